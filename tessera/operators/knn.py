"""Exact k nearest neighbours, weighted votes, margins and what is measured on them (V rows)."""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import nearest
from tessera.operators.guards import Refused, duplicate_keys, require_empty
from tessera.operators.scan import quantiles
from tessera.sources.scratch import written

#: Vote settings by name. Published presets.
PRESETS = {
    "tuned": {"k": 10, "power": 3.0, "adaptive_k": 25, "adaptive_margin": 0.15},
    "legacy": {"k": 250, "power": 0.0, "adaptive_k": None, "adaptive_margin": None},
}
EPS = 1e-6
#: Clusters whose centroids may go to the driver and to tasks.
MOST_CENTROIDS = 10_000


def resolve_vote(preset: str = "tuned", **changes) -> dict:
    """A preset with overrides; adaptive settings come together and widen k."""
    if preset not in PRESETS:
        raise Refused(f"no preset {preset}")
    out = PRESETS[preset] | {k: v for k, v in changes.items() if v is not None}
    if unknown := set(out) - set(PRESETS["tuned"]):
        raise Refused(f"unknown settings {sorted(unknown)}")
    if (out["adaptive_k"] is None) != (out["adaptive_margin"] is None):
        raise Refused("adaptive_k and adaptive_margin come together")
    if out["adaptive_k"] is not None and out["adaptive_k"] <= out["k"]:
        raise Refused("adaptive_k must be above k")
    return out


def mean_vector(df: DataFrame, vec: str = "vec", *group: str) -> DataFrame:
    """Mean of each component over all rows, as an array; null where there is none. One partial aggregate by position."""
    long = df.select(*group, F.posexplode(vec).alias("pos", "x"))
    mean = F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s.x)
    return long.groupBy(*group, "pos").agg(F.avg("x").alias("x")).groupBy(*group).agg(F.when(F.count("*") > 0, mean).alias("mean"))


def project(df: DataFrame, components: np.ndarray, mean: np.ndarray | None, vec: str = "vec") -> DataFrame:
    """V1: (x - mean) @ components in Arrow batches; a vector of another width refuses."""
    d = components.shape[0]
    names, at = df.columns, df.columns.index(vec)
    schema = ", ".join(f"`{c}` {t if c != vec else 'array<double>'}" for c, t in df.dtypes)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.asarray(b.column(at).flatten(), np.float64)
            if x.size != b.num_rows * d:
                raise Refused(f"vectors must have {d} components")
            x = x.reshape(-1, d)
            y = (x if mean is None else x - mean) @ components
            col = pa.ListArray.from_arrays(np.arange(0, y.size + 1, y.shape[1], dtype=np.int32), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([col if i == at else c for i, c in enumerate(b.columns)], names)

    return df.mapInArrow(over, schema)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x)


def unit(vec: Column, eps: float = 1e-12) -> Column:
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.transform(vec, lambda x: x / F.greatest(norm, F.lit(eps)))


def packed(refs: DataFrame, metric: str = "l2", blocks: int | None = None) -> nearest.Index:
    """References packed for any number of searches by one metric, in about so many blocks, or in blocks of the usual size."""
    if metric not in ("l2", "cosine"):
        raise Refused(f"no metric {metric}")
    own = refs.withColumn("vec", unit(F.col("vec"))) if metric == "cosine" else refs
    return nearest.index(own, max(1, -(-own.count() // blocks)) if blocks else None)


def neighbours(asks: DataFrame, refs: DataFrame | nearest.Index, k: int, metric: str = "l2", exclude_self: bool = False, blocks: int | None = None) -> DataFrame:
    """row_id, truth, ref_id, code, d2, rank of the k nearest references, ties to the smaller ref_id.

    refs: rows, which are packed for this search, or what ``packed`` made of them by the same metric. Sets of neighbouring
    queries take the blocks that bounds leave them, in tasks of bounded size. Distances are one product of matrices, and
    on the candidates that it picks they are summed exactly, so ranks follow exact distances; squares of components must
    fit single precision. cosine: on unit vectors, d2 = max(2 - 2 sim, 0).
    """
    index = refs if isinstance(refs, nearest.Index) else packed(refs, metric, blocks)
    own = asks.withColumn("vec", unit(F.col("vec"))) if metric == "cosine" else asks
    out = nearest.search(own, index, k, exclude_self)
    return out.withColumn("d2", F.greatest("d2", F.lit(0.0))) if metric == "cosine" else out


def local_scales(refs: DataFrame, r: int) -> DataFrame:
    """V8: each reference's distance to its r-th other reference."""
    own = refs.select(F.col("ref_id").alias("row_id"), F.lit(None).cast("int").alias("truth"), "vec")
    near = neighbours(own, refs, r, exclude_self=True)
    return near.groupBy(F.col("row_id").alias("ref_id")).agg(F.sqrt(F.max("d2")).alias("scale"))


def _votes(near: DataFrame, ks: list[int], power: float, class_weights: DataFrame | None, scales: DataFrame | None) -> DataFrame:
    """row_id, truth and for each k a struct v<k>: label, runner_up, margin, neighbor_distance. One aggregation for all k."""
    n = near.where(F.col("rank") <= max(ks))
    d = F.sqrt("d2")
    if scales is not None:
        n = n.join(scales, "ref_id", "left")
        d = d / F.greatest(F.coalesce("scale", F.lit(1.0)), F.lit(EPS))
    w = F.lit(1.0) if not power else F.pow(1 / (d + EPS), F.lit(power))
    if class_weights is not None:
        n = n.join(class_weights, "code", "left")
        w = w * F.coalesce("weight", F.lit(1.0))
    n = n.withColumn("w", w)
    held = {k: F.col("rank") <= k for k in ks}
    sums = [f.alias(f"{x}{k}") for k in ks for x, f in (("w", F.sum(F.when(held[k], F.col("w")))), ("d", F.sum(F.when(held[k], F.sqrt("d2")))), ("n", F.count_if(held[k])))]
    by_code = n.groupBy("row_id", "code").agg(*sums, F.first("truth").alias("truth"))
    ranked = {k: F.sort_array(F.collect_list(F.when(F.col(f"n{k}") > 0, F.struct(F.col(f"w{k}").alias("w"), "code"))), asc=False) for k in ks}
    parts = [f.alias(f"{x}{k}") for k in ks for x, f in (("r", ranked[k]), ("total", F.sum(f"w{k}")), ("mean", F.sum(f"d{k}") / F.sum(f"n{k}")))]
    out = by_code.groupBy("row_id").agg(*parts, F.first("truth").alias("truth"))

    def result(k: int) -> Column:
        first, second = F.get(f"r{k}", F.lit(0)), F.get(f"r{k}", F.lit(1))
        margin = (first.w - F.coalesce(second.w, F.lit(0.0))) / F.greatest(f"total{k}", F.lit(1e-12))
        return F.struct(first.code.alias("label"), second.code.alias("runner_up"), margin.alias("margin"), F.col(f"mean{k}").alias("neighbor_distance"))

    return out.select("row_id", "truth", *(result(k).alias(f"v{k}") for k in ks))


def vote(near: DataFrame, k: int, power: float = 0.0, class_weights: DataFrame | None = None, scales: DataFrame | None = None) -> DataFrame:
    """Label, margin and mean distance of each query's first k neighbours; ties go to the highest code.

    Weights are 1 / (distance + eps) ** power, over the class size or the reference's scale where given. The margin is
    the lead over the sum of weights; the distance is neither weighted nor scaled.
    """
    return _votes(near, [k], power, class_weights, scales).select("row_id", "truth", f"v{k}.*")


def classify(near: DataFrame, k: int, power: float, adaptive_k: int | None = None, adaptive_margin: float | None = None, class_weights: DataFrame | None = None, scales: DataFrame | None = None) -> DataFrame:
    """A vote over k, and where its margin is low the wider vote instead, with its margin and distance. One search and one aggregation serve both."""
    if adaptive_k is None:
        return vote(near, k, power, class_weights, scales).withColumn("revoted", F.lit(False))
    both = _votes(near, [k, adaptive_k], power, class_weights, scales)
    low = F.col(f"v{k}.margin") < adaptive_margin
    return both.select("row_id", "truth", F.when(low, F.col(f"v{adaptive_k}")).otherwise(F.col(f"v{k}")).alias("v"), low.alias("revoted")).select("row_id", "truth", "v.*", "revoted")


def accuracy(votes: DataFrame) -> DataFrame:
    """V14, V25, T8."""
    return votes.agg(F.count("*").alias("n"), F.round(F.avg((F.col("label") == F.col("truth")).cast("int")), 6).alias("accuracy"))


def sweep(near: DataFrame, ks: tuple[int, ...], powers: tuple[float, ...]) -> DataFrame:
    """Accuracy over a grid of k and power from one search: a row of sums holds all settings, so neighbours aren't copied."""
    grid = [(k, float(p)) for k in ks for p in powers]
    w = lambda p: F.lit(1.0) if p == 0 else F.pow(1 / (F.sqrt("d2") + EPS), F.lit(p))
    sums = [F.sum(F.when(F.col("rank") <= k, w(p))).alias(f"w{i}") for i, (k, p) in enumerate(grid)]
    n = near.where(F.col("rank") <= max(ks)).groupBy("row_id", "truth", "code").agg(*sums)
    best = n.groupBy("row_id", "truth").agg(*(F.max_by("code", F.when(F.col(f"w{i}").isNotNull(), F.struct(f"w{i}", "code"))).alias(f"l{i}") for i in range(len(grid))))
    right = best.agg(F.count("*").alias("n"), *(F.count_if(F.col(f"l{i}") == F.col("truth")).alias(f"r{i}") for i in range(len(grid))))
    rows = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(p).alias("power"), F.col("n"), F.round(F.col(f"r{i}") / F.col("n"), 6).alias("accuracy")) for i, (k, p) in enumerate(grid)))
    return right.select(F.inline(rows)).where("n > 0")


def mcnemar(a: DataFrame, b: DataFrame) -> DataFrame:
    """What b fixed and broke against a, net, and the z of the difference."""
    j = a.select("row_id", (F.col("label") == F.col("truth")).alias("a")).join(b.select("row_id", (F.col("label") == F.col("truth")).alias("b")), "row_id")
    fixed, broke = F.count_if(~F.col("a") & F.col("b")), F.count_if(F.col("a") & ~F.col("b"))
    return j.agg(fixed.alias("fixed"), broke.alias("broke")).withColumn("net", F.col("fixed") - F.col("broke")).withColumn("z", F.round(F.col("net") / F.sqrt(F.nullif(F.col("fixed") + F.col("broke"), F.lit(0))), 6))


def tiebreak(near: DataFrame, votes: DataFrame, k: int, flip: float = 0.0) -> DataFrame:
    """Label of low-margin rows by the nearest neighbour of the two leaders, or by their smaller mean distance if that leads by more than flip."""
    two = votes.select("row_id", "label", "runner_up")
    n = near.where(F.col("rank") <= k).join(two, "row_id").where(F.col("code").isin(F.col("label"), F.col("runner_up")))
    d = F.sqrt("d2")
    mine = F.col("code") == F.col("label")
    out = n.groupBy("row_id", "label", "runner_up", "truth").agg(F.min_by("code", F.struct("d2", "ref_id")).alias("nearest"), F.avg(F.when(mine, d)).alias("a"), F.avg(F.when(~mine, d)).alias("b"))
    swap = (F.col("a") - F.col("b")) / (F.abs("a") + F.abs("b") + EPS) > flip
    return out.select("row_id", "truth", "label", "nearest", F.when(swap, F.col("runner_up")).otherwise(F.col("label")).alias("mean_distance"))


def diagnostics(near: DataFrame, core: float = 0.8) -> DataFrame:
    """For each cluster of a leave-one-out search, own share, core share, radius, strongest foreign partner and a verdict.
    The search runs once: a row for each query, with its neighbours' codes, is written and read for both."""
    per = near.groupBy("row_id", "truth").agg(F.avg((F.col("code") == F.col("truth")).cast("int")).alias("own"), F.avg(F.sqrt("d2")).alias("radius"), F.collect_list(F.when(F.col("code") != F.col("truth"), F.col("code"))).alias("foreign"))
    per, _ = written(per, "diagnosed")
    own = per.groupBy("truth").agg(F.count("*").alias("size"), F.avg("own").alias("purity"), F.avg((F.col("own") >= core).cast("int")).alias("core"), F.avg("radius").alias("radius"))
    foreign = per.select("truth", F.explode("foreign").alias("code")).groupBy("truth", "code").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("truth"))
    top = foreign.withColumn("share", F.col("n") / total).groupBy("truth").agg(F.max_by("code", F.struct("n", -F.col("code"))).alias("partner"), F.max("share").alias("dominance"))
    back = top.select(F.col("truth").alias("partner"), F.col("partner").alias("back"))
    j = own.join(top, "truth", "left").join(back, "partner", "left")
    mutual = F.coalesce(F.col("back") == F.col("truth"), F.lit(False))
    verdict = F.when((F.col("purity") < 0.5) & (F.col("dominance") >= 0.6) & mutual, "duplicate").when((F.col("purity") < 0.5) & (F.col("dominance") >= 0.6), "engulfed").when(F.col("core") < 0.1, "diffuse").otherwise("boundary")
    return j.select(F.col("truth").alias("code"), "size", F.round("purity", 6).alias("purity"), F.round("core", 6).alias("core"), F.round("radius", 6).alias("radius"), "partner", F.round("dominance", 6).alias("dominance"), mutual.alias("mutual"), verdict.alias("verdict"))


def medoids(refs: DataFrame, most: int | None = None) -> DataFrame:
    """Of each cluster the member with the least summed squared distance to all, or within a sample of up to ``most`` by hash."""
    if most is not None:
        w = Window.partitionBy("code").orderBy(F.xxhash64("ref_id"), "ref_id")
        refs = refs.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= most)
    return exact_medoids(refs).select("code", "medoid")


def exact_medoids(refs: DataFrame) -> DataFrame:
    """Of each cluster's members, all of them, the one with the least summed squared distance, ties to the smaller id.

    Of n members with mean m the sum from x is n times the squared distance of x and m, and what is the same for all. So
    the medoid is the member nearest the mean, and no pair of members is formed; cost is that sum.
    """
    means = mean_vector(refs, "vec", "code").join(refs.groupBy("code").agg(F.count("*").alias("_n")), "code")
    far = refs.join(means, "code").select("code", "ref_id", "_n", squared_distance(F.col("vec"), F.col("mean")).alias("_d"))
    spread = far.groupBy("code").agg(F.sum("_d").alias("_all"), F.min_by(F.struct("ref_id", "_d"), F.struct(F.round("_d", 9), F.col("ref_id"))).alias("_m"), F.first("_n").alias("n"))
    return spread.select("code", F.col("_m.ref_id").alias("medoid"), "n", (F.col("n") * F.col("_m._d") + F.col("_all")).alias("cost"))


def _centroids(refs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Codes in order and their mean vectors; more than MOST_CENTROIDS are refused, so the matrix has a bound."""
    found = mean_vector(refs, "vec", "code").limit(MOST_CENTROIDS + 1).collect()
    if len(found) > MOST_CENTROIDS:
        raise Refused(f"more than {MOST_CENTROIDS} clusters")
    found.sort(key=lambda r: r.code)
    return np.array([r.code for r in found], np.int64), np.array([r.mean for r in found], np.float64)


def _to_centroids(shared):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, means = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                x = np.asarray(b.column("vec").flatten(), np.float64).reshape(b.num_rows, -1)
                d = np.sqrt(np.maximum((x * x).sum(1)[:, None] - 2 * (x @ means.T) + (means * means).sum(1), 0))
                own = np.searchsorted(codes, np.asarray(b.column("code")))
                rows = np.arange(len(x))
                a = np.sqrt(((x - means[own]) ** 2).sum(1))
                d[rows, own] = np.inf
                other = d.min(1)
                yield pa.RecordBatch.from_arrays([b.column("ref_id"), b.column("code"), pa.array(a), pa.array(other, mask=np.isinf(other))], ["ref_id", "code", "a", "b"])

    return over


def centroid_distances(refs: DataFrame, centroids: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """ref_id, code, a, b: each row's distance to its own centroid and to the nearest other one (null if there is none)."""
    shared = refs.sparkSession.sparkContext.broadcast(centroids)
    return refs.select("ref_id", "code", "vec").mapInArrow(_to_centroids(shared), "ref_id long, code int, a double, b double")


def centroid_scores(refs: DataFrame) -> DataFrame:
    """Simplified silhouette and mean distance to the own centroid (disruption), by cluster."""
    per = centroid_distances(refs, _centroids(refs))
    s = (F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0))
    return per.groupBy("code").agg(F.round(F.avg(s), 6).alias("silhouette"), F.round(F.avg("a"), 6).alias("spread"))


def cluster_quality(refs: DataFrame, config: str) -> DataFrame:
    """One row for a configuration: n, clusters, silhouette, disruption, variance ratio and Davies-Bouldin index.

    Rows are summed by cluster in Spark; sums by cluster and centroids, of a checked number, are put together here.
    """
    codes, means = _centroids(refs)
    s = (F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0))
    sums = (F.count("*").alias("n"), F.avg("a").alias("s"), F.sum(F.col("a") * F.col("a")).alias("w"), F.sum(s).alias("silhouette"))
    per = sorted(centroid_distances(refs, (codes, means)).groupBy("code").agg(*sums).collect(), key=lambda r: r.code)
    n, spread, within = (np.array([r[c] for r in per], np.float64) for c in ("n", "s", "w"))
    k, total = len(per), n.sum()
    grand = (n[:, None] * means).sum(0) / total
    between = (n * ((means - grand) ** 2).sum(1)).sum()
    vrc = float(between / (k - 1) / (within.sum() / (total - k))) if k > 1 and total > k and within.sum() else None
    apart = np.sqrt(((means[:, None] - means[None]) ** 2).sum(2)) if k <= 2000 else np.stack([np.sqrt(((means - m) ** 2).sum(1)) for m in means])
    np.fill_diagonal(apart, np.inf)
    dbi = float(((spread[:, None] + spread) / apart).max(1).mean()) if k > 1 else None
    silhouette = float(sum(r.silhouette or 0.0 for r in per) / total)
    row = (config, int(total), k, silhouette, float((n * spread).sum() / total), vrc, dbi)
    out = refs.sparkSession.createDataFrame([row], "config string, n long, clusters long, silhouette double, disruption double, vrc double, dbi double")
    return out.select("config", "n", "clusters", *(F.round(c, 6).alias(c) for c in ("silhouette", "disruption", "vrc", "dbi")))


def configurations(refs: DataFrame, codes: dict[str, Column]) -> DataFrame:
    """The table of cluster configurations, one row for each way to code the same vectors."""
    return reduce(DataFrame.unionAll, (cluster_quality(refs.withColumn("code", c.cast("int")), name) for name, c in codes.items()))


def agreement(predicted: DataFrame, truth: DataFrame, keys: list[str], label: str, least: float = 0.99) -> DataFrame:
    """Rows that both have, the share whose labels are equal, and whether that is enough. Truth without a label, or
    with several for one key, is left out; a key that repeats among the predictions refuses."""
    require_empty(duplicate_keys(predicted, *keys), "predicted keys repeat")
    clear = truth.where(F.col(label).isNotNull()).groupBy(*keys).agg(F.min(label).alias("_t"), F.max(label).alias("_u")).where("_t = _u")
    j = predicted.join(clear, keys)
    return j.agg(F.count("*").alias("n"), F.round(F.avg((F.col(label) == F.col("_t")).cast("int")), 6).alias("agreement")).withColumn("passes", F.col("agreement") >= least)


def compared_tiebreaks(near: DataFrame, votes: DataFrame, k: int, flips: tuple[float, ...]) -> DataFrame:
    """For each flip margin, rows with a narrow vote and how many the vote, the nearest neighbour and the mean distance get right."""
    right = lambda c: F.count_if(F.col(c) == F.col("truth"))
    one = lambda f: tiebreak(near, votes, k, f).agg(F.lit(f).alias("flip"), F.count("*").alias("n"), right("label").alias("vote"), right("nearest").alias("nearest"), right("mean_distance").alias("mean_distance"))
    return reduce(DataFrame.unionAll, map(one, flips))


def graph_silhouette(near: DataFrame) -> DataFrame:
    """On neighbour edges, mean distance inside the cluster against that to the closest other."""
    e = near.groupBy("truth", "code").agg(F.avg(F.sqrt("d2")).alias("d"))
    out = e.groupBy("truth").agg(F.min(F.when(F.col("truth") == F.col("code"), F.col("d"))).alias("a"), F.min(F.when(F.col("truth") != F.col("code"), F.col("d"))).alias("b"))
    return out.select(F.col("truth").alias("code"), F.round((F.col("b") - F.col("a")) / F.greatest("a", "b"), 6).alias("silhouette"))


def shift_profile(df: DataFrame, qs: tuple[float, ...] = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0)) -> DataFrame:
    """Ten quantiles of the novelty distance, and the mean margin."""
    found = F.array(*(F.lit(q).cast("double") for q in quantiles(df, "neighbor_distance", qs)))
    return df.agg(F.round(F.avg("vote_margin"), 6).alias("margin")).select(F.transform(found, lambda x: F.round(x, 6)).alias("quantiles"), "margin")


def shift_compare(cohort: DataFrame, reference: DataFrame, group: str) -> DataFrame:
    """By slide, the share beyond the reference's 99th percentile, the ratio of medians and a verdict. A slide's own median is found in one task."""
    p99, p50 = quantiles(reference, "neighbor_distance", (0.99, 0.5))
    beyond = F.avg((F.col("neighbor_distance") > F.lit(p99).cast("double")).cast("int"))
    out = cohort.groupBy(group).agg(beyond.alias("beyond"), (F.percentile("neighbor_distance", 0.5) / F.nullif(F.lit(p50).cast("double"), F.lit(0.0))).alias("ratio"))
    verdict = F.when((F.col("beyond") > 0.05) | (F.col("ratio") > 1.5), "alarm").when((F.col("beyond") > 0.02) | (F.col("ratio") > 1.15), "notice").otherwise("consistent")
    return out.select(group, F.round("beyond", 6).alias("beyond"), F.round("ratio", 6).alias("ratio"), verdict.alias("verdict"))
