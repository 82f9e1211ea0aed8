"""Registration, selections and derived frames of a cohort (the remaining S, K, J, T, R and V rows)."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import profiles as P
from tessera.operators.guards import Refused, conflicting, incomplete, one_to_one, require_empty
from tessera.operators.keys import grid_xy, supercluster


def resolve_columns(df: DataFrame, rep: str, metadata: tuple[str, ...] = ("samples", "slides", "tiles")) -> dict[str, str]:
    """Which columns hold the representation and the metadata, with or without a set's prefix; from the schema, no job."""
    out = {}
    for want in (rep, *metadata):
        found = [c for c in df.columns if c == want or c.split("_", 1)[-1] == want or want == rep and rep in c]
        if len(found) != 1:
            raise Refused(f"one column for {want} is needed, not {found}")
        out[want] = found[0]
    return out


def probability_columns(df: DataFrame, prefix: str = "p_hpc_") -> list[str]:
    """In the order of their numbers."""
    return sorted((c for c in df.columns if c.startswith(prefix) and c.removeprefix(prefix).isdigit()), key=lambda c: int(c.removeprefix(prefix)))


def slide_files(paths: DataFrame, path: str = "path") -> DataFrame:
    """Slides by the base name of their files, with how many files each has and whether that is ambiguous."""
    name = F.regexp_extract(path, r"([^/?#]+?)(\.[A-Za-z0-9]+)?/?([?#].*)?$", 1)
    return paths.groupBy(name.alias("slide")).agg(F.count("*").alias("files")).withColumn("ambiguous", F.col("files") > 1)


def normalising_updates(df: DataFrame, *cols: str) -> DataFrame:
    """How many values of each column the canonical form would change."""
    return df.agg(*(F.count_if(F.col(c) != F.upper(F.trim(c))).alias(c) for c in cols))


def run_record(values: DataFrame, table: DataFrame) -> DataFrame:
    """Only the columns that the table has."""
    return values.select(*(c for c in values.columns if c in table.columns))


def low_confidence(df: DataFrame, below: float = 0.1) -> DataFrame:
    """P13."""
    return df.where(F.col("vote_margin").isNotNull() & (F.col("vote_margin") < below))


def containing(df: DataFrame, col: str, part: str) -> DataFrame:
    """Whatever the case; signs of patterns in ``part`` count as themselves."""
    return df.where(F.contains(F.lower(col), F.lit(part.lower())))


def enough_tiles(df: DataFrame, col: str, least: int) -> DataFrame:
    """A value that is no number refuses."""
    require_empty(df.where(F.col(col).try_cast("double").isNull()), f"{col} must be a number")
    return df.where(F.col(col).try_cast("double") >= least)


def over(df: DataFrame, **limits: float) -> DataFrame:
    """A flag over_<column>_<limit> for each column and limit."""
    return df.select("*", *(F.when(F.col(c).isNotNull(), F.col(c) > v).alias(f"over_{c}_{v:g}") for c, v in limits.items()))


def with_probabilities(meta: DataFrame, heat: DataFrame, key: str = "slide_tile") -> DataFrame:
    """Probabilities of the view's tiles only: the keys reach the large table as a semi-join before the left join."""
    return meta.join(heat.join(meta.select(key), key, "left_semi"), key, "left")


def pitch(tiles: DataFrame, x: str, slide: str = "slides") -> DataFrame:
    """The smallest difference of neighbouring distinct positions, by slide."""
    at = tiles.select(slide, x).distinct()
    step = F.col(x) - F.lag(x).over(Window.partitionBy(slide).orderBy(x))
    return at.withColumn("step", step).where("step > 0").groupBy(slide).agg(F.min("step").alias("pitch"))


def joined_exactly(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """An inner join that refuses keys of one side only."""
    for left, right in ((a, b), (b, a)):
        require_empty(left.join(right.select(key), key, "left_anti").select(key), "keys without a partner")
    return a.join(b, key)


def side_by_side(a: DataFrame, b: DataFrame, row: str = "row_id") -> DataFrame:
    """By an explicit row number only."""
    return one_to_one(a, b, [row], "inner")


def sample_of(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """N keys in the order of a digest of seed and key, with all their rows. A sampling operator: the limit is the feature."""
    chosen = df.select(key).distinct().orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), key).limit(n)
    return df.join(chosen, key, "left_semi")


def first_tiles(tiles: DataFrame, n: int, order: str) -> DataFrame:
    """T3, T13."""
    return tiles.orderBy(order).limit(n)


def key_differences(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of one side only."""
    only = lambda x, y, name: x.select(key).distinct().join(y.select(key), key, "left_anti").withColumn("side", F.lit(name))
    return only(a, b, "left").unionAll(only(b, a, "right"))


def expected_tables(names: list[str], there: DataFrame, col: str = "name") -> DataFrame:
    """A list of tables with whether each exists."""
    spark = there.sparkSession
    want = spark.createDataFrame([(n,) for n in names], f"{col} string")
    return want.join(there.select(col).distinct().withColumn("_there", F.lit(True)), col, "left").select(col, F.col("_there").isNotNull().alias("present"))


def banded_accuracy(votes: DataFrame, edges: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75)) -> DataFrame:
    """Accuracy by margin band, and how often the runner-up would have been right."""
    band = sum(((F.col("margin") >= e).cast("int") for e in edges), F.lit(0))
    right = lambda c: F.round(F.avg((F.col(c) == F.col("truth")).cast("int")), 6)
    return votes.groupBy(band.alias("band")).agg(F.count("*").alias("n"), right("label").alias("accuracy"), right("runner_up").alias("if_swapped"))


def holdout_accuracy(votes: DataFrame, slide: str = "slides") -> DataFrame:
    """Mean and spread of the accuracy of held-out slides."""
    per = votes.groupBy(slide).agg(F.avg((F.col("label") == F.col("truth")).cast("int")).alias("a"), F.count("*").alias("n"))
    return per.agg(F.count("*").alias("slides"), F.sum("n").alias("tiles"), F.round(F.avg("a"), 6).alias("mean"), F.round(F.stddev_samp("a"), 6).alias("sd"))


def check_holdout(holdout: DataFrame, reduced: DataFrame, slide: str = "slides", code: str = "code") -> DataFrame:
    """Held-out slides must be absent from the reduced reference; yields the clusters that it can't reach."""
    require_empty(holdout.join(reduced.select(slide).distinct(), slide, "left_semi").select(slide).distinct(), "held-out slides in the reference")
    return holdout.select(code).distinct().join(reduced.select(code), code, "left_anti")


def build_reference(codes: DataFrame, categories: DataFrame, vectors: DataFrame) -> DataFrame:
    """ref_id, code, label, vec; refuses repeated ids, missing vectors, vectors of other widths and codes without a label."""
    ref = joined_exactly(one_to_one(codes, vectors, ["ref_id"], "inner"), codes.select("ref_id"), "ref_id").join(categories, "code", "left")
    require_empty(ref.where("label is null"), "codes without a label")
    width = ref.agg(F.min(F.size("vec")).alias("a"), F.max(F.size("vec")).alias("b")).first()
    if width.a != width.b:
        raise Refused(f"vectors of {width.a} to {width.b} components")
    return ref


def pca(df: DataFrame, k: int, vec: str = "vec") -> tuple[DataFrame, list[float]]:
    """The first k principal components and their share of the variance."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = df.withColumn("_v", array_to_vector(vec))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(v)
    return model.transform(v).withColumn("pca", vector_to_array("_p")).drop("_v", "_p"), [float(x) for x in model.explainedVariance]


def dictionary_state(dictionary: DataFrame) -> DataFrame:
    """Rows of a dictionary, malignant ones among them, and whether it can be used: both must be there."""
    return dictionary.agg(F.count("*").alias("n"), F.count_if("malignant").alias("malignant")).withColumn("usable", (F.col("n") > 0) & (F.col("malignant") > 0))


def require_dictionary(dictionary: DataFrame) -> None:
    """G8."""
    r = dictionary_state(dictionary).first()
    if not r.usable:
        raise Refused(f"a dictionary of {r.n} rows, {r.malignant} malignant")


def require_complete(df: DataFrame, columns: dict[str, str], rows: int) -> None:
    """A packaged table has these columns and types and so many rows."""
    require_empty(incomplete(df, columns), "columns differ")
    if (n := df.count()) != rows:
        raise Refused(f"{n} rows, not {rows}")


class Load:
    """A load that is only planned until commit() is called; preview() writes nothing."""

    def __init__(self, planned: DataFrame, report: DataFrame, checks: list) -> None:
        self.planned, self.report, self.checks = planned, report, checks

    def preview(self) -> DataFrame:
        return self.report

    def commit(self, path: str) -> int:
        from tessera.sources.sinks import commit

        for check in self.checks:
            check()
        return commit(self.planned, path)

    def publish(self, path: str, base: str | None = None) -> str:
        """The load as a new version of the table at ``path``, which readers get once it is whole; refused if another than ``base`` is there."""
        from tessera.sources.versions import publish

        for check in self.checks:
            check()
        return publish(self.planned, path, base=base)


def build_registration(identity: DataFrame, coords: DataFrame, scope: DataFrame | None = None) -> dict[str, DataFrame]:
    """Registry, coordinates, slides, unmatched tiles and samples in conflict; ``scope`` (slides) narrows both sides."""
    if scope is not None:
        identity, coords = (x.join(scope.select("slides").distinct(), "slides", "left_semi") for x in (identity, coords))
    j = one_to_one(identity, coords.drop("slides").withColumn("_there", F.lit(True)), ["slide_tile"])
    return {
        "registry": j.select("samples", "slides", "slide_tile", "image_index"),
        "coordinates": j.where("_there").drop("_there"),
        "slides": identity.groupBy("slides").agg(F.min("samples").alias("samples"), F.count("*").alias("n_tiles")),
        "unmatched": j.where("_there is null").select("slide_tile"),
        "conflicts": conflicting(identity, "slides", "samples"),
    }


def registration_preview(target: DataFrame, new: DataFrame, key: str, scope: str, dataset: str) -> DataFrame:
    """Rows there, rows new and collisions with other datasets; a semi-join in place of lists of keys."""
    hit = target.join(new.select(key).distinct(), key, "left_semi")
    own = F.col(scope) == dataset
    return hit.agg(F.count_if(own).alias("existing"), F.count_if(~own).alias("foreign")).crossJoin(new.agg(F.count("*").alias("incoming")))  # one row each


def frames(df: DataFrame, cluster: str, label: str, sample: str) -> DataFrame:
    """Purities with diversity, by subtype and falling purity."""
    return P.purities(df, cluster, label).join(P.diversity(df, cluster, sample), cluster).orderBy("subtype", F.desc("purity"), cluster)


def with_connectivity(composition: DataFrame, connectivity: DataFrame, key: str, keep_composition: bool) -> DataFrame:
    """Features by sample; the class version keeps connectivity features only, the survival version both."""
    j = composition.join(connectivity, key)
    return j if keep_composition else j.select(key, *(c for c in connectivity.columns if c != key))


def with_purity(samples: DataFrame, purity: DataFrame) -> DataFrame:
    """Sample rows and the purity row, told apart by a tag rather than by position."""
    return samples.withColumn("kind", F.lit("sample")).unionByName(purity.withColumn("kind", F.lit("purity")), allowMissingColumns=True)


def group_counts(df: DataFrame, core: str, cluster: str, groups: dict[str, list[int]]) -> DataFrame:
    """Tiles of each fixed group of clusters by core, as columns."""
    g = supercluster(F.col(cluster), groups)
    return df.groupBy(core).agg(*(F.count_if(g == name).alias(name) for name in groups))


def core_id(value: Column, width: int = 3) -> Column:
    """Letters as they are, the number padded."""
    return F.concat(F.upper(F.regexp_extract(value, r"^([A-Za-z]*)", 1)), F.lpad(F.regexp_extract(value, r"(\d+)$", 1), width, "0"))


def topography(dictionary: DataFrame) -> DataFrame:
    """Clusters by side, malignant or stromal; those that are neither are left out."""
    return dictionary.where(F.col("malignant").isNotNull()).select("hpc_id", F.when(F.col("malignant"), "malignant").otherwise("stromal").alias("side"))


def with_participants(df: DataFrame, ref: str) -> DataFrame:
    """Slide and participant from a reference field."""
    return df.withColumn("slide", F.substring_index(ref, "_", 1)).withColumn("participant", F.substring_index(F.substring_index(ref, "_", 1), "-", 3))


def combined(parts: dict[str, DataFrame]) -> DataFrame:
    """Sets stacked by name with the set each row comes from."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn("part", F.lit(k)) for k, df in parts.items()))


def tile_at(tiles: DataFrame, slide: str, x: float, y: float, px: float) -> DataFrame:
    """Q15, Q18."""
    col, row = grid_xy(F.lit(x), F.lit(y), F.lit(px))
    return tiles.where((F.col("slides") == slide) & (F.col("grid_col") == col) & (F.col("grid_row") == row))


def sql_frame(df: DataFrame, name: str, text: str) -> DataFrame:
    """An SQL scan over a named view of a frame."""
    return df.sparkSession.sql(text, **{name: df})


def descriptions(sheet: DataFrame, key: str = "hpc_id", text: str = "description", removed: str = "removed") -> tuple[DataFrame, DataFrame]:
    """The description of each cluster, and the clusters that a review removed."""
    gone = F.lower(F.trim(removed)).isin("x", "yes", "true", "1")
    return sheet.where(~F.coalesce(gone, F.lit(False)) & (F.trim(text) != "")).select(key, F.trim(text).alias(text)), sheet.where(gone).select(key)


def write_list(df: DataFrame, col: str, path: str) -> None:
    """One name a line, in order; Spark's committer makes it appear whole."""
    df.select(F.col(col).cast("string")).orderBy(col).coalesce(1).write.mode("overwrite").text(path)


def to_long(df: DataFrame, key: str, prefix: str = "p_hpc_") -> DataFrame:
    """Probability columns as rows of cluster and value."""
    cols = probability_columns(df, prefix)
    return df.unpivot(key, cols, "hpc_id", "p").withColumn("hpc_id", F.substring("hpc_id", len(prefix) + 1, 9).cast("int")).where("p is not null")


def to_wide(df: DataFrame, key: str, clusters: list[int], prefix: str = "p_hpc_") -> DataFrame:
    """One column a named cluster."""
    return df.groupBy(key).agg(*(F.max(F.when(F.col("hpc_id") == c, F.col("p"))).alias(f"{prefix}{c}") for c in clusters))


def titled(df: DataFrame, dictionary: DataFrame, strict: bool = False) -> DataFrame:
    """A left join with the dictionary; strict refuses clusters that it lacks."""
    j = df.join(dictionary.withColumn("_known", F.lit(True)), "hpc_id", "left")
    if strict:
        require_empty(j.where(F.col("hpc_id").isNotNull() & F.col("_known").isNull()).select("hpc_id").distinct(), "unknown clusters")
    return j.drop("_known")


def matched(stage: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows of the stage that the registry has, on the canonical key of both."""
    key = lambda df: df.withColumn("_key", F.upper(F.trim("slide_tile")))
    return key(stage).join(key(registry).select("_key").distinct(), "_key", "left_semi").drop("_key")
