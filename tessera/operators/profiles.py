"""Composition, coverage and tumour lists (A, J and T rows)."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def proportion(tiles: DataFrame, min_margin: float | None = None, group: tuple[str, ...] = ("samples", "slides"), label: str = "hpc_id") -> DataFrame:
    """Share of each label in its group, after an optional cut by margin. The window runs over counts, one row a label."""
    kept = tiles if min_margin is None else tiles.where(F.col("vote_margin") >= min_margin)
    n = counts_by(kept, *group, label)
    return n.withColumn("proportion", F.col("n") / F.sum("n").over(Window.partitionBy(*group)).cast("double"))


def summary(tiles: DataFrame, group: tuple[str, ...] = ("samples", "slides"), label: str = "hpc_id") -> DataFrame:
    """A2: tiles of each group and its most frequent label; ties go to the smallest. One shuffle by group after a partial count."""
    n = counts_by(tiles, *group, label)
    return n.groupBy(*group).agg(F.sum("n").alias("total_tiles"), F.max_by(label, F.struct("n", -F.col(label))).alias(f"dominant_{label.removesuffix('_id')}"))


def tri_counts(df: DataFrame, flag: str = "malignant") -> DataFrame:
    """A4."""
    n = F.count("*")
    parts = {"n_true": F.col(flag), "n_false": ~F.col(flag), "n_null": F.col(flag).isNull()}
    return df.agg(n.alias("n"), *(F.count_if(c).alias(k) for k, c in parts.items()), *(F.round(100 * F.count_if(c) / n, 2).alias(f"pct_{k[2:]}") for k, c in parts.items()))


def coverage(prop: DataFrame, dictionary: DataFrame, group: str = "slides") -> DataFrame:
    """A5: percent of a slide in malignant clusters, null where there is nothing to divide by."""
    j = prop.join(dictionary, "hpc_id", "left")
    share = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    total = F.nullif(F.sum("n"), F.lit(0))
    return j.groupBy(group).agg(F.round(100.0 * share(F.col("malignant")) / total, 2).alias("pct_malignant"), F.round(100.0 * share(~F.col("malignant")) / total, 2).alias("pct_other"))


def tumour_list(prop: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Malignant tiles of each slide, their share and how many malignant clusters there are; unknown malignancy counts as not malignant."""
    j = prop.join(dictionary, "hpc_id", "left")
    bad = F.coalesce("malignant", F.lit(False))
    return j.groupBy("samples", "slides").agg(
        F.sum("n").alias("total_tiles"),
        F.sum(F.when(bad, F.col("n")).otherwise(0)).alias("malignant_tiles"),
        F.countDistinct(F.when(bad, F.col("hpc_id"))).alias("malignant_hpcs"),
    ).withColumn("fraction", F.col("malignant_tiles") / F.col("total_tiles"))


def tumour_list_from_rows(tiles: DataFrame, malignant: Column) -> DataFrame:
    """The same from a table of tiles that says of each whether it is malignant; clusters without an id aren't counted."""
    return tiles.withColumn("_m", F.coalesce(malignant, F.lit(False))).groupBy("samples", "slides").agg(
        F.count("*").alias("total_tiles"), F.count_if("_m").alias("malignant_tiles"), F.countDistinct(F.when(F.col("_m"), F.col("hpc_id"))).alias("malignant_hpcs")
    )


def purity_thresholds(df: DataFrame, label: str, reduction: float = 2.0) -> DataFrame:
    """Each label's share of all rows in percent, and the purity that a cluster must have of it: p + (100 - p) / reduction."""
    n = counts_by(df, label).crossJoin(df.agg(F.count("*").alias("all")))  # one row
    p = 100.0 * F.col("n") / F.col("all")
    return n.select(label, "n", F.round(p, 6).alias("percent"), F.round(p + (100 - p) / reduction, 6).alias("threshold"))


def fraction_distribution(slides: DataFrame, floors: tuple[float, ...] = (0.0, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.75)) -> DataFrame:
    """What each floor would keep; one pass, the floors exploded by row and combined before the shuffle."""
    cuts = F.explode(F.array(*map(F.lit, floors))).alias("floor")
    kept = F.col("fraction") >= F.col("floor")
    out = slides.select(cuts, "fraction", "malignant_tiles").groupBy("floor").agg(F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"), F.sum(F.when(kept, F.col("malignant_tiles")).otherwise(0)).alias("tiles"))
    return out.withColumn("share", F.round(F.col("kept") / (F.col("kept") + F.col("dropped")), 6))


def cohort_report(slides: DataFrame) -> DataFrame:
    """A9."""
    return slides.agg(F.count("*").alias("n_slides"), F.sum("malignant_tiles").alias("tiles"), F.round(F.median("fraction"), 6).alias("median_fraction"), F.round(F.min("fraction"), 6).alias("least_fraction"), F.count_if(F.col("malignant_tiles") <= 1).alias("slides_of_one_tile"))


def margin_tradeoff(tiles: DataFrame, cuts: tuple[float, ...], bands: tuple[tuple[float, float, float], ...]) -> DataFrame:
    """For each cut the tiles kept and the mean published accuracy of their margin bands."""
    acc = F.lit(None).cast("double")
    for low, high, a in bands:
        acc = F.when((F.col("vote_margin") >= low) & (F.col("vote_margin") < high), a).otherwise(acc)
    rows = tiles.select("vote_margin", acc.alias("accuracy"), F.explode(F.array(*map(F.lit, cuts))).alias("cut"))
    kept = F.col("vote_margin") >= F.col("cut")
    return rows.groupBy("cut").agg(F.count_if(kept).alias("kept"), F.round(F.count_if(kept) / F.count("*"), 6).alias("share"), F.round(F.avg(F.when(kept, F.col("accuracy"))) + 1e-9, 6).alias("accuracy"))


def majority(df: DataFrame, key: str, label: str) -> DataFrame:
    """The most frequent label, ties to the smallest; A21: the share of the votes that agree, to 2 places."""
    n = df.where(F.col(label).isNotNull()).groupBy(key, label).agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("label"), F.round(F.max("n") / F.sum("n"), 2).alias("agreement"))


def purities(df: DataFrame, cluster: str, label: str, threshold: float = 50.0) -> DataFrame:
    """A cluster's dominant class and its percentage; subtype -1 below the threshold."""
    n = counts_by(df, cluster, label)
    out = n.groupBy(cluster).agg(F.sum("n").alias("size"), F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("dominant"), (100.0 * F.max("n") / F.sum("n")).alias("purity"))
    return out.withColumn("subtype", F.when(F.col("purity") >= threshold, F.col("dominant")).otherwise(F.lit("-1"))).withColumn("purity", F.round("purity", 4))


def diversity(df: DataFrame, cluster: str, sample: str, n_samples: int | None = None) -> DataFrame:
    """Mean and most tiles a sample, and the percentage of samples in the cluster."""
    per = counts_by(df, cluster, sample)
    out = per.groupBy(cluster).agg(F.round(F.avg("n"), 6).alias("mean_tiles"), F.max("n").alias("most_tiles"), F.count("*").alias("n_samples"))
    total = df.agg(F.countDistinct(sample).alias("all_samples"))
    return out.crossJoin(total).withColumn("pct_samples", F.round(100.0 * F.col("n_samples") / F.col("all_samples"), 4)).drop("all_samples")  # one row


def presence(df: DataFrame, cluster: str, sample: str, least: float = 0.005) -> DataFrame:
    """Share of samples (patients, sites) of which the cluster holds at least ``least``, and the size-weighted one."""
    per = counts_by(df, sample, cluster).withColumn("of", F.sum("n").over(Window.partitionBy(sample)))
    there = F.col("n") >= least * F.col("of")
    total = per.groupBy(sample).agg(F.max("of").alias("of")).agg(F.count("*").alias("samples_all"), F.sum("of").alias("tiles_all"))
    out = per.groupBy(cluster).agg(F.count_if(there).alias("present"), F.sum(F.when(there, F.col("of")).otherwise(0)).alias("weight"))
    return out.crossJoin(total).select(cluster, F.round(F.col("present") / F.col("samples_all"), 6).alias("presence"), F.round(F.col("weight") / F.col("tiles_all"), 6).alias("weighted_presence"))  # one row


def crosstab(df: DataFrame, row: str, column: str, values: list, share: bool = False) -> DataFrame:
    """Counts by row with a column for each value, which must be named; shares sum to 1 over them."""
    wide = df.groupBy(row).agg(*(F.count_if(F.col(column) == v).alias(f"v_{v}") for v in values))
    if not share:
        return wide
    total = sum((F.col(f"v_{v}") for v in values), F.lit(0))
    return wide.select(row, *(F.round(F.col(f"v_{v}") / F.nullif(total, F.lit(0)), 6).alias(f"v_{v}") for v in values))


def shannon_simpson(df: DataFrame, group: str, label: str) -> DataFrame:
    """Shannon and Simpson diversity and the entropy in bits."""
    p = counts_by(df, group, label).withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy(group)))
    return p.groupBy(group).agg(F.round(-F.sum(F.col("p") * F.log("p")), 6).alias("shannon"), F.round(1 - F.sum(F.col("p") * F.col("p")), 6).alias("simpson"), F.round(-F.sum(F.col("p") * F.log2("p")), 6).alias("bits"))


def divergence(df: DataFrame, group: str, label: str) -> DataFrame:
    """Kullback-Leibler divergence of each group's composition from the whole, in bits."""
    n = counts_by(df, group, label)
    whole = n.groupBy(label).agg(F.sum("n").alias("all"))
    total = whole.agg(F.sum("all").alias("total"))
    q = whole.crossJoin(total).select(label, (F.col("all") / F.col("total")).alias("q"))  # one row
    p = n.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy(group)))
    return p.join(q, label).groupBy(group).agg(F.round(F.sum(F.col("p") * F.log2(F.col("p") / F.col("q"))), 6).alias("kl"))


def risk(prop: DataFrame, survival: DataFrame, most_p: float = 0.05) -> DataFrame:
    """Sum of share times coefficient over significant clusters, and over the largest magnitude of the sample."""
    j = prop.join(survival.where(F.col("p") < most_p), "hpc_id")
    out = j.groupBy("samples", "slides").agg(F.sum(F.col("proportion") * F.col("coef")).alias("risk"))
    top = F.nullif(F.max(F.abs("risk")).over(Window.partitionBy("samples")), F.lit(0.0))
    return out.select("samples", "slides", F.round(F.col("risk") + 1e-9, 6).alias("risk"), F.round(F.col("risk") / top + 1e-9, 6).alias("norm"))


def duplicates(df: DataFrame, *keys: str, value: str) -> DataFrame:
    """Repeated keys with their size and how many values conflict."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.countDistinct(value).alias("n_values")).where("n > 1")


def repeated_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Every row whose key repeats, the first one too."""
    keyed = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return df.join(keyed, list(keys), "left_semi")


def first_of(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key by an order that must settle ties."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")
