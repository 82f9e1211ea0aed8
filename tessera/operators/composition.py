"""Compositional transforms over dense vectors."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dense_counts(df: DataFrame, sample: str, cluster: str, clusters: list[int], min_tiles: int = 0) -> DataFrame:
    """Sample, n and the array of counts over all named clusters, zeros included; samples below min_tiles are left out. One partial aggregate by sample, no pivot job."""
    n = df.groupBy(sample).agg(F.count("*").alias("n"), *(F.count_if(F.col(cluster) == c).alias(f"_{c}") for c in clusters))
    return n.where(F.col("n") >= min_tiles).select(sample, "n", F.array(*(F.col(f"_{c}").cast("double") for c in clusters)).alias("counts"))


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def closure(x: Column) -> Column:
    s = total(x)
    return F.transform(x, lambda v: v / F.nullif(s, F.lit(0.0)))


def replace_zeros(p: Column, size: int) -> Column:
    """M2: multiplicative replacement with delta 1 / D**2."""
    delta = 1.0 / size**2
    zeros = F.size(F.filter(p, lambda v: v == 0))
    return F.transform(p, lambda v: F.when(v == 0, delta).otherwise(v * (1 - zeros * delta)))


def clr(p: Column, size: int) -> Column:
    """M2, M3."""
    mean = total(F.transform(p, lambda v: F.log(v))) / size
    return F.transform(p, lambda v: F.log(v) - mean)


def alr(p: Column, size: int) -> Column:
    """M2, M3: against the last part."""
    last = F.element_at(p, -1)
    return F.transform(F.slice(p, 1, size - 1), lambda v: F.log(v / last))


def ilr(p: Column, size: int) -> Column:
    """M2: the orthonormal basis of sequential balances; the i-th part against the geometric mean of those before it."""
    logs = F.transform(p, lambda v: F.log(v))
    return F.transform(F.sequence(F.lit(1), F.lit(size - 1)), lambda i: F.sqrt(i / (i + 1.0)) * (total(F.slice(logs, F.lit(1), i)) / i - F.element_at(logs, i + 1)))


def log_ratios(p: Column, size: int) -> Column:
    """M4: logs of the ratios of all pairs of parts, i < j."""
    return F.array(*(F.log(F.get(p, F.lit(i)) / F.get(p, F.lit(j))) for i in range(size) for j in range(i + 1, size)))


def variance_selection(df: DataFrame, vec: str, percentile: float) -> DataFrame:
    """Places of a vector whose variance is above the percentile of all; fit it on train rows and reuse it."""
    var = df.select(F.posexplode(vec).alias("pos", "v")).groupBy("pos").agg(F.var_pop("v").alias("var"))
    cut = var.agg(F.percentile("var", percentile).alias("cut"))
    return var.crossJoin(cut).where("var > cut").select("pos", "var")  # one row
