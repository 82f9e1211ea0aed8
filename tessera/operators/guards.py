"""Guards: each yields a frame of violations; require_empty() refuses (G rows)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Refused(ValueError):
    """Data that must not be loaded."""


def require_empty(violations: DataFrame, message: str, examples: int = 5) -> None:
    """Raises with the count and a few examples; only these reach the driver."""
    few = violations.limit(examples).collect()
    if few:
        raise Refused(f"{message}: {violations.count()} rows, such as {[tuple(r) for r in few]}")


def blank_keys(df: DataFrame, *keys: str) -> DataFrame:
    """G1, G7, R35."""
    blank: Column = F.lit(False)
    for k in keys:
        blank = blank | F.col(k).isNull() | (F.trim(F.col(k).cast("string")) == "")
    return df.where(blank)


#: What a slide list may say for true, in lower case.
TRUE = ("true", "1", "yes", "y", "t")


def slide_list_problems(slides: DataFrame, slide: str = "slide_id", sample: str = "samples", tumour: str = "is_tumour", verified: bool = True) -> DataFrame:
    """Rows of a slide list that must not be graded, with the first rule they break; a null counts as blank and as not true.

    A list that isn't verified may say 'unverified' of a slide, but still not that it is no tumour.
    """
    bare = lambda c: F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"^\s+|\s+$", ""), F.lit(""))
    known = F.lower(bare(tumour)).isin(*TRUE, *([] if verified else ["unverified"]))
    problem = F.when(bare(slide) == "", "blank slide").when(~known, "not tumour").when(bare(sample) == "", "blank sample")
    return slides.withColumn("problem", problem).where("problem is not null")


def not_numeric(df: DataFrame, *cols: str) -> DataFrame:
    """G1: text that is there but isn't a number."""
    bad: Column = F.lit(False)
    for c in cols:
        bad = bad | (F.trim(F.col(c)) != "") & F.col(c).try_cast("double").isNull()
    return df.where(bad)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """G2, G14."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def disagreeing(df: DataFrame, a: str, b: str) -> DataFrame:
    """G3."""
    return df.where(~F.col(a).eqNullSafe(F.col(b)))


def not_summing_to_one(prop: DataFrame, *group: str, tolerance: float = 0.01) -> DataFrame:
    """G6. A sum that is off by the tolerance itself passes, in whatever order it was added up: what is beyond the twelfth
    digit is rounding."""
    return prop.groupBy(*group).agg(F.sum("proportion").alias("total")).where(F.round(F.abs(F.col("total") - 1), 12) > tolerance)


def conflicting(df: DataFrame, key: str, value: str) -> DataFrame:
    """G16."""
    return df.groupBy(key).agg(F.countDistinct(value).alias("n")).where("n > 1")


def orphans(df: DataFrame, parent: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key the parent lacks."""
    return df.join(parent.select(*keys).distinct(), list(keys), "left_anti")


def one_to_one(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """A join that refuses repeated keys on either side."""
    for side, df in (("left", left), ("right", right)):
        require_empty(duplicate_keys(df, *keys), f"keys repeat on the {side}")
    return left.join(right, keys, how)


def not_integral(df: DataFrame, col: str) -> DataFrame:
    """Cluster ids that no integer column can hold."""
    value = F.col(col).try_cast("double")
    return df.where(value.isNull() | (value != F.round(value)))


def inspect(stage: DataFrame, registry: DataFrame, dictionary: DataFrame, low: float = 0.1) -> DataFrame:
    """What a load would do; one left join each, and nothing is written."""
    known = registry.select("slide_tile", F.col("hpc_id").alias("_old"), F.lit(True).alias("_there"))
    named = dictionary.select("hpc_id", F.lit(True).alias("_named"))
    j = stage.join(known, "slide_tile", "left").join(named, "hpc_id", "left")
    return j.agg(
        F.count("*").alias("n_rows"),
        F.count("_there").alias("matched"),
        F.count_if(F.col("_old") != F.col("hpc_id")).alias("overwriting"),
        F.countDistinct(F.when(F.col("_named").isNull(), F.col("hpc_id"))).alias("unknown_clusters"),
        F.count_if(F.col("vote_margin") < low).alias("low_margin"),
    )


def require_match(report: DataFrame, least: float = 0.95) -> None:
    """Refuses a load of which too little matches, or with unknown clusters."""
    r = match_verdict(report, least).first()
    if r.verdict != "ok":
        raise Refused(f"{r.verdict}: {r.matched} of {r.n_rows} rows match (at least {least:.0%} must), {r.unknown_clusters} unknown clusters")


def row_counts(source: DataFrame, output: DataFrame, *group: str) -> DataFrame:
    """Groups whose numbers of rows differ between a source and what was written of it."""
    n = lambda df, name: df.groupBy(*group).agg(F.count("*").alias(name))
    j = n(source, "n_source").join(n(output, "n_output"), list(group), "full_outer").na.fill(0, ["n_source", "n_output"])
    return j.where("n_source <> n_output")


def incomplete(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns of a packaged table that are missing or of another type; from the schema, no job."""
    types = dict(df.dtypes)
    wrong = [(c, t, types.get(c)) for c, t in columns.items() if types.get(c) != t]
    return df.sparkSession.createDataFrame(wrong, "name string, expected string, found string")


def match_verdict(report: DataFrame, least: float = 0.95) -> DataFrame:
    """What a load's report comes to."""
    few = (F.col("n_rows") == 0) | (F.col("matched") < least * F.col("n_rows"))
    return report.withColumn("verdict", F.when(few, "too few rows match").when(F.col("unknown_clusters") > 0, "unknown clusters").otherwise("ok"))


def whole_pixels(df: DataFrame, *cols: str) -> DataFrame:
    """Rows whose pixel counts, read as text, are no whole numbers."""
    bad: Column = F.lit(False)
    for c in cols:
        v = F.col(c).try_cast("double")
        bad = bad | v.isNull() | (v != F.floor(v)) | (v < 0)
    return df.where(bad)


def reconcile(expected: DataFrame, counted: DataFrame, key: str, label: str) -> DataFrame:
    """Key and state (ok, missing, unexpected, relabelled)."""
    e = expected.select(F.col(key).alias("k"), F.col(label).alias("e"), F.lit(True).alias("in_e"))
    c = counted.select(F.col(key).alias("k"), F.col(label).alias("c"), F.lit(True).alias("in_c"))
    state = F.when(F.col("in_e").isNull(), "unexpected").when(F.col("in_c").isNull(), "missing").when(F.col("e") != F.col("c"), "relabelled").otherwise("ok")
    return e.join(c, "k", "full_outer").select(F.col("k").alias(key), state.alias("state"))
