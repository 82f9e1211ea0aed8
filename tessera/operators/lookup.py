"""Lookups by exact, then partial name."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_match(asked: DataFrame, names: DataFrame, name: str, q: str = "q") -> DataFrame:
    """The name equal to what is asked, else the first that holds it, else null, a row for each distinct question. Names
    meet the questions where they lie and only hits go on, so the list of names is neither broadcast nor made distinct."""
    own = asked.select(F.col(q).alias("_q")).distinct()
    n = F.lower("_name")
    hits = names.select(F.col(name).alias("_name")).join(own, F.contains(n, F.lower("_q")))
    rank = F.struct(F.when(n == F.lower("_q"), 0).otherwise(1), F.col("_name"))
    best = hits.groupBy(F.col("_q").alias("_hit")).agg(F.min_by("_name", rank).alias("found"))
    return own.join(best, F.col("_q") == F.col("_hit"), "left").select(F.col("_q").alias(q), "found")
