"""States of runs."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coarse_state(state: str = "state") -> Column:
    """Running beats pending, pending failed, failed complete."""
    any_of = lambda s: F.bool_or(F.col(state) == s)
    return F.when(any_of("running"), "running").when(any_of("pending"), "pending").when(any_of("failed"), "failed").otherwise("complete")


def datasets(runs: DataFrame) -> DataFrame:
    """By dataset its runs, state, newest run and newest complete artefact, and what to do next."""
    done = F.col("state") == "complete"
    newest = F.struct("submitted_at", "submission_id")
    out = runs.groupBy("dataset").agg(
        F.count("*").alias("n_runs"),
        coarse_state().alias("state"),
        F.max_by("submission_id", newest).alias("latest_run"),
        F.max_by(F.when(done, F.col("submission_id")), F.when(done, newest)).alias("latest_artefact"),
        F.round(F.max(F.when(done, F.col("size"))), 2).alias("largest"),
    )
    action = F.when(F.col("state").isin("running", "pending"), "wait").when(F.col("latest_artefact").isNull(), "rerun").otherwise("load")
    return out.withColumn("next_action", action)


def newest(runs: DataFrame, skip: str) -> DataFrame:
    """The newest run of each dataset that isn't in a state to skip."""
    order = F.struct("submitted_at", "submission_id")
    return runs.where(F.col("state") != skip).groupBy("dataset").agg(F.max_by("submission_id", order).alias("submission_id"), F.max_by("state", order).alias("state"))


def missing(manifest: DataFrame, counted: DataFrame, key: str, n: str) -> DataFrame:
    """Never (no row), corrupt (null count), zero, complete."""
    there = counted.select(key, F.col(n).alias("_n"), F.lit(True).alias("_there"))
    state = F.when(F.col("_there").isNull(), "never").when(F.col("_n").isNull(), "corrupt").when(F.col("_n") == 0, "zero").otherwise("complete")
    return manifest.join(there, key, "left").select(key, state.alias("state"))


def shard_breaks(shards: DataFrame) -> DataFrame:
    """Shards that don't start where the one before ends, with the kind of break. One row a shard goes through the window."""
    before = F.lag("hi").over(Window.partitionBy("dataset").orderBy("lo", "hi"))
    s = shards.withColumn("before", F.coalesce(before, F.lit(0)))
    return s.where("lo <> before").withColumn("kind", F.when(F.col("lo") > F.col("before"), "gap").otherwise("overlap"))


def shard_plan(n: int, size: int) -> list[tuple[int, int]]:
    """Ranges [lo, hi) that tile n rows."""
    return [(lo, min(n, lo + size)) for lo in range(0, n, size)]
