"""A cohort against the distribution of its reference (V24, T6): profiles of quantiles, interpolated percentiles, spread over slides."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.guards import Refused
from tessera.operators.scan import quantiles

#: Stored levels, the one whose quantile is the envelope, and the verdict's limits. Fixed values.
LEVELS = (0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99, 0.999)
ENVELOPE = 0.99
NOTICE_RATIO, NOTICE_PERCENTILE, ALARM_PERCENTILE, CONCENTRATION = 2.0, 65.0, 85.0, 0.10
DISTANCE, MARGIN = "neighbor_distance", "vote_margin"


@dataclass
class Profile:
    """What is kept of a reference: the vote that it was made by and quantiles at LEVELS, ten numbers a column."""

    vote: str
    n: int
    distance: list[float]
    margin: list[float]
    low_margin: tuple[float, float]

    def to_frame(self, spark) -> DataFrame:
        """One row a level."""
        rows = [(self.vote, self.n, level, d, m) for level, d, m in zip(LEVELS, self.distance, self.margin, strict=True)]
        return spark.createDataFrame(rows, "vote string, n long, level double, distance double, margin double")


def finite(c: str) -> Column:
    x = F.col(c).cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def build_profile(df: DataFrame, vote: str) -> Profile:
    """Exact quantiles of finite distances and of margins, and the shares of margins below 0.10 and 0.25. Without a finite distance it refuses."""
    known = df.where(finite(DISTANCE))
    distance = quantiles(known, DISTANCE, LEVELS)
    if distance[0] is None:
        raise Refused("no finite distance to make a profile of")
    low = df.agg(*(F.avg((F.col(MARGIN) < m).cast("int")) for m in (0.10, 0.25)), F.count("*")).first()
    return Profile(vote, low[2], distance, quantiles(df, MARGIN, LEVELS), (low[0], low[1]))


def interpolated(value: Column, xs: list[float], ys: list[float]) -> Column:
    """The line through the points at ``value``, held at both ends; where xs repeat, the last of them counts. Null and NaN stay null."""
    out = F.when(value < xs[0], F.lit(float(ys[0])))
    for a, b, ya, yb in zip(xs, xs[1:], ys, ys[1:], strict=False):
        if b > a:
            out = out.when(value < b, F.lit(float(ya)) + (value - F.lit(float(a))) * F.lit((yb - ya) / (b - a)))
    return F.when(value.isNotNull() & ~F.isnan(value), out.otherwise(F.lit(float(ys[-1]))))


def per_slide(df: DataFrame, profile: Profile, slide: str = "slides") -> DataFrame:
    """For each slide its tiles with a finite distance, the share of them beyond the envelope, their median distance and the share of low margins."""
    envelope = profile.distance[LEVELS.index(ENVELOPE)]
    d, m = F.col(DISTANCE).cast("double"), F.col(MARGIN)
    known = df.where(finite(DISTANCE))
    share = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("int"))
    return known.groupBy(slide).agg(F.count("*").alias("n"), share(d > envelope).alias("beyond"), F.percentile(d, 0.5).alias("median_distance"), share(m < 0.10).alias("low_margin"))


def compare(df: DataFrame, profile: Profile, vote: str, slide: str = "slides") -> DataFrame:
    """One row: n, n_finite, envelope, beyond, novelty_ratio, median_percentile, spread over slides, and a verdict.

    median_percentile is where the cohort's median lies in the reference, by linear interpolation between the profile's
    quantiles, and at most the last level. spread is the largest less the smallest share beyond by slide, null with
    fewer than two slides. alarm: the median is at the 85th percentile or above; notice: twice as many tiles beyond as
    expected, or the median at the 65th; concentrated: the spread is above 0.10, so it is some slides. A profile of
    another vote refuses, as distances of other settings tell nothing.
    """
    if vote != profile.vote:
        raise Refused(f"the profile was made by {profile.vote}, not by {vote}")
    spark = df.sparkSession
    median = quantiles(df.where(finite(DISTANCE)), DISTANCE, (0.5,))[0]
    sides = per_slide(df, profile, slide)
    spread = F.when(F.count(slide) >= 2, F.max("beyond") - F.min("beyond"))
    whole = sides.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_finite"), (F.sum(F.col("beyond") * F.col("n")) / F.sum("n")).alias("beyond"), spread.alias("spread"))
    facts = spark.createDataFrame([(profile.distance[LEVELS.index(ENVELOPE)], median)], "envelope double, median double")
    percent = interpolated(F.col("median"), profile.distance, list(LEVELS)) * 100
    ratio = F.coalesce("beyond", F.lit(0.0)) / F.lit(1.0 - ENVELOPE)
    row = whole.crossJoin(facts).crossJoin(df.agg(F.count("*").alias("n")))  # one row each
    row = row.select("n", "n_finite", "envelope", F.coalesce("beyond", F.lit(0.0)).alias("beyond"), ratio.alias("novelty_ratio"), percent.alias("median_percentile"), "spread")
    level = F.when(F.col("median_percentile").isNull(), "consistent").when(F.col("median_percentile") >= ALARM_PERCENTILE, "alarm")
    level = level.when((F.col("novelty_ratio") >= NOTICE_RATIO) | (F.col("median_percentile") >= NOTICE_PERCENTILE), "notice").otherwise("consistent")
    return row.withColumn("concentrated", F.coalesce(F.col("spread") > CONCENTRATION, F.lit(False))).withColumn("verdict", level)
