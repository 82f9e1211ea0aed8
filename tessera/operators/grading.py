"""Growth-pattern grading by pooled pixels."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.keys import HIGH_GRADE, PATTERNS, grade_of


def _by_pattern(of) -> Column:
    return F.array(*(F.struct(of(p).alias("v"), F.lit(-i).alias("o"), F.lit(p).alias("p")) for i, p in enumerate(PATTERNS)))


def slide_proportions(slides: DataFrame) -> DataFrame:
    """Each pattern's share of the pattern pixels, null where there are none; G17: whether the pixels add up."""
    total = sum((F.col(f"{p}_px") for p in PATTERNS), F.lit(0))
    return slides.select("slide_id", "sample", *(F.round(F.col(f"{p}_px") / F.nullif(total, F.lit(0)), 6).alias(p) for p in PATTERNS), (total == F.col("pattern_pixels")).alias("adds_up"))


def tumour_grade(slides: DataFrame) -> DataFrame:
    """Pixels pooled by sample (not shares averaged over slides), the predominant pattern by fixed order, ties by name, the high-grade share and the grade."""
    px = slides.groupBy("sample").agg(*(F.sum(f"{p}_px").alias(p) for p in PATTERNS), F.count("*").alias("n_slides"))
    total = sum((F.col(p) for p in PATTERNS), F.lit(0))
    top = F.array_max(_by_pattern(F.col))
    ties = F.array_join(F.transform(F.filter(_by_pattern(F.col), lambda s: s.v == top.v), lambda s: s.p), ",")
    high = sum((F.col(p) for p in HIGH_GRADE), F.lit(0)) / F.nullif(total, F.lit(0))
    out = px.select("sample", "n_slides", F.when(total > 0, top.p).alias("predominant"), F.when(total > 0, ties).alias("ties"), F.round(high, 6).alias("high_share"), high.alias("_high"))
    return out.select("sample", "n_slides", "predominant", "ties", "high_share", F.when(F.col("predominant").isNotNull(), grade_of(F.col("predominant"), F.col("_high"))).alias("grade"))
