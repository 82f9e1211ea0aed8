"""Ordered work over whole tables without a task that sees all rows: ranges of a numeric key, running totals, ranks and exact order statistics."""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Of a range's bounds, how far a sketch may be off: one in so many rows.
ACCURACY = 10_000


def bounds(df: DataFrame, key: str, ranges: int | None = None) -> list[float]:
    """Values that cut a numeric column into about even ranges, from a sketch; zero for one without values. At most ``ranges`` of them reach the driver."""
    n = ranges or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = df.agg(F.percentile_approx(F.col(key).cast("double"), [i / n for i in range(1, n)], ACCURACY)).first()[0]
    return sorted({c for c in cuts or [] if c == c and abs(c) != float("inf")}) or [0.0]


def with_range(df: DataFrame, key: str, cuts: list[float], out: str = "_range") -> DataFrame:
    """The number of the range of each row, by a binary search in the JVM; equal values share one. A null or NaN key goes to the last of all."""
    splits = [float("-inf"), *cuts, float("inf")]
    number = Bucketizer(splits=splits, inputCol="_x", outputCol="_b", handleInvalid="keep")
    return number.transform(df.withColumn("_x", F.col(key).cast("double"))).withColumn(out, F.coalesce(F.col("_b").cast("int"), F.lit(len(cuts) + 1))).drop("_x", "_b")


def running(df: DataFrame, key: str, sums: dict[str, Column], then: tuple[str | Column, ...] = (), descending: bool = False, ranges: int | None = None, combine=F.sum) -> DataFrame:
    """``df`` with running totals in the order of a numeric key (nulls last; ``then`` breaks ties), each row included.

    Ranges of the key are summed first, their totals are added up in order, and rows add what precedes them in their own
    range, so a task sorts one range only. Values that repeat very often share a range: count equal ones beforehand.
    combine: F.sum, F.min or F.max.
    """
    add = {F.sum: lambda x, y: x + y, F.min: min, F.max: max}[combine]
    joined = {F.sum: lambda x, y: x + y, F.min: F.least, F.max: F.greatest}[combine]
    cuts = bounds(df, key, ranges)
    first = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_last()
    src = with_range(df, key, cuts).withColumns({f"_v_{c}": v for c, v in sums.items()})
    # the last number is that of keys that aren't there, whatever the direction
    place = F.when((F.col("_range") <= len(cuts)) & F.lit(descending), F.lit(len(cuts)) - F.col("_range")).otherwise(F.col("_range"))
    src = src.withColumn("_range", place)
    totals = src.groupBy("_range").agg(*(combine(f"_v_{c}").alias(c) for c in sums)).collect()  # one row a range
    before, left = [], {c: None for c in sums}
    for r in sorted(totals, key=lambda r: r["_range"]):
        before.append((r["_range"], *left.values()))
        left = {c: r[c] if v is None else v if r[c] is None else add(v, r[c]) for c, v in left.items()}
    kinds = ", ".join(f"`_t_{c}` {src.select(combine(f'_v_{c}')).dtypes[0][1]}" for c in sums)
    start = df.sparkSession.createDataFrame(before, f"_range int, {kinds}")
    w = Window.partitionBy("_range").orderBy(first, *then).rowsBetween(Window.unboundedPreceding, 0)
    own = src.withColumns({f"_s_{c}": combine(f"_v_{c}").over(w) for c in sums}).join(F.broadcast(start), "_range")
    whole = {c: F.when(F.col(f"_s_{c}").isNotNull() & F.col(f"_t_{c}").isNotNull(), joined(F.col(f"_s_{c}"), F.col(f"_t_{c}"))).otherwise(F.coalesce(f"_s_{c}", f"_t_{c}")) for c in sums}
    return own.select(*df.columns, *(v.alias(c) for c, v in whole.items()))


def ranked(df: DataFrame, key: str, then: tuple[str | Column, ...] = (), descending: bool = False, out: str = "rank") -> DataFrame:
    """``df`` with the place of each row, from 1, in the order of a numeric key."""
    return running(df, key, {out: F.lit(1).cast("long")}, then, descending)


#: Values of a bracket that may come to the driver, once counted.
FEW = 10_000


def order_statistics(df: DataFrame, value: str, ranks: list[int], ranges: int | None = None) -> list[float]:
    """The values at the given places (from 0) among the rows of a numeric column that aren't null or NaN, exactly.

    A sketch cuts the values into brackets, one aggregation counts each, and only the brackets that hold a wanted rank
    are cut again, until they hold one value or few enough to look at. So no task holds the values of the column, and
    one that is repeated ever so often is a bracket by itself. Ranks beyond the rows are refused.
    """
    src = df.select(F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    found: dict[int, float] = {}
    # brackets that are still open: least and largest value, rows before them, ranks wanted of them
    todo: list[tuple[float | None, float | None, int, list[int]]] = [(None, None, 0, sorted(set(ranks)))]
    while todo:
        held = src if todo[0][0] is None else src.where(_within(todo))
        cuts = sorted({c for lo, hi, *_ in todo for c in _cuts(src, lo, hi, ranges)} | {lo for lo, *_ in todo if lo is not None})
        counts = sorted(with_range(held, "v", cuts).groupBy("_range").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect(), key=lambda r: r["_range"])
        open_, few = [], []
        for lo, hi, before, wanted in todo:
            at = before
            for r in (r for r in counts if lo is None or lo <= r.lo <= hi):
                mine = [k for k in wanted if at <= k < at + r.n]
                if mine and r.lo == r.hi:
                    found |= dict.fromkeys(mine, r.lo)
                elif mine:
                    (few if r.n <= FEW else open_).append((r.lo, r.hi, at, mine))
                at += r.n
            if lo is None and wanted and (wanted[0] < 0 or wanted[-1] >= at):
                raise ValueError(f"ranks beyond {at} rows")
        if few:
            values = sorted((r.v, r.n) for r in src.where(_within(few)).groupBy("v").agg(F.count("*").alias("n")).collect())
            for lo, hi, at, mine in few:
                for v, n in values:
                    if lo <= v <= hi:
                        found |= {k: v for k in mine if at <= k < at + n}
                        at += n
        todo = open_
    return [found[k] for k in ranks]


def _within(brackets: list[tuple]) -> Column:
    out = F.lit(False)
    for lo, hi, *_ in brackets:
        out = out | F.col("v").between(lo, hi)
    return out


def _cuts(src: DataFrame, lo: float | None, hi: float | None, ranges: int | None) -> list[float]:
    """Cuts of a bracket; where the sketch sees nothing between its ends, the value after the least, so that it gets smaller all the same."""
    own = src if lo is None else src.where(F.col("v").between(lo, hi))
    cuts = bounds(own, "v", ranges or 64)
    if lo is not None and not any(lo < c <= hi for c in cuts):
        cuts = [own.where(F.col("v") > lo).agg(F.min("v")).first()[0]]
    return cuts


def quantiles(df: DataFrame, value: str, qs: tuple[float, ...] | list[float]) -> list[float | None]:
    """Exact quantiles with linear interpolation, as percentile() gives them, without a task that holds all values. Of no rows all are null."""
    n = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).count()
    if not n:
        return [None] * len(qs)
    at = [q * (n - 1) for q in qs]
    low, high = [int(a) for a in at], [min(int(a) + 1, n - 1) for a in at]
    values = dict(zip(low + high, order_statistics(df, value, low + high), strict=True))
    return [values[i] if a == i or values[i] == values[j] else (j - a) * values[i] + (a - i) * values[j] for a, i, j in zip(at, low, high, strict=True)]
