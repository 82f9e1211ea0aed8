"""Ridge Cox regression over whole tables (M18, R10): Newton steps on sums over risk sets, which ranges of time add up.

All fits of a call (folds left out, penalties, subsets of features) take their steps together. A step sums e, e x and
e x x by fit, range of time and time; running sums within a range and the totals of later ranges give the sums over the
risk set of each time; gradient and Hessian are one aggregation of these. What comes to the driver is a row a fit.
"""

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.guards import Refused
from tessera.operators.scan import bounds, with_range
from tessera.sources.scratch import written

STEPS, ENOUGH = 50, 1e-10
#: Fits of a call: their coefficients go to every task.
MOST_FITS = 10_000


@dataclass(frozen=True)
class Fit:
    """A regression on the rows of all folds but one (None: of all), over some of the features."""

    left_out: int | None
    ridge: float
    features: tuple[str, ...]


def _prepared(df: DataFrame, time: str, event: str, cols: Sequence[str], fold: Column | None) -> tuple[DataFrame, int]:
    """Rows with a time and all features, written once with the range of their time; a later range is of later times."""
    x = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]
    f = F.lit(None).cast("int") if fold is None else fold.cast("int")
    src = df.select(f.alias("fold"), F.col(time).cast("double").alias("time"), F.coalesce(F.col(event).cast("boolean"), F.lit(False)).alias("event"), *x).na.drop(subset=["time", *(f"x{i}" for i in range(len(cols)))])
    cuts = bounds(src, "time")
    return written(with_range(src, "time", cuts), "cox-rows")[0], len(cols)


def _members(fits: Sequence[Fit], inside: bool) -> Column:
    """The numbers of the fits that a row takes part in."""
    own = lambda f: F.col("fold").eqNullSafe(F.lit(f.left_out))
    out = [F.when(F.lit(f.left_out is None) | (own(f) if inside else ~own(f)), F.lit(i)) for i, f in enumerate(fits)]
    return F.filter(F.array(*out), lambda i: i.isNotNull())


def _terms(rows: DataFrame, b: DataFrame, p: int) -> DataFrame:
    """For each fit d, g (gradient without penalty) and h (upper triangle of the Hessian without penalty) at coefficients b."""
    risk = F.exp(sum((F.col(f"x{i}") * F.col(f"b{i}") for i in range(p)), F.lit(0.0)))
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    e = rows.join(F.broadcast(b), "fit").withColumn("e", risk)
    d = F.col("event")
    sums = {"s": F.sum("e"), "d": F.count_if(d)}
    sums |= {f"s{i}": F.sum(F.col("e") * F.col(f"x{i}")) for i in range(p)} | {f"d{i}": F.sum(F.when(d, F.col(f"x{i}")).otherwise(0.0)) for i in range(p)}
    sums |= {f"s{i}_{j}": F.sum(F.col("e") * F.col(f"x{i}") * F.col(f"x{j}")) for i, j in pairs}
    at = e.groupBy("fit", "_range", "time").agg(*(v.alias(c) for c, v in sums.items()))
    carried = ["s", *(f"s{i}" for i in range(p)), *(f"s{i}_{j}" for i, j in pairs)]
    later = Window.partitionBy("fit").orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    totals = at.groupBy("fit", "_range").agg(*(F.sum(c).alias(c) for c in carried))
    after = totals.select("fit", "_range", *(F.coalesce(F.sum(c).over(later), F.lit(0.0)).alias(f"_a_{c}") for c in carried))  # one row a fit and range
    within = Window.partitionBy("fit", "_range").orderBy(F.desc("time")).rowsBetween(Window.unboundedPreceding, 0)
    own = at.select("fit", "_range", "d", *(f"d{i}" for i in range(p)), *(F.sum(c).over(within).alias(c) for c in carried))
    r = own.join(after, ["fit", "_range"]).where("d > 0")
    s = {c: F.col(c) + F.col(f"_a_{c}") for c in carried}
    g = [F.sum(F.col(f"d{i}") - F.col("d") * s[f"s{i}"] / s["s"]).alias(f"g{i}") for i in range(p)]
    h = [F.sum(F.col("d") * (s[f"s{i}_{j}"] / s["s"] - s[f"s{i}"] * s[f"s{j}"] / (s["s"] * s["s"]))).alias(f"h{i}_{j}") for i, j in pairs]
    return r.groupBy("fit").agg(F.sum("d").alias("d"), *g, *h)


def _solved(row, fit: Fit, cols: Sequence[str], b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The Newton step of one fit and its standard errors, over the features that it has; p x p numbers."""
    mine = [i for i, c in enumerate(cols) if c in fit.features]
    g = np.array([row[f"g{i}"] for i in mine]) - fit.ridge * b[mine]
    h = np.array([[row[f"h{min(i, j)}_{max(i, j)}"] for j in mine] for i in mine]) + fit.ridge * np.eye(len(mine))
    step, se = np.zeros(len(cols)), np.zeros(len(cols))
    step[mine] = np.linalg.solve(h, g)
    se[mine] = np.sqrt(np.diag(np.linalg.inv(h)))
    return step, se


def regressions(df: DataFrame, time: str, event: str, cols: Sequence[str], fits: Sequence[Fit], fold: Column | None = None, inside: bool = False) -> list[tuple[np.ndarray, np.ndarray]]:
    """Coefficients and standard errors by feature for each fit (Breslow ties, no intercept); features that a fit lacks have 0.

    Rows without a time or a feature take no part, a null event is none. A fit without an event has coefficients of 0
    and errors by its penalty. More than MOST_FITS fits, or a singular Hessian, are refused.
    inside: fits are on the rows of their fold instead of on all others.
    """
    if len(fits) > MOST_FITS:
        raise Refused(f"more than {MOST_FITS} fits in one call")
    src, p = _prepared(df, time, event, cols, fold)
    rows = src.withColumn("fit", F.explode(_members(fits, inside)))
    b = np.zeros((len(fits), p))
    out = [(np.zeros(p), np.array([1 / math.sqrt(f.ridge) if c in f.features and f.ridge else 0.0 for c in cols])) for f in fits]
    active = set(range(len(fits)))
    names = ", ".join(f"b{i} double" for i in range(p))
    for _ in range(STEPS):
        at = df.sparkSession.createDataFrame([(i, *b[i].tolist()) for i in sorted(active)], f"fit int, {names}")
        found = {r.fit: r for r in _terms(rows, at, p).collect()}
        for i in sorted(active):
            if i not in found:
                active.discard(i)
                continue
            try:
                step, se = _solved(found[i], fits[i], cols, b[i])
            except np.linalg.LinAlgError as e:
                raise Refused("features determine each other: give a penalty") from e
            b[i] += step
            out[i] = (b[i].copy(), se)
            if np.abs(step).max(initial=0.0) < ENOUGH:
                active.discard(i)
        if not active:
            break
    return out


def folds_of(df: DataFrame, fold: Column) -> list[int]:
    return sorted(r[0] for r in df.select(fold.cast("int")).distinct().collect() if r[0] is not None)


def with_risk(df: DataFrame, cols: Sequence[str], fits: Sequence[Fit], found: list[tuple[np.ndarray, np.ndarray]], fold: Column) -> DataFrame:
    """Rows once for each fit that left them out, with its number and their risk by its coefficients."""
    b = df.sparkSession.createDataFrame([(i, f.left_out, c.tolist()) for i, (f, (c, _)) in enumerate(zip(fits, found, strict=True))], "fit int, _fold int, _b array<double>")
    x = F.array(*(F.col(c).cast("double") for c in cols))
    risk = F.aggregate(F.zip_with(x, F.col("_b"), lambda u, v: u * v), F.lit(0.0), lambda a, v: a + v)
    return df.withColumn("_fold", fold.cast("int")).join(F.broadcast(b), "_fold").withColumn("risk", risk).drop("_b", "_fold")


def feature_table(df: DataFrame, time: str, event: str, cols: Sequence[str], ridge: float = 0.0) -> DataFrame:
    """Each feature alone on all rows: coef, se, z, hazard_ratio, and the ends of its 95 % interval."""
    fits = [Fit(None, ridge, (c,)) for c in cols]
    found = regressions(df, time, event, cols, fits)
    rows = [(c, float(b[i]), float(se[i])) for i, (c, (b, se)) in enumerate(zip(cols, found, strict=True))]
    out = df.sparkSession.createDataFrame(rows, "feature string, coef double, se double")
    end = lambda sign: F.exp(F.col("coef") + F.lit(sign * 1.959964) * F.col("se"))
    return out.select("feature", "coef", "se", (F.col("coef") / F.nullif("se", F.lit(0.0))).alias("z"), F.exp("coef").alias("hazard_ratio"), end(-1).alias("low"), end(1).alias("high"))


def validated(df: DataFrame, time: str, event: str, key: str, cols: Sequence[str], fold: Column, fits: Sequence[Fit]) -> DataFrame:
    """Fit, c_index, pairs: the C-index of each fit on the fold that it left out."""
    from tessera.operators.stats import c_index

    found = regressions(df, time, event, cols, fits, fold)
    return c_index(with_risk(df, cols, fits, found, fold), time, event, "risk", key, "fit")


def all_subsets(cols: Sequence[str], most: int | None = None) -> list[tuple[str, ...]]:
    return [s for n in range(1, (most or len(cols)) + 1) for s in combinations(cols, n)]


def best_subset(df: DataFrame, time: str, event: str, key: str, cols: Sequence[str], fold: Column, ridge: float = 0.1, most: int | None = None) -> DataFrame:
    """Every subset of the features (up to ``most`` of them) with its mean C-index over the folds left out, best first;
    of equal ones the smaller, then the first by the order of ``cols``. Every subset and fold is a fit of one call."""
    subsets, ks = all_subsets(cols, most), folds_of(df, fold)
    fits = [Fit(k, ridge, s) for s in subsets for k in ks]
    scores = validated(df, time, event, key, cols, fold, fits)
    spark = df.sparkSession
    of = spark.createDataFrame([(i, i // len(ks), list(f.features)) for i, f in enumerate(fits)], "fit int, subset int, features array<string>")
    mean = of.join(scores, "fit", "left").groupBy("subset", "features").agg(F.round(F.avg("c_index"), 6).alias("c_index"), F.count("c_index").alias("folds"))
    return mean.orderBy(F.desc_nulls_last("c_index"), F.size("features"), "subset").select("features", "c_index", "folds")


def refit(df: DataFrame, time: str, event: str, key: str, cols: Sequence[str], fold: Column, ridges: Sequence[float]) -> DataFrame:
    """The penalty with the best mean C-index over the folds left out (the larger, if equal), and coefficients with it on all rows."""
    ks = folds_of(df, fold)
    fits = [Fit(k, r, tuple(cols)) for r in ridges for k in ks]
    scores = {r.fit: r.c_index for r in validated(df, time, event, key, cols, fold, fits).collect()}
    mean = {}
    for n, r in enumerate(ridges):
        own = [scores[i] for i in range(n * len(ks), (n + 1) * len(ks)) if scores.get(i) is not None]
        mean[r] = round(sum(own) / len(own), 6) if own else -1.0
    best = max(ridges, key=lambda r: (mean[r], r))
    b, se = regressions(df, time, event, cols, [Fit(None, best, tuple(cols))])[0]
    rows = [(float(best), mean[best] if mean[best] >= 0 else None, c, float(x), float(s)) for c, x, s in zip(cols, b, se, strict=True)]
    return df.sparkSession.createDataFrame(rows, "ridge double, c_index double, feature string, coef double, se double")
