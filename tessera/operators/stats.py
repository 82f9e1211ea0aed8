"""Statistics: ranks, correlations, tests, survival."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.scan import bounds, quantiles, ranked, running, with_range
from tessera.sources.scratch import written


def _totals(df: DataFrame, key: str, sums: dict[str, Column], group: tuple[str, ...], descending: bool = False) -> DataFrame:
    """Running totals in the order of a numeric key whose values are distinct within a group: by window within groups, by ranges over a whole table."""
    if not group:
        return running(df, key, sums, descending=descending)
    w = Window.partitionBy(*group).orderBy(F.desc(key) if descending else key)
    return df.withColumns({c: F.sum(v).over(w) for c, v in sums.items()})


def average_rank(df: DataFrame, value: str, *group: str, out: str = "rank") -> DataFrame:
    """Ranks with ties averaged, by group: from counts of equal values, so a group's rows needn't sit in one task before they are counted."""
    n = _totals(df.groupBy(*group, value).agg(F.count("*").alias("_n")), value, {"_upto": F.col("_n")}, group)
    ranks = n.select(*group, value, (F.col("_upto") - F.col("_n") + (F.col("_n") + 1) / 2).alias(out))
    return df.join(ranks, [*group, value])


def correlation(df: DataFrame, pairs: list[tuple[str, str]], method: str = "pearson") -> DataFrame:
    """Correlation of column pairs over the rows where both are there, and how many."""
    out = None
    for a, b in pairs:
        d = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
        if method == "spearman":
            d = average_rank(average_rank(d, "a", out="ra"), "b", out="rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        one = d.agg(F.lit(a).alias("x"), F.lit(b).alias("y"), F.round(F.corr("a", "b"), 6).alias("r"), F.count("*").alias("n"))
        out = one if out is None else out.unionAll(one)
    return out


def masked_correlation(df: DataFrame, pairs: list[tuple[str, str]], least: int = 10, critical: float = 1.959964) -> DataFrame:
    """Correlations of pairs with enough rows; those whose t statistic is below the critical value are masked as null."""
    c = correlation(df, pairs).where(F.col("n") >= least)
    t = F.abs("r") * F.sqrt((F.col("n") - 2) / F.nullif(1 - F.col("r") * F.col("r"), F.lit(0.0)))
    return c.select("x", "y", "n", "r", F.when(t.isNull() | (t >= critical), F.col("r")).alias("masked"))


def class_balance(df: DataFrame, label: str, fold: str) -> DataFrame:
    """The share of positives, to two places, in the train and the test rows of each fold."""
    n = df.groupBy(fold).agg(F.count("*").alias("n"), F.sum(F.col(label).cast("int")).alias("p"))
    whole = n.agg(F.sum("n").alias("all"), F.sum("p").alias("positive"))
    share = lambda p, m: F.round(p / F.nullif(m, F.lit(0)), 2)
    return n.crossJoin(whole).select(fold, share(F.col("positive") - F.col("p"), F.col("all") - F.col("n")).alias("train"), share(F.col("p"), F.col("n")).alias("test"))  # one row


def logit(df: DataFrame, label: str, cols: list[str], fold: str, alpha: float = 1.0, intercept: bool = False) -> DataFrame:
    """For each fold, a lasso logistic fit on the other folds' rows (the penalty is alpha times the coefficients' sizes,
    against the summed loss), with rows, accuracy and area under the curve of its train and test rows."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = df.select(F.col(fold).alias("fold"), F.col(label).cast("double").alias("label"), array_to_vector(F.array(*(F.col(c).cast("double") for c in cols))).alias("features"))
    out = None
    for i in sorted(r.fold for r in v.select("fold").distinct().collect()):
        train = v.where(F.col("fold") != i)
        n = train.count()
        model = LogisticRegression(regParam=alpha / max(n, 1), elasticNetParam=1.0, fitIntercept=intercept, standardization=False, maxIter=500, tol=1e-10).fit(train)
        scored = model.transform(v).select("label", F.element_at(vector_to_array("probability"), 2).alias("p"), F.when(F.col("fold") == i, "test").otherwise("train").alias("part"))
        for part in ("train", "test"):
            rows = scored.where(F.col("part") == part)
            right = rows.agg(F.count("*").alias("n"), F.round(F.avg(((F.col("p") >= 0.5) == (F.col("label") == 1)).cast("int")), 6).alias("accuracy"))
            one = right.crossJoin(auc(rows, "p", "label").select("auc")).select(F.lit(i).alias("fold"), F.lit(part).alias("part"), "n", "accuracy", "auc")  # one row each
            out = one if out is None else out.unionAll(one)
    return out


def combined_risk(df: DataFrame, score: str, fold: str, k: int) -> DataFrame:
    """High or low by each fold's cutoff, the median score of the rows of the other folds, and the majority of the folds."""
    cuts = [quantiles(df.where(F.col(fold) != i), score, (0.5,))[0] for i in range(k)]
    high = sum(((F.col(score) > F.lit(c).cast("double")).cast("int") for c in cuts), F.lit(0))
    return df.withColumn("n_high", high).withColumn("risk_group", F.when(2 * F.col("n_high") > k, "high").otherwise("low"))


def benjamini_hochberg(df: DataFrame, p: str, out: str = "q") -> DataFrame:
    """M7: adjusted p-values. Equal p-values share one, so they are counted first, and ranks and least values go through ranges of p; null ones stay null."""
    n = df.where(F.col(p).isNotNull()).groupBy(F.col(p).alias("_p")).agg(F.count("*").alias("_n"))
    ranks = running(n, "_p", {"_k": F.col("_n")})
    size = n.agg(F.sum("_n").alias("_all"))
    raw = ranks.crossJoin(size).withColumn("_raw", F.col("_p") * F.col("_all") / F.col("_k"))  # one row
    least = running(raw, "_p", {"_least": F.col("_raw")}, descending=True, combine=F.min)
    q = least.select("_p", F.least(F.lit(1.0), F.col("_least")).alias(out))
    return df.join(q, F.col(p) == F.col("_p"), "left").drop("_p")


def ks_two_sample(df: DataFrame, value: str, side: str, *group: str) -> DataFrame:
    """M8: largest and smallest difference of the two empirical distributions (side true minus false), by group."""
    n = df.groupBy(*group, value).agg(F.count_if(side).alias("a"), F.count_if(~F.col(side)).alias("b"))
    whole = n.groupBy(*group).agg(F.sum("a").alias("_a"), F.sum("b").alias("_b"))
    upto = _totals(n, value, {"a1": F.col("a"), "b1": F.col("b")}, group)
    both = upto.join(whole, list(group)) if group else upto.crossJoin(whole)  # one row
    share = lambda c: F.col(f"{c}1") / F.nullif(F.col(f"_{c}"), F.lit(0))
    d = both.withColumn("d", share("a") - share("b"))
    up, down = F.greatest(F.max("d"), F.lit(0.0)), F.greatest(-F.min("d"), F.lit(0.0))
    return d.groupBy(*group).agg(F.round(F.greatest(up, down), 6).alias("ks"), F.when(up >= down, "lower").otherwise("higher").alias("direction"))


#: Terms of a distribution that are looked at together.
TERMS = 4096


def _upper_tail(x: int, draws: int, good: int, size: int) -> float:
    """Share of a hypergeometric distribution from x on. Terms follow from each other by ratios, from the largest to both
    sides until they vanish, which is some forty deviations away: work goes with the root of the counts, and no logarithm
    of a factorial loses digits. Their sum is what they are shares of."""
    lo, hi = max(0, draws - (size - good)), min(draws, good)
    mode = min(hi, max(lo, (draws + 1) * (good + 1) // (size + 2)))
    whole, tail = [1.0], [1.0] if mode >= x else []
    for step, end in ((1, hi), (-1, lo)):
        at, last = mode, 1.0
        while at != end and last:
            i = np.arange(at, at + step * min(TERMS, abs(end - at)), step, dtype=np.float64)
            if step > 0:
                ratio = (good - i) * (draws - i) / ((i + 1) * (size - good - draws + i + 1))
            else:
                ratio = i * (size - good - draws + i) / ((good - i + 1) * (draws - i + 1))
            terms = last * np.cumprod(ratio)
            whole.append(float(terms.sum()))
            tail.append(float(terms[i + step >= x].sum()))
            at, last = at + step * len(i), float(terms[-1])
    return min(1.0, math.fsum(tail) / math.fsum(whole))


def _hypergeometric(k: pd.Series, n: pd.Series, K: pd.Series, N: pd.Series) -> pd.Series:
    return pd.Series([_upper_tail(*map(int, r)) for r in zip(k, n, K, N, strict=True)], dtype="float64")


def enrichment(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Hits among those drawn in each cluster and class, good ones of the whole, and the upper-tail hypergeometric p."""
    n = df.groupBy(cluster, label).agg(F.count("*").alias("hits"))
    total = n.agg(F.sum("hits").alias("whole"))
    n = n.withColumn("drawn", F.sum("hits").over(Window.partitionBy(cluster))).withColumn("good", F.sum("hits").over(Window.partitionBy(label))).crossJoin(total)  # one row
    udf = F.pandas_udf(_hypergeometric, "double")
    return n.withColumn("p", F.round(udf("hits", "drawn", "good", "whole"), 9))


def mann_whitney(df: DataFrame, value: str, side: str, *group: str) -> DataFrame:
    """U of the true side, z by the normal approximation without tie correction, and log2 of the ratio of means (+1e-9)."""
    r = average_rank(df, value, *group)
    n1, n2 = F.count_if(side), F.count_if(~F.col(side))
    m = lambda c: F.coalesce(F.avg(F.when(c, F.col(value))), F.lit(0.0)) + 1e-9
    out = r.groupBy(*group).agg(n1.alias("n1"), n2.alias("n2"), F.sum(F.when(F.col(side), F.col("rank")).otherwise(0.0)).alias("w"), F.log2(m(F.col(side)) / m(~F.col(side))).alias("log2fc"))
    u = F.col("w") - F.col("n1") * (F.col("n1") + 1) / 2
    z = (u - F.col("n1") * F.col("n2") / 2) / F.sqrt(F.nullif(F.col("n1") * F.col("n2") * (F.col("n1") + F.col("n2") + 1) / 12.0, F.lit(0.0)))
    return out.select(*group, "n1", "n2", F.round(u, 3).alias("u"), F.round(z, 6).alias("z"), F.round("log2fc", 6).alias("log2fc"))


def kruskal(df: DataFrame, value: str, label: str) -> DataFrame:
    """H without tie correction."""
    r = average_rank(df, value)
    per = r.groupBy(label).agg(F.count("*").alias("n"), F.sum("rank").alias("r"))
    n = F.sum("n")
    return per.agg(F.round(12.0 / (n * (n + 1)) * F.sum(F.col("r") * F.col("r") / F.col("n")) - 3 * (n + 1), 6).alias("h"), F.count("*").alias("groups"))


def anova(df: DataFrame, value: str, label: str) -> DataFrame:
    """F of a one-way analysis, from counts, means and variances by group."""
    g = df.groupBy(label).agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.coalesce(F.var_samp(value), F.lit(0.0)).alias("v"))
    whole = g.agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"))
    s = g.crossJoin(whole)  # one row
    between = F.sum(F.col("n") * (F.col("m") - F.col("grand")) ** 2) / (F.count("*") - 1)
    within = F.sum((F.col("n") - 1) * F.col("v")) / (F.sum("n") - F.count("*"))
    return s.agg(F.round(between / within, 6).alias("f"), F.count("*").alias("groups"))


def t_test(df: DataFrame, value: str, side: str) -> DataFrame:
    """Welch's t of the true side against the false one."""
    on = lambda f, c: f(F.when(c, F.col(value)))
    a, b = F.col(side), ~F.col(side)
    t = (on(F.avg, a) - on(F.avg, b)) / F.sqrt(on(F.var_samp, a) / on(F.count, a) + on(F.var_samp, b) / on(F.count, b))
    return df.agg(F.round(t, 6).alias("t"), on(F.count, a).alias("n1"), on(F.count, b).alias("n2"))


def kaplan_meier(df: DataFrame, time: str, event: str, *group: str) -> DataFrame:
    """Survival after each time. Rows are counted by time first, so totals are over distinct times."""
    t = df.groupBy(*group, time).agg(F.count_if(F.col(event) == 1).alias("events"), F.count("*").alias("n"))
    t = _totals(t, time, {"at_risk": F.col("n")}, group, descending=True)
    left = F.col("events") < F.col("at_risk")
    t = _totals(t, time, {"_ends": (~left).cast("int"), "_log": F.when(left, F.log1p(-F.col("events") / F.col("at_risk"))).otherwise(0.0)}, group)
    return t.withColumn("survival", F.round(F.when(F.col("_ends") > 0, 0.0).otherwise(F.exp("_log")), 6)).select(*group, time, "events", "at_risk", "survival")


def log_rank(df: DataFrame, time: str, event: str, side: str) -> DataFrame:
    """Chi-square of two groups. Rows are counted by time; who is still at risk comes from totals of later ranges of time."""
    t = df.groupBy(time).agg(F.count_if(F.col(event) == 1).alias("d"), F.count_if((F.col(event) == 1) & F.col(side)).alias("d1"), F.count("*").alias("c"), F.count_if(side).alias("c1"))
    t = running(t, time, {"n": F.col("c"), "n1": F.col("c1")}, descending=True)
    expected = F.col("d") * F.col("n1") / F.col("n")
    variance = F.when(F.col("n") > 1, F.col("d") * (F.col("n1") / F.col("n")) * (1 - F.col("n1") / F.col("n")) * (F.col("n") - F.col("d")) / (F.col("n") - 1)).otherwise(0.0)
    return t.agg(F.sum("d1").alias("observed"), F.round(F.sum(expected), 6).alias("expected"), F.round((F.sum("d1") - F.sum(expected)) ** 2 / F.nullif(F.sum(variance), F.lit(0.0)), 6).alias("chi2"))


def cox(df: DataFrame, time: str, event: str, cols: list[str], fold: Column | None = None, ridge: float = 0.1) -> DataFrame:
    """Ridge Cox regression (Breslow ties) by Newton steps, for the rows of each fold; one pass a step serves all folds."""
    from tessera.operators import cox as C

    own = df if fold is None else df.withColumn("_fold", fold.cast("int"))
    ks = [0] if fold is None else C.folds_of(own, F.col("_fold"))
    found = C.regressions(own, time, event, cols, [C.Fit(None if fold is None else k, ridge, tuple(cols)) for k in ks], None if fold is None else F.col("_fold"), inside=True)
    rows = [(k, c, float(b[i]), float(se[i])) for k, (b, se) in zip(ks, found, strict=True) for i, c in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "fold int, feature string, coef double, se double")


def cross_validated(df: DataFrame, time: str, event: str, cols: list[str], fold: str, ridges: tuple[float, ...]) -> DataFrame:
    """Ridge, fold, c_index, pairs: for each penalty, fits on all folds but one and the C-index of the fold left out. All fits take their steps together."""
    from tessera.operators import cox as C

    k = F.col(fold)
    fits = [C.Fit(i, r, tuple(cols)) for r in ridges for i in C.folds_of(df, k)]
    scores = C.validated(df, time, event, "risk", cols, k, fits)
    names = df.sparkSession.createDataFrame([(i, float(f.ridge), f.left_out) for i, f in enumerate(fits)], "fit int, ridge double, fold int")
    return names.join(scores, "fit", "left").select("ridge", "fold", "c_index", F.coalesce("pairs", F.lit(0)).alias("pairs"))


def best_ridge(table: DataFrame) -> DataFrame:
    """The penalty with the highest mean C-index, the larger one if two are equal."""
    mean = table.groupBy("ridge").agg(F.round(F.avg("c_index"), 6).alias("c_index"))
    return mean.orderBy(F.desc("c_index"), F.desc("ridge")).limit(1)


#: Bits of a rank that a level of a tree takes: a node has 2 ** BITS children.
BITS = 3


def _children(rank: str, levels: int, out: str) -> Column:
    """A rank in every level of a tree: two ranks are in two children of one node exactly once, the smaller in the lower one."""
    return F.explode(F.expr(f"transform(sequence(0, {levels - 1}), l -> struct(l, shiftright({rank}, {BITS} * (l + 1)) as node, cast(shiftright({rank}, {BITS} * l) & {2**BITS - 1} as int) as child))")).alias(out)


def c_index(df: DataFrame, time: str, event: str, score: str, key: str, *group: str) -> DataFrame:
    """Share of comparable pairs (the earlier had the event) that the score orders, by group.

    Rows with the same time and score are counted first. A pair's times part in one node of a tree over the ranks of times,
    which are over all groups. There, children's totals by range of the score give the pairs and, of two ranges, those in
    order; within a range, running counts by score do. So work grows as rows by levels, and no pair is formed.
    """
    times = ranked(df.select(F.col(time).alias("t")).where("t is not null").distinct(), "t", out="rt").withColumn("rt", F.col("rt") - 1)
    counted = df.where(F.col(time).isNotNull()).groupBy(*group, F.col(time).alias("t"), F.col(score).alias("s")).agg(F.count("*").alias("n"), F.count_if(F.col(event) == 1).alias("e"))
    rows, _ = written(with_range(counted.join(times, "t"), "s", bounds(df, score)), "risk-counts")
    top = 2**BITS - 1
    levels = max(1, -(-(rows.agg(F.max("rt")).first()[0] or 0).bit_length() // BITS))
    at = rows.select(*group, "s", "n", "e", F.when(F.col("s").isNotNull(), F.col("_range")).alias("r"), _children("rt", levels, "k"))
    early, late = F.when(F.col("k.child") < top, F.col("e")).otherwise(0), F.when(F.col("k.child") > 0, F.col("n")).otherwise(0)
    at = at.select(*group, "s", "r", "k.l", "k.node", "k.child", early.alias("early"), late.alias("late")).where("early > 0 or late > 0")
    node = [*group, "l", "node"]

    # what children below c had early, by what those from c on had late
    by_child = [f(F.when(F.col("child") == c, F.col(x)).otherwise(0)).alias(f"{x}{c}") for f, x, cs in ((F.sum, "early", range(top)), (F.sum, "late", range(1, top + 1))) for c in cs]
    totals = at.groupBy(*node, "r").agg(*by_child)
    crossed = lambda late: sum((F.col(f"early{c}") * sum((late(d) for d in range(c + 2, top + 1)), late(c + 1)) for c in range(top)), F.lit(0))
    sums = [F.sum(f"{x}{c}").alias(f"{x}{c}") for x, cs in (("early", range(top)), ("late", range(1, top + 1))) for c in cs]
    pairs = totals.groupBy(*node).agg(*sums).select(*group, F.lit("pairs").alias("kind"), crossed(lambda c: F.col(f"late{c}")).alias("n"))
    lower = Window.partitionBy(*node).orderBy("r").rowsBetween(Window.unboundedPreceding, -1)  # one row a node and range
    apart = totals.where("r is not null").select(*group, F.lit("right").alias("kind"), crossed(lambda c: F.coalesce(F.sum(f"late{c}").over(lower), F.lit(0))).alias("n"))

    equal, upto = Window.partitionBy(*node, "r", "s"), Window.partitionBy(*node, "r").orderBy("s")  # by range: with those of the same score
    later = lambda w: F.get(F.array(*(F.sum(F.when(F.col("child") >= c, F.col("late")).otherwise(0)).over(w) for c in range(1, top + 1))), F.col("child"))
    within = at.where("s is not null").groupBy(*node, "r", "s", "child").agg(F.sum("early").alias("early"), F.sum("late").alias("late"))
    within = within.select(*group, "early", later(equal).alias("same"), later(upto).alias("upto")).where("early > 0").groupBy(*group).agg(F.sum(F.col("early") * F.col("same")).alias("ties"), F.sum(F.col("early") * (F.col("upto") - F.col("same"))).alias("right"))
    within = within.select(*group, F.inline(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in ("ties", "right")))))
    n = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0))
    return pairs.unionAll(apart).unionAll(within).groupBy(*group).agg(F.round((n("right") + n("ties") / 2) / F.nullif(n("pairs"), F.lit(0)), 6).alias("c_index"), n("pairs").alias("pairs"))


def risk_split(df: DataFrame, train: Column, score: str, *percentiles: float) -> DataFrame:
    """High or low by the cutoff of the train rows, applied to all."""
    cuts = quantiles(df.where(train), score, percentiles or (0.5,))
    level = sum(((F.col(score) > F.lit(c).cast("double")).cast("int") for c in cuts), F.lit(0))
    return df.withColumn("risk_group", level)


#: Two-sided 95 % quantiles of Student's t for 1 to 30 degrees of freedom (fixed values), then the normal one.
T95 = (12.706205, 4.302653, 3.182446, 2.776445, 2.570582, 2.446912, 2.364624, 2.306004, 2.262157, 2.228139, 2.200985, 2.178813, 2.160369, 2.144787, 2.13145, 2.119905, 2.109816, 2.100922, 2.093024, 2.085963, 2.079614, 2.073873, 2.068658, 2.063899, 2.059539, 2.055529, 2.051831, 2.048407, 2.04523, 2.042272)


def mean_ci(df: DataFrame, value: str, *group: str) -> DataFrame:
    """Mean and half-width of its 95 % interval by group."""
    n = F.count(value)
    t = F.coalesce(F.get(F.array(*map(F.lit, T95)), (n - 2).cast("int")), F.lit(1.959964))
    half = F.when(n > 1, t * F.stddev_samp(value) / F.sqrt(n))
    return df.groupBy(*group).agg(n.alias("n"), F.round(F.avg(value), 6).alias("mean"), F.round(half, 6).alias("half_width"))


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the curve by ranks."""
    r = average_rank(df, score)
    n1, n0 = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    u = F.sum(F.when(F.col(label) == 1, F.col("rank")).otherwise(0.0)) - n1 * (n1 + 1) / 2
    return r.agg(F.round(u / F.nullif(n1 * n0, F.lit(0)), 6).alias("auc"), n1.alias("positives"), n0.alias("negatives"))


def stratified_folds(df: DataFrame, key: str, label: str, k: int, seed: int = 0) -> DataFrame:
    """Folds of even size within each label, by hash order of keys; one row a key goes through the window."""
    w = Window.partitionBy(label).orderBy(F.xxhash64(F.lit(seed), key), key)
    return df.withColumn("fold", ((F.row_number().over(w) - 1) % k).cast("int"))


def group_folds(df: DataFrame, group: str, k: int) -> DataFrame:
    """Whole institutions dealt by falling size, so that no group is in two folds."""
    n = df.groupBy(group).agg(F.count("*").alias("_n"))
    place = ranked(n, "_n", (group,), descending=True, out="_k")
    return df.join(place.select(group, ((F.col("_k") - 1) % k).cast("int").alias("fold")), group)
