"""One-vs-rest logistic regression of a class label (M21): all classes, and all folds left out, take each Newton step from one pass over the rows."""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.guards import Refused
from tessera.operators.stats import average_rank

STEPS, ENOUGH, ROWS = 100, 1e-9, 2048
#: Numbers of the sums of a pass, over fits, that tasks may hold and the driver may get.
MOST_SUMS = 8_000_000


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    """Vectors with a leading one for the intercept."""
    return np.column_stack([np.ones(rows), np.asarray(column.flatten(), np.float64).reshape(rows, -1)])


def _chances(x: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ b.T, -500, 500)))


def _sums(shared):
    """fit, value: for each fold and class the loss, the gradient and the Hessian of a task's rows of other folds, as one array."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folds, classes, b = shared.value
        n, k, p = b.shape
        loss, g, h = np.zeros((n, k)), np.zeros((n, k, p)), np.zeros((n, k, p, p))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                x, label, fold = _matrix(batch.column("vec"), batch.num_rows), np.asarray(batch.column("label")), np.asarray(batch.column("fold"))
                y = label[:, None] == classes
                for f in range(n):
                    use = fold != folds[f]
                    a, t = x[use], y[use]
                    z = np.clip(a @ b[f].T, -500, 500)
                    chance = 1 / (1 + np.exp(-z))
                    loss[f] += (np.logaddexp(0, z) - t * z).sum(0)
                    g[f] += (chance - t).T @ a
                    w = chance * (1 - chance)
                    for c in range(k):
                        h[f, c] += (a * w[:, c : c + 1]).T @ a
        upper = np.triu_indices(p)
        for f in range(n):
            for c in range(k):
                row = np.concatenate([[loss[f, c]], g[f, c], h[f, c][upper]])
                at = np.arange(len(row), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), f * k + c, np.int32)), pa.array(at), pa.array(row)], ["fit", "at", "value"])

    return over


class Classifier:
    """Coefficients by fold left out, class and component (the first is the intercept)."""

    def __init__(self, folds: np.ndarray, classes: np.ndarray, b: np.ndarray):
        self.folds, self.classes, self.b = folds, classes, b


def fit(df: DataFrame, label: str, vec: str, fold: str | None = None, ridge: float = 1.0) -> Classifier:
    """Coefficients of each class against all others, on the rows of all folds but one (without ``fold``: on all rows).

    The penalty is ridge / 2 times the squared coefficients, but for the intercept. A step that would raise a class's
    loss is halved. Rows without a label or vector take no part. Sums of more than MOST_SUMS numbers are refused.
    """
    src = df.select(F.col(label).cast("int").alias("label"), F.col(vec).cast("array<double>").alias("vec"), (F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold")).where("label is not null and vec is not null and fold is not null")
    classes = np.array(sorted(r.label for r in src.select("label").distinct().limit(MOST_SUMS).collect()), np.int64)
    folds = np.array(sorted(r.fold for r in src.select("fold").distinct().limit(MOST_SUMS).collect()) if fold else [-2], np.int64)
    if not len(classes):
        raise Refused("no row has a label and a vector")
    p = len(src.select("vec").first().vec) + 1
    n, k = len(folds), len(classes)
    if n * k * p * (p + 3) // 2 > MOST_SUMS:
        raise Refused(f"{n} folds of {k} classes and {p} coefficients are too many sums")
    b, step, before = np.zeros((n, k, p)), np.zeros((n, k, p)), np.full((n, k), np.inf)
    penalty = np.full(p, ridge)
    penalty[0] = 0.0
    upper = np.triu_indices(p)
    sc = df.sparkSession.sparkContext
    for _ in range(STEPS):
        found = src.mapInArrow(_sums(sc.broadcast((folds, classes, b))), "fit int, at int, value double").groupBy("fit", "at").agg(F.sum("value").alias("value")).toArrow()
        sums = np.zeros((n * k, 1 + p + len(upper[0])))
        sums[np.asarray(found.column("fit")), np.asarray(found.column("at"))] = np.asarray(found.column("value"))
        moved = 0.0
        for i, row in enumerate(sums):
            f, c = divmod(i, k)
            loss = row[0] + (penalty * b[f, c] ** 2).sum() / 2
            if loss > before[f, c] + 1e-9 * abs(before[f, c]):
                step[f, c] /= 2
                b[f, c] -= step[f, c]
            else:
                before[f, c] = loss
                h = np.zeros((p, p))
                h[upper] = row[1 + p :]
                h = h + np.triu(h, 1).T + np.diag(penalty + 1e-12)
                step[f, c] = -np.linalg.solve(h, row[1 : 1 + p] + penalty * b[f, c])
                b[f, c] += step[f, c]
            moved = max(moved, float(np.abs(step[f, c]).max()))
        if moved < ENOUGH:
            break
    return Classifier(folds, classes, b)


def _predict(shared, names: list[str]):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folds, classes, b = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                x, fold = _matrix(batch.column("vec"), batch.num_rows), np.asarray(batch.column("fold"))
                chance = np.zeros((len(x), len(classes)))
                for f in range(len(folds)):
                    own = fold == folds[f] if folds[f] != -2 else np.ones(len(x), bool)
                    chance[own] = _chances(x[own], b[f])
                lists = pa.ListArray.from_arrays(np.arange(0, chance.size + 1, len(classes), dtype=np.int32), pa.array(chance.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), lists, pa.array(classes[chance.argmax(1)].astype(np.int32))], [*names, "chances", "predicted"])

    return over


def predict(df: DataFrame, model: Classifier, vec: str, fold: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The columns ``keep``, chances (by class in order) and predicted (the likeliest class, the smallest if equal) by the fit that left a row's fold out."""
    src = df.select(*keep, F.col(vec).cast("array<double>").alias("vec"), (F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold")).where("vec is not null and fold is not null")
    kinds = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in keep)
    shared = df.sparkSession.sparkContext.broadcast((model.folds, model.classes, model.b))
    return src.mapInArrow(_predict(shared, list(keep)), f"{kinds}{', ' if kinds else ''}chances array<double>, predicted int")


def class_auc(scored: DataFrame, label: str, model: Classifier) -> DataFrame:
    """label, positives, auc: for each class the area under the curve of its chance against all other classes. Ranks are by class, one row a distinct chance."""
    names = F.array(*(F.lit(int(c)) for c in model.classes))
    rows = scored.select(F.col(label).alias("_l"), F.explode(F.arrays_zip(names.alias("c"), F.col("chances").alias("p"))).alias("s")).select(F.col("s.c").alias("label"), F.col("s.p").alias("p"), (F.col("_l") == F.col("s.c")).alias("own"))
    r = average_rank(rows, "p", "label")
    n1, n0 = F.count_if("own"), F.count_if(~F.col("own"))
    u = F.sum(F.when(F.col("own"), F.col("rank")).otherwise(0.0)) - n1 * (n1 + 1) / 2
    return r.groupBy("label").agg(n1.alias("positives"), F.round(u / F.nullif(n1 * n0, F.lit(0)), 6).alias("auc"))


def error_matrix(scored: DataFrame, label: str) -> DataFrame:
    """label, predicted, n, share (of the label's rows) from predictions."""
    n = scored.groupBy(F.col(label).alias("label"), "predicted").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("label")), 6))  # one row a pair of classes
