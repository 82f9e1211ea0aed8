"""Toxicity from confirmed examples and unlabelled text: non-negative positive-unlabelled learning of a linear model.

With the class prior p, the risk of a classifier is p * (confirmed counted as toxic) + (unlabelled counted as clean) -
p * (confirmed counted as clean). The last two make the risk of clean text, which can't be below zero: where a batch's
falls below it, the step goes against that part alone, so the model doesn't overfit the few confirmed examples. Rows
labelled clean are used for the prior only.
"""

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.arrow import binaries, coded_words, flat, slices
from tessera.sources.scratch import written

#: ASCII that isn't a letter parts words; letters are lower-cased before, also beyond ASCII.
_FOLD = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Near copies in the sample share one of so many least hashes of their runs of words, and one of them stays.
SKETCHES, RUN = 3, 5
#: Lengths of a word's beginnings; how often a text has a stem, and one of how many of its words it is.
STEMS, TIMES, SHARES = range(4, 9), (1, 2, 4), (200, 50, 15)
LEVELS = len(TIMES) + len(SHARES)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 modulo 5; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Lower-case words of a slice of texts: the number of each in order, how many each text has, and the distinct ones."""
    lower = pc.utf8_lower(pc.fill_null(column, ""))
    data, offsets = flat(lower)
    plain = pa.LargeStringArray.from_buffers(len(lower), pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data.tobytes().translate(_FOLD)))
    return coded_words(plain)


def stems(word: str) -> list[str]:
    """The whole word, and its beginnings of 4 to 8 letters, which inflected forms share."""
    return [f"{word}$", *(word[:n] for n in STEMS if len(word) >= n)]


def occurrences(column: pa.Array, number: Callable[[str], list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, stem, how many words of the text have it, and how many words each text has. ``number``: a word's stems by number."""
    codes, size, distinct = words(column)
    of = [number(w) for w in distinct.to_pylist()]
    n = np.fromiter((len(x) for x in of), np.int64, len(of))
    flat_of = np.fromiter((i for x in of for i in x), np.int64, int(n.sum()))
    text = np.repeat(np.arange(len(size)), size)
    some = n[codes] > 0 if len(codes) else np.zeros(0, bool)
    pair, times = np.unique(text[some] * max(1, len(of)) + codes[some], return_counts=True)
    t, w = pair // max(1, len(of)), pair % max(1, len(of))
    reps = n[w]
    start = np.cumsum(n)[w] - reps
    first = np.cumsum(reps) - reps
    stem = flat_of[np.repeat(start - first, reps) + np.arange(int(reps.sum()))]
    width = int(stem.max(initial=0)) + 1
    key = np.repeat(t, reps) * width + stem
    order = np.argsort(key, kind="stable")
    at, begin = np.unique(key[order], return_index=True)
    total = np.add.reduceat(np.repeat(times, reps)[order], begin) if len(at) else np.zeros(0, np.int64)
    return at // width, at % width, total, size


def levels(text: np.ndarray, stem: np.ndarray, times: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and term: a term is a stem that a text has so often, or in such a share of its words; its number is stem * LEVELS + level."""
    reached = [times >= n for n in TIMES] + [times * n >= size[text] for n in SHARES]
    return np.concatenate([text[r] for r in reached]), np.concatenate([stem[r] * LEVELS + i for i, r in enumerate(reached)])


@dataclass
class Model:
    """What each term (stem, level) adds to the log odds of a text that has it, and what all texts start from."""

    numbers: dict[str, int]
    column: np.ndarray
    weights: np.ndarray
    start: float

    def held(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Text and term of every term that a text of the slice has, once each."""
        of = self.numbers
        text, term = levels(*occurrences(column, lambda w: [of[s] for s in stems(w) if s in of]))
        term = self.column[term] if len(term) else term
        return text[term >= 0], term[term >= 0]

    def scores(self, column: pa.Array) -> np.ndarray:
        text, term = self.held(column)
        z = self.start + np.bincount(text, self.weights[term], len(column))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def model_of(terms: list[tuple[str, int]]) -> Model:
    """A model without weights for terms (stem, level)."""
    numbers = {s: i for i, s in enumerate(sorted({s for s, _ in terms}))}
    column = np.full(len(numbers) * LEVELS, -1)
    for i, (s, level) in enumerate(terms):
        column[numbers[s] * LEVELS + level] = i
    return Model(numbers, column, np.zeros(len(terms)), 0.0)


def _sketch(h: np.ndarray) -> list[int]:
    """For each of SKETCHES mixes the least hash of the runs of RUN words (a shorter text: of all its words)."""
    n = max(1, len(h) - RUN + 1)
    run = np.zeros(n, np.uint64)
    for i in range(min(RUN, len(h))):
        run = run * np.uint64(0x100000001B3) + h[i : i + n]
    return [int((((run ^ m) * m) >> np.uint64(1)).min()) for m in _MIX]


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["confirmed", "key", "text", "mark"]
    for whole in batches:
        for batch in slices(whole):
            codes, size, distinct = words(batch.column("text"))
            h = np.fromiter((int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little") for w in binaries(distinct)), np.uint64, len(distinct))
            ends = np.cumsum(size)
            found = [_sketch(h[codes[e - n : e]]) if n else [0] * SKETCHES for n, e in zip(size.tolist(), ends.tolist(), strict=True)]
            cols = [pa.array([f[i] for f in found], pa.int64()) for i in range(SKETCHES)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *cols], [*names, *(f"s{i}" for i in range(SKETCHES))])


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """stem, level, p, u: in how many confirmed and in how many unlabelled texts of a task."""
    ids: dict[str, int] = {}
    n = np.zeros((2, 0), np.int64)
    for whole in batches:
        for batch in slices(whole):
            text, term = levels(*occurrences(batch.column("text"), lambda w: [ids.setdefault(s, len(ids)) for s in stems(w)]))
            if (size := len(ids) * LEVELS) > n.shape[1]:
                n = np.pad(n, ((0, 0), (0, size * 2 - n.shape[1])))
            side = np.asarray(batch.column("confirmed"))[text]
            for i in (0, 1):
                at, k = np.unique(term[side == bool(i)], return_counts=True)
                n[i, at] += k
    held = np.flatnonzero(n.any(0))
    names = list(ids)
    for at in range(0, len(held), 65_536):
        some = held[at : at + 65_536]
        yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in some // LEVELS], pa.string()), pa.array((some % LEVELS).astype(np.int32)), pa.array(n[1, some]), pa.array(n[0, some])], ["stem", "level", "p", "u"])


def _term_rows(shared):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                text, term = shared.value.held(batch.column("text"))
                order = np.lexsort((term, text))
                text, term = text[order], term[order]
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=batch.num_rows))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("confirmed"), pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32)))], ["key", "confirmed", "terms"])

    return over


class _Rows:
    """Texts as lists of the terms that they have."""

    def __init__(self, rows: list[list[int]]):
        self.size = np.array([len(r) for r in rows], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        self.term = np.fromiter((t for r in rows for t in r), np.int64, int(self.at[-1]))

    def taken(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among ``rows`` and term of all that these texts have."""
        n = self.size[rows]
        start = np.cumsum(n) - n
        return np.repeat(np.arange(len(rows)), n), self.term[np.repeat(self.at[rows] - start, n) + np.arange(int(n.sum()))]


def train(confirmed: list[list[int]], unlabelled: list[list[int]], n_terms: int, prior: float, epochs: int = 300, batch: int = 4096, rate: float = 0.05, decay: float = 3e-4, slack: float = 0.005, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights by term and the start of a logistic model, by Adam steps on batches of the non-negative risk. Terms were chosen
    for being commoner in confirmed texts, so no weight goes below zero: more of them never make a text look cleaner. Then
    the start is moved so that even odds are where ``cut`` says."""
    p, u = _Rows(confirmed), _Rows(unlabelled)
    rng = np.random.default_rng(seed)
    theta, m, v, t = np.zeros(n_terms + 1), np.zeros(n_terms + 1), np.zeros(n_terms + 1), 0
    theta[-1] = np.log(max(prior, 1e-9) / max(1 - prior, 1e-9))
    if not confirmed or not unlabelled:
        return theta[:-1], float(theta[-1])
    steps = max(1, -(-len(unlabelled) // batch))

    def part(rows: _Rows, which: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean loss if counted as clean, and the gradients of the mean loss if counted as clean and as toxic."""
        text, term = rows.taken(which)
        z = theta[-1] + np.bincount(text, theta[term], len(which))
        chance = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        grads = []
        for g in (chance / len(which), (chance - 1) / len(which)):
            grads.append(np.append(np.bincount(term, g[text], n_terms), g.sum()))
        return float(np.logaddexp(0, z).mean()), *grads

    for _ in range(epochs):
        us, ps = rng.permutation(len(unlabelled)), rng.permutation(len(confirmed))
        for i in range(steps):
            mine, theirs = ps[i::steps] if len(ps) >= steps else ps, us[i::steps]
            p_clean, gp_clean, gp_toxic = part(p, mine)
            u_clean, gu_clean, _ = part(u, theirs)
            if u_clean - prior * p_clean >= -slack:
                g = prior * gp_toxic + gu_clean - prior * gp_clean
            else:
                g = prior * gp_clean - gu_clean
            g = g + decay * np.append(theta[:-1], 0)
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            np.maximum(theta[:-1], 0, out=theta[:-1])
    zs = [theta[-1] + np.bincount(text, theta[term], len(rows.size)) for rows in (p, u) for text, term in [rows.taken(np.arange(len(rows.size)))]]
    return theta[:-1], float(theta[-1] - cut(*zs, prior))


def cut(confirmed: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """Where log odds are cut with the least share of errors, estimated without clean labels: confirmed texts below it, times
    the prior, and what is above it among unlabelled texts beyond the prior's share of confirmed ones, at least none."""
    at = np.unique(np.concatenate([confirmed, unlabelled]))
    above = lambda z: 1 - np.searchsorted(np.sort(z), at, "left") / len(z)
    p, u = above(confirmed), above(unlabelled)
    errors = prior * (1 - p) + np.maximum(u - prior * p, 0)
    best = int(np.flatnonzero(errors == errors.min())[-1])
    if errors[best] >= prior:
        return float(at[-1] + 1)  # to call all texts clean errs no more
    return float(at[best] - 1 if best == 0 else (at[best - 1] + at[best]) / 2)


def _one_of_each(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows that are equal in ``keys`` the one with the smallest digest."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), "key").alias("_r")).select(*keys, "_r.*")


def sample(docs: DataFrame, labels: DataFrame, max_docs: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Written rows key, text, confirmed, mark of the fit: about ``max_docs`` distinct texts a side, chosen by hashes of the
    label's id or of the text, and of near copies one. mark is an unlabelled row's label, for the prior alone."""
    fits = lambda df: df.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    marks = fits(labels).where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("mark"))
    n = marks.where("mark = 1").count()
    below = lambda h, of: F.pmod(h, F.lit(1 << 30)) < int((1 << 30) * min(1.0, max_docs / max(1, of)))
    ids = marks.where((F.col("mark") == 1) & below(F.xxhash64(F.lit(1), "_id"), n)).select("_id")  # about max_docs at most
    src = fits(docs).where(F.length(F.col(text_col)) > 0).select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    distinct = src.agg(F.approx_count_distinct(F.xxhash64("text"))).first()[0]
    confirmed = src.join(F.broadcast(ids), "_id", "left_semi").select("text", F.lit(True).alias("confirmed"), F.lit(None).cast("int").alias("mark"))
    unlabelled = src.where(below(F.xxhash64(F.lit(2), "text"), distinct)).join(marks, "_id", "left").select("text", F.lit(False).alias("confirmed"), "mark")
    both = confirmed.unionAll(unlabelled).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    once = both.groupBy("confirmed", "key").agg(F.first("text").alias("text"), F.max("mark").alias("mark"))  # equal texts have equal digests
    kinds = ", ".join(f"s{i} long" for i in range(SKETCHES))
    rows = once.mapInArrow(_prints, f"confirmed boolean, key string, text string, mark int, {kinds}")
    for i in range(SKETCHES):
        rows = _one_of_each(rows, ["confirmed", f"s{i}"])
    return written(rows.select("key", "text", "confirmed", "mark"), "toxicity-sample")[0]


def measured_prior(rows: DataFrame, errors: float = 2.0) -> float:
    """The share of label 1 among the sample's unlabelled rows that have one, less so many standard errors: a prior above
    the true one would make the risk of clean text negative, one a little below costs some confidence only."""
    r = rows.where(~F.col("confirmed") & F.col("mark").isNotNull()).agg(F.count("*").alias("n"), F.avg((F.col("mark") == 1).cast("int")).alias("p")).first()
    if not r.n:
        return 0.0
    return max(r.p - errors * (r.p * (1 - r.p) / r.n) ** 0.5, r.p / 2)


def chosen_terms(rows: DataFrame, max_terms: int, least_docs: int, least_gain: float) -> list[tuple[str, int]]:
    """Terms that tell confirmed texts from unlabelled ones: in at least ``least_docs`` confirmed ones and in a larger share
    of them, with a likelihood ratio statistic of ``least_gain`` or more; the ``max_terms`` highest, so a model has a bound."""
    size = {r.confirmed: r.n for r in rows.groupBy("confirmed").agg(F.count("*").alias("n")).collect()}
    np_, nu = float(size.get(True, 0)), float(size.get(False, 0))
    if not np_ or not nu:
        return []
    n = rows.select("text", "confirmed").mapInArrow(_count_terms, "stem string, level int, p long, u long").groupBy("stem", "level").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    p, u = F.col("p"), F.col("u")
    log = lambda a, b: F.when(a > 0, a * F.log(a / b)).otherwise(0.0)
    expected = lambda k, whole: k * whole / (np_ + nu)
    gain = 2 * (log(p, expected(p + u, np_)) + log(u, expected(p + u, nu)) + log(np_ - p, expected(np_ + nu - p - u, np_)) + log(nu - u, expected(np_ + nu - p - u, nu)))
    more = (p >= least_docs) & (p * nu > u * np_)
    best = n.where(more).withColumn("gain", gain).where(F.col("gain") >= least_gain).orderBy(F.desc("gain"), "stem", "level").limit(max_terms)
    return sorted((r.stem, r.level) for r in best.collect())


def fit(docs: DataFrame, labels: DataFrame, prior: float | None = None, max_docs: int = 20_000, max_terms: int = 5_000, least_docs: int = 5, least_gain: float = 20.0, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **training) -> Model:
    """A model from documents that aren't held out, those whose label is 1 being confirmed and all of them unlabelled.

    prior: the share of toxic text, by default measured on labelled rows of the unlabelled sample. The sample is bounded:
    about ``max_docs`` distinct texts a side, without near copies. Terms are counted and texts turned into lists of
    terms in the cluster; lists of at most ``max_terms`` numbers for each sampled text come to the driver, where numpy
    trains. Labels that are null or whose id is null tell nothing; an id with several labels is confirmed if one of them
    is 1. Without a confirmed text the model gives all texts the prior (0 if there is no label).
    """
    rows = sample(docs, labels, max_docs, id_col, text_col, label_col)
    prior = measured_prior(rows) if prior is None else prior
    model = model_of(chosen_terms(rows, max_terms, least_docs, least_gain))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    lists = rows.mapInArrow(_term_rows(shared), "key string, confirmed boolean, terms array<int>").collect()
    lists.sort(key=lambda r: (r.confirmed, r.key))
    side = {c: [r.terms for r in lists if r.confirmed == c] for c in (True, False)}
    model.weights, model.start = train(side[True], side[False], len(model.weights), prior, **training)
    return model


def _score(shared, names: list[str]):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                score = shared.value.scores(batch.column("text"))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], [*names, "score", "predicted"])

    return over


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep``, score (0 to 1, higher: likelier toxic) and predicted (1 from 0.5 on) of every whole text.

    Null and empty texts get the score of a text without terms. Equal texts get equal scores, repeated rows each come
    back, and an empty table gives an empty result. Nothing but the text is read for a score.
    """
    names = list(keep)
    src = docs.select(*(F.col(c) for c in names if c != "text"), F.col(text_col).alias("text"))
    fields = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in names)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return src.mapInArrow(_score(shared, names), f"{fields}, score double, predicted int")
