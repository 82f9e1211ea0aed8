"""Language of texts, also mixed ones: scripts narrow the candidates, Viterbi labels spans of words."""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.arrow import slices
from tessera.sources.scratch import remove, written

UNKNOWN = "und"
#: Fixed ranges of code points by script (first, last, script); letters outside all of them are "Other".
SCRIPTS = (
    (0x41, 0x24F, "Latin"), (0x250, 0x2AF, "Latin"), (0x370, 0x3FF, "Greek"), (0x400, 0x52F, "Cyrillic"), (0x530, 0x58F, "Armenian"), (0x590, 0x5FF, "Hebrew"),
    (0x600, 0x77F, "Arabic"), (0x900, 0x97F, "Devanagari"), (0x980, 0x9FF, "Bengali"), (0xB80, 0xBFF, "Tamil"), (0xC00, 0xC7F, "Telugu"), (0xE00, 0xE7F, "Thai"),
    (0x10A0, 0x10FF, "Georgian"), (0x1100, 0x11FF, "Hangul"), (0x1E00, 0x1EFF, "Latin"), (0x1F00, 0x1FFF, "Greek"), (0x3040, 0x30FF, "Kana"), (0x3400, 0x9FFF, "Han"), (0xAC00, 0xD7AF, "Hangul"),
)
_starts = np.array([a for a, _, _ in SCRIPTS])
#: Chance of a gram that a language's sample lacks; alike for all languages, so that small samples aren't favoured.
FLOOR = 1e-6
#: Words whose scores a task remembers, and languages that a model may have.
REMEMBERED, MOST_LANGS = 300_000, 1000
#: Grams of a model, of all languages.
MOST_GRAMS = 1_000_000


def script_of(word: str) -> str:
    """The script of most of a word's letters."""
    found = Counter()
    for c in word:
        i = int(np.searchsorted(_starts, ord(c), "right")) - 1
        found[SCRIPTS[i][2] if i >= 0 and ord(c) <= SCRIPTS[i][1] else "Other"] += 1
    return min(found, key=lambda s: (-found[s], s), default="Other")


def letters(token: str) -> str:
    return token if token.isalpha() else "".join(filter(str.isalpha, token))


def grams(word: str) -> list[str]:
    """Runs of three characters of the word with its ends marked."""
    w = f"^{word}$"
    return [w[i : i + 3] for i in range(len(w) - 2)]


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 3; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class Model:
    langs: list[str]
    rows: dict[str, int]
    logs: np.ndarray
    scripts: dict[str, list[bool]]
    penalty: float
    foreign: float

    def score(self, words: list[str]) -> np.ndarray:
        """A row of scores by language for each word (lower-case letters): sums of its grams' log chances, less for languages that don't use its script."""
        of = self.rows
        idx, size = [], []
        for w in words:
            found = [of.get(g, 0) for g in grams(w)]
            idx += found
            size.append(len(found))
        ends = np.cumsum(size)
        out = np.add.reduceat(self.logs[idx], np.concatenate([[0], ends[:-1]]), axis=0)
        some = {k: np.where(v, 0, self.foreign) for k, v in self.scripts.items() if not all(v)}
        all_fit = self.scripts.keys() - some.keys()
        latin = "Latin" in all_fit
        for i, w in enumerate(words):
            if w.isascii() or max(w) < "\u0250":  # letters below are Latin
                if latin:
                    continue
                script = "Latin"
            else:
                script = script_of(w)
            if script in some:
                out[i] -= some[script]
        return out

    def label(self, scores: np.ndarray) -> np.ndarray:
        """The language of each word on the best path, where a change of language costs the penalty."""
        n, k = scores.shape
        best = int(scores.sum(0).argmax())
        if k == 1:
            return np.zeros(n, np.int64)
        # a path with one language is the best if no run of words gains more than one change costs
        gain = scores - scores[:, best : best + 1]
        gain[:, best] = -np.inf
        total = np.cumsum(gain.max(1))
        if (total - np.minimum.accumulate(np.concatenate([[0.0], total[:-1]]))).max() <= self.penalty:
            return np.full(n, best)
        rows = scores.tolist()
        now, penalty = rows[0], self.penalty
        came: list[tuple[list[float], float, int]] = []
        for row in rows[1:]:
            top = max(now)
            change = top - penalty
            came.append((now, change, now.index(top)))
            now = [(x if x >= change else change) + y for x, y in zip(now, row, strict=True)]
        out = np.empty(n, np.int64)
        out[-1] = at = now.index(max(now))
        for t in range(n - 2, -1, -1):
            before, change, origin = came[t]
            if before[at] < change:
                at = origin
            out[t] = at
        return out


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: dict[str, Counter] = {}
    for whole in batches:
        for batch in slices(whole):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(text.lower().split())
    found: Counter = Counter()
    for lang, tokens in words.items():
        for token, n in tokens.items():
            if word := letters(token):
                found[lang, "", script_of(word)] += n * len(word)
                for g in grams(word):
                    found[lang, g, ""] += n
    keys = list(found)
    cols = [pa.array([k[i] for k in keys], pa.string()) for i in range(3)]
    yield pa.RecordBatch.from_arrays([*cols, pa.array([found[k] for k in keys], pa.int64())], ["lang", "gram", "script", "n"])


def fit(docs: DataFrame, max_docs: int = 1500, max_grams: int = 25_000, penalty: float = 10.0, foreign: float = 30.0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from the text and language of documents that aren't held out.

    The sample is bounded by language: about ``max_docs`` whole documents of each, chosen by a hash of id and text, so a
    rare language is learned at any size. Its grams are counted in the cluster, and the ``max_grams`` most frequent ones
    of each language (fewer, where there are so many languages that MOST_GRAMS would be passed) make the model, which
    therefore fits any task; more than MOST_LANGS languages are refused. A language uses a script if at least 1 % of its
    letters are of it.
    """
    src = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    src = src.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 30)).alias("h"))
    n = src.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGS + 1).collect()
    if len(n) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    spark = docs.sparkSession
    taken = spark.createDataFrame([(r.lang, int((1 << 30) * min(1.0, max_docs / r.n))) for r in n], "lang string, below long")
    sample = src.join(F.broadcast(taken), "lang").where("h < below").select("text", "lang")
    counts = sample.mapInArrow(_count_grams, "lang string, gram string, script string, n long").groupBy("lang", "gram", "script").agg(F.sum("n").alias("n"))
    counts, path = written(counts, "grams")
    by_script = counts.where("gram = ''").collect()
    most = min(max_grams, MOST_GRAMS // max(1, len(n)))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    kept = counts.where("gram <> ''").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most).select("gram").distinct()
    by_gram = counts.where("gram <> ''").join(kept, "gram", "left_semi").groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("n")).orderBy("gram").collect()
    remove(spark, path)
    langs = sorted({r.lang for r in by_script})
    number = {x: i for i, x in enumerate(langs)}
    logs = np.zeros((len(by_gram) + 1, len(langs)))
    for i, r in enumerate(by_gram, 1):
        for lang, k in r.n.items():
            logs[i, number[lang]] = k
    logs = np.log(logs / np.maximum(logs.sum(0), 1) + FLOOR).astype(np.float32)
    total = Counter()
    for r in by_script:
        total[r.lang] += r.n
    scripts: dict[str, list[bool]] = {}
    for r in by_script:
        if r.n >= 0.01 * total[r.lang]:
            scripts.setdefault(r.script, [False] * len(langs))[number[r.lang]] = True
    return Model(langs, {r.gram: i for i, r in enumerate(by_gram, 1)}, logs, scripts, penalty, foreign)


def _predict(shared, keep: list[str]):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        known: dict[str, int] = {}
        size = np.zeros(REMEMBERED * 2, np.int32)
        scores = np.zeros((REMEMBERED * 2, max(1, len(model.langs))), np.float32)
        for whole in batches:
            for batch in slices(whole):
                tokens = [t.lower().split() if t else [] for t in batch.column("text").to_pylist()]
                new = list({w for words in tokens for w in words if w not in known})
                if len(known) + len(new) > len(size):
                    known = {}
                    new = list({w for words in tokens for w in words})
                    if len(new) > len(size):
                        size, scores = np.zeros(2 * len(new), np.int32), np.zeros((2 * len(new), scores.shape[1]), np.float32)
                if new:
                    at, plain = len(known), [letters(w) for w in new]
                    size[at : at + len(new)] = [len(w) for w in plain]
                    scores[at : at + len(new)] = 0
                    held = [i for i, w in enumerate(plain) if w]
                    if held and model.langs:
                        scores[at + np.array(held)] = model.score([plain[i] for i in held])
                    known.update(zip(new, range(at, at + len(new)), strict=True))
                lang, share, spans = [], [], []
                for words in tokens:
                    idx = np.array([known[w] for w in words], np.int64)
                    n = size[idx]
                    if not n.sum() or not model.langs:
                        lang.append(UNKNOWN)
                        share.append(0.0)
                        spans.append([])
                        continue
                    labels = model.label(scores[idx])
                    weight = np.bincount(labels, n, len(model.langs))
                    top = int(weight.argmax())
                    lang.append(model.langs[top])
                    share.append(float(weight[top] / weight.sum()))
                    cut = np.flatnonzero(np.diff(labels)) + 1
                    spans.append([{"first": a, "end": b, "lang": model.langs[labels[a]]} for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(labels)], strict=True)])
                span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(share, pa.float64()), pa.array(spans, span)], [*keep, "lang_pred", "score", "spans"])

    return over


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep``, then lang_pred, score (the share of letters on the best path that are in that language) and
    spans (first word, end, language) of the whole text. Ties of languages go to the first by name.

    A null text, or one without a letter, is ``und`` with score 0. Repeated rows each come back; an empty table gives
    an empty result. Nothing but the text is read for a prediction.
    """
    names = list(keep)
    src = docs.select(*(F.col(c) for c in names if c != "text"), F.col(text_col).alias("text"))
    fields = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in names)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return src.mapInArrow(_predict(shared, names), f"{fields}, lang_pred string, score double, spans array<struct<first:int,end:int,lang:string>>")
