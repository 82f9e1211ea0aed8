"""Benchmark items in training documents: a BM25 index of the items, asked with every passage by block-max WAND."""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.arrow import coded_words, slices

WORD = re.compile(r"\w+")
#: The usual constants of BM25.
K1, B = 1.2, 0.75
#: Items of a block: impacts are bounded by block.
BLOCK = 8
#: Bounds of blocks that are summed at a time.
SUMS = 1 << 22
#: The text of items that one broadcast index holds, in characters; more items take more passes over the documents.
INDEX_CHARS = 8_000_000


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingles(ids: list[int], size: int) -> list[tuple[int, ...]]:
    return [tuple(ids[i : i + size]) for i in range(max(1, len(ids) - size + 1))]


@dataclass
class Postings:
    """Items that hold a term, in order, with impacts; the blocks of items that they lie in, where each starts, and its largest impact."""

    items: np.ndarray
    impacts: np.ndarray
    blocks: np.ndarray = field(init=False)
    starts: np.ndarray = field(init=False)
    tops: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.blocks, self.starts = np.unique(self.items // BLOCK, return_index=True)
        self.tops = np.maximum.reduceat(self.impacts, self.starts)

    def of(self, block: int) -> tuple[float, list[int], list[float]] | None:
        """The largest impact, the items and the impacts of a block."""
        i = int(np.searchsorted(self.blocks, block))
        if i == len(self.blocks) or self.blocks[i] != block:
            return None
        a, b = int(self.starts[i]), int(self.starts[i + 1]) if i + 1 < len(self.starts) else len(self.items)
        return float(self.tops[i]), self.items[a:b].tolist(), self.impacts[a:b].tolist()


class Index:
    """Items of like length. Impacts are shares of the item's own threshold, so an item is retrieved at 1.

    An item's threshold is what it scores itself, less the impacts of its heaviest terms: as many as words may be
    missing if ``overlap`` of its shingles are there (each missing word costs at least one). So none is missed.
    """

    def __init__(self, items: list[tuple], span: int, terms: dict[str, int], size: int, overlap: float, mean: float, n: int, df: Counter) -> None:
        self.span, self.size, self.overlap = span, size, overlap
        self.item_ids = [i for i, *_ in items]
        self.shingles, self.answers = [], []
        lists: dict[int, list[tuple[int, float]]] = {}
        for at, (_, question, answer) in enumerate(items):
            ids = [terms[w] for w in question]
            self.shingles.append(shingles(ids, size))
            self.answers.append(shingles([terms[w] for w in answer], size) if answer else [])
            scale = K1 * (1 - B + B * len(ids) / mean)
            own = {t: np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1) / (f + scale) for t, f in Counter(ids).items()}
            lost = int((1 - overlap) * len(self.shingles[-1]) + 1e-9)
            least = max(sum(sorted(own.values())[: max(1, len(own) - lost)]), 1e-9)
            for t, x in own.items():
                lists.setdefault(t, []).append((at, x / least))
        self.postings = {t: Postings(np.array([i for i, _ in x]), np.array([v for _, v in x])) for t, x in lists.items()}
        self.bound = np.zeros(len(terms) + 1)
        for t, p in self.postings.items():
            self.bound[t] = p.tops.max()
        # the blocks of all terms in one array, those of term t from blocks_from[t] on
        held = [self.postings.get(t) for t in range(len(terms))]
        self.blocks_from = np.concatenate([[0], np.cumsum([len(p.blocks) if p else 0 for p in held], dtype=np.int64)])
        self.block_of = np.concatenate([np.zeros(0, np.int64), *(p.blocks for p in held if p)])
        self.block_top = np.concatenate([np.zeros(0), *(p.tops for p in held if p)])
        self.n_blocks = -(-len(items) // BLOCK)

    def reached(self, passage: np.ndarray, term: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """The passages and blocks whose bounds sum to ``least`` or more, for passages (numbered, in order) of distinct terms."""
        out = []
        step = max(1, SUMS // self.n_blocks)
        first = 0
        while first < len(passage):
            base = int(passage[first])
            to = int(np.searchsorted(passage, base + step))
            t = term[first:to]
            n = self.blocks_from[t + 1] - self.blocks_from[t]
            ends = np.cumsum(n)
            at = np.repeat(self.blocks_from[t] - (ends - n), n) + np.arange(int(ends[-1]))
            where = np.repeat(passage[first:to] - base, n) * self.n_blocks + self.block_of[at]
            hot = np.flatnonzero(np.bincount(where, self.block_top[at]) >= least)
            out.append((hot // self.n_blocks + base, hot % self.n_blocks))
            first = to
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def walk(self, terms: list[int], block: int, least: float) -> list[tuple[int, float]]:
        """The items of a block that score ``least`` or more for a query of distinct terms.

        Cursors stand in the order of their items, and the pivot is the first one at which the block's bounds sum to
        the threshold: no item before its item can reach it.
        """
        found: list[tuple[int, float]] = []
        lists = [x for t in terms if (p := self.postings.get(t)) and (x := p.of(block))]
        cursors = [[items[0], 0, top, items, impacts] for top, items, impacts in lists]
        while cursors:
            cursors.sort(key=lambda c: c[0])
            total, item = 0.0, None
            for c in cursors:
                total += c[2]
                if total >= least:
                    item = c[0]
                    break
            if item is None:
                break
            score = 0.0
            for c in cursors:
                if c[0] > item:
                    break
                while c[1] < len(c[3]) and c[3][c[1]] < item:
                    c[1] += 1
                if c[1] < len(c[3]) and c[3][c[1]] == item:
                    score += c[4][c[1]]
                    c[1] += 1
                c[0] = c[3][c[1]] if c[1] < len(c[3]) else -1
            if score >= least:
                found.append((item, score))
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def retrieve(self, terms: list[int], least: float = 1 - 1e-9) -> list[tuple[int, float]]:
        """All items that score ``least`` or more for a query of distinct terms: block-max WAND.

        The largest impacts of the terms in a block bound all its items' scores; blocks that can't reach the threshold
        are skipped, the others are walked.
        """
        own = np.array(terms, np.int64)
        _, blocks = self.reached(np.zeros(len(own), np.int64), own, least)
        return [x for block in blocks.tolist() for x in self.walk(terms, block, least)]

    def search(self, ids: np.ndarray, size: np.ndarray, before: np.ndarray) -> dict[int, dict[int, tuple[float, float]]]:
        """{document: {item: (overlap, score)}} of the items that documents hold, verified on their passages.

        ids: the terms (-1: in no item) of all documents' words, ``size`` of each; before: where each word was last
        seen in its document, or -1.
        """
        step, least = self.span, 1 - 1e-9
        n = np.where(size > 0, np.maximum(1, -(-(size - step) // step)), 0)  # passages of each document
        doc = np.repeat(np.arange(len(size)), n)
        starts = np.cumsum(size) - size
        a = starts[doc] + (np.arange(len(doc)) - (np.cumsum(n) - n)[doc]) * step
        b = np.minimum(a + 2 * step, (starts + size)[doc])
        total = np.concatenate([[0.0], np.cumsum(self.bound[ids])])
        hot = total[b] - total[a] >= 1 - 1e-6
        doc, a, b = doc[hot], a[hot], b[hot]
        # the distinct terms of each passage: words not seen before in it
        length = b - a
        passage = np.repeat(np.arange(len(a)), length)
        at = np.repeat(a - (np.cumsum(length) - length), length) + np.arange(len(passage))
        distinct = (self.bound[ids[at]] > 0) & (before[at] < a[passage])
        passage, term = passage[distinct], ids[at[distinct]]
        enough = np.bincount(passage, self.bound[term], len(a)) >= least
        held = enough[passage]
        passage, term = passage[held], term[held]
        out: dict[int, dict[int, tuple[float, float]]] = {}
        found: dict[int, list[tuple[int, float]]] = {}
        for p, block in zip(*(x.tolist() for x in self.reached(passage, term, least)), strict=True):
            first, to = np.searchsorted(passage, (p, p + 1))
            if hits := self.walk(term[first:to].tolist(), block, least):
                found.setdefault(p, []).extend(hits)
        for p, hits in found.items():
            words = ids[a[p] : b[p]].tolist()
            there = set(shingles(words, self.size)) | {tuple(words[i : i + k]) for k in range(1, self.size) for i in range(len(words) - k + 1)}
            best = out.setdefault(int(doc[p]), {})
            for item, score in hits:
                own = self.shingles[item]
                share = sum(s in there for s in own) / len(own)
                if share >= self.overlap - 1e-9 and share > best.get(item, (0, 0))[0]:
                    best[item] = (share, score)
        for d, best in out.items():
            for item in [i for i in best if self.answers[i]]:
                words = ids[starts[d] : starts[d] + size[d]].tolist()
                k = len(self.answers[item][0])
                there = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
                if sum(s in there for s in self.answers[item]) < self.overlap * len(self.answers[item]) - 1e-9:
                    del best[item]
        return out


@dataclass
class Indexes:
    terms: dict[str, int]
    parts: list[Index]


def build(items: list[tuple], size: int = 5, overlap: float = 0.8) -> Indexes:
    """items: (item_id, question, answer or None). Items of like length share an index; a passage is twice as long as
    the longest of them may be, and starts anew after half of it, so that any item lies whole in one."""
    parsed = [(i, words(q), words(a)) for i, q, a in items]
    parsed = [x for x in parsed if x[1]]
    terms: dict[str, int] = {}
    for _, q, a in parsed:
        for w in (*q, *a):
            terms.setdefault(w, len(terms))
    df = Counter(terms[w] for _, q, _ in parsed for w in set(q))
    mean = sum(len(q) for _, q, _ in parsed) / max(1, len(parsed))
    spans: dict[int, list[tuple]] = {}
    for x in parsed:
        spans.setdefault(max(16, 1 << (len(x[1]) - 1).bit_length()), []).append(x)
    return Indexes(terms, [Index(group, span, terms, size, overlap, mean, len(parsed), df) for span, group in sorted(spans.items())])


class Reader:
    """Terms of texts, read off their distinct words between ASCII white space, which lower-case and match one by one.

    A word of plain letters, digits and underscores among plain signs is matched by Arrow, any other by ``words``.
    """

    PLAIN = r"^[!-/:-@\[-^`{-~]*(?P<word>[0-9A-Z_a-zÀ-ÖØ-öø-ÿß]+)[!-/:-@\[-^`{-~]*$"

    def __init__(self, terms: dict[str, int]) -> None:
        self.terms = terms
        self.values = pa.array(list(terms), pa.string())

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The term (-1: none) of each word, how many words each text has, and where each was last seen in its text (-1: nowhere)."""
        codes, n, tokens = coded_words(texts)
        parts = pc.extract_regex(tokens, self.PLAIN)
        plain = np.asarray(parts.is_valid())
        lower = pc.utf8_lower(pc.struct_field(parts.filter(pa.array(plain)), "word"))
        others = [[self.terms.get(w, -1) for w in words(x)] for x in tokens.filter(pa.array(~plain)).to_pylist()]
        size = np.ones(len(tokens), np.int64)
        size[~plain] = [len(x) for x in others]
        flat = np.empty(int(size.sum()), np.int64)
        of_plain = np.repeat(plain, size)
        flat[of_plain] = np.asarray(pc.fill_null(pc.index_in(lower, value_set=self.values), -1))
        flat[~of_plain] = [t for x in others for t in x]
        each = size[codes]
        ends = np.cumsum(each)
        ids = flat[np.repeat((np.cumsum(size) - size)[codes] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]
        total = np.concatenate([[0], ends])
        last = np.cumsum(n)
        sizes = total[last] - total[last - n]
        held = np.flatnonzero(ids >= 0)
        own = np.repeat(np.arange(len(sizes)), sizes)[held] * (len(self.terms) + 1) + ids[held]
        order = np.argsort(own, kind="stable")
        same = own[order][1:] == own[order][:-1]
        before = np.full(len(ids), -1, np.int64)
        before[held[order[1:][same]]] = held[order[:-1][same]]
        return ids, sizes, before


def _search(shared, keep: list[str], hit: pa.DataType):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Indexes = shared.value
        reader = Reader(index.terms)
        for whole in batches:
            for batch in slices(whole):
                ids, sizes, before = reader.read(batch.column("text"))
                found = [(part, part.search(ids, sizes, before)) for part in index.parts]
                hits = [[{"item_id": part.item_ids[i], "overlap": o, "score": s} for part, of in found for i, (o, s) in of.get(d, {}).items()] for d in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(hits, pa.list_(hit))], [*keep, "found"])

    return over


def search(docs: DataFrame, items: DataFrame, size: int = 5, overlap: float = 0.8, item_col: str = "item_id", question_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """``docs`` (which has a column text) with ``hits``: item_id, overlap and score of every item that a passage holds.

    A passage holds an item if ``overlap`` of the item's word shingles are in it, and, where items have an answer, as
    many of the answer's are in the document. Words are runs of letters, digits and underscores, lower-cased; an item
    shorter than a shingle is one. Candidates come from the BM25 index; its thresholds let none with that overlap slip.

    The index goes to tasks as a broadcast of bounded size (INDEX_CHARS of items). A larger benchmark is dealt into as
    many parts as it needs, each a further pass of the same scan; documents are never shuffled.

    Null and empty texts hold nothing, null and empty items are in nothing; repeated rows each come back. Empty tables
    are allowed on both sides. Columns of docs called found or hits are replaced.
    """
    own = items.where(F.col(question_col).isNotNull())
    answer = F.col(answer_col) if answer_col else F.lit(None).cast("string")
    own = own.select(F.col(item_col).cast("long").alias("i"), F.col(question_col).alias("q"), answer.alias("a"))
    chars = own.agg(F.sum(F.length("q") + F.coalesce(F.length("a"), F.lit(0)))).first()[0] or 0
    parts = max(1, -(-chars // INDEX_CHARS))
    out = docs.drop("found", "hits").withColumn("hits", F.array().cast("array<struct<item_id:bigint,overlap:double,score:double>>"))
    hit = pa.struct([("item_id", pa.int64()), ("overlap", pa.float64()), ("score", pa.float64())])
    for part in range(parts):
        rows = own.where(F.pmod(F.xxhash64("i", "q"), F.lit(parts)) == part).collect()
        shared = docs.sparkSession.sparkContext.broadcast(build([tuple(r) for r in sorted(rows, key=repr)], size, overlap))
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
        out = out.mapInArrow(_search(shared, out.columns, hit), f"{fields}, found array<struct<item_id:bigint,overlap:double,score:double>>")
        out = out.withColumn("hits", F.concat("hits", "found")).drop("found")
    return out
