"""Near duplicates by SimHash fingerprints, found through Golay-code fuzzy hashing.

A 64-bit fingerprint falls into three segments (23, 23 and 18 bits; the last is padded with zeros). The perfect
binary Golay code has a codeword within three bits of any 23-bit word. A word's *near* set is its nearest codeword
and, where that is three bits off, the five codewords four bits off (one or six in all). Two facts carry the search:

* words that differ in one bit: the nearest codeword of either is in the near set of the other;
* words that differ in two bits: their near sets share a codeword.

Of at most four differing bits, either a segment holds none, and then another one at most two, or the segments hold one,
one and at most two. So fingerprints meet in

* a key of one whole segment and a near codeword of another one, or
* a key of a codeword of each segment: of two segments nearest here and near there, of the third near in both.

So a key has 30 bits or more that tell fingerprints apart, and unlike ones seldom meet: a fingerprint has up to 127 keys,
and of n random ones about n * n / 3.8 million pairs are compared. Keys of two codewords alone would be fewer, yet those
of 23 and 18 bits make two hundred times as many pairs.

All keys of a pair's meeting are verified on the fingerprints, so links are exact.
"""

from collections.abc import Iterator
from functools import cache
from itertools import permutations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.arrow import binaries, slices, sorted_runs
from tessera.llm.components import connected
from tessera.sources.scratch import written

SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: The generator polynomial of the binary Golay code.
GENERATOR = 0b101011100011
#: Links an executor's task holds before it hands them on.
HELD = 200_000


def fingerprint(text: bytes | None, words: int = 4, seed: int = 42) -> int:
    """The SimHash of a text's shingles (XXH64 of each, repeats included); 0 for a text without words."""
    parts = (text or b"").lower().split()
    if not parts:
        return 0
    whole = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(whole, seed)
    size = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    ends = np.cumsum(size) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
    hashes = np.array([digest(whole[a:b], seed) for a, b in spans], np.uint64)
    counts = np.zeros((8, 8), np.int64)  # by bit of a byte, by byte
    for bit in range(8):
        ones = (hashes >> np.uint64(bit)) & np.uint64(0x0101010101010101)
        whole_rows = len(ones) // 255 * 255  # sums of 255 words' bits fit a byte each
        for part in (ones[:whole_rows].reshape(-1, 255).sum(1), ones[whole_rows:].sum(keepdims=True)):
            counts[bit] += part.view(np.uint8).reshape(-1, 8).sum(0, dtype=np.int64)
    set_bits = (counts * 2 > len(hashes)).T.reshape(64)
    return int(np.packbits(set_bits, bitorder="little").view(np.uint64)[0])


@cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The remainder of every 23-bit word's halves, and for each of 2,048 remainders the errors to near codewords (first the nearest; -1: none)."""
    powers = []
    r = 1
    for _ in range(23):
        powers.append(r)
        r <<= 1
        if r >> 11:
            r ^= GENERATOR
    of = lambda bits, at: np.bitwise_xor.reduce([np.where(np.arange(1 << bits) >> i & 1, powers[at + i], 0) for i in range(bits)])
    low, high = of(12, 0), of(11, 12)
    near = np.full((2048, 6), -1, np.int64)
    n = np.zeros(2048, int)
    bits = [1 << i for i in range(23)]
    layer = [(0, 0, -1)]
    for weight in range(5):
        for e, s, _ in layer:
            if weight < 4 or n[s] and bin(int(near[s, 0])).count("1") == 3:
                near[s, n[s]] = e
                n[s] += 1
        layer = [(e | bits[i], s ^ powers[i], i) for e, s, last in layer for i in range(last + 1, 23)]
    return low, high, near


def near_codewords(x: np.ndarray) -> np.ndarray:
    """For 23-bit words, the 12-bit indices of near codewords, the nearest first; -1 where there are fewer than six."""
    low, high, near = _golay()
    errors = near[low[x & 0xFFF] ^ high[x >> 12]]
    return np.where(errors < 0, -1, (x[:, None] ^ errors) >> 11)  # the code is systematic in its upper bits


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All meeting keys of fingerprints (uint64), and the index of the fingerprint that each belongs to."""
    words = [((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    near = [near_codewords(w) for w in words]
    rows = np.arange(len(fps))
    out, owner = [], []

    def emit(scheme: int, left: np.ndarray, right: np.ndarray) -> None:
        """The keys of both parts that aren't negative, several a row."""
        held = (left >= 0) & (right >= 0)
        out.append(((scheme << 40) | left | right)[held])
        owner.append(np.broadcast_to(rows[:, None], held.shape)[held])

    for scheme, (i, j) in enumerate(permutations(range(3), 2)):
        emit(scheme, words[i][:, None] << 12, near[j])
    # every choice of codewords with the nearest of some segment: what the two segments with one differing bit need
    a, b, c = np.array([x for x in product(range(6), repeat=3) if 0 in x]).T
    first, second = near[0][:, a], near[1][:, b]
    emit(6, np.where((first < 0) | (second < 0), -1, (first << 24) | (second << 12)), near[2][:, c])
    return np.concatenate(out), np.concatenate(owner)


def _fingerprints(words: int, seed: int, extra: list[str]):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                fp = np.array([fingerprint(t, words, seed) for t in binaries(batch.column("text"))], np.uint64)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in extra), pa.array(fp.view(np.int64))], [*extra, "fp"])

    return over


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of every document; null texts count as empty."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(_fingerprints(words, seed, ["doc_id"]), f"doc_id {src.schema['doc_id'].dataType.simpleString()}, fp long")


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = np.asarray(batch.column("fp")).view(np.uint64)
        for at in range(0, len(fps), 4096):
            part = fps[at : at + 4096]
            key, owner = keys(part)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[owner].view(np.int64))], ["key", "fp"])


class Forest:
    """Union-find that hands on an edge to each root."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        r = x
        while (p := up.get(r, r)) != r:
            r = p
        while (p := up.get(x, x)) != r and p != x:
            up[x], x = r, p
        return r

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.up.setdefault(min(a, b), min(a, b))

    def drain(self) -> pa.RecordBatch:
        pairs = np.array([(x, self.root(x)) for x in list(self.up)], np.int64).reshape(-1, 2)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        self.up.clear()
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _explore(fps: np.ndarray, bits: int, forest: Forest) -> None:
    """Links a bucket's fingerprints. Each one reached leaves the rest at once, so a dense group costs about one pass."""
    rest = np.unique(fps)
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            x = frontier.pop()
            close = np.bitwise_count(rest ^ x) <= bits
            if close.any():
                found = rest[close]
                rest = rest[~close]
                for y in found.tolist():
                    forest.join(int(x.view(np.int64)), int(np.uint64(y).view(np.int64)))
                frontier.extend(found)


def _link(bits: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in sorted_runs(batches, "key"):
            key, fps = np.asarray(batch.column("key")), np.asarray(batch.column("fp")).view(np.uint64)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
            size = np.diff(edges)
            two = edges[:-1][size == 2]
            hit = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= bits]
            for a, b in zip(fps[hit].view(np.int64).tolist(), fps[hit + 1].view(np.int64).tolist(), strict=True):
                forest.join(a, b)
            for i in np.flatnonzero(size > 2).tolist():
                _explore(fps[edges[i] : edges[i + 1]], bits, forest)
            if len(forest.up) > HELD:
                yield forest.drain()
        yield forest.drain()

    return over


def links(distinct: DataFrame, bits: int = 4) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp): a spanning forest of all links in each task."""
    if not 0 <= bits <= 4:
        raise ValueError("these keys find up to 4 differing bits")
    keyed = distinct.select("fp").mapInArrow(_explode, "key long, fp long")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_link(bits), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 4, seed: int = 42, bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id: documents whose fingerprints link, directly or through others.

    component_id is the smallest doc_id that can be reached, itself included. Copies meet in one fingerprint before
    the search, so their number doesn't matter to it. Null and empty texts have fingerprint 0 and link as any other.
    Repeated rows each come back. A null doc_id takes part, yet is never a component_id unless the component has no
    other. An empty table gives an empty result. Further columns are ignored.
    """
    stored, _ = written(fingerprints(docs, words, seed, id_col, text_col), "simhash-prints")
    classes = stored.groupBy("fp").agg(F.min("doc_id").alias("least"))
    labels = connected(links(classes, bits))
    of = classes.join(labels, classes.fp == labels.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    roots = of.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of.join(roots, "root").select("fp", "component_id")
    return stored.join(named, "fp").select("doc_id", "fp", "component_id")
