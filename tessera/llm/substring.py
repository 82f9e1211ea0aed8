"""Passages that recur, removed word by word. Windows are found through difference-cover anchors.

A difference cover modulo m is a set D such that any difference modulo m is one of two of its members. So if windows
of W words at places i and j agree, some k < m has both i + k and j + k in D modulo m, and the anchors of W - m + 1
words there agree too. Only anchors at cover places are hashed and shuffled, a quarter of all places. An anchor that
occurs again is then extended: the windows around it (at most m) are compared by a digest of their words and counted.
Anchors meet by a fast rolling hash, in which unlike words may agree: that costs work, but removes nothing.
"""

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.arrow import binaries, flat, slices, sorted_runs
from tessera.sources.scratch import written

#: Perfect difference covers by their modulus.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}
#: Fixed odd multipliers of the rolling hash, for bytes in a word and words in an anchor.
BYTES, WORDS = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: A window's digest: 64 bits to meet by and 32 more.
DIGEST = np.dtype([("p", "<u8"), ("s", "<u4")])


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i modulo 2 ** 64 for i < n, and the inverses."""
    up = np.full(n, base, np.uint64)
    down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(base, 1 << max(12, int(n).bit_length()))
    return up[:n], down[:n]


class Words:
    """The words of a slice of texts: a hash, the text of each, its place there, and the number of words by text."""

    def __init__(self, column: pa.Array) -> None:
        self.data, offsets = flat(column)
        data = self.data
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        head = np.zeros(len(data) + 1, bool)
        head[offsets] = True
        inside = ~blank
        self.start = np.flatnonzero(inside & (head[:-1] | np.concatenate([[True], blank[:-1]])[: len(data)]))
        self.size = np.flatnonzero(inside & (head[1:] | np.concatenate([blank[1:], [True]])[: len(data)])) + 1 - self.start
        self.text = np.searchsorted(offsets, self.start, "right") - 1
        self.n = np.bincount(self.text, minlength=len(column))
        first = np.concatenate([[0], np.cumsum(self.n)])
        self.first = first[:-1]
        self.place = np.arange(len(self.start)) - first[self.text]

    def anchors(self, at: np.ndarray, size: int) -> np.ndarray:
        """Rolling hashes of the ``size`` words from each of the words ``at`` on, which must fit their texts."""
        up, down = _power(BYTES, len(self.data) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(self.data.astype(np.uint64) + np.uint64(BYTES)) * up[: len(self.data)], dtype=np.uint64)])
        words = _mix((total[self.start + self.size] - total[self.start]) * down[self.start] + self.size.astype(np.uint64))
        up, down = _power(WORDS, len(words) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)], dtype=np.uint64)])
        return _mix((total[at + size] - total[at]) * down[at])

    def digests(self, at: np.ndarray, size: int) -> np.ndarray:
        """BLAKE2b digests of the ``size`` words from each of the words ``at`` on, joined by a space."""
        ends = np.cumsum(self.size + 1)
        begins = ends - self.size - 1
        joined = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
        held = np.ones(len(joined), bool)
        held[ends - 1] = False
        joined[held] = self.data[np.repeat(self.start - (begins - np.arange(len(begins))), self.size) + np.arange(int(self.size.sum()))]
        whole = memoryview(joined.tobytes())
        blake, n = hashlib.blake2b, DIGEST.itemsize
        spans = zip(begins[at].tolist(), (ends[at + size - 1] - 1).tolist(), strict=True)
        return np.frombuffer(b"".join([blake(whole[a:b], digest_size=n).digest() for a, b in spans]), DIGEST)


def _emit(hashes: np.ndarray, second: np.ndarray, rows: np.ndarray, twins: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Rows (p, x, row, row2) for a shuffle by p: of hashes that occur once here, and of one occurrence of each other hash,
    p is the hash; all occurrences of the latter are known to recur and go to any task (p of their place).
    x: the kind (0, 1 for one known to recur that stands for others, 2 for those others), 30 bits of the place, 32 of the second hash."""
    order = np.argsort(hashes, kind="stable")
    h, s = hashes[order], second[order]
    cut = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
    group = np.cumsum(cut) - 1
    size = np.bincount(group, minlength=int(cut.sum()))
    # hashes that agree here in full; where second hashes differ too, all go by the hash
    same = np.logical_and.reduceat(np.concatenate([[True], s[1:] == s[:-1]]) | cut, np.flatnonzero(cut)) if len(h) else np.zeros(0, bool)
    # back in the order of places, in which neighbours share their row's number and so compress
    known, first = np.empty(len(h), bool), np.empty(len(h), bool)
    known[order] = ((size > 1) & same)[group]
    first[order] = cut
    at = place.astype(np.uint64)
    x = (second << np.uint64(32)) | (at << np.uint64(2))
    sends = np.flatnonzero(~known | first)
    spread = np.flatnonzero(known)
    p = np.concatenate([hashes[sends], _mix(rows[spread].view(np.uint64) + at[spread])])
    x = np.concatenate([x[sends] | known[sends].astype(np.uint64), x[spread] | np.uint64(2)])
    row, twin = (np.concatenate([r[sends], r[spread]]) for r in (rows, twins))
    return pa.RecordBatch.from_arrays([pa.array(p.view(np.int64)), pa.array(x.view(np.int64)), pa.array(row), pa.array(twin)], ["p", "x", "row", "row2"])


#: Bytes of text hashed at a time, and hashes that are settled among themselves before they are sent.
SLICE, HELD = 1 << 19, 400_000


def _emitted(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Rows of _emit for (hashes, second hashes, both numbers of rows, places), about HELD at a time."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= HELD:
            yield _emit(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held, n = [], 0
    if held:
        yield _emit(*(np.concatenate(x) for x in zip(*held, strict=True)))


_ROWS = "p long, x long, row long, row2 long"


def _anchors(window: int, modulus: int):
    size = window - modulus + 1
    cover = np.zeros(modulus, bool)
    cover[list(COVERS[modulus])] = True

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in (x for whole in batches for x in slices(whole, most=SLICE)):
            w = Words(batch.column("text"))
            at = np.flatnonzero(cover[w.place % modulus] & (w.place + size <= w.n[w.text]) & (w.n[w.text] >= window))
            yield w.anchors(at, size), np.zeros(len(at), np.uint64), *(np.asarray(batch.column(c))[w.text[at]] for c in ("row", "row2")), w.place[at]

    return lambda batches: _emitted(hashes(batches))


def _extended(window: int, modulus: int):
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in (x for whole in batches for x in slices(whole, most=SLICE)):
            w = Words(batch.column("text"))
            places = batch.column("places")
            anchors = np.asarray(places.flatten(), np.int64)
            text = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(places.offsets)))
            # every window that holds the anchor: it starts up to modulus - 1 words before
            spread = np.zeros(len(w.place) + modulus + 1, np.int64)
            at = w.first[text] + anchors
            np.add.at(spread, np.maximum(at - modulus + 1, w.first[text]), 1)
            np.add.at(spread, at + 1, -1)
            starts = np.flatnonzero(np.cumsum(spread)[: len(w.place)] > 0)
            starts = starts[w.place[starts] + window <= w.n[w.text[starts]]]
            digest = w.digests(starts, window)
            yield digest["p"].astype(np.uint64), digest["s"].astype(np.uint64), *(np.asarray(batch.column(c))[w.text[starts]] for c in ("row", "row2")), w.place[starts]

    return lambda batches: _emitted(hashes(batches))


def _recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, row2, place of what recurs, from rows of _emit that are sorted by p."""
    for batch in sorted_runs(batches, "p"):
        p, x, row, twin = (np.asarray(batch.column(c)) for c in ("p", "x", "row", "row2"))
        x = x.view(np.uint64)
        kind = x & np.uint64(3)
        place = ((x >> np.uint64(2)) & np.uint64((1 << 30) - 1)).astype(np.int32)
        counted = np.flatnonzero(kind < 2)
        h, s = p[counted], (x >> np.uint64(32))[counted]
        order = np.lexsort((s, h))
        counted, h, s = counted[order], h[order], s[order]
        cut = np.concatenate([[True], (h[1:] != h[:-1]) | (s[1:] != s[:-1])]) if len(h) else np.zeros(0, bool)
        size = np.bincount(np.cumsum(cut) - 1, minlength=int(cut.sum()))[np.cumsum(cut) - 1] if len(h) else np.zeros(0, int)
        # one that is known to recur stands for places that are on their way as kind 2
        new = counted[(size > 1) & (kind[counted] == 0)]
        out = np.concatenate([np.flatnonzero(kind == 2), new])
        yield pa.RecordBatch.from_arrays([pa.array(row[out]), pa.array(twin[out]), pa.array(place[out])], ["row", "row2", "place"])


def _recur(emitted: DataFrame) -> DataFrame:
    """row, row2, places: sorted places of each row that recur."""
    met = emitted.repartition("p").sortWithinPartitions("p").mapInArrow(_recurring, "row long, row2 long, place int")
    return met.groupBy("row", "row2").agg(F.sort_array(F.collect_list("place")).alias("places"))


def _remove(window: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                n, removed, kept = [], [], []
                for text, places in zip(binaries(batch.column("text")), batch.column("places"), strict=True):
                    words = (text or b"").split()
                    n.append(len(words))
                    if not places.is_valid:
                        removed.append(0)
                        kept.append(b" ".join(words))
                        continue
                    at = np.asarray(places.values)
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + window, -1)
                    stays = np.cumsum(cover)[:-1] == 0
                    removed.append(len(words) - int(stays.sum()))
                    kept.append(b" ".join([words[i] for i in np.flatnonzero(stays).tolist()]))
                sha = [hashlib.sha256(x).hexdigest() for x in kept]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array([x.decode() for x in kept]), pa.array(sha)], ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return over


def dedup_substrings(docs: DataFrame, window: int = 35, modulus: int = 21, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept (words that stay, joined by a space), kept_sha256.

    Words lie between ASCII white space. A word goes if a window of ``window`` words covers it whose words also start
    anywhere else, in the same document or another. Windows are compared by 96 bits of a cryptographic digest of their
    words, so unlike windows agree by chance alone: about once in a thousand runs over 1e13 windows.
    Rows are told apart by 128 bits drawn from the SHA-256 digest of their text, with their id.

    What recurs among HELD hashes of a task is settled there: such a hash goes to the shuffle once, and the places of
    hashes known to recur spread evenly over tasks, so a passage that a third of all documents hold is no hot key.
    Places of recurring anchors are written to the shared folder, which frees the anchors' shuffle. Documents are dealt
    out once by a hash of the row, and both later steps read that one exchange.

    Null texts have no words; repeated rows are documents of their own, each the other's copy; a null doc_id takes
    part. An empty table gives an empty result; further columns are ignored. A text may have up to 2 ** 30 words.
    """
    if modulus not in COVERS or window - modulus < 1:
        raise ValueError(f"the modulus must be one of {sorted(COVERS)} and less than the window")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    base = base.withColumns({"row": F.xxhash64("doc_id", digest), "row2": F.xxhash64(F.lit(1), "doc_id", digest)})
    anchors, _ = written(_recur(base.select("row", "row2", "text").mapInArrow(_anchors(window, modulus), _ROWS)), "anchors")
    dealt = base.repartition("row", "row2")
    # both steps take the same columns of the dealt documents, so that one exchange serves them
    near = dealt.join(anchors, ["row", "row2"]).select("row", "row2", "doc_id", "text", "places").mapInArrow(_extended(window, modulus), _ROWS)
    starts = _recur(near)
    out = dealt.join(starts, ["row", "row2"], "left").select("doc_id", "text", "places")
    return out.mapInArrow(_remove(window), "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
