"""Helpers for functions over Arrow batches."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are taken in slices of about so many bytes, so that memory doesn't follow the size of Arrow batches.
SLICE = 2 << 20


def slices(batch: pa.RecordBatch, text: str = "text", most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of whole rows with about ``most`` bytes of text each."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
    at = 0
    ends = np.cumsum(size)
    while at < len(size):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def binaries(column: pa.Array) -> list[bytes | None]:
    """Each text as UTF-8 bytes, without decoding them."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a slice of texts (null: empty) and the offset of each text, with the end."""
    texts = binaries(column)
    size = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
    return np.frombuffer(b"".join(t for t in texts if t), np.uint8), np.concatenate([[0], np.cumsum(size)])


def coded_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The words between ASCII white space of a slice of texts (null: none): the number of each word in the order of
    the texts, how many words each text has, and the distinct words that the numbers stand for."""
    split = pc.ascii_split_whitespace(pc.fill_null(column, ""))
    pieces = split.flatten()
    size = np.diff(np.asarray(split.offsets))
    held = np.asarray(pc.not_equal(pc.binary_length(pieces), 0))  # white space at either end leaves an empty piece
    if not held.all():
        text = np.repeat(np.arange(len(size)), size)
        size = np.bincount(text[held], minlength=len(size))
        pieces = pieces.filter(pa.array(held))
    coded = pieces.dictionary_encode()
    return np.asarray(coded.indices), size, coded.dictionary


def sorted_runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.RecordBatch]:
    """Batches sorted by ``keys``, cut anew so that equal keys are never in two of them."""
    left: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1].as_py() for k in keys]
        same = np.ones(batch.num_rows, bool)
        for k, v in zip(keys, last, strict=True):
            same &= np.asarray(batch.column(k)) == v
        cut = batch.num_rows - int(same.sum())
        first = left and all(left[0].column(k)[0].as_py() == v for k, v in zip(keys, last, strict=True))
        if cut == 0 and (first or not left):
            left.append(batch)
            continue
        yield pa.Table.from_batches([*left, batch.slice(0, cut)]).combine_chunks().to_batches()[0]
        left = [batch.slice(cut)]
    if left:
        yield pa.Table.from_batches(left).combine_chunks().to_batches()[0]
