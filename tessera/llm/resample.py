"""Importance resampling towards a target: hashed runs of words, gains by bucket, Gumbel noise by document.

Identical texts are collapsed by grouping the full text, so a text is split, hashed and weighed once however many
documents hold it; its counts are multiplied by how many do. Weights are joined back by a digest of the text before
the noise, which is a document's own. The highest scores are ranked by ranges, without a task that sorts all rows.
"""

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.arrow import binaries, coded_words, flat, slices
from tessera.operators.scan import ranked
from tessera.sources.scratch import written

#: A-Z to lower case; what is neither a letter, a digit nor beyond ASCII parts words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Words with more bytes than this extend a checksum byte by byte instead of by table.
LONG = 64


def _zeros() -> np.ndarray:
    """By number of bytes n, byte of the register and its value: the CRC-32 register after n further zero bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    out = np.empty((LONG + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, LONG + 1):
        out[n] = step[out[n - 1] & 255] ^ (out[n - 1] >> 8)
    return out


_TABLE = _zeros()


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The words of a slice of texts: the number of each in order, how many each text has, and the distinct ones."""
    data, offsets = flat(column)
    folded = data.tobytes().translate(_FOLD)
    plain = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(folded))
    codes, size, distinct = coded_words(plain)
    return codes, size, binaries(distinct)


def checksums(codes: np.ndarray, size: np.ndarray, distinct: list[bytes], longest: int) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of every run of 1 to ``longest`` consecutive words of a text, joined by one space, and the text of each.

    The checksum of a run is that of the run without its last word, carried over the bytes of a space and that word,
    xor the checksum of these bytes, so no run is spelt out.
    """
    alone = np.fromiter((zlib.crc32(w) for w in distinct), np.uint32, len(distinct))
    spaced = np.fromiter((zlib.crc32(b" " + w) for w in distinct), np.uint32, len(distinct))
    length = np.fromiter((len(w) + 1 for w in distinct), np.int64, len(distinct))
    text = np.repeat(np.arange(len(size)), size)
    now, end = alone[codes] if len(codes) else np.zeros(0, np.uint32), np.arange(len(codes))
    sums, texts = [now], [text]
    for _ in range(1, longest):
        # runs that go on: the next word is of the same text
        on = end + 1 < len(codes)
        on[on] = text[end[on] + 1] == text[end[on]]
        now, end = now[on], end[on] + 1
        add = codes[end]
        n = length[add]
        short = np.minimum(n, LONG)
        carried = _TABLE[short, 0, now & 255] ^ _TABLE[short, 1, (now >> 8) & 255] ^ _TABLE[short, 2, (now >> 16) & 255] ^ _TABLE[short, 3, now >> 24]
        nxt = carried ^ spaced[add]
        for i in np.flatnonzero(n > LONG).tolist():
            nxt[i] = zlib.crc32(b" " + distinct[add[i]], int(now[i]))
        now = nxt
        sums.append(now)
        texts.append(text[end])
    return np.concatenate(sums), np.concatenate(texts)


def _counts(buckets: int, longest: int):
    """bucket, n: how often features of each bucket occur in all texts of a task, a text counting n times."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in slices(whole):
                crc, text = checksums(*words(batch.column("text")), longest)
                times = np.asarray(batch.column("n"), np.int64)[text]
                order = np.argsort(crc % buckets, kind="stable")
                at, start = np.unique((crc % buckets)[order], return_index=True)
                if len(at):
                    total[at] += np.add.reduceat(times[order], start)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], ["bucket", "n"])

    return over


def bucket_counts(texts: DataFrame, buckets: int, longest: int) -> np.ndarray:
    """Features by bucket of all rows (text, n). ``buckets`` numbers reach the driver."""
    out = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(_counts(buckets, longest), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of how much likelier a bucket is in the target, each bucket with one more feature than it has."""
    size, k = (float(source.sum()), float(target.sum())), len(source)
    return np.array([math.floor(1000 * math.log((t + 1) * (size[0] + k) / ((s + 1) * (size[1] + k)))) for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist(), strict=True)], np.int64)


def _weigh(shared, longest: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain: np.ndarray = shared.value
        for whole in batches:
            for batch in slices(whole):
                codes, size, distinct = words(batch.column("text"))
                crc, text = checksums(codes, size, distinct, longest)
                order = np.argsort(text, kind="stable")
                total = np.concatenate([[0], np.cumsum(gain[crc[order] % len(gain)])])
                n = np.bincount(text, minlength=len(size))
                end = np.cumsum(n)
                weight = (total[end] - total[end - n]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(size.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(weight.astype(np.int64))], ["key", "n_words", "n_features", "weight"])

    return over


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def noise(doc_id: Column, salt: str) -> Column:
    """floor(-1000 * ln(-ln(u))), u from the first 8 hex digits of the sha256 of salt and id; null for a null id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(salt), doc_id.cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (25, 100), least_words: int = 20, buckets: int = 10_000, longest: int = 2, salt: str = "7:", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_words, n_features, weight, score, rank of every row: those with a rank are drawn, best first.

    Of the rows with an id and at least ``least_words`` words the floor of ``share`` is drawn by highest score, ties to
    the smaller id. Texts that are null, empty or without a word have no features and weight 0. A null id has neither
    noise nor score and isn't drawn. Repeated rows are drawn each by itself, though equal ids have equal noise. Empty
    tables on either side give whole results. Further columns are ignored. Sums of gains must fit 64 bits.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    once, _ = written(docs.select(text.alias("text")).groupBy("text").agg(F.count("*").alias("n")), "texts-once")
    goal = target.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).groupBy("text").agg(F.count("*").alias("n"))
    gain = gains(bucket_counts(once, buckets, longest), bucket_counts(goal, buckets, longest))
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    weighed = once.select(digest(F.col("text")).alias("key"), "text").mapInArrow(_weigh(shared, longest), "key binary, n_words long, n_features long, weight long")
    rows = docs.select(F.col(id_col).alias("_id"), digest(text).alias("key")).join(weighed, "key").drop("key")
    scored, _ = written(rows.withColumn("score", F.col("weight") + noise(F.col("_id"), salt)), "resample-scores")
    able = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    drawn = scored.where(able).count() * share[0] // share[1]
    place = F.when(F.col("rank") <= drawn, F.col("rank"))
    best = ranked(scored.where(able), "score", ("_id", "weight", "n_features"), descending=True).withColumn("rank", place)
    out = best.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))
    return out.withColumnRenamed("_id", id_col)
