"""Token ids in binary files: frequency-ranked ids in a byte-aligned variable-length code with separate control bytes.

File format, version 1. A dataset is a folder with two Parquet tables, written by Spark so that tasks commit whole:

* ``ranks``: rank, id. Ranks go by falling frequency over all documents, ties by rising id.
* ``blocks``: shard, block, at, n_tokens, doc_ids, payload. Blocks in (shard, block) order hold the documents in order.
  ``at`` counts the ids of a shard before the block. The payload is the magic, the numbers of documents and of ids and
  the CRC-32 of what follows as little-endian unsigned 32-bit integers, then two coded lists: ids a document, and ranks.

A coded list of unsigned 32-bit integers is its control bytes, then its data bytes. A control byte holds four lengths
less one in two bits each, the first in the lowest; each integer has so many little-endian bytes. Decoding looks
control bytes up in a table of 256 rows that say which of 16 bytes are there.
"""

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.arrow import binaries, coded_words, slices
from tessera.sources.scratch import new_path, remove, shuffles_dropped

MAGIC = b"TSR1"
#: Ids a block holds before it is closed; a document is never split.
BLOCK = 1 << 17
#: Words whose ids a Python worker remembers, and bytes of text that it encodes at a time.
WORDS, SLICE = 800_000, 4 << 20
BLOCKS = "shard int, block int, at long, n_tokens long, doc_ids array<bigint>, payload binary"

_present = (np.arange(4) <= ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3)[:, :, None]).reshape(256, 16)


def encode_list(values: np.ndarray) -> bytes:
    """Control bytes, then data bytes."""
    n = len(values)
    x = np.zeros(-(-n // 4) * 4, "<u4")
    x[:n] = values
    extra = (x > 0xFF).astype(np.uint8) + (x > 0xFFFF) + (x > 0xFFFFFF)
    control = (extra.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    held = _present[control].reshape(-1, 4)
    held[n:] = False
    return control.tobytes() + x.view(np.uint8).reshape(-1, 4)[held].tobytes()


def decode_list(data: bytes | memoryview, n: int) -> tuple[np.ndarray, int]:
    """n integers, and how many bytes they took."""
    k = -(-n // 4)
    held = _present[np.frombuffer(data, np.uint8, k)].reshape(-1, 4)
    held[n:] = False
    size = int(held.sum())
    out = np.zeros((4 * k, 4), np.uint8)
    out[held] = np.frombuffer(data, np.uint8, size, k)
    return out.view("<u4").reshape(-1)[:n], k + size


def pack(lengths: np.ndarray, values: np.ndarray) -> bytes:
    body = encode_list(lengths) + encode_list(values)
    return MAGIC + np.array([len(lengths), len(values), zlib.crc32(body)], "<u4").tobytes() + body


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids a document, and all values of the block."""
    docs, n, crc = np.frombuffer(payload, "<u4", 3, 4).tolist()
    body = memoryview(payload)[16:]
    if payload[:4] != MAGIC or zlib.crc32(body) != crc:
        raise ValueError("not a block of this format, or damaged")
    lengths, used = decode_list(body, docs)
    return lengths, decode_list(body[used:], n)[0]


#: Fixed parts of definitions whose tokenizers see words between ASCII white space one by one.
WORD_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
WORD_END = "</w>"


def splits_by_word(definition: str) -> bool:
    """Whether a definition folds case, drops white space before it splits, and parts letters from all else: then no
    token, normal form or special token spans two words, so texts may be encoded word by word."""
    d = json.loads(definition)
    steps = (d.get("pre_tokenizer") or {}).get("pretokenizers") or []
    model = d["model"]
    return (
        (d.get("normalizer") or {}).get("normalizers") == WORD_NORMALIZERS
        and [s["type"] for s in steps] == ["Split", "ByteLevel"]
        and (steps[0]["pattern"], steps[0]["behavior"], steps[0]["invert"]) == ({"Regex": WORD_PATTERN}, "Removed", True)
        and not steps[1]["add_prefix_space"]
        and not steps[1]["use_regex"]
        and (model["type"], model.get("end_of_word_suffix"), model.get("dropout"), model.get("unk_token")) == ("BPE", WORD_END, None, None)
        and not any(d.get(k) for k in ("truncation", "padding"))
        and not any(c.isspace() for t in d.get("added_tokens", []) for c in t["content"])
    )


def _runs(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` that start at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    return ids[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Encoder:
    """A tokenizer of the ``tokenizers`` library.

    by_word: texts are encoded by their distinct words, each once (see splits_by_word). A word of plain letters with a
    tail of plain signs is two pieces; its letters go to the same model, many words in a call, without the costly
    normal forms, which leave them as they are.
    """

    #: Letters that lower-case and compose to themselves, one for one, and signs that stay as they are.
    PLAIN = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿß]+)(?P<signs>[.,;:!?*#$%&|]*)$"

    def __init__(self, definition: str, by_word: bool) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(definition)
        self.by_word = by_word
        if by_word:
            if not splits_by_word(definition):
                raise ValueError("this tokenizer doesn't see words one by one")
            self.letters = Tokenizer(self.tokenizer.model)
            self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends_word[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
            self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _each(self, texts: list[str], by=None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has."""
        found = []
        for at in range(0, len(texts), 20_000):
            found += [e.ids for e in (by or self.tokenizer).encode_batch_fast(texts[at : at + 20_000], add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))

    def _of_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As _each, for words of plain lower-case letters, a thousand in one text."""
        ids, _ = self._each([" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)], self.letters)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):
            raise AssertionError("words and their ends differ in number")
        return ids, np.diff(ends, prepend=0)

    def _learn(self, words: pa.Array) -> None:
        parts = pc.extract_regex(words, self.PLAIN)
        plain = np.asarray(parts.is_valid())
        whole = parts.filter(pa.array(plain))
        letters = pc.utf8_lower(pc.struct_field(whole, "letters")).dictionary_encode()
        signs = pc.struct_field(whole, "signs").dictionary_encode()
        pieces = [self._of_letters(letters.dictionary.to_pylist()), self._each(signs.dictionary.to_pylist()), self._each(words.filter(pa.array(~plain)).to_pylist())]
        ids, sizes = (np.concatenate(x) for x in zip(*pieces, strict=True))
        starts = np.cumsum(sizes) - sizes
        # the pieces of each word: letters and signs, or the whole word and nothing
        first = np.empty(len(words), np.int64)
        first[plain] = np.asarray(letters.indices)
        first[~plain] = len(letters.dictionary) + len(signs.dictionary) + np.arange(len(words) - int(plain.sum()))
        second = np.full(len(words), len(sizes))
        second[plain] = len(letters.dictionary) + np.asarray(signs.indices)
        of = np.stack([first, second], 1).reshape(-1)
        starts, sizes = np.append(starts, 0), np.append(sizes, 0)
        new = _runs(ids, starts[of], sizes[of])
        sizes = sizes[of].reshape(-1, 2).sum(1)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, new])

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty), and how many each has."""
        if not self.by_word:
            return self._each(pc.fill_null(texts, "").to_pylist())
        codes, n, words = coded_words(texts)
        keys = binaries(words)
        number = np.fromiter(map(self.known.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(number < 0)
        if len(new):
            if self.known and len(self.known) + len(new) > WORDS:
                self._forget()
                new = np.arange(len(keys))
            number[new] = np.arange(len(self.known), len(self.known) + len(new))
            self._learn(words.take(pa.array(new)))
            self.known.update(zip([keys[i] for i in new.tolist()], number[new].tolist(), strict=True))
        of = number[codes]
        sizes = self.sizes[of]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(n)
        return _runs(self.ids, self.starts[of], sizes), total[ends] - total[ends - n]

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        ids, sizes = self.column(pa.array(texts, pa.binary()).cast(pa.string()))
        return [x.astype("<u4").tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1])] if len(sizes) else []


@lru_cache(maxsize=1)
def _encoder(definition: str, by_word: bool) -> Encoder:
    """One encoder a Python worker, which keeps the words that it knows from task to task."""
    return Encoder(definition, by_word)


def _width(vocabulary: int, end: int) -> str:
    return "<u2" if max(vocabulary, end + 1) <= 1 << 16 else "<u4"


def _tokenise(definition, by_word: bool, end: int):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value, by_word)
        shard, block, at, n = TaskContext.get().partitionId(), 0, 0, 0
        width = _width(encoder.tokenizer.get_vocab_size(), end)
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def close() -> pa.RecordBatch:
            nonlocal block, at, n
            doc_ids, sizes, ids = zip(*held, strict=True)
            doc_ids = pa.concat_arrays(doc_ids)
            one = pa.array([0, len(doc_ids)], pa.int32())
            sizes = pa.ListArray.from_arrays(one, pa.array(np.concatenate(sizes), pa.int32()))
            row = [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([at]), pa.array([n]), pa.ListArray.from_arrays(one, doc_ids), pa.array([np.concatenate(ids).tobytes()], pa.binary()), sizes]
            block, at, n = block + 1, at + n, 0
            held.clear()
            return pa.RecordBatch.from_arrays(row, ["shard", "block", "at", "n_tokens", "doc_ids", "payload", "sizes"])

        for batch in (x for whole in batches for x in slices(whole, most=SLICE)):
            ids, sizes = encoder.column(batch.column("text"))
            ids = np.insert(ids, np.cumsum(sizes), end).astype(width)
            sizes = sizes + 1
            ends, first = np.cumsum(sizes), 0
            while first < len(sizes):
                before = int(ends[first - 1]) if first else 0
                to = min(int(np.searchsorted(ends, before + BLOCK - n)) + 1, len(sizes))
                held.append((batch.column("doc_id").slice(first, to - first), sizes[first:to], ids[before : ends[to - 1]]))
                n, first = n + int(ends[to - 1]) - before, to
                if n >= BLOCK:
                    yield close()
        if held:
            yield close()

    return over


def _count(width: str):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for payload in batch.column("payload").to_pylist():
                n = np.bincount(np.frombuffer(payload, width))
                if len(n) > len(total):
                    total = np.concatenate([total, np.zeros(len(n) - len(total), np.int64)])
                total[: len(n)] += n
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    return over


def _rank(rank_of, width: str):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = rank_of.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids = np.frombuffer(row.column("payload")[0].as_py(), width)
                sizes = np.asarray(row.column("sizes")[0].values, np.uint32)
                coded = pa.array([pack(sizes, ranks[ids])], pa.binary())
                yield pa.RecordBatch.from_arrays([*row.columns[:5], coded], [*row.schema.names[:5], "payload"])

    return over


def _read(id_of):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_by_rank = id_of.value
        for batch in batches:
            for i in range(batch.num_rows):
                lengths, ranks = unpack(batch.column("payload")[i].as_py())
                ids = ids_by_rank[ranks].astype("<u4")
                n = lengths.astype(np.int64)
                ends = np.cumsum(n)
                starts = ends - n
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                shard = pa.array(np.full(len(n), batch.column("shard")[i].as_py(), np.int32))
                at = batch.column("at")[i].as_py()
                yield pa.RecordBatch.from_arrays([shard, batch.column("doc_ids")[i].values, pa.array(starts + at), pa.array(n), pa.array(crc, pa.int64())], ["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    return over


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int, order: tuple[str, ...] = ("doc_id",), by_word: bool | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of every document, each closed by ``end``, to the folder ``path`` in the order of ``order``.

    tokenizer: path of a definition for the ``tokenizers`` library, read on the driver and sent to the tasks. Texts are
    dealt out by ranges of the order, encoded once and held in a scratch table; counting, at most one row a task and
    vocabulary entry, gives ranks, and a second pass over the scratch table rewrites ids as ranks. Only the rank
    table, which the vocabulary bounds, reaches the driver. by_word: whether texts are encoded by distinct words; by
    default, if the definition allows that (see splits_by_word); ValueError if it is asked for and doesn't. Rows that tie go by a hash of their text. Null texts count
    as empty, null ids come first, repeated rows are written each time; an empty table gives empty files.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(json.dumps(json.load(f)))
    allowed = splits_by_word(definition.value)
    if by_word and not allowed:
        raise ValueError("this tokenizer doesn't see words one by one")
    by_word = allowed if by_word is None else by_word
    tie = F.xxhash64(text_col)
    src = docs.select(*(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), tie.alias("tie"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keys = [*(f"o{i}" for i in range(len(order))), "tie"]
    ordered = src.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    scratch = new_path(spark, "tokens")
    schema = f"{BLOCKS}, sizes array<int>"
    with shuffles_dropped(spark):  # the ordered texts' files go before a second copy of the ids is written
        ordered.mapInArrow(_tokenise(definition, by_word, end), schema).write.option("compression", "zstd").parquet(scratch)
    plain = spark.read.schema(schema).parquet(scratch)
    width = _width(Encoder(definition.value, False).tokenizer.get_vocab_size(), end)
    counts = plain.select("payload").mapInArrow(_count(width), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    ids = [r.id for r in sorted(counts, key=lambda r: (-r.n, r.id))]
    id_of = np.array(ids, np.uint32)
    rank_of = np.zeros(max(ids, default=0) + 1, np.uint32)
    rank_of[id_of] = np.arange(len(ids), dtype=np.uint32)
    spark.createDataFrame([(r, i) for r, i in enumerate(ids)], "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    plain.mapInArrow(_rank(spark.sparkContext.broadcast(rank_of), width), BLOCKS).write.option("compression", "zstd").parquet(f"{path}/blocks")
    remove(spark, scratch)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files: start counts the ids of all documents before it, the CRC is over ids as little-endian unsigned 32-bit integers."""
    ranks = spark.read.schema("rank long, id long").parquet(f"{path}/ranks").collect()
    id_of = np.zeros(len(ranks), np.uint32)
    for r in ranks:
        id_of[r.rank] = r.id
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    docs = blocks.mapInArrow(_read(spark.sparkContext.broadcast(id_of)), "shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
    sizes = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    before = F.sum("size").over(Window.orderBy("shard")) - F.col("size")  # one row a shard
    return docs.join(sizes.select("shard", before.alias("before")), "shard").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer: str, end: int = 2, path: str | None = None, **options) -> DataFrame:
    """Writes tokens (see write_tokens) to ``path`` or a new folder in the shared one, and reads them back (see read_tokens)."""
    spark = docs.sparkSession
    path = path or new_path(spark, "token-files")
    write_tokens(docs, path, tokenizer, end, **options)
    return read_tokens(spark, path)


def raw_ids(spark: SparkSession, path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """Each document's ids in order, for a trainer that reads block after block."""
    ranks = spark.read.schema("rank long, id long").parquet(f"{path}/ranks").collect()
    id_of = np.zeros(len(ranks), np.uint32)
    for r in ranks:
        id_of[r.rank] = r.id
    for row in spark.read.schema(BLOCKS).parquet(f"{path}/blocks").orderBy("shard", "block").toLocalIterator():
        lengths, values = unpack(bytes(row.payload))
        yield from zip(row.doc_ids, np.split(id_of[values], np.cumsum(lengths)[:-1]), strict=True)
