import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpus import SCHEMA, documents
from tessera.llm import tokens

FILE = public_tokenizers.path("word_bpe_49k.json")
whole = tokens.Encoder(open(FILE, encoding="utf-8").read(), False)
by_word = tokens.Encoder(open(FILE, encoding="utf-8").read(), True)


@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aB éÉßẞİΣſKÅ´́'st|<>.\x1c\x85\xa0 \r\n\t"))), max_size=5))
@settings(max_examples=300, deadline=None)
def test_words_encode_as_whole_texts(texts):
    texts = [t.encode() for t in texts] + [b"it's <|endoftext|> A<|startoftext|>b ab...12", None]
    assert by_word.encode(texts) == whole.encode(texts)


@given(st.lists(st.sampled_from([0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1]), max_size=40))
@settings(deadline=None)
def test_lists_round_trip(values):
    x = np.array(values, np.uint32)
    data = tokens.encode_list(x)
    back, used = tokens.decode_list(data + b"more", len(x))
    assert used == len(data) and back.tolist() == values


def test_files_match_the_library(spark):
    rows = [*documents(), (None, "no id", None, None, None, "x", "y", 1), (0, "again", None, None, None, "x", "y", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    path = tokens.new_path(spark, "t")
    tokens.write_tokens(df.repartition(3), path, FILE, 2, by_word=True)
    got = [tuple(r) for r in tokens.read_tokens(spark, path).orderBy("start").collect()]
    lib = Tokenizer.from_file(FILE)
    ids = {(r[0], tuple(lib.encode(r[1] or "", add_special_tokens=False).ids + [2])) for r in rows}
    start = 0
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda x: -1 if x is None else x)
    seen = {(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids}
    for i, s, n, crc in got:
        assert s == start and (i, n, crc) in seen
        start += n
    assert {(i, tuple(x.tolist())) for i, x in tokens.raw_ids(spark, path)} == ids
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    counts = np.bincount([t for _, x in tokens.raw_ids(spark, path) for t in x])
    assert [r.id for r in ranks] == sorted(np.flatnonzero(counts).tolist(), key=lambda t: (-counts[t], t))


def test_empty_table_and_general_tokenizers(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert tokens.token_output(df, FILE, by_word=True).count() == 0
    other = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame([(1, "A text  with spaces"), (2, None)], "doc_id long, text string")
    lib = Tokenizer.from_file(other)
    want = len(lib.encode("A text  with spaces", add_special_tokens=False).ids) + 1
    assert [(r.doc_id, r.start, r.n_tokens) for r in tokens.token_output(df, other).orderBy("doc_id").collect()] == [(1, 0, want), (2, want, 1)]


def test_very_long_texts_and_tokenizers_that_need_whole_texts(spark):
    import pytest

    long = " ".join(f"Wörter{i % 977} und (Zahl {i})," for i in range(60_000))
    df = spark.createDataFrame([(1, long), (2, "x" * (5 << 20)), (3, "kurz")], "doc_id long, text string")
    lib = Tokenizer.from_file(FILE)
    want = {i: lib.encode(t, add_special_tokens=False).ids + [2] for i, t in ((1, long), (3, "kurz"))}
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in tokens.token_output(df.where("doc_id <> 2"), FILE).collect()}
    assert got == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want.items()}
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert tokens.splits_by_word(open(FILE, encoding="utf-8").read()) and not tokens.splits_by_word(open(other, encoding="utf-8").read())
    with pytest.raises(ValueError, match="one by one"):
        tokens.write_tokens(df, tokens.new_path(spark, "t"), other, 2, by_word=True)
