import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from corpus import documents
from tessera.llm import mixing
from test_simhash import brute_fingerprint, components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages(spark, tmp_path):
    rows = [r[:5] for r in documents(3)]
    words = "this item has nine words and three further ones".split()
    leak = "before " * 30 + " ".join(words) + " after"
    rows += [(9001, leak, "en", "s1", 1), (None, "a text without an id here", "en", "s1", 1), (None, "a text without an id here", "en", None, 1)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, " ".join(words)), (1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = out[name] = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "token_output":
            assert docs.columns == before.columns
    ids = {k: sorted((r.doc_id for r in v.select("doc_id").collect()), key=str) for k, v in out.items()}
    known = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    assert ids["language_id"] == sorted((r[0] for r in known), key=str)
    fps = {r[0] if r[0] is not None else 10**9 + i: brute_fingerprint(r[1]) for i, r in enumerate(known)}
    comp = components(fps)
    kept = [i for i in fps if comp[i] == i]
    assert ids["simhash_near_dedup"] == sorted((i if i < 10**9 else None for i in kept), key=str)
    assert ids["benchmark_decontamination"] == [i for i in ids["simhash_near_dedup"] if i != 9001]
    assert ids["source_mixing"] == ids["benchmark_decontamination"] == ids["token_output"]
    order = [r.doc_id for r in mixing.mix(out["benchmark_decontamination"]).orderBy("mix_pos").collect()]
    text = {r[0]: r[1] for r in rows}
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    got = {r.doc_id: r for r in docs.collect()}
    for i in order:
        t = np.array([*lib.encode(text[i], add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(t), zlib.crc32(t.tobytes()))
        start += len(t)


def test_docs_that_are_no_scan(spark):
    df = spark.createDataFrame([r[:5] for r in documents()], SCHEMA)
    got = corpus_pipeline.write_tokens(spark, df, "").orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in df.collect())
    none = df.limit(0)
    for _, stage in corpus_pipeline.STAGES[:2]:
        assert stage(spark, none, "").count() == 0
    assert corpus_pipeline.mix_sources(spark, none, "").count() == 0


def test_texts_that_share_an_id(spark):
    words = [f"{a}{b}" for a in "bcdfghklmn" for b in ("ada", "eno", "iru", "ost")]
    text = lambda k: " ".join(words[(i * (2 * k + 1) + k * k) % 40] for i in range(60))
    copy, lone, other = text(1), text(2), text(3)
    assert min((brute_fingerprint(a) ^ brute_fingerprint(b)).bit_count() for a, b in ((copy, lone), (copy, other), (lone, other))) > 4
    # id 5 names a copy of 1's text and a text of its own, which stays; of the two rows that repeat both, one stays
    rows = [(1, copy), (5, copy), (5, lone), (5, lone), (7, other), (7, copy), (None, other)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    got = corpus_pipeline.drop_near_duplicates(spark, df, "").collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted([(1, copy), (5, lone), (7, other)])
