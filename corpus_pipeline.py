"""A training corpus in five stages: language, near duplicates, benchmark items, source mix, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.

The mix decides the order of documents. Its stage writes files whose names, and rows within them, are in that order;
the token stage reads it back from the files' names and row numbers, which Spark gives as metadata of Parquet scans.
Docs that aren't a Parquet scan are taken in the order of doc_id, with a warning.
"""

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, langid, mixing, simhash, tokens
from tessera.sources import table
from tessera.sources.scratch import written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: null texts and those without a letter."""
    known = langid.identify(docs, langid.fit(docs), tuple(docs.columns))
    return known.where(F.col("lang_pred") != langid.UNKNOWN).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, the one with the smallest doc_id.

    Documents without an id count as ids above all others, by a hash of their text. Texts that share an id are documents
    of their own, in the order of a hash of the text; of rows that repeat both, one stays, by a hash of the whole row.
    """
    by_text = F.shiftrightunsigned(F.xxhash64("text"), 3) + F.lit(1 << 62)
    keys = {"pipeline_id": F.coalesce("doc_id", by_text), "pipeline_text": F.xxhash64("text"), "pipeline_row": F.xxhash64(*docs.columns)}
    numbered = docs.withColumns(keys)
    found = simhash.near_duplicates(numbered.withColumn("pipeline_key", F.struct(*keys)), id_col="pipeline_key")
    kept = found.where("doc_id = component_id").select("doc_id.*")
    return numbered.join(kept, list(keys), "left_semi").dropDuplicates(list(keys)).select(*docs.columns)


def drop_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage that holds a benchmark item go."""
    return decontam.search(docs, table(spark, sf_dir, "benchmark")).where(F.size("hits") == 0).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in files in the mixed order."""
    placed = mixing.mix(docs)
    return placed.repartitionByRange("mix_pos").sortWithinPartitions("mix_pos").select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from token files in the mixed order."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    try:
        file = F.col("_metadata.file_name")
        part = F.regexp_extract(file, r"^part-(\d+)", 1).try_cast("long")
        placed = docs.select("doc_id", "text", part.alias("part"), file.alias("file"), F.col("_metadata.row_index").alias("row"))
        order = ("part", "file", "row")
    except AnalysisException:
        warnings.warn("docs aren't a scan of files: they are taken in the order of doc_id", stacklevel=2)
        placed, order = docs.select("doc_id", "text"), ("doc_id",)
    return tokens.token_output(placed, tokenizer, order=order)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_items),
    ("source_mixing", mix_sources),
    ("token_output", write_tokens),
]

#: SQL can express neither fingerprints nor the language model, so tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
