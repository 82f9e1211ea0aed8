"""Lines that recur in several documents, kept in one of them only. DataFrame functions throughout."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.scratch import written

#: What may surround a line's key: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def identity(text: Column, first: str, second: str) -> dict[str, Column]:
    """Two columns of 64 bits that tell texts apart: they are drawn from the SHA-256 digest, which no known texts share."""
    digest = F.sha2(text.cast("binary"), 256)
    return {first: F.xxhash64(digest), second: F.xxhash64(F.lit(1), digest)}


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row, also where ``use`` reads it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (the text that stays): each document without lines that other documents hold.

    A line's key is the stripped, lower-cased line. A key of ``min_chars`` code points or more that ``min_docs``
    documents hold loses all its lines but those of the smallest doc_id that holds it. Keys meet by 128 bits of their SHA-256 digest,
    and rows by as many of their text's, so unlike ones don't meet, also where hashes are attacked.
    Lines' hashes are written to the shared folder once, for the count and for the join back. Counting combines before
    the shuffle, so a line in a third of all documents is one row a task there; in the join back only (document,
    position, hash) moves, and adaptive execution splits the partition of such a line. Texts move once, to meet the
    positions they lose.

    A null or empty text is one empty line. Rows with one doc_id count as one document (of repeated rows both come
    back). A null doc_id counts as the largest. An empty table gives an empty result; further columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumns(identity(F.col("text"), "row", "row2")).withColumn("of", F.coalesce("doc_id", F.lit(2**63 - 1)))
    lines = (
        base.select("of", "row", "row2", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
        .withColumn("key", line_key(F.col("line")))
        .where(F.char_length("key") >= min_chars)
        .withColumns(identity(F.col("key"), "h1", "h2"))
        .select("of", "row", "row2", "at", "h1", "h2")
    )
    lines, _ = written(lines, "lines")  # texts are split and hashed once, for the count and for the join back
    if min_docs == 2:
        shared = lines.groupBy("h1", "h2").agg(F.min("of").alias("first"), F.max("of").alias("last")).where("first < last")
    else:
        by_doc = lines.groupBy("h1", "h2", "of").agg(F.lit(1).alias("one"))
        shared = by_doc.groupBy("h1", "h2").agg(F.min("of").alias("first"), F.count("*").alias("n")).where(F.col("n") >= min_docs)
    # written, so that the join gets a shuffle of its own, which adaptive execution can split; one under an aggregate it can't
    shared, _ = written(shared.select("h1", "h2", "first"), "shared-lines")
    lost = lines.join(shared, ["h1", "h2"]).where("of <> first").groupBy("of", "row", "row2").agg(F.collect_set("at").alias("lost"))
    met = base.join(lost, ["of", "row", "row2"], "left").select("doc_id", "text", F.coalesce("lost", F.array().cast("array<int>")).alias("lost"))

    def keep(x: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(x.lines) - 1), x.lost)
        return F.array_join(F.transform(stay, lambda i: F.get(x.lines, i)), "\n")

    kept = F.when(F.size("lost") == 0, F.col("text")).otherwise(_bound(F.struct(F.split("text", "\n", -1).alias("lines"), F.col("lost").alias("lost")), keep))
    return met.select(
        "doc_id",
        (F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.size("lost").cast("long").alias("n_dropped"),
        kept.alias("kept"),
    )
