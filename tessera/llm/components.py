"""Connected components of an edge table, by rounds of large-star and small-star."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.scratch import remove, written


def connected(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of ``edges`` (a, b: long) reaches. Nodes without edges are absent.

    Every round is written to the shared folder, so a lost executor costs a reread at most. A large star moves each
    node's larger neighbours to its smallest one, a small star its smaller ones; they end when nothing moves, after a
    number of rounds that grows with the logarithm of the largest component.
    """
    spark = edges.sparkSession
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    now, path = written(pairs, "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        # large star: u's neighbours above it go to the least of its neighbourhood
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select(F.col("lo"), F.col("hi")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        # small star: u and its neighbours below it go to the least of them
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        step = small.union(low.select("hi", F.col("m").alias("lo"))).distinct()
        old = path
        now, path = written(step, "edges")
        remove(spark, old)
    root = now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    tops = now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return root.union(tops).select(F.col("node").cast(T.LongType()), F.col("root").cast(T.LongType()))
