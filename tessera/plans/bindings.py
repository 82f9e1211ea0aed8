"""The cohort's tables, bound to the tables of a folder by fixed rules; CTES say the same in SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.keys import make_slide_tile
from tessera.sources import table

CLUSTERS = 71

CTES = {
    "tiles": """SELECT n_name AS samples, CAST(l_suppkey AS VARCHAR) AS slides, l_orderkey || '_' || l_linenumber || '_' || l_partkey || '.jpeg' AS tiles,
        upper(trim(CAST(l_suppkey AS VARCHAR))) || '_' || upper(trim(l_orderkey || '_' || l_linenumber || '_' || l_partkey || '.jpeg')) AS slide_tile,
        CAST(l_partkey % 71 AS INTEGER) AS hpc_id, l_discount * 10 AS vote_margin, l_tax AS neighbor_distance,
        CAST(l_orderkey % 40 AS INTEGER) AS grid_col, CAST(l_partkey % 40 AS INTEGER) AS grid_row, l_returnflag AS flag, l_orderkey AS run
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "dictionary": """SELECT CAST(i AS INTEGER) AS hpc_id, CASE WHEN i % 17 = 0 THEN NULL ELSE i % 3 = 0 END AS malignant, 'cluster ' || i AS hpc_title,
        CASE WHEN i % 4 = 0 THEN 'High' WHEN i % 4 = 1 THEN 'Medium' ELSE 'Low' END AS inflammation FROM range(71) r(i)""",
    "survival": """SELECT CAST(i AS INTEGER) AS hpc_id, (i % 13 - 6) / 10.0::DOUBLE AS coef, CASE WHEN i % 11 = 0 THEN NULL ELSE (i * 37 % 100) / 500.0::DOUBLE END AS p FROM range(71) r(i)""",
    "proportion": """SELECT samples, slides, hpc_id, count(*) AS n, count(*) / CAST(sum(count(*)) OVER (PARTITION BY samples, slides) AS DOUBLE) AS proportion FROM tiles GROUP BY samples, slides, hpc_id""",
    "first_tiles": """SELECT * FROM tiles QUALIFY row_number() OVER (PARTITION BY slides, grid_col, grid_row ORDER BY slide_tile) = 1""",
    "runs": """SELECT o_orderkey AS submission_id, o_custkey AS dataset, CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'O' THEN 'running' ELSE 'pending' END AS state, o_orderdate AS submitted_at, o_totalprice AS size FROM orders""",
    "cells": """SELECT CAST(user_id AS VARCHAR) AS core, event_id AS cell, CAST(floor(value * 10) AS BIGINT) % 97 AS x, event_id * 31 % 89 AS y, event_type AS phenotype FROM events""",
    "refs": """SELECT vec_id AS ref_id, CAST(label AS INTEGER) AS code, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings WHERE vec_id % 5 <> 0""",
    "asks": """SELECT vec_id AS row_id, CAST(label AS INTEGER) AS truth, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings WHERE vec_id % 5 = 0""",
    "pairs": """SELECT row_id, truth, ref_id, code, list_sum(list_transform(list_zip(a.vec, r.vec), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d2 FROM asks a, refs r""",
    "near": """SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY d2, ref_id) AS rank FROM pairs QUALIFY rank <= 25""",
}


def tiles(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_tax", "l_returnflag")
    place = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    slide, tile = F.col("l_suppkey").cast("string"), F.concat(F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey"), F.lit(".jpeg"))
    # one after the other: a join's size is guessed as a product, by which places joined first would not be broadcast
    return li.join(place, F.col("l_suppkey") == F.col("s_suppkey")).join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("samples"),
        slide.alias("slides"),
        tile.alias("tiles"),
        make_slide_tile(slide, tile).alias("slide_tile"),
        (F.col("l_partkey") % CLUSTERS).cast("int").alias("hpc_id"),
        (F.col("l_discount") * 10).alias("vote_margin"),
        F.col("l_tax").alias("neighbor_distance"),
        (F.col("l_orderkey") % 40).cast("int").alias("grid_col"),
        (F.col("l_partkey") % 40).cast("int").alias("grid_row"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_orderkey").alias("run"),
    )


def dictionary(spark: SparkSession) -> DataFrame:
    i = F.col("id")
    level = F.when(i % 4 == 0, "High").when(i % 4 == 1, "Medium").otherwise("Low")
    return spark.range(CLUSTERS).select(i.cast("int").alias("hpc_id"), F.when(i % 17 != 0, i % 3 == 0).alias("malignant"), F.concat(F.lit("cluster "), i.cast("string")).alias("hpc_title"), level.alias("inflammation"))


def survival(spark: SparkSession) -> DataFrame:
    i = F.col("id")
    return spark.range(CLUSTERS).select(i.cast("int").alias("hpc_id"), ((i % 13 - 6) / 10.0).alias("coef"), F.when(i % 11 != 0, (i * 37 % 100) / 500.0).alias("p"))


def runs(spark: SparkSession, d: str) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "F", "complete").when(F.col("o_orderstatus") == "O", "running").otherwise("pending")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("submission_id"), F.col("o_custkey").alias("dataset"), state.alias("state"), F.col("o_orderdate").alias("submitted_at"), F.col("o_totalprice").alias("size"))


def cells(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").cast("string").alias("core"), F.col("event_id").alias("cell"), (F.floor(F.col("value") * 10) % 97).alias("x"), (F.col("event_id") * 31 % 89).alias("y"), F.col("event_type").alias("phenotype"))


def refs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").where("vec_id % 5 <> 0").select(F.col("vec_id").alias("ref_id"), F.col("label").cast("int").alias("code"), F.col("embedding").cast("array<double>").alias("vec"))


def asks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").where("vec_id % 5 = 0").select(F.col("vec_id").alias("row_id"), F.col("label").cast("int").alias("truth"), F.col("embedding").cast("array<double>").alias("vec"))
