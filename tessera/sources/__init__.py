"""Readers of tables; every path goes through Spark, so any store that Spark reads will do."""

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir``, a file or a folder of files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
