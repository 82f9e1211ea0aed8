"""Tables written in the shared folder, to cut lineage in a way that survives the loss of executors."""

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only where that is unset and Spark runs on a single machine, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="tessera-"))
    return f"file://{_own[0]}"


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear(spark: SparkSession) -> int:
    """Deletes the scratch tables that this process has made, and says how many: call it when no frame that reads them is needed any more."""
    n = len(_made)
    while _made:
        remove(spark, _made.pop())
    return n


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, Spark removes the shuffle files of a write once it has ended: what was written replaces them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Within it, Python workers are handed batches of about so many bytes: Spark's own bound lets them grow with the input up to 64 MB."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, name: str, **options: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet in the shared folder and read again, and its path."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    with shuffles_dropped(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder through Hadoop's file systems."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Lets Spark drop shuffle files that nothing refers to any more; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
