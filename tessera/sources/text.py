"""Text-exact reads: nothing is inferred, so 007, NA and null stay what they are (S rows)."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.guards import Refused
from tessera.operators.keys import make_slide_tile

#: Columns of an assignment file besides the cluster's.
KNOWN = ("samples", "slides", "tiles", "slide_tile", "vote_margin", "neighbor_distance", "hpc_reference")


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; an empty field is an empty text, not null."""
    raw = spark.read.csv(path, header=True, inferSchema=False, nullValue="\u0001", emptyValue="")
    return raw.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines."""
    return spark.read.text(path).where(F.trim("value") != "")


def read_slide_tables(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """One table a slide, in folders slides=<id>, as one frame with the slide's id as text."""
    return spark.read.schema(f"{fields}, slides string").csv(path, header=True)


def file_registry(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and time of the files below a folder, with the slide that each name stands for; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"), slide_id_from_path(F.col("path")).alias("slide_id"))


def cluster_column(columns: list[str]) -> str:
    """The only column that isn't a known one."""
    other = [c for c in columns if c not in KNOWN]
    if len(other) != 1:
        raise Refused(f"one cluster column is needed, not {other}")
    return other[0]


def parse_assignments(raw: DataFrame) -> DataFrame:
    """Typed columns and, in ``problem``, the first rule that a row breaks (null: none)."""
    cluster = cluster_column(raw.columns)
    num = lambda c: F.col(c).try_cast("double")
    blank = (F.trim("slides") == "") | (F.trim("tiles") == "") | (F.trim("samples") == "")
    bad = lambda c: (F.trim(c) != "") & num(c).isNull()
    hpc = F.col(cluster).try_cast("double")
    problem = F.when(blank, "blank key").when(bad("vote_margin") | bad("neighbor_distance"), "bad number").when(hpc.isNull() | (hpc != F.floor(hpc)), "bad cluster")
    return raw.select("samples", "slides", "tiles", make_slide_tile(F.col("slides"), F.col("tiles")).alias("slide_tile"), F.when(hpc == F.floor(hpc), hpc).try_cast("int").alias("hpc_id"), num("vote_margin").alias("vote_margin"), num("neighbor_distance").alias("neighbor_distance"), problem.alias("problem"))


def row_range(df: DataFrame, lo: int, hi: int, col: str = "row_id") -> DataFrame:
    """Rows [lo, hi); the bounds reach the scan."""
    return df.where((F.col(col) >= lo) & (F.col(col) < hi))


def wide(df: DataFrame, vec: str, size: int, *keep: str) -> DataFrame:
    """A column for each component."""
    return df.select(*keep, *(F.get(vec, F.lit(i)).alias(f"d{i}") for i in range(size)))


def decode(df: DataFrame, categories: DataFrame, code: str = "code") -> DataFrame:
    """Labels by code."""
    return df.join(categories, code, "left")


def with_index(df: DataFrame, *order: str) -> DataFrame:
    """The row's place in storage order, counted by ranges: ranks within, then the sizes of ranges before."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_nth", F.monotonically_increasing_id())
    from pyspark.sql import Window

    ranked = parts.withColumn("_k", F.row_number().over(Window.partitionBy("_part").orderBy("_nth")) - 1)
    sizes = ranked.groupBy("_part").agg(F.count("*").alias("_size"))
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))  # one row a range
    return ranked.join(before, "_part").withColumn("image_index", F.col("_before") + F.col("_k")).drop("_part", "_nth", "_k", "_before")


def slide_id_from_path(path):
    """The last part without its suffix; R22: and the id in braces-free hex before it."""
    return F.regexp_extract(path, r"([^/?#]+?)(\.[A-Za-z0-9]+)?/?([?#].*)?$", 1)


def folds(df: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """A fold for each key, the same for all its rows, by a hash."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), key), F.lit(k)).cast("int"))
