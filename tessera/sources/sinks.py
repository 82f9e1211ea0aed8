"""Keyed loads as set operations (K rows). A plan is a DataFrame; commit() writes it beside the old table and swaps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.guards import Refused, conflicting, require_empty
from tessera.sources.scratch import remove


def update_from(target: DataFrame, stage: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """K1, K2: the target with the columns of matching rows replaced; others stay."""
    new = stage.select(key, *(F.col(c).alias(f"_n_{c}") for c in cols), F.lit(True).alias("_hit"))
    j = target.join(new, key, "left")
    return j.select(*(F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in target.columns))


def replace_group(target: DataFrame, new: DataFrame, group: list[str], owner: str | None = None) -> DataFrame:
    """K4, K5: rows of the groups in ``new`` give way to it. With an owner column, a group that another owner holds refuses."""
    if owner:
        both = target.select(*group, owner).unionByName(new.select(*group, owner)).join(new.select(*group).distinct(), group, "left_semi")
        require_empty(conflicting(both, group[0], owner), "groups of another owner")
    return target.join(new.select(*group).distinct(), group, "left_anti").unionByName(new)


def upsert(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows, and new values of old ones where they aren't null."""
    cols = [c for c in target.columns if c != key]
    n = new.select(key, *(F.col(c).alias(f"_n_{c}") for c in cols))
    return target.join(n, key, "full_outer").select(key, *(F.coalesce(f"_n_{c}", c).alias(c) for c in cols))


def insert_once(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't there yet, each once."""
    return target.unionByName(new.dropDuplicates(keys).join(target, keys, "left_anti"))


def collisions(target: DataFrame, new: DataFrame, key: str, scope: str, dataset: str) -> DataFrame:
    """Rows of other datasets whose keys a load would take."""
    return target.where(F.col(scope) != dataset).join(new.select(key), key, "left_semi")


def register(target: DataFrame, new: DataFrame, key: str, scope: str, dataset: str, replace: bool = False) -> DataFrame:
    """Adds a dataset's rows; refuses keys that another dataset holds; ``replace`` drops its old rows first."""
    require_empty(collisions(target, new, key, scope, dataset), "keys of another dataset")
    old = target.where(F.col(scope) != dataset) if replace else target
    return old.unionByName(new.join(old.select(key), key, "left_anti"))


def stale(names: DataFrame, now: int, hours: int = 24, col: str = "name") -> DataFrame:
    """K8: scratch tables whose name holds an epoch older than so many hours."""
    epoch = F.regexp_extract(col, r"_(\d{9,10})$", 1).try_cast("long")
    return names.where(epoch < now - 3600 * hours)


def other_identity(done: DataFrame, identity: str) -> DataFrame:
    """What was done under other settings, which a resumed run must not take over."""
    return done.where(~F.col("identity").eqNullSafe(F.lit(identity)))


def pending_ranges(ranges: DataFrame, done: DataFrame, identity: str) -> DataFrame:
    """Ranges that still have to run; what was done under another identity refuses."""
    require_empty(other_identity(done, identity), "done under other settings")
    return ranges.join(done, ["lo", "hi"], "left_anti")


def commit(df: DataFrame, path: str, expected: int | None = None) -> int:
    """Writes beside ``path``, checks the count of what was written, then puts it in its place by renames; between two of them a reader finds no table, unlike one of ``versions``."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    new, old = f"{path}.new", f"{path}.old"
    df.write.mode("overwrite").parquet(new)
    n = spark.read.parquet(new).count()
    if expected is not None and n != expected:
        remove(spark, new)
        raise Refused(f"{n} rows were written, not {expected}")
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    remove(spark, old)
    if fs.exists(at(path)):
        fs.rename(at(path), at(old))
    fs.rename(at(new), at(path))
    remove(spark, old)
    return n
