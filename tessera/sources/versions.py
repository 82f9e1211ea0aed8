"""Tables that readers never see half done (K3, K7): immutable version folders, and one empty marker file that is put there last.

``<path>/data/<version>`` holds a version's files and ``<path>/published/<number>.<version>`` says that it is whole. A
reader lists the markers once and takes the one with the highest number, so it reads one version from start to end
whatever is published meanwhile; making an empty file is one step in every file system, unlike replacing one. A number
is claimed by a file that must not exist yet, so of two loads at once one has to give way.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.guards import Refused
from tessera.sources.scratch import remove


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *parts]))
    return at().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _listed(fs, folder) -> dict[str, int]:
    """Names in a folder, hidden ones aside, and when they were made (ms); none if there is no folder."""
    if not fs.exists(folder):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(folder) if not s.getPath().getName().startswith((".", "_"))}


def _made(fs, file) -> bool:
    """Makes an empty file unless it is there already."""
    try:
        fs.create(file, False).close()
    except Exception as e:  # the file system's own exception for a file that exists differs by its kind
        if fs.exists(file):
            return False
        raise e
    return True


def published(spark: SparkSession, path: str) -> list[str]:
    """Versions in the order in which they were published."""
    fs, at = _fs(spark, path)
    return [name.split(".", 1)[1] for name in sorted(_listed(fs, at("published")))]


def current(spark: SparkSession, path: str) -> str | None:
    """The version that a reader gets now; null before the first."""
    return next(reversed(published(spark, path)), None)


def read(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The table as it is now, or as ``version`` left it. The version is looked up here, once: later loads don't change the frame."""
    version = version or current(spark, path)
    if version is None:
        raise Refused(f"nothing is published at {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/data/{version}")


def publish(df: DataFrame, path: str, expected: int | None = None, checks: tuple[Callable[[DataFrame], None], ...] = (), base: str | None = None) -> str:
    """Writes ``df`` as a version of its own and makes it the current one; returns its name.

    What was written is counted against ``expected`` and handed to each check, which raises to refuse; a load that is
    refused or dies leaves readers where they were. ``base``: the version that ``df`` was derived from; if another has
    been published since, or another load is under way, this one is refused, so no load undoes another unseen.
    """
    spark = df.sparkSession
    fs, at = _fs(spark, path)
    version = uuid.uuid4().hex
    started = _listed(fs, at("published"))
    last = max((int(n.split(".", 1)[0]) for n in started), default=0)
    if base is not None and current(spark, path) != base:
        raise Refused("another version has been published since")
    claims = [int(n) for n in _listed(fs, at("claims"))]
    if base is not None and any(n > last for n in claims):
        raise Refused("another load is under way")
    number = max([last, *claims]) + 1
    while not _made(fs, at("claims", f"{number:012d}")):
        if base is not None:
            raise Refused("another load is under way")
        number += 1
    folder = f"{path.rstrip('/')}/data/{version}"
    try:
        df.write.parquet(folder)
        new = spark.read.schema(df.schema).parquet(folder)
        if expected is not None and (n := new.count()) != expected:
            raise Refused(f"{n} rows were written, not {expected}")
        for check in checks:
            check(new)
        if base is not None and current(spark, path) != base:
            raise Refused("another version has been published since")
    except BaseException:
        remove(spark, folder)
        fs.delete(at("claims", f"{number:012d}"), False)
        raise
    fs.create(at("published", f"{number:012d}.{version}"), False).close()
    return version


def sweep(spark: SparkSession, path: str, now_ms: int, keep: int = 2, hours: float = 24.0) -> list[str]:
    """K8: deletes versions beyond the newest ``keep``, what loads that died have left, and their claims, all if older than
    so many hours, so that readers that began before can end. Returns the names of the versions that are gone."""
    fs, at = _fs(spark, path)
    before = now_ms - hours * 3_600_000
    marks = sorted(_listed(fs, at("published")).items())
    kept = {name.split(".", 1)[1] for name, made in marks[max(0, len(marks) - keep) :]} | {name.split(".", 1)[1] for name, made in marks if made > before}
    for name, _ in marks:
        if name.split(".", 1)[1] not in kept:
            fs.delete(at("published", name), False)
    gone = [v for v, made in _listed(fs, at("data")).items() if v not in kept and made <= before]
    for v in gone:
        remove(spark, str(at("data", v)))
    for name, made in _listed(fs, at("claims")).items():
        if made <= before:
            fs.delete(at("claims", name), False)
    return gone
