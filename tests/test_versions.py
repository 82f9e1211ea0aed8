"""Loads that readers never see half done."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from tessera.operators.guards import Refused
from tessera.sources import versions


def table(spark, v, n=50):
    return spark.range(n).withColumn("v", F.lit(v)).repartition(4)


def test_readers_never_find_a_missing_or_mixed_table(spark, tmp_path):
    path, bad, seen, stop = f"{tmp_path}/t", [], set(), threading.Event()
    versions.publish(table(spark, 0), path, 50)

    def reader():
        while not stop.is_set():
            try:
                rows = versions.read(spark, path).groupBy("v").count().collect()
                seen.add(rows[0].v)
                if len(rows) != 1 or rows[0]["count"] != 50:
                    bad.append(rows)
            except Exception as e:  # any failure of a reader fails the test
                bad.append(e)

    threads = [threading.Thread(target=reader) for _ in range(2)]
    for t in threads:
        t.start()
    for v in range(1, 7):
        versions.publish(table(spark, v), path, 50)
        versions.sweep(spark, path, int(time.time() * 1000), keep=2, hours=1.0)
    stop.set()
    for t in threads:
        t.join()
    assert not bad and len(seen) > 1
    assert versions.read(spark, path).first().v == 6 and len(versions.published(spark, path)) == 7


def test_a_refused_load_leaves_the_pointer_alone(spark, tmp_path):
    path = f"{tmp_path}/t"
    first = versions.publish(table(spark, 1), path)

    def none_above(df):
        if df.where("v > 1").count():
            raise Refused("too large")

    for load in (lambda: versions.publish(table(spark, 2), path, 51), lambda: versions.publish(table(spark, 2), path, checks=(none_above,)), lambda: versions.publish(table(spark, 1).withColumn("v", F.expr("v div (id - 3)")), path, checks=(lambda df: (_ for _ in ()).throw(ZeroDivisionError()),))):
        with pytest.raises(Exception):  # noqa: B017  of whatever kind
            load()
        assert versions.current(spark, path) == first
    assert versions.read(spark, path).count() == 50
    assert versions.sweep(spark, path, int(time.time() * 1000), keep=1, hours=-1.0) == []
    versions.publish(table(spark, 3), path, checks=(lambda df: None,))
    assert versions.read(spark, path).first().v == 3


def test_a_load_on_an_old_version_gives_way(spark, tmp_path):
    path = f"{tmp_path}/t"
    base = versions.publish(table(spark, 1), path)
    old = versions.read(spark, path)
    versions.publish(table(spark, 2), path, base=base)
    with pytest.raises(Refused, match="since"):
        versions.publish(old, path, base=base)
    assert versions.read(spark, path).first().v == 2 and old.first().v == 1


def test_sweep_keeps_the_newest_and_removes_the_rest(spark, tmp_path):
    path = f"{tmp_path}/t"
    names = [versions.publish(table(spark, v), path) for v in range(3)]
    (tmp_path / "t" / "data" / "died").mkdir()
    assert versions.sweep(spark, path, int(time.time() * 1000), keep=1, hours=1.0) == []
    gone = versions.sweep(spark, path, int(time.time() * 1000) + 7_200_000, keep=1, hours=1.0)
    assert set(gone) == {names[0], names[1], "died"} and versions.published(spark, path) == names[2:]
    assert versions.read(spark, path).first().v == 2


def test_nothing_published(spark, tmp_path):
    assert versions.current(spark, f"{tmp_path}/none") is None
    with pytest.raises(Refused, match="nothing"):
        versions.read(spark, f"{tmp_path}/none")
