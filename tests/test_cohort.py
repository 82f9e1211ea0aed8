"""Guards and plans of registration and selections."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import cohort as C
from tessera.operators import guards


def test_guards(spark, tmp_path):
    d = spark.createDataFrame([(1, True), (2, None)], "hpc_id int, malignant boolean")
    C.require_dictionary(d)
    for bad in (d.limit(0), d.where("malignant is null")):
        with pytest.raises(guards.Refused):
            C.require_dictionary(bad)
    C.require_complete(d, {"hpc_id": "int"}, 2)
    for columns, rows in (({"hpc_id": "string"}, 2), ({"x": "int"}, 2), ({"hpc_id": "int"}, 3)):
        with pytest.raises(guards.Refused):
            C.require_complete(d, columns, rows)
    with pytest.raises(guards.Refused):
        C.joined_exactly(d, d.limit(1), "hpc_id")
    with pytest.raises(guards.Refused):
        C.check_holdout(d.withColumn("slides", F.lit("a")), d.withColumn("slides", F.lit("a")), code="hpc_id")
    with pytest.raises(guards.Refused):
        C.enough_tiles(spark.createDataFrame([("x",)], "n string"), "n", 1)


def test_a_load_writes_only_on_commit(spark, tmp_path):
    df = spark.range(3)
    path = f"{tmp_path}/t"

    def refuse():
        raise guards.Refused("no")

    load = C.Load(df, df.agg(F.count("*").alias("n")), [])
    assert load.preview().first().n == 3 and not (tmp_path / "t").exists()
    with pytest.raises(guards.Refused):
        C.Load(df, df, [refuse]).commit(path)
    assert not (tmp_path / "t").exists()
    assert load.commit(path) == 3 and spark.read.parquet(path).count() == 3


def test_columns_and_ids(spark):
    df = spark.createDataFrame([("a7", 1, 2, 3)], "train_samples string, train_z_latent int, slides int, tiles int")
    assert C.resolve_columns(df, "z_latent") == {"z_latent": "train_z_latent", "samples": "train_samples", "slides": "slides", "tiles": "tiles"}
    with pytest.raises(guards.Refused):
        C.resolve_columns(df, "h_latent")
    assert df.select(C.core_id(F.col("train_samples"))).first()[0] == "A007"
    wide = spark.createDataFrame([(1, 2, 3)], "p_hpc_10 int, p_hpc_2 int, p_hpc_x int")
    assert C.probability_columns(wide) == ["p_hpc_2", "p_hpc_10"]


def test_sample_keeps_whole_keys(spark):
    df = spark.createDataFrame([(i % 10, i) for i in range(100)], "k int, v int")
    a, b = C.sample_of(df, "k", 3), C.sample_of(df.repartition(5), "k", 3)
    assert a.count() == 30 and sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert C.sample_of(df, "k", 3, seed=1).count() == 30


def test_lists_and_unknown_clusters(spark, tmp_path):
    df = spark.createDataFrame([("b", 1), ("a", 2)], "slide_id string, hpc_id int")
    C.write_list(df, "slide_id", f"{tmp_path}/list")
    assert [r.value for r in spark.read.text(f"{tmp_path}/list").collect()] == ["a", "b"]
    dictionary = spark.createDataFrame([(1, True)], "hpc_id int, malignant boolean")
    assert C.titled(df, dictionary).count() == 2
    with pytest.raises(guards.Refused, match="unknown"):
        C.titled(df, dictionary, strict=True)
