import pytest
from pyspark.sql import functions as F

from eclusa.errors import SinkError
from eclusa.operators.sink import check_apart, check_partitions, write, write_mode
from tests.helpers import data_files


def test_modes():
    assert write_mode(" Overwrite ") == "overwrite" and write_mode("UPSERT") == "upsert"
    for text in ("replace", "", None):
        with pytest.raises(SinkError):
            write_mode(text)


def test_overwrite_is_static_and_empties(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).withColumn("p", F.col("id") % 3)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write(df, path, "parquet", "overwrite", ["p"])
        write(df.filter("p = 1"), path, "parquet", "overwrite", ["p"])
        assert spark.read.parquet(path).count() == 3
        write(df.limit(0), path, "parquet", "overwrite", ["p"])
        assert not data_files(path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_append_adds(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(3):
        write(spark.range(5), path, "orc", "append")
    assert spark.read.orc(path).count() == 15


def test_null_and_blank_partition_values_share_a_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, None), (2, ""), (3, "01")], "i int, p string")
    write(df, path, "parquet", "overwrite", ["p"])
    back = spark.read.schema(df.schema).parquet(path)
    assert {r["i"]: r["p"] for r in back.collect()} == {1: None, 2: None, 3: "01"}


def test_dropped_partition_column(spark, tmp_path):
    df = spark.range(1).withColumn("Ano", F.lit(1))
    check_partitions(df, ["ano"])
    with pytest.raises(SinkError, match="mes"):
        write(df, str(tmp_path / "t"), "parquet", "overwrite", ["ano", "mes"])
    assert not (tmp_path / "t").exists()


def test_overlapping_locations(spark, tmp_path):
    df = spark.range(1)
    a, b = f"file://{tmp_path}/a", f"{tmp_path}/a"
    for source, target in ((a, b), (a, f"{b}/x"), (f"{a}/x/y", b), (f"{a}/", b)):
        with pytest.raises(SinkError, match="overlap"):
            check_apart(df, source, target)
    check_apart(df, f"{tmp_path}/a", f"{tmp_path}/ab")
    check_apart(df, f"{tmp_path}/a/x", f"{tmp_path}/a/y")


def test_one_file_per_small_partition(spark, tmp_path):
    df = spark.range(0, 8000, 1, 16).withColumn("p", F.col("id") % 20)
    write(df, str(tmp_path / "together"), "parquet", "overwrite", ["p"])
    write(df, str(tmp_path / "apart"), "parquet", "overwrite", ["p"], cluster=False)
    assert len(data_files(tmp_path / "together")) == 20
    assert len(data_files(tmp_path / "apart")) == 320


def test_partition_names_with_dots_and_spaces(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 2 as `a.b c`")
    write(df, str(tmp_path / "t"), "parquet", "overwrite", ["a.b c"])
    assert spark.read.parquet(str(tmp_path / "t")).filter("`a.b c` = 1").count() == 5


def test_hot_partition_is_split(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(0, 60000, 1, 16).withColumn(
            "p", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 20)
        )
        write(df, str(tmp_path / "t"), "parquet", "overwrite", ["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(data_files(tmp_path / "t" / "p=-1")) > 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60000


def test_codec_and_catalog_table(spark, tmp_path):
    df = spark.range(5)
    write(df, str(tmp_path / "t"), "parquet", "overwrite", compression="gzip", table="default.t_cat")
    assert all(".gz." in f.name for f in data_files(tmp_path / "t"))
    assert spark.table("default.t_cat").count() == 5
    write(df, str(tmp_path / "t"), "parquet", "append", table="default.t_cat")
    assert spark.table("default.t_cat").count() == 10
    spark.sql("drop table default.t_cat")
    assert data_files(tmp_path / "t")
