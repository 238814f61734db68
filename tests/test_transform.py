from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from eclusa.errors import IngestionError, TransformError
from eclusa.operators.partitioning import with_partitions
from eclusa.operators.transform import apply_sql

DATES = [(1, None), (2, "2024-05-01"), (3, ""), (4, "31/12/2024"), (5, "20241231")]


def test_year_and_month_are_cut_by_position(spark):
    df, names = with_partitions(spark.createDataFrame(DATES, "i int, d string"), "D", "data")
    assert names == ["ano", "mes"] and df.columns == ["i", "d", "ano", "mes"]
    assert {r["i"]: (r["ano"], r["mes"]) for r in df.collect()} == {
        1: (None, None),
        2: ("2024", "05"),
        3: ("", ""),
        4: ("31/1", "/2"),
        5: ("2024", "23"),
    }


def test_existing_year_is_replaced(spark):
    df = spark.createDataFrame([("2024-05-01", "old")], "ano string, mes string")
    assert with_partitions(df, "ano", "data")[0].head() == ("2024", "05")


def test_date_types(spark):
    for kind in ("date", "timestamp", "timestamp_ntz", "string"):
        df = spark.sql(f"select cast('2021-03-04' as {kind}) as d")
        row = with_partitions(df, "d", "data")[0].head()
        assert (row["ano"], row["mes"]) == ("2021", "03")


def test_other_kinds(spark):
    df = spark.range(1)
    assert with_partitions(df, "a, b,,c ", "normal") == (df, ["a", "b", "c"])
    for kind in ("", "nenhum", "Data", "NORMAL"):
        assert with_partitions(df, "nonsense", kind) == (df, [])
    with pytest.raises(IngestionError):
        with_partitions(df, "nonsense", "data")


@pytest.mark.parametrize("query", ["", None, "na", " NA ", "Na\n"])
def test_skipped(spark, query):
    df = spark.range(1)
    assert apply_sql(df, query) is df


@pytest.mark.parametrize("query", ["  ", "selec 1", "select nope from tabela_temp", "select 1 from nope"])
def test_refused(spark, query):
    with pytest.raises(TransformError) as e:
        apply_sql(spark.range(1), query)
    assert e.value.__cause__ is not None


def test_data_errors_are_lazy(spark):
    df = apply_sql(spark.createDataFrame([("x",)], "s string"), "select cast(s as int) i from tabela_temp;")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.collect()


def test_session_functions_are_visible(spark):
    spark.udf.register("twice", lambda x: x * 2, "long")
    assert apply_sql(spark.range(3), "select sum(twice(id)) s from tabela_temp").head()["s"] == 6


def test_threads_do_not_see_each_other(spark):
    def run(i):
        df = apply_sql(spark.range(10).withColumn("mine", F.lit(i)), "select distinct mine from tabela_temp")
        return [r["mine"] for r in df.collect()]

    with ThreadPoolExecutor(8) as pool:
        assert list(pool.map(run, range(40))) == [[i] for i in range(40)]


def test_statement_reaches_the_scan(spark, tmp_path, capsys):
    spark.range(100).selectExpr("id", "id * 2 as v", "'x' as unused").write.parquet(str(tmp_path / "t"))
    df, _ = with_partitions(spark.read.parquet(str(tmp_path / "t")), "unused", "nenhum")
    apply_sql(df, "select sum(v) as s from tabela_temp where id > 90").explain("formatted")
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<id:bigint,v:bigint>" in plan
    assert "GreaterThan(id,90)" in plan
