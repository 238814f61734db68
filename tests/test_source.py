import pytest

from eclusa.errors import ContractError, SourceError
from eclusa.sources.scan import check_contract, expected_columns, require_rows, scan


def test_unreadable_sources(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for fmt, path in (
        ("parquet", tmp_path / "missing"),
        ("parquet", tmp_path / "empty"),
        ("no_such_format", tmp_path / "empty"),
    ):
        with pytest.raises(SourceError) as e:
            scan(spark, fmt, str(path))
        assert isinstance(e.value, ValueError) and e.value.__cause__ is not None


def test_no_rows(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "t"))
    with pytest.raises(SourceError, match="no rows"):
        require_rows(scan(spark, "parquet", str(tmp_path / "t")))


def test_explicit_schema(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"b": 1, "a": "x"}\n')
    assert scan(spark, "json", str(tmp_path)).columns == ["a", "b"]
    assert scan(spark, "json", str(tmp_path), "b int, a string").head() == (1, "x")


def test_csv_header_is_data(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2\n")
    df = scan(spark, "csv", str(tmp_path))
    assert df.columns == ["_c0", "_c1"] and df.count() == 2


@pytest.mark.parametrize("declared", ["", None])
def test_nothing_declared(declared):
    with pytest.raises(ContractError):
        expected_columns(declared)


def test_contract(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert check_contract(df, " a,b ") is df
    for declared in ("b,a", "a,B", "a", "a,b,c", "a,b,", " "):
        with pytest.raises(ContractError):
            check_contract(df, declared)
