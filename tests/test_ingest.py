import pytest

from eclusa import Options, ingest, load_control, raise_failures, run_arrivals, run_dataset
from eclusa.errors import (
    ContractError,
    ControlError,
    IngestionError,
    MergeError,
    SinkError,
    SourceError,
    TransformError,
)
from eclusa.functions.locations import uri
from tests.helpers import control_row, sorted_rows
from tests.test_control import write_csv


@pytest.fixture
def source(spark, tmp_path):
    path = tmp_path / "source"
    df = spark.range(20).selectExpr("id", "if(id % 2 = 0, '2024-01-05', '2023-12-01') as d", "id * 2 as v")
    df.write.parquet(str(path))
    return path


def test_uri():
    assert uri("b", "p/q") == "s3://b/p/q"
    assert uri("b", "p", "gs") == "gs://b/p"
    assert uri("hdfs://n:1", "p") == "hdfs://n:1/p"


def test_whole_run(spark, tmp_path, source):
    row = control_row(
        source,
        tmp_path / "target",
        dataset_id="monthly",
        formato_destino="orc",
        coluna_particao="d",
        tipo_particao="data",
        colunas_esperadas="id, d, v",
        query="select ano, mes, sum(v) as total from tabela_temp group by ano, mes",
    )
    control = load_control(spark, write_csv(tmp_path / "c.csv", [row]))
    outcome = run_dataset(spark, control, "monthly")
    assert outcome.read(spark).columns == ["ano", "mes", "total"]
    assert sorted_rows(outcome.read(spark)) == [("2023", "12", 200), ("2024", "01", 180)]
    assert {p.name for p in (tmp_path / "target").iterdir() if p.is_dir()} == {"ano=2023", "ano=2024"}
    with pytest.raises(ControlError):
        run_dataset(spark, control, "weekly")


def test_upsert_run(spark, tmp_path, source):
    spark.sql("select 3L as id, 'x' as d, 0L as v union all select 99L, 'y', 1L").write.parquet(
        str(tmp_path / "target")
    )
    row = control_row(
        source,
        tmp_path / "target",
        modo_ingestao="Upsert",
        chaves=" id ",
        colunas_esperadas="id,d,v",
        coluna_particao="d",
        tipo_particao="data",
        query="NA",
    )
    back = ingest(spark, row).read(spark)
    assert back.columns == ["id", "d", "v"] and back.count() == 21
    assert spark.read.parquet(str(tmp_path / "target")).columns == ["id", "d", "v"]
    assert sorted_rows(back.filter("id in (3, 99)")) == [(3, "2023-12-01", 6), (99, "y", 1)]
    with pytest.raises(MergeError):
        ingest(spark, {**row, "chaves": " , "})


@pytest.mark.parametrize(
    "settings, error",
    [
        ({"modo_ingestao": "replace", "caminho_origem": "missing"}, SinkError),
        ({"caminho_origem": "missing"}, SourceError),
        ({"formato_origem": "nope"}, SourceError),
        ({"colunas_esperadas": ""}, ContractError),
        ({"colunas_esperadas": "id,v,d"}, ContractError),
        ({"query": "select nope from tabela_temp"}, TransformError),
        ({"tipo_particao": "data", "coluna_particao": "nope"}, IngestionError),
        ({"tipo_particao": "normal", "coluna_particao": "id,nope"}, SinkError),
        (
            {"tipo_particao": "data", "coluna_particao": "d", "query": "select v from tabela_temp"},
            SinkError,
        ),
        ({"modo_ingestao": "upsert", "chaves": "id"}, MergeError),
    ],
)
def test_refused_before_anything_is_written(spark, tmp_path, source, settings, error):
    row = control_row(source, tmp_path / "target", colunas_esperadas="id,d,v")
    with pytest.raises(error):
        ingest(spark, {**row, **settings})
    assert not (tmp_path / "target").exists()


def test_overwriting_the_source_is_refused(spark, tmp_path, source):
    for mode in ("overwrite", "upsert"):
        row = control_row(source, source, modo_ingestao=mode, chaves="id", colunas_esperadas="id,d,v")
        with pytest.raises(SinkError, match="overlap"):
            ingest(spark, row)
    assert spark.read.parquet(str(source)).count() == 20


def test_empty_result(spark, tmp_path, source):
    row = control_row(source, tmp_path / "target", colunas_esperadas="id,d,v")
    ingest(spark, row)
    nothing = {**row, "query": "select * from tabela_temp where id < 0"}
    with pytest.raises(SourceError):
        ingest(spark, nothing, Options(refuse_empty_result=True))
    assert spark.read.parquet(str(tmp_path / "target")).count() == 20
    assert ingest(spark, nothing).read(spark).count() == 0


def test_options_beyond_the_plain_run(spark, tmp_path, source):
    row = control_row(
        source,
        tmp_path / "target",
        colunas_esperadas="id,d,v",
        compressao="gzip",
        glue_database="default",
        glue_tabela="ingested",
    )
    ingest(spark, row)
    assert not spark.catalog.tableExists("default.ingested")
    assert not list((tmp_path / "target").glob("*.gz.parquet"))
    ingest(spark, row, Options(compress=True, catalog=True))
    assert spark.table("default.ingested").count() == 20
    assert list((tmp_path / "target").glob("*.gz.parquet"))
    spark.sql("drop table default.ingested")
    ingest(spark, {**row, "compressao": ""}, Options(compress=True))


def test_arrivals(spark, tmp_path, source):
    common = {"colunas_esperadas": "id,d,v"}
    rows = [
        control_row(source, tmp_path / "a", dataset_id="a", prefixo="in/a/", **common),
        control_row(source, tmp_path / "b", dataset_id="b", prefixo="in/b/", modo_ingestao="bad", **common),
        control_row(source, tmp_path / "c", dataset_id="c", prefixo="in/c/", modo_ingestao="append", **common),
        control_row(source, tmp_path / "c", dataset_id="c2", prefixo="in/c2/", modo_ingestao="append", **common),
        control_row(source, tmp_path / "d", dataset_id="d", prefixo="in/d/", **common),
    ]
    control = load_control(spark, write_csv(tmp_path / "c.csv", rows))
    keys = [f"in/{x}/{i}" for x in ("a", "b", "c", "c2") for i in range(50)] + ["out/1"]
    arrivals = spark.createDataFrame([(k,) for k in keys], "key string")
    report = run_arrivals(spark, control, arrivals)
    assert sorted(o.dataset_id for o in report.done) == ["a", "c", "c2"]
    assert list(report.failed) == ["b"]
    assert [r["key"] for r in report.unroutable.collect()] == ["out/1"]
    assert report.arrived == {"a": 50, "b": 50, "c": 50, "c2": 50, None: 1}
    assert spark.read.parquet(str(tmp_path / "c")).count() == 40
    assert not (tmp_path / "d").exists()
    with pytest.raises(IngestionError, match="out/1"):
        raise_failures(report)
    with pytest.raises(IngestionError, match="failed for b"):
        raise_failures(run_arrivals(spark, control, arrivals.filter("key like 'in/b%'")))
