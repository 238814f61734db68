import pytest

from eclusa.errors import ContractError, IngestionError, SinkError
from eclusa.plans.ingest import Options, ingest
from eclusa.streaming.ingest import ingest_new_files
from tests.helpers import control_row, data_files, sorted_rows


class Feed:
    """A source folder that grows file by file."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def drop(self, *rows):
        df = self.spark.createDataFrame(list(rows), "k int, d string, v int")
        df.coalesce(1).write.mode("append").parquet(str(self.folder))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "source")


def row_for(feed, tmp_path, **settings):
    settings = {"modo_ingestao": "append", "colunas_esperadas": "k,d,v", **settings}
    return control_row(feed.folder, tmp_path / "target", **settings)


def test_every_file_once(spark, tmp_path, feed):
    row = row_for(feed, tmp_path, coluna_particao="d", tipo_particao="data", query="na")
    checkpoint = str(tmp_path / "c")
    feed.drop((1, "2024-01-01", 1))
    ingest_new_files(spark, row, checkpoint)
    feed.drop((2, "2024-02-01", 2))
    feed.drop((3, "2024-02-01", 3))
    ingest_new_files(spark, row, checkpoint)
    outcome = ingest_new_files(spark, row, checkpoint)
    assert sorted_rows(outcome.read(spark)) == [
        (1, "2024-01-01", 1, "2024", "01"),
        (2, "2024-02-01", 2, "2024", "02"),
        (3, "2024-02-01", 3, "2024", "02"),
    ]


def test_batch_append_takes_all_again(spark, tmp_path, feed):
    row = row_for(feed, tmp_path)
    feed.drop((1, "a", 1))
    ingest(spark, row)
    feed.drop((2, "a", 2))
    assert ingest(spark, row).read(spark).count() == 3


def test_statement_per_micro_batch(spark, tmp_path, feed):
    row = row_for(feed, tmp_path, query="select d, sum(v) as s from tabela_temp group by d")
    feed.drop((1, "a", 1), (2, "a", 2))
    feed.drop((3, "a", 4), (4, "b", 8))
    outcome = ingest_new_files(spark, row, str(tmp_path / "c"), max_files=1)
    assert sorted_rows(outcome.read(spark)) == [("a", 3), ("a", 4), ("b", 8)]
    folders = {f.parent.name.split("-", 1)[0] for f in data_files(tmp_path / "target")}
    assert folders == {"lote=0", "lote=1"}


def test_repeated_micro_batch_replaces_itself(spark, tmp_path, feed):
    row = row_for(feed, tmp_path, query="select count(*) as n from tabela_temp")
    feed.drop((1, "a", 1))
    checkpoint = tmp_path / "c"
    ingest_new_files(spark, row, str(checkpoint))
    # As after a crash between the write and the commit of the batch.
    for commit in (checkpoint / "commits").iterdir():
        commit.unlink()
    outcome = ingest_new_files(spark, row, str(checkpoint))
    assert sorted_rows(outcome.read(spark)) == [(1,)]


@pytest.mark.parametrize("query", ["na", "select count(*) as n from tabela_temp"])
def test_streams_that_share_a_target(spark, tmp_path, feed, query):
    other = Feed(spark, tmp_path / "other")
    feed.drop((1, "a", 1))
    other.drop((2, "b", 2), (3, "b", 3))
    row = row_for(feed, tmp_path, query=query)
    ingest_new_files(spark, row, str(tmp_path / "c1"))
    second = {**row, "caminho_origem": str(other.folder).lstrip("/")}
    outcome = ingest_new_files(spark, second, str(tmp_path / "c2"))
    expected = [(1, "a", 1), (2, "b", 2), (3, "b", 3)] if query == "na" else [(1,), (2,)]
    assert sorted_rows(outcome.read(spark)) == expected
    # A fresh checkpoint takes all files again, and replaces nobody's rows.
    outcome = ingest_new_files(spark, row, str(tmp_path / "c3"))
    assert outcome.read(spark).count() == len(expected) + 1


@pytest.mark.parametrize(
    "query, expected",
    [
        ("select k from tabela_temp limit 1", 2),
        ("select a.k from tabela_temp a join tabela_temp b on a.d = b.d", 8),
        ("select distinct d from tabela_temp", 2),
    ],
)
def test_statements_see_one_micro_batch(spark, tmp_path, feed, query, expected):
    feed.drop((1, "a", 1), (2, "a", 2))
    feed.drop((3, "a", 4), (4, "a", 8))
    row = row_for(feed, tmp_path, query=query)
    outcome = ingest_new_files(spark, row, str(tmp_path / "c"), max_files=1)
    assert outcome.read(spark).count() == expected
    assert not (tmp_path / "c" / "state").exists()


def test_commands_run_zero_times(spark, tmp_path, feed):
    feed.drop((1, "a", 1))
    spark.sql("create table if not exists visto (k int) using parquet")
    for query in ("insert into visto select k from tabela_temp", "drop table visto", "create table x as select 1"):
        with pytest.raises(IngestionError, match="must be a query"):
            ingest_new_files(spark, row_for(feed, tmp_path, query=query), str(tmp_path / "c"))
    assert spark.table("visto").count() == 0


def test_upsert_by_micro_batch(spark, tmp_path, feed):
    feed.drop((0, "z", 0))
    target = spark.createDataFrame([(1, "old", 0), (9, "old", 0)], "k int, d string, v int")
    target.write.parquet(str(tmp_path / "target"))
    row = row_for(feed, tmp_path, modo_ingestao="upsert", chaves="k")
    feed.drop((1, "a", 1), (2, "a", 1))
    feed.drop((2, "b", 2))
    ingest_new_files(spark, row, str(tmp_path / "c"), max_files=1)
    expected = [(0, "z", 0), (1, "a", 1), (2, "b", 2), (9, "old", 0)]
    assert sorted_rows(spark.read.parquet(str(tmp_path / "target"))) == expected
    outcome = ingest_new_files(spark, row, str(tmp_path / "again"), max_files=1)
    assert sorted_rows(outcome.read(spark)) == expected
    with pytest.raises(SinkError, match="existing"):
        ingest_new_files(spark, {**row, "caminho_destino": "missing"}, str(tmp_path / "m"))


def test_ambiguous_micro_batch(spark, tmp_path, feed):
    spark.sql("select 1 as k, 'old' as d, 0 as v").write.parquet(str(tmp_path / "target"))
    feed.drop((1, "a", 1), (1, "b", 2))
    row = row_for(feed, tmp_path, modo_ingestao="upsert", chaves="k")
    with pytest.raises(IngestionError, match="several source rows"):
        ingest_new_files(spark, row, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "target")).head()["d"] == "old"


def test_refusals(spark, tmp_path, feed):
    feed.drop((1, "a", 1))
    checkpoint = str(tmp_path / "c")
    for settings, error in (
        ({"modo_ingestao": "overwrite"}, SinkError),
        ({"modo_ingestao": "merge"}, SinkError),
        ({"colunas_esperadas": "k,v,d"}, ContractError),
        ({"query": "select k from tabela_temp", "coluna_particao": "d", "tipo_particao": "normal"}, SinkError),
        ({"query": "select nope from tabela_temp"}, IngestionError),
        ({"caminho_destino": f"{feed.folder}/inside".lstrip("/")}, SinkError),
    ):
        with pytest.raises(error):
            ingest_new_files(spark, row_for(feed, tmp_path, **settings), checkpoint)
    assert not (tmp_path / "target").exists()


def test_stream_and_batch_do_not_hide_each_others_rows(spark, tmp_path, feed):
    feed.drop((1, "a", 1))
    row = row_for(feed, tmp_path)
    ingest_new_files(spark, row, str(tmp_path / "c1"))
    for settings in ({}, {"modo_ingestao": "upsert", "chaves": "k"}):
        with pytest.raises(SinkError, match="stream"):
            ingest(spark, {**row, **settings})
    other = control_row(feed.folder, tmp_path / "other", colunas_esperadas="k,d,v")
    ingest(spark, other)
    with pytest.raises(SinkError, match="other files"):
        ingest_new_files(spark, {**other, "modo_ingestao": "append"}, str(tmp_path / "c2"))
    feed.drop((2, "a", 2), (3, "a", 3))
    outcome = ingest_new_files(spark, row, str(tmp_path / "c1"))
    assert outcome.read(spark).count() == 3


def test_hot_partition_of_a_stream_is_split(spark, tmp_path):
    source = spark.range(0, 60000, 1, 16).selectExpr("id", "if(id % 3 = 0, -1, id % 20) as p")
    source.write.parquet(str(tmp_path / "source"))
    row = control_row(
        tmp_path / "source",
        tmp_path / "target",
        modo_ingestao="append",
        colunas_esperadas="id,p",
        coluna_particao="p",
        tipo_particao="normal",
    )
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.files.openCostInBytes": "64MB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        outcome = ingest_new_files(spark, row, str(tmp_path / "c"))
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert outcome.read(spark).count() == 60000
    assert len([f for f in data_files(tmp_path / "target") if f.parent.name == "p=-1"]) > 1


@pytest.mark.parametrize("mode", ["append", "upsert"])
def test_codec(spark, tmp_path, feed, mode):
    feed.drop((1, "a", 1))
    if mode == "upsert":
        spark.sql("select 0 as k, 'z' as d, 0 as v").write.parquet(str(tmp_path / "target"))
    row = row_for(feed, tmp_path, modo_ingestao=mode, chaves="k", compressao="gzip")
    ingest_new_files(spark, row, str(tmp_path / "c"), Options(compress=True))
    assert all(f.name.endswith(".gz.parquet") for f in data_files(tmp_path / "target"))
