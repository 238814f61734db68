"""Runs that fail, repeat, wait for each other or meet what others wrote."""

import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eclusa import Options, ingest, load_control, raise_failures, run_arrivals
from eclusa.errors import IngestionError, SinkError, TransformError
from eclusa.functions.locations import Files
from eclusa.operators.sink import write
from eclusa.operators.transform import apply_sql, own_session, refuse_commands
from eclusa.operators.upsert import upsert
from eclusa.plans.ingest import waves
from eclusa.streaming.arrivals import ingest_new_arrivals
from eclusa.streaming.ingest import ingest_new_files
from tests.helpers import control_row, sorted_rows
from tests.test_control import write_csv
from tests.test_streaming import Feed


def test_failed_overwrite_keeps_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    write(spark.range(5), path, "parquet", "overwrite")
    bad = spark.range(9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("no"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        write(bad, path, "parquet", "overwrite")
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    write(spark.range(3), path, "parquet", "overwrite")
    assert spark.read.parquet(path).count() == 3


def test_interrupted_overwrite_is_mended(spark, tmp_path):
    path = tmp_path / "t"
    write(spark.range(5), str(path), "parquet", "overwrite")
    path.rename(tmp_path / ".t.antes")  # as after a crash between both renames
    write(spark.range(2), str(path), "parquet", "overwrite")
    assert spark.read.parquet(str(path)).count() == 2 and not (tmp_path / ".t.antes").exists()


@pytest.mark.parametrize("partitions", [{}, {"coluna_particao": "d", "tipo_particao": "normal"}])
def test_append_of_a_repeated_run(spark, tmp_path, partitions, monkeypatch):
    spark.range(12).selectExpr("id", "id % 3 as d").repartition(3).write.parquet(str(tmp_path / "s"))
    row = control_row(
        tmp_path / "s", tmp_path / "t", dataset_id="d", colunas_esperadas="id,d", modo_ingestao="append", **partitions
    )

    def rows():
        return spark.read.parquet(str(tmp_path / "t")).count()

    ingest(spark, row, Options(run="one"))
    ingest(spark, row, Options(run="one"))
    assert rows() == 12
    ingest(spark, row)  # no name: adds all again, as ever
    ingest(spark, row, Options(run="two"))
    assert rows() == 36

    # A run that is lost after some of its files were moved, and one that is lost before.
    rename, moves = Files.rename, []

    def lost(self, old, new):
        moves.append(old)
        if len(moves) > 1:
            raise KeyboardInterrupt
        return rename(self, old, new)

    monkeypatch.setattr(Files, "rename", lost)
    with pytest.raises(KeyboardInterrupt):
        ingest(spark, row, Options(run="three"))
    monkeypatch.setattr(Files, "rename", rename)
    ingest(spark, row, Options(run="three"))
    ingest(spark, row, Options(run="three"))
    assert rows() == 48 and sorted(p.name for p in tmp_path.iterdir()) == ["s", "t"]

    touch = Files.touch
    monkeypatch.setattr(Files, "touch", lambda self, path: lost(self, path, path) and None)
    with pytest.raises(KeyboardInterrupt):
        ingest(spark, row, Options(run="four"))
    monkeypatch.setattr(Files, "touch", touch)
    ingest(spark, row, Options(run="four"))
    assert rows() == 60


@pytest.mark.parametrize("log", ["_delta_log", ".hoodie", "metadata/version-hint.text"])
@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_table_logs_are_not_written_over(spark, tmp_path, log, mode):
    path = tmp_path / "t"
    write(spark.range(5), str(path), "parquet", "overwrite")
    (path / log).mkdir(parents=True)
    with pytest.raises(SinkError, match="table of"):
        write(spark.range(2), str(path), "parquet", mode)
    assert (path / log).exists() and spark.read.parquet(str(path)).count() == 5


def test_a_column_called_as_the_streams_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "7-a"), (2, "8")], "k int, lote string")
    write(rows, path, "parquet", "overwrite", ["lote"])
    write(rows, path, "parquet", "append", ["lote"])
    upsert(spark.createDataFrame([(3, "8")], "k int, lote string"), path, ["k"])
    assert sorted_rows(spark.read.schema(rows.schema).parquet(path)) == [
        (1, "7-a"), (1, "7-a"), (2, "8"), (2, "8"), (3, "8"),
    ]


@pytest.mark.parametrize(
    "query",
    [
        "with x as (select * from tabela_temp) insert into t select * from x",
        "from tabela_temp insert into a select * insert into b select *",
        "create table t as select 1",
    ],
)
def test_commands_anywhere_in_a_statement(spark, query):
    with pytest.raises(TransformError, match="must be a query"):
        refuse_commands(spark, query)
    refuse_commands(spark, "with x as (select 1 as a) select * from x where a in (select 1)")


@pytest.mark.parametrize("partitions", [{}, {"coluna_particao": "d", "tipo_particao": "normal"}])
def test_replayed_micro_batch_without_keys(spark, tmp_path, partitions):
    feed = Feed(spark, tmp_path / "source")
    row = control_row(
        feed.folder, tmp_path / "target", modo_ingestao="upsert", chaves="k", colunas_esperadas="k,d,v", **partitions
    )
    write(
        spark.createDataFrame([(1, "a", 1)], "k int, d string, v int"),
        str(tmp_path / "target"), "parquet", "overwrite", ["d"] if partitions else [],
    )
    feed.drop((None, "n", 5), (1, "a", 9))
    checkpoint = tmp_path / "c"
    for _ in range(2):
        outcome = ingest_new_files(spark, row, str(checkpoint))
        for commit in (checkpoint / "commits").iterdir():
            commit.unlink()  # as after a crash between the merge and the commit
    assert sorted_rows(outcome.read(spark).select("k", "d", "v")) == [(1, "a", 9), (None, "n", 5)]
    # A later batch, and another stream's first one, are merged.
    feed.drop((2, "b", 2))
    ingest_new_files(spark, row, str(checkpoint))
    outcome = ingest_new_files(spark, row, str(tmp_path / "other"))
    assert outcome.read(spark).filter("k is null").count() == 2
    assert outcome.read(spark).filter("k = 2").count() == 1


def test_order_of_chained_targets():
    chain = {"f:/c": {"f:/b/x"}, "f:/b": {"f:/a"}, "f:/a": {"f:/0"}, "f:/z": {"f:/"}, "g:/a": {"g:/ab"}}
    first, *rest = waves(chain)
    assert sorted(first) == ["f:/a", "g:/a"] and rest == [["f:/b"], ["f:/c"], ["f:/z"]]
    assert waves({}) == [] and waves({"f:/a": {"f:/a/x"}}) == [["f:/a"]]
    with pytest.raises(IngestionError, match="f:/a, f:/b"):
        waves({"f:/a": {"f:/b"}, "f:/b": {"f:/a/x"}, "f:/c": {"f:/0"}})


def test_datasets_that_read_each_other_run_zero_times(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(3).write.parquet(str(tmp_path / name))
    rows = [
        control_row(tmp_path / x, tmp_path / y, dataset_id=x, prefixo=f"/{x}/", colunas_esperadas="id", modo_ingestao="append")
        for x, y in ("ab", "ba")
    ]
    control = load_control(spark, write_csv(tmp_path / "c.csv", rows))
    keys = spark.createDataFrame([("in/a/1",), ("in/b/1",)], "key string")
    with pytest.raises(IngestionError, match="each other"):
        run_arrivals(spark, control, keys)
    assert spark.read.parquet(str(tmp_path / "a")).count() == 3


def test_schemas_by_dataset(spark, tmp_path):
    rows, schemas = [], {}
    for name, columns in (("a", "x int, y string"), ("b", "z double")):
        schemas[name] = StructType.fromDDL(columns)
        value = (1, "q") if name == "a" else (2.5,)
        spark.createDataFrame([value], columns).write.json(str(tmp_path / name))
        rows.append(
            control_row(
                tmp_path / name, tmp_path / f"to_{name}", dataset_id=name, prefixo=f"/{name}/",
                formato_origem="json", colunas_esperadas=",".join(schemas[name].names),
            )
        )
    control = load_control(spark, write_csv(tmp_path / "c.csv", rows))
    keys = spark.createDataFrame([("in/a/1",), ("in/b/1",)], "key string")
    report = raise_failures(run_arrivals(spark, control, keys, options=Options(schema=schemas)))
    assert {o.dataset_id: o.schema for o in report.done} == schemas


def test_slow_statements_overlap(spark):
    """Sessions don't wait for each other's statements, nor see each other's views."""
    running, most, lock = [0], [0], threading.Lock()

    def slow(x):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.5)
        with lock:
            running[0] -= 1
        return x

    def run(i):
        own = own_session(spark)
        sql = own.sql

        def waiting(query):
            slow(0)
            return sql(query)

        own.sql = waiting
        df = own.range(3).withColumn("mine", F.lit(i))
        df.__dict__["_session"] = own
        return [r.mine for r in apply_sql(df, "select distinct mine from tabela_temp").collect()]

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(run, range(4))) == [[0], [1], [2], [3]]
    assert most[0] == 2


def test_a_session_of_its_own_knows_the_views_of_the_first(spark, tmp_path):
    spark.range(4).createOrReplaceTempView("known_view")
    spark.range(2).write.parquet(str(tmp_path / "s"))
    row = control_row(
        tmp_path / "s", tmp_path / "t", colunas_esperadas="id",
        query="select t.id from known_view v join tabela_temp t on t.id = v.id",
    )
    assert ingest(spark, row).read(spark).count() == 2


def test_arrivals_that_fail_come_again(spark, tmp_path):
    inbox, target = str(tmp_path / "inbox"), str(tmp_path / "t")
    row = control_row(tmp_path / "s", target, dataset_id="d", prefixo="/d/", colunas_esperadas="id")
    control = load_control(spark, write_csv(tmp_path / "c.csv", [row]))
    spark.createDataFrame([("in/d/1",)], "key string").write.parquet(inbox)
    seen = []

    def run():
        arrivals = spark.readStream.schema("key string").parquet(inbox)
        ingest_new_arrivals(spark, control, arrivals, str(tmp_path / "c"), seen=lambda n, r: seen.append((n, r.arrived)))

    with pytest.raises(IngestionError):
        run()  # its source is not there yet
    spark.range(3).write.parquet(str(tmp_path / "s"))
    run()
    run()
    assert spark.read.parquet(target).count() == 3 and seen == [(0, {"d": 1})] * 2


@pytest.mark.parametrize("partitions", [{}, {"coluna_particao": "d", "tipo_particao": "normal"}])
def test_catalog_names_show_the_folders_rows(spark, tmp_path, partitions):
    """After each mode, also where partitions come and go."""
    feed = Feed(spark, tmp_path / "source")
    feed.drop((1, "a", 1), (2, "b", 2))
    name = "named_" + ("by_d" if partitions else "flat")
    row = control_row(
        feed.folder, tmp_path / "target", colunas_esperadas="k,d,v", chaves="k",
        glue_database="default", glue_tabela=name, **partitions,
    )
    options = Options(catalog=True)

    def shown():
        return sorted_rows(spark.table(f"default.{name}").select("k", "d", "v"))

    def run(mode, **settings):
        outcome = ingest(spark, {**row, "modo_ingestao": mode, **settings}, options)
        assert shown() == sorted_rows(outcome.read(spark).select("k", "d", "v"))

    run("overwrite")
    run("append")
    run("overwrite", query="select * from tabela_temp where d = 'a'")
    feed.drop((3, "c", 3), (1, "z", 9))
    run("upsert", query="select * from tabela_temp where v > 1")  # 1 moves from a, which is left empty
    assert shown() == [(1, "z", 9), (2, "b", 2), (3, "c", 3)]
    streamed = control_row(
        feed.folder, tmp_path / "streamed", colunas_esperadas="k,d,v", modo_ingestao="append",
        glue_database="default", glue_tabela=name + "_s", **partitions,
    )
    for i in range(2):
        outcome = ingest_new_files(spark, streamed, str(tmp_path / "c"), options)
        named = sorted_rows(spark.table(f"default.{name}_s").select("k", "d", "v"))
        assert named == sorted_rows(outcome.read(spark).select("k", "d", "v")) and len(named) == 4 + i
        feed.drop((8, "h", 8))
