"""Upserts, and ingestions that take new files only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.common import control_row, table
from eclusa.errors import IngestionError
from eclusa.functions.locations import BATCH_COLUMN, fresh_path
from eclusa.operators.partitioning import with_partitions
from eclusa.operators.sink import write
from eclusa.operators.upsert import upsert
from eclusa.plans.ingest import Options, ingest
from eclusa.streaming.ingest import ingest_new_files


def _merged(target: DataFrame, source: DataFrame, keys: list[str], *partitions: str) -> DataFrame:
    spark = target.sparkSession
    path = fresh_path(spark, "destino")
    write(target, path, "parquet", "overwrite", partitions)
    upsert(source, path, keys)
    return spark.read.schema(target.schema).parquet(path).select(target.columns)


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One open entry per order that has lines."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("pedido"))
    return lines.agg(
        F.count("*").alias("linhas"), F.lit("aberto").alias("estado"), F.lit(0.0).alias("total")
    )


def upsert_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed orders update the ledger; orders without lines are new to it."""
    closed = (
        table(spark, sf_dir, "orders")
        .filter("o_orderstatus <> 'P'")
        .select(
            F.col("o_totalprice").alias("total"),
            F.col("o_orderstatus").alias("estado"),
            F.col("o_orderkey").alias("PEDIDO"),
            F.lit(0).alias("linhas"),
            "o_custkey",
        )
    )
    return _merged(_ledger(spark, sf_dir), closed, ["pedido"])


def upsert_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target repeats keys, the source does not."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey"]
    lines = table(spark, sf_dir, "lineitem")
    target = lines.filter("l_returnflag <> 'R'").select(columns)
    source = (
        lines.filter("l_returnflag <> 'A'")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.max("l_partkey").alias("l_partkey"))
    )
    return _merged(target, source, ["l_orderkey", "l_linenumber"])


def upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors have no key on either side, clicks lose their value."""
    events = table(spark, sf_dir, "events").withColumn(
        "chave", F.when(F.col("event_type") != "error", F.col("event_id"))
    )
    target = events.filter("event_type <> 'signup'").select("chave", "value")
    source = events.filter("event_type <> 'view'").select(
        "chave", F.when(F.col("event_type") != "click", -F.col("value")).alias("value")
    )
    return _merged(target, source, ["chave"])


def upsert_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the target shares one key; the source has one row for it."""
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "chave", F.when(F.col("l_returnflag") == "A", -1).otherwise(F.col("l_orderkey"))
    )
    source = (
        lines.filter("l_linestatus = 'F'")
        .groupBy("chave")
        .agg(F.max("l_partkey").alias("l_partkey"), F.max("l_quantity").alias("l_quantity"))
    )
    target = lines.filter("l_linestatus <> 'F' or l_returnflag = 'A'")
    return _merged(target.select("chave", "l_partkey", "l_quantity"), source, ["chave"])


def upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys contain the partition column: partitions without source rows stay untouched."""
    orders = table(spark, sf_dir, "orders")
    target = orders.filter("o_orderstatus <> 'P'")
    source = orders.filter("o_orderpriority in ('1-URGENT', '5-LOW')").withColumn(
        "o_totalprice", -F.col("o_totalprice")
    )
    return _merged(target, source, ["o_orderpriority", "o_orderkey"], "o_orderpriority")


def upsert_moves_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months are partitions but not keys: an update may move a row to another month."""
    orders, months = with_partitions(table(spark, sf_dir, "orders"), "o_orderdate", "data")
    target = orders.filter("o_orderstatus <> 'P'")
    later = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    later = later.withColumn("o_orderdate", F.expr("o_orderdate + interval 40 days"))
    source, _ = with_partitions(later, "o_orderdate", "data")
    return _merged(target, source, ["o_orderkey"], *months)


def _stream(
    spark: SparkSession, drops: list[DataFrame], target: str, **settings: str
) -> DataFrame:
    """Ingest new files after every drop into a folder, and once more without a drop."""
    source = fresh_path(spark, "chegada")
    checkpoint = fresh_path(spark, "andamento")
    declared = ",".join(drops[0].columns)
    row = control_row(spark, source, target, colunas_esperadas=declared, **settings)
    for drop in drops:
        drop.write.mode("append").parquet(source)
        ingest_new_files(spark, row, checkpoint)
    return ingest_new_files(spark, row, checkpoint).read(spark)


def _event_drops(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    events = table(spark, sf_dir, "events")
    early = F.col("event_type").isin("click", "view")
    return [events.filter(early), events.filter(~early)]


def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream(
        spark,
        _event_drops(spark, sf_dir),
        fresh_path(spark, "destino"),
        modo_ingestao="append",
        coluna_particao="ts",
        tipo_particao="data",
        query="na",
    )


def stream_append_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A statement that works row by row."""
    return _stream(
        spark,
        _event_drops(spark, sf_dir),
        fresh_path(spark, "destino"),
        modo_ingestao="append",
        coluna_particao="event_type",
        tipo_particao="normal",
        query="select event_id, cast(get_json_object(props, '$.k') as int) as k, event_type "
        "from tabela_temp where value > 10",
    )


def stream_append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A statement that aggregates sees one micro-batch at a time."""
    result = _stream(
        spark,
        _event_drops(spark, sf_dir),
        fresh_path(spark, "destino"),
        modo_ingestao="append",
        query="select user_id, count(*) as n, round(sum(value), 2) as total "
        "from tabela_temp group by user_id",
    )
    assert BATCH_COLUMN not in result.columns
    return result


def _shared(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    """Two datasets with a source and a checkpoint each, streamed into one target."""
    target = fresh_path(spark, "destino")
    settings = {"modo_ingestao": "append", "query": query}
    for drop in _event_drops(spark, sf_dir):
        result = _stream(spark, [drop], target, **settings)
    return result


def stream_shared_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shared(spark, sf_dir, "na")


def stream_shared_target_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = "select event_type, count(*) as n, max(value) as top from tabela_temp group by event_type"
    return _shared(spark, sf_dir, query)


def refused_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that must be refused, over a target whose rows stay: unknown mode, no declared
    columns, a missing source and a file that isn't what its format says."""
    target, broken = fresh_path(spark, "destino"), fresh_path(spark, "origem")
    orders = table(spark, sf_dir, "orders")
    orders.write.parquet(target)
    table(spark, sf_dir, "pages").select("url").write.text(broken)
    good = {"modo_ingestao": "overwrite", "colunas_esperadas": ",".join(orders.columns)}
    source = f"{sf_dir}/orders.parquet"
    for location, settings, schema in (
        (source, {"modo_ingestao": "replace"}, None),
        (source, {"colunas_esperadas": ""}, None),
        (fresh_path(spark, "nada"), {}, None),
        (broken, {}, orders.schema),
    ):
        row = control_row(spark, location, target, **{**good, **settings})
        try:
            ingest(spark, row, Options(schema=schema))
        except IngestionError:
            continue
        raise AssertionError(f"not refused: {settings or location}")
    return spark.read.parquet(target)


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``upsert_single_key``, the closed orders arriving in two drops."""
    target = fresh_path(spark, "destino")
    ledger = _ledger(spark, sf_dir)
    ledger.write.parquet(target)
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return _stream(
        spark,
        [orders.filter(urgent), orders.filter(~urgent)],
        target,
        modo_ingestao="upsert",
        chaves="pedido",
        query="select o_orderkey as pedido, 0 as linhas, o_orderstatus as estado, "
        "o_totalprice as total from tabela_temp",
    )


QUERIES = {
    f.__name__: f
    for f in (
        upsert_single_key,
        upsert_composite_key,
        upsert_null_keys,
        upsert_hot_key,
        upsert_partitioned,
        upsert_moves_partition,
        stream_append,
        stream_append_sql,
        stream_append_batches,
        stream_shared_target,
        stream_shared_target_sql,
        refused_runs,
        stream_upsert,
    )
}

LEDGER = """
    with t as (select l_orderkey as pedido, count(*) as linhas from lineitem group by l_orderkey),
    s as (select * from orders where o_orderstatus <> 'P')
    select coalesce(t.pedido, s.o_orderkey) as pedido,
           case when s.o_orderkey is null then t.linhas else 0 end as linhas,
           coalesce(s.o_orderstatus, 'aberto') as estado,
           coalesce(s.o_totalprice, 0.0::double) as total
    from t full join s on t.pedido = s.o_orderkey"""

ORACLE = {
    "upsert_single_key": LEDGER,
    "upsert_composite_key": """
        with t as (select l_orderkey, l_linenumber, l_partkey from lineitem
                   where l_returnflag <> 'R'),
        s as (select l_orderkey, l_linenumber, max(l_partkey) as l_partkey from lineitem
              where l_returnflag <> 'A' group by l_orderkey, l_linenumber)
        select t.l_orderkey, t.l_linenumber, coalesce(s.l_partkey, t.l_partkey) as l_partkey
        from t left join s using (l_orderkey, l_linenumber)
        union all
        select * from s anti join t using (l_orderkey, l_linenumber)""",
    "upsert_null_keys": """
        select event_id as chave, value from events where event_type = 'view'
        union all
        select event_id, case when event_type <> 'click' then -value end from events
        where event_type not in ('view', 'error')
        union all
        select null, value from events where event_type = 'error'
        union all
        select null, -value from events where event_type = 'error'""",
    "upsert_hot_key": """
        with l as (select *, case when l_returnflag = 'A' then -1 else l_orderkey end as chave
                   from lineitem),
        t as (select * from l where l_linestatus <> 'F' or l_returnflag = 'A'),
        s as (select chave, max(l_partkey) as l_partkey, max(l_quantity) as l_quantity
              from l where l_linestatus = 'F' group by chave)
        select t.chave, coalesce(s.l_partkey, t.l_partkey) as l_partkey,
               coalesce(s.l_quantity, t.l_quantity) as l_quantity
        from t left join s using (chave)
        union all
        select * from s anti join t using (chave)""",
    "upsert_partitioned": """
        select * replace (-o_totalprice as o_totalprice) from orders
        where o_orderpriority in ('1-URGENT', '5-LOW')
        union all
        select * from orders
        where o_orderpriority not in ('1-URGENT', '5-LOW') and o_orderstatus <> 'P'""",
    "upsert_moves_partition": """
        select *, substr(cast(o_orderdate as varchar), 1, 4) as ano,
               substr(cast(o_orderdate as varchar), 6, 2) as mes
        from (select * replace (case when o_orderstatus = 'F' then o_orderdate
                                else o_orderdate + interval 40 days end as o_orderdate)
              from orders)""",
    "stream_append": """
        select *, substr(cast(ts as varchar), 1, 4) as ano,
               substr(cast(ts as varchar), 6, 2) as mes
        from events""",
    "stream_append_sql": """
        select event_id, cast(json_extract_string(props, '$.k') as integer) as k, event_type
        from events where value > 10""",
    "stream_append_batches": """
        select user_id, count(*) as n, round(sum(value), 2) as total
        from events group by user_id, event_type in ('click', 'view')""",
    "stream_shared_target": "select * from events",
    "stream_shared_target_sql": """
        select event_type, count(*) as n, max(value) as top from events group by event_type""",
    "refused_runs": "select * from orders",
    "stream_upsert": LEDGER,
}
