"""Partitions, SQL statements, sinks and whole ingestions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.common import columns_of, control_file, control_row, table
from eclusa.functions.locations import fresh_path
from eclusa.operators.partitioning import with_partitions
from eclusa.operators.sink import write
from eclusa.operators.transform import apply_sql
from eclusa.plans.ingest import ingest, raise_failures, run_arrivals, run_dataset
from eclusa.sources.control import load_control
from eclusa.streaming.arrivals import ingest_new_arrivals


def _read_back(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    spark = df.sparkSession
    return spark.read.format(fmt).schema(df.schema).load(path).select(df.columns)


def _dated_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    return with_partitions(table(spark, sf_dir, "orders"), "o_orderdate", "data")


def partition_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated_orders(spark, sf_dir)[0]


def partition_by_date_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_partitions(table(spark, sf_dir, "events"), "ts", "data")[0]


def partition_by_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    orders, names = with_partitions(orders, "o_orderstatus, o_orderpriority", "normal")
    path = fresh_path(spark, "destino")
    write(orders, path, "parquet", "overwrite", names)
    return _read_back(orders, path)


def write_unpartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, names = with_partitions(table(spark, sf_dir, "lineitem"), "l_shipdate", "nenhum")
    path = fresh_path(spark, "destino")
    write(lines, path, "orc", "overwrite", names)
    return _read_back(lines, path, "orc")


def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, names = _dated_orders(spark, sf_dir)
    path = fresh_path(spark, "destino")
    write(orders, path, "parquet", "overwrite", names)
    return _read_back(orders, path)


def write_overwrite_replaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second overwrite brings one year only; the other years' partitions must vanish."""
    orders, names = _dated_orders(spark, sf_dir)
    path = fresh_path(spark, "destino")
    write(orders, path, "parquet", "overwrite", names)
    write(orders.filter("ano = '1995'"), path, "parquet", "overwrite", names)
    return _read_back(orders, path)


def overwrite_failed_keeps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An overwrite that fails at one of its rows leaves the target as it was."""
    orders, names = _dated_orders(spark, sf_dir)
    path = fresh_path(spark, "destino")
    write(orders, path, "parquet", "overwrite", names)
    last = orders.agg(F.max("o_orderkey")).head()[0]
    broken = F.raise_error(F.lit("broken row")).cast("string")
    status = F.when(F.col("o_orderkey") == last, broken).otherwise(F.col("o_orderstatus"))
    try:
        write(orders.withColumn("o_orderstatus", status), path, "parquet", "overwrite", names)
    except Exception as e:
        if "broken row" not in str(e):
            raise
        return _read_back(orders, path)
    raise AssertionError("the overwrite was to fail")


def write_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, names = _dated_orders(spark, sf_dir)
    path = fresh_path(spark, "destino")
    write(orders, path, "parquet", "overwrite", names)
    write(orders.filter("o_orderstatus = 'F'"), path, "parquet", "append", names)
    return _read_back(orders, path)


# The statements of control rows, and the table each one runs on.
STATEMENTS = {
    "sql_filter": (
        "events",
        "select event_id, user_id, value from tabela_temp "
        "where event_type = 'purchase' and value > 10",
    ),
    "sql_agg": (
        "lineitem",
        "select l_returnflag, l_linestatus, count(*) as n, "
        "round(sum(l_extendedprice * (1 - l_discount)), 2) as rev "
        "from tabela_temp group by l_returnflag, l_linestatus",
    ),
    "sql_cube": (
        "lineitem",
        "select l_returnflag, l_linestatus, count(*) as n "
        "from tabela_temp group by cube (l_returnflag, l_linestatus)",
    ),
    "sql_window": (
        "events",
        "select event_id, user_id, row_number() over (partition by user_id order by ts, event_id) "
        "as rn from tabela_temp",
    ),
    "sql_join": (
        "orders",
        "select c.c_mktsegment, count(*) as n from tabela_temp t "
        "join customer c on t.o_custkey = c.c_custkey group by c.c_mktsegment",
    ),
    "sql_semi_join": (
        "customer",
        "select c_custkey, c_name from tabela_temp semi join orders on c_custkey = o_custkey",
    ),
    "sql_anti_join": (
        "orders",
        "select o_orderkey, o_custkey from tabela_temp "
        "anti join lineitem on o_orderkey = l_orderkey",
    ),
    "sql_topk": (
        "orders",
        "select o_orderkey, o_totalprice from tabela_temp "
        "order by o_totalprice desc, o_orderkey limit 100",
    ),
    "sql_distinct": ("lineitem", "select distinct l_orderkey, l_linenumber from tabela_temp"),
    "sql_union": (
        "orders",
        "select o_custkey as pessoa from tabela_temp "
        "union select user_id as pessoa from events",
    ),
    "sql_except": (
        "orders",
        "select o_custkey from tabela_temp where o_orderstatus = 'P' "
        "except select o_custkey from tabela_temp where o_orderpriority = '1-URGENT'",
    ),
    "sql_json": (
        "events",
        "select event_id, cast(get_json_object(props, '$.k') as int) as k from tabela_temp",
    ),
    "sql_skip_na": ("orders", " NA "),
}


def _statement(name: str):
    source, statement = STATEMENTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # A statement reaches further datasets by their paths.
        query = statement
        for other in ("customer", "lineitem", "orders", "events"):
            for word in ("join", "from"):
                path = f"{word} parquet.`{sf_dir}/{other}.parquet`"
                query = query.replace(f"{word} {other}", path)
        return apply_sql(table(spark, sf_dir, source), query)

    run.__name__ = name
    return run


def _statement_oracle(name: str) -> str:
    source, statement = STATEMENTS[name]
    if name == "sql_skip_na":
        return f"select * from {source}"
    statement = statement.replace("get_json_object", "json_extract_string")
    return statement.replace("tabela_temp", source)


MONTHLY_REVENUE = (
    "select ano, mes, o_orderpriority,\n"
    '  count(*) as n_orders, round(sum(o_totalprice), 2) as revenue -- "by month"\n'
    "from tabela_temp group by ano, mes, o_orderpriority"
)


def _monthly_row(spark: SparkSession, sf_dir: str, target: str) -> dict[str, str]:
    return control_row(
        spark,
        f"{sf_dir}/orders.parquet",
        target,
        dataset_id="orders_monthly",
        prefixo="/orders/",
        coluna_particao="o_orderdate",
        tipo_particao="data",
        colunas_esperadas=columns_of(spark, sf_dir, "orders"),
        modo_ingestao="Overwrite",
        query=MONTHLY_REVENUE,
    )


def ingest_monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control file to partitioned target in one run: orders by month and priority."""
    row = _monthly_row(spark, sf_dir, fresh_path(spark, "destino"))
    control = load_control(spark, control_file(spark, [row]))
    return run_dataset(spark, control, "orders_monthly").read(spark)


def ingest_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files arrive for three datasets: each is ingested once, whatever the number of its files."""
    targets = [fresh_path(spark, "destino") for _ in range(3)]
    rows = [
        _monthly_row(spark, sf_dir, targets[0]),
        control_row(
            spark,
            f"{sf_dir}/events.parquet",
            targets[1],
            dataset_id="events_types",
            prefixo="/events/",
            coluna_particao="event_type",
            tipo_particao="normal",
            colunas_esperadas=columns_of(spark, sf_dir, "events"),
            modo_ingestao="append",
            query="na",
        ),
        control_row(
            spark,
            f"{sf_dir}/customer.parquet",
            targets[2],
            dataset_id="customers",
            prefixo="/customer/",
            formato_destino="orc",
            colunas_esperadas=columns_of(spark, sf_dir, "customer"),
            modo_ingestao="overwrite",
        ),
    ]
    control = load_control(spark, control_file(spark, rows))
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("landing/orders/"), "o_orderkey").alias("key")
    )
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("landing/events/"), "event_id").alias("key")
    )
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("landing/customer/"), "c_custkey").alias("key")
    )
    arrivals = orders.union(events).union(customers)
    report = raise_failures(run_arrivals(spark, control, arrivals))
    done = {o.dataset_id: o.read(spark) for o in report.done}
    # Every row of every target, as text by column.
    return reduce(DataFrame.union, (_as_text(name, done[name]) for name in sorted(done)))


def _as_text(name: str, df: DataFrame) -> DataFrame:
    def text(column: str) -> F.Column:
        kind = dict(df.dtypes)[column]
        value = F.col(column)
        if kind == "double":
            value = F.round(value * 100).cast("long")
        elif kind.startswith("timestamp"):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        return F.coalesce(value.cast("string"), F.lit("-"))

    cells = [F.concat(F.lit(f"{c}="), text(c)) for c in sorted(df.columns)]
    return df.select(F.lit(name).alias("dataset"), F.concat_ws("|", *cells).alias("linha"))


def ingest_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files arrive for two datasets at once, and the second reads what the first writes."""
    months, years = fresh_path(spark, "destino"), fresh_path(spark, "destino")
    first = _monthly_row(spark, sf_dir, months)
    yearly = (
        "select cast(ano as int) as ano, o_orderpriority, count(*) as n_months, sum(n_orders) as n_orders "
        "from tabela_temp group by ano, o_orderpriority"
    )
    second = control_row(
        spark,
        months,
        years,
        dataset_id="orders_yearly",
        prefixo="/years/",
        colunas_esperadas="o_orderpriority,n_orders,revenue,ano,mes",
        modo_ingestao="overwrite",
        query=yearly,
    )
    control = load_control(spark, control_file(spark, [second, first]))
    keys = table(spark, sf_dir, "orders").select(
        F.explode(F.array(*[F.concat(F.lit(f"in/{d}/"), "o_orderkey") for d in ("years", "orders")])).alias("key")
    )
    report = raise_failures(run_arrivals(spark, control, keys))
    return next(o for o in report.done if o.dataset_id == "orders_yearly").read(spark)


def stream_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys arrive in two drops: the customers are appended once for each that has some of theirs."""
    target, inbox = fresh_path(spark, "destino"), fresh_path(spark, "chegadas")
    settings = {
        "colunas_esperadas": columns_of(spark, sf_dir, "customer"),
        "modo_ingestao": "append",
    }
    rows = [
        control_row(
            spark, f"{sf_dir}/customer.parquet", target, dataset_id="customers", prefixo="/fr/", **settings
        ),
        control_row(
            spark,
            f"{sf_dir}/customer.parquet",
            fresh_path(spark, "destino"),
            dataset_id="others",
            **settings,
        ),
    ]
    control = load_control(spark, control_file(spark, rows))
    pages = table(spark, sf_dir, "pages").select("url", (F.col("page_id") % 2).alias("drop"))
    checkpoint = fresh_path(spark, "chegadas")
    for drop in (0, 1):
        pages.filter(F.col("drop") == drop).select("url").write.mode("append").parquet(inbox)
        arrivals = spark.readStream.schema("url string").parquet(inbox)
        ingest_new_arrivals(spark, control, arrivals, checkpoint, "url")
    return _read_back(table(spark, sf_dir, "customer"), target)


def ingest_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit partitions, appended twice: an append takes the whole source each time."""
    row = control_row(
        spark,
        f"{sf_dir}/customer.parquet",
        fresh_path(spark, "destino"),
        coluna_particao="c_mktsegment , c_nationkey",
        tipo_particao="normal",
        colunas_esperadas=columns_of(spark, sf_dir, "customer"),
        modo_ingestao=" APPEND ",
        query="na",
    )
    ingest(spark, row)
    return ingest(spark, row).read(spark)


DATED_ORDERS = """
    select *, substr(cast(o_orderdate as varchar), 1, 4) as ano,
           substr(cast(o_orderdate as varchar), 6, 2) as mes
    from orders"""

def _text_sql(*columns: str) -> str:
    """Cells as :func:`_as_text` writes them; ``$`` marks a number with cents, ``@`` a time."""
    cells = []
    for c in sorted(columns):
        name = c.rstrip("$@")
        value = f"cast({name} as varchar)"
        if c.endswith("$"):
            value = f"cast(cast(round({name} * 100) as bigint) as varchar)"
        elif c.endswith("@"):
            value = f"strftime({name}, '%Y-%m-%d %H:%M:%S')"
        cells.append(f"'{name}=' || coalesce({value}, '-')")
    return " || '|' || ".join(cells)


QUERIES = {
    "ingest_monthly_revenue": ingest_monthly_revenue,
    "ingest_arrivals": ingest_arrivals,
    "ingest_append_twice": ingest_append_twice,
    "ingest_chain": ingest_chain,
    "stream_arrivals": stream_arrivals,
    "overwrite_failed_keeps": overwrite_failed_keeps,
    "partition_by_date": partition_by_date,
    "partition_by_date_events": partition_by_date_events,
    "partition_by_columns": partition_by_columns,
    "write_unpartitioned": write_unpartitioned,
    "write_overwrite": write_overwrite,
    "write_overwrite_replaces": write_overwrite_replaces,
    "write_append": write_append,
    **{name: _statement(name) for name in STATEMENTS},
}

ORACLE = {
    "ingest_monthly_revenue": f"""
        select ano, mes, o_orderpriority, count(*) as n_orders,
               round(sum(o_totalprice), 2) as revenue
        from ({DATED_ORDERS}) group by ano, mes, o_orderpriority""",
    "ingest_arrivals": f"""
        select 'orders_monthly' as dataset, {_text_sql("ano", "mes", "n_orders", "o_orderpriority", "revenue$")} as linha
        from (select ano, mes, o_orderpriority, count(*) as n_orders, round(sum(o_totalprice), 2) as revenue
              from ({DATED_ORDERS}) group by ano, mes, o_orderpriority)
        union all
        select 'events_types', {_text_sql("event_id", "event_type", "props", "ts@", "user_id", "value$")} from events
        union all
        select 'customers', {_text_sql("c_acctbal$", "c_custkey", "c_mktsegment", "c_name", "c_nationkey")} from customer""",
    "ingest_append_twice": "select * from customer union all select * from customer",
    "ingest_chain": f"""
        select cast(ano as int) as ano, o_orderpriority, count(*) as n_months, cast(sum(n) as bigint) as n_orders
        from (select ano, mes, o_orderpriority, count(*) as n from ({DATED_ORDERS})
              group by ano, mes, o_orderpriority)
        group by ano, o_orderpriority""",
    "stream_arrivals": """
        select c.* from customer c
        cross join (select distinct page_id % 2 as half from pages where contains(url, '/fr/'))""",
    "overwrite_failed_keeps": DATED_ORDERS,
    "partition_by_date": DATED_ORDERS,
    "partition_by_date_events": """
        select *, substr(cast(ts as varchar), 1, 4) as ano,
               substr(cast(ts as varchar), 6, 2) as mes
        from events""",
    "partition_by_columns": "select * from orders",
    "write_unpartitioned": "select * from lineitem",
    "write_overwrite": DATED_ORDERS,
    "write_overwrite_replaces": f"select * from ({DATED_ORDERS}) where ano = '1995'",
    "write_append": f"{DATED_ORDERS} union all {DATED_ORDERS} where o_orderstatus = 'F'",
    **{name: _statement_oracle(name) for name in STATEMENTS},
}
