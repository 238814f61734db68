"""Control table, routing, sources and validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.common import control_file, control_row, table, write_control
from eclusa.functions.locations import fresh_path
from eclusa.operators.routing import route
from eclusa.sources.control import CONTROL_FIELDS, first_rows, load_control
from eclusa.sources.scan import check_contract, require_rows, scan

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def _as_control(df: DataFrame, **columns) -> DataFrame:
    blank = {f: F.lit("") for f in CONTROL_FIELDS}
    return df.select(*[c.alias(f) for f, c in {**blank, **columns}.items()])


def control_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a control row: cells with quotes, commas and line breaks, and blanks."""
    rows = _as_control(
        table(spark, sf_dir, "documents"),
        dataset_id=F.col("doc_id").cast("string"),
        prefixo=F.when(F.col("lang") == "en", "").otherwise(F.concat(F.lit(" /"), "lang")),
        chaves=F.concat_ws(", ", "source", "lang"),
        query=F.col("text"),
    )
    return load_control(spark, write_control(rows)).select(
        "dataset_id", "prefixo", "chaves", F.md5("query").alias("query_md5"), "glue_tabela"
    )


def control_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as control rows, one dataset each: the first turn in file order wins."""
    turns = table(spark, sf_dir, "conversations").orderBy("conv_id", "turn")
    rows = _as_control(
        turns,
        dataset_id=F.col("conv_id").cast("string"),
        nome_job=F.concat(F.lit("turno "), "turn"),
        query=F.col("text"),
    )
    first = first_rows(load_control(spark, write_control(rows)))
    return first.select("dataset_id", "nome_job", F.md5("query").alias("query_md5"))


PREFIXES = [("en", "/en/"), ("fr", "/fr/"), ("any", "/2"), ("ex", "example")]


def route_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [
        control_row(spark, sf_dir, sf_dir, dataset_id=name, prefixo=prefix)
        for name, prefix in PREFIXES
    ]
    control = load_control(spark, control_file(spark, rows))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return route(pages, control, "url").drop("prefixo")


def _daily_arrivals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One arrival per order, and a control row for one priority and then for each shipping day."""
    day = F.date_format("day", "yyyy-MM-dd")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "day")
    arrivals = orders.select(
        F.concat(
            F.lit("landing/"), "o_orderpriority", F.lit("/dt="), day, F.lit("/"), "o_orderkey"
        ).alias("key")
    )
    days = (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_shipdate").alias("day"))
        .distinct()
        .select(F.lit(1).alias("rank"), F.concat(F.lit("dt="), day, F.lit("/")).alias("prefix"))
    )
    low = orders.filter("o_orderpriority = '5-LOW'").select(
        F.lit(0).alias("rank"), F.concat(F.lit("/"), "o_orderpriority", F.lit("/")).alias("prefix")
    )
    rows = low.distinct().union(days).orderBy("rank", "prefix")
    rows = _as_control(
        rows, dataset_id=F.concat(F.lit("para "), "prefix"), prefixo=F.col("prefix")
    )
    return arrivals, load_control(spark, write_control(rows))


def route_arrivals_many_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals, control = _daily_arrivals(spark, sf_dir)
    return route(arrivals, control).drop("prefixo")


def route_arrivals_large_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As before, with a control table beyond the bounds of what is broadcast."""
    arrivals, control = _daily_arrivals(spark, sf_dir)
    return route(arrivals, control, collect_bytes=0, broadcast_bytes=0).drop("prefixo")


ROUTED_BY_DAY = """
    with c as (
        select 0 as rank, '/5-LOW/' as prefix
        union
        select distinct 1, 'dt=' || strftime(l_shipdate, '%Y-%m-%d') || '/'
        from lineitem
    ), a as (
        select 'landing/' || o_orderpriority || '/dt=' || strftime(o_orderdate, '%Y-%m-%d') || '/'
               || o_orderkey as key
        from orders
    ), m as (
        select key, arg_min(prefix, (rank, prefix)) as prefix
        from a join c on contains(key, prefix) group by key
    )
    select a.key, 'para ' || m.prefix as dataset_id from a left join m using (key)
"""


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, "parquet", f"{sf_dir}/lineitem.parquet")


def _copy(df: DataFrame, fmt: str, *partitions: str) -> str:
    path = fresh_path(df.sparkSession, f"origem-{fmt}")
    df.write.partitionBy(*partitions).format(fmt).save(path)
    return path


def scan_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, "orc", _copy(table(spark, sf_dir, "customer"), "orc"))


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _copy(table(spark, sf_dir, "customer"), "csv")
    return scan(spark, "csv", path)


def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, "json", _copy(table(spark, sf_dir, "customer"), "json"))


def scan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses and pages, each a text; line ends inside a page would part it."""
    pages = table(spark, sf_dir, "pages")
    lines = pages.select("url").union(pages.select(F.regexp_replace("html", "[\\r\\n]+", " ")))
    return scan(spark, "text", _copy(lines, "text"))


def scan_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition columns of a source come last, typed by Spark from the folder names."""
    orders = table(spark, sf_dir, "orders").withColumn("ano", F.year("o_orderdate"))
    path = _copy(orders, "parquet", "ano")
    return scan(spark, "parquet", path)


def guard_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table passes the guard; its rows are counted behind it."""
    counts = [
        require_rows(table(spark, sf_dir, name), name).agg(
            F.lit(name).alias("tabela"), F.count("*").alias("linhas")
        )
        for name in TABLES
    ]
    return reduce(DataFrame.union, counts)


ORDERS = "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority"


def contract_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared columns in order, with the number of filled values behind the check."""
    declared = " , ".join(ORDERS.split(","))
    df = check_contract(table(spark, sf_dir, "orders"), declared)
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns])
    pairs = [
        F.struct(F.lit(i).alias("pos"), F.lit(c).alias("coluna"), F.col(c).alias("preenchidas"))
        for i, c in enumerate(df.columns, 1)
    ]
    return filled.select(F.inline(F.array(*pairs)))


QUERIES = {
    f.__name__: f
    for f in (
        control_load,
        control_lookup,
        route_arrivals,
        route_arrivals_many_prefixes,
        route_arrivals_large_control,
        scan_parquet,
        scan_orc,
        scan_csv,
        scan_json,
        scan_text,
        scan_partitioned,
        guard_nonempty,
        contract_columns,
    )
}

ORACLE = {
    "control_load": """
        select cast(doc_id as varchar) as dataset_id,
               case when lang = 'en' then '' else ' /' || lang end as prefixo,
               source || ', ' || lang as chaves, md5(text) as query_md5, '' as glue_tabela
        from documents""",
    "control_lookup": """
        select cast(conv_id as varchar) as dataset_id,
               'turno ' || min(turn) as nome_job, md5(arg_min(text, turn)) as query_md5
        from conversations group by conv_id""",
    "route_arrivals": """
        with c(ordem, dataset_id, prefixo) as (
            values (0, 'en', '/en/'), (1, 'fr', '/fr/'), (2, 'any', '/2'), (3, 'ex', 'example'))
        select page_id, url, dataset_id from (
            select *, row_number() over (partition by page_id order by ordem) as rn
            from pages left join c on contains(url, prefixo))
        where rn = 1""",
    "route_arrivals_many_prefixes": ROUTED_BY_DAY,
    "route_arrivals_large_control": ROUTED_BY_DAY,
    "scan_parquet": "select * from lineitem",
    "scan_orc": "select * from customer",
    "scan_csv": """
        select cast(c_custkey as varchar) as _c0, c_name as _c1,
               cast(c_nationkey as varchar) as _c2, cast(c_acctbal as varchar) as _c3,
               c_mktsegment as _c4
        from customer""",
    "scan_json": """
        select c_acctbal, c_custkey, c_mktsegment, c_name,
               cast(c_nationkey as bigint) as c_nationkey
        from customer""",
    "scan_text": """
        select url as value from pages
        union all
        select regexp_replace(html, '[\\r\\n]+', ' ', 'g') from pages""",
    "scan_partitioned": """
        select *, cast(year(o_orderdate) as integer) as ano from orders""",
    "guard_nonempty": " union all ".join(
        f"select '{name}' as tabela, count(*) as linhas from {name}" for name in TABLES
    ),
    "contract_columns": " union all ".join(
        f"select {i} as pos, '{c}' as coluna, count({c}) as preenchidas from orders"
        for i, c in enumerate(ORDERS.split(","), 1)
    ),
}
