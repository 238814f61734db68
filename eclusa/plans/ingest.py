"""Ingesting one dataset, or every dataset that files have arrived for."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eclusa import journal
from eclusa.errors import IngestionError
from eclusa.functions.columns import split_names
from eclusa.functions.locations import Files, folder_columns, segments, uri
from eclusa.operators.catalog import register
from eclusa.operators.partitioning import with_partitions
from eclusa.operators.routing import route
from eclusa.operators.sink import check_apart, check_partitions, write, write_mode
from eclusa.operators.transform import apply_sql, own_session
from eclusa.operators.upsert import upsert
from eclusa.sources.control import first_rows, lookup
from eclusa.sources.scan import check_contract, require_rows, scan


@dataclass(frozen=True)
class Options:
    """Choices a control row has no column for.

    ``cluster`` brings the rows of a partition together before they are written.
    ``compress`` and ``catalog`` make use of the control columns ``compressao`` and
    ``glue_database``/``glue_tabela``; both go beyond the plain ingestion. ``schema`` spares
    the inference of the source's schema: one for all, or by ``dataset_id``, where those that
    are not named are inferred, once in each run. ``run`` names this run of the job, and a
    retry of it by the same name: an append that the first try has done is not done again.
    """

    scheme: str = "s3"
    compress: bool = False
    catalog: bool = False
    cluster: bool = True
    refuse_empty_result: bool = False
    run: str = ""
    schema: StructType | Mapping[str, StructType] | None = None

    def table_of(self, row: Mapping[str, str]) -> str:
        return f"{row['glue_database']}.{row['glue_tabela']}" if self.catalog else ""

    def schema_of(self, dataset_id: str) -> StructType | None:
        return self.schema.get(dataset_id) if isinstance(self.schema, Mapping) else self.schema


@dataclass(frozen=True)
class Outcome:
    dataset_id: str
    target: str
    fmt: str
    mode: str
    partitions: list[str]
    schema: StructType

    def read(self, spark: SparkSession) -> DataFrame:
        """The target with the types and column order it was written with.

        Without them partition values such as ``01`` would come back as numbers.
        """
        df = spark.read.format(self.fmt).schema(self.schema).load(self.target)
        return df.select(*[F.col(f"`{c}`") for c in self.schema.names])


def ingest(spark: SparkSession, row: dict[str, str], options: Options = Options()) -> Outcome:
    """Read, check, partition, transform and write the dataset of one control row.

    It does so in a session of its own, so that several can run side by side.
    """
    dataset_id = row.get("dataset_id", "")
    try:
        outcome = _ingest(own_session(spark), row, options)
    except Exception as e:
        journal.error("ingestion failed", dataset_id=dataset_id, error=str(e))
        raise
    if table := options.table_of(row):
        # The caller's session may have listed the table's files before.
        spark.catalog.refreshTable(table)
    journal.info("ingestion done", dataset_id=dataset_id, target=outcome.target, mode=outcome.mode)
    return outcome


def _ingest(spark: SparkSession, row: dict[str, str], options: Options) -> Outcome:
    mode = write_mode(row["modo_ingestao"])
    source = uri(row["bucket_origem"], row["caminho_origem"], options.scheme)
    target = uri(row["bucket_destino"], row["caminho_destino"], options.scheme)

    schema = options.schema_of(row.get("dataset_id", ""))
    df = require_rows(scan(spark, row["formato_origem"], source, schema), source)
    if mode != "append":
        check_apart(df, source, target)
    check_contract(df, row["colunas_esperadas"])
    df, partitions = with_partitions(df, row["coluna_particao"], row["tipo_particao"])
    df = apply_sql(df, row["query"])
    if options.refuse_empty_result:
        require_rows(df, f"result of the SQL over {source}")

    fmt = row["formato_destino"]
    codec = row["compressao"].strip() if options.compress else ""
    table = options.table_of(row)
    if mode == "upsert":
        schema = upsert(df, target, split_names(row["chaves"]), fmt, partitions, compression=codec)
        if table:
            register(spark, table, target, fmt, schema, folder_columns(spark, target))
    else:
        schema = df.schema
        check_partitions(df, partitions)
        run = f"{options.run}/{row.get('dataset_id', '')}/{source}" if options.run else ""
        write(df, target, fmt, mode, partitions, codec, table, options.cluster, run)
    return Outcome(row.get("dataset_id", ""), target, fmt, mode, partitions, schema)


def run_dataset(
    spark: SparkSession, control: DataFrame, dataset_id: str, options: Options = Options()
) -> Outcome:
    """Ingest the dataset that the control table describes under ``dataset_id``."""
    return ingest(spark, lookup(control, dataset_id), options)


@dataclass
class ArrivalReport:
    """What became of a set of arrivals.

    ``arrived`` counts them by dataset, under None those without a route; these are
    the rows of ``unroutable``, and ``lost`` is one of them.
    """

    unroutable: DataFrame
    arrived: dict[str | None, int]
    lost: str | None = None
    done: list[Outcome] = field(default_factory=list)
    failed: dict[str, Exception] = field(default_factory=dict)


def run_arrivals(
    spark: SparkSession,
    control: DataFrame,
    arrivals: DataFrame,
    key: str = "key",
    options: Options = Options(),
    parallel: int = 4,
) -> ArrivalReport:
    """Route the arrived files and ingest each dataset that got some, once.

    One dataset's failure leaves the others alone. Datasets with the same target run
    one after the other, in file order; one whose source another's target lies in, or around,
    runs after that one; the rest share the cluster. Datasets that wait for each other are an
    error, before any of them runs. What the driver
    sees of the arrivals is one short row per control row that took some; a dataset's
    settings are fetched when its turn comes.
    """
    routed = route(arrivals, control, key)
    taken = routed.groupBy("prefixo").agg(
        F.count("*").alias("_arrivals"), F.min(key).alias("_example")
    )
    places = first_rows(control, "prefixo").select(
        "prefixo", "dataset_id", "bucket_origem", "caminho_origem", "bucket_destino", "caminho_destino", "ordem"
    )
    rows = taken.join(places, "prefixo", "left").orderBy("ordem").collect()
    report = ArrivalReport(routed.filter("prefixo is null").select(*arrivals.columns), {})

    by_target: dict[str, list[dict[str, str]]] = {}
    sources: dict[str, set[str]] = {}
    for row in rows:
        dataset_id = row["dataset_id"]
        report.arrived[dataset_id] = report.arrived.get(dataset_id, 0) + row["_arrivals"]
        if row["prefixo"] is None:
            report.lost = str(row["_example"])
            continue
        source = uri(row["bucket_origem"], row["caminho_origem"], options.scheme)
        target = uri(row["bucket_destino"], row["caminho_destino"], options.scheme)
        place = Files(spark, target).qualified(target)
        by_target.setdefault(place, []).append(row.asDict())
        sources.setdefault(place, set()).add(Files(spark, source).qualified(source))

    def run(group: list[dict[str, str]]) -> None:
        for row in group:
            try:
                same = control.filter(F.col("prefixo") == row["prefixo"])
                settings = same.orderBy("ordem").head().asDict()
                report.done.append(ingest(spark, settings, options))
            except Exception as e:
                report.failed[row["dataset_id"]] = e

    with ThreadPoolExecutor(parallel) as pool:
        for wave in waves(sources):
            list(pool.map(run, [by_target[place] for place in wave]))
    return report


def waves(sources: Mapping[str, set[str]]) -> list[list[str]]:
    """Targets in the order of their making, from each target's sources; those of one wave are independent.

    A target waits for every other that equals one of its sources, lies in it or around it.
    """
    parts = {place: (urlparse(place)[:2], tuple(segments(place))) for place in sources}
    around: dict[tuple, set[str]] = {}
    inside: dict[tuple, set[str]] = {}
    for place, (store, path) in parts.items():
        inside.setdefault((store, path), set()).add(place)
        for n in range(len(path) + 1):
            around.setdefault((store, path[:n]), set()).add(place)
    waiting: dict[str, set[str]] = {}
    for place, read in sources.items():
        before: set[str] = set()
        for source in read:
            store, path = urlparse(source)[:2], tuple(segments(source))
            # Targets in the source, and targets that the source is in.
            before |= around.get((store, path), set())
            for n in range(len(path)):
                before |= inside.get((store, path[:n]), set())
        waiting[place] = before - {place}
    order = []
    while waiting:
        ready = [place for place, before in waiting.items() if not before]
        if not ready:
            raise IngestionError(f"datasets read each other's targets: {', '.join(sorted(waiting))}")
        order.append(ready)
        waiting = {p: before - set(ready) for p, before in waiting.items() if p not in set(ready)}
    return order


def raise_failures(report: ArrivalReport) -> ArrivalReport:
    """The report itself, unless an arrival had no route or a dataset failed."""
    if report.lost is not None:
        raise IngestionError(f"no dataset takes the arrival {report.lost!r}")
    if report.failed:
        names = ", ".join(sorted(report.failed))
        raise IngestionError(f"ingestion failed for {names}") from next(iter(report.failed.values()))
    return report
