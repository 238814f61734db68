"""Ingesting only the files that are new since the last run.

Each run takes what has arrived and ends. The checkpoint folder, one per dataset,
remembers the files that were taken, so unlike the batch job an append does not
add earlier files again.
"""

from __future__ import annotations

import json

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StringType, StructField, StructType

from eclusa import journal
from eclusa.errors import IngestionError, SinkError
from eclusa.functions.columns import split_names
from eclusa.functions.locations import BATCH_COLUMN, Files, folder_columns, owned_by_stream, uri
from eclusa.operators.catalog import register
from eclusa.operators.partitioning import with_partitions
from eclusa.operators.sink import check_apart, check_partitions, write, write_mode
from eclusa.operators.transform import apply_sql, refuse_commands
from eclusa.operators.upsert import open_target, upsert
from eclusa.plans.ingest import Options, Outcome
from eclusa.sources.scan import check_contract, scan


def ingest_new_files(
    spark: SparkSession,
    row: dict[str, str],
    checkpoint: str,
    options: Options = Options(),
    max_files: int | None = None,
) -> Outcome:
    """Ingest the files that arrived since the last run with this ``checkpoint``.

    A statement sees one micro-batch at a time; it must be a query, commands are refused
    before anything runs. Append puts each micro-batch in a folder of its own,
    ``lote=<batch>-<id of the query>``, which a repeated batch replaces; the id is kept in
    the checkpoint, so streams that share a target never touch each other's rows. Upsert
    merges micro-batch by micro-batch; the target remembers the last one, and a repeated
    batch is left out. Overwrite means the whole source, which is the batch
    job's work.

    A micro-batch takes ``max_files`` files, by default all there are.
    """
    mode = write_mode(row["modo_ingestao"])
    if mode == "overwrite":
        raise SinkError("a stream cannot overwrite its target; ingest the dataset as a batch")
    source = uri(row["bucket_origem"], row["caminho_origem"], options.scheme)
    target = uri(row["bucket_destino"], row["caminho_destino"], options.scheme)
    fmt = row["formato_destino"]

    known = check_contract(
        scan(spark, row["formato_origem"], source, options.schema_of(row["dataset_id"])),
        row["colunas_esperadas"],
    )
    check_apart(known, source, target)
    reader = spark.readStream.format(row["formato_origem"]).schema(known.schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    arrived, partitions = with_partitions(
        reader.load(source), row["coluna_particao"], row["tipo_particao"]
    )

    refuse_commands(spark, row["query"])
    codec = row["compressao"].strip() if options.compress else ""
    if mode == "upsert":
        keys = split_names(row["chaves"])
        sink, schema = _merge_sink(arrived, row["query"], target, fmt, partitions, keys, checkpoint, codec)
    else:
        sink, schema = _batch_sink(arrived, row["query"], target, fmt, partitions, checkpoint, codec)
    try:
        _run(sink, checkpoint)
    except StreamingQueryException as e:
        journal.error("stream run failed", dataset_id=row["dataset_id"], error=str(e))
        raise IngestionError(f"stream into {target} failed: {e}") from e
    table = options.table_of(row)
    if table and Files(spark, target).first_entry(target):
        layout = folder_columns(spark, target)
        own = [StructField(BATCH_COLUMN, StringType())] if layout[:1] == [BATCH_COLUMN] and mode == "append" else []
        register(spark, table, target, fmt, StructType([*schema.fields, *own]), layout)
    journal.info("stream run done", dataset_id=row["dataset_id"], target=target, mode=mode)
    return Outcome(row["dataset_id"], target, fmt, mode, partitions, schema)


def _run(sink: DataStreamWriter, checkpoint: str) -> None:
    sink = sink.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    sink.start().awaitTermination()


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query that the checkpoint belongs to, written there before its first batch."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").head()[0])["id"]


def _shape(arrived: DataFrame, query: str) -> DataFrame:
    """The statement's result columns, from a frame of the source's schema without rows."""
    return apply_sql(arrived.sparkSession.createDataFrame([], arrived.schema), query)


def _merge_sink(
    arrived: DataFrame,
    query: str,
    target: str,
    fmt: str,
    partitions: list[str],
    keys: list[str],
    checkpoint: str,
    codec: str,
) -> tuple[DataStreamWriter, StructType]:
    current, _ = open_target(_shape(arrived, query), target, fmt, partitions)

    def merge(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            own = (_query_id(batch.sparkSession, checkpoint), number)
            upsert(apply_sql(batch, query), target, keys, fmt, partitions, compression=codec, batch=own)

    return arrived.writeStream.foreachBatch(merge), current.schema


def _batch_sink(
    arrived: DataFrame,
    query: str,
    target: str,
    fmt: str,
    partitions: list[str],
    checkpoint: str,
    codec: str,
) -> tuple[DataStreamWriter, StructType]:
    spark = arrived.sparkSession
    if Files(spark, target).first_entry(target) and owned_by_stream(spark, target) != "batches":
        raise SinkError(f"{target} has other files; folders of micro-batches cannot lie beside them")
    shape = _shape(arrived, query)
    check_partitions(shape, partitions)

    def append(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            folder = f"{target}/{BATCH_COLUMN}={number}-{_query_id(spark, checkpoint)}"
            write(apply_sql(batch, query), folder, fmt, "overwrite", partitions, codec)

    return arrived.writeStream.foreachBatch(append), shape.schema
