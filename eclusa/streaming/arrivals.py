"""Arrivals as a stream: keys come in, their datasets run by themselves.

Each run takes the keys that are new since the last one, routes them micro-batch by micro-batch
and ingests every dataset that got some, once for each batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from eclusa import journal
from eclusa.errors import IngestionError
from eclusa.functions.locations import fresh_path
from eclusa.plans.ingest import ArrivalReport, Options, raise_failures, run_arrivals


def ingest_new_arrivals(
    spark: SparkSession,
    control: DataFrame,
    arrivals: DataFrame,
    checkpoint: str,
    key: str = "key",
    options: Options = Options(),
    parallel: int = 4,
    seen: Callable[[int, ArrivalReport], None] | None = None,
) -> None:
    """Ingest the datasets that keys of the stream ``arrivals`` belong to, until it is empty.

    The checkpoint remembers which keys were taken. A micro-batch is written down before it is
    routed, since routing reads it several times, by whatever number of prefixes there are.
    If a key has no route or a dataset fails, the rest of the batch is still ingested, then
    the run ends with the error; the next one takes the same batch again. So a dataset may
    run twice for one batch, as a retried job does; overwrite and upsert come to the same.
    ``seen`` gets each batch's number and report.
    """

    def take(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        # The batch's own session serves for reading it, the caller's for the datasets.
        path = fresh_path(spark, "chegadas")
        batch.write.parquet(path)
        known = spark.read.schema(batch.schema).parquet(path)
        report = run_arrivals(spark, control, known, key, options, parallel)
        if seen:
            seen(number, report)
        raise_failures(report)

    writer = arrivals.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    try:
        writer.trigger(availableNow=True).start().awaitTermination()
    except StreamingQueryException as e:
        journal.error("arrivals failed", checkpoint=checkpoint, error=str(e))
        raise IngestionError(f"ingestion of new arrivals failed: {e}") from e
