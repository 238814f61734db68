"""Spark side that the operators share: tables in the shared folder, and Arrow passes over texts."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from eclusa.functions.locations import Files, fresh_path

# Texts are scanned in slices of about so many bytes, which bounds a task's memory.
SLICE_BYTES = 2 * 1024 * 1024

Slice = tuple[pa.RecordBatch, np.ndarray, np.ndarray]


def on_workers(df: DataFrame) -> DataFrame:
    """The frame, once Python workers on this machine find this package.

    Executors elsewhere get it as any package: by ``--py-files`` or from their image.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = df.sparkSession.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
    return df


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` on workers that hand their free memory back when a task ends.

    Spark keeps idle workers, and those of several stages share an executor's memory.
    """

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return on_workers(df).mapInArrow(tidy, schema)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the session's shared folder and read from there.

    It cuts the lineage, outlives any executor and is not computed again.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.staged_at = path
    return found


def discard(*frames: DataFrame) -> None:
    """Remove the folders of staged frames that nothing reads any more."""
    for df in frames:
        Files(df.sparkSession, df.staged_at).remove(df.staged_at)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(taken: Sequence[str], name: str) -> str:
    """The name, lengthened until no column has it in any case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def held_out(doc_id) -> F.Column:
    """Rows whose labels no model may learn from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def id_and_text(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that no other column can clash."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def text_slices(batches: Iterator[pa.RecordBatch], at: int, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Rows in slices of at most ``limit`` text bytes (a longer text alone).

    With each slice come its texts' bytes and offsets; a null text has no bytes.
    """
    for batch in batches:
        texts = pc.fill_null(batch.column(at), "").cast(pa.large_string())
        if not len(texts):
            continue
        _, ends, data = texts.buffers()
        offsets = np.frombuffer(ends, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        first = 0
        while first < len(texts):
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), len(texts))
            yield (
                batch.slice(first, last - first),
                data[offsets[first] : offsets[last]],
                offsets[first : last + 1] - offsets[first],
            )
            first = last


def map_texts(
    df: DataFrame,
    text: str,
    make: Callable[[], Callable[[np.ndarray, np.ndarray], list]],
    fields: Sequence[StructField],
    replaces: bool = False,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Add columns that a function computes from the texts of a slice.

    ``make`` runs once in each task and returns the function, which gets a slice's
    bytes and offsets and returns a list or Arrow array for each of ``fields``.
    With ``replaces`` one array more comes first: the new texts; a null text stays null.
    """
    at = df.columns.index(text)
    schema = StructType([*df.schema.fields, *fields])
    kinds = list(to_arrow_schema(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = make()
        for rows, data, offsets in text_slices(batches, at, limit):
            made = list(scan(data, offsets))
            columns = list(rows.columns)
            if replaces:
                fresh = pa.array(made.pop(0), pa.string())
                columns[at] = pc.if_else(pc.is_null(columns[at]), pa.scalar(None, pa.string()), fresh)
            for value, kind in zip(made, kinds[len(columns) :], strict=True):
                columns.append(value if isinstance(value, pa.Array) else pa.array(value, kind.type))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(df, run, schema)
