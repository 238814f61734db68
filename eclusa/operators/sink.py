"""Writing a dataset by overwrite or append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter

from eclusa.errors import SinkError
from eclusa.functions.columns import find_column, named
from eclusa.functions.locations import Files, overlaps, owned_by_stream, table_format
from eclusa.operators import swap
from eclusa.operators.catalog import register

# Modes in the control table.
MODES = ("overwrite", "append", "upsert")


def write_mode(text: str | None) -> str:
    mode = (text or "").strip().lower()
    if mode not in MODES:
        raise SinkError(f"write mode {text!r} is none of {', '.join(MODES)}")
    return mode


def check_partitions(df: DataFrame, partitions: Sequence[str]) -> None:
    """A statement may have dropped a partition column; say so before the write."""
    gone = [p for p in partitions if find_column(df.sparkSession, df.columns, p) is None]
    if gone:
        raise SinkError(f"partition columns {gone} are not among {df.columns}")


def check_apart(df: DataFrame, source: str, target: str) -> None:
    """Overwriting the files being read would delete them; a stream would read its own output."""
    if overlaps(df.sparkSession, source, target):
        raise SinkError(f"source {source} and target {target} overlap")


def clustered(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of one partition value together, so that each becomes few files.

    AQE sizes the shuffled pieces: small values share a task, and a value that
    holds a large share of the rows is split over several.
    """
    return df.hint("rebalance", *map(named, partitions)) if partitions else df


def writer(
    df: DataFrame, fmt: str, partitions: Sequence[str] = (), cluster: bool = True
) -> DataFrameWriter:
    check_partitions(df, partitions)
    return (clustered(df, partitions) if cluster else df).write.partitionBy(*partitions).format(fmt)


def write(
    df: DataFrame,
    target: str,
    fmt: str,
    mode: str,
    partitions: Sequence[str] = (),
    compression: str = "",
    table: str = "",
    cluster: bool = True,
    run: str = "",
) -> None:
    """Overwrite replaces the whole target, also by an empty result; append adds rows.

    The new dataset is written next to the old one and takes its place when it is whole,
    so that a run that fails leaves the target as it was.

    An append under the name of a ``run`` is done once, however often that run is repeated.

    A table of a format with a log is written by that format or not at all.
    A source that already lies in the order of its partitions needs no ``cluster``.
    ``compression`` and ``table`` go beyond the plain write and are off by default:
    a codec for the files, and a catalog name for the target.
    """
    found = table_format(df.sparkSession, target)
    if found and found != fmt:
        raise SinkError(f"{target} is a table of {found}; files of {fmt} must not be written there")
    if mode == "append" and owned_by_stream(df.sparkSession, target):
        raise SinkError(f"{target} belongs to a stream; other files must not be added to it")
    out = writer(df, fmt, partitions, cluster).mode(mode)
    if mode == "overwrite":
        out = out.option("partitionOverwriteMode", "static")
    if compression:
        out = out.option("compression", compression)
    if not found:
        swap.restore_interrupted(df.sparkSession, target)
    if mode == "overwrite" and not found and swap.siblings(target):
        if Files(df.sparkSession, target).exists(target):
            swap.replace(df.sparkSession, out, target)
        else:
            out.save(target)
    elif mode == "append" and run and not found:
        swap.add_once(df.sparkSession, out, target, run)
    else:
        out.save(target)
    if table:
        register(df.sparkSession, table, target, fmt, df.schema, partitions)
