"""Partition columns of a dataset."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from eclusa.errors import IngestionError
from eclusa.functions.columns import split_names

# Kinds in the control table, and the names of the date partitions.
BY_DATE = "data"
BY_COLUMNS = "normal"
DATE_PARTS = ["ano", "mes"]


def with_partitions(df: DataFrame, column: str, kind: str) -> tuple[DataFrame, list[str]]:
    """The frame with its partition columns, and their names.

    ``data`` cuts year and month by position from the text of ``column``, without
    reading it as a date; ``normal`` takes the listed columns as they are; any
    other kind means no partitions, whatever ``column`` says.
    """
    if kind == BY_DATE:
        try:
            text = df[column]
        except AnalysisException as e:
            raise IngestionError(f"no column {column!r} to cut year and month from") from e
        return df.withColumns({"ano": text.substr(1, 4), "mes": text.substr(6, 2)}), DATE_PARTS
    if kind == BY_COLUMNS:
        return df, split_names(column)
    return df, []
