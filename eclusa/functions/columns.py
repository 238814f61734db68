"""Column expressions shared by the operators. Everything here runs inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def split_names(text: str | None) -> list[str]:
    """Comma-separated names of a control cell, trimmed, blanks dropped."""
    return [name.strip() for name in (text or "").split(",") if name.strip()]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    """A top-level column whose name may hold dots or spaces."""
    return F.col(quoted(name))


def find_column(spark: SparkSession, columns: Iterable[str], name: str) -> str | None:
    """The spelling under which Spark would resolve ``name``, or None."""
    if spark.conf.get("spark.sql.caseSensitive") == "true":
        return name if name in columns else None
    return next((c for c in columns if c.lower() == name.lower()), None)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Sequence[Column]) -> Column:
    """OR as a balanced tree, so that long lists stay shallow for the optimizer."""
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return any_of(conditions[:half]) | any_of(conditions[half:])


def has_null(columns: Iterable[Column]) -> Column:
    return any_of([c.isNull() for c in columns])
