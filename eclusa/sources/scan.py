"""Reading a source and holding it against its declared columns."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException as SparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from eclusa import journal
from eclusa.errors import ContractError, SourceError


def scan(
    spark: SparkSession, fmt: str, location: str, schema: StructType | None = None
) -> DataFrame:
    """Source of any Spark format, without reader options.

    Without ``schema`` Spark infers one; for JSON that is a full extra pass over
    the files, which a caller who knows the columns can spare.
    """
    reader = spark.read.format(fmt)
    try:
        return (reader.schema(schema) if schema else reader).load(location)
    except (AnalysisException, Py4JJavaError) as e:
        journal.error("source unreadable", location=location, format=fmt, error=str(e))
        raise SourceError(f"cannot read {location} as {fmt}: {e}") from e


def require_rows(df: DataFrame, location: str = "") -> DataFrame:
    """The frame itself, if it has at least one row. Spark stops at the first one found."""
    try:
        empty = df.isEmpty()
    except (AnalysisException, SparkException, Py4JJavaError) as e:
        raise SourceError(f"cannot read {location}: {e}") from e
    if empty:
        journal.error("source empty", location=location)
        raise SourceError(f"the source {location} has no rows")
    return df


def expected_columns(declared: str | None) -> list[str]:
    """Declared column names in order. Blank names stay, so that they fail the comparison."""
    if not declared:
        raise ContractError("the control row declares no expected columns")
    return [name.strip() for name in declared.split(",")]


def check_contract(df: DataFrame, declared: str | None) -> DataFrame:
    """The frame itself, if its column names equal the declared ones in number, order and case."""
    expected = expected_columns(declared)
    if df.columns != expected:
        journal.error("columns differ", found=df.columns, expected=expected)
        raise ContractError(f"columns {df.columns} differ from the declared {expected}")
    return df
