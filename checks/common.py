"""Helpers of the check queries: input tables, scratch datasets and control rows."""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

from eclusa.functions.locations import Files, fresh_path
from eclusa.sources.control import CONTROL_FIELDS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def place(spark: SparkSession, location: str) -> tuple[str, str]:
    """Bucket and path, as a control row holds them, of any location."""
    parts = urlparse(Files(spark, location).qualified(location))
    return f"{parts.scheme}://{parts.netloc}", parts.path.lstrip("/")


def control_row(spark: SparkSession, source: str, target: str, **settings: str) -> dict[str, str]:
    """A full control row between two locations; what is not given is blank."""
    row = dict.fromkeys(CONTROL_FIELDS, "")
    row["bucket_origem"], row["caminho_origem"] = place(spark, source)
    row["bucket_destino"], row["caminho_destino"] = place(spark, target)
    row.update(dataset_id="consulta", formato_origem="parquet", formato_destino="parquet")
    return {**row, **settings}


def write_control(rows: DataFrame) -> str:
    """Control file(s) with the frame's rows in the frame's order."""
    spark = rows.sparkSession
    path = fresh_path(spark, "controle")
    rows.write.csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


def control_file(spark: SparkSession, rows: list[dict[str, str]]) -> str:
    values = [tuple(row[f] for f in CONTROL_FIELDS) for row in rows]
    schema = ", ".join(f"{f} string" for f in CONTROL_FIELDS)
    return write_control(spark.createDataFrame(values, schema).coalesce(1))


def columns_of(spark: SparkSession, sf_dir: str, name: str) -> str:
    return ",".join(table(spark, sf_dir, name).columns)
