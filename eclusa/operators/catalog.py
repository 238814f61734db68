"""Catalog names of datasets that lie in folders of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructField, StructType

from eclusa.functions.columns import find_column, quoted


def register(
    spark: SparkSession, table: str, target: str, fmt: str, schema: StructType, partitions: Sequence[str] = ()
) -> None:
    """Make the catalog show the dataset as it now is, under the name ``database.table``.

    A table that is there already keeps its entry if its columns agree; its partitions are
    made those of the folder, new ones and gone ones. The files are not touched.
    """
    name = ".".join(quoted(part) for part in table.split(".", 1))
    own = [find_column(spark, schema.names, p) or p for p in partitions]
    # The catalog lists partition columns last.
    fields = [f for f in schema.fields if f.name not in own]
    whole = StructType([StructField(f.name, f.dataType) for f in (*fields, *(schema[p] for p in own))])
    if spark.catalog.tableExists(table):
        known = StructType([StructField(f.name, f.dataType) for f in spark.table(name).schema.fields])
        if known != whole:
            spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(table):
        by = f"PARTITIONED BY ({', '.join(map(quoted, own))})" if own else ""
        place = target.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({whole.toDDL()}) USING {fmt} {by} LOCATION '{place}'")
    if own:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
