"""The control table: one row per dataset, every value a string."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eclusa.errors import ControlError
from eclusa.functions.locations import fresh_path

# The control file's column names. Existing files must load as they are.
SETTINGS = [
    "bucket_origem",
    "caminho_origem",
    "bucket_destino",
    "caminho_destino",
    "formato_origem",
    "formato_destino",
    "coluna_particao",
    "tipo_particao",
    "compressao",
    "glue_database",
    "glue_tabela",
    "colunas_esperadas",
    "modo_ingestao",
    "chaves",
    "query",
]
CONTROL_FIELDS = ["dataset_id", "prefixo", "nome_job", *SETTINGS]


def load_control(spark: SparkSession, path: str, fields: list[str] | None = None) -> DataFrame:
    """Control rows with ``ordem``, their place in file order.

    ``path`` is a CSV file with header, or a folder of them (read in name order). Each
    file's cells go by its own header, and may be quoted and then hold commas, quotes and
    line breaks; blank cells are ``''``; where lines end in CRLF, line breaks inside cells
    are read as LF.

    A file needs an id or a prefix; other columns that it lacks are blank, and a missing
    id is the prefix. ``fields`` names columns that every file must have instead.

    A file with line breaks inside cells cannot be split, so numbers given in reading
    order follow the lines within each file. The rows are kept as a written table:
    every later use sees the same rows and numbers, even if the file changes or the
    cluster's size does.
    """
    try:
        found = spark.read.text(path, wholetext=True).select("_metadata.file_path").distinct()
        files = sorted(r.file_path for r in found.collect())
    except (AnalysisException, Py4JJavaError) as e:
        raise ControlError(f"cannot read the control table {path}: {e}") from e
    if not files:
        raise ControlError(f"the control table {path} has no files")
    parts = [_control_file(spark, file, fields) for file in files]
    rows = reduce(DataFrame.union, parts)
    path = fresh_path(spark, "controle")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _control_file(spark: SparkSession, path: str, fields: list[str] | None) -> DataFrame:
    raw = spark.read.csv(
        unquote(path), header=True, multiLine=True, quote='"', escape='"', inferSchema=False
    )
    missing = [f for f in fields or () if f not in raw.columns]
    if missing or not {"dataset_id", "prefixo"} & set(raw.columns):
        raise ControlError(f"control table {path} lacks the columns {missing or 'dataset_id, prefixo'}")

    def cell(name: str) -> Column:
        there = name if name in raw.columns else "prefixo" if name == "dataset_id" else None
        return F.coalesce(F.col(f"`{there}`"), F.lit("")) if there else F.lit("")

    return raw.select(
        *[cell(f).alias(f) for f in fields or CONTROL_FIELDS],
        F.struct(
            F.lit(path).alias("arquivo"), F.monotonically_increasing_id().alias("linha")
        ).alias("ordem"),
    )


def first_rows(control: DataFrame, key: str = "dataset_id") -> DataFrame:
    """The first control row in file order for every value of ``key``."""
    others = [c for c in control.columns if c != key]
    first = F.min_by(F.struct(*others), F.col("ordem")).alias("primeira")
    return control.groupBy(key).agg(first).select(key, "primeira.*").select(*control.columns)


def lookup(control: DataFrame, dataset_id: str) -> dict[str, str]:
    """Settings of one dataset: exact match, first row in file order."""
    row = control.filter(F.col("dataset_id") == dataset_id).orderBy("ordem").head()
    if row is None:
        raise ControlError(f"the control table has no dataset {dataset_id!r}")
    return {name: row[name] for name in control.columns if name != "ordem"}
