"""Keyed upsert into a target of plain files, or into a table format that can merge.

A target row that equals a source row on all keys takes over the source row's
values, NULLs included; source rows without a partner are added; all other target
rows stay. NULL keys equal nothing. Several source rows for one target row are an
error; several target rows for one source row are all updated.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eclusa import journal
from eclusa.errors import MergeError, SinkError
from eclusa.functions.columns import all_of, any_of, find_column, has_null, named, quoted
from eclusa.functions.locations import Files, fresh_path, owned_by_stream, segments, table_format
from eclusa.operators import swap
from eclusa.operators.sink import writer

# Formats that run MERGE themselves, given their package on the classpath.
MERGING_FORMATS = ("delta",)
# Formats whose files may differ in schema while the reader can unite them.
UNITING_FORMATS = ("parquet", "orc")
# Up to this many rows and bytes the source is broadcast.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 128 * 1024 * 1024
# Bytes that a broadcast row needs beyond its text.
ROW_OVERHEAD = 128
# A repeated source key is hot with more than one in so many of the rows.
HOT_KEYS = 10_000
# Up to this many touched partitions are named one by one in the scan's partition filter;
# of more, the values of each partition column are, and of still more values their range.
PRUNED_PARTITIONS = 200
NAMED_VALUES = 10_000
# Heavy keys of a target are looked for among about so many of its rows, and no fewer
# than so many for each shuffle partition.
SAMPLE_ROWS = 1_000_000
SAMPLE_ROWS_EACH = 100
# Formats that leave out NULLs, so that a column without values is not in the files.
SPARSE_FORMATS = ("json",)


def upsert(
    source: DataFrame,
    target: str,
    keys: Sequence[str],
    fmt: str = "parquet",
    partitions: Sequence[str] = (),
    pruned_partitions: int = PRUNED_PARTITIONS,
    compression: str = "",
    batch: tuple[str, int] | None = None,
) -> StructType:
    """Merge ``source`` into the existing dataset at ``target``; returns the target's schema.

    The target keeps its own partition layout; ``partitions`` only serves a target
    that has no files to show one. Of a partitioned target just the partitions are
    rewritten that updates leave and that the source has rows for; those left without
    rows go. Without partitions the merged dataset is written next to the target and
    takes its place by rename. Either way a lost run changes nothing, or the next one
    finishes it. The size of the source plays no part in this. ``compression`` is the
    codec of what is written.

    A target that is a table of a format with a log is merged by that format, whatever
    ``fmt`` says, or not at all. A JSON target takes on columns that only the source has:
    its files don't show a column that is NULL in all rows.

    ``batch`` is a stream's id and the number of its micro-batch. A plain target remembers the
    last one of each stream, in the dataset itself, and a batch that it has is not merged again:
    that matters for rows with NULL keys, which match nothing and would be added twice.
    """
    if not keys:
        raise MergeError("an upsert needs at least one key column")
    spark = source.sparkSession
    if fmt in MERGING_FORMATS:
        return _merge_natively(source, fmt, target, keys)

    found = table_format(spark, target)
    if found in MERGING_FORMATS:
        return _merge_natively(source, found, target, keys)
    if found:
        raise MergeError(f"{target} is a table of {found}, which is not merged here")

    with _as_merge_error():
        swap.restore_interrupted(spark, target)
    current, layout = open_target(source, target, fmt, partitions)
    keys = _resolve(current, keys, "target")
    marks = tuple(Files(spark, target).names(target, swap.BATCH_MARK))
    if batch:
        stream = f"{swap.BATCH_MARK}{batch[0]}-"
        if any(int(m.removeprefix(stream)) >= batch[1] for m in marks if m.startswith(stream)):
            journal.info("micro-batch is in the target already", target=target, batch=batch)
            return current.schema
        marks = (*(m for m in marks if not m.startswith(stream)), f"{stream}{batch[1]}")
    staging = fresh_path(spark, "upsert")
    wanted = _aligned(source, current)
    try:
        # Written once, so that the checks and the join see the same rows.
        wanted.write.parquet(f"{staging}/rows")
        staged = spark.read.schema(wanted.schema).parquet(f"{staging}/rows")
        rows, hot = reject_ambiguous(current, staged, keys)
        if rows == 0:
            return current.schema
        small = rows <= BROADCAST_ROWS and text_bytes(staged) <= BROADCAST_BYTES
        if layout:
            values, moves = staged, False
            if not set(layout) <= set(keys):
                values, moves = _entered_and_left(current, staged, keys, layout, small, f"{staging}/parts")
            folders = _folders(current, values, layout, target, pruned_partitions)
            touched = _touched_partitions(current, values, layout, pruned_partitions)
            merged = merge_frames(touched, staged, keys, small, hot)
            out = _compressed(writer(merged, fmt, layout, moves or not small), compression)
            with _as_merge_error():
                swap.replace_folders(spark, out, target, folders, len(layout), marks)
        else:
            merged = merge_frames(current, staged, keys, small, hot)
            with _as_merge_error():
                swap.replace(spark, _compressed(writer(merged, fmt), compression), target, marks)
        return current.schema
    finally:
        Files(spark, staging).remove(staging)


@contextmanager
def _as_merge_error() -> Iterator[None]:
    try:
        yield
    except SinkError as e:
        raise MergeError(str(e)) from e


def _compressed(out: DataFrameWriter, codec: str) -> DataFrameWriter:
    return out.option("compression", codec) if codec else out


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    small_source: bool = False,
    unmatched: DataFrame | None = None,
) -> DataFrame:
    """Merged rows, for a source that is unambiguous and has the target's columns.

    ``small_source`` says that the source was measured and fits a broadcast; then the
    target is not shuffled at all. Otherwise one full outer join sees every row of either
    side once and decides whether it is updated, added or kept. Rows that would meet in
    one task are dealt over many: those with a NULL key and those of ``unmatched``, source
    keys known to have no partner, which match nothing wherever they are; and the target's
    rows of heavy keys, each of which finds a copy of its source row.
    """
    columns = target.columns
    t, s = _numbered(target, "t"), _numbered(source, "s")
    t_keys = [f"t{columns.index(k)}" for k in keys]
    s_keys = [f"s{columns.index(k)}" for k in keys]
    on_keys = all_of([F.col(a) == F.col(b) for a, b in zip(t_keys, s_keys)])
    merged = [
        F.when(F.col("s_found"), F.col(f"s{i}")).otherwise(F.col(f"t{i}")).alias(c)
        for i, c in enumerate(columns)
    ]
    s = s.withColumn("s_found", F.lit(True))
    if not small_source:
        parts = int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        heavy = heavy_keys(target, keys, parts)
        t = _dealt(t, t_keys, "t", parts, heavy, None)
        s = _dealt(s, s_keys, "s", parts, heavy, unmatched)
        both = t.join(s, on_keys & (F.col("t_turn") == F.col("s_turn")), "full")
        # A heavy key is one of the target's: a copy that meets none of its rows adds nothing.
        return both.filter(F.col("t_copies").isNotNull() | (F.col("s_copies") == 0)).select(*merged)

    # Two joins, as a full outer one has no side that can be broadcast.
    s = F.broadcast(s)
    known = t.select(*t_keys).join(F.broadcast(s.select(*s_keys)), on_keys, "left_semi").distinct()
    added = s.join(known, on_keys, "left_anti").drop("s_found").toDF(*columns)
    return t.join(s, on_keys, "left").select(*merged).union(added)


def heavy_keys(target: DataFrame, keys: Sequence[str], parts: int) -> DataFrame | None:
    """Keys with more rows than one of ``parts`` even partitions, and how many should share them.

    Counted in a sample of the target, so a key near the bound may be missing or not;
    this only decides where rows are joined. There are at most ``parts`` such keys, and
    three times as many shares in all.
    """
    rows = target.count()
    share = max(SAMPLE_ROWS, SAMPLE_ROWS_EACH * parts) / max(rows, 1)
    names = [f"h{i}" for i in range(len(keys))]
    seen = target.select(*[named(k).alias(n) for k, n in zip(keys, names)])
    seen = seen.filter(~has_null([F.col(n) for n in names]))
    if share < 1:
        seen, rows = seen.sample(share, seed=1), rows * share
    counts = seen.groupBy(*names).count().filter(F.col("count") * parts > rows)
    copies = F.ceil(2.0 * parts / max(rows, 1) * F.col("count")).cast("long")
    heavy = counts.select(*names, copies.alias("copies"))
    found = heavy.collect()
    return target.sparkSession.createDataFrame(found, heavy.schema) if found else None


def _dealt(
    df: DataFrame,
    key_columns: Sequence[str],
    side: str,
    parts: int,
    heavy: DataFrame | None,
    unmatched: DataFrame | None,
) -> DataFrame:
    """The rows with a turn that they must share to be joined, and the copies of their key, 0 for most.

    Turns go round by the rows' place in the files, which a repeated task finds again.
    """
    copies, turn = f"{side}_copies", f"{side}_turn"
    df = df.withColumn(turn, F.monotonically_increasing_id())
    alone = has_null([F.col(k) for k in key_columns])
    if unmatched is not None:
        names = [f"u{i}" for i in range(len(key_columns))]
        lone = F.broadcast(unmatched.toDF(*names).withColumn("alone", F.lit(True)))
        on = all_of([F.col(k) == F.col(n) for k, n in zip(key_columns, names)])
        df = df.join(lone, on, "left").drop(*names)
        alone = alone | F.coalesce(F.col("alone"), F.lit(False))
    if heavy is not None:
        on = all_of([F.col(k) == F.col(f"h{i}") for i, k in enumerate(key_columns)])
        df = df.join(F.broadcast(heavy), on, "left")
        df = df.withColumn(copies, F.coalesce(F.col("copies"), F.lit(0).cast("long")))
    else:
        df = df.withColumn(copies, F.lit(0).cast("long"))
    own = F.when(alone, F.pmod(F.col(turn), F.lit(parts))).otherwise(F.lit(0).cast("long"))
    if heavy is not None and side == "s":
        many = F.sequence(F.lit(0).cast("long"), F.col(copies) - 1)
        df = df.withColumn(turn, F.explode(F.when(F.col(copies) > 0, many).otherwise(F.array(own))))
    elif heavy is not None:
        dealt = F.pmod(F.col(turn), F.greatest(F.col(copies), F.lit(1)))
        df = df.withColumn(turn, F.when(F.col(copies) > 0, dealt).otherwise(own))
    else:
        df = df.withColumn(turn, own)
    return df.drop("alone", "copies", *(f"h{i}" for i in range(len(key_columns))))


def reject_ambiguous(
    target: DataFrame, source: DataFrame, keys: Sequence[str]
) -> tuple[int, DataFrame | None]:
    """Raise if some target row would be updated by several source rows.

    The target is only looked at when the source repeats a key at all. Returns the
    number of source rows, and the hot keys among the repeated ones, if any: by the
    check they match nothing, and by their share there are at most ``HOT_KEYS``.
    """
    numbered = [f"s{i}" for i in range(len(keys))]
    counts = source.select(*[named(k).alias(n) for k, n in zip(keys, numbered)])
    counts = counts.groupBy(*numbered).count()
    usable = ~has_null([F.col(n) for n in numbered])
    rows, most = counts.agg(F.sum("count"), F.max(F.when(usable, F.col("count")))).head()
    if (most or 0) <= 1:
        return rows or 0, None
    repeated = counts.filter(usable & (F.col("count") > 1))
    on_keys = all_of([named(k) == F.col(n) for k, n in zip(keys, numbered)])
    clash = target.select(*map(named, keys)).join(repeated, on_keys, "left_semi").head()
    if clash is not None:
        raise MergeError(f"several source rows match the target row with {clash.asDict()}")
    if most * HOT_KEYS <= rows:
        return rows, None
    hot = repeated.filter(F.col("count") * HOT_KEYS > rows)
    return rows, hot.select(*[F.col(n).alias(k) for k, n in zip(keys, numbered)])


def _merge_natively(source: DataFrame, fmt: str, target: str, keys: Sequence[str]) -> StructType:
    spark = source.sparkSession
    on = " AND ".join(f"target.{quoted(k)} = source.{quoted(k)}" for k in keys)
    statement = (
        f"MERGE INTO {fmt}.{quoted(target)} AS target USING {{source}} AS source ON {on} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
    try:
        spark.sql(statement, source=source)
        return spark.read.format(fmt).load(target).schema
    except (AnalysisException, Py4JJavaError) as e:
        raise MergeError(f"cannot merge into the {fmt} table {target}: {e}") from e


def _numbered(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[f"{prefix}{i}" for i in range(len(df.columns))])


def _resolve(df: DataFrame, names: Sequence[str], side: str) -> list[str]:
    found = [find_column(df.sparkSession, df.columns, n) for n in names]
    gone = [n for n, f in zip(names, found) if f is None]
    if gone:
        raise MergeError(f"the {side} lacks the columns {gone}")
    return found


def _aligned(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows in the target's columns and types, matched by name; the rest is left out."""
    names = _resolve(source, target.columns, "source")
    return source.select(
        *[named(n).cast(f.dataType).alias(f.name) for n, f in zip(names, target.schema.fields)]
    )


def text_bytes(df: DataFrame) -> int:
    """Size of the rows, by their values as text and a fixed overhead."""
    row = F.struct(*map(named, df.columns)).cast("string")
    return df.agg(F.sum(F.octet_length(row) + ROW_OVERHEAD)).head()[0] or 0


def _entered_and_left(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    layout: Sequence[str],
    small: bool,
    path: str,
) -> tuple[DataFrame, bool]:
    """Partition values that the source has rows for or takes rows from, and whether rows move.

    Only the keys and partition columns of the target are read. ``small``: the source is
    broadcast. The values, at most two for each partition, are kept at ``path``.
    """
    names = list(dict.fromkeys([*keys, *layout]))
    t, s = (_numbered(df.select(*map(named, names)), side) for df, side in ((target, "t"), (source, "s")))
    pairs = {n: (F.col(f"t{i}"), F.col(f"s{i}")) for i, n in enumerate(names)}
    same_key = all_of([pairs[k][0] == pairs[k][1] for k in keys])
    moved = any_of([~pairs[c][0].eqNullSafe(pairs[c][1]) for c in layout])
    met = t.join(F.broadcast(s) if small else s, same_key)
    left = met.groupBy(*[pairs[c][0] for c in layout]).agg(F.bool_or(moved))
    entered = source.select(*[_folder_value(source, c) for c in layout]).distinct()
    flag = f"{'-'.join(layout)} moved"
    both = left.toDF(*layout, flag).union(entered.withColumn(flag, F.lit(False)))
    both.write.parquet(path)
    kept = source.sparkSession.read.schema(both.schema).parquet(path)
    return kept.drop(flag), not kept.filter(named(flag)).isEmpty()


def _folders(
    current: DataFrame, values: DataFrame, layout: Sequence[str], target: str, named_at_most: int
) -> list[str]:
    """Folders of the partitions with these values that have rows, relative to the target."""
    name = f"{'-'.join(layout)} folder"
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias(name)
    placed = current.select(*map(named, layout), folder)
    found = _touched_partitions(placed, values, layout, named_at_most).select(named(name)).distinct()
    depth = len(segments(Files(current.sparkSession, target).qualified(target)))
    return ["/".join(segments(unquote(row[0]))[depth:]) for row in found.collect()]


def open_target(
    source: DataFrame, target: str, fmt: str, partitions: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """The target as it is, and the partition columns its folders show.

    Folder names carry no types, so partition columns take the source's. Only the
    schema of ``source`` is used.
    """
    spark = source.sparkSession
    reader = spark.read.format(fmt)
    if fmt in UNITING_FORMATS:
        reader = reader.option("mergeSchema", "true")
    try:
        found = reader.load(target)
        file = found.select("_metadata.file_path").head()
    except (AnalysisException, Py4JJavaError) as e:
        raise MergeError(f"an upsert needs an existing {fmt} target at {target}: {e}") from e
    if owned_by_stream(spark, target):
        raise MergeError(f"{target} belongs to a stream and cannot be rewritten")

    if fmt in SPARSE_FORMATS:
        more = [f for f in source.schema.fields if find_column(spark, found.columns, f.name) is None]
        schema = StructType([*found.schema.fields, *(StructField(f.name, f.dataType) for f in more)])
        found = reader.schema(schema).load(target)
    if file is None:
        known = [find_column(spark, found.columns, p) for p in partitions]
        return found, [p for p in known if p]
    depth = len(segments(Files(spark, target).qualified(target)))
    folders = segments(unquote(file[0]))[depth:-1]
    layout = _resolve(found, [f.split("=", 1)[0] for f in folders if "=" in f], "target")
    in_source = _resolve(source, layout, "source")
    types = {p: source.schema[name].dataType for p, name in zip(layout, in_source)}
    schema = StructType(
        [StructField(f.name, types.get(f.name, f.dataType)) for f in found.schema.fields]
    )
    return spark.read.format(fmt).schema(schema).load(target), layout


def _touched_partitions(
    current: DataFrame, source: DataFrame, layout: Sequence[str], named_at_most: int
) -> DataFrame:
    """Target rows of the partitions that the source has rows for."""
    values = source.select(*[_folder_value(source, c).alias(c) for c in layout]).distinct()
    few = values.limit(named_at_most + 1).collect()
    if len(few) <= named_at_most:
        # One condition per value of the outer columns, listing those of the innermost.
        inner: dict[tuple, list] = {}
        for *outer, last in few:
            inner.setdefault(tuple(outer), []).append(last)
        *outer_columns, last_column = map(named, layout)
        return current.filter(
            any_of(
                [
                    all_of([*map(Column.eqNullSafe, outer_columns, outer), _among(last_column, found)])
                    for outer, found in inner.items()
                ]
            )
        )
    for column in layout:
        current = current.filter(_within(named(column), values.select(named(column).alias("v")).distinct()))
    values = values.select(*[named(c).alias(f"v{i}") for i, c in enumerate(layout)])
    same = all_of([named(c).eqNullSafe(F.col(f"v{i}")) for i, c in enumerate(layout)])
    return current.join(values, same, "left_semi")


def _within(column: Column, values: DataFrame) -> Column:
    """Condition that holds for all of the values ``v``, and that prunes partitions."""
    few = [r.v for r in values.limit(NAMED_VALUES + 1).collect()]
    if len(few) <= NAMED_VALUES:
        return _among(column, few)
    low, high, nulls = values.agg(F.min("v"), F.max("v"), F.count_if(F.col("v").isNull())).head()
    return column.between(low, high) | (column.isNull() if nulls else F.lit(False))


def _among(column: Column, values: list) -> Column:
    known = [v for v in values if v is not None]
    hits = [column.isin(known)] if known else []
    return any_of(hits + [column.isNull()] if len(known) < len(values) else hits)


def _folder_value(df: DataFrame, column: str) -> Column:
    """What a partition value reads back as: an empty string shares the folder of NULL."""
    if isinstance(df.schema[column].dataType, StringType):
        return F.when(named(column) != "", named(column))
    return named(column)
