"""Routing of arrived files: the first control row whose ``prefixo`` occurs in the key.

The way is chosen by the measured size of the control table. All ways give one output
row per arrival and never pair an arrival with a control row it does not match.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from eclusa.functions.columns import named

# Up to this many bytes of prefixes and ids become part of the projection.
COLLECT_BYTES = 2 * 1024 * 1024
# Of those, so many distinct prefixes are tried one by one; more are joined by a piece of each.
INLINE_PREFIXES = 256
# Up to this many bytes the prefixes are broadcast to a join.
BROADCAST_BYTES = 32 * 1024 * 1024
# Bytes that a broadcast row needs beyond its text.
ROW_OVERHEAD = 128
# Beyond, a Bloom filter of their pieces is broadcast: bits of it for each prefix, bytes at most.
FILTER_BITS, FILTER_BYTES = 32, 32 * 1024 * 1024
# Bits of one of the filter's blocks (a power of two), and how many of them a piece sets.
BLOCK_BITS, SPOTS = 8192, 4

_ROUTE = "dataset_id: string, prefixo: string"
_LAST = 2**31 - 1


def route(
    arrivals: DataFrame,
    control: DataFrame,
    key: str = "key",
    inline: int = INLINE_PREFIXES,
    collect_bytes: int = COLLECT_BYTES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``arrivals`` with ``dataset_id`` and ``prefixo`` of the control row each key goes to.

    Both are NULL if no prefix occurs in the key. A blank prefix occurs in every key. The
    arrivals must be a table that reads the same each time.
    """
    size = _size(control)
    routes = _first_routes(control) if size <= collect_bytes else None
    if routes is not None and len(routes) <= inline:
        routed = arrivals.withColumn("_destino", _one_by_one(named(key), routes))
    elif routes is not None:
        sizes = sorted({_size_of(p) for p, _ in routes if p})
        index = _collected_index(arrivals.sparkSession, routes)
        routed = _by_pieces(arrivals, index, sizes, key, True)
        if routes and routes[-1][0] == "":
            routed = routed.withColumn("_destino", F.coalesce("_destino", _catch_all(key, routes[-1][1])))
    else:
        prefixes = control.filter(F.col("prefixo") != "")
        found = {r[0]: r[1] for r in prefixes.groupBy(_power("prefixo")).count().collect()}
        small = size <= broadcast_bytes
        routed = _by_pieces(arrivals, _index(control), sorted(found), key, small, sum(found.values()))
        blank = control.filter(F.col("prefixo") == "").orderBy("ordem").head()
        if blank is not None:
            every = _catch_all(key, blank["dataset_id"], blank["ordem"])
            routed = routed.withColumn("_destino", F.least("_destino", every))
    return routed.select(
        *[named(c) for c in arrivals.columns],
        F.col("_destino.dataset_id").alias("dataset_id"),
        F.col("_destino.prefixo").alias("prefixo"),
    )


def _size(control: DataFrame) -> int:
    # The join carries a prefix twice, as key and as part of the route.
    text = 2 * F.octet_length("prefixo") + F.octet_length("dataset_id")
    row = text + F.octet_length("ordem.arquivo") + ROW_OVERHEAD
    return control.agg(F.sum(row)).head()[0] or 0


def _first_routes(control: DataFrame) -> list[tuple[str, str]]:
    """Prefix and dataset of the rows that can win, in file order; a blank prefix is the last."""
    rows = control.select("ordem", "prefixo", "dataset_id").collect()
    first: dict[str, str] = {}
    for _, prefix, dataset_id in sorted(rows):
        first.setdefault(prefix, dataset_id)
        if prefix == "":
            break
    return list(first.items())


def _one_by_one(key: Column, routes: list[tuple[str, str]]) -> Column:
    if not routes:
        return F.lit(None).cast(f"struct<{_ROUTE}>")
    table = F.array(
        *[F.struct(F.lit(d).alias("dataset_id"), F.lit(p).alias("prefixo")) for p, d in routes]
    )
    return F.get(F.filter(table, lambda r: F.contains(key, r["prefixo"])), 0)


def _index(control: DataFrame) -> DataFrame:
    """The prefixes by a piece of each: ``size`` and ``piece`` (its hash), ``back`` and ``prefix``.

    A prefix's piece is as long as the largest power of two that its bytes hold, so that few
    sizes serve prefixes of all lengths. It stands at the prefix's start or at its end, ``back``
    bytes on: where fewer prefixes have the same one, as many may begin or end alike.
    """
    first = control.filter(F.col("prefixo") != "").groupBy("prefixo").agg(
        F.min(F.struct("ordem", "dataset_id", "prefixo")).alias("destino")
    )
    raw = F.col("prefixo").cast("binary")
    rows = first.select("destino", raw.alias("prefix"), _power("prefixo").alias("size"))
    last = F.octet_length("prefix") - F.col("size")
    ends = F.explode(F.array(F.lit(0), last)).alias("back")
    pieces = rows.select("destino", "prefix", "size", ends).withColumn(
        "piece", _piece(F.col("prefix"), F.col("back") + 1, F.col("size"))
    )
    shared = pieces.groupBy("size", "piece").agg(F.count("*").alias("n"))
    best = pieces.join(shared, ["size", "piece"]).groupBy("prefix").agg(
        F.min(F.struct("n", "back", "size", "piece", "destino")).alias("best")
    )
    return best.select("prefix", *(F.col(f"best.{c}") for c in ("back", "size", "piece", "destino")))


def _power(text: str) -> Column:
    """The largest power of two that a text's bytes hold: the leading binary digit of their number."""
    return F.pow(F.lit(2), F.length(F.bin(F.octet_length(F.col(text).cast("binary")))) - 1).cast("int")


def _size_of(text: str) -> int:
    return 1 << len(text.encode()).bit_length() - 1


def _collected_index(spark: SparkSession, routes: list[tuple[str, str]]) -> DataFrame:
    """The same of routes that the driver has; ``ordem`` is their place in the list."""
    raw = [(i, p.encode()) for i, (p, _) in enumerate(routes) if p]
    size = {i: _size_of(routes[i][0]) for i, _ in raw}
    shared = Counter(piece for i, p in raw for piece in (p[: size[i]], p[len(p) - size[i] :]))
    rows = []
    for i, p in raw:
        n = size[i]
        back = min(0, len(p) - n, key=lambda at: (shared[p[at : at + n]], at))
        rows.append((bytearray(p), back, n, (i, routes[i][1], routes[i][0])))
    schema = f"prefix binary, back int, size int, destino struct<ordem: int, {_ROUTE}>"
    index = spark.createDataFrame(rows, schema).coalesce(1)
    return index.withColumn("piece", _piece(F.col("prefix"), F.col("back") + 1, F.col("size")))


def _piece(raw: Column, at: Column, size: Column) -> Column:
    return F.xxhash64(size, F.substring(raw, at, size))


def _pieces(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """The rows with ``_size`` and ``_at`` of each piece of their ``_bytes``.

    A row without any, for want of bytes, comes once, with NULL.
    """
    fitting = F.filter(
        F.array(*[F.lit(n) for n in sizes]).cast("array<int>"), lambda n: n <= F.octet_length("_bytes")
    )
    last = F.octet_length("_bytes") - F.col("_size") + 1
    return rows.select("*", F.explode_outer(fitting).alias("_size")).select(
        "*", F.explode_outer(F.sequence(F.lit(1), last)).alias("_at")
    )


def _found(piece: Column, raw: Column) -> Column:
    """The prefix of the row that shares a piece stands in the key, where the piece says."""
    start = F.col("_at") - F.col("back")
    return (
        (F.col("piece") == piece)
        & (start >= 1)
        & (F.substring(raw, start, F.octet_length("prefix")) == F.col("prefix"))
    )


def _spots(piece: Column) -> list[Column]:
    """The bits that a piece sets in its block."""
    other, width = F.xxhash64(piece, F.lit(1)), BLOCK_BITS.bit_length() - 1
    return [
        F.shiftrightunsigned(other, width * i).bitwiseAND(BLOCK_BITS - 1).cast("int") for i in range(SPOTS)
    ]


def _filter(index: DataFrame, blocks: int) -> DataFrame:
    """A Bloom filter of the index's pieces: ``block`` and its bits, as ``words`` of 64."""
    block = F.pmod("piece", F.lit(blocks)).alias("block")
    bits = index.select(block, F.explode(F.array(*_spots(F.col("piece")))).alias("spot"))
    words = bits.groupBy("block", F.shiftright("spot", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, spot & 63))").alias("bits")
    )
    each = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("of"))
    places = F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1))
    dense = F.transform(places, lambda w: F.coalesce(F.try_element_at("of", w), F.lit(0).cast("bigint")))
    return each.select("block", dense.alias("words"))


def _likely(pieces: DataFrame, index: DataFrame, prefixes: int) -> DataFrame:
    """The pieces, by their hash ``_piece``, that the index can have; few that it hasn't.

    The filter grows with the number of prefixes up to FILTER_BYTES; beyond, it lets more
    through, but never loses a piece of the index.
    """
    blocks = min(-(-prefixes * FILTER_BITS // BLOCK_BITS), FILTER_BYTES * 8 // BLOCK_BITS) or 1
    there = F.pmod("_piece", F.lit(blocks)) == F.col("block")
    for spot in _spots(F.col("_piece")):
        there &= F.getbit(F.get("words", F.shiftright(spot, 6)), spot.bitwiseAND(63)) == 1
    return pieces.join(F.broadcast(_filter(index, blocks)), there, "left_semi")


def _by_pieces(
    arrivals: DataFrame, index: DataFrame, sizes: list[int], key: str, small: bool, prefixes: int = 0
) -> DataFrame:
    """``arrivals`` with ``_destino``, the first control row whose prefix stands in the key.

    The keys' pieces are joined with the prefixes' by equality, and a hit is checked where
    it stands. A small index is broadcast: the arrivals are read once and dealt evenly
    before their pieces are made, so that an arrival's hits meet without another shuffle.
    Otherwise each distinct key is searched once: its pieces that pass a filter of the index's
    are shuffled to it, and AQE splits a piece or key that dominates.
    """
    raw = named(key).cast("binary").alias("_bytes")
    piece = _piece(F.col("_bytes"), F.col("_at"), F.col("_size"))
    whole = F.struct(*[named(c) for c in arrivals.columns]).alias("_linha")
    if small:
        numbered = arrivals.select(F.monotonically_increasing_id().alias("_numero"), whole, raw)
        joined = _pieces(numbered.repartition("_numero"), sizes).join(
            F.broadcast(index), _found(piece, F.col("_bytes")), "left"
        )
        first = F.col("_at").isNull() | ((F.col("_at") == 1) & (F.col("_size") == (sizes or [0])[0]))
        hits = joined.filter(F.col("destino").isNotNull() | first)
        routed = hits.groupBy("_numero").agg(F.first("_linha").alias("_linha"), F.min("destino").alias("_destino"))
        return routed.select("_linha.*", "_destino")
    # Spark takes the pieces for as few as the keys, and might broadcast those.
    keys = arrivals.select(named(key).alias("_key")).filter("_key is not null").distinct()
    pieces = _pieces(keys.withColumn("_bytes", F.col("_key").cast("binary")), sizes).withColumn("_piece", piece)
    likely = _likely(pieces, index, prefixes).drop("_piece", "_bytes")
    again = F.col("_key").cast("binary")
    on = _found(_piece(again, F.col("_at"), F.col("_size")), again)
    joined = likely.join(index.hint("merge"), on)
    found = joined.groupBy("_key").agg(F.min("destino").alias("_destino"))
    return arrivals.join(found, named(key) == F.col("_key"), "left").drop("_key")


def _catch_all(key: str, dataset_id: str, ordem: Row | None = None) -> Column:
    """What a blank prefix, which occurs in every key, leads to."""
    if ordem is None:
        place = F.lit(_LAST)
    else:
        file, line = F.lit(ordem["arquivo"]), F.lit(ordem["linha"]).cast("bigint")
        place = F.struct(file.alias("arquivo"), line.alias("linha"))
    route = F.struct(place.alias("ordem"), F.lit(dataset_id).alias("dataset_id"), F.lit("").alias("prefixo"))
    return F.when(named(key).isNotNull(), route)
