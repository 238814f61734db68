"""Merkle manifest of a dataset, with a proof for each leaf by pointer jumping.

A leaf is the digest of a row's fields. The leaves of a group (a language, say) ascend in a
given order and are hashed in runs of FANOUT consecutive nodes, level by level, until one is
left: the group's subroot. The subroots, in the order of their groups, are hashed to the root
in the same way.

Proofs come by pointer jumping. Every node holds a pointer, at first to its parent, and a path,
at first of the one piece that lies beside it in its run (the digests left of it and right of
it). A self-join replaces each pointer by that of the node it points to and appends that node's
path, which doubles the distance; after log2(height) joins all have reached the root. The leaves
of a run share all that is above it, so a run is one row until the end. Ancestors that many
nodes point to are few, so they are broadcast once their size is measured to be small; those
that are not small are pointed to by few nodes each.

Places come from one range exchange, with no task for a whole group: rows are sorted within
ranges, numbered within each, and set off by the rows of the group's ranges before it. Equal rows
lie in several ranges if there are many.

Null fields are marked as such and differ from empty ones. Null groups come first and are a group
like any other, null order values come first; rows equal in group and order ascend by their
digests, and repeated rows, whose places can't be told apart, are each a leaf. An empty table
has no leaves and no root.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eclusa.llm.frames import discard, staged

FANOUT = 8
# Up to this many bytes of nodes are broadcast to those that point to them.
BROADCAST_BYTES = 32 * 1024 * 1024
# Bytes that a node needs beyond its path.
NODE_BYTES = 128
# Tree of the subroots; the groups' own trees are numbered from 0 on.
TOP = -1
_PATH = "array<struct<left:binary,right:binary>>"


def field(value: Column) -> Column:
    """A value as it is hashed: ``-`` for null, else its number of bytes, a colon, and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def digest(*fields: Column) -> Column:
    """Digest of a row's fields, as bytes."""
    return _hash(F.concat(*map(field, fields)))


def _hash(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def as_text(raw: Column) -> Column:
    return F.lower(F.hex(raw))


# --- places ---


def _in_ranges(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows sorted within ranges, with ``at``: number of the range, and place in it."""
    # Equal rows part by this number, so that many of them don't fill one range.
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    ranged = salted.repartitionByRange(*by, "salt").sortWithinPartitions(*by, "salt").drop("salt")
    return staged(ranged.withColumn("at", F.monotonically_increasing_id()), "merkle-order")


def _part() -> Column:
    return F.shiftright("at", 33)


def _starts(ranged: DataFrame, group: Sequence[str]) -> DataFrame:
    """``part``, the group, the first ``at`` of it in there, and its rows before; one row for each."""
    counted = ranged.groupBy(_part().alias("part"), *group).agg(
        F.min("at").alias("first"), F.count("*").alias("n")
    )
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))


def _trees(parts: DataFrame) -> DataFrame:
    """``group`` with its number, ``tree``, in the order of groups, and ``n``, its rows."""
    sizes = parts.groupBy("group").agg(F.sum("n").alias("n"))
    ranged = _in_ranges(sizes, ["group"])
    starts = _starts(ranged, []).select("part", "first", "start")
    place = F.col("at") - F.col("first") + F.col("start")
    return ranged.join(starts, _part() == F.col("part")).select("group", "n", place.alias("tree"))


def _placed(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``tree``, ``n``, ``pos``, ``digest`` and ``row`` of ``group``, ``key``, ``digest``, ``row``; the trees."""
    ranged = _in_ranges(leaves, ["group", "key", "digest"])
    parts = staged(_starts(ranged, ["group"]), "merkle-parts")
    trees = staged(_trees(parts), "merkle-trees")
    starts = parts.select("part", F.col("group").alias("g"), "first", "start")
    starts = starts.join(trees, F.col("g").eqNullSafe(F.col("group"))).drop("group")
    same = (_part() == F.col("part")) & F.col("group").eqNullSafe(F.col("g"))
    place = F.col("at") - F.col("first") + F.col("start")
    return ranged.join(starts, same).select("tree", "n", place.alias("pos"), "digest", "row"), trees


# --- levels ---


def _runs(nodes: DataFrame) -> DataFrame:
    """``tree``, ``n`` (nodes of the tree at this level), ``run`` and its nodes in order."""
    more = [c for c in nodes.columns if c not in ("tree", "n", "pos")]
    run = F.floor(F.col("pos") / FANOUT).alias("run")
    inside = F.array_sort(F.collect_list(F.struct("pos", *more)))
    return nodes.groupBy("tree", "n", run).agg(inside.alias("nodes"))


def _texts() -> Column:
    return F.transform("nodes", lambda x: as_text(x["digest"]))


def _parents(runs: DataFrame) -> DataFrame:
    """Nodes of the next level: a run's digest, or its only node where the tree has no more."""
    own = F.when(F.col("n") > 1, _hash(F.array_join(_texts(), ""))).otherwise(F.get("nodes", F.lit(0))["digest"])
    n = F.ceil(F.col("n") / FANOUT).cast("long")
    return runs.select("tree", n.alias("n"), F.col("run").alias("pos"), own.alias("digest"))


def _piece(i: Column) -> Column:
    """What lies beside the node at ``i`` of a run."""

    def joined(first: Column, n: Column) -> Column:
        return F.unhex(F.array_join(F.slice(_texts(), first, n), ""))

    size = F.size("nodes")
    return F.struct(
        joined(F.lit(1), i).alias("left"), joined(i + 2, F.greatest(size - i - 1, F.lit(0))).alias("right")
    )


def _levels(first: DataFrame, n: int) -> tuple[list[DataFrame], DataFrame]:
    """Runs of each level, from that of the given runs on, and the trees' last nodes."""
    levels, left = [first], n
    ends = []
    while True:
        made = staged(_parents(levels[-1]), "merkle-nodes")
        ends.append(made.filter("n = 1").select("tree", "digest"))
        left = -(-left // FANOUT)
        if left <= 1:
            return levels, reduce(DataFrame.union, ends)
        levels.append(staged(_runs(made.filter("n > 1")), "merkle-runs"))


def _pointers(levels: Sequence[DataFrame], lowest: int, above: tuple[Column, Column, Column] | None) -> DataFrame:
    """A row for each node of the runs: its key, the key it points to, and its path.

    ``above`` is what the last run's nodes point to; without it they have reached the root.
    """
    none = F.lit(None).cast("long")
    up = above or (none, none, none)
    rows = []
    for level, runs in enumerate(levels, lowest):
        each = F.posexplode("nodes").alias("i", "node")
        made = runs.withColumn("pieces", F.transform("nodes", lambda _, i: _piece(i))).filter("n > 1")
        last = F.col("n") <= FANOUT
        parent = [F.col("tree"), F.lit(level + 1).cast("long"), F.col("run")]
        rows.append(
            made.select("tree", "n", "run", "pieces", each).select(
                "tree",
                F.lit(level).cast("long").alias("level"),
                F.col("node.pos").alias("pos"),
                *(
                    F.when(last, end).otherwise(own).alias(name)
                    for name, end, own in zip(("up_tree", "up_level", "up_pos"), up, parent, strict=True)
                ),
                F.array(F.get("pieces", F.col("i"))).cast(_PATH).alias("path"),
                F.col("node.digest").alias("digest"),
            )
        )
    return reduce(DataFrame.union, rows)


# --- proofs ---


def _path_bytes() -> Column:
    sizes = F.transform("path", lambda p: F.octet_length(p["left"]) + F.octet_length(p["right"]))
    return F.aggregate(sizes, F.lit(NODE_BYTES), lambda a, b: a + b)


def _jumped(nodes: DataFrame, longest: int, broadcast_bytes: int) -> DataFrame:
    """The nodes with their paths to the root: distances of 1, 2, 4, ... until all are there."""
    done = 1
    while done < longest:
        # Nodes point ``done`` levels up, so that these alone are pointed to.
        far = nodes.filter((F.col("tree") == TOP) | (F.col("level") > done))
        size = far.agg(F.sum(_path_bytes())).head()[0] or 0
        far = far.select(
            F.col("tree").alias("t"),
            F.col("level").alias("l"),
            F.col("pos").alias("p"),
            F.struct("up_tree", "up_level", "up_pos").alias("next"),
            F.col("path").alias("rest"),
            F.col("subroot").alias("s"),
        )
        same = (F.col("up_tree") == F.col("t")) & (F.col("up_level") == F.col("l")) & (F.col("up_pos") == F.col("p"))
        under = nodes.filter("up_tree is not null")
        joined = under.join(F.broadcast(far) if size <= broadcast_bytes else far, same).select(
            "tree",
            "level",
            "pos",
            "next.*",
            F.concat("path", "rest").alias("path"),
            F.coalesce("subroot", "s").alias("subroot"),
        )
        made = staged(nodes.filter("up_tree is null").union(joined), "merkle-paths")
        discard(nodes)
        nodes, done = made, 2 * done
    return nodes


def proofs(
    leaves: DataFrame,
    group: str,
    order: str,
    leaf: str,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The leaves with ``subroot``, ``root`` and ``path``; digests are bytes.

    ``leaf`` names the column with a leaf's digest. All columns are kept, in the struct ``row``,
    and must be of types that can be ordered. ``path`` has a piece for each level: the digests
    ``left`` of the leaf's ancestor in its run, and those ``right`` of it, one after the other.
    """
    rows = leaves.select(
        F.col(f"`{group}`").alias("group"),
        F.col(f"`{order}`").alias("key"),
        F.col(f"`{leaf}`").alias("digest"),
        F.struct(*(F.col(f"`{c}`") for c in leaves.columns)).alias("row"),
    )
    placed, trees = _placed(staged(rows, "merkle-leaves"))
    runs = staged(_runs(placed), "merkle-runs")
    n_trees, largest = trees.agg(F.count("*"), F.max("n")).head()
    if not n_trees:
        none = F.lit(None).cast("binary")
        return runs.select(
            F.explode("nodes.row").alias("row"), none.alias("subroot"), none.alias("root"),
            F.array().cast(_PATH).alias("path"),
        )
    # The first runs are rows of their own; their digests and those above are nodes.
    levels, subroots = _levels(runs, largest)
    top = subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"), F.col("tree").alias("pos"), "digest"
    )
    tops, root = _levels(staged(_runs(top), "merkle-runs"), n_trees)
    root = root.head()["digest"]

    to_top = (F.lit(TOP).cast("long"), F.lit(0).cast("long"), F.col("tree"))
    upper = _pointers(tops, 0, None)
    # A group's last node is one of the top tree's first ones, and its digest a subroot.
    first = F.when((F.col("tree") == TOP) & (F.col("level") == 0), F.col("digest"))
    nodes = upper
    if len(levels) > 1:
        lone = n_trees == 1
        nodes = _pointers(levels[1:], 1, None if lone else to_top).union(upper)
    nodes = staged(nodes.withColumn("subroot", first).drop("digest"), "merkle-paths")
    paths = _jumped(nodes, len(levels) - 1 + (len(tops) if n_trees > 1 else 0), broadcast_bytes)

    small = F.col("n") <= FANOUT
    keyed = runs.select(
        F.when(small, F.lit(TOP).cast("long")).otherwise(F.col("tree")).alias("tree"),
        F.when(small, 0).otherwise(1).cast("long").alias("level"),
        F.when(small, F.col("tree")).otherwise(F.col("run")).alias("pos"),
        "n",
        "nodes",
    )
    above = paths.select("tree", "level", "pos", "path", "subroot").filter(
        ((F.col("tree") == TOP) & (F.col("level") == 0)) | ((F.col("tree") != TOP) & (F.col("level") == 1))
    )
    pieces = F.transform("nodes", lambda _, i: _piece(i))
    joined = keyed.withColumn("pieces", pieces).join(above, ["tree", "level", "pos"], "left")
    rest = F.coalesce("path", F.array().cast(_PATH))
    own = F.array(F.get("pieces", F.col("i"))).cast(_PATH)
    return joined.select("n", "path", "subroot", "pieces", F.posexplode("nodes").alias("i", "node")).select(
        F.col("node.row").alias("row"),
        F.coalesce("subroot", F.lit(bytes(root))).alias("subroot"),
        F.lit(bytes(root)).alias("root"),
        F.when(F.col("n") > 1, F.concat(own, rest)).otherwise(rest).alias("path"),
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root, as text, that a leaf's digest comes to with the path's digests beside it."""
    return F.aggregate(
        path,
        as_text(leaf),
        lambda at, p: F.sha2(F.concat(as_text(p["left"]), at, as_text(p["right"])).cast("binary"), 256),
    )


def siblings(path: Column) -> Column:
    """All digests of a path as text, level by level and left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(as_text(p["left"]), as_text(p["right"]))), "")


# --- documents ---

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# A-Z and a-z.
_UPPER = "".join(map(chr, range(65, 91)))
_LOWER = _UPPER.lower()


def document_leaves(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``leaf`` and ``tampered``, the digest if the text had been lower-cased.

    That is what the query pretends for every id whose checksum 3 divides; for the rest, ids
    that are null among them, ``tampered`` is null.
    """
    text = F.translate(F.col("text").cast("string"), _UPPER, _LOWER)
    others = [F.col(c) for c in FIELDS[:-1]]
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        digest(*others, F.col("text")).alias("leaf"),
        F.when(marked, digest(*others, text)).alias("tampered"),
    )


def checked(documents: DataFrame) -> DataFrame:
    """Leaf, subroot, root and proof of each document, and what its tampered text folds to."""
    found = proofs(document_leaves(documents), "lang", "doc_id", "leaf")
    used = F.coalesce("row.tampered", "row.leaf")
    return found.withColumn("folded_root", folded(used, F.col("path"))).select(
        "row.doc_id",
        as_text(F.col("row.leaf")).alias("leaf"),
        as_text(F.col("subroot")).alias("subroot"),
        as_text(F.col("root")).alias("root"),
        F.sha2(siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == as_text(F.col("root"))).alias("verified"),
    )


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def oracle() -> str:
    """DuckDB's SQL for :func:`checked`: levels, siblings and folds by recursion."""

    def leaf(text: str) -> str:
        values = [*(f"cast({c} as varchar)" for c in FIELDS[:-1]), text]
        return "sha256(" + " || ".join(map(_field_sql, values)) + ")"

    # CRC-32 bit by bit: the reflected polynomial over the characters of the id.
    bit = "lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end"
    byte = f"lambda c, b: list_reduce([1, 2, 3, 4, 5, 6, 7, 8], {bit}, xor(c, b))"
    chars = "list_transform(string_split(cast(doc_id as varchar), ''), lambda s: cast(ascii(s) as bigint))"
    crc = f"xor(list_reduce({chars}, {byte}, 4294967295::bigint), 4294967295)"
    grow = """sha256(string_agg(digest, '' order by pos)), (any_value(n) + 7) // 8"""
    beside = """string_agg(l.digest, '' order by l.pos) filter (where l.pos < mine) as lefts,
        string_agg(l.digest, '' order by l.pos) filter (where l.pos > mine) as rights"""
    return f"""
    with recursive leaves as (
      select row_number() over () as rid, doc_id, lang, {leaf("text")} as leaf,
        case when {crc} % 3 = 0 then {leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} end as tampered
      from documents),
    placed as (
      select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
        count(*) over (partition by lang) as n, dense_rank() over (order by lang nulls first) - 1 as tree
      from leaves),
    low as (
      select tree, 0 as level, pos, leaf as digest, n from placed
      union all
      select tree, level + 1, pos // 8, {grow} from low where n > 1 group by tree, level, pos // 8),
    high as (
      select 0 as level, tree as pos, digest, (select count(distinct tree) from placed) as n from low where n = 1
      union all
      select level + 1, pos // 8, {grow} from high where n > 1 group by level, pos // 8),
    steps as (
      select p.rid, l.level as step, p.pos >> (3 * l.level) as mine, {beside}
      from placed p join low l on l.tree = p.tree and l.n > 1 and l.pos // 8 = p.pos >> (3 * l.level + 3)
      group by all
      union all
      select p.rid, 1000 + l.level as step, p.tree >> (3 * l.level) as mine, {beside}
      from placed p join high l on l.n > 1 and l.pos // 8 = p.tree >> (3 * l.level + 3)
      group by all),
    path as (
      select rid, coalesce(lefts, '') as l, coalesce(rights, '') as r,
        row_number() over (partition by rid order by step) as k
      from steps),
    fold as (
      select rid, 0::bigint as k, coalesce(tampered, leaf) as cur from placed
      union all
      select f.rid, p.k, sha256(p.l || f.cur || p.r) from fold f join path p on p.rid = f.rid and p.k = f.k + 1),
    proof as (
      select rid, sha256(string_agg(l || r, '' order by k)) as proof_sha256 from path group by rid)
    select p.doc_id, p.leaf, s.digest as subroot, r.digest as root,
      coalesce(q.proof_sha256, sha256('')) as proof_sha256, f.cur as folded_root, f.cur = r.digest as verified
    from placed p
    join (select tree, digest from low where n = 1) s on s.tree = p.tree
    cross join (select digest from high where n = 1) r
    join (select rid, arg_max(cur, k) as cur from fold group by rid) f on f.rid = p.rid
    left join proof q on q.rid = p.rid"""
