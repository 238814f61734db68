"""Near-duplicate classes of texts: ProbMinHash, banding in levels, exact verification.

The weighted elements of a text are its shingles of five words; a shingle that occurs c
times weighs 1 + log2(c). Each element is a Poisson process whose rate is its weight: its
arrivals, drawn from the element's hash, fall on the registers, and a register keeps the
element that arrives first. An element stops as soon as its next arrival comes after the
last register's first. The share of registers in which two texts agree estimates their
probability Jaccard similarity, which for unweighted sets is the Jaccard similarity. Pairs are
told by the Jaccard similarity of their sets, so a text that repeats shingles has a second
sketch in which all weights are 1; that of another text is the same as its weighted one.

Registers are banded; texts that share a band meet in a bucket. Any two texts of similarity 0.8
share one with a chance of 1 - 3e-6, however often they repeat their shingles. Pairs are verified by the
exact Jaccard similarity of their sets of shingles, 0.8 or more, so that any two texts that share a
band are verified or in one class already. The bands are taken in groups, and what one group
has joined is not looked at by the next.

In a bucket of up to SMALL texts every pair is verified that isn't in one class yet. In a larger
one all texts outside its largest class are held against all of the bucket, in blocks of at
most about BLOCK texts or BLOCK_BYTES of shingles a side, inside a task: a bucket of n texts, m
of them outside its largest class, makes about 2 n m / BLOCK rows of blocks, or n + m of a small
m. While m is over BLOCK, texts are joined by less first: each is verified against two of the
bucket, and where that leaves m over BLOCK, the bucket is dealt into finer ones, each by a
further band that none of the buckets it came from was made by, several ways. Two texts of
similarity 0.8 share a third of all bands, and so have a chance to meet again at each level, in
each of the WAYS ways and under each of their common buckets, while others part. What the
levels leave is done in blocks. No step emits all pairs of a large bucket, and none collects one.

Equal texts are one node from the start. A class is a connected set of nodes; its id is its
smallest doc_id. Texts of one to four words have one shingle of all their words. Texts
without words, null ones included, are alike only if they are equal; a null text counts as
an empty one. Repeated rows are in one class. A null doc_id comes after all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from eclusa.llm import words as W
from eclusa.llm.frames import discard, free_name, map_batches, map_texts, on_workers, staged, text_slices

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
# Texts of a bucket in which all pairs are verified, finer buckets of each larger one, levels.
SMALL, WAYS, LEVELS = 16, 2, 4
# Bands whose buckets are looked at together; later ones find most of theirs joined already.
GROUPS = (4, 8, 20)
# Texts, and bytes of their shingles, on each side of a block of what the levels leave.
BLOCK, BLOCK_BYTES = 512, 16 * 1024 * 1024
# Shingles that are counted at once in a block.
COUNTED = 4096
_UNIT = 2.0**-53


def shingles(found: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each run of five words, or of all words of a shorter text."""
    grams, at = W.windows(found, SHINGLE)
    texts = found.text[at]
    n = np.diff(found.first)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    whole = np.array(
        [hash_of(found.hash[found.first[t] : found.first[t + 1]]) for t in short], dtype=np.uint64
    )
    return np.concatenate([grams, whole]), np.concatenate([texts, short])


def hash_of(words: np.ndarray) -> int:
    h = np.array([len(words)], dtype=np.uint64)
    for w in words:
        h = W.mix(h * np.uint64(0xD6E8FEB86659FD93) + w)
    return int(h[0])


def elements(found: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: hash, text number and weight, by text."""
    grams, texts = shingles(found)
    order = np.lexsort((grams, texts))
    grams, texts = grams[order], texts[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (texts[1:] != texts[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(grams)))
    return grams[at], texts[at], 1 + np.log2(times)


def sketch(grams: np.ndarray, texts: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Registers of ``n`` texts: hash of the element that arrives first, 0 without elements."""
    first = np.full(n * REGISTERS, np.inf)
    who = np.zeros(n * REGISTERS, dtype=np.uint64)
    limit = np.full(n, np.inf)
    state, home = grams.copy(), texts
    clock = np.zeros(len(grams))
    rate, names = weights, grams
    while len(state):
        # The next arrival of every process that isn't over.
        state = W.mix(state + np.uint64(0x9E3779B97F4A7C15))
        clock = clock - np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * _UNIT) / rate
        at = home * REGISTERS + (W.mix(state) % np.uint64(REGISTERS)).astype(np.int64)
        early = np.flatnonzero(clock < first[at])
        np.minimum.at(first, at[early], clock[early])
        won = early[clock[early] == first[at[early]]]
        who[at[won]] = names[won]
        live = np.unique(home)
        limit[live] = first.reshape(n, REGISTERS)[live].max(axis=1)
        on = np.flatnonzero(clock < limit[home])
        state, home, clock, rate, names = state[on], home[on], clock[on], rate[on], names[on]
    return who.reshape(n, REGISTERS)


def both_sketches(grams: np.ndarray, texts: np.ndarray, weights: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Registers of ``n`` texts with their weights, and of those that repeat a shingle with weights 1.

    The second comes with one row for each text that repeats one, in order.
    """
    again = np.zeros(n, dtype=bool)
    again[texts[weights > 1]] = True
    of = again[texts]
    place = np.cumsum(again) - 1
    plain = sketch(grams[of], place[texts[of]], np.ones(int(of.sum())), int(again.sum()))
    return sketch(grams, texts, weights, n), plain


def bands(registers: np.ndarray) -> np.ndarray:
    """One number for each band of each row of registers."""
    parts = registers.reshape(len(registers), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(ROWS):
        out = W.mix(out * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, j])
    return out


def with_bands(documents: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """The documents with the bands of their texts; none for a text without words.

    The last BANDS ones are those of the set of shingles. A text that repeats a shingle has
    as many of its weighted shingles before them.
    """
    name = free_name(documents.columns, "bands")

    def make():
        def scan(data: np.ndarray, offsets: np.ndarray):
            n = len(offsets) - 1
            grams, texts, weights = elements(W.scan(data, offsets))
            again = np.zeros(n, dtype=bool)
            again[texts[weights > 1]] = True
            has = np.bincount(texts, minlength=n) > 0
            weighted, plain = both_sketches(grams, texts, weights, n)
            # Rows of bands in the order of their texts, a text's weighted ones first.
            at = np.concatenate([np.flatnonzero(has), np.flatnonzero(again)])
            made = np.concatenate([bands(weighted)[has], bands(plain)])[np.argsort(at, kind="stable")]
            ends = np.concatenate([[0], np.cumsum((has * 1 + again) * BANDS)]).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(ends), pa.array(made.view(np.int64).ravel()))]

        return scan

    return map_texts(documents, text, make, [StructField(name, ArrayType(LongType()))]), name


def text_key(text: Column) -> Column:
    """What equal texts have in common."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def _sets(texts: DataFrame) -> DataFrame:
    """``node`` and its sorted distinct shingles, packed, from ``node`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_slices(batches, 1):
            grams, home, _ = elements(W.scan(data, offsets))
            ends = np.searchsorted(home, np.arange(len(offsets)))
            packed = [grams[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(packed, pa.binary())], names=["node", "shingles"]
            )

    return map_batches(texts, run, "node long, shingles binary")


def verified(pairs: DataFrame, sets: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets' Jaccard similarity is ``least`` or more."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            kept = []
            for x, y in zip(rows["x"].to_pylist(), rows["y"].to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = 0
                if min(len(x), len(y)) >= least * max(len(x), len(y)):
                    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                    both = int((x[at] == y).sum())
                kept.append(both > 0 and both >= least * (len(x) + len(y) - both))
            yield rows.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return map_batches(pairs.join(left, "a").join(right, "b"), run, "a long, b long")


def _all_stars(edges: DataFrame) -> bool:
    """Whether no larger end of the links has two smaller ones, or is a smaller one itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    met = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return _counts(met, (F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))) == [0]


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``class``, the smallest node it is connected with, of all linked nodes.

    Large stars and small stars by turns until the links are stars: each node is
    linked to the smallest of its neighbours, first from above, then from below.
    """

    def least(edges: DataFrame) -> DataFrame:
        # Merged: to broadcast what is shuffled already would take the driver a job and a copy more.
        return edges.groupBy("a").agg(F.min("b").alias("m")).hint("merge")

    # Every link goes from the larger node down, here and after each round.
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = staged(down.filter("a <> b").distinct(), "dup-edges")
    while not _all_stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        stars = both.join(least(both), "a").filter("b > a")
        # At most one row of each link, so that equal ones may stay until the end of the round.
        large = stars.select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
        # Small stars join what hangs below one node.
        down = least(large)
        small = large.join(down, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last, edges = edges, staged(small.union(down.select("a", F.col("m").alias("b"))).distinct(), "dup-edges")
        discard(last)
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("class")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("class")).union(own)


def _with_class(rows: DataFrame, classes: DataFrame | None) -> DataFrame:
    if classes is None:
        return rows.withColumn("class", F.col("node"))
    found = rows.join(classes, "node", "left")
    return found.withColumn("class", F.coalesce("class", "node"))


def _open_buckets(rows: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several classes, with ``n``, the bucket's texts, ``m``, those
    outside its largest class, and its first and last text."""
    each = rows.groupBy("key", "class").agg(
        F.count("*").alias("n"), F.min("node").alias("first"), F.max("node").alias("final")
    )
    counted = each.groupBy("key").agg(
        F.sum("n").alias("n"),
        (F.sum("n") - F.max("n")).alias("m"),
        F.min(F.struct(F.col("first").alias("node"), "class")).alias("leader"),
        F.max(F.struct(F.col("final").alias("node"), "class")).alias("last"),
    )
    return rows.join(counted.filter("m > 0").hint("merge"), "key")


def _all_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of different classes in small buckets."""
    one = rows.select("key", F.col("node").alias("a"), F.col("class").alias("ca"))
    other = rows.select("key", F.col("node").alias("b"), F.col("class").alias("cb"))
    return one.join(other, "key").filter("a < b and ca <> cb").select("a", "b")


def _stars(rows: DataFrame) -> DataFrame:
    """Pairs of each text with two of its bucket, if they are of other classes."""
    others = F.filter(F.array("leader", "last"), lambda e: e["class"] != F.col("class"))
    ends = rows.select("node", F.explode(others).alias("end"))
    return ends.select(F.col("end.node").alias("a"), F.col("node").alias("b"))


def _finer(rows: DataFrame, sketches: DataFrame) -> DataFrame:
    """Rows of large buckets in finer ones: by further bands that the bucket itself chooses.

    ``used`` are the bands that led to a bucket; each way takes another one of the rest,
    of the set of shingles, as that is what pairs are verified by.
    The rows get their texts' bands once, and take them along to all levels.
    """
    if "bands" not in rows.columns:
        rows = rows.join(sketches.select("node", "bands"), "node")
    ways = F.explode(F.sequence(F.lit(0), F.lit(WAYS - 1))).alias("way")
    each = rows.select("node", "key", "bands", "used", ways)
    left = F.array_except(F.sequence(F.lit(0), F.lit(BANDS - 1)), F.col("used"))
    at = F.pmod(F.pmod(F.xxhash64("key"), F.size(left)) + F.col("way"), F.size(left))
    each = each.withColumn("band", F.get(left, at.cast("int")))
    return each.select(
        "node",
        F.xxhash64("key", "way", F.get("bands", F.size("bands") - BANDS + F.col("band"))).alias("key"),
        "bands",
        F.array_append("used", F.col("band")).alias("used"),
    )


def shared_counts(left: list[np.ndarray], right: list[np.ndarray], nodes: np.ndarray) -> np.ndarray:
    """Number of common shingles of each left set and each right one.

    ``nodes`` are those of the left sets, then of the right ones; a node may be on both sides.
    """
    n = len(left)
    grams = np.concatenate([*left, *right])
    at = np.repeat(np.arange(len(nodes)), [len(x) for x in (*left, *right)])
    known, word = np.unique(grams, return_inverse=True)
    # Shingles of one node alone are common to no two.
    low, high = np.full(len(known), np.iinfo(np.int64).max), np.full(len(known), -1)
    np.minimum.at(low, word, nodes[at])
    np.maximum.at(high, word, nodes[at])
    common = low < high
    place = np.cumsum(common) - 1
    of = common[word]
    word, at = place[word[of]], at[of]
    order = np.argsort(word, kind="stable")
    word, at = word[order], at[order]
    both = np.zeros((n, len(right)), dtype=np.int64)
    for first in range(0, int(common.sum()), COUNTED):
        a, b = np.searchsorted(word, [first, first + COUNTED])
        has = np.zeros((len(nodes), COUNTED), dtype=np.float32)
        has[at[a:b], word[a:b] - first] = 1
        both += (has[:n] @ has[n:].T).astype(np.int64)
    return both


def _block_links(rows: DataFrame, sets: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """All links between different classes of the buckets ``key``, from ``key``, ``node``, ``class``."""
    sized = rows.join(sets.select("node", F.length("shingles").alias("bytes")), "node")
    each = sized.groupBy("key", "class").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    whole = each.groupBy("key").agg(
        F.max(F.struct("n", "class", "bytes")).alias("top"),
        F.sum("n").alias("n"),
        F.sum("bytes").alias("bytes"),
    )

    def blocks(n: Column, size: Column) -> Column:
        return F.greatest(F.ceil(n / BLOCK), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")

    counted = whole.select(
        "key",
        F.col("top.class").alias("top"),
        blocks(F.col("n") - F.col("top.n"), F.col("bytes") - F.col("top.bytes")).alias("lefts"),
        blocks(F.col("n"), F.col("bytes")).alias("rights"),
    )
    met = rows.join(counted.hint("merge"), "key")

    def own(n: str) -> Column:
        return F.pmod(F.xxhash64("node"), F.col(n)).cast("int")

    def all_of(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = met.filter("class <> top").select(
        "key", own("lefts").alias("i"), all_of("rights").alias("j"), F.lit(True).alias("left"), "node", "class"
    )
    right = met.select(
        "key", all_of("lefts").alias("i"), own("rights").alias("j"), F.lit(False).alias("left"), "node", "class"
    )
    dealt = left.union(right).join(sets, "node")

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by([("left", "descending")])
        n = int(np.count_nonzero(block["left"].to_numpy()))
        nodes, own = block["node"].to_numpy(), block["class"].to_numpy()
        found = [np.frombuffer(x, np.uint64) for x in block["shingles"].to_pylist()]
        size = np.array([len(x) for x in found])
        both = shared_counts(found[:n], found[n:], nodes)
        near = (both > 0) & (both >= least * (size[:n, None] + size[None, n:] - both))
        a, b = np.nonzero(near & (own[:n, None] != own[None, n:]))
        return pa.table({"a": nodes[:n][a], "b": nodes[n:][b]})

    return on_workers(dealt).groupBy("key", "i", "j").applyInArrow(run, "a long, b long").distinct()


def _merged(classes: DataFrame | None, links: DataFrame) -> DataFrame:
    """Classes after more links: only the linked classes are looked at, not their nodes."""
    if classes is None:
        return staged(components(links), "dup-classes")
    ends = [classes.select(F.col("node").alias(x), F.col("class").alias("c" + x)) for x in "ab"]
    own = links.join(ends[0], "a", "left").join(ends[1], "b", "left")
    joined = components(own.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    joined = staged(joined, "dup-joined")
    to = joined.select(F.col("node").alias("class"), F.col("class").alias("to"))
    old = classes.join(to, "class", "left").select("node", F.coalesce("to", "class").alias("class"))
    return staged(old.union(joined.join(classes, "node", "left_anti")), "dup-classes")


def _linked(classes: DataFrame | None, links: DataFrame) -> DataFrame | None:
    links = staged(links, "dup-links")
    if not links.isEmpty():
        classes, old = _merged(classes, links), classes
        if old is not None:
            discard(old)
    discard(links)
    return classes


def _counts(rows: DataFrame, *which: Column) -> list[int]:
    """Number of the rows that meet each condition."""
    return list(rows.agg(*(F.count_if(c).alias(f"n{i}") for i, c in enumerate(which))).head())


def _by_buckets(
    sketches: DataFrame, sets: DataFrame, rows: DataFrame, classes: DataFrame | None
) -> DataFrame | None:
    """Classes after all links between texts that share one of the buckets."""
    large, crowd, crowded = F.col("n") > SMALL, F.col("m") > BLOCK, None
    for level in range(LEVELS):
        open_ = staged(_open_buckets(_with_class(rows, classes)), "dup-buckets")
        few, some, many = _counts(open_, ~large, large & ~crowd, large & crowd)
        if few + some + many == 0:
            discard(open_)
            break
        # Steps that no bucket needs are left out: each of their stages would cost the driver memory.
        pairs = [_all_pairs(open_.filter(~large))] if few else []
        pairs += [_stars(open_.filter(large & crowd))] if many else []
        pairs = [staged(reduce(DataFrame.union, pairs).distinct(), "dup-pairs")] if pairs else []
        links = [verified(p, sets) for p in pairs]
        links += [_block_links(open_.filter(large & ~crowd).select("key", "node", "class"), sets)] if some else []
        classes = _linked(classes, reduce(DataFrame.union, links))
        if not many:
            discard(*pairs, open_)
            break
        # The stars may have left few outside the largest class of a bucket.
        hot = open_.filter(large & crowd).drop("class", "n", "m", "leader", "last")
        hot = staged(_open_buckets(_with_class(hot, classes)), "dup-buckets")
        discard(*pairs, open_)
        some, many = _counts(hot, ~crowd, crowd)
        if some:
            classes = _linked(classes, _block_links(hot.filter(~crowd).select("key", "node", "class"), sets))
        if not many:
            break
        hot = hot.filter(crowd).drop("class", "n", "m", "leader", "last")
        if crowded is None:
            crowded = hot.select("key", "node")
        if level + 1 == LEVELS:
            break
        rows = _finer(hot, sketches)
    if crowded is not None:
        # What the finer buckets have not joined.
        left = staged(_open_buckets(_with_class(crowded, classes)).select("key", "node", "class"), "dup-left")
        classes = _linked(classes, _block_links(left, sets))
    return classes


def _classes(sketches: DataFrame, sets: DataFrame, met: DataFrame) -> DataFrame | None:
    """Classes of the nodes, from their rows in buckets; None if nothing is linked."""
    classes, first = None, 0
    for n in GROUPS:
        own = met.filter(F.get("used", F.lit(0)).between(first, first + n - 1))
        classes, first = _by_buckets(sketches, sets, own, classes), first + n
    return classes


def classes(documents: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Texts and their classes: one row for each distinct text, and one for each document row.

    The first frame has ``text_key``, ``node``, ``class``, ``doc_id`` (the text's smallest) and
    ``class_id`` (the class's smallest doc_id); the second ``doc_id`` and ``text_key``.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    made, name = with_bands(rows)
    keyed = made.select("doc_id", text_key(F.col("text")).alias("text_key"), F.col(name).alias("bands"))
    keyed = staged(keyed, "dup-sketches")
    first = Window.partitionBy("text_key").orderBy(F.col("doc_id").asc_nulls_last())
    distinct = keyed.withColumn("at", F.row_number().over(first)).filter("at = 1").drop("at")
    sketches = staged(distinct.withColumn("node", F.monotonically_increasing_id()), "dup-texts")

    banded = sketches.select("node", "bands", F.posexplode("bands").alias("at", "key"))
    # A band that a text has both ways counts once.
    banded = banded.filter((F.col("at") < BANDS) | (F.col("key") != F.get("bands", F.col("at") - BANDS)))
    banded = banded.select("node", (F.col("at") % BANDS).alias("band"), "key")
    shared = banded.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    met = banded.join(shared.filter("low <> high"), "key")
    met = staged(met.select("node", "key", F.array("band").alias("used")), "dup-met")
    nodes = met.select("node").distinct().join(sketches.select("node", "text_key"), "node")
    texts = rows.withColumn("text_key", text_key(F.col("text"))).join(nodes, "text_key")
    once = texts.select("node", "text").dropDuplicates(["node"])
    sets = staged(_sets(once), "dup-sets")
    found = _classes(sketches, sets, met)
    texts_ = _with_class(sketches.select("text_key", "node", "doc_id"), found)
    ids = texts_.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    return texts_.join(ids, "class"), keyed.select("doc_id", "text_key")


def members(documents: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``class_id`` and ``n_texts``, the class's distinct texts, of each row."""
    texts, rows = classes(documents, text)
    n = texts.groupBy("class").agg(F.count("*").alias("n_texts"))
    return rows.join(texts.join(n, "class").select("text_key", "class_id", "n_texts"), "text_key").select(
        "doc_id", "class_id", "n_texts"
    )


def deduplicated(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with one row of each class, that of the smallest doc_id; columns as before."""
    texts, _ = classes(documents, text)
    # The class's smallest doc_id, and of texts that share it the one with the smallest key.
    order = Window.partitionBy("class").orderBy(F.col("doc_id").asc_nulls_last(), "text_key")
    kept = texts.withColumn("at", F.row_number().over(order)).filter("at = 1")
    key = free_name(documents.columns, "text_key")
    same = free_name([*documents.columns, key], "kept_id")
    kept = staged(kept.select(F.col("text_key").alias(key), F.col("doc_id").alias(same)), "dup-kept")
    own = documents.withColumn(key, text_key(F.col(f"`{text}`")))
    on = (F.col("d." + key) == F.col("k." + key)) & F.col("d.doc_id").cast("long").eqNullSafe(
        F.col("k." + same)
    )
    found = own.alias("d").join(kept.alias("k"), on).select("d.*")
    return found.dropDuplicates([key]).select(*(F.col(f"`{c}`") for c in documents.columns))
