"""Benchmark decontamination: words of documents that lie in benchmark passages.

The normalised n-grams of the benchmark are broadcast as a hash set. Every window of
every document is looked up by its hash, and each hit is verified word by word. Hit
spans or whole documents can then be removed.

Executors make the benchmark's windows: pieces of its words with the hash and place of each
window, written once. These come to the driver in slices of a bounded size, measured first,
and a slice is let go before the next one is fetched: one pass over the documents for each,
whose result is written down, so that neither a broadcast nor the driver's memory grows with
the benchmark.

A null or empty text has no words and no hits. Items without words have no windows.
Items with equal ids count as one; a null id counts as the text ``null``. Repeated
document rows are each scanned and returned. An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from eclusa.llm import words as W
from eclusa.llm.frames import discard, free_name, map_batches, map_texts, staged, text_slices

N_WORDS = 10
# Bytes of words, hashes and places in one broadcast: some 20 MB of benchmark text.
SLICE_TEXT = 64 * 1024 * 1024
# Windows of a piece of an item.
PIECE = 4096
# Bits of the address of the first look-up, by which most windows end.
_FILTER_BITS = 22
# Windows whose items a task remembers.
_REMEMBERED = 1 << 16

# Of each piece: its item, the number of words in a window, its words with one space between,
# and the hash (8 bytes) and first byte (4 bytes) of each window.
PIECES = StructType(
    [
        StructField("item", StringType()),
        StructField("size", IntegerType()),
        StructField("words", BinaryType()),
        StructField("hashes", BinaryType()),
        StructField("places", BinaryType()),
    ]
)


def pieces(benchmark: DataFrame, n: int) -> DataFrame:
    """The windows of the benchmark's items, in pieces as in PIECES."""
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("null"))
    items = benchmark.select(item.alias("item"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_slices(batches, 1):
            found = W.scan(data, offsets)
            n_words = np.diff(found.first)
            for size in np.unique(np.minimum(n_words[n_words > 0], n)).tolist():
                hashes, at = W.windows(found, size)
                text = found.text[at]
                fits = np.minimum(n_words[text], n) == size
                hashes, at, text = hashes[fits], at[fits], text[fits]
                edges = np.flatnonzero(np.diff(text, prepend=-1, append=-1))
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    name = rows.column(0)[int(text[a])].as_py()
                    for c in range(a, b, PIECE):
                        d = min(c + PIECE, b)
                        yield _piece(found, name, size, hashes[c:d], int(at[c]))

    return map_batches(items.filter(F.col("text").isNotNull()), run, PIECES)


def _piece(found: W.Words, item: str, size: int, hashes: np.ndarray, first: int) -> pa.RecordBatch:
    last = first + len(hashes) + size - 1
    length = found.end[first:last] - found.start[first:last]
    places = (np.cumsum(length + 1) - length - 1)[: len(hashes)].astype("<i4")
    values = (item, size, found.joined(first, last), hashes.astype("<u8").tobytes(), places.tobytes())
    kinds = (pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    columns = [pa.array([v], k) for v, k in zip(values, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=PIECES.names)


@dataclass
class Grams:
    """Hash set of benchmark windows by their number of words, and where each one stands."""

    item: list[str] = field(default_factory=list)
    words: list[bytes] = field(default_factory=list)
    # Sorted hashes, and the piece and place of the window of each.
    by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)

    @staticmethod
    def of(table: pa.Table) -> Grams:
        grams = Grams(table["item"].to_pylist(), table["words"].to_pylist())
        sizes = np.array(table["size"].to_pylist(), dtype=np.int64)
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            hashes, places = (
                [np.frombuffer(table[name][int(r)].as_py(), dtype=kind) for r in rows]
                for name, kind in (("hashes", "<u8"), ("places", "<i4"))
            )
            piece = np.repeat(rows.astype(np.int32), [len(h) for h in hashes])
            hashes = np.concatenate(hashes)
            order = np.argsort(hashes, kind="stable")
            grams.by_size[size] = hashes[order], piece[order], np.concatenate(places)[order]
        return grams

    def having(self, size: int, hash_: np.uint64, window: bytes) -> frozenset[str]:
        """The items that have the window, compared word by word."""
        hashes, piece, place = self.by_size[size]
        found = set()
        for k in range(*(int(np.searchsorted(hashes, hash_, side=s)) for s in ("left", "right"))):
            words, a = self.words[piece[k]], int(place[k])
            b = a + len(window)
            if words[a:b] == window and words[b : b + 1] in (b"", b" "):
                found.add(self.item[piece[k]])
        return frozenset(found)


def _slices(found: DataFrame, limit: int) -> Iterator[Grams]:
    """The written pieces, about ``limit`` bytes at a time; at least one slice."""
    size = sum((F.octet_length(c) for c in ("item", "words", "hashes", "places")), F.lit(0))
    rows, total = found.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    n = max(1, min(rows, -(-total // limit)))
    turn = F.pmod(F.xxhash64("item", "words"), F.lit(n))
    for k in range(n):
        grams = Grams.of(found.filter(turn == k).toArrow())
        # Slices that got no piece cost no pass.
        if grams.by_size or n == 1:
            yield grams


def _scanner(grams: Grams):
    """Function of a slice: words of each text, first and last words of hits, items."""
    bits = np.uint64(64 - _FILTER_BITS)
    filters = {}
    for size, (hashes, _, _) in grams.by_size.items():
        filters[size] = np.zeros(1 << _FILTER_BITS, dtype=bool)
        filters[size][hashes >> bits] = True
    having = lru_cache(_REMEMBERED)(grams.having)

    def scan(data: np.ndarray, offsets: np.ndarray):
        found = W.scan(data, offsets)
        hits: list[list[int]] = [[] for _ in offsets[1:]]
        items: list[set[str]] = [set() for _ in offsets[1:]]
        for size, (hashes, _, _) in grams.by_size.items():
            window, at = W.windows(found, size)
            maybe = np.flatnonzero(filters[size][window >> bits])
            place = np.minimum(np.searchsorted(hashes, window[maybe]), len(hashes) - 1)
            maybe = maybe[hashes[place] == window[maybe]]
            for first, hash_ in zip(at[maybe].tolist(), window[maybe], strict=True):
                if own := having(size, hash_, found.joined(first, first + size)):
                    text = int(found.text[first])
                    hits[text] += (first, first + size)
                    items[text] |= own
        return found, hits, items

    return scan


def _runs(pairs: list[int]) -> list[tuple[int, int]]:
    """Union of [first, last) ranges as disjoint ranges in order."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(zip(pairs[::2], pairs[1::2], strict=True)):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


FIELDS = (
    ("n_words", LongType()),
    # Word numbers: first, one past the last, first, ...; byte ranges in the same way.
    ("hit_words", ArrayType(IntegerType())),
    ("hit_bytes", ArrayType(IntegerType())),
    ("items", ArrayType(StringType())),
)


def _one_pass(documents: DataFrame, text: str, names: list[str], shared) -> DataFrame:
    """The documents with what the broadcast windows hit."""

    def make():
        scan = _scanner(shared.value)

        def columns(data: np.ndarray, offsets: np.ndarray):
            found, hits, items = scan(data, offsets)
            words, spans = [], []
            for k, pairs in enumerate(hits):
                runs = _runs(pairs)
                words.append([int(x - found.first[k]) for run in runs for x in run])
                spans.append(
                    [
                        int(x - offsets[k])
                        for a, b in runs
                        for x in (found.start[a], found.end[b - 1])
                    ]
                )
            return np.diff(found.first), words, spans, [sorted(x) for x in items]

        return columns

    fields = [StructField(name, kind) for name, (_, kind) in zip(names, FIELDS, strict=True)]
    return map_texts(documents, text, make, fields)


def scan(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    n: int = N_WORDS,
    slice_text: int = SLICE_TEXT,
) -> tuple[DataFrame, list[str]]:
    """The documents with the columns of FIELDS, under free names, which come second.

    Each of several slices of the benchmark adds its own hits to those found before, which
    wait in the shared folder.
    """
    names: list[str] = []
    for name, _ in FIELDS:
        names.append(free_name([*documents.columns, *names], name))
    spark = documents.sparkSession
    windows = staged(pieces(benchmark, n), "benchmark-windows")
    out = shared = None
    for grams in _slices(windows, slice_text):
        if out is None:
            shared = spark.sparkContext.broadcast(grams)
            out = _one_pass(documents, text, names, shared)
            continue
        before = staged(out, "decontaminate")
        shared.destroy()
        shared = spark.sparkContext.broadcast(grams)
        out = _further(before, text, names, shared)
    discard(windows)
    return out, names


def _further(before: DataFrame, text: str, names: list[str], shared) -> DataFrame:
    """One pass more, its hits united with those of the passes before."""
    fresh: list[str] = []
    for name in names:
        fresh.append(free_name([*before.columns, *fresh], name))
    out = _one_pass(before, text, fresh, shared)
    for old, new in zip(names[1:3], fresh[1:3], strict=True):
        out = out.withColumn(old, _union(F.col(f"`{old}`"), F.col(f"`{new}`")))
    items = F.array_sort(F.array_union(f"`{names[3]}`", f"`{fresh[3]}`"))
    return out.withColumn(names[3], items).drop(*fresh)


def _union(one, other):
    """Ranges as flat arrays, united; ranges that touch or overlap become one."""
    pairs = lambda x: F.transform(
        F.filter(F.sequence(F.lit(0), F.size(x)), lambda i: (i % 2 == 0) & (i < F.size(x))),
        lambda i: F.struct(F.get(x, i).alias("a"), F.get(x, i + 1).alias("b")),
    )
    both = F.array_sort(F.concat(pairs(one), pairs(other)))
    kind = "array<struct<a:int,b:int>>"

    def add(runs, r):
        last = F.element_at(runs, -1)
        longer = F.struct(last.a.alias("a"), F.greatest(last.b, r.b).alias("b"))
        return F.when(
            (F.size(runs) > 0) & (F.try_element_at(runs, F.lit(-1)).b >= r.a),
            F.concat(F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0))), F.array(longer)),
        ).otherwise(F.concat(runs, F.array(r)))

    runs = F.aggregate(both, F.array().cast(kind), add)
    return F.flatten(F.transform(runs, lambda r: F.array(r.a, r.b)))


def n_hit(hit_words):
    """Number of words in the ranges."""
    signs = F.transform(hit_words, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(signs, F.lit(0).cast("long"), lambda acc, x: acc + x)


def report(documents: DataFrame, benchmark: DataFrame, n: int = N_WORDS) -> DataFrame:
    """One row for each document row: doc_id, n_words, n_hit, items, contaminated."""
    found, (words, hits, _, items) = scan(documents.select("doc_id", "text"), benchmark, n=n)
    return found.select(
        "doc_id",
        F.col(words).alias("n_words"),
        n_hit(F.col(hits)).alias("n_hit"),
        F.col(items).alias("items"),
        (F.size(hits) > 0).alias("contaminated"),
    )


def cleaned(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    n: int = N_WORDS,
    most: float = 0.5,
) -> DataFrame:
    """The documents without benchmark passages, columns as before.

    Spans of hit words are cut out of the texts; a document of which more than the
    share ``most`` of words is hit goes as a whole.
    """
    found, (total, hits, spans, _) = scan(documents, benchmark, text, n)
    raw, at = F.col(f"`{text}`").cast("binary"), F.col(f"`{spans}`")
    size = F.octet_length(raw)
    # What lies before the first span, between spans and after the last.
    edges = F.concat(F.array(F.lit(0)), at, F.array(size))
    pieces = F.transform(
        F.sequence(F.lit(0), (F.size(at) / 2).cast("int")),
        lambda i: F.substring(raw, F.get(edges, 2 * i) + 1, F.get(edges, 2 * i + 1) - F.get(edges, 2 * i)).cast(
            "string"
        ),
    )
    kept = found.filter(n_hit(F.col(f"`{hits}`")) <= F.col(f"`{total}`") * most)
    fresh = F.when(F.size(at) > 0, F.array_join(pieces, "")).otherwise(F.col(f"`{text}`"))
    return kept.select(
        *(fresh.alias(c) if c == text else F.col(f"`{c}`") for c in documents.columns)
    )
