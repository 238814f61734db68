"""Token counts without token ids.

The pre-tokens of a piece model are cut at spaces and line ends, which no piece crosses;
so a text's count is the sum of its pre-tokens' counts. Each distinct pre-token is
counted once where its occurrences meet, and the counts are joined to the documents'
pre-token frequencies.

Frequencies travel in blocks: a task turns a slice of documents into, for each bucket of
pre-tokens, the bucket's distinct pre-tokens and how often which document of the slice
has them. A pre-token that all documents share is so one entry in each slice, however
many rows have it. Buckets return one partial sum for each document of a slice, and the
slices add them up. Memory is bounded by one slice's share of a bucket, plus a cache of
counts of a fixed size; a pre-token that has been dropped from it is counted again.

A null text is an empty one and has no tokens. Repeated rows are each returned. Blocks are
named by the task and its place in it, so the input must be read the same way each time,
as a table is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eclusa.llm.frames import on_workers, text_slices
from eclusa.llm.words import hash_ranges

# Bytes of text in a block.
BLOCK_BYTES = 8 * 1024 * 1024
# Distinct pre-tokens whose counts a task remembers.
REMEMBERED = 400_000
_SPACE, _NEWLINE = 0x20, 0x0A


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each pre-token of the texts.

    A pre-token is a line end, or a run of spaces with what follows up to the next space
    or line end. The sign that the model has for a space counts as one.
    """
    space = data == _SPACE
    sign = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81))
    for j in range(3):
        space[sign + j] = True
    line = data == _NEWLINE
    begin = np.zeros(len(data) + 1, dtype=bool)
    # A space after anything else, a line end, and what follows a line end.
    begin[1:-1] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
    begin[offsets] = True
    start = np.flatnonzero(begin[:-1])
    ends = np.append(start[1:], len(data))
    return start, ends


class Counter:
    """Numbers of pieces of pre-tokens, each counted once while it is remembered."""

    def __init__(self, model: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.known: dict[tuple[bytes, bool], int] = {}

    def counts(self, tokens: list[bytes], first: np.ndarray) -> np.ndarray:
        """``first``: which of the pre-tokens begin their text."""
        keys = list(zip(tokens, first.tolist(), strict=True))
        fresh = [k for k in keys if k not in self.known]
        if fresh:
            if len(self.known) + len(fresh) > REMEMBERED:
                self.known.clear()
                fresh = keys
            self.known.update(zip(fresh, self._count(fresh), strict=True))
        return np.array([self.known[k] for k in keys], dtype=np.int64)

    def _count(self, keys: list[tuple[bytes, bool]]) -> list[int]:
        # The model puts a space sign before every text. Before a pre-token that begins with
        # a space it is that space, so the space goes; before another one inside of a text,
        # a line end in front parts it off, and both are taken off the count.
        texts, less = [], []
        for token, first in keys:
            text = token.decode()
            if first:
                texts.append(text)
                less.append(0)
            elif text[0] in " \u2581":
                texts.append(text[1:])
                less.append(0 if len(text) > 1 else -1)
            else:
                texts.append("\n" + text)
                less.append(2)
        ids = self.model.encode(texts, num_threads=1)
        return [len(i) - n for i, n in zip(ids, less, strict=True)]


def _pack(values: np.ndarray, kind: type) -> bytes:
    return pa.compress(values.astype(kind).tobytes(), codec="zstd", asbytes=True)


def _unpack(raw: bytes, size: int, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw, size * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


# A block's rows: one head with its documents, and one for each bucket it has pre-tokens of.
PACKED = (
    "bucket int, block string, docs int, ids array<long>, bytes array<long>, tokens array<binary>, "
    "first binary, entries int, token_at binary, doc_at binary, times binary"
)
SUMS = "block string, docs int, ids array<long>, bytes array<long>, sums binary"
COUNTS = "doc_id long, n_bytes long, n_tokens long"


_TYPES = {
    "int": pa.int32(),
    "long": pa.int64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<binary>": pa.list_(pa.binary()),
}


def _arrow(fields: str) -> pa.Schema:
    pairs = (field.split() for field in fields.split(", "))
    return pa.schema([(name, _TYPES[kind]) for name, kind in pairs])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _frequencies(buckets: int):
    """Blocks of per-document pre-token frequencies, by bucket of pre-tokens."""
    schema = _arrow(PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for rows, data, offsets in text_slices(batches, 1, BLOCK_BYTES):
            block, docs = f"{task}:{number}", len(offsets) - 1
            number += 1
            home = zlib.crc32(block.encode()) % buckets
            ids = rows.column(0).to_pylist()
            head = (home, block, docs, ids, np.diff(offsets).tolist(), *[None] * 6)
            yield _batch([head], schema)
            for row in _by_bucket(data, offsets, block, buckets):
                yield _batch([row], schema)

    return run


def _by_bucket(data: np.ndarray, offsets: np.ndarray, block: str, buckets: int) -> Iterator[tuple]:
    start, end = cut(data, offsets)
    first = np.isin(start, offsets)
    doc = np.searchsorted(offsets, start, side="right") - 1
    # Equal pre-tokens have equal hashes; those that begin a text are counted apart.
    key = hash_ranges(data, start, end) ^ (first.astype(np.uint64) * np.uint64(0xA5A5A5A5A5A5A5A5))
    bucket = (key >> np.uint64(32)) % np.uint64(buckets)
    order = np.lexsort((doc, key, bucket))
    key, doc, bucket = key[order], doc[order], bucket[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(key)))
    key, doc, bucket, place = key[at], doc[at], bucket[at], order[at]
    token = np.ones(len(key), dtype=bool)
    token[1:] = key[1:] != key[:-1]
    raw, docs = data.tobytes(), len(offsets) - 1
    edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    for b, (low, high) in enumerate(pairwise(edges.tolist())):
        if low == high:
            continue
        which = place[low:high][token[low:high]]
        tokens = [raw[s:e] for s, e in zip(start[which].tolist(), end[which].tolist(), strict=True)]
        yield (
            b,
            block,
            docs,
            None,
            None,
            tokens,
            np.packbits(first[which]).tobytes(),
            high - low,
            _pack(np.cumsum(token[low:high]) - 1, np.uint32),
            _pack(doc[low:high], np.uint32),
            _pack(times[low:high], np.uint32),
        )


def _joined(model: str):
    """Partial sums of a block's documents over a bucket's pre-tokens."""
    schema = _arrow(SUMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(model)
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k] for name in batch.schema.names}
                docs, n = row["docs"].as_py(), row["entries"].as_py()
                kept = (row["block"].as_py(), docs, row["ids"].as_py(), row["bytes"].as_py())
                sums = None
                if n is not None:
                    tokens = row["tokens"].as_py()
                    bits = np.frombuffer(row["first"].as_py(), dtype=np.uint8)
                    first = np.unpackbits(bits, count=len(tokens)).astype(bool)
                    pieces = counter.counts(tokens, first)
                    token_at, doc_at, times = (
                        _unpack(row[c].as_py(), n, np.uint32) for c in ("token_at", "doc_at", "times")
                    )
                    # Sums of whole numbers under 2**53 are exact in doubles.
                    weights = pieces[token_at] * times.astype(np.int64)
                    sums = _pack(np.bincount(doc_at, weights, docs), np.int64)
                yield _batch([(*kept, sums)], schema)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document of the blocks, whose rows follow each other."""
    schema = _arrow(COUNTS)

    def closed(head, sums) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in (*head, sums)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    block, head, sums = None, None, None
    for batch in batches:
        for row in batch.to_pylist():
            if row["block"] != block:
                if head:
                    yield closed(head, sums)
                block, head, sums = row["block"], None, np.zeros(row["docs"], dtype=np.int64)
            if row["sums"] is None:
                head = (row["ids"], row["bytes"])
            else:
                sums = sums + _unpack(row["sums"], row["docs"], np.int64)
    if head:
        yield closed(head, sums)


def count(documents: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of each document row."""
    rows = on_workers(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
        )
    )
    buckets = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frequencies = rows.mapInArrow(_frequencies(buckets), PACKED).repartition("bucket")
    partial = frequencies.mapInArrow(_joined(model), SUMS).repartition("block")
    return partial.sortWithinPartitions("block").mapInArrow(_summed, COUNTS)
