"""Byte-level BPE by ranks: encoding in overlapping chunks, decoding by joining bytes.

A text is cut by a pattern into pre-tokens, and each pre-token is merged by ranks on its
own. A long text is cut into overlapping chunks first, which are pre-tokenised in
parallel. A chunk that begins inside a pre-token starts out with wrong boundaries; they
resynchronise at the first boundary that both it and the chunk before it have, behind
which both agree, as the pattern only looks ahead. There the chunks are stitched. Each
stretch between two stitches is then encoded, again in parallel. Chunks whose overlap
holds no common boundary are encoded as one.

A null text is an empty one and has no tokens. Repeated rows are each returned. Short
texts, the great majority, are encoded where they are, without a shuffle.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from eclusa.llm.frames import free_name, map_batches, staged, text_slices

# Characters of a chunk, and those that it shares with the next.
CHUNK = 32_768
OVERLAP = 1_024
# Characters before a chunk's end where a match may still change.
MARGIN = 8
# Bytes of pre-tokens whose ids a task remembers: so many of the last, and as many from before.
REMEMBERED_BYTES = 48 * 1024 * 1024
# Bytes that a remembered pre-token needs beyond its characters and ids.
ENTRY_BYTES = 190
# Bytes of texts that are encoded at once.
SLICE = 1024 * 1024
EMPTY = np.zeros(0, dtype=np.int32)

# First and last code points that the pattern's library takes for letters or
# digits and the tokenizer, whose character tables are older, for neither.
NEWER = (
    "558-558 58b-58c 88f-88f c5c-c5c cdc-cdc 208f-208f 209d-209f a7ce-a7cf a7d2-a7d2 a7d4-a7d4 "
    "a7dd-a7dd a7e2-a7e2 a7f1-a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee "
    "11b0a-11b0a 11db0-11ddb 11de0-11de9 11df1-11df1 1246f-1246f 12475-1247f 12550-12686 "
    "16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 "
    "18e00-19191 191a0-191d2 1b123-1b128 1b168-1b168 1d6a6-1d6a6 1df1f-1df24 1df2b-1df81 "
    "1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 "
    "1e6fe-1e6ff 2b73a-2b73f 2b81e-2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)
_NEWER = re.compile(
    "[" + "".join("-".join(chr(int(c, 16)) for c in r.split("-")) for r in NEWER.split()) + "]"
)
# No UTF-8 sequence of such a code point has a smaller greatest byte.
_LEAST_BYTE = 0xD5
# A character that is neither letter nor digit nor white space to either.
_OTHER = "\ue000"


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file that has a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the neighbours of the lowest rank are joined until none has one.

    Long pre-tokens keep their neighbours in a heap, so that the time stays near their length.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > 64:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    none = len(ranks)
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while pairs:
        low = min(pairs)
        if low == none:
            break
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins here; 0 once it is joined to the left
    before = list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or ranks.get(piece[i : end[middle]]) != rank:
            continue  # one of its parts has been joined meanwhile
        end[i], end[middle] = end[middle], 0
        if end[i] < n:
            before[end[i]] = i
            if (r := ranks.get(piece[i : end[end[i]]])) is not None:
                heapq.heappush(heap, (r, i))
        if (j := before[i]) >= 0 and (r := ranks.get(piece[j : end[i]])) is not None:
            heapq.heappush(heap, (r, j))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class Coder:
    """Encoder and decoder of one task, which remembers what pre-tokens came to."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        # Ids of a pre-token as packed 32-bit numbers.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.room = REMEMBERED_BYTES

    def _piece(self, piece: str) -> bytes:
        ids = self.older.get(piece) or array("i", merge(piece.encode(), self.ranks)).tobytes()
        if len(piece) <= 64:
            self.room -= ENTRY_BYTES + len(piece) + len(ids)
            if self.room < 0:
                self.known, self.older, self.room = {}, self.known, REMEMBERED_BYTES
            self.known[piece] = ids
        return ids

    def pieces(self, text: str) -> list[str]:
        if not _NEWER.search(text):
            return self.pattern.findall(text)
        plain = _NEWER.sub(_OTHER, text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(plain)]

    def encode(self, text: str, old: bool = False) -> bytes:
        """The text's ids, packed. ``old``: it is known to have no newer code points."""
        pieces = self.pattern.findall(text) if old else self.pieces(text)
        get, make = self.known.get, self._piece
        return b"".join([get(p) or make(p) for p in pieces])

    def starts(self, text: str) -> list[int]:
        return [m.start() for m in self.pattern.finditer(_NEWER.sub(_OTHER, text))]


class Decoder:
    """Joins the bytes of ids, for many rows at once."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.size = np.array([len(t) for t in tokens], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)])[:-1].astype(np.int64)
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.joined(ids).tobytes()

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.size[ids]
        ends = np.cumsum(sizes)
        # Place in the token table of each byte: its token's start, plus its place in the token.
        shift = np.repeat(self.start[ids] - (ends - sizes), sizes)
        return self.bytes[shift + np.arange(len(shift))]

    def many(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The bytes of each list of ids; ``ends`` are the lists' bounds, from 0 on."""
        sizes = np.concatenate([[0], np.cumsum(self.size[ids])])
        offsets = pa.py_buffer(sizes[ends].astype(np.int64))
        raw = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, offsets, pa.py_buffer(self.joined(ids))])
        return raw.cast(pa.binary())


def _with_ids(
    df: DataFrame, text: str, name: str, ranks_path: str, pattern: str, decoded: str | None = None
) -> DataFrame:
    """The frame with the ids of its texts in place of the texts.

    With ``decoded`` the same pass decodes the ids to a column of that name.
    """
    at = df.columns.index(text)
    fields = [f for f in df.schema.fields if f.name != text]
    fields.append(StructField(name, ArrayType(IntegerType(), False)))
    if decoded:
        fields.append(StructField(decoded, BinaryType()))
    schema = StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(load_ranks(ranks_path), pattern)
        decoder = Decoder(coder.ranks) if decoded else None
        for rows, data, offsets in text_slices(batches, at, SLICE):
            raw, old = data.tobytes(), not bool((data >= _LEAST_BYTE).any())
            ids = [coder.encode(raw[a:b].decode(), old) for a, b in pairwise(offsets.tolist())]
            ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
            values = np.frombuffer(b"".join(ids), dtype=np.int32)
            columns = [c for i, c in enumerate(rows.columns) if i != at]
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32())))
            if decoder:
                columns.append(decoder.many(values, ends))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(df, run, schema)


def _boundaries(chunks: DataFrame, chunk: int, overlap: int, pattern: str) -> DataFrame:
    """``key``, ``number`` and the boundaries, in the text, that lie in a chunk's overlaps.

    ``head``: those it shares with the chunk before, ``tail``: with the next, if they are safe.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder({}, pattern)
        for rows in batches:
            head, tail = [], []
            for number, piece in zip(rows["number"].to_pylist(), rows["piece"].to_pylist(), strict=True):
                first = number * chunk
                starts = coder.starts(piece)
                head.append([first + s for s in starts if s <= overlap])
                tail.append([first + s for s in starts if chunk <= s <= len(piece) - MARGIN])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [rows["key"], rows["number"], pa.array(head, kind), pa.array(tail, kind)],
                names=["key", "number", "head", "tail"],
            )

    return map_batches(chunks, run, "key long, number int, head array<long>, tail array<long>")


def stitched(chunks: DataFrame, chunk: int, overlap: int, pattern: str) -> DataFrame:
    """``key``, ``stretch`` and ``piece``: texts of ``chunks`` cut at right boundaries.

    ``chunks`` has ``key``, ``number`` and ``piece``. Neighbours are cut at the first boundary
    they share. Behind the first pair without one, the text's remainder is one stretch.
    """
    bounds = _boundaries(chunks, chunk, overlap, pattern)
    own = Window.partitionBy("key").orderBy("number")
    shared = F.array_min(F.array_intersect(F.lag("tail").over(own), F.col("head")))
    cuts = bounds.select("key", "number", F.when(F.col("number") > 0, shared).otherwise(0).alias("cut"))
    lost = F.min(F.when(F.col("cut").isNull(), F.col("number"))).over(Window.partitionBy("key"))
    after = F.lead("cut").over(own)
    cuts = cuts.withColumn("lost", lost).select(
        "key",
        "number",
        # The chunk whose stretch this one's text belongs to.
        F.least("number", F.coalesce(F.col("lost") - 1, "number")).alias("stretch"),
        F.when(F.col("number") < F.coalesce("lost", F.lit(2**31 - 1)), F.col("cut")).alias("cut"),
        F.when(F.col("number") + 1 < F.coalesce("lost", F.lit(2**31 - 1)), after).alias("until"),
    )
    first = F.col("number") * chunk
    begin = F.coalesce("cut", first)
    end = F.when(F.col("until").isNotNull(), F.col("until")).otherwise(
        F.when(F.col("ends"), first + F.char_length("piece")).otherwise(first + chunk)
    )
    part = F.substring("piece", begin - first + 1, F.greatest(end - begin, F.lit(0)))
    parts = chunks.join(cuts, ["key", "number"]).withColumn("part", part)
    joined = F.transform(
        F.array_sort(F.collect_list(F.struct("number", "part"))), lambda x: x["part"]
    )
    return parts.groupBy("key", "stretch").agg(F.array_join(joined, "").alias("piece"))


def encode(
    documents: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """The documents with their ids, ``array<int>``, in place of the texts.

    The new column is called ``ids``, or the next free name.
    """
    kept = [c for c in documents.columns if c != text]
    name = free_name(kept, "ids")
    short, long = _by_length(documents, text, chunk)
    return _with_ids(short, text, name, ranks_path, pattern).unionByName(
        _long_ids(long, text, name, ranks_path, pattern, chunk, overlap)
    )


def round_trip(
    documents: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """What :func:`decode` makes of :func:`encode`'s result, in one pass over the short texts.

    The new columns are called ``ids`` and ``decoded``, or the next free names.
    """
    kept = [c for c in documents.columns if c != text]
    name = free_name(kept, "ids")
    short, long = _by_length(documents, text, chunk)
    both = _with_ids(short, text, name, ranks_path, pattern, free_name([*kept, name], "decoded"))
    return both.unionByName(
        decode(_long_ids(long, text, name, ranks_path, pattern, chunk, overlap), ranks_path, name)
    )


def _by_length(documents: DataFrame, text: str, chunk: int) -> tuple[DataFrame, DataFrame]:
    whole = documents.withColumn(text, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    size = F.char_length(f"`{text}`")
    return whole.filter(size <= chunk), whole.filter(size > chunk)


def _long_ids(
    whole: DataFrame, text: str, name: str, ranks_path: str, pattern: str, chunk: int, overlap: int
) -> DataFrame:
    kept = [c for c in whole.columns if c != text]
    fields = F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row")
    long = whole.select(
        F.monotonically_increasing_id().alias("key"), fields, F.col(f"`{text}`").alias("piece")
    )
    last = F.floor((F.char_length("piece") - 1) / chunk).cast("int")
    numbered = long.select(
        "key", "row", "piece", last.alias("last"), F.explode(F.sequence(F.lit(0), last)).alias("number")
    ).select(
        "key",
        F.when(F.col("number") == 0, F.col("row")).alias("row"),
        "number",
        (F.col("number") == F.col("last")).alias("ends"),
        F.substring("piece", F.col("number") * chunk + 1, F.lit(chunk + overlap)).alias("piece"),
    )
    chunks = staged(numbered, "bpe-chunks")
    stretches = stitched(chunks.drop("row"), chunk, overlap, pattern)
    pieces = _with_ids(stretches, "piece", "ids", ranks_path, pattern)
    ordered = F.array_sort(F.collect_list(F.struct("stretch", "ids")))
    all_ids = F.flatten(F.transform(ordered, lambda x: x["ids"]))
    ids = pieces.groupBy("key").agg(all_ids.alias("ids"))
    rows = chunks.filter("number = 0").select("key", "row").join(ids, "key")
    return rows.select(*(F.col("row").getField(c).alias(c) for c in kept), F.col("ids").alias(name))


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """The frame with a column more, ``decoded`` or the next free name: the ids' bytes, joined."""
    at = encoded.columns.index(ids)
    name = free_name(encoded.columns, "decoded")
    schema = StructType([*encoded.schema.fields, StructField(name, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(load_ranks(ranks_path))
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows = batch.slice(first, 256)
                values = [x.values.to_numpy() if x.is_valid else EMPTY for x in rows.column(at)]
                raw = pa.array([decoder.decode(v) for v in values], pa.binary())
                yield pa.RecordBatch.from_arrays([*rows.columns, raw], names=schema.names)

    return map_batches(encoded, run, schema)
