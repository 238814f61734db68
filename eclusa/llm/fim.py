r"""Fill-in-the-middle by a wavelet matrix over character classes.

The characters of a slice of texts are put into eight classes, whose three bits are the planes
of a wavelet matrix, one matrix for all texts of the slice. A rank query counts a class before a
place, in constant time; the ranks of the classes that end a unit, a line or a sentence, add up
to the boundaries before a place, and the difference of two places to those of a text. The
boundary with a given number is found by bisection on these ranks, for all texts at once. So a
text of n units is cut behind two of them without being split into units.

Cuts and form come from a digest of the row's id, so that they are the same on every run. A text
that contains a marker, or is empty, stays plain; so does a null text, as an empty one. A null id
counts as an empty one. Repeated rows come out alike. A text longer than a slice is a slice of
its own, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from eclusa.llm.frames import free_name, map_batches, text_slices

# Markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

# Classes of characters.
OTHER, NEWLINE, BLANK, SMALL, CAPITAL, DIGIT, END, MARK = range(8)
PLANES = 3
# Classes that end a unit.
UNITS = {"line": (NEWLINE,), "sentence": (NEWLINE, END)}


def _class_table() -> np.ndarray:
    """Class of a character by its first byte."""
    table = np.full(256, OTHER, dtype=np.uint8)
    table[33:127] = MARK
    table[[9, 11, 12, 13, 32]] = BLANK
    table[10] = NEWLINE
    table[48:58], table[65:91], table[97:123] = DIGIT, CAPITAL, SMALL
    table[[33, 46, 63]] = END
    return table


_CLASSES = _class_table()


class Bits:
    """A plane of bits with counts: ``rank(i)`` ones lie before place ``i``."""

    def __init__(self, bits: np.ndarray):
        words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def rank(self, i: np.ndarray) -> np.ndarray:
        at, bit = i >> 6, (i & 63).astype(np.uint64)
        low = self.words[at] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[at] + np.bitwise_count(low)


class WaveletMatrix:
    """Ranks of the classes of a sequence, from one plane of bits for each bit of a class."""

    def __init__(self, classes: np.ndarray):
        self.size = len(classes)
        self.planes: list[tuple[Bits, int]] = []
        for bit in reversed(range(PLANES)):
            ones = (classes >> bit) & 1
            # Those with a zero bit come first on the next plane, each half in its order.
            zeros = classes[ones == 0]
            self.planes.append((Bits(ones), len(zeros)))
            classes = np.concatenate([zeros, classes[ones == 1]])

    def rank(self, cls: int, i: np.ndarray) -> np.ndarray:
        """How many of a class lie before each place."""
        first = np.zeros_like(i)
        for bit, (plane, zeros) in zip(reversed(range(PLANES)), self.planes, strict=True):
            if cls >> bit & 1:
                first, i = zeros + plane.rank(first), zeros + plane.rank(i)
            else:
                first, i = first - plane.rank(first), i - plane.rank(i)
        return i - first

    def boundaries(self, classes: tuple[int, ...], i: np.ndarray) -> np.ndarray:
        """How many of the classes, together, lie before each place."""
        return sum(self.rank(c, i) for c in classes)

    def select(self, classes: tuple[int, ...], k: np.ndarray) -> np.ndarray:
        """The first place with ``k`` of the classes before it, by bisection on the ranks.

        There must be that many.
        """
        low, high = np.zeros_like(k), np.full_like(k, self.size)
        for _ in range(int(self.size).bit_length()):
            middle = (low + high) >> 1
            enough = self.boundaries(classes, middle) >= k
            low, high = np.where(enough, low, np.minimum(middle + 1, high)), np.where(enough, middle, high)
        return high


@dataclass
class Cuts:
    """Units of each text, and the places of both cuts, in characters and in bytes of the text."""

    n: np.ndarray
    chars: np.ndarray
    bytes: np.ndarray
    length: np.ndarray


def cuts(data: np.ndarray, offsets: np.ndarray, h1: np.ndarray, h2: np.ndarray, unit: str = "line") -> Cuts:
    """Where texts are cut: behind ``h1 % (n + 1)`` and ``h2 % (n + 1)`` of their n units."""
    ends = UNITS[unit]
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    classes = _CLASSES[data[starts]]
    matrix = WaveletMatrix(classes)
    first = np.searchsorted(starts, offsets)
    low, high = first[:-1], first[1:]
    before = matrix.boundaries(ends, low)
    whole = matrix.boundaries(ends, high) - before
    # What lies behind the last boundary is a unit, too.
    has_end = np.zeros(len(low), dtype=bool)
    full = high > low
    has_end[full] = np.isin(classes[high[full] - 1], ends)
    n = whole + (full & ~has_end)
    k = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)]), axis=0)
    # Of the last unit the end is that of the text; of the others, that of their boundary.
    known = np.minimum(k, whole)
    places = matrix.select(ends, (before + known).ravel()).reshape(2, -1)
    places = np.where(k == 0, low, np.where(k == n, high, places))
    # A place past the last character is the end of the bytes.
    in_bytes = np.append(starts, len(data))[places]
    return Cuts(n, places - low, in_bytes - offsets[:-1], high - low)


def _number(hexes: Column, group: int) -> Column:
    return F.conv(F.substring(hexes, 8 * group + 1, 8), 16, 10).cast("long")


def _has_marker(text: Column) -> Column:
    return F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))


def transformed(
    documents: DataFrame,
    text: str = "text",
    seed: int = 7,
    rate: int = 100,
    spm_rate: int = 50,
    unit: str = "line",
) -> DataFrame:
    """The documents with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    So many in a hundred texts are transformed, and of them so many in a hundred with the suffix
    first. New columns whose names are taken get the next free ones; the text stays. ``n`` are
    the text's units; the counts of characters are null for a plain text.
    """
    names, taken = [], list(documents.columns)
    for name in ("n", "form", "prefix_chars", "middle_chars", "output", "h1", "h2"):
        names.append(free_name(taken, name))
        taken.append(names[-1])
    *made, h1, h2 = names
    own = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    hexes = F.sha2(F.concat(F.lit(f"{seed}:"), own).cast("binary"), 256)
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    plain = (whole == "") | _has_marker(whole) | (_number(hexes, 2) % 100 >= rate)
    form = F.when(plain, PLAIN).when(_number(hexes, 3) % 100 < spm_rate, SPM).otherwise(PSM)
    rows = documents.select(
        *(F.col(f"`{c}`") for c in documents.columns),
        form.alias(made[1]),
        _number(hexes, 0).alias(h1),
        _number(hexes, 1).alias(h2),
    )
    n_own = len(documents.columns)
    at = documents.columns.index(text)
    fields = [StructField(name, LongType()) for name in made]
    fields[1] = StructField(made[1], StringType())
    fields[4] = StructField(made[4], StringType())
    schema = StructType([*documents.schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, data, offsets in text_slices(batches, at):
            forms = found.column(n_own)
            found_cuts = cuts(
                data, offsets, found.column(n_own + 1).to_numpy(), found.column(n_own + 2).to_numpy(), unit
            )
            one, two = found_cuts.bytes
            output = []
            raw = data.tobytes()
            for i, form in enumerate(forms.to_pylist()):
                low, high = int(offsets[i]), int(offsets[i + 1])
                a, b = low + int(one[i]), low + int(two[i])
                prefix, middle, suffix = raw[low:a], raw[a:b], raw[b:high]
                if form == PSM:
                    parts = (b"<P>", prefix, b"<S>", suffix, b"<M>", middle)
                elif form == SPM:
                    parts = (b"<S>", suffix, b"<P>", prefix, b"<M>", middle)
                else:
                    parts = (raw[low:high],)
                output.append(b"".join(parts))
            is_plain = np.array([f == PLAIN for f in forms.to_pylist()], dtype=bool)
            prefix, end = found_cuts.chars
            yield pa.RecordBatch.from_arrays(
                [
                    *found.columns[:n_own],
                    pa.array(found_cuts.n, pa.int64()),
                    forms,
                    pa.array(prefix, pa.int64(), mask=is_plain),
                    pa.array(end - prefix, pa.int64(), mask=is_plain),
                    pa.array(output, pa.binary()).cast(pa.string()),
                ],
                names=schema.names,
            )

    return map_batches(rows, run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed. No part of it has a marker, so the first of each is ours."""

    def parts(second: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, F.lit(4), F.char_length(output))
        one = F.substring_index(body, second, 1)
        rest = F.substring(body, F.char_length(one) + 4, F.char_length(body))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substring(rest, F.char_length(two) + 4, F.char_length(rest))

    prefix, suffix, middle = parts(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(PREFIX)
    return F.when(form == PSM, psm).when(form == SPM, F.concat(prefix, middle, suffix)).otherwise(output)
