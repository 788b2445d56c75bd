"""Whole texts as flat byte arrays: words, lines and shingles of an Arrow batch by numpy, without a loop over words.

A batch is cut into blocks of about `BLOCK_BYTES`; a longer text is a block of its own, so memory follows the longest text.
Words are `[^\\x20\\x09-\\x0D]+`; a null text has none. Hashes are 64-bit: a polynomial over randomised bytes, then mixed.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

BLOCK_BYTES = 1 << 21

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEPS = np.random.default_rng(7).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_shipped: set[str] = set()
_powers: dict[str, np.ndarray] = {}


def prepare(spark: SparkSession) -> None:
    """Sends this package to the workers, once a session; Arrow batches of at most 500 rows or 8 MB, so that a Python worker
    never holds a whole partition."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = Path(__file__).parent.parent
        archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"  # code only; Spark copies it to the executors
        with zipfile.ZipFile(archive, "w") as out:
            for file in package.rglob("*.py"):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8388608")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


@dataclass
class Block:
    """Texts laid end to end: `data[offsets[i]:offsets[i + 1]]` is the UTF-8 of text i; `first` is the batch row of text 0."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def text_starts(self) -> np.ndarray:
        mark = np.zeros(len(self.data) + 1, bool)
        mark[self.offsets] = True
        return mark

    def prefix(self, lower: bool = False) -> np.ndarray:
        """Running polynomial of the bytes; `span_hash` takes the hash of any span from it."""
        up, _ = _power_tables(len(self.data) + 1)
        codes = _CODES[_LOWER[self.data] if lower else self.data]
        out = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(codes * up[: len(codes)], out=out[1:])
        return out

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and ends of the runs of flagged bytes, and where each text's begin in them."""
        fresh = self.text_starts()[1:-1]
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1] | fresh
        end[:-1] &= ~inside[1:] | fresh
        starts = np.flatnonzero(start)
        return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, self.offsets)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and ends of all words, and where each text's words begin in them."""
        return self.spans(~_SPACE[self.data])

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and ends of the \\n-separated lines, and where each text's lines begin in them."""
        newline = np.flatnonzero(self.data == 10)
        holder = np.searchsorted(self.offsets, newline, side="right") - 1
        each = np.arange(self.n)
        owner = np.concatenate([each, holder])
        starts = np.concatenate([self.offsets[:-1], newline + 1])
        ends = np.concatenate([self.offsets[1:], newline])
        first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=self.n))])
        return starts[np.lexsort((starts, owner))], ends[np.lexsort((ends, owner))], first

    def counts(self, flags: np.ndarray) -> np.ndarray:
        """Per text, the number of bytes that are flagged."""
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span, the same wherever the span stands."""
    _, down = _power_tables(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all `width`-word windows of each text, repeats included, and where each text's begin.

    A text with fewer words has its whole sequence as its one shingle; a text without words has none.
    """
    counts = np.diff(first)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], n)
    length = np.repeat(np.minimum(counts, width), n)
    total = length.astype(np.uint64)
    for j in range(width):
        inside = length > j
        total[inside] += words[at[inside] + j] * _STEPS[j]
    return mix(total), begin


def reduce_by_text(function: np.ufunc, values: np.ndarray, first: np.ndarray, empty) -> np.ndarray:
    """`function` over each text's values; `empty` for a text without values."""
    out = np.full(len(first) - 1, empty, values.dtype)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = function.reduceat(values, first[full])
    return out


def distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct values in order, how often each occurs, and where each text's begin."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(values)))
    return values[at], times, np.searchsorted(owner[at], np.arange(len(first)))


def blocks(batch: pa.RecordBatch, column: str = "text") -> Iterator[Block]:
    """The texts of a batch, block by block; null is empty."""
    texts = pc.fill_null(batch.column(column), "").cast(pa.large_string())
    _, bounds, values = texts.buffers()
    offsets = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        last = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, side="right")) - 1
        last = min(len(texts), max(row + 1, last))
        yield Block(data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row], row)
        row = last


def column(values: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, kind)


def word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span, eight at a time, each step mixed before the next: no sequence of bytes is weak."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    length = ends - starts
    out = mix(length.astype(np.uint64) + np.uint64(_BASE))
    left, at = np.flatnonzero(length > 0), 0
    while len(left):
        rest = np.minimum(length[left] - at, 8)
        chunk = eight[starts[left] + at] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * rest.astype(np.uint64)))
        out[left] = mix(out[left] * np.uint64(_BASE) + mix(chunk + _CODES[1]))
        at += 8
        left = left[length[left] > at]
    return out


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] of each range, the same wherever the range stands. Meant for short ranges of mixed values."""
    up, down = _power_tables(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[data]
