"""Arrow-batched row functions and the word kernel shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

SLICE_BYTES = 1 << 20  # text handled at once by the word kernel; its working memory is about 40 times as much

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACES = b" \t\n\x0b\x0c\r"
_IS_SPACE = np.isin(np.arange(256), list(_SPACES))
_CODE = np.array([c + 33 if 65 <= c <= 90 else c + 1 for c in range(256)], dtype=np.uint64)  # A-Z as a-z, never 0


def map_columns(
    df: DataFrame,
    keep: Sequence[str],
    fields: str,
    start: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
    needs: Sequence[str] = ("text",),
) -> DataFrame:
    """Rows of ``df`` with the columns ``keep`` and the new ``fields``; one output row per input row.

    ``start`` runs once per task and returns the function from a batch to the new columns. A kept column that
    has the name of a new one is replaced by it.
    """
    added = StructType.fromDDL(fields)
    kept = [c for c in keep if c not in added.names]
    schema = StructType([df.schema[c] for c in kept] + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            if batch.num_rows:
                columns = [batch.column(c) for c in kept] + compute(batch)
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(df.select(*[quoted(c) for c in dict.fromkeys([*kept, *needs])]), run, schema)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType) -> DataFrame:
    """``mapInArrow`` for columns of any name (its own lookup of columns takes dots and backticks as syntax)."""
    names = df.columns

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(pa.RecordBatch.from_arrays(b.columns, names=names) for b in batches)

    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(named, schema)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch as Python strings; NULL as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def row_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of at most ``limit`` bytes of text, or one row."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield column.slice(start, stop - start)
        start = stop


class Words(NamedTuple):
    """Words of some rows: one 64-bit hash each; row i has the words ``offsets[i]:offsets[i + 1]``."""

    hashes: np.ndarray
    offsets: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def rows(self) -> np.ndarray:
        """Row number of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))

    def strings(self, which: np.ndarray) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.starts[which].tolist(), self.ends[which].tolist(), strict=True)]


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """Powers of the hash base and of its inverse, grown to the longest slice seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            factors = np.full(n, _BASE, dtype=np.uint64)
            factors[0] = 1
            self.up = np.multiply.accumulate(factors)
            factors[1:] = _INVERSE
            self.down = np.multiply.accumulate(factors)
        return self.up, self.down


_powers = _Powers()


def hash_words(column: pa.Array) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text with A-Z lower-cased, hashed without a Python loop.

    The hash of a word is a polynomial in its bytes, taken as a difference of prefix sums (mod 2**64) and
    finalized. NULL texts have no words.
    """
    if column.null_count:
        column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    size = int(bounds[-1] - bounds[0])
    if not size:
        none = np.zeros(0, dtype=np.int64)
        return Words(none.astype(np.uint64), np.zeros(len(column) + 1, dtype=np.int64), none.astype(np.uint8), none, none)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]]
    edges = bounds - bounds[0]
    space = _IS_SPACE[data]
    before = np.empty(size + 1, dtype=bool)  # before[i]: position i follows a space or starts a text
    before[1:] = space
    before[edges] = True
    after = np.empty(size + 1, dtype=bool)  # after[i + 1]: what comes after position i is a space or another text
    after[1:-1] = space[1:]
    after[edges] = True
    after[-1] = True
    word = ~space
    starts = np.flatnonzero(word & before[:-1])
    ends = np.flatnonzero(word & after[1:]) + 1
    up, down = _powers.get(size)
    sums = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum(_CODE[data] * up[:size], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    return Words(hashes, np.searchsorted(starts, edges), data, starts, ends)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words (over the flat array, across rows too)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = hashes[:n].copy()
    for i in range(1, width):
        total = total * np.uint64(_BASE) + hashes[i : i + n]
    return mixed(total)
