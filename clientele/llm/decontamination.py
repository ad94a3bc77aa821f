"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive words, at most ``WINDOW`` of them: only the kept positions enter its hash, so a
substituted word at an ignored position leaves the hash as it is. The masks are complete: whatever words of a window
differ, as many as the agreement allows, one mask ignores them all. Every benchmark item gives the seeds of all its positions,
every document those of all its positions; equal hashes are hits. Around each hit the item and the document are
aligned without gaps, and the pair counts if some window of ``WINDOW`` words that holds the seed agrees in at least
``AGREEMENT`` percent of its words. Words of the item beyond either end of the document disagree.

The seeds of the benchmark travel as one table of bounded size; a larger benchmark is taken in blocks of items, each
matched against all documents. Words are compared by 64-bit hashes, A-Z lower-cased.

Defined results: documents and items that are NULL or empty have no words and match nothing. An item shorter than
``WINDOW`` has masks of its own length; one of
fewer than ``MIN_ITEM`` words says too little and is never matched.
Repeated document rows are matched alike; an empty table on either side gives no matches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from clientele.llm.arrow import Words, hash_words, map_batches, mixed, quoted, row_slices

WINDOW, AGREEMENT = 15, 80
MIN_ITEM = 6
BLOCK_CHARACTERS = 8 << 20  # of items in one broadcast table
FILTER_BITS = 20


def masks_of(length: int) -> list[tuple[int, ...]]:
    """Kept positions of the masks for an item of ``length`` words.

    A window is cut into blocks, two more than the words that may differ, and each mask leaves out as many blocks as
    words may differ: these cannot touch all of the blocks but two, so some mask is free of them.
    """
    window = min(length, WINDOW)
    differ = window - -(-AGREEMENT * window // 100)
    blocks = [range(window * k // (differ + 2), window * (k + 1) // (differ + 2)) for k in range(differ + 2)]
    return [tuple(i for block in kept for i in block) for kept in combinations(blocks, 2)]


def seeds(hashes: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Hash of the kept words at every position (over the flat array)."""
    n = len(hashes) - mask[-1]
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, len(mask), dtype=np.uint64)
    for i in mask:
        total = total * np.uint64(0x9DDFEA08EB382D69) + hashes[i : i + n]
    return mixed(total)


@dataclass
class _Table:
    """Sorted seeds of one mask with item and position, and a bit filter in front."""

    mask: tuple[int, ...]
    seeds: np.ndarray
    item: np.ndarray
    position: np.ndarray
    filter: np.ndarray


class Index:
    """All seeds of some items."""

    def __init__(self, texts: list[str | None]) -> None:
        words = hash_words(pa.array(texts, pa.string()))
        bounds = zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True)
        self.items = [words.hashes[a:b] for a, b in bounds]
        found: dict[tuple[int, ...], list[tuple[np.ndarray, int, int]]] = {}
        for i, item in enumerate(self.items):
            if len(item) >= MIN_ITEM:
                for mask in masks_of(len(item)):
                    first = mask[0]  # the words before are not needed: they may lie beyond the document
                    found.setdefault(tuple(m - first for m in mask), []).append((seeds(item[first:], tuple(m - first for m in mask)), i, first))
        self.tables = []
        for mask, parts in found.items():
            all_seeds = np.concatenate([s for s, _, _ in parts])
            item = np.concatenate([np.full(len(s), i) for s, i, _ in parts])
            position = np.concatenate([first + np.arange(len(s)) for s, _, first in parts])
            order = np.argsort(all_seeds, kind="stable")
            bits = np.zeros(1 << FILTER_BITS, dtype=bool)
            bits[(all_seeds >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.tables.append(_Table(mask, all_seeds[order], item[order], position[order], bits))

    def hits(self, words: Words) -> set[tuple[int, int, int]]:
        """(row, item, first word of the aligned item in the flat array) of all hits inside one row."""
        found = set()
        for t in self.tables:
            own = seeds(words.hashes, t.mask)
            at = np.flatnonzero(t.filter[(own >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            first, last = np.searchsorted(t.seeds, own[at], "left"), np.searchsorted(t.seeds, own[at], "right")
            rows = np.searchsorted(words.offsets, at, side="right") - 1
            inside = (last > first) & (at + t.mask[-1] < words.offsets[rows + 1])
            for p, row, a, b in zip(at[inside].tolist(), rows[inside].tolist(), first[inside].tolist(), last[inside].tolist(), strict=True):
                found.update((row, int(t.item[k]), p - int(t.position[k])) for k in range(a, b))
        return found

    def verified(self, words: Words) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, first agreeing word, words of the best window, words that agree over the whole alignment)."""
        for row, i, start in sorted(self.hits(words)):
            item = self.items[i]
            a, b = max(start, int(words.offsets[row])), min(start + len(item), int(words.offsets[row + 1]))
            same = words.hashes[a:b] == item[a - start : b - start]
            width = min(WINDOW, len(item))
            sums = np.r_[0, np.cumsum(same)]
            best = int((sums[width:] - sums[:-width]).max()) if b - a >= width else int(sums[-1])
            if 100 * best >= AGREEMENT * width:
                yield row, i, a + int(same.argmax()) - int(words.offsets[row]), best, int(sums[-1])


def find_overlaps(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", item_column: str = "item_id", text: str = "text"
) -> DataFrame:
    """(id, item id, ``n_agreeing``, ``share``, ``start_word``) of each document and item that overlap."""
    items = benchmark.select(F.col(quoted(item_column)).alias("item"), F.col(quoted(text)).alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_CHARACTERS))
    numbered = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    return reduce(DataFrame.union, [
        _overlaps(docs, [tuple(r) for r in numbered.filter(F.col("block") == k).select("item", "text").collect()],
                  benchmark.schema[item_column], id_column, text)
        for k in range(blocks)
    ])


def _overlaps(docs: DataFrame, items: list[tuple], item_field: StructField, id_column: str, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    own_id = StructField(id_column, docs.schema[id_column].dataType)
    item_id = StructField(item_field.name, item_field.dataType)
    schema = StructType([own_id, item_id]).add("n_agreeing", "long").add("share", "double").add("start_word", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index([t for _, t in shared.value])
        for batch in batches:
            ids, first = batch.column(0), 0
            for part in row_slices(batch.column(1)):
                best: dict[tuple[int, int], tuple[int, int]] = {}
                for row, i, start, _, agreeing in index.verified(hash_words(part)):
                    best[row, i] = max(best.get((row, i), (0, 0)), (agreeing, -start))
                rows = [first + row for row, _ in best]
                first += len(part)
                if best:
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array(rows, pa.int64())), pa.array([shared.value[i][0] for _, i in best], to_arrow_type(item_id.dataType)),
                        pa.array([n for n, _ in best.values()], pa.int64()),
                        pa.array([n / len(index.items[i]) for (_, i), (n, _) in best.items()], pa.float64()),
                        pa.array([-s for _, s in best.values()], pa.int64()),
                    ], names=schema.names)

    return docs.select(F.col(quoted(id_column)).alias("id"), F.col(quoted(text)).alias("text")).mapInArrow(run, schema)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that overlap no item, with their own columns; judged row by row, ids play no part."""
    items = benchmark.select(F.col(quoted(text)).alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_CHARACTERS))
    numbered = items.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks)))
    for k in range(blocks):
        docs = _without(docs, [r["text"] for r in numbered.filter(F.col("block") == k).select("text").collect()], text)
    return docs


def _without(docs: DataFrame, items: list[str | None], text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value)
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            first = 0
            for part in row_slices(batch.column(text)):
                for row, *_ in index.verified(hash_words(part)):
                    keep[first + row] = False
                first += len(part)
            yield batch.filter(pa.array(keep))

    return map_batches(docs, run, docs.schema)
