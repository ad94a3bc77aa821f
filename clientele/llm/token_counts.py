"""Token counts by a map-side two-tier lookup; no pre-token is ever shuffled.

A piece is what stands between two spaces, with the space before it: its pre-tokens are the same inside a text and
alone, unless a run of white space goes on across that space (such texts are given to the library whole).
Tier one is a compact table of the corpus's frequent pieces and their token counts, broadcast with a fixed number
of entries. Every task summarizes its own rows by a bounded frequency table (lossy counting: when the table
is full, entries at or below the current floor leave), and only those summaries meet. Tier two is each worker's
bounded table of the other pieces it has met, filled by the tokenizer library in batches. Neither table can
change a count, only how often the library is asked.

Texts with characters on which Unicode tables may differ, or with strings of special tokens, are given to the
library whole. Defined results: NULL or empty text: no bytes, no tokens. Repeated rows have equal results; columns
of the input named like a result are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import os
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clientele.llm.arrow import map_columns, quoted, texts
from clientele.llm.bpe import PLAIN, parts_of

FREQUENT = 1 << 14  # entries of the broadcast table
LONGEST_FREQUENT = 64  # characters of an entry: with FREQUENT this bounds the broadcast to a few MB
SUMMARY = 1 << 16  # entries of a task's frequency table
SENT = 1 << 13  # entries a task reports
CACHE = 400_000  # entries of a worker's table
SPLIT_RUN = re.compile(r"\s (?:\s|\Z)")  # a space inside a run of white space, where pieces don't stand alone


def pieces(text: str) -> list[str]:
    """What stands between spaces; every piece but the first belongs to the space before it."""
    return text.split(" ")


def separable(text: str) -> bool:
    return PLAIN.fullmatch(text) is not None and SPLIT_RUN.search(text) is None


class Summary:
    """Frequent strings of a stream in bounded memory."""

    def __init__(self, size: int = SUMMARY) -> None:
        self.counts: Counter[str] = Counter()
        self.size, self.floor = size, 0

    def update(self, items: list[str]) -> None:
        self.counts.update(items)
        while len(self.counts) > self.size:
            self.floor += 1
            self.counts = Counter({k: n for k, n in self.counts.items() if n > self.floor})


def frequent_lengths(docs: DataFrame, tokenizer: str, text: str = "text") -> dict[str, int]:
    """Token count of each of the ``FREQUENT`` most frequent pre-tokens of all documents."""

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Summary()
        for batch in batches:
            for t in texts(batch, text):
                if separable(t):
                    seen.update(pieces(t)[1:])
        top = [(k, n) for k, n in seen.counts.most_common(SENT) if len(k) <= LONGEST_FREQUENT]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"]
        )

    top = (
        docs.select(F.col(quoted(text)).alias(text)).mapInArrow(summarize, "piece string, n long")
        .groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(FREQUENT)
    )
    found = [r.piece for r in top.select("piece").collect()]
    return dict(zip(found, lengths(load(tokenizer), [" " + p for p in found]), strict=True))


def load(tokenizer: str) -> Tokenizer:
    return Tokenizer.from_file(tokenizer)


def lengths(library: Tokenizer, batch: list[str]) -> list[int]:
    return [len(e) for e in library.encode_batch_fast(batch, add_special_tokens=False)] if batch else []


class PieceCounter:
    """A worker's tokenizer with both tiers of known pieces."""

    def __init__(self, tokenizer: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use the cores
        self.library = load(tokenizer)
        specials = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(specials) or r"(?!)")
        self.frequent: dict[str, int] = {}
        self.known: dict[str, int] = {}

    def count(self, batch: list[str]) -> list[int]:
        """Tokens of each text; pieces not known yet are encoded together."""
        split = [pieces(t) if separable(t) and not self.special.search(t) else [t] for t in batch]
        first = lengths(self.library, [p[0] for p in split])
        met = {p for parts in split for p in parts[1:]}
        missing = met.difference(self.known)
        if len(self.known) + len(missing) > CACHE:
            self.known = {p: self.known[p] for p in met.intersection(self.known)}
        self.known.update(self.frequent)
        missing = list(met.difference(self.known))
        self.known.update(zip(missing, lengths(self.library, [" " + p for p in missing]), strict=True))
        known = self.known.__getitem__
        return [n + sum(map(known, parts[1:])) for n, parts in zip(first, split, strict=True)]


@functools.lru_cache(maxsize=2)
def _counter(tokenizer: str) -> PieceCounter:
    """One per worker process, whatever the number of tasks it runs."""
    return PieceCounter(tokenizer)


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int, keep: list[str] | None = None, text: str = "text"
) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) to each document."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, tokenizer, text))

    def start() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        counter = _counter(tokenizer)
        counter.frequent = table.value

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            counts = [n for part in parts_of(texts(batch, text)) for n in counter.count(part)]
            size = pc.fill_null(pc.binary_length(batch.column(text)), 0).cast(pa.int64())
            return [size, pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())]

        return compute

    fields = "n_bytes long, n_tokens long, over_limit boolean"
    return map_columns(docs, docs.columns if keep is None else keep, fields, start, needs=[text])
