"""Removal of repeated line runs by a suffix array over line numbers, built by distributed prefix doubling.

The corpus is a sequence of lines (those with a word, each known by a 64-bit hash; documents end it, so no run
crosses them). Doubling up: the rank name of the 2**j lines from a position is the hash of the two names of its
halves; only names that occur again are kept, so what is unique drops out of every later round. Only equality of
ranks matters below, not their order, so no global sort is needed.

Doubling down gives the longest-common-prefix intervals: groups of positions that share their first ``length``
lines and no more. A group starts with length 0; at each level from the largest to 0 its members are told apart by
the name of the next 2**level lines. Members with equal names go on as a longer group, and the earliest of them
also stays behind to stand for them, so that shorter common runs with others are still found. A position that is
not the earliest of its group begins a later copy of ``length`` lines; its longest such run is kept.

Later copies are deleted where the run has at least ``min_words`` words. "Earlier" goes by document id, then text
hash, then line. Lines without a word are never deleted, nor do they break a run. Rows equal in id and text are one
document: they give equal results, and are no copies of each other. Defined results: a NULL text stays NULL with no
lines; a document whose lines with words are all deleted has an empty text; NULL ids come first in the order.
Columns of the input named like a result are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.arrow import map_columns, quoted
from clientele.sources.storage import store

MIN_WORDS = 30
PLACE = ("d", "h", "k")  # document id, text hash, number of the line with a word


def _document(id_column: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(quoted(id_column)).cast("long"), F.lit(-(1 << 63))).alias("d"), F.xxhash64(quoted(text)).alias("h")]


def _lines(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(``d``, ``h``, ``k``, ``name``, ``w``): each line with a word, its hash and its number of words."""
    words = F.transform(
        F.split(F.col(quoted(text)), "\n"),
        lambda line: F.struct(F.xxhash64(line).alias("name"), F.size(F.array_remove(F.split(line, "[\\x20\\x09-\\x0D]+"), "")).alias("w")),
    )
    found = docs.select(*_document(id_column, text), F.filter(words, lambda x: x["w"] > 0).alias("lines"))
    return found.select("d", "h", F.posexplode("lines").alias("k", "line")).select(*PLACE, "line.name", "line.w")


def _repeated(named: DataFrame) -> DataFrame:
    """Rows whose name occurs at another place too."""
    again = named.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name")
    return named.join(again, "name", "left_semi")


def _doubled(named: DataFrame, step: int) -> DataFrame:
    """Names of twice the length; ``reach`` counts the words of the longest run that can still begin here."""
    ahead = Window.partitionBy("d", "h").orderBy("k").rangeBetween(step, step)
    both = named.select(*PLACE, "name", F.max("name").over(ahead).alias("second")).filter("second is not null")
    return both.select(*PLACE, F.xxhash64("name", "second").alias("name"))


def _levels(first: DataFrame) -> list[DataFrame]:
    """Repeated names of 1, 2, 4, ... lines, as long as there are any."""
    levels = [first]
    while True:
        longer = store(_repeated(_doubled(levels[-1], 1 << (len(levels) - 1))), "line_names")
        if longer.isEmpty():
            return levels
        levels.append(longer)


def _promising(lines: DataFrame, levels: list[DataFrame], min_words: int) -> DataFrame:
    """Places where a repeated run may reach ``min_words``: below twice the largest repeated power of two."""
    sizes = reduce(DataFrame.union, [x.select(*PLACE, F.lit(1 << j).alias("size")) for j, x in enumerate(levels)])
    longest = sizes.groupBy(*PLACE).agg(F.max("size").alias("size"))
    order = Window.partitionBy("d", "h").orderBy("k")
    sums = lines.withColumn("until", F.sum("w").over(order))
    ends = Window.partitionBy("d", "h").orderBy("k")
    reach = F.lit(None).cast("long")
    for j in range(len(levels)):
        span = (2 << j) - 2
        reach = F.when(F.col("size") == 1 << j, F.max("until").over(ends.rangeBetween(0, span)) - F.col("until") + F.col("w")).otherwise(reach)
    return sums.join(longest, list(PLACE)).withColumn("reach", reach).filter(F.col("reach") >= min_words).select(*PLACE)


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(``d``, ``h``, ``runs``): per document the longest runs that begin at each line and occurred before."""
    lines = store(_lines(docs, id_column, text), "lines")  # read twice below: texts are split once
    # rows equal in id and text give equal places: they are one document
    again = lines.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name")
    first = store(lines.join(again, "name", "left_semi").groupBy(*PLACE).agg(F.any_value("name").alias("name"), F.any_value("w").alias("w")), "line_names")
    names = store(_repeated(first.select(*PLACE, "name")), "line_names")
    levels = _levels(names)
    place = F.struct(*PLACE)
    members = store(
        _promising(first, levels, min_words).select(*PLACE, F.lit(0).cast("long").alias("g"), F.lit(0).alias("length")), "line_groups"
    )
    runs = []
    for level in range(len(levels) - 1, -1, -1):
        size = 1 << level
        next_names = levels[level].select("d", "h", F.col("k").alias("at"), "name")
        told = store(members.withColumn("at", F.col("k") + F.col("length")).join(next_names, ["d", "h", "at"], "left").drop("at"), "line_told")
        named = told.filter("name is not null")
        groups = named.groupBy("g", "name").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("earliest")).filter("n > 1")
        split = store(
            named.join(groups, ["g", "name"], "left").withColumn("leads", F.coalesce(F.col("earliest") == place, F.lit(False))), "line_split"
        )
        longer = split.filter("n is not null").select(
            *PLACE, F.xxhash64("g", "name", F.lit(level)).alias("g"), (F.col("length") + size).alias("length"), "leads"
        )
        runs.append(longer.filter("not leads").select(*PLACE, "length"))
        stay = split.filter("n is null or leads").select(*PLACE, "g", "length")
        members = told.filter("name is null").select(*PLACE, "g", "length").union(stay).union(longer.drop("leads"))
    longest = reduce(DataFrame.union, runs).groupBy(*PLACE).agg(F.max("length").alias("length"))
    return longest.groupBy("d", "h").agg(F.collect_list(F.struct("k", "length")).alias("runs"))


def deleted_lines(lines: list[str], runs: list[tuple[int, int]], min_words: int) -> tuple[list[int], int]:
    """Numbers (among all lines) of the deleted ones, and how many lines have words."""
    counts = [len(line.encode().split()) for line in lines]
    worded = [i for i, n in enumerate(counts) if n]
    sums = [0]
    for i in worded:
        sums.append(sums[-1] + counts[i])
    gone: list[int] = []
    covered = 0
    for k, length in sorted(runs):
        if k + length > covered and sums[k + length] - sums[k] >= min_words:
            gone += worded[max(k, covered) : k + length]
            covered = k + length
    return gone, len(worded)


def without_repeats(
    docs: DataFrame, min_words: int = MIN_WORDS, keep: list[str] | None = None, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Documents without later copies of line runs; adds ``n_lines`` (with words) and ``deleted`` (line numbers)."""
    copies = later_copies(docs, min_words, id_column, text)
    copies = copies.select(F.col("d").alias("_d"), F.col("h").alias("_h"), F.to_json("runs").alias("_runs"))
    d, h = _document(id_column, text)
    rows = docs.withColumns({"_d": d, "_h": h}).join(copies, ["_d", "_h"], "left")
    kept = [c for c in (docs.columns if keep is None else keep) if c != text]

    def start() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        import json

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            left, sizes, gone = [], [], []
            for t, runs in zip(batch.column(text).to_pylist(), batch.column("_runs").to_pylist(), strict=True):
                lines = (t or "").split("\n")
                found = [(r["k"], r["length"]) for r in json.loads(runs)] if runs else []
                numbers, n = deleted_lines(lines, found, min_words)
                dropped = set(numbers)
                rest = [line for i, line in enumerate(lines) if i not in dropped]
                empty = bool(numbers) and len(numbers) == n
                left.append(t if not numbers else "" if empty else "\n".join(rest))
                sizes.append(n)
                gone.append(numbers)
            return [pa.array(left, pa.string()), pa.array(sizes, pa.int32()), pa.array(gone, pa.list_(pa.int32()))]

        return compute

    return map_columns(rows, kept, f"{quoted(text)} string, n_lines int, deleted array<int>", start, needs=[text, "_runs"])
