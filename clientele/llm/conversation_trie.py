"""Prefix trie of conversations from sorted rows, longest common prefixes and range minima.

A turn is known by 128 bits of hashes of role and text. Conversations are sequences of turns, cut into segments of
``SEGMENT`` turns; a segment knows the turns before it by a chain hash, so a conversation of any length is spread over
rows of bounded size. The rows are sorted by (chain, turns, conversation): whatever shares a prefix is now adjacent,
and the longest common prefix (LCP) of neighbours tells where prefixes begin. A row's prefixes that its predecessor
does not have are nodes of the trie. The extent of each, and of the prefix that it hangs on, is found on its own:
binary searches to the left and to the right on sparse tables of LCP minima, no stack, no order among them. Members,
their smallest id (a range minimum as well) and parents follow from the extents. The sorted rows lie in parts of
bounded size; of each part only its first and last row, its minima, and the steps of its running minima from either
end are known to all tasks, which is enough to continue a search beyond the part.

A subtree is a range of nodes ordered by (first row, depth), so sums over subtrees are differences of running totals.
What lies below the last turn of a segment is added up by pointer doubling over chains; rounds are logarithmic in the
number of segments.

Defined results: rows with a NULL conversation id belong to no conversation and are left out. A NULL turn comes
before the others, turns of equal number follow by their hashes, NULL roles and texts are empty. Repeated rows are
turns of their own. An empty table has no nodes, not even a root. Other columns of the input play no part. The digest of a node's
ending conversations is sequential by nature: their ids are joined in pieces where they lie, and one task digests a
node's pieces one after the other, without holding them.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.arrow import quoted
from clientele.sources.storage import store

SEGMENT = 64  # turns of a sorted row, by default
PART_ROWS = 1 << 18  # sorted rows of a part, whose tables one task holds
PIECE_IDS = 4096
CHAIN_BLOCK = 1024
NOBODY = np.iinfo(np.int64).max
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()

RESULTS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


# Sequences ---------------------------------------------------------------------------------------
def numbered_turns(
    conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(``c``, ``i``, ``a``, ``b``, ``chars``): the turns of each conversation, numbered from 0, by their hashes.

    Turns are sorted over the whole table, so a very long conversation is numbered by many tasks; what one task
    counted of it is added in the next ones.
    """
    said, by = F.coalesce(F.col(quoted(text)), F.lit("")), F.coalesce(F.col(quoted(role)), F.lit(""))
    turns = conversations.filter(F.col(quoted(conversation)).isNotNull()).select(
        F.col(quoted(conversation)).cast("long").alias("c"), F.col(quoted(turn)).cast("long").alias("t"),
        F.xxhash64(by, said).alias("a"), F.xxhash64(F.lit(7), said, by).alias("b"), F.length(said).alias("chars"),
    )
    order = ("c", "t", "a", "b")
    turns = store(turns, "trie_turns")
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = turns.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("c", "a", "b", "chars")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, seen = None, 0
        names = ["c", "a", "b", "chars", "part", "i", "at_end"]
        for batch in batches:
            if batch.num_rows:
                c = np.asarray(batch.column(0))
                new = np.r_[c[0] != last, c[1:] != c[:-1]]
                first = np.maximum.accumulate(np.where(new, np.arange(len(c)), 0))
                i = np.arange(len(c)) - first
                if not new[0]:
                    i[: len(c) if not new.any() else int(new.argmax())] += seen
                last, seen = c[-1], int(i[-1]) + 1
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(np.full(len(c), part)), pa.array(i), pa.nulls(len(c), pa.int64())], names=names
                )
        if last is not None:
            none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array([last]), *none, pa.array([part], pa.int64()), pa.nulls(1, pa.int64()), pa.array([seen])], names=names)

    counted = store(ordered.mapInArrow(number, "c long, a long, b long, chars int, part long, i long, at_end long"), "trie_numbered")
    ends = counted.filter("at_end is not null").select("part", "c", "at_end").orderBy("part").collect()  # one row a task
    begun, before = [], 0
    for this, following in zip(ends, ends[1:], strict=False):
        before = this["at_end"] + (before if begun and begun[-1][:2] == (this["part"], this["c"]) else 0)
        begun.append((following["part"], this["c"], before))
    offsets = counted.sparkSession.createDataFrame(begun, "part long, c long, before long")
    rows = counted.filter("i is not null").join(offsets, ["part", "c"], "left")
    return rows.select("c", (F.col("i") + F.coalesce("before", F.lit(0))).alias("i"), "a", "b", "chars")


def share_heads(turns: DataFrame, of_each: int = 100, most: int = 6) -> DataFrame:
    """Conversations rebuilt: the first h turns of the conversation that opens their hundred, then their own after h.

    h is the checksum of the conversation's number modulo ``most``. A NULL turn stands for a conversation as such.
    """
    entry = F.struct("i", "a", "b", "chars")
    heads = (
        turns.filter((F.col("c") % of_each == 0) & (F.col("i") < most)).groupBy("c")
        .agg(F.array_sort(F.collect_list(entry)).alias("head")).withColumnRenamed("c", "base")
    )
    drawn = F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(most)).cast("int")
    plan = turns.select("c").distinct().withColumns({"h": drawn, "base": F.col("c") - F.col("c") % of_each})
    plan = plan.join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array().cast("array<struct<i:bigint,a:bigint,b:bigint,chars:int>>")), F.lit(1), F.col("h")))
    own = turns.join(plan.select("c", "h", F.size("head").alias("n_head")), "c").filter("i >= h")
    own = own.select("c", (F.col("i") - F.col("h") + F.col("n_head")).alias("d"), "a", "b", "chars")
    first = plan.select("c", F.posexplode_outer("head").alias("d", "x"))
    return own.union(first.select("c", F.col("d").cast("long"), "x.a", "x.b", "x.chars"))


def as_they_are(turns: DataFrame) -> DataFrame:
    """Conversations with the turns they have."""
    return turns.select("c", F.col("i").alias("d"), "a", "b", "chars")


def _chained(segments: DataFrame) -> DataFrame:
    """Add ``x1``, ``x2``, the hashes of all segments before this one, by running XOR in two levels."""
    several = segments.filter("s > 0").select("c").distinct()
    long = segments.join(several, "c", "left_semi").select(
        "c", "s", F.xxhash64("s", "turns").alias("g1"), F.xxhash64(F.lit(11), "turns", "s").alias("g2"),
        F.floor(F.col("s") / CHAIN_BLOCK).alias("block"),
    )
    lanes = ("g1", "g2")
    blocks = long.groupBy("c", "block").agg(*[F.bit_xor(g).alias(f"whole_{g}") for g in lanes])
    earlier = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("c", "block", *[F.coalesce(F.bit_xor(f"whole_{g}").over(earlier), F.lit(0)).alias(f"off_{g}") for g in lanes])
    inside = Window.partitionBy("c", "block").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    running = long.withColumns({f"run_{g}": F.coalesce(F.bit_xor(g).over(inside), F.lit(0)) for g in lanes}).join(blocks, ["c", "block"])
    chains = running.filter("s > 0").select(
        "c", "s", *[F.col(f"run_{g}").bitwiseXOR(F.col(f"off_{g}")).alias(f"x{k}") for k, g in ((1, "g1"), (2, "g2"))]
    )
    return segments.join(chains, ["c", "s"], "left").withColumns({x: F.coalesce(x, F.lit(0).cast("long")) for x in ("x1", "x2")})


def _segments(sequences: DataFrame, segment: int) -> DataFrame:
    """Rows to be sorted: ``x1``, ``x2``, ``key`` (hashes), ``c``, ``s``, ``chars``, ``ends``, and the chain ``y1``, ``y2`` behind them."""
    entry = F.when(F.col("a").isNotNull(), F.struct("d", "a", "b", "chars"))
    number = F.floor(F.coalesce("d", F.lit(0)) / segment)
    grouped = sequences.groupBy("c", number.alias("s")).agg(F.array_sort(F.collect_list(entry)).alias("turns"))  # at most a segment
    segments = store(grouped.select(
        "c", "s", F.flatten(F.transform("turns", lambda x: F.array(x["a"], x["b"]))).alias("turns"),
        F.transform("turns", lambda x: x["chars"]).alias("chars"),
    ), "trie_segments")
    full = F.size("chars") == segment
    goes_on = segments.filter("s > 0").select("c", (F.col("s") - 1).alias("s"), F.lit(True).alias("goes_on"))
    rows = _chained(segments).join(goes_on, ["c", "s"], "left")
    after = [F.when(full, F.col(x).bitwiseXOR(g)) for x, g in (
        ("x1", F.xxhash64("s", "turns")), ("x2", F.xxhash64(F.lit(11), "turns", "s")),
    )]
    return rows.select(
        "x1", "x2", F.col("turns").alias("key"), "c", "s", "chars", F.col("goes_on").isNull().alias("ends"),
        after[0].alias("y1"), after[1].alias("y2"),
    )


# Parts of the sorted rows ------------------------------------------------------------------------
def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Turns in common at the start of two keys."""
    n = min(len(x), len(y))
    differs = np.flatnonzero(x[:n] != y[:n])
    return (int(differs[0]) if len(differs) else n) // 2


def _steps(lcp: np.ndarray, convs: np.ndarray) -> list[tuple[int, int, int]]:
    """(place, LCP, smallest id of the rows before) where the running minimum of the LCPs from place 1 on falls."""
    found, low, start, least = [], NOBODY, 0, NOBODY
    running = np.minimum.accumulate(lcp[1:]) if len(lcp) > 1 else lcp[:0]
    for place in (np.flatnonzero(np.r_[True, running[1:] < running[:-1]]) + 1 if len(running) else ()):
        least = min(least, int(convs[start:place].min()))
        found.append((int(place), int(lcp[place]), least))
        start, low = place, lcp[place]
    return found


@dataclass
class Summary:
    """What all tasks know of a part."""

    part: int
    n: int
    first: tuple[int, int, np.ndarray]
    last: tuple[int, int, np.ndarray]
    lowest: int  # LCP inside the part
    smallest: int  # id
    from_start: list[tuple[int, int, int]]
    from_end: list[tuple[int, int, int]]  # (place, LCP, smallest id from there on)


def _sorted_parts(rows: DataFrame, parts: int) -> DataFrame:
    """Rows in order with their LCP inside the part (NULL for its first), and one pickled ``Summary`` a part."""
    order = ("x1", "x2", "key", "c")
    fields = "part long, place long, c long, s long, lcp int, n int, chars array<int>, ends boolean, x1 long, x2 long, y1 long, y2 long, summary binary"
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        previous = first = None
        lcps, convs = [], []
        schema = pa.schema([
            ("part", pa.int64()), ("place", pa.int64()), ("c", pa.int64()), ("s", pa.int64()), ("lcp", pa.int32()), ("n", pa.int32()),
            ("chars", pa.list_(pa.int32())), ("ends", pa.bool_()), *[(x, pa.int64()) for x in ("x1", "x2", "y1", "y2")], ("summary", pa.binary()),
        ])
        for batch in batches:
            if not batch.num_rows:
                continue
            x1, x2 = (np.asarray(batch.column(k)) for k in (0, 1))
            keys = batch.column(2)
            flat, bounds = np.asarray(keys.values), np.asarray(keys.offsets)
            own = []
            for k in range(batch.num_rows):
                row = (int(x1[k]), int(x2[k]), flat[bounds[k] : bounds[k + 1]])
                if previous is None:
                    own.append(None)
                    first = row
                else:
                    own.append(_common(previous[2], row[2]) if previous[:2] == row[:2] else -1)
                previous = row
            previous = (*previous[:2], previous[2].copy())
            first = (*first[:2], first[2].copy())
            start = len(convs)
            lcps += [-1 if x is None else x for x in own]
            convs += batch.column(3).to_pylist()
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, part)), pa.array(np.arange(start, start + n)), batch.column(3), batch.column(4), pa.array(own, pa.int32()),
                pa.array((np.diff(bounds) // 2).astype(np.int32)), batch.column(5), batch.column(6), batch.column(0), batch.column(1),
                batch.column(7), batch.column(8), pa.nulls(n, pa.binary()),
            ], schema=schema)
        if previous is not None:
            lcp, conv = np.array(lcps), np.array(convs)
            n = len(lcp)
            # from the end: place k of the reversed rows lies between rows n-1-k and n-k
            back = [(n - k, x, least) for k, x, least in _steps(np.r_[-1, lcp[:0:-1]], conv[::-1])]
            lowest = int(lcp[1:].min()) if n > 1 else NOBODY
            summary = Summary(part, n, first, previous, lowest, int(conv.min()), _steps(lcp, conv), back)
            nothing = [pa.nulls(1, f.type) for f in schema][1:-1]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), *nothing, pa.array([pickle.dumps(summary)], pa.binary())], schema=schema)

    return ordered.mapInArrow(run, fields)


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all ranges of 1, 2, 4, ... values by their first place."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half, last = 1 << (len(table) - 1), table[-1]
        table.append(np.minimum(last[: len(last) - half], last[half:]))
    return table


def reach_right(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last place up to which all values after ``at`` are at least ``depth``."""
    at, n = at.copy(), len(table[0])
    for k in range(len(table) - 1, -1, -1):
        fits = at + (1 << k) < n
        fits[fits] = table[k][at[fits] + 1] >= depth[fits]
        at[fits] += 1 << k
    return at


def reach_left(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first place from which all values after it, up to that of ``at``, are at least ``depth``."""
    at = at.copy()
    for k in range(len(table) - 1, -1, -1):
        fits = at >= 1 << k
        fits[fits] = table[k][at[fits] - (1 << k) + 1] >= depth[fits]
        at[fits] -= 1 << k
    return at


def range_minimum(table: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    result = np.empty(len(first), dtype=table[0].dtype)
    for k in np.unique(level).tolist():
        at = np.flatnonzero(level == k)
        result[at] = np.minimum(table[k][first[at]], table[k][last[at] - (1 << k) + 1])
    return result


class Parts:
    """Extents beyond a part, from the summaries of all parts in order."""

    def __init__(self, summaries: Sequence[Summary]) -> None:
        self.all = list(summaries)
        self.number = {p.part: k for k, p in enumerate(self.all)}
        self.offset = np.cumsum([0, *[p.n for p in self.all]])
        self.border = np.array([-1] + [
            _common(p.last[2], q.first[2]) if p.last[:2] == q.first[:2] else -1 for p, q in zip(self.all, self.all[1:], strict=False)
        ])
        inside = np.array([p.lowest for p in self.all])
        self.whole = sparse_table(np.minimum(self.border, inside))  # of a part and the border before it
        self.before = sparse_table(np.minimum(self.border, np.r_[-1, inside[:-1]]))  # of a border and the part before it
        self.smallest = sparse_table(np.array([p.smallest for p in self.all]))

    def _least(self, a: int, b: int) -> int:
        return int(range_minimum(self.smallest, np.array([a]), np.array([b]))[0]) if a <= b else NOBODY

    def right(self, k: int, depth: int) -> tuple[int, int]:
        """Last row of what reaches the end of part ``k`` at this depth, and the smallest id beyond the part."""
        q = int(reach_right(self.whole, np.array([k]), np.array([depth]))[0])
        row, least = int(self.offset[q + 1]) - 1, self._least(k + 1, q)
        if q + 1 < len(self.all) and self.border[q + 1] >= depth:
            place, _, smallest = next(s for s in self.all[q + 1].from_start if s[1] < depth)
            row, least = int(self.offset[q + 1]) + place - 1, min(least, smallest)
        return row, least

    def left(self, k: int, depth: int) -> tuple[int, int]:
        """First row of what reaches the start of part ``k`` at this depth, and the smallest id before the part."""
        q = int(reach_left(self.before, np.array([k]), np.array([depth]))[0])
        row, least = int(self.offset[q]), self._least(q, k - 1)
        if q > 0 and self.border[q] >= depth:
            place, _, smallest = next(s for s in self.all[q - 1].from_end if s[1] < depth)
            row, least = int(self.offset[q - 1]) + place, min(least, smallest)
        return row, least


class Part:
    """Sparse tables of one part."""

    def __init__(self, parts: Parts, number: int, lcp: np.ndarray, convs: np.ndarray) -> None:
        self.parts, self.k, self.n = parts, number, len(lcp)
        self.lcp, self.convs = sparse_table(lcp), sparse_table(convs)
        self.offset = int(parts.offset[number])

    def extents(self, at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first row, last row, smallest id) of the rows that share the first ``depth`` turns of row ``at``."""
        first, last = reach_left(self.lcp, at, depth), reach_right(self.lcp, at, depth)
        least = range_minimum(self.convs, first, last)
        rows = first + self.offset, last + self.offset
        for side, touches, beyond in (
            (0, (first == 0) & (self.parts.border[self.k] >= depth), self.parts.left),
            (1, (last == self.n - 1) if self.k + 1 < len(self.parts.all) else np.zeros(len(at), dtype=bool), self.parts.right),
        ):
            for d in np.unique(depth[touches]).tolist():  # at most one per turn of a segment
                row, smallest = beyond(self.k, d)
                which = touches & (depth == d)
                rows[side][which] = row
                least[which] = np.minimum(least[which], smallest)
        return *rows, least


NODE = (
    "l long, d int, s long, r long, conv long, n long, chars long, p_l long, p_d int, p_conv long, first boolean, part long, "
    "x1 long, x2 long, y1 long, y2 long, ends string, piece string"
)


def _nodes_of(part: Part, number: int, rows: dict[str, np.ndarray], chars: pa.ListArray, segment: int) -> Iterator[list]:
    """Columns of ``NODE``: the nodes that begin in a part, then the pieces of ending ids that other parts share."""
    lcp, length, convs = rows["lcp"], rows["n"], rows["c"]
    shared = np.maximum(lcp, 0)
    new = length - shared
    root = (lcp < 0) & (rows["x1"] == 0) & (rows["x2"] == 0) & (rows["s"] == 0)
    made = new + root
    at = np.repeat(np.arange(len(lcp)), made)
    inside = np.arange(len(at)) - np.repeat(np.cumsum(made) - made, made)  # 0, 1, ... of a row's nodes
    depth = shared[at] + 1 + inside - root[at]
    hangs = np.flatnonzero(new > 0)
    again = np.flatnonzero(rows["ends"] & (length == shared) & ~(root & (length == 0)))  # end at a node of an earlier row
    l, r, least = part.extents(np.r_[at, hangs, again], np.r_[depth, shared[hangs], length[again]])
    nodes = len(at)
    own = slice(0, nodes)
    # a node hangs on the one before it in the row, the first one of a row on the prefix shared with the row before
    p_l, p_d, p_conv = np.r_[0, l][:nodes], depth - 1, np.r_[0, least][:nodes]
    begins = np.flatnonzero((inside == 0) & (depth > 0))
    slot = np.searchsorted(hangs, at[begins])
    p_l[begins], p_conv[begins] = l[nodes + slot], least[nodes + slot]
    flat, bounds = np.asarray(chars.values), np.asarray(chars.offsets)
    size = np.zeros(nodes, dtype=np.int64)
    size[depth > 0] = flat[bounds[at[depth > 0]] + depth[depth > 0] - 1]
    # ending conversations of a node are adjacent rows in the order of their ids
    enders = np.flatnonzero(rows["ends"])
    home = np.full(len(lcp), -1, dtype=np.int64)
    home[enders] = part.offset + enders
    home[again] = l[nodes + len(hangs) :]
    digests = np.full(nodes, EMPTY_DIGEST, dtype=object)
    last_node = np.cumsum(made) - 1
    pieces, to_end = [], np.minimum.accumulate(lcp[::-1])[::-1]  # may rows of the next part belong to this node, too?
    for run in np.split(enders, np.flatnonzero(np.diff(home[enders])) + 1) if len(enders) else ():
        row = int(home[run[0]])
        ids = convs[run].tolist()
        e = int(run[-1])
        more = number + 1 < len(part.parts.all) and (e == len(lcp) - 1 or to_end[e + 1] >= length[e])
        if row < part.offset or more:
            pieces += [(row, int(length[run[0]]), ids[k], ",".join(map(str, ids[k : k + PIECE_IDS]))) for k in range(0, len(ids), PIECE_IDS)]
            if row >= part.offset:
                digests[last_node[row - part.offset]] = None
        else:
            digests[last_node[row - part.offset]] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    full = depth == segment
    yield [
        l[own], depth, rows["s"][at], r[own], least[own], r[own] - l[own] + 1, size, p_l, p_d, p_conv, inside == 0, np.full(nodes, number),
        rows["x1"][at], rows["x2"][at], pa.array(rows["y1"][at], mask=~full), pa.array(rows["y2"][at], mask=~full),
        pa.array(digests.tolist(), pa.string()), pa.nulls(nodes, pa.string()),
    ]
    if pieces:
        rows_l, rows_d, first, texts = zip(*pieces, strict=True)
        n = len(pieces)
        none, none32 = pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())
        yield [
            np.array(rows_l), np.array(rows_d), none, none, np.array(first), none, none, none, none32, none, pa.nulls(n, pa.bool_()), none,
            none, none, none, none, pa.nulls(n, pa.string()), pa.array(texts),
        ]


def _searched(sorted_rows: DataFrame, summaries: list[Summary], segment: int) -> DataFrame:
    """Nodes (and pieces of ending ids) from the sorted rows, part by part."""
    shared = sorted_rows.sparkSession.sparkContext.broadcast(summaries)
    types = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string()}
    schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in NODE.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, waiting, current = None, [], None

        def found() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(waiting).combine_chunks()
            chars = table.column("chars").chunk(0)
            rows = {c: np.asarray(table.column(c).fill_null(-1) if c == "lcp" else table.column(c)) for c in ("lcp", "n", "c", "s", "ends", "x1", "x2")}
            rows |= {c: np.asarray(table.column(c).fill_null(0)) for c in ("y1", "y2")}
            k = parts.number[current]
            lcp = rows["lcp"].astype(np.int64)
            lcp[0] = parts.border[k]
            rows |= {"lcp": lcp, "n": rows["n"].astype(np.int64)}
            for columns in _nodes_of(Part(parts, k, lcp, rows["c"]), k, rows, chars, segment):
                yield pa.RecordBatch.from_arrays([
                    (x if isinstance(x, pa.Array) else pa.array(x)).cast(f.type) for x, f in zip(columns, schema, strict=True)
                ], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            parts = parts or Parts(shared.value)
            numbers = np.asarray(batch.column(0))
            cuts = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]]).tolist()
            for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                if current != int(numbers[a]):
                    if waiting:
                        yield from found()
                    current, waiting = int(numbers[a]), []
                waiting.append(batch.slice(a, b - a))
        if waiting:
            yield from found()

    dealt = sorted_rows.drop("summary").repartition(max(1, len(summaries)), "part").sortWithinPartitions("part", "place")
    return dealt.mapInArrow(run, NODE)


# Sums over the trie ------------------------------------------------------------------------------
def _digests(pieces: DataFrame) -> DataFrame:
    """(``l``, ``d``, ``joined``): digest of the pieces of each node, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None

        def finished() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int32()), pa.array([digest.hexdigest()])], names=["l", "d", "joined"]
            )

        for batch in batches:
            for l, d, piece in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if key != (l, d):
                    if key is not None:
                        yield finished()
                    key, digest = (l, d), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(piece.encode())
        if key is not None:
            yield finished()

    ordered = pieces.repartition("l", "d").sortWithinPartitions("l", "d", "conv").select("l", "d", "piece")
    return ordered.mapInArrow(run, "l long, d int, joined string")


def _below_chains(chains: DataFrame, links: DataFrame) -> DataFrame:
    """Per chain (``x1``, ``x2``): leaves and saved characters of its nodes and of all chains behind them.

    ``links`` gives the chain before each chain; pointers double until none is left.
    """
    sums = store(chains, "trie_chains")
    up = store(links, "trie_links")
    while not up.isEmpty():
        moved = up.join(sums, ["x1", "x2"]).groupBy("u1", "u2").agg(*[F.sum(x).alias(f"more_{x}") for x in ("leaves", "saved")])
        moved = moved.withColumnsRenamed({"u1": "x1", "u2": "x2"})
        added = {x: F.col(x) + F.coalesce(f"more_{x}", F.lit(0)) for x in ("leaves", "saved")}
        sums = store(sums.join(moved, ["x1", "x2"], "left").select("x1", "x2", *[v.alias(k) for k, v in added.items()]), "trie_chains")
        next_up = up.select(*[F.col(a).alias(b) for a, b in (("x1", "u1"), ("x2", "u2"), ("u1", "v1"), ("u2", "v2"))])
        up = store(up.join(next_up, ["u1", "u2"]).select("x1", "x2", F.col("v1").alias("u1"), F.col("v2").alias("u2")), "trie_links")
    return sums


def _before(nodes: DataFrame, sums: Sequence[str]) -> DataFrame:
    """Add ``before_<x>``: the sum of ``x`` over the nodes before this one, by (first row, depth)."""
    parts = nodes.groupBy("part").agg(*[F.sum(x).alias(f"_{x}") for x in sums])
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    parts = parts.select("part", *[F.coalesce(F.sum(f"_{x}").over(earlier), F.lit(0)).alias(f"off_{x}") for x in sums])
    inside = Window.partitionBy("part").orderBy("l", "d").rowsBetween(Window.unboundedPreceding, -1)
    running = nodes.withColumns({f"run_{x}": F.coalesce(F.sum(x).over(inside), F.lit(0)) for x in sums}).join(parts, "part")
    return running.withColumns({f"before_{x}": F.col(f"run_{x}") + F.col(f"off_{x}") for x in sums}).drop(
        *[f"{p}_{x}" for p in ("run", "off") for x in sums]
    )


def _counted(nodes: DataFrame) -> DataFrame:
    """Add children, leaves and saved characters of whole subtrees, and the parents of nodes that open a chain."""
    opens_chain = (F.col("s") > 0) & (F.col("p_d") == 0)
    children = nodes.filter(~opens_chain & (F.col("p_d") >= 0)).groupBy("p_l", "p_d").agg(F.count(F.lit(1)).alias("own_children"))
    children = children.withColumnsRenamed({"p_l": "l", "p_d": "d"})
    behind = nodes.filter(opens_chain).groupBy("x1", "x2").agg(F.count(F.lit(1)).alias("far_children")).withColumnsRenamed({"x1": "y1", "x2": "y2"})
    with_children = nodes.join(children, ["l", "d"], "left").join(behind, ["y1", "y2"], "left")
    n_children = F.coalesce("own_children", F.lit(0)) + F.coalesce("far_children", F.lit(0))
    weighed = store(with_children.withColumns({
        "n_children": n_children, "leaves": F.when(n_children == 0, 1).otherwise(0).cast("long"), "saved": (F.col("n") - 1) * F.col("chars"),
    }).drop("own_children", "far_children"), "trie_weighed")
    if not weighed.filter("s > 0").isEmpty():
        later = weighed.filter("s > 0")
        chains = later.groupBy("x1", "x2").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        links = later.filter("y1 is not null and n_children > 0").select(
            F.col("y1").alias("x1"), F.col("y2").alias("x2"), F.col("x1").alias("u1"), F.col("x2").alias("u2")
        ).join(chains.select("x1", "x2"), ["x1", "x2"], "left_semi")
        below = _below_chains(chains, links).select(
            F.col("x1").alias("y1"), F.col("x2").alias("y2"), F.col("leaves").alias("far_leaves"), F.col("saved").alias("far_saved")
        )
        parents = weighed.filter("y1 is not null").select(F.col("y1").alias("x1"), F.col("y2").alias("x2"), F.col("conv").alias("far_conv"))
        far = F.when(opens_chain, F.col("far_conv")).otherwise(F.col("p_conv"))
        more = {x: F.col(x) + F.coalesce(f"far_{x}", F.lit(0)) for x in ("leaves", "saved")}
        weighed = weighed.join(below, ["y1", "y2"], "left").join(parents, ["x1", "x2"], "left").withColumns({**more, "p_conv": far})
        weighed = store(weighed.drop("far_leaves", "far_saved", "far_conv"), "trie_weighed")
    sums = ("leaves", "saved")
    running = store(_before(weighed, sums), "trie_running")
    after = running.filter("first").select((F.col("l") - 1).alias("r"), *[F.col(f"before_{x}").alias(f"after_{x}") for x in sums])
    totals = running.agg(F.struct(*[F.sum(x).alias(x) for x in sums]).alias("v")).scalar()
    subtree = {f"n_{x}": F.coalesce(f"after_{x}", totals[x]) - F.col(f"before_{x}") for x in sums}
    return running.join(after, "r", "left").withColumns(subtree)


def prefix_trie(sequences: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row of ``RESULTS`` per node of the trie of ``sequences`` (``c``, ``d``, ``a``, ``b``, ``chars``)."""
    rows = store(_segments(sequences, segment), "trie_rows")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(tasks, math.ceil(rows.count() / PART_ROWS))
    sorted_rows = store(_sorted_parts(rows, parts), "trie_sorted")
    found = sorted_rows.filter("summary is not null").select("part", "summary").orderBy("part").collect()  # one row a part
    searched = store(
        _searched(sorted_rows.filter("summary is null"), [pickle.loads(r["summary"]) for r in found], segment), "trie_nodes"
    )
    counted = _counted(searched.filter("piece is null").drop("piece"))
    joined = _digests(searched.filter("piece is not null"))
    whole = counted.join(joined, ["l", "d"], "left")
    depth: Column = F.col("s") * segment + F.col("d")
    return whole.select(
        F.col("conv").alias("conv_id"), depth.alias("depth"), F.when(depth > 0, F.col("p_conv")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        "n_children", "n_leaves", F.col("n_saved").alias("saved_tokens"), F.coalesce("joined", "ends").alias("ends_sha256"),
    )
