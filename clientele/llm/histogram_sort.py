"""Sharding by histogram sort: exact byte counts below candidate keys are refined until every splitter is close
enough to its target, then the rows are exchanged once.

A row's key is (hash of its text, hash of its id), so equal texts are neighbours and a splitter falls inside such
a group only where the group is larger than the tolerance. A probe round counts bytes and rows per key digit,
reduced on the map side, for those key ranges only in which a target still lies; at most ``2**DIGIT_BITS`` numbers
per open target reach the driver. Each shard is cut into finer parts, so that no task orders a whole shard; the
exact counts below the splitters give every part its first slot.

Defined results: size of a NULL text is 1 and its checksum 0, as for the empty text. Rows equal in id and text have
equal keys and stay in one part (their slots are arbitrary among them). An empty table gives an empty result.
Columns of the input named like a result are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.sources.storage import store

DIGIT_BITS = 12
DIGITS = 5  # per key: its hash keeps 60 bits
SHARD_TOLERANCE = 0.002  # of a shard's bytes
PART_TOLERANCE = 0.1  # of a part's bytes

RESULTS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
_KEYS = ("_k1", "_k2")


@dataclass(frozen=True)
class Splitter:
    """The first key of a part, and what lies below it."""

    key: tuple[int, int]
    bytes_below: int
    rows_below: int


@dataclass
class _Open:
    """A target inside a key range given by its leading digits."""

    target: float
    tolerance: float
    prefix: tuple[int, ...]
    bytes_below: int
    rows_below: int


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _keyed(docs: DataFrame) -> DataFrame:
    sixty = [F.shiftrightunsigned(F.xxhash64(c), 64 - DIGIT_BITS * DIGITS) for c in (_text(), F.col("doc_id"))]
    return docs.withColumns({"size": F.octet_length(_text()).cast("long") + 1, **dict(zip(_KEYS, sixty, strict=True))})


def _digit(level: int) -> Column:
    shift = DIGIT_BITS * (DIGITS - 1 - level % DIGITS)
    return F.shiftright(F.col(_KEYS[level // DIGITS]), shift).bitwiseAND((1 << DIGIT_BITS) - 1).cast("int")


def _lowest_key(digits: tuple[int, ...]) -> tuple[int, int]:
    """The smallest key with these leading digits; one past the last digit carries over."""
    whole = 0
    for d in [*digits, *[0] * (2 * DIGITS - len(digits))]:
        whole = (whole << DIGIT_BITS) + d
    return divmod(whole, 1 << (DIGIT_BITS * DIGITS))


def _probe(keys: DataFrame, prefixes: set[tuple[int, ...]]) -> dict[tuple[int, ...], list[tuple[int, int, int]]]:
    """Bytes and rows per next digit under each prefix, in digit order."""
    level = len(next(iter(prefixes)))
    inside = F.array(*[_digit(i) for i in range(level)])
    if level:
        keys = keys.filter(F.concat_ws(",", inside).isin([",".join(map(str, p)) for p in sorted(prefixes)]))
        keys = keys.withColumn("_prefix", F.concat_ws(",", inside))
    else:
        keys = keys.withColumn("_prefix", F.lit(""))
    rows = keys.groupBy("_prefix", _digit(level).alias("_d")).agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    found: dict[tuple[int, ...], list[tuple[int, int, int]]] = {}
    for r in sorted(rows, key=lambda r: r["_d"]):
        prefix = tuple(map(int, r["_prefix"].split(","))) if r["_prefix"] else ()
        found.setdefault(prefix, []).append((r["_d"], r["b"], r["n"]))
    return found


def find_splitters(keys: DataFrame, targets: list[tuple[float, float]]) -> list[Splitter]:
    """A splitter for each (share of all bytes, tolerance as a share), ascending."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    waiting = {i: _Open(share * total, tolerance * total, (), 0, 0) for i, (share, tolerance) in enumerate(targets)}
    done: dict[int, Splitter] = {}
    while waiting and total:
        histograms = _probe(keys, {o.prefix for o in waiting.values()})
        for i, o in list(waiting.items()):
            below, rows = o.bytes_below, o.rows_below
            for digit, size, count in histograms[o.prefix]:
                if below + size >= o.target:
                    break
                below, rows = below + size, rows + count
            low, high = abs(o.target - below), abs(below + size - o.target)
            prefix = (*o.prefix, digit)
            if min(low, high) > o.tolerance and count > 1 and len(prefix) < 2 * DIGITS:
                waiting[i] = _Open(o.target, o.tolerance, prefix, below, rows)
                continue
            del waiting[i]
            after = (*o.prefix, digit + 1)
            done[i] = Splitter(_lowest_key(prefix), below, rows) if low <= high else Splitter(_lowest_key(after), below + size, rows + count)
    return sorted((done.get(i, Splitter((0, 0), 0, 0)) for i in range(len(targets))), key=lambda s: s.key)


def _part(splitters: list[Splitter], first: int = 0) -> Column:
    """Number of splitters at or below the row's key, as a balanced tree of comparisons."""
    if not splitters:
        return F.lit(first)
    middle = len(splitters) // 2
    k1, k2 = splitters[middle].key
    below = (F.col("_k1") < k1) | ((F.col("_k1") == k1) & (F.col("_k2") < k2))
    return F.when(below, _part(splitters[:middle], first)).otherwise(_part(splitters[middle + 1 :], first + middle + 1))


def shard_by_bytes(docs: DataFrame, shards: int = 8, parts_per_shard: int | None = None) -> DataFrame:
    """Add size, checksum, shard and slot: shards of nearly equal bytes, slots gapless from 0 in key order."""
    if parts_per_shard is None:
        parts_per_shard = math.ceil(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) / shards)
    docs = docs.drop(*[c for c in docs.columns if c in RESULTS])
    keyed = _keyed(docs)
    parts = shards * parts_per_shard
    targets = [
        (i / parts, SHARD_TOLERANCE / shards if i % parts_per_shard == 0 else PART_TOLERANCE / parts) for i in range(1, parts)
    ]
    splitters = find_splitters(store(keyed.select("size", *_KEYS), "shard_keys"), targets)
    rows_below = [0, *[s.rows_below for s in splitters]]
    first_slot = [n - rows_below[i - i % parts_per_shard] for i, n in enumerate(rows_below)]
    order = Window.partitionBy("_part").orderBy(*_KEYS, "doc_id", "text_crc32")
    return (
        keyed.withColumns({"text_crc32": F.crc32(_text().cast("binary")), "_part": _part(splitters)})
        .withColumn("_row", F.row_number().over(order))
        .withColumns({
            "law": F.lit("bytes"), "shard": F.floor(F.col("_part") / parts_per_shard).cast("int"),
            "slot": F.col("_row") - 1 + F.get(F.array(*[F.lit(n).cast("long") for n in first_slot]), F.col("_part")),
            "grown_shard": F.lit(None).cast("int"),
        })
        .drop(*_KEYS, "_part", "_row")
    )
