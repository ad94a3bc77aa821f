"""Phrase collocations by exact counts in counting quotient filters.

Texts are cut into pieces and words. A word's id is the leading bits of a hash of its language and itself, wide enough
that no two words of the corpus share an id (checked on all of them; else another hash is taken). An n-gram is its
ids side by side; a Feistel permutation, which can be undone, spreads it, its leading bits (the quotient) tell the
slot and the rest (the remainder) is kept whole. So a filter is a sorted, compact and lossless table of counts. Tasks
fill filters of bounded size, cut them at fixed leading bits, and the parts of all tasks with equal leading bits are
merged. A frequent n-gram reaches its merge as one counter per filter.

Every part of a phrase is at least as frequent as the phrase. So n-grams of two words are counted between frequent
words only, longer ones where all their pairs are frequent; that is looked up in a bit map of the frequent ones of at
most ``MAP_BITS``. A wrong hit there costs a counter and changes no result.

Scores are floored ratios of decimals, so no product overflows. Languages are ranked by score and count first, and
only phrases up to the wanted rank, ties included, get their words.

Defined results: a NULL text has no words; a NULL language counts as ``und``. A language without any candidate has
no rows; an empty table gives an empty result. Repeated rows count as often as they stand. Other columns of the
input play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.llm.arrow import mixed, quoted, row_slices
from clientele.sources.storage import store

LONGEST = 4
WIDTHS = (40, 48, 56, 64)  # bits of a word id
SEEDS = (1, 2, 3, 4)
FILTER_ENTRIES = 1 << 21  # of a task's filter before it is handed on
WORD_ENTRIES = 1 << 18  # distinct words a task holds before it hands them on
PART_WORDS = 1 << 21  # word occurrences per part of a merge
BITS_EACH, MAP_BITS = 16, 1 << 28
UNKNOWN = "und"
SCALE = 2_000_000

_BREAKS = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
_BLANKS = np.isin(np.arange(256), list(b" \t"))
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint8)
_BASES = tuple(int(x) | 1 for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))


@dataclass
class Pieces:
    """Words of some texts in order: hash, place in ``data``, row, and whether the piece goes on after the word."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    goes_on: np.ndarray
    data: np.ndarray

    def string(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode()


def cut_words(column: pa.Array, salts: np.ndarray, seed: int) -> Pieces:
    """Words of each text, A-Z lower-cased; ``salts`` is a number per row (its language) that enters the hashes."""
    column = column.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    size = int(bounds[-1] - bounds[0])
    if not size:
        none = np.zeros(0, dtype=np.int64)
        return Pieces(none.astype(np.uint64), none, none, none, none.astype(bool), none.astype(np.uint8))
    data = _LOWER[np.frombuffer(column.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]]]
    edges = bounds - bounds[0]
    breaks = _BREAKS[data]
    gap = breaks | _BLANKS[data]
    before, after = np.empty(size + 1, dtype=bool), np.empty(size + 1, dtype=bool)
    before[1:], before[edges] = gap, True
    after[:-1], after[edges], after[-1] = gap, True, True
    starts = np.flatnonzero(~gap & before[:-1])
    ends = np.flatnonzero(~gap & after[1:]) + 1
    rows = np.searchsorted(edges, starts, side="right") - 1
    broken = np.zeros(size + 1, dtype=np.int64)
    np.cumsum(breaks, out=broken[1:])
    goes_on = np.zeros(len(starts), dtype=bool)
    goes_on[:-1] = (broken[starts[1:]] == broken[ends[:-1]]) & (rows[1:] == rows[:-1])
    base = _BASES[seed % len(_BASES)]
    up, down = np.full(size + 1, base, dtype=np.uint64), np.full(size + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    sums = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * np.multiply.accumulate(up)[:size], out=sums[1:])
    own = mixed((sums[ends] - sums[starts]) * np.multiply.accumulate(down)[starts])
    return Pieces(mixed(own + salts[rows]), starts, ends, rows, goes_on, data)


def _languages(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Names, the number of each row's name, and a hash of each name."""
    coded = column.fill_null(UNKNOWN).dictionary_encode()
    names = coded.dictionary.to_pylist()
    hashes = []
    for name in names:
        total = np.uint64(len(name) + 1)
        for byte in name.encode():
            total = mixed(np.array([total ^ np.uint64(byte)], dtype=np.uint64) + np.uint64(0x2545F4914F6CDD1D))[0]
        hashes.append(total)
    return names, np.asarray(coded.indices), np.array(hashes, dtype=np.uint64)


def _parts(batch: pa.RecordBatch, seed: int) -> Iterator[tuple[Pieces, list[str], np.ndarray]]:
    """The words of a batch of (lang, text), some texts at a time, with names and their number per row."""
    first = 0
    for part in row_slices(batch.column(1)):
        names, numbers, hashes = _languages(batch.column(0).slice(first, len(part)))
        first += len(part)
        yield cut_words(part, hashes[numbers], seed), names, numbers


# Vocabulary --------------------------------------------------------------------------------------
def count_words(docs: DataFrame, seed: int) -> DataFrame:
    """(``lang``, ``word``, ``h``, ``n``) of every distinct word: counted per task, then over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, list] = {}

        def handed() -> pa.RecordBatch:
            h = np.fromiter(known, dtype=np.uint64, count=len(known)).view(np.int64)
            lang, word, n = zip(*known.values(), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(lang), pa.array(word), pa.array(h), pa.array(n, pa.int64())], names=["lang", "word", "h", "n"])

        for batch in batches:
            for words, names, numbers in _parts(batch, seed):
                h, first, counts = np.unique(words.hashes, return_index=True, return_counts=True)
                for x, i, n in zip(h.tolist(), first.tolist(), counts.tolist(), strict=True):
                    if x in known:
                        known[x][2] += n
                    else:
                        known[x] = [names[numbers[words.rows[i]]], words.string(i), n]
                if len(known) > WORD_ENTRIES:
                    yield handed()
                    known = {}
        if known:
            yield handed()

    counted = docs.mapInArrow(run, "lang string, word string, h long, n long")
    return counted.groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))


def _vocabulary(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """All words with their counts, the seed of their hashes and the width at which no two share an id."""
    for seed in SEEDS:
        words = store(count_words(docs, seed), "phrase_words")
        for width in WIDTHS:
            shared = words.groupBy(F.shiftrightunsigned("h", 64 - width)).count().filter("count > 1")
            if shared.isEmpty():
                return words, seed, width
    raise ValueError("phrase mining: words share their 64-bit hashes under every seed")


# Bit map of what is frequent ---------------------------------------------------------------------
def _bit_map(codes: DataFrame) -> np.ndarray:
    """Bits set at two places of each ``code``; ``BITS_EACH`` bits a code, at most ``MAP_BITS`` in all."""
    size = codes.count()
    bits = min(MAP_BITS, max(1 << 15, 1 << math.ceil(math.log2(BITS_EACH * size + 1))))
    places = [F.pmod(c, F.lit(bits)) for c in (F.col("code"), F.shiftrightunsigned("code", 32))]
    slots = codes.select(F.explode(F.array(*places)).alias("p")).select(
        F.shiftright("p", 15).alias("slot"), F.col("p").bitwiseAND(32767).alias("at")
    )
    rows = slots.groupBy("slot").agg(F.bitmap_construct_agg("at").alias("bits")).collect()  # 4 kB each, MAP_BITS in all
    whole = np.zeros(bits // 8, dtype=np.uint8)
    for r in rows:
        whole[r["slot"] * 4096 : (r["slot"] + 1) * 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return whole


def _in_map(whole: np.ndarray, codes: np.ndarray) -> np.ndarray:
    mask = np.uint64(8 * len(whole) - 1)

    def bit(place: np.ndarray) -> np.ndarray:
        return (whole[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1

    found = bit(codes & mask)
    found[found] = bit(codes[found] >> np.uint64(32) & mask)
    return found


def code_of(lanes: Sequence[np.ndarray]) -> np.ndarray:
    """64 mixed bits of an n-gram, for the bit map only."""
    total = np.full(len(lanes[0]), len(lanes), dtype=np.uint64)
    for lane in lanes:
        total = mixed(total * np.uint64(0x9FB21C651E98DF25) + lane)
    return total


# Counting quotient filters -----------------------------------------------------------------------
def _turned(lanes: Sequence[np.ndarray], width: int, back: bool = False) -> list[np.ndarray]:
    """Feistel permutation of n-grams: each lane in turn is XORed with a hash of the others (in reverse to undo it)."""
    lanes, mask = list(lanes), np.uint64((1 << width) - 1)
    steps = [*range(len(lanes) - 1, -1, -1)] * 2
    for turn in reversed(range(len(steps))) if back else range(len(steps)):
        at = steps[turn]
        others = code_of([np.full(len(lanes[0]), turn + 1, dtype=np.uint64), *lanes[:at], *lanes[at + 1 :]])
        lanes[at] = lanes[at] ^ (others & mask)
    return lanes


def _collapsed(lanes: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct n-grams with summed counts."""
    order = np.argsort(lanes[0], kind="stable")
    lanes = [lane[order] for lane in lanes]
    same = lanes[0][1:] == lanes[0][:-1]
    if any((lane[1:][same] != lane[:-1][same]).any() for lane in lanes[1:]):  # two n-grams agree in their first lane
        again = np.lexsort(lanes[::-1])
        lanes, order = [lane[again] for lane in lanes], order[again]
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.logical_or.reduce([lane[1:] != lane[:-1] for lane in lanes])
    at = np.flatnonzero(new)
    return [lane[at] for lane in lanes], np.add.reduceat(counts[order], at) if len(at) else counts[:0]


def _low_bytes(lane: np.ndarray, size: int) -> bytes:
    return lane.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def _from_low_bytes(raw: bytes, size: int, n: int) -> np.ndarray:
    wide = np.zeros((n, 8), dtype=np.uint8)
    wide[:, :size] = np.frombuffer(raw, dtype=np.uint8).reshape(n, size)
    return wide.view("<u8").ravel().astype(np.uint64)


def packed(lanes: Sequence[np.ndarray], counts: np.ndarray, width: int, part_bits: int) -> bytes:
    """Sorted permuted n-grams with equal leading ``part_bits`` as a quotient filter.

    The first lane without these bits gives quotient and remainder; one bit map tells the entries of every quotient
    (a one per entry, a zero per quotient). Remainders and counts follow in that order; a count of 255 or more stands
    in a list of its own.
    """
    n = len(counts)
    own = width - part_bits
    size = max(0, -(-(own - int(math.log2(n))) // 8))  # bytes of the remainder; what is left are quotient bits
    if own < 8 * size:
        size = own // 8
    first = lanes[0] & np.uint64((1 << own) - 1)
    quotient = (first >> np.uint64(8 * size)).astype(np.int64)
    marks = np.zeros((1 << (own - 8 * size)) + n, dtype=bool)
    marks[quotient + np.arange(n)] = True
    many = counts[counts >= 255].astype("<i8")
    head = np.array([n, size, len(marks), len(many)], dtype="<i8").tobytes()
    rests = [_low_bytes(first, size), *[_low_bytes(lane, width // 8) for lane in lanes[1:]]]
    return b"".join([head, np.packbits(marks).tobytes(), *rests, np.minimum(counts, 255).astype(np.uint8).tobytes(), many.tobytes()])


def unpacked(raw: bytes, words: int, width: int, part_bits: int, part: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The permuted n-grams and counts of a filter."""
    n, size, slots, many = np.frombuffer(raw, dtype="<i8", count=4).tolist()
    at = 32

    def take(length: int) -> bytes:
        nonlocal at
        at += length
        return raw[at - length : at]

    marks = np.unpackbits(np.frombuffer(take(-(-slots // 8)), dtype=np.uint8), count=slots)
    quotient = (np.flatnonzero(marks) - np.arange(n)).astype(np.uint64)
    first = (quotient << np.uint64(8 * size)) | _from_low_bytes(take(n * size), size, n)
    if part_bits:
        first |= np.uint64(part) << np.uint64(width - part_bits)
    lanes = [first, *[_from_low_bytes(take(n * (width // 8)), width // 8, n) for _ in range(words - 1)]]
    counts = np.frombuffer(take(n), dtype=np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(take(8 * many), dtype="<i8")
    return lanes, counts


class Filter:
    """Counts of n-grams of one length, by one task."""

    def __init__(self, words: int, width: int, part_bits: int) -> None:
        self.words, self.width, self.part_bits = words, width, part_bits
        self._forget()

    def _forget(self) -> None:
        self.sorted = [np.zeros(0, dtype=np.uint64)] * self.words, np.zeros(0, dtype=np.int64)
        self.waiting: list[list[np.ndarray]] = []
        self.n_waiting = 0

    def add(self, lanes: list[np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
        """Count n-grams; yields the parts of the filter when it is full."""
        if len(lanes[0]):
            self.waiting.append(_turned(lanes, self.width))
            self.n_waiting += len(lanes[0])
            if self.n_waiting >= FILTER_ENTRIES // 2:
                self._merge()
                if len(self.sorted[1]) >= FILTER_ENTRIES:
                    yield from self.handed()

    def _merge(self) -> None:
        if self.waiting:
            lanes = [np.concatenate([old, *new]) for old, new in zip(self.sorted[0], zip(*self.waiting, strict=True), strict=True)]
            counts = np.concatenate([self.sorted[1], np.ones(self.n_waiting, dtype=np.int64)])
            self.sorted, self.waiting, self.n_waiting = _collapsed(lanes, counts), [], 0

    def handed(self) -> Iterator[tuple[int, int, bytes]]:
        """(words, part, packed filter) of everything counted; empties the filter."""
        self._merge()
        lanes, counts = self.sorted
        if len(counts):
            shift = np.uint64(self.width - self.part_bits)
            parts = lanes[0] >> shift if self.part_bits else np.zeros(len(counts), dtype=np.uint64)
            cuts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]]).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(counts)], strict=True):
                yield self.words, int(parts[a]), packed([lane[a:b] for lane in lanes], counts[a:b], self.width, self.part_bits)
        self._forget()


def frequent_ngrams(
    docs: DataFrame, lengths: Sequence[int], known: np.ndarray, known_words: int, seed: int, width: int, parts: int, least: int
) -> DataFrame:
    """(``words``, ``ids``, ``code``, ``n``) of the n-grams with at least ``least`` occurrences.

    ``known`` is the bit map of the frequent words (``known_words`` 1) or pairs (2); only n-grams all of whose words
    or pairs are in it are counted.
    """
    part_bits = max(0, math.ceil(math.log2(parts)))
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {k: Filter(k, width, part_bits) for k in lengths}

        def made(rows: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
            for words, part, raw in rows:
                yield pa.RecordBatch.from_arrays([pa.array([words], pa.int32()), pa.array([part], pa.int32()), pa.array([raw], pa.binary())], names=["words", "part", "filter"])

        for batch in batches:
            for words, _, _ in _parts(batch, seed):
                ids = words.hashes >> np.uint64(64 - width)
                if known_words == 1:
                    good = _in_map(shared.value, words.hashes)
                    pair = words.goes_on[:-1] & good[:-1] & good[1:]
                else:
                    pair = words.goes_on[:-1].copy()
                    at = np.flatnonzero(pair)
                    pair[at] = _in_map(shared.value, code_of([ids[at], ids[at + 1]]))
                run = pair  # run[i]: the n-gram from word i on is wanted
                for k in range(2, max(lengths) + 1):
                    if k > 2:
                        run = run[:-1] & pair[k - 2 :]
                    if k in filters:
                        at = np.flatnonzero(run)
                        yield from made(filters[k].add([ids[at + j] for j in range(k)]))
        for f in filters.values():
            yield from made(f.handed())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts arrive ordered by (words, part); one part at a time is merged, whenever enough of it has come."""
        key, got = None, []

        def collapsed() -> tuple[list[np.ndarray], np.ndarray]:
            return _collapsed([np.concatenate(x) for x in zip(*[g[0] for g in got], strict=True)], np.concatenate([g[1] for g in got]))

        def finished() -> pa.RecordBatch:
            lanes, counts = collapsed()
            enough = counts >= least
            plain = _turned([lane[enough] for lane in lanes], width, back=True)
            flat = np.stack(plain, axis=1).view(np.int64).ravel() if len(plain[0]) else np.zeros(0, dtype=np.int64)
            ids = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, key[0], dtype=np.int32), pa.array(flat))
            n = int(enough.sum())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, key[0], dtype=np.int32)), ids, pa.array(code_of(plain).view(np.int64)), pa.array(counts[enough])],
                names=["words", "ids", "code", "n"],
            )

        for batch in batches:
            for words, part, raw in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if key != (words, part):
                    if got:
                        yield finished()
                    key, got = (words, part), []
                got.append(unpacked(raw, words, width, part_bits, part))
                if len(got) > 1 and sum(len(g[1]) for g in got) > 2 * max(FILTER_ENTRIES, len(got[0][1])):
                    got = [collapsed()]
        if got:
            yield finished()

    filters = docs.mapInArrow(count, "words int, part int, filter binary")
    tasks = len(lengths) << part_bits
    dealt = filters.repartition(tasks, "words", "part").sortWithinPartitions("words", "part")
    return dealt.mapInArrow(merge, "words int, ids array<bigint>, code bigint, n bigint")


# Scores ------------------------------------------------------------------------------------------
def _wide(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def _scored(counts: DataFrame, least: int) -> DataFrame:
    """``ids``, ``words``, ``a``, ``l``, ``r``, ``score`` of each candidate at its lowest-scoring cut."""
    candidates = counts.filter(f"words > 1 and n >= {least}")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1))
    cuts = candidates.select("ids", "words", F.col("n").alias("a"), cut.alias("k")).withColumns({
        "first": F.slice("ids", F.lit(1), F.col("k")), "rest": F.slice("ids", F.col("k") + 1, F.col("words") - F.col("k")),
    })
    for side, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select(F.col("ids").alias(side), F.col("n").alias(name)), side)
    score = F.expr(f"(cast({SCALE} as decimal(10,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("ids", "words", "a").agg(lowest).select("ids", "words", "a", "cut.l", "cut.r", "cut.score")


def _maximal(scored: DataFrame) -> DataFrame:
    """Without the phrases of which a longer candidate makes up at least four fifths."""
    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("words") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: F.slice("ids", at, size)),
    ))
    longer = scored.filter("words > 2").select(F.explode(inner).alias("part"), F.col("a").alias("whole"))
    longest = longer.groupBy("part").agg(F.max("whole").alias("whole"))
    within = (F.col("ids") == F.col("part")) & (_wide(F.col("whole")) * 100 >= _wide(F.col("a")) * 80)
    return scored.join(longest, within, "left_anti")


def collocations(
    docs: DataFrame, top: int | None = 2000, least: int = 30, language: str = "lang", text: str = "text"
) -> DataFrame:
    """(``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``), the first ``top`` of each language or all."""
    texts = docs.select(F.col(quoted(language)).cast("string").alias("lang"), F.col(quoted(text)).alias("text"))
    words, seed, width = _vocabulary(texts)
    sizes = store(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase_sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    frequent = words.filter(F.col("n") >= least)
    singles = frequent.select(
        F.lit(1).alias("words"), F.array(F.shiftrightunsigned("h", 64 - width)).alias("ids"), F.col("h").alias("code"), "n"
    )
    parts = max(1, math.ceil(total / PART_WORDS))
    pairs = store(frequent_ngrams(texts, [2], _bit_map(singles), 1, seed, width, parts, least), "phrase_pairs")
    longer = store(
        frequent_ngrams(texts, range(3, LONGEST + 1), _bit_map(pairs), 2, seed, width, parts, least), "phrase_longer"
    )
    counts = singles.select("words", "ids", "n").union(pairs.select("words", "ids", "n")).union(longer.select("words", "ids", "n"))
    scored = store(_scored(counts, least), "phrase_scores")
    ids = frequent.select(F.shiftrightunsigned("h", 64 - width).alias("id"), "lang", "word")
    of_lang = ids.select("id", "lang")
    named = _maximal(scored).withColumn("id", F.col("ids")[0]).join(of_lang, "id").drop("id")
    if top is not None:
        by_count = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
        named = named.withColumn("place", F.rank().over(by_count)).filter(F.col("place") <= top)
    placed = named.select("*", F.posexplode("ids").alias("at", "id")).join(ids.select("id", "word"), "id")
    spelled = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")
    phrases = placed.groupBy("lang", "ids", "a", "l", "r", "score").agg(spelled.alias("phrase")).join(sizes, "lang")
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = phrases.withColumn("rank", F.row_number().over(best).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
