"""Similarity join on word shingles by multiple-global-order filtering.

Two documents link when the Jaccard similarity of their sets of five-word shingles is at least 3/4. Such a pair
shares a token in the leading part (prefix) of both sets under any order of all tokens, so a candidate pair must do
so under several orders. The orders put rare tokens first, by a fixed-size table of counts over all documents, and
break ties by different hashes; any order is correct, a rare-first one is selective.

Under the first order, documents meet in the buckets of their prefix tokens. A bucket never emits all its pairs:
its members meet the bucket's centers one after the other, best placed member first, and only while the bucket
still holds documents not known to be connected; a bucket is done when all its members are connected or every
member has been a center. Whatever can link two components is compared, so no component is lost. Candidates then
need common prefix tokens under the other orders, one rare-first and one by a hash alone, and in each of them so many
that the sets can still be similar. What is left is verified on the whole sets. Prefixes under the other orders move
only for contents that are in a candidate pair, texts only for those of pairs that pass these orders; documents are
read again when a round brings pairs of new contents.

Equal word sequences are one content: they take part once. Contents and shingles are known by 64-bit hashes.
Defined results: a document without words (or NULL) has no shingles and is linked with nothing; one with fewer than
five words has its whole sequence as its one shingle. A NULL id takes part, but names no component. Repeated rows
are one content and have equal results; columns of the input named like a result are replaced; an empty table gives
an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from clientele.llm.arrow import Words, hash_words, map_columns, mixed, quoted, row_slices, window_hashes
from clientele.llm.components import connected_components
from clientele.sources.storage import store

WIDTH = 5
COUNTERS = 1 << 21  # of the table of token counts
SLICES = 64  # pieces in which that table moves
BITMAP = 1 << 26  # bits of the map of contents to be compared: 8 MB, whatever the corpus
CENTERS_GROW = 16  # a bucket's 1st center, then up to the 16th, the 256th, ...
OTHER_ORDERS = ((0x51ED270B35A3C1D7, True), (0xA24BAED4963EE407, False))  # seeds, and whether rare tokens come first
CONTENT_SEED = np.uint64(0xD6E8FEB86659FD93)


def sequence_hashes(words: Words) -> np.ndarray:
    """64-bit hash of each row's whole word sequence."""
    n = len(words.hashes)
    base = np.uint64(0xC2B2AE3D27D4EB4F | 1)
    factors = np.full(max(n, 1), base)
    factors[0] = 1
    up = np.multiply.accumulate(factors)
    inverse = np.full(max(n, 1) + 1, np.uint64(pow(int(base), -1, 1 << 64)))
    inverse[0] = 1
    down = np.multiply.accumulate(inverse)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words.hashes * up[:n], out=sums[1:])
    a, b = words.offsets[:-1], words.offsets[1:]
    return mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * CONTENT_SEED)


def shingle_sets(words: Words, contents: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    flat = window_hashes(words.hashes, WIDTH)
    for content, a, b in zip(contents, words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True):
        if b - a >= WIDTH:
            x = np.sort(flat[a : b - WIDTH + 1])
            yield x[np.r_[True, x[1:] != x[:-1]]]
        else:
            yield np.full(int(b > a), content)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def required(nx: int, ny: int) -> int:
    """Least intersection of sets of these sizes with similarity 3/4."""
    return (3 * (nx + ny) + 6) // 7


def prefix_size(n: int) -> int:
    """Tokens of a set that any similar set must meet, under any order."""
    return n - (3 * n + 3) // 4 + 1


def order_keys(tokens: np.ndarray, levels: np.ndarray | None, seed: int) -> np.ndarray:
    """Places of tokens in a global order: rare ones first and ties by a hash, or without ``levels`` by the hash alone."""
    place = mixed(tokens ^ np.uint64(seed))
    if levels is None:
        return place
    level = levels[(tokens & np.uint64(COUNTERS - 1)).astype(np.int64)].astype(np.uint64)
    return (level << np.uint64(56)) | (place >> np.uint64(8))


def ranked(tokens: np.ndarray, levels: np.ndarray, seed: int, n: int) -> np.ndarray:
    """The first ``n`` tokens: rare ones first, ties by a hash."""
    key = order_keys(tokens, levels, seed)
    if n < len(key):
        first = np.argpartition(key, n - 1)[:n]
        return tokens[first[np.argsort(key[first])]]
    return tokens[np.argsort(key)]


def signature(tokens: np.ndarray, levels: np.ndarray | None, seed: int) -> np.ndarray:
    """The prefix under an order: the leading 32 bits of its tokens' places, ascending."""
    size = prefix_size(len(tokens))
    return (np.sort(np.partition(order_keys(tokens, levels, seed), size - 1)[:size]) >> np.uint64(32)).astype(np.uint32)


def may_link(x: np.ndarray, nx: int, y: np.ndarray, ny: int) -> bool:
    """Whether sets of these sizes with these signatures share a prefix token and can be similar at all.

    What lies before the end of the shorter-reaching prefix is known of both sets; of the rest, at most the smaller
    rest can be common. Equal places of different tokens only raise the bound.
    """
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    shared = y[at] == x
    if not shared.any():
        return False
    end = min(x[-1], y[-1])
    before_x, before_y = int(np.searchsorted(x, end)), int(np.searchsorted(y, end))
    return int(shared[:before_x].sum()) + min(nx - before_x, ny - before_y) >= required(nx, ny)


def _profile(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """Per document its content and number of shingles; per task the slices of its table of token counts."""
    field = StructField("id", docs.schema[id_column].dataType)
    schema = StructType([field]).add("h", "long").add("content", "long").add("n", "long").add("slice", "integer").add("counts", "binary")
    arrow_id = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal arrow_id
        counts = np.zeros(COUNTERS, dtype=np.int64)
        waiting: list[np.ndarray] = []
        seen: set[int] = set()
        for batch in batches:
            arrow_id = batch.schema.field(0).type
            contents, sizes = [], []
            for part in row_slices(batch.column(2)):
                words = hash_words(part)
                own = sequence_hashes(words)
                for c, tokens in zip(own.tolist(), shingle_sets(words, own), strict=True):
                    sizes.append(len(tokens))
                    if len(tokens) and c not in seen:
                        seen.add(c)
                        waiting.append((tokens & np.uint64(COUNTERS - 1)).astype(np.int64))
                contents.append(signed(own))
                if sum(map(len, waiting)) > COUNTERS:
                    counts += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
                    waiting = []
            n = np.array(sizes, dtype=np.int64)
            content = pa.array(np.concatenate(contents), mask=n == 0)
            nothing = [pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), content, pa.array(n), *nothing], names=schema.names)
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
        if arrow_id is not None:
            pieces = [zlib.compress(x.astype(np.int64).tobytes(), 1) for x in np.split(counts, SLICES)]
            none = [pa.nulls(SLICES, t) for t in (arrow_id, pa.int64(), pa.int64(), pa.int64())]
            numbers = pa.array(range(SLICES), pa.int32())
            yield pa.RecordBatch.from_arrays([*none, numbers, pa.array(pieces, pa.binary())], names=schema.names)

    own = F.col(quoted(text))
    return docs.select(F.col(quoted(id_column)).alias("id"), F.xxhash64(own).alias("h"), own.alias("text")).mapInArrow(run, schema)


def _levels(slices: DataFrame) -> np.ndarray:
    """The summed table of token counts on a logarithmic scale: ``COUNTERS`` bytes, whatever the corpus."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.frombuffer(zlib.decompress(piece), dtype=np.int64)
                sums[number] = sums[number] + counts if number in sums else counts
        levels = [(4 * np.log2(1 + x)).astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array(levels, pa.binary())], names=["slice", "levels"])

    rows = slices.select("slice", "counts").repartition(SLICES, "slice").mapInArrow(add, "slice int, levels binary").collect()
    levels = np.zeros((SLICES, COUNTERS // SLICES), dtype=np.uint8)
    for r in rows:
        levels[r["slice"]] = np.frombuffer(r["levels"], dtype=np.uint8)
    return levels.ravel()


def _contents(docs: DataFrame, text: str, schema: StructType, one: Callable[[int, np.ndarray, int], list[tuple]]) -> DataFrame:
    """Rows made from each content that a task meets for the first time: ``one(content, shingles, row of the part)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in row_slices(batch.column(0)):
                words = hash_words(part)
                own = sequence_hashes(words)
                columns: list[list] = [[] for _ in schema.names]
                for i, (c, tokens) in enumerate(zip(signed(own).tolist(), shingle_sets(words, own), strict=True)):
                    if len(tokens) and c not in seen:
                        seen.add(c)
                        if (made := one(c, tokens, i)) is not None:
                            for column, value in zip(columns, made, strict=True):
                                column.append(part[i].as_py() if value is None else value)
                arrays = [
                    pa.array(np.concatenate(x)) if x and isinstance(x[0], np.ndarray) else pa.array(x, t)
                    for x, t in zip(columns, arrow_types, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    names = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    arrow_types = [names[{"bigint": "long"}.get(f.dataType.simpleString(), f.dataType.simpleString())] for f in schema.fields]
    return docs.select(F.col(quoted(text)).alias("text")).mapInArrow(run, schema)


def _prefixes(docs: DataFrame, text: str, levels: np.ndarray) -> DataFrame:
    """(``token``, ``c``, ``n``, ``pos``): the prefix tokens of each content under the first order."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)
    schema = StructType([StructField("token", LongType()), StructField("c", LongType()), StructField("n", IntegerType()), StructField("pos", IntegerType())])

    def one(c: int, tokens: np.ndarray, _: int) -> tuple:
        n = len(tokens)
        first = signed(ranked(tokens, shared.value, 0, prefix_size(n)))
        size = len(first)
        return first, np.full(size, c), np.full(size, n, dtype=np.int32), np.arange(size, dtype=np.int32)

    return _contents(docs, text, schema, one)


def _bitmap(contents: DataFrame) -> np.ndarray:
    """A bit for each content's hash, folded to ``BITMAP`` bits."""
    position = F.pmod(F.col("c"), F.lit(BITMAP))
    rows = (
        contents.groupBy(F.bitmap_bucket_number(position).alias("b"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(position)).alias("bits")).collect()
    )
    folded = np.zeros(BITMAP // 8 + 8192, dtype=np.uint8)
    for r in rows:
        bits = np.frombuffer(r["bits"], dtype=np.uint8)
        start = (r["b"] - 1) * 4096 if r["b"] > 0 else 0
        folded[start : start + len(bits)] |= bits
    return folded


def _bit_offset(value: int) -> int:
    """Where the bitmap functions put a value: bucket 1 holds 1 to 32768, and 0 is bucket 0 position 0."""
    return value - 1 if value > 0 else 0


def _met(c: int, bits: np.ndarray) -> bool:
    at = _bit_offset(c % BITMAP)
    return bool(bits[at >> 3] >> (at & 7) & 1)


def _signatures(docs: DataFrame, text: str, levels: np.ndarray, met: np.ndarray) -> DataFrame:
    """(``c``, ``n``, ``second``, ``third``) of the contents that meet others: signatures under the other orders."""
    broadcast = docs.sparkSession.sparkContext.broadcast((levels, met))

    def one(c: int, tokens: np.ndarray, _: int) -> tuple | None:
        table, bits = broadcast.value
        if not _met(c, bits):
            return None
        return c, len(tokens), *[signature(tokens, table if rare else None, seed).tobytes() for seed, rare in OTHER_ORDERS]

    schema = StructType().add("c", "long").add("n", "integer").add("second", "binary").add("third", "binary")
    return _contents(docs, text, schema, one).groupBy("c").agg(*[F.any_value(x).alias(x) for x in ("n", "second", "third")])


def _texts(docs: DataFrame, text: str, met: np.ndarray) -> DataFrame:
    """(``c``, ``text``) of the contents that meet others under every order."""
    broadcast = docs.sparkSession.sparkContext.broadcast(met)

    def one(c: int, tokens: np.ndarray, i: int) -> tuple | None:
        return (c, None) if _met(c, broadcast.value) else None

    found = _contents(docs, text, StructType().add("c", "long").add("text", "string"), one)
    return found.groupBy("c").agg(F.any_value("text").alias("text"))


class _Gathered:
    """A table about contents that grows with the pairs it is asked for; ``read`` takes a map of contents.

    It holds every content with a bit of its map, so tables of disjoint maps have no content in common.
    """

    def __init__(self, read: Callable[[np.ndarray], DataFrame], name: str):
        self._read, self._name = read, name
        self._have = np.zeros(BITMAP // 8 + 8192, dtype=np.uint8)
        self._table: DataFrame | None = None

    def of(self, pairs: DataFrame) -> DataFrame:
        """The rows of the contents of ``pairs`` (and, the first time, of few others)."""
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("c"))
        new = _bitmap(nodes) & ~self._have
        if self._table is not None and not new.any():
            return self._table.join(nodes, "c", "left_semi")
        rows = store(self._read(new), self._name)
        self._have |= new
        if self._table is None:
            self._table = rows
            return rows
        self._table = self._table.union(rows)
        return self._table.join(nodes, "c", "left_semi")


def _with_both(pairs: DataFrame, contents: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``pairs`` with the columns of both contents."""
    for side in ("b", "a"):
        renamed = contents.select(F.col("c").alias(side), *[F.col(x).alias(f"{x}_{side}") for x in columns])
        pairs = pairs.join(renamed, side)
    return pairs


def _meeting(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) that may link under each of the other orders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            na, nb = batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist()
            for order in ("second", "third"):
                xs, ys = batch.column(f"{order}_a"), batch.column(f"{order}_b")
                for i in np.flatnonzero(keep).tolist():
                    x, y = (np.frombuffer(s[i].as_buffer(), dtype=np.uint32) for s in (xs, ys))
                    keep[i] = may_link(x, na[i], y, nb[i])
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return _with_both(pairs, signatures, ("n", "second", "third")).mapInArrow(run, "a long, b long")


def _similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) of similar contents, by their whole sets."""

    def sets(column: pa.Array) -> Iterator[np.ndarray]:
        for part in row_slices(column):
            words = hash_words(part)
            yield from shingle_sets(words, sequence_hashes(words))

    def similar(x: np.ndarray, y: np.ndarray) -> bool:
        if len(x) > len(y):
            x, y = y, x
        common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
        return common >= required(len(x), len(y))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(sets(batch.column("text_a")), sets(batch.column("text_b")), strict=True)
            yield batch.select(["a", "b"]).filter(pa.array([similar(x, y) for x, y in both], pa.bool_()))

    return _with_both(pairs, texts, ("text",)).mapInArrow(run, "a long, b long")


def _can_link(a: str, b: str) -> Column:
    """Sizes and positions allow similarity, if the token of the bucket is the first one in common."""
    na, nb = F.col(f"{a}n"), F.col(f"{b}n")
    need = F.expr(f"(3 * ({a}n + {b}n) + 6) div 7")
    return (F.col(f"{a}c") != F.col(f"{b}c")) & (F.least(na - F.col(f"{a}pos"), nb - F.col(f"{b}pos")) >= need)


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def content_links(docs: DataFrame, text: str, levels: np.ndarray) -> DataFrame | None:
    """(``node``, ``component``) of the contents that link with others; None if no two contents meet."""
    order = Window.partitionBy("token").orderBy("pos", "c")
    # a content met by several tasks has equal rows, one after the other
    once = _prefixes(docs, text, levels).withColumn("before", F.lag("c").over(order)).filter("before is null or before <> c").drop("before")
    rows = once.withColumns({
        "rank": F.row_number().over(order), "next": F.lead("c").over(order), "third": F.lead("c", 2).over(order),
        "best": F.first(F.struct("c", "n", "pos")).over(order),
    })
    rows = rows.filter("rank > 1 or next is not null")
    rows = rows.withColumn("beyond_two", F.expr("rank > 2 or (rank = 2 and next is not null) or third is not null"))
    rows = store(rows.drop("next", "third"), "ngram_buckets")
    if rows.isEmpty():
        return None
    flat = rows.select("*", *[F.col(f"best.{x}").alias(f"best_{x}") for x in ("c", "n", "pos")])
    pairs = flat.filter("rank > 1").filter(_can_link("", "best_")).select(*_pair("c", "best_c")).distinct()
    tested = store(pairs, "ngram_tested")
    signatures = _Gathered(lambda met: _signatures(docs, text, levels, met), "ngram_signatures")
    texts = _Gathered(lambda met: _texts(docs, text, met), "ngram_texts")

    def verified(candidates: DataFrame) -> DataFrame:
        close = store(_meeting(candidates, signatures.of(candidates)), "ngram_close")
        return _similar(close, texts.of(close))

    components = store(connected_components(verified(tested)), "ngram_components")
    buckets, done = rows.filter("beyond_two").select("token", "c", "n", "pos", "rank"), 1  # a pair's bucket is done
    while True:
        member = buckets.join(components.withColumnRenamed("node", "c"), "c", "left").withColumn(
            "component", F.coalesce("component", "c")
        )
        member = store(member, "ngram_members")
        open_tokens = member.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.max("rank").alias("last"))
        open_tokens = open_tokens.filter((F.col("x") != F.col("y")) & (F.col("last") > done + 1)).select("token")
        member = store(member.join(open_tokens, "token", "left_semi"), "ngram_members")
        if member.isEmpty():
            return components
        center = member.filter(F.col("rank").between(done + 1, CENTERS_GROW * done))
        center = center.select("token", *[F.col(x).alias(f"center_{x}") for x in ("c", "n", "pos", "rank", "component")])
        across = member.join(center, "token").filter("rank > center_rank and component <> center_component")
        pairs = across.filter(_can_link("", "center_")).select(*_pair("c", "center_c")).distinct()
        pairs = store(pairs.join(tested, ["a", "b"], "left_anti"), "ngram_tested")
        done *= CENTERS_GROW
        buckets = member.drop("component")
        if not pairs.isEmpty():
            tested = tested.union(pairs)
            known = components.select(F.col("node").alias("a"), F.col("component").alias("b"))
            components = store(connected_components(known.union(verified(pairs))), "ngram_components")


def _judged(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(``id``, ``h``, ``n_shingles``, ``component_id``) of each document; ``h`` is the hash of its text."""
    profile = store(_profile(docs, id_column, text), "ngram_profile")
    levels = _levels(profile.filter("slice is not null"))
    own = profile.filter("slice is null").select("id", "h", "content", F.col("n").alias("n_shingles"))
    components = content_links(docs, text, levels)
    if components is None:
        own = own.withColumn("group", F.col("content"))
    else:
        own = own.join(components.withColumnRenamed("node", "content"), "content", "left")
        own = own.withColumn("group", F.coalesce("component", "content"))
    smallest = own.filter("group is not null").groupBy("group").agg(F.min("id").alias("smallest"))
    named = F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("smallest"))
    return own.join(smallest, "group", "left").select("id", "h", "n_shingles", named.alias("component_id"))


def similar_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ``n_shingles``, ``component_id``) of each document; see the module text."""
    return _judged(docs, id_column, text).select(F.col("id").alias(id_column), "n_shingles", "component_id")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that name their component, with their own columns.

    Rows equal in id and text are one document, of which one row stays. A component of NULL ids only keeps each of
    its different texts.
    """
    kept = _judged(docs, id_column, text).filter(F.col("id").eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col("id").alias("_id"), F.col("h").alias("_h")).distinct()
    own = F.xxhash64(quoted(text))
    rows = docs.join(kept, (own == F.col("_h")) & F.col(quoted(id_column)).eqNullSafe(F.col("_id")), "left_semi")
    same = Window.partitionBy(quoted(id_column), own).orderBy(F.lit(1))
    return rows.withColumn("_copy", F.row_number().over(same)).filter("_copy = 1").drop("_copy")
