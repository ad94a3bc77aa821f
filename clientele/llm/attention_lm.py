"""Language-model scoring by a causal self-attention model trained in numpy on subword ids.

Words become the ids of a given subword vocabulary, a document its words' ids and one end id. An id belongs to one
of ``CLASSES`` classes (the most frequent ids have their own; the others share classes of equal mass, apart for ids
that begin a word), and

    P(id | before) = P(class | before) * P(id | class).

The first factor is one causal self-attention layer over up to ``WINDOW`` ids before. An id enters it as the sum of its
class's vector, which all ids of the class train, and one of its own, zero at first, so which id of a class came before
counts. The second factor comes from counts over all training documents. Documents are scored in windows that overlap by ``OVERLAP`` ids:
every window after the first scores only what lies behind its overlap, so each id is scored once.

Training is data-parallel: every window of every training document belongs to one round. The windows of a round are
dealt to the shuffle partitions, each trains a copy from the same start, and the copies' average starts the next
round (an id's own vector: weighted by how often each copy has met the id; one that none has met stays). Besides, the same pass counts all words of the training documents. Frequent counts (a fixed number) are
broadcast; the other words of each document meet their counts in one join.

Words ``[^\\x20\\x09-\\x0D]+`` have A-Z lower-cased and are counted by 64-bit hashes. Defined results: a NULL or
empty text is the end token alone. A document is for training unless the remainder of its id's checksum says
otherwise; a NULL id counts as an empty one. Repeated rows are scored alike; columns of the input named like a
result are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from clientele.llm.arrow import Words, hash_words, quoted, row_slices
from clientele.sources.storage import store

CLASSES, OWN_CLASS = 96, 76
WIDTH, HIDDEN = 16, 32
WINDOW, OVERLAP = 32, 8
ROUNDS, BATCH, RATE = 2, 32, 0.01
FOLDS, HELD_OUT = 7, 2
FREQUENT = 1 << 18  # words whose counts are broadcast
KNOWN_WORDS = 400_000  # of a worker's table of words already split
COUNTED_WORDS = 1 << 21  # distinct words a task holds before it passes counts on

WORD, PIECE, WINDOWS = 0, 1, 2  # kinds of gathered rows
OWN = "own"  # name of the ids' own vectors among the weights
MEETINGS = 16  # tasks at most in which copies are summed


class Pieces:
    """A worker's subword vocabulary, with the words it has split so far."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.end = self.model.eos_id()
        self.begins_word = np.array([self.model.id_to_piece(i).startswith("\u2581") for i in range(self.size)])
        self.forget()

    def forget(self) -> None:
        self.index: dict[int, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.int32)
        self.starts = np.zeros(1 << 14, dtype=np.int64)
        self.words = self.used = 0

    def _append(self, ids: list[list[int]]) -> None:
        lengths = np.array([len(x) for x in ids])
        total = int(lengths.sum())
        while self.used + total > len(self.flat):
            self.flat = np.r_[self.flat, np.zeros_like(self.flat)]
        while self.words + len(ids) + 1 > len(self.starts):
            self.starts = np.r_[self.starts, np.zeros_like(self.starts)]
        self.flat[self.used : self.used + total] = np.concatenate([np.array(x, dtype=np.int32) for x in ids])
        self.starts[self.words + 1 : self.words + len(ids) + 1] = self.used + np.cumsum(lengths)
        self.used += total
        self.words += len(ids)

    def split(self, words: Words, distinct: np.ndarray, first: np.ndarray, inverse: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, each row ended, and where each row ends."""
        if self.words > KNOWN_WORDS:
            self.forget()
        keys = distinct.tolist()
        new = [i for i, h in enumerate(keys) if h not in self.index]
        if new:
            texts = [w.lower().decode("utf-8") for w in words.strings(first[new])]
            self.index.update(zip([keys[i] for i in new], range(self.words, self.words + len(new)), strict=True))
            self._append([x or [self.model.unk_id()] for x in self.model.encode(texts, num_threads=1)])
        at = np.fromiter(map(self.index.__getitem__, keys), dtype=np.int64, count=len(keys))
        lengths = (self.starts[at + 1] - self.starts[at])[inverse]
        begins = self.starts[at][inverse]
        rows = len(words.offsets) - 1
        place = np.r_[0, np.cumsum(lengths)]
        shift = np.repeat(np.arange(rows), np.diff(words.offsets))  # one end id for each row before
        total = int(place[-1]) + rows
        ids = np.full(total, self.end, dtype=np.int32)
        target = np.arange(int(place[-1])) + np.repeat(shift, lengths)
        ids[target] = self.flat[np.arange(int(place[-1])) + np.repeat(begins - place[:-1], lengths)]
        return ids, place[words.offsets[1:]] + np.arange(1, rows + 1)


@functools.lru_cache(maxsize=1)
def _pieces(path: str) -> Pieces:
    """One per worker process, whatever the number of tasks it runs."""
    return Pieces(path)


# the model


def start_weights(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shapes = {
        "e": (CLASSES + 1, WIDTH), "p": (WINDOW, WIDTH), "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH),
        "m1": (WIDTH, HIDDEN), "b1": (HIDDEN,), "m2": (HIDDEN, WIDTH), "o": (WIDTH, CLASSES), "b": (CLASSES,),
    }
    return {n: (rng.normal(0, 0.25, s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for n, s in shapes.items()}


def flat(w: dict[str, np.ndarray]) -> np.ndarray:
    """All weights but the ids' own vectors, in one row."""
    return np.concatenate([w[n].ravel() for n in sorted(w) if n != OWN])


def shaped(values: np.ndarray) -> dict[str, np.ndarray]:
    w, at = start_weights(), 0
    for n in sorted(w):
        w[n] = values[at : at + w[n].size].reshape(w[n].shape).astype(np.float32)
        at += w[n].size
    return w


MASK = np.where(np.tril(np.ones((WINDOW, WINDOW), dtype=bool)), 0, -1e9).astype(np.float32)
SCALE = np.float32(1 / math.sqrt(WIDTH))


def attended(w: dict[str, np.ndarray], x_class: np.ndarray, own: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Attention over windows (``[windows, WINDOW]``) of rows of ``e`` and, with ``own``, each place's own vector."""
    x = np.take(w["e"], x_class, axis=0)
    x += w["p"]
    if own is not None:
        x += own
    qkv = x @ projections(w)
    q, k, v = (qkv[:, :, i : i + WIDTH] for i in range(0, 3 * WIDTH, WIDTH))
    a = np.matmul(q, np.ascontiguousarray(k.transpose(0, 2, 1)))
    np.clip(a, -30, 30, out=a)
    a += MASK
    np.exp(a, out=a)
    a /= row_sums(a)[..., None]
    added = np.matmul(a, v)
    return {"x": x, "q": q, "k": k, "v": v, "a": a, "added": added, "h": x + added}


def projections(w: dict[str, np.ndarray]) -> np.ndarray:
    """Queries (scaled), keys and values in one matrix."""
    return np.concatenate([w["q"] * SCALE, w["k"], w["v"]], axis=1)


def row_sums(a: np.ndarray) -> np.ndarray:
    """Sums over the last axis, as a product."""
    return a @ np.ones(a.shape[-1], dtype=a.dtype)


def hidden(w: dict[str, np.ndarray], h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hidden layer at some places and what comes out of it."""
    r = h @ w["m1"]
    r += w["b1"]
    np.maximum(r, 0, out=r)
    z = r @ w["m2"]
    z += h
    return r, z


def forward(w: dict[str, np.ndarray], x_class: np.ndarray, own: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """The whole layer at all places."""
    f = attended(w, x_class, own)
    f["r"], f["z"] = hidden(w, f["h"].reshape(-1, WIDTH))
    return f


def class_scores(w: dict[str, np.ndarray], x_class: np.ndarray, y_class: np.ndarray, scored: np.ndarray) -> np.ndarray:
    """Natural log of P(class | before) at the scored places of some windows (``scored``: flat indexes); ``x_class``: rows of ``e``."""
    _, z = hidden(w, np.take(attended(w, x_class)["h"].reshape(-1, WIDTH), scored, axis=0))
    logits = z @ w["o"]
    logits += w["b"]
    np.clip(logits, -40, 40, out=logits)
    chosen = logits[np.arange(len(scored)), y_class.ravel()[scored]]
    np.exp(logits, out=logits)
    return chosen - np.log(row_sums(logits))


def gradients(w: dict[str, np.ndarray], x_class: np.ndarray, y_class: np.ndarray, own: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Of the mean negative log-likelihood; places with class -1 are not scored. ``OWN``: of each place's own vector."""
    g = place_gradients(w, x_class, y_class, own)
    order = np.argsort(x_class.ravel(), kind="stable")
    met, first = run_starts(x_class.ravel()[order])
    g["e"] = np.zeros_like(w["e"])
    g["e"][met] = np.add.reduceat(g[OWN][order], first, axis=0)
    return g


def run_starts(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of an ordered array and where each begins."""
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[first], first


def place_gradients(w: dict[str, np.ndarray], x_class: np.ndarray, y_class: np.ndarray, own: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """As ``gradients``, without ``e``, whose rows get the sums of ``OWN`` over their places."""
    f = forward(w, x_class, own)
    y = y_class.ravel()
    real = np.flatnonzero(y >= 0)
    d = f["z"] @ w["o"]
    d += w["b"]
    if d.max() > 60 or d.min() < -60:
        d -= d.max(axis=1, keepdims=True)
    np.exp(d, out=d)
    sums = row_sums(d)
    d[real, y[real]] -= sums[real]
    each = ((y >= 0) / (sums * max(1, len(real)))).astype(d.dtype)  # times a row of d: the gradient of its logits
    by_window = np.matmul((f["z"] * each[:, None]).reshape(-1, WINDOW, WIDTH).transpose(0, 2, 1), d.reshape(-1, WINDOW, CLASSES))
    g = {"o": by_window.sum(axis=0), "b": each @ d}
    dz = d @ w["o"].T
    dz *= each[:, None]
    dr = dz @ w["m2"].T
    dr *= f["r"] > 0
    g["m2"], g["m1"], g["b1"] = f["r"].T @ dz, f["h"].reshape(-1, WIDTH).T @ dr, row_sums(dr.T)
    dz += dr @ w["m1"].T
    dh = dz.reshape(f["h"].shape)
    ds = np.matmul(dh, np.ascontiguousarray(f["v"].transpose(0, 2, 1)))
    ds -= np.einsum("ijk,ijk->ij", dh, f["added"])[:, :, None]
    ds *= f["a"]
    parts = np.empty((*x_class.shape, 3 * WIDTH), dtype=dz.dtype)  # of queries, keys and values
    np.matmul(ds, f["k"], out=parts[:, :, :WIDTH])
    np.matmul(ds.transpose(0, 2, 1), f["q"], out=parts[:, :, WIDTH : 2 * WIDTH])
    np.matmul(f["a"].transpose(0, 2, 1), dh, out=parts[:, :, 2 * WIDTH :])
    parts = parts.reshape(-1, 3 * WIDTH)
    projected = f["x"].reshape(-1, WIDTH).T @ parts
    g["q"], g["k"], g["v"] = projected[:, :WIDTH] * SCALE, projected[:, WIDTH : 2 * WIDTH], projected[:, 2 * WIDTH :]
    dz += parts @ projections(w).T
    g["p"], g[OWN] = dh.sum(axis=0), dz
    return g


class Trainer:
    """Adam over batches of windows, of classes or, with ``of`` (the class of each id), of ids with their own vectors.

    An own vector moves only in steps that meet its id.
    """

    def __init__(self, w: dict[str, np.ndarray], own: np.ndarray | None = None, of: np.ndarray | None = None) -> None:
        self.own, self.of = own, of
        if own is not None:
            self.moments = np.zeros((len(own), 2, WIDTH), dtype=own.dtype)  # mean and square of an id's gradients
            self.met = np.zeros(len(own), dtype=np.int64)
            self.by_class = np.argsort(of, kind="stable")
            self.rank = np.empty(len(of), dtype=id_type(len(of)))  # in the order by class
            self.rank[self.by_class] = np.arange(len(of))
        self.all = flat(w)
        self.w, at = {}, 0  # views of all
        for n in sorted(w):
            if n != OWN:
                self.w[n] = self.all[at : at + w[n].size].reshape(w[n].shape)
                at += w[n].size
        self.mean, self.square = np.zeros_like(self.all), np.zeros_like(self.all)
        self.steps = 0

    def step(self, x: np.ndarray, y_class: np.ndarray) -> None:
        self.steps += 1
        if self.own is None:
            found = gradients(self.w, x, y_class)
        else:
            found = place_gradients(self.w, np.take(self.of, x), y_class, np.take(self.own, x, axis=0))
            found["e"] = self._move_own(x.ravel(), found[OWN])
        g = flat(found)
        self.mean += 0.1 * (g - self.mean)
        self.square += 0.01 * (g * g - self.square)
        m = self.mean / (1 - 0.9**self.steps)
        s = self.square / (1 - 0.99**self.steps)
        self.all -= RATE * m / (np.sqrt(s) + 1e-8)

    def _move_own(self, ids: np.ndarray, each: np.ndarray) -> np.ndarray:
        """Move the ids' own vectors; the gradients' sums by class. Places are brought together by id, ids by class."""
        ranks = np.take(self.rank, ids)
        order = np.argsort(ranks, kind="stable")
        met, first = run_starts(np.take(ranks, order))
        met = np.take(self.by_class, met)
        g = np.add.reduceat(np.take(each, order, axis=0), first, axis=0)
        moments = np.take(self.moments, met, axis=0)
        mean, square = moments[:, 0], moments[:, 1]
        mean += np.float32(0.1) * (g - mean)
        square += np.float32(0.01) * (g * g - square)
        self.moments[met] = moments
        move = np.sqrt(square / (1 - 0.99**self.steps))
        move += 1e-8
        np.divide(mean, move, out=move)
        move *= RATE / (1 - 0.9**self.steps)
        self.own[met] -= move
        self.met += np.bincount(ids, minlength=len(self.met))
        classes, start = run_starts(np.take(self.of, met))
        sums = np.zeros_like(self.w["e"])
        sums[classes] = np.add.reduceat(g, start, axis=0)
        return sums


# from documents to windows


def starts_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of documents with these numbers of ids: (document, first place) of each."""
    n = np.where(sizes <= WINDOW, 1, 1 + -(-(sizes - WINDOW) // (WINDOW - OVERLAP)))
    doc = np.repeat(np.arange(len(sizes)), n)
    return doc, (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * (WINDOW - OVERLAP)


def places(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window: flat places of its ids, which of them exist, and which the window scores."""
    begins = np.r_[0, ends[:-1]]
    doc, start = starts_of(ends - begins)
    at = (begins[doc] + start)[:, None] + np.arange(WINDOW)
    real = at < ends[doc][:, None]
    fresh = real & ((np.arange(WINDOW) >= OVERLAP) | (start == 0)[:, None])
    return np.minimum(at, (ends[doc] - 1)[:, None]), real, fresh


def before(ids: np.ndarray, ends: np.ndarray, none: int) -> np.ndarray:
    """The id before each place; ``none`` at the start of a document."""
    x = np.empty_like(ids)
    x[1:] = ids[:-1]
    x[np.r_[0, ends[:-1]]] = none
    return x


def packed_windows(ids: np.ndarray, ends: np.ndarray, size: int) -> pa.Array:
    """Each window as bytes: the id before it, then its ids; the largest number stands where there is none."""
    kind = id_type(size)
    none = np.iinfo(kind).max
    at, real, _ = places(ends)
    both = np.empty((len(at), WINDOW + 1), dtype=kind)
    both[:, 0] = before(ids.astype(np.int64), ends, none)[at[:, 0]]
    both[:, 1:] = np.where(real, ids[at], none)
    offsets = np.arange(len(at) + 1, dtype=np.int32) * both.strides[0]
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(both)])


def unpacked_windows(column: pa.Array, size: int) -> np.ndarray:
    """Rows of ``packed_windows``; -1 where there is no id."""
    kind = id_type(size)
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    found = np.frombuffer(column.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]].view(kind).reshape(-1, WINDOW + 1)
    return np.where(found == np.iinfo(kind).max, -1, found.astype(np.int64))


def id_type(size: int) -> type:
    """The smallest type for the ids of a vocabulary and one number more."""
    return np.uint16 if size < 1 << 16 else np.int32


def distinct_words(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(words.hashes, return_index=True, return_inverse=True)


def _gathered(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Word counts, id counts and all windows of the training documents, a task's words reduced first."""

    def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
        found, inverse = np.unique(all_keys, return_inverse=True)
        return found, np.bincount(inverse, weights=all_counts).astype(np.int64)

    def rows(kind: int, keys: np.ndarray, counts: np.ndarray, windows: pa.Array | None = None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(keys), kind, dtype=np.int32)), pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64)),
            pa.nulls(len(keys), pa.binary()) if windows is None else windows,
        ], names=["kind", "key", "n", "window"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(vocabulary)
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        ids_seen = np.zeros(pieces.size, dtype=np.int64)
        for batch in batches:
            train = batch.filter(pc.invert(batch.column(1)))
            for part in row_slices(train.column(0)):
                words = hash_words(part)
                distinct, first, inverse = distinct_words(words)
                keys.append(distinct.view(np.int64))
                counts.append(np.bincount(inverse, minlength=len(distinct)))
                if sum(map(len, keys)) > 2 * COUNTED_WORDS:
                    found, sums = merged(keys, counts)
                    keys, counts = [found], [sums]
                    if len(found) > COUNTED_WORDS:
                        yield rows(WORD, found, sums)
                        keys, counts = [], []
                ids, ends = pieces.split(words, distinct, first, inverse)
                ids_seen += np.bincount(ids, minlength=pieces.size)
                windows = packed_windows(ids, ends, pieces.size)
                yield rows(WINDOWS, np.zeros(len(windows)), np.ones(len(windows)), windows)
        if keys:
            yield rows(WORD, *merged(keys, counts))
        used = np.flatnonzero(ids_seen)
        yield rows(PIECE, used, ids_seen[used])

    return docs.select("text", "held_out").mapInArrow(run, "kind int, key long, n long, window binary")


@dataclass
class Classes:
    """The class of each id, and the natural logs of P(id | class) and of P(class)."""

    of: np.ndarray
    log_inside: np.ndarray
    log_share: np.ndarray

    @staticmethod
    def fit(counts: np.ndarray, begins_word: np.ndarray) -> Classes:
        """From id counts (one is added to each): frequent ids alone, the others in classes of equal mass."""
        mass = counts + 1.0
        order = np.argsort(-mass, kind="stable")
        of = np.empty(len(mass), dtype=np.int64)
        of[order[:OWN_CLASS]] = np.arange(OWN_CLASS)
        half, first = (CLASSES - OWN_CLASS) // 2, OWN_CLASS
        for kind in (True, False):
            rest = order[OWN_CLASS:][begins_word[order[OWN_CLASS:]] == kind]
            shares = np.cumsum(mass[rest]) / mass[rest].sum()
            of[rest] = first + np.minimum((shares * half).astype(np.int64), half - 1)
            first += half
        whole = np.bincount(of, weights=mass, minlength=CLASSES)
        return Classes(of, np.log(mass / whole[of]), np.log(np.maximum(whole, 1) / whole.sum()))


def _trained(windows: DataFrame, classes: Classes) -> dict[str, np.ndarray]:
    """Rounds of local training and averaging; sums of copies meet in a number of tasks that grows as a root."""
    spark = windows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    none = len(classes.of)  # stands where no id came before
    of = spark.sparkContext.broadcast(np.r_[classes.of, CLASSES])
    weights = start_weights()
    weights["b"] = classes.log_share.astype(np.float32)  # so it starts as good as class counts alone
    weights["o"] *= np.float32(0.2)
    weights[OWN] = np.zeros((none + 1, WIDTH), dtype=np.float32)
    kind = "n long, w binary, met binary, own binary"
    names = ["n", "w", "met", "own"]

    def batch_of(n: int, w: np.ndarray, met: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), *(pa.array([a.tobytes()], pa.binary()) for a in (w, met, own))], names=names)

    def summed(rows: Iterable[tuple[int, bytes, bytes, bytes]]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        n, w, met, own = 0, np.zeros(1), np.zeros(none + 1, dtype=np.int64), np.zeros((none + 1, WIDTH))
        for m, v, k, o in rows:
            n, w = n + m, w + np.frombuffer(v)
            met += np.frombuffer(k, dtype=np.int64)
            own += np.frombuffer(o).reshape(none + 1, WIDTH)
        return n, w, met, own

    for number in range(ROUNDS):
        current = spark.sparkContext.broadcast((flat(weights), weights[OWN]))

        def train(batches: Iterator[pa.RecordBatch], current: Broadcast = current) -> Iterator[pa.RecordBatch]:
            values, own = current.value
            trainer, n = Trainer(shaped(values), own.copy(), of.value), 0
            for batch in batches:
                ids = unpacked_windows(batch.column(0), none)
                x, y = ids[:, :-1], ids[:, 1:]
                x, y = np.where(x < 0, none, x), np.where(y < 0, -1, of.value[y])
                for a in range(0, len(ids), BATCH):
                    trainer.step(x[a : a + BATCH], y[a : a + BATCH])
                n += len(ids)
            if n:
                yield batch_of(n, flat(trainer.w).astype(np.float64) * n, trainer.met, trainer.own.astype(np.float64) * trainer.met[:, None])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = summed(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
            if sums[0]:
                yield batch_of(*sums)

        chosen = windows.filter(F.pmod(F.xxhash64("window"), F.lit(ROUNDS)) == number).select("window").repartition(parts)
        meetings = min(MEETINGS, math.isqrt(parts) + 1)
        copies = chosen.mapInArrow(train, kind).repartition(meetings).mapInArrow(add, kind).collect()
        if copies:
            n, w, met, own = summed(copies)
            kept = weights[OWN]
            weights = shaped(w / n)
            weights[OWN] = np.where(met[:, None] > 0, own / np.maximum(met, 1)[:, None], kept).astype(np.float32)
    return weights


def by_id(weights: dict[str, np.ndarray], of: np.ndarray) -> dict[str, np.ndarray]:
    """The weights with one row of ``e`` for each id, and one for none: its class's vector and its own together."""
    return {**{n: a for n, a in weights.items() if n != OWN}, "e": weights["e"][np.r_[of, CLASSES]] + weights[OWN]}


def _frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and counts of the most frequent words: as many powers of two of counts as fit ``FREQUENT``."""
    bands = counts.groupBy(F.floor(F.log2("n")).alias("band")).agg(F.count(F.lit(1)).alias("words")).collect()
    least, total = 1 << 62, 0
    for r in sorted(bands, key=lambda r: -r["band"]):
        total += r["words"]
        if total > FREQUENT:
            break
        least = 1 << r["band"]
    rows = counts.filter(F.col("n") >= least).toArrow()
    keys, n = rows.column("key").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def score_documents(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Base and model scores of each document; ``vocabulary`` is the path of a sentencepiece model."""
    spark = docs.sparkSession
    checksum = F.crc32(F.coalesce(F.col(quoted(id_column)).cast("string"), F.lit("")).cast("binary"))
    docs = docs.select(F.col(quoted(id_column)).alias("id"), F.col(quoted(text)).alias("text"), (F.pmod(checksum, F.lit(FOLDS)) == HELD_OUT).alias("held_out"))
    gathered = store(_gathered(docs, vocabulary), "lm_gathered")
    sums = gathered.filter(F.col("kind") != WINDOWS).groupBy("kind", "key").agg(F.sum("n").alias("n"))
    counts = store(sums, "lm_counts")
    words = counts.filter(F.col("kind") == WORD).select("key", "n")
    pieces = counts.filter(F.col("kind") == PIECE).select("key", "n").collect()  # at most one row per id
    training_docs = docs.filter("not held_out").count()
    totals = words.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    train_tokens, distinct = totals["n"] + training_docs, totals["v"] + (training_docs > 0)
    own_pieces = Pieces(vocabulary)
    id_counts = np.zeros(own_pieces.size)
    for r in pieces:
        id_counts[r["key"]] = r["n"]
    classes = Classes.fit(id_counts, own_pieces.begins_word)
    weights = _trained(gathered.filter(F.col("kind") == WINDOWS), classes)
    shared = spark.sparkContext.broadcast((_frequent(words), by_id(weights, classes.of), classes))
    end_known = int(training_docs > 0)
    end_share = math.log10(training_docs + 1)
    each = math.log10(train_tokens + distinct + 1)

    schema = StructType([StructField("id", docs.schema["id"].dataType)])
    for name, kind in (("held_out", "boolean"), ("row", "long"), ("n_tokens", "long"), ("n_known", "long"), ("common", "double"), ("score", "double")):
        schema = schema.add(name, kind)
    schema = schema.add("rare", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = _pieces(vocabulary)
        (frequent, n), w, cl = shared.value
        gain = np.log10(n + 1.0)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            parts = [_scored(part, own, frequent, gain, w, cl) for part in row_slices(batch.column(1))]
            sizes, known, common, score, rare = (sum(x, []) for x in zip(*parts, strict=True))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array(np.arange(row, row + batch.num_rows)), pa.array(sizes, pa.int64()),
                pa.array(known, pa.int64()), pa.array(common, pa.float64()), pa.array(score, pa.float64()), pa.array(rare, pa.binary()),
            ], names=schema.names)
            row += batch.num_rows

    scored = store(docs.select("id", "text", "held_out").mapInArrow(run, schema), "lm_scored")
    added = _rare_words(scored, words)
    known = F.col("n_known") + F.coalesce("rare_known", F.lit(0)) + end_known
    base = F.col("common") + F.coalesce("rare_gain", F.lit(0.0)) + end_share - F.col("n_tokens") * each
    return scored.join(added, "row", "left").select(
        F.col("id").alias(id_column), "held_out", "n_tokens", known.alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )


def _scored(
    part: pa.Array, own: Pieces, frequent: np.ndarray, gain: np.ndarray, w: dict[str, np.ndarray], classes: Classes
) -> tuple[list, list, list, list, list]:
    """Of some rows: tokens, known common words, their log10 counts, the model's score, hashes of the other words."""
    words = hash_words(part)
    rows = len(words.offsets) - 1
    distinct, first, inverse = distinct_words(words)
    owner = words.rows()
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, distinct), len(frequent) - 1)
        found = frequent[at] == distinct
        gains = np.where(found, gain[at], 0.0)[inverse]
    else:
        found, gains = np.zeros(len(distinct), dtype=bool), np.zeros(len(inverse))
    is_common = found[inverse]
    common = np.bincount(owner, weights=gains, minlength=rows)
    known = np.bincount(owner, weights=is_common, minlength=rows).astype(np.int64)
    rare = words.hashes[~is_common].tobytes()
    cut = (np.r_[0, np.cumsum(np.bincount(owner[~is_common], minlength=rows))] * 8).tolist()

    ids, ends = own.split(words, distinct, first, inverse)
    target = classes.of[ids]
    source = before(ids, ends, len(classes.of))
    at, _, fresh = places(ends)
    scores = classes.log_inside[ids]
    for a in range(0, len(at), 128):
        place = at[a : a + 128]
        new = np.flatnonzero(fresh[a : a + 128].ravel())
        scores[place.ravel()[new]] += class_scores(w, source[place], target[place], new)
    sums = np.r_[0, np.cumsum(scores)]
    score = (sums[ends] - sums[np.r_[0, ends[:-1]]]) / math.log(10)
    sizes = np.diff(words.offsets) + 1
    return sizes.tolist(), known.tolist(), common.tolist(), score.tolist(), [rare[a:b] for a, b in zip(cut, cut[1:], strict=False)]


def _rare_words(scored: DataFrame, words: DataFrame) -> DataFrame:
    """Per row, log10 counts of the words that are not common: they meet the table of all counts."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [np.frombuffer(b, dtype=np.int64) for b in batch.column(1).to_pylist()]
            rows = np.repeat(batch.column(0).to_numpy(), [len(h) for h in hashes])
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(np.concatenate(hashes))], names=["row", "key"])

    each = scored.select("row", "rare").mapInArrow(spread, "row long, key long")
    met = each.join(words, "key").groupBy("row")
    return met.agg(F.count(F.lit(1)).alias("rare_known"), F.sum(F.log10(F.col("n") + 1)).alias("rare_gain"))
