"""Byte-pair encoding and decoding by batched numpy merge rounds.

The symbols of many words stand in one flat array. A round looks every adjacent pair up by binary search in the
sorted pair keys, takes each word's lowest rank and merges all its pairs of that rank at once; rounds end when no
word has a known pair left. Workers keep a bounded table of words already encoded.

The tokenizer file (path parameter) gives the vocabulary, the merges, the end-of-word suffix, the special tokens,
the splitting pattern and the normalization. Texts of plain Latin characters are normalized and split here; texts
with any other character go through the file's own normalizer and pre-tokenizer, so that Unicode tables agree.

Defined results: NULL or empty text: no ids, empty decoded text. Strings of special tokens inside a text become
their ids. A document's result depends on its text alone, so repeated rows have equal results; columns of the
input named like a result are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from clientele.llm.arrow import map_columns, texts

CACHE_UNITS = 250_000
BATCH_CHARACTERS = 1 << 20  # characters of words merged at once, or one word
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xff]*")  # characters on which all Unicode tables agree


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next code points from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def plain_pattern(pattern: str) -> str:
    """A splitting pattern for plain texts in the standard library's syntax: letter and number classes spelled out."""
    latin = [chr(c) for c in range(256)]
    for name in (r"\p{L}", r"\p{N}"):
        pattern = pattern.replace(name, "".join(re.escape(c) for c in latin if regex.fullmatch(name, c)))
    return pattern


class WordBpe:
    """Encoder and decoder of one tokenizer file with word ends."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*vocab.values(), *self.specials.values()]))
        for token, i in [*vocab.items(), *self.specials.items()]:
            self.tokens[i] = token
        longest_first = sorted(self.specials, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.plain = re.compile(plain_pattern(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]))
        self.names = [str(i) for i in range(len(self.tokens))]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters])
        self.last = np.array([vocab[c + self.suffix] for c in letters])
        self.bytes_of = {c: b for b, c in enumerate(letters)}
        self.base = len(self.tokens)
        pairs = [(vocab[a] * self.base + vocab[b], rank, vocab[a + b]) for rank, (a, b) in enumerate(model["merges"])]
        pairs.sort()
        self.keys, self.ranks, self.merged = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True))
        self.numbers: dict[str, str] = {}
        self.decoded: dict[str, str] = {}

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (bytes, none empty) one after the other, and the number of ids of each.

        Merge rounds over all words at once: symbols of finished words leave, the others merge their lowest pair.
        """
        lengths = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols = self.inner[flat]
        final = np.cumsum(lengths) - 1
        symbols[final] = self.last[flat[final]]
        owner = np.repeat(np.arange(len(words)), lengths)
        done = []
        never = len(self.keys)
        while len(symbols):
            key = symbols[:-1] * self.base + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), never - 1)
            rank = np.full(len(symbols), never)
            rank[:-1] = np.where((self.keys[at] == key) & (owner[:-1] == owner[1:]), self.ranks[at], never)
            starts = np.r_[True, owner[1:] != owner[:-1]]
            lowest = np.minimum.reduceat(rank, np.flatnonzero(starts))[np.cumsum(starts) - 1]
            still = lowest < never
            done.append((owner[~still], symbols[~still]))
            hit = np.flatnonzero((rank == lowest) & still)
            run_start = np.r_[True, np.diff(hit) > 1][: len(hit)]  # of overlapping pairs in a row, every second one merges
            order = np.arange(len(hit))
            hit = hit[(order - np.maximum.accumulate(np.where(run_start, order, 0))) % 2 == 0]
            symbols[hit] = self.merged[at[hit]]
            still[hit + 1] = False
            symbols, owner = symbols[still], owner[still]
        owner, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
        return symbols[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def ids_of(self, sequences: list[list[str]]) -> Iterator[list[int]]:
        """Ids of each sequence of words (pieces of the splitting pattern)."""
        start = size = 0
        for i, words in enumerate(sequences):
            size += sum(map(len, words))
            if size > BATCH_CHARACTERS or i == len(sequences) - 1:
                part = sequences[start : i + 1]
                ids: list[int] = []
                counts = np.zeros(0, dtype=np.int64)
                if flat := [w.encode() for words in part for w in words]:
                    symbols, counts = self.merge(flat)
                    ids = symbols.tolist()
                ends = np.r_[0, np.cumsum(counts)][np.cumsum([len(words) for words in part])].tolist()
                for a, b in zip([0, *ends], ends, strict=False):
                    yield ids[a:b]
                start, size = i + 1, 0

    def learn(self, units: list[str]) -> None:
        """Enter the units' ids and decoded text into the tables. A unit is a run without white space."""
        names, tokens = self.names, self.tokens
        for unit, ids in zip(units, self.ids_of([self.plain.findall(u) for u in units]), strict=True):
            self.numbers[unit] = " ".join([names[i] for i in ids])
            self.decoded[unit] = " ".join([tokens[i] for i in ids])

    def split(self, text: str) -> tuple[bool, list[str]]:
        """Units of a text without special tokens, in order, and whether they are still to be split by the pattern."""
        if PLAIN.fullmatch(text):
            return True, text.lower().split()
        letters = self.bytes_of
        pieces = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
        return False, [bytes([letters[c] for c in piece]).decode("utf-8") for piece, _ in pieces]

    def encode_batch(self, batch: list[str]) -> list[tuple[str, str]]:
        """Ids as decimal text and decoded text of every text."""
        whole = [t if self.special is None else self.special.split(t) for t in batch]
        plain = [self.split(t) if isinstance(t, str) else self.split(t[0]) if len(t) == 1 else None for t in whole]
        units = {u for p in plain if p and p[0] for u in p[1]}
        missing = units.difference(self.numbers)
        if len(self.numbers) + len(missing) > CACHE_UNITS:
            kept = units.intersection(self.numbers)  # whatever is frequent occurs in this batch too
            self.numbers = {u: self.numbers[u] for u in kept}
            self.decoded = {u: self.decoded[u] for u in kept}
        self.learn(list(missing))
        number, decoded = self.numbers.__getitem__, self.decoded.__getitem__
        return [
            (" ".join(map(number, p[1])), " ".join(map(decoded, p[1]))) if p and p[0] else self.by_library_rules(t)
            for t, p in zip(whole, plain, strict=True)
        ]

    def by_library_rules(self, parts: str | list[str]) -> tuple[str, str]:
        """A text with special tokens, or with characters outside the plain ones."""
        ids: list[int] = []
        for i, part in enumerate([parts] if isinstance(parts, str) else parts):
            if i % 2:
                ids.append(self.specials[part])
                continue
            plain, pieces = self.split(part)
            words = [w for p in pieces for w in self.plain.findall(p)] if plain else pieces
            ids += next(self.ids_of([words]))
        return " ".join(map(str, ids)), self.decode(ids)

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.encode_batch([text])[0][0].split()]

    def decode(self, ids: list[int]) -> str:
        """The tokens' strings joined by spaces: the file names no decoder."""
        return " ".join([self.tokens[i] for i in ids])


def encode_documents(docs: DataFrame, tokenizer: str, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """Add ``n_tokens``, ``ids`` (array) and ``decoded`` to each document."""

    def finish(found: list[tuple[str, str]]) -> list[pa.Array]:
        ids = [list(map(int, e[0].split())) for e in found]
        return [sizes(found), pa.array(ids, pa.list_(pa.int32())), pa.array([e[1] for e in found], pa.string())]

    return _encoded(docs, tokenizer, keep, text, "n_tokens long, ids array<int>, decoded string", finish)


def encode_digests(docs: DataFrame, tokenizer: str, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``: what ``encode_documents`` gives, as digests."""

    def finish(found: list[tuple[str, str]]) -> list[pa.Array]:
        digests = ([hashlib.sha256(e[i].encode()).hexdigest() for e in found] for i in (0, 1))
        return [sizes(found), *[pa.array(d, pa.string()) for d in digests]]

    return _encoded(docs, tokenizer, keep, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", finish)


def sizes(found: list[tuple[str, str]]) -> pa.Array:
    return pa.array([e[0].count(" ") + 1 if e[0] else 0 for e in found], pa.int64())


@functools.lru_cache(maxsize=2)
def _loaded(tokenizer: str) -> WordBpe:
    """One per worker process, with its tables, whatever the number of tasks it runs."""
    return WordBpe(tokenizer)


def _encoded(
    docs: DataFrame, tokenizer: str, keep: list[str] | None, text: str, fields: str,
    finish: Callable[[list[tuple[str, str]]], list[pa.Array]],
) -> DataFrame:
    def start() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        bpe = _loaded(tokenizer)

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            columns = [finish(bpe.encode_batch(part)) for part in parts_of(texts(batch, text))]
            return [pa.concat_arrays(list(same)) for same in zip(*columns, strict=True)]

        return compute

    return map_columns(docs, docs.columns if keep is None else keep, fields, start, needs=[text])


def parts_of(batch: list[str], size: int = 1 << 20) -> Iterator[list[str]]:
    """Consecutive parts of at most ``size`` characters, or one text."""
    part: list[str] = []
    total = 0
    for text in batch:
        if part and total + len(text) > size:
            yield part
            part, total = [], 0
        part.append(text)
        total += len(text)
    if part:
        yield part
