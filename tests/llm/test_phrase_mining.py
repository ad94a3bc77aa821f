"""Filters as exact round trips; collocations against plain Python counts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from clientele.llm import phrase_mining
from clientele.llm.phrase_mining import Filter, _collapsed, _turned, collocations, packed, unpacked

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    """(lang, rank, phrase, a, l, r, n, score) counted over lists of words."""
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            sizes[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i : i + k]))
                    counts[key] = counts.get(key, 0) + 1
    found = {}
    for (lang, words), a in counts.items():
        if len(words) > 1 and a >= least:
            cuts = [(counts[lang, words[:c]], counts[lang, words[c:]]) for c in range(1, len(words))]
            score, _, l, r = min((2000000 * a // (l + r), c, l, r) for c, (l, r) in enumerate(cuts))
            found[lang, words] = (a, l, r, score)
    dropped = set()
    for (lang, words), (whole, *_) in found.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                inner = (lang, words[i : i + size])
                if 100 * whole >= 80 * found[inner][0]:
                    dropped.add(inner)
    result = []
    for lang in sizes:
        mine = [(-s, -a, " ".join(w).encode(), l, r) for (g, w), (a, l, r, s) in found.items() if g == lang and (g, w) not in dropped]
        for rank, (s, a, p, l, r) in enumerate(sorted(mine)[:top], 1):
            result.append((lang, rank, p.decode(), -a, l, r, sizes[lang], -s))
    return sorted(result)


def got(df):
    return sorted(map(tuple, df.collect()))


def prose(rng):
    said = ["new york", "as soon as possible", "in front of", "Kind regards", "é è", "x y z"]
    words = [rng.choice([rng.choice(said), rng.choice("abcdefg"), "the", "word" + str(rng.randrange(30))]) for _ in range(rng.randrange(60))]
    return "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\r\n"]) for w in words)


@pytest.mark.parametrize(("least", "top", "part_words"), [(30, 2000, 1 << 21), (4, 7, 500), (2, 40, 100)])
def test_collocations_match_brute_force(spark, monkeypatch, least, top, part_words):
    monkeypatch.setattr(phrase_mining, "PART_WORDS", part_words)
    rng = random.Random(least)
    rows = [(rng.choice(["en", "en", "fr", None, "und"]), prose(rng)) for _ in range(400)]
    rows += [("en", None), ("en", ""), (None, " \n"), ("qq", None), ("de", "only once here"), ("en", "new york " * 3000), *rows[:5]]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    assert got(collocations(docs, top, least)) == brute(rows, least, top)


def test_all_phrases_without_a_top(spark):
    rows = [("en", "a b c d e f. a b c d, " * 3)] * 3
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert got(collocations(docs, None, 2)) == brute(rows, 2, 10**6)


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([], "lang string, text string, phrase string, n int")
    assert collocations(docs).collect() == []
    rows = [("en", "a b " * 50)] * 2
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 as n", "'x' as phrase", "2 as words", "3 as `a b``c`")
    assert got(collocations(docs)) == brute(rows, 30, 2000)


@pytest.mark.parametrize("width", [40, 48, 56, 64])
@pytest.mark.parametrize("words", [2, 3, 4])
def test_permutation_and_packing_lose_nothing(words, width):
    rng = np.random.default_rng(words * width)
    for n, part_bits in ((1, 0), (1, 5), (700, 0), (9000, 3)):
        lanes = [rng.integers(0, 1 << 20, n, dtype=np.uint64) << np.uint64(width - 20) for _ in range(words)]
        turned = _turned(lanes, width)
        assert all((a == b).all() for a, b in zip(_turned(turned, width, back=True), lanes, strict=True))
        part = 1 if part_bits else 0
        if part_bits:
            turned[0] = turned[0] & np.uint64((1 << (width - part_bits)) - 1) | np.uint64(part << (width - part_bits))
        sorted_lanes, counts = _collapsed(turned, rng.integers(1, 600, n))
        back, n_back = unpacked(packed(sorted_lanes, counts, width, part_bits), words, width, part_bits, part)
        assert all((a == b).all() for a, b in zip(back, sorted_lanes, strict=True)) and (n_back == counts).all()


def test_filters_count_exactly_when_they_are_handed_on_in_between(monkeypatch):
    monkeypatch.setattr(phrase_mining, "FILTER_ENTRIES", 64)
    rng = np.random.default_rng(5)
    f, want, have = Filter(2, 40, 2), Counter(), Counter()

    def read(handed):
        for words, part, raw in handed:
            lanes, counts = unpacked(raw, words, 40, 2, part)
            for x, y, n in zip(*[lane.tolist() for lane in _turned(lanes, 40, back=True)], counts.tolist(), strict=True):
                have[x, y] += n

    for _ in range(60):
        lanes = [rng.integers(0, 12, 50).astype(np.uint64) for _ in range(2)]
        want.update(zip(*[lane.tolist() for lane in lanes], strict=True))
        read(f.add(lanes))
    read(f.handed())
    assert have == want


def test_equal_first_lanes_of_different_ngrams_stay_apart():
    lanes = [np.array([5, 5, 5, 1], dtype=np.uint64), np.array([2, 1, 2, 9], dtype=np.uint64)]
    (first, second), counts = _collapsed(lanes, np.ones(4, dtype=np.int64))
    assert list(zip(first.tolist(), second.tolist(), counts.tolist(), strict=True)) == [(1, 9, 1), (5, 1, 1), (5, 2, 2)]
