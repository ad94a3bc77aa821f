"""Targets by repeated resharing, certain copies and the ranking against plain Python."""

import math
import random

import pytest

from clientele.llm.source_mix import MOST_COPIES, filled, mix, mixture

WEIGHTS = [5, 2, 1]


def reshared(sizes, weights, most, total):
    """Deal by weight; whoever is above its limit keeps that, and the excess is dealt again among the others."""
    fixed = {}
    while True:
        free = [k for k in sizes if k not in fixed]
        left, weight = total - sum(fixed.values()), sum(weights[k] for k in free)
        share = {k: left * weights[k] / weight for k in free} if weight else {}
        over = [k for k in free if share[k] > most[k] + 1e-9]
        if not over:
            return fixed | share
        fixed |= {k: most[k] for k in over}


def words(text):
    return len([w for w in (text or "").encode().split()])


def by_source(rows):
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    return sizes


def corpus(n, seed=3):
    rng = random.Random(seed)
    sources = ["a", "b", "c", "d", "é", None]
    rows = []
    for i in range(n):
        source = "a" if i % 3 == 0 else rng.choice(sources)
        length = rng.choice([0, 3, 20, 40, 200]) if source != "d" else 2
        rows.append((i, source, " ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=length))))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_filled_deals_as_repeated_resharing(spark, seed):
    rng = random.Random(seed)
    weights = {k: rng.choice([1, 2, 5, 0.5]) for k in range(9)}
    most = {k: rng.choice([0, 1, 5, 50, 400]) for k in range(9)}
    total = min(120, sum(most.values()))
    items = spark.createDataFrame([(k, weights[k] * 1.0, most[k], total) for k in range(9)], "k int, w double, m long, t long")
    got = {r.k: r.share for r in filled(items, [], "w", "m", "t").collect()}
    want = reshared(dict.fromkeys(range(9), 0), weights, most, total)
    assert got == pytest.approx(want)


def test_taken_words_end_just_below_the_targets(spark):
    rows = corpus(900)
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    got = mix(docs, WEIGHTS).collect()
    assert len(got) == len(rows)
    sizes = by_source(rows)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    want = reshared(sizes, weights, {s: MOST_COPIES * n for s, n in sizes.items()}, sum(sizes.values()))
    text_of = {i: text for i, _, text in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["size"] == words(text_of[r.doc_id]) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= MOST_COPIES
        taken[r.source] += r.taken
    for s, target in want.items():
        assert taken[s] <= target + 1e-6
        assert target - taken[s] <= max(0.005 * target, 20)  # far less than the largest documents' 200 words
    again = {r.doc_id: r.taken for r in mix(docs.repartition(3), WEIGHTS).collect()}
    assert again == {r.doc_id: r.taken for r in got}


def test_words_of_little_variety_are_taken_less(spark):
    rows = [(i, "s" if i < 800 else "t", " ".join(f"w{k}" for k in range(30)) if i % 2 else "x " * 30) for i in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = [r for r in mix(docs, [1, 9]).collect() if r.source == "s"]
    share = [sum(r.copies for r in got if r.doc_id % 2 == k) for k in (0, 1)]
    assert share[1] > 2.5 * share[0] > 0  # inclusion odds of 1 to 4 in quarters


def test_odd_rows_clashes_and_empty_tables(spark, odd_rows, with_clashes):
    rows = [(i, None if i is None else "s" if i % 2 else None, t) for i, t in odd_rows]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "1 as target", "2 as _size"))
    got = mix(docs, WEIGHTS).collect()
    assert len(got) == len(rows) and all(r.taken == r.copies * r["size"] for r in got)
    assert all(r.taken == 0 for r in got if r["size"] == 0)
    assert all(r["_size"] == 2 and r.kept == "x" for r in got)
    assert mix(docs.limit(0), WEIGHTS).collect() == []
    mixed = mixture(docs, WEIGHTS)
    assert mixed.columns == docs.columns
    assert sum(words(r.text) for r in mixed.collect()) == sum(r.taken for r in got)


def test_a_single_source_gets_all_its_words_once(spark):
    docs = spark.createDataFrame([(i, "s", "a b c d") for i in range(50)], "doc_id long, source string, text string")
    assert {r.copies for r in mix(docs, WEIGHTS).collect()} == {1}
    assert math.isclose(mix(docs, WEIGHTS).first().target, 200)
