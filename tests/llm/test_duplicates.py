"""Line dedup, n-gram join, components and decontamination against brute force."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clientele.llm import line_dedup
from clientele.llm.arrow import hash_words
from clientele.llm.components import connected_components
from clientele.llm.decontamination import AGREEMENT, Index, find_overlaps, keep_clean
from clientele.llm.line_dedup import without_repeats
from clientele.llm.ngram_join import COUNTERS, OTHER_ORDERS, may_link, one_of_each, required, signature, similar_documents
from clientele.sources.storage import store


def line_corpus():
    rng = random.Random(3)
    lines = [" ".join(f"a{rng.randrange(9)}" for _ in range(rng.randrange(1, 6))) for _ in range(8)] + ["", " "]
    blocks = [[rng.choice(lines) for _ in range(rng.randrange(2, 12))] for _ in range(6)]
    rows = []
    for i in range(40):
        d = []
        for _ in range(rng.randrange(0, 4)):
            d += rng.choice(blocks) if rng.random() < 0.6 else rng.choices(lines, k=3)
        rows.append((i, "\n".join(d)))
    return rows + [rows[5], rows[5], (None, rows[7][1]), (100, None), (102, "x y z " * 30), (103, "x y z " * 30), (3, "q\n" + rows[9][1])]


def longest_earlier_runs(rows, hashes, min_words):
    """For each distinct document the deleted lines, comparing every place with every earlier one."""
    docs = []
    for i, t in set(rows):
        docs.append((i, t, [(n, line) for n, line in enumerate((t or "").split("\n")) if line.encode().split()]))
    docs.sort(key=lambda d: (float("-inf") if d[0] is None else d[0], hashes[d[1]]))
    gone = {}
    for a, (i, t, own) in enumerate(docs):
        deleted = set()
        for k in range(len(own)):
            best = 0
            for b in range(a + 1):
                other = docs[b][2]
                for m in range(len(other) if b < a else k):
                    n = 0
                    while k + n < len(own) and m + n < len(other) and own[k + n][1] == other[m + n][1]:
                        n += 1
                    best = max(best, n)
            if best and sum(len(own[k + x][1].split()) for x in range(best)) >= min_words:
                deleted |= set(range(k, k + best))
        gone[i, t] = [own[x][0] for x in sorted(deleted)]
    return gone


@pytest.mark.parametrize("min_words", [1, 12])
def test_deleted_lines_match_brute_force(spark, documents, with_clashes, min_words):
    rows = line_corpus()
    texts = spark.createDataFrame([(t,) for t in {t for _, t in rows}], "t string")
    hashes = dict(texts.select("t", F.xxhash64("t")).collect())
    expected = longest_earlier_runs(rows, hashes, min_words)
    docs = with_clashes(documents(rows)).withColumn("whole", F.col("text"))
    got = without_repeats(docs, min_words).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.deleted == expected[r.doc_id, r.whole], (r.doc_id, r.whole)
        left = [line for n, line in enumerate((r.whole or "").split("\n")) if n not in set(r.deleted)]
        if r.deleted and len(r.deleted) == r.n_lines:
            assert r.text == ""
        elif r.deleted:
            assert r.text == "\n".join(left)
        else:
            assert r.text == r.whole


def test_odd_rows_survive_line_dedup(documents, odd_rows):
    assert without_repeats(documents([])).count() == 0
    got = without_repeats(documents(odd_rows)).collect()
    assert len(got) == len(odd_rows) and sum(r.text is None for r in got) == sum(t is None for _, t in odd_rows)


def test_texts_are_split_into_lines_once(spark, documents, tmp_path, monkeypatch):
    path = str(tmp_path / "documents.parquet")
    run = " ".join(f"word{i}" for i in range(40))
    documents([(i, f"own line {i}\n{run}\nsecond {run}") for i in range(6)] + [(7, None)]).write.parquet(path)
    readers = []

    def kept(df, name, *rest):
        readers.append((name, any("documents.parquet" in f for f in df.inputFiles())))
        return store(df, name, *rest)

    monkeypatch.setattr(line_dedup, "store", kept)
    copies = line_dedup.later_copies(spark.read.parquet(path))
    assert [name for name, reads in readers if reads] == ["lines"]
    assert {r["d"] for r in copies.collect()} == {1, 2, 3, 4, 5}


def shingles(t):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components_by_all_pairs(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, s in enumerate(sets):
        for j in range(k):
            if s and 100 * len(s & sets[j]) >= 75 * len(s | sets[j]):
                a, b = find(j), find(k)
                parent[max(a, b)] = min(a, b)
    smallest = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            smallest[find(k)].append(i)
    return Counter((i, len(sets[k]), (min(smallest[find(k)], default=None) if sets[k] else i)) for k, (i, _) in enumerate(rows))


def near_copies(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(8):
        base = rng.choices(words, k=rng.choice([5, 8, 30, 60, 120]))
        for _ in range(rng.choice([1, 3, 40])):
            d = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                d[rng.randrange(len(d))] = rng.choice(words)
            if rng.random() < 0.3:
                d = d[: max(1, len(d) - rng.randrange(6))]
            rows.append((len(rows), " ".join(d).upper() if rng.random() < 0.1 else "  ".join(d)))
    passage = rng.choices(words, k=50)  # shared by many documents, of which few are similar
    rows += [(len(rows) + i, " ".join(passage + rng.choices(words, k=rng.randrange(1, 30)))) for i in range(70)]
    rng.shuffle(rows)
    return rows


def test_components_match_all_pairs(documents, odd_rows, with_clashes):
    rows = near_copies(5) + [(None if i is None else 5000 + i, t) for i, t in odd_rows]
    docs = with_clashes(documents(rows))
    assert Counter(tuple(r) for r in similar_documents(docs).collect()) == components_by_all_pairs(rows)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    expected = {i for i, _, c in components_by_all_pairs(rows) if i == c}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(expected | {None} if None in expected else expected)


def test_join_of_empty_and_unlinked_tables(documents):
    assert similar_documents(documents([])).count() == 0
    assert {tuple(r) for r in similar_documents(documents([(1, "a b c d e f"), (2, "q")])).collect()} == {(1, 2, 1), (2, 1, 2)}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 200), (300, 200), (250, 300)]
    rng.shuffle(links)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 250: 200, 300: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def contamination_case(spark):
    rng = random.Random(9)
    words = [f"v{i}" for i in range(2000)]
    items = [(i, " ".join(rng.choices(words, k=n))) for i, n in enumerate([15, 20, 40, 8, 12, 3])] + [(90, None), (91, "")]
    docs, expected = [], set()
    for i in range(60):
        d = rng.choices(words, k=rng.randrange(0, 80))
        if i % 2:
            item = items[i % 6][1].split()
            changed = list(item)
            if len(item) >= 20:
                changed[7] = changed[15] = "changed"
            at = rng.randrange(len(d) + 1)
            d[at:at] = [w.upper() for w in changed]
            if len(item) >= 6:
                expected.add((i, i % 6))
        docs.append((i, " ".join(d)))
    docs += [(100, None), (101, ""), (None, items[1][1]), (1, docs[1][1])]
    return docs, spark.createDataFrame(items, "item_id int, text string"), expected


def test_overlaps_with_substitutions_are_found_and_nothing_else(spark, documents, with_clashes):
    rows, benchmark, expected = contamination_case(spark)
    docs = with_clashes(documents(rows))
    got = find_overlaps(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected | {(None, 1)}
    assert all(0.75 <= r.share <= 1 for r in got)
    clean = keep_clean(docs, benchmark)
    dirty = {i for i, _ in expected} | {None}
    assert clean.columns == docs.columns and Counter(r.doc_id for r in clean.collect()) == Counter(i for i, _ in rows if i not in dirty)


def test_blocks_of_items_give_the_same_overlaps(spark, documents, monkeypatch):
    rows, benchmark, expected = contamination_case(spark)
    monkeypatch.setattr("clientele.llm.decontamination.BLOCK_CHARACTERS", 100)
    assert {(r.doc_id, r.item_id) for r in find_overlaps(documents(rows), benchmark).collect()} == expected | {(None, 1)}
    assert find_overlaps(documents([]), benchmark).count() == 0
    assert find_overlaps(documents(rows), benchmark.limit(0)).count() == 0
    assert keep_clean(documents(rows), benchmark.limit(0)).count() == len(rows)


@pytest.mark.parametrize("length", [6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 18])
def test_every_choice_of_changed_words_is_found(length):
    """As many words as the agreement allows may differ, whichever they are; one more in the best window is too many."""
    item = [f"i{k}" for k in range(length)]
    window = min(length, 15)
    may_differ = window - -(-AGREEMENT * window // 100)
    index = Index([" ".join(item)])
    texts = []
    for changed in combinations(range(window), may_differ):
        texts.append("before it " + " ".join("other" if k in changed else w for k, w in enumerate(item)) + " after it")
    found = {row for row, *_ in index.verified(hash_words(pa.array(texts)))}
    assert found == set(range(len(texts)))
    few = [w if k % 2 else "other" for k, w in enumerate(item)]
    assert not list(index.verified(hash_words(pa.array([" ".join(few)]))))


def test_a_passage_cut_by_an_end_of_the_document_counts_its_agreeing_words(spark, documents):
    item = [f"i{k}" for k in range(20)]
    other = [f"o{k}" for k in range(30)]
    cases = {
        1: item[-12:] + other, 2: other + item[:12], 3: item[4:16], 4: other + item[4:16] + other, 5: other + item[:14],
        6: [*item[-13:-6], "x", *item[-5:], *other], 7: item[-11:] + other, 8: [*item[-12:-6], "x", *item[-5:], *other], 9: other + item[:11],
    }
    benchmark = spark.createDataFrame([(0, " ".join(item))], "item_id int, text string")
    docs = documents([(i, " ".join(d)) for i, d in cases.items()])
    assert {r.doc_id for r in find_overlaps(docs, benchmark).collect()} == {1, 2, 3, 4, 5, 6}
    assert {r.doc_id for r in keep_clean(docs, benchmark).collect()} == {7, 8, 9}


def test_short_items_are_found_with_the_words_that_may_differ(spark, documents):
    items = {n: [f"s{n}x{k}" for k in range(n)] for n in range(5, 12)}
    rows, expected = [], set()
    for n, item in items.items():
        for x in range(n):
            for y in range(x, n):
                for z in {y, n - 1}:
                    d = [f"o{k}" if k in (x, y, z) else w for k, w in enumerate(item)]
                    rows.append((len(rows), " ".join(["before", *d, "after"])))
                    if n >= 6 and 100 * (n - len({x, y, z})) >= 80 * n:
                        expected.add((len(rows) - 1, n))
    for at in (slice(1, None), slice(None, -1)):
        rows.append((len(rows), " ".join(items[6][at])))
        expected.add((len(rows) - 1, 6))
    benchmark = spark.createDataFrame([(n, " ".join(item)) for n, item in items.items()], "item_id int, text string")
    assert {(r.doc_id, r.item_id) for r in find_overlaps(documents(rows), benchmark).collect()} == expected


def test_orders_reject_no_similar_sets():
    rng = np.random.default_rng(5)
    levels = rng.integers(0, 9, COUNTERS).astype(np.uint8)
    linked = rejected = 0
    for _ in range(3000):
        n = int(rng.integers(1, 60))
        shared = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        own = [rng.integers(0, 1 << 63, int(rng.integers(0, n // 2 + 1)), dtype=np.uint64) for _ in range(2)]
        a, b = (np.unique(np.concatenate([shared, x])) for x in own)
        common = len(np.intersect1d(a, b))
        for seed, rare in OTHER_ORDERS:
            x, y = (signature(s, levels if rare else None, seed) for s in (a, b))
            passes = may_link(x, len(a), y, len(b))
            if common >= required(len(a), len(b)):
                linked += 1
                assert passes
            else:
                rejected += not passes
    assert linked > 500 and rejected > 100
