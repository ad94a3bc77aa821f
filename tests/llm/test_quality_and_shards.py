"""Quality statistics, learned rules and sharding against plain Python."""

import random
import zlib
from collections import Counter, defaultdict

from clientele.llm.histogram_sort import shard_by_bytes
from clientele.llm.quality_rules import Condition, keep_good, learn, quality_report, text_counts


def base(t):
    words = [w.decode() for w in (t or "").encode().split()]
    triples = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {p for i in range(len(words) - 2) if triples[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(covered)


def test_counts_match_brute_force(documents, odd_rows, with_clashes):
    rng = random.Random(2)
    rows = odd_rows + [(100 + i, " ".join(rng.choices("abcd|", k=rng.randrange(60)))) for i in range(60)]
    got = text_counts(with_clashes(documents(rows))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(r.text)


def prose(rng, n=80):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 8))) for _ in range(n))


def labelled_corpus(spark, documents):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(300):
        bad = i % 3 == 0
        text = prose(rng)
        rows.append((i, text.replace(" ", "### ") if bad and i % 2 else text.upper() + "!" if bad else text))
        if i < 240:
            labels.append((i, int(not bad)))
    rows += [(900, None), (901, "short"), (0, rows[0][1])]
    return documents(rows), spark.createDataFrame([*labels, (5000, 0), (None, 0), (7, None)], "doc_id long, quality int")


def test_rules_separate_bad_documents(spark, documents):
    docs, labels = labelled_corpus(spark, documents)
    report = quality_report(docs, labels).collect()
    assert len(report) == docs.count()
    for r in report:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (r.doc_id < 900 and r.doc_id % 3 != 0), r
    kept = keep_good(docs.selectExpr("*", "'x' as kept", "1 as n_words"), labels)
    assert kept.columns == ["doc_id", "text", "kept", "n_words"] and {r.doc_id for r in kept.collect()} == {i for i in range(300) if i % 3}


def test_without_labels_the_base_rule_decides(spark, documents):
    docs = documents([(1, prose(random.Random(1))), (2, "few words"), (3, "a b c " * 30)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.doc_id: r.kept for r in quality_report(docs, none).collect()} == {1: True, 2: False, 3: False}
    assert quality_report(docs.limit(0), none).count() == 0


def test_imprecise_rules_are_not_taken(spark):
    rows = [(i % 2 == 0, i % 3 > 0, *[i % 7] * 10) for i in range(200)]
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_upper n_exclaims n_digits n_distinct_words".split()
    examples = spark.createDataFrame(rows, "bad boolean, grow boolean, " + ", ".join(f"{n} long" for n in names))
    assert learn(examples) == []
    assert str(Condition("words_up_to_1000", True, 3)) == "words_up_to_1000 >= 3"


def check_shards(rows, got, shards):
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    by = defaultdict(list)
    texts = dict(rows)
    for r in got:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        by[r.shard].append(r)
    for group in by.values():
        assert sorted(r.slot for r in group) == list(range(len(group)))
    return {k: sum(r["size"] for r in v) for k, v in by.items()}


def test_shards_are_equally_large_and_slots_gapless(spark, documents):
    rng = random.Random(3)
    hot = "hot copy " * 20
    rows = [(i, hot if i % 3 == 0 else prose(rng, rng.randrange(1, 60))) for i in range(3000)]
    sizes = check_shards(rows, shard_by_bytes(documents(rows), 8).collect(), 8)
    mean = sum(sizes.values()) / 8
    assert set(sizes) == set(range(8)) and all(abs(s - mean) < 0.02 * mean for s in sizes.values())
    groups = defaultdict(set)
    for r in shard_by_bytes(documents(rows), 8).collect():
        groups[r.text_crc32].add(r.shard)
    assert sum(len(g) > 1 for g in groups.values()) <= 7  # only what lies across a splitter


def test_shards_of_odd_rows(documents, odd_rows, with_clashes):
    rows = [(i, t) for i, t in odd_rows if i is not None]
    check_shards(rows, shard_by_bytes(with_clashes(documents(rows)), 8).collect(), 8)
    assert shard_by_bytes(documents([])).count() == 0
    assert shard_by_bytes(documents([(None, None), (None, "a")])).count() == 2


def test_texts_of_more_words_than_packed_positions_are_counted_right(documents, monkeypatch):
    monkeypatch.setattr("clientele.llm.quality_rules.POSITION_BITS", 4)
    rng = random.Random(6)
    rows = [(n, " ".join(rng.choices("abcdefgh", k=n))) for n in [0, 2, 3, 15, 16, 17, 18, 19, 40, 200, 900]]
    for r in text_counts(documents(rows)).collect():
        assert r.n_repeat_words == base(r.text)[-1], r.doc_id
