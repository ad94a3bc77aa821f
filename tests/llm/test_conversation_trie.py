"""The trie against one built turn by turn in plain Python, with short segments and small parts as well."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from clientele.llm.conversation_trie import (
    RESULTS, as_they_are, numbered_turns, prefix_trie, range_minimum, reach_left, reach_right, share_heads, sparse_table,
)

SCHEMA = "conv_id long, turn long, role string, text string"


def sequences(rows):
    """Turns of each conversation in order; rows of equal turn stay in the given order."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(turns, key=lambda x: x[:2])] for c, turns in convs.items()}


def rebuilt(rows):
    own = sequences(rows)
    found = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        found[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return found


def brute(convs):
    if not convs:
        return []
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, below = {}, {}
    for key in members:
        if key:
            children[key[:-1]] = children.get(key[:-1], 0) + 1
    for key, who in members.items():
        saved = (len(who) - 1) * len(key[-1][1]) if key else 0
        for d in range(len(key) + 1):
            leaves, total = below.get(key[:d], (0, 0))
            below[key[:d]] = leaves + (key not in children), total + saved
    result = []
    for key, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(convs[c]) == len(key))))
        parent = min(members[key[:-1]]) if key else None
        result.append((min(who), len(key), parent, len(who), children.get(key, 0), *below[key], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(result, key=str)


def got(df):
    assert df.columns == list(RESULTS)
    return sorted(map(tuple, df.collect()), key=str)


def talk(rng, n, longest, words):
    rows = []
    for c in rng.sample(range(450), n):
        for turn in range(rng.randrange(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_rebuilt_conversations_match_brute_force(spark, seed):
    rows = talk(random.Random(seed), 150, 9, ["a", "bb", "é日", ""])
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(prefix_trie(share_heads(numbered_turns(docs)))) == brute(rebuilt(rows))


@pytest.mark.parametrize("segment", [1, 2, 3, 64])
def test_long_conversations_pass_from_segment_to_segment(spark, segment):
    rng = random.Random(segment)
    rows = talk(rng, 60, 12, ["a", "bb"])
    rows += [(500 + k, i, "user", "same") for k in range(6) for i in range(30 + k % 3)]
    rows += [(600 + k, i, "user", "x" if i < 150 else f"{k % 2}") for k in range(4) for i in range(260)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(prefix_trie(as_they_are(numbered_turns(docs)), segment)) == brute(sequences(rows))


def test_many_equal_conversations_over_many_parts(spark):
    """One conversation makes up most of the table: its node, and the list of those that end there, cross parts."""
    rows = [(c, i, "user", "hello" if i < 3 else str(c)) for c in range(400) for i in range(3 + (c % 5 == 0))]
    rows += [(1000 + c, 0, "user", "hello") for c in range(300)] + [(2000, 0, "system", "z")]
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        docs = spark.createDataFrame(rows, SCHEMA).repartition(9)
        assert got(prefix_trie(as_they_are(numbered_turns(docs)))) == brute(sequences(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_one_conversation_holds_most_rows(spark):
    rows = [(7, i, "user", str(i % 3)) for i in range(300)] + [(c, 0, "user", "0") for c in range(20, 60)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    numbers = sorted((r.c, r.i) for r in numbered_turns(docs).collect())
    assert numbers == sorted([(7, i) for i in range(300)] + [(c, 0) for c in range(20, 60)])
    assert got(prefix_trie(share_heads(numbered_turns(docs)))) == brute(rebuilt(rows))


def test_odd_rows_clashes_and_empty_tables(spark):
    rows = [
        (0, None, None, None), (0, 0, "user", None), (1, 0, None, "a"), (1, 1, "user", "x" * 5000), (100, 3, "user", "q"), (100, -2, "user", "p"),
        (None, 0, "user", "lost"), (101, 0, "a", "bc"), (102, 0, "ab", "c"), (103, None, "user", "q"), (104, 0, "user", "r"), (104, 1, "user", "r"),
        (205, 0, "user", "turnless if its head is skipped"), (206, 0, "u", "v"), (207, 0, "u", "v"), (2**40, 0, "u", "v"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as depth", "'x' as `a b``c`", "2 as c", "3 as i")
    assert got(prefix_trie(share_heads(numbered_turns(docs)))) == brute(rebuilt(rows))
    assert got(prefix_trie(as_they_are(numbered_turns(docs)))) == brute(sequences(rows))
    assert prefix_trie(share_heads(numbered_turns(docs.limit(0)))).collect() == []


def test_repeated_rows_are_turns_of_their_own(spark):
    rows = [(5, 0, "user", "a"), (5, 0, "user", "a"), (6, 0, "user", "a")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert got(prefix_trie(as_they_are(numbered_turns(docs)))) == brute(sequences(rows))


def test_searches_match_scans():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 100):
        values = rng.integers(-1, 5, n)
        table = sparse_table(values)
        at, depth = np.repeat(np.arange(n), 6), np.tile(np.arange(6), n)
        right, left = reach_right(table, at, depth), reach_left(table, at, depth)
        for i, d, r, left_end in zip(at.tolist(), depth.tolist(), right.tolist(), left.tolist(), strict=True):
            end = i
            while end + 1 < n and values[end + 1] >= d:
                end += 1
            start = i
            while start > 0 and values[start] >= d:
                start -= 1
            assert (start, end) == (left_end, r)
        a = rng.integers(0, n, 50)
        b = np.minimum(n - 1, a + rng.integers(0, n, 50))
        assert range_minimum(table, a, b).tolist() == [values[x : y + 1].min() for x, y in zip(a, b, strict=True)]
