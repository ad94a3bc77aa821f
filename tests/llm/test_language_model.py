"""Scores by word counts match plain Python; the attention model's gradients and windows are right."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers

from clientele.llm import attention_lm as lm

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def base_scores(rows):
    def held(i):
        return zlib.crc32(str("" if i is None else i).encode()) % 7 == 2

    counts = Counter()
    for i, t in rows:
        if not held(i):
            counts.update([*(t or "").encode().lower().split(), "end"])
    n, v = sum(counts.values()), len(counts)
    found = Counter()
    for i, t in rows:
        tokens = [*(t or "").encode().lower().split(), "end"]
        score = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        found[i, held(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, round(score, 5)] += 1
    return found


def test_base_scores_match_brute_force(documents, odd_rows, with_clashes, monkeypatch):
    rows = odd_rows + [(100 + i, f"common word number{i % 7} and rare{i} " * (1 + i % 5)) for i in range(80)]
    for frequent in (0, 4, lm.FREQUENT):
        monkeypatch.setattr(lm, "FREQUENT", frequent)
        got = lm.score_documents(with_clashes(documents(rows)), VOCABULARY).collect()
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == base_scores(rows)
        assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    same = {r.score for r in got if r.doc_id == 3}
    assert len(same) == 1
    assert lm.score_documents(documents([]), VOCABULARY).count() == 0


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in lm.start_weights().items()}
    x, y = rng.integers(0, lm.CLASSES + 1, (3, lm.WINDOW)), rng.integers(-1, lm.CLASSES, (3, lm.WINDOW))

    def loss():
        logits = lm.forward(w, x)["z"] @ w["o"] + w["b"]
        logits = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
        real = np.flatnonzero(y.ravel() >= 0)
        return -logits[real, y.ravel()[real]].mean()

    g = lm.gradients(w, x, y)
    for name in w:
        at = tuple(rng.integers(0, s) for s in w[name].shape)
        kept, step = w[name][at], 1e-5
        w[name][at] = kept + step
        up = loss()
        w[name][at] = kept - step
        down = loss()
        w[name][at] = kept
        assert abs((up - down) / (2 * step) - g[name][at]) < 1e-6, name


def test_windows_score_every_place_once():
    sizes = np.array([1, 31, 32, 33, 56, 57, 200, 1])
    ends = np.cumsum(sizes)
    at, real, fresh = lm.places(ends)
    assert Counter(at[fresh].tolist()) == Counter(range(ends[-1])) and not (fresh & ~real).any()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    assert all(len(set(owner[row])) == 1 for row in at)


def test_later_ids_do_not_change_a_score():
    rng = np.random.default_rng(1)
    w = lm.start_weights()
    x = rng.integers(0, lm.CLASSES, (1, lm.WINDOW))
    other = x.copy()
    other[0, 20:] = rng.integers(0, lm.CLASSES, lm.WINDOW - 20)
    first = np.arange(20)
    assert np.allclose(lm.class_scores(w, x, x, first), lm.class_scores(w, other, x, first))


def test_probabilities_of_all_ids_sum_to_one():
    counts = np.random.default_rng(2).integers(0, 50, 500).astype(float)
    classes = lm.Classes.fit(counts, np.arange(500) % 3 == 0)
    w = lm.start_weights()
    logits = lm.forward(w, np.zeros((1, lm.WINDOW), dtype=int))["z"][5] @ w["o"] + w["b"]
    p = np.exp(logits) / np.exp(logits).sum()
    assert abs((p[classes.of] * np.exp(classes.log_inside)).sum() - p[np.unique(classes.of)].sum()) < 1e-5
    assert set(classes.of) == set(range(lm.CLASSES))


def test_training_beats_the_start_on_held_out_windows():
    rng = np.random.default_rng(3)
    cycle = np.array([rng.permutation(lm.CLASSES)[: lm.WINDOW + 1]] * 64)
    w = lm.start_weights()
    trainer = lm.Trainer(w)
    for _ in range(60):
        trainer.step(cycle[:, :-1], cycle[:, 1:])
    places = np.arange(lm.WINDOW)
    assert lm.class_scores(trainer.w, cycle[:1, :-1], cycle[:1, 1:], places).mean() > lm.class_scores(w, cycle[:1, :-1], cycle[:1, 1:], places).mean() + 1


def test_every_window_of_every_training_document_is_gathered(documents):
    rows = [(i, " ".join(f"word{(i * k) % 97}" for k in range(n))) for i, n in enumerate([0, 1, 3, 9, 20, 60, 150] * 4)] + [(None, None)]
    docs = documents(rows).selectExpr("text", "coalesce(doc_id % 5 = 2, false) as held_out")
    pieces = lm.Pieces(VOCABULARY)
    expected = Counter()
    for i, t in rows:
        if i is None or i % 5 != 2:
            ids = [*(x for w in (t or "").split() for x in pieces.model.encode(w)), pieces.end]
            for a in range(0, max(1, len(ids) - lm.OVERLAP), lm.WINDOW - lm.OVERLAP):
                own = ids[a : a + lm.WINDOW]
                expected[ids[a - 1] if a else -1, *own, *[-1] * (lm.WINDOW - len(own))] += 1
    gathered = lm._gathered(docs, VOCABULARY).filter(f"kind = {lm.WINDOWS}").select("window").toArrow()
    got = [lm.unpacked_windows(c, pieces.size) for c in gathered.column(0).chunks if len(c)]
    assert Counter(tuple(w) for c in got for w in c.tolist()) == expected


def test_each_round_trains_on_its_share_of_all_windows(documents, monkeypatch):
    ends = np.arange(1, 41) * 50
    packed = lm.packed_windows(np.arange(2000) % 300, ends, 300)
    spark = documents([]).sparkSession
    windows = spark.createDataFrame([(w,) for w in packed.to_pylist()], "window binary")
    seen = spark.sparkContext.accumulator(0)

    class Counting(lm.Trainer):
        def step(self, x_class, y_class):
            seen.add(len(x_class))
            super().step(x_class, y_class)

    monkeypatch.setattr(lm, "Trainer", Counting)
    classes = lm.Classes.fit(np.ones(300), np.arange(300) % 2 == 0)
    weights = lm._trained(windows, classes)
    assert seen.value == len(packed) and all(np.isfinite(x).all() for x in weights.values())


def test_training_tells_ids_of_one_class_apart(documents):
    """Two ids of a shared class: one is always followed by id 1, the other by id 2."""
    rng = np.random.default_rng(4)
    classes = lm.Classes.fit(np.r_[np.full(lm.OWN_CLASS, 100.0), np.zeros(224)], np.arange(300) % 2 == 0)
    one, two = (int(i) for i in np.flatnonzero(classes.of == classes.of[299])[:2])
    follows = np.where(rng.random(60_000) < 0.5, one, two)
    ids = np.c_[follows, np.where(follows == one, 1, 2)].ravel().astype(np.int32)
    packed = lm.packed_windows(ids, np.arange(1, 2001) * 60, 300)
    windows = documents([]).sparkSession.createDataFrame([(w,) for w in packed.to_pylist()], "window binary")
    weights = lm._trained(windows, classes)
    assert not np.array_equal(weights[lm.OWN][one], weights[lm.OWN][two]) and not weights[lm.OWN][250].any()
    w = lm.by_id(weights, classes.of)
    x = np.full((2, lm.WINDOW), 300)
    x[:, 0] = one, two
    y = np.full((2, lm.WINDOW), classes.of[1])
    after_one, after_two = lm.class_scores(w, x, y, np.array([0, lm.WINDOW]))
    assert after_one > after_two + 0.5


def test_gradient_of_own_vectors_matches_differences():
    rng = np.random.default_rng(5)
    w = {k: v.astype(np.float64) for k, v in lm.start_weights().items()}
    x, y = rng.integers(0, lm.CLASSES + 1, (2, lm.WINDOW)), rng.integers(-1, lm.CLASSES, (2, lm.WINDOW))
    own = rng.normal(0, 0.1, (2, lm.WINDOW, lm.WIDTH))

    def loss():
        logits = lm.forward(w, x, own)["z"] @ w["o"] + w["b"]
        logits = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
        real = np.flatnonzero(y.ravel() >= 0)
        return -logits[real, y.ravel()[real]].mean()

    found = lm.gradients(w, x, y, own)[lm.OWN].reshape(own.shape)
    for at in ((0, 3, 5), (1, 20, 0)):
        kept, step = own[at], 1e-5
        own[at] = kept + step
        up = loss()
        own[at] = kept - step
        down = loss()
        own[at] = kept
        assert abs((up - down) / (2 * step) - found[at]) < 1e-6


def test_a_step_brings_places_together_by_id_and_ids_by_class():
    """Sums by class of the ids' sums are the gradient of ``e``; own vectors move by Adam on their ids' sums alone."""
    rng = np.random.default_rng(6)
    of = np.r_[rng.integers(0, lm.CLASSES, 300), lm.CLASSES]
    w = lm.start_weights()
    own = rng.normal(0, 0.1, (301, lm.WIDTH)).astype(np.float32)
    x, y = rng.integers(0, 301, (4, lm.WINDOW)), rng.integers(-1, lm.CLASSES, (4, lm.WINDOW))
    x[0, :9] = 7
    found = lm.gradients(w, of[x], y, own[x])
    sums = np.zeros_like(own)
    np.add.at(sums, x.ravel(), found[lm.OWN])
    trainer = lm.Trainer(w, own.copy(), of)
    trainer.steps = 1
    assert np.allclose(trainer._move_own(x.ravel(), lm.place_gradients(w, of[x], y, own[x])[lm.OWN]), found["e"], atol=1e-6)
    trainer = lm.Trainer(w, own.copy(), of)
    trainer.step(x, y)
    met = np.bincount(x.ravel(), minlength=301)
    assert np.array_equal(trainer.met, met)
    assert np.allclose(trainer.own, np.where(met[:, None] > 0, own - lm.RATE * sums / (np.abs(sums) + 1e-8), own), atol=1e-5)


def test_gradients_of_extreme_logits_are_finite():
    rng = np.random.default_rng(7)
    w = lm.start_weights()
    w["b"][3] = 500
    x, y = rng.integers(0, lm.CLASSES, (2, lm.WINDOW)), np.full((2, lm.WINDOW), 3)
    assert all(np.isfinite(a).all() for a in lm.gradients(w, x, y).values())
    assert abs(lm.gradients(w, x, y)["b"]).max() < 1e-6
    w["b"][3] = -500
    assert abs(lm.gradients(w, x, y)["b"][3] + 1) < 1e-5
