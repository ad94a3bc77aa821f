import random

import pytest
from pyspark.sql import functions as F

from clientele.operators import ml
from clientele.operators.trees import forest_probability, with_forest


@pytest.fixture(scope="module")
def labelled(bank):
    return ml.features(ml.label(bank.customer_360))


def test_label_is_binary_and_observed_only_when_asked(bank):
    observed = ml.label(bank.customer_360, use_synthetic=False)
    assert {r[0] for r in observed.select(ml.LABEL).distinct().collect()} <= {0, 1}
    assert observed.filter("is_synthetic").isEmpty()


def test_split_is_stratified_and_exact(labelled):
    split = ml.stratified_split(labelled).groupBy(ml.LABEL).agg(
        F.count("*").alias("n"), F.count_if("is_test").alias("test")
    )
    for r in split.collect():
        assert r["test"] == -(-r["n"] // 5)


def test_folds_are_even_inside_each_label(labelled):
    sizes = ml.stratified_folds(labelled, 5).groupBy(ml.LABEL, "fold").count().collect()
    for y in (0, 1):
        own = [r["count"] for r in sizes if r[ml.LABEL] == y]
        assert max(own) - min(own) <= 1


def test_logistic_trains_scores_and_warns(labelled):
    split = ml.stratified_split(labelled)
    test = split.filter("is_test")
    model = ml.train(split.filter("not is_test"))
    pred = ml.score(model, test)
    assert pred.count() == test.count() and pred.filter("score < 0 or score > 1").isEmpty()
    assert ml.evaluate(pred).first()["avertissement"] is not None
    assert ml.explain(model, test).count() == len(ml.FEATURES)
    scaled = split.filter("not is_test").select(model.scaled()[0].alias("x"))
    assert abs(scaled.agg(F.avg("x")).first()[0]) < 1e-9


@pytest.mark.parametrize("kind", ["random_forest", "gbt"])
def test_tree_models_cross_validate(labelled, kind):
    row = ml.cross_validate(labelled, kind, k=2, trees=5, rounds=3).first()
    assert all(0 <= row[c] <= 1 for c in ("auc", "recall", "precision", "f1"))


def test_cached_node_ids_grow_the_same_forest(labelled, monkeypatch):
    cached = ml.train(labelled, "random_forest", trees=5).stages[-1]
    assert cached.getCacheNodeIds()
    plain = ml._estimator("random_forest", ml.RULES.seed, 5, 0).setCacheNodeIds(False)
    monkeypatch.setattr(ml, "_estimator", lambda *_: plain)
    assert ml.train(labelled, "random_forest", trees=5).stages[-1].toDebugString.split("\n", 1)[1] == cached.toDebugString.split("\n", 1)[1]


@pytest.mark.parametrize(("kind", "most", "at_once"), [("random_forest", 0, 1), ("random_forest", 1 << 40, 5), ("gbt", 0, 5)])
def test_large_forests_follow_one_another(labelled, monkeypatch, kind, most, at_once):
    seen = []
    own = ml.run_all

    def watched(spark, actions, limit):
        seen.append(limit)
        return own(spark, actions, limit)

    monkeypatch.setattr(ml, "FOREST_ROWS", most)
    monkeypatch.setattr(ml, "run_all", watched)
    assert ml.cross_validate(labelled, kind, k=2, trees=2, rounds=1).count() == 1
    assert seen == [at_once]


@pytest.mark.parametrize("kind", ["random_forest", "gbt"])
def test_exported_nodes_score_as_the_model(labelled, tmp_path, kind):
    model = ml.train(labelled, kind, trees=7, rounds=5)
    own = {r.customer_id: r.score for r in ml.score(model, labelled).collect()}
    nodes = ml.node_scores(model, kind, labelled, str(tmp_path / "trees"))
    assert "Python" not in nodes._jdf.queryExecution().executedPlan().toString()
    assert {r.customer_id: r.score for r in nodes.collect()} == pytest.approx(own, abs=1e-12)


def test_a_walk_binds_the_inputs_once_a_row_and_the_node_once_a_step(spark):
    """Five splits in a chain on either side; inside the lambdas neither the inputs nor a node are computed again."""
    chain = [(0, 1.0, i, i % 2, float(i), i + 1 if i < 5 else None, 6 if i < 5 else None, float(i) if i == 5 else None) for i in range(6)]
    nodes = spark.createDataFrame(
        [*chain, (0, 1.0, 6, None, None, None, None, -1.0)],
        "tree int, weight double, node int, variable int, threshold double, left int, right int, value double",
    )
    rows = spark.createDataFrame([(0.0, 0.0), (0.0, 2.0), (9.0, 0.0)], "a double, b double")
    walked = with_forest(rows, nodes).select("a", "b", forest_probability([F.col("a") * 1.0, F.col("b") * 1.0], 5).alias("p"))
    assert [tuple(r) for r in walked.orderBy("a", "b").collect()] == [(0.0, 0.0, 5.0), (0.0, 2.0, -1.0), (9.0, 0.0, -1.0)]
    walk = walked._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
    assert walk.count(".nodes[") == 2  # the root, and the child chosen
    outside, _, inside = walk.partition("lambdafunction(")
    assert " * 1.0)" in outside and " * 1.0)" not in inside


def test_unknown_model_raises(labelled):
    with pytest.raises(ValueError):
        ml.train(labelled, "perceptron")


def test_production_model_survives_reloading(bank, tmp_path):
    row = ml.train_production(bank.customer_360, str(tmp_path / "model")).first()
    assert 0.5 < row["auc"] <= 1


def scored(spark, rows):
    return spark.createDataFrame([(f"c{i}", y, s, int(s >= 0.5)) for i, (y, s) in enumerate(rows)],
                                 f"customer_id string, {ml.LABEL} int, score double, prediction int")


def test_auc_and_metrics_match_brute_force(spark):
    random.seed(3)
    rows = [(random.randint(0, 1), round(random.random(), 1)) for _ in range(200)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    expected = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    pred = scored(spark, rows)
    assert ml.auc(pred).first()["auc"] == pytest.approx(expected)
    tp = sum(1 for y, s in rows if y and s >= 0.5)
    row = ml.confusion_metrics(pred).first()
    assert row["recall"] == pytest.approx(tp / len(pos))
    assert row["precision"] == pytest.approx(tp / sum(1 for _, s in rows if s >= 0.5))
    best = max(sorted({s for _, s in rows}, reverse=True),
               key=lambda c: sum(s >= c for s in pos) / len(pos) - sum(s >= c for s in neg) / len(neg))
    assert ml.best_threshold(ml.roc(pred)).first()["seuil_retenu"] == best


def test_unknown_scores_take_no_part_in_the_curve(spark):
    known = [(1, 0.9), (0, 0.4), (1, 0.3), (0, 0.1)]
    pred = scored(spark, [(y, s) for y, s in known])
    more = pred.union(spark.createDataFrame([("x", 1, float("nan"), 0), ("y", 0, None, 0)], pred.schema))
    assert ml.auc(more).first()["auc"] == ml.auc(pred).first()["auc"] == 0.75
    assert sorted(ml.roc(more).collect()) == sorted(ml.roc(pred).collect())


def test_one_class_has_no_auc_and_zero_ratios(spark):
    row = ml.evaluate(scored(spark, [(0, 0.1), (0, 0.2)])).first()
    assert row["auc"] is None and (row["recall"], row["precision"], row["f1"]) == (0.0, 0.0, 0.0)


def test_psi(spark):
    base = spark.createDataFrame([(float(i),) for i in range(100)], "v double")
    assert ml.psi(base, base, "v").first()["psi"] == 0.0
    shifted = base.select((F.col("v") + 60).alias("v"))
    assert ml.psi(base, shifted, "v").first()["psi"] > 1
    constant = spark.createDataFrame([(1.0,)] * 10, "v double")
    assert ml.psi(constant, base, "v").first()["psi"] == 0.0


def test_rule_baseline_is_in_bounds(bank):
    row = ml.evaluate_rules(ml.label(bank.customer_360)).first()
    assert 0.5 < row["auc"] <= 1 and 0 <= row["f1"] <= 1
