"""Churn-modelling queries on the gold table."""

from __future__ import annotations

from pyspark.sql import functions as F

from clientele.catalog.core import Query
from clientele.functions.columns import round_doubles
from clientele.operators import ml
from clientele.operators.logistic import gradient
from clientele.plans.warehouse import Warehouse, warehouse
from clientele.sources.storage import fresh_path, store

QUERIES: dict[str, Query] = {}


def over(name, digits=6):
    def register(build):
        QUERIES[name] = lambda spark, source_dir: round_doubles(build(warehouse(spark, source_dir)), digits)
        return build

    return register


def _split(w: Warehouse):
    return ml.stratified_split(ml.features(ml.label(w.customer_360)))


def _rules(w: Warehouse):
    return ml.rule_predictions(ml.label(w.customer_360))


def _fitted(w: Warehouse, kind: str):
    split = store(_split(w), "split")
    return ml.train(split.filter(~F.col("is_test")), kind), split


def _test_metrics(w: Warehouse, kind: str):
    model, split = _fitted(w, kind)
    return ml.evaluate(ml.score(model, split.filter("is_test")))


over("ml1_label")(lambda w: ml.label(w.customer_360).select("customer_id", ml.LABEL))
over("ml1_label_observed")(lambda w: ml.label(w.customer_360, use_synthetic=False).select("customer_id", ml.LABEL))
over("ml1b_label_study")(lambda w: ml.label_study(w.customer_360))
over("ml2_features")(lambda w: ml.features(ml.label(w.customer_360)))
over("ml3_stratified_split")(lambda w: _split(w).select("customer_id", ml.LABEL, "is_test"))
over("ml8_rule_metrics")(lambda w: ml.evaluate(_rules(w)))
over("ml9_roc_points")(lambda w: ml.roc(_rules(w)))
over("ml9_best_threshold")(lambda w: ml.best_threshold(ml.roc(_rules(w))))
over("ml9_auc_by_segment")(
    lambda w: ml.auc(_rules(w).join(w.customer_360.select("customer_id", "segment"), "customer_id"), ["segment"])
)


@over("ml10_psi_risk")
def _(w: Warehouse):
    c360 = w.customer_360
    return ml.psi(c360.filter(~F.col("is_synthetic")), c360.filter("is_synthetic"), "risque_composite")


@over("ml10_psi_few_edges")
def _(w: Warehouse):
    c360 = w.customer_360
    return ml.psi(c360.filter(~F.col("is_synthetic")), c360.filter("is_synthetic"), "nb_reclamations_total")


over("ml11_stratified_folds")(
    lambda w: ml.stratified_folds(ml.features(ml.label(w.customer_360))).select("customer_id", ml.LABEL, "fold")
)
over("ml12_rules_baseline")(lambda w: ml.evaluate_rules(ml.label(w.customer_360, use_synthetic=False)))
over("ml5_logistic")(lambda w: _test_metrics(w, "logistic"))
over("ml6_random_forest")(lambda w: _test_metrics(w, "random_forest"))
over("ml7_gradient_boosting")(lambda w: _test_metrics(w, "gbt"))
over("ml11_cross_validation")(lambda w: ml.cross_validate(ml.label(w.customer_360), "logistic"))


@over("ml4_scaled_features")
def _(w: Warehouse):
    """Train-set mean and deviation of every scaled input: the scaler saw the training rows only."""
    model, split = _fitted(w, "logistic")
    scaled = split.select("is_test", F.array(*model.scaled()).alias("v"))
    per_input = scaled.select("is_test", F.posexplode("v").alias("rang", "valeur"))
    return per_input.groupBy("is_test", "rang").agg(F.avg("valeur").alias("moyenne"), F.stddev_samp("valeur").alias("ecart_type"))


@over("ml5_gradient")
def _(w: Warehouse):
    """Slope of the penalized likelihood at the fitted coefficients: 0 at the optimum."""
    model, split = _fitted(w, "logistic")
    return gradient(split.filter(~F.col("is_test")), model, ml.LABEL)


def _node_scores(w: Warehouse, kind: str):
    """Scores from the exported nodes beside those of the model: how far apart, and whether the class is the same."""
    model, split = _fitted(w, kind)
    own = ml.score(model, split).select("customer_id", F.col("score").alias("own"), F.col("prediction").alias("said"))
    nodes = ml.node_scores(model, kind, split, fresh_path(split.sparkSession, f"models/{kind}"))
    gap = F.abs(F.col("score") - F.col("own")).alias("ecart")
    return nodes.join(own, "customer_id").select("customer_id", "is_test", gap, (F.col("prediction") == F.col("said")).alias("meme_classe"))


over("ml6_node_scores")(lambda w: _node_scores(w, "random_forest"))
over("ml7_node_scores")(lambda w: _node_scores(w, "gbt"))


@over("ml11_held_out_scores")
def _(w: Warehouse):
    """Each customer scored by the model of the other four folds."""
    folded = store(ml.stratified_folds(ml.features(ml.label(w.customer_360))), "folds")
    return ml.held_out_scores(folded, 5).select("customer_id", "fold", "score", "prediction")


@over("ml13_comparison")
def _(w: Warehouse):
    return ml.compare(w.customer_360)


@over("ml14_production_model")
def _(w: Warehouse):
    path = fresh_path(w.customer_360.sparkSession, "models/churn-logistic")
    return ml.train_production(w.customer_360, path)


@over("ml15_scores")
def _(w: Warehouse):
    model, split = _fitted(w, "logistic")
    return ml.score(model, split)


@over("ml15_coefficients")
def _(w: Warehouse):
    model, split = _fitted(w, "logistic")
    return ml.explain(model, split)


@over("ml15_train_test_psi")
def _(w: Warehouse):
    model, split = _fitted(w, "logistic")
    scores = store(ml.score(model, split), "scores")
    return ml.psi(scores.filter(~F.col("is_test")), scores.filter("is_test"), "score")
