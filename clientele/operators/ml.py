"""Churn modelling on the gold table: label, features, split, training, evaluation, drift, comparison.

Splits and folds come from seeded hashes, ranked exactly inside each label. The logistic model is fitted by
``logistic.fit``, trees are Spark ML pipelines; the scaler is part of every model, so a later fit can never change an
earlier one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.config import RULES, BusinessRules
from clientele.functions.columns import count_rows, portable_hash, round_half_up, whole_table_value
from clientele.functions.ordered import exact_quantiles, hash_rank, known_value, prefix_sums
from clientele.operators import boosting
from clientele.operators.eda import union_all
from clientele.operators.features import ID
from clientele.operators.logistic import LogisticModel
from clientele.operators.logistic import fit as fit_logistic
from clientele.operators.scoring import rule_score
from clientele.operators.trees import boosted_probability, export_nodes, forest_probability, scaled_inputs, with_forest
from clientele.sources.concurrent import run_all
from clientele.sources.storage import store, use_for_checkpoints

# Model inputs; the composite risk stays out because the label shares its signals.
FEATURES = (
    "recency_jours", "tendance_transactions", "nb_reclamations_ouvertes", "nb_reclamations_total", "score_digital",
    "nb_comptes", "nb_cartes", "nb_produits_total", "monthly_income_xof",
)
LABEL = "churn_flag"
Model = LogisticModel | PipelineModel
KINDS = ("logistic", "random_forest", "gbt")
DEPTH = {"random_forest": 15, "gbt": 6}
STEP = 0.3  # of boosting
RELIABLE_ROWS, RELIABLE_POSITIVES = 200, 20
FOREST_ROWS = 1 << 18  # a forest of more rows is grown alone: it fills the cores, and holds two numbers a row and tree


# Label and data ----------------------------------------------------------------------------------
def _signals(rules: BusinessRules) -> Column:
    """How many of the four disengagement signals are on; an unknown one counts as off."""
    signals = (
        F.col("recency_jours") > rules.churn_recency_days,
        F.col("nb_reclamations_ouvertes") > 0,
        F.col("tendance_transactions") < 0,
        F.col("score_digital") <= 1,
    )
    return sum((F.when(s, 1).otherwise(0) for s in signals), F.lit(0))


def label(c360: DataFrame, use_synthetic: bool = True, rules: BusinessRules = RULES) -> DataFrame:
    """Add the proxy label: at least two of four signals."""
    rows = c360 if use_synthetic else c360.filter(~F.col("is_synthetic"))
    return rows.withColumn(LABEL, F.when(_signals(rules) >= 2, 1).otherwise(0))


def label_study(c360: DataFrame, rules: BusinessRules = RULES) -> DataFrame:
    """Positives of the naive label and at one, two and three signals."""
    on = _signals(rules)
    return c360.agg(
        count_rows().alias("n"), F.count_if(F.col("recency_jours") > rules.churn_recency_days).alias("positifs_naif"),
        *[F.count_if(on >= k).alias(f"positifs_{k}_criteres") for k in (1, 2, 3)],
    )


def features(df: DataFrame) -> DataFrame:
    """Key, label and the numeric inputs with missing values as 0."""
    inputs = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES]
    return df.select(ID, LABEL, *inputs)


def _ranked(df: DataFrame, y: str, seed: int) -> DataFrame:
    return hash_rank(df.withColumn("_h", portable_hash(seed, F.col(ID))), "_h", ID, by=[y], rank_col="_rank").drop("_h")


def stratified_split(df: DataFrame, y: str = LABEL, test_size: float = 0.2, seed: int = RULES.seed) -> DataFrame:
    """Add ``is_test``: in each label the first ceil(test_size x n) rows in hash order."""
    sizes = df.groupBy(y).agg(F.ceil(count_rows() * F.lit(test_size)).alias("_k"))
    return _ranked(df, y, seed).join(sizes, y).withColumn("is_test", F.col("_rank") <= F.col("_k")).drop("_rank", "_k")


def stratified_folds(df: DataFrame, k: int = 5, y: str = LABEL, seed: int = RULES.seed) -> DataFrame:
    """Add ``fold`` 0..k-1, dealt in turn inside each label."""
    fold = F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")
    return _ranked(df, y, seed).withColumn("fold", fold).drop("_rank")


# Training ----------------------------------------------------------------------------------------
def _balanced(df: DataFrame, kind: str) -> DataFrame:
    """Class weights: n / (2 n_class), for boosting n_negative / n_positive on the positives."""
    row = df.agg(count_rows().alias("n"), F.count_if(F.col(LABEL) == 1).alias("pos")).first()
    n, pos = row["n"], row["pos"]
    neg = n - pos
    if kind == "gbt":
        heavy, light = neg / max(pos, 1), 1.0
    else:
        heavy, light = n / (2 * max(pos, 1)), n / (2 * max(neg, 1))
    weight = F.when(F.col(LABEL) == 1, F.lit(float(heavy))).otherwise(F.lit(float(light)))
    return df.withColumn("_weight", weight)


def _estimator(kind: str, seed: int, trees: int, rounds: int):
    common = {"featuresCol": "scaled", "labelCol": LABEL, "weightCol": "_weight"}
    if kind == "random_forest":
        # cached node ids: each pass takes a row from where the last one left it, not from the root of all trees; same forest
        return RandomForestClassifier(numTrees=trees, maxDepth=DEPTH[kind], maxMemoryInMB=1024, cacheNodeIds=True, seed=seed, **common)
    if kind == "gbt":
        return GBTClassifier(maxIter=rounds, maxDepth=DEPTH[kind], stepSize=STEP, seed=seed, **common)
    raise ValueError(f"train: unknown model kind {kind!r}")


def train(
    df: DataFrame, kind: str = "logistic", seed: int = RULES.seed, trees: int = 200, rounds: int = 100
) -> Model:
    """Fit scaler and classifier on rows shaped by ``features``."""
    if kind not in KINDS:
        raise ValueError(f"train: unknown model kind {kind!r}")
    if kind == "logistic":
        return fit_logistic(store(df, "training_rows"), FEATURES, LABEL, F.array(F.lit(0)), 1)[0]
    use_for_checkpoints(df.sparkSession)
    weighted = _balanced(df, kind)
    stages = [
        VectorAssembler(inputCols=list(FEATURES), outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
        _estimator(kind, seed, trees, rounds),
    ]
    return Pipeline(stages=stages).fit(weighted)


def _kept(df: DataFrame) -> list[str]:
    return [c for c in (ID, LABEL, "fold", "is_test") if c in df.columns]


def _scored(df: DataFrame, probability: Column) -> DataFrame:
    rows = df.select(*_kept(df), probability.alias("score"))
    return rows.withColumn("prediction", (F.col("score") > 0.5).cast("int"))


def score(model: Model, df: DataFrame) -> DataFrame:
    """Probability of disengagement and predicted class per customer."""
    if isinstance(model, LogisticModel):
        return _scored(df, model.probability())
    positive = vector_to_array(F.col("probability"))[1]
    kept = _kept(df)
    return model.transform(df).select(*kept, positive.alias("score"), F.col("prediction").cast("int").alias("prediction"))


def node_scores(model: PipelineModel, kind: str, df: DataFrame, path: str) -> DataFrame:
    """Probability per customer from the table of nodes that the tree model is exported to."""
    nodes = export_nodes(model, df.sparkSession, path)
    walk = forest_probability if kind == "random_forest" else boosted_probability
    return _scored(with_forest(df, nodes), walk(scaled_inputs(model, FEATURES), DEPTH[kind]))


def explain(model: Model, df: DataFrame) -> DataFrame:
    """Coefficient (logistic) or importance (trees) of each input."""
    values = model.coefficients if isinstance(model, LogisticModel) else model.stages[-1].featureImportances
    rows = [(name, float(values[i])) for i, name in enumerate(FEATURES)]
    return df.sparkSession.createDataFrame(rows, "variable string, coefficient double")


# Evaluation --------------------------------------------------------------------------------------
def _score_counts(pred: DataFrame, by: Sequence[str], score_col: str) -> DataFrame:
    """(``by``, ``seuil``, ``pos``, ``neg``): labels per distinct known score, written once; unknown scores take no part."""
    counts = pred.filter(known_value(pred, score_col)).groupBy(*by, F.col(score_col).cast("double").alias("seuil"))
    return store(counts.agg(F.count_if(F.col(LABEL) == 1).alias("pos"), F.count_if(F.col(LABEL) == 0).alias("neg")), "score_counts")


def auc(pred: DataFrame, by: Sequence[str] = (), score_col: str = "score") -> DataFrame:
    """Area under the ROC curve by rank sum, ties counting half; NULL when one class is absent."""
    ranked = prefix_sums(_score_counts(pred, by, score_col), "seuil", ["pos", "neg"], by, descending=True, stored=True)
    won = F.sum((F.col("cum_pos") - F.col("pos") / 2) * F.col("neg"))
    return ranked.groupBy(*by).agg((won / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("auc"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(part.cast("double") / F.nullif(whole, F.lit(0)).cast("double"), F.lit(0.0))


def confusion_metrics(pred: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Recall, precision and F1 (0 where undefined), unrounded, with sizes."""
    actual, said = F.col(LABEL) == 1, F.col("prediction") == 1
    counts = pred.groupBy(*by).agg(
        F.count_if(actual & said).alias("_tp"), F.count_if(said).alias("_said"), F.count_if(actual).alias("n_positifs_test"),
        count_rows().alias("n_test"),
    )
    return counts.select(
        *by, _ratio(F.col("_tp"), F.col("n_positifs_test")).alias("recall"), _ratio(F.col("_tp"), F.col("_said")).alias("precision"),
        _ratio(F.col("_tp") * 2, F.col("n_positifs_test") + F.col("_said")).alias("f1"), "n_test", "n_positifs_test",
    )


def evaluate(pred: DataFrame, score_col: str = "score") -> DataFrame:
    """One row of metrics to three decimals and a warning on a small sample."""
    area = whole_table_value(auc(pred, score_col=score_col), auc=F.max("auc"))["auc"]
    metrics = confusion_metrics(pred)
    small = (F.col("n_test") < RELIABLE_ROWS) | (F.col("n_positifs_test") < RELIABLE_POSITIVES)
    return metrics.select(
        round_half_up(area, 3).alias("auc"), *[round_half_up(F.col(c), 3).alias(c) for c in ("recall", "precision", "f1")],
        "n_test", "n_positifs_test", F.when(small, F.lit("echantillon de test trop petit")).alias("avertissement"),
    )


def roc(pred: DataFrame, score_col: str = "score") -> DataFrame:
    """One ROC point per distinct threshold, highest first."""
    counts = _score_counts(pred, (), score_col)
    ranked = prefix_sums(counts, "seuil", ["pos", "neg"], descending=True, stored=True)
    size = whole_table_value(counts, pos=F.sum("pos"), neg=F.sum("neg"))
    return ranked.select(
        "seuil", (F.col("cum_neg") / F.nullif(size["neg"], F.lit(0))).alias("fpr"),
        (F.col("cum_pos") / F.nullif(size["pos"], F.lit(0))).alias("tpr"),
        _ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
    )


def best_threshold(points: DataFrame) -> DataFrame:
    """Youden threshold: largest TPR - FPR, the highest threshold on a tie."""
    best = F.max_by(F.struct("seuil", "fpr", "tpr", "precision"), F.struct(F.col("tpr") - F.col("fpr"), F.col("seuil")))
    chosen = points.agg(best.alias("b"))
    return chosen.select(
        round_half_up(F.col("b.seuil"), 3).alias("seuil_retenu"), F.col("b.fpr").alias("fpr_seuil"),
        F.col("b.tpr").alias("tpr_seuil"), round_half_up(F.col("b.precision"), 3).alias("precision_seuil"),
    )


def psi(reference: DataFrame, current: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Population stability index over the reference's quantile bins (open ends, right-closed).

    Repeated edges collapse; fewer than three edges mean no drift can be told: 0.
    """
    edges = exact_quantiles(reference, column, {f"q{i}": i / bins for i in range(bins + 1)})
    distinct = F.array_sort(F.array_distinct(F.array(*[F.col(f"q{i}") for i in range(bins + 1)])))
    edge_list = edges.agg(F.first(distinct)).scalar()
    value = F.col(column).cast("double")

    def shares(df: DataFrame, name: str) -> DataFrame:
        inner = F.slice(F.col("_edges"), F.lit(2), F.greatest(F.size("_edges") - 2, F.lit(0)))
        bin_number = F.size(F.filter(inner, lambda e: e < F.col("_x")))
        known = df.filter(known_value(df, column)).select(value.alias("_x")).withColumn("_edges", edge_list)
        return known.groupBy(bin_number.alias("bin"), F.size("_edges").alias("_n_edges")).agg(count_rows().alias(name))

    both = store(shares(reference, "r").join(shares(current, "c"), ["bin", "_n_edges"], "full"), "psi_bins")
    total = whole_table_value(both, r=F.sum("r"), c=F.sum("c"))

    def share(name: str) -> Column:
        return F.greatest(F.coalesce(F.col(name) / F.nullif(total[name], F.lit(0)), F.lit(0.0)), F.lit(1e-4))

    term = (share("c") - share("r")) * F.log(share("c") / share("r"))
    value_sum = F.coalesce(F.sum(F.when(F.col("_n_edges") >= 3, term)), F.lit(0.0))
    return both.agg(round_half_up(value_sum, 4).alias("psi"))


def cross_validate(
    df: DataFrame, kind: str = "logistic", k: int = 5, seed: int = RULES.seed, trees: int = 200, rounds: int = 100,
    parallelism: int = 5,
) -> DataFrame:
    """k-fold metrics: one model per fold, each with its own scaler; means to three decimals.

    The k logistic models are fitted in the same passes, and so are the k boosted ones (``boosting``), whose scalers and
    thresholds come from up to ``parallelism`` folds at once. Of the forests up to ``parallelism`` are submitted
    at once, which fills the gaps between the many short jobs of a fit; those of more than ``FOREST_ROWS`` rows follow
    one another, so that what a fit keeps of each row and tree is held for one fold at a time.
    """
    folded = store(stratified_folds(features(df), k, seed=seed), "folds")
    if kind == "logistic":
        return _fold_means(held_out_scores(folded, k))
    if kind == "gbt":
        return _fold_means(boosted_scores(folded, k, seed, rounds, parallelism))

    def predicted(fold: int) -> DataFrame:
        model = train(folded.filter(F.col("fold") != fold), kind, seed, trees, rounds)
        return score(model, folded.filter(F.col("fold") == fold))

    if kind == "random_forest" and folded.count() > FOREST_ROWS:
        parallelism = 1
    scored = run_all(folded.sparkSession, [partial(predicted, fold) for fold in range(k)], parallelism)
    return _fold_means(union_all(scored))


def held_out_scores(folded: DataFrame, k: int) -> DataFrame:
    """Each row scored by the model that did not see its fold."""
    others = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda m: m != F.col("fold"))
    models = fit_logistic(folded, FEATURES, LABEL, others, k)
    own = F.coalesce(*[F.when(F.col("fold") == m, model.probability()) for m, model in enumerate(models)])
    return _scored(folded, own)


def boosted_scores(folded: DataFrame, k: int, seed: int, rounds: int, parallelism: int) -> DataFrame:
    """Each row scored by the boosted trees that did not see its fold; the same model as ``train`` fits, all folds at once."""
    use_for_checkpoints(folded.sparkSession)
    others = [partial(boosting.binning, folded.filter(F.col("fold") != m), FEATURES, LABEL, seed) for m in range(k)]
    binned = run_all(folded.sparkSession, others, parallelism)
    models = boosting.fit_folds(folded, FEATURES, LABEL, binned, rounds, DEPTH["gbt"], STEP)
    rows = boosting.held_out_scores(folded, FEATURES, models, _kept(folded))
    return _scored(rows, F.col("score"))


def _fold_means(scored: DataFrame) -> DataFrame:
    pred = store(scored, "fold_predictions")
    per_fold = confusion_metrics(pred, ["fold"]).join(auc(pred, ["fold"]), "fold", "left")
    means = {"auc": F.coalesce(F.col("auc"), F.lit(0.5)), **{c: F.col(c) for c in ("recall", "precision", "f1")}}
    return per_fold.agg(*[round_half_up(F.avg(v), 3).alias(n) for n, v in means.items()])


def rule_predictions(df: DataFrame) -> DataFrame:
    """Rule score as a classifier: positive from the median of the score on."""
    scores = rule_score(df)
    median = whole_table_value(exact_quantiles(scores, "score_regles", {"m": 0.5}), m=F.max("m"))["m"]
    return (
        df.select(ID, LABEL)
        .join(scores, ID)
        .select(
            ID, LABEL, F.col("score_regles").alias("score"),
            F.when(F.col("score_regles") >= median, 1).otherwise(0).alias("prediction"),
        )
    )


def evaluate_rules(df: DataFrame) -> DataFrame:
    return evaluate(rule_predictions(df)).select("auc", "recall", "precision", "f1")


def compare(
    c360: DataFrame, k: int = 5, seed: int = RULES.seed, trees: int = 200, rounds: int = 100
) -> DataFrame:
    """Scenario A (observed): logistic and rules; scenario B (all): logistic, forest, boosting."""
    observed, everyone = label(c360, use_synthetic=False), label(c360)

    def row(metrics: DataFrame, scenario: str, model: str) -> DataFrame:
        return metrics.select(F.lit(scenario).alias("scenario"), F.lit(model).alias("modele"), "auc", "recall", "precision", "f1")

    studies = [
        ("A", "logistic", partial(cross_validate, observed, "logistic", k, seed)),
        ("A", "regles_metier", partial(evaluate_rules, observed)),
        *[("B", kind, partial(cross_validate, everyone, kind, k, seed, trees, rounds)) for kind in KINDS],
    ]
    metrics = run_all(c360.sparkSession, [study for _, _, study in studies])
    rows = [row(m, scenario, model) for m, (scenario, model, _) in zip(metrics, studies, strict=True)]
    return union_all(rows)


def train_production(c360: DataFrame, path: str, kind: str = "logistic", seed: int = RULES.seed) -> DataFrame:
    """Train on 80 %, save the model, reload it and evaluate the reloaded one on the rest."""
    split = store(stratified_split(features(label(c360)), seed=seed), "split")
    model = train(split.filter(~F.col("is_test")), kind, seed)
    if isinstance(model, LogisticModel):
        model.save(split.sparkSession, path)
        saved: Model = LogisticModel.load(split.sparkSession, path)
    else:
        model.write().overwrite().save(path)
        saved = PipelineModel.load(path)
    return evaluate(score(saved, split.filter("is_test")))
