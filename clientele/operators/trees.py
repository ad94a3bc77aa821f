"""Tree models as a table of nodes, and scores from that table alone.

A fitted forest or boosted model is written out as one row per node: where it splits, where to go, what it is worth.
Any engine can score from these rows. Here a row walks all trees inside one expression: the node table, whose size is
bounded by trees and depth, enters the plan as a scalar subquery, so scoring neither shuffles nor leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def export_nodes(model: PipelineModel, spark: SparkSession, path: str) -> DataFrame:
    """(``tree``, ``weight``, ``node``, ``variable``, ``threshold``, ``left``, ``right``, ``value``) of the classifier.

    ``variable`` is the position of an input, ``threshold`` refers to the scaled input; rows at or below it go left.
    Leaves have no variable. ``value`` is the share of positives of a forest's node, the output of a boosted tree's.
    """
    classifier = model.stages[-1]
    classifier.write().overwrite().save(f"{path}/model")
    saved = spark.read.parquet(f"{path}/model/data").select("treeID", "nodeData.*")
    boosted = hasattr(classifier, "treeWeights") and hasattr(classifier, "evaluateEachIteration")
    weights = [float(x) for x in classifier.treeWeights] if boosted else [1.0 / classifier.getNumTrees] * classifier.getNumTrees
    positive = F.col("prediction") if boosted else F.col("impurityStats")[1] / F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    split = F.col("leftChild") >= 0
    nodes = saved.select(
        F.col("treeID").alias("tree"), F.array(*map(F.lit, weights))[F.col("treeID")].alias("weight"), F.col("id").alias("node"),
        F.when(split, F.col("split.featureIndex")).alias("variable"), F.when(split, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(split, F.col("leftChild")).alias("left"), F.when(split, F.col("rightChild")).alias("right"), positive.alias("value"),
    )
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    return spark.read.parquet(f"{path}/nodes")


def scaled_inputs(model: PipelineModel, inputs: Sequence[str]) -> list[Column]:
    """The inputs as the model's scaler hands them on."""
    scaler = model.stages[1]
    return [
        (F.col(c) - float(m)) * (1.0 / float(d) if d else 0.0)
        for c, m, d in zip(inputs, scaler.mean.toArray(), scaler.std.toArray(), strict=True)
    ]


def with_forest(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` with the whole node table in the column ``_forest``, which the functions below walk."""
    fields = F.struct("node", "variable", "threshold", "left", "right", "value")
    trees = nodes.groupBy("tree").agg(F.max("weight").alias("weight"), F.array_sort(F.collect_list(fields)).alias("nodes"))
    return rows.withColumn("_forest", trees.agg(F.array_sort(F.collect_list(F.struct("tree", "weight", "nodes")))).scalar())


def _value(inputs: Sequence[Column], deepest: int) -> Column:
    """Weighted sum over all trees of the value of the leaf that a row falls into, at most ``deepest`` splits down.

    The inputs are bound once a row and the node once a step: an expression named twice inside a lambda is computed twice.
    """
    depth = F.sequence(F.lit(1), F.lit(deepest))

    def leaf(tree: Column, x: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            child = F.when(x[node["variable"]] <= node["threshold"], node["left"]).otherwise(node["right"])
            return F.when(node["left"].isNull(), node).otherwise(tree["nodes"][child])

        return F.aggregate(depth, tree["nodes"][0], step)["value"]

    def total(x: Column) -> Column:
        return F.aggregate("_forest", F.lit(0.0), lambda so_far, t: so_far + t["weight"] * leaf(t, x))

    return F.transform(F.array(F.array(*inputs)), total)[0]


def forest_probability(inputs: Sequence[Column], deepest: int) -> Column:
    """Mean share of positives over the trees."""
    return _value(inputs, deepest)


def boosted_probability(inputs: Sequence[Column], deepest: int) -> Column:
    """Logistic transform of twice the boosted margin."""
    return 1 / (1 + F.exp(_value(inputs, deepest) * -2.0))
