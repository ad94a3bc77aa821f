"""Penalized logistic regression by iteratively reweighted least squares, several models in one pass.

Every iteration is one aggregate: per model the sums of the weighted cross products, of the gradient and of the
log-likelihood (66 numbers for nine inputs). A row takes part in every model that may see it, so cross-validation
costs the scans of one fit. The driver only solves one small system per model and iteration.

Minimized per model: sum of class-weighted log losses + 1/2 x sum of squared coefficients (not the intercept) of the
inputs scaled by the training rows' mean and sample deviation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.columns import count_rows

PENALTY = 1.0
ITERATIONS = 60
CONVERGED = 1e-12


@dataclass(frozen=True)
class LogisticModel:
    """Coefficients of the scaled inputs, with the scaler that belongs to them."""

    inputs: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    def scaled(self) -> list[Column]:
        return [
            ((F.col(c) - m) / d if d else F.lit(0.0)).alias(c)
            for c, m, d in zip(self.inputs, self.means, self.deviations, strict=True)
        ]

    def probability(self) -> Column:
        margin = F.lit(self.intercept)
        for scaled, b in zip(self.scaled(), self.coefficients, strict=True):
            margin = margin + scaled * b
        return 1 / (1 + F.exp(-margin))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [("(intercept)", self.intercept, 0.0, 1.0), *zip(self.inputs, self.coefficients, self.means, self.deviations, strict=True)]
        numbered = [(i, *row) for i, row in enumerate(rows)]
        schema = "rang int, variable string, coefficient double, moyenne double, ecart_type double"
        spark.createDataFrame(numbered, schema).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LogisticModel:
        first, *rows = spark.read.parquet(path).orderBy("rang").collect()
        inputs, coefficients, means, deviations = zip(*[tuple(r)[1:] for r in rows], strict=True)
        return LogisticModel(inputs, first["coefficient"], coefficients, means, deviations)


def _by_model(values: Sequence[float]) -> Column:
    """The value that belongs to a row's model."""
    return F.array(*[F.lit(float(v)) for v in values])[F.col("model")]


def _deviation(value: float | None) -> float:
    return float(value) if value else 0.0  # missing with one row, 0 for a constant input


def fit(df: DataFrame, inputs: Sequence[str], label: str, models: Column, n_models: int) -> list[LogisticModel]:
    """One model per number below ``n_models``; ``models`` is the array of those that a row trains.

    ``inputs`` hold no NULL. A model without rows of one class gets the prior odds of what it has.
    """
    rows = df.select(F.explode(models).alias("model"), F.col(label).cast("double").alias("y"), *inputs)
    statistics = rows.groupBy("model").agg(
        count_rows().alias("n"), F.sum("y").alias("pos"), *[F.avg(c).alias(f"m_{c}") for c in inputs],
        *[F.stddev_samp(c).alias(f"d_{c}") for c in inputs],
    )
    of = {r["model"]: r for r in statistics.collect()}  # one row a model
    if len(of) < n_models:
        raise ValueError("logistic regression: a model has no rows")
    size = len(inputs) + 1
    means = np.array([[of[k][f"m_{c}"] for c in inputs] for k in range(n_models)])
    deviations = np.array([[_deviation(of[k][f"d_{c}"]) for c in inputs] for k in range(n_models)])
    scaled = [
        F.coalesce((F.col(c) - _by_model(means[:, j])) / F.nullif(_by_model(deviations[:, j]), F.lit(0.0)), F.lit(0.0)).alias(f"z{j + 1}")
        for j, c in enumerate(inputs)
    ]
    counts = [(of[k]["n"], of[k]["n"] - of[k]["pos"], of[k]["pos"]) for k in range(n_models)]
    class_weight = [[c[0] / (2 * max(c[1 + y], 1)) for c in counts] for y in (0, 1)]
    weight = F.when(F.col("y") == 1, _by_model(class_weight[1])).otherwise(_by_model(class_weight[0]))
    ready = rows.select("model", "y", weight.alias("w"), F.lit(1.0).alias("z0"), *scaled)
    beta = np.zeros((n_models, size))
    penalty = np.diag([0.0] + [PENALTY] * (size - 1))
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    wanted = [*[f"sum(v * z{i} * z{j})" for i, j in pairs], *[f"sum(g * z{j})" for j in range(size)], "sum(loss)"]
    sums_of = F.expr(f"array({', '.join(wanted)}) AS sums")
    best = np.full(n_models, -np.inf)
    step = np.zeros_like(beta)
    for _ in range(ITERATIONS):
        margin = " + ".join(f"z{j} * array({', '.join(f'{b!r}D' for b in beta[:, j].tolist())})[model]" for j in range(size))
        found = (
            ready.selectExpr("*", f"{margin} AS margin").selectExpr("*", "1 / (1 + exp(-margin)) AS p")
            .selectExpr(
                "*", "w * p * (1 - p) AS v", "w * (y - p) AS g",
                "w * (y * margin - if(margin > 0, margin + log1p(exp(-margin)), log1p(exp(margin)))) AS loss",
            )
            .groupBy("model").agg(sums_of).collect()  # one row a model
        )
        moved = 0.0
        for r in found:
            k, sums = r["model"], r["sums"]
            value = sums[-1] - 0.5 * PENALTY * float(beta[k, 1:] @ beta[k, 1:])
            if value < best[k] - 1e-9 * abs(best[k]):  # overshot: go back half of the way
                step[k] /= 2
                beta[k] -= step[k]
                moved = max(moved, float(np.abs(step[k]).max()))
                continue
            best[k] = value
            hessian = penalty.copy()
            for (i, j), value in zip(pairs, sums, strict=False):
                hessian[i, j] += value
                hessian[j, i] = hessian[i, j]
            slope = np.array(sums[len(pairs) : -1]) - penalty @ beta[k]
            step[k] = np.linalg.solve(hessian, slope)
            beta[k] += step[k]
            moved = max(moved, float(np.abs(step[k]).max()))
        if moved < CONVERGED:
            break
    return [
        LogisticModel(tuple(inputs), float(beta[k, 0]), tuple(beta[k, 1:].tolist()), tuple(means[k].tolist()), tuple(deviations[k].tolist()))
        for k in range(n_models)
    ]


def gradient(df: DataFrame, model: LogisticModel, label: str) -> DataFrame:
    """(``variable``, ``gradient``) of the penalized likelihood at the model, over its training rows: 0 at the optimum."""
    row = df.agg(count_rows().alias("n"), F.count_if(F.col(label) == 1).alias("pos")).first()
    n, pos = row["n"], row["pos"]
    weight = F.when(F.col(label) == 1, n / (2 * max(pos, 1))).otherwise(n / (2 * max(n - pos, 1)))
    miss = weight * (F.col(label) - model.probability())
    slopes = {"(intercept)": F.sum(miss)} | {
        c: F.sum(miss * z) - PENALTY * b for c, z, b in zip(model.inputs, model.scaled(), model.coefficients, strict=True)
    }
    return df.agg(*[v.alias(k) for k, v in slopes.items()]).unpivot([], [f"`{k}`" for k in slopes], "variable", "gradient")
