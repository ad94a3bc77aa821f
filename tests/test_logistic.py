"""Reweighted least squares against numpy, several models against one at a time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientele.operators.logistic import LogisticModel, fit, gradient

INPUTS = ("a", "b", "c")


def table(spark, n=400, seed=1, separable=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2)) * [3, 100] + [5, -20]
    y = (x[:, 0] - 5 + (0 if separable else rng.normal(size=n) * 2) > 1).astype(int)
    rows = [(i, int(y[i]), float(x[i, 0]), float(x[i, 1]), 7.0, i % 3) for i in range(n)]
    return spark.createDataFrame(rows, "id int, y int, a double, b double, c double, fold int").repartition(3)


def by_numpy(rows):
    x = np.array([[r.a, r.b, r.c] for r in rows])
    y = np.array([r.y for r in rows], dtype=float)
    d = x.std(axis=0, ddof=1)
    z = np.divide(x - x.mean(axis=0), d, out=np.zeros_like(x), where=d > 1e-12)
    z = np.c_[np.ones(len(z)), z]
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    beta, ridge = np.zeros(4), np.diag([0, 1, 1, 1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ beta))
        beta = beta + np.linalg.solve((z * (w * p * (1 - p))[:, None]).T @ z + ridge, z.T @ (w * (y - p)) - ridge @ beta)
    return beta


@pytest.mark.parametrize("separable", [False, True])
def test_one_model_is_the_optimum(spark, separable):
    df = table(spark, separable=separable)
    model = fit(df, INPUTS, "y", F.array(F.lit(0)), 1)[0]
    assert [model.intercept, *model.coefficients] == pytest.approx(by_numpy(df.collect()), abs=1e-8)
    slopes = {r.variable: r.gradient for r in gradient(df, model, "y").collect()}
    assert set(slopes) == {"(intercept)", *INPUTS} and max(map(abs, slopes.values())) < 1e-7


def test_several_models_equal_one_at_a_time(spark):
    df = table(spark)
    together = fit(df, INPUTS, "y", F.filter(F.sequence(F.lit(0), F.lit(2)), lambda m: m != F.col("fold")), 3)
    for k, model in enumerate(together):
        alone = fit(df.filter(F.col("fold") != k), INPUTS, "y", F.array(F.lit(0)), 1)[0]
        assert [model.intercept, *model.coefficients] == pytest.approx([alone.intercept, *alone.coefficients], abs=1e-9)


def test_saved_models_score_alike(spark, tmp_path):
    df = table(spark)
    model = fit(df, INPUTS, "y", F.array(F.lit(0)), 1)[0]
    model.save(spark, str(tmp_path / "m"))
    again = LogisticModel.load(spark, str(tmp_path / "m"))
    assert again == model
    assert df.filter(again.probability() != model.probability()).isEmpty()


def test_one_class_and_no_rows(spark):
    df = table(spark).withColumn("y", F.lit(0))
    model = fit(df, INPUTS, "y", F.array(F.lit(0)), 1)[0]
    assert df.agg(F.max(model.probability())).first()[0] < 0.01
    with pytest.raises(ValueError):
        fit(df.limit(0), INPUTS, "y", F.array(F.lit(0)), 1)
