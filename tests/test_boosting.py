import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientele.operators import boosting, ml


def rows(n, seed=5):
    """Customers whose label follows two inputs, with every tenth one against the rule."""
    draw = random.Random(seed)
    for i in range(n):
        x = [draw.randint(0, 400), draw.randint(-5, 5), *[draw.randint(0, 6) for _ in range(6)], draw.random() * 1e6]
        yield (f"c{i:05d}", int((x[0] > 90) + (x[1] < 0) + (x[4] < 2) >= 2) ^ (draw.random() < 0.1), *x, i % 3)


@pytest.fixture(scope="module")
def folded(spark):
    columns = ", ".join(f"{c} double" for c in ml.FEATURES)
    made = [(r[0], r[1], *map(float, r[2:-1]), r[-1]) for r in rows(900)]
    return spark.createDataFrame(made, f"customer_id string, {ml.LABEL} int, {columns}, fold int").repartition(4).cache()


def test_all_folds_at_once_score_as_spark_fits_each(folded, monkeypatch):
    monkeypatch.setitem(ml.DEPTH, "gbt", 3)  # nodes of many rows: in small ones several splits are equally good
    ours = {r.customer_id: r for r in ml.boosted_scores(folded, 3, 42, 5, 2).collect()}
    for m in range(3):
        own = ml.score(ml.train(folded.filter(F.col("fold") != m), "gbt", 42, rounds=5), folded.filter(F.col("fold") == m)).collect()
        assert len(own) == 300
        far = [r for r in own if abs(r.score - ours[r.customer_id].score) > 1e-9]
        assert len(far) <= 3
        assert sum(r.prediction != ours[r.customer_id].prediction for r in own) <= 1
    assert len(ours) == 900


def test_folds_share_their_passes(spark, folded):
    """Five models take as many jobs as two: a pass per level and round, whatever the number of folds."""

    def jobs(k):
        group = f"boosting-{k}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            rows = folded.withColumn("fold", F.pmod(F.hash("customer_id"), F.lit(k)))
            binned = [boosting.Binning(tuple(np.array([100.0 if c == "recency_jours" else 0.5]) for c in ml.FEATURES), 1.0)] * k
            boosting.fit_folds(rows, ml.FEATURES, ml.LABEL, binned, 3, 2, 0.3)
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    assert jobs(2) == jobs(5)


def test_thresholds_part_scaled_values_as_raw_ones():
    known = np.array([0.1, 0.2, 0.3, 7.0, 1e6])
    points = boosting.split_points((known - 3.3) * 0.7, np.ones(5))
    cuts = boosting.raw_cuts(points, known, 3.3, 0.7)
    tried = np.concatenate([known, cuts, np.nextafter(cuts, np.inf), [5.0, -1.0, 2e6]])
    assert (np.searchsorted(cuts, tried) == np.searchsorted(points, (tried - 3.3) * 0.7)).all()
    assert len(boosting.split_points(np.arange(1000.0), np.ones(1000))) == boosting.BINS - 1
    assert len(boosting.split_points(np.ones(10), np.ones(10))) == 0


def test_rows_of_one_class_and_constant_inputs_have_a_score(folded):
    one = folded.select("customer_id", F.lit(1).alias(ml.LABEL), *[F.lit(2.0).alias(c) for c in ml.FEATURES], "fold")
    assert {r.score for r in ml.boosted_scores(one, 3, 42, 2, 2).collect()} == {0.5}
    mixed = folded.select("customer_id", ml.LABEL, *[F.lit(2.0).alias(c) for c in ml.FEATURES], "fold")
    assert len({r.score for r in ml.boosted_scores(mixed, 3, 42, 2, 2).collect()}) <= 3
