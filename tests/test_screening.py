"""Screening on a table with planted noise columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import learn, screening
from tests.test_boosting import vectors

NAMES = ["step", "noise_a", "line", "noise_b", "same"]


@pytest.fixture(scope="module")
def planted(spark):
    """The noise columns look like the others, and one column is constant; rows come sorted by the signal."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(3000, 5))
    x[:, 4] = 1.0
    x = x[np.argsort(x[:, 2])]
    y = 3 * (x[:, 0] > 0) + 2 * x[:, 2] + rng.normal(0, 0.3, 3000)
    return vectors(spark, x, y)


def boosters():
    return learn.boosted_trees(depth=3, step=0.5, rounds=12, feature_share=1.0)


def test_noise_goes_and_signal_stays(planted):
    for make in (boosters, learn.absolute_linear):
        found = screening.screen(planted, make, 3, NAMES)
        assert found.names == ["step", "line"]
        assert found.after <= found.before * 1.1
        ranked = found.importances.orderBy("rank").collect()
        assert {ranked[0].feature, ranked[1].feature} == {"step", "line"} and [r.rank for r in ranked] == [1, 2, 3, 4, 5]
        assert {r.feature: r.importance for r in ranked}["same"] == 0.0


def test_importance_is_the_loss_of_a_shuffled_column(planted):
    """Against a plain shuffle of the held-out rows."""
    fitted = learn.cross_fit(planted, learn.absolute_linear, 3)
    got = {r.feature: r.importance for r in screening.permutation_importance(planted, fitted, NAMES).collect()}
    again = {r.feature: r.importance for r in screening.permutation_importance(planted.repartition(5), fitted, NAMES).collect()}
    table = planted.select("fold", "label", screening.vector_to_array("features").alias("x")).toPandas()
    x, y, fold, rng = np.array(table.x.tolist()), table.label.to_numpy(), table.fold.to_numpy(), np.random.default_rng(0)
    for j, name in enumerate(NAMES):
        errors = {False: 0.0, True: 0.0}
        for m, model in enumerate(fitted.models):
            own = fold == m
            for shuffled in errors:
                xm = x[own].copy()
                xm[:, j] = rng.permutation(xm[:, j]) if shuffled else xm[:, j]
                errors[shuffled] += np.abs(y[own] - model.predict_matrix(xm)).sum() / len(y)
        assert got[name] == pytest.approx(errors[True] - errors[False], rel=0.1, abs=0.02)
        assert got[name] == pytest.approx(again[name], rel=1e-9, abs=1e-9)


def test_something_stays(planted):
    nothing = planted.withColumn("label", F.lit(1.0))
    assert len(screening.screen(nothing, boosters, 3, NAMES).names) == 1
