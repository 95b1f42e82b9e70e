"""Boosting over all folds against plain computations."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabwright import session
from tabwright.operators import boosting, folds, learn, matrix
from tabwright.operators.boosting import FoldBoosting, Settings, Tree
from tabwright.session import SPREAD


def vectors(spark, x, y, k=3):
    names = [f"x_{i}" for i in range(x.shape[1])]
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["id", *names, "label"])
    return folds.modulo_folds(matrix.as_vector(df, names, keep=["id", "label"]), k, "id")


@pytest.fixture(scope="module")
def skewed(spark):
    """A signal under noise with a long tail, where means are drawn away from the middle."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1500, 3))
    y = 2 * x[:, 0] + np.where(x[:, 1] > 0, 1.0, -1.0) + rng.pareto(1.1, 1500) * 2
    return vectors(spark, x, y)


def mae(df):
    return df.agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]


QUICK = {"depth": 3, "step": 0.3, "rounds": 15, "patience": 15}


def test_absolute_loss_beats_squared_loss_on_skewed_noise(skewed):
    errors = {}
    for loss in ("absolute", "squared"):
        fitted = learn.cross_fit(skewed, lambda loss=loss: learn.boosted_trees(loss=loss, **QUICK), 3)
        errors[loss] = mae(fitted.transform(skewed))
    assert errors["absolute"] < 0.95 * errors["squared"]


def same(a, b):
    return all(np.array_equal(getattr(s, c), getattr(t, c)) for s, t in zip(a, b, strict=True) for c in ("feature", "split", "value"))


def test_rounds_go_on_from_the_stored_state(skewed):
    """Rounds in two steps give the trees of one, and a model is the beginning of the longest one."""
    settings = Settings(**QUICK)
    whole = FoldBoosting(skewed, 3, "fold", settings).advance(7)
    parts = FoldBoosting(skewed, 3, "fold", settings).advance(3)
    short = parts.models()
    parts.advance(4)
    for a, b in zip(whole.progress, parts.progress):
        assert same(a.trees, b.trees) and a.scores == pytest.approx(b.scores, abs=1e-12)
    for before, after, p in zip(short, parts.models(), parts.progress):
        assert before.best_round == np.argmin(p.scores[:3]) + 1 and after.best_round == np.argmin(p.scores) + 1
        assert same(before.trees, after.trees[: before.getNumTrees])


def test_noted_scores_are_those_of_the_models(skewed):
    b = FoldBoosting(skewed, 3, "fold", Settings(**QUICK)).advance(4)
    table = skewed.select("fold", "label", boosting.vector_to_array("features").alias("x")).toPandas()
    for i, (model, p) in enumerate(zip(b.models(), b.progress)):
        own = table[table.fold == i]
        got = np.abs(own.label - model.predict_matrix(np.array(own.x.tolist()))).mean()
        assert got == pytest.approx(min(p.scores), abs=1e-9)


def test_metrics_keep_different_rounds(skewed):
    """The caller's metric decides: one that only likes low predictions keeps the first rounds."""
    rounds = {}
    metrics = {"mean": boosting.mean_absolute, "low": lambda y, p: F.max(p)}
    for name, metric in metrics.items():
        fitted = learn.cross_fit(skewed, lambda metric=metric: learn.boosted_trees(metric=metric, **QUICK), 3)
        rounds[name] = [m.best_round for m in fitted.models]
    assert all(a > b for a, b in zip(rounds["mean"], rounds["low"]))


def test_patience_stops_every_model_for_itself(skewed):
    made = FoldBoosting(skewed, 3, "fold", Settings(depth=2, step=0.9, rounds=60, patience=3)).run()
    for p, model in zip(made.progress, made.models()):
        assert p.done and model.best_round + 3 <= len(p.trees) < 60 and not model.hit_limit


@pytest.mark.parametrize("loss", ["absolute", "squared"])
def test_first_stump_by_hand(spark, skewed, loss):
    settings = Settings(depth=1, rounds=1, step=0.5, rows_share=1.0, feature_share=1.0, min_rows=10, loss=loss)
    model = FoldBoosting(skewed, 3, "fold", settings).advance(1).models()[0]
    table = skewed.filter("fold <> 0").select("label", boosting.vector_to_array("features").alias("x")).toPandas()
    x, y = np.array(table.x.tolist()), table.label.to_numpy()
    middle = np.median if loss == "absolute" else np.mean
    base = middle(y)
    target = np.sign(y - base) if loss == "absolute" else y - base
    best = (0.0, None, None)
    for f in range(3):
        every = np.array([r[0][f] for r in skewed.select(boosting.vector_to_array("features")).collect()])
        for edge in np.unique(np.quantile(every, np.arange(1, 65) / 64, method="inverted_cdf"))[:-1]:
            left = x[:, f] <= edge
            if min(left.sum(), (~left).sum()) >= 10:
                gain = sum(target[side].sum() ** 2 / side.sum() for side in (left, ~left)) - target.sum() ** 2 / len(y)
                best = max(best, (gain, f, edge), key=lambda b: b[0])
    tree = model.trees[0]
    assert model.base == pytest.approx(base) and tree.feature[0] == best[1] and tree.split[0] == best[2]
    left = x[:, best[1]] <= best[2]
    assert tree.value[1:3] == pytest.approx([middle((y - base)[left]), middle((y - base)[~left])])


def test_sums_on_executors_equal_those_on_the_driver(skewed, monkeypatch):
    plain = FoldBoosting(skewed, 3, "fold", Settings(**QUICK)).advance(2)
    monkeypatch.setattr(boosting, "DRIVER_BYTES", 0)
    spread = FoldBoosting(skewed, 3, "fold", Settings(**QUICK)).advance(2)
    assert all(same(a.trees, b.trees) for a, b in zip(plain.progress, spread.progress))


def test_medians_of_many_rows_stay_within_their_bound():
    rng = np.random.default_rng(1)
    parts = [rng.pareto(1.0, n) for n in (20_000, 7, 50_001, 1)]
    points, weights = [], []
    for p in parts:
        b = boosting.Block(np.zeros((len(p), 1), np.uint8), np.full(len(p), -1, np.int16), np.zeros(len(p), np.int64), p, np.zeros((len(p), 1)), b"")
        boosting.TaskContext.get, kept = staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})()), boosting.TaskContext.get
        try:
            (out,) = list(boosting.leaf_residuals(iter([b.batch()]), {0: Tree.empty(1)}, Settings()))
        finally:
            boosting.TaskContext.get = kept
        points += out.column("points").to_pylist()
        weights += out.column("weights").to_pylist()
    every = np.sort(np.concatenate(parts))
    rank = np.searchsorted(every, boosting.leaf_value(points, weights, "absolute")) / len(every)
    assert abs(rank - 0.5) <= 1 / (2 * boosting.MEDIAN_POINTS)


def test_odd_tables(spark):
    """One value per feature, one row, constant labels; rows without label or fold; no rows."""
    x = np.ones((30, 2))
    df = vectors(spark, x, np.r_[np.zeros(15), np.ones(15)])
    model = FoldBoosting(df, 3, "fold", Settings(rounds=2)).run().models()[0]
    assert not model.featureImportances.toArray().any() and model.predict_matrix(x[:1])[0] in (0.0, 0.5, 1.0)
    gone = df.withColumn("label", F.when(F.col("id") < 20, F.col("label"))).withColumn("fold", F.when(F.col("id") >= 5, F.col("fold")))
    assert FoldBoosting(gone, 3, "fold", Settings(rounds=1)).run().models()[0].getNumTrees == 1
    one = FoldBoosting(df.limit(1), 3, "fold", Settings(rounds=1)).run().models()
    assert len(one) == 3
    with pytest.raises(ValueError, match="no labelled rows"):
        FoldBoosting(df.limit(0), 3, "fold", Settings())
    with pytest.raises(ValueError, match="unknown loss"):
        Settings(loss="other")


def test_bin_numbers_take_the_way_of_the_tree():
    """Trees whose nodes partly have no split, to every depth and for chosen rows."""
    rng = np.random.default_rng(3)
    code = np.asfortranarray(rng.integers(0, boosting.BINS, (500, 4)).astype(np.uint8))
    tree = Tree.empty(4)
    tree.feature[:15], tree.split[:15] = rng.integers(0, 4, 15), rng.integers(5, 60, 15)
    tree.feature[[2, 4, 9, 10, 5, 6, 11, 12, 13, 14]] = [-1, 1, -1, 2, -1, -1, -1, -1, -1, -1]
    rows = np.flatnonzero(rng.random(500) < 0.3)
    assert np.array_equal(boosting.placed(tree, code, 4), tree.route(code))
    assert np.array_equal(boosting.placed(tree, code, 4, rows), tree.route(code[rows]))


def test_signs_and_rows_share_a_double():
    rng = np.random.default_rng(4)
    cell, sign = rng.integers(0, 7, 5000), rng.integers(-1, 2, 5000).astype(float)
    packed = boosting.counted(cell, 2.0 * boosting.PACKED_ROWS * sign + 1.0, 8, True)[None]
    found = boosting.unpacked(packed, True)[0]
    assert np.array_equal(found[:, 0], np.bincount(cell, minlength=8)) and np.array_equal(found[:, 1], np.bincount(cell, sign, 8))


def test_predictions_by_places_are_those_of_the_thresholds(skewed):
    model = FoldBoosting(skewed, 3, "fold", Settings(**QUICK)).advance(3).models()[0]
    x = np.random.default_rng(5).normal(size=(300, 3))
    x[0], x[1], x[2] = np.nan, np.inf, -np.inf
    x[3:9, 0] = [t for tree in model.trees for t, f in zip(tree.split, tree.feature) if f == 0][:6]
    plain = model.base + sum(model.step * tree.value[tree.route(x)] for tree in model.trees)
    assert model.predict_matrix(x) == pytest.approx(plain, abs=1e-12)


def test_rows_of_one_file_are_dealt_to_the_cores(spark, skewed, monkeypatch):
    """A table in one file was read by one core in every pass."""
    monkeypatch.setattr(boosting, "TASK_ROWS", 200)
    one, spread = skewed.coalesce(1), spark.conf.get(SPREAD)
    spark.conf.unset(SPREAD)
    try:
        assert FoldBoosting(one, 3, "fold", Settings(**QUICK)).partitions > 1
    finally:
        spark.conf.set(SPREAD, spread)
    assert boosting.tasks_for(one, 1500) == 8 and boosting.tasks_for(one, 100) == 1


def test_what_reaches_the_driver_is_bounded_for_the_whole_fit(skewed, monkeypatch):
    plain = FoldBoosting(skewed, 3, "fold", Settings(**QUICK)).advance(2)
    monkeypatch.setattr(boosting, "DRIVER_BYTES", plain.sent // 2)
    bounded = FoldBoosting(skewed, 3, "fold", Settings(**QUICK)).advance(2)
    assert 0 < bounded.sent <= plain.sent // 2
    assert all(same(a.trees, b.trees) for a, b in zip(plain.progress, bounded.progress))


def test_stored_states_do_not_pile_up(skewed):
    """Every stage left its state and the rows it came from in the shared folder."""
    before = set(session._WRITTEN)
    b = FoldBoosting(skewed, 3, "fold", Settings(**QUICK)).advance(2).advance(2)
    assert [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in set(session._WRITTEN) - before] == ["boosting-state"]
    assert b.state.count() and b.advance(1).rounds == 5


def test_blocks_come_one_at_a_time(spark, skewed):
    """A task's whole part of the state came in one batch, which grew with the rows of a task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    with session.configured(spark, {name: "50"}):
        b = FoldBoosting(skewed.coalesce(1), 3, "fold", Settings(**QUICK))
        sizes = lambda batches: (pa.RecordBatch.from_pydict({"n": [x.num_rows]}) for x in batches)
        with session.configured(spark, boosting.ONE_BLOCK):
            kept = b._step(b.state).persist()
            got = [r.n for r in kept.mapInArrow(sizes, "n long").collect()]
            kept.unpersist()
        assert len(got) >= 20 and max(got) == 1
        assert spark.conf.get(name) == "50"


def test_the_larger_half_of_a_node_is_not_counted(skewed, monkeypatch):
    """Its sums are those of the node less the smaller half; the trees are the same."""
    plain = FoldBoosting(skewed, 3, "fold", Settings(**QUICK)).advance(2)
    monkeypatch.setattr(boosting, "PASS_BYTES", 0)
    asked, grouped = [], FoldBoosting._grouped

    def noted(self, parts, key, sums, *more):
        if key == "node":
            asked.append(parts.groupBy("model").agg(F.count_distinct("node").alias("n")).agg(F.max("n")).first()[0])
        return grouped(self, parts, key, sums, *more)

    monkeypatch.setattr(FoldBoosting, "_grouped", noted)
    halved = FoldBoosting(skewed, 3, "fold", Settings(**QUICK)).advance(2)
    assert asked[:3] == [1, 1, 2]
    assert all(same(a.trees, b.trees) for a, b in zip(plain.progress, halved.progress))
