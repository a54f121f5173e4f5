import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from pavilion.operators import classifiers, discriminant, folds, importance, metrics, moments, neighbours, network, vectors
from pavilion.plans import model_selection


def labelled(spark, n=160, d=4, seed=1, duplicates=0.3):
    """Two classes; a share of all rows is the same point, so that it forms a hot cell."""
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    x = rng.normal(size=(n, d)) + y[:, None]
    same = rng.random(n) < duplicates
    x[same] = 0.25
    rows = [(int(i), float(y[i]), [float(v) for v in x[i]]) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, label double, v array<double>").repartition(3)
    return vectors.from_array(df, "v", ["id", "label"]).persist(), x, y


@pytest.mark.parametrize(
    "options",
    [
        {"strategy": "broadcast"},
        {"strategy": "cells", "pivot_count": 6, "block_rows": 8},
        {"strategy": "cells", "pivot_count": 1, "block_rows": 1000},
    ],
)
def test_nearest_neighbours_are_exact(spark, options):
    df, x, y = labelled(spark)
    train, test = df.where("id % 4 != 0"), df.where("id % 4 = 0")
    found = neighbours.nearest_neighbours(train, test, 5, **options).collect()
    train_ids = np.array([i for i in range(len(x)) if i % 4])
    for i in range(0, len(x), 4):
        dist = np.sqrt(((x[train_ids] - x[i]) ** 2).sum(axis=1))
        want = train_ids[np.lexsort((train_ids, dist))[:5]].tolist()
        assert [r.train_id for r in sorted(found, key=lambda r: r["rank"]) if r.test_id == i] == want


def test_fewer_training_rows_than_neighbours(spark):
    df, *_ = labelled(spark, n=20)
    train, test = df.where("id < 3"), df.where("id >= 15")
    for strategy in ("broadcast", "cells"):
        assert neighbours.nearest_neighbours(train, test, 5, strategy, 2).count() == 15


def test_equal_training_rows_are_limited_before_the_shuffle(spark):
    df, *_ = labelled(spark)
    limited = neighbours.lowest_of_equal(neighbours._rows(df, "train_id"), 5)
    text = limited._jdf.queryExecution().executedPlan().toString()
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")
    assert limited.groupBy("vector").count().agg(F.max("count")).head()[0] == 5


def test_vote_takes_the_lower_label_on_a_tie(spark):
    rows = [(1, 0.0), (1, 1.0), (2, 1.0), (2, 1.0), (2, 0.0)]
    out = neighbours.vote(spark.createDataFrame(rows, "test_id long, label double")).collect()
    assert {r.id: (r.yhat, round(r.score, 3)) for r in out} == {1: (0.0, 0.5), 2: (1.0, 0.667)}


def test_discriminant(spark):
    df, x, y = labelled(spark, duplicates=0.1)
    stats = discriminant.discriminant_stats(df)
    centred = x - np.array([x[y == k].mean(axis=0) for k in (0, 1)])[y]
    pooled = centred.T @ centred / (len(x) - 2)
    assert np.allclose(stats.pooled, pooled)
    out = {r.id: (r.yhat, r.score) for r in discriminant.fit_predict(df, df, ["id"]).collect()}
    inverse = np.linalg.inv(pooled)
    means = np.array([x[y == k].mean(axis=0) for k in (0, 1)])
    scores = x @ inverse @ means.T - 0.5 * np.diag(means @ inverse @ means.T) + np.log(np.bincount(y) / len(y))
    for i in range(len(x)):
        assert out[i][0] == scores[i].argmax()
        assert out[i][1] == pytest.approx(scores[i, 1] - scores[i, 0])


def test_standardise_and_components(spark):
    df, x, _ = labelled(spark, d=5)
    scaler = vectors.Standardiser.fit(df)
    scaled = {r.id: r.features.toArray() for r in scaler.transform(df).collect()}
    want = (x - x.mean(axis=0)) / x.std(axis=0)
    assert np.allclose(np.array([scaled[i] for i in range(len(x))]), want)
    parts = vectors.Components.fit(df)
    _, singular, axes = np.linalg.svd(want, full_matrices=False)
    ratios = singular**2 / (singular**2).sum()
    assert np.allclose(parts.ratios, ratios)
    assert parts.kept == int(np.searchsorted(ratios.cumsum(), 0.95, side="right")) + 1
    for k, loading in enumerate(parts.loadings):
        assert abs(np.dot(loading, axes[k])) == pytest.approx(1.0)
        assert max(loading, key=abs) > 0
    scores = {r.id: r.features.toArray() for r in parts.transform(df).collect()}
    projected = want @ np.array(parts.loadings[: parts.kept]).T
    assert np.allclose(np.array([scores[i] for i in range(len(x))]), projected)
    table = vectors.variance_table(df, parts).orderBy("component").collect()
    assert table[-1].cumulative_ratio == pytest.approx(ratios[: parts.kept].sum())


def test_moments_merge_per_class_in_one_read(spark):
    df, x, y = labelled(spark, n=300, d=5)
    shifted = df.where("id < 290").repartition(7)
    found = moments.class_moments(shifted, F.col("label"))
    assert list(found) == [0.0, 1.0]
    for k, m in found.items():
        own = x[:290][y[:290] == k]
        assert m.rows == len(own) and np.allclose(m.mean, own.mean(axis=0))
        assert np.allclose(m.covariance(), np.cov(own.T))
    whole = moments.class_moments(shifted)[None]
    assert np.allclose(whole.correlation(), np.corrcoef(x[:290].T))
    assert np.allclose(whole.deviations(), x[:290].std(axis=0))
    far = moments.Moments.of(x + 1e9) + moments.Moments.of(x + 1e9)
    assert np.allclose(far.scatter, 2 * len(x) * np.cov(x.T, ddof=0), rtol=1e-4)
    one = moments.Moments.of(np.array([[1.0, 2.0], [1.0, 3.0]]))
    assert one.deviations()[0] == 0 and np.isnan(one.correlation()[0, 1])
    assert moments.class_moments(df.limit(0), F.col("label")) == {}


def test_zero_row_stays_zero(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 3.0, 4.0)], "id long, a double, b double")
    out = {r.id: list(r.features.toArray()) for r in model_selection.normalised(df, ["a", "b"], ["id"]).collect()}
    assert out == {1: [0.0, 0.0], 2: [0.6, 0.8]}


@pytest.mark.parametrize("strategy", ["window", "distributed"])
def test_metrics(spark, strategy):
    rng = np.random.default_rng(4)
    y, score = rng.integers(0, 2, 90), rng.integers(0, 6, 90) / 2
    yhat = (score > 1.2).astype(int)
    rows = [("M", i % 2, i, int(y[i]), int(yhat[i]), float(score[i])) for i in range(90)]
    df = spark.createDataFrame(rows, "model string, fold int, id long, y int, yhat int, score double")
    got = {(r.fold, r.metric): r.value for r in metrics.fold_metrics(df, strategy).collect()}
    for fold in (0, 1):
        a, b, s = y[fold::2], yhat[fold::2], score[fold::2]
        pos, neg = s[a == 1], s[a == 0]
        wins = (pos[:, None] > neg[None, :]).mean() + (pos[:, None] == neg[None, :]).mean() / 2
        assert got[fold, "roc_auc"] == pytest.approx(wins)
        assert got[fold, "accuracy"] == pytest.approx((a == b).mean())
        p = [((a == k) & (b == k)).sum() / (b == k).sum() for k in (0, 1)]
        r = [((a == k) & (b == k)).sum() / (a == k).sum() for k in (0, 1)]
        share = [(a == k).mean() for k in (0, 1)]
        assert got[fold, "precision_weighted"] == pytest.approx(np.dot(p, share))
        f1 = [2 * u * v / (u + v) for u, v in zip(p, r)]
        assert got[fold, "f1_weighted"] == pytest.approx(np.dot(f1, share))


def test_boxplot_leaves_out_far_values(spark):
    rows = [("M", i, "accuracy", v) for i, v in enumerate([0.1, 0.5, 0.52, 0.54, 0.56])]
    row = metrics.fold_boxplot(spark.createDataFrame(rows, "model string, fold int, metric string, value double")).head()
    assert (row["median"], row.low_whisker, row.high_whisker) == (0.52, 0.5, 0.56)


def test_folds_cover_every_row(spark):
    df = folds.with_folds(spark.range(1000), "id")
    sizes = {r.fold: r["count"] for r in df.groupBy("fold").count().collect()}
    assert set(sizes) == set(range(5)) and sum(sizes.values()) == 1000 and min(sizes.values()) > 150


def test_cross_validation_predicts_every_row_once(spark):
    rng = np.random.default_rng(9)
    y = rng.integers(0, 2, 150)
    rows = [(i, int(y[i]), float(rng.normal() + 2 * y[i]), float(rng.normal())) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, won int, a double, b double").repartition(2)
    models = {
        "LDA": discriminant.fit_predict,
        "KNN": neighbours.knn_predict,
        "CART": lambda a, b, k: model_selection.MODELS["CART"](a, b, k, max_depth=3),
        "RF": lambda a, b, k: model_selection.MODELS["RF"](a, b, k, size=5, max_depth=3),
        "SVM": lambda a, b, k: model_selection.MODELS["SVM"](a, b, k, size=40),
    }
    for features, used in (("normalised", models), ("pca", {k: models[k] for k in ("LDA", "KNN")})):
        out = model_selection.cross_validate(df, ["a", "b"], "won", features, used, folds=2)
        rows = len(used) * 150
        assert out.count() == rows and out.select("model", "id").distinct().count() == rows
        for row in metrics.model_means(metrics.fold_metrics(out)).where("metric = 'accuracy'").collect():
            assert row.mean_value > 0.65, (features, row)
    shared = model_selection.cross_validate(
        df, ["a", "b"], "won", "pca", {"LDA": discriminant.fit_predict}, folds=2, fit_scope="all"
    )
    assert shared.count() == 150


def test_held_out_net(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i % 7, int(i % 2), float(rng.normal() + 3 * (i % 2)), 1.0) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, day int, won int, a double, b double")
    options = network.Options(hidden=(6,), epochs=12)
    run = model_selection.held_out_net(df, ["a", "b"], "won", ["day", "id"], 90, options)
    assert run.predictions.count() == 30
    curve = run.history.orderBy("epoch").collect()
    assert [r.epoch for r in curve] == list(range(1, 13))
    assert curve[-1].loss < curve[0].loss
    held_out = model_selection.accuracy(run.predictions).head().accuracy
    assert held_out > 0.7 and held_out == curve[-1].test_accuracy


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(1)
    net = network.Net.random([3, 5, 4, 1], seed=2)
    x, y = rng.normal(size=(20, 3)), rng.integers(0, 2, 20).astype(float)
    flat, found = net.flat(), net.gradient(x, y)
    for i in range(0, len(flat), 3):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        up, down = (network.log_loss(net.like(flat + s).odds(x), y).sum() for s in (step, -step))
        assert found[i] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_steps_do_not_depend_on_partitions(spark, monkeypatch):
    df, *_ = labelled(spark, n=90)
    rows = df.withColumn("is_test", F.col("id") >= 70)
    options = network.Options(hidden=(4,), epochs=3, batches=3)
    one = network.train(rows.coalesce(1), options)
    monkeypatch.setattr(network, "FAN", 2)  # more than one level of sums
    many = network.train(rows.repartition(5), options)
    assert np.allclose(one.net.flat(), many.net.flat())
    assert np.allclose(one.history, many.history)


def exact_machine(x, y, gamma, penalty=1.0, steps=4000):
    """Dual of the kernel machine, the pair that violates it most at a time; the score of rows."""
    k = classifiers.kernel(x, x, gamma)
    sign = np.where(y == 1, 1.0, -1.0)
    a, slope = np.zeros(len(y)), -np.ones(len(y))
    for _ in range(steps):
        up = ((sign > 0) & (a < penalty)) | ((sign < 0) & (a > 0))
        down = ((sign > 0) & (a > 0)) | ((sign < 0) & (a < penalty))
        score = -sign * slope
        i, j = np.flatnonzero(up)[score[up].argmax()], np.flatnonzero(down)[score[down].argmin()]
        if score[i] - score[j] < 1e-6:
            break
        curve = max(k[i, i] + k[j, j] - 2 * k[i, j], 1e-12)
        move = (score[i] - score[j]) / curve
        move = min(move, penalty - a[i] if sign[i] > 0 else a[i], a[j] if sign[j] > 0 else penalty - a[j])
        a[i] += sign[i] * move
        a[j] -= sign[j] * move
        slope += sign * move * (k[i] - k[j])
    bias = (score[i] + score[j]) / 2
    return lambda z: classifiers.kernel(z, x, gamma) @ (a * sign) + bias


def test_kernel_machine_agrees_with_an_exact_one(spark):
    rng = np.random.default_rng(6)
    n = 500
    x = rng.normal(size=(n, 4))
    y = ((x**2).sum(axis=1) + rng.normal(size=n) * 0.5 > 3.5).astype(int)
    rows = [(i, float(y[i]), [float(v) for v in x[i]]) for i in range(n)]
    df = vectors.from_array(spark.createDataFrame(rows, "id long, label double, v array<double>"), "v", ["id", "label"])
    train, test = df.where("id < 300"), df.where("id >= 300")
    gamma = classifiers.kernel_scale(train)
    assert gamma == pytest.approx(1 / (4 * x[:300].var()))
    exact = exact_machine(x[:300], y[:300], gamma)(x[300:])
    scored = classifiers.svm_predict(train, test, ["id", "label"], size=200).orderBy("id").collect()
    agree = np.mean([(r.score > 0) == (e > 0) for r, e in zip(scored, exact)])
    assert agree >= 0.97
    landmarks = classifiers.svm_landmarks(train, 200, "id", 42)
    mean, largest = landmarks.error(test)
    assert mean < 0.005 and largest <= 1
    whole = classifiers.svm_landmarks(train, 300, "id", 42)
    lifted = whole.lift(x[:300])
    assert np.allclose(lifted @ lifted.T, classifiers.kernel(x[:300], x[:300], gamma), atol=1e-6)


def test_kernel_errors_are_those_of_all_pairs(spark, monkeypatch):
    """More rows than one tile, several parts, equal ids and equal rows."""
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(900, 3)), 1)
    rows = [(int(i % 880), [float(v) for v in x[i]]) for i in range(900)]
    df = vectors.from_array(spark.createDataFrame(rows, "id long, v array<double>"), "v", ["id"])
    landmarks = classifiers.Landmarks.choose(df, 0.3, 12, "id", 42)
    lifted = landmarks.lift(x)
    apart = np.abs(lifted @ lifted.T - classifiers.kernel(x, x, 0.3))
    monkeypatch.setattr(classifiers, "TILE_ROWS", 64)
    monkeypatch.setattr(classifiers, "TASK_PAIRS", 100_000)
    for size in (900 * 4 * 8, 10_000):
        monkeypatch.setattr(classifiers, "PAIR_BYTES", size)
        mean, largest = landmarks.error(df)
        assert mean == pytest.approx(apart.mean()) and largest == pytest.approx(apart.max())
    assert landmarks.error(df.where("id < 0")) == (None, None)


def test_forest_importance(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(i % 2) + 0.1 * float(rng.normal()), float(rng.normal()), int(i % 2)) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, good double, noise double, won int")
    found = {r.feature: r.forest_importance for r in importance.forest_importance(df, ["good", "noise"], "won", 10, 4).collect()}
    assert sum(found.values()) == pytest.approx(1.0) and found["good"] > found["noise"]


def test_steps_read_no_held_out_rows_and_the_history_reads_them_once(spark, monkeypatch):
    df, *_ = labelled(spark, n=90)
    rows = df.withColumn("is_test", F.col("id") >= 70)
    read = []
    partial_sums, shares = network._partial_sums, network.held_out_shares
    monkeypatch.setattr(network, "_partial_sums", lambda r, *a: read.append(r.count()) or partial_sums(r, *a))
    monkeypatch.setattr(network, "held_out_shares", lambda *a: read.append("held out") or shares(*a))
    trained = network.train(rows, network.Options(hidden=(4,), epochs=3, batches=2))
    assert set(read) == {70}
    assert len(trained.history) == 3 and read.count("held out") == 1
    monkeypatch.setattr(network, "AT_A_READ", 2)
    held_out = rows.where("is_test").select(F.col("id"), F.col("label"), "features")
    for flat, (_, _, _, share) in zip(trained.epochs, trained.history, strict=True):
        scored = network.predict(trained.net.like(flat), held_out, ["id", "label"])
        assert scored.where("label = yhat").count() / 20 == share
    assert [h[3] for h in trained.history] == shares(trained.held_out, trained.net, trained.epochs)


def test_neighbours_by_products_are_those_of_plain_differences():
    """A bound on rounding leaves exact distances and ties as they are, far from the origin too."""
    rng = np.random.default_rng(4)
    cases = [
        (rng.normal(size=(40, 8)), rng.normal(size=(90, 8))),
        (rng.integers(0, 2, (40, 3)).astype(float), rng.integers(0, 2, (90, 3)).astype(float)),
        (1e8 + rng.normal(size=(20, 4)), 1e8 + rng.normal(size=(60, 4))),
        (np.full((3, 2), 1e200), rng.normal(size=(7, 2))),
    ]
    for tests, trains in cases:
        columns, found = neighbours._k_nearest(tests, trains, 5)
        away = neighbours._distances(tests, trains)
        want = np.argsort(away, axis=1, kind="stable")[:, :5]
        assert (columns == want).all()
        assert (found == np.take_along_axis(away, want, axis=1)).all()


def test_test_rows_of_one_file_are_dealt_to_tasks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "TASK_PAIRS", 100)
    rows = [(i, float(i % 2), [float(i), 1.0]) for i in range(40)]
    df = vectors.from_array(spark.createDataFrame(rows, "id long, label double, v array<double>").coalesce(1), "v", ["id", "label"])
    found = neighbours._broadcast_candidates(df, df, 3)
    assert found.rdd.getNumPartitions() == 16
    assert found.count() == 120


def test_a_visit_writes_each_test_row_once(spark, monkeypatch):
    written = {}
    monkeypatch.setattr(neighbours, "stage", lambda df, name, real=neighbours.stage: written.setdefault(name, real(df, name)))
    rows = [(i, float(i % 2), [float(i % 7), float(i % 5)]) for i in range(60)]
    df = vectors.from_array(spark.createDataFrame(rows, "id long, label double, v array<double>"), "v", ["id", "label"])
    cells = {(r.test_id, r.rank): r.train_id for r in neighbours.nearest_neighbours(df, df, 3, "cells", pivot_count=8).collect()}
    assert written["knn-visits"].count() == 60
    assert cells == {(r.test_id, r.rank): r.train_id for r in neighbours.nearest_neighbours(df, df, 3, "broadcast").collect()}


def test_spans_of_products_lose_no_neighbour():
    """More rows than a span and a tile, ties across spans, and squares that are not finite."""
    rng = np.random.default_rng(9)
    many = neighbours.TILE + 3 * neighbours.SPAN + 5
    trains = rng.integers(0, 3, (many, 4)).astype(float)
    trains[: many // 2] += rng.normal(size=(many // 2, 4))
    huge = np.full((many, 2), 1e200)
    for tests, rows in ((trains[::400] + 0.25, trains), (trains[::400], trains[:200]), (huge[:5], huge)):
        with np.errstate(over="ignore", invalid="ignore"):
            columns, found = neighbours._k_nearest(tests, rows, 5)
            away = neighbours._distances(tests, rows)
        want = np.argsort(away, axis=1, kind="stable")[:, :5]
        assert (columns == want).all()
        assert (found == np.take_along_axis(away, want, axis=1)).all()
    spread_out = rng.normal(size=(many, 4))
    row, _ = neighbours._near(spread_out[:20], neighbours._ready(spread_out), many, 5)
    assert 100 <= len(row) < 20 * 64  # far fewer pairs than there are


def test_folds_are_read_from_the_rows_written_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(model_selection, "stage", lambda df, name, real=model_selection.stage: written.append(name) or real(df, name))
    rows = [(i, i % 2, float(i % 7), float(i % 5 + 1)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, won int, a double, b double")
    runs = model_selection.CrossValidation(df, ["a", "b"], "won")
    parts = [runs.part(fold) for fold in range(5)]
    assert written == ["model-input"]
    assert sorted(r.id for _, test in parts for r in test.collect()) == list(range(60))
    for train, test in parts:
        held = {r.id for r in test.collect()}
        assert {r.id for r in train.collect()} == set(range(60)) - held


def test_the_kernel_machine_keeps_no_second_copy_of_the_lifted_rows(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 3))
    rows = [(i, float(v[0] > 0), [float(c) for c in v]) for i, v in enumerate(x)]
    df = vectors.from_array(spark.createDataFrame(rows, "id long, label double, v array<double>"), "v", ["id", "label"])
    monkeypatch.setattr(type(df), "persist", lambda *_: pytest.fail("rows are kept twice"))
    assert classifiers.svm_predict(df, df, ["id"], size=20).count() == 60


def test_folds_are_files_and_few_kernel_machines_run_at_once(spark, monkeypatch):
    df, *_ = labelled(spark, n=60)
    wide = df.select("id", F.col("label").cast("int").alias("won"), F.hash("id").cast("double").alias("a"), F.lit(1.0).alias("b"))
    running, most, lock = set(), [], threading.Lock()

    def fake(train, test, keep):
        with lock:
            running.add(id(test))
            most.append(len(running))
        assert set(r.id for r in train.select("id").collect()).isdisjoint(r.id for r in test.select("id").collect())
        scored = test.select(*keep, F.lit(1.0).alias("yhat"), F.lit(0.5).alias("score")).localCheckpoint()
        with lock:
            running.discard(id(test))
        return scored

    for limit, chains in ((1000, 2), (10, 1)):
        monkeypatch.setattr(model_selection, "ALONE_ROWS", limit)
        most.clear()
        runs = model_selection.CrossValidation(wide, ["a", "b"], "won")
        assert {p.rsplit("/", 2)[-2] for p in runs.base.inputFiles()} == {f"fold={i}" for i in range(5)}
        found = runs.predictions({"SVM": fake})
        assert found.count() == 60 and max(most) <= chains


def test_neighbours_come_to_the_driver_as_columns(spark, monkeypatch):
    df, *_ = labelled(spark, n=40)
    monkeypatch.setattr(type(df), "toPandas", None)
    found = neighbours.nearest_neighbours(df.where("id < 30"), df.where("id >= 30"), 3, strategy="broadcast")
    assert found.count() == 30
