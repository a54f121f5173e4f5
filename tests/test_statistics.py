"""Buckets, response analysis, correlation, logit and cleaning against numpy and pandas."""

import math

import numpy as np
import pandas as pd
import pytest

from pavilion.operators import buckets, cleaning, correlation, logit, pairs, response

COLUMNS = ["a", "b", "c"]
ORDER = ["day", "id"]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(11)
    n = 211
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "day": rng.integers(0, 30, n),
            "a": rng.normal(size=n).round(3),
            "b": rng.integers(-3, 4, n).astype(float),
            "c": np.where(rng.random(n) < 0.4, 0.0, rng.exponential(size=n)),
        }
    )
    pdf["y"] = (rng.random(n) < 1 / (1 + np.exp(-pdf.a))).astype(int)
    return pdf


@pytest.fixture(scope="module")
def df(spark, frame):
    return spark.createDataFrame(frame).repartition(3).persist()


def test_zscore_filter(df, frame):
    spread = frame[COLUMNS]
    z = (spread - spread.mean()) / spread.std(ddof=0)
    want = set(frame.id[(z.abs() < 1.5).all(axis=1)])
    assert {r.id for r in cleaning.zscore_filter(df, COLUMNS, 1.5).collect()} == want


def test_constant_column_removes_every_row(df):
    from pyspark.sql import functions as F

    assert cleaning.zscore_filter(df.withColumn("k", F.lit(3.0)), ["a", "k"]).count() == 0


def test_equal_width_buckets(df, frame):
    got = buckets.equal_width_long(df, COLUMNS, ["id"]).toPandas()
    for c in COLUMNS:
        mine = got[got.feature == c].set_index("id").bucket.sort_index()
        want = pd.cut(frame.set_index("id")[c], 8, labels=False)
        assert (mine == want).all()


def test_constant_column_has_one_middle_bucket(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id long, k double")
    got = {r.bucket for r in buckets.equal_width_long(rows, ["k"], ["id"]).collect()}
    assert len(got) == 1 and got <= {3, 4}


@pytest.mark.parametrize("strategy", ["window", "distributed"])
def test_equal_count_buckets(df, frame, strategy):
    long = buckets.equal_count_long(df, COLUMNS, ORDER, strategy=strategy).toPandas()
    wide = buckets.with_equal_count_buckets(df, COLUMNS, ORDER, strategy=strategy).toPandas()
    placed = frame.sort_values(ORDER)
    for c in COLUMNS:
        want = pd.qcut(placed[c].rank(method="first"), 10, labels=False)
        want.index = placed.id
        mine = long[long.feature == c].set_index("id").bucket
        assert (mine.sort_index() == want.sort_index()).all()
        assert (wide.set_index("id")[f"bucket_{c}"].sort_index() == want.sort_index()).all()


def test_few_rows_still_get_buckets(spark):
    rows = spark.createDataFrame([(i, 0, float(i)) for i in range(4)], "id long, day int, a double")
    want = pd.qcut(pd.Series(range(1, 5)), 10, labels=False).tolist()
    long = buckets.equal_count_long(rows, ["a"], ORDER).orderBy("id").collect()
    wide = buckets.with_equal_count_buckets(rows, ["a"], ORDER).orderBy("id").collect()
    assert [r.bucket for r in long] == want and [r.bucket_a for r in wide] == want


def test_feature_msd(df, frame):
    got = {r.feature: r for r in response.feature_msd(df, COLUMNS, "y").collect()}
    rate = frame.y.mean()
    for c in COLUMNS:
        bins = frame.groupby(pd.cut(frame[c], 8, labels=False)).y.agg(["count", "mean"])
        gap = (bins["mean"] - rate) ** 2
        assert got[c].mean_sq_diff == pytest.approx(gap.sum())
        assert got[c].mean_sq_diff_weighted == pytest.approx((gap * bins["count"] / len(frame)).sum())


def test_pair_grid_and_msd(df, frame):
    grid = pairs.bucket_grid(df, COLUMNS, "y", ORDER).toPandas()
    assert len(grid) == 300
    assert (grid.groupby(["feature_1", "feature_2"]).bin_count.sum() == len(frame)).all()
    assert grid[grid.bin_count == 0].bin_mean.isna().all()
    msd = {(r.feature_1, r.feature_2): r for r in pairs.pair_msd(df, COLUMNS, "y", ORDER).collect()}
    placed = frame.sort_values(ORDER)
    tenth = {c: pd.qcut(placed[c].rank(method="first"), 10, labels=False) for c in COLUMNS}
    for (a, b), row in msd.items():
        bins = placed.groupby([tenth[a], tenth[b]]).y.agg(["count", "mean"])
        gap = (bins["mean"] - frame.y.mean()) ** 2
        assert row.mean_sq_diff == pytest.approx(gap.sum())
        assert row.mean_sq_diff_weighted == pytest.approx((gap * bins["count"]).sum() / len(frame))
    matrix = pairs.grid_matrix(pairs.bucket_grid(df, COLUMNS, "y", ORDER))
    assert matrix.count() == 30 and matrix.columns[3:] == [f"b{i}" for i in range(10)]


def test_correlation(df, frame):
    got = {(r.feature_1, r.feature_2): r.correlation for r in correlation.correlation_matrix(df, COLUMNS).collect()}
    want = frame[COLUMNS].corr()
    for (a, b), r in got.items():
        assert r == pytest.approx(want.loc[a, b])
    assert correlation.correlation_pairs(df, COLUMNS).count() == 3


def test_histogram_and_density(df, frame):
    hist = response.class_histogram(df, ["a"], "y").toPandas()
    for y, part in frame.groupby("y"):
        want = np.floor((part.a - part.a.min()) / 0.2).value_counts()
        got = hist[hist.y == y].set_index("bin").bin_count
        assert got.to_dict() == {int(k): v for k, v in want.items()}
    curve = response.class_density(df, ["a", "c"], "y").toPandas()
    assert len(curve) == 2 * 2 * 500
    for (c, y), part in curve.groupby(["feature", "y"]):
        x = frame[frame.y == y][c].to_numpy()
        h = x.std(ddof=1) * len(x) ** -0.2
        part = part.sort_values("point")
        u = (part.x.to_numpy()[:, None] - x[None, :]) / h
        want = np.exp(-u * u / 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))
        assert np.allclose(part.density, want, rtol=1e-9, atol=1e-15)


def test_trend_and_categories(df, frame):
    got = {r.feature: r for r in response.linear_trend(df, COLUMNS, "y").collect()}
    for c in COLUMNS:
        slope, intercept = np.polyfit(frame[c], frame.y, 1)
        assert got[c].slope == pytest.approx(slope) and got[c].intercept == pytest.approx(intercept)
    table = {r.category: (r.response_0, r.response_1) for r in response.category_counts(df, "b", "y").collect()}
    want = pd.crosstab(frame.b, frame.y)
    assert table == {k: (v[0], v[1]) for k, v in zip(want.index, want.to_numpy())}
    bins = frame.groupby("b").y.agg(["count", "mean"])
    gap = (bins["mean"] - frame.y.mean()) ** 2
    assert response.category_msd(df, "b", "y").head().mean_sq_diff == pytest.approx(gap.sum())


def newton(x, y):
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ beta))
        hessian = (design * (p * (1 - p))[:, None]).T @ design
        beta = beta + np.linalg.solve(hessian, design.T @ (y - p))
    return beta, np.sqrt(np.linalg.inv(hessian)[1, 1])


def test_logit(df, frame):
    got = {r.feature: r for r in logit.univariate_logit(df, COLUMNS, "y").collect()}
    for c in COLUMNS:
        beta, error = newton(frame[c].to_numpy(), frame.y.to_numpy())
        z = beta[1] / error
        assert got[c].intercept == pytest.approx(beta[0])
        assert got[c].t_value == pytest.approx(z)
        assert got[c].p_value == pytest.approx(math.erfc(abs(z) / math.sqrt(2)))
    text = {r.feature: r.p_value for r in logit.formatted(logit.univariate_logit(df, ["a"], "y")).collect()}
    assert text["a"] == f"{got['a'].p_value:.6e}"


def test_logit_without_a_fit_is_null(spark):
    rows = [(float(i), 1.0, int(i >= 10)) for i in range(20)]
    df = spark.createDataFrame(rows, "apart double, constant double, y int")
    for r in logit.univariate_logit(df, ["apart", "constant"], "y").collect():
        assert r.t_value is None and r.p_value is None


def test_result_does_not_depend_on_partitions(spark, df):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        seen = []
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            long = buckets.equal_count_long(df, COLUMNS, ORDER, strategy="distributed")
            seen.append(sorted(map(tuple, long.collect())))
        assert seen[0] == seen[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
