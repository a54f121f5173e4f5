import datetime as dt
import random

import pytest

from pavilion.operators.prior import prior_stats

SCHEMA = "team string, day date, id long, runs double, wickets long"


def brute(rows):
    out = {}
    for team, day, i, *_ in rows:
        earlier = [r for r in rows if r[0] == team and (r[1], r[2]) < (day, i)]
        runs = [r[3] for r in earlier if r[3] is not None]
        wickets = [r[4] for r in earlier if r[4] is not None]
        out[team, i] = (
            sum(runs) / len(runs) if runs else None,
            sum(wickets) / len(wickets) if wickets else None,
            len(earlier),
        )
    return out


def run(df, strategy, bits=(40, 20)):
    out = prior_stats(
        df, ["team"], "day", "id", {"avg_runs": "runs", "avg_wickets": "wickets"}, {"played": "id"},
        strategy=strategy, block_bits=bits,
    )
    return {(r.team, r.id): (r.avg_runs, r.avg_wickets, r.played) for r in out.collect()}


def table(seed, n=120, hot=0.5):
    rng = random.Random(seed)
    ids = rng.sample(range(10_000), n)
    start = dt.date(2020, 1, 1)
    return [
        (
            "A" if rng.random() < hot else rng.choice("BCD"),
            start + dt.timedelta(days=0 if rng.random() < 0.3 else rng.randrange(6)),
            i,
            None if rng.random() < 0.2 else float(rng.randrange(50)),
            None if rng.random() < 0.2 else rng.randrange(10),
        )
        for i in ids
    ]


@pytest.mark.parametrize("strategy,bits", [("window", (40, 20)), ("distributed", (40, 20)), ("distributed", (8, 4)), ("distributed", (6,))])
def test_equals_brute_force(spark, strategy, bits):
    rows = table(7)
    assert run(spark.createDataFrame(rows, SCHEMA), strategy, bits) == brute(rows)


def test_first_row_and_same_day_order(spark):
    day = dt.date(2020, 5, 1)
    rows = [("A", day, 2, 10.0, 1), ("A", day, 1, 30.0, None)]
    for strategy in ("window", "distributed"):
        out = run(spark.createDataFrame(rows, SCHEMA), strategy)
        assert out == {("A", 1): (None, None, 0), ("A", 2): (30.0, None, 1)}


def test_null_days_and_keys_form_groups(spark):
    rows = [(None, None, 1, 4.0, 1), (None, None, 2, 6.0, 1), (None, dt.date(2020, 1, 1), 3, 8.0, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert run(df, "distributed") == run(df, "window")
    assert run(df, "window")[None, 3] == (5.0, 1.0, 2)


def test_unknown_size_takes_the_distributed_way(spark):
    from pavilion.functions.sizing import pick_strategy

    rdd = spark.sparkContext.parallelize([(1,)])
    assert pick_strategy(spark.createDataFrame(rdd, "a int"), "auto") == "distributed"
    assert pick_strategy(spark.range(3), "auto") == "window"


def test_rows_move_with_each_column_once(spark):
    """The join that places rows reads no column twice, and no sums beside their inputs."""
    rows = spark.range(50).selectExpr("id", "id % 3 team", "id % 5 day", "cast(id as double) a", "id * 2 b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = prior_stats(
            rows, ["team"], "day", "id", {"mean_a": "a", "mean_b": "b"}, {"n": "id"},
            {"id": "id", "day": "day", "team": "team", "same": "a"}, "distributed",
        )
        assert found.where("same <> id").count() == 0
        want = prior_stats(
            rows, ["team"], "day", "id", {"mean_a": "a", "mean_b": "b"}, {"n": "id"},
            {"id": "id", "day": "day", "team": "team", "same": "a"}, "window",
        )
        assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
        joined = found._jdf.queryExecution().optimizedPlan().toString()
        moved = [line for line in joined.split("\n") if "Project" in line and "in_0" in line and "in_1" in line and "at_id" in line]
        assert moved and "size_0" not in moved[-1] and "sum_0" not in moved[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
