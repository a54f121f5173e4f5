"""Properties of the whole chain and of the physical plans."""

import random

import pytest
from fixtures import TEAM_ROWS, ball, balls, match, matches, teams

from pavilion.operators import innings
from pavilion.operators.positions import positions
from pavilion.plans.feature_table import FeatureTable

NAMES = [r[1] for r in TEAM_ROWS]


def season(seed, n=24):
    rng = random.Random(seed)
    games, deliveries = [], []
    for i in range(1, n + 1):
        a, b = rng.sample(NAMES, 2)
        games.append(
            match(
                i, rng.choice(["North", "South", "East", "Quay", None]), a, b, rng.choice([a, b]),
                rng.choice(["bat", "field"]), rng.choice([a, b, None]), on=i // 2,
            )
        )
        for inning, bat, bowl in ((1, a, b), (2, b, a)):
            for k in range(12):
                deliveries.append(
                    ball(
                        i, inning, bat, bowl, rng.choice("PQR"), rng.choice([0, 1, 4, 6, 30]),
                        over=1 + k // 6, wide=int(rng.random() < 0.1),
                        out="P" if rng.random() < 0.2 else "",
                    )
                )
    return games, deliveries


def table(spark, games, deliveries, strategy="auto"):
    return FeatureTable(teams(spark), matches(spark, games), balls(spark, deliveries), strategy=strategy)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def by_id(df):
    return {r.id: tuple(r) for r in df.collect()}


def test_no_leakage(spark):
    games, deliveries = season(1)
    before = by_id(table(spark, games, deliveries).home_stats)
    changed = [list(g) for g in games]
    target = changed[14]
    target[8] = target[5] if target[8] != target[5] else target[4]
    louder = [(*d[:7], 6, *d[8:]) if d[0] == target[0] else d for d in deliveries]
    after = by_id(table(spark, [tuple(g) for g in changed], louder).home_stats)
    won = [i for i, c in enumerate(table(spark, games, deliveries).home_stats.columns) if c == "Home_team_Win"][0]
    same = 0
    for i, row in before.items():
        if (games[i - 1][3], i) <= (target[3], target[0]):
            assert row[:won] + row[won + 1 :] == after[i][:won] + after[i][won + 1 :]
            same += 1
    assert same > 5 and before != after


def test_strategies_agree_on_the_final_table(spark):
    games, deliveries = season(2)
    window = by_id(table(spark, games, deliveries, "window").final_diff)
    blocks = by_id(table(spark, games, deliveries, "distributed").final_diff)
    assert window.keys() == blocks.keys() and len(window) > 10
    for i in window:
        assert window[i][:5] == blocks[i][:5]
        for x, y in zip(window[i][5:-1], blocks[i][5:-1]):
            assert x == y if x is None or y is None else x == pytest.approx(y, abs=1e-9)


def test_ratio_of_zero_is_null(spark):
    games, deliveries = season(3)
    t = table(spark, games, deliveries)
    stats = {r.id: r for r in t.match_stats.collect()}
    zero = 0
    for r in t.final_ratio.collect():
        if stats[r.id].Away_Centuries == 0:
            assert r.Centuries is None
            zero += 1
    assert zero > 0 and "Net_Run_Rate" not in t.final_ratio.columns


def test_balls_are_read_once(spark, tmp_path):
    _, deliveries = season(4)
    path = str(tmp_path / "balls")
    balls(spark, deliveries).write.parquet(path)
    rolled = innings.roll_up(innings.batter_parts(spark.read.parquet(path)))
    assert plan(rolled).count("FileScan parquet") == 1


def test_one_shuffle_per_window_specification(spark, tmp_path):
    games, deliveries = season(5)
    t = table(spark, games, deliveries, "window")
    assert plan(t.batting_form).count("Exchange") == 1
    assert plan(t.game_form).count("Exchange") == 2


def test_positions_have_no_single_partition(spark):
    spread = positions(spark.range(500).selectExpr("id", "id % 7 as v"), ["v", "id"], strategy="distributed")
    assert "SinglePartition" not in plan(spread)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    games, deliveries = season(6)
    path = str(tmp_path / "balls")
    balls(spark, deliveries).write.parquet(path)
    parts = innings.batter_parts(spark.read.parquet(path).where("match_id = 3"))
    text = plan(parts.select("match_id", "wickets"))
    assert "EqualTo(match_id,3)" in text and "noball_runs" not in text.split("ReadSchema")[1]


@pytest.mark.parametrize("strategy", ["window", "distributed"])
def test_both_sides_join_the_form_by_match_alone(spark, strategy):
    games, deliveries = season(6)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(before, ("-1", "false"), strict=True):
        spark.conf.set(k, v)
    try:
        whole = table(spark, games, deliveries, strategy)
        text = plan(whole.named_match_stats)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # the joins meet by match; a shuffle by (match, team) would move games and form again
    sides = [line for line in text.splitlines() if "SortMergeJoin [id#" in line]
    assert len(sides) == 2 and all("[form_id#" in line for line in sides)
    shuffles = [line for line in text.splitlines() if " Exchange hashpartitioning(id#" in line]
    assert shuffles and not any("_team#" in line for line in shuffles)
