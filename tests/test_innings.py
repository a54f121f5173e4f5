from fixtures import ball, balls, match, matches

from pavilion.operators import innings
from pavilion.plans.feature_table import FeatureTable
from pavilion.sources import star_schema


def one(spark, rows):
    return innings.roll_up(innings.batter_parts(balls(spark, rows))).collect()[0]


def test_absent_events_are_null(spark):
    row = one(spark, [ball(1, 1, "Reds", "Blues", "A", 1), ball(1, 1, "Reds", "Blues", "B", 2, out=None)])
    assert row.Number_4s is None and row.Number_6s is None and row.Dot_Balls is None
    assert row.Number_Wickets is None and row.BattingAverage is None and row.Bowling_Index is None
    assert (row.Total_Runs, row.Total_Balls, row.Bowling_Econ) == (3, 2, 3.0)


def test_counts_and_ratios(spark):
    rows = [
        ball(1, 2, "Reds", "Blues", "A", 4),
        ball(1, 2, "Reds", "Blues", "A", 6, over=2, out="A"),
        ball(1, 2, "Reds", "Blues", "B", 0, over=2),
        ball(1, 2, "Reds", "Blues", "B", 0, over=2, wide=1),
        ball(1, 2, "Reds", "Blues", "B", 1, over=3, bye=1),
        ball(1, 2, "Reds", "Blues", "B", 0, over=3, penalty=5, out="B"),
    ]
    row = one(spark, rows)
    assert (row.inning, row.bowling_team, row.Total_Runs, row.Total_Balls, row.Overs) == (2, "Blues", 18, 6, 3)
    assert (row.Total_wide, row.Bye_Runs, row.penalty_runs, row.Extra_runs) == (1, 1, 5, 7)
    assert (row.Number_Wickets, row.Number_4s, row.Number_6s, row.Dot_Balls) == (2, 1, 1, 1)
    assert (row.Balls_Faced, row.Runs_Conceded) == (5, 11)
    assert (row.Batting_StrikeRate, row.BattingAverage) == (11 / 5, 11 / 2)
    assert (row.Bowling_SR, row.Bowling_Avg, row.Bowling_Econ) == (3.0, 5.5, 6.0)
    assert row.Batting_Index == (11 / 2) * (11 / 5) and row.Bowling_Index == 5.5 * 3.0


def test_all_wides_have_no_strike_rate(spark):
    parts = innings.batter_parts(balls(spark, [ball(1, 1, "Reds", "Blues", "A", 0, wide=1)]))
    row = innings.roll_up(parts).collect()[0]
    assert row.Balls_Faced is None and row.Batting_StrikeRate is None
    assert innings.batter_innings(parts).count() == 0


def test_milestone_limits(spark):
    rows = [ball(1, 1, "Reds", "Blues", "A", 100), ball(1, 1, "Reds", "Blues", "B", 50)]
    rows += [ball(1, 1, "Reds", "Blues", "C", 49), ball(2, 1, "Golds", "Blues", "D", 99)]
    parts = innings.batter_parts(balls(spark, rows + [ball(3, 1, "Reds", "Golds", "E", 1)]))
    full = innings.with_milestones(
        innings.roll_up(parts), innings.milestones(innings.batter_innings(parts))
    )
    found = {r.match_id: (r.Century, r.Fifty) for r in full.collect()}
    assert found == {1: (1, 1), 2: (0, 1), 3: (0, 0)}


def test_names_attached_later_give_the_same_innings(spark):
    rows = [
        ball(m, i, *(("Reds", "Blues") if i == 1 else ("Blues", "Reds")), b, r)
        for m in (1, 2)
        for i in (1, 2)
        for b, r in (("A", 4), ("B", 6), ("A", 0))
    ]
    df = balls(spark, rows)
    sides = df.select("match_id", "inning", "batting_team", "bowling_team").distinct()
    late = innings.name_sides(
        innings.batter_parts(df.drop("batting_team", "bowling_team"), ["match_id", "inning", "batsman"]),
        sides,
    )
    direct = innings.roll_up(innings.batter_parts(df))
    assert sorted(innings.roll_up(late).select(*direct.columns).collect()) == sorted(direct.collect())


def test_date_join_drops_unknown_matches(spark):
    rows = [ball(1, 1, "Reds", "Blues", "A", 1), ball(8, 1, "Reds", "Blues", "A", 1)]
    rolled = innings.roll_up(innings.batter_parts(balls(spark, rows)))
    dated = innings.with_match_date(rolled, matches(spark, [match(1, "North")]))
    assert [r.match_id for r in dated.collect()] == [1]


def test_one_pass_gives_the_innings_with_their_milestones(spark):
    """Batters with two teams in an inning, without a team or a name, and repeated balls."""
    rows = []
    for i, (bat, batter) in enumerate(
        [("Reds", "A"), ("Blues", "A"), (None, "A"), (None, "B"), ("Reds", None), ("Blues", "C"), ("Golds", "D")]
    ):
        for match_id in (1, 2):
            for inning in (1, 2):
                runs = 10 + 15 * i + match_id * 20 + inning * 5
                rows += [ball(match_id, inning, bat, "Golds", batter, runs, wide=int(i % 3 == 2))] * (1 + i % 2)
    parts = innings.batter_parts(balls(spark, rows))
    want = innings.with_milestones(innings.roll_up(parts), innings.milestones(innings.batter_innings(parts)))
    found = innings.roll_up_with_milestones(parts)
    assert found.columns == want.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    assert {r.Century for r in found.collect()} > {0} and {r.Fifty for r in found.collect()} > {0}


def test_innings_of_a_match_take_one_shuffle_of_the_balls(spark, tmp_path):
    """From balls to innings with milestones only balls, sides and dates move."""
    spark.range(4000).selectExpr(
        "id % 900 l_orderkey", "id % 7 l_partkey", "cast(id % 5 + 1 as int) l_linenumber", "cast(id % 50 as double) l_quantity",
        "cast(id % 9 as double) / 100 l_tax", "'R' l_returnflag",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    lineitem = spark.read.parquet(f"{tmp_path}/lineitem.parquet")
    star = star_schema.by_order(star_schema.StarTables(None, None, None, lineitem))
    sides = spark.range(900).selectExpr("id match_id", "1 inning", "'a' batting_team", "'b' bowling_team")
    table = FeatureTable(None, None, star_schema.balls(star), sides)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = innings.roll_up_with_milestones(table.parts_by_match)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
