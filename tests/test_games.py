import pytest
from fixtures import match, matches, teams

from pavilion.operators import games


def test_home_side_by_ground(spark):
    rows = [
        match(1, "North"),
        match(2, "South"),
        match(3, "Elsewhere"),
        match(4, None),
        match(5, "Quay", "Reds", "Golds"),
        match(6, "East", "Reds", "Golds"),
        match(7, "North", "Reds", "Unknown"),
    ]
    out = games.home_away(matches(spark, rows), teams(spark)).collect()
    assert {(r.id, r.Home_team, r.Away_team) for r in out} == {
        (1, "Reds", "Blues"),
        (2, "Blues", "Reds"),
        (3, "Reds", "Blues"),
        (4, "Reds", "Blues"),
        (5, "Reds", "Golds"),
        (6, "Golds", "Reds"),
    }


def test_indicators_with_no_result(spark):
    rows = [match(1, "South", winner=None), match(2, "North", toss="Blues", choice="field", winner="Blues")]
    out = {r.id: r for r in games.match_indicators(matches(spark, rows), teams(spark)).collect()}
    assert (out[1].Home_Team_Win, out[1].Away_Team_Win) == (0, 0)
    assert (out[1].Away_Toss_Won, out[1].Away_Toss_Bat) == (1, 1)
    assert (out[2].Away_Toss_Won, out[2].Away_Toss_Bat, out[2].Away_Team_Win) == (1, 0, 1)


def test_team_id_lookup(spark):
    named = games.home_away(matches(spark, [match(1, "North")]), teams(spark))
    out = games.team_ids(named, teams(spark), ["Home_team", "Away_team"]).collect()
    assert [(r.Home_team, r.Away_team) for r in out] == [(1, 2)]
    unknown = games.team_ids(named, teams(spark, [(1, "Reds", None, None)]), ["Away_team"]).collect()
    assert unknown[0].Away_team is None


def test_team_id_lookup_rejects_two_ids(spark):
    named = games.home_away(matches(spark, [match(1, "North")]), teams(spark))
    twice = teams(spark, [(1, "Reds", None, None), (9, "Reds", None, None)])
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        games.team_ids(named, twice, ["Home_team"]).collect()
