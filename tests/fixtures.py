"""Hand-made matches and balls."""

from __future__ import annotations

import datetime as dt

from pavilion.sources import schemas

TEAM_ROWS = [
    (1, "Reds", "North", "Quay"),
    (2, "Blues", "South", None),
    (3, "Golds", "East", "Quay"),
]


def day(n: int) -> dt.date:
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def match(i, city, team1="Reds", team2="Blues", toss="Reds", choice="bat", winner="Reds", on=None):
    return (i, 2020, city, day(i if on is None else on), team1, team2, toss, choice, winner)


def ball(
    match_id, inning, bat, bowl, batter, runs, over=1, wide=0, bye=0, legbye=0, noball=0, penalty=0, out=""
):
    extra = wide + bye + legbye + noball + penalty
    return (
        match_id, inning, bat, bowl, over, 1, batter, runs, extra, runs + extra,
        wide, bye, legbye, noball, penalty, out,
    )


def teams(spark, rows=None):
    return spark.createDataFrame(TEAM_ROWS if rows is None else rows, schemas.TEAMS)


def matches(spark, rows):
    return spark.createDataFrame(rows, schemas.MATCHES)


def balls(spark, rows):
    return spark.createDataFrame(rows, schemas.DELIVERIES)
