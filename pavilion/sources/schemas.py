"""Schemas of the three source tables and of the exported feature table."""

from __future__ import annotations

from pyspark.sql import types as T

TEAMS = T.StructType(
    [
        T.StructField("team_id", T.IntegerType(), False),
        T.StructField("Team_name", T.StringType(), False),
        T.StructField("Home_Ground", T.StringType()),
        T.StructField("Second_Ground", T.StringType()),
    ]
)

MATCHES = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("season", T.IntegerType()),
        T.StructField("city", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("team1", T.StringType()),
        T.StructField("team2", T.StringType()),
        T.StructField("toss_winner", T.StringType()),
        T.StructField("toss_decision", T.StringType()),
        T.StructField("winner", T.StringType()),
    ]
)

DELIVERIES = T.StructType(
    [
        T.StructField("match_id", T.LongType(), False),
        T.StructField("inning", T.IntegerType()),
        T.StructField("batting_team", T.StringType()),
        T.StructField("bowling_team", T.StringType()),
        T.StructField("over", T.IntegerType()),
        T.StructField("ball", T.IntegerType()),
        T.StructField("batsman", T.StringType()),
        T.StructField("batsman_runs", T.IntegerType()),
        T.StructField("extra_runs", T.IntegerType()),
        T.StructField("total_runs", T.IntegerType()),
        T.StructField("wide_runs", T.IntegerType()),
        T.StructField("bye_runs", T.IntegerType()),
        T.StructField("legbye_runs", T.IntegerType()),
        T.StructField("noball_runs", T.IntegerType()),
        T.StructField("penalty_runs", T.IntegerType()),
        T.StructField("player_dismissed", T.StringType()),
    ]
)

# The names of the output features, in output order.
DIFF_FEATURES = [
    "Batting_Index",
    "Net_Run_Rate",
    "Fours",
    "Six",
    "matchplayed",
    "Centuries",
    "Fifties",
    "Bowling_Index",
    "Extras",
    "Bo_Econ",
    "Avg_Toss_Won",
    "AVG_Bat_Won",
    "AVG_Wins",
]
# Key columns and response of the exported table.
KEY_COLUMNS = ["id", "season", "Home_team", "Away_team"]
RESPONSE = "Home_team_Win"

FINAL_DIFF = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("season", T.IntegerType()),
        T.StructField("Home_team", T.StringType()),
        T.StructField("Away_team", T.StringType()),
        T.StructField(RESPONSE, T.IntegerType()),
    ]
    + [
        T.StructField(f, T.LongType() if f == "matchplayed" else T.DoubleType())
        for f in DIFF_FEATURES
    ]
)

# The export carries its order: rows are sorted by date and id.
ORDER_KEY = ["date", "id"]
DATED_DIFF = T.StructType([*FINAL_DIFF.fields, T.StructField("date", T.DateType())])
