"""Match level: home side, win and toss indicators, team ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavilion.functions.columns import indicator
from pavilion.functions.sizing import broadcast_if_small


def _grounds(teams: DataFrame, name: str, prefix: str) -> DataFrame:
    return broadcast_if_small(
        teams.select(
            F.col("Team_name").alias(name),
            F.col("Home_Ground").alias(f"{prefix}_first"),
            F.col("Second_Ground").alias(f"{prefix}_second"),
        )
    )


def _plays_at(prefix: str) -> Column:
    """True when the city is a ground of the team; NULL cities are no ground."""
    city = F.col("city")
    return F.coalesce(
        (city == F.col(f"{prefix}_first")) | (city == F.col(f"{prefix}_second")), F.lit(False)
    )


def with_home_side(matches: DataFrame, teams: DataFrame) -> DataFrame:
    """Matches with ``Home_team`` and ``Away_team``.

    The second team is at home only when the city is one of its grounds and none
    of the first team's. A match with an unknown team is dropped.
    """
    second_at_home = _plays_at("g2") & ~_plays_at("g1")
    return (
        matches.join(_grounds(teams, "team1", "g1"), "team1")
        .join(_grounds(teams, "team2", "g2"), "team2")
        .select(
            *[F.col(c) for c in matches.columns],
            F.when(second_at_home, F.col("team2")).otherwise(F.col("team1")).alias("Home_team"),
            F.when(second_at_home, F.col("team1")).otherwise(F.col("team2")).alias("Away_team"),
        )
    )


def home_away(matches: DataFrame, teams: DataFrame) -> DataFrame:
    return with_home_side(matches, teams).select("id", "Home_team", "Away_team")


def match_indicators(matches: DataFrame, teams: DataFrame) -> DataFrame:
    """Home and away sides with 0/1 flags for toss, bat-first choice and win."""
    sided = with_home_side(matches, teams)
    bats = F.col("toss_decision") == "bat"

    def flags(side: str) -> list[Column]:
        team = F.col(f"{side}_team")
        won_toss = F.col("toss_winner") == team
        return [
            indicator(won_toss).alias(f"{side}_Toss_Won"),
            indicator(won_toss & bats).alias(f"{side}_Toss_Bat"),
            indicator(F.col("winner") == team).alias(f"{side}_Team_Win"),
        ]

    return sided.select(
        "id", "Home_team", "Away_team", "season", "city", "date", *flags("Home"), *flags("Away")
    )


def team_ids(df: DataFrame, teams: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace team names by ids: an unknown name gives NULL, a name with two ids fails.

    A scalar subquery checks the uniqueness; a left join would repeat rows instead.
    """
    out = df
    for name in columns:
        wanted = teams.where(F.col("Team_name") == F.col(name).outer()).select("team_id")
        out = out.withColumn(name, wanted.scalar())
    return out
