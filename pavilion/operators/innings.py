"""Innings level: one pass over the balls gives batters, innings and milestones.

Every measure is a sum, count, min or max, so the balls are first reduced to one
row per batter of an innings (combined map-side before any shuffle). The innings
roll-up and the batter totals both continue from that table; the ball table is
read once, and a match that holds a large share of all balls is no hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pavilion.functions.columns import count_or_null

INNINGS_KEYS = ["match_id", "batting_team"]

# Runs that make a milestone and runs per boundary.
HUNDRED = 100
FIFTY = 50
FOUR = 4
SIX = 6


def batter_parts(balls: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Partial sums and counts per (match, inning, team, batter).

    ``keys`` may leave out the team names when the ball table has none; attach
    them to the result with ``name_sides`` before going on.
    """
    if keys is None:
        keys = ["match_id", "inning", "batting_team", "bowling_team", "batsman"]
    runs, extras = F.col("batsman_runs"), F.col("extra_runs")
    legal = F.col("wide_runs") == 0
    charged = (F.col("bye_runs") == 0) & (F.col("legbye_runs") == 0) & (F.col("penalty_runs") == 0)
    return balls.groupBy(*keys).agg(
        F.sum("total_runs").alias("total_runs"),
        F.count("ball").alias("balls"),
        F.max("over").alias("last_over"),
        *[
            F.sum(c).alias(c)
            for c in (
                "wide_runs",
                "bye_runs",
                "legbye_runs",
                "noball_runs",
                "penalty_runs",
                "extra_runs",
            )
        ],
        F.count_if(F.col("player_dismissed") != "").alias("wickets"),
        F.count_if(runs == FOUR).alias("fours"),
        F.count_if(runs == SIX).alias("sixes"),
        F.count_if((runs == 0) & (extras == 0)).alias("dots"),
        F.count(F.when(legal, F.col("ball"))).alias("balls_faced"),
        F.count_if(legal).alias("legal_rows"),
        F.sum(F.when(legal, runs)).alias("runs_off_bat"),
        F.sum(F.when(charged, F.col("total_runs"))).alias("runs_conceded"),
    )


def name_sides(parts: DataFrame, sides: DataFrame) -> DataFrame:
    """Attach batting and bowling team to parts keyed by (match, inning).

    Innings are compared in the pairs of a match, which has few, and not as a key of the join,
    so parts that lie by match stay where they are.
    """
    named = sides.withColumnsRenamed({"match_id": "side_match", "inning": "side_inning"})
    same = (F.col("match_id") == F.col("side_match")) & (F.col("inning") <= F.col("side_inning")) & (F.col("inning") >= F.col("side_inning"))
    return parts.join(named, same).drop("side_match", "side_inning")


def roll_up(parts: DataFrame) -> DataFrame:
    """One row per (match, batting team): totals, conditional counts and ratios.

    A count with no matching ball is NULL, so that later averages skip the match. Counts
    of balls without a batting team are NULL as well: they belong to no team.
    """
    totals = parts.groupBy(*INNINGS_KEYS).agg(*roll_up_measures())
    return totals.withColumns(innings_ratios()).withColumns(innings_products())


def roll_up_measures() -> list[Column]:
    """Totals and conditional counts of a batting team's innings."""

    def known(name: str) -> Column:
        of_team = F.when(F.col("batting_team").isNotNull(), F.col(name))
        return F.nullif(F.sum(of_team), F.lit(0))

    return [
        F.min("inning").alias("inning"),
        F.min("bowling_team").alias("bowling_team"),
        F.sum("total_runs").alias("Total_Runs"),
        F.sum("balls").alias("Total_Balls"),
        F.max("last_over").alias("Overs"),
        F.sum("wide_runs").alias("Total_wide"),
        F.sum("bye_runs").alias("Bye_Runs"),
        F.sum("legbye_runs").alias("Leg_Bye"),
        F.sum("noball_runs").alias("Noball_runs"),
        F.sum("penalty_runs").alias("penalty_runs"),
        F.sum("extra_runs").alias("Extra_runs"),
        known("wickets").alias("Number_Wickets"),
        known("fours").alias("Number_4s"),
        known("sixes").alias("Number_6s"),
        known("dots").alias("Dot_Balls"),
        known("balls_faced").alias("Balls_Faced"),
        F.sum("runs_conceded").alias("Runs_Conceded"),
    ]


def innings_ratios() -> dict[str, Column]:
    off_bat = F.col("Total_Runs") - F.col("Extra_runs")
    wickets = F.col("Number_Wickets")
    return {
        "Batting_StrikeRate": F.try_divide(off_bat, F.col("Balls_Faced")),
        "BattingAverage": F.try_divide(off_bat, wickets),
        "Bowling_SR": F.try_divide(F.col("Total_Balls"), wickets),
        "Bowling_Avg": F.try_divide(F.col("Runs_Conceded"), wickets),
        "Bowling_Econ": F.try_divide(F.col("Total_Runs"), F.col("Overs")),
    }


def innings_products() -> dict[str, Column]:
    return {
        "Batting_Index": F.col("BattingAverage") * F.col("Batting_StrikeRate"),
        "Bowling_Index": F.col("Bowling_Avg") * F.col("Bowling_SR"),
    }


def batter_innings(parts: DataFrame) -> DataFrame:
    """Runs and balls of each batter per inning, wides left out."""
    totals = parts.groupBy("match_id", "inning", "batsman").agg(
        F.min("batting_team").alias("batting_team"),
        F.min("bowling_team").alias("bowling_team"),
        F.sum("runs_off_bat").alias("total_runs"),
        F.sum("balls_faced").alias("total_balls"),
        F.sum("legal_rows").alias("legal_rows"),
    )
    return totals.where(F.col("legal_rows") > 0).drop("legal_rows")


def milestones(batters: DataFrame) -> DataFrame:
    """Hundreds and fifties per (match, batting team); NULL where there is none."""
    runs = F.col("total_runs")
    return (
        batters.where(runs >= FIFTY)
        .groupBy(*INNINGS_KEYS)
        .agg(
            count_or_null(runs >= HUNDRED).alias("Century"),
            count_or_null(runs < HUNDRED).alias("Fifty"),
        )
    )


def with_milestones(innings: DataFrame, counts: DataFrame) -> DataFrame:
    """Innings with hundreds and fifties; only these two are filled with 0."""
    joined = innings.join(counts, INNINGS_KEYS, "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in ("Century", "Fifty")}
    )


def roll_up_with_milestones(parts: DataFrame) -> DataFrame:
    """``with_milestones(roll_up(parts), milestones(batter_innings(parts)))`` in one pass.

    The row of a batter with the least team carries the batter's runs, so hundreds and fifties
    are counted with the other measures; parts that lie by match stay where they are.
    """
    order = Window.partitionBy("match_id", "inning", "batsman").orderBy(F.asc_nulls_last("batting_team"))
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.row_number().over(order) == 1
    marked = parts.withColumn("batter_runs", F.sum("runs_off_bat").over(every)).withColumn("first_part", first)
    runs, of_team = F.col("batter_runs"), F.col("first_part") & F.col("batting_team").isNotNull()
    counts = [
        F.count_if(of_team & (runs >= HUNDRED)).alias("Century"),
        F.count_if(of_team & (runs >= FIFTY) & (runs < HUNDRED)).alias("Fifty"),
    ]
    totals = marked.groupBy(*INNINGS_KEYS).agg(*roll_up_measures(), *counts)
    measured = totals.withColumns(innings_ratios()).withColumns(innings_products())
    return measured.select(*[c for c in measured.columns if c not in ("Century", "Fifty")], "Century", "Fifty")


def with_match_date(innings: DataFrame, matches: DataFrame) -> DataFrame:
    """Innings of known matches with the date of the match."""
    dates = matches.select(F.col("id").alias("match_id"), "date")
    return innings.join(dates, "match_id")
