"""Match features: form of both sides joined to the match, differences, ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pavilion.functions.sizing import pick_strategy
from pavilion.functions.staging import stage
from pavilion.operators.prior import prior_stats
from pavilion.sources.schemas import KEY_COLUMNS, RESPONSE

# Which output column averages which innings or match column.
BATTING_FORM = {
    "Batting_Index": "Batting_Index",
    "Run_Rate": "Bowling_Econ",
    "Number_4s": "Number_4s",
    "Number_6s": "Number_6s",
    "Century": "Century",
    "Fifty": "Fifty",
}
BOWLING_FORM = {
    "Bowling_Econ": "Bowling_Econ",
    "Bowling_Index": "Bowling_Index",
    "AVG_Extras": "Extra_runs",
    "Avg_Overs": "Overs",
    "Avg_balls": "Total_Balls",
}
SIDE_RATES = {"Avg_Toss_Won": "Toss_Won", "Avg_Bat_Won": "Toss_Bat", "Avg_Wins": "Team_Win"}

# Side columns (after ``Home_`` or ``Away_``) and the form column of each.
SIDE_COLUMNS = {
    "BI": "Batting_Index",
    "RR": "Run_Rate",
    "4s": "Number_4s",
    "6s": "Number_6s",
    "matchplayed": "Matches_Played",
    "Centuries": "Century",
    "Fifties": "Fifty",
    "BoI": "Bowling_Index",
    "BoEcon": "Bowling_Econ",
    "Extras": "AVG_Extras",
}
# Final features in output order and the side column of each.
FEATURE_SOURCE = {
    "Batting_Index": "BI",
    "Net_Run_Rate": "RR",
    "Fours": "4s",
    "Six": "6s",
    "matchplayed": "matchplayed",
    "Centuries": "Centuries",
    "Fifties": "Fifties",
    "Bowling_Index": "BoI",
    "Extras": "Extras",
    "Bo_Econ": "BoEcon",
    "Avg_Toss_Won": "Avg_Toss_Won",
    "AVG_Bat_Won": "Avg_Bat_Won",
    "AVG_Wins": "Avg_Wins",
}
NO_RATIO = ("Net_Run_Rate", "Bo_Econ")
FINAL_KEYS = [*KEY_COLUMNS, RESPONSE]


def batting_form(innings: DataFrame, strategy: str = "auto") -> DataFrame:
    """Per innings, the batting team's averages over its earlier matches."""
    return prior_stats(
        innings,
        ["batting_team"],
        "date",
        "match_id",
        BATTING_FORM,
        {"Matches_Played": "match_id"},
        {"match_id": "match_id", "date": "date", "Team": "batting_team"},
        strategy,
    )


def bowling_form(innings: DataFrame, strategy: str = "auto") -> DataFrame:
    """Per innings, the bowling team's averages over its earlier matches."""
    return prior_stats(
        innings,
        ["bowling_team"],
        "date",
        "match_id",
        BOWLING_FORM,
        keep={"match_id": "match_id", "date": "date", "Team": "bowling_team"},
        strategy=strategy,
    )


def side_rates(games: DataFrame, side: str, keep: list[str], strategy: str = "auto") -> DataFrame:
    """Toss and win rates of one side over its earlier games on that side."""
    return prior_stats(
        games,
        [f"{side}_team"],
        "date",
        "id",
        {f"{side}_{out}": f"{side}_{c}" for out, c in SIDE_RATES.items()},
        keep={c: c for c in keep},
        strategy=strategy,
    )


def game_form(games: DataFrame, strategy: str = "auto") -> DataFrame:
    """Per match, home rates from earlier home games and away rates from away games."""
    shown = ["id", "season", "date", "city", "Home_team", "Away_team", "Home_Team_Win"]
    away_inputs = [f"Away_{c}" for c in SIDE_RATES.values()]
    chosen = pick_strategy(games, strategy)
    home = side_rates(games, "Home", [*shown, *away_inputs], chosen)
    if chosen == "distributed":
        # The second pass reads its input twice.
        home = stage(home, "home-rates")
    home_outputs = [f"Home_{c}" for c in SIDE_RATES]
    both = side_rates(home, "Away", [*shown, *home_outputs], chosen)
    return both.withColumnRenamed("Home_Team_Win", "Home_team_Win")


def team_form(batting: DataFrame, bowling: DataFrame) -> DataFrame:
    """Batting and bowling form of a team in one row per (match, team)."""
    other = bowling.drop("date").withColumnsRenamed({"match_id": "other_id", "Team": "other_team"})
    same = (F.col("match_id") == F.col("other_id")) & _same_team("Team", "other_team")
    return batting.join(other, same).drop("other_id", "other_team")


def _same_team(one: str, other: str) -> Column:
    """Equal names, compared in the pairs of a match and not as a key of the join.

    A match has few teams. Keyed by the match alone, the joins of both sides share one
    shuffle of the form and leave the games where they are.
    """
    return (F.col(one) <= F.col(other)) & (F.col(one) >= F.col(other))


def with_side(games: DataFrame, form: DataFrame, side: str) -> DataFrame:
    """Add one side's form as ``<side>_*``; a match without that side's form is dropped."""
    named = form.select(
        F.col("match_id").alias("form_id"),
        F.col("Team").alias("form_team"),
        *[F.col(c).alias(f"{side}_{out}") for out, c in SIDE_COLUMNS.items()],
    )
    same = (F.col("id") == F.col("form_id")) & _same_team(f"{side}_team", "form_team")
    return games.join(named, same).drop("form_id", "form_team")


def difference_features(match_stats: DataFrame) -> DataFrame:
    """Home minus away for every feature; the date stays as the order key."""
    return match_stats.select(
        *FINAL_KEYS,
        *[
            (F.col(f"Home_{c}") - F.col(f"Away_{c}")).alias(out)
            for out, c in FEATURE_SOURCE.items()
        ],
        "date",
    )


def ratio_features(match_stats: DataFrame) -> DataFrame:
    """Home divided by away, NULL where the away value is 0."""
    return match_stats.select(
        *FINAL_KEYS,
        *[
            F.try_divide(F.col(f"Home_{c}"), F.col(f"Away_{c}")).alias(out)
            for out, c in FEATURE_SOURCE.items()
            if out not in NO_RATIO
        ],
        "date",
    )
