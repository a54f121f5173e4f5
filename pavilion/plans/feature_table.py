"""From source tables to the per-match feature tables, as DataFrame plans.

Tables that several later steps read (matches, match flags, dated innings, cleaned
features, and batter parts where a query asks for them) are written out once, when they are first asked for;
everything else stays lazy.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from pavilion.functions.columns import round_doubles
from pavilion.functions.sizing import is_small
from pavilion.functions.staging import spread, stage
from pavilion.operators import cleaning, features, games, innings
from pavilion.sources import star_schema
from pavilion.sources.schemas import DIFF_FEATURES, KEY_COLUMNS, RESPONSE

FEATURE_DIGITS = 8
EXPORTED = [*KEY_COLUMNS, RESPONSE, *DIFF_FEATURES]


def clean_features(final_diff: DataFrame) -> DataFrame:
    """Complete feature rows without outliers: what the analyses and models read.

    Rounding makes averages equal that differ only by the order of their sums,
    so that ranks and buckets do not depend on how the data was partitioned.
    """
    complete = round_doubles(cleaning.drop_nulls(final_diff, EXPORTED), FEATURE_DIGITS)
    written = stage(complete, "complete")
    kept = cleaning.zscore_filter(written, EXPORTED)
    # large tables stay as they are dealt: rows are not moved once more
    return stage(spread(kept) if is_small(written) else kept, "cleaned")


class FeatureTable:
    """The chain of tables; each property is one table.

    ``balls`` may lack team names when ``sides`` gives them per (match, inning).
    """

    def __init__(
        self,
        teams: DataFrame,
        matches: DataFrame,
        balls: DataFrame,
        sides: DataFrame | None = None,
        strategy: str = "auto",
    ) -> None:
        self.teams = teams
        self.matches = matches
        self.balls = balls
        self.sides = sides
        self.strategy = strategy

    @classmethod
    def from_star(cls, spark: SparkSession, folder: str, strategy: str = "auto") -> FeatureTable:
        star = star_schema.by_order(star_schema.open_star(spark, folder))
        matches = stage(star_schema.matches(star), "matches")
        return cls(
            star_schema.teams(star),
            matches,
            star_schema.balls(star),
            star_schema.innings_sides(matches),
            strategy,
        )

    @cached_property
    def game_stats(self) -> DataFrame:
        return stage(games.match_indicators(self.matches, self.teams), "game-stats")

    @cached_property
    def parts_by_match(self) -> DataFrame:
        """Parts of batters, not written: balls move once, to the task of their match."""
        if self.sides is None:
            return innings.batter_parts(self.balls.repartition("match_id"))
        unnamed = innings.batter_parts(self.balls, ["match_id", "inning", "batsman"])
        return innings.name_sides(unnamed, self.sides)

    @cached_property
    def parts(self) -> DataFrame:
        return stage(self.parts_by_match, "batter-parts")

    @cached_property
    def innings(self) -> DataFrame:
        return innings.roll_up(self.parts)

    @cached_property
    def batters(self) -> DataFrame:
        return innings.batter_innings(self.parts)

    @cached_property
    def milestones(self) -> DataFrame:
        return innings.milestones(self.batters)

    @cached_property
    def dated_innings(self) -> DataFrame:
        # all of it in the task of a match
        full = innings.roll_up_with_milestones(self.parts_by_match)
        return stage(innings.with_match_date(full, self.matches), "dated-innings")

    @cached_property
    def batting_form(self) -> DataFrame:
        return features.batting_form(self.dated_innings, self.strategy)

    @cached_property
    def bowling_form(self) -> DataFrame:
        return features.bowling_form(self.dated_innings, self.strategy)

    @cached_property
    def game_form(self) -> DataFrame:
        return features.game_form(self.game_stats, self.strategy)

    @cached_property
    def team_form(self) -> DataFrame:
        # Joined to both sides of a match, which share its shuffles.
        return features.team_form(self.batting_form, self.bowling_form)

    @cached_property
    def home_stats(self) -> DataFrame:
        return features.with_side(self.game_form, self.team_form, "Home")

    @cached_property
    def named_match_stats(self) -> DataFrame:
        return features.with_side(self.home_stats, self.team_form, "Away")

    @cached_property
    def match_stats(self) -> DataFrame:
        return games.team_ids(self.named_match_stats, self.teams, ["Home_team", "Away_team"])

    @cached_property
    def final_diff(self) -> DataFrame:
        """Thirteen home-minus-away features per match, with the date as order key."""
        return features.difference_features(self.match_stats)

    @cached_property
    def cleaned(self) -> DataFrame:
        return clean_features(self.final_diff)

    @cached_property
    def final_ratio(self) -> DataFrame:
        return features.ratio_features(self.match_stats)
