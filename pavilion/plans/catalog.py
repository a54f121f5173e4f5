"""The query catalogue: every operator on the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavilion.functions.columns import round_doubles, to_long
from pavilion.functions.staging import scratch_path
from pavilion.operators import (
    buckets,
    cleaning,
    correlation,
    innings,
    logit,
    pairs,
    positions,
    response,
)
from pavilion.plans import reports
from pavilion.plans.feature_table import EXPORTED, FeatureTable, clean_features
from pavilion.sources import readers, star_schema, writers
from pavilion.sources.schemas import DIFF_FEATURES, KEY_COLUMNS, ORDER_KEY, RESPONSE

Query = Callable[[SparkSession, str], DataFrame]

ORDER = ORDER_KEY
SIDE_KEYS = ["match_id", "inning", "batting_team", "bowling_team"]
# Fixed value: length of the training part of the chronological split.
TRAIN_ROWS = 550

_CATALOG: dict[str, Query] = {}


def query(name: str):
    def register(function: Query) -> Query:
        _CATALOG[name] = function
        return function

    return register


_TABLES: dict[tuple[str, str, str], FeatureTable] = {}


def table(spark: SparkSession, folder: str, strategy: str = "auto") -> FeatureTable:
    """The chain of tables of a folder, built once per session like stored tables.

    Call ``forget_tables`` after the files of a folder have changed.
    """
    key = (spark.sparkContext.applicationId, folder, strategy)
    if key not in _TABLES:
        _TABLES[key] = FeatureTable.from_star(spark, folder, strategy)
    return _TABLES[key]


def forget_tables() -> None:
    _TABLES.clear()


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder).cleaned


def catalog() -> dict[str, Query]:
    from pavilion.plans import model_catalog  # noqa: F401  registers the model queries

    return dict(_CATALOG)


# Sources and match level


@query("source_matches")
def _source_matches(spark, folder):
    return star_schema.matches(star_schema.open_star(spark, folder))


@query("source_deliveries")
def _source_deliveries(spark, folder):
    names = [f.name for f in readers.schemas.DELIVERIES.fields]
    return star_schema.deliveries(star_schema.open_star(spark, folder)).select(*names)


@query("home_away")
def _home_away(spark, folder):
    return table(spark, folder).game_stats.select("id", "Home_team", "Away_team")


@query("match_indicators")
def _match_indicators(spark, folder):
    return table(spark, folder).game_stats


# Innings level


@query("innings_rollup")
def _innings_rollup(spark, folder):
    sums = "Total_Runs Total_Balls Overs Total_wide Bye_Runs Leg_Bye Noball_runs penalty_runs Extra_runs"
    return table(spark, folder).innings.select(*SIDE_KEYS, *sums.split())


@query("innings_conditional_counts")
def _innings_conditional_counts(spark, folder):
    counts = "Number_Wickets Number_4s Number_6s Dot_Balls Balls_Faced Runs_Conceded"
    return table(spark, folder).innings.select(*SIDE_KEYS, *counts.split())


@query("innings_ratios")
def _innings_ratios(spark, folder):
    names = [*innings.innings_ratios(), *innings.innings_products()]
    return round_doubles(table(spark, folder).innings.select(*SIDE_KEYS, *names))


@query("batter_innings")
def _batter_innings(spark, folder):
    return table(spark, folder).batters


@query("milestones")
def _milestones(spark, folder):
    t = table(spark, folder)
    filled = innings.with_milestones(t.innings, t.milestones)
    return filled.select("match_id", "batting_team", "Century", "Fifty")


@query("innings_dated")
def _innings_dated(spark, folder):
    return table(spark, folder).dated_innings.select(*SIDE_KEYS, "date")


# Form and final tables; the ``_blocked`` twins force the plan for very large keys


@query("rolling_batting")
def _rolling_batting(spark, folder):
    return round_doubles(table(spark, folder).batting_form)


@query("rolling_bowling")
def _rolling_bowling(spark, folder):
    return round_doubles(table(spark, folder).bowling_form)


@query("rolling_home_away")
def _rolling_home_away(spark, folder):
    return round_doubles(table(spark, folder).game_form)


@query("rolling_batting_blocked")
def _rolling_batting_blocked(spark, folder):
    return round_doubles(table(spark, folder, "distributed").batting_form)


@query("rolling_bowling_blocked")
def _rolling_bowling_blocked(spark, folder):
    return round_doubles(table(spark, folder, "distributed").bowling_form)


@query("rolling_home_away_blocked")
def _rolling_home_away_blocked(spark, folder):
    return round_doubles(table(spark, folder, "distributed").game_form)


@query("home_stats")
def _home_stats(spark, folder):
    return round_doubles(table(spark, folder).home_stats)


@query("away_stats")
def _away_stats(spark, folder):
    return round_doubles(table(spark, folder).named_match_stats)


@query("team_id_lookup")
def _team_id_lookup(spark, folder):
    return table(spark, folder).match_stats.select("id", "Home_team", "Away_team")


@query("final_diff")
def final_diff(spark, folder):
    return round_doubles(table(spark, folder).final_diff.select(*EXPORTED))


@query("final_diff_blocked")
def _final_diff_blocked(spark, folder):
    return round_doubles(table(spark, folder, "distributed").final_diff.select(*EXPORTED))


@query("final_ratio")
def _final_ratio(spark, folder):
    return round_doubles(table(spark, folder).final_ratio.drop("date"))


@query("head5")
def _head5(spark, folder):
    first = positions.head(table(spark, folder).final_diff, ORDER)
    return round_doubles(first.select(*EXPORTED))


@query("tsv_roundtrip")
def _tsv_roundtrip(spark, folder):
    return round_doubles(_exported(spark, folder).select(*EXPORTED))


def _exported(spark, folder):
    """The feature table as a later program finds it: exported in order and read back."""
    path = scratch_path(spark, "final-diff-tsv")
    final = table(spark, folder).final_diff.select(*EXPORTED, "date")
    writers.write_tsv(final, path, ORDER, "gzip")
    return readers.read_features(spark, path)


@query("split_from_tsv")
def _split_from_tsv(spark, folder):
    rows = clean_features(_exported(spark, folder))
    # the features take no part, so they are not moved and written with the positions
    split = positions.chronological_split(rows.select(*ORDER), ORDER, TRAIN_ROWS)
    return split.select("id", "position", "split")


@query("table_roundtrip")
def _table_roundtrip(spark, folder):
    path = scratch_path(spark, "final-diff")
    exported = table(spark, folder).final_diff.select(*EXPORTED)
    return round_doubles(writers.replace_table(exported, path))


@query("table_named")
def _table_named(spark, folder):
    """The feature table under a name, replaced once and read by SQL."""
    exported = table(spark, folder).final_diff.select(*EXPORTED)
    name, shared = "final_diff_stats", scratch_path(spark, "named")
    writers.replace_named(exported.limit(0), name, shared)
    writers.replace_named(exported, name, shared)
    return round_doubles(spark.sql(f"SELECT * FROM {name}"))


# Cleaning, ranks and buckets


@query("feature_long")
def _feature_long(spark, folder):
    return round_doubles(to_long(cleaned(spark, folder), ["id"], DIFF_FEATURES))


@query("drop_nulls")
def _drop_nulls(spark, folder):
    return cleaning.drop_nulls(table(spark, folder).final_diff, EXPORTED).select("id")


@query("zscore_filter")
def _zscore_filter(spark, folder):
    return cleaned(spark, folder).select("id")


@query("rank_first")
def _rank_first(spark, folder):
    ranked = buckets.ranks(cleaned(spark, folder), DIFF_FEATURES, ORDER)
    return ranked.select("id", "feature", "rank")


@query("rank_first_ranged")
def _rank_first_ranged(spark, folder):
    ranked = buckets.ranks(
        cleaned(spark, folder), DIFF_FEATURES, ORDER, strategy="distributed"
    )
    return ranked.select("id", "feature", "rank")


@query("qcut10")
def _qcut10(spark, folder):
    return buckets.equal_count_long(cleaned(spark, folder), DIFF_FEATURES, ORDER)


@query("cut8")
def _cut8(spark, folder):
    bucketed = buckets.equal_width_long(cleaned(spark, folder), DIFF_FEATURES, ["id"])
    return bucketed.select("id", "feature", "bucket")


@query("chrono_split")
def _chrono_split(spark, folder):
    split = positions.chronological_split(cleaned(spark, folder), ORDER, TRAIN_ROWS)
    return split.select("id", "position", "split")


# One feature against the response


@query("response_rate")
def _response_rate(spark, folder):
    return round_doubles(response.population(cleaned(spark, folder), RESPONSE).select("all.*"))


@query("bucket_stats")
def _bucket_stats(spark, folder):
    return round_doubles(response.bucket_stats(cleaned(spark, folder), DIFF_FEATURES, RESPONSE))


@query("msd_univariate")
def _msd_univariate(spark, folder):
    return round_doubles(response.feature_msd(cleaned(spark, folder), DIFF_FEATURES, RESPONSE))


@query("crosstab_response")
def _crosstab_response(spark, folder):
    return response.category_counts(table(spark, folder).game_form, "city", RESPONSE)


@query("category_msd")
def _category_msd(spark, folder):
    return round_doubles(response.category_msd(table(spark, folder).game_form, "city", RESPONSE))


@query("class_histogram")
def _class_histogram(spark, folder):
    return round_doubles(response.class_histogram(cleaned(spark, folder), DIFF_FEATURES, RESPONSE))


@query("class_density")
def _class_density(spark, folder):
    return round_doubles(response.class_density(cleaned(spark, folder), DIFF_FEATURES, RESPONSE))


@query("ols_trend")
def _ols_trend(spark, folder):
    return round_doubles(response.linear_trend(cleaned(spark, folder), DIFF_FEATURES, RESPONSE))


@query("univariate_logit")
def _univariate_logit(spark, folder):
    return round_doubles(
        logit.univariate_logit(cleaned(spark, folder), DIFF_FEATURES, RESPONSE)
    )


# Pairs of features


@query("msd_pairs")
def _msd_pairs(spark, folder):
    return round_doubles(pairs.pair_msd(cleaned(spark, folder), DIFF_FEATURES, RESPONSE, ORDER))


@query("bucket_grid")
def _bucket_grid(spark, folder):
    return round_doubles(pairs.bucket_grid(cleaned(spark, folder), DIFF_FEATURES, RESPONSE, ORDER))


@query("grid_pivot")
def _grid_pivot(spark, folder):
    grid = pairs.bucket_grid(cleaned(spark, folder), DIFF_FEATURES, RESPONSE, ORDER)
    return round_doubles(pairs.grid_matrix(grid))


@query("corr_pairs")
def _corr_pairs(spark, folder):
    pairs_of = correlation.correlation_pairs(cleaned(spark, folder), DIFF_FEATURES)
    return round_doubles(pairs_of.orderBy(F.desc("correlation"), *pairs.PAIR_KEYS))


@query("corr_matrix")
def _corr_matrix(spark, folder):
    predictors = [*KEY_COLUMNS, *DIFF_FEATURES]
    return round_doubles(correlation.correlation_matrix(cleaned(spark, folder), predictors))


# Reports


@query("pair_report")
def _pair_report(spark, folder):
    return round_doubles(
        reports.pair_report(cleaned(spark, folder), DIFF_FEATURES, RESPONSE, ORDER)
    )


@query("feature_ranking")
def _feature_ranking(spark, folder):
    return round_doubles(reports.feature_ranking(cleaned(spark, folder), DIFF_FEATURES, RESPONSE))


@query("report_roundtrip")
def _report_roundtrip(spark, folder):
    path = scratch_path(spark, "reports")
    pair = reports.pair_report(cleaned(spark, folder), DIFF_FEATURES, RESPONSE, ORDER)
    writers.write_reports({"pairs": pair}, path)
    return round_doubles(readers.read_table(spark, f"{path}/pairs"))


@query("feature_report")
def _feature_report(spark, folder):
    return round_doubles(reports.feature_report(cleaned(spark, folder), DIFF_FEATURES, RESPONSE))


@query("feature_table")
def _feature_table(spark, folder):
    """The feature report without the importance that a random forest gives."""
    ranked = reports.feature_ranking(cleaned(spark, folder), DIFF_FEATURES, RESPONSE)
    return round_doubles(logit.formatted(ranked).withColumn("kind", F.lit("Continuous")))
