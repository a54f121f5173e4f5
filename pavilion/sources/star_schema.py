"""Teams, matches and deliveries derived from star-schema tables.

``nation`` gives teams, ``orders`` with ``customer`` gives matches, ``lineitem``
gives the balls. Balls come without team names: those depend on the match and
the inning only, so they are attached after the balls have been aggregated and
a match with very many balls never travels through a join row by row.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavilion.functions.columns import indicator
from pavilion.functions.sizing import broadcast_if_small

# Numbers the derivation is defined with.
CITY_COUNT = 30
SECOND_GROUND_OFFSET = 25
NATION_COUNT = 25
EXTRA_KINDS = ["wide_runs", "bye_runs", "legbye_runs", "noball_runs"]
PENALTY_TAX = 4
PENALTY_RUNS = 5


@dataclass(frozen=True)
class StarTables:
    nation: DataFrame
    customer: DataFrame
    orders: DataFrame
    lineitem: DataFrame


def open_star(spark: SparkSession, folder: str) -> StarTables:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")

    return StarTables(table("nation"), table("customer"), table("orders"), table("lineitem"))


def by_order(star: StarTables) -> StarTables:
    """Line items dealt by their order, so that all steps on the balls of a match share one shuffle."""
    return replace(star, lineitem=star.lineitem.repartition("l_orderkey"))


def teams(star: StarTables) -> DataFrame:
    n = star.nation
    return n.select(
        (F.col("n_nationkey") + 1).cast("int").alias("team_id"),
        F.col("n_name").alias("Team_name"),
        F.concat(F.lit("C"), F.col("n_nationkey")).alias("Home_Ground"),
        F.concat(F.lit("C"), F.col("n_regionkey") + SECOND_GROUND_OFFSET).alias("Second_Ground"),
    )


def matches(star: StarTables) -> DataFrame:
    """One match per order of a known customer; nations are a checked broadcast."""
    nation = broadcast_if_small(star.nation.select("n_nationkey", "n_name"))
    first = nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("team1")
    )
    second = nation.select(F.col("n_nationkey").alias("rival_key"), F.col("n_name").alias("team2"))
    rival = (F.col("c_nationkey") + 1 + F.col("o_orderkey") % (NATION_COUNT - 1)) % NATION_COUNT
    customer = broadcast_if_small(star.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"))
    named = (
        star.orders.join(customer, "o_custkey")
        .withColumn("rival_key", rival.cast("int"))
        .join(broadcast_if_small(first), "c_nationkey")
        .join(broadcast_if_small(second), "rival_key")
    )
    day = F.col("o_orderdate").cast("date")
    return named.select(
        F.col("o_orderkey").alias("id"),
        F.year(day).alias("season"),
        F.concat(F.lit("C"), F.col("o_orderkey") % CITY_COUNT).alias("city"),
        day.alias("date"),
        "team1",
        "team2",
        F.when(F.col("o_custkey") % 2 == 0, F.col("team1"))
        .otherwise(F.col("team2"))
        .alias("toss_winner"),
        F.when(F.substring("o_orderpriority", 1, 1).isin("1", "2"), F.lit("bat"))
        .otherwise(F.lit("field"))
        .alias("toss_decision"),
        F.when(F.col("o_orderstatus") == "F", F.col("team1"))
        .when(F.col("o_orderstatus") == "O", F.col("team2"))
        .alias("winner"),
    )


def balls(star: StarTables) -> DataFrame:
    """One ball per line item: everything but the team names."""
    tax = F.round(F.col("l_tax") * 100).cast("int")
    batter = F.concat(F.lit("P"), F.col("l_partkey") % 2)
    runs = star.lineitem.select(
        F.col("l_orderkey").alias("match_id"),
        F.when(F.col("l_linenumber") % 2 == 1, F.lit(1)).otherwise(F.lit(2)).alias("inning"),
        F.col("l_linenumber").alias("over"),
        F.col("l_linenumber").alias("ball"),
        batter.alias("batsman"),
        (F.col("l_quantity").cast("int") - 1).alias("batsman_runs"),
        *[indicator(tax == i).alias(kind) for i, kind in enumerate(EXTRA_KINDS)],
        F.when(tax == PENALTY_TAX, F.lit(PENALTY_RUNS)).otherwise(F.lit(0)).alias("penalty_runs"),
        F.when(F.col("l_returnflag") == "R", batter).otherwise(F.lit("")).alias("player_dismissed"),
    )
    extras = sum((F.col(kind) for kind in EXTRA_KINDS), F.col("penalty_runs"))
    return runs.withColumn("extra_runs", extras).withColumn(
        "total_runs", F.col("batsman_runs") + F.col("extra_runs")
    )


def innings_sides(matches_df: DataFrame) -> DataFrame:
    """Who bats and who bowls in each inning: two rows per match."""
    sides = F.array(
        F.struct(
            F.lit(1).alias("inning"),
            F.col("team1").alias("batting_team"),
            F.col("team2").alias("bowling_team"),
        ),
        F.struct(
            F.lit(2).alias("inning"),
            F.col("team2").alias("batting_team"),
            F.col("team1").alias("bowling_team"),
        ),
    )
    return matches_df.select(F.col("id").alias("match_id"), F.inline(sides))


def deliveries(star: StarTables, matches_df: DataFrame | None = None) -> DataFrame:
    """The full ball table with team names, for operators that want it row by row."""
    sides = innings_sides(matches(star) if matches_df is None else matches_df)
    return balls(star).join(sides, ["match_id", "inning"])
