import pytest
from pyspark.sql import functions as F

from pavilion.functions.columns import rounded
from pavilion.functions.sizing import broadcast_if_small, input_bytes
from pavilion.functions.staging import scratch_path, stage
from pavilion.sources import readers, schemas, writers
from fixtures import day, match, matches, teams


def feature_row(i, value):
    features = [3 if f == "matchplayed" else value for f in schemas.DIFF_FEATURES]
    return (i, 2020, "1", "2", 1, *features, day(10 - i))


def test_tsv_keeps_nulls_and_doubles(spark):
    df = spark.createDataFrame([feature_row(1, 0.1 + 0.2), feature_row(2, None)], schemas.DATED_DIFF)
    path = scratch_path(spark, "tsv")
    writers.write_tsv(df, path, schemas.ORDER_KEY)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert any("NULL" in line for line in lines)
    assert [line[0] for line in lines if line[0].isdigit()] == ["2", "1"]
    back = readers.read_features(spark, path).orderBy("id").collect()
    assert back[0].Batting_Index == 0.1 + 0.2 and back[1].Batting_Index is None
    assert (back[0].Home_team, back[0].Away_team, back[1].matchplayed) == (1, 2, 3)


def test_bad_team_id_fails(spark):
    row = list(feature_row(1, 1.0))
    row[2] = "Reds"
    path = scratch_path(spark, "tsv")
    writers.write_tsv(spark.createDataFrame([tuple(row)], schemas.DATED_DIFF), path)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_features(spark, path).collect()


def test_named_tables_are_switched_when_written(spark):
    folder = scratch_path(spark, "named")
    name = "named_rows"
    assert writers.replace_named(spark.range(5), name, folder).count() == 5
    before = spark.table(name)
    assert writers.replace_named(spark.range(3), name, folder).count() == 3
    failing = spark.range(0, 1000, 1, 4).select(
        F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("broke off")).cast("long")).alias("id")
    )
    with pytest.raises(Exception, match="broke off"):
        writers.replace_named(failing, name, folder)
    assert sorted(r.id for r in spark.table(name).collect()) == [0, 1, 2]
    assert spark.sql(f"SELECT count(*) AS n FROM {name}").head().n == 3
    other = writers.replace_named(spark.range(2).select("id", F.lit("x").alias("text")), name, folder)
    assert other.columns == ["id", "text"] and spark.table(name).count() == 2
    assert before.columns == ["id"]
    spark.sql(f"DROP TABLE {name}")


def test_replace_table_and_reports(spark):
    path = scratch_path(spark, "table")
    writers.replace_table(spark.range(5), path)
    assert writers.replace_table(spark.range(3), path).count() == 3
    writers.write_reports({"a": spark.range(2), "b": spark.range(4)}, path + "-reports")
    assert spark.read.parquet(path + "-reports/b").count() == 4


def test_names_ignore_case_and_trailing_blanks(spark):
    folder = scratch_path(spark, "sources")
    teams(spark, [(1, "Reds ", "NORTH", None)]).write.parquet(f"{folder}/teams.parquet")
    matches(spark, [match(1, "North", team1="REDS")]).write.parquet(f"{folder}/matches.parquet")
    spark.createDataFrame([], schemas.DELIVERIES).write.parquet(f"{folder}/deliveries.parquet")
    tables = readers.read_sources(spark, folder)
    joined = tables["matches"].join(tables["teams"], tables["teams"].Team_name == tables["matches"].team1)
    assert joined.count() == 1
    assert joined.where("city = Home_Ground").count() == 1


def test_stage_knows_its_size(spark):
    staged = stage(spark.range(1000).repartition(3), "numbers")
    assert 0 < input_bytes(staged) < 100_000
    assert broadcast_if_small(staged, 1) is staged


def test_rounding_treats_halves_alike(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(0.0000005,), (-0.0000005,), (10.717187499999999,)], "x double")
    assert [r[0] for r in df.select(rounded(F.col("x"))).collect()] == [0.000001, 0.0, 10.717188]


def test_rounding_at_any_size(spark):
    from pyspark.sql import functions as F

    values = [1e11, 2.5e13, -3e13, float("inf"), -1e300, 1.2345674995, 2.5e-7]
    df = spark.createDataFrame([(v,) for v in values], "x double").coalesce(1)
    for digits in (6, 8):
        found = [r[0] for r in df.select(rounded(F.col("x"), digits)).collect()]
        assert found[:5] == values[:5]
    assert [r[0] for r in df.select(rounded(F.col("x"))).collect()][5:] == [1.234567, 0.0]
    nan = spark.createDataFrame([(float("nan"),)], "x double").select(rounded(F.col("x")))
    assert nan.head()[0] != nan.head()[0]


def test_spread_does_not_depend_on_the_partitions_before(spark):
    from pavilion.functions.staging import spread

    rows = spark.range(500)
    parts = [spread(rows.repartition(n)).rdd.glom().collect() for n in (1, 4)]
    assert parts[0] == parts[1]
