"""The driver contract: names, and a sample of queries against their reference SQL."""

import os

import pytest

import __spark_entry__ as contract
import check

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "match_indicators",
    "innings_ratios",
    "rolling_batting_blocked",
    "final_ratio",
    "tsv_roundtrip",
    "cut8",
    "msd_pairs",
    "fold_metrics",
    "knn_predict",
]


def test_every_reference_text_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the generated tables")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_reference_sql(spark, name):
    assert check.compare(spark, check.database(FOLDER), FOLDER, name).same


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the generated tables")
def test_entry(spark):
    out = contract.entry(spark)
    assert out.columns[:5] == ["id", "season", "Home_team", "Away_team", "Home_team_Win"]
    assert out.count() == 1105
