"""Operators that return whole rows keep every column, whatever its name."""

import random

import pytest

from pavilion.llm import contamination, jaccard_join, mixing, sharding, toxicity
from pavilion.llm.names import free_names

NAMES = (
    "_copies _copy _key _hash _one _place _size _crc32 _coarse _fine _total _outer _inner _within _start "
    "mark copies copy rank hashed one place number row_number size crc32 coarse fine total outer inner "
    "within first shard slot start epoch taken rows component key source_text SOURCE_null"
).split()
LIMIT = jaccard_join.Threshold(80, 100)


def documents(spark, rows):
    extra = ", ".join(f"`{n}` string" for n in NAMES)
    data = [(i, t, "en", s, len(t or ""), *[f"{n}-{k}" for n in NAMES]) for k, (i, t, s) in enumerate(rows)]
    return spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")


@pytest.mark.parametrize(
    "operator",
    [
        mixing.mixed_rows,
        sharding.sharded_rows,
        lambda docs: jaccard_join.one_per_component(docs, 5, LIMIT),
        lambda docs: contamination.without_leaks(docs, docs.selectExpr("doc_id + 1000 AS item_id", "'no such passage here' AS text")),
        lambda docs: toxicity.without_toxic(docs, toxicity.learn(docs, docs.selectExpr("doc_id", "0 AS toxic"))),
    ],
)
def test_columns_with_clashing_names_stay(spark, operator):
    r = random.Random(1)
    rows = [(i, " ".join(r.choices("abcdefghij", k=20)) + f" {i}", "xy"[i % 2]) for i in range(40)] + [(None, None, None), (3, "", "x")]
    docs = documents(spark, rows)
    given = {tuple(x) for x in docs.collect()}
    out = operator(docs)
    renamed = {"shard": "shard_", "slot": "slot_"} if operator is sharding.sharded_rows else {}
    names = [renamed.get(c, c) for c in docs.columns]
    assert out.columns[: len(names)] == names
    kept = [tuple(x)[: len(names)] for x in out.collect()]
    assert kept and set(kept) <= given
    if operator is sharding.sharded_rows:
        assert out.columns[len(names) :] == ["shard", "slot"] and len(kept) == len(given)


def test_free_names():
    assert free_names(["a", "A_", "b"], "a", "c", "c") == ["a__", "c", "c_"]


def test_texts_of_one_identifier_are_judged_apart(spark):
    r = random.Random(2)
    text = [" ".join(r.choices([f"{a}{b}" for a in "klmn" for b in "aeiou"], k=40)) for _ in range(4)]
    near = text[0] + " tail"
    rows = [(5, text[0], "x"), (5, text[1], "x"), (2, near, "x"), (7, text[1], "y"), (9, text[2], "x"), (9, text[2], "x")]
    rows += [(11, "", "x"), (12, None, "x"), (None, text[2], "x"), (None, text[2], "x"), (13, text[3], "x"), (13, text[3] + " end", "x")]
    out = jaccard_join.one_per_component(documents(spark, rows), 5, LIMIT)
    kept = sorted(((x["doc_id"], x["text"]) for x in out.collect()), key=str)
    thirteen = [k for k in kept if k[0] == 13]
    assert len(thirteen) == 1 and thirteen[0][1].startswith(text[3])
    assert sorted((k for k in kept if k[0] != 13), key=str) == sorted(
        [(2, near), (5, text[1]), (9, text[2]), (11, ""), (12, None), (None, text[2]), (None, text[2])], key=str
    )
    again = jaccard_join.one_per_component(documents(spark, rows).repartition(7), 5, LIMIT).collect()
    assert sorted(((x["doc_id"], x["text"]) for x in again), key=str) == kept
    first = [x for x in out.collect() if x["doc_id"] == 9]
    assert first[0]["mark"] == min(f"mark-{k}" for k in (4, 5))
