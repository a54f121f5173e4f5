import random

from pavilion.operators.positions import chronological_split, head, positions


def rows_of(seed=3, n=300):
    rng = random.Random(seed)
    # A third of the values are equal, so that ties matter.
    return [(rng.choice("xyz"), 0 if rng.random() < 0.4 else rng.randrange(40), i) for i in range(n)]


def test_distributed_equals_sorted_order(spark):
    rows = rows_of()
    df = spark.createDataFrame(rows, "g string, v int, id long").repartition(5)
    want = {r[2]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])))}
    for strategy in ("window", "distributed"):
        out = positions(df, ["v", "id"], strategy=strategy)
        assert {r.id: r.position for r in out.collect()} == want


def test_positions_within_groups(spark):
    rows = rows_of(5)
    df = spark.createDataFrame(rows, "g string, v int, id long").repartition(5)
    want = {}
    for g in "xyz":
        group = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        want.update({r[2]: i + 1 for i, r in enumerate(group)})
    out = positions(df, ["v", "id"], ["g"], "place", "distributed")
    assert {r.id: r.place for r in out.collect()} == want


def test_head_and_split(spark):
    df = spark.createDataFrame(rows_of(n=30), "g string, v int, id long")
    assert [r.id for r in head(df, ["id"], 3).collect()] == [0, 1, 2]
    for strategy in ("window", "distributed"):
        split = chronological_split(df, ["id"], 20, strategy)
        assert {r.id for r in split.where("split = 'train'").collect()} == set(range(20))
