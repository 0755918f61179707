import random

import pytest
from pyspark.sql import functions as F

from sievemark.operators import ordered as O


def records(spark, n=600, seed=1):
    r = random.Random(seed)
    rows = [(i, r.choice([None, "a", "b", "b", "c", f"k{r.randrange(40)}"]), r.choice([None, "x", "y"]), r.randrange(5)) for i in range(n)]
    r.shuffle(rows)
    return rows, spark.createDataFrame(rows, "pos long, k string, v string, t int").repartition(6)


def place(v):
    return (v is not None, v)


@pytest.mark.parametrize("ranges", [1, 7, 200])
def test_numbers_follow_the_order(spark, ranges):
    rows, df = records(spark)
    got = O.numbered(df, ["pos"], total="n", ranges=ranges).collect()
    assert sorted((r.pos, r.position) for r in got) == [(i, i + 1) for i in range(600)] and {r.n for r in got} == {600}
    tied = O.numbered(df, ["k", "t"], ranges=ranges).collect()
    assert sorted(r.position for r in tied) == list(range(1, 601))
    in_order = [(place(r.k), r.t) for r in sorted(tied, key=lambda r: r.position)]
    assert in_order == sorted(in_order)


@pytest.mark.parametrize("ranges", [1, 7, 200])
def test_previous_record_equals_the_sequential_rule(spark, ranges):
    rows, df = records(spark)
    want, before = [], (None, None)
    changed, both, first = set(), set(), True
    for pos, k, v, _ in sorted(rows):
        want.append((pos, *before))
        if first or (k, v) != before:
            changed.add(pos)
        if k != before[0] and v != before[1]:
            both.add(pos)
        before, first = (k, v), False
    got = O.with_previous(df, ["k", "v"], ["pos"], ranges=ranges)
    assert sorted((r.pos, r.previous_k, r.previous_v) for r in got.collect()) == want
    assert {r.pos for r in O.key_changes(df, ["k", "v"], ["pos"], ranges=ranges).collect()} == changed
    assert {r.pos for r in O.key_changes(df, ["k", "v"], ["pos"], every=True, ranges=ranges).collect()} == both


@pytest.mark.parametrize("ranges", [1, 7, 200])
@pytest.mark.parametrize("part_rows", [3, 100_000])
def test_ordered_groups_equal_the_sequential_rule(spark, ranges, part_rows):
    rows, df = records(spark)
    want, group, position, before = [], 0, 0, "none yet"
    for row in sorted(rows, key=lambda r: (place(r[1]), r[3], r[0])):
        group, position = (group, position + 1) if row[1] == before else (group + 1, 1)
        want.append((*row, group, position, (position - 1) // part_rows))
        before = row[1]
    got = O.ordered_groups(df, ["k"], ["t", "pos"], part_rows, ranges)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_equal_rows_beyond_a_range_travel_as_one(spark, monkeypatch):
    monkeypatch.setattr(O, "RANGE_ROWS", 20)
    rows = [("b", 1)] * 300 + [("a", i) for i in range(40)] + [("c", i % 7) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(5)
    o = O.order_rows(df, ["k"], 9)
    assert o.copied and o.rows.count() == 101 and o.total == 400
    got = sorted((r.position, r.k) for r in O.numbered(df, ["k"], ranges=9).collect())
    assert got == list(enumerate(["a"] * 40 + ["b"] * 300 + ["c"] * 60, start=1))
    groups = O.ordered_groups(df, ["k"], ["v"], 50, 9).collect()
    assert sorted((r.k, r.group_no, r.position, r.part) for r in groups) == sorted(
        (k, g, i, (i - 1) // 50) for g, (k, n) in enumerate([("a", 40), ("b", 300), ("c", 60)], start=1) for i in range(1, n + 1)
    )
    previous = sorted((r.position, r.k, r.previous_k) for r in O.with_previous(df, ["k"], ["k"], ranges=9).collect())
    keys = ["a"] * 40 + ["b"] * 300 + ["c"] * 60
    assert previous == [(i + 1, k, keys[i - 1] if i else None) for i, k in enumerate(keys)]


def test_empty_and_single_rows(spark):
    one = spark.createDataFrame([(1, "a")], "pos long, k string")
    none = one.limit(0)
    assert O.numbered(none, ["pos"]).count() == 0 and O.ordered_groups(none, ["k"]).count() == 0 and O.key_changes(none, ["k"], ["pos"]).count() == 0
    assert [tuple(r) for r in O.ordered_groups(one, ["k"]).collect()] == [(1, "a", 1, 1, 0)]
    assert O.key_changes(one, ["k"], ["pos"]).count() == 1
    null = one.withColumn("k", F.lit(None).cast("string"))
    assert O.key_changes(null, ["k"], ["pos"]).count() == 1 and O.key_changes(null, ["k"], ["pos"], every=True).count() == 0
