import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from sievemark.plans import split as SP
from sievemark.sources import readers as RD


def greedy(keys, n):
    """Chunk of every key, one group after the other."""
    out, chunk, filled = {}, 0, 0
    for k, g in groupby(sorted(keys)):
        out[k] = chunk
        filled += len(list(g))
        if filled >= n:
            chunk, filled = chunk + 1, 0
    return out


@pytest.mark.parametrize("n", [1, 7, 50, 10_000])
@pytest.mark.parametrize("shape", ["single", "mixed", "hot", "even"])
def test_group_split_equals_sequential_greedy(spark, n, shape):
    rnd = random.Random(n)
    if shape == "single":
        keys = [f"{i:05d}" for i in range(400)]
    elif shape == "even":
        keys = [f"{i:05d}" for i in range(100) for _ in range(4)]
    else:
        keys = [f"{rnd.randrange(90):03d}" for _ in range(270)] + ["040"] * (130 if shape == "hot" else 3)
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string").repartition(5)
    got = SP.split_by_group(df, ["k"], n).collect()
    assert len(got) == len(keys)
    expected = greedy(keys, n)
    assert {(r["i"], r["k"], r["chunk"]) for r in got} == {(i, k, expected[k]) for i, k in enumerate(keys)}


def test_group_split_on_two_keys_sorts_field_by_field(spark):
    data = [("a", "2"), ("a", "10"), ("b", "1"), ("a", "10"), ("b", None)]
    df = spark.createDataFrame(data, "x string, y string")
    got = {(r["x"], r["y"]): r["chunk"] for r in SP.split_by_group(df, ["x", "y"], 2).collect()}
    assert got == {("a", "10"): 0, ("a", "2"): 1, ("b", None): 1, ("b", "1"): 2}


@pytest.mark.parametrize("n", [1, 3, 100, 250])
def test_size_split_numbers_rows_in_order(spark, n):
    values = list(range(250))
    random.Random(3).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(6)
    assert all(r["chunk"] == r["v"] // n for r in SP.split_by_size(df, n, ["v"]).collect())
    k = max(1, 250 // n)
    size = -(-250 // k)
    assert all(r["chunk"] == r["v"] // size for r in SP.split_in(df, k, ["v"]).collect())


def test_leading_short_lines_are_dropped_only_at_the_top(spark):
    df = spark.createDataFrame([(1, "title"), (2, ""), (3, "a|b"), (4, "x"), (5, "c|d")], "p int, value string")
    out = SP.drop_leading_short(RD.split_fields(df, "|"), "p", "fields")
    assert sorted(r["p"] for r in out.collect()) == [3, 4, 5]


def test_position_keeps_stored_order_without_keys(spark):
    df = spark.range(0, 100, 1, 4).select(F.col("id"))
    assert all(r["position"] == r["id"] + 1 for r in SP.with_position(df).collect())


@pytest.mark.parametrize("entries", [1, 40, 10**6])
@pytest.mark.parametrize("n", [3, 60, 1000])
def test_carry_tree_equals_sequential_greedy(spark, monkeypatch, entries, n):
    from sievemark.operators import ordered

    monkeypatch.setattr(SP, "CHAIN_ENTRIES", entries)
    monkeypatch.setattr(ordered, "_PER_RANGE", 100)
    monkeypatch.setattr(SP, "order_rows", lambda df, order: ordered.order_rows(df, order, 23))
    rnd = random.Random(n)
    keys = [f"{i:04d}" for i in range(500)] + [f"{rnd.randrange(500):04d}" for _ in range(400)] + ["0250"] * 90
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string").repartition(3)
    expected = greedy(keys, n)
    assert {(r["k"], r["chunk"]) for r in SP.split_by_group(df, ["k"], n).select("k", "chunk").distinct().collect()} == set(expected.items())


def test_one_row_per_key_and_a_large_chunk(spark):
    n, total = 1_000_000, 2_500_000
    df = spark.range(total).select(F.format_string("%08d", "id").alias("k"))
    got = SP.split_by_group(df, ["k"], n).groupBy("chunk").agg(F.count("*").alias("rows"), F.min("k").alias("low")).collect()
    assert sorted(map(tuple, got)) == [(0, n, "00000000"), (1, n, "01000000"), (2, total - 2 * n, "02000000")]


def test_composed_effects_equal_one_run_after_the_other():
    import numpy as np

    r = random.Random(5)
    for _ in range(300):
        n = r.randint(1, 12)
        runs = [[r.randint(1, 6) for _ in range(r.randint(1, 6))] for _ in range(3)]

        def effect(sizes):
            import pyarrow as pa

            t = pa.table({"_size": sizes, "_i": list(range(len(sizes))), "run": [0] * len(sizes)})
            return SP._effects_of(SP._effect(n)(t))[1][0]

        both = SP._then(SP._then(effect(runs[0]), effect(runs[1])), effect(runs[2]))
        for carry in range(n):
            open_rows, closed = carry, 0
            for size in sum(runs, []):
                open_rows += size
                if open_rows >= n:
                    open_rows, closed = 0, closed + 1
            assert [int(x[0]) for x in SP._after(both, np.array([carry]))] == [open_rows, closed]


def test_lines_are_split_by_fields_without_the_leading_title(spark, tmp_path):
    lines = ["title", "", "b|2|x", "a|10|y", "short", "a|2|z", "b|1|w"]
    (tmp_path / "in.txt").write_text("\n".join(lines) + "\n")
    got = SP.split_lines_by_group(RD.read_lines(spark, str(tmp_path / "in.txt")), "|", [1, 2], 2)
    keys = {"a|10|y": ("a", "10"), "a|2|z": ("a", "2"), "b|1|w": ("b", "1"), "b|2|x": ("b", "2"), "short": ("short", "")}
    assert {r["value"]: r["chunk"] for r in got.collect()} == {v: greedy(keys.values(), 2)[k] for v, k in keys.items()}
    (tmp_path / "none.txt").write_text("only\ntitles\n")
    assert SP.split_lines_by_group(RD.read_lines(spark, str(tmp_path / "none.txt")), "|", [1], 2).count() == 0


def test_files_are_numbered_by_blocks_without_a_checkpoint(spark, tmp_path, monkeypatch):
    lines = [f"line {i:05d}" for i in range(4000)]
    for part in range(4):
        (tmp_path / f"f{part}.txt").write_text("\n".join(lines[part * 1000 : (part + 1) * 1000]) + "\n")

    def never(df):
        raise AssertionError("rows were written")

    monkeypatch.setattr(SP, "cut_lineage", never)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        df = spark.read.text(str(tmp_path))
        assert df.rdd.getNumPartitions() > 4
        assert all(r.value == lines[r.position - 1] for r in SP.with_position(df).collect())
        assert all(int(r.value[5:]) // 700 == r.chunk for r in SP.split_by_size(df, 700).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
