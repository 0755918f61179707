import collections
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sievemark.operators import keyed as N
from sievemark.operators import reference as S
from sievemark.operators import rows as A
from sievemark.operators import sets as U


@pytest.fixture
def skewed(spark):
    """A third of all rows share one key, a tenth has none."""
    rnd = random.Random(7)
    data = []
    for i in range(600):
        key = "HOT" if i % 3 == 0 else None if i % 10 == 1 else f"k{rnd.randrange(150)}"
        data.append((i, key, rnd.choice(["a", "b", "c", None])))
    return data, spark.createDataFrame(data, "i int, k string, v string").repartition(4)


@pytest.fixture(params=[5_000_000, 50, 2])
def heavy(request, monkeypatch):
    """With the real bound no key is heavy here, with the small ones many are."""
    monkeypatch.setattr(N, "PIECE_ROWS", request.param)
    return request.param


def test_duplicate_rows_with_heavy_keys(skewed, heavy):
    data, df = skewed
    n = collections.Counter(k for _, k, _ in data)
    expected = sorted(((i, k, v, n[k]) for i, k, v in data if n[k] > 1), key=repr)
    assert rows(N.duplicate_rows(df, ["k"])) == expected
    assert rows(N.duplicate_rows(df, [F.upper("k")])) == expected
    m = collections.Counter(k for _, k, v in data if v is not None)
    got = rows(N.duplicate_rows(df, ["k"], counted=F.col("v")))
    assert got == sorted(((i, k, v, m[k]) for i, k, v in data if m[k] > 1), key=repr)


def test_duplicate_rows_distinct_counts_before_distinct(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("c", 1), ("C", 2)], "k string, x int")
    assert rows(N.duplicate_rows(df, [F.upper("k")], distinct=True)) == [("C", 2, 2), ("a", 1, 2), ("c", 1, 2)]


def test_multi_value_rows_with_heavy_keys(skewed, heavy):
    data, df = skewed
    seen = collections.defaultdict(set)
    for _, k, v in data:
        if v is not None:
            seen[k].add(v)
    expected = {(k, v, len(seen[k])) for _, k, v in data if len(seen[k]) > 1}
    assert rows(N.multi_value_rows(df, ["k"], "v", ["k", "v"])) == sorted(expected, key=repr)
    full = sorted(((i, k, v, len(seen[k])) for i, k, v in data if len(seen[k]) > 1), key=repr)
    assert rows(N.multi_value_rows(df, ["k"], "v", distinct=False)) == full


def test_counts_per_key(skewed, heavy):
    data, df = skewed
    n = collections.Counter(k for _, k, _ in data)
    assert rows(N.count_per_key(df, ["k"], "n")) == sorted(((i, k, v, n[k]) for i, k, v in data), key=repr)
    seen = collections.defaultdict(set)
    for _, k, v in data:
        if v is not None:
            seen[k].add(v)
    assert rows(N.distinct_count_per_key(df, ["k"], "v", "n")) == sorted(((i, k, v, len(seen[k])) for i, k, v in data), key=repr)


def test_value_lists_hold_every_copy_in_order(skewed):
    data, df = skewed
    lists = collections.defaultdict(list)
    for _, k, v in data:
        if v is not None:
            lists[k].append(v)
    assert rows(N.value_lists(df, ["k"], "v", "l")) == sorted(((k, ", ".join(sorted(v))) for k, v in lists.items()), key=repr)


def test_one_list_per_key_whatever_its_length(spark):
    many = [("a", f"{i:05d}") for i in range(40_000)] + [("b", "x" * 100)] * 20_000 + [("c", "y"), ("c", "y")]
    df = spark.createDataFrame(many, "k string, v string")
    assert rows(N.value_lists(df, ["k"], "v", "l")) == [
        ("a", ", ".join(f"{i:05d}" for i in range(40_000))), ("b", ", ".join(["x" * 100] * 20_000)), ("c", "y, y")
    ]
    assert [r[0] for r in rows(N.multi_value_lists(df, "k", "v", "n", "l"))] == ["a"]


def test_long_lists_report_no_known_revision(spark):
    data = [("d", 1, f"{i:03d}", new) for i in range(900) for new in ("000", "450", "899", "zz")] + [("e", 2, "07", "07")] * 400
    df = spark.createDataFrame(data, "doc string, item int, rev string, new string")
    for exact in (False, True):
        assert [(r[0], r[2]) for r in rows(S.revision_not_listed(df, "doc", "item", "rev", "new", exact=exact))] == [("d", "zz")]


def test_versions_same_date_counts_distinct_versions(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 1, "x"), ("a", None, "p"), ("a", None, "q"), ("b", 1, "x"), ("b", 1, None)], "k string, d int, v string")
    assert rows(N.versions_same_date(df, "k", "d", "v")) == [("a", 1, 2, "x, y"), ("a", None, 2, "p, q")]


def test_latest_takes_missing_date_first_and_larger_id_on_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 5, "x"), ("b", None, "n")], "k string, d int, v string")
    assert rows(N.latest_per_key(df, "k", "d", "v", ["v"])) == [("a", "z"), ("b", "n")]


def test_majority_ties_and_missing_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "v string")
    assert rows(N.majority_value(df, "v")) == [("a",)]
    items = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, g string")
    assert rows(S.not_in_majority(items, df.select(F.col("v").alias("g")), "g", ["i"])) == [(2,), (3,)]


def test_revision_list_test_is_on_text_unless_exact(spark):
    df = spark.createDataFrame([("d", 1, "10", "1"), ("d", 1, "20", "1"), ("e", 2, "A", None), ("f", 3, "A", "_"), ("g", 4, "A", "B")], "doc string, item int, rev string, new string")
    assert rows(S.revision_not_listed(df, "doc", "item", "rev", "new")) == [("g", "A", "B")]
    assert [r[0] for r in rows(S.revision_not_listed(df, "doc", "item", "rev", "new", exact=True))] == ["d", "f", "g"]


def test_outer_join_of_three_inputs_names_clashes(spark):
    a = spark.createDataFrame([("1", "p"), (None, "q")], "ID string, N string")
    b = spark.createDataFrame([("1", "r"), ("2", "s"), (None, "t")], "ID string, N string")
    d = spark.createDataFrame([("2", "u")], "ID string, M string")
    out = U.outer_join_inputs([a, b, d], ["ID"])
    assert out.columns == ["ID", "N_x", "N_y", "M"]
    assert rows(out) == sorted([("1", "p", "r", None), ("2", None, "s", "u"), (None, "q", "t", None)], key=repr)


def test_anti_join_any_equals_not_exists_with_or(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None), (None, "z")], "i string, g string")
    other = spark.createDataFrame([("a", "q"), (None, "y")], "i string, g string")
    assert rows(U.anti_join_any(df, ("i", other, "i"), ("g", other, "g"))) == [("c", None), (None, "z")]


def test_id_union_counts_null_once(spark):
    df = spark.createDataFrame([("a", "b"), ("b", None), (None, "a")], "p string, c string")
    assert rows(U.id_union(df, ["p", "c"])) == [("a",), ("b",), (None,)]
    assert len(rows(U.id_union(df, {"P": "p", "C": "c"}))) == 6


def test_update_leaves_rows_of_unknown_condition(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, n int")
    assert rows(A.update_rows(df, {"k": "upper(k)"}, "n = 1")) == [("A", 1), ("b", None)]
    assert rows(A.affected_rows(df, "n = 1")) == [(1,)]


def test_order_puts_nulls_last_ascending_first_descending(spark):
    df = spark.createDataFrame([("10",), ("9",), (None,)], "v string")
    assert [r[0] for r in A.ordered(df, ["v"]).collect()] == ["10", "9", None]
    assert [r[0] for r in A.ordered(df, ["-v"]).collect()] == [None, "9", "10"]
    assert [r[0] for r in A.ordered(df, ["#v"]).collect()] == ["9", "10", None]


def test_dropped_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "v string")
    assert rows(U.dropped_rows(df)) == [(1, 2)]
    assert rows(U.column_profile(df.withColumn("w", F.lit("")))) == [("v", 1, False), ("w", 0, True)]


def test_numbers_sort_exactly_with_keys_worked_out_once(spark):
    texts = ["9007199254740993", "9007199254740992", "9007199254740992.5", "9007199254740991.9999999999", "0.1", "0.1000000001", "-0.1", "-3", "x", None, "", "7", "7.0", "9999999999999999999999999999", "9999999999999999999999999998.9", "-9007199254740993"]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "q string, i int")
    for spec, how in (("#q", "asc nulls last"), ("-#q", "desc nulls first")):
        want = df.orderBy(F.expr("try_cast(q as decimal(38,10))").asc_nulls_last() if spec == "#q" else F.expr("try_cast(q as decimal(38,10))").desc_nulls_first(), "i")
        got = A.ordered(df, [spec, "i"])
        assert got.columns == df.columns and got.collect() == want.collect()
        sorts = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Sort [" in line]
        assert sorts and not any("cast" in s for s in sorts)


def test_value_that_is_a_key_needs_no_set_of_values(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("a", None, 3), ("a", None, 4), ("b", "y", 5)], "k string, v string, i int")
    got = N.multi_value_rows(df, ["k", "v"], "v", distinct=False)
    assert got.columns == ["k", "v", "i", "cnt"] and got.collect() == []
    assert "distinct" not in got._jdf.queryExecution().optimizedPlan().toString()
