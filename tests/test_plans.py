import re

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from oracle.compare import difference
from sievemark.packages import PACKAGES, SAMPLE_INPUTS
from sievemark.plans.fused import fused_counts, split_parts
from sievemark.session import plan_nodes

CHECKS = {entry_name: (package, check_id) for entry_name, package, check_id in entry._checks()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_a_name_of_its_own_and_sql_where_possible():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert len(queries) > 380 and set(sql) <= set(queries)
    # Only the training-data operators, where installed, have queries that SQL cannot say.
    assert all(re.match(r"op\d+_|pipeline$", name) for name in set(queries) - set(sql))


@pytest.mark.parametrize("package", sorted(PACKAGES))
def test_no_check_joins_every_row_with_every_row(refs, package):
    """All joins have keys: no nested loops, no products."""
    p = PACKAGES[package]
    _, frames, _ = split_parts(p.context(refs[SAMPLE_INPUTS[package]], refs), p.checks)
    bad = [i for i, df in frames.items() if re.search("CartesianProduct|NestedLoopJoin", plan(df))]
    assert bad == []


def test_fused_package_reads_the_staged_table_once(spark, refs, tmp_path):
    refs["stg_item"].write.parquet(str(tmp_path / "item"))
    staged = spark.read.parquet(str(tmp_path / "item"))
    p = PACKAGES["item"]
    parts, _, _ = split_parts(p.context(staged, refs), p.checks)
    text = plan(fused_counts(p.context(staged, refs), parts))
    assert text.count("FileScan parquet") == 1 and text.count("Exchange hashpartitioning") <= 2


def test_filters_and_columns_reach_the_scan(spark, refs, tmp_path):
    refs["stg_item"].write.parquet(str(tmp_path / "item"))
    staged = spark.read.parquet(str(tmp_path / "item"))
    p = PACKAGES["item"]
    text = plan(p.check("A15").frame(p.context(staged, refs)))
    assert "PushedFilters: [IsNull(revision)]" in text
    assert "ReadSchema: struct<tc_id:string,revision:string>" in text


@pytest.mark.parametrize("package", sorted(PACKAGES))
def test_checks_equal_their_sql(spark, con, package):
    queries, sql = entry.queries(), entry.oracle_sql()
    names = [n for n, (p, _) in CHECKS.items() if p == package]
    keep = names[len(package) % 7 :: 7]
    bad = {n: d for n in keep if (d := difference(queries[n](spark, SMALL), con, sql[n]))}
    assert bad == {}


def test_entry_counts_every_item_check(spark):
    assert entry.entry(spark).count() == 63


def test_sample_inputs_cover_all_packages():
    assert set(SAMPLE_INPUTS) == set(PACKAGES)


def test_wide_master_rows_are_joined_last(refs):
    """A document has many parts: its texts are not carried through their joins and groups."""
    p = PACKAGES["status"]
    df = p.check("G21").frame(p.context(refs["stg_status"], refs))
    assert plan_nodes(df)[:2] == ["Project", "Join"]


def test_second_parts_do_not_work_out_their_items_twice(refs):
    p = PACKAGES["ownership"]
    assert plan_nodes(p.check("H16").frame(p.context(refs["stg_owner"], refs))).count("Relation") < 200


def test_pairs_of_staged_rows_are_counted_from_the_rows(refs):
    """Not from their groups: every use of the pairs would move all groups."""
    p = PACKAGES["doc_relation"]
    text = p.check("C11").frame(p.context(refs["stg_docrel"], refs))._jdf.queryExecution().optimizedPlan().toString()
    groups = [line for line in text.splitlines() if re.search(r"Aggregate \[item_id#\d+, revision#\d+, doc_id#\d+", line)]
    assert len(groups) <= 1 and "sum(_n" not in text
