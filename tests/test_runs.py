import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sievemark.operators import parts as R
from sievemark.packages import PACKAGES, SAMPLE_INPUTS
from sievemark.plans import check as C
from sievemark.plans import fused as FU
from sievemark.plans import runner as RU
from sievemark.sources import sinks
from sievemark.sources.catalog import Catalog

NOW = dt.datetime(2024, 5, 6)


@pytest.mark.parametrize("name", ["item", "bom"])
def test_fused_parts_equal_single_checks(refs, name):
    p = PACKAGES[name]
    ctx = p.context(refs[SAMPLE_INPUTS[name]], refs)
    parts, _, errors = FU.split_parts(ctx, p.checks)
    assert not errors
    got = {}
    for check_id, row in FU.fused_results(ctx, parts).collect():
        got.setdefault(check_id, []).append(row)
    counts = {r["check_id"]: r["result"] for r in FU.fused_counts(ctx, parts).collect()}
    for members in parts.values():
        for check_id, part in members:
            single = part.frame(ctx.base(part.over))
            text = single.select(F.to_json(F.map_from_entries(F.array(*[F.struct(F.lit(c), F.col(f"`{c}`").cast("string")) for c in single.columns])), {"ignoreNullFields": "false"}))
            expected = sorted(r[0] for r in text.collect())
            assert sorted(got.get(check_id, [])) == expected, check_id
            if not isinstance(part, R.Measure):
                assert counts.get(check_id, 0) == len(expected), check_id


def test_failing_checks_are_recorded_and_the_run_goes_on(spark, refs, tmp_path):
    p = PACKAGES["status"]
    run = RU.run_package(p, refs["stg_status"].drop("rdd_id"), refs, table_name="req", now=NOW, output=str(tmp_path / "out"))
    by_id = run.rows()
    assert [i for i, n in by_id.items() if n is None] == ["G03", "G05", "G07", "G08", "G18"]
    assert by_id["G01"] == 1 and by_id["G06"] == p.check("G06").frame(p.context(refs["stg_status"], refs)).count()
    log = run.log_frame(spark)
    assert [f.name for f in log.schema] == ["seq", "run_date", "table_name", "vl_mode", "sql_package", "sql_name", "result", "sql_definition"]
    failed = log.filter("result is null").collect()
    assert len(failed) == 5 and failed[0]["table_name"] == "REQ" and failed[0]["sql_name"] == "INFO - Count RDDs"
    manifest = {r["check_id"]: r["rows"] for r in spark.read.json(str(tmp_path / "out" / "manifest")).collect()}
    assert {k: v for k, v in manifest.items() if v is not None} == {k: v for k, v in by_id.items() if v is not None}
    reports = reports_of(spark, tmp_path / "out")
    assert set(reports) == {i for i, n in by_id.items() if n}
    assert reports["G04"].columns == ["TC_ID", "STATUS_NEW", "COUNT"]
    assert {i: df.count() for i, df in reports.items()} == {i: n for i, n in by_id.items() if n}


def reports_of(spark, folder, fmt="parquet", **options):
    """The reports of a run by check; a report's name ends with its number of rows."""
    found = {}
    for path in folder.iterdir():
        if " - Rows " in path.name:
            found[path.name.split(" ")[0]] = spark.read.options(**options).format(fmt).load(str(path))
            assert path.name.endswith(f" - Rows {found[path.name.split(' ')[0]].count()}") or fmt == "text"
    return found


def as_set(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


@pytest.mark.parametrize("broken", [False, True])
def test_reports_have_the_rows_and_types_of_their_checks(spark, refs, tmp_path, monkeypatch, broken):
    if broken:  # the job that writes all parts fails; nothing may be lost

        def fail(*args):
            raise RuntimeError("disk full")

        monkeypatch.setattr(sinks, "stage_packed", fail)
    p = PACKAGES["item"]
    wanted = ["A01", "A02", "A03", "A08", "A09", "A15", "A20", "A35", "A39", "A57"]
    run = RU.run_package(p, refs["stg_item"], refs, now=NOW, output=str(tmp_path / "out"), skip=[c.id for c in p.checks if c.id not in wanted])
    reports, by_id = reports_of(spark, tmp_path / "out"), run.rows()
    ctx = p.context(refs["stg_item"], refs)
    assert set(reports) == {i for i in wanted if by_id[i]} and None not in by_id.values()
    for i, df in reports.items():
        frame = p.check(i).frame(ctx)
        assert [(c.upper(), t) for c, t in frame.dtypes] == df.dtypes and as_set(frame) == as_set(df), i
    manifest = {r["check_id"]: r["report"] for r in spark.read.json(str(tmp_path / "out" / "manifest")).collect()}
    assert {i for i, path in manifest.items() if path} == set(reports) and not (tmp_path / "out" / "_staging").exists()


def test_a_second_run_replaces_the_reports_of_its_checks_only(spark, tmp_path):
    checks = [C.Check("Z1", C.ISSUE, "big/large: all?", lambda c: R.RowRule(F.col("v") > 1)), C.Check("Z2", C.INFO, "sum", lambda c: R.Measure({"t": F.sum("v")}))]
    p, out = C.Package("mine", ["v"], checks), tmp_path / "out"
    RU.run_package(p, spark.createDataFrame([(1,), (2,), (3,)], "v int"), now=NOW, output=str(out), output_format="csv")
    assert {x.name for x in out.iterdir()} == {"Z1 ISSUE - big_large_ all_ - Rows 2", "Z2 INFO - sum - Rows 1", "manifest"}
    RU.run_package(p, spark.createDataFrame([(2,)], "v int"), now=NOW, output=str(out), output_format="text", skip=["Z2"])
    assert {x.name for x in out.iterdir()} == {"Z1 ISSUE - big_large_ all_ - Rows 1", "Z2 INFO - sum - Rows 1", "manifest"}
    assert sorted(r.value for r in spark.read.option("lineSep", "\r\n").text(str(out / "Z1 ISSUE - big_large_ all_ - Rows 1")).collect()) == ["2", "INPUT"]
    RU.run_package(p, spark.createDataFrame([(0,)], "v int"), now=NOW, output=str(out), skip=["Z2"])
    assert {x.name for x in out.iterdir()} == {"Z2 INFO - sum - Rows 1", "manifest"}


def test_cells_of_every_type_come_back(spark):
    row = spark.sql(
        "select 1 i, cast(1.5 as double) d, cast(0.1 as float) f, cast('12.340' as decimal(9,3)) n, timestamp '2024-01-02 03:04:05.678901' t, "
        "date '2020-02-29' a, true b, x'00ff' x, array(1, null) l, named_struct('p', 'q', 'r', cast(null as int)) s, map('k', 2) m, cast(null as string) z"
    )
    part = R.RowRule(F.lit(True))
    (packed,) = FU._packed_over(row, [("Z1", part)])
    back = FU.report_of(packed, part, row.schema)
    assert back.dtypes == row.dtypes and back.collect() == row.collect()


def test_finished_checks_are_skipped_on_the_next_run(spark, refs, tmp_path):
    p = PACKAGES["status"]
    first = RU.run_package(p, refs["stg_status"].drop("rdd_id"), refs, table_name="req", now=NOW)
    sinks.append_log(first.log_frame(spark), str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    done = [r["check_id"] for r in RU.finished_checks(C.checks_frame(spark, [p]), log, "req", dt.datetime(2024, 1, 1)).collect()]
    assert len(done) == 16
    second = RU.run_package(p, refs["stg_status"], refs, table_name="req", now=NOW, skip=done)
    assert list(second.rows()) == ["G03", "G05", "G07", "G08", "G18"] and None not in second.rows().values()
    assert RU.finished_checks(C.checks_frame(spark, [p]), log, "other", dt.datetime(2024, 1, 1)).count() == 0


def test_run_counts_and_one_plan_counts_agree(refs):
    p = PACKAGES["name_desc"]
    ctx = p.context(refs["stg_namedesc"], refs)
    one_plan = {r["check_id"]: r["result"] for r in FU.package_counts(ctx, p.checks).collect()}
    assert RU.run_package(p, refs["stg_namedesc"], refs, now=NOW).rows() == one_plan


def test_bad_expression_in_one_part_fails_only_that_part(spark):
    checks = [
        C.Check("Z1", C.INFO, "rows", lambda c: R.row_count()),
        C.Check("Z2", C.ISSUE, "cast", lambda c: R.RowRule(F.col("v").cast("int") > 0, ["v"])),
        C.Check("Z3", C.ISSUE, "null", lambda c: R.null_rows("v")),
    ]
    run = RU.run_package(C.Package("mine", ["v"], checks), spark.createDataFrame([("x",), (None,)], "v string"), now=NOW)
    assert run.rows() == {"Z1": 1, "Z2": None, "Z3": 1}


@pytest.mark.parametrize("name", ["item", "bom"])
def test_shared_paths_give_the_same_counts_with_fewer_scans(spark, refs, name):
    from sievemark.plans.shared import drop_shared, share_paths

    p = PACKAGES[name]
    chosen = ("A03", "A05", "A16", "A52", "A57", "D05", "D07", "D08", "D20", "D24", "D29")
    checks = [k for k in p.checks if k.id in chosen]
    whole = p.context(refs[SAMPLE_INPUTS[name]], refs)
    ctx, tables = share_paths(whole)
    plans = {}
    for kind, c in (("whole", whole), ("shared", ctx)):
        df = FU.package_counts(c, checks)
        plans[kind] = df._jdf.queryExecution().optimizedPlan().toString()
        plans[kind, "rows"] = rows(df.select("check_id", "result"))
    assert plans["whole", "rows"] == plans["shared", "rows"] and len(plans["whole", "rows"]) == len(checks)
    assert 3 * plans["shared"].count("Relation ") < 2 * plans["whole"].count("Relation ")
    drop_shared(whole, tables)
    assert not [t for t in tables if spark.catalog.tableExists(t)]


def test_a_run_with_shared_paths_leaves_no_tables(spark, refs):
    p = PACKAGES["bom"]
    some = [k.id for k in p.checks if k.id not in ("D05", "D07", "D08")]
    before = len(spark.catalog.listTables())
    runs = [RU.run_package(p, refs["stg_bom"], refs, now=NOW, skip=some, share=s).rows() for s in (False, True)]
    assert runs[0] == runs[1] and None not in runs[0].values() and len(spark.catalog.listTables()) == before


def test_summary_shows_only_summary_checks(refs):
    p = PACKAGES["item"]
    got = {}
    for check_id, row in RU.summary(p, refs["stg_item"], refs).collect():
        got.setdefault(check_id, []).append(json.loads(row))
    assert set(got) <= {c.id for c in p.checks if c.summary} and "A03" not in got
    assert int(got["A01"][0]["cnt"]) == refs["stg_item"].count()


def test_user_checks_in_sql_with_parameters(spark, refs):
    check = C.sql_check("Z9", C.ISSUE, "big", "select p_partkey from {chk} where p_size > :limit", limit=45)
    assert check.frame(C.Context(refs["part"])).count() == refs["part"].filter("p_size > 45").count()


def test_package_listing_and_contract(spark, refs):
    listing = C.checks_frame(spark, list(PACKAGES.values()))
    assert listing.count() == 260
    assert [r[0] for r in listing.select("package").distinct().orderBy("package").collect()] == sorted(PACKAGES)
    assert PACKAGES["bom"].missing_columns(refs["stg_bom"].drop("quantity")) == ["quantity"]


def test_catalog_sites(spark):
    a, b = spark.range(1), spark.range(2)
    refs = Catalog({"pitem": a, "pitem@shatc": lambda: b})
    assert refs["pitem"].count() == 1 and refs["pitem@sha"].count() == 2 and refs.at("sha")["pitem"].count() == 2
    assert refs.at("edm")["pitem"].count() == 1


def test_sorted_frames(refs):
    p = PACKAGES["item"]
    lengths = [r["length"] for r in p.check("A38").frame(p.context(refs["stg_item"], refs), sort=True).collect()]
    assert lengths == sorted(lengths, reverse=True)


def test_repeated_relation_check_is_literal_unless_fixed(spark):
    p = PACKAGES["doc_relation"]
    df = spark.createDataFrame([("i", "1", "d", "RelatedDocuments")] * 2, "item_id string, revision string, doc_id string, relationship_type string")
    assert p.check("C07").frame(p.context(df)).count() == 0
    assert rows(p.check("C07").frame(p.context(df, fixed=True)))[0][-1] == 2


@pytest.mark.parametrize("written", [False, True])
def test_a_measure_that_fails_when_it_runs_is_logged_as_failed(spark, tmp_path, written):
    chk = spark.createDataFrame([("1",), ("x",)], "v string")
    checks = (
        C.Check("Z1", "INFO", "Sum", lambda c: R.Measure({"total": F.sum(F.col("v").cast("int"))})),
        C.Check("Z2", "INFO", "Rows", lambda c: R.row_count()),
    )
    p = C.Package("demo", ["v"], checks)
    run = RU.run_package(p, chk, table_name="t", now=NOW, output=str(tmp_path / "out") if written else None)
    assert run.rows() == {"Z1": None, "Z2": 1}
    assert [r["result"] for r in run.log_frame(spark).orderBy("seq").collect()] == [None, 1.0]


def test_derived_tables_that_checks_read_twice_are_stored_once(spark, tmp_path):
    from sievemark.plans.check import Check, Context
    from sievemark.plans.shared import drop_shared, share_paths
    from sievemark.session import checkpoint_folder, plan_nodes

    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    grouped = table.groupBy("k").agg(F.sum("v").alias("n"))
    bad = table.groupBy("k").agg(F.raise_error(F.lit("no such site")).alias("n"))
    once = table.select(F.col("k").alias("o")).distinct()
    refs = {"grouped": grouped, "bad": bad, "plain": table, "once": once}
    read = lambda name: lambda c: c.chk.join(c.refs[name].select(F.col("k").alias("_k")), F.col("k") == F.col("_k"))
    checks = [Check(f"Z{i}", "INFO", n, read(n)) for i, n in enumerate(("grouped", "grouped", "bad", "bad", "plain", "plain"))]
    checks += [Check("Z7", "INFO", "once", lambda c: c.refs["once"]), Check("Z8", "INFO", "none", lambda c: c.refs["none"])]
    ctx = Context(table.distinct(), refs)
    shared, names = share_paths(ctx, checks)
    assert plan_nodes(shared.refs["grouped"]) == ["Relation"] == plan_nodes(shared.chk)
    assert shared.refs["plain"] is table and shared.refs["bad"] is bad and shared.refs["once"] is once
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(checks[0].frame(shared)) == rows(checks[0].frame(ctx)) and rows(shared.chk) == rows(ctx.chk)
    drop_shared(ctx, names)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_folder(spark)}/shared")
    left = [f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    assert not set(left) & set(names)
