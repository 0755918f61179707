"""What checks of a run leave behind while later ones run."""

import datetime as dt
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sievemark.operators import parts as R
from sievemark.plans import check as C
from sievemark.plans import fused as FU
from sievemark.plans import runner as RU
from sievemark.plans import shared as SH
from sievemark.session import FILE_CLEANUP, finished, shuffles_removed

NOW = dt.datetime(2024, 5, 6)


def shuffle_files(spark):
    """Shuffle data of the session that is on disk, once removals under way are over."""
    folder = os.path.dirname(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    names = lambda: {f for _, _, fs in os.walk(folder) for f in fs if f.startswith("shuffle_") and f.endswith(".data")}
    found, until = names(), time.time() + 3
    while time.time() < until:
        time.sleep(0.3)
        found &= names()
    return found


def some_checks():
    return [
        C.Check("Z1", C.INFO, "groups", lambda c: c.chk.groupBy("v").agg(F.count("*").alias("n"))),
        C.Check("Z2", C.INFO, "rows", lambda c: c.chk.select("v")),
        C.Check("Z3", C.INFO, "missing", lambda c: c.chk.select("none")),
        C.Check("Z4", C.INFO, "sum", lambda c: R.Measure({"t": F.sum("v")})),
        C.Check("Z5", C.ISSUE, "big", lambda c: R.RowRule(F.col("v") > 3)),
        C.Check("Z6", C.ISSUE, "none", lambda c: R.RowRule(F.col("v") > 100)),
    ]


def staged(spark):
    return spark.createDataFrame([(1,), (1,), (2,), (4,), (None,)], "v int")


def test_counts_apart_are_those_of_one_plan_and_leave_no_shuffle_files(spark):
    checks = some_checks()
    ctx = C.Context(staged(spark))
    before = shuffle_files(spark)
    apart = FU.package_counts(ctx, checks, apart=True)
    assert not shuffle_files(spark) - before
    nodes = apart._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in nodes  # all counts are found
    assert rows(apart) == rows(FU.package_counts(ctx, checks))
    assert {r["check_id"]: r["result"] for r in apart.collect()} == {"Z1": 4, "Z2": 5, "Z3": None, "Z4": 1, "Z5": 1, "Z6": 0}


def test_counts_apart_fail_with_their_check(spark):
    bad = [C.Check("Z1", C.INFO, "bad", lambda c: c.chk.filter(F.raise_error(F.lit("no such site")).isNull()))]
    for apart in (False, True):
        with pytest.raises(Exception, match="no such site"):
            FU.package_counts(C.Context(staged(spark)), bad, apart=apart).collect()


@pytest.mark.parametrize("written", [False, True])
def test_checks_of_a_run_leave_no_shuffle_files(spark, tmp_path, written):
    before = shuffle_files(spark)
    p = C.Package("mine", ["v"], some_checks())
    run = RU.run_package(p, staged(spark), now=NOW, output=str(tmp_path / "out") if written else None, share=True)
    assert run.rows() == {"Z1": 4, "Z2": 5, "Z3": None, "Z4": 1, "Z5": 1, "Z6": 0}
    assert not shuffle_files(spark) - before
    assert spark.conf.get(FILE_CLEANUP) == "false"


def test_tables_of_a_run_are_stored_without_leaving_shuffle_files(spark, tmp_path):
    staged(spark).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    before = shuffle_files(spark)
    ctx, names = SH.share_paths(C.Context(table.distinct(), {}, {}, ("v",)))
    assert not shuffle_files(spark) - before
    assert rows(ctx.chk) == rows(table.distinct()) and rows(ctx.ids) == [("1",), ("2",), ("4",), (None,)]
    SH.drop_shared(ctx, names)


def test_a_run_query_drops_its_tables(spark, refs):
    from registry.operators import OPS

    before = len(spark.catalog.listTables())
    counts = {r["check_id"]: r["result"] for r in OPS["L07_run_bom"][0](refs).collect()}
    assert len(counts) == 32 and None not in counts.values() and len(spark.catalog.listTables()) == before


def test_the_setting_of_the_session_comes_back(spark):
    spark.conf.set(FILE_CLEANUP, "false")
    with pytest.raises(ValueError), shuffles_removed(spark):
        assert spark.conf.get(FILE_CLEANUP) == "true"
        raise ValueError
    assert spark.conf.get(FILE_CLEANUP) == "false"
    spark.conf.unset(FILE_CLEANUP)


def test_what_still_runs_at_the_end_of_a_job_is_ended(spark):
    from pyspark import InheritableThread

    slow = spark.range(4).select(F.expr("reflect('java.lang.Thread', 'sleep', 60000L)"))
    late = []

    def work():
        try:
            slow.collect()
        except Exception as e:  # noqa: BLE001
            late.append(str(e))

    def begin():
        thread = InheritableThread(target=work)
        thread.start()
        time.sleep(2)
        return thread

    thread = finished(spark, begin)
    thread.join(20)
    assert isinstance(thread, threading.Thread) and not thread.is_alive() and late


def test_occurrences_of_rows_are_dealt_once(spark, tmp_path):
    from sievemark.operators import paths as K
    from sievemark.operators import relations as L

    def table(name, data, schema):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    revs = table("rows", [("a", "r1"), ("b", "r1"), ("c", "r2"), ("d", None), ("e", "r9")], "id string, rev_puid string")
    refs = {
        "pstructure_revisions": table("s", [("r1", "s1"), ("r1", "s2"), ("r2", "s1"), (None, "s3"), ("r3", None)], "puid string, pvalu_0 string"),
        "ppsoccurrence": table(
            "o",
            [("s1", "x", 1.0, "1", None), ("s1", "x", 1.0, "1", None), ("s2", "y", None, "2", "n"), (None, "z", 1.0, "1", "n"), ("s4", "z", 1.0, "1", "n")],
            "rparent_bvru string, rchild_itemu string, pqty_value double, pseq_no string, rnotes_refu string",
        ),
    }
    before = revs.join(K.occurrences(refs), F.col("rev_puid") == F.col("struct_rev"))
    now = L.with_occurrences(revs, refs)
    assert rows(now.select(*before.columns)) == rows(before) and now.count() == 8

    def dealt(df):
        """Exchanges above the scan of occurrences where no side is small enough to be broadcast."""
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            df = df.select("*")
            paths, plan = [], df._jdf.queryExecution().executedPlan().toString().splitlines()
            for line in plan:
                depth = next((i for i, ch in enumerate(line) if ch.isalpha()), 0)
                paths = [(d, t) for d, t in paths if d < depth] + [(depth, line)]
                if "FileScan" in line and "rchild_itemu" in line:
                    return sum("Exchange" in t for _, t in paths)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    assert dealt(now) == 1 and dealt(before) == 2
