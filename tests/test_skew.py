import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sievemark.operators import sets as U
from sievemark.plans import extract as E
from sievemark.streaming import dropfolder as D


def outer(left, right):
    """Full outer join of (key, value) rows with NULL keys equal."""
    out = [(k, v, w) for k, v in left for j, w in right if j == k]
    out += [(k, v, None) for k, v in left if k not in {j for j, _ in right}]
    return sorted(out + [(j, None, w) for j, w in right if j not in {k for k, _ in left}], key=repr)


@pytest.mark.parametrize("piece", [7, 50, 10_000])
def test_full_outer_join_with_heavy_and_blank_keys(spark, piece):
    r = random.Random(piece)
    left = [(None, i) for i in range(60)] + [("hot", i) for i in range(80)] + [("left only", i) for i in range(90)] + [(f"k{r.randrange(50)}", i) for i in range(100)]
    right = [(None, -i) for i in range(30)] + [("hot", -i) for i in range(3)] + [("right only", 5)] * 70 + [(f"k{r.randrange(70)}", -i) for i in range(100)]
    a = spark.createDataFrame(left, "id string, v int").repartition(4)
    b = spark.createDataFrame(right, "id string, w int").repartition(3)
    got = U.outer_join_inputs([a, b], ["id"], piece)
    assert got.columns == ["id", "v", "w"] and sorted(map(tuple, got.collect()), key=repr) == outer(left, right)


def test_no_task_gets_all_rows_of_a_heavy_key(spark):
    a = spark.range(4000).select(F.lit(None).cast("string").alias("id"), F.col("id").alias("v")).repartition(8)
    b = spark.range(50).select(F.lit(None).cast("string").alias("id"), F.col("id").alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rows = U.outer_join_inputs([a, b], ["id"], 100)
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 200_000 and max(sizes) < 30_000


def test_a_batch_reads_only_the_keys_of_its_prefixes(spark, tmp_path):
    target = str(tmp_path / "target")
    batches = [[(str(i), "x") for i in range(low, low + 300)] for low in (0, 200, 0)]
    for b, rows in enumerate(batches):
        D.append_new_rows(spark.createDataFrame(rows, "a string, b string"), b, target)
    assert sorted(int(r.a) for r in D.loaded(spark, target).collect()) == list(range(500))
    rows_of = lambda: sorted(map(tuple, spark.read.parquet(target).collect()))
    keys_of = lambda: sorted(map(tuple, spark.read.parquet(f"{target}/_keys").select("row_key", "batch").collect()))
    rows_before, keys_before = rows_of(), keys_of()
    D.append_new_rows(spark.createDataFrame(batches[1], "a string, b string"), 1, target)
    assert rows_of() == rows_before
    keys = keys_of()
    assert keys == keys_before and len(keys) == 500
    one = D.row_key(spark.createDataFrame([("new", "x")], "a string, b string"))
    plan = D.earlier_keys(one, 9, target)._jdf.queryExecution().executedPlan().toString()
    prefix = one.first()["row_key"][:2]
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert prefix in filters and "batch" in filters and "ReadSchema: struct<row_key:string>" in plan


def test_a_target_without_an_index_gets_one(spark, tmp_path):
    target = str(tmp_path / "target")
    df = spark.createDataFrame([(str(i),) for i in range(20)], "a string")
    D.row_key(df).write.parquet(f"{target}/batch=0")
    D.append_new_rows(spark.createDataFrame([(str(i),) for i in range(15, 25)], "a string"), 1, target)
    assert D.loaded(spark, target).count() == 25 and spark.read.parquet(f"{target}/_keys").count() == 25


def breaking(spark, text, at=50):
    """Rows whose scan fails in the middle."""
    return spark.range(100).select(F.when(F.col("id") == at, F.raise_error(F.lit(text)).cast("bigint")).otherwise(F.col("id")).alias("id"))


def test_sites_that_fail_while_they_are_read(spark, tmp_path):
    asked = []

    def reader(site, *frames):
        left = list(frames)

        def read():
            asked.append(site)
            return left.pop(0) if len(left) > 1 else left[0]

        return read

    good = spark.range(100)
    readers = {
        "edm": reader("edm", good),
        "fra": reader("fra", breaking(spark, "XYZ-03254: connection lost"), good.filter("id < 5")),
        "houstby": reader("houstby", breaking(spark, "XYZ-16000: database open for read-only access")),
        "houprod": reader("houprod", spark.range(200, 210)),
        "nor": reader("nor", breaking(spark, "XYZ-00942: table does not exist")),
        "sha": reader("sha", breaking(spark, "XYZ-03254: connection lost")),
    }
    got = E.extract(spark, readers, retry=2, retry_on=[3254], folder=str(tmp_path / "sites"))
    state = {r.site: (r.status, r.attempts) for r in got.status.orderBy("position").collect()}
    assert list(state) == ["edm", "fra", "houstby", "houprod", "nor", "sha"]
    assert state["edm"] == ("ok", 1) and state["houprod"] == ("ok", 1) and state["houstby"] == ("replaced", 1) and state["nor"] == ("failed", 1)
    # Two retries for both sites together.
    assert state["sha"][0] == "failed" and state["fra"][1] + state["sha"][1] == 4
    want = set(range(100)) | set(range(200, 210))
    assert {r.id for r in got.df.collect()} == want and got.df.count() == len(want)
    assert "XYZ-00942" in {r.site: r.message for r in got.status.collect()}["nor"]
    with pytest.raises(E.ExtractFailed):
        E.extract(spark, readers, sites="nor", folder=str(tmp_path / "again"))
    with pytest.raises(AnalysisException):
        spark.read.parquet(str(tmp_path / "sites" / "nor"))


def test_left_join_deals_rows_without_a_key_to_all_tasks(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, F.col("id") % 7).cast("string").alias("k"))
    one = spark.createDataFrame([("0", "a"), ("1", "b"), ("1", "c"), (None, "n")], "x string, v string")
    two = spark.createDataFrame([("1", "d"), ("5", "e")], "y string, w string")
    want = df.join(one, F.col("k") == F.col("x"), "left").join(two, F.col("k") == F.col("y"), "left")
    old = {c: spark.conf.get(c, None) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for c, v in zip(old, ("-1", "false")):
            spark.conf.set(c, v)
        got = U.left_join_spread(df, "k", (one, "x"), (two, "y"))
        assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        blank = got.filter("k is null").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(blank) == 4 and max(r["count"] for r in blank) < 1000
        # Occurrences without notes, in the backup of a bill of material.
        assert "SortMergeJoin [occ_notes" in (text := bom_backup(spark)) and not any("_spot" not in j for j in text.splitlines() if "SortMergeJoin [occ_notes" in j)
    finally:
        for c, v in old.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


def bom_backup(spark):
    from conftest import SMALL
    from sievemark.packages import PACKAGES
    from sievemark.sources.catalog import sample_catalog

    refs, p = sample_catalog(spark, SMALL), PACKAGES["bom"]
    return p.check("D32").frame(p.context(refs["stg_bom"], refs))._jdf.queryExecution().executedPlan().toString()
