"""Operators that read or write files: each writes sample rows to the shared folder and reads them back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from sievemark.packages import PACKAGES
from sievemark.plans import check as C
from sievemark.plans import runner as RU
from sievemark.plans import split as SP
from sievemark.session import checkpoint_folder
from sievemark.sources import readers as RD
from sievemark.sources import sinks
from sievemark.streaming import dropfolder


def scratch(c) -> str:
    return f"{checkpoint_folder(c['part'].sparkSession)}/queries/{uuid.uuid4().hex}"


def conversion_lines(c):
    """Pipe-separated conversion records, one per document, some cut short."""
    d = c["documents"]
    item = F.concat(F.lit("DOC-"), (F.col("doc_id") % 50).cast("string"))
    rev = (F.col("n_chars") % 3).cast("string")
    full = F.concat_ws("|", item, rev, F.concat(F.lit("DS "), item), F.when(F.col("doc_id") % 4 == 0, "PDF").otherwise("ACADDWG"), F.concat(item, F.lit(" "), rev, F.lit(".pdf")), F.concat(F.lit("new"), F.col("doc_id").cast("string")), F.lit("TRUE"), F.lit("model"))
    short = F.concat_ws("|", item, rev)
    return d.select("doc_id", F.when(F.col("doc_id") % 17 == 0, short).otherwise(full).alias("value"))


CONVERSION_SQL = """(select doc_id, 'DOC-'||(doc_id%50) as "itemID", cast(n_chars%3 as varchar) as "revID", case when doc_id%17<>0 then 'DS DOC-'||(doc_id%50) end as ds_name,
  case when doc_id%17<>0 then case when doc_id%4=0 then 'PDF' else 'ACADDWG' end end as ds_type, case when doc_id%17<>0 then 'DOC-'||(doc_id%50)||'_'||(n_chars%3)||'.pdf' end as file_name,
  case when doc_id%17<>0 then 'new'||doc_id end as ds_name_new, case when doc_id%17<>0 then 'true' end as monochrome, case when doc_id%17<>0 then 'MODEL' end as layout from documents)"""


def services(c):
    """Service answers per item revision: datasets with files, an empty list, or errors."""
    asked = RD.conversion_records(conversion_lines(c)).select("itemID", "revID").distinct().filter("itemID not like '%9'")
    f = lambda name, puid: F.struct(name.alias("fileName"), puid.alias("filePUID"))
    s = lambda kind, *fs: F.struct(
        F.concat(F.lit("DS "), "itemID").alias("objectName"), F.lit(kind).alias("objectType"), F.col("itemID"), F.col("revID"), F.struct(F.array(*fs).alias("file")).alias("datasetFileList")
    )
    good = F.concat("itemID", F.lit("_"), "revID", F.lit(".pdf"))
    key = F.concat(F.lit("f"), "itemID", F.lit("-"), "revID")
    sets = F.array(s("PDF", f(F.lit("other.pdf"), F.lit("x")), f(good, key)), s("PDF", f(good, F.lit("second"))))
    failed, empty = F.col("itemID").like("%8"), F.col("itemID").like("%7")
    none = F.lit(None).cast("array<struct<objectName:string,objectType:string,itemID:string,revID:string,datasetFileList:struct<file:array<struct<fileName:string,filePUID:string>>>>>")
    return asked.select(
        "itemID",
        "revID",
        F.when(failed, "Bad Gateway").alias("reason"),
        F.struct(F.when(~failed & ~empty, sets).otherwise(none).alias("dataset")).alias("datasetList"),
        F.when(failed, F.array(F.struct(F.lit("a").alias("message")), F.struct(F.lit("b").alias("message")))).alias("errorList"),
    )


SERVICES_SQL = """(select distinct "itemID" as i, "revID" as v, case when "itemID" like '%8' then 'Bad Gateway' end as reason, "itemID" like '%7' as empty from """ + CONVERSION_SQL + """ where "itemID" not like '%9')"""


def _inputs(c):
    folder = scratch(c)
    c["part"].filter("p_partkey % 2 = 0").select("p_partkey", "p_name").write.option("header", True).csv(f"{folder}/a")
    c["part"].filter("p_partkey % 2 = 1").select("p_partkey", "p_name").write.option("header", True).csv(f"{folder}/b")
    read = RD.read_inputs(c["part"].sparkSession, {"a": f"{folder}/a", "b": f"{folder}/b"}, names=[1, "a"])
    return read["a"].unionByName(read["b"])


def _records(c):
    folder = scratch(c)
    rows = c["part"].select(F.col("p_partkey").alias("ItemId"), F.col("p_name").alias("NAME"), F.when(F.col("p_size") % 2 == 0, F.lit("")).otherwise(F.lit("x")).alias("Uom"))
    rows.write.option("header", True).csv(folder)
    return RD.read_records(c["part"].sparkSession, folder)


def _lines(c):
    folder = scratch(c)
    c["part"].select(F.concat_ws("|", "p_partkey", "p_name")).write.text(folder)
    out = RD.split_fields(RD.read_lines(c["part"].sparkSession, folder), "|")
    return out.select("value", F.get("fields", F.lit(1)).alias("second"))


def _target(c):
    spark, name = c["part"].sparkSession, f"target_{uuid.uuid4().hex[:12]}"
    folder = scratch(c)
    spark.sql(f"create table {name} (p_partkey bigint, p_name string) using parquet location '{folder}'")
    sinks.write_target(c["part"].select("p_partkey", "p_name"), name, "delete")
    sinks.write_target(c["part"].filter("p_partkey % 2 = 0").select("p_name", "p_partkey"), name, "append")
    out = spark.read.parquet(folder)
    spark.sql(f"drop table {name}")
    return out


def _target_dropped(c):
    """A table that is replaced, columns and all."""
    spark, name = c["part"].sparkSession, f"target_{uuid.uuid4().hex[:12]}"
    sinks.write_target(c["part"].select("p_partkey", "p_name"), name, "drop")
    sinks.write_target(c["part"].select("p_brand", "p_partkey", "p_size"), name, "drop")
    kept = scratch(c)  # the table goes, its rows stay to be looked at
    spark.table(name).write.parquet(kept)
    spark.sql(f"drop table {name}")
    return spark.read.parquet(kept)


def _reports(c):
    folder = scratch(c)
    RU.run_package(PACKAGES["bom"], c["stg_bom"], c, output=folder, share=True)
    return c["part"].sparkSession.read.json(f"{folder}/manifest").select("check_id", "rows")


REPORTED = ("A01", "A02", "A03", "A08", "A09", "A15", "A57")


def _report(check_id, fmt):
    """The rows of one report of a run, read back from the folder that the manifest names."""

    def run(c):
        folder, spark, p = scratch(c), c["part"].sparkSession, PACKAGES["item"]
        RU.run_package(p, c["stg_item"], c, output=folder, output_format=fmt, skip=[k.id for k in p.checks if k.id not in REPORTED])
        (entry,) = spark.read.json(f"{folder}/manifest").filter(F.col("check_id") == check_id).collect()
        reader = spark.read.options(**sinks.CSV).schema(p.check(check_id).frame(p.context(c["stg_item"], c)).schema) if fmt == "csv" else spark.read
        rows = reader.format(fmt).load(f"{folder}/{entry['report']}")
        if not entry["report"].endswith(f" - Rows {entry['rows']}") or [x for x in rows.columns if fmt != "csv" and x != x.upper()]:
            raise ValueError(f"wrong name or heading: {entry['report']}")
        return rows

    return run


def _input_file(c):
    folder = scratch(c)
    ctx = PACKAGES["item"].context(c["stg_item"], c)
    sinks.write_input_lines(RU.input_lines(PACKAGES["item"].check("A59").frame(ctx)), folder)
    return c["part"].sparkSession.read.option("lineSep", "\r\n").text(folder).filter("value <> 'INPUT'")


def _log(c):
    folder, spark = scratch(c), c["part"].sparkSession
    run = RU.run_package(PACKAGES["name_desc"], c["stg_namedesc"], c, table_name="names", share=True, now=dt.datetime(2024, 5, 6))
    sinks.append_log(run.log_frame(spark), folder)
    return spark.read.parquet(folder).select("seq", "run_date", "table_name", "vl_mode", "sql_package", "sql_name", "result")


def _finished(c):
    spark = c["part"].sparkSession
    run = RU.run_package(PACKAGES["status"], c["stg_status"].drop("rdd_id"), c, table_name="requests", share=True, now=dt.datetime(2024, 5, 6))
    done = RU.finished_checks(C.checks_frame(spark, [PACKAGES["status"]]), run.log_frame(spark), "requests", dt.datetime(2024, 1, 1))
    return done.select("check_id", "title")


def _chunks(c):
    folder = scratch(c)
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    sinks.write_chunks(SP.split_by_size(c["lineitem"].select(*order), 9000, order), folder, order=order)
    schema = ", ".join(f"{x} bigint" for x in order)
    read = c["part"].sparkSession.read.option("header", True).option("sep", "|").schema(f"{schema}, chunk bigint").csv(folder)
    return read.select(*order, "chunk")


def _export(c):
    folder = scratch(c)
    sinks.write_export(c["stg_owner"], folder)
    return c["part"].sparkSession.read.option("header", True).csv(folder)


def _pass_fail(c):
    folder = scratch(c)
    rows = c["orders"].select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "pass").otherwise("fail").alias("status"))
    sinks.write_pass_fail(rows, folder)
    return c["part"].sparkSession.read.json(folder).select("o_orderkey", "status")


def _drop_folder(c):
    """Events arrive as one file set per month, the newest rows partly repeated."""
    spark, folder = c["part"].sparkSession, scratch(c)
    cols = ["event_id", "user_id", "event_type", "status"]
    events = c["events"].select("event_id", "user_id", "event_type", F.concat(F.lit(" "), F.col("event_type")).alias("status"), F.pmod("event_id", F.lit(3)).alias("m"))
    schema = "event_id string, user_id string, event_type string, status string"
    for m in (0, 1, 2):
        events.filter(F.col("m").isin(m, (m + 2) % 3)).select(*cols).write.mode("append").option("header", True).csv(f"{folder}/in")
        dropfolder.load_folder(spark, f"{folder}/in", schema, f"{folder}/out", f"{folder}/state", header="true")
    return dropfolder.loaded(spark, f"{folder}/out")


def _newest(c):
    spark, folder = c["part"].sparkSession, scratch(c)
    c["part"].filter("p_partkey % 2 = 0").select("p_partkey", "p_name").coalesce(1).write.mode("append").option("header", True).csv(folder)
    import time

    time.sleep(1.1)
    c["part"].filter("p_partkey % 2 = 1").select("p_partkey", "p_name").coalesce(1).write.mode("append").option("header", True).csv(folder)
    return RD.newest_file(spark, folder)


from oracle.checks import SQL as CHECK_SQL  # noqa: E402

_manifest = " union all ".join(f"select '{k.id}' as check_id, (select count(*) from ({CHECK_SQL[k.id]})) as rows" for k in PACKAGES["bom"].checks)
_logged = " union all ".join(
    f"select {i}::bigint as seq, timestamp '2024-05-06' as run_date, 'NAMES' as table_name, 'REPORT' as vl_mode, 'NAME_DESC' as sql_package, '{k.name}' as sql_name, (select count(*) from ({CHECK_SQL[k.id]}))::double as result"
    for i, k in enumerate(PACKAGES["name_desc"].checks, start=1)
)

OPS = {
    "S01_named_inputs": (_inputs, "select p_partkey::varchar as p_partkey, p_name from part"),
    "S02_drop_folder": (_drop_folder, "select event_id::varchar as EVENT_ID, user_id::varchar as USER_ID, event_type as EVENT_TYPE, upper(substr(event_type,1,1))||lower(substr(event_type,2)) as STATUS from events"),
    "O04_newest_file": (_newest, "select p_partkey::varchar as p_partkey, p_name from part where p_partkey%2=1"),
    "S07_record_file": (_records, "select p_partkey::varchar as itemid, p_name as name, case when p_size%2=1 then 'x' end as uom from part"),
    "S08_text_lines": (_lines, "select p_partkey||'|'||p_name as value, p_name as second from part"),
    "S09_table_sink": (_target, "select p_partkey, p_name from part union all select p_partkey, p_name from part where p_partkey%2=0"),
    "S09_table_sink_drop": (_target_dropped, "select p_brand, p_partkey, p_size from part"),
    "S10_report_sink": (_reports, _manifest),
    **{f"S10_report_rows_{i}_{fmt}": (_report(i, fmt), CHECK_SQL[i]) for i, fmt in (("A01", "parquet"), ("A03", "parquet"), ("A08", "csv"), ("A09", "orc"), ("A57", "csv"))},
    "S11_input_file": (_input_file, f"select inp as value from ({CHECK_SQL['A59']}) where inp is not null"),
    "S12_run_log": (_log, _logged),
    # Without the column rdd_id five checks fail, all others are finished.
    "S13_finished_checks": (_finished, " union all ".join(f"select '{k.id}' as check_id, '{k.title}' as title" for k in PACKAGES["status"].checks if k.id not in ("G03", "G05", "G07", "G08", "G18"))),
    "S14_split_sink": (_chunks, "select l_orderkey, l_linenumber, l_partkey, l_suppkey, (row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey)-1)//9000 as chunk from lineitem"),
    "S15_export": (_export, "select * from {stg_owner}"),
    "S16_pass_fail": (_pass_fail, "select o_orderkey, case when o_orderstatus='F' then 'pass' else 'fail' end as status from orders"),
}
