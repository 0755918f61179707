"""Matching conversion records with the dataset files that a document service lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.operators.ordered import ordered_groups
from sievemark.sources.readers import CONVERSION_FIELDS

NO_FILE = "No dataset file found"
LOG_FIELD_CHARS = 200

SERVICE_SCHEMA = (
    "itemID string, revID string, reason string, "
    "datasetList struct<dataset:array<struct<objectName:string,objectType:string,itemID:string,revID:string,"
    "datasetFileList:struct<file:array<struct<fileName:string,filePUID:string>>>>>>, "
    "errorList array<struct<message:string>>"
)


def match_datasets(records: DataFrame, services: DataFrame) -> DataFrame:
    """Each record with the key of its file, or the reason why there is none.

    A dataset fits if name, type, item and revision are equal; the first file of the record's name in
    the first such dataset counts. The nested lists stay on their row, nothing is exploded.
    """
    answer = services.select(
        F.col("itemID").alias("_item"), F.col("revID").alias("_rev"), "reason", F.col("datasetList.dataset").alias("_sets"), F.col("errorList").alias("_errors")
    )
    rows = records.join(answer, F.col("itemID").eqNullSafe(F.col("_item")) & F.col("revID").eqNullSafe(F.col("_rev")), "left")

    def fits(d: Column) -> Column:
        return (
            (d["objectName"] == F.col("ds_name"))
            & (d["objectType"] == F.col("ds_type"))
            & (d["itemID"] == F.col("itemID"))
            & (d["revID"] == F.col("revID"))
        )

    files = F.flatten(F.transform(F.filter("_sets", fits), lambda d: F.coalesce(d["datasetFileList"]["file"], F.array())))
    hits = F.filter(files, lambda f: f["fileName"] == F.col("file_name"))
    puid = F.get(hits, F.lit(0))["filePUID"]
    errors = F.array_join(F.transform("_errors", lambda e: e["message"]), ";")
    message = F.when(F.size("_sets") > 0, F.lit(NO_FILE)).otherwise(F.coalesce(errors, F.col("reason")))
    return rows.withColumn("ds_puid", puid).select(*CONVERSION_FIELDS, "ds_puid", F.when(F.col("ds_puid").isNull(), message).alias("message"))


def grouped_records(records: DataFrame, place: str, part_rows: int = 100_000) -> DataFrame:
    """Records by item revision, then data set name, records of one name as they came.

    Adds the number of the group, the position in it and, for a group of more than ``part_rows`` records, its part:
    the service is asked once per group, and the records of a part are sent one after the other.
    """
    return ordered_groups(records, ["itemID", "revID"], ["ds_name", place], part_rows)


def conversion_requests(matched: DataFrame) -> DataFrame:
    """Request payload of every matched record."""
    payload = F.struct(
        F.col("itemID").alias("itemId"),
        F.col("revID").alias("itemRevId"),
        F.col("ds_name_new").alias("datasetName"),
        F.array("ds_puid").alias("datasetFilePuids"),
        F.lit("false").alias("scaleLineweights"),
        F.col("monochrome").alias("forceMonochrome"),
        F.lit("false").alias("zoomExtents"),
        F.col("layout"),
    )
    return matched.filter(F.col("ds_puid").isNotNull()).select("itemID", "revID", "ds_puid", F.to_json(payload, {"ignoreNullFields": "false"}).alias("payload"))


def log_line(fields: list[str], level: Column, message: Column) -> Column:
    """Non-blank fields of at most 200 characters and ``Level: message``, joined by bars."""
    last = F.concat(level, F.lit(": "), F.coalesce(message, F.lit("None")))
    parts = F.array(*[F.col(f) for f in fields], last)
    kept = F.filter(parts, lambda x: x.isNotNull() & (x != "") & (F.length(x) <= LOG_FIELD_CHARS))
    return F.array_join(kept, "|")


def conversion_log(matched: DataFrame) -> DataFrame:
    """One log line and status per record."""
    failed = F.col("ds_puid").isNull()
    status = F.when(failed, "fail").otherwise("pass")
    level = F.when(failed, F.lit("Error")).otherwise(F.lit("Info"))
    text = F.when(failed, F.col("message")).otherwise(F.lit("Created"))
    return matched.select(*CONVERSION_FIELDS, status.alias("status"), log_line([*CONVERSION_FIELDS, "ds_puid"], level, text).alias("log"))
