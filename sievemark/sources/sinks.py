"""Table, report, log and file sinks."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 20_000
HEADING = "INPUT"
# Blanks at the ends of a cell are part of it.
CSV = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_target(df: DataFrame, name: str, if_exists: str = "drop", fmt: str = "parquet") -> None:
    """Write a table: ``drop`` replaces it, ``append`` adds, ``delete`` empties it but keeps its schema."""
    spark = df.sparkSession
    if if_exists == "drop":
        df.write.mode("overwrite").format(fmt).saveAsTable(name)
    elif if_exists == "append":
        _as_table(df, spark, name).write.mode("append").insertInto(name)
    elif if_exists == "delete":
        _as_table(df, spark, name).write.insertInto(name, overwrite=True)
    else:
        raise ValueError(f"if_exists must be drop, append or delete, not {if_exists!r}")


def _as_table(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Columns by name, in the order and types of an existing table."""
    have = {c.lower(): c for c in df.columns}
    fields = spark.table(name).schema.fields
    return df.select(*[(F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def write_jdbc(df: DataFrame, url: str, table: str, if_exists: str = "drop", **options: str) -> None:
    """Database sink in batches of 20,000 rows; ``delete`` truncates instead of dropping."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", BATCH_ROWS).options(**options)
    if if_exists == "delete":
        writer = writer.option("truncate", "true")
    writer.mode("append" if if_exists == "append" else "overwrite").save()


def report_name(check_id: str, title: str, rows: int) -> str:
    """Folder name of a report: id, title and number of rows, without characters that paths give a meaning."""
    return re.sub(r"[^\w .,()+-]+", "_", f"{check_id} {title}").strip() + f" - Rows {rows}"


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Result rows of one check, header in capitals; a single column as ``text`` becomes an input file."""
    out = df.select(*[(F.col(f"`{c}`").cast("string") if t == "void" else F.col(f"`{c}`")).alias(c.upper()) for c, t in df.dtypes])
    if fmt == "text":
        write_input_lines(out, path)
        return
    writer = out.write.mode("overwrite").format(fmt)
    (writer.options(**CSV) if fmt == "csv" else writer).save(path)


def stage_packed(packed: DataFrame, path: str, check_ids: Sequence[str]) -> dict[str, int]:
    """Write the packed rows of many checks in one job, apart by check; returns how many rows each has."""
    seen = Observation()
    counts = [F.count_if(F.col("check_id") == i).alias(i) for i in check_ids]
    packed.observe(seen, *counts).write.mode("overwrite").partitionBy("check_id").parquet(path)
    return {i: seen.get[i] for i in check_ids}


def stage_report(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Write one report and count its rows in the same job."""
    seen = Observation()
    write_report(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, fmt)
    return seen.get["rows"]


def _files(spark: SparkSession, path: str):
    """File system of a path, and the path as it knows it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, source = _files(spark, old)
    _, target = _files(spark, new)
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"{old} could not be renamed to {new}")


def remove(spark: SparkSession, path: str) -> None:
    """Remove what a path or pattern names; nothing if there is nothing."""
    fs, at = _files(spark, path)
    for found in fs.globStatus(at) or []:
        fs.delete(found.getPath(), True)


def write_manifest(spark: SparkSession, folder: str, entries: Sequence[tuple]) -> None:
    """One line per check of the package: id, name, rows, folder of its report and definition."""
    frame = spark.createDataFrame(list(entries), "check_id string, name string, rows bigint, report string, definition string")
    frame.coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")


def write_input_lines(df: DataFrame, folder: str, fallback_format: str = "csv") -> str:
    """Utility input files: one text column, heading and CRLF line ends; wider results become a report."""
    if len(df.columns) != 1:
        df.toDF(*[c.upper() for c in df.columns]).write.mode("overwrite").option("header", "true").format(fallback_format).save(folder)
        return fallback_format
    text = df.toDF("value").select(F.col("value").cast("string"))
    text.mapInArrow(_with_heading, "value string").write.mode("overwrite").option("lineSep", "\r\n").text(folder)
    return "text"


def _with_heading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The heading line before the lines of each file."""
    first = True
    for batch in batches:
        if first:
            yield pa.RecordBatch.from_pydict({"value": [HEADING]})
            first = False
        yield batch


def append_log(log: DataFrame, path: str) -> None:
    log.coalesce(1).write.mode("append").parquet(path)


def write_chunks(df: DataFrame, folder: str, chunk: str = "chunk", header: bool = True, sep: str = "|", order: Sequence[str] = (), files_per_chunk: int = 1) -> None:
    """One folder per chunk; each of its files repeats the heading, and no file mixes chunks.

    A chunk is dealt to ``files_per_chunk`` tasks by a digest of the row; with ``order``, each file is sorted.
    """
    piece = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files_per_chunk))
    dealt = df.withColumn("_piece", piece).repartition(chunk, "_piece").sortWithinPartitions(chunk, "_piece", *order).drop("_piece")
    dealt.write.mode("overwrite").partitionBy(chunk).option("header", str(header).lower()).option("sep", sep).csv(folder)


def write_export(df: DataFrame, folder: str) -> None:
    """The combined inputs as csv with heading."""
    df.write.mode("overwrite").option("header", "true").csv(folder)


def write_pass_fail(df: DataFrame, folder: str, status: str = "status") -> None:
    """Results split by status in one pass."""
    df.write.mode("overwrite").partitionBy(status).json(folder)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Table bucketed and sorted by its join key, so that joins on the key need no shuffle of it."""
    # Dealt by the key first, so that each bucket is one file.
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
