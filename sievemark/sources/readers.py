"""Sources: named inputs, record files, text lines, clones and drop folders."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.functions import text as T

# Names under which staging tables are cloned; the tables behind them are configuration.
CLONE_SOURCES = ("caps", "jde", "syteline", "bomload", "docload", "docrel")
LOAD_ID = "loadidentifier"

CONVERSION_FIELDS = ("itemID", "revID", "ds_name", "ds_type", "file_name", "ds_name_new", "monochrome", "layout")
# Characters of a file name that the file service replaces by an underscore.
FILE_NAME_CHARS = " ,()[]{}\\/@#$%^&*"


def all_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def read_inputs(spark: SparkSession, paths: Mapping[str, str], fmt: str = "csv", names: Sequence[str] | str = "all", multi_line: bool = False) -> dict[str, DataFrame]:
    """Named inputs, all cells as text; ``names`` selects some by name or by position from 0.

    ``multi_line`` is for cells with line ends in them; such a csv file cannot be split between tasks.
    """
    keys = list(paths)
    if names != "all":
        wanted = [names] if isinstance(names, str) else list(names)
        keys = [keys[n] if isinstance(n, int) else n for n in wanted]
    out = {}
    for key in keys:
        reader = spark.read.format(fmt)
        if fmt == "csv":
            reader = reader.option("header", "true").option("multiLine", str(multi_line).lower()).option("escape", '"')
        elif fmt == "json":
            reader = reader.option("primitivesAsString", "true")
        out[key] = all_text(reader.load(paths[key]))
    return out


def clone_source(spark: SparkSession, tables: Mapping[str, str], source: str, load_id: str) -> DataFrame:
    """Rows of one load of a staging source."""
    if source not in CLONE_SOURCES:
        raise ValueError(f"unknown source {source!r}, expected one of {', '.join(CLONE_SOURCES)}")
    return load_rows(spark.table(tables[source]), load_id)


def load_rows(df: DataFrame, load_id: str) -> DataFrame:
    return df.filter(F.col(LOAD_ID) == load_id)


def read_records(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Record file with heading: names in small letters, all text, blank cells NULL; ``multi_line`` as above."""
    raw = spark.read.option("header", "true").option("escape", '"').option("multiLine", str(multi_line).lower()).option("encoding", "UTF-8").csv(path)
    return records(raw)


def records(raw: DataFrame) -> DataFrame:
    names = [c.lstrip("﻿").lower() for c in raw.columns]
    return raw.toDF(*names).select(*[T.null_if_blank(F.col(f"`{c}`").cast("string")).alias(c) for c in names])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their place in the input: file, block of the file, then order within the block."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line_order")]
    return spark.read.text(path).select("value", *place)


def split_fields(lines: DataFrame, sep: str) -> DataFrame:
    """Fields of each line; the separator is literal text."""
    return lines.withColumn("fields", F.split("value", "\\Q" + sep + "\\E"))


def conversion_records(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Pipe-separated records of eight fields; missing fields are NULL, in-place rules per field.

    The first missing field ends a record, so the fields after it are NULL as well. ``keep`` names columns of the
    lines that stay, such as their place.
    """
    parts = F.split("value", r"\|")
    raw = [F.get(parts, F.lit(i)) for i in range(len(CONVERSION_FIELDS))]
    cols = dict(zip(CONVERSION_FIELDS, raw))
    cols["file_name"] = service_file_name(cols["file_name"])
    cols["monochrome"] = F.lower(cols["monochrome"])
    cols["layout"] = F.upper(cols["layout"])
    return lines.select(*keep, *[c.alias(n) for n, c in cols.items()])


def service_file_name(c):
    return F.translate(c, FILE_NAME_CHARS, "_" * len(FILE_NAME_CHARS))


def newest_file(spark: SparkSession, folder: str, fmt: str = "csv", schema=None) -> DataFrame:
    """Rows of the most recently changed file of a folder; ties go to the larger path.

    Names and times are listed without reading a file; only the newest one is then read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "modificationTime")
    newest = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("newest")).first()["newest"]
    reader = spark.read.format(fmt).option("header", "true") if fmt == "csv" else spark.read.format(fmt)
    # Paths are read as patterns, so characters with a meaning in patterns are escaped.
    path = folder if newest is None else re.sub(r"([\[\]{}*?\\])", r"\\\1", newest)
    return (reader.schema(schema) if schema is not None else reader).load(path)
