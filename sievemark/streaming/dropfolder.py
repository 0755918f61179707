"""Incremental load of a drop folder with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievemark.plans.staging import clean

ROW_KEY = "row_key"
BATCH = "batch"
# The index: a folder that readers of the target pass over, partitioned by the first digits of the key.
KEYS, PREFIX, PREFIX_DIGITS = "_keys", "prefix", 2
_MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def row_key(df: DataFrame) -> DataFrame:
    """The frame with a digest of the whole row; equal rows have equal keys, NULL differs from text."""
    fields = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    return df.withColumn(ROW_KEY, F.sha2(fields, 256))


def _index(spark: SparkSession, target: str) -> DataFrame | None:
    """The keys of all rows of the target, by prefix and batch; made from the rows where there is none yet."""
    try:
        return spark.read.parquet(f"{target}/{KEYS}")
    except AnalysisException as e:
        if e.getCondition() not in _MISSING:
            raise
    try:
        rows = spark.read.parquet(target)
    except AnalysisException as e:  # the first batch finds no table
        if e.getCondition() not in _MISSING:
            raise
        return None
    _write_keys(rows.select(ROW_KEY, BATCH), target)
    return spark.read.parquet(f"{target}/{KEYS}")


def _write_keys(keys: DataFrame, target: str) -> None:
    """Adds keys to the index; the keys of a batch that is repeated replace those it wrote before."""
    rows = keys.withColumn(PREFIX, F.substring(ROW_KEY, 1, PREFIX_DIGITS)).repartition(PREFIX)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PREFIX, BATCH).parquet(f"{target}/{KEYS}")


def earlier_keys(fresh: DataFrame, batch_id: int, target: str) -> DataFrame | None:
    """Keys of earlier batches that ``fresh`` rows may have: only the partitions of their prefixes are read."""
    index = _index(fresh.sparkSession, target)
    if index is None:
        return None
    prefixes = [r[0] for r in fresh.select(F.substring(ROW_KEY, 1, PREFIX_DIGITS)).distinct().collect()]  # at most 16 ** PREFIX_DIGITS
    return index.filter(F.col(PREFIX).isin(prefixes) & (F.col(BATCH) < batch_id)).select(ROW_KEY)


def append_new_rows(df: DataFrame, batch_id: int, target: str) -> None:
    """Add rows that no earlier batch has; a repeated batch replaces what it wrote before.

    The keys of the target's rows are kept beside it, partitioned by their first digits, so a batch reads keys of
    its own prefixes, not the target. Keys are added after the rows: a batch that was stopped in between is
    repeated, finds no keys of its own, and leaves the same rows and keys.
    """
    spark = df.sparkSession
    fresh = row_key(df).dropDuplicates([ROW_KEY]).persist(StorageLevel.DISK_ONLY)
    try:
        earlier = earlier_keys(fresh, batch_id, target)
        rows = fresh if earlier is None else fresh.join(earlier, ROW_KEY, "left_anti")
        rows.write.mode("overwrite").parquet(f"{target}/{BATCH}={batch_id}")
    finally:
        fresh.unpersist()
    written = spark.read.schema(f"{ROW_KEY} string").parquet(f"{target}/{BATCH}={batch_id}")
    _write_keys(written.withColumn(BATCH, F.lit(batch_id).cast("int")), target)


def load_folder(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    target: str,
    checkpoint: str,
    fmt: str = "csv",
    files_per_batch: int = 1000,
    prepare: Callable[[DataFrame], DataFrame] = clean,
    **options: str,
):
    """Load all files that arrived since the last run, cleaned and de-duplicated against the target."""
    stream = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch).options(**options).load(folder)
    write = stream.writeStream.foreachBatch(lambda df, batch_id: append_new_rows(prepare(df), batch_id, target))
    query = write.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def loaded(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop(ROW_KEY, BATCH)
