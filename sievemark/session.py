"""Session helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
Result = TypeVar("Result")


def local_session(name: str = "sievemark", cores: str | None = None, **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine; on a cluster, pass the cluster's own session."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_TEST_FOLDERS: dict[str, str] = {}


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster; a temporary one only where none is set (tests)."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _TEST_FOLDERS.setdefault(context.applicationId, tempfile.mkdtemp(prefix="sievemark-"))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries made inside go when each query ends, not when the driver collects its garbage."""
    before = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(FILE_CLEANUP) if before is None else spark.conf.set(FILE_CLEANUP, before)


def finished(spark: SparkSession, run: Callable[[], Result]) -> Result:
    """What ``run`` returns; stages still at work then, which nobody waits for (a join found empty), are ended."""
    context, tag = spark.sparkContext, f"run-{uuid.uuid4().hex}"
    context.addJobTag(tag)
    try:
        return run()
    finally:
        context.removeJobTag(tag)
        context.cancelJobsWithTag(tag)


def plan_nodes(df: DataFrame) -> list[str]:
    """First word of each line of the optimised plan, mostly the names of its operators."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [m.group(1) if (m := re.match(r"[\s:+|-]*(\w+)", line)) else line for line in plan.splitlines() if line.strip()]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, so that later passes see the same rows in the same places."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_folder(df.sparkSession))
    return df.checkpoint(eager=True)
