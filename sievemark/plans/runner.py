"""Package runs: counts, result files, run log and resume."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievemark.operators import parts as R
from sievemark.operators.rows import ordered
from sievemark.plans.check import Check, Context, Package
from sievemark.plans.fused import fused_counts, fused_results, package_summary, packed_results, report_of, split_parts
from sievemark.plans.shared import drop_shared, share_paths
from sievemark.session import finished, shuffles_removed
from sievemark.sources import sinks

LOG_SCHEMA = (
    "seq bigint, run_date timestamp, table_name string, vl_mode string, sql_package string, "
    "sql_name string, result double, sql_definition string"
)


@dataclass
class CheckResult:
    check: Check
    rows: int | None
    error: str | None = None
    definition: str = ""

    @property
    def failed(self) -> bool:
        return self.rows is None


@dataclass
class PackageRun:
    package: str
    table_name: str
    mode: str
    started: dt.datetime
    results: list[CheckResult] = field(default_factory=list)

    def rows(self) -> dict[str, int | None]:
        return {r.check.id: r.rows for r in self.results}

    def log_frame(self, spark: SparkSession) -> DataFrame:
        """Run log: names in capitals except the check title, a failed check has no result."""
        rows = [
            (
                i,
                self.started,
                self.table_name.upper(),
                self.mode.upper(),
                self.package.upper(),
                r.check.name,
                None if r.failed else float(r.rows),
                r.definition or (r.error or ""),
            )
            for i, r in enumerate(self.results, start=1)
        ]
        return spark.createDataFrame(rows, LOG_SCHEMA)


def _definition(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _count(df: DataFrame) -> int:
    return df.count()


def run_package(
    package: Package,
    chk: DataFrame,
    refs: Mapping[str, DataFrame] | None = None,
    *,
    table_name: str = "staged",
    mode: str = "report",
    output: str | None = None,
    output_format: str = "parquet",
    sort: bool = False,
    skip: Sequence[str] = (),
    share: bool = False,
    parallel: int = 1,
    now: dt.datetime | None = None,
    **params,
) -> PackageRun:
    """Run every check; a failing check is recorded and the run goes on.

    Shareable parts run fused, the other checks as jobs of their own, ``parallel`` at a time: each check has its shuffle
    files on disk and its broadcasts in the driver while it runs, no longer. With ``output``
    every check that has rows gets a report below that folder, named by its id, title and number of rows, with
    its own columns in ``output_format``; a check without rows gets none. The rows of the fused parts are
    written and counted in one job, then each part's rows are read back alone. A manifest names all reports.
    ``share`` cuts the master paths to the staged ids once and stores them for all checks of the run, and with them
    the derived tables that several checks read.
    """
    whole = package.context(chk, refs, **params)
    ctx, tables = share_paths(whole, [c for c in package.checks if c.id not in set(skip)]) if share else (whole, [])
    try:
        with shuffles_removed(chk.sparkSession):
            return _run(ctx, package, chk, table_name, mode, output, output_format, sort, skip, parallel, now)
    finally:
        drop_shared(whole, tables)


def _run(ctx, package, chk, table_name, mode, output, output_format, sort, skip, parallel, now) -> PackageRun:
    checks = [c for c in package.checks if c.id not in set(skip)]
    run = PackageRun(package.name, table_name, mode, now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    parts, frames, errors = split_parts(ctx, checks)
    by_id = {c.id: c for c in checks}
    made = {i: (p, p.frame(ctx.base(over))) for over, members in parts.items() for i, p in members}
    spark = chk.sparkSession
    reports = _Reports(spark, output, output_format, by_id) if output is not None else None
    done: dict[str, CheckResult] = {}
    if reports is None:
        counts = _part_counts(ctx, parts)
    else:
        counts = reports.stage_parts(ctx, parts)
        if counts is None:  # each part as a check of its own
            frames, made = {**frames, **{i: f for i, (_, f) in made.items()}}, {}

    def one(check_id: str, df: DataFrame) -> CheckResult:
        check = by_id[check_id]
        try:
            df = check.frame(ctx, sort=True) if sort else df
            rows = finished(spark, lambda: _count(df) if reports is None else reports.write_frame(check_id, df))
            return CheckResult(check, rows, None, _definition(df))
        except Exception as e:  # noqa: BLE001 - recorded as a failed check
            return CheckResult(check, None, str(e).split("\n")[0])

    def fused(check_id: str) -> CheckResult:
        check, (part, df), rows = by_id[check_id], made[check_id], counts[check_id]
        try:
            if reports is not None and rows:
                reports.write_part(check_id, part, df.schema, rows, check.order if sort else ())
            return CheckResult(check, rows, None if rows is not None else "check failed", _definition(df) if rows is not None else "")
        except Exception as e:  # noqa: BLE001
            return CheckResult(check, None, str(e).split("\n")[0])

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        done |= zip(frames, pool.map(lambda kv: one(*kv), frames.items()))
        done |= zip(made, pool.map(fused, made))
    for check_id, text in errors.items():
        done[check_id] = CheckResult(by_id[check_id], None, text)
    run.results = [done[c.id] for c in checks]
    if reports is not None:
        reports.finish(run.results)
    return run


class _Reports:
    """The reports of one run: staged rows first, then a folder per check that has any."""

    def __init__(self, spark: SparkSession, output: str, fmt: str, checks: Mapping[str, Check]):
        self.spark, self.output, self.fmt, self.checks = spark, output, fmt, checks
        self.staging = f"{output}/_staging"
        self.paths: dict[str, str] = {}
        for check_id in checks:  # of an earlier run
            sinks.remove(spark, f"{output}/{check_id} *")

    def _path(self, check_id: str, rows: int) -> str:
        self.paths[check_id] = sinks.report_name(check_id, self.checks[check_id].name, rows)
        return f"{self.output}/{self.paths[check_id]}"

    def stage_parts(self, ctx: Context, parts: dict[str, list[tuple[str, R.Part]]]) -> dict[str, int] | None:
        """Rows of all parts, written in one job; None if that job fails."""
        ids = [i for members in parts.values() for i, _ in members]
        try:
            packed = packed_results(ctx, parts)
            return {} if packed is None else sinks.stage_packed(packed, f"{self.staging}/fused", ids)
        except Exception:  # noqa: BLE001 - the bad part is found when each runs alone
            return None

    def write_part(self, check_id: str, part: R.Part, schema: StructType, rows: int, order: Sequence[str]) -> None:
        # Each part has a folder of its own, so no write can touch the rows of another part.
        packed = self.spark.read.schema("cells array<string>").parquet(f"{self.staging}/fused/check_id={check_id}")
        report = report_of(packed, part, schema)
        sinks.write_report(ordered(report, order) if order else report, self._path(check_id, rows), self.fmt)

    def write_frame(self, check_id: str, df: DataFrame) -> int:
        staged = f"{self.staging}/{check_id}"
        rows = sinks.stage_report(df, staged, self.fmt)
        if rows:
            sinks.rename(self.spark, staged, self._path(check_id, rows))
        return rows

    def finish(self, results: Sequence[CheckResult]) -> None:
        sinks.remove(self.spark, self.staging)
        entries = [(r.check.id, r.check.name, r.rows, None if r.failed else self.paths.get(r.check.id), r.definition) for r in results]
        sinks.write_manifest(self.spark, self.output, entries)


def _measure_counts(ctx: Context, parts: dict[str, list[tuple[str, R.Part]]]) -> dict[str, int | None]:
    """Rows of the measures, one each, with all their values computed; a measure that fails has none."""
    measures = {o: [m for m in ms if isinstance(m[1], R.Measure)] for o, ms in parts.items()}
    out: dict[str, int | None] = {i: 1 for ms in measures.values() for i, _ in ms}
    try:
        fused = fused_results(ctx, measures) if out else None
        if fused is not None:
            fused.collect()
    except Exception:  # noqa: BLE001 - each alone, so that only bad ones fail
        for members in measures.values():
            for check_id, part in members:
                try:
                    out[check_id] = len(part.frame(ctx.base(part.over)).collect())
                except Exception:  # noqa: BLE001
                    out[check_id] = None
    return out


def _part_counts(ctx: Context, parts: dict[str, list[tuple[str, R.Part]]]) -> dict[str, int | None]:
    """Counts of all parts in one job; if that job fails, each part alone, so that only bad ones fail."""
    out: dict[str, int | None] = {i: 0 for ms in parts.values() for i, _ in ms}
    measured = _measure_counts(ctx, parts)
    try:
        fused = fused_counts(ctx, parts)
        if fused is not None:
            out |= {r["check_id"]: r["result"] for r in fused.collect()}
    except Exception:  # noqa: BLE001
        for members in parts.values():
            for check_id, part in members:
                try:
                    out[check_id] = part.frame(ctx.base(part.over)).count()
                except Exception:  # noqa: BLE001
                    out[check_id] = None
    return out | measured


def summary(package: Package, chk: DataFrame, refs: Mapping[str, DataFrame] | None = None, **params) -> DataFrame:
    """Rows of the checks shown in a summary, as ``(check_id, row)``; nothing is logged."""
    return package_summary(package.context(chk, refs, **params), package.checks)


def finished_checks(checks: DataFrame, log: DataFrame, table_name: str, since: dt.datetime) -> DataFrame:
    """Checks of a package that the run log already has for this table, failed ones not counted."""
    seen = log.filter((F.col("table_name") == table_name.upper()) & (F.col("run_date") >= F.lit(since)) & F.col("result").isNotNull())
    name = F.when(F.col("severity") == "Backup", F.col("title")).otherwise(F.concat_ws(" - ", "severity", "title"))
    done = seen.select(F.upper("sql_package").alias("_package"), F.col("sql_name").alias("_name")).distinct()
    return checks.join(done, (F.upper("package") == F.col("_package")) & (name == F.col("_name")), "left_semi")


def input_lines(df: DataFrame, column: str = "inp") -> DataFrame:
    """The request lines of a delta check, the single column of a load input file."""
    return df.select(F.col(column).alias("INPUT")).filter(F.col("INPUT").isNotNull())
