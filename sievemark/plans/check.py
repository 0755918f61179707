"""Checks and packages of checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.functions import text as T
from sievemark.operators import parts as R
from sievemark.operators.rows import ordered
from sievemark.operators.sets import id_union

INFO, ISSUE, BACKUP = "INFO", "ISSUE", "Backup"
SHARED_IDS = "shared_ids"


@dataclass
class Context:
    """What a check may read: the staged table, the reference tables and parameters."""

    chk: DataFrame
    refs: Mapping[str, DataFrame] = field(default_factory=dict)
    params: Mapping[str, Any] = field(default_factory=dict)
    id_columns: Sequence[str] = ()

    def base(self, over: str) -> DataFrame:
        if over == R.STAGED_IDS:
            return self.ids
        return self.chk

    @property
    def ids(self) -> DataFrame:
        """Set of the capitalised ids of the id columns; worked out once per run where paths are shared."""
        if SHARED_IDS in self.refs:
            return self.refs[SHARED_IDS]
        return id_union(self.chk, [T.id_key(c) for c in self.id_columns])


@dataclass(frozen=True)
class Check:
    """A named check; ``make`` returns a shareable part or a DataFrame of its own."""

    id: str
    severity: str
    title: str
    make: Callable[[Context], R.Part | DataFrame]
    order: Sequence[str] = ()
    summary: bool = False

    @property
    def name(self) -> str:
        return self.title if self.severity == BACKUP else f"{self.severity} - {self.title}"

    def frame(self, ctx: Context, sort: bool = False) -> DataFrame:
        made = self.make(ctx)
        df = made if isinstance(made, DataFrame) else made.frame(ctx.base(made.over))
        return ordered(df, self.order) if sort else df


@dataclass(frozen=True)
class Package:
    name: str
    expects: Sequence[str]
    checks: Sequence[Check]
    id_columns: Sequence[str] = ()

    def check(self, check_id: str) -> Check:
        return next(c for c in self.checks if c.id == check_id)

    def context(self, chk: DataFrame, refs: Mapping[str, DataFrame] | None = None, **params) -> Context:
        return Context(chk, refs or {}, params, self.id_columns)

    def missing_columns(self, chk: DataFrame) -> list[str]:
        """Columns of the naming convention that the staged table lacks."""
        have = {c.upper() for c in chk.columns}
        return [c for c in self.expects if c.upper() not in have]


def sql_check(check_id: str, severity: str, title: str, query: str, summary=False, **args) -> Check:
    """User-supplied check as Spark SQL over ``{chk}`` and ``{reference_table}`` names, with ``:name`` parameters."""

    def make(ctx: Context) -> DataFrame:
        spark = SparkSession.active()
        used = {n: ctx.refs[n] for n in ctx.refs if "{" + n + "}" in query}
        return spark.sql(query, args={**args, **ctx.params} or None, chk=ctx.chk, **used)

    return Check(check_id, severity, title, make, summary=summary)


def checks_frame(spark: SparkSession, packages: Sequence[Package]) -> DataFrame:
    """All checks of all packages as a table, packages numbered from 1 in name order."""
    rows = [
        (i, p.name, c.id, c.severity, c.title, c.summary)
        for i, p in enumerate(sorted(packages, key=lambda p: p.name), start=1)
        for c in p.checks
    ]
    return spark.createDataFrame(rows, "package_no int, package string, check_id string, severity string, title string, summary boolean")


def count_of(df: DataFrame, name="cnt") -> DataFrame:
    return df.agg(F.count("*").alias(name))
