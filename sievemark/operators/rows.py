"""Ad-hoc row operators: projection, value counts, update, ordering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.values import number


def select_rows(df: DataFrame, cols: Sequence[str], where: str | None = None) -> DataFrame:
    return (df if where is None else df.filter(F.expr(where))).selectExpr(*cols)


def distinct_values(df: DataFrame, cols: Sequence[str], where: str | None = None, count_name="count") -> DataFrame:
    """Distinct combinations of columns and how often each occurs."""
    df = df if where is None else df.filter(F.expr(where))
    return df.groupBy(*cols).agg(F.count("*").alias(count_name))


def update_rows(df: DataFrame, assignments: Mapping[str, str], where: str | None = None) -> DataFrame:
    """Copy of the table with new values where the condition holds."""
    cond = F.lit(True) if where is None else F.coalesce(F.expr(where), F.lit(False))
    return df.withColumns({c: F.when(cond, F.expr(e)).otherwise(F.col(c)) for c, e in assignments.items()})


def affected_rows(df: DataFrame, where: str | None = None) -> DataFrame:
    cond = F.lit(True) if where is None else F.expr(where)
    return df.agg(F.count_if(cond).alias("affected"))


def _number_keys(name: str) -> list[Column]:
    """Keys that sort like the number in a column, fast to compare: a double, and the exact number only where it needs one.

    Numbers of the same double are those below it, it, and those above it.
    """
    exact = number(name)
    near = exact.cast("double")
    back = near.try_cast("decimal(38,10)")
    side = F.when(exact > back, 1).when(exact < back, -1).otherwise(0)
    return [near, side, F.when(back.isNull() | (exact != back), exact)]


def ordered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Sort by names: ``-name`` descending, ``#name`` by number; NULLs last ascending, first descending.

    Keys are columns while rows are sorted: an expression would be worked out again for every comparison.
    """
    if not order:
        return df
    keys: dict[str, Column] = {}
    by: list[Column] = []
    for i, spec in enumerate(order):
        name = spec.lstrip("-").lstrip("#")
        made = _number_keys(name) if "#" in spec[:2] else []
        names = [f"_key{i}_{j}" for j in range(len(made))]
        keys |= zip(names, made)
        by += [F.col(n).desc_nulls_first() if spec.startswith("-") else F.col(n).asc_nulls_last() for n in names or [name]]
    return df.select("*", *[c.alias(n) for n, c in keys.items()]).orderBy(*by).drop(*keys)
