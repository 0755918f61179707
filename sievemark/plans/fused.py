"""Many checks of one package in one pass over the staged table.

Each row yields one entry per check it concerns; equal entries are combined before the only shuffle.
A package of sixty checks reads the staged table once instead of sixty times.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from sievemark.functions import values as V
from sievemark.operators import parts as R
from sievemark.operators.parts import named_columns
from sievemark.plans.check import Check, Context
from sievemark.session import finished, shuffles_removed

COUNTS_SCHEMA = "check_id string, result bigint"
RESULTS_SCHEMA = "check_id string, row string"


def _shown(df: DataFrame, rule: R.RowRule) -> list[tuple[str, Column]]:
    """Output columns of a rule with their names, ``*`` spelled out."""
    out: list[tuple[str, Column]] = []
    for c in rule.show:
        if isinstance(c, str):
            out += [(n, F.col(f"`{n}`")) for n in (df.columns if c == "*" else [c])]
        else:
            out.append((df.select(c).columns[0], c))
    return out


def _values(columns: Sequence[tuple[str, Column]]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), c.cast("string").alias("value")) for n, c in columns])


_NO_VALUES = "array<struct<name:string,value:string>>"


def _entry(check_id: str, values: Column | None, hit: Column | None) -> Column:
    values = F.lit(None).cast(_NO_VALUES) if values is None else values.cast(_NO_VALUES)
    entry = F.struct(F.lit(check_id).alias("check_id"), values.alias("values"))
    return entry if hit is None else F.when(hit, entry)


def _entries(df: DataFrame, entries: Sequence[Column]) -> DataFrame:
    return df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.check_id", "e.values")


def _tally_value(part: R.Tally) -> Column:
    return _values([(part.name, part.value)])


def counts_over(df: DataFrame, parts: Sequence[tuple[str, R.Part]]) -> DataFrame:
    """Number of result rows of each part: one scan and one shuffle of combined entries."""
    entries, by_group = [], []
    for check_id, part in parts:
        if isinstance(part, R.RowRule):
            values = _values(_shown(df, part)) if part.distinct else None
            entries.append(_entry(check_id, values, part.where))
            if part.distinct:
                by_group.append(check_id)
        elif isinstance(part, R.Tally):
            entries.append(_entry(check_id, _tally_value(part), part.where))
            by_group.append(check_id)
    groups = _entries(df, entries).groupBy("check_id", "values").agg(F.count("*").alias("n"))
    totals = groups.groupBy("check_id").agg(F.sum("n").alias("rows"), F.count("*").alias("groups"))
    result = F.when(F.col("check_id").isin(by_group), F.col("groups")).otherwise(F.col("rows"))
    return totals.select("check_id", result.cast("bigint").alias("result"))


def results_over(df: DataFrame, parts: Sequence[tuple[str, R.Part]]) -> list[DataFrame]:
    """Result rows of each part as JSON text: plain rules without a shuffle, the others with one."""
    plain, grouped, labels, counts = [], [], {}, {}
    for check_id, part in parts:
        if isinstance(part, R.RowRule):
            entry = _entry(check_id, _values(_shown(df, part)), part.where)
            (grouped if part.distinct else plain).append(entry)
        elif isinstance(part, R.Tally):
            grouped.append(_entry(check_id, _tally_value(part), part.where))
            counts[check_id] = part.count_name
            if part.null_label is not None:
                labels[check_id] = part.null_label
    frames = []
    as_json = lambda values: F.to_json(F.map_from_entries(values), {"ignoreNullFields": "false"}).alias("row")
    if plain:
        frames.append(_entries(df, plain).select("check_id", as_json(F.col("values"))))
    if grouped:
        rows = _entries(df, grouped).groupBy("check_id", "values").agg(F.count("*").alias("n"))
        values = F.col("values")
        if labels:
            label = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])[F.col("check_id")]
            named = F.transform(values, lambda v: F.struct(v["name"].alias("name"), F.coalesce(v["value"], label).alias("value")))
            values = F.when(label.isNotNull(), named).otherwise(values)
        if counts:
            name = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])[F.col("check_id")]
            total = F.array(F.struct(name.alias("name"), F.col("n").cast("string").alias("value")))
            values = F.when(name.isNotNull(), F.concat(values, total)).otherwise(values)
        frames.append(rows.select("check_id", as_json(values)))
    return frames


def measures_over(df: DataFrame, parts: Sequence[tuple[str, R.Measure]]) -> DataFrame:
    """All one-row aggregates in one aggregation, one JSON row per check."""
    aggs = [c.alias(f"{i}_{n}") for i, (_, p) in enumerate(parts) for n, c in p.values.items()]
    row = df.agg(*aggs)
    entries = [
        F.struct(F.lit(check_id).alias("check_id"), _values([(n, F.col(f"`{i}_{n}`")) for n in p.values]).alias("values"))
        for i, (check_id, p) in enumerate(parts)
    ]
    out = row.select(F.inline(F.array(*entries)))
    return out.select("check_id", F.to_json(F.map_from_entries("values"), {"ignoreNullFields": "false"}).alias("row"))


_NESTED = (Ty.ArrayType, Ty.MapType, Ty.StructType)


def pack(c: Column, kind: Ty.DataType) -> Column:
    """A cell as text that :func:`unpack` reads back without loss."""
    if isinstance(kind, Ty.BinaryType):
        return F.base64(c)
    if isinstance(kind, Ty.TimestampType):
        return F.unix_micros(c).cast("string")
    return F.to_json(c) if isinstance(kind, _NESTED) else c.cast("string")


def unpack(c: Column, kind: Ty.DataType) -> Column:
    if isinstance(kind, Ty.BinaryType):
        return F.unbase64(c)
    if isinstance(kind, Ty.TimestampType):
        return F.timestamp_micros(c.cast("bigint"))
    if isinstance(kind, _NESTED):
        return F.from_json(c, kind)
    return c.cast("string" if isinstance(kind, Ty.NullType) else kind)


def _packed_over(df: DataFrame, parts: Sequence[tuple[str, R.Part]]) -> list[DataFrame]:
    plain, grouped, counted, measures = [], [], [], []
    for check_id, part in parts:
        name = F.lit(check_id).alias("check_id")
        if isinstance(part, R.Measure):
            measures.append((check_id, part))
            continue
        if isinstance(part, R.Tally):
            columns, where = [part.value], part.where
            counted.append(check_id)
        else:
            columns, where = [c for _, c in _shown(df, part)], part.where
        kinds = [f.dataType for f in df.select(*columns).schema]
        entry = F.struct(name, F.array(*[pack(c, k) for c, k in zip(columns, kinds)]).alias("cells"))
        entry = entry if where is None else F.when(where, entry)
        (grouped if isinstance(part, R.Tally) or part.distinct else plain).append(entry)
    exploded = lambda entries: df.select(F.inline(F.array_compact(F.array(*entries))))
    frames = []
    if plain:
        frames.append(exploded(plain))
    if grouped:
        rows = exploded(grouped).groupBy("check_id", "cells").agg(F.count("*").alias("n"))
        total = F.concat("cells", F.array(F.col("n").cast("string")))
        frames.append(rows.select("check_id", F.when(F.col("check_id").isin(counted), total).otherwise(F.col("cells")).alias("cells")))
    if measures:
        values = [(i, n, c) for i, p in measures for n, c in p.values.items()]
        row = df.agg(*[c.alias(f"{i}_{n}") for i, n, c in values])
        kinds = dict(zip([(i, n) for i, n, _ in values], [f.dataType for f in row.schema]))
        entries = [
            F.struct(F.lit(i).alias("check_id"), F.array(*[pack(F.col(f"`{i}_{n}`"), kinds[i, n]) for n in p.values]).alias("cells"))
            for i, p in measures
        ]
        frames.append(row.select(F.inline(F.array(*entries))))
    return frames


def packed_results(ctx: Context, parts: dict[str, list[tuple[str, R.Part]]]) -> DataFrame | None:
    """Result rows of all parts as ``(check_id, cells)``, in one pass; :func:`report_of` gives each its own columns."""
    frames = [f for over, members in parts.items() for f in (_packed_over(ctx.base(over), members) if members else [])]
    return reduce(lambda a, b: a.unionByName(b), frames) if frames else None


def report_of(packed: DataFrame, part: R.Part, schema: Ty.StructType) -> DataFrame:
    """The packed rows of one part with the names and types of its own frame."""
    cells = [unpack(F.get("cells", F.lit(i)), f.dataType) for i, f in enumerate(schema)]
    if isinstance(part, R.Tally) and part.null_label is not None:
        cells[0] = V.null_label(cells[0], part.null_label)
    return packed.select(*[c.alias(f.name) for c, f in zip(cells, schema)])


def _resolves(base: DataFrame, members: Sequence[tuple[str, R.Part]]) -> str | None:
    """Error text if an expression of the parts does not fit the table, such as a missing column."""
    columns: list[Column] = []
    aggregates: list[Column] = []
    for _, part in members:
        if isinstance(part, R.Measure):
            aggregates += part.values.values()
        elif isinstance(part, R.Tally):
            columns += [part.value] if part.where is None else [part.value, part.where]
        else:
            columns += [part.where, *named_columns(part.show)]
    try:
        if columns:
            base.select(*columns).schema
        if aggregates:
            base.agg(*aggregates).schema
    except Exception as e:  # noqa: BLE001
        return str(e).split("\n")[0]
    return None


def split_parts(ctx: Context, checks: Sequence[Check]):
    """Made checks by kind: parts per base table, frames, and the error text of those that cannot be made."""
    parts: dict[str, list[tuple[str, R.Part]]] = {}
    frames: dict[str, DataFrame] = {}
    errors: dict[str, str] = {}
    for check in checks:
        try:
            made = check.make(ctx)
        except Exception as e:  # noqa: BLE001 - one bad check must not stop the package
            errors[check.id] = str(e).split("\n")[0]
            continue
        if isinstance(made, DataFrame):
            frames[check.id] = made
        else:
            parts.setdefault(made.over, []).append((check.id, made))
    for over, members in list(parts.items()):
        base = ctx.base(over)
        if _resolves(base, members) is None:
            continue
        wrong = {i: text for i, part in members if (text := _resolves(base, [(i, part)])) is not None}
        errors |= wrong
        parts[over] = [m for m in members if m[0] not in wrong]
    return parts, frames, errors


def fused_counts(ctx: Context, parts: dict[str, list[tuple[str, R.Part]]]) -> DataFrame | None:
    """Result row counts of all parts; parts without any hit are absent, measures always give one row."""
    frames = []
    for over, members in parts.items():
        rows = [m for m in members if not isinstance(m[1], R.Measure)]
        if rows:
            frames.append(counts_over(ctx.base(over), rows))
    return reduce(lambda a, b: a.unionByName(b), frames) if frames else None


def fused_results(ctx: Context, parts: dict[str, list[tuple[str, R.Part]]]) -> DataFrame | None:
    """Result rows of all parts as ``(check_id, row)``."""
    frames: list[DataFrame] = []
    for over, members in parts.items():
        rows = [m for m in members if not isinstance(m[1], R.Measure)]
        measures = [m for m in members if isinstance(m[1], R.Measure)]
        if rows:
            frames += results_over(ctx.base(over), rows)
        if measures:
            frames.append(measures_over(ctx.base(over), measures))
    return reduce(lambda a, b: a.unionByName(b), frames) if frames else None


def package_counts(ctx: Context, checks: Sequence[Check], apart: bool = False) -> DataFrame:
    """One row per check with its number of result rows, as one lazy plan for the whole package.

    One plan holds the shuffle files and broadcasts of all checks until its end. With ``apart``, checks are counted at
    once, one after the other, and what one of them needed is gone when the next begins; the parts are still one job.
    """
    spark = ctx.chk.sparkSession
    if apart:
        with shuffles_removed(spark):
            return _package_counts(ctx, checks, lambda frames: [_found(spark, frames)])
    return _package_counts(ctx, checks, lambda frames: frames)


def _found(spark: SparkSession, frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of the frames, each frame a job of its own."""
    return spark.createDataFrame([tuple(r) for f in frames for r in finished(spark, f.collect)], COUNTS_SCHEMA)


def _package_counts(ctx: Context, checks: Sequence[Check], held: Callable[[list[DataFrame]], list[DataFrame]]) -> DataFrame:
    spark = ctx.chk.sparkSession
    parts, frames, errors = split_parts(ctx, checks)
    counted = [f.agg(F.count("*").alias("result")).select(F.lit(i).alias("check_id"), "result") for i, f in frames.items()]
    fused = fused_counts(ctx, parts)
    if fused is not None:
        counted.append(fused)
    measures = [i for members in parts.values() for i, p in members if isinstance(p, R.Measure)]
    listed = spark.createDataFrame(
        [(c.id, c.severity, c.title, 1 if c.id in measures else 0, c.id in errors) for c in checks],
        "check_id string, severity string, title string, least bigint, failed boolean",
    )
    found = reduce(lambda a, b: a.unionByName(b), held(counted)).withColumnRenamed("check_id", "_id")
    result = F.when(~F.col("failed"), F.coalesce("result", "least"))
    return listed.join(found, F.col("check_id") == F.col("_id"), "left").select("check_id", "severity", "title", result.alias("result"))


def package_summary(ctx: Context, checks: Sequence[Check]) -> DataFrame:
    """Result rows of the summary checks as ``(check_id, row)``."""
    parts, frames, _ = split_parts(ctx, [c for c in checks if c.summary])
    out = [
        f.select(F.lit(i).alias("check_id"), F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in f.columns]), {"ignoreNullFields": "false"}).alias("row"))
        for i, f in frames.items()
    ]
    fused = fused_results(ctx, parts)
    if fused is not None:
        out.append(fused)
    return reduce(lambda a, b: a.unionByName(b), out)
