"""Operators over one global order of the rows: numbering, the previous record, consecutive groups.

No task sees the whole order. The rows are dealt into ranges by fixed bounds, drawn once from a sample of the order
keys, so the range of a row depends on the row alone and a task that runs again deals its rows alike. Sizes per
range, and what the rows at the end of a range hand on to the next one, are small (one row per range).

Rows that tie in the order are told apart by a digest of all their columns. Rows that are equal in every column may
stand in any order among themselves; where they are so many that one range could not hold them, they travel as one
row with a number of copies and are laid out again in pieces at the end.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

RANGE_ROWS = 2_000_000  # rows per range, more where there would be over MOST_RANGES
MOST_RANGES = 20_000  # bounds the sample, the sizes and the border rows that the driver or a broadcast holds
_PER_RANGE = 40  # sampled keys per range
_TIE, _RANGE, _COPIES = "_tie", "_range", "_copies"


def _literals(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


@dataclass
class OrderedRows:
    """Rows in ranges, each with the number of its equal copies; ranges are in order, rows ordered within them."""

    rows: DataFrame
    columns: list[str]
    order: list[str]
    sizes: list[int]
    copied: bool

    @property
    def total(self) -> int:
        return sum(self.sizes)

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(_RANGE).orderBy(*[F.asc_nulls_first(f"`{c}`") for c in self.order], _TIE)

    def placed(self, name: str) -> DataFrame:
        """Adds the place from 1 of the first copy of each row."""
        before = F.element_at(_literals([0, *accumulate(self.sizes)][: len(self.sizes)] or [0]), F.col(_RANGE) + 1)
        upto = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return self.rows.withColumn(name, before + F.sum(_COPIES).over(upto) - F.col(_COPIES) + 1)

    def laid_out(self, df: DataFrame, place: str, piece: int = RANGE_ROWS) -> DataFrame:
        """One row per copy again, with ``_copy`` from 0; many copies are made by several tasks."""
        if not self.copied:
            return df.withColumn("_copy", F.lit(0).cast("bigint"))
        step = F.lit(piece).cast("bigint")
        pieces = df.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(_COPIES) - 1, step)))
        dealt = pieces.repartition(place, "_from")
        last = F.least(F.col("_from") + step, F.col(_COPIES)) - 1
        return dealt.withColumn("_copy", F.explode(F.sequence("_from", last))).withColumn(place, F.col(place) + F.col("_copy")).drop("_from")

    def passed_on(self, df: DataFrame, aggregates: Sequence[Column], handed: Sequence[Column]) -> DataFrame:
        """(_r, ...) per range: aggregates of its rows, then what all ranges before it hand on, as windows over ranges.

        ``handed`` are aggregates over the window of the ranges before.
        """
        per_range = df.groupBy(F.col(_RANGE).alias("_r")).agg(*aggregates)
        before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)  # at most MOST_RANGES rows
        return per_range.select("_r", *[c.over(before).alias(f"_h{i}") for i, c in enumerate(handed)])

    def with_handed(self, df: DataFrame, handed: DataFrame) -> DataFrame:
        return df.join(F.broadcast(handed), F.col(_RANGE) == F.col("_r"), "left").drop("_r")


def order_rows(df: DataFrame, order: Sequence[str], ranges: int | None = None) -> OrderedRows:
    """The rows of ``df`` in ranges of the ascending order of some columns, NULL first.

    Looks at the order columns and the digest twice: once for a sample, once for the sizes.
    """
    columns, order = df.columns, list(order)
    rows = df.withColumn(_TIE, F.xxhash64(*[F.col(f"`{c}`") for c in columns]))
    count = rows.count()
    spark = df.sparkSession
    if ranges is None:
        ranges = min(MOST_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // RANGE_ROWS)))
    ranges = max(1, min(ranges, count))
    key = F.struct(*[F.col(f"`{c}`") for c in order], F.col(_TIE))
    bounds = _bounds(rows.select(key.alias("k")), count, ranges)
    rows = rows.withColumn(_RANGE, _range_of(key, bounds) if bounds else F.lit(0))
    found = {r[0]: r[1] for r in rows.groupBy(_RANGE).count().collect()}
    sizes = [found.get(i, 0) for i in range(len(bounds) + 1)]
    share = max(RANGE_ROWS, 2 * -(-count // ranges))
    rows, copied = rows.withColumn(_COPIES, F.lit(1).cast("bigint")), False
    heavy = [i for i, n in enumerate(sizes) if n > share]
    if heavy:
        rows, copied = _copies_as_one(rows, columns, heavy, share)
    return OrderedRows(rows, columns, order, sizes, copied)


def _bounds(keys: DataFrame, count: int, ranges: int) -> list:
    """Upper bounds of all ranges but the last, each the first key of the next range."""
    if ranges < 2:
        return []
    share = min(1.0, ranges * _PER_RANGE / count)
    drawn = keys if share == 1.0 else keys.sample(share, seed=7)
    sample = [r[0] for r in drawn.orderBy("k").collect()]  # about ranges * _PER_RANGE keys
    picked = [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []
    distinct = [b for i, b in enumerate(picked) if i == 0 or b != picked[i - 1]]
    return distinct and [_row_literal(b, keys.schema["k"].dataType) for b in distinct]


def _row_literal(row, kind) -> Column:
    return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, kind)])


def _range_of(key: Column, bounds: list) -> Column:
    """Number of bounds that are not above the key, by binary search in a constant array."""
    table, n = F.array(*bounds), len(bounds)
    steps = [1 << i for i in reversed(range(n.bit_length()))]

    def down(low: Column, step: Column) -> Column:
        at = low + step
        return F.when((at <= n) & (F.get(table, at - 1) <= key), at).otherwise(low)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), down)


def _copies_as_one(rows: DataFrame, columns: Sequence[str], heavy: Sequence[int], share: int) -> tuple[DataFrame, bool]:
    """Equal rows of which there are more than ``share`` as one row with their number."""
    digests = rows.filter(F.col(_RANGE).isin(list(heavy))).groupBy(F.col(_TIE).alias("_t")).agg(F.count("*").alias("_c")).filter(F.col("_c") > share // 2)
    many = [r[0] for r in digests.select("_t").collect()]  # fewer than 2 * ranges
    if not many:
        return rows, False
    hot = F.col(_TIE).isin(many)
    merged = rows.filter(hot).groupBy(*[F.col(f"`{c}`") for c in columns], _TIE, _RANGE).agg(F.count("*").alias(_COPIES))
    return rows.filter(~hot).unionByName(merged), True


def numbered(df: DataFrame, order: Sequence[str], name: str = "position", total: str | None = None, ranges: int | None = None) -> DataFrame:
    """Rows numbered from 1 in ``order``; with ``total``, the number of all rows beside it."""
    o = order_rows(df, order, ranges)
    out = o.laid_out(o.placed(name), name)
    extra = [F.lit(o.total).cast("bigint").alias(total)] if total else []
    return out.select(*[F.col(f"`{c}`") for c in o.columns], F.col(name).cast("bigint").alias(name), *extra)


def _previous(o: OrderedRows, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``_before``: the key values of the record before as a struct, NULL for the first record."""
    key = F.struct(*[F.col(f"`{k}`") for k in keys])
    rank = F.struct(*[F.col(f"`{c}`") for c in o.order], F.col(_TIE))
    # The nearest range before that has rows hands on its last record.
    handed = o.passed_on(df, [F.max_by(key, rank).alias("_k")], [F.last("_k", ignorenulls=True)])
    return o.with_handed(df, handed).withColumn("_before", F.coalesce(F.lag(key).over(o.window), F.col("_h0"))).drop("_h0")


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], prefix: str = "previous_", ranges: int | None = None) -> DataFrame:
    """Every record with the key values of the record before it in the whole order, and its position from 1."""
    o = order_rows(df, order, ranges)
    own = F.struct(*[F.col(f"`{k}`") for k in keys])
    rows = o.laid_out(_previous(o, o.placed("position"), keys), "position")
    rows = rows.withColumn("_before", F.when(F.col("_copy") > 0, own).otherwise(F.col("_before")))
    seen = [F.col(f"_before.`{k}`").alias(f"{prefix}{k}") for k in keys]
    return rows.select(*[F.col(f"`{c}`") for c in o.columns], F.col("position").cast("bigint").alias("position"), *seen)


def key_changes(df: DataFrame, keys: Sequence[str], order: Sequence[str], every: bool = False, ranges: int | None = None) -> DataFrame:
    """Records whose key differs from that of the record before, the first record included.

    With ``every``, all of the key columns have to differ, not just one; NULL equals NULL, also before the first record.
    """
    rows = with_previous(df, keys, order, "_previous_", ranges)
    changed = [~F.col(f"`{k}`").eqNullSafe(F.col(f"`_previous_{k}`")) for k in keys]
    hit = changed[0]
    for c in changed[1:]:
        hit = hit & c if every else hit | c
    first = F.lit(False) if every else F.col("position") == 1
    return rows.filter(hit | first).select(*[F.col(f"`{c}`") for c in df.columns], "position")


def ordered_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), part_rows: int = 100_000, ranges: int | None = None) -> DataFrame:
    """The records sorted by ``keys``, then ``order``, in consecutive groups of equal keys.

    Adds ``group_no`` and ``position`` (both from 1) and ``part``: a group of more than ``part_rows`` records comes
    in several parts from 0, each with consecutive records, so no reader has to hold a large group.
    """
    keys = list(keys)
    o = order_rows(df, [*keys, *[c for c in order if c not in keys]], ranges)
    own = F.struct(*[F.col(f"`{k}`") for k in keys])
    rows = _previous(o, o.placed("_place"), keys)
    rows = rows.withColumn("_new", (F.col("_place") == 1) | ~own.eqNullSafe(F.col("_before")))
    start = F.max(F.when(F.col("_new"), F.col("_place")))
    upto = o.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    handed = o.passed_on(rows, [F.count_if("_new").alias("_groups"), start.alias("_start")], [F.sum("_groups"), F.max("_start")])
    rows = o.with_handed(rows, handed).select(
        "*",
        (F.coalesce("_h0", F.lit(0)) + F.sum(F.col("_new").cast("bigint")).over(upto)).alias("group_no"),
        F.coalesce(start.over(upto), F.col("_h1")).alias("_begin"),
    )
    rows = o.laid_out(rows, "_place").withColumn("position", F.col("_place") - F.col("_begin") + 1)
    part = F.floor((F.col("position") - 1) / part_rows).cast("bigint").alias("part")
    return rows.select(*[F.col(f"`{c}`") for c in o.columns], F.col("group_no").cast("bigint").alias("group_no"), F.col("position").cast("bigint").alias("position"), part)
