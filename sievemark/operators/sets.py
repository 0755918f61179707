"""Unions, full outer joins, de-duplication and column profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.text import _col
from sievemark.operators.keyed import PIECE_ROWS
from sievemark.session import cut_lineage


def id_union(df: DataFrame, cols: Sequence[Column | str] | Mapping[str, Column | str], name="tc_id", type_name="type", extra=None) -> DataFrame:
    """Set of the ids of several columns, read in one scan.

    A mapping gives each id its type; ``extra`` names one more column per id column, kept with it.
    """
    typed = cols if isinstance(cols, Mapping) else {None: None}
    items: list[Column]
    if isinstance(cols, Mapping):
        items = [F.struct(_col(c).alias(name), F.lit(t).alias(type_name)) for t, c in typed.items()]
    elif extra:
        items = [F.struct(_col(c).alias(name), _col(e).alias(n)) for c, (n, e) in zip(cols, extra)]
    else:
        items = [F.struct(_col(c).alias(name)) for c in cols]
    return df.select(F.inline(F.array(*items))).distinct()


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name, missing ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return union_by_name(frames).distinct()


def union_set(frames: Sequence[DataFrame]) -> DataFrame:
    """Set union by position; NULL equals NULL."""
    return reduce(lambda a, b: a.union(b), frames).distinct()


def full_outer_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], piece_rows: int | None = None) -> DataFrame:
    """Full outer join on pairs of (left, right) columns, NULL keys equal, keys with many rows in pieces.

    Column names have to differ. A key with more than ``piece_rows`` rows on either side is taken apart from the
    others: where only one side has it, its rows pass without a join; where both do, the rows of each side are dealt
    into pieces and every piece meets every piece of the other side, so no task gets more than a piece of each.
    Blank keys are a key like any other here. There are at most ``rows / piece_rows`` such keys, which bounds the
    broadcast; the others are joined as usual. Finding them counts the rows per key first.
    """
    size = piece_rows or PIECE_ROWS
    keys = [f"_k{i}" for i in range(len(on))]

    def counts(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
        return df.groupBy(*[F.col(f"`{c}`").alias(k) for k, c in zip(keys, columns)]).agg(F.count("*").alias(name))

    lcols, rcols = [a for a, _ in on], [b for _, b in on]
    both = counts(left, lcols, "_m").unionByName(counts(right, rcols, "_n"), allowMissingColumns=True)
    sizes = both.groupBy(*keys).agg(F.coalesce(F.sum("_m"), F.lit(0)).alias("_m"), F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"))
    heavy = cut_lineage(sizes.filter((F.col("_m") > size) | (F.col("_n") > size)))
    same = reduce(lambda a, b: a & b, [F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`")) for a, b in on])
    if heavy.isEmpty():
        return left.join(right, same, "outer")
    pieces = lambda c: F.ceil(F.greatest(F.col(c), F.lit(1)) / size).cast("int")
    heavy = heavy.select(*keys, "_m", "_n", pieces("_m").alias("_a"), pieces("_n").alias("_b"))

    def marked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        match = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(k)) for c, k in zip(columns, keys)])
        return df.join(F.broadcast(heavy), match, "left").drop(*keys)

    lrows, rrows = marked(left, lcols), marked(right, rcols)
    plain = ["_m", "_n", "_a", "_b"]
    light = lrows.filter("_m is null").drop(*plain).join(rrows.filter("_m is null").drop(*plain), same, "outer")
    alone = lrows.filter("_n = 0").drop(*plain).unionByName(rrows.filter("_m = 0").drop(*plain), allowMissingColumns=True)

    def dealt(df: DataFrame, own: str, other: str, names: tuple[str, str]) -> DataFrame:
        # Deterministic per row and input partition; equal rows of several partitions are spread, too.
        spot = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in df.columns if c not in plain])
        rows = df.filter("_m > 0 and _n > 0").withColumn(names[0], F.pmod(spot, F.col(own)).cast("int"))
        return rows.withColumn(names[1], F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop(*plain)

    l, r = dealt(lrows, "_a", "_b", ("_li", "_lj")), dealt(rrows, "_b", "_a", ("_rj", "_ri"))
    met = l.join(r, same & (F.col("_li") == F.col("_ri")) & (F.col("_lj") == F.col("_rj"))).drop("_li", "_lj", "_ri", "_rj")
    return light.unionByName(alone).unionByName(met)


def outer_join_inputs(frames: Sequence[DataFrame], on: Sequence[str], piece_rows: int | None = None) -> DataFrame:
    """Full outer join of all inputs on shared keys; clashing columns get ``_x`` and ``_y``.

    NULL keys match each other, as blank cells of two sheets do.
    """
    on = list(on)

    def pair(left: DataFrame, right: DataFrame) -> DataFrame:
        clash = (set(left.columns) & set(right.columns)) - set(on)
        lnames = [c if c in on or c not in clash else f"{c}_x" for c in left.columns]
        rnames = [f"_right_{c}" if c in on else f"{c}_y" if c in clash else c for c in right.columns]
        left, right = left.toDF(*lnames), right.toDF(*rnames)
        joined = full_outer_join(left, right, [(c, f"_right_{c}") for c in on], piece_rows)
        keys = [F.coalesce(F.col(f"`{c}`"), F.col(f"`_right_{c}`")).alias(c) for c in on]
        rest = [c for c in rnames if not c.startswith("_right_")]
        return joined.select(*[keys[on.index(c)] if c in on else F.col(f"`{c}`") for c in lnames], *[F.col(f"`{c}`") for c in rest])

    return reduce(pair, frames)


def left_join_spread(df: DataFrame, key: str, *others: tuple[DataFrame, str]) -> DataFrame:
    """Left joins of one column with columns of other frames; rows without a key are dealt to all tasks.

    Such rows match nothing, but a left join on the key alone would send all of them to one task, and several joins
    in a row on one key keep adaptive execution from splitting it. The place of a row depends on the row and its
    input partition only.
    """
    spot = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in df.columns])
    rows = df.withColumn("_spot", F.when(F.col(key).isNull(), spot).otherwise(F.lit(0).cast("bigint")))
    for other, column in others:
        # 0 for every row, told from the column so that the optimiser keeps it a join key.
        other = other.withColumn("_at", F.pmod(F.xxhash64(column), F.lit(1).cast("bigint")))
        rows = rows.join(other, (F.col(key) == F.col(column)) & (F.col("_spot") == F.col("_at")), "left").drop("_at")
    return rows.drop("_spot")


def anti_join_any(df: DataFrame, *conditions: tuple[str, DataFrame, str]) -> DataFrame:
    """Rows that match none of several sets; one anti join per set instead of one join with OR."""
    for col, other, other_col in conditions:
        keys = other.select(F.col(other_col).alias("_other")).filter(F.col("_other").isNotNull()).distinct()
        df = df.join(keys, F.col(col) == F.col("_other"), "left_anti")
    return df


def deduplicate(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dropped_rows(df: DataFrame) -> DataFrame:
    """Row counts before and after de-duplication, in one pass."""
    per_row = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    total = F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint")
    return per_row.agg((total - F.count("*")).alias("dropped"), F.count("*").alias("remaining"))


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: longest text and whether all cells are blank; one aggregation over the table."""
    aggs = []
    for i, c in enumerate(df.columns):
        text = F.col(f"`{c}`").cast("string")
        aggs.append(F.coalesce(F.max(F.length(text)), F.lit(0)).cast("bigint").alias(f"_w{i}"))
    row = df.agg(*aggs)
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_w{i}").alias("max_length")) for i, c in enumerate(df.columns)])
    return row.select(F.inline(entries)).select("column_name", "max_length", (F.col("max_length") == 0).alias("all_blank"))
