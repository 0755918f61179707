"""Per-key operators: duplicates, several values per key, lists, latest and majority values.

No operator sends all rows of a key through one task: statistics are aggregated map-side first,
and rows of heavy keys are salted when the statistic is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemark.functions.text import _col
from sievemark.operators.parts import named_columns

# A key is split into pieces of about this many rows. At most rows / PIECE_ROWS keys have more than one
# piece, which bounds the broadcast set of heavy keys.
PIECE_ROWS = 1_000_000


def other_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame with its key columns renamed, so that it can be joined with a frame of the same origin."""
    return df.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in df.columns])


def same_keys(keys: Sequence[str]) -> Column:
    """NULL-safe match of ``keys`` with those of :func:`other_keys`."""
    cond = F.col(keys[0]).eqNullSafe(F.col(f"_r_{keys[0]}"))
    for k in keys[1:]:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return cond


def join_key_statistic(
    rows: DataFrame, statistic: DataFrame, keys: Sequence[str], weight: str, weights: DataFrame | None = None, piece_rows: int | None = None
) -> DataFrame:
    """Inner join of rows with one statistic row per key, NULL keys equal, heavy keys in pieces.

    ``weight`` is the statistic column with the number of rows of the key; a key gets a piece for every
    ``piece_rows`` of them, so pieces stay the same size however heavy it is. The piece of a row depends only
    on the row and its input partition, so a retried task sends every row to the same place again.
    ``weights`` may name a cheaper frame with one row per key, needed if a key has several statistics.
    """
    keys, columns = list(keys), rows.columns
    pieces = F.ceil(F.col(weight) / (piece_rows or PIECE_ROWS)).cast("int")
    heavy = (statistic if weights is None else weights).withColumn("_pieces", pieces).filter("_pieces > 1")
    heavy = other_keys(heavy.select(*keys, "_pieces"), keys)
    marked = rows.join(F.broadcast(heavy), same_keys(keys), "left").select(*columns, "_pieces")
    spot = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in columns]), F.col("_pieces")).cast("int")
    salted = marked.select(*columns, F.coalesce(spot, F.lit(0)).alias("_salt"))
    spread = other_keys(statistic.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(pieces - 1, F.lit(0))))), [*keys, "_salt"])
    extra = [c for c in statistic.columns if c not in keys]
    return salted.join(spread, same_keys([*keys, "_salt"]), "inner").select(*columns, *extra)


def _keyed(df: DataFrame, keys: Sequence[Column | str]) -> tuple[DataFrame, list[str]]:
    """The frame with a column per key expression; a key given by name is used as it is."""
    names = [k if isinstance(k, str) else f"_key{i}" for i, k in enumerate(keys)]
    return df.select("*", *[k.alias(n) for n, k in zip(names, keys) if not isinstance(k, str)]), names


def duplicate_rows(
    df: DataFrame, keys: Sequence[Column | str], count_name="cnt", distinct=False, where: Column | None = None, counted: Column | None = None
) -> DataFrame:
    """Rows whose key occurs more than once, with the number of rows of the key.

    ``counted`` counts only rows in which it is not NULL; ``distinct`` gives equal rows once.
    """
    df = df if where is None else df.filter(where)
    columns = df.columns
    if distinct:
        df = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    rows, names = _keyed(df, keys)
    n = F.col("_n") if distinct else F.lit(1)
    hit = n if counted is None else F.when(counted.isNotNull(), n).otherwise(0)
    stat = rows.groupBy(*names).agg(F.sum(hit).cast("bigint").alias("_hits"), F.count("*").alias("_weight")).filter(F.col("_hits") > 1)
    return join_key_statistic(rows, stat, names, "_weight").select(*columns, F.col("_hits").alias(count_name))


def multi_value_rows(
    df: DataFrame,
    keys: Sequence[Column | str],
    value: Column | str,
    show: Sequence[str | Column] = ("*",),
    count_name="cnt",
    distinct=True,
) -> DataFrame:
    """Rows of keys that have more than one distinct value, with the number of values."""
    rows, names = _keyed(df, keys)
    show = df.columns if any(isinstance(c, str) and c == "*" for c in show) else show
    shown = rows.select(*named_columns(show)).columns
    held = value if isinstance(value, str) and value in shown else "_value"
    extra = [F.col(n) for n in names if n not in shown]
    if held == "_value":
        extra.append(_col(value).alias(held))
    rows = rows.select(*named_columns(show), *extra)
    if distinct:
        rows = rows.distinct()
    # A value that is a key itself is the only one of its key, unless it is NULL: no set of values has to be kept.
    values = F.max(F.col(held).isNotNull().cast("bigint")) if held in names else F.count_distinct(held)
    stat = rows.groupBy(*names).agg(values.alias("_values"), F.count("*").alias("_weight")).filter(F.col("_values") > 1)
    return join_key_statistic(rows, stat, names, "_weight").select(*shown, F.col("_values").alias(count_name))


def distinct_count_per_key(df: DataFrame, keys: Sequence[Column | str], value: Column | str, name: str) -> DataFrame:
    """Every row with the number of distinct values of its key (a distinct count over a partition)."""
    columns = df.columns
    rows, names = _keyed(df, keys)
    stat = rows.groupBy(*names).agg(F.count_distinct(_col(value)).alias("_values"), F.count("*").alias("_weight"))
    return join_key_statistic(rows, stat, names, "_weight").select(*columns, F.col("_values").alias(name))


def count_per_key(df: DataFrame, keys: Sequence[Column | str], name: str) -> DataFrame:
    """Every row with the number of rows of its key (a count over a partition)."""
    columns = df.columns
    rows, names = _keyed(df, keys)
    stat = rows.groupBy(*names).agg(F.count("*").alias("_weight"))
    return join_key_statistic(rows, stat, names, "_weight").select(*columns, F.col("_weight").alias(name))


def multi_value_keys(df: DataFrame, key: Column | str, value: str, key_name: str, count_name="cnt") -> DataFrame:
    """Keys with more than one distinct value and the number of values."""
    counts = df.groupBy(_col(key).alias(key_name)).agg(F.count_distinct(value).alias(count_name))
    return counts.filter(F.col(count_name) > 1)


def value_lists(
    df: DataFrame, keys: Sequence[str], value: str, name: str, order: Sequence[str] = (), sep=", ", copies: Column | None = None
) -> DataFrame:
    """One ordered text list of the non-NULL values per key, every copy of a value included.

    Equal values are counted before they are listed, so what moves is one row per distinct value of a key.
    The list of a key is one text, which has to fit in a row.
    """
    keys, order = list(keys), list(order)
    n = F.count("*") if copies is None else F.sum(copies)
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, *order, F.col(value).alias("_v")).agg(n.alias("_n"))
    repeated = F.array_join(F.array_repeat(F.col("_v"), F.col("_n").cast("int")), sep)
    quoted = sep.replace("'", "''")
    within = ", ".join(f"`{c}` ASC NULLS LAST" for c in [*order, "_v"])
    listed = F.expr(f"listagg(_entry, '{quoted}') WITHIN GROUP (ORDER BY {within})").alias(name)
    return counted.select(*keys, *order, "_v", repeated.alias("_entry")).groupBy(*keys).agg(listed)


def multi_value_lists(df: DataFrame, key: str, value: str, count_name: str, list_name: str) -> DataFrame:
    """Keys with several distinct values, their number and the list of all values."""
    counts = multi_value_keys(df, key, value, key, count_name)
    hit = df.join(other_keys(counts, [key]), same_keys([key]), "left_semi")
    lists = value_lists(hit, [key], value, list_name)
    return counts.join(other_keys(lists, [key]), same_keys([key])).select(key, count_name, list_name)


def versions_same_date(df: DataFrame, key: str, date: str, version: str) -> DataFrame:
    """Keys with several versions of the same date: the number of versions and their list."""
    seen = df.select(key, date, version).distinct()
    counts = seen.groupBy(key, date).agg(F.count(version).alias("cnt_revs_same_date")).filter(F.col("cnt_revs_same_date") > 1)
    keys = [key, date]
    hit = seen.join(other_keys(counts, keys), same_keys(keys), "left_semi")
    lists = value_lists(hit, [key, date], version, "revisions_samedate")
    return counts.join(other_keys(lists, keys), same_keys(keys)).select(*keys, "cnt_revs_same_date", "revisions_samedate")


def latest_per_key(df: DataFrame, key: str, by: str, tie: str, show: Sequence[str]) -> DataFrame:
    """The row with the largest ``by`` of each key; NULL counts as largest, ties go to the larger ``tie``."""
    rank = F.struct(F.col(by).isNull(), F.col(by), F.col(tie))
    best = df.groupBy(key).agg(F.max_by(F.struct(*show), rank).alias("_best"))
    return best.select(key, *[F.col(f"_best.{c}").alias(c) for c in show])


def majority_value(df: DataFrame, value: str) -> DataFrame:
    """One row: the most frequent value; ties go to the smaller value."""
    counts = df.groupBy(value).agg(F.count("*").alias("_n"))
    return counts.orderBy(F.desc("_n"), F.asc_nulls_last(value)).limit(1).select(value)


def first_per_key(df: DataFrame, key: Sequence[str], position: str) -> DataFrame:
    """Position of the first row of each key, the order-free form of comparing with the previous record."""
    return df.groupBy(*key).agg(F.min(position).alias("first_position"))
