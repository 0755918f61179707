"""Checks of a staged table against reference tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions import text as T
from sievemark.functions import values as V
from sievemark.functions.text import _col
from sievemark.operators.keyed import count_per_key, majority_value, value_lists
from sievemark.operators.parts import named_columns


def exists_in(chk: DataFrame, key: Column | str, ref: DataFrame, ref_key: Column | str, show: Sequence[str | Column], distinct=True) -> DataFrame:
    """Staged rows with a match in the reference, with columns of both."""
    out = chk.join(ref, _col(key) == _col(ref_key)).select(*named_columns(show))
    return out.distinct() if distinct else out


def count_existing(chk: DataFrame, key: str, ref: DataFrame, ref_key: Column | str, name="count") -> DataFrame:
    """Distinct staged ids with a match in the reference."""
    ids = chk.select(F.col(key).alias("_id")).distinct()
    found = ids.join(ref, T.id_key("_id") == _col(ref_key), "left_semi")
    return found.agg(F.count("_id").alias(name))


def missing_in(chk: DataFrame, key: Column | str, ref: DataFrame, ref_key: Column | str, when: Column | None = None) -> DataFrame:
    """Staged rows without a match in the reference; a NULL key never matches."""
    chk = chk if when is None else chk.filter(when)
    return chk.join(ref, _col(key) == _col(ref_key), "left_anti")


def missing_value(joined: DataFrame, col: str, show: Sequence[str | Column] = ("*",)) -> DataFrame:
    """Rows of a left join chain whose looked-up value is NULL, one per unmatched copy."""
    return joined.filter(F.col(col).isNull()).select(*named_columns(show))


def not_in_lov(chk: DataFrame, values: dict[str, str], lov: DataFrame, count_key: str, names: dict[str, str] | None = None) -> DataFrame:
    """Value combinations that the list of values lacks, with the number of distinct ids using them.

    ``values`` maps staged columns to columns of the list. Ids are counted per combination first, so
    only one row per combination is looked up.
    """
    counts = chk.groupBy(*values).agg(F.count_distinct(count_key).alias("cnt"))
    known = lov.select(*[F.col(c).alias(f"_lov_{c}") for c in values.values()]).distinct()
    cond = [F.col(c) == F.col(f"_lov_{v}") for c, v in values.items()]
    out = counts.join(known, cond, "left_anti")
    return out.select(*[F.col(c).alias((names or {}).get(c, c)) for c in values], "cnt")


def not_in_values(joined: DataFrame, col: str, allowed: Sequence[str], show: Sequence[str | Column]) -> DataFrame:
    """Rows whose value is none of the allowed ones; NULL drops out."""
    return joined.filter(~F.col(col).isin(*allowed)).select(*named_columns(show))


def dimension_profile(counts: DataFrame, group: str, dim: DataFrame, dim_group: str, show: Sequence[str | Column], per: Sequence[str], ignore_case=True) -> DataFrame:
    """Distinct group descriptions with the number of joined rows per partition.

    ``counts`` holds the number of rows ``_n`` per ``per`` columns; the dimension is joined to those
    few rows only. A group with several descriptions counts each row once per description.
    """
    left, right = (T.id_key(group), T.id_key(dim_group)) if ignore_case else (F.col(group), F.col(dim_group))
    joined = counts.join(dim, left == right, "left")
    totals = joined.groupBy(*per).agg(F.sum("_n").cast("bigint").alias("cnt"))
    keys = [F.col(p).alias(f"_t_{p}") for p in per]
    totals = totals.select(*keys, "cnt")
    cond = F.lit(True)
    for p in per:
        cond = cond & F.col(p).eqNullSafe(F.col(f"_t_{p}"))
    return joined.join(totals, cond).select(*named_columns(show), "cnt").distinct()


def delta_update(
    joined: DataFrame,
    new: Column | str,
    current: Column | str,
    mode: str = "strict",
    show: Sequence[str | Column] = ("*",),
    input_line: Column | None = None,
    distinct=False,
) -> DataFrame:
    """Staged values that differ from the current ones.

    ``strict`` drops rows with a NULL on either side, ``null_safe`` reads NULL as ``none``. With
    ``input_line`` the result starts with the line that requests the change.
    """
    compare = {"strict": V.differs, "null_safe": V.differs_null_safe}[mode]
    columns = named_columns(show)
    if input_line is not None:
        columns = [input_line.alias("inp"), *columns]
    out = joined.filter(compare(new, current)).select(*columns)
    return out.distinct() if distinct else out


def multiple_joined_versions(joined: DataFrame, key: str, show: Sequence[str | Column], distinct=False) -> DataFrame:
    """Joined rows of ids that have more than one version, with the number of rows per id."""
    rows = count_per_key(joined.select(key, *[c for c in named_columns(show)]), [key], "cnt").filter(F.col("cnt") > 1)
    return rows.distinct() if distinct else rows


def revision_not_listed(joined: DataFrame, key: str, item: str, rev: str, new: str, exact=False) -> DataFrame:
    """Ids whose staged revision is not in the list of the item's revisions.

    The test is on the list text: ``1`` is found in ``10``, ``%`` and ``_`` in the staged revision are
    wildcards, a text with the separator may span two revisions, and a NULL staged revision is always found.
    ``exact`` compares the staged revision with each of the item's revisions instead.
    """
    pairs = joined.select(key, item, new).distinct()
    lists = value_lists(joined, [item], rev, "rev_current").withColumnRenamed(item, "_item")
    if exact:
        known = joined.select(F.col(item).alias("_i"), F.col(rev).alias("_r")).distinct()
        pairs = pairs.filter(F.col(new).isNotNull()).join(known, (F.col(item) == F.col("_i")) & (F.col(new) == F.col("_r")), "left_anti")
        missing = pairs.join(lists, F.col(item) == F.col("_item"))
    else:
        text = F.concat(F.lit("%"), F.coalesce(F.col(new), F.lit("")), F.lit("%"))
        missing = pairs.join(lists, F.col(item) == F.col("_item")).filter(~F.like("rev_current", text))
    return missing.select(key, "rev_current", F.col(new).alias("rev_new")).distinct()


def not_in_majority(joined: DataFrame, population: DataFrame, attr: str, show: Sequence[str | Column]) -> DataFrame:
    """Rows whose attribute is not the most frequent one of the population; NULL is never the same."""
    top = majority_value(population.select(F.col(attr).alias("_major")), "_major")
    return joined.join(F.broadcast(top), F.col(attr) == F.col("_major"), "left_anti").select(*named_columns(show))


def id_counts(chk: DataFrame, col: str, upper=True, distinct=False) -> DataFrame:
    """Rows per staged id, so that a join with a reference table sees each id once.

    ``distinct`` counts each staged id once, whatever the number of its rows.
    """
    rows = chk.select(col).distinct() if distinct else chk
    key = T.id_key(col) if upper else F.col(col)
    return rows.groupBy(key.alias("_id")).agg(F.count("*").alias("_n"))


def joined_frequency(joined: DataFrame, cols: dict[str, str | Column], count_name="count", null_label: str | None = None) -> DataFrame:
    """Staged rows per value of joined columns; ``joined`` carries the weights of :func:`id_counts`."""
    counts = joined.groupBy(*[_col(c).alias(n) for n, c in cols.items()]).agg(F.sum("_n").cast("bigint").alias(count_name))
    if null_label is None:
        return counts
    return counts.select(*[V.null_label(n, null_label).alias(n) for n in cols], count_name)


def joined_count(joined: DataFrame, name="count") -> DataFrame:
    return joined.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias(name))
