"""Check parts that many checks of a package can share in one scan of the staged table.

* :class:`RowRule`  - rows that satisfy a predicate (null, pattern, length, range checks);
* :class:`Tally`    - rows per value of an expression (frequency, decade, suffix checks);
* :class:`Measure`  - one row of aggregates (row, item and null counts).

``part.frame(df)`` runs one part alone; :mod:`sievemark.plans.fused` runs many together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions import patterns as P
from sievemark.functions import text as T
from sievemark.functions import values as V

STAGED = "staged"
STAGED_IDS = "staged_ids"


def named_columns(show: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in show]


@dataclass(frozen=True)
class RowRule:
    where: Column
    show: Sequence[str | Column] = ("*",)
    distinct: bool = False
    over: str = STAGED

    def frame(self, df: DataFrame) -> DataFrame:
        rows = df.filter(self.where).select(*named_columns(self.show))
        return rows.distinct() if self.distinct else rows


@dataclass(frozen=True)
class Tally:
    value: Column
    name: str
    count_name: str = "cnt"
    null_label: str | None = None
    where: Column | None = None
    over: str = STAGED

    def frame(self, df: DataFrame) -> DataFrame:
        df = df if self.where is None else df.filter(self.where)
        return self.labelled(df.groupBy(self.value.alias(self.name)).agg(F.count("*").alias(self.count_name)))

    def labelled(self, counts: DataFrame) -> DataFrame:
        value = F.col(self.name)
        if self.null_label is not None:
            value = V.null_label(value, self.null_label)
        return counts.select(value.alias(self.name), self.count_name)


@dataclass(frozen=True)
class Measure:
    values: Mapping[str, Column]
    over: str = STAGED

    def frame(self, df: DataFrame) -> DataFrame:
        return df.agg(*[c.alias(n) for n, c in self.values.items()])


Part = RowRule | Tally | Measure

# ------------------------------------------------------------------ measures


def row_count(name: str = "cnt") -> Measure:
    return Measure({name: F.count("*")})


def distinct_count(over: str = STAGED, **names: Column | str) -> Measure:
    """Exact distinct counts, NULL not counted."""
    return Measure({n: F.count_distinct(T._col(c)) for n, c in names.items()}, over)


def distinct_counts_and_total(total: str, **names: Column | str) -> Measure:
    """Several distinct counts and their sum in one row."""
    counts = {n: F.count_distinct(T._col(c)) for n, c in names.items()}
    return Measure({**counts, total: sum(list(counts.values())[1:], list(counts.values())[0])})


def null_count(col: str, name: str = "cnt") -> Measure:
    return Measure({name: F.count_if(F.col(col).isNull())})


# ------------------------------------------------------------------ row rules


def null_rows(cols: str | Sequence[str], show=("*",), negate=False, distinct=False) -> RowRule:
    """Rows in which any of the columns is NULL (or none of them, with ``negate``)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    missing = F.col(cols[0]).isNull()
    for c in cols[1:]:
        missing = missing | F.col(c).isNull()
    return RowRule(~missing if negate else missing, show, distinct)


def pattern_rows(
    col: str | Column, show, regex=None, like=None, negate=False, distinct=False, also: Column | None = None, over=STAGED
) -> RowRule:
    """Rows whose value matches a regular expression or LIKE pattern; NULL never matches, negated or not."""
    value = T._col(col)
    test = value.rlike(regex) if regex is not None else value.like(like)
    test = ~test if negate else test
    return RowRule(test if also is None else test & also, show, distinct, over)


def too_long(col: str, n: int, show=None, over=STAGED, length_name="length") -> RowRule:
    shown = [col] if show is None else list(show)
    return RowRule(F.length(F.col(col)) > n, [*shown, T.text_length(col).alias(length_name)], over=over)


def non_ascii(col: str, show=()) -> RowRule:
    return RowRule(T.differs_from_ascii(col), [*show, col, T.ascii_escaped(col).alias(f"{col}_ascii")])


def control_chars(
    col: str, replacement: str, show=(), pattern=P.CONTROL_CHARS, unless: str | None = None, over=STAGED, name: str | None = None
) -> RowRule:
    """Rows with control characters and a copy in which each is replaced."""
    test = T.matches(col, pattern)
    if unless is not None:
        test = test & ~T.matches(col, unless)
    copy = F.regexp_replace(F.col(col), pattern, replacement)
    return RowRule(test, [*show, col, copy.alias(name or f"{col}_marked")], over=over)


def numeric_range(col: str, lo=None, hi=None, zero=False, missing=False, show=("*",)) -> RowRule:
    """Rows whose number is below ``lo``, above ``hi``, zero or missing; text that is no number never matches."""
    n = V.number(col)
    tests = []
    if missing:
        tests.append(F.col(col).isNull())
    if zero:
        tests.append(n == 0)
    if lo is not None:
        tests.append(n < lo)
    if hi is not None:
        tests.append(n > hi)
    test = tests[0]
    for t in tests[1:]:
        test = test | t
    return RowRule(test, show)


def not_numeric(col: str, show=("*",)) -> RowRule:
    """Rows whose text is no number; a numeric compare would fail on them."""
    return RowRule(F.col(col).isNotNull() & V.number(col).isNull(), show)


def column_pair(a: Column | str, b: Column | str, op: str, show=("*",), also: Column | None = None) -> RowRule:
    a, b = T._col(a), T._col(b)
    test = {"=": a == b, "<>": a != b, "<": a < b, ">": a > b}[op]
    return RowRule(test if also is None else also & test, show)


def suffix_matches_group(id_col: str, group_col: str) -> RowRule:
    """Ids whose last colon part (less a final ``P``) is not the first word of the owning group."""
    suffix = T.first_match(id_col, P.LAST_COLON_PART)
    test = T.without(suffix, r"P\z") != T.first_match(group_col, P.GROUP_FIRST_WORD)
    return RowRule(test & F.col(id_col).like("%:%"), [id_col, suffix.alias("suffix"), group_col], distinct=True)


def odd_revision(id_col: str, rev_col: str = "revision") -> RowRule:
    """Revisions with other characters than capitals and digits (one dot between two characters is fine)."""
    odd = T.matches(T.without(rev_col, P.DOT_BETWEEN, "$1$2"), P.ODD_REVISION_CHAR)
    return RowRule(odd & ~T.matches(rev_col, P.DASH_REVISION), [id_col, rev_col], distinct=True)


# ------------------------------------------------------------------ tallies


def value_frequency(col: str | Column, name: str | None = None, count_name="cnt", null_label=None, where=None) -> Tally:
    return Tally(T._col(col), name or col, count_name, null_label, where)


def decade_histogram(date_col: str, count_name="count") -> Tally:
    return Tally(V.decade(date_col), "decade", count_name)


def suffix_frequency(id_col: str, null_label: str) -> Tally:
    """Rows per id suffix, from the first colon on."""
    return Tally(T.first_match(id_col, P.COLON_SUFFIX), "suffix", "cnt", null_label)
