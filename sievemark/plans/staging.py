"""Staging: clean, combine, type and de-duplicate inputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from sievemark.functions import text as T
from sievemark.operators.sets import deduplicate, outer_join_inputs, union_by_name

DATE_FORMATS = (None, "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy", "dd-MMM-yy", "dd-MMM-yyyy")
MIN_SPARE = 5
BLANK_WIDTH, BLANK_DESCRIPTION_WIDTH = 55, 555

# Kind of load -> package with its naming convention.
KINDS = {
    "namedesc": "name_desc",
    "obsolete": "status",
    "supersede": "supersede",
    "ownership": "ownership",
    "active": "status",
    "phase out": "status",
    "docload": "document",
    "itemload": "item",
    "bomload": "bom",
    "relationload": "doc_relation",
}


@dataclass
class StagedTable:
    """A staged table with the column widths of its text columns (None: unbounded) and the date columns left as text."""

    df: DataFrame
    widths: dict[str, int | None]
    untyped_dates: list[str]


def clean(df: DataFrame, lifecycle: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Heading in capitals, everything text, ids stripped and capitalised, statuses normalised, blanks NULL.

    The rule is chosen by column name: ``PUID`` leaves a column alone, ``ID`` anywhere in the name
    makes it an id (columns in ``keep`` are exempt), ``STATUS`` (and ``LIFECYCLE`` on request) a status.
    """
    keep = {k.upper() for k in keep}
    out: list[Column] = []
    for old, new in zip(df.columns, T.header_names(df.columns)):
        c = F.col(f"`{old}`").cast("string")
        if "PUID" in new or new in keep:
            pass
        elif "ID" in new:
            c = F.upper(T.strip(c))
        elif "STATUS" in new or (lifecycle and "LIFECYCLE" in new):
            c = T.status_text(c)
        out.append(T.null_if_blank(c).alias(new))
    return df.select(*out)


def _as_timestamp(c: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(c) if f is None else F.try_to_timestamp(c, F.lit(f)) for f in DATE_FORMATS])


def type_and_profile(df: DataFrame) -> StagedTable:
    """Date columns to timestamps, all values of a column or none; text widths measured.

    One aggregation over the table finds unreadable dates and the longest text of every column.
    """
    dates = [f.name for f in df.schema.fields if "DATE" in f.name.upper() and isinstance(f.dataType, Ty.StringType)]
    texts = [f.name for f in df.schema.fields if "DATE" not in f.name.upper()]
    if not dates and not texts:
        return StagedTable(df, {}, [])
    aggs = [F.count_if(F.col(f"`{c}`").isNotNull() & _as_timestamp(F.col(f"`{c}`")).isNull()).alias(f"d{i}") for i, c in enumerate(dates)]
    aggs += [F.max(F.length(F.col(f"`{c}`").cast("string"))).alias(f"w{i}") for i, c in enumerate(texts)]
    found = df.agg(*aggs).first()
    bad = [c for i, c in enumerate(dates) if found[f"d{i}"]]
    typed = df.withColumns({c: _as_timestamp(F.col(f"`{c}`")) for c in dates if c not in bad}) if len(bad) < len(dates) else df
    widths = {c: text_width(c, found[f"w{i}"]) for i, c in enumerate(texts)}
    return StagedTable(typed, widths, bad)


def text_width(name: str, longest: int | None) -> int | None:
    """Column width of a text column: longest value plus a margin, a fixed width if all cells are blank.

    Columns with ``CLOB`` in their name hold texts of any length and have none.
    """
    if "CLOB" in name.upper():
        return None
    if longest:
        return longest + MIN_SPARE
    return BLANK_DESCRIPTION_WIDTH if "DESCRIPTION" in name.upper() else BLANK_WIDTH


def column_types(staged: StagedTable) -> DataFrame:
    """(column_name, type, width): what a database table for the staged rows needs."""
    rows = []
    for f in staged.df.schema.fields:
        width = staged.widths.get(f.name)
        kind = "CLOB" if f.name in staged.widths and width is None else "TEXT" if f.name in staged.widths or f.name in staged.untyped_dates else "DATE"
        rows.append((f.name, kind, width))
    return staged.df.sparkSession.createDataFrame(rows, "column_name string, type string, width int")


def combine(inputs: Sequence[DataFrame], join_on: Sequence[str] | None = None) -> DataFrame:
    """Several inputs as one: full outer join on shared keys, or rows under each other by column name."""
    if len(inputs) > 1 and join_on:
        return outer_join_inputs(inputs, [T.header_name(k) for k in join_on])
    return union_by_name(inputs)


def stage(
    inputs: Mapping[str, DataFrame] | Sequence[DataFrame],
    join_on: Sequence[str] | None = None,
    clean_up: bool = True,
    dedup: bool = True,
    **clean_options,
) -> StagedTable:
    frames = list(inputs.values()) if isinstance(inputs, Mapping) else list(inputs)
    if clean_up:
        frames = [clean(f, **clean_options) for f in frames]
    df = combine(frames, join_on)
    df = df.select(*[T.null_if_blank(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])
    staged = type_and_profile(df)
    if dedup:
        staged.df = deduplicate(staged.df)
    return staged


def clone(rows: DataFrame, clean_up: bool = True, **clean_options) -> StagedTable:
    """One load of a staging source as a staged table."""
    return stage([rows], clean_up=clean_up, **clean_options)


def expected_columns(kind: str) -> dict[str, list[str]]:
    """Naming conventions of all kinds whose name contains ``kind``, or of every kind with ``all``."""
    from sievemark.packages import PACKAGES

    return {k: list(PACKAGES[p].expects) for k, p in KINDS.items() if kind == "all" or kind in k}


def contract(kind: str) -> Ty.StructType:
    """Staged schema of one kind: dates as timestamps, the rest text."""
    (cols,) = [c for k, c in expected_columns(kind).items() if k == kind]
    return Ty.StructType([Ty.StructField(c.upper(), Ty.TimestampType() if "date" in c else Ty.StringType()) for c in cols])


def check_contract(df: DataFrame, kind: str) -> list[str]:
    """Columns the kind expects and the table lacks."""
    have = {c.upper() for c in df.columns}
    return [f.name for f in contract(kind).fields if f.name not in have]


def contract_profile(df: DataFrame, kind: str) -> DataFrame:
    """(column_name, filled): each expected column with the number of rows that fill it, NULL if the table lacks it."""
    lacking = set(check_contract(df, kind))
    names = [f.name for f in contract(kind).fields]
    counts = df.agg(*[(F.lit(None).cast("bigint") if c in lacking else F.count(c)).alias(c) for c in names])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in names])).alias("c")).select("c.*")
