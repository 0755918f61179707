"""Text expressions.  All of them are plain Spark column expressions, no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievemark.functions import patterns as P


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_blank(c: Column | str) -> Column:
    """The empty string counts as NULL everywhere after staging."""
    return F.nullif(_col(c), F.lit(""))


def strip(c: Column | str) -> Column:
    """Remove any white space at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+\z", "")


def id_key(c: Column | str) -> Column:
    """Case-insensitive match key of an identifier."""
    return F.upper(_col(c))


def joined(*parts: Column | str | None) -> Column:
    """Concatenation in which NULL counts as the empty text; the result is NULL if nothing is left."""
    return null_if_blank(F.concat(*[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts]))


def text_length(c: Column | str) -> Column:
    return F.length(_col(c)).cast("bigint")


def matches(c: Column | str, pattern: str) -> Column:
    return _col(c).rlike(pattern)


def first_match(c: Column | str, pattern: str) -> Column:
    """First part that matches, NULL without a match."""
    return null_if_blank(F.regexp_substr(_col(c), F.lit(pattern)))


def without(c: Column | str, pattern: str, replacement: str = "") -> Column:
    """Replace every match; an emptied text becomes NULL."""
    return null_if_blank(F.regexp_replace(_col(c), pattern, replacement))


def word_tokens(c: Column | str) -> Column:
    """Array of the word tokens of a list text; ``-`` counts as part of a word."""
    return F.regexp_extract_all(F.replace(_col(c), F.lit("-"), F.lit("_")), F.lit(r"(\w+)"), F.lit(1))


def ascii_escaped(c: Column | str) -> Column:
    """Each non-ASCII character and each backslash as ``\\XXXX`` UTF-16 code units."""
    c = _col(c)

    def one(ch: Column) -> Column:
        units = F.regexp_replace(F.hex(F.encode(ch, "UTF-16BE")), "(.{4})", r"\\$1")
        return F.when(ch.rlike(P.NON_ASCII_OR_BACKSLASH), units).otherwise(ch)

    escaped = F.array_join(F.transform(F.split(c, ""), one), "")
    return F.when(c.rlike(P.NON_ASCII_OR_BACKSLASH), escaped).otherwise(c)


def differs_from_ascii(c: Column | str) -> Column:
    """True where :func:`ascii_escaped` would change the text; needs no per-character work."""
    return _col(c).rlike(P.NON_ASCII_OR_BACKSLASH)


def title_case(c: Column | str) -> Column:
    """Capital after every non-letter, other letters small (``o'neil-x`` becomes ``O'Neil-X``)."""
    runs = F.regexp_extract_all(_col(c), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def status_text(c: Column | str) -> Column:
    """Known status codes in capitals, other statuses in title case."""
    s = strip(c)
    return F.when(F.lower(s).isin(*P.UPPER_STATUS_CODES), F.upper(s)).otherwise(title_case(s))


def compare_text(c: Column | str) -> Column:
    """Capitals of the word characters only, NULL if none are left."""
    return F.upper(without(c, r"\W"))


def file_name(path: Column | str) -> Column:
    """Part of a path after the last backslash, in capitals."""
    return F.upper(first_match(path, P.FILE_NAME))


def file_extension(path: Column | str) -> Column:
    """Text after the last dot, in capitals; the path itself where it has no dot before it."""
    return F.regexp_replace(F.upper(_col(path)), P.EXTENSION, "$1")


def server_share(path: Column | str) -> Column:
    return first_match(F.upper(_col(path)), P.SERVER_SHARE)


def default_text(c: Column | str, default: str | Column) -> Column:
    """Default for a NULL or blank field."""
    return F.coalesce(null_if_blank(c), _col(default) if isinstance(default, Column) else F.lit(default))


def header_name(name: str) -> str:
    """Column name as staged: stripped, capitals, blanks as underscores."""
    return name.strip().upper().replace(" ", "_")


def header_names(names: list[str]) -> list[str]:
    return [header_name(n) for n in names]
