import datetime as dt

import pytest
from pyspark.sql import functions as F

from sievemark.functions import patterns as P
from sievemark.functions import text as T
from sievemark.functions import values as V


def each(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("c"))).collect()]


def python_ascii(s):
    if s is None:
        return None
    out = []
    for ch in s:
        if ord(ch) < 128 and ch != "\\":
            out.append(ch)
        else:
            raw = ch.encode("utf-16-be").hex().upper()
            out += ["\\" + raw[i : i + 4] for i in range(0, len(raw), 4)]
    return "".join(out)


def test_ascii_escape_matches_utf16_units(spark):
    values = ["plain", "caf\u00e9", "a\\b", "\u20ac\U0001f600x", "", None, "tab\there", "\x7f\x80"]
    assert each(spark, values, T.ascii_escaped) == [python_ascii(v) for v in values]
    assert each(spark, values, T.differs_from_ascii) == [None if v is None else python_ascii(v) != v for v in values]


def test_title_case_follows_python(spark):
    values = ["o'neil-x", "ON HOLD", "a1b c", "\u00e9tat civil", "x"]
    assert each(spark, values, T.title_case) == [v.title() for v in values]


@pytest.mark.parametrize("given,expected", [(" active ", "ACTIVE"), ("Mfg", "MFG"), ("on hold", "On Hold"), ("STOP", "STOP"), (None, None)])
def test_status_text(spark, given, expected):
    assert each(spark, [given], T.status_text) == [expected]


def test_blank_rules(spark):
    assert each(spark, ["", " ", "x", None], T.null_if_blank) == [None, " ", "x", None]
    assert each(spark, ["\t a \n", "", None], T.strip) == ["a", "", None]
    assert each(spark, [None, "x"], lambda c: T.joined(c, F.lit("|"), c)) == ["|", "x|x"]
    assert each(spark, [None], lambda c: T.joined(c, c)) == [None]
    assert each(spark, ["---", "a-b"], T.compare_text) == [None, "AB"]


def test_first_match_is_null_without_match(spark):
    assert each(spark, ["12:AB:C", "12", None], lambda c: T.first_match(c, P.COLON_SUFFIX)) == [":AB:C", None, None]
    assert each(spark, ["12:AB:C", "12"], lambda c: T.first_match(c, P.LAST_COLON_PART)) == ["C", "12"]


@pytest.mark.parametrize(
    "pattern,hits,misses",
    [
        (P.INVALID_ID_CHARS, ["a]b", "a[b", "a~b", "a,b", "a^b", "a|b"], ["a-b", "a:b", "a/b", 'a"b']),
        (P.QUESTIONABLE_ID_CHARS, ["a\\b", "a/b", 'a"b', "a(b"], ["a-b", "a[b"]),
        (P.SPECIAL_CHARS, ["a'b", "a\\b", "a/b", "a!b", "a%b"], ["a-b", "a_b", "a b"]),
        (P.CONTROL_CHARS, ["a\tb", "a\x7fb", "a\nb"], ["a b", "caf\u00e9"]),
        (P.TRAILING_SPACE, ["a ", "a :b", "a: b", "a\t"], ["a b", " a", "a:b"]),
        (P.EIGHT_THREE_ID, ["12345678-123"], ["12345678-1234", "12345678-123\n", "x12345678-123"]),
        (P.DASH_REVISION, ["-", "--"], ["---", "a-", ""]),
        (P.UNC_PATH, ["\\\\srv\\x"], ["\\srv", "c:\\x"]),
        (P.SUBTYPE_LOV_NAME, ["ABC_Subtype_LOV", "Nov4ABC_Subtype_LOV"], ["AB_Subtype_LOV", "XNov4ABC_Subtype_LOV", "ABCxSubtype_LOV"]),
    ],
)
def test_patterns(spark, pattern, hits, misses):
    assert each(spark, hits, lambda c: T.matches(c, pattern)) == [True] * len(hits)
    assert each(spark, misses, lambda c: T.matches(c, pattern)) == [False] * len(misses)


def test_paths(spark):
    path = "\\\\Srv\\Share\\dir\\f.tar.gz"
    assert each(spark, [path], T.file_name) == ["F.TAR.GZ"]
    assert each(spark, [path, "nodot"], T.file_extension) == ["GZ", "NODOT"]
    assert each(spark, [path, "c:\\x"], T.server_share) == ["\\\\SRV\\SHARE", None]


def test_word_tokens_keep_dashes_in_words(spark):
    assert each(spark, ["JDE,RS-One", "SAP;JDE", None], T.word_tokens) == [["JDE", "RS_One"], ["SAP", "JDE"], None]


def test_decade_of_missing_date(spark):
    assert each(spark, [dt.date(1994, 1, 1), None], V.decade, "date") == ["1990s", "0s"]


def test_numbers_and_compares(spark):
    assert [None if v is None else float(v) for v in each(spark, ["5", "n/a", "-1.5", None], V.number)] == [5.0, None, -1.5, None]
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, None), (None, "none"), ("a", "a")], "a string, b string")
    assert [r[0] for r in df.select(V.differs("a", "b")).collect()] == [True, None, None, None, False]
    assert [r[0] for r in df.select(V.differs_null_safe("a", "b")).collect()] == [True, True, False, False, False]


def test_request_date(spark):
    now = F.lit(dt.datetime(2024, 1, 2, 3, 4, 5))
    values = ["01/31/2020 10:20:30", "2020-01-31", "", None]
    assert each(spark, values, lambda c: V.request_date(c, now)) == ["31-Jan-20 10:20:30", None, "02-Jan-24 03:04:05", "02-Jan-24 03:04:05"]


def test_header_names():
    assert T.header_names([" tc id ", "Rev Date"]) == ["TC_ID", "REV_DATE"]
