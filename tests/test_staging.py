import datetime as dt

import pytest

from conftest import rows
from sievemark.plans import extract as E
from sievemark.plans import staging as ST
from sievemark.sources import readers as RD
from sievemark.sources import sinks
from sievemark.streaming import dropfolder


def test_clean_chooses_the_rule_by_column_name(spark):
    df = spark.createDataFrame([(" a1 ", " x1 ", " mfg ", " keep ", "on hold", "")], "`tc id` string, PUID string, `Item status` string, name string, lifecycle string, width string")
    out = ST.clean(df)
    assert out.columns == ["TC_ID", "PUID", "ITEM_STATUS", "NAME", "LIFECYCLE", "WIDTH"]
    assert rows(out) == [("A1", " x1 ", "MFG", " keep ", "on hold", None)]
    assert ST.clean(df, lifecycle=True).first()["LIFECYCLE"] == "On Hold"
    assert ST.clean(spark.createDataFrame([("a b ",)], "WIDTH string")).first()[0] == "A B"
    assert ST.clean(spark.createDataFrame([("a b ",)], "width string"), keep=["WIDTH"]).first()[0] == "a b "


def test_clean_is_idempotent(spark):
    df = spark.createDataFrame([(" a1 ", "o'neil X", None)], "id string, status string, name string")
    once = ST.clean(df)
    assert rows(ST.clean(once)) == rows(once)


def test_dates_are_typed_all_or_nothing_and_widths_measured(spark):
    df = spark.createDataFrame(
        [("2020-01-31", "01/02/2020", "abc", None, None), ("02/01/2020 10:20:30", "soon", "a", None, None)],
        "REV_DATE string, DUE_DATE string, NAME string, NOTE string, LONG_DESCRIPTION string",
    )
    staged = ST.type_and_profile(df)
    assert staged.untyped_dates == ["DUE_DATE"]
    assert staged.widths == {"NAME": 8, "NOTE": 55, "LONG_DESCRIPTION": 555}
    assert sorted(r["REV_DATE"] for r in staged.df.collect()) == [dt.datetime(2020, 1, 31), dt.datetime(2020, 2, 1, 10, 20, 30)]


def test_stage_joins_or_unions_and_drops_equal_rows(spark):
    a = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "2")], "`tc id` string, n string")
    b = spark.createDataFrame([("A", "9")], "TC_ID string, m string")
    assert rows(ST.stage({"a": a, "b": b}, join_on=["tc id"]).df) == sorted([("A", "1", "9"), ("B", "2", None)], key=repr)
    union = ST.stage([a, b])
    assert union.df.columns == ["TC_ID", "N", "M"]
    assert len(rows(union.df)) == 3
    assert len(rows(ST.stage([a], dedup=False).df)) == 3
    assert rows(ST.stage([a], clean_up=False).df) == [("a", "1"), ("b", "2")]


def test_conventions():
    assert list(ST.expected_columns("load")) == ["docload", "itemload", "bomload", "relationload"]
    assert ST.expected_columns("namedesc") == {"namedesc": ["tc_id", "name1", "name2", "description"]}
    assert len(ST.expected_columns("all")) == 10
    assert ST.contract("itemload")["REV_CREATION_DATE"].dataType.typeName() == "timestamp"


class DatabaseError(RuntimeError):
    def __init__(self, code, text):
        super().__init__(f"ORA-{code:05d}: {text}")
        self.code = code


def sites(spark, **failures):
    """Sites that fail as often as told, then answer."""
    def reader(site, data):
        def read():
            if failures.get(site):
                raise failures[site].pop(0)
            return spark.createDataFrame(data, "k int, v string")

        return read

    return {s: reader(s, [(1, "all"), (i + 2, s)]) for i, s in enumerate([*E.ALL_SITES, "houprod"])}


def test_extract_merges_sites_and_equal_rows_once(spark):
    got = E.extract(spark, sites(spark))
    assert rows(got.df) == [(1, "all")] + [(i + 2, s) for i, s in enumerate(E.ALL_SITES)]
    back = E.extract(spark, sites(spark), sites=list(reversed(E.ALL_SITES)))
    assert rows(back.df) == rows(got.df)
    assert [r[1] for r in E.extract(spark, sites(spark), sites="nor").status.collect()] == ["nor"]


def test_extract_skips_retries_and_falls_back(spark):
    e = lambda code=942: DatabaseError(code, "no table")
    got = E.extract(spark, sites(spark, fra=[e()], houstby=[DatabaseError(16000, "open for read-only access")]))
    state = {r["site"]: r["status"] for r in got.status.collect()}
    assert state == {"edm": "ok", "fra": "failed", "houstby": "replaced", "nor": "ok", "sha": "ok", "houprod": "ok"}
    got = E.extract(spark, sites(spark, fra=[e(3254), e(3254)], nor=[e(3254)]), retry=2, retry_on=[3254])
    state = {r["site"]: (r["status"], r["attempts"]) for r in got.status.collect()}
    assert state["fra"] == ("ok", 3) and state["nor"] == ("failed", 1)  # the budget is shared
    assert {r["site"]: r["status"] for r in E.extract(spark, sites(spark), sites=["edm", "moon"]).status.collect()} == {"edm": "ok", "moon": "invalid"}
    with pytest.raises(E.ExtractFailed):
        E.extract(spark, sites(spark, fra=[e()]), strict=True)
    with pytest.raises(E.ExtractFailed):
        E.extract(spark, sites(spark, fra=[e()]), sites="fra")


def test_record_file_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "r.csv").write_text("﻿ItemID,NAME\n a ,\n,\"x,\"\"y\"\n", encoding="utf-8")
    assert sorted(rows(RD.read_records(spark, str(tmp_path / "r.csv"))), key=repr) == sorted([(" a ", None), (None, 'x,"y')], key=repr)
    assert RD.read_records(spark, str(tmp_path / "r.csv")).columns == ["itemid", "name"]


def test_input_lines_have_heading_crlf_and_no_quotes(spark, tmp_path):
    df = spark.createDataFrame([('a"b,c|d',), ("x",)], "inp string").coalesce(1)
    assert sinks.write_input_lines(df, str(tmp_path / "o")) == "text"
    (file,) = (tmp_path / "o").glob("part-*")
    assert file.read_bytes() == b'INPUT\r\na"b,c|d\r\nx\r\n'
    assert sinks.write_input_lines(spark.createDataFrame([("a", "b")], "x string, y string"), str(tmp_path / "w")) == "csv"


def test_table_sink_modes(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    sinks.write_target(df, "sink_modes")
    sinks.write_target(df.select("v", "k"), "sink_modes", "append")
    assert rows(spark.table("sink_modes")) == [(1, "a"), (1, "a")]
    sinks.write_target(spark.createDataFrame([(5,)], "k int"), "sink_modes", "delete")
    assert rows(spark.table("sink_modes")) == [(5, None)]
    with pytest.raises(ValueError):
        sinks.write_target(df, "sink_modes", "merge")
    spark.sql("drop table sink_modes")


def test_drop_folder_loads_each_file_once_and_each_row_once(spark, tmp_path):
    folder, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    run = lambda: dropfolder.load_folder(spark, folder, "id string, v string", out, state, header="true")
    (tmp_path / "in" / "a.csv").write_text("id,v\na,1\na,1\nb,\n")
    run()
    (tmp_path / "in" / "b.csv").write_text("id,v\nA ,1\nc,2\n")
    run()
    run()
    assert rows(dropfolder.loaded(spark, out)) == sorted([("A", "1"), ("B", None), ("C", "2")], key=repr)
    # A batch that runs again replaces what it wrote.
    dropfolder.append_new_rows(spark.createDataFrame([("A", "1"), ("D", "3")], "ID string, V string"), 1, out)
    assert rows(dropfolder.loaded(spark, out)) == sorted([("A", "1"), ("B", None), ("D", "3")], key=repr)


def test_newest_file(spark, tmp_path):
    import os

    for name, when in (("old", 1000), ("new", 2000)):
        (tmp_path / f"{name}.csv").write_text(f"v\n{name}\n")
        os.utime(tmp_path / f"{name}.csv", (when, when))
    assert rows(RD.newest_file(spark, str(tmp_path))) == [("new",)]


def test_inputs_by_name_or_position(spark, tmp_path):
    for n in "ab":
        (tmp_path / f"{n}.csv").write_text(f"x\n{n}\n")
    paths = {n: str(tmp_path / f"{n}.csv") for n in "ab"}
    assert list(RD.read_inputs(spark, paths)) == ["a", "b"]
    assert rows(RD.read_inputs(spark, paths, names=[1])["b"]) == [("b",)]
