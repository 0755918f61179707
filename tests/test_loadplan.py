import datetime as dt
import random


from sievemark.operators import keyed as N
from sievemark.plans import datasets as D
from sievemark.plans import loadplan as LP
from sievemark.sources import readers as RD

NOW = dt.datetime(2024, 1, 1)


def one_by_one(records, items, revisions):
    """The records loaded in order against a growing system."""
    items, revisions, out = set(items), set(revisions), []
    for r in records:
        item, rev, kind = r["itemid"], r["revision"] or "01", r["item_type"] or "Documents"
        if r["date_created"] == "bad":
            action = "fail"
        elif item in items:
            action = "fail" if (item, rev) in revisions else "add_revision"
        else:
            action = {"Documents": "create_document", "Nov4Part": "create_part"}.get(kind, "fail")
        if action != "fail":
            items.add(item)
            revisions.add((item, rev))
        out.append((r["position"], action))
    return sorted(out)


def make(rnd, n):
    return [
        {
            "position": i,
            "itemid": "HOT" if rnd.random() < 0.33 else f"i{rnd.randrange(25)}",
            "revision": rnd.choice(["01", "02", "03", "", None]),
            "item_type": rnd.choice(["Documents", "Nov4Part", "Tool", "", None]),
            "ds_path": rnd.choice([None, "x.pdf", "x"]),
            "date_created": rnd.choice(["01/31/2020 10:20:30", "", "bad"]),
        }
        for i in range(n)
    ]


def test_plan_equals_sequential_load(spark, monkeypatch):
    monkeypatch.setattr(N, "PIECE_ROWS", 20)
    rnd = random.Random(11)
    records = make(rnd, 300)
    items = [f"i{k}" for k in range(0, 25, 3)]
    revisions = [(i, "02") for i in items]
    schema = "position int, itemid string, revision string, item_type string, ds_path string, date_created string"
    rec = spark.createDataFrame([tuple(r.values()) for r in records], schema).repartition(4)
    plan = LP.plan_load(
        rec, spark.createDataFrame([(i,) for i in items], "itemid string"), spark.createDataFrame(revisions, "itemid string, revision string"), now=NOW
    )
    got = plan.collect()
    assert sorted((r["position"], r["action"]) for r in got) == one_by_one(records, items, revisions)
    for r in got:
        is_document = r["action"] in ("create_document", "add_revision") and (r["item_type"] or "Documents") == "Documents"
        assert r["relate"] == (is_document and r["ds_path"] == "x.pdf")
        assert r["dataset_message"] == ("invalid file extension" if is_document and r["ds_path"] == "x" else None)
        assert (r["message"] is None) == (r["action"] != "fail")


def test_later_rows_of_a_new_item_name_their_creator(spark):
    rec = spark.createDataFrame([(1, "a", "Tool", "01"), (2, "a", "Nov4Part", "01"), (3, "a", "Tool", "02")], "position int, itemid string, item_type string, revision string")
    none = spark.createDataFrame([], "itemid string, revision string")
    got = {r["position"]: (r["action"], r["depends_on"]) for r in LP.plan_load(rec, none, none, now=NOW).collect()}
    assert got == {1: ("fail", None), 2: ("create_part", None), 3: ("add_revision", 2)}


def test_release_and_delete_take_each_key_once(spark):
    rec = spark.createDataFrame([(1, "a", "01", "R1"), (2, "a", "01", "R2"), (3, "b", "01", ""), (4, "b", None, "R4")], "position int, itemid string, revision string, rev_status string")
    state = spark.createDataFrame([("b", "01", True)], "itemid string, revision string, released boolean")
    got = sorted((r["itemid"], r["revision"], r["rev_status"], r["action"]) for r in LP.plan_release(rec, state, now=NOW).collect())
    assert got == [("a", "01", "R1", "release"), ("b", "01", "null", "fail")]
    assert sorted(r["itemid"] for r in LP.plan_delete(rec).collect()) == ["a", "b"]


def test_requests_fill_defaults_and_stay_on_one_line(spark):
    plan = spark.createDataFrame([("d:1", None, "two\nlines", "create_document", "PDF", "c:\\f.pdf")], "itemid string, name string, description string, action string, dataset_type string, ds_path string")
    row = LP.render_requests(plan).first()
    assert row["request"].startswith("FUNCTION addDocumentsItem\tITEMTYPE null\tITEMID d:1\tITEMNAME d:1\tITEMDESC twolines\tCATEGORY null\tREVISION 01\tSEQNO 001")
    assert row["dataset_request"].split("\t")[1:3] == ["DATASETNAME d", "DATASETTYPE PDF"]


def test_dataset_types(spark):
    paths = ["a.PDF", "\\\\s\\x.y\\noext", "a.b.docx", "a.zzz", "a.", ".pdf"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string")
    got = [r[0] for r in df.orderBy("i").select(LP.dataset_type("p")).collect()]
    assert got == ["PDF", None, "MSWord", "MISC", None, None]


def test_responses(spark):
    lines = ["Success\tPUID abc\tITEMTYPE Part X\tISRELEASED true", "FAILED\tERROR no such item", "x\tPUID a\tPUID b"]
    got = LP.parse_responses(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert (got[0]["ok"], got[0]["puid"], got[0]["itemtype"], got[0]["released"], got[0]["err_msg"]) == (True, "abc", "Part X", True, None)
    assert (got[1]["ok"], got[1]["err_msg"], got[1]["released"]) == (False, "no such item", None)
    assert (got[2]["ok"], got[2]["puid"]) == (None, "b")


def test_invalid_columns_are_checked_per_kind(spark):
    df = spark.createDataFrame([("a", "b", "c")], "ItemId string, nov4_width string, ds_path string")
    assert LP.invalid_columns(df, "part") == ["ds_path"]
    assert LP.invalid_columns(df, "document") == ["nov4_width"]


def test_conversion_match_and_log(spark):
    lines = ["51|03|51|ACADDWG|5 1.dwg|51-T|TRUE|model", "51|03|51|PDF|5 1.dwg|51-T|TRUE|model", "52|01|52|PDF|x.pdf", "53|01"]
    rec = RD.conversion_records(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert rec.first()["file_name"] == "5_1.dwg" and rec.first()["layout"] == "MODEL"
    file = lambda n, p: (n, p)
    ds = ("51", "ACADDWG", "51", "03", ([file("no", "p0"), file("5_1.dwg", "p1"), file("5_1.dwg", "p2")],))
    services = spark.createDataFrame([("51", "03", None, ([ds],), None), ("52", "01", "Bad", (None,), [("e1",), ("e2",)])], D.SERVICE_SCHEMA)
    got = {(r["itemID"], r["ds_type"]): (r["ds_puid"], r["message"]) for r in D.match_datasets(rec, services).collect()}
    assert got == {("51", "ACADDWG"): ("p1", None), ("51", "PDF"): (None, D.NO_FILE), ("52", "PDF"): (None, "e1;e2"), ("53", None): (None, None)}
    logs = {r["log"]: r["status"] for r in D.conversion_log(D.match_datasets(rec, services)).collect()}
    assert logs["53|01|Error: None"] == "fail"
    assert "51|03|51|ACADDWG|5_1.dwg|51-T|true|MODEL|p1|Info: Created" in logs
