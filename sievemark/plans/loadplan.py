"""Planning a load: per record create, add a revision, skip or fail; requests and responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions import text as T
from sievemark.functions import values as V
from sievemark.operators.keyed import join_key_statistic, other_keys, same_keys

# Record fields of a part and of a document file.
PART_FIELDS = (
    "itemid", "name", "description", "revision", "item_type", "rsone_itemtype", "rsone_uom", "rsone_uow",
    "rev_weight", "name2", "part_sub_type", "lifecycle", "rev_status", "rev_sites", "rev_comments", "uom",
    "nov4_mis_type", "nov4_mis_serialize", "nov4_height", "nov4_length", "nov4_width", "nov4_lwhunits", "nov4_volume",
    "nov4_volunits", "nov4_weight", "nov4_weightunits", "date_created", "date_released",
)
DOCUMENT_FIELDS = (
    "itemid", "name", "description", "revision", "item_type", "doc_category", "doc_type", "sequence", "sheet_no",
    "publish_toweb", "publish_topp", "pull_drawing", "ds_path", "ds_name", "rev_sites", "lifecycle", "rev_status",
    "rev_comments", "date_created", "date_released",
)
FIELDS = {"part": PART_FIELDS, "document": DOCUMENT_FIELDS}

DOCUMENT_TYPE, PART_TYPE = "Documents", "Nov4Part"
DEFAULT_REVISION = "01"

# Dataset type of each file extension; other extensions are MISC.
DATASET_TYPES = {
    "doc": "MSWord", "ppt": "MSPowerPoint", "xls": "MSExcel", "csv": "MSExcel", "dwg": "ACADDWG", "vsd": "MSVisio",
    "idw": "INVENTOR", "pdf": "PDF", "zip": "Zip", "mpg": "Mpeg", "txt": "Text", "xpi": "Text", "xpr": "Text",
    "cnr": "Text", "cns": "Text", "dat": "Text", "ncf": "Text", "hd3": "Text", "min": "Text", "cnc": "Text", "vnc": "Text",
    "htm": "HTML", "html": "HTML", "xml": "XML", "tif": "Image", "tiff": "Image", "jpg": "Image", "jpeg": "Image",
    "gif": "Image", "bmp": "Image", "wmv": "WMV", "mov": "Quicktime", "rtf": "MSWord", "plt": "Plot_File", "dxf": "DXF",
    "sch": "PCADSCH", "pcb": "PCADPCB", "sat": "sat", "docx": "MSWord", "xlsx": "MSExcel", "pptx": "MSPowerPoint",
    "wmf": "ACADDWG", "pds": "Photoshop", "mdb": "MSAccess", "msg": "Email", "avi": "Image", "png": "Image",
    "pptm": "MSPowerPoint", "pps": "MSPowerPoint", "xlsm": "MSExcel", "ext": "Reference", "btw": "Nov4BTW", "gp4": "Nov4GP4",
}
OTHER_DATASET = "MISC"

# Request keys, the record field behind each and the text sent for a blank one.
REQUESTS = {
    "create_part": (
        "addPartItem",
        [
            ("ITEMID", "itemid", "null"), ("ITEMNAME", "name", "null"), ("ITEMDESC", "description", "null"), ("REVISION", "revision", "01"),
            ("RSONE_ITEMTYPE", "item_type", "null"), ("RSONE_UOM", "rsone_uom", "null"), ("RSONE_UOW", "rsone_uow", "null"),
            ("REV_WEIGHT", "rev_weight", "null"), ("NAME2", "name2", "null"), ("PARTSUBTYPE", "part_sub_type", "null"),
            ("LIFECYCLE", "lifecycle", "null"), ("SITES", "rev_sites", "null"), ("REVCOMMENTS", "rev_comments", "null"), ("ITEM_UOM", "uom", "null"),
            ("NOV4_MIS_TYPE", "nov4_mis_type", "null"), ("NOV4_MIS_SERIALIZE", "nov4_mis_serialize", "null"), ("NOV4_HEIGHT", "nov4_height", "null"),
            ("NOV4_LENGTH", "nov4_length", "null"), ("NOV4_WIDTH", "nov4_width", "null"), ("NOV4_LWH_UNITS", "nov4_lwhunits", "null"),
            ("NOV4_VOLUME", "nov4_volume", "null"), ("NOV4_VOL_UNITS", "nov4_volunits", "null"), ("NOV4_WEIGHT", "nov4_weight", "null"),
            ("NOV4_WGT_UNITS", "nov4_weightunits", "null"), ("DATE", "date_created", "null"),
        ],
    ),
    "create_document": (
        "addDocumentsItem",
        [
            ("ITEMTYPE", "doc_type", "null"), ("ITEMID", "itemid", "null"), ("ITEMNAME", "name", "itemid"), ("ITEMDESC", "description", "null"),
            ("CATEGORY", "doc_category", "null"), ("REVISION", "revision", "01"), ("SEQNO", "sequence", "001"), ("SHEET", "sheet_no", "null"),
            ("PUBLISHWEB", "publish_toweb", "false"), ("PUBLISHPP", "publish_topp", "false"), ("PULLDRAWING", "pull_drawing", "false"),
            ("LIFECYCLE", "lifecycle", "null"), ("SITES", "rev_sites", "null"), ("REVCOMMENTS", "rev_comments", "null"), ("DATE", "date_created", "null"),
        ],
    ),
    "add_revision": (
        "addRevision",
        [
            ("ITEMID", "itemid", "null"), ("REVISION", "revision", "01"), ("REV_WEIGHT", "rev_weight", "null"), ("LIFECYCLE", "lifecycle", "null"),
            ("SITES", "rev_sites", "null"), ("REVCOMMENTS", "rev_comments", "null"), ("NAME2", "name2", "null"), ("NOV4_HEIGHT", "nov4_height", "null"),
            ("NOV4_LENGTH", "nov4_length", "null"), ("NOV4_WIDTH", "nov4_width", "null"), ("NOV4_LWH_UNITS", "nov4_lwhunits", "null"),
            ("NOV4_VOLUME", "nov4_volume", "null"), ("NOV4_VOL_UNITS", "nov4_volunits", "null"), ("NOV4_WEIGHT", "nov4_weight", "null"),
            ("NOV4_WGT_UNITS", "nov4_weightunits", "null"), ("DATE", "date_created", "null"),
        ],
    ),
    "release": (
        "releaseRevision",
        [("ITEMID", "itemid", "null"), ("REVISION", "revision", "01"), ("RELEASESTATUS", "rev_status", "null"), ("RELEASEDATE", "date_released", "null")],
    ),
    "delete": ("deleteItem", [("ITEMID", "itemid", "null")]),
}

# Response keys by the word they contain; the first class that fits a key counts.
RESPONSE_KEYS = (
    "SUCCESS", "FAILED", "PUID", "ITEMID", "REVISION", "ISRELEASED", "TYPE", "PRIMARY_OBJECTU", "SECONDARY_OBJECTU", "ERROR",
)


def invalid_columns(df: DataFrame, kind: str) -> list[str]:
    """Columns that are no record field of the kind."""
    return [c for c in df.columns if c.lower() not in FIELDS[kind]]


def filled_invalid_fields(df: DataFrame, kind: str) -> DataFrame:
    """(field, filled): each column that is no record field, with the number of rows that have a value in it."""
    bad = invalid_columns(df, kind)
    if not bad:
        return df.select(F.lit("").alias("field"), F.lit(0).cast("bigint").alias("filled")).limit(0)
    counts = df.agg(*[F.count(c).alias(c) for c in bad])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("filled")) for c in bad])).alias("f")).select("f.*")


def with_fields(rec: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Missing fields added as NULL, blanks as NULL."""
    have = {c.lower() for c in rec.columns}
    out = rec.withColumns({f: F.lit(None).cast("string") for f in fields if f not in have})
    return out.withColumns({f: T.null_if_blank(F.col(f)) for f in fields})


def file_extension(path: Column | str) -> Column:
    """Extension in small letters, NULL without one; a leading dot starts no extension."""
    name = F.regexp_substr(F.trim(T._col(path)), F.lit(r"[^\\/]+\z"))
    return F.lower(T.null_if_blank(F.regexp_extract(F.regexp_replace(name, r"^\.+", ""), r"\.([^.]*)\z", 1)))


def dataset_type(path: Column | str) -> Column:
    """Dataset type of a file path by extension, NULL where the path has none."""
    ext = file_extension(path)
    pairs = [F.lit(x) for pair in DATASET_TYPES.items() for x in pair]
    return F.when(ext.isNotNull(), F.coalesce(F.create_map(*pairs)[ext], F.lit(OTHER_DATASET)))


def plan_load(rec: DataFrame, items: DataFrame, revisions: DataFrame, position: str = "position", now: Column | None = None) -> DataFrame:
    """Action per record, as if the records were loaded one by one in file order.

    ``items`` has the existing ``itemid``, ``revisions`` the existing ``itemid`` and ``revision``. The
    first record of a new item that can create it does; records of the item before it fail, later ones
    add revisions. A revision that exists, also from an earlier record, fails.
    """
    rec = with_fields(rec, ["itemid", "revision", "item_type", "ds_path", "date_created", "date_released"])
    columns = rec.columns
    rows = rec.select(
        *[c for c in columns if c not in ("revision", "item_type", "date_created", "date_released")],
        T.default_text("revision", DEFAULT_REVISION).alias("revision"),
        T.default_text("item_type", DOCUMENT_TYPE).alias("item_type"),
        V.request_date("date_created", now).alias("date_created"),
        V.request_date("date_released", now).alias("date_released"),
    )
    dated = F.col("date_created").isNotNull() & F.col("date_released").isNotNull()
    can_create = F.col("item_type").isin(DOCUMENT_TYPE, PART_TYPE)
    known = other_keys(items.select("itemid", F.lit(True).alias("_known")).distinct(), ["itemid"])
    per_item = rows.groupBy("itemid").agg(
        F.count("*").alias("_item_rows"), F.min(F.when(dated & can_create, F.col(position))).alias("_first")
    )
    per_item = per_item.join(known, same_keys(["itemid"]), "left").select("itemid", "_item_rows", "_first", "_known")
    rows = join_key_statistic(rows, per_item, ["itemid"], "_item_rows")
    exists = F.coalesce("_known", F.lit(False))
    creates = ~exists & F.coalesce(F.col(position) == F.col("_first"), F.lit(False))
    open_item = dated & (exists | F.coalesce(F.col(position) >= F.col("_first"), F.lit(False)))
    had = other_keys(revisions.select("itemid", "revision", F.lit(True).alias("_had")).distinct(), ["itemid", "revision"])
    per_rev = rows.groupBy("itemid", "revision").agg(
        F.count("*").alias("_rev_rows"), F.min(F.when(open_item, F.col(position))).alias("_rev_first"), F.max(exists).alias("_exists")
    )
    per_rev = per_rev.join(had, same_keys(["itemid", "revision"]), "left")
    per_rev = per_rev.select("itemid", "revision", "_rev_rows", "_rev_first", (F.col("_exists") & F.coalesce("_had", F.lit(False))).alias("_had"))
    rows = join_key_statistic(rows, per_rev, ["itemid", "revision"], "_rev_rows")
    repeated = F.col("_had") | (F.col(position) > F.col("_rev_first"))
    action = (
        F.when(~dated, "fail")
        .when(creates & (F.col("item_type") == DOCUMENT_TYPE), "create_document")
        .when(creates, "create_part")
        .when(~open_item | repeated, "fail")
        .otherwise("add_revision")
    )
    message = (
        F.when(~dated, "date cannot be read")
        .when(creates, F.lit(None))
        .when(~open_item, F.concat(F.lit("item has an unsupported type ("), "item_type", F.lit(")")))
        .when(repeated, "item revision already exists, skipping")
    )
    planned = rows.select(*[c for c in columns], action.alias("action"), message.alias("message"), F.when(~exists & ~creates, F.col("_first")).alias("depends_on"))
    wants = F.col("action").isin("create_document", "add_revision") & (F.col("item_type") == DOCUMENT_TYPE) & F.col("ds_path").isNotNull()
    kind = dataset_type("ds_path")
    return planned.withColumns(
        {
            "dataset_type": F.when(wants, kind),
            "dataset_message": F.when(wants & kind.isNull(), "invalid file extension"),
            "relate": F.coalesce(wants & kind.isNotNull(), F.lit(False)),
            "depends_on": F.when(F.col("action") == "add_revision", F.col("depends_on")),
        }
    )


def plan_delete(rec: DataFrame) -> DataFrame:
    """One delete per item."""
    return rec.select("itemid").distinct().select("itemid", F.lit("delete").alias("action"))


def plan_release(rec: DataFrame, revisions: DataFrame, position: str = "position", now: Column | None = None) -> DataFrame:
    """One release per item revision unless it is released already; status and date of its first record.

    ``revisions`` has ``itemid``, ``revision`` and the flag ``released``.
    """
    rec = with_fields(rec, ["itemid", "revision", "rev_status", "date_created", "date_released"])
    dated = rec.select(
        "itemid",
        T.default_text("revision", DEFAULT_REVISION).alias("revision"),
        T.default_text("rev_status", "null").alias("rev_status"),
        V.request_date("date_released", now).alias("date_released"),
        V.request_date("date_created", now).alias("date_created"),
        position,
    ).filter(F.col("date_released").isNotNull() & F.col("date_created").isNotNull())
    first = dated.groupBy("itemid", "revision").agg(F.min_by(F.struct("rev_status", "date_released"), position).alias("_first"))
    state = revisions.groupBy(F.col("itemid").alias("_r_itemid"), F.col("revision").alias("_r_revision")).agg(F.max("released").alias("_released"))
    rows = first.join(state, same_keys(["itemid", "revision"]), "left")
    released = F.coalesce("_released", F.lit(False))
    return rows.select(
        "itemid",
        "revision",
        F.col("_first.rev_status").alias("rev_status"),
        F.col("_first.date_released").alias("date_released"),
        F.when(released, "fail").otherwise("release").alias("action"),
        F.when(released, "item revision already released").alias("message"),
    )


def _request(action: str, have: set[str]) -> Column:
    function, fields = REQUESTS[action]

    def value(field: str, default: str) -> Column:
        fallback = F.coalesce(T.null_if_blank(F.col("itemid")), F.lit("null")) if default == "itemid" else F.lit(default)
        return T.default_text(F.col(field), fallback) if field in have else fallback

    words = [F.concat(F.lit(f"{key} "), value(field, default)) for key, field, default in fields]
    line = F.concat_ws("\t", F.lit(f"FUNCTION {function}"), *words)
    # Texts of new items are sent on one line.
    return F.replace(line, F.lit("\n"), F.lit("")) if action.startswith("create") else line


def _dataset_request(have: set[str]) -> Column:
    name = F.split_part("itemid", F.lit(":"), F.lit(1))
    name = T.default_text("ds_name", name) if "ds_name" in have else name
    about = T.default_text("description", "null") if "description" in have else F.lit("null")
    words = [("DATASETNAME", name), ("DATASETTYPE", F.col("dataset_type")), ("ITEMDESC", about), ("FILENAME", T.default_text("ds_path", "null"))]
    return F.concat_ws("\t", F.lit("FUNCTION addSimpleDataset"), *[F.concat(F.lit(f"{k} "), v) for k, v in words])


def render_requests(plan: DataFrame) -> DataFrame:
    """The plan with the request text of its action and, where one is due, of its dataset."""
    have = {c.lower() for c in plan.columns}
    request = F.lit(None).cast("string")
    for action in REQUESTS:
        request = F.when(F.col("action") == action, _request(action, have)).otherwise(request)
    out = plan.withColumn("request", request)
    if "dataset_type" in have:
        out = out.withColumn("dataset_request", F.when(F.col("dataset_type").isNotNull(), _dataset_request(have)))
    return out


def relation_request(primary: Column, secondary: Column, kind: str = "IMAN_specification") -> Column:
    return F.concat_ws(
        "\t", F.lit("FUNCTION createRelationship"), F.concat(F.lit("FROMPUID "), primary), F.concat(F.lit("TOPUID "), secondary), F.lit(f"RELATION {kind}")
    )


def parse_responses(lines: DataFrame, col: str = "value") -> DataFrame:
    """Fields of key/value response lines; of several words of one class the last one counts."""

    def word(w: Column) -> Column:
        tokens = F.split(T.strip(w), r"\s+")
        key = F.upper(F.get(tokens, F.lit(0)))
        kind = F.lit(None).cast("string")
        for k in reversed(RESPONSE_KEYS):
            kind = F.when(key.contains(k), F.lit(k)).otherwise(kind)
        return F.struct(kind.alias("kind"), F.array_join(F.slice(tokens, 2, F.size(tokens)), " ").alias("value"))

    words = F.transform(F.split(col, "\t"), word)

    def last(*kinds: str) -> Column:
        hits = F.filter("_words", lambda w: w["kind"].isin(*kinds))
        return F.get(hits, F.size(hits) - 1)

    parsed = lines.withColumn("_words", words)
    named = {
        "puid": "PUID", "itemid": "ITEMID", "revid": "REVISION", "itemtype": "TYPE",
        "primary_obj": "PRIMARY_OBJECTU", "secondary_obj": "SECONDARY_OBJECTU", "err_msg": "ERROR",
    }
    return parsed.select(
        *lines.columns,
        (last("SUCCESS", "FAILED")["kind"] == "SUCCESS").alias("ok"),
        (last("ISRELEASED")["value"] == "true").alias("released"),
        *[last(kind)["value"].alias(name) for name, kind in named.items()],
    )
