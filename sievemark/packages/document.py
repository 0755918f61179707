"""Document load checks."""

from pyspark.sql import functions as F

from sievemark.functions import patterns as P
from sievemark.functions import text as T
from sievemark.operators import keyed as N
from sievemark.operators import parts as R
from sievemark.operators import paths as K
from sievemark.operators import reference as S
from sievemark.packages.item import owning_group, status_updates, text_updates
from sievemark.plans.check import INFO, ISSUE, Check, Context, Package


def in_warehouse(c: Context):
    ids = c.chk.select("doc_id").distinct()
    dw = K.master(c.refs)
    return ids.join(dw, T.id_key("doc_id") == F.col("dw_key")).select(*[F.col(x).alias(x[3:]) for x in dw.columns if x != "dw_key"])


def existing_revisions(c: Context):
    joined = c.chk.join(K.master(c.refs), T.id_key("doc_id") == F.col("dw_key"))
    return joined.join(K.revisions(c.refs), F.col("dw_puid") == F.col("rev_item"))


def duplicate_files(c: Context):
    rows = c.chk.select("doc_id", "revision", F.upper("path_location").alias("path_location"), T.file_name("path_location").alias("filename"))
    return N.duplicate_rows(rows, [T.id_key("doc_id"), T.id_key("revision"), F.trim("filename")], counted=F.col("filename"))


def same_path(c: Context):
    rows = c.chk.select("path_location", "doc_id", "revision")
    # Rows without a path share no key with others, so they can go before the count.
    return N.duplicate_rows(rows, [F.upper("path_location"), "revision"], where=F.col("path_location").isNotNull())


def dataset_file_exists(c: Context):
    names = K.item_names(c.refs)
    files = (
        K.revisions(c.refs)
        .join(K.dataset_files(c.refs), F.col("rev_puid") == F.col("files_rev"))
        .join(names, F.col("rev_item") == F.col("named_puid"))
    )
    joined = c.chk.join(files, (F.col("doc_id") == F.col("named_id")) & (F.col("revision") == F.col("rev_id")))
    return joined.select(
        F.col("named_id").alias("pitem_id"),
        F.col("rev_id").alias("pitem_revision_id"),
        "dataset_name_current",
        "dataset_namedref_current",
        T.file_name("path_location").alias("file_given"),
        F.upper("path_location").alias("file_path_location_given"),
    ).distinct()


_DETAIL = ["doc_id", "document_category", "document_type", "name", "description"]
_PATH = ["doc_id", "revision", "path_location"]

CHECKS = [
    Check("B01", INFO, "Count Total Rows", lambda c: R.row_count(), summary=True),
    Check("B02", INFO, "Count Total Items", lambda c: R.distinct_count(cnt="doc_id"), summary=True),
    Check("B03", INFO, "Item Staged Twice", lambda c: N.duplicate_rows(c.chk, [T.id_key("doc_id"), T.id_key("revision"), T.id_key("path_location")], "dup_count", distinct=True), ["doc_id"]),
    Check("B04", ISSUE, "Item Exist in Warehouse", in_warehouse),
    Check("B05", ISSUE, "Item Exist in Product System", lambda c: S.count_existing(c.chk, "doc_id", K.items(c.refs, local=True), "item_key"), summary=True),
    Check("B06", INFO, "Item ID Suffix", lambda c: R.suffix_frequency("doc_id", "NULL"), summary=True),
    Check("B07", INFO, "Duplicate Suffix", lambda c: R.pattern_rows("doc_id", ["doc_id"], like="%:%:%", distinct=True)),
    Check("B08", INFO, "Item with no Suffix", lambda c: R.pattern_rows("doc_id", ["doc_id"], like="%:%", negate=True, distinct=True)),
    Check("B09", INFO, "Docs with multiple REVs", lambda c: N.multi_value_keys(c.chk, "doc_id", "revision", "doc_id", "rev_count"), ["-rev_count"], summary=True),
    Check("B10", ISSUE, "Revisions with Same Creation Date", lambda c: N.versions_same_date(c.chk, "doc_id", "rev_creation_date", "revision"), ["doc_id"]),
    Check("B11", ISSUE, "REV is null", lambda c: R.null_rows("revision", ["doc_id", "revision"])),
    Check("B12", INFO, "Revisions", lambda c: R.value_frequency("revision"), ["revision"], summary=True),
    Check("B13", INFO, "Odd Revision ID", lambda c: R.odd_revision("doc_id")),
    Check("B14", ISSUE, "ID Length Greater Than 64 Chars", lambda c: R.too_long("doc_id", 64)),
    Check("B15", INFO, "Spaces in ID", lambda c: R.pattern_rows("doc_id", ["doc_id"], P.WHITESPACE)),
    Check("B16", INFO, "Leading Non-AlphaNumeric Char in ID", lambda c: R.pattern_rows("doc_id", ["doc_id"], P.LEADING_ALNUM, negate=True)),
    Check("B17", INFO, "ID with Trailing Space", lambda c: R.pattern_rows("doc_id", ["doc_id"], P.TRAILING_SPACE)),
    Check("B18", INFO, "ID with Invalid Characters", lambda c: R.pattern_rows("doc_id", ["doc_id"], P.INVALID_ID_CHARS)),
    Check("B19", INFO, "ID with Questionable Characters", lambda c: R.pattern_rows("doc_id", ["doc_id"], P.QUESTIONABLE_ID_CHARS)),
    Check("B20", ISSUE, "Item Name is Null", lambda c: R.null_rows("name", ["doc_id", "name", "description"])),
    Check("B21", INFO, "Item Name Length Greater than 64 chars", lambda c: R.too_long("name", 64, ["doc_id", "name"]), ["-length"]),
    Check("B22", INFO, "Item Name Length Greater than 30 chars (JDE)", lambda c: R.too_long("name", 30, ["doc_id", "name"]), ["-length"]),
    Check("B23", INFO, "Item Name Non-ASCII", lambda c: R.non_ascii("name", ["doc_id"])),
    Check("B24", ISSUE, "Item Name has Control Chars", lambda c: R.control_chars("name", '"CTRL"', ["doc_id"])),
    Check("B25", INFO, "Item Desc is Null", lambda c: R.null_rows("description", ["doc_id", "description", "name"])),
    Check("B26", INFO, "Item Desc > 240", lambda c: R.too_long("description", 240, ["doc_id", "description"])),
    Check("B27", INFO, "Item Desc has pipe", lambda c: R.pattern_rows("description", ["doc_id", "description"], P.PIPE)),
    Check("B28", ISSUE, "Item Desc has Control Chars", lambda c: R.control_chars("description", '"CTRL"', ["doc_id"])),
    Check("B29", ISSUE, "Doc Category is Null", lambda c: R.null_rows("document_category", _DETAIL)),
    Check("B30", ISSUE, "Doc Type is Null", lambda c: R.null_rows("document_type", _DETAIL)),
    Check("B31", ISSUE, "Doc with Multiple Types", lambda c: N.multi_value_rows(c.chk, [T.id_key("doc_id")], "document_type", [T.id_key("doc_id").alias("tc_id"), "document_type"])),
    Check("B32", ISSUE, "Invalid Doc Type", lambda c: S.not_in_lov(c.chk, {"document_category": "lov_category", "document_type": "lov_type"}, K.document_types(c.refs), "doc_id"), ["document_category", "document_type"], summary=True),
    Check("B33", INFO, "Release Date is Null", lambda c: R.null_count("rev_release_date", "count"), summary=True),
    Check("B34", INFO, "Creation Date is Null", lambda c: R.null_count("rev_creation_date", "count"), summary=True),
    Check("B35", INFO, "Release Dates", lambda c: R.decade_histogram("rev_release_date"), ["decade"]),
    Check("B36", INFO, "Creation Dates", lambda c: R.decade_histogram("rev_creation_date"), ["decade"]),
    Check("B37", INFO, "Owning Group", owning_group, ["-cnt"], summary=True),
    Check("B38", INFO, "Item Status", lambda c: R.value_frequency("document_status", count_name="count", null_label="NULL"), summary=True),
    Check("B39", INFO, "Revision Status", lambda c: R.value_frequency("revision_status", count_name="count", null_label="NULL"), summary=True),
    Check("B40", ISSUE, "Multiple ItemRevs with Same Path Location", same_path, ["path_location"]),
    Check("B41", INFO, "Duplicate Dataset Files", duplicate_files, ["filename"]),
    Check("B42", INFO, "File Extensions", lambda c: R.value_frequency(T.file_extension("path_location"), "extensions", where=T.matches(F.upper("path_location"), P.HAS_EXTENSION)), summary=True),
    Check("B43", ISSUE, "Paths Without Filenames", lambda c: R.pattern_rows(F.upper("path_location"), _PATH, P.HAS_EXTENSION, negate=True, distinct=True)),
    Check("B44", ISSUE, "Item Without Path Location", lambda c: R.null_rows("path_location", _PATH, distinct=True)),
    Check("B45", INFO, "Invalid Remote Path", lambda c: R.pattern_rows("path_location", _PATH, P.UNC_PATH, negate=True, distinct=True)),
    Check("B46", INFO, "Network Drives", lambda c: R.value_frequency(T.server_share("path_location"), "remote_drive", "count"), summary=True),
    Check("B47", INFO, "Dataset File Status", lambda c: R.null_rows("path_location", ["doc_id", "revision", "rev_creation_date", F.col("path_location").alias("file_path")], negate=True, distinct=True)),
    Check("B48", INFO, "Existing - Revision Updates", lambda c: S.revision_not_listed(existing_revisions(c), "doc_id", "rev_item", "rev_id", "revision", c.params.get("exact_revisions", False))),
    Check("B49", INFO, "Existing - Parts With Multiple Revisions", lambda c: S.multiple_joined_versions(existing_revisions(c), "doc_id", [F.col("rev_id").alias("rev_current")], distinct=True)),
    Check("B50", INFO, "Existing - Status Updates", status_updates("doc_id", "document_status", distinct=True)),
    Check("B51", INFO, "Existing - Item Name Updates", text_updates("doc_id", "name", "pobject_name", "name", lambda: T.joined("dw_tc_id", F.lit("|"), "name", F.lit("|IGNORE")), lengths=True, distinct=True)),
    Check("B52", INFO, "Existing - Item Description Updates", text_updates("doc_id", "description", "pobject_desc", "description", lambda: T.joined("dw_tc_id", F.lit("|IGNORE|"), "description"), distinct=True)),
    Check("B53", INFO, "Dataset file exists for given Item Revision", dataset_file_exists, ["pitem_id", "pitem_revision_id", "dataset_namedref_current"]),
]

PACKAGE = Package(
    "document",
    (  # fixed values
        "doc_id",
        "name",
        "description",
        "revision",
        "revision_status",
        "rev_creation_date",
        "rev_release_date",
        "document_status",
        "document_category",
        "document_type",
        "dataset_name",
        "path_location",
    ),
    CHECKS,
)
