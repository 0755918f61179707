"""Item load checks."""

from pyspark.sql import functions as F

from sievemark.functions import patterns as P
from sievemark.functions import text as T
from sievemark.operators import keyed as N
from sievemark.operators import parts as R
from sievemark.operators import paths as K
from sievemark.operators import reference as S
from sievemark.plans.check import INFO, ISSUE, Check, Context, Package


def existing(c: Context):
    """Staged items that the warehouse master knows."""
    return c.chk.join(K.master(c.refs), T.id_key("tc_id") == F.col("dw_key"))


def existing_revisions(c: Context):
    return existing(c).join(K.revisions(c.refs), F.col("dw_puid") == F.col("rev_item"))


def alternate(c: Context):
    return K.pick(c.refs["altid_all_site"], alt_item="pitem_id", alt_id="pidfr_id", cxt="pidcxt_name", item_group="item_group", local_site="local_site")


def in_warehouse(c: Context):
    ids, dw = c.chk.select("tc_id").distinct(), K.master(c.refs)
    return S.exists_in(ids, T.id_key("tc_id"), dw, "dw_key", ["tc_id", *[x for x in dw.columns if x != "dw_key"]])


def alt_id_exists(c: Context):
    alt = alternate(c).withColumn("_key", T.id_key("alt_id"))
    show = ["tc_id", F.col("alternateid").alias("given_altid"), "cxt", F.col("alt_item").alias("actual_related_item"), "item_group", "local_site"]
    return S.exists_in(c.chk.select("tc_id", "alternateid").distinct(), T.id_key("alternateid"), alt, "_key", show)


def alt_id_differs(c: Context):
    joined = c.chk.join(alternate(c).withColumn("_key", T.id_key("alt_item")), T.id_key("tc_id") == F.col("_key"))
    return S.delta_update(joined, "alternateid", "alt_id", show=["tc_id", "alternateid", F.col("alt_id").alias("current_altid")])


def unit_unknown(lov_column: str):
    return lambda c: S.not_in_lov(c.chk, {"uom": lov_column}, K.unit_values(c.refs), "tc_id", {"uom": "given_uom"})


def owning_group(c: Context):
    counts = c.chk.groupBy("owninggroup").agg(F.count("*").alias("_n"))
    show = ["primary_site", "business_unit", "parent_name", F.col("owninggroup").alias("grp"), "erps"]
    return S.dimension_profile(counts, "owninggroup", K.group_dimension(c.refs), "dim_group", show, ["owninggroup"])


def status_updates(id_col: str, status_col: str, distinct: bool):
    def make(c: Context):
        staged = c.chk.select(id_col, status_col)
        staged = staged.distinct() if distinct else staged
        joined = staged.join(K.master(c.refs), T.id_key(id_col) == F.col("dw_key"))
        joined = joined.join(K.item_status(c.refs, inner=False), F.col("dw_puid") == F.col("status_item"), "left")
        return S.delta_update(
            joined,
            F.upper(F.trim(status_col)),
            F.upper("status_name"),
            "null_safe",
            [id_col, F.col("dw_status").alias("status_current"), F.col(status_col).alias("status_new")],
            T.joined("dw_tc_id", F.lit("|"), status_col),
            distinct,
        )

    return make


def text_updates(id_col: str, new: str, current: str, label: str, line, lengths=False, distinct=False):
    """Name or description changes, compared by word characters only."""

    def make(c: Context):
        objects = K.pick(c.refs["pworkspaceobject"], wso_puid="puid", wso_text=current)
        staged = c.chk.select(id_col, new)
        staged = staged.distinct() if distinct else staged
        joined = staged.join(K.master(c.refs), T.id_key(id_col) == F.col("dw_key")).join(objects, F.col("dw_puid") == F.col("wso_puid"))
        show = [id_col, F.col(f"dw_{current}").alias(f"{label}_current")]
        if lengths:
            show.append(T.text_length(f"dw_{current}").alias("length_current"))
        show.append(F.col(new).alias(f"{label}_new"))
        if lengths:
            show.append(T.text_length(new).alias("length_new"))
        return S.delta_update(joined, T.compare_text(new), T.compare_text("wso_text"), show=show, input_line=line(), distinct=distinct)

    return make


def type_updates(c: Context):
    forms = K.master_forms(c.refs, ["part_form", "nonengineering_form"], ["prsone_itemtype"])
    joined = existing(c).join(forms, F.col("dw_puid") == F.col("form_of"))
    show = ["tc_id", F.col("prsone_itemtype").alias("type_current"), F.col("engineering_type").alias("type_new")]
    return S.delta_update(joined, "engineering_type", "prsone_itemtype", "null_safe", show)


def unit_updates(c: Context):
    units = K.pick(c.refs["punitofmeasure"], unit="puid", symbol="psymbol")
    item_units = K.items(c.refs).join(units, F.col("unit_puid") == F.col("unit"))
    joined = existing(c).join(item_units, F.col("dw_puid") == F.col("item_puid"))
    return S.delta_update(joined, "uom", "symbol", "null_safe", ["tc_id", F.col("symbol").alias("uom_current"), F.col("uom").alias("uom_new")])


def revision_updates(c: Context):
    return S.delta_update(
        existing_revisions(c),
        "revision",
        "rev_id",
        show=["tc_id", F.col("rev_id").alias("rev_current"), F.col("revision").alias("rev_new")],
        input_line=T.joined("dw_tc_id", F.lit("|"), "rev_id", F.lit("|"), "revision"),
    )


CHECKS = [
    Check("A01", INFO, "Count Total Rows", lambda c: R.row_count(), summary=True),
    Check("A02", INFO, "Count Total Items", lambda c: R.distinct_count(cnt="tc_id"), summary=True),
    Check("A03", INFO, "Item Staged Twice", lambda c: N.duplicate_rows(c.chk, [T.id_key("tc_id"), T.id_key("revision")]), ["tc_id"]),
    Check("A04", ISSUE, "Item Exist in Warehouse", in_warehouse),
    Check("A05", ISSUE, "Item Exist in Product System", lambda c: S.count_existing(c.chk, "tc_id", K.items(c.refs, local=True), "item_key"), summary=True),
    Check("A06", ISSUE, "Alt ID Exist in Product System", alt_id_exists),
    Check("A07", ISSUE, "Item with different Alt ID in Product System", alt_id_differs),
    Check("A08", INFO, "Item ID Suffix", lambda c: R.suffix_frequency("tc_id", "None"), summary=True),
    Check("A09", ISSUE, "Suffix Does Not Correspond to Owning Group", lambda c: R.suffix_matches_group("tc_id", "owninggroup")),
    Check("A10", INFO, "Duplicate Suffix", lambda c: R.pattern_rows("tc_id", ["tc_id"], like="%:%:%", distinct=True)),
    Check("A11", INFO, "Item with no Suffix", lambda c: R.pattern_rows("tc_id", ["legacyid", "tc_id", "owninggroup"], like="%:%P", negate=True, distinct=True, also=~T.matches("tc_id", P.EIGHT_THREE_ID))),
    Check("A12", INFO, "8-3 ID is suffixed", lambda c: R.pattern_rows("tc_id", ["legacyid", "tc_id", "owninggroup"], regex=P.EIGHT_THREE_PREFIX, also=F.col("tc_id").like("%:%"))),
    Check("A13", ISSUE, "Parts with multiple REVs", lambda c: N.multi_value_lists(c.chk, "tc_id", "revision", "rev_count", "revision_list"), summary=True),
    Check("A14", ISSUE, "Revisions with Same Creation Date", lambda c: N.versions_same_date(c.chk, "tc_id", "rev_creation_date", "revision"), ["tc_id"]),
    Check("A15", ISSUE, "REV is null", lambda c: R.null_rows("revision", ["tc_id", "revision"])),
    Check("A16", INFO, "REV Counts", lambda c: R.value_frequency("revision"), ["revision"], summary=True),
    Check("A17", INFO, "Odd Revision ID", lambda c: R.odd_revision("tc_id")),
    Check("A18", ISSUE, "ID Length Greater Than 64 Chars", lambda c: R.too_long("tc_id", 64), ["-length"]),
    Check("A19", ISSUE, "ID Length Greater Than 25 Chars (JDE)", lambda c: R.too_long("tc_id", 25), ["-length"]),
    Check("A20", INFO, "Spaces in ID", lambda c: R.pattern_rows("tc_id", ["tc_id"], P.WHITESPACE)),
    Check("A21", INFO, "Leading Non-AlphaNumeric Char in ID", lambda c: R.pattern_rows("tc_id", ["tc_id"], P.LEADING_ALNUM, negate=True)),
    Check("A22", INFO, "ID with Trailing Space", lambda c: R.pattern_rows("tc_id", ["tc_id"], P.TRAILING_SPACE)),
    Check("A23", INFO, "ID with Invalid Characters", lambda c: R.pattern_rows("tc_id", ["tc_id"], P.INVALID_ID_CHARS)),
    Check("A24", INFO, "ID with Questionable Characters", lambda c: R.pattern_rows("tc_id", ["tc_id"], P.QUESTIONABLE_ID_CHARS)),
    Check("A25", INFO, "No Alt ID count", lambda c: R.null_count("alternateid"), summary=True),
    Check("A26", ISSUE, "Item with different Alt ID", lambda c: N.multi_value_rows(c.chk, [T.id_key("tc_id")], "alternateid", ["tc_id", "alternateid"]), ["tc_id"]),
    Check("A27", ISSUE, "Alt ID on different Items", lambda c: N.multi_value_keys(c.chk.filter(F.col("alternateid").isNotNull()), T.id_key("alternateid"), "tc_id", "alternateid"), summary=True),
    Check("A28", ISSUE, "Alt ID Greater Than 32 Chars", lambda c: R.too_long("alternateid", 32), ["-length"]),
    Check("A29", INFO, "Spaces in Alt ID", lambda c: R.pattern_rows("alternateid", ["alternateid"], P.WHITESPACE)),
    Check("A30", INFO, "Leading Non-AlphaNumeric Char in Alt ID", lambda c: R.pattern_rows("alternateid", ["alternateid"], P.LEADING_ALNUM, negate=True)),
    Check("A31", INFO, "Alt ID with Trailing Space", lambda c: R.pattern_rows("alternateid", ["alternateid"], P.TRAILING_SPACE)),
    Check("A32", INFO, "Alt ID with Special Chars", lambda c: R.pattern_rows("alternateid", ["alternateid"], P.SPECIAL_CHARS)),
    Check("A33", ISSUE, "Alt ID has colon", lambda c: R.pattern_rows("alternateid", ["alternateid"], P.COLON)),
    Check("A34", INFO, "Non 8-3 Alt ID", lambda c: R.pattern_rows("alternateid", ["alternateid"], P.EIGHT_THREE_ID, negate=True)),
    Check("A35", ISSUE, "Alt ID mismatch with ID", lambda c: R.column_pair("tc_id", "alternateid", "<>", ["tc_id", "alternateid"], also=T.matches("tc_id", P.EIGHT_THREE_ID))),
    Check("A36", ISSUE, "Item Name1 is Null", lambda c: R.null_rows("name", ["tc_id", "name"])),
    Check("A37", INFO, "Item Name1 Length Greater than 64 chars", lambda c: R.too_long("name", 64, ["tc_id", "name"]), ["-length"]),
    Check("A38", INFO, "Item Name1 Length Greater than 30 chars (JDE)", lambda c: R.too_long("name", 30, ["tc_id", "name"]), ["-length"]),
    Check("A39", INFO, "Item Name1 Non-ASCII", lambda c: R.non_ascii("name", ["tc_id"])),
    Check("A40", ISSUE, "Item Name has Control Chars", lambda c: R.control_chars("name", "(CNTRL)", ["tc_id"])),
    Check("A41", INFO, "Item Name2 is Null", lambda c: R.null_count("name2", "count"), summary=True),
    Check("A42", INFO, "Item Name2 Length Greater than 30 chars", lambda c: R.too_long("name2", 30, ["tc_id", "name2"]), ["-length"]),
    Check("A43", INFO, "Item Name2 Non-ASCII", lambda c: R.non_ascii("name2", ["tc_id"])),
    Check("A44", INFO, "Item Desc is Null", lambda c: R.null_count("description", "count"), summary=True),
    Check("A45", INFO, "Item Desc Greater than 240 chars", lambda c: R.too_long("description", 240, ["tc_id", "description"]), ["-length"]),
    Check("A46", INFO, "Item Desc has pipe", lambda c: R.pattern_rows("description", ["tc_id", "description"], P.PIPE)),
    Check("A47", ISSUE, "Item Desc has Control Chars", lambda c: R.control_chars("description", "(CNTRL)", ["tc_id"])),
    Check("A48", INFO, "Release Date is Null", lambda c: R.null_count("rev_release_date", "count"), summary=True),
    Check("A49", INFO, "Creation Date is Null", lambda c: R.null_count("rev_creation_date", "count"), summary=True),
    Check("A50", INFO, "Release Dates", lambda c: R.decade_histogram("rev_release_date"), ["decade"]),
    Check("A51", INFO, "Creation Dates", lambda c: R.decade_histogram("rev_creation_date"), ["decade"]),
    Check("A52", ISSUE, "Invalid UOM (unit symbol)", unit_unknown("psymbol"), ["given_uom"], summary=True),
    Check("A53", ISSUE, "Invalid UOM (list value)", unit_unknown("rsuom"), ["given_uom"], summary=True),
    Check("A54", INFO, "Owning Group", owning_group, ["-cnt"], summary=True),
    Check("A55", INFO, "Item Status", lambda c: R.value_frequency("item_status", count_name="count"), summary=True),
    Check("A56", INFO, "Revision Status", lambda c: R.value_frequency("revision_status", count_name="count"), summary=True),
    Check("A57", INFO, "Existing - Revision Updates", revision_updates),
    Check("A58", INFO, "Existing - Parts With Multiple Revisions", lambda c: S.multiple_joined_versions(existing_revisions(c), "tc_id", [F.col("rev_id").alias("rev_current")])),
    Check("A59", INFO, "Existing - Status Updates", status_updates("tc_id", "item_status", distinct=False)),
    Check("A60", INFO, "Existing - Item Name Updates", text_updates("tc_id", "name", "pobject_name", "name", lambda: T.joined("dw_tc_id", F.lit("|"), "name", F.lit("|IGNORE")), lengths=True)),
    Check("A61", INFO, "Existing - Item Description Updates", text_updates("tc_id", "description", "pobject_desc", "description", lambda: T.joined("dw_tc_id", F.lit("|IGNORE|"), "description"))),
    Check("A62", INFO, "Existing - Item Type Updates", type_updates),
    Check("A63", INFO, "Existing - UOM Updates", unit_updates),
]

PACKAGE = Package(
    "item",
    (  # fixed values
        "tc_id",
        "alternateid",
        "revision",
        "rev_creation_date",
        "name",
        "name2",
        "description",
        "uom",
        "engineering_type",
        "item_status",
        "revision_status",
        "rev_release_date",
        "traceability",
    ),
    CHECKS,
    id_columns=("tc_id",),
)
