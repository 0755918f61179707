"""Bill-of-material load checks."""

from pyspark.sql import functions as F

from sievemark.functions import patterns as P
from sievemark.functions import text as T
from sievemark.operators import keyed as N
from sievemark.operators import parts as R
from sievemark.operators import paths as K
from sievemark.operators import reference as S
from sievemark.operators import relations as L
from sievemark.operators.sets import id_union, left_join_spread
from sievemark.plans.check import BACKUP, INFO, ISSUE, Check, Context, Package, count_of

IDS = R.STAGED_IDS


def ids_in_master(c: Context):
    return c.ids.join(K.master(c.refs), F.col("tc_id") == F.col("dw_key"))


def not_in_product_system(c: Context):
    """Ids without a locally owned item; a copy owned at another site is reported once per copy."""
    own = K.pick(c.refs["ppom_object"].filter(F.col("rowning_siteu").isNull()), own_puid="puid")
    rows = c.ids.join(K.items(c.refs), F.col("tc_id") == F.col("item_key"), "left").join(own, F.col("item_puid") == F.col("own_puid"), "left")
    return S.missing_value(rows, "own_puid", ["tc_id"])


def revision_missing(c: Context):
    wanted = c.chk.select(T.id_key("parent_tc_id").alias("tc_id"), F.col("parent_revision").alias("rev")).distinct()
    known = c.refs["item_all_site_rev"].select(T.id_key("tc_id").alias("_id"), F.col("rev").alias("_rev"))
    return wanted.join(known, (F.col("tc_id") == F.col("_id")) & (F.col("rev") == F.col("_rev")), "left_anti")


def alt_id_missing(c: Context):
    pairs = id_union(
        c.chk,
        [T.id_key("parent_tc_id"), T.id_key("child_tc_id")],
        extra=[("altid", T.id_key("parent_gid_id")), ("altid", T.id_key("child_gid_id"))],
    ).filter(F.col("altid").isNotNull())
    known = c.refs["altid_all_site"].filter(F.col("pidcxt_name").isin("JDE", "RSOne"))
    known = known.select(T.id_key("pitem_id").alias("_id"), F.col("pidfr_id").alias("_alt"))
    return pairs.join(known, (F.col("tc_id") == F.col("_id")) & (F.col("altid") == F.col("_alt")), "left_anti")


def same_sequence(c: Context):
    rows = c.chk.select(T.id_key("parent_tc_id").alias("parent_tc_id"), "seq_no", T.id_key("child_tc_id").alias("child_tc_id"), "quantity")
    return N.multi_value_rows(rows, ["parent_tc_id", "seq_no"], "child_tc_id")


def group_profile(c: Context):
    counts = ids_in_master(c).groupBy("dw_local_site", "dw_pname").agg(F.count("*").alias("_n"))
    show = [F.col("dw_local_site").alias("local_site"), "business_unit", "parent_name", F.col("dw_pname").alias("grp"), "erps"]
    return S.dimension_profile(counts, "dw_pname", K.group_dimension(c.refs), "dim_group", show, ["dw_local_site", "dw_pname"])


def typed_ids(c: Context):
    ids = id_union(c.chk, {"Assembly": T.id_key("parent_tc_id"), "Component": T.id_key("child_tc_id")})
    return ids.join(K.master(c.refs), F.col("tc_id") == F.col("dw_key"))


def not_in_major_group(kind: str):
    def make(c: Context):
        show = [F.col("dw_tc_id").alias("tc_id"), "type", F.col("dw_pname").alias("owninggroup"), F.col("dw_local_site").alias("local_site")]
        return S.not_in_majority(typed_ids(c).filter(F.col("type") == kind), ids_in_master(c), "dw_pname", show)

    return make


def not_in_major_site(c: Context):
    show = [F.col("dw_tc_id").alias("tc_id"), "type", F.col("dw_local_site").alias("local_site")]
    return S.not_in_majority(typed_ids(c), ids_in_master(c), "dw_local_site", show)


def status_frequency(c: Context):
    rows = c.ids.join(K.items(c.refs), F.col("tc_id") == F.col("item_key"))
    rows = rows.join(K.item_status(c.refs, inner=False), F.col("item_puid") == F.col("status_item"), "left")
    return rows.groupBy(F.col("status_name").alias("status")).agg(F.count("*").alias("cnt"))


def has_structure(c: Context):
    """Staged assemblies whose item has at least one child occurrence."""
    children = K.pick(c.refs["pitem"], child_puid="puid", child_id="pitem_id").filter(F.col("child_id").isNotNull())
    parents = (
        K.occurrences(c.refs)
        .join(children, F.col("occ_child") == F.col("child_puid"), "left_semi")
        .join(K.revisions(c.refs), F.col("struct_rev") == F.col("rev_puid"))
        .select("rev_item")
    )
    built = K.items(c.refs).join(parents, F.col("item_puid") == F.col("rev_item"), "left_semi")
    staged = c.chk.select("parent_tc_id").distinct()
    return staged.join(built, T.id_key("parent_tc_id") == F.col("item_key"), "left_semi").select("parent_tc_id", F.lit("Y").alias("hasbom"))


def backup(c: Context):
    staged = c.chk.select("parent_tc_id", "parent_revision").distinct()
    rows = L.with_given_revision(L.with_item(staged, c.refs, "parent_tc_id", local=False), c.refs, "parent_revision", ignore_case=True)
    rows = L.with_occurrences(rows, c.refs)
    rows = rows.join(K.item_names(c.refs), F.col("occ_child") == F.col("named_puid"))
    notes = ((K.REFERENCE_DESIGNATOR, "ref_designator"), (K.REFERENCE_COMMENTS, "refdefcomments"))
    rows = rows.select(
        F.col("tc_item_id").alias("assy"), F.col("rev_id").alias("rev"), F.col("named_id").alias("comp"), F.round("occ_qty", 4).alias("qty"), F.col("occ_seq").alias("pseq_no"), "occ_notes"
    )
    # Many occurrences have no notes at all.
    rows = left_join_spread(rows, "occ_notes", *[(K.occurrence_notes(c.refs, kind, name), f"{name}_notes") for kind, name in notes])
    return rows.select("assy", "rev", "comp", "qty", "pseq_no", "ref_designator", "refdefcomments").distinct()


CHECKS = [
    Check("D01", INFO, "Count Total Rows", lambda c: R.row_count(), summary=True),
    Check("D02", INFO, "Item Staged Twice", lambda c: N.duplicate_rows(c.chk, ["parent_tc_id", "child_tc_id", "seq_no", "quantity"])),
    Check("D03", INFO, "Count Assemblies", lambda c: R.distinct_count(cnt=T.id_key("parent_tc_id")), summary=True),
    Check("D04", INFO, "Count Components", lambda c: R.distinct_count(cnt=T.id_key("child_tc_id")), summary=True),
    Check("D05", INFO, "Count ASM and COMP", lambda c: R.Measure({"cnt": F.count("*")}, IDS), summary=True),
    Check("D06", INFO, "Count Items in Data Warehouse", lambda c: count_of(ids_in_master(c)), summary=True),
    Check("D07", ISSUE, "Item Not Exist in Data Warehouse", lambda c: S.missing_in(c.ids, "tc_id", K.master(c.refs), "dw_key")),
    Check("D08", ISSUE, "Item Not Exist in Product System", not_in_product_system),
    Check("D09", ISSUE, "Item Rev Not Exist in Product System", revision_missing),
    Check("D10", ISSUE, "ID is NULL", lambda c: R.null_rows(["parent_tc_id", "child_tc_id"])),
    Check("D11", ISSUE, "ID Length > 28", lambda c: R.too_long("tc_id", 28, over=IDS)),
    Check("D12", ISSUE, "ID Length > 30 DHT", lambda c: R.too_long("tc_id", 30, over=IDS)),
    Check("D13", INFO, "ID with Spaces", lambda c: R.pattern_rows("tc_id", ["tc_id"], P.WHITESPACE, over=IDS)),
    Check("D14", INFO, "ID with Trailing Space", lambda c: R.pattern_rows("tc_id", ["tc_id"], P.TRAILING_SPACE, over=IDS)),
    Check("D15", INFO, "ID with Special Chars", lambda c: R.pattern_rows("tc_id", ["tc_id"], P.SPECIAL_CHARS, over=IDS)),
    Check("D16", INFO, "ID Leading Odd Character", lambda c: R.pattern_rows("tc_id", ["tc_id"], P.LEADING_NON_WORD, over=IDS)),
    Check("D17", INFO, "ID with Control Chars", lambda c: R.control_chars("tc_id", "CNTRL", over=IDS, name="tc_id_cntrl")),
    Check("D18", ISSUE, "Alt ID not exist", alt_id_missing),
    Check("D19", ISSUE, "SEQ No is Missing", lambda c: R.null_rows("seq_no")),
    Check("D20", INFO, "SEQ No is a Decimal", lambda c: R.pattern_rows("seq_no", ["*"], P.DECIMAL_POINT)),
    Check("D21", ISSUE, "Components with Same SEQ on Same ASM", same_sequence, ["parent_tc_id", "seq_no", "#seq_no"]),
    Check("D22", INFO, "Quantity is Missing", lambda c: R.numeric_range("quantity", zero=True, missing=True)),
    Check("D23", INFO, "Questionable QTY", lambda c: R.numeric_range("quantity", lo=0, hi=1000), ["-#quantity"]),
    Check("D24", INFO, "Owning Group", group_profile, ["-cnt"], summary=True),
    Check("D25", ISSUE, "Assy Not in Major Group", not_in_major_group("Assembly"), ["owninggroup"]),
    Check("D26", INFO, "Comp Not in Major Group", not_in_major_group("Component"), ["owninggroup"]),
    Check("D27", INFO, "Owning Site", lambda c: ids_in_master(c).groupBy(F.col("dw_local_site").alias("local_site")).agg(F.count("*").alias("count")), summary=True),
    Check("D28", ISSUE, "Item in Different Owning Site", not_in_major_site),
    Check("D29", INFO, "Item Status", status_frequency, ["cnt"], summary=True),
    Check("D30", ISSUE, "COMP and ASM are the Same", lambda c: R.column_pair(T.id_key("parent_tc_id"), T.id_key("child_tc_id"), "=")),
    Check("D31", INFO, "ASSY has BOM", has_structure),
    Check("D32", BACKUP, "Backup", backup),
]

PACKAGE = Package(
    "bom",
    (  # fixed values
        "parent_tc_id",
        "parent_gid_id",
        "parent_revision",
        "child_tc_id",
        "child_gid_id",
        "seq_no",
        "quantity",
        "refdefcomments",
    ),
    CHECKS,
    id_columns=("parent_tc_id", "child_tc_id"),
)
