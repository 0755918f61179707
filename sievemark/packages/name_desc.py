"""Name and description checks."""

from pyspark.sql import functions as F

from sievemark.functions import patterns as P
from sievemark.functions import text as T
from sievemark.operators import keyed as N
from sievemark.operators import parts as R
from sievemark.operators import paths as K
from sievemark.operators import reference as S
from sievemark.operators import relations as L
from sievemark.packages.status import counted_master
from sievemark.plans.check import BACKUP, INFO, ISSUE, Check, Context, Package, count_of


def group_profile(c: Context):
    rows = S.id_counts(c.chk, "tc_id").join(K.master(c.refs), F.col("_id") == F.col("dw_key"))
    counts = rows.groupBy("dw_local_site", "dw_pname").agg(F.sum("_n").alias("_n"))
    show = [F.col("dw_local_site").alias("local_site"), "business_unit", "parent_name", F.col("dw_pname").alias("grp"), "erps"]
    return S.dimension_profile(counts, "dw_pname", K.group_dimension(c.refs), "dim_group", show, ["dw_local_site", "dw_pname"])


def backup(c: Context):
    def texts(prefix: str):
        return K.pick(c.refs["pworkspaceobject"], **{f"{prefix}_wso": "puid", f"{prefix}_name": "pobject_name", f"{prefix}_desc": "pobject_desc", f"{prefix}_released": "pdate_released"})

    def second_names(tables, name: str):
        forms = K.master_forms(c.refs, tables, ["pname2"], how="inner")
        return K.pick(forms, **{f"{name}_of": "form_of", name: "pname2"})

    rows = L.with_owner(L.with_item(c.chk.select("tc_id"), c.refs, "tc_id", upper=False), c.refs)
    rows = rows.join(texts("item"), F.col("item_puid") == F.col("item_wso"))
    rows = rows.join(K.revisions(c.refs), F.col("item_puid") == F.col("rev_item"))
    rows = rows.join(texts("rev"), F.col("rev_puid") == F.col("rev_wso"))
    rows = rows.join(second_names(["part_form", "nonengineering_form"], "item_name2"), F.col("item_puid") == F.col("item_name2_of"), "left")
    rows = rows.join(second_names(["version_form", "part_revision_form"], "rev_name2"), F.col("rev_puid") == F.col("rev_name2_of"), "left")
    return rows.select(
        F.col("grp").alias("item_grp"),
        F.col("tc_item_id").alias("pitem_id"),
        "item_name",
        "item_name2",
        "item_desc",
        "rev_id",
        F.col("item_released").alias("pdate_released"),
        "rev_name",
        "rev_name2",
        "rev_desc",
    )


CHECKS = [
    Check("I01", INFO, "Total Rows", lambda c: R.row_count(), summary=True),
    Check("I02", INFO, "Total Items", lambda c: count_of(c.chk.select("tc_id").distinct()), summary=True),
    Check("I03", INFO, "Total Rows Distinct", lambda c: count_of(c.chk.distinct()), summary=True),
    Check("I04", INFO, "Duplicate Items", lambda c: N.duplicate_rows(c.chk, ["tc_id"], counted=F.col("tc_id"))),
    Check("I05", ISSUE, "Item Not Exists", lambda c: S.missing_in(c.chk, "tc_id", K.master(c.refs), "dw_key")),
    Check("I06", INFO, "Item Types", lambda c: S.joined_frequency(counted_master(c), {"item_type": "dw_item_type"}, "cnt"), summary=True),
    Check("I07", ISSUE, "Item Name1 is Null", lambda c: R.null_rows("name1", ["tc_id", "name1"])),
    Check("I08", INFO, "Item Name1 Length Greater than 64 chars", lambda c: R.too_long("name1", 64, ["tc_id", "name1"]), ["length"]),
    Check("I09", INFO, "Item Name1 Length Greater than 30 (JDE)", lambda c: R.too_long("name1", 30, ["tc_id", "name1"]), ["length"]),
    Check("I10", INFO, "Item Name1 Non-ASCII", lambda c: R.non_ascii("name1", ["tc_id"])),
    Check("I11", ISSUE, "Item Name1 has Control Chars", lambda c: R.control_chars("name1", "CNTRL", ["tc_id"])),
    Check("I12", INFO, "Item Name2 is Null", lambda c: R.null_rows("name2", ["tc_id", "name2"])),
    Check("I13", INFO, "Item Name2 Length Greater than 30 chars", lambda c: R.too_long("name2", 30, ["tc_id", "name2"]), ["length"]),
    Check("I14", INFO, "Item Name2 Non-ASCII", lambda c: R.non_ascii("name2", ["tc_id"])),
    Check("I15", ISSUE, "Item Name2 has Control Chars", lambda c: R.control_chars("name2", "CNTRL", ["tc_id"])),
    Check("I16", INFO, "Item Desc is Null", lambda c: R.null_rows("description", ["tc_id", "description"])),
    Check("I17", INFO, "Item Desc Greater than 240 chars", lambda c: R.too_long("description", 240, ["tc_id", "description"]), ["length"]),
    Check("I18", INFO, "Item Desc has pipe", lambda c: R.pattern_rows("description", ["tc_id", "description"], P.PIPE)),
    Check("I19", ISSUE, "Item Desc has Control Chars", lambda c: R.control_chars("description", "CNTRL", ["tc_id"], unless=P.NEW_LINES)),
    Check("I20", INFO, "Item Desc has New Lines", lambda c: R.control_chars("description", "NEWLINE", ["tc_id"], pattern=P.NEW_LINES)),
    Check("I21", INFO, "Owning Group", group_profile, ["-cnt"], summary=True),
    Check("I22", BACKUP, "Backup", backup, ["item_grp", "pitem_id", "rev_id"]),
]

PACKAGE = Package("name_desc", ["tc_id", "name1", "name2", "description"], CHECKS)
