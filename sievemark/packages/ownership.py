"""Ownership checks."""

from pyspark.sql import functions as F

from sievemark.functions import patterns as P
from sievemark.functions import text as T
from sievemark.operators import keyed as N
from sievemark.operators import parts as R
from sievemark.operators import paths as K
from sievemark.operators import reference as S
from sievemark.operators import relations as L
from sievemark.packages.status import counted_master, staged_master
from sievemark.plans.check import BACKUP, INFO, ISSUE, Check, Context, Package


def group_not_as_given(c: Context):
    known = K.pick(c.refs["ppom_group"], group_name="pname")
    rows = staged_master(c).join(known, F.col("dw_pname") == F.col("group_name"))
    show = [F.col("dw_tc_id").alias("tc_id"), F.col("grp_old").alias("grp_given"), F.col("group_name").alias("grp_actual")]
    return S.delta_update(rows.drop("tc_id"), T.first_match("grp_old", P.GROUP_BEFORE_DOT), "group_name", show=show)


def group_frequency(c: Context, rows, group: str, name: str):
    """Rows per site, parent, group and ERP systems; only groups that exist."""
    rows = rows.join(K.group_parents(c.refs), F.col(group) == F.col("group_name"))
    rows = rows.join(K.group_dimension(c.refs), F.col(group) == F.col("dim_group"), "left")
    return S.joined_frequency(rows, {"local_site": "dw_local_site", "parent": "parent", name: group, "erps": "erps"})


def new_group_frequency(c: Context):
    counts = c.chk.groupBy(F.col("tc_id").alias("_id"), "grp_new").agg(F.count("*").alias("_n"))
    return group_frequency(c, counts.join(K.master(c.refs), F.col("_id") == F.col("dw_key")), "grp_new", "grp")


def form_type_frequency(c: Context):
    rows = S.id_counts(c.chk, "tc_id", upper=False).join(K.items(c.refs), F.col("_id") == F.col("item_key"))
    forms = K.master_forms(c.refs, ["part_form", "nonengineering_form"], ["prsone_itemtype", "prsone_uom"])
    return S.joined_frequency(rows.join(forms, F.col("item_puid") == F.col("form_of")), {"prsone_itemtype": "prsone_itemtype"})


def superseded(c: Context):
    return staged_master(c).drop("dw_key").filter(F.col("dw_status") == "Superseded")


def not_released(c: Context):
    rows = S.id_counts(c.chk, "tc_id", upper=False).join(K.items(c.refs), F.col("_id") == F.col("item_key"))
    return S.joined_count(rows.join(K.latest_revisions(c.refs, "released", rows.select("item_puid")), F.col("item_puid") == F.col("last_item"), "left_anti"))


def context_frequency(c: Context):
    alt = c.refs["altid_all_site"].select(T.id_key("pitem_id").alias("_key"), "pidcxt_name")
    rows = S.id_counts(c.chk, "tc_id", upper=False).join(alt, F.col("_id") == F.col("_key"), "left")
    return S.joined_frequency(rows, {"erp_context": "pidcxt_name"})


def cross_documents(c: Context):
    show = ["grp", "tc_id", F.col("last_rev").alias("max_rev_working"), "rdd_id", "rdd_grp"]
    return L.cross_group_documents(c.chk.select("tc_id"), c.refs, "tc_id", "working", show, upper=False)


def cross_second_parts(c: Context):
    show = ["grp", "tc_id", F.col("last_rev").alias("max_rev_working"), "rdd_id", "rdd_grp", F.col("rel_part_id").alias("rel_partid"), F.col("rel_part_grp").alias("rel_partgrp")]
    rows = L.cross_group_second_parts(c.chk.select("tc_id"), c.refs, "tc_id", "working", show, upper=False)
    return L.without_staged(rows, c.chk, "rel_partid", "tc_id", "rel_partgrp", "grp_new")


def cross_parts(c: Context):
    def documents(rows):
        kinds = K.pick(c.refs["pworkspaceobject"].filter(F.col("pobject_type") == "Documents"), kind_puid="puid")
        return rows.join(kinds, F.col("item_puid") == F.col("kind_puid"))

    show = ["grp", F.col("tc_item_id").alias("doc_id"), F.col("last_rev").alias("max_rev_working"), "rel_part_id", "rel_part_grp"]
    rows = L.cross_group_parts(c.chk.select("tc_id"), c.refs, "tc_id", "working", show, upper=False, only=documents)
    return L.without_staged(rows, c.chk, "rel_part_id", "tc_id", "rel_part_grp", "grp_new")


def backup(c: Context):
    own = K.pick(K.owners(c.refs, with_user=True), _own="owned_puid", item_grp="owner_group", item_usr="owner_user")
    rows = L.with_item(c.chk.select("tc_id"), c.refs, "tc_id", upper=False).join(own, F.col("item_puid") == F.col("_own"))
    rows = L.with_owner(L.with_revision(rows, c.refs, "working"), c.refs, "last_puid", "rev_grp")
    dates = K.pick(c.refs["pworkspaceobject"], wso_puid="puid", pdate_released="pdate_released")
    rows = rows.join(dates, F.col("last_puid") == F.col("wso_puid"))
    rows = rows.join(K.related_documents(c.refs, with_group=True), F.col("last_puid") == F.col("rel_rev"), "left")
    rows = rows.join(K.item_status(c.refs, inner=False), F.col("item_puid") == F.col("status_item"), "left")
    return rows.select(
        "tc_id",
        "item_grp",
        "item_usr",
        F.col("status_name").alias("status"),
        F.col("last_rev").alias("max_rev_working"),
        "rev_grp",
        "pdate_released",
        "rdd_id",
        "rdd_grp",
    )


CHECKS = [
    Check("H01", INFO, "Total Rows", lambda c: R.row_count("row_count"), summary=True),
    Check("H02", INFO, "Count Items", lambda c: R.distinct_count(item_count="tc_id"), summary=True),
    Check("H03", INFO, "Item Staged Twice", lambda c: N.duplicate_rows(c.chk, ["tc_id"], "count"), ["tc_id"]),
    Check("H04", ISSUE, "Item Not Exist in Product System", lambda c: S.missing_in(c.chk, "tc_id", K.master(c.refs), "dw_key")),
    Check("H05", ISSUE, "Current Owning Group Not as Given", group_not_as_given),
    Check("H06", INFO, "Current Owning Group", lambda c: group_frequency(c, counted_master(c), "dw_pname", "owninggroup"), ["-count"], summary=True),
    Check("H07", INFO, "New Owning Group", new_group_frequency, ["-count"], summary=True),
    Check("H08", INFO, "Item Types", lambda c: S.joined_frequency(counted_master(c), {"tc_itemtype": "dw_item_type"}), ["-count"], summary=True),
    Check("H09", INFO, "Form Item Types", form_type_frequency, ["-count"], summary=True),
    Check("H10", ISSUE, "Item is Superseded", superseded),
    Check("H11", INFO, "Status Current", lambda c: S.joined_frequency(counted_master(c), {"status": "dw_status"}), ["-count"], summary=True),
    Check("H12", INFO, "Item Not Released", not_released, summary=True),
    Check("H13", INFO, "ERP Contexts", context_frequency, summary=True),
    Check("H14", INFO, "Item Has RDD", lambda c: L.defined_items(c.chk.select("tc_id"), c.refs, "tc_id", "working", upper=False).agg(F.count("*").alias("count")), summary=True),
    Check("H15", ISSUE, "RDD Grp Different from Part Grp", cross_documents),
    Check("H16", ISSUE, "Related Part of Given Part's RDD has Different Grp", cross_second_parts, ["tc_id", "rdd_id", "rel_partid"]),
    Check("H17", ISSUE, "Related Part of Given Doc has Different Grp from Doc Grp", cross_parts),
    Check("H18", BACKUP, "Backup", backup),
]

PACKAGE = Package("ownership", ["tc_id", "grp_old", "grp_new"], CHECKS)
