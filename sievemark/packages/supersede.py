"""Supersession checks."""

from pyspark.sql import functions as F

from sievemark.functions import text as T
from sievemark.operators import keyed as N
from sievemark.operators import parts as R
from sievemark.operators import paths as K
from sievemark.operators import reference as S
from sievemark.operators import relations as L
from sievemark.operators.sets import id_union
from sievemark.plans.check import BACKUP, INFO, ISSUE, Check, Context, Package

# The superseded side counts rows, the survivor side counts each id once.
SUPERSEDED = ("sup_id", False)
SURVIVOR = ("sur_id", True)


def counted_master(c: Context, side):
    col, distinct = side
    return S.id_counts(c.chk, col, distinct=distinct).join(K.master(c.refs), F.col("_id") == F.col("dw_key"))


def missing(side):
    col, distinct = side

    def make(c: Context):
        rows = c.chk.select(col)
        return S.missing_in(rows.distinct() if distinct else rows, T.id_key(col), K.master(c.refs), "dw_key")

    return make


def group_frequency(side):
    def make(c: Context):
        rows = counted_master(c, side).join(K.group_parents(c.refs), F.col("dw_pname") == F.col("group_name"), "left")
        return S.joined_frequency(rows, {"local_site": "dw_local_site", "parent": "parent", "owninggroup": "dw_pname"})

    return make


def master_frequency(side, col: str, name: str):
    return lambda c: S.joined_frequency(counted_master(c, side), {name: col})


def not_released(side):
    col, distinct = side

    def make(c: Context):
        rows = S.id_counts(c.chk, col, distinct=distinct).join(K.items(c.refs), F.col("_id") == F.col("item_key"))
        rows = rows.join(K.latest_revisions(c.refs, "released", rows.select("item_puid")), F.col("item_puid") == F.col("last_item"), "left_anti")
        return S.joined_count(rows)

    return make


def currently_superseded(c: Context):
    ids = id_union(c.chk, {"Superseded": "sup_id", "Survivor": "sur_id"})
    by = K.pick(c.refs["chk_superseded_items"], by_puid="superseded_puid", superseded_by="survivor_id")
    rows = ids.join(K.master(c.refs).filter(F.col("dw_status") == "Superseded"), T.id_key("tc_id") == F.col("dw_key"))
    return rows.join(by, F.col("dw_puid") == F.col("by_puid"), "left").select("tc_id", "type", "superseded_by")


def context_frequency(side):
    col, distinct = side

    def make(c: Context):
        alt = c.refs["altid_all_site"].select(T.id_key("pitem_id").alias("_key"), "pidcxt_name")
        rows = S.id_counts(c.chk, col, distinct=distinct).join(alt, F.col("_id") == F.col("_key"))
        return S.joined_frequency(rows, {"pidcxt_name": "pidcxt_name"}, "cnt")

    return make


def unit_differs(c: Context):
    sup = L.item_attributes(c.refs, c.chk, "sup_id", "sup", "supersede_legacy")
    sur = L.item_attributes(c.refs, c.chk, "sur_id", "sur", "survivor_legacy")
    return L.pair_attribute_diff(
        c.chk, ("sup_id", sup, "supersede_legacy"), ("sur_id", sur, "survivor_legacy"), [("sup_uom", "sur_uom"), ("sup_rsuom", "sur_rsuom")]
    )


def backup(c: Context):
    rows = L.with_owner(L.with_item(c.chk, c.refs, "sup_id"), c.refs)
    texts = K.pick(c.refs["pworkspaceobject"], wso_puid="puid", pobject_name="pobject_name", pobject_desc="pobject_desc")
    rows = rows.join(texts, F.col("item_puid") == F.col("wso_puid"))
    rows = L.with_revision(rows, c.refs, "working")
    rows = rows.join(K.alternate_ids(c.refs), F.col("item_puid") == F.col("alt_item"), "left")
    documents = K.related_documents(c.refs, with_group=True).withColumnRenamed("rdd_id", "current_rdd")
    rows = rows.join(documents, F.col("last_puid") == F.col("rel_rev"), "left")
    rows = rows.join(K.item_status(c.refs, inner=False), F.col("item_puid") == F.col("status_item"), "left")
    return rows.select(
        "grp",
        "sup_id",
        F.col("last_rev").alias("max_rev_working"),
        "pobject_name",
        "pobject_desc",
        F.col("status_name").alias("status"),
        "altid",
        "context",
        F.col("current_rdd").alias("rdd_id"),
        "rdd_grp",
    )


def _part_side(c: Context):
    return c.chk.select("sup_id")


CHECKS = [
    Check("E01", INFO, "Total Rows", lambda c: R.row_count("row_count"), summary=True),
    Check("E02", INFO, "Count Items", lambda c: R.distinct_counts_and_total("total", sup_count="sup_id", sur_count="sur_id"), summary=True),
    Check("E03", INFO, "Item Staged Twice", lambda c: N.duplicate_rows(c.chk, ["sup_id"], "count"), ["sup_id"]),
    Check("E04", ISSUE, "Superseded Not Exist In Warehouse", missing(SUPERSEDED)),
    Check("E05", ISSUE, "Survivor Not Exist In Warehouse", missing(SURVIVOR)),
    Check("E06", INFO, "Superseded Owning Group", group_frequency(SUPERSEDED), ["local_site", "-count"], summary=True),
    Check("E07", INFO, "Survivor Owning Group", group_frequency(SURVIVOR), ["local_site", "-count"], summary=True),
    Check("E08", INFO, "Superseded Item Type", master_frequency(SUPERSEDED, "dw_item_type", "item_type"), ["-count"], summary=True),
    Check("E09", INFO, "Survivor Item Type", master_frequency(SURVIVOR, "dw_item_type", "item_type"), ["-count"], summary=True),
    Check("E10", INFO, "Superseded Status Current", master_frequency(SUPERSEDED, "dw_status", "status"), ["-count"], summary=True),
    Check("E11", INFO, "Survivor Status Current", master_frequency(SURVIVOR, "dw_status", "status"), ["-count"], summary=True),
    Check("E12", INFO, "Superseded Not Released", not_released(SUPERSEDED), summary=True),
    Check("E13", INFO, "Survivor Not Released", not_released(SURVIVOR), summary=True),
    Check("E14", ISSUE, "Item Is Currently Superseded", currently_superseded, ["type", "tc_id"]),
    Check("E15", INFO, "Superseded ERP Context", context_frequency(SUPERSEDED), ["pidcxt_name"], summary=True),
    Check("E16", INFO, "Survivor ERP Context", context_frequency(SURVIVOR), ["pidcxt_name"], summary=True),
    Check("E17", ISSUE, "Superseded and Survivor ERPs Dont Match", lambda c: L.contexts_contained(c.chk, c.refs["altid_all_site"], "sup_id", "sur_id", c.params.get("only_mismatch", False)), ["sup_id", "sup_cxt"]),
    Check("E18", ISSUE, "Superseded and Survivor IPs Dont Match", lambda c: L.tokens_contained(c.chk, c.refs, "sup_id", "sur_id", c.params.get("only_mismatch", False)), ["sup_id", "sup_ip"]),
    Check("E19", INFO, "Given SupPart-RDD Relation Not Match", lambda c: L.relation_lookup(c.chk.select("sup_id", F.col("rdd_id").alias("staged_rdd")), c.refs, "sup_id", "released", "staged_rdd")),
    Check("E20", INFO, "Superseded Has RDD", lambda c: L.defined_items(_part_side(c), c.refs, "sup_id", "released").agg(F.count("*").alias("count")), summary=True),
    Check("E21", ISSUE, "RDD Grp Different from Sup Part Grp", lambda c: L.cross_group_documents(_part_side(c), c.refs, "sup_id", "released", ["grp", "sup_id", F.col("last_rev").alias("max_rev_released"), "rdd_id", "rdd_grp"])),
    Check("E22", ISSUE, "Related Part of Given Sup Doc has Different Grp from Doc Grp", lambda c: L.cross_group_parts(_part_side(c), c.refs, "sup_id", "released", ["grp", F.col("tc_item_id").alias("sup_doc_id"), F.col("last_rev").alias("max_rev_released"), "rel_part_id", "rel_part_grp"])),
    Check("E23", ISSUE, "Superseded and Survivor UOM Not Same", unit_differs),
    Check("E24", BACKUP, "Backup", backup),
]

PACKAGE = Package("supersede", ["sup_id", "sur_id"], CHECKS)
