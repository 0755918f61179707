"""Status request checks (obsolete, active, phase out)."""

from pyspark.sql import functions as F

from sievemark.operators import keyed as N
from sievemark.operators import parts as R
from sievemark.operators import paths as K
from sievemark.operators import reference as S
from sievemark.operators import relations as L
from sievemark.plans.check import BACKUP, INFO, ISSUE, Check, Context, Package

PART_TYPES = ("Nov4Part", "Non-Engineering")
DEAD_STATUSES = ("Superseded", "Obsolete")


def counted_master(c: Context):
    return S.id_counts(c.chk, "tc_id", upper=False).join(K.master(c.refs), F.col("_id") == F.col("dw_key"))


def staged_master(c: Context):
    return c.chk.join(K.master(c.refs), F.col("tc_id") == F.col("dw_key"))


def local_items(c: Context):
    return L.with_item(c.chk, c.refs, "tc_id", upper=False)


def relation_mismatch(c: Context):
    staged = c.chk.select("tc_id", F.col("rdd_id").alias("staged_rdd"))
    return L.relation_lookup(staged, c.refs, "tc_id", "released", "staged_rdd", upper=False)


def group_frequency(c: Context):
    rows = counted_master(c).join(K.group_parents(c.refs), F.col("dw_pname") == F.col("group_name"), "left")
    return S.joined_frequency(rows, {"local_site": "dw_local_site", "parent": "parent", "owninggroup": "dw_pname"})


def lifecycle_frequency(c: Context):
    rows = S.id_counts(c.chk, "tc_id", upper=False).join(K.items(c.refs, local=True), F.col("_id") == F.col("item_key"))
    rows = L.with_revision(rows, c.refs, "released", "left")
    forms = K.master_forms(c.refs, ["part_revision_form", "document_revision_form", "version_form"], ["plifecycle"])
    rows = rows.join(forms, F.col("last_puid") == F.col("form_of"), "left")
    return S.joined_frequency(rows, {"plifecycle": "plifecycle"}, "cnt")


def dead_items(c: Context):
    replaced = K.relations(c.refs, K.SUPERSEDED_BY).select(F.col("primary").alias("replaced")).distinct()
    rows = staged_master(c).join(replaced, F.col("dw_puid") == F.col("replaced"), "left")
    rows = rows.filter(F.col("dw_status").isin(*DEAD_STATUSES) | F.col("replaced").isNotNull())
    reltype = F.when(F.col("replaced").isNotNull(), F.lit(K.SUPERSEDED_BY)).alias("reltype")
    return rows.select(*c.chk.columns, *[F.col(f"dw_{x}").alias(x) for x in ("pobject_name", "pobject_desc", "status")], reltype)


def active_without(lookup, key: str):
    """Active requests whose item has no row in the lookup."""

    def make(c: Context):
        rows = L.with_item(c.chk.filter(F.col("status_new") == "ACTIVE"), c.refs, "tc_id", upper=False)
        return rows.join(lookup(c), F.col("item_puid") == F.col(key), "left_anti").select(*c.chk.columns)

    return make


def cross_documents(c: Context):
    show = [F.col("grp").alias("item_grp"), F.col("tc_item_id").alias("pitem_id"), F.col("last_rev").alias("max_rev_released"), "rdd_id", "rdd_grp"]
    return L.cross_group_documents(c.chk.select("tc_id"), c.refs, "tc_id", "released", show, upper=False)


def cross_parts(c: Context):
    show = [F.col("grp").alias("doc_grp"), F.col("tc_item_id").alias("doc_id"), F.col("last_rev").alias("max_rev_released"), "rel_part_id", "rel_part_grp"]
    return L.cross_group_parts(c.chk.select("tc_id"), c.refs, "tc_id", "released", show, upper=False)


def backup(c: Context):
    dw = K.master(c.refs)
    staged = c.chk.select("tc_id").distinct()
    shown = [F.col(x).alias(x[3:]) for x in dw.columns if x != "dw_key"]
    master = staged.join(dw, F.col("tc_id") == F.col("dw_key")).select(*shown).distinct()
    # Relations are found for the keys alone: a document has many parts, and a row of the master may be wide.
    keys = staged.join(dw.select("dw_key", "dw_puid"), F.col("tc_id") == F.col("dw_key")).select("dw_puid").distinct()
    items = keys.join(K.items(c.refs, local=True), F.col("dw_puid") == F.col("item_puid")).select("item_puid")
    rows = L.with_revision(items, c.refs, "working")
    documents = K.related_documents(c.refs).select("rel_rev", "rdd_id").distinct()
    rows = rows.join(documents, F.col("last_puid") == F.col("rel_rev"), "left")
    parts = K.related_parts(c.refs, with_group=False, of_documents=items)
    rows = rows.join(parts, F.col("item_puid") == F.col("part_doc"), "left")
    found = rows.select("item_puid", F.col("last_rev").alias("max_rev_working"), "rdd_id", F.col("rel_part_id").alias("related_part")).distinct()
    # Both sides are sets, so their join on the key is one.
    return master.join(found, F.col("puid") == F.col("item_puid")).drop("item_puid")


CHECKS = [
    Check("G01", INFO, "Total Rows", lambda c: R.row_count("row_count"), summary=True),
    Check("G02", INFO, "Count Items", lambda c: R.distinct_count(item_count="tc_id"), summary=True),
    Check("G03", INFO, "Count RDDs", lambda c: R.distinct_count(item_count="rdd_id"), summary=True),
    Check("G04", INFO, "Item Staged Twice", lambda c: N.duplicate_rows(c.chk, ["tc_id"], "count"), ["tc_id"]),
    Check("G05", INFO, "RDD Staged Twice", lambda c: N.duplicate_rows(c.chk, ["rdd_id", "tc_id"], "count", where=F.col("rdd_id").isNotNull()), ["rdd_id"]),
    Check("G06", ISSUE, "Item Not Exist In Product System", lambda c: S.missing_in(c.chk, "tc_id", K.master(c.refs), "dw_key")),
    Check("G07", ISSUE, "RDD Not Exist In Product System", lambda c: S.missing_in(c.chk, "rdd_id", K.master(c.refs), "dw_key", when=F.col("rdd_id").isNotNull())),
    Check("G08", ISSUE, "Part-RDD Relation Mismatch", relation_mismatch),
    Check("G09", INFO, "Owning Group", group_frequency, ["-count"], summary=True),
    Check("G10", INFO, "Item Type", lambda c: S.joined_frequency(counted_master(c), {"item_type": "dw_item_type"}), ["-count"], summary=True),
    Check("G11", ISSUE, "Item Not A Part", lambda c: S.not_in_values(staged_master(c).drop("tc_id"), "dw_item_type", PART_TYPES, [F.col("dw_tc_id").alias("tc_id"), F.col("dw_item_type").alias("item_type")])),
    Check("G12", INFO, "Item Status Current", lambda c: S.joined_frequency(counted_master(c), {"status": "dw_status"}), ["-count"], summary=True),
    Check("G13", ISSUE, "Item Lifecycle Current", lifecycle_frequency, ["-cnt"], summary=True),
    Check("G14", INFO, "Item Status to Update", lambda c: R.value_frequency("status_new", count_name="count"), summary=True),
    Check("G15", ISSUE, "Item is Superseded or Obsolete", dead_items),
    Check("G16", ISSUE, "Item is Not Released", active_without(lambda c: K.latest_revisions(c.refs, "released"), "last_item")),
    Check("G17", ISSUE, "Item Has No Alt ID", active_without(lambda c: K.alternate_ids(c.refs), "alt_item")),
    Check("G18", INFO, "Given Part-RDD Relation Not Match", relation_mismatch),
    Check("G19", ISSUE, "RDD Grp Different from Part Grp", cross_documents),
    Check("G20", ISSUE, "Related Part of Given Item (Doc) has Different Grp from Item (Doc) Grp", cross_parts),
    Check("G21", BACKUP, "Backup", backup, ["puid"]),
]

PACKAGE = Package("status", ["tc_id", "status_new"], CHECKS)
