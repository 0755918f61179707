"""Document relation load checks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.functions import text as T
from sievemark.functions import values as V
from sievemark.operators import keyed as N
from sievemark.operators import parts as R
from sievemark.operators import paths as K
from sievemark.operators import reference as S
from sievemark.operators import relations as L
from sievemark.operators.sets import id_union
from sievemark.plans.check import INFO, ISSUE, Check, Context, Package


def not_in_product_system(c: Context):
    ids = id_union(c.chk, {"PART": T.id_key("item_id"), "DOCUMENTS": T.id_key("doc_id")})
    return S.missing_in(ids, "tc_id", K.items(c.refs, local=True), "item_key")


def added_more_than_once(relation: str, with_document_key: bool):
    """Documents related more than once to a revision.

    The check on related documents also partitions by the document it counts, so as published it
    never reports; with the parameter ``fixed`` it reports relation rows staged more than once.
    """

    def make(c: Context):
        rows = c.chk.filter(F.col("relationship_type") == relation)
        keys = ["item_id", "revision", "relationship_type"]
        if not with_document_key:
            return N.multi_value_rows(rows, keys, "doc_id", count_name="count", distinct=False)
        if c.params.get("fixed"):
            return N.duplicate_rows(rows, [*keys, "doc_id"], "count")
        return N.multi_value_rows(rows, [*keys, "doc_id"], "doc_id", count_name="count", distinct=False)

    return make


def related_now(c: Context, relation: str) -> DataFrame:
    rows = L.with_given_revision(L.with_item(c.chk, c.refs, "item_id"), c.refs, "revision")
    return rows.join(K.related_documents(c.refs, relation), F.col("rev_puid") == F.col("rel_rev"))


def given(relation: str):
    return F.when(F.col("relationship_type") == relation, F.col("doc_id"))


def existing_defining(c: Context):
    return related_now(c, K.DEFINING_DOCUMENT).select(
        "item_id",
        "revision",
        given(K.DEFINING_DOCUMENT).alias("given_rdd"),
        F.col("rdd_id").alias("current_rdd"),
        V.flag(F.col("rdd_id") == F.col("doc_id")).alias("is_match"),
    )


def existing_related(c: Context):
    rows = related_now(c, K.RELATED_DOCUMENT)
    show = ["item_id", "revision", given(K.RELATED_DOCUMENT).alias("given_rd"), F.col("rdd_id").alias("current_rd")]
    return S.delta_update(rows, "rdd_id", "doc_id", show=show)


def given_revision_missing(c: Context):
    rows = L.with_given_revision(L.with_item(c.chk, c.refs, "item_id"), c.refs, "revision", "left", ignore_case=True)
    return S.missing_value(rows, "rev_puid", c.chk.columns)


def latest_created_differs(c: Context):
    """Given revision versus latest created revision of the document, with the list of all revisions.

    The list repeats each revision once per staged row of the same document and revision.
    """
    columns = c.chk.columns
    # Counted from the staged rows, not from their groups, of which there may be as many.
    per_pair = c.chk.groupBy(T.id_key("doc_id").alias("_key"), "revision").agg(F.count("*").alias("_copies"))
    items = per_pair.join(K.items(c.refs, local=True), F.col("_key") == F.col("item_key"))
    pairs = S.delta_update(L.with_revision(items, c.refs, "created"), "last_rev", "revision")
    pairs = pairs.select("_key", "revision", "_copies", "item_puid", F.col("last_rev").alias("doc_rev_latest"))
    listed = pairs.join(K.revision_dates(c.refs, items.select("item_puid")), F.col("item_puid") == F.col("rev_item"))
    # Items of the same key are listed on their own; equal lists of one key count once.
    keys = ["_key", "revision", "_copies", "item_puid", "doc_rev_latest"]
    lists = N.value_lists(listed, keys, "rev_id", "doc_rev_list", order=["rev_created"], copies=F.col("_copies"))
    lists = lists.drop("item_puid").distinct()
    staged = c.chk.distinct().withColumn("_key", T.id_key("doc_id"))
    rows = N.join_key_statistic(staged, lists, ["_key", "revision"], "_copies", weights=per_pair)
    return rows.select(*columns, "doc_rev_latest", "doc_rev_list")


def not_latest(kind: str):
    def make(c: Context):
        rows = L.with_revision(L.with_item(c.chk, c.refs, "item_id"), c.refs, kind)
        return S.delta_update(rows, "revision", "last_rev", show=[*c.chk.columns, F.col("last_rev").alias(f"current_{kind}_rev")])

    return make


def _counted_items(c: Context, col: str, local: bool):
    return S.id_counts(c.chk, col).join(K.items(c.refs, local), F.col("_id") == F.col("item_key"))


def status_frequency(col: str, count_name: str, name: str, local: bool):
    def make(c: Context):
        rows = _counted_items(c, col, local).join(K.item_status(c.refs, inner=local), F.col("item_puid") == F.col("status_item"), "left")
        return S.joined_frequency(rows, {name: "status_name"}, count_name, "NULL")

    return make


def status_rows(test, name: str, local: bool):
    def make(c: Context):
        rows = L.with_item(c.chk, c.refs, "item_id", local=local)
        rows = rows.join(K.item_status(c.refs, inner=local), F.col("item_puid") == F.col("status_item"), "left")
        return rows.filter(test()).select(F.col("status_name").alias(name), *c.chk.columns)

    return make


def is_superseded():
    return F.coalesce("status_name", F.lit("None")) == "Superseded"


def group_frequency(col: str, count_name: str):
    def make(c: Context):
        rows = L.with_owner(_counted_items(c, col, local=False), c.refs)
        return S.joined_frequency(rows, {"owninggroup": "grp"}, count_name, "NULL")

    return make


def _released(c: Context, rows, given_revision: bool):
    if given_revision:
        rows = L.with_given_revision(rows, c.refs, "revision")
    else:
        rows = rows.join(K.revisions(c.refs), F.col("item_puid") == F.col("rev_item"))
    dates = K.pick(c.refs["pworkspaceobject"], wso_puid="puid", date_released="pdate_released")
    return rows.join(dates, F.col("rev_puid") == F.col("wso_puid"))


def released_frequency(col: str, count_name: str, given_revision: bool):
    def make(c: Context):
        keys = ["revision"] if given_revision else []
        counts = c.chk.groupBy(T.id_key(col).alias("_id"), *keys).agg(F.count("*").alias("_n"))
        rows = counts.join(K.items(c.refs), F.col("_id") == F.col("item_key"))
        return S.joined_frequency(_released(c, rows, given_revision), {"released": V.yes_no("date_released")}, count_name)

    return make


def not_released(col: str, given_revision: bool):
    def make(c: Context):
        rows = _released(c, L.with_item(c.chk, c.refs, col, local=False), given_revision)
        show = [col, F.col("rev_id").alias("pitem_revision_id"), V.yes_no("date_released").alias("released")]
        return S.missing_value(rows, "date_released", show)

    return make


CHECKS = [
    Check("C01", INFO, "Count Total Rows", lambda c: R.row_count(), summary=True),
    Check("C02", INFO, "Count Parts and Docs", lambda c: R.distinct_counts_and_total("total_items", parts="item_id", docs="doc_id")),
    Check("C03", INFO, "Item Staged Twice", lambda c: N.duplicate_rows(c.chk, [T.id_key(x) for x in ("item_id", "revision", "doc_id", "relationship_type")], distinct=True)),
    Check("C04", ISSUE, "Item Not Exist in Product System", not_in_product_system),
    Check("C05", INFO, "Given Relations Count", lambda c: R.value_frequency("relationship_type", count_name="count"), summary=True),
    Check("C06", ISSUE, "RDD Added Multiple Times", added_more_than_once(K.DEFINING_DOCUMENT, False), ["item_id", "doc_id"]),
    Check("C07", INFO, "RD Added Multiple Times", added_more_than_once(K.RELATED_DOCUMENT, True), ["item_id", "doc_id"]),
    Check("C08", INFO, "Parts with Existing RDD", existing_defining),
    Check("C09", INFO, "Parts with Existing RD", existing_related),
    Check("C10", ISSUE, "Given Part REV does not Exist", given_revision_missing),
    Check("C11", INFO, "Part Latest Rev and Doc Latest Rev Mismatch", latest_created_differs, ["item_id", "revision", "doc_id"]),
    Check("C12", INFO, "Given Part REV is Not Current Released REV", not_latest("released")),
    Check("C13", INFO, "Given Part REV is Not Current Working REV", not_latest("working")),
    Check("C14", INFO, "Status - Part", status_frequency("item_id", "parts", "status", True), ["-parts"], summary=True),
    Check("C15", INFO, "Status - Doc", status_frequency("doc_id", "docs", "status", True), ["-docs"], summary=True),
    Check("C16", ISSUE, "Status is Superseded - Part", status_rows(is_superseded, "item_status", True)),
    Check("C17", ISSUE, "Status Missing - Part", status_rows(lambda: F.col("status_item").isNull(), "item_status", True)),
    Check("C18", INFO, "Lifecycle - Part", status_frequency("item_id", "parts", "lifecycle", False), ["-parts"], summary=True),
    Check("C19", INFO, "Lifecycle - Doc", status_frequency("doc_id", "docs", "lifecycle", False), ["-docs"], summary=True),
    Check("C20", ISSUE, "Lifecycle is Superseded - Part", status_rows(is_superseded, "item_lifecycle", False)),
    Check("C21", ISSUE, "Lifecycle Missing - Part", status_rows(lambda: F.col("status_name").isNull(), "item_lifecycle", False)),
    Check("C22", INFO, "Owning Group - Part", group_frequency("item_id", "parts"), ["-parts"], summary=True),
    Check("C23", INFO, "Owning Group - Doc", group_frequency("doc_id", "docs"), ["-docs"], summary=True),
    Check("C24", INFO, "Released - Part", released_frequency("item_id", "part_revisions", True), ["-part_revisions"], summary=True),
    Check("C25", INFO, "Released - Doc", released_frequency("doc_id", "doc_revisions", False), ["-doc_revisions"], summary=True),
    Check("C26", ISSUE, "Not Released - Parts", not_released("item_id", True)),
    Check("C27", ISSUE, "Not Released - Docs", not_released("doc_id", False)),
]

PACKAGE = Package("doc_relation", "item_id revision doc_id relationship_type".split(), CHECKS)
