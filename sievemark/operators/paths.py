"""Join paths over the master tables that many checks share.

Every path returns fresh column names, so paths can be joined with each other freely. Types and
names that are filtered on are filtered before the join; no side is broadcast by hand, adaptive
execution decides from the sizes it sees.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.functions import patterns as P
from sievemark.functions import text as T
from sievemark.operators.keyed import latest_per_key
from sievemark.operators.sets import union_set

Refs = Mapping[str, DataFrame]

# Names of relation types, lists of values and note types.
DEFINING_DOCUMENT = "RelatedDefiningDocument"
RELATED_DOCUMENT = "RelatedDocuments"
MASTER_FORM = "IMAN_master_form"
SPECIFICATION = "IMAN_specification"
SUPERSEDED_BY = "Nov4_Superseded_by"
UNIT_LOV = "_RSOne_UnitsOfMeasure_"
UNIT_LOV_MARK = "%RSONE%"
DOCUMENT_TYPES_LOV = "ValidDocumentTypes_LOV"
REFERENCE_DESIGNATOR = "Reference Designator"
REFERENCE_COMMENTS = "Nov4RefDefComments"

# Names of paths that a run has cut to its staged ids and stored, see plans.shared.
SHARED_MASTER, SHARED_ITEMS = "shared_master", "shared_items"


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Only the given columns under new names."""
    return df.select(*[F.col(c).alias(n) for n, c in names.items()])


def master(refs: Refs, prefix="dw_") -> DataFrame:
    """Warehouse item master; all columns prefixed, plus the match key ``<prefix>key``."""
    if SHARED_MASTER in refs:
        dw = refs[SHARED_MASTER]
        return dw.select(*[F.col(c).alias(f"{prefix}{c}") for c in dw.columns])
    dw = refs["item_all_site"]
    return dw.select(*[F.col(c).alias(f"{prefix}{c}") for c in dw.columns], T.id_key("tc_id").alias(f"{prefix}key"))


def items(refs: Refs, local=False) -> DataFrame:
    """Items with their match key; ``local`` keeps those whose object is owned here."""
    if SHARED_ITEMS in refs:
        shared = refs[SHARED_ITEMS]
        return (shared.filter("is_local") if local else shared).drop("is_local")
    out = pick(refs["pitem"], item_puid="puid", tc_item_id="pitem_id", unit_puid="ruom_tagu")
    out = out.withColumn("item_key", T.id_key("tc_item_id"))
    if local:
        own = pick(refs["ppom_object"].filter(F.col("rowning_siteu").isNull()), own_puid="puid")
        out = out.join(own, F.col("item_puid") == F.col("own_puid"), "left_semi")
    return out


def items_with_site(refs: Refs) -> DataFrame:
    """All items of :func:`items`, marked whether their object is owned here."""
    own = pick(refs["ppom_object"].filter(F.col("rowning_siteu").isNull()), own_puid="puid").distinct()
    marked = items(refs).join(own, F.col("item_puid") == F.col("own_puid"), "left")
    return marked.withColumn("is_local", F.col("own_puid").isNotNull()).drop("own_puid")


def item_names(refs: Refs) -> DataFrame:
    """Id of each item by surrogate key, without the match key."""
    return pick(refs["pitem"], named_puid="puid", named_id="pitem_id")


def only(df: DataFrame, key: str, wanted: DataFrame | None) -> DataFrame:
    """Rows of a master path whose key is among the (one-column) ``wanted`` keys; all rows without any.

    Comes before what de-duplicates, lists or ranks rows of the path, so that work is done for staged items only.
    The plan of ``wanted`` is worked out once more, so it should be a short one.
    """
    if wanted is None:
        return df
    keys = wanted.toDF("_wanted").distinct()  # a key that many staged rows have is sent once
    return df.join(keys, F.col(key) == F.col("_wanted"), "left_semi")


def revisions(refs: Refs) -> DataFrame:
    return pick(refs["pitemrevision"], rev_puid="puid", rev_item="ritems_tagu", rev_id="pitem_revision_id")


def revision_dates(refs: Refs, of_items: DataFrame | None = None) -> DataFrame:
    """Revisions with creation date (application object) joined in."""
    dates = pick(refs["ppom_application_object"], app_puid="puid", rev_created="pcreation_date")
    return only(revisions(refs), "rev_item", of_items).join(dates, F.col("rev_puid") == F.col("app_puid")).drop("app_puid")


def latest_revisions(refs: Refs, kind: str, of_items: DataFrame | None = None) -> DataFrame:
    """Latest revision per item: ``created`` over all, ``released`` or ``working`` by release date.

    With ``of_items``, of these items only: the others are left out before revisions are ranked.

    A table ``z_max_rev_<kind>`` of the catalog is used if there is one.
    """
    given = f"z_max_rev_{kind}"
    if given in refs:
        return pick(refs[given], last_puid="puid", last_item="ritems_tagu", last_rev="pitem_revision_id")
    revs = revision_dates(refs, of_items)
    if kind != "created":
        wso = pick(refs["pworkspaceobject"], wso_puid="puid", wso_released="pdate_released")
        test = F.col("wso_released").isNotNull() if kind == "released" else F.col("wso_released").isNull()
        revs = revs.join(wso.filter(test), F.col("rev_puid") == F.col("wso_puid"))
    best = latest_per_key(revs, "rev_item", "rev_created", "rev_id", ["rev_puid", "rev_id"])
    return pick(best, last_puid="rev_puid", last_item="rev_item", last_rev="rev_id")


def item_status(refs: Refs, inner=True) -> DataFrame:
    """Release statuses per item; ``inner`` drops list entries without a status."""
    entries = pick(refs["prelease_status_list"], status_item="puid", status_entry="pvalu_0")
    names = pick(refs["preleasestatus"], status_puid="puid", status_name="pname")
    how = "inner" if inner else "left"
    return entries.join(names, F.col("status_entry") == F.col("status_puid"), how).select("status_item", "status_name")


def owners(refs: Refs, with_user=False) -> DataFrame:
    """Owning group (and user) of each object."""
    app = pick(refs["ppom_application_object"], owned_puid="puid", owned_group="rowning_groupu", owned_user="rowning_useru")
    groups = pick(refs["ppom_group"], group_puid="puid", owner_group="pname")
    out = app.join(groups, F.col("owned_group") == F.col("group_puid"))
    if with_user:
        users = pick(refs["ppom_user"], user_puid="puid", owner_user="puser_id")
        return out.join(users, F.col("owned_user") == F.col("user_puid")).select("owned_puid", "owner_group", "owner_user")
    return out.select("owned_puid", "owner_group")


def group_parents(refs: Refs) -> DataFrame:
    """Each group name with the name of its parent group, NULL without one."""
    groups = pick(refs["ppom_group"], group_name="pname", group_parent="rparentu")
    parents = pick(refs["ppom_group"], parent_puid="puid", parent="pname")
    return groups.join(parents, F.col("group_parent") == F.col("parent_puid"), "left").select("group_name", "parent")


def group_dimension(refs: Refs) -> DataFrame:
    return pick(
        refs["dim_group_master"],
        dim_group="group_name",
        primary_site="primary_site",
        business_unit="business_unit",
        parent_name="parent_name",
        erps="erps",
    )


def relations(refs: Refs, type_name: str) -> DataFrame:
    """Edges of one relation type."""
    types = refs["pimantype"].filter(F.col("ptype_name") == type_name)
    edges = pick(refs["pimanrelation"], primary="rprimary_objectu", secondary="rsecondary_objectu", edge_type="rrelation_typeu")
    return edges.join(pick(types, type_puid="puid"), F.col("edge_type") == F.col("type_puid")).select("primary", "secondary")


def related_documents(refs: Refs, type_name=DEFINING_DOCUMENT, with_group=False) -> DataFrame:
    """Revision -> related document: its surrogate key, id and, if asked for, owning group."""
    out = relations(refs, type_name).join(item_names(refs), F.col("secondary") == F.col("named_puid"))
    out = out.select(F.col("primary").alias("rel_rev"), F.col("secondary").alias("rel_doc"), F.col("named_id").alias("rdd_id"))
    if with_group:
        groups = pick(owners(refs), rdd_owned="owned_puid", rdd_grp="owner_group")
        out = out.join(groups, F.col("rel_doc") == F.col("rdd_owned")).drop("rdd_owned")
    return out


def related_parts(refs: Refs, type_name=DEFINING_DOCUMENT, with_group=True, of_documents: DataFrame | None = None) -> DataFrame:
    """Document -> parts whose revisions relate to it (the reverse direction), each part once."""
    out = (
        only(relations(refs, type_name), "secondary", of_documents)
        .join(revisions(refs), F.col("primary") == F.col("rev_puid"))
        .select("secondary", "rev_item")
        .distinct()
        .join(item_names(refs), F.col("rev_item") == F.col("named_puid"))
    )
    shown = [F.col("secondary").alias("part_doc"), F.col("named_id").alias("rel_part_id")]
    if with_group:
        groups = pick(owners(refs), part_owned="owned_puid", rel_part_grp="owner_group")
        out = out.join(groups, F.col("rev_item") == F.col("part_owned"))
        shown.append(F.col("rel_part_grp"))
    return out.select(*shown).distinct()


def master_forms(refs: Refs, tables: Sequence[str], cols: Sequence[str], how="left") -> DataFrame:
    """Item or revision -> columns of its master form, looked up in the union of form tables."""
    forms = pick(refs["pform"], form_puid="puid", form_data="rdata_fileu")
    data = union_set([refs[t].select(F.col("puid").alias("data_puid"), *cols) for t in tables])
    return (
        relations(refs, MASTER_FORM)
        .join(forms, F.col("secondary") == F.col("form_puid"))
        .join(data, F.col("form_data") == F.col("data_puid"), how)
        .select(F.col("primary").alias("form_of"), *cols)
    )


def dataset_files(refs: Refs) -> DataFrame:
    """Revision -> dataset name and the files in it."""
    sets = pick(refs["pdataset"], ds_puid="puid", ds_type="rdataset_typeu")
    types = pick(refs["pdatasettype"], dst_puid="puid")
    names = pick(refs["pworkspaceobject"], dsn_puid="puid", dataset_name_current="pobject_name")
    entries = pick(refs["pref_list_0"], entry_ds="puid", entry_file="pvalu_0")
    files = pick(refs["pimanfile"], file_puid="puid", dataset_namedref_current="poriginal_file_name")
    return (
        relations(refs, SPECIFICATION)
        .join(sets, F.col("secondary") == F.col("ds_puid"))
        .join(types, F.col("ds_type") == F.col("dst_puid"))
        .join(names, F.col("ds_puid") == F.col("dsn_puid"))
        .join(entries, F.col("ds_puid") == F.col("entry_ds"))
        .join(files, F.col("entry_file") == F.col("file_puid"))
        .select(F.col("primary").alias("files_rev"), "dataset_name_current", "dataset_namedref_current")
    )


def structures(refs: Refs) -> DataFrame:
    """Revision -> its structure."""
    return pick(refs["pstructure_revisions"], struct_rev="puid", struct_bvr="pvalu_0")


def children(refs: Refs) -> DataFrame:
    """Structure -> child occurrences."""
    return pick(
        refs["ppsoccurrence"],
        occ_bvr="rparent_bvru",
        occ_child="rchild_itemu",
        occ_qty="pqty_value",
        occ_seq="pseq_no",
        occ_notes="rnotes_refu",
    )


def occurrences(refs: Refs) -> DataFrame:
    """Revision -> child occurrences of its structure."""
    return structures(refs).join(children(refs), F.col("struct_bvr") == F.col("occ_bvr")).drop("occ_bvr", "struct_bvr")


def occurrence_notes(refs: Refs, type_name: str, name: str) -> DataFrame:
    """Note text of one type per occurrence."""
    kinds = pick(refs["pnotetype"].filter(F.col("pname") == type_name), kind_puid="puid")
    entries = pick(refs["pnote_types"], entry_puid="puid", entry_seq="pseq", entry_kind="pvalu_0")
    texts = pick(refs["pnote_texts"], text_puid="puid", text_seq="pseq", text="pval_0")
    notes = pick(refs["ppsoccurrencenotes"], note_puid="puid")
    same_entry = (F.col("entry_puid") == F.col("text_puid")) & (F.col("entry_seq") == F.col("text_seq"))
    return (
        entries.join(kinds, F.col("entry_kind") == F.col("kind_puid"))
        .join(texts, same_entry)
        .join(notes, F.col("entry_puid") == F.col("note_puid"))
        .select(F.col("note_puid").alias(f"{name}_notes"), F.col("text").alias(name))
    )


def alternate_ids(refs: Refs) -> DataFrame:
    """Item -> alternate ids and their context."""
    ids = pick(refs["pidentifier"], alt_item="raltid_ofu", altid="pidfr_id", alt_context="ridcontextu")
    contexts = pick(refs["pidcontext"], context_puid="puid", context="pidcxt_name")
    return ids.join(contexts, F.col("alt_context") == F.col("context_puid")).select("alt_item", "altid", "context")


def unit_values(refs: Refs) -> DataFrame:
    """Units of measure of the list of values: value, description and unit symbol."""
    lov = pick(refs["plistofvalues"].filter(F.col("plov_name") == UNIT_LOV), lov_puid="puid")
    vals = pick(refs["plov_values_2"], val_puid="puid", val_seq="pseq", rsuom="pval_0")
    descs = pick(refs["plov_value_descriptions_2"].filter(F.col("pval_0").like(UNIT_LOV_MARK)), desc_puid="puid", desc_seq="pseq", lov_desc="pval_0")
    units = pick(refs["punitofmeasure"], psymbol="psymbol")
    before_comma = T.null_if_blank(F.substring_index("lov_desc", ",", 1))
    described = F.when(F.locate(",", F.col("lov_desc")) > 1, before_comma)
    return (
        lov.join(vals, F.col("lov_puid") == F.col("val_puid"))
        .join(descs, (F.col("val_puid") == F.col("desc_puid")) & (F.col("val_seq") == F.col("desc_seq")))
        .join(units, F.upper("psymbol") == F.upper(described))
        .select("rsuom", "lov_desc", "psymbol")
    )


def document_types(refs: Refs) -> DataFrame:
    """Valid document types per category, from the lists whose name follows the subtype rule."""
    lov = refs["plistofvalues"].filter(F.col("plov_name").rlike(P.SUBTYPE_LOV_NAME))
    lov = lov.select(F.col("puid").alias("lov_puid"), T.first_match("plov_name", P.THREE_CAPITALS).alias("lov_category"))
    vals = pick(refs["plov_values_2"], val_puid="puid", lov_type="pval_0")
    return lov.join(vals, F.col("lov_puid") == F.col("val_puid")).select("lov_category", "lov_type")
