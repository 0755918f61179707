"""Checks over relations between items: lookups, groups, containment, pairs, snapshots."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions import text as T
from sievemark.functions import values as V
from sievemark.operators import paths as K
from sievemark.operators.keyed import value_lists
from sievemark.operators.sets import anti_join_any


def with_item(chk: DataFrame, refs: K.Refs, col: str, local=True, upper=True) -> DataFrame:
    """Staged rows joined with their item; ``upper=False`` where staging already capitalised the id."""
    key = T.id_key(col) if upper else F.col(col)
    return chk.join(K.items(refs, local), key == F.col("item_key"))


def with_revision(rows: DataFrame, refs: K.Refs, kind: str, how="inner") -> DataFrame:
    """Joined with the latest released, working or created revision of the item."""
    return rows.join(K.latest_revisions(refs, kind, rows.select("item_puid")), F.col("item_puid") == F.col("last_item"), how)


def with_given_revision(rows: DataFrame, refs: K.Refs, col: str, how="inner", ignore_case=False) -> DataFrame:
    left, right = (T.id_key("rev_id"), T.id_key(col)) if ignore_case else (F.col("rev_id"), F.col(col))
    return rows.join(K.revisions(refs), (F.col("item_puid") == F.col("rev_item")) & (left == right), how)


def with_owner(rows: DataFrame, refs: K.Refs, of: str = "item_puid", name="grp") -> DataFrame:
    groups = K.pick(K.owners(refs), **{f"_{name}_of": "owned_puid", name: "owner_group"})
    return rows.join(groups, F.col(of) == F.col(f"_{name}_of")).drop(f"_{name}_of")


def with_documents(rows: DataFrame, refs: K.Refs, type_name=K.DEFINING_DOCUMENT) -> DataFrame:
    """Joined with the related documents of the latest revision and their groups, hop by hop from the rows."""
    out = rows.join(K.relations(refs, type_name), F.col("last_puid") == F.col("primary"))
    out = out.join(K.item_names(refs), F.col("secondary") == F.col("named_puid"))
    out = out.withColumnsRenamed({"secondary": "rel_doc", "named_id": "rdd_id"}).drop("primary", "named_puid")
    return with_owner(out, refs, "rel_doc", "rdd_grp")


def with_occurrences(rows: DataFrame, refs: K.Refs, of: str = "rev_puid") -> DataFrame:
    """Joined with the child occurrences of a revision; structures first, so that occurrences are dealt once, not twice."""
    out = rows.join(K.structures(refs), F.col(of) == F.col("struct_rev"))
    return out.join(K.children(refs), F.col("struct_bvr") == F.col("occ_bvr")).drop("occ_bvr", "struct_bvr")


def relation_lookup(
    chk: DataFrame, refs: K.Refs, col: str, kind: str, given: str | None = None, upper=True, type_name=K.DEFINING_DOCUMENT
) -> DataFrame:
    """Given versus actual related document on the latest revision of each staged item."""
    rows = with_revision(with_item(chk, refs, col, upper=upper), refs, kind)
    rows = rows.join(K.related_documents(refs, type_name), F.col("last_puid") == F.col("rel_rev"), "left")
    return rows.filter(V.differs_null_safe(given, "rdd_id", "None")).select(
        col, F.col(given).alias("given_rdd"), F.col("rdd_id").alias("actual_rdd"), F.col("last_rev").alias("on_max_rev_released")
    )


def defined_items(chk: DataFrame, refs: K.Refs, col: str, kind: str, upper=True) -> DataFrame:
    """Staged items with owning group, latest revision and its defining documents with their groups."""
    rows = with_owner(with_item(chk, refs, col, upper=upper), refs)
    rows = with_revision(rows, refs, kind)
    return with_documents(rows, refs)


def cross_group_documents(chk: DataFrame, refs: K.Refs, col: str, kind: str, show: Sequence[str | Column], upper=True) -> DataFrame:
    """Items whose defining document belongs to another group."""
    return defined_items(chk, refs, col, kind, upper).filter(F.col("grp") != F.col("rdd_grp")).select(*show)


def cross_group_parts(
    chk: DataFrame, refs: K.Refs, col: str, kind: str, show: Sequence[str | Column], upper=True, only: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Documents one of whose related parts belongs to another group."""
    rows = with_owner(with_item(chk, refs, col, upper=upper), refs)
    if only is not None:
        rows = only(rows)
    # Documents without related parts fall out before their revisions are ranked.
    rows = rows.join(K.related_parts(refs, of_documents=rows.select("item_puid")), F.col("item_puid") == F.col("part_doc"))
    rows = with_revision(rows, refs, kind)
    return rows.filter(F.col("grp") != F.col("rel_part_grp")).select(*show)


def cross_group_second_parts(chk: DataFrame, refs: K.Refs, col: str, kind: str, show: Sequence[str | Column], upper=True) -> DataFrame:
    """Two steps: item to its defining document to the other parts of that document, groups differing."""
    rows = defined_items(chk, refs, col, kind, upper)
    # All documents of the rows are items: a shorter plan than that of the rows, which would be worked out twice.
    items = K.item_names(refs).select("named_puid")
    rows = rows.join(K.related_parts(refs, of_documents=items), F.col("rel_doc") == F.col("part_doc"))
    return rows.filter(F.col("grp") != F.col("rel_part_grp")).select(*show)


def without_staged(rows: DataFrame, chk: DataFrame, id_col: str, staged_id: str, grp_col: str, staged_grp: str) -> DataFrame:
    """Drop rows whose part is staged itself or whose group is the new group of any staged row."""
    return anti_join_any(rows, (id_col, chk, staged_id), (grp_col, chk, staged_grp))


def contexts_contained(chk: DataFrame, alt: DataFrame, left: str, right: str, only_mismatch=False) -> DataFrame:
    """Contexts of the left item and whether the right item has them too; matches are listed as well.

    The flag column is 1 where the right item lacks the context, else NULL.
    """
    pairs = chk.select(left, right).distinct()
    # Alternate ids of staged items only, before they are made distinct and listed.
    alt = alt.select("pitem_id", "pidcxt_name", T.id_key("pitem_id").alias("_akey"))
    of_left, alt = K.only(alt, "_akey", pairs.select(T.id_key(left))), K.only(alt, "_akey", pairs.select(T.id_key(right)))
    lefts = of_left.select(F.col("_akey").alias("_lkey"), F.col("pidcxt_name").alias("sup_cxt")).distinct()
    wanted = pairs.join(lefts, T.id_key(left) == F.col("_lkey")).select(left, "sup_cxt", right).distinct()
    has = alt.select(F.col("_akey").alias("_rkey"), F.col("pidcxt_name").alias("_rcxt")).distinct()
    found = wanted.join(has, (T.id_key(right) == F.col("_rkey")) & (F.col("sup_cxt") == F.col("_rcxt")), "left")
    nomatch = F.when(F.col("_rcxt").isNull(), F.lit(1)).alias("is_nomatch")
    lists = value_lists(alt.select("pitem_id", "pidcxt_name"), ["pitem_id"], "pidcxt_name", "sur_cxt_list", sep=",")
    named = alt.select("pitem_id").distinct().join(lists.withColumnRenamed("pitem_id", "_item"), F.col("pitem_id").eqNullSafe(F.col("_item")), "left")
    named = named.select(T.id_key("pitem_id").alias("_pkey"), "sur_cxt_list")
    out = found.join(named, T.id_key(right) == F.col("_pkey"), "left").select(nomatch, left, "sup_cxt", right, "sur_cxt_list").distinct()
    return out.filter(F.col("is_nomatch") == 1) if only_mismatch else out


def tokens_contained(chk: DataFrame, refs: K.Refs, left: str, right: str, only_mismatch=False) -> DataFrame:
    """Integration points of the left item and whether the right item's list has them too.

    Both token arrays are built on the row of the pair, so no row identity join is needed.
    """
    dw = refs["item_all_site"]
    text = F.replace("ip", F.lit("-"), F.lit("_"))
    lefts = dw.select(T.id_key("tc_id").alias("_lkey"), T.word_tokens("ip").alias("_ltokens"))
    rights = dw.select(T.id_key("tc_id").alias("_rkey"), T.word_tokens("ip").alias("_rtokens"), text.alias("sur_ip_list"))
    rows = (
        chk.select(left, right)
        .distinct()
        .join(lefts, F.col(left) == F.col("_lkey"))
        .join(rights, F.col(right) == F.col("_rkey"))
        .select(left, right, "_rtokens", "sur_ip_list", F.explode("_ltokens").alias("sup_ip"))
    )
    hit = F.coalesce(F.array_contains("_rtokens", F.col("sup_ip")), F.lit(False))
    triple = [left, "sup_ip", right]
    per_list = rows.groupBy(*triple, "sur_ip_list").agg(F.max(hit).alias("_hit"))
    any_hit = per_list.groupBy(*[F.col(c).alias(f"_t_{c}") for c in triple]).agg(F.max("_hit").alias("_any"))
    out = per_list.join(any_hit, [F.col(c) == F.col(f"_t_{c}") for c in triple])
    out = out.select(F.when(~F.col("_any"), F.lit(1)).alias("is_nomatch"), left, "sup_ip", right, "sur_ip_list")
    return out.filter(F.col("is_nomatch") == 1) if only_mismatch else out


def item_attributes(refs: K.Refs, ids: DataFrame, col: str, prefix: str, id_name: str) -> DataFrame:
    """Unit of measure of the item and of its master form, for one side of a pair."""
    units = K.pick(refs["punitofmeasure"], unit="puid", symbol="psymbol")
    forms = K.master_forms(refs, ["part_form", "nonengineering_form"], ["prsone_uom"], how="inner").filter(F.col("prsone_uom").isNotNull())
    known = K.pick(refs["pworkspaceobject"], wso="puid")
    rows = with_owner(with_item(ids.select(col).distinct(), refs, col), refs)
    rows = rows.join(known, F.col("item_puid") == F.col("wso")).join(units, F.col("unit_puid") == F.col("unit"), "left")
    rows = rows.join(forms, F.col("item_puid") == F.col("form_of"), "left")
    return rows.select(
        F.col("item_puid").alias(f"{prefix}_puid"),
        F.col(col).alias(id_name),
        F.col("symbol").alias(f"{prefix}_uom"),
        F.col("prsone_uom").alias(f"{prefix}_rsuom"),
    ).distinct()


def pair_attribute_diff(pairs: DataFrame, left: tuple[str, DataFrame, str], right: tuple[str, DataFrame, str], compare: Sequence[tuple[str, str]]) -> DataFrame:
    """Pairs any of whose compared attributes differ, NULL read as ``none``."""
    (lcol, lattrs, lid), (rcol, rattrs, rid) = left, right
    rows = pairs.select(F.col(lcol).alias("_l"), F.col(rcol).alias("_r"))
    rows = rows.join(rattrs, F.col("_r") == F.col(rid)).join(lattrs, F.col("_l") == F.col(lid))
    test = F.lit(False)
    for a, b in compare:
        test = test | V.differs_null_safe(a, b)
    return rows.filter(test).select(*lattrs.columns, *rattrs.columns)
