"""One query per operator over the sample tables: a Spark function and, where SQL can say it, the SQL.

``c`` is the catalog of base tables and sample views; ``{name}`` in the SQL marks a table or view.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from registry import files
from sievemark.functions import patterns as P
from sievemark.functions import text as T
from sievemark.functions import values as V
from sievemark.operators import keyed as N
from sievemark.operators import ordered as OR
from sievemark.operators import parts as R
from sievemark.operators import paths as K
from sievemark.operators import reference as S
from sievemark.operators import relations as L
from sievemark.operators import rows as A
from sievemark.operators import sets as U
from sievemark.packages import PACKAGES, SAMPLE_INPUTS
from sievemark.plans import check as C
from sievemark.plans import datasets as D
from sievemark.plans import extract as E
from sievemark.plans import fused as FU
from sievemark.plans import loadplan as LP
from sievemark.plans import runner as RU
from sievemark.plans import split as SP
from sievemark.plans import staging as ST
from sievemark.plans.shared import drop_shared, share_paths
from sievemark.sources import readers as RD

OPS: dict[str, tuple] = {}


def op(name, sql=None):
    def add(fn):
        OPS[name] = (fn, sql)
        return fn

    return add


def own_key(k):
    """Part keys of one sheet: every k-th is one that no other sheet has."""
    return f"case when p_partkey%{k}=0 then -{k}*p_partkey else p_partkey end"


def ops(entries):
    OPS.update(entries)


big = lambda x: F.col(x).cast("bigint") if isinstance(x, str) else x.cast("bigint")

# ---------------------------------------------------------------- projections and predicates
ops(
    {
        "P01_projection": (lambda c: c["stg_item"].select("*", F.length("tc_id").cast("bigint").alias("id_length")), "select *, length(tc_id) as id_length from {stg_item}"),
        "P02_select_where": (lambda c: A.select_rows(c["stg_item"], ["tc_id", "upper(name) as name"], "revision = 'A.B'"), "select tc_id, upper(name) as name from {stg_item} where revision='A.B'"),
        "P03_select_distinct": (lambda c: A.distinct_values(c["stg_bom"], ["seq_no", "refdefcomments"]), "select seq_no, refdefcomments, count(*) as count from {stg_bom} group by all"),
        "P04_update": (lambda c: A.update_rows(c["stg_owner"], {"grp_new": "concat('X-', grp_old)"}, "grp_new = 'Brand#1'"), "select tc_id, grp_old, case when grp_new='Brand#1' then 'X-'||grp_old else grp_new end as grp_new from {stg_owner}"),
        "P04_update_affected": (lambda c: A.affected_rows(c["stg_owner"], "grp_new = 'Brand#1'"), "select count(*) as affected from {stg_owner} where grp_new='Brand#1'"),
        "P05_distinct": (lambda c: c["stg_docrel"].select("doc_id", "relationship_type").distinct(), "select distinct doc_id, relationship_type from {stg_docrel}"),
        "P06_comparison": (lambda c: c["lineitem"].filter((F.col("l_quantity") > 45) & ~F.col("l_returnflag").isin("A", "R") | (F.col("l_tax") != 0) & (F.col("l_discount") == 0)).select("l_orderkey", "l_linenumber", "l_quantity"), "select l_orderkey, l_linenumber, l_quantity from lineitem where (l_quantity>45 and l_returnflag not in ('A','R')) or (l_tax<>0 and l_discount=0)"),
        "P07_null_tests": (lambda c: c["stg_bom"].filter(F.col("seq_no").isNull() & F.col("quantity").isNotNull()), "select * from {stg_bom} where seq_no is null and quantity is not null"),
        "P08_like": (lambda c: c["part"].filter(F.col("p_name").like("%bolt%") & ~F.col("p_brand").like("Brand#1_")).select("p_partkey"), "select p_partkey from part where p_name like '%bolt%' and p_brand not like 'Brand#1_'"),
        "P08_like_data_pattern": (lambda c: c["part"].filter(F.expr("p_name like concat('%', lower(substr(p_type, 1, 1)), '%')")).select("p_partkey"), "select p_partkey from part where p_name like '%'||lower(substr(p_type,1,1))||'%'"),
        "P09_regexp_like": (lambda c: c["documents"].filter(T.matches("text", r"[0-9]{3}-[0-9]{4}")).select("doc_id"), "select doc_id from documents where regexp_matches(text, '[0-9]{3}-[0-9]{4}')"),
        "P10_case_flag": (lambda c: c["orders"].select("o_orderkey", V.flag(F.col("o_orderstatus") == "F").alias("is_done"), V.yes_no(F.when(F.col("o_totalprice") > 1000, 1)).alias("is_large")), "select o_orderkey, case when o_orderstatus='F' then 'Y' end as is_done, case when o_totalprice>1000 then 'Yes' else 'No' end as is_large from orders"),
        "P11_null_safe_compare": (lambda c: c["stg_item"].filter(V.differs_null_safe("uom", "engineering_type")).select("tc_id", "uom", "engineering_type"), "select tc_id, uom, engineering_type from {stg_item} where coalesce(uom,'none')<>coalesce(engineering_type,'none')"),
        "P12_load_id_filter": (lambda c: RD.load_rows(c["stg_item"].withColumn("loadidentifier", F.col("traceability")), "1"), "select *, traceability as loadidentifier from {stg_item} where traceability='1'"),
        "P13_locally_owned": (lambda c: K.items(c, local=True).select("item_puid", "tc_item_id"), "select i.puid as item_puid, i.pitem_id as tc_item_id from {pitem} i join {ppom_object} o on o.puid=i.puid where o.rowning_siteu is null"),
    }
)

# ---------------------------------------------------------------- joins
MK = "(select *, upper(tc_id) as k from {item_all_site})"
ops(
    {
        "J01_inner_join": (lambda c: c["stg_item"].join(K.master(c), T.id_key("tc_id") == F.col("dw_key")).select("tc_id", "dw_puid"), f"select c.tc_id, w.puid as dw_puid from {{stg_item}} c join {MK} w on w.k=upper(c.tc_id)"),
        "J02_join_chain": (lambda c: K.dataset_files(c), "select e.rprimary_objectu as files_rev, n.pobject_name as dataset_name_current, f.poriginal_file_name as dataset_namedref_current from {pimanrelation} e, {pimantype} t, {pdataset} s, {pdatasettype} y, {pworkspaceobject} n, {pref_list_0} l, {pimanfile} f where t.puid=e.rrelation_typeu and t.ptype_name='IMAN_specification' and s.puid=e.rsecondary_objectu and y.puid=s.rdataset_typeu and n.puid=s.puid and l.puid=s.puid and f.puid=l.pvalu_0"),
        "J03_left_join": (lambda c: K.items(c).join(K.item_status(c), F.col("item_puid") == F.col("status_item"), "left").select("item_puid", "status_name"), "select i.puid as item_puid, s.pname as status_name from {pitem} i left join ({prelease_status_list} l join {preleasestatus} s on s.puid=l.pvalu_0) on l.puid=i.puid"),
        "J04_anti_join": (lambda c: S.missing_in(c["stg_status"], "tc_id", K.master(c), "dw_key"), f"select c.* from {{stg_status}} c left join {MK} w on w.k=c.tc_id where w.k is null"),
        "J05_not_exists": (lambda c: c["part"].join(c["lineitem"].filter("l_quantity > 48"), F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey"), "select p_partkey from part where not exists (select 1 from lineitem where l_partkey=p_partkey and l_quantity>48)"),
        "J06_anti_join_any": (lambda c: U.anti_join_any(K.master(c).select("dw_tc_id", "dw_pname"), ("dw_tc_id", c["stg_owner"], "tc_id"), ("dw_pname", c["stg_owner"], "grp_new")), "select w.tc_id as dw_tc_id, w.pname as dw_pname from {item_all_site} w where not exists (select 1 from {stg_owner} o where o.tc_id=w.tc_id or o.grp_new=w.pname)"),
        "J07_semi_join": (lambda c: c["orders"].join(c["lineitem"].filter(F.col("l_returnflag") == "R"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey"), "select o_orderkey from orders where o_orderkey in (select l_orderkey from lineitem where l_returnflag='R')"),
        "J08_right_join": (lambda c: K.occurrences(c).join(K.pick(c["pstructure_revisions"], puid="puid"), F.col("struct_rev") == F.col("puid"), "right").groupBy("puid").agg(F.count("occ_child").alias("children")), "select r.puid, count(p.rchild_itemu) as children from {ppsoccurrence} p right join {pstructure_revisions} r on r.pvalu_0=p.rparent_bvru group by 1"),
        "J09_full_outer_inputs": (
            lambda c: U.outer_join_inputs([c["part"].selectExpr(f"{own_key(3)} as ID", "p_name as NAME", "p_brand as BRAND"), c["part"].selectExpr(f"{own_key(5)} as ID", "upper(p_name) as NAME", "p_type as TYPE"), c["part"].selectExpr(f"{own_key(7)} as ID", "p_size as SIZE")], ["ID"]),
            f"select coalesce(a.id, b.id, s.id) as ID, a.name as NAME_x, a.brand as BRAND, b.name as NAME_y, b.type as TYPE, s.size as SIZE from (select {own_key(3)} as id, p_name as name, p_brand as brand from part) a full join (select {own_key(5)} as id, upper(p_name) as name, p_type as type from part) b on b.id=a.id full join (select {own_key(7)} as id, p_size as size from part) s on s.id=coalesce(a.id,b.id)",
        ),
        "J10_multi_key_join": (lambda c: L.with_given_revision(L.with_item(c["stg_docrel"].select(F.col("item_id").alias("given_item"), "revision"), c, "given_item", local=False), c, "revision").select("given_item", "rev_puid"), "select d.item_id as given_item, r.puid as rev_puid from {stg_docrel} d join {pitem} i on upper(i.pitem_id)=upper(d.item_id) join {pitemrevision} r on r.ritems_tagu=i.puid and r.pitem_revision_id=d.revision"),
        "J11_theta_residual": (lambda c: S.delta_update(c["lineitem"].join(c["part"], F.col("l_partkey") == F.col("p_partkey")), big("l_linenumber"), big(F.col("p_size") % 7), show=["l_orderkey", "l_linenumber", "p_size"]), "select l_orderkey, l_linenumber, p_size from lineitem join part on p_partkey=l_partkey where l_linenumber<>p_size%7"),
        "J12_self_join_parent": (lambda c: K.group_parents(c), "select g.pname as group_name, p.pname as parent from {ppom_group} g left join {ppom_group} p on p.puid=g.rparentu"),
        "J13_notes_join": (lambda c: K.occurrence_notes(c, K.REFERENCE_DESIGNATOR, "ref"), "select n.puid as ref_notes, x.pval_0 as ref from {ppsoccurrencenotes} n, {pnote_types} t, {pnotetype} y, {pnote_texts} x where t.puid=n.puid and y.puid=t.pvalu_0 and x.puid=n.puid and x.pseq=t.pseq and y.pname='Reference Designator'"),
        "J14_join_union": (lambda c: K.master_forms(c, ["part_form", "nonengineering_form"], ["prsone_uom"]), "select e.rprimary_objectu as form_of, f.prsone_uom from {pimanrelation} e join {pimantype} t on t.puid=e.rrelation_typeu and t.ptype_name='IMAN_master_form' join {pform} p on p.puid=e.rsecondary_objectu left join (select puid, prsone_uom from {part_form} union select puid, prsone_uom from {nonengineering_form}) f on f.puid=p.rdata_fileu"),
        "J15_same_row_tokens": (lambda c: L.tokens_contained(c["stg_supersede"], c, "sup_id", "sur_id", only_mismatch=True), "with w as (select upper(tc_id) as k, replace(ip,'-','_') as ips, regexp_extract_all(replace(ip,'-','_'), '\\w+') as ts from {item_all_site}) select distinct 1 as is_nomatch, sup_id, sup_ip, sur_id, sur_ip_list from (select c.sup_id, c.sur_id, unnest(a.ts) as sup_ip, b.ips as sur_ip_list, b.ts as bt from {stg_supersede} c join w a on a.k=c.sup_id join w b on b.k=c.sur_id) where not coalesce(list_contains(bt, sup_ip), false)"),
    }
)

# ---------------------------------------------------------------- aggregates
ops(
    {
        "G01_counts": (lambda c: c["stg_bom"].agg(F.count("*").alias("n"), F.count("seq_no").alias("n_seq"), F.count(F.lit(1)).alias("n_one")), "select count(*) as n, count(seq_no) as n_seq, count(1) as n_one from {stg_bom}"),
        "G02_distinct_counts": (lambda c: R.distinct_counts_and_total("total", parts="l_partkey", suppliers="l_suppkey").frame(c["lineitem"]), "select count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers, count(distinct l_partkey)+count(distinct l_suppkey) as total from lineitem"),
        "G03_group_count": (lambda c: R.value_frequency(F.concat_ws("/", "l_returnflag", "l_linestatus"), "kind").frame(c["lineitem"]), "select l_returnflag||'/'||l_linestatus as kind, count(*) as cnt from lineitem group by 1"),
        "G04_having_distinct": (lambda c: N.multi_value_keys(c["lineitem"], "l_orderkey", "l_returnflag", "l_orderkey"), "select l_orderkey, count(distinct l_returnflag) as cnt from lineitem group by 1 having cnt > 1"),
        "G05_listagg": (lambda c: N.value_lists(c["lineitem"].select("l_orderkey", F.col("l_returnflag").alias("flag")), ["l_orderkey"], "flag", "flags"), "select l_orderkey, string_agg(l_returnflag, ', ' order by l_returnflag) as flags from lineitem group by 1"),
        "G06_distinct_rows_count": (lambda c: C.count_of(c["stg_docrel"].distinct()), "select count(*) as cnt from (select distinct * from {stg_docrel})"),
        "G07_deduplicate": (lambda c: U.deduplicate(c["lineitem"].select("l_partkey", "l_suppkey", "l_returnflag")), "select distinct l_partkey, l_suppkey, l_returnflag from lineitem"),
        "G07_dropped_rows": (lambda c: U.dropped_rows(c["stg_docrel"]), "select (select count(*) from {stg_docrel}) - count(*) as dropped, count(*) as remaining from (select distinct * from {stg_docrel})"),
        "G08_column_profile": (lambda c: U.column_profile(c["stg_item"].select("tc_id", "name", "revision")), "select 'tc_id' as column_name, max(length(tc_id)) as max_length, false as all_blank from {stg_item} union all select 'name', max(length(name)), false from {stg_item} union all select 'revision', max(length(revision)), false from {stg_item}"),
    }
)

# ---------------------------------------------------------------- windows
SHIPPED = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
ops(
    {
        "W01_count_per_key": (lambda c: N.count_per_key(c["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"], "lines"), "select l_orderkey, l_linenumber, l_partkey, count(*) over (partition by l_orderkey) as lines from lineitem"),
        "W02_distinct_count_per_key": (lambda c: N.distinct_count_per_key(c["lineitem"].select("l_orderkey", "l_partkey", "l_returnflag"), ["l_orderkey"], "l_returnflag", "kinds"), "select l_orderkey, l_partkey, l_returnflag, (select count(distinct b.l_returnflag) from lineitem b where b.l_orderkey=a.l_orderkey) as kinds from lineitem a"),
        "W03_max_flag": (lambda c: c["lineitem"].groupBy("l_partkey", "l_suppkey").agg(F.max(F.when(F.col("l_returnflag") == "R", 1)).alias("returned")), "select l_partkey, l_suppkey, max(case when l_returnflag='R' then 1 end) as returned from lineitem group by 1, 2"),
        "W04_total": (lambda c: R.distinct_counts_and_total("all_kinds", a="l_returnflag", b="l_linestatus").frame(c["lineitem"]), "select t.*, sum(a+b) over ()::bigint as all_kinds from (select count(distinct l_returnflag) as a, count(distinct l_linestatus) as b from lineitem) t"),
        "W05_latest_revision": (lambda c: N.latest_per_key(c["mst_rev"], "item_puid", "created", "rev", ["puid", "rev"]), "select item_puid, puid, rev from {mst_rev} qualify row_number() over (partition by item_puid order by created desc nulls first, rev desc)=1"),
        "W06_majority": (lambda c: N.majority_value(c["item_all_site"], "pname"), "select pname from {item_all_site} group by 1 order by count(*) desc, pname limit 1"),
        "W07_list_per_key": (lambda c: c["pitemrevision"].select("puid", "ritems_tagu").join(N.value_lists(c["pitemrevision"].select(F.col("ritems_tagu").alias("item"), "pitem_revision_id"), ["item"], "pitem_revision_id", "revs"), F.col("ritems_tagu") == F.col("item")).select("puid", "revs"), "with l as (select ritems_tagu as item, string_agg(pitem_revision_id, ', ' order by pitem_revision_id) as revs from {pitemrevision} group by 1) select r.puid, l.revs from {pitemrevision} r join l on l.item=r.ritems_tagu"),
        "W08_previous_record": (
            lambda c: OR.with_previous(c["lineitem"].select(*SHIPPED), ["l_orderkey", "l_suppkey"], SHIPPED, "before_"),
            f"select {', '.join(SHIPPED)}, row_number() over w as position, lag(l_orderkey) over w as before_l_orderkey, lag(l_suppkey) over w as before_l_suppkey from lineitem window w as (order by {', '.join(SHIPPED)})",
        ),
        # Deletes are sent at every change of the item, releases where item and revision both change.
        "W08_key_changes": (
            lambda c: OR.key_changes(c["lineitem"].select(*SHIPPED), ["l_orderkey"], SHIPPED),
            f"select * exclude (b) from (select {', '.join(SHIPPED)}, row_number() over w as position, lag(l_orderkey) over w as b from lineitem window w as (order by {', '.join(SHIPPED)})) where position=1 or l_orderkey is distinct from b",
        ),
        "W08_both_change": (
            lambda c: OR.key_changes(c["lineitem"].select(*SHIPPED), ["l_orderkey", "l_linenumber"], SHIPPED, every=True),
            f"select * exclude (b, d) from (select {', '.join(SHIPPED)}, row_number() over w as position, lag(l_orderkey) over w as b, lag(l_linenumber) over w as d from lineitem window w as (order by {', '.join(SHIPPED)})) where l_orderkey is distinct from b and l_linenumber is distinct from d",
        ),
        "W08_first_record": (lambda c: N.first_per_key(c["lineitem"], ["l_partkey"], "l_orderkey"), "select l_partkey, min(l_orderkey) as first_position from lineitem group by 1"),
    }
)

# ---------------------------------------------------------------- sorts and sets
ops(
    {
        "O01_sort": (
            lambda c: SP.with_position(A.ordered(c["stg_bom"].select("parent_tc_id", "seq_no", "quantity"), ["-#quantity", "seq_no", "parent_tc_id", "quantity"])),
            "select parent_tc_id, seq_no, quantity, row_number() over (order by try_cast(quantity as decimal(38,10)) desc nulls first, seq_no nulls last, parent_tc_id nulls last, quantity nulls last) as position from {stg_bom}",
        ),
        "O02_top_per_group": (lambda c: N.latest_per_key(c["orders"], "o_custkey", "o_orderdate", "o_orderkey", ["o_orderkey", "o_totalprice"]), "select o_custkey, o_orderkey, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc)=1"),
        "O03_ordered_groups": (
            lambda c: D.grouped_records(RD.conversion_records(files.conversion_lines(c), ["doc_id"]), "doc_id", 10).select("doc_id", "itemID", "revID", "ds_name", "group_no", "position", "part"),
            f"""select doc_id, "itemID", "revID", ds_name, dense_rank() over (order by "itemID", "revID") as group_no, row_number() over g as position, (row_number() over g - 1)//10 as part from {files.CONVERSION_SQL} window g as (partition by "itemID", "revID" order by ds_name nulls first, doc_id)""",
        ),
        "U01_union_ids": (lambda c: U.id_union(c["stg_bom"], {"Assembly": T.id_key("parent_tc_id"), "Component": T.id_key("child_tc_id")}), "select upper(parent_tc_id) as tc_id, 'Assembly' as type from {stg_bom} union select upper(child_tc_id), 'Component' from {stg_bom}"),
        "U02_union_by_name": (lambda c: U.union_by_name([c["part"].select("p_partkey", "p_name"), c["part"].select("p_partkey", "p_brand")]), "select p_partkey, p_name, p_brand from (select p_partkey, p_name, null as p_brand from part union all select p_partkey, null, p_brand from part)"),
        "U03_union_distinct": (lambda c: U.union_distinct([c["orders"], c["orders"].withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 3 == 0, "X").otherwise(F.col("o_orderstatus")))]), "select * from orders union select * replace (case when o_orderkey%3=0 then 'X' else o_orderstatus end as o_orderstatus) from orders"),
    }
)

# ---------------------------------------------------------------- scalar functions
DOC = "select doc_id, {} as v from documents"
fn = lambda expr: (lambda c: c["documents"].select("doc_id", expr().alias("v")))
item_fn = lambda expr: (lambda c: c["stg_item"].select("tc_id", expr().alias("v")))
ITM = "select tc_id, {} as v from {{stg_item}}"
doc_fn = lambda expr: (lambda c: c["stg_doc"].select("doc_id", expr().alias("v")))
SDOC = "select doc_id, {} as v from {{stg_doc}}"
DOC_EXT = "lower(nullif(regexp_extract(path_location, '\\.([^.\\\\]*)$', 1), ''))"
ops(
    {
        "F01_upper_lower": (item_fn(lambda: F.concat(F.upper("tc_id"), F.lower("tc_id"))), ITM.format("upper(tc_id)||lower(tc_id)")),
        "F02_strip": (item_fn(lambda: T.strip("description")), ITM.format("regexp_replace(description, '^\\s+|\\s+$', '', 'g')")),
        "F03_length": (fn(lambda: T.text_length("text")), DOC.format("length(text)")),
        "F04_default": (item_fn(lambda: F.concat(V.null_label("revision", "none"), V.yes_no("name2"))), ITM.format("coalesce(revision,'none')||case when name2 is not null then 'Yes' else 'No' end")),
        "F05_first_match": (item_fn(lambda: T.first_match("tc_id", P.COLON_SUFFIX)), ITM.format("nullif(regexp_extract(tc_id, ':.*'), '')")),
        "F06_split_to_rows": (lambda c: c["item_all_site"].select("puid", F.explode_outer(T.word_tokens("ip")).alias("token")), "select puid, unnest(case when ip is null then [null] else regexp_extract_all(replace(ip,'-','_'), '\\w+') end) as token from {item_all_site}"),
        "F07_regexp_replace": (fn(lambda: T.without("text", r"\W")), DOC.format("nullif(regexp_replace(text, '\\W', '', 'g'), '')")),
        "F08_regexp_count": (fn(lambda: F.regexp_count("text", F.lit(r"\W")).cast("bigint")), DOC.format("len(regexp_extract_all(text, '\\W'))")),
        "F09_substr_instr": (fn(lambda: F.expr("nullif(substr(text, 1, greatest(locate(',', text) - 1, 0)), '')")), DOC.format("nullif(case when contains(text, ',') then split_part(text, ',', 1) end, '')")),
        "F10_replace": (item_fn(lambda: F.replace("tc_id", F.lit("-"), F.lit("_"))), ITM.format("replace(tc_id,'-','_')")),
        "F11_joined": (item_fn(lambda: T.joined("alternateid", F.lit("|"), "revision")), ITM.format("coalesce(alternateid,'')||'|'||coalesce(revision,'')")),
        "F12_line_characters": (fn(lambda: T.matches("text", P.NEW_LINES)), DOC.format("contains(text, chr(10))")),
        "F13_decade": (item_fn(lambda: V.decade("rev_creation_date")), ITM.format("coalesce(substr(cast(year(rev_creation_date) as varchar),1,3),'')||'0s'")),
        "F14_number": (lambda c: c["stg_bom"].select("seq_no", "quantity", F.round(V.number("quantity").cast("double") / 3, 4).alias("v")), "select seq_no, quantity, round(try_cast(quantity as decimal(38,10))::double/3, 4) as v from {stg_bom}"),
        "F16_status_text": (item_fn(lambda: T.status_text("item_status")), ITM.format("case when lower(trim(item_status)) in ('active','legacy','inactive','stop','mfg','eng') then upper(trim(item_status)) else upper(substr(trim(item_status),1,1))||lower(substr(trim(item_status),2)) end")),
        "F17_title_case": (lambda c: c["part"].select("p_partkey", T.title_case(F.concat("p_name", F.lit("-x'y 3d"))).alias("v")), "select p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1])||lower(w[2:])), ' ')||'-X''Y 3D' as v from part"),
        "F18_header": (lambda c: ST.clean(c["part"].withColumnRenamed("p_name", " p name ")).select("P_PARTKEY", "P_NAME"), "select cast(p_partkey as varchar) as P_PARTKEY, p_name as P_NAME from part"),
        "F19_request_date": (lambda c: c["orders"].select("o_orderkey", V.request_date(F.when(F.col("o_orderkey") % 11 == 0, F.lit("31.12.2020")).otherwise(F.date_format("o_orderdate", V.INPUT_DATE))).alias("v")), "select o_orderkey, case when o_orderkey%11<>0 then strftime(o_orderdate, '%d-%b-%y %H:%M:%S') end as v from orders"),
        "F20_default_text": (item_fn(lambda: T.default_text("revision", "01")), ITM.format("coalesce(revision,'01')")),
        "F21_translate": (fn(lambda: RD.service_file_name(F.col("text"))), DOC.format("translate(text, ' ,()[]{}'||chr(92)||'/@#$%^&*', repeat('_', 18))")),
        "F22_dataset_type": (doc_fn(lambda: LP.dataset_type("path_location")), SDOC.format("case when path_location like '%.pdf' then 'PDF' when path_location like '%.dwg' then 'ACADDWG' end")),
        "F23_path_parts": (doc_fn(lambda: F.concat_ws("|", T.file_name("path_location"), LP.file_extension("path_location"), T.server_share("path_location"))), SDOC.format(f"concat_ws('|', upper(nullif(regexp_extract(path_location, '[^\\\\]+$'), '')), {DOC_EXT}, nullif(regexp_extract(upper(path_location), '^\\\\\\\\[^\\\\]+\\\\[^\\\\]+'), ''))")),
    }
)


@op("F15_ascii_escaped")
def _ascii(c):
    return c["documents"].select("doc_id", T.ascii_escaped("text").alias("v"))


from oracle.snippets import ascii_text  # noqa: E402

OPS["F15_ascii_escaped"] = (_ascii, f"select doc_id, {ascii_text('text')} as v from documents")

# ---------------------------------------------------------------- load planning inputs over the samples
NOW = dt.datetime(2024, 1, 2, 3, 4, 5)


def load_records(c):
    """Records in file order: parts, some staged twice, some new, some with unreadable dates."""
    p = c["part"].select(F.col("p_partkey").alias("k"), "p_name", "p_type", "p_size")
    first = p.select((F.col("k") * 3).alias("position"), "*", F.lpad((F.col("p_size") % 4 + 1).cast("string"), 2, "0").alias("revision"))
    second = p.filter("k % 4 <> 1").select((F.col("k") * 3 + 1).alias("position"), "*", F.when(F.col("k") % 6 == 0, F.lit("")).otherwise(F.lit("09")).alias("revision"))
    third = p.filter("k % 5 = 0").select((F.col("k") * 3 + 2).alias("position"), "*", F.lit("09").alias("revision"))
    rows = first.unionByName(second).unionByName(third)
    kind = F.when((F.col("k") + F.col("position")) % 7 == 0, "Tool").when(F.col("k") % 3 == 0, "Nov4Part").when(F.col("k") % 3 == 1, "Documents")
    return rows.select(
        "position",
        F.concat(F.lit("P"), F.col("k").cast("string")).alias("itemid"),
        F.col("p_name").alias("name"),
        F.concat(F.col("p_type"), F.lit("\n"), F.col("p_name")).alias("description"),
        "revision",
        kind.alias("item_type"),
        F.when(F.col("k") % 2 == 0, F.concat(F.lit("\\\\srv\\f"), F.col("k").cast("string"), F.when(F.col("k") % 8 == 0, "").when(F.col("k") % 8 == 2, ".xyz").otherwise(".PDF"))).alias("ds_path"),
        F.when(F.col("position") % 13 == 0, "2020-01-01").otherwise("01/31/2020 10:20:30").alias("date_created"),
        F.lit("02/01/2020 00:00:00").alias("date_released"),
    )


LOAD_RECORDS = """(select k*3 + s as position, 'P'||k as itemid, p_name as name, p_type||chr(10)||p_name as description, revision,
  case when (k + k*3 + s)%7=0 then 'Tool' when k%3=0 then 'Nov4Part' when k%3=1 then 'Documents' end as item_type,
  case when k%2=0 then chr(92)||chr(92)||'srv'||chr(92)||'f'||k||case when k%8=0 then '' when k%8=2 then '.xyz' else '.PDF' end end as ds_path,
  case when (k*3+s)%13=0 then '2020-01-01' else '01/31/2020 10:20:30' end as date_created, '02/01/2020 00:00:00' as date_released
  from (select p_partkey as k, 0 as s, p_name, p_type, lpad(cast(p_size%4+1 as varchar),2,'0') as revision from part
    union all select p_partkey, 1, p_name, p_type, case when p_partkey%6=0 then '' else '09' end from part where p_partkey%4<>1
    union all select p_partkey, 2, p_name, p_type, '09' from part where p_partkey%5=0))"""


def known_items(c):
    return c["part"].filter("p_partkey % 3 <> 2 and p_partkey % 2 = 0").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("itemid"))


def known_revisions(c):
    return c["part"].filter("p_partkey % 3 <> 2 and p_partkey % 2 = 0").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("itemid"), F.lit("02").alias("revision"), (F.col("p_partkey") % 4 == 0).alias("released")
    )


KNOWN = "(select 'P'||p_partkey as itemid, p_partkey%4=0 as released from part where p_partkey%3<>2 and p_partkey%2=0)"
# Which records fail or create, stated over pairs of records instead of per-key minima.
PLAN = f"""with r as (select position, itemid, coalesce(nullif(revision,''),'01') as revision, coalesce(item_type,'Documents') as item_type, ds_path, date_created<>'2020-01-01' as dated from {LOAD_RECORDS}),
 k as (select r.*, exists (select 1 from {KNOWN} x where x.itemid=r.itemid) as known from r),
 a as (select k.*, k.dated and not k.known and k.item_type in ('Documents','Nov4Part') and not exists (select 1 from k e where e.itemid=k.itemid and e.position<k.position and e.dated and e.item_type in ('Documents','Nov4Part')) as creates from k),
 b as (select a.*, a.dated and (a.known or exists (select 1 from a e where e.itemid=a.itemid and e.creates and e.position<=a.position)) as open from a),
 d as (select b.*, (b.known and b.revision='02') or exists (select 1 from b e where e.itemid=b.itemid and e.revision=b.revision and e.open and e.position<b.position) as repeated from b)
"""
PLAN_ACTION = "case when not dated then 'fail' when creates and item_type='Documents' then 'create_document' when creates then 'create_part' when not open or repeated then 'fail' else 'add_revision' end"
PLAN_MESSAGE = "case when not dated then 'date cannot be read' when creates then null when not open then 'item has an unsupported type ('||item_type||')' when repeated then 'item revision already exists, skipping' end"


# Every request as a list of words, one statement for each kind.
_NULLS = lambda names: "||chr(9)||".join(f"'{k} null'" for k in names.split())
_SPEC = "NOV4_HEIGHT NOV4_LENGTH NOV4_WIDTH NOV4_LWH_UNITS NOV4_VOLUME NOV4_VOL_UNITS NOV4_WEIGHT NOV4_WGT_UNITS"
_NEW = "'ITEMID '||itemid||chr(9)||'ITEMNAME '||name||chr(9)||'ITEMDESC '||replace(description,chr(10),'')"
_CREATED = "'DATE 31-Jan-20 10:20:30'"
REQUESTS_SQL = f"""{PLAN}, q as (select d.*, {PLAN_ACTION} as action, x.name, x.description from d join (select position, name, description from {LOAD_RECORDS}) x using (position))
select action, position::varchar as position, case action
  when 'create_part' then 'FUNCTION addPartItem'||chr(9)||{_NEW}||chr(9)||'REVISION '||revision||chr(9)||'RSONE_ITEMTYPE '||item_type||chr(9)||{_NULLS("RSONE_UOM RSONE_UOW REV_WEIGHT NAME2 PARTSUBTYPE LIFECYCLE SITES REVCOMMENTS ITEM_UOM NOV4_MIS_TYPE NOV4_MIS_SERIALIZE " + _SPEC)}||chr(9)||{_CREATED}
  when 'create_document' then 'FUNCTION addDocumentsItem'||chr(9)||'ITEMTYPE null'||chr(9)||{_NEW}||chr(9)||'CATEGORY null'||chr(9)||'REVISION '||revision||chr(9)||'SEQNO 001'||chr(9)||'SHEET null'||chr(9)||'PUBLISHWEB false'||chr(9)||'PUBLISHPP false'||chr(9)||'PULLDRAWING false'||chr(9)||{_NULLS("LIFECYCLE SITES REVCOMMENTS")}||chr(9)||{_CREATED}
  when 'add_revision' then 'FUNCTION addRevision'||chr(9)||'ITEMID '||itemid||chr(9)||'REVISION '||revision||chr(9)||{_NULLS("REV_WEIGHT LIFECYCLE SITES REVCOMMENTS NAME2 " + _SPEC)}||chr(9)||{_CREATED}
  end as request from q
union all select 'delete', itemid, 'FUNCTION deleteItem'||chr(9)||'ITEMID '||itemid from (select distinct itemid from {LOAD_RECORDS})
union all select case when done then 'fail' else 'release' end, itemid||'/'||revision, case when not done then 'FUNCTION releaseRevision'||chr(9)||'ITEMID '||itemid||chr(9)||'REVISION '||revision||chr(9)||'RELEASESTATUS null'||chr(9)||'RELEASEDATE 01-Feb-20 00:00:00' end
  from (select r.*, exists (select 1 from {KNOWN} x where x.itemid=r.itemid and r.revision='02' and x.released) as done from (select distinct itemid, coalesce(nullif(revision,''),'01') as revision from {LOAD_RECORDS} where date_created<>'2020-01-01') r)"""


def load_plan(c):
    return LP.plan_load(load_records(c), known_items(c), known_revisions(c), now=F.lit(NOW))


ops(
    {
        "L14_record_fields": (lambda c: LP.filled_invalid_fields(c["part"].selectExpr("p_partkey as itemid", "p_name as name", "case when p_size > 9 then p_brand end as brand", "p_type as kind"), "part"), "select 'brand' as field, count(case when p_size > 9 then p_brand end) as filled from part union all select 'kind', count(p_type) from part"),
        "L15_plan_load": (lambda c: load_plan(c).select("position", "itemid", "revision", "item_type", "action", "message", "relate"), PLAN + f"select position, itemid, revision, item_type, {PLAN_ACTION} as action, {PLAN_MESSAGE} as message, ({PLAN_ACTION}) in ('create_document','add_revision') and item_type='Documents' and ds_path is not null and ds_path like '%.%' as relate from d"),
        "L16_plan_delete": (lambda c: LP.plan_delete(load_records(c)), f"select distinct itemid, 'delete' as action from {LOAD_RECORDS}"),
        "L17_plan_release": (lambda c: LP.plan_release(load_records(c), known_revisions(c), now=F.lit(NOW)).select("itemid", "revision", "date_released", "action", "message"), f"with r as (select distinct itemid, coalesce(nullif(revision,''),'01') as revision from {LOAD_RECORDS} where date_created<>'2020-01-01'), s as (select r.*, exists (select 1 from {KNOWN} x where x.itemid=r.itemid and r.revision='02' and x.released) as done from r) select itemid, revision, '01-Feb-20 00:00:00' as date_released, case when done then 'fail' else 'release' end as action, case when done then 'item revision already released' end as message from s"),
        "L18_render_requests": (
            lambda c: U.union_by_name([
                LP.render_requests(load_plan(c)).select("action", F.col("position").cast("string").alias("position"), "request"),
                LP.render_requests(LP.plan_delete(load_records(c))).select("action", F.col("itemid").alias("position"), "request"),
                LP.render_requests(LP.plan_release(load_records(c), known_revisions(c), now=F.lit(NOW))).select("action", F.concat_ws("/", "itemid", "revision").alias("position"), "request"),
            ]),
            REQUESTS_SQL,
        ),
        "L18_relation_requests": (
            lambda c: load_plan(c).filter("relate").select("position", LP.relation_request(F.concat(F.lit("R:"), "itemid", F.lit("/"), "revision"), F.concat(F.lit("D:"), "itemid")).alias("request")),
            PLAN + f"select position, 'FUNCTION createRelationship'||chr(9)||'FROMPUID R:'||itemid||'/'||revision||chr(9)||'TOPUID D:'||itemid||chr(9)||'RELATION IMAN_specification' as request from d where ({PLAN_ACTION}) in ('create_document','add_revision') and item_type='Documents' and ds_path is not null and ds_path like '%.%'",
        ),
        "F24_dataset_requests": (
            lambda c: LP.render_requests(load_plan(c)).filter("dataset_request is not null").select("position", "dataset_request"),
            PLAN + f"select d.position, 'FUNCTION addSimpleDataset'||chr(9)||'DATASETNAME '||itemid||chr(9)||'DATASETTYPE '||case when d.ds_path like '%.PDF' then 'PDF' else 'MISC' end||chr(9)||'ITEMDESC '||x.description||chr(9)||'FILENAME '||d.ds_path as dataset_request from d join (select position, description from {LOAD_RECORDS}) x on x.position=d.position where ({PLAN_ACTION}) in ('create_document','add_revision') and item_type='Documents' and d.ds_path like '%.%'",
        ),
    }
)


def response_lines(c):
    p = c["part"]
    status = F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("failed\tError item "), F.col("p_name"), F.lit(" locked"))).otherwise(F.lit("Success"))
    tail = F.concat(F.lit("\tPUID  q"), F.col("p_partkey").cast("string"), F.lit("\tItemId "), F.col("p_name"), F.lit("\tITEMTYPE "), F.col("p_type"), F.lit("\tIsReleased "), F.when(F.col("p_size") % 2 == 0, "true").otherwise("no"))
    return p.select("p_partkey", F.concat(status, tail).alias("value"))


ops(
    {
        "L19_parse_responses": (
            lambda c: LP.parse_responses(response_lines(c)).drop("value"),
            "select p_partkey, p_partkey%5<>0 as ok, p_size%2=0 as released, 'q'||p_partkey as puid, p_name as itemid, null::varchar as revid, p_type as itemtype, null::varchar as primary_obj, null::varchar as secondary_obj, case when p_partkey%5=0 then 'item '||p_name||' locked' end as err_msg from part",
        ),
        "S06_pipe_records": (
            lambda c: RD.conversion_records(files.conversion_lines(c)),
            f"select * exclude (doc_id) from {files.CONVERSION_SQL}",
        ),
        "L20_match_datasets": (
            lambda c: D.match_datasets(RD.conversion_records(files.conversion_lines(c)), files.services(c)),
            f"""select r.* exclude (doc_id), case when hit then 'f'||r."itemID"||'-'||r."revID" end as ds_puid, case when hit then null when s.reason is not null then 'a;b' when s.i is not null and not s.empty then 'No dataset file found' end as message
            from (select x.*, x.ds_type='PDF' and x.file_name=replace(x."itemID",'/','_')||'_'||x."revID"||'.pdf' as fits from {files.CONVERSION_SQL} x) r left join {files.SERVICES_SQL} s on s.i is not distinct from r."itemID" and s.v is not distinct from r."revID" cross join lateral (select coalesce(r.fits and s.i is not null and not s.empty and s.reason is null, false) as hit) h""".replace("r.* exclude (doc_id)", "r.* exclude (doc_id, fits)"),
        ),
    }
)
OPS["J16_nested_match"] = (lambda c: OPS["L20_match_datasets"][0](c).filter("ds_puid is not null").select("itemID", "revID", "ds_puid"), f"""select "itemID", "revID", ds_puid from ({OPS['L20_match_datasets'][1]}) where ds_puid is not null""")
OPS["L21_conversion_requests"] = (
    lambda c: D.conversion_requests(OPS["L20_match_datasets"][0](c)).select("itemID", "revID", "payload"),
    f"""select "itemID", "revID", '{{"itemId":"'||"itemID"||'","itemRevId":"'||"revID"||'","datasetName":'||coalesce('"'||ds_name_new||'"','null')||',"datasetFilePuids":["'||ds_puid||'"],"scaleLineweights":"false","forceMonochrome":'||coalesce('"'||monochrome||'"','null')||',"zoomExtents":"false","layout":'||coalesce('"'||layout||'"','null')||'}}' as payload from ({OPS['L20_match_datasets'][1]}) where ds_puid is not null""",
)
OPS["F26_log_line"] = (
    lambda c: D.conversion_log(OPS["L20_match_datasets"][0](c)).select("itemID", "status", "log"),
    f"""select "itemID", case when ds_puid is null then 'fail' else 'pass' end as status, concat_ws('|', "itemID", nullif("revID",''), nullif(ds_name,''), nullif(ds_type,''), nullif(file_name,''), nullif(ds_name_new,''), nullif(monochrome,''), nullif(layout,''), ds_puid, case when ds_puid is null then 'Error: '||coalesce(message,'None') else 'Info: Created' end) as log from ({OPS['L20_match_datasets'][1]})""",
)
OPS["F25_response_flags"] = (lambda c: LP.parse_responses(response_lines(c)).select("p_partkey", "ok", "released"), "select p_partkey, p_partkey%5<>0 as ok, p_size%2=0 as released from part")

CONTRACT_SQL = " union all ".join(
    f"select '{f.name}' as column_name, " + ("null::bigint" if f.name == "CHILD_GID_ID" else f"(select count({f.name.lower()}) from {{stg_bom}})") + " as filled"
    for f in ST.contract("bomload").fields
)


# ---------------------------------------------------------------- staging
def sheet(c, k, cols):
    """All parts; every k-th has a key that only this sheet knows."""
    return c["part"].selectExpr("*", f"{own_key(k)} as own_key").selectExpr(*cols)


ops(
    {
        "L01_stage_union": (
            lambda c: ST.stage([sheet(c, 3, ["concat(' ', lower(p_name), ' ') as ` item id`", "p_brand as name", "'mfg ' as status", "'2020-01-31' as `rev date`"]), sheet(c, 5, ["p_name as `item id `", "p_brand as NAME", "'on hold' as Status", "'02/01/2020' as `rev date`", "p_type as kind"])]).df,
            "select distinct upper(p_name) as ITEM_ID, p_brand as NAME, 'MFG' as STATUS, timestamp '2020-01-31' as REV_DATE, null as KIND from part union select upper(p_name), p_brand, 'On Hold', timestamp '2020-02-01', p_type from part",
        ),
        "L01_stage_join": (
            lambda c: ST.stage({"a": sheet(c, 3, ["concat(own_key, '') as `tc id`", "p_name as name"]), "b": sheet(c, 5, ["concat(' ', own_key) as `TC ID`", "p_brand as name"])}, join_on=["tc id"]).df,
            f"select coalesce(a.k, b.k)::varchar as TC_ID, a.p_name as NAME_x, b.p_brand as NAME_y from (select *, {own_key(3)} as k from part) a full join (select *, {own_key(5)} as k from part) b on b.k=a.k",
        ),
        "L02_clean": (lambda c: ST.clean(c["stg_doc"].select("doc_id", "name", "document_status", "path_location")), "select upper(trim(doc_id)) as DOC_ID, name as NAME, case lower(trim(document_status)) when 'active' then 'ACTIVE' when 'obsolete' then 'Obsolete' end as DOCUMENT_STATUS, path_location as PATH_LOCATION from {stg_doc}"),
        "L03_type_dates": (lambda c: ST.type_and_profile(c["orders"].select(F.col("o_orderkey").cast("string").alias("ID"), F.date_format("o_orderdate", "MM/dd/yyyy HH:mm:ss").alias("ORDER_DATE"), F.when(F.col("o_orderkey") % 7 == 0, "soon").otherwise("2020-01-01").alias("DUE_DATE"))).df, "select o_orderkey::varchar as ID, date_trunc('second', o_orderdate) as ORDER_DATE, case when o_orderkey%7=0 then 'soon' else '2020-01-01' end as DUE_DATE from orders"),
        "L03_widths": (
            lambda c: ST.column_types(ST.type_and_profile(c["stg_item"].selectExpr("tc_id", "name", "cast(null as string) as long_description", "cast(null as string) as path", "description as note_clob", "'2020-01-01' as made_date", "'soon' as due_date"))),
            "select 'tc_id' as column_name, 'TEXT' as type, max(length(tc_id))+5 as width from {stg_item} union all select 'name', 'TEXT', max(length(name))+5 from {stg_item} union all select 'long_description', 'TEXT', 555 union all select 'path', 'TEXT', 55 union all select 'note_clob', 'CLOB', null union all select 'made_date', 'DATE', null union all select 'due_date', 'TEXT', null",
        ),
        "L04_clone": (lambda c: ST.clone(RD.load_rows(c["stg_docrel"].withColumn("loadidentifier", F.substring("doc_id", 12, 1)), "3")).df, "select distinct upper(trim(item_id)) as ITEM_ID, revision as REVISION, upper(trim(doc_id)) as DOC_ID, relationship_type as RELATIONSHIP_TYPE, '3' as LOADIDENTIFIER from {stg_docrel} where substr(doc_id,12,1)='3'"),
        "S03_clone_rows": (lambda c: RD.load_rows(c["stg_bom"].withColumn("loadidentifier", F.col("parent_revision")), "02"), "select *, parent_revision as loadidentifier from {stg_bom} where parent_revision='02'"),
        "L22_contract": (lambda c: ST.contract_profile(c["stg_bom"].drop("child_gid_id"), "bomload"), CONTRACT_SQL),
    }
)


# ---------------------------------------------------------------- extract
def site_slices(c):
    """Five overlapping site copies of the orders."""
    spark = c["orders"].sparkSession

    def failing():
        """Fails while its rows are read, not when it is opened."""
        broken = F.raise_error(F.lit("ORA-16000: database open for read-only access")).cast("bigint")
        return c["orders"].withColumn("o_orderkey", F.when(F.col("o_orderkey") % 1000 == 3, broken).otherwise(F.col("o_orderkey")))

    slices = {s: (lambda i=i: c["orders"].filter(F.pmod("o_orderkey", F.lit(5)).isin(i, (i + 1) % 5))) for i, s in enumerate(E.ALL_SITES)}
    return spark, {**slices, "houstby": failing, "houprod": slices["houstby"]}


ops(
    {
        "L05_extract": (lambda c: E.extract(*site_slices(c)).df, "select distinct * from orders"),
        "S04_site_extract": (lambda c: E.extract(*site_slices(c), sites=["edm", "xyz", "sha"]).df, "select * from orders where o_orderkey%5 in (0,1,4)"),
        "S05_linked_table": (lambda c: c.with_tables(**{"pitem@shatc": c["pitem"].filter("puid like 'D%'")}).at("sha")["pitem"], "select * from {pitem} where puid like 'D%'"),
    }
)

# ---------------------------------------------------------------- split
LORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
LKEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate"
lines = lambda c: c["lineitem"].select(*LORDER)
ops(
    {
        "L11_split_by_size": (lambda c: SP.split_by_size(lines(c), 700, LORDER), f"select {LKEY}, (row_number() over (order by {LKEY}) - 1)//700 as chunk from lineitem"),
        "L12_split_in": (lambda c: SP.split_in(lines(c), 9, LORDER), f"select {LKEY}, (row_number() over (order by {LKEY}) - 1)//cast(ceil((select count(*) from lineitem)/9.0) as bigint) as chunk from lineitem"),
        "L13_split_by_group": (
            lambda c: SP.split_by_group(lines(c), ["l_orderkey"], 5000),
            f"""with recursive g as (select cast(l_orderkey as varchar) as k, count(*) as n from lineitem group by 1), o as (select k, (sum(n) over (order by k))::bigint as cum from g),
            w(lo, hi, chunk) as (select 0::bigint, (select min(cum) from o where cum >= 5000), 0::bigint union all select w.hi, min(o.cum), w.chunk+1 from w left join o on o.cum >= w.hi+5000 where w.hi is not null group by w.hi, w.chunk)
            select {LKEY}, w.chunk from lineitem join o on o.k=cast(l_orderkey as varchar) join w on o.cum > w.lo and (w.hi is null or o.cum <= w.hi)""",
        ),
    }
)


# ---------------------------------------------------------------- runs of packages
def _context(c, name):
    return PACKAGES[name].context(c[SAMPLE_INPUTS[name]], c)


def _package_counts(name):
    def run(c):
        p = PACKAGES[name]
        whole = _context(c, name)
        ctx, tables = share_paths(whole, p.checks)
        try:
            return FU.package_counts(ctx, p.checks, apart=True).select("check_id", "result")
        finally:  # the counts are found
            drop_shared(whole, tables)

    return run


from oracle.checks import SQL as CHECK_SQL  # noqa: E402


for _name, _p in PACKAGES.items():
    OPS[f"L07_run_{_name}"] = (
        _package_counts(_name),
        " union all ".join(f"select '{k.id}' as check_id, (select count(*) from ({CHECK_SQL[k.id]})) as result" for k in _p.checks),
    )
OPS["L08_item_summary"] = (
    lambda c: RU.summary(PACKAGES["item"], c["stg_item"], c),
    " union all ".join(f"select '{k.id}' as check_id, to_json(t)::varchar as row from (select columns(*)::varchar from ({CHECK_SQL[k.id]})) t" for k in PACKAGES["item"].checks if k.summary),
)
OPS["L10_input_lines"] = (
    lambda c: RU.input_lines(PACKAGES["item"].check("A57").frame(_context(c, "item"))),
    f"select inp as INPUT from ({CHECK_SQL['A57']})",
)
OPS["X01_row_function"] = (lambda c: c["stg_doc"].select("doc_id", T.status_text("document_status").alias("v")), "select doc_id, case lower(trim(document_status)) when 'active' then 'ACTIVE' when 'obsolete' then 'Obsolete' end as v from {stg_doc}")
OPS["X02_sql_check"] = (
    lambda c: C.sql_check("Z1", "ISSUE", "Large parts", "select p_partkey, p_size from {chk} where p_size > :limit and p_brand in (select brand from {brands})", limit=40).frame(C.Context(c["part"], c)),
    "select p_partkey, p_size from part where p_size > 40",
)
OPS["V16_not_in_lov"] = (lambda c: S.not_in_lov(c["documents"], {"lang": "v"}, c["documents"].filter("lang in ('en', 'fr')").select(F.col("lang").alias("v")), "source"), "select lang, count(distinct source) as cnt from documents where lang not in ('en','fr') group by 1")
OPS["V26_not_numeric"] = (lambda c: R.not_numeric("quantity").frame(c["stg_bom"]), "select * from {stg_bom} where quantity is not null and try_cast(quantity as decimal(38,10)) is null")
OPS["V23_only_mismatch"] = (lambda c: L.contexts_contained(c["stg_supersede"], c["altid_all_site"], "sup_id", "sur_id", only_mismatch=True), f"select * from ({CHECK_SQL['E17']}) where is_nomatch=1")
OPS["C07_fixed"] = (
    lambda c: PACKAGES["doc_relation"].check("C07").frame(PACKAGES["doc_relation"].context(c["stg_docrel"], c, fixed=True)),
    "select * from (select item_id, revision, doc_id, relationship_type, count(*) over (partition by item_id, revision, relationship_type, doc_id) as count from {stg_docrel} where relationship_type='RelatedDocuments') where count > 1",
)
OPS["B48_exact_revisions"] = (
    lambda c: PACKAGES["document"].check("B48").frame(PACKAGES["document"].context(c["stg_doc"], c, exact_revisions=True)),
    CHECK_SQL["B48"].replace("not (l.rev_current like '%'||coalesce(j.revision,'')||'%')", "not list_contains(string_split(l.rev_current, ', '), j.revision)"),
)
OPS.update(files.OPS)
