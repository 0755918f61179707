"""Staged inputs and master tables expressed over the TPC-H-like sample tables.

Each view is one SQL body that means the same in Spark SQL (session time zone UTC) and in
DuckDB; ``{name}`` marks another view or a base table.  Production jobs pass their own tables
to :class:`sievemark.sources.catalog.Catalog`; these views only exist so that every check has
real rows to run on.
"""

from __future__ import annotations

import re

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _part_id(a: str) -> str:
    return (
        f"concat(lpad(cast({a}.p_partkey as string),8,'0'),'-',lpad(cast({a}.p_size as string),3,'0'),"
        f"case when {a}.p_partkey%4=0 then ':GRP1P' when {a}.p_partkey%4=1 then ':GRP2' else '' end)"
    )


def _doc_id(a: str) -> str:
    return (
        f"concat('DOC-',lpad(cast({a}.doc_id as string),8,'0'),"
        f"case when {a}.doc_id%5=0 then ':A:B' when {a}.doc_id%5=1 then ':A' else '' end)"
    )


_P = _part_id("p")
_D = _doc_id("d")

VIEWS: dict[str, str] = {}

# ---------------------------------------------------------------- staged inputs

VIEWS["stg_item"] = f"""
select case when p.p_partkey%13=0 then lower({_P}) when p.p_partkey%17=0 then concat({_P},' ')
            when p.p_partkey%19=0 then concat({_P},'#') when p.p_partkey%37=0 then concat({_P},':X/(2)')
            when p.p_partkey%43=0 then concat('-',{_P}) when p.p_partkey%47=0 then concat({_P},repeat('Z',60)) else {_P} end as tc_id,
  concat('L',cast(p.p_partkey as string)) as legacyid,
  case when p.p_partkey%27=0 then concat('A:',cast(p.p_partkey as string),' ') when p.p_partkey%28=0 then concat('*',cast(p.p_partkey as string))
       when p.p_partkey%44=0 then concat(cast(p.p_partkey as string),repeat('9',32)) when p.p_partkey%46=0 then {_P}
       when p.p_partkey%5<>0 then lpad(cast(p.p_partkey-p.p_partkey%25%2 as string),8,'0') end as alternateid,
  case when p.p_partkey%23=0 then null when p.p_partkey%8=0 then 'A.B' when p.p_partkey%8=1 then '--'
       when p.p_partkey%8=2 then 'a_1' else lpad(cast(p.p_size%4 as string),2,'0') end as revision,
  case when p.p_partkey%29<>0 then make_date(cast(1980+p.p_partkey%40 as int),cast(1+p.p_partkey%12 as int),cast(1+p.p_partkey%28 as int)) end as rev_creation_date,
  case when p.p_partkey%31=0 then null when p.p_partkey%9=0 then concat(p.p_name,chr(9),'x')
       when p.p_partkey%9=1 then concat(p.p_name,chr(233)) when p.p_partkey%9=2 then repeat(p.p_name,8)
       when p.p_partkey%9=8 then concat('new ',p.p_name) else p.p_name end as name,
  case when p.p_partkey%7=0 then null when p.p_partkey%7=1 then concat(repeat(p.p_name,5),chr(241)) else p.p_name end as name2,
  case when p.p_partkey%9=3 then null when p.p_partkey%9=4 then concat(p.p_type,'|',p.p_name)
       when p.p_partkey%9=5 then repeat(p.p_name,40) when p.p_partkey%9=6 then concat(p.p_type,chr(10),p.p_name)
       when p.p_partkey%9=7 then concat(p.p_type,chr(7),p.p_name) else concat(p.p_type,' ',p.p_name) end as description,
  case when p.p_partkey%21=0 then 'FURLONG' when p.p_partkey%22=0 then null else p.p_type end as uom,
  p.p_type as engineering_type,
  case when p.p_partkey%4=0 then ' active' when p.p_partkey%4=1 then 'Superseded' end as item_status,
  'Released' as revision_status,
  case when p.p_partkey%3<>0 then make_date(cast(1985+p.p_partkey%40 as int),6,15) end as rev_release_date,
  cast(p.p_partkey%2 as string) as traceability,
  case when p.p_partkey%12=0 then 'GRP1 West' else p.p_brand end as owninggroup
from {{part}} p
union all
select upper({_P}), concat('L',cast(p.p_partkey as string)), cast(p.p_partkey as string), lpad(cast(p.p_size%4 as string),2,'0'),
  case when p.p_partkey%20=2 then make_date(cast(1980+p.p_partkey%40 as int),cast(1+p.p_partkey%12 as int),cast(1+p.p_partkey%28 as int)) else make_date(2001,1,1) end,
  p.p_name, p.p_name, p.p_type, p.p_type, p.p_type, 'Active', 'Released', make_date(2002,2,2), '0', p.p_brand
from {{part}} p where p.p_partkey%10=2
"""

_PATH = (
    "case when d.doc_id%9=0 then null when d.doc_id%9=1 then concat('c:',chr(92),'tmp') "
    "else concat(chr(92),chr(92),'srv',cast(d.doc_id%4 as string),chr(92),d.source,chr(92),'f',"
    "cast(d.doc_id%200 as string),'.',case when d.doc_id%2=0 then 'pdf' else 'dwg' end) end"
)
_DOC_CREATED = "make_date(cast(1990+d.doc_id%30 as int),cast(1+d.doc_id%12 as int),cast(1+d.doc_id%28 as int))"

VIEWS["stg_doc"] = f"""
select case when d.doc_id%41=0 then concat(' ',{_D},' ') when d.doc_id%42=1 then concat({_D},'/~',repeat('9',60)) else {_D} end as doc_id, case when d.doc_id%33=0 then null else d.text end as name,
  case when d.doc_id%34=0 then null else d.text end as description,
  case when d.doc_id%35=0 then null when d.doc_id%36=0 then 'b-1' else cast(d.n_chars%4 as string) end as revision,
  case when d.doc_id%4<>0 then 'Released' end as revision_status,
  case when d.doc_id%10<>0 then {_DOC_CREATED} end as rev_creation_date,
  case when d.doc_id%3<>0 then make_date(cast(1995+d.doc_id%25 as int),6,15) end as rev_release_date,
  case when d.doc_id%6=0 then null when d.doc_id%6=1 then ' obsolete' else 'Active' end as document_status,
  case when d.doc_id%37=0 then null when d.doc_id%3=0 then upper(substr(d.source,1,4)) else upper(substr(d.source,1,3)) end as document_category,
  case when d.doc_id%38=0 then null else d.lang end as document_type,
  concat('DS-',cast(d.doc_id as string)) as dataset_name, {_PATH} as path_location,
  concat('Brand#',cast(d.doc_id%30+1 as string)) as owninggroup
from {{documents}} d
union all
select lower({_D}), d.text, d.text, cast((d.n_chars+d.doc_id%2)%4 as string), 'Released', {_DOC_CREATED},
  make_date(2010,1,1), 'Active', upper(substr(d.source,1,3)), case when d.doc_id%12=0 then 'xx' else d.lang end,
  concat('DS-',cast(d.doc_id as string)), {_PATH}, concat('Brand#',cast(d.doc_id%30+1 as string))
from {{documents}} d where d.doc_id%6=0
union all
select {_D}, d.text, d.text, 'Z', 'Released', {_DOC_CREATED}, null, 'Active', upper(substr(d.source,1,3)), d.lang,
  concat('DS-',cast(d.doc_id as string)), {_PATH}, concat('Brand#',cast(d.doc_id%30+1 as string))
from {{documents}} d where d.doc_id%15=2
"""

VIEWS["stg_docrel"] = f"""
select {_P} as item_id, case when l.l_orderkey%71=0 then '99' else lpad(cast(l.l_linenumber as string),2,'0') end as revision,
  concat('DOC-',lpad(cast(l.l_suppkey as string),8,'0')) as doc_id,
  case when l.l_returnflag='A' then 'RelatedDefiningDocument' else 'RelatedDocuments' end as relationship_type
from {{lineitem}} l join {{part}} p on p.p_partkey=l.l_partkey
"""

VIEWS["stg_bom"] = f"""
select {_part_id("a")} as parent_tc_id, lpad(cast(a.p_partkey as string),8,'0') as parent_gid_id,
  lpad(cast(l.l_linenumber as string),2,'0') as parent_revision,
  case when l.l_orderkey%97=0 then null when l.l_orderkey%101=0 then concat(' x',chr(9),lower({_part_id("c")}),' ',repeat('y',12))
       when l.l_orderkey%103=0 then concat({_part_id("c")},' :#') when l.l_orderkey%43=0 then {_part_id("a")} else lower({_part_id("c")}) end as child_tc_id,
  case when c.p_partkey%3=0 then null else cast(c.p_partkey as string) end as child_gid_id,
  case when l.l_orderkey%41=0 then null when l.l_orderkey%37=0 then '1.5' when l.l_orderkey%61=0 then 'n/a' else cast(l.l_linenumber as string) end as seq_no,
  case when l.l_orderkey%53=0 then null when l.l_orderkey%59=0 then 'ea' when l.l_orderkey%43=0 then '0' when l.l_orderkey%47=0 then '5000'
       when l.l_orderkey%67=0 then '-2' else cast(cast(l.l_quantity as int) as string) end as quantity,
  case when l.l_orderkey%5=0 then 'as drawn' end as refdefcomments
from {{lineitem}} l join {{part}} a on a.p_partkey=l.l_suppkey join {{part}} c on c.p_partkey=l.l_partkey
"""

VIEWS["stg_supersede"] = f"""
select {_part_id("a")} as sup_id, {_part_id("b")} as sur_id, case when a.p_partkey%2=0 then concat('DOC-',lpad(cast(a.p_partkey%100 as string),8,'0')) end as rdd_id
from {{part}} a join {{part}} b on b.p_partkey=a.p_partkey+1
union all
select {_part_id("a")}, {_part_id("b")}, 'DOC-00000000'
from {{part}} a join {{part}} b on b.p_partkey=a.p_partkey+2 where a.p_partkey%30=0
union all
select {_doc_id("a")}, {_doc_id("b")}, null
from {{documents}} a join {{documents}} b on b.doc_id=a.doc_id+1
"""

VIEWS["stg_status"] = f"""
select {_P} as tc_id, case when p.p_partkey%2=0 or p.p_partkey%5=1 then 'ACTIVE' when p.p_partkey%3=0 then 'PHASE OUT' else 'OBSOLETE' end as status_new,
  case when p.p_partkey%3<>0 then concat('DOC-',lpad(cast(p.p_partkey%300 as string),8,'0')) end as rdd_id
from {{part}} p
union all
select {_P}, 'ACTIVE', concat('DOC-',lpad(cast(p.p_partkey%300 as string),8,'0')) from {{part}} p where p.p_partkey%20=4
union all
select {_D}, 'ACTIVE', null from {{documents}} d
"""

VIEWS["stg_owner"] = f"""
select {_P} as tc_id, case when p.p_partkey%4=0 then 'Brand#1.Old' else concat(p.p_brand,'.Sub') end as grp_old,
  concat('Brand#',cast(p.p_partkey%5+1 as string)) as grp_new
from {{part}} p
union all
select {_P}, p.p_brand, 'Brand#3' from {{part}} p where p.p_partkey%40=8
union all
select {_D}, concat('Brand#',cast(d.doc_id%25+1 as string)), 'Brand#2' from {{documents}} d
"""

VIEWS["stg_namedesc"] = """
select upper(s.tc_id) as tc_id, s.name as name1, s.name2 as name2, s.description as description from {stg_item} s
union all
select upper(s.tc_id), s.name, s.name2 || chr(9), s.description from {stg_item} s where s.legacyid like '%7'
"""

# ---------------------------------------------------------------- master tables

VIEWS["mst_item"] = f"""
select concat('I',cast(p.p_partkey as string)) as puid, case when p.p_partkey%10=7 then concat('OLD-',{_P}) else {_P} end as item_id, p.p_partkey as k, 0 as is_doc,
  case when p.p_partkey%41<>0 then p.p_brand end as grp, p.p_brand as owner_grp, p.p_name as nm, concat(p.p_type,' ',p.p_name) as ds,
  p.p_type as uom, cast(p.p_size as bigint) as sz
from {{part}} p
union all
select concat('D',cast(d.doc_id as string)), case when d.doc_id%20=7 then concat('OLD-',{_D}) else {_D} end, d.doc_id, 1, concat('Brand#',cast(d.doc_id%25+1 as string)),
  concat('Brand#',cast(d.doc_id%25+1 as string)), d.text, d.text, null, d.n_chars
from {{documents}} d
"""

VIEWS["mst_rev"] = """
select concat('R',cast(r.l_partkey as string),'-',cast(r.l_linenumber as string)) as puid, concat('I',cast(r.l_partkey as string)) as item_puid,
  lpad(cast(r.l_linenumber as string),2,'0') as rev, r.l_partkey as k, 0 as is_doc, r.created as created, r.released as released
from (select l_partkey, l_linenumber, min(l_shipdate) as created,
        max(case when l_linestatus='F' and l_partkey%15<>0 then l_shipdate end) as released
      from {lineitem} group by l_partkey, l_linenumber) r
union all
select concat('D',cast(d.doc_id as string),'-',d.rev), concat('D',cast(d.doc_id as string)), d.rev, d.doc_id, 1,
  d.created, case when d.doc_id%11<>0 and d.rev<>'2' then d.created end
from (select doc_id, '0' as rev, cast(make_date(cast(2000+doc_id%20 as int),1,5) as timestamp) as created from {documents}
      union all select doc_id, '1', cast(make_date(cast(2001+doc_id%20 as int),2,6) as timestamp) from {documents} where n_chars%3>0
      union all select doc_id, '2', cast(make_date(cast(2002+doc_id%20 as int),3,7) as timestamp) from {documents} where n_chars%3>1) d
"""

VIEWS["pitem"] = """
select m.puid as puid, m.item_id as pitem_id, case when m.is_doc=0 and m.k%11<>3 then concat('U',case when m.k%26=0 then 'PROMO' else m.uom end) end as ruom_tagu from {mst_item} m
union all
select concat('X',m.puid), m.item_id, null from {mst_item} m where m.k%16=5
"""

VIEWS["ppom_object"] = """
select m.puid as puid, case when m.k%16=6 then 'S2' end as rowning_siteu from {mst_item} m
union all
select concat('X',m.puid), 'S3' from {mst_item} m where m.k%16=5
"""

VIEWS["item_all_site"] = """
select m.puid as puid, case when m.k%14=0 then lower(m.item_id) else m.item_id end as tc_id, m.grp as pname,
  concat('SITE',cast(m.sz%5 as string)) as local_site,
  case when m.k%6=0 then 'Superseded' when m.k%6=1 then 'Obsolete' else 'Active' end as status,
  case when m.is_doc=1 then 'Documents' when m.k%3=0 then 'Nov4Part' when m.k%3=1 then 'Non-Engineering' when m.k%9=2 then 'Tool' end as item_type,
  m.nm as pobject_name, m.ds as pobject_desc,
  case when m.k%3=0 then 'JDE,RS-One' when m.k%3=1 then 'SAP;JDE' end as ip
from {mst_item} m
"""

VIEWS["item_all_site_rev"] = """
select m.item_id as tc_id, r.rev as rev from {mst_item} m join {mst_rev} r on r.item_puid=m.puid
"""

VIEWS["pitemrevision"] = """
select r.puid as puid, r.item_puid as ritems_tagu, r.rev as pitem_revision_id from {mst_rev} r
"""

VIEWS["pworkspaceobject"] = """
select m.puid as puid, case when m.k%12=0 then concat(m.nm,' X') when m.k%12=5 and m.is_doc=0 then upper(replace(m.nm,' ','-')) when m.k%12=5 then replace(m.nm,' ','-') else m.nm end as pobject_name,
  case when m.is_doc=1 and m.k%9=4 then concat(m.ds,' (old)') else m.ds end as pobject_desc, case when m.is_doc=1 then 'Documents' else 'Nov4Part' end as pobject_type, cast(null as timestamp) as pdate_released from {mst_item} m
union all
select r.puid, concat('rev ',r.rev), concat('of ',r.item_puid), case when r.is_doc=1 then 'DocumentsRevision' else 'Nov4PartRevision' end, r.released from {mst_rev} r
union all
select concat('S',cast(d.doc_id as string)), concat('DS-',cast(d.doc_id as string)), 'dataset', 'Dataset', cast(null as timestamp) from {documents} d
"""

VIEWS["ppom_application_object"] = """
select m.puid as puid, concat('G',m.owner_grp) as rowning_groupu, concat('US',cast(m.k%25 as string)) as rowning_useru, cast(null as timestamp) as pcreation_date from {mst_item} m
union all
select r.puid, concat('GBrand#',cast(r.k%25+1 as string)), concat('US',cast(r.k%25 as string)), r.created from {mst_rev} r
"""

VIEWS["brands"] = """
select distinct p.p_brand as brand, cast(substr(p.p_brand,7) as int) as n from {part} p
"""

VIEWS["ppom_group"] = """
select concat('G',b.brand) as puid, b.brand as pname, case when b.n%6<>5 then concat('GP',cast(b.n%4 as string)) end as rparentu from {brands} b
union all
select distinct concat('GP',cast(b.n%4 as string)), concat('Division ',cast(b.n%4 as string)), cast(null as string) from {brands} b
"""

VIEWS["dim_group_master"] = """
select case when b.n%2=0 then upper(b.brand) else b.brand end as group_name, concat('SITE',cast(b.n%5 as string)) as primary_site,
  concat('BU',cast(b.n%3 as string)) as business_unit, concat('Division ',cast(b.n%4 as string)) as parent_name,
  case when b.n%2=0 then 'JDE' else 'SAP' end as erps from {brands} b where b.n%6<>0
union all
select b.brand, 'SITE9', 'BU9', 'Division 9', 'JDE' from {brands} b where b.n%8=1
"""

VIEWS["ppom_user"] = """
select concat('US',cast(n.n_nationkey as string)) as puid, n.n_name as puser_id from {nation} n
"""

VIEWS["prelease_status_list"] = """
select m.puid as puid, concat('ST',cast(m.k%6 as string)) as pvalu_0 from {mst_item} m where m.k%8<>3
union all
select m.puid, 'ST1' from {mst_item} m where m.k%24=2
"""

VIEWS["preleasestatus"] = """
select distinct concat('ST',cast(p.p_partkey%6 as string)) as puid,
  case when p.p_partkey%6=0 then 'Superseded' when p.p_partkey%6=1 then 'Obsolete' when p.p_partkey%6=5 then 'Phase Out' else 'Active' end as pname
from {part} p
"""

VIEWS["pimantype"] = """
select 'T1' as puid, 'RelatedDefiningDocument' as ptype_name union all select 'T2', 'RelatedDocuments'
union all select 'T3', 'IMAN_master_form' union all select 'T4', 'IMAN_specification' union all select 'T5', 'Nov4_Superseded_by'
"""

VIEWS["pimanrelation"] = """
select concat('R',cast(l.l_partkey as string),'-',cast(l.l_linenumber as string)) as rprimary_objectu, concat('D',cast(l.l_suppkey as string)) as rsecondary_objectu,
  case when l.l_returnflag='A' then 'T1' else 'T2' end as rrelation_typeu from {lineitem} l
union all
select m.puid, concat('F',m.puid), 'T3' from {mst_item} m where m.k%9<>4
union all
select r.puid, concat('F',r.puid), 'T3' from {mst_rev} r where r.k%9<>4
union all
select r.puid, concat('S',cast(r.k as string)), 'T4' from {mst_rev} r where r.is_doc=1
union all
select m.puid, concat('I',cast(m.k+1 as string)), 'T5' from {mst_item} m where m.is_doc=0 and (m.k%6=0 or m.k%20=3)
"""

VIEWS["pform"] = """
select concat('F',m.puid) as puid, concat('M',m.puid) as rdata_fileu from {mst_item} m
union all
select concat('F',r.puid), concat('M',r.puid) from {mst_rev} r
"""

VIEWS["part_form"] = """
select concat('M',m.puid) as puid, case when m.k%10=1 then 'STANDARD' when m.k%10<>2 then m.uom end as prsone_itemtype,
  case when m.k%10=3 then 'EA' when m.k%10<>4 then m.uom end as prsone_uom, upper(m.nm) as pname2 from {mst_item} m where m.is_doc=0 and m.k%3=0
"""

VIEWS["nonengineering_form"] = """
select concat('M',m.puid) as puid, case when m.k%10<>5 then m.uom end as prsone_itemtype, m.uom as prsone_uom, lower(m.nm) as pname2
from {mst_item} m where m.is_doc=0 and m.k%3=1
"""

VIEWS["part_revision_form"] = """
select concat('M',r.puid) as puid, case when r.k%5=0 then 'Prototype' else 'Production' end as plifecycle, concat('P',r.rev) as pname2 from {mst_rev} r where r.is_doc=0 and r.k%2=0
"""

VIEWS["document_revision_form"] = """
select concat('M',r.puid) as puid, case when r.k%4=0 then 'Draft' else 'Production' end as plifecycle from {mst_rev} r where r.is_doc=1
"""

VIEWS["version_form"] = """
select concat('M',r.puid) as puid, 'Legacy' as plifecycle, concat('V',r.rev) as pname2 from {mst_rev} r where r.is_doc=0 and r.k%4=1
"""

VIEWS["punitofmeasure"] = """
select distinct concat('U',p.p_type) as puid, p.p_type as psymbol from {part} p
"""

VIEWS["plistofvalues"] = """
select 'V1' as puid, '_RSOne_UnitsOfMeasure_' as plov_name
union all select distinct concat('V',upper(substr(d.source,1,3))), concat(case when d.doc_id%2=0 then 'Nov4' else '' end,upper(substr(d.source,1,3)),'_Subtype_LOV') from {documents} d
union all select 'V3', 'SRC_Other_LOV'
"""

VIEWS["plov_values_2"] = """
select 'V1' as puid, min(p.p_partkey) as pseq, substr(p.p_type,1,5) as pval_0 from {part} p group by p.p_type
union all
select concat('V',upper(substr(d.source,1,3))), min(d.doc_id), d.lang from {documents} d where d.lang<>'de' group by upper(substr(d.source,1,3)), d.lang
union all
select 'V3', 0, 'de'
"""

VIEWS["plov_value_descriptions_2"] = """
select 'V1' as puid, min(p.p_partkey) as pseq, concat(lower(p.p_type),case when p.p_type='LARGE' then ',other' else ',RSONE unit' end) as pval_0 from {part} p group by p.p_type
"""

VIEWS["pidcontext"] = """
select 'C1' as puid, 'JDE' as pidcxt_name union all select 'C2', 'RSOne' union all select 'C3', 'SAP'
"""

VIEWS["pidentifier"] = """
select m.puid as raltid_ofu, lpad(cast(m.k as string),8,'0') as pidfr_id, 'C1' as ridcontextu from {mst_item} m where m.k%2=0
union all select m.puid, cast(m.k as string), 'C2' from {mst_item} m where m.k%3<>0
union all select m.puid, concat('s',cast(m.k as string)), 'C3' from {mst_item} m where m.k%7=0
"""

VIEWS["altid_all_site"] = """
select m.item_id as pitem_id, a.pidfr_id as pidfr_id, c.pidcxt_name as pidcxt_name, m.grp as item_group, concat('SITE',cast(m.sz%5 as string)) as local_site
from {mst_item} m join {pidentifier} a on a.raltid_ofu=m.puid join {pidcontext} c on c.puid=a.ridcontextu
"""

VIEWS["chk_superseded_items"] = """
select m.puid as superseded_puid, concat('I',cast(m.k+1 as string)) as survivor_id from {mst_item} m where m.k%12=0
union all select m.puid, concat('I',cast(m.k+2 as string)) from {mst_item} m where m.k%36=0
"""

VIEWS["pdataset"] = """
select concat('S',cast(d.doc_id as string)) as puid, concat('DT',cast(d.doc_id%2 as string)) as rdataset_typeu from {documents} d
"""

VIEWS["pdatasettype"] = """
select 'DT0' as puid, 'PDF' as pdatasettype_name union all select 'DT1', 'ACADDWG'
"""

VIEWS["pref_list_0"] = """
select concat('S',cast(d.doc_id as string)) as puid, concat('IF',cast(d.doc_id as string)) as pvalu_0 from {documents} d
union all select concat('S',cast(d.doc_id as string)), concat('IF',cast(d.doc_id as string),'b') from {documents} d where d.doc_id%4=0
"""

VIEWS["pimanfile"] = """
select r.pvalu_0 as puid, concat(lower(r.puid),case when r.pvalu_0 like '%b' then '.dwg' else '.pdf' end) as poriginal_file_name from {pref_list_0} r
"""

VIEWS["pstructure_revisions"] = """
select r.puid as puid, concat('B',r.puid) as pvalu_0 from {mst_rev} r where r.is_doc=0
"""

VIEWS["ppsoccurrence"] = """
select concat('BR',cast(l.l_suppkey as string),'-',cast(l.l_linenumber as string)) as rparent_bvru, concat('I',cast(l.l_partkey as string)) as rchild_itemu,
  l.l_quantity+l.l_discount/7 as pqty_value, cast(l.l_linenumber as string) as pseq_no,
  case when l.l_partkey%3<>0 then concat('N',cast(l.l_partkey as string)) end as rnotes_refu
from {lineitem} l
"""

VIEWS["ppsoccurrencenotes"] = """
select concat('N',cast(p.p_partkey as string)) as puid from {part} p where p.p_partkey%3<>0
"""

VIEWS["pnotetype"] = """
select 'NT1' as puid, 'Reference Designator' as pname union all select 'NT2', 'Nov4RefDefComments'
"""

VIEWS["pnote_types"] = """
select concat('N',cast(p.p_partkey as string)) as puid, 0 as pseq, 'NT1' as pvalu_0 from {part} p where p.p_partkey%3<>0
union all select concat('N',cast(p.p_partkey as string)), 1, 'NT2' from {part} p where p.p_partkey%3=1
"""

VIEWS["pnote_texts"] = """
select n.puid as puid, n.pseq as pseq, concat(case when n.pseq=0 then 'C' else 'see ' end,n.puid) as pval_0 from {pnote_types} n
"""

# The two ranking views have no published definition: latest creation date among the released
# (with a release date) or the working revisions (without one); ties go to the larger revision id.
for _name, _test in (("released", "is not null"), ("working", "is null")):
    VIEWS[f"z_max_rev_{_name}"] = f"""
select t.puid as puid, t.ritems_tagu as ritems_tagu, t.pitem_revision_id as pitem_revision_id from (
  select r.puid, r.item_puid as ritems_tagu, r.rev as pitem_revision_id,
    row_number() over (partition by r.item_puid order by case when r.created is null then 0 else 1 end, r.created desc, r.rev desc) as rn
  from {{mst_rev}} r where r.released {_test}) t where t.rn=1
"""

_REF = re.compile(r"\{([a-z_]\w*)\}")


def dependencies(name: str) -> list[str]:
    """Direct inputs of a view, in order of first use."""
    return list(dict.fromkeys(_REF.findall(VIEWS[name])))


def standalone_sql(query: str) -> str:
    """Prefix ``query`` with CTEs for every view it names with ``{view}``; base tables stay bare names."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in VIEWS and name not in order:
            for dep in dependencies(name):
                visit(dep)
            order.append(name)

    for name in _REF.findall(query):
        visit(name)
    bare = lambda text: _REF.sub(r"\1", text)
    if not order:
        return bare(query)
    ctes = ",\n".join(f"{n} as ({bare(VIEWS[n]).strip()})" for n in order)
    text = bare(query).strip()
    return f"with {ctes},\n{text[5:]}" if text.startswith("with ") else f"with {ctes}\n{text}"
