"""One DuckDB statement per check."""

from oracle.snippets import cat, counted, decades, docs, edges, forms, freq, has, long_text, marked, not_ascii, parts, pattern, rows, sub, twice, words
from oracle.snippets import ALT, CNTRL, DW, EIGHT3, INVALID, ITEM, LOCAL, OWNER, PARENT, PART_FORMS, QUESTION, SPECIAL, STATUS, STATUS_ANY, TRAIL, WS

I, D, R, B, S, G, H, N = "stg_item stg_doc stg_docrel stg_bom stg_supersede stg_status stg_owner stg_namedesc".split()
IDS = "(select upper(parent_tc_id) as tc_id from {stg_bom} union select upper(child_tc_id) from {stg_bom})"
TYPED = "(select upper(parent_tc_id) as tc_id, 'Assembly' as type from {stg_bom} union select upper(child_tc_id), 'Component' from {stg_bom})"
REL, WRK = "{z_max_rev_released}", "{z_max_rev_working}"


def ids_where(test, show="tc_id"):
    return f"select {show} from {IDS} where {test}"


def profile(src, group, per, show, ignore=True):
    l, r = (f"upper({group})", "upper(g.group_name)") if ignore else (group, "g.group_name")
    return f"select distinct {show}, count(*) over (partition by {per}) as cnt from {src} left join {{dim_group_master}} g on {r}={l}"


def master_texts(src, key, new, cur, label, tail, lens=False, distinct=False):
    extra = f", length(w.{cur}) as length_current" if lens else ""
    extra2 = f", length(c.{new}) as length_new" if lens else ""
    d = "distinct " if distinct else ""
    return (
        f"select {d}{tail} as inp, c.{key}, w.{cur} as {label}_current{extra}, c.{new} as {label}_new{extra2} from {{{src}}} c join {DW} w on w.k=upper(c.{key}) "
        f"join {{pworkspaceobject}} o on o.puid=w.puid where {words('c.' + new)} <> {words('o.' + cur)}"
    )


def status_change(src, key, col, distinct=False):
    d = "distinct " if distinct else ""
    return (
        f"select {d}{cat('w.tc_id', chr(39) + '|' + chr(39), 'c.' + col)} as inp, c.{key}, w.status as status_current, c.{col} as status_new from {{{src}}} c "
        f"join {DW} w on w.k=upper(c.{key}) left join {STATUS_ANY} s on s.sid=w.puid where coalesce(upper(trim(c.{col})),'none') <> coalesce(upper(s.sname),'none')"
    )


def same_date(src, key):
    return (
        f"with u as (select distinct {key}, rev_creation_date, revision from {{{src}}}) select {key}, rev_creation_date, count(revision) as cnt_revs_same_date, "
        f"string_agg(revision, ', ' order by revision) as revisions_samedate from u group by 1,2 having count(revision) > 1"
    )


def lov_units(col):
    return (
        f"select c.uom as given_uom, count(distinct c.tc_id) as cnt from {{stg_item}} c where not exists (select 1 from {{plistofvalues}} l, {{plov_values_2}} v, "
        f"{{plov_value_descriptions_2}} t, {{punitofmeasure}} m where l.plov_name='_RSOne_UnitsOfMeasure_' and v.puid=l.puid and t.puid=v.puid and t.pseq=v.pseq "
        f"and t.pval_0 like '%RSONE%' and upper(m.psymbol)=upper(nullif(split_part(t.pval_0,',',1),'')) and t.pval_0 like '%,%' and {col}=c.uom) group by c.uom"
    )


SQL: dict[str, str] = {}

# ------------------------------------------------------------------ item
DWCOLS = ", ".join(f"w.{c} as dw_{c}" for c in "puid tc_id pname local_site status item_type pobject_name pobject_desc ip".split())
DWBARE = ", ".join(f"w.{c} as {c}" for c in "puid tc_id pname local_site status item_type pobject_name pobject_desc ip".split())
Q = "'"
SQL |= {
    "A01": counted(I),
    "A02": counted(I, "count(distinct tc_id)"),
    "A03": twice(I, "upper(tc_id), upper(revision)"),
    "A04": f"select distinct c.tc_id, {DWCOLS} from {{stg_item}} c join {DW} w on w.k=upper(c.tc_id)",
    "A05": f"select count(distinct c.tc_id) as count from {{stg_item}} c join {LOCAL} i on i.k=upper(c.tc_id)",
    "A06": "select distinct c.tc_id, c.alternateid as given_altid, a.pidcxt_name as cxt, a.pitem_id as actual_related_item, a.item_group, a.local_site from {stg_item} c join {altid_all_site} a on upper(a.pidfr_id)=upper(c.alternateid)",
    "A07": f"select c.tc_id, c.alternateid, a.pidfr_id as current_altid from {{stg_item}} c join {ALT} a on a.k=upper(c.tc_id) where c.alternateid<>a.pidfr_id",
    "A08": freq(I, sub("tc_id", ":.*"), "suffix", label="None"),
    "A09": rows(I, "tc_id, " + sub("tc_id", "[^:]+$") + " as suffix, owninggroup", f"contains(tc_id, ':') and nullif(regexp_replace({sub('tc_id', '[^:]+$')}, 'P$', ''), '') <> {sub('owninggroup', '^[^ ]+')}", True),
    "A10": rows(I, "tc_id", "tc_id like '%:%:%'", True),
    "A11": rows(I, "legacyid, tc_id, owninggroup", f"not (tc_id like '%:%P') and not {has('tc_id', EIGHT3)}", True),
    "A12": rows(I, "legacyid, tc_id, owninggroup", has("tc_id", r"^\d{8}-\d{3}") + " and contains(tc_id, ':')"),
    "A13": "select tc_id, count(distinct revision) as rev_count, string_agg(revision, ', ' order by revision) as revision_list from {stg_item} group by tc_id having rev_count > 1",
    "A14": same_date(I, "tc_id"),
    "A15": rows(I, "tc_id, revision", "revision is null"),
    "A16": freq(I, "revision", "revision"),
    "A17": rows(I, "tc_id, revision", has(r"regexp_replace(revision, '(.)\.(.)', '\1\2', 'g')", "[^A-Z0-9]") + " and not " + has("revision", "^-{1,2}$"), True),
    "A18": long_text(I, "tc_id", 64),
    "A19": long_text(I, "tc_id", 25),
    "A20": pattern(I, "tc_id", WS),
    "A21": pattern(I, "tc_id", "^[[:alnum:]]", negate=True),
    "A22": pattern(I, "tc_id", TRAIL),
    "A23": pattern(I, "tc_id", INVALID),
    "A24": pattern(I, "tc_id", QUESTION),
    "A25": counted(I, where="alternateid is null"),
    "A26": "select * from (select distinct tc_id, alternateid, (select count(distinct b.alternateid) from {stg_item} b where upper(b.tc_id) is not distinct from upper(a.tc_id)) as cnt from {stg_item} a) where cnt > 1",
    "A27": "select upper(alternateid) as alternateid, count(distinct tc_id) as cnt from {stg_item} where alternateid is not null group by 1 having cnt > 1",
    "A28": long_text(I, "alternateid", 32),
    "A29": pattern(I, "alternateid", WS),
    "A30": pattern(I, "alternateid", "^[[:alnum:]]", negate=True),
    "A31": pattern(I, "alternateid", TRAIL),
    "A32": pattern(I, "alternateid", SPECIAL),
    "A33": pattern(I, "alternateid", ":"),
    "A34": pattern(I, "alternateid", EIGHT3, negate=True),
    "A35": rows(I, "tc_id, alternateid", has("tc_id", EIGHT3) + " and tc_id<>alternateid"),
    "A36": rows(I, "tc_id, name", "name is null"),
    "A37": long_text(I, "name", 64, "tc_id, name"),
    "A38": long_text(I, "name", 30, "tc_id, name"),
    "A39": not_ascii(I, "name", "tc_id"),
    "A40": marked(I, "name", "(CNTRL)", "tc_id"),
    "A41": counted(I, name="count", where="name2 is null"),
    "A42": long_text(I, "name2", 30, "tc_id, name2"),
    "A43": not_ascii(I, "name2", "tc_id"),
    "A44": counted(I, name="count", where="description is null"),
    "A45": long_text(I, "description", 240, "tc_id, description"),
    "A46": pattern(I, "description", r"\|", "tc_id, description"),
    "A47": marked(I, "description", "(CNTRL)", "tc_id"),
    "A48": counted(I, name="count", where="rev_release_date is null"),
    "A49": counted(I, name="count", where="rev_creation_date is null"),
    "A50": decades(I, "rev_release_date"),
    "A51": decades(I, "rev_creation_date"),
    "A52": lov_units("m.psymbol"),
    "A53": lov_units("v.pval_0"),
    "A54": profile("{stg_item} c", "c.owninggroup", "c.owninggroup", "g.primary_site, g.business_unit, g.parent_name, c.owninggroup as grp, g.erps"),
    "A55": freq(I, "item_status", "item_status", "count"),
    "A56": freq(I, "revision_status", "revision_status", "count"),
    "A57": f"select {cat('w.tc_id', Q + '|' + Q, 'r.pitem_revision_id', Q + '|' + Q, 'c.revision')} as inp, c.tc_id, r.pitem_revision_id as rev_current, c.revision as rev_new from {{stg_item}} c join {DW} w on w.k=upper(c.tc_id) join {{pitemrevision}} r on r.ritems_tagu=w.puid where c.revision<>r.pitem_revision_id",
    "A58": f"select * from (select c.tc_id, r.pitem_revision_id as rev_current, count(*) over (partition by c.tc_id) as cnt from {{stg_item}} c join {DW} w on w.k=upper(c.tc_id) join {{pitemrevision}} r on r.ritems_tagu=w.puid) where cnt > 1",
    "A59": status_change(I, "tc_id", "item_status"),
    "A60": master_texts(I, "tc_id", "name", "pobject_name", "name", cat("w.tc_id", "'|'", "c.name", "'|IGNORE'"), True),
    "A61": master_texts(I, "tc_id", "description", "pobject_desc", "description", cat("w.tc_id", "'|IGNORE|'", "c.description")),
    "A62": f"select c.tc_id, f.prsone_itemtype as type_current, c.engineering_type as type_new from {{stg_item}} c join {DW} w on w.k=upper(c.tc_id) join {forms(PART_FORMS, 'prsone_itemtype')} f on f.fo=w.puid where coalesce(c.engineering_type,'none')<>coalesce(f.prsone_itemtype,'none')",
    "A63": f"select c.tc_id, m.psymbol as uom_current, c.uom as uom_new from {{stg_item}} c join {DW} w on w.k=upper(c.tc_id) join {{pitem}} i on i.puid=w.puid join {{punitofmeasure}} m on m.puid=i.ruom_tagu where coalesce(c.uom,'none')<>coalesce(m.psymbol,'none')",
}

# ------------------------------------------------------------------ document
FN = "upper(" + sub("path_location", r"[^\\]+$") + ")"
EXT = has("upper(path_location)", r"\.(.+)$")
DET = "doc_id, document_category, document_type, name, description"
PTH = "doc_id, revision, path_location"
SQL |= {
    "B01": counted(D),
    "B02": counted(D, "count(distinct doc_id)"),
    "B03": twice(D, "upper(doc_id), upper(revision), upper(path_location)", "dup_count", distinct=True),
    "B04": f"select {DWBARE} from (select distinct doc_id from {{stg_doc}}) c join {DW} w on w.k=upper(c.doc_id)",
    "B05": f"select count(distinct c.doc_id) as count from {{stg_doc}} c join {LOCAL} i on i.k=upper(c.doc_id)",
    "B06": freq(D, sub("doc_id", ":.*"), "suffix", label="NULL"),
    "B07": rows(D, "doc_id", "doc_id like '%:%:%'", True),
    "B08": rows(D, "doc_id", "not contains(doc_id, ':')", True),
    "B09": "select doc_id, count(distinct revision) as rev_count from {stg_doc} group by doc_id having rev_count > 1",
    "B10": same_date(D, "doc_id"),
    "B11": rows(D, "doc_id, revision", "revision is null"),
    "B12": freq(D, "revision", "revision"),
    "B13": rows(D, "doc_id, revision", has(r"regexp_replace(revision, '(.)\.(.)', '\1\2', 'g')", "[^A-Z0-9]") + " and not " + has("revision", "^-{1,2}$"), True),
    "B14": long_text(D, "doc_id", 64),
    "B15": pattern(D, "doc_id", WS),
    "B16": pattern(D, "doc_id", "^[[:alnum:]]", negate=True),
    "B17": pattern(D, "doc_id", TRAIL),
    "B18": pattern(D, "doc_id", INVALID),
    "B19": pattern(D, "doc_id", QUESTION),
    "B20": rows(D, "doc_id, name, description", "name is null"),
    "B21": long_text(D, "name", 64, "doc_id, name"),
    "B22": long_text(D, "name", 30, "doc_id, name"),
    "B23": not_ascii(D, "name", "doc_id"),
    "B24": marked(D, "name", '"CTRL"', "doc_id"),
    "B25": rows(D, "doc_id, description, name", "description is null"),
    "B26": long_text(D, "description", 240, "doc_id, description"),
    "B27": pattern(D, "description", r"\|", "doc_id, description"),
    "B28": marked(D, "description", '"CTRL"', "doc_id"),
    "B29": rows(D, DET, "document_category is null"),
    "B30": rows(D, DET, "document_type is null"),
    "B31": "select * from (select distinct upper(a.doc_id) as tc_id, a.document_type, (select count(distinct b.document_type) from {stg_doc} b where upper(b.doc_id)=upper(a.doc_id)) as cnt from {stg_doc} a) where cnt > 1",
    "B32": "select c.document_category, c.document_type, count(distinct c.doc_id) as cnt from {stg_doc} c where not exists (select 1 from {plistofvalues} l join {plov_values_2} v on v.puid=l.puid where "
    + has("l.plov_name", "^(Nov4){0,1}[A-Z]{3}_Subtype_LOV$")
    + f" and {sub('l.plov_name', '[A-Z]{3}')}=c.document_category and v.pval_0=c.document_type) group by 1, 2",
    "B33": counted(D, name="count", where="rev_release_date is null"),
    "B34": counted(D, name="count", where="rev_creation_date is null"),
    "B35": decades(D, "rev_release_date"),
    "B36": decades(D, "rev_creation_date"),
    "B37": profile("{stg_doc} c", "c.owninggroup", "c.owninggroup", "g.primary_site, g.business_unit, g.parent_name, c.owninggroup as grp, g.erps"),
    "B38": freq(D, "document_status", "document_status", "count", label="NULL"),
    "B39": freq(D, "revision_status", "revision_status", "count", label="NULL"),
    "B40": "select * from (select path_location, doc_id, revision, count(*) over (partition by upper(path_location), revision) as cnt from {stg_doc}) where cnt > 1 and path_location is not null",
    "B41": f"select * from (select doc_id, revision, upper(path_location) as path_location, {FN} as filename, count({FN}) over (partition by upper(doc_id), upper(revision), trim({FN})) as cnt from {{stg_doc}}) where cnt > 1",
    "B42": freq(D, r"regexp_replace(upper(path_location), '.+\.(.+)$', '\1')", "extensions", where=EXT),
    "B43": rows(D, PTH, f"not {EXT}", True),
    "B44": rows(D, PTH, "path_location is null", True),
    "B45": rows(D, PTH, "not starts_with(path_location, chr(92)||chr(92))", True),
    "B46": freq(D, sub("upper(path_location)", r"^\\\\[^\\]+\\[^\\]+"), "remote_drive", "count"),
    "B47": rows(D, "doc_id, revision, rev_creation_date, path_location as file_path", "path_location is not null", True),
    "B48": f"with j as (select c.doc_id, c.revision, r.ritems_tagu as it, r.pitem_revision_id as rv from {{stg_doc}} c join {DW} w on w.k=upper(c.doc_id) join {{pitemrevision}} r on r.ritems_tagu=w.puid), l as (select it, string_agg(rv, ', ' order by rv) as rev_current from j group by it) select distinct j.doc_id, l.rev_current, j.revision as rev_new from j join l using (it) where not (l.rev_current like '%'||coalesce(j.revision,'')||'%')",
    "B49": f"select distinct * from (select c.doc_id, r.pitem_revision_id as rev_current, count(*) over (partition by c.doc_id) as cnt from {{stg_doc}} c join {DW} w on w.k=upper(c.doc_id) join {{pitemrevision}} r on r.ritems_tagu=w.puid) where cnt > 1",
    "B50": status_change(D, "doc_id", "document_status", True),
    "B51": master_texts(D, "doc_id", "name", "pobject_name", "name", cat("w.tc_id", "'|'", "c.name", "'|IGNORE'"), True, True),
    "B52": master_texts(D, "doc_id", "description", "pobject_desc", "description", cat("w.tc_id", "'|IGNORE|'", "c.description"), False, True),
    "B53": f"select distinct i.pitem_id, r.pitem_revision_id, n.pobject_name as dataset_name_current, f.poriginal_file_name as dataset_namedref_current, {FN.replace('path_location', 'c.path_location')} as file_given, upper(c.path_location) as file_path_location_given from {{stg_doc}} c, {{pitem}} i, {{pitemrevision}} r, {edges('IMAN_specification')} e, {{pdataset}} s, {{pdatasettype}} t, {{pworkspaceobject}} n, {{pref_list_0}} l, {{pimanfile}} f where i.pitem_id=c.doc_id and r.ritems_tagu=i.puid and r.pitem_revision_id=c.revision and e.a=r.puid and s.puid=e.b and t.puid=s.rdataset_typeu and n.puid=s.puid and l.puid=s.puid and f.puid=l.pvalu_0",
}

# ------------------------------------------------------------------ document relation
RC = "c.item_id, c.revision, c.doc_id, c.relationship_type"


def rel_item(col, local=True):
    return f"{{stg_docrel}} c join {LOCAL if local else ITEM} i on i.k=upper(c.{col})"


def many_docs(kind, extra=""):
    return f"with f as (select * from {{stg_docrel}} where relationship_type='{kind}'), m as (select item_id, revision{extra}, count(distinct doc_id) as count from f group by all having count(distinct doc_id) > 1) select {RC.replace('c.', 'f.')}, m.count from f join m on m.item_id=f.item_id and m.revision=f.revision{' and m.doc_id=f.doc_id' if extra else ''}"


def rel_status(col, cnt, name, local):
    return f"select count(*) as {cnt}, coalesce(s.sname,'NULL') as {name} from {rel_item(col, local)} left join {STATUS if local else STATUS_ANY} s on s.sid=i.puid group by s.sname"


def rel_status_rows(test, name, local):
    return f"select s.sname as {name}, {RC} from {rel_item('item_id', local)} left join {STATUS if local else STATUS_ANY} s on s.sid=i.puid where {test}"


def latest(view, name):
    return f"select {RC}, z.pitem_revision_id as current_{name}_rev from {rel_item('item_id')} join {view} z on z.ritems_tagu=i.puid where c.revision<>z.pitem_revision_id"


GIVEN = "join {pitemrevision} r on r.ritems_tagu=i.puid and r.pitem_revision_id=c.revision"
ANYREV = "join {pitemrevision} r on r.ritems_tagu=i.puid"
WSO = "join {pworkspaceobject} o on o.puid=r.puid"
YES = "case when o.pdate_released is not null then 'Yes' else 'No' end"
SQL |= {
    "C01": counted(R),
    "C02": "select count(distinct item_id) as parts, count(distinct doc_id) as docs, count(distinct item_id)+count(distinct doc_id) as total_items from {stg_docrel}",
    "C03": twice(R, "upper(item_id), upper(revision), upper(doc_id), upper(relationship_type)", distinct=True),
    "C04": f"select tc_id, type from (select upper(item_id) as tc_id, 'PART' as type from {{stg_docrel}} union select upper(doc_id), 'DOCUMENTS' from {{stg_docrel}}) c anti join {LOCAL} i on i.k=c.tc_id",
    "C05": freq(R, "relationship_type", "relationship_type", "count"),
    "C06": many_docs("RelatedDefiningDocument"),
    "C07": many_docs("RelatedDocuments", ", doc_id"),
    "C08": f"select c.item_id, c.revision, case when c.relationship_type='RelatedDefiningDocument' then c.doc_id end as given_rdd, e.rdd_id as current_rdd, case when e.rdd_id=c.doc_id then 'Y' end as is_match from {rel_item('item_id')} {GIVEN} join {docs()} e on e.rv=r.puid",
    "C09": f"select c.item_id, c.revision, case when c.relationship_type='RelatedDocuments' then c.doc_id end as given_rd, e.rdd_id as current_rd from {rel_item('item_id')} {GIVEN} join {docs('RelatedDocuments')} e on e.rv=r.puid where e.rdd_id<>c.doc_id",
    "C10": f"select {RC} from {rel_item('item_id')} anti join {{pitemrevision}} r on r.ritems_tagu=i.puid and upper(r.pitem_revision_id)=upper(c.revision)",
    "C11": f"with t as (select r.ritems_tagu as it, r.pitem_revision_id as rv, a.pcreation_date as dt from {{pitemrevision}} r join {{ppom_application_object}} a on a.puid=r.puid), z as (select it, rv from t qualify row_number() over (partition by it order by dt desc nulls first, rv desc)=1), "
    f"j as (select {RC}, i.puid as it, z.rv as top from {rel_item('doc_id')} join z on z.it=i.puid where z.rv<>c.revision), l as (select j.it, j.revision, string_agg(t.rv, ', ' order by t.dt, t.rv) as doc_rev_list from j join t on t.it=j.it group by 1, 2) "
    "select distinct j.item_id, j.revision, j.doc_id, j.relationship_type, j.top as doc_rev_latest, l.doc_rev_list from j join l on l.it=j.it and l.revision=j.revision",
    "C12": latest(REL, "released"),
    "C13": latest(WRK, "working"),
    "C14": rel_status("item_id", "parts", "status", True),
    "C15": rel_status("doc_id", "docs", "status", True),
    "C16": rel_status_rows("s.sname='Superseded'", "item_status", True),
    "C17": rel_status_rows("s.sid is null", "item_status", True),
    "C18": rel_status("item_id", "parts", "lifecycle", False),
    "C19": rel_status("doc_id", "docs", "lifecycle", False),
    "C20": rel_status_rows("s.sname='Superseded'", "item_lifecycle", False),
    "C21": rel_status_rows("s.sname is null", "item_lifecycle", False),
    "C22": f"select count(*) as parts, coalesce(o.grp,'NULL') as owninggroup from {rel_item('item_id', False)} join {OWNER} o on o.oid=i.puid group by o.grp",
    "C23": f"select count(*) as docs, coalesce(o.grp,'NULL') as owninggroup from {rel_item('doc_id', False)} join {OWNER} o on o.oid=i.puid group by o.grp",
    "C24": f"select count(*) as part_revisions, {YES} as released from {rel_item('item_id', False)} {GIVEN} {WSO} group by 2",
    "C25": f"select count(*) as doc_revisions, {YES} as released from {rel_item('doc_id', False)} {ANYREV} {WSO} group by 2",
    "C26": f"select c.item_id, r.pitem_revision_id, {YES} as released from {rel_item('item_id', False)} {GIVEN} {WSO} where o.pdate_released is null",
    "C27": f"select c.doc_id, r.pitem_revision_id, {YES} as released from {rel_item('doc_id', False)} {ANYREV} {WSO} where o.pdate_released is null",
}

# ------------------------------------------------------------------ bill of material
NUM = lambda c: f"try_cast({c} as decimal(38,10))"


def minor(col, show, kind=None):
    k = f" and c.type='{kind}'" if kind else ""
    return f"with m as (select w.{col} as v from {IDS} c join {DW} w on w.k=c.tc_id group by 1 order by count(*) desc, 1 asc nulls last limit 1) select {show} from {TYPED} c join {DW} w on w.k=c.tc_id where not exists (select 1 from m where m.v=w.{col}){k}"


def notes(kind, name):
    return f"(select n.puid as np, x.pval_0 as {name} from {{ppsoccurrencenotes}} n, {{pnote_types}} t, {{pnotetype}} y, {{pnote_texts}} x where t.puid=n.puid and y.puid=t.pvalu_0 and x.puid=n.puid and x.pseq=t.pseq and y.pname='{kind}')"


SQL |= {
    "D01": counted(B),
    "D02": twice(B, "parent_tc_id, child_tc_id, seq_no, quantity"),
    "D03": counted(B, "count(distinct upper(parent_tc_id))"),
    "D04": counted(B, "count(distinct upper(child_tc_id))"),
    "D05": f"select count(*) as cnt from {IDS}",
    "D06": f"select count(*) as cnt from {IDS} c join {DW} w on w.k=c.tc_id",
    "D07": f"select tc_id from {IDS} c anti join {DW} w on w.k=c.tc_id",
    "D08": f"select c.tc_id from {IDS} c left join {ITEM} i on i.k=c.tc_id left join (select puid from {{ppom_object}} where rowning_siteu is null) o on o.puid=i.puid where o.puid is null",
    "D09": "select distinct upper(b.parent_tc_id) as tc_id, b.parent_revision as rev from {stg_bom} b where not exists (select 1 from {item_all_site_rev} r where upper(r.tc_id)=upper(b.parent_tc_id) and r.rev=b.parent_revision)",
    "D10": rows(B, "*", "parent_tc_id is null or child_tc_id is null"),
    "D11": ids_where("length(tc_id) > 28", "tc_id, length(tc_id) as length"),
    "D12": ids_where("length(tc_id) > 30", "tc_id, length(tc_id) as length"),
    "D13": ids_where(has("tc_id", WS)),
    "D14": ids_where(has("tc_id", TRAIL)),
    "D15": ids_where(has("tc_id", SPECIAL)),
    "D16": ids_where(has("tc_id", r"^\W")),
    "D17": ids_where(has("tc_id", CNTRL), f"tc_id, regexp_replace(tc_id, '{CNTRL}', 'CNTRL', 'g') as tc_id_cntrl"),
    "D18": "select tc_id, altid from (select upper(parent_tc_id) as tc_id, upper(parent_gid_id) as altid from {stg_bom} union select upper(child_tc_id), upper(child_gid_id) from {stg_bom}) c where altid is not null and not exists (select 1 from {altid_all_site} a where upper(a.pitem_id)=c.tc_id and a.pidfr_id=c.altid and a.pidcxt_name in ('JDE','RSOne'))",
    "D19": rows(B, "*", "seq_no is null"),
    "D20": pattern(B, "seq_no", r"\.", "*"),
    "D21": "with u as (select upper(parent_tc_id) as parent_tc_id, seq_no, upper(child_tc_id) as child_tc_id, quantity from {stg_bom}), m as (select parent_tc_id, seq_no, count(distinct child_tc_id) as cnt from u group by 1, 2 having cnt > 1) select distinct u.*, m.cnt from u join m on m.parent_tc_id is not distinct from u.parent_tc_id and m.seq_no is not distinct from u.seq_no",
    "D22": rows(B, "*", f"quantity is null or {NUM('quantity')}=0"),
    "D23": rows(B, "*", f"{NUM('quantity')}<0 or {NUM('quantity')}>1000"),
    "D24": profile(f"{IDS} c join {DW} w on w.k=c.tc_id", "w.pname", "w.local_site, w.pname", "w.local_site, g.business_unit, g.parent_name, w.pname as grp, g.erps"),
    "D25": minor("pname", "w.tc_id, c.type, w.pname as owninggroup, w.local_site", "Assembly"),
    "D26": minor("pname", "w.tc_id, c.type, w.pname as owninggroup, w.local_site", "Component"),
    "D27": f"select w.local_site, count(*) as count from {IDS} c join {DW} w on w.k=c.tc_id group by 1",
    "D28": minor("local_site", "w.tc_id, c.type, w.local_site"),
    "D29": f"select s.sname as status, count(*) as cnt from {IDS} c join {ITEM} i on i.k=c.tc_id left join {STATUS_ANY} s on s.sid=i.puid group by 1",
    "D30": rows(B, "*", "upper(parent_tc_id)=upper(child_tc_id)"),
    "D31": f"select distinct c.parent_tc_id, 'Y' as hasbom from {{stg_bom}} c join {ITEM} i on i.k=upper(c.parent_tc_id) where i.puid in (select r.ritems_tagu from {{ppsoccurrence}} p join {{pstructure_revisions}} q on q.pvalu_0=p.rparent_bvru join {{pitemrevision}} r on r.puid=q.puid join {{pitem}} x on x.puid=p.rchild_itemu)",
    "D32": f"select distinct i.pitem_id as assy, r.pitem_revision_id as rev, x.pitem_id as comp, round(p.pqty_value,4) as qty, p.pseq_no, n1.ref_designator, n2.refdefcomments from (select distinct upper(parent_tc_id) as k, upper(parent_revision) as rv from {{stg_bom}}) c join {ITEM} i on i.k=c.k join {{pitemrevision}} r on r.ritems_tagu=i.puid and upper(r.pitem_revision_id)=c.rv join {{pstructure_revisions}} q on q.puid=r.puid join {{ppsoccurrence}} p on p.rparent_bvru=q.pvalu_0 join {{pitem}} x on x.puid=p.rchild_itemu left join {notes('Reference Designator', 'ref_designator')} n1 on n1.np=p.rnotes_refu left join {notes('Nov4RefDefComments', 'refdefcomments')} n2 on n2.np=p.rnotes_refu",
}

# ------------------------------------------------------------------ supersession
SUP, SUR = "(select upper(sup_id) as k from {stg_supersede})", "(select upper(sur_id) as k from (select distinct sur_id from {stg_supersede}))"


def per_master(src, col, name, cnt="count"):
    return f"select w.{col} as {name}, count(*) as {cnt} from {src} c join {DW} w on w.k=c.k group by 1"


def per_group(src):
    return f"select w.local_site, p.parent, w.pname as owninggroup, count(*) as count from {src} c join {DW} w on w.k=c.k left join {PARENT} p on p.gname=w.pname group by 1, 2, 3"


def unreleased(src):
    return f"select count(*) as count from {src} c join {ITEM} i on i.k=c.k anti join {REL} z on z.ritems_tagu=i.puid"


def per_context(src):
    return f"select a.pidcxt_name, count(*) as cnt from {src} c join {ALT} a on a.k=c.k group by 1"


def defined(src, key, up, view, grp=True):
    k = f"upper(c.{key})" if up else f"c.{key}"
    return f"{{{src}}} c join {LOCAL} i on i.k={k} join {OWNER} g on g.oid=i.puid join {view} z on z.ritems_tagu=i.puid join {docs(grp=True)} e on e.rv=z.puid"


def related(src, key, up, view, only=""):
    k = f"upper(c.{key})" if up else f"c.{key}"
    return f"{{{src}}} c join {LOCAL} i on i.k={k} {only} join {OWNER} g on g.oid=i.puid join {view} z on z.ritems_tagu=i.puid join {parts()} e on e.d=i.puid"


def unmatched(src, key, up):
    k = f"upper(c.{key})" if up else f"c.{key}"
    return f"select c.{key}, c.rdd_id as given_rdd, e.rdd_id as actual_rdd, z.pitem_revision_id as on_max_rev_released from {{{src}}} c join {LOCAL} i on i.k={k} join {REL} z on z.ritems_tagu=i.puid left join {docs()} e on e.rv=z.puid where coalesce(c.rdd_id,'None')<>coalesce(e.rdd_id,'None')"


def unit_side(col, p, name):
    f = forms(PART_FORMS, "prsone_uom", "join")
    return f"(select distinct i.puid as {p}_puid, c.{col} as {name}, m.psymbol as {p}_uom, f.prsone_uom as {p}_rsuom from {{stg_supersede}} c join {LOCAL} i on i.k=upper(c.{col}) join {{pworkspaceobject}} o on o.puid=i.puid join {OWNER} g on g.oid=i.puid left join {{punitofmeasure}} m on m.puid=i.ruom_tagu left join (select * from {f} where prsone_uom is not null) f on f.fo=i.puid)"


TOK = r"regexp_extract_all(replace(ip,'-','_'), '\w+')"
SQL |= {
    "E01": counted(S, name="row_count"),
    "E02": "select count(distinct sup_id) as sup_count, count(distinct sur_id) as sur_count, count(distinct sup_id)+count(distinct sur_id) as total from {stg_supersede}",
    "E03": twice(S, "sup_id", "count"),
    "E04": f"select c.sup_id from {{stg_supersede}} c anti join {DW} w on w.k=upper(c.sup_id)",
    "E05": f"select distinct c.sur_id from {{stg_supersede}} c anti join {DW} w on w.k=upper(c.sur_id)",
    "E06": per_group(SUP),
    "E07": per_group(SUR),
    "E08": per_master(SUP, "item_type", "item_type"),
    "E09": per_master(SUR, "item_type", "item_type"),
    "E10": per_master(SUP, "status", "status"),
    "E11": per_master(SUR, "status", "status"),
    "E12": unreleased(SUP),
    "E13": unreleased(SUR),
    "E14": f"select c.tc_id, c.type, s.survivor_id as superseded_by from (select sup_id as tc_id, 'Superseded' as type from {{stg_supersede}} union select sur_id, 'Survivor' from {{stg_supersede}}) c join {DW} w on w.k=upper(c.tc_id) left join {{chk_superseded_items}} s on s.superseded_puid=w.puid where w.status='Superseded'",
    "E15": per_context(SUP),
    "E16": per_context(SUR),
    "E17": f"with p as (select distinct c.sup_id, a.pidcxt_name as sup_cxt, c.sur_id from {{stg_supersede}} c join {ALT} a on a.k=upper(c.sup_id)), l as (select k, string_agg(pidcxt_name, ',' order by pidcxt_name) as sur_cxt_list, list(pidcxt_name) as cs from {ALT} group by pitem_id, k) select distinct case when not coalesce(list_contains(l.cs, p.sup_cxt), false) then 1 end as is_nomatch, p.sup_id, p.sup_cxt, p.sur_id, l.sur_cxt_list from p left join l on l.k=upper(p.sur_id)",
    "E18": f"with w as (select upper(tc_id) as k, replace(ip,'-','_') as ips, {TOK} as ts from {{item_all_site}}), x as (select distinct c.sup_id, c.sur_id, unnest(a.ts) as sup_ip, b.ips as sur_ip_list, b.ts as bt from {{stg_supersede}} c join w a on a.k=c.sup_id join w b on b.k=c.sur_id) select distinct case when not bool_or(coalesce(list_contains(bt, sup_ip), false)) over (partition by sup_id, sup_ip, sur_id) then 1 end as is_nomatch, sup_id, sup_ip, sur_id, sur_ip_list from x",
    "E19": unmatched(S, "sup_id", True),
    "E20": f"select count(*) as count from {defined(S, 'sup_id', True, REL)}",
    "E21": f"select g.grp, c.sup_id, z.pitem_revision_id as max_rev_released, e.rdd_id, e.rdd_grp from {defined(S, 'sup_id', True, REL)} where g.grp<>e.rdd_grp",
    "E22": f"select g.grp, i.pitem_id as sup_doc_id, z.pitem_revision_id as max_rev_released, e.rel_part_id, e.rel_part_grp from {related(S, 'sup_id', True, REL)} where g.grp<>e.rel_part_grp",
    "E23": f"select a.*, b.* from {{stg_supersede}} c join {unit_side('sup_id', 'sup', 'supersede_legacy')} a on a.supersede_legacy=c.sup_id join {unit_side('sur_id', 'sur', 'survivor_legacy')} b on b.survivor_legacy=c.sur_id where coalesce(sup_uom,'none')<>coalesce(sur_uom,'none') or coalesce(sup_rsuom,'none')<>coalesce(sur_rsuom,'none')",
    "E24": f"select g.grp, c.sup_id, z.pitem_revision_id as max_rev_working, o.pobject_name, o.pobject_desc, s.sname as status, a.pidfr_id as altid, x.pidcxt_name as context, e.rdd_id, e.rdd_grp from {{stg_supersede}} c join {LOCAL} i on i.k=upper(c.sup_id) join {OWNER} g on g.oid=i.puid join {{pworkspaceobject}} o on o.puid=i.puid join {WRK} z on z.ritems_tagu=i.puid left join ({{pidentifier}} a join {{pidcontext}} x on x.puid=a.ridcontextu) on a.raltid_ofu=i.puid left join {docs(grp=True)} e on e.rv=z.puid left join {STATUS_ANY} s on s.sid=i.puid",
}

# ------------------------------------------------------------------ status
GT = "(select tc_id as k from {stg_status})"
GC = "c.tc_id, c.status_new, c.rdd_id"
SQL |= {
    "G01": counted(G, name="row_count"),
    "G02": counted(G, "count(distinct tc_id)", "item_count"),
    "G03": counted(G, "count(distinct rdd_id)", "item_count"),
    "G04": twice(G, "tc_id", "count"),
    "G05": twice(G, "rdd_id, tc_id", "count", "rdd_id is not null"),
    "G06": f"select {GC} from {{stg_status}} c anti join {DW} w on w.k=c.tc_id",
    "G07": f"select {GC} from {{stg_status}} c anti join {DW} w on w.k=c.rdd_id where c.rdd_id is not null",
    "G08": unmatched(G, "tc_id", False),
    "G09": per_group(GT),
    "G10": per_master(GT, "item_type", "item_type"),
    "G11": f"select w.tc_id, w.item_type from {{stg_status}} c join {DW} w on w.k=c.tc_id where w.item_type<>'Nov4Part' and w.item_type<>'Non-Engineering'",
    "G12": per_master(GT, "status", "status"),
    "G13": f"select f.plifecycle, count(*) as cnt from {{stg_status}} c join {LOCAL} i on i.k=c.tc_id left join {REL} z on z.ritems_tagu=i.puid left join {forms(['part_revision_form', 'document_revision_form', 'version_form'], 'plifecycle')} f on f.fo=z.puid group by 1",
    "G14": freq(G, "status_new", "status_new", "count"),
    "G15": f"select {GC}, w.pobject_name, w.pobject_desc, w.status, case when e.a is not null then 'Nov4_Superseded_by' end as reltype from {{stg_status}} c join {DW} w on w.k=c.tc_id left join (select distinct a from {edges('Nov4_Superseded_by')}) e on e.a=w.puid where w.status in ('Superseded','Obsolete') or e.a is not null",
    "G16": f"select {GC} from {{stg_status}} c join {LOCAL} i on i.k=c.tc_id anti join {REL} z on z.ritems_tagu=i.puid where c.status_new='ACTIVE'",
    "G17": f"select {GC} from {{stg_status}} c join {LOCAL} i on i.k=c.tc_id where c.status_new='ACTIVE' and i.puid not in (select a.raltid_ofu from {{pidentifier}} a join {{pidcontext}} x on x.puid=a.ridcontextu)",
    "G18": unmatched(G, "tc_id", False),
    "G19": f"select g.grp as item_grp, i.pitem_id, z.pitem_revision_id as max_rev_released, e.rdd_id, e.rdd_grp from {defined(G, 'tc_id', False, REL)} where g.grp<>e.rdd_grp",
    "G20": f"select g.grp as doc_grp, i.pitem_id as doc_id, z.pitem_revision_id as max_rev_released, e.rel_part_id, e.rel_part_grp from {related(G, 'tc_id', False, REL)} where g.grp<>e.rel_part_grp",
    "G21": f"select distinct {DWBARE}, z.pitem_revision_id as max_rev_working, e.rdd_id, p.rel_part_id as related_part from {{stg_status}} c join {DW} w on w.k=c.tc_id join {LOCAL} i on i.puid=w.puid join {WRK} z on z.ritems_tagu=i.puid left join {docs()} e on e.rv=z.puid left join {parts(grp=False)} p on p.d=i.puid",
}

# ------------------------------------------------------------------ ownership
HT = "(select tc_id as k, grp_new from {stg_owner})"
DIMX = "left join {dim_group_master} d on d.group_name="
UNSTAGED = "not exists (select 1 from {stg_owner} q where q.tc_id=e.rel_part_id) and not exists (select 1 from {stg_owner} q where q.grp_new=e.rel_part_grp)"
SQL |= {
    "H01": counted(H, name="row_count"),
    "H02": counted(H, "count(distinct tc_id)", "item_count"),
    "H03": twice(H, "tc_id", "count"),
    "H04": f"select c.tc_id, c.grp_old, c.grp_new from {{stg_owner}} c anti join {DW} w on w.k=c.tc_id",
    "H05": f"select w.tc_id, c.grp_old as grp_given, g.pname as grp_actual from {{stg_owner}} c join {DW} w on w.k=c.tc_id join {{ppom_group}} g on g.pname=w.pname where {sub('c.grp_old', '^[^.]+')}<>g.pname",
    "H06": f"select w.local_site, p.parent, w.pname as owninggroup, d.erps, count(*) as count from {HT} c join {DW} w on w.k=c.k join {PARENT} p on p.gname=w.pname {DIMX}w.pname group by 1, 2, 3, 4",
    "H07": f"select w.local_site, p.parent, c.grp_new as grp, d.erps, count(*) as count from {HT} c join {DW} w on w.k=c.k join {PARENT} p on p.gname=c.grp_new {DIMX}c.grp_new group by 1, 2, 3, 4",
    "H08": per_master(HT, "item_type", "tc_itemtype"),
    "H09": f"select f.prsone_itemtype, count(*) as count from {HT} c join {ITEM} i on i.k=c.k join {forms(PART_FORMS, 'prsone_itemtype, prsone_uom').replace('f.prsone_itemtype, prsone_uom', 'f.prsone_itemtype')} f on f.fo=i.puid group by 1",
    "H10": f"select c.tc_id, c.grp_old, c.grp_new, {DWCOLS} from {{stg_owner}} c join {DW} w on w.k=c.tc_id where w.status='Superseded'",
    "H11": per_master(HT, "status", "status"),
    "H12": unreleased(HT),
    "H13": f"select a.pidcxt_name as erp_context, count(*) as count from {HT} c left join {ALT} a on a.k=c.k group by 1",
    "H14": f"select count(*) as count from {defined(H, 'tc_id', False, WRK)}",
    "H15": f"select g.grp, c.tc_id, z.pitem_revision_id as max_rev_working, e.rdd_id, e.rdd_grp from {defined(H, 'tc_id', False, WRK)} where g.grp<>e.rdd_grp",
    # In steps that are worked out one by one, smallest first.
    "H16": f"with f as materialized (select * from {docs(grp=True)}), p as materialized (select * from {parts()}), u as materialized (select e.* from p e where {UNSTAGED}), "
    f"g as materialized (select c.tc_id, i.puid, g.grp from {{stg_owner}} c join {LOCAL} i on i.k=c.tc_id join {OWNER} g on g.oid=i.puid), z as materialized (select * from {WRK}), "
    "r as materialized (select g.grp, g.tc_id, z.pitem_revision_id, f.rdd_id, f.rdd_grp, f.dpuid from g join z on z.ritems_tagu=g.puid join f on f.rv=z.puid) "
    "select r.grp, r.tc_id, r.pitem_revision_id as max_rev_working, r.rdd_id, r.rdd_grp, u.rel_part_id as rel_partid, u.rel_part_grp as rel_partgrp from r join u on u.d=r.dpuid where r.grp<>u.rel_part_grp",
    "H17": f"select g.grp, i.pitem_id as doc_id, z.pitem_revision_id as max_rev_working, e.rel_part_id, e.rel_part_grp from {related(H, 'tc_id', False, WRK, 'join {pworkspaceobject} o on o.puid=i.puid and o.pobject_type=' + Q + 'Documents' + Q)} where g.grp<>e.rel_part_grp and {UNSTAGED}",
    "H18": f"select c.tc_id, g.grp as item_grp, u.puser_id as item_usr, s.sname as status, z.pitem_revision_id as max_rev_working, h.grp as rev_grp, o.pdate_released, e.rdd_id, e.rdd_grp from {{stg_owner}} c join {LOCAL} i on i.k=c.tc_id join {OWNER} g on g.oid=i.puid join {{ppom_user}} u on u.puid=g.usr join {WRK} z on z.ritems_tagu=i.puid join {OWNER} h on h.oid=z.puid join {{pworkspaceobject}} o on o.puid=z.puid left join {docs(grp=True)} e on e.rv=z.puid left join {STATUS_ANY} s on s.sid=i.puid",
}

# ------------------------------------------------------------------ name and description
NT = "(select upper(tc_id) as k from {stg_namedesc})"
NL = r"\n|\r\n"
SQL |= {
    "I01": counted(N),
    "I02": "select count(*) as cnt from (select distinct tc_id from {stg_namedesc})",
    "I03": "select count(*) as cnt from (select distinct * from {stg_namedesc})",
    "I04": twice(N, "tc_id", what="count(tc_id)"),
    "I05": f"select c.tc_id, c.name1, c.name2, c.description from {{stg_namedesc}} c anti join {DW} w on w.k=c.tc_id",
    "I06": per_master("(select tc_id as k from {stg_namedesc})", "item_type", "item_type", "cnt"),
    "I07": rows(N, "tc_id, name1", "name1 is null"),
    "I08": long_text(N, "name1", 64, "tc_id, name1"),
    "I09": long_text(N, "name1", 30, "tc_id, name1"),
    "I10": not_ascii(N, "name1", "tc_id"),
    "I11": marked(N, "name1", "CNTRL", "tc_id"),
    "I12": rows(N, "tc_id, name2", "name2 is null"),
    "I13": long_text(N, "name2", 30, "tc_id, name2"),
    "I14": not_ascii(N, "name2", "tc_id"),
    "I15": marked(N, "name2", "CNTRL", "tc_id"),
    "I16": rows(N, "tc_id, description", "description is null"),
    "I17": long_text(N, "description", 240, "tc_id, description"),
    "I18": pattern(N, "description", r"\|", "tc_id, description"),
    "I19": marked(N, "description", "CNTRL", "tc_id", extra=f" and not {has('description', NL)}"),
    "I20": marked(N, "description", "NEWLINE", "tc_id", NL),
    "I21": profile(f"{NT} c join {DW} w on w.k=c.k", "w.pname", "w.local_site, w.pname", "w.local_site, g.business_unit, g.parent_name, w.pname as grp, g.erps"),
    "I22": f"with c as materialized (select c.tc_id, i.puid, i.pitem_id, g.grp from {{stg_namedesc}} c join {LOCAL} i on i.k=c.tc_id join {OWNER} g on g.oid=i.puid), "
    f"a as materialized (select * from {forms(PART_FORMS, 'pname2', 'join')}), b as materialized (select * from {forms(['version_form', 'part_revision_form'], 'pname2', 'join')}), "
    "o as materialized (select puid, pobject_name, pobject_desc, pdate_released from {pworkspaceobject}), r as materialized (select puid, ritems_tagu, pitem_revision_id from {pitemrevision}), "
    "k as materialized (select c.*, r.puid as rv, r.pitem_revision_id from c join r on r.ritems_tagu=c.puid) "
    "select k.grp as item_grp, k.pitem_id, o.pobject_name as item_name, a.pname2 as item_name2, o.pobject_desc as item_desc, k.pitem_revision_id as rev_id, o.pdate_released, q.pobject_name as rev_name, b.pname2 as rev_name2, q.pobject_desc as rev_desc "
    "from k join o on o.puid=k.puid join o q on q.puid=k.rv left join a on a.fo=k.puid left join b on b.fo=k.rv",
}
