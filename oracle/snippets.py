"""Building blocks of the DuckDB statements that the Spark results are compared with.

``{name}`` marks a sample view or base table; ``standalone_sql`` turns a statement into one that
DuckDB runs on the bare tables.
"""

WS = r"\s"
TRAIL = r"\s+:.*$|\s+$|:\s+.*$"
INVALID = r"[\]\[~`!@#$%^&*=+}{|<>;?,]"
QUESTION = r'[\\/")(]'
SPECIAL = r"""[*&~'';,%+#"\\/$@`?)(^!]"""
CNTRL = "[[:cntrl:]]"
EIGHT3 = r"^\d{8}-\d{3}$"


def has(col, pattern):
    return f"regexp_matches({col}, '{pattern}')"


def rows(src, show, where, distinct=False):
    return f"select {'distinct ' if distinct else ''}{show} from {{{src}}} where {where}"


def pattern(src, col, p, show=None, negate=False, distinct=False):
    test = has(col, p)
    return rows(src, show or col, f"not {test}" if negate else test, distinct)


def long_text(src, col, n, show=None):
    return rows(src, f"{show or col}, length({col}) as length", f"length({col}) > {n}")


def ascii_text(col):
    """UTF-16 escapes of non-ASCII characters and backslashes, character by character."""
    unit = lambda e: f"chr(92) || lpad(upper(to_hex(({e})::bigint)), 4, '0')"
    high, low = unit("55296 + (unicode(ch) - 65536) // 1024"), unit("56320 + (unicode(ch) - 65536) % 1024")
    one = (
        "case when unicode(ch) < 128 and unicode(ch) <> 92 then ch "
        f"when unicode(ch) < 65536 then {unit('unicode(ch)')} else {high} || {low} end"
    )
    return f"array_to_string(list_transform(regexp_extract_all({col}, '(?s).'), lambda ch: {one}), '')"


def not_ascii(src, col, key):
    a = ascii_text(col)
    return f"select {key}, {col}, {a} as {col}_ascii from {{{src}}} where {col} <> {a}"


def marked(src, col, mark, key=None, p=CNTRL, extra="", name=None):
    show = f"{key}, {col}" if key else col
    return f"select {show}, regexp_replace({col}, '{p}', '{mark}', 'g') as {name or col + '_marked'} from {{{src}}} where {has(col, p)}{extra}"


def counted(src, what="count(*)", name="cnt", where="true"):
    return f"select {what} as {name} from {{{src}}} where {where}"


def freq(src, expr, name, count="cnt", where="true", label=None):
    shown = f"coalesce(v, '{label}')" if label else "v"
    return f"select {shown} as {name}, n as {count} from (select {expr} as v, count(*) as n from {{{src}}} where {where} group by 1)"


def decades(src, col):
    return f"select v || '0s' as decade, n as count from (select coalesce(substr(cast(year({col}) as varchar),1,3),'') as v, count(*) as n from {{{src}}} group by 1)"


def sub(col, p):
    """First match or NULL."""
    return f"nullif(regexp_extract({col}, '{p}'), '')"


def twice(src, key, count="cnt", where="true", distinct=False, cols="*", what="count(*)"):
    return f"select {'distinct ' if distinct else ''}* from (select {cols}, {what} over (partition by {key}) as {count} from {{{src}}} where {where}) where {count} > 1"


def words(col):
    return f"upper(nullif(regexp_replace({col}, '\\W', '', 'g'), ''))"


def cat(*parts):
    return "nullif(" + " || ".join(f"coalesce({p},'')" for p in parts) + ",'')"


LOCAL = "(select i.puid, i.pitem_id, i.ruom_tagu, upper(i.pitem_id) as k from {pitem} i semi join (select puid from {ppom_object} where rowning_siteu is null) o on o.puid=i.puid)"
ITEM = "(select i.puid, i.pitem_id, i.ruom_tagu, upper(i.pitem_id) as k from {pitem} i)"
DW = "(select w.*, upper(w.tc_id) as k from {item_all_site} w)"
OWNER = "(select a.puid as oid, g.pname as grp, a.rowning_useru as usr from {ppom_application_object} a join {ppom_group} g on g.puid=a.rowning_groupu)"
STATUS = "(select l.puid as sid, s.pname as sname from {prelease_status_list} l join {preleasestatus} s on s.puid=l.pvalu_0)"
STATUS_ANY = "(select l.puid as sid, s.pname as sname from {prelease_status_list} l left join {preleasestatus} s on s.puid=l.pvalu_0)"
PARENT = "(select g.pname as gname, u.pname as parent from {ppom_group} g left join {ppom_group} u on u.puid=g.rparentu)"
ALT = "(select upper(pitem_id) as k, pidcxt_name, pidfr_id, pitem_id, item_group, local_site from {altid_all_site})"


def edges(kind):
    return f"(select e.rprimary_objectu as a, e.rsecondary_objectu as b from {{pimanrelation}} e, {{pimantype}} t where t.puid=e.rrelation_typeu and t.ptype_name='{kind}')"


def docs(kind="RelatedDefiningDocument", grp=False):
    if grp:
        return f"(select e.a as rv, e.b as dpuid, i.pitem_id as rdd_id, o.grp as rdd_grp from {edges(kind)} e, {{pitem}} i, {OWNER} o where i.puid=e.b and o.oid=e.b)"
    return f"(select e.a as rv, e.b as dpuid, i.pitem_id as rdd_id from {edges(kind)} e, {{pitem}} i where i.puid=e.b)"


def parts(kind="RelatedDefiningDocument", grp=True):
    g = ", o.grp as rel_part_grp" if grp else ""
    w = " and o.oid=i.puid" if grp else ""
    f = f", {OWNER} o" if grp else ""
    return f"(select distinct e.b as d, i.pitem_id as rel_part_id{g} from {edges(kind)} e, {{pitemrevision}} r, {{pitem}} i{f} where r.puid=e.a and i.puid=r.ritems_tagu{w})"


def forms(tables, col, how="left join"):
    union = " union ".join(f"select puid, {col} from {{{t}}}" for t in tables)
    return f"(select e.a as fo, f.{col} from {edges('IMAN_master_form')} e join {{pform}} p on p.puid=e.b {how} ({union}) f on f.puid=p.rdata_fileu)"


PART_FORMS = ["part_form", "nonengineering_form"]
