"""The queries of the catalog restated in DuckDB SQL."""

from __future__ import annotations

from textveil.functions import dates
from textveil.operators import detect, models
from textveil.operators.tokens import SUBTOKEN
from textveil.plans import catalog

REPORTS = "(select report_row_id as doc, text, status, diagnostic_report_id, per_number, issued_at, modality from radiology_df where text is not null)"


def _q(s: str) -> str:
    return s.replace("'", "''")


def span_sql(src: str, pattern: str, head: str = "", tail: str = "", key: str = "doc", text: str = "text") -> str:
    """Spans of one pattern: (key, i, b, e, covered), by lengths of gaps and matches."""
    h = f"length(regexp_extract(m, '^(?:{_q(head)})'))" if head else "0"
    t = f"length(regexp_extract(m, '(?:{_q(tail)})$'))" if tail else "0"
    return (
        f"(select {key}, i, hi - length(m) + {h} as b, hi - {t} as e, substr(m, {h} + 1, length(m) - {h} - {t}) as covered from ("
        f"select {key}, i, m, sum(length(g) + length(m)) over (partition by {key} order by i) as hi from ("
        f"select {key}, u.i as i, mm[u.i] as m, gg[u.i] as g from (select {key}, regexp_extract_all({text}, '{_q(pattern)}') as mm, regexp_split_to_array({text}, '{_q(pattern)}') as gg from {src} z) y, unnest(range(1, len(mm) + 1)) u(i))))"
    )


def spans(src: str, detectors, key: str = "doc", text: str = "text") -> str:
    """Spans of a set of detectors with seq, class and subclass."""
    parts = [f"select {key}, {k} * 1000000 + i - 1 as seq, b, e, '{d.main_class}' as mc, '{d.sub_class}' as sc, covered from {span_sql(src, d.pattern, d.head, d.tail, key, text)} s{k}" for k, d in enumerate(detectors)]
    return "(" + " union all ".join(parts) + ")"


def folded(found: str, merge: bool = False, src: str = "rules") -> str:
    """The greedy fold of found spans (doc, seq, b, e, mc, sc) as nested list_reduce: (doc, b, e, seq, mc, sc, src)."""
    clash = "list_sort(list_filter(acc, lambda s: s.e > x[1].b and s.b < x[1].e))"
    rest = "list_filter(acc, lambda s: not (s.e > x[1].b and s.b < x[1].e))"
    if merge:
        one = (
            f"case when len({clash}) = 0 then x[1] else struct_pack(b := least(x[1].b, list_min(list_transform({clash}, lambda s: s.b))), e := greatest(x[1].e, list_max(list_transform({clash}, lambda s: s.e))),"
            f" seq := x[1].seq, mc := {clash}[-1].mc, sc := {clash}[-1].sc, src := 'Merge overlapping entities') end"
        )
    else:
        one = f"list_reduce(list_concat([x[1]], {clash}), lambda c, k: case when k.e - k.b > c.e - c.b then k else c end)"
    return (
        f"(select doc, unnest(kept, recursive := true) from (select doc, list_reduce(list_transform(l, lambda y: [y]), lambda acc, x: list_concat({rest}, [{one}])) as kept from ("
        f"select doc, list(struct_pack(b := b, e := e, seq := seq, mc := mc, sc := sc, src := '{src}') order by seq) as l from {found} a group by doc)))"
    )


def resolved(src: str, detectors, merge: bool = False) -> str:
    return folded(spans(src, detectors), merge)


def stitched(src: str, found: str, sub: str) -> str:
    """Texts with each found span replaced by the expression ``sub`` (over mc, sc, covered)."""
    return f"""
    with t as (select doc, text from {src} q), f as (select f.doc, f.b, f.e, f.mc, f.sc, substr(t.text, (f.b + 1)::bigint, (f.e - f.b)::bigint) as covered from {found} f join t on t.doc = f.doc),
    g as (select doc, b, e, {sub} as sub, coalesce(lag(e) over (partition by doc order by b, e), 0) as prev from f),
    h as (select g.doc, string_agg(substr(t.text, (prev + 1)::bigint, (b - prev)::bigint) || sub, '' order by b, e) as body, max(e) as last, count(*) as n from g join t on t.doc = g.doc group by g.doc)
    select t.doc, case when h.doc is null then t.text else h.body || substr(t.text, (h.last + 1)::bigint) end as deid_text, coalesce(h.n, 0)::bigint as n_entities from t left join h on h.doc = t.doc"""


ALL = detect.CONTACTS + detect.RADIOLOGY
_TAG = "'<' || mc || '_' || sc || '>'"
_COVER = "doc, seq::bigint as seq, b::bigint as begin_pos, e::bigint as end_pos, mc as main_class, sc as sub_class, covered"


def _rates(inner: str, name: str = "eval_name", extra: str = "") -> str:
    """Counts to rates; ``inner`` has eval_name, tp, fp, fn."""
    return f"""select {extra}{name}, tp::bigint as tp, fp::bigint as fp, fn::bigint as fn, 0::bigint as tn, (tp + fn)::bigint as total_gt, (tp + fp)::bigint as total_pred, p as precision, r as recall,
      case when p + r = 0 then 0.0::double else round((2 * p * r / (p + r))::double, 4) end as f1 from (
      select *, case when tp + fp = 0 then 0.0::double else round((tp / (tp + fp))::double, 4) end as p, case when tp + fn = 0 then 0.0::double else round((tp / (tp + fn))::double, 4) end as r from ({inner}))"""


def _label(level: int) -> str:
    return "case when mc = 'Other' then 'REDACTED' else mc || '_' || sc end" if level == 2 else "mc"


def _matched(level: int) -> str:
    g, p = (f"(select distinct doc, {_label(level)} as label, b, e from {spans(REPORTS, ds)} a)" for ds in (detect.CONTACTS + detect.RADIOLOGY[:6], detect.RADIOLOGY[:8]))
    return f"(select coalesce(g.doc, p.doc) as doc, coalesce(g.label, p.label) as label, (g.doc is not null)::int as g, (p.doc is not null)::int as p from {g} g full join {p} p on g.doc = p.doc and g.label = p.label and g.b = p.b and g.e = p.e)"


def _counts(src: str) -> str:
    return f"coalesce(sum({src}g * {src}p), 0)::bigint as tp, coalesce(sum((1 - {src}g) * {src}p), 0)::bigint as fp, coalesce(sum({src}g * (1 - {src}p)), 0)::bigint as fn"


def _summary(matched: str) -> str:
    return _rates(f"select case when grouping(label) = 1 then 'strict' else label end as eval_name, {_counts('')} from {matched} m group by rollup(label)")


_MONTHS = "[" + ", ".join(f"'{m}'" for m in dates.MONTHS) + "]"
_SHAPES = ["strftime(o_orderdate, '%d.%m.%Y')", "day(o_orderdate) || '.' || month(o_orderdate) || '.' || year(o_orderdate)", "strftime(o_orderdate, '%Y-%m-%d')", "strftime(o_orderdate, '%d.%m.%y')", "strftime(o_orderdate, '%d.%m.')", f"day(o_orderdate) || '. ' || {_MONTHS}[month(o_orderdate)] || ' ' || year(o_orderdate)", "strftime(o_orderdate, '%m.%Y')", "day(o_orderdate) || '.'", "strftime(o_orderdate, '%d/%m/%Y')", "'kein Datum'"]
DATES = "(select o_orderkey as doc, o_custkey as patient, o_orderdate::date as day, (o_orderkey % 10)::int as k, case o_orderkey % 10 " + " ".join(f"when {i} then {s}" for i, s in enumerate(_SHAPES)) + " end as covered, (o_orderkey % 29 - 14)::int as days, (o_orderkey % 5 - 2)::int as years from orders)"


def _moved(days: str) -> str:
    """The shifted text of DATES by its shape."""
    new = f"(day + {days})"
    short = f"try_strptime(covered || '1900', '%d.%m.%Y')::date + {days}"
    first = f"try_strptime(covered || '01.1900', '%d.%m.%Y')::date + {days}"
    return f"""case k when 0 then strftime({new}, '%d.%m.%Y') when 1 then strftime({new}, '%d.%m.%Y') when 2 then strftime({new}, '%Y-%m-%d') when 3 then strftime({new}, '%d.%m.%y')
      when 4 then strftime({short}, '%d.%m.') when 5 then strftime({new}, '%d') || '. ' || {_MONTHS}[month({new})] || ' ' || year({new}) when 6 then covered when 7 then strftime({first}, '%d.') when 8 then strftime({new}, '%d/%m/%Y') end"""


def _birthdate() -> str:
    """DATES with the year replaced, then moved, by shape."""
    at = lambda base, form: f"strftime(case when ({base}) is not null then try_strptime(lpad((year({base}) + years)::varchar, 4, '0') || strftime({base}, '-%m-%d'), '%Y-%m-%d')::date + days end, '{form}')"
    short = "try_strptime(covered || '1900', '%d.%m.%Y')::date"
    first = "try_strptime(covered || '01.1900', '%d.%m.%Y')::date"
    # a month and year without separators between three numbers is read as day, month and year: 12.1995 as the first of February
    odd = "case when month(day) > 10 then make_date(year(day), month(day) - 10, 1) end"
    named = f"(case when try_strptime((year(day) + years) || strftime(day, '-%m-%d'), '%Y-%m-%d') is not null then try_strptime((year(day) + years) || strftime(day, '-%m-%d'), '%Y-%m-%d')::date + days end)"
    return f"""case k when 0 then {at('day', '%d.%m.%Y')} when 1 then {at('day', '%d.%m.%Y')} when 2 then {at('day', '%Y-%m-%d')} when 3 then {at('day', '%d.%m.%y')} when 4 then {at(short, '%d.%m.')}
      when 5 then strftime({named}, '%d') || '. ' || {_MONTHS}[month({named})] || ' ' || year({named}) when 6 then {at(odd, '%d%m.%Y')} when 7 then {at(first, '%d.')} when 8 then {at('day', '%d/%m/%Y')} end"""


def _hash(x: str) -> str:
    return f"('0x' || substr(md5({x}::varchar), 1, 8))::bigint"


def _offset_days(x: str) -> str:
    return f"(case when {_hash(x)} % 28 - 14 >= 0 then {_hash(x)} % 28 - 13 else {_hash(x)} % 28 - 14 end)::int"


NOTES = """(select o_orderkey as doc, o_custkey as patient, 'Institut für Pathologie' || chr(10) || 'Eingang ' || strftime(o_orderdate, '%d.%m.%Y') || chr(10) || 'Befundbericht' || chr(10) || 'Frau ' || c_name || ' aus ' || n_name || ', ' || (o_orderkey % 90) ||
  ' Jahre, Gewicht: ' || (o_orderkey % 60 + 40) || ' kg, MELANO-' || (o_orderkey % 9) || ' Studie läuft. Ima ' || (o_orderkey % 7) || '/' || (o_orderkey % 12) || ' Frau Dr Meier.' || chr(10) || 'Kein Anhalt für Malignität. ' || chr(10) || 'Prof. Dr. Vogt' || chr(10) as text
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""

_WORDS = "(select doc, u.i - 1 as pos, mm[u.i] as token, sum(length(gg[u.i]) + length(mm[u.i])) over (partition by doc order by u.i) as e from (select doc, regexp_extract_all(text, '\\S+') as mm, regexp_split_to_array(text, '\\S+') as gg from " + REPORTS + " r) z, unnest(range(1, len(mm) + 1)) u(i))"
_PIECES = "(select vec_id // 64 as doc, vec_id // 4 as word, vec_id, [list_max([abs(embedding[i])::double for i in range(1, len(embedding) + 1) if (i - 1) % 5 = c]) for c in range(0, 5)] as s from embeddings)"
_NAMES = "['O', 'B-Date', 'I-Date', 'B-Name', 'I-Name']"


def _word(strategy: str) -> str:
    """(doc, word, idx, score) of a strategy, by flat rows of (word, piece, class, score)."""
    flat = f"(select doc, word, vec_id, u.c as c, s[u.c + 1] as v, list_position(s, list_max(s)) - 1 as own from {_PIECES} p, unnest(range(0, 5)) u(c))"
    if strategy == "first":
        return f"(select doc, word, arg_min(own, vec_id) as idx, arg_min(m, vec_id) as score from (select doc, word, vec_id, list_position(s, list_max(s)) - 1 as own, list_max(s) as m from {_PIECES} p) group by doc, word)"
    best = f"select doc, word, c as idx, v as score from (select *, row_number() over (partition by doc, word order by v desc, vec_id, c) as rn from {flat} f"
    if strategy == "max":
        return f"({best}) where rn = 1)"
    none = f"select doc, word, 0 as idx, avg(v) as score from {flat} f where c = 0 group by doc, word having max(own) = 0"
    return f"({best} where own > 0) where rn = 1 union all {none})"


def _entities(strategy: str) -> str:
    t = f"(select doc, word as pos, {_NAMES}[(idx + 1)::int] as tag, score from {_word(strategy)} w)"
    t = f"(select *, regexp_replace(tag, '^[BI]-', '') as name from {t} t)"
    t = f"(select *, case when tag not like 'B-%' and name = lag(name) over (partition by doc order by pos) then 0 else 1 end as brk from {t} t)"
    t = f"(select *, sum(brk) over (partition by doc order by pos) as g from {t} t)"
    return f"(select doc, g, any_value(name) as label, min(pos) as b, max(pos) as e, avg(score) as score, count(*) as n from {t} t where tag <> 'O' group by doc, g)"


_SUP = spans(REPORTS, detect.RADIOLOGY)
_SUB = spans(REPORTS, detect.CONTACTS + detect.RADIOLOGY[1:4])
_TOUCH = "((a.b <= b.b and b.b < a.e) or (a.b <= b.e - 1 and b.e - 1 <= a.e) or (b.b <= a.b and a.b < b.e) or (b.b <= a.e - 1 and a.e - 1 <= b.e))"
_MATCH = f"(select coalesce(a.doc, b.doc) as doc, a.seq as sa, b.seq as sb, a.b as ab, a.e as ae, a.mc as am, b.b as bb, b.e as be, b.mc as bm, b.sc as bs from {_SUP} a full join {_SUB} b on a.doc = b.doc and {_TOUCH})"


def _case(policy: dict[str, dict[str, str]]) -> str:
    arms = []
    for c, subs in policy.items():
        for s, m in subs.items():
            to = {"redact": "repeat('X', length(covered))", "keep": "covered"}.get(m, _TAG)
            arms.append(f"when upper(mc) = '{c}' and sc = '{s}' then {to}")
    return f"case {' '.join(arms)} else {_TAG} end" if arms else _TAG


def _rewritten(sub: str, detectors=detect.RADIOLOGY, merge: bool = False) -> str:
    return stitched(REPORTS, resolved(REPORTS, detectors, merge), sub)


def _every(method: str) -> dict:
    return {"DATE": {"DATE": method}, "CONTACT": {"PHONE": method}, "ID": {"PATIENTID": method, "STUDYID": method}, "NAME": {"STAFF": method}}


def oracle_sql() -> dict[str, str]:
    docs = "(select doc_id as doc, text from documents where text is not null)"
    radio_hist = spans(REPORTS, ALL)
    study = span_sql(NOTES, detect.STUDY.pattern, "", detect.STUDY.tail)
    skip = ", ".join(f"'{x}'" for x in models.SKIP_STUDIES)
    lh_spans = spans(NOTES, detect.RADIOLOGY[:2] + (detect.POSTPROCESS[0],))
    patient = f"(select s.*, r.per_number from {spans(REPORTS, detect.RADIOLOGY)} s join {REPORTS} r on r.doc = s.doc where r.per_number is not null)"
    by_doc = f"select doc, case when grouping(label) = 1 then 'strict' else label end as eval_name, {_counts('')} from {_matched(1)} m group by grouping sets ((doc, label), (doc))"
    eval_doc = _rates(f"{by_doc} union all select doc, 'strict', 0, 0, 0 from {REPORTS} r where doc not in (select doc from {_matched(1)} m)", extra="doc, ")
    split = "select distinct patient_id from split_document where patient_id is not null"
    sampled = f"(select patient_id from ({split}) order by {_hash('patient_id')}, patient_id limit (select ceil(80 * count(*) / 100)::bigint from ({split})))"
    seq = f"(select coalesce(g.label, p.label) as label, (g.doc is not null)::int as g, (p.doc is not null)::int as p from {_entities('max')} g full join {_entities('first')} p on g.doc = p.doc and g.label = p.label and g.b = p.b and g.e = p.e)"
    metric = "(select doc, modality, length(text) as characters, regexp_extract_all(text, '[^\\s]+') as w, len(regexp_extract_all(text, '[.!?]+(?:\\s|$)')) as ends from " + REPORTS + " r)"
    per_doc = f"(select doc, modality, len(w)::bigint as tokens, case when len(w) > 0 then greatest(ends, 1) else 0 end::bigint as sentences, characters::bigint as characters, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars from {metric} m)"
    cos_docs = "(select item_id as doc, text from benchmark union all select s_suppkey + 1000000, str_split(s_name, '0')[-1] || chr(10) || 'nation ' || s_nationkey || chr(10) || 'bal ' || trunc(s_acctbal / 1000)::int from supplier)"
    terms = f"(select doc, term, count(*) as tf from (select doc, unnest(regexp_split_to_array(lower(text), '[\\n\\r]+')) as term from {cos_docs} c) where term <> '' group by all)"
    norm = f"(select doc, sqrt(sum(tf * tf)) as n from {terms} t group by doc)"
    out = {
        "deidentify_documents": _rewritten(_TAG, ALL),
        "deidentify_merge": _rewritten(_case({"DATE": {"DATE": "redact"}}), merge=True),
        "detect_contacts": f"select {_COVER} from {spans(REPORTS, detect.CONTACTS)}",
        "detect_radiology_rules": f"select {_COVER} from {spans(REPORTS, detect.RADIOLOGY)}",
        "detect_postprocess_rules": f"select {_COVER} from {spans(docs, detect.POSTPROCESS + detect.MISSING)}",
        "detect_measures": f"select doc, b::bigint as begin_pos, e::bigint as end_pos, sc as sub_class, covered from {spans(NOTES, detect.MEASURES)}",
        "resolve_longest": f"select doc, b::bigint as begin_pos, e::bigint as end_pos, mc as main_class, sc as sub_class from {resolved(REPORTS, ALL)}",
        "resolve_merge": f"select doc, b::bigint as begin_pos, e::bigint as end_pos, mc as main_class, sc as sub_class from {resolved(REPORTS, ALL, True)}",
        "match_models_outer": f"select doc, sa::bigint as sup_seq, sb::bigint as sub_seq from {_MATCH}",
        "merge_models": f"""select doc, least(ab, bb)::bigint as begin_pos, greatest(ae, be)::bigint as end_pos, case when am = bm then am when sb is null then am else 'Other' end as main_class,
            case when am = bm then bs else '' end as sub_class, case when am = bm or sb is null then 1.0 else 0.0 end::double as score,
            case when am = bm then 'both-models-agree' when sb is null then 'supermodel-vs-submodel' else 'submodel-vs-supermodel' end as source from {_MATCH}""",
        "redact": _rewritten(_case(_every("redact"))),
        "keep_all": _rewritten("covered"),
        "replace_tags": _rewritten("'<' || mc || '>'"),
        "show_original": _rewritten("'<' || mc || '_' || sc || ':' || covered || '>'"),
        "policy_lookup": f"select mc as main_class, sc as sub_class, case when mc = 'Date' and sc = 'DATE' then 'redact' when mc = 'Contact' and sc = 'PHONE' then 'keep' when mc = 'Name' and sc = 'STAFF' then 'redact' else 'replace' end as method, count(*) as n from {spans(REPORTS, detect.RADIOLOGY)} group by all",
        "infer_date_format": f"select case k when 0 then 'dmy' when 1 then 'dmy' when 2 then 'ymd' when 3 then 'dmy2' when 4 then 'dm' when 5 then 'dB' when 6 then case when true then 'dmy' end when 7 then 'd' when 8 then 'dmy' end as format, k = 6 as stays, count(*) as n from {DATES} group by all",
        "shift_dates": f"select doc, covered, {_moved('days')} as shifted from {DATES}",
        "shift_birthdates": f"select doc, covered, {_birthdate()} as shifted from {DATES}",
        "shift_ages": f"select doc, age, case when years = 0 then age when age like '%Jahre' then null else (try_cast(age as int) + years)::varchar end as shifted from (select *, case when doc % 7 = 0 then (doc % 90) || ' Jahre' else (doc % 90)::varchar end as age from {DATES})",
        "offset_draw": f"select c_custkey as patient, {_offset_days('c_custkey')}::bigint as days, [-2, -1, 1, 2][({_hash(chr(39) + 'y' + chr(39) + ' || c_custkey')} % 4 + 1)::int]::bigint as years from customer",
        "offset_lookup": f"select doc, case when patient % 3 = 0 then '<Date_DATE>' else coalesce({_moved(_offset_days('patient'))}, '<Date_WRONG>') end as shifted from {DATES} where patient in (select c_custkey from customer)",
        "study_names": f"""select s.doc, b::bigint as begin_pos, e::bigint as end_pos, (case when skip then null when wide then greatest(b - length(before) - 1, 0) else b end)::bigint as fixed_begin, (case when skip then null when nxt = '-' then e - 1 else e end)::bigint as fixed_end from (
            select *, covered in ({skip}) or (wide and before in ({skip})) as skip from (select s.*, regexp_full_match(covered, '[0-9]+') or covered = 'Lung' as wide, regexp_extract(substr(n.text, 1, (b - 1)::bigint), '(\\S*)$', 1) as before, substr(n.text, (e + 1)::bigint, 1) as nxt from {study} s join {NOTES} n on n.doc = s.doc)) s""",
        "extend_titles": f"""select doc, covered, b::bigint as begin_pos, (case when ext <> '' then b - length(ext) else b end)::bigint as new_begin, img as dropped from (
            select s.doc, covered, b, regexp_extract(substr(n.text, greatest(b - 10, 0)::bigint + 1, (b - greatest(b - 10, 0))::bigint), '(?i)(?:Ehefrau|Ehemann|Herrn|Herr|Frau|Dr|Prog)\\s$') as ext,
            regexp_matches(substr(n.text, greatest(b - 6, 0)::bigint + 1, (e - greatest(b - 6, 0))::bigint), '(?i)ima.*?[0-9]+/[0-9]+') as img from {span_sql(NOTES, 'Customer#[0-9]+|Meier')} s join {NOTES} n on n.doc = s.doc)""",
        "cut_letterhead": f"""with n as (select doc, text, instr(text, 'Befundbericht' || chr(10)) - 1 as h, instr(text, 'Malignität.') + 10 as t from {NOTES} n), a as (select s.doc, s.b from {lh_spans} s join n on n.doc = s.doc where s.b > n.h and s.e < n.t)
            select n.doc, substr(text, h + 1, t - h) as text, coalesce(c, 0)::bigint as n_kept, (f - h)::bigint as first_begin from n left join (select doc, count(*) as c, min(b) as f from a group by doc) x on x.doc = n.doc""",
        "strict_eval_summary": _summary(_matched(2)),
        "strict_eval_only_type": _summary(_matched(1)),
        "strict_eval_document": eval_doc,
        "blindness_labels": f"select lv::bigint as level, case lv when 2 then mc || '_' || sc when 1 then mc else 'REDACTED' end as label, count(*) as n from {radio_hist} s, unnest([0, 1, 2]) u(lv) group by all",
        "boxplot_stats": f"select case when eval_name = 'strict' then 'all' else 'class' end as method, count(f1) as n, min(f1) as low, quantile_cont(f1, 0.25) as q1, quantile_cont(f1, 0.5) as median, quantile_cont(f1, 0.75) as q3, max(f1) as high, avg(f1) as mean from ({eval_doc}) where total_gt > 0 group by all",
        "tokenize": f"select doc, pos::bigint as pos, (e - length(token))::bigint as begin_pos, e::bigint as end_pos, token from {_WORDS}",
        "chunk_ranges": f"select doc, p::bigint as part, greatest(p * 50 - 10, 0)::bigint as first, least((p + 1) * 50 + 10, n - 1)::bigint as last from (select doc, len(regexp_extract_all(text, '[^\\s]+')) as n from {REPORTS} r), unnest(range(0, ceil(n / 50)::bigint)) u(p)",
        "chunk_rows": f"""with w as (select *, e - length(token) as b from {_WORDS}), n as (select doc, count(*) as n from w group by doc), r as (select doc, n, p, greatest(p * 50 - 10, 0) as f, least((p + 1) * 50 + 10, n - 1) as l from n, unnest(range(0, ceil(n / 50)::bigint)) u(p))
            select r.doc, ceil(n / 50)::bigint as num_parts, p::bigint as part_id, w1.b::bigint as part_start, w2.e::bigint as part_end, substr(t.text, (w1.b + 1)::bigint, (w2.e - w1.b)::bigint) as text, (l - f + 1)::bigint as n_tokens from r join w w1 on w1.doc = r.doc and w1.pos = f join w w2 on w2.doc = r.doc and w2.pos = l join {REPORTS} t on t.doc = r.doc""",
        "dedup_keep_first": "select diagnostic_report_id, min(report_row_id) as report_row_id from radiology_df where status = 'final' group by 1",
        "limit_annotated": "select report_row_id, length(text) as n_chars from radiology_df where status = 'final' and length(text) >= 1000 order by report_row_id limit 100",
        "label_histogram": f"select mc as main_class, sc as sub_class, count(*) as n from {radio_hist} group by all",
        "patients_per_label": f"select per_number, count(*) as n from {patient} where mc = 'Date' and sc = 'DATE' group by 1",
        "split_patients": f"select patient_id from {sampled}",
        "split_manifest": f"select split_id, document_type, patient_id, document_id, case when patient_id in (select patient_id from {sampled}) then 'train' else 'test' end as phase from split_document where patient_id is not null",
        "leak_flag": "with s as (select split_id, patient_id, case when lower(trim(phase, ' \t\r\n')) in ('train', 'training') then 'train' when lower(trim(phase, ' \t\r\n')) in ('validation', 'val', 'valid', 'dev', 'test', 'testing') then 'test' end as side from split_document) select split_id, patient_id, side, coalesce(patient_id in (select patient_id from s where side = 'train' intersect select patient_id from s where side = 'test'), false) as leaks from s where side is not null",
        "patient_enrichment": "select s.split_id, s.patient_id, p.identifier_0_value as per_number from split_document s left join (select * from patient_lookup where identifier_0_value is not null) p on p.id = s.patient_id",
        **{f"word_aggregate_{s}": f"select doc, word, idx::bigint as idx, score::double as score from {_word(s)}" for s in ("first", "max", "any_max")},
        "group_entities": f"select doc, label, (b * 10)::bigint as begin_pos, (e * 10 + 8)::bigint as end_pos, round(score::double, 6) as score, n as n_words from {_entities('max')}",
        "seqeval_scores": _summary(seq),
        "document_metrics": f"select doc, tokens, sentences, characters, word_chars, case when tokens > 0 then word_chars / tokens else 0.0 end::double as mean_word_length, case when sentences > 0 then tokens / sentences else 0.0 end::double as mean_sentence_length from {per_doc}",
        "corpus_metrics": f"select modality, sum(tokens)::bigint as tokens, sum(sentences)::bigint as sentences, sum(characters)::bigint as characters, sum(word_chars) / sum(tokens) as mean_word_length, sum(case when sentences > 0 then tokens else 0 end) / sum(sentences) as mean_sentence_length from {per_doc} group by 1",
        "line_cosine_pairs": f"select a, b, round(d / (na.n * nb.n), 6) as cosine from (select x.doc as a, y.doc as b, sum(x.tf * y.tf) as d from {terms} x join {terms} y on x.term = y.term and x.doc < y.doc group by all) p join {norm} na on na.doc = a join {norm} nb on nb.doc = b where d / (na.n * nb.n) > 0.3",
        "bundle_rewrite": "select resource_row_id, id, deid_text as valuestring from resource r left join (" + stitched("(select resource_row_id as doc, valuestring as text from resource where valuestring is not null)", resolved("(select resource_row_id as doc, valuestring as text from resource where valuestring is not null)", detect.CONTACTS), _TAG) + ") x on x.doc = r.resource_row_id",
        "subtokens_bio": f"select doc, count(*) as n, sum(b)::bigint as sum_begin, max(e)::bigint as last_end from {span_sql(REPORTS, _sub_pattern())} group by doc",
    }
    from textveil.plans import composed, files

    out.update({**composed.oracle_sql(), **files.oracle_sql(), "leaks_round_trip": out["leak_flag"]})
    return {k: v for k, v in out.items() if k in catalog.queries()}


def _sub_pattern() -> str:
    assert SUBTOKEN
    return r"[\p{L}\p{N}\p{M}\p{Pc}]+|[^\s\p{L}\p{N}\p{M}\p{Pc}]+"
