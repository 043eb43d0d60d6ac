"""Queries over composed pipelines, labels, scores and rewriting, each with its SQL restatement."""

from __future__ import annotations

from pyspark.sql import functions as F

from textveil.functions import dates
from textveil.functions.spans import fold_longest, spread
from textveil.functions.texts import decode_base64
from textveil.operators import corpus, detect, evaluate, models, rewrite, scores, tokens
from textveil.plans import catalog, oracles
from textveil.plans.catalog import _out, query, reports, table
from textveil.plans.oracles import ALL, DATES, NOTES, REPORTS, folded, span_sql, spans, stitched

SQL: dict[str, str] = {}


# --- SQL of shared parts ----------------------------------------------------------
_SKIP = ", ".join(f"'{x}'" for x in models.SKIP_STUDIES)


def cleaned(src: str, detectors) -> str:
    """Spans as the radiology set is applied: (doc, seq, b, e, mc, sc, covered)."""
    raw = f"(select s.*, t.text from {spans(src, detectors)} s join {src} t on t.doc = s.doc)"
    trimmed = f"(select doc, seq, mc, sc, text, case when covered ~ '.*[^ ].*' or regexp_matches(covered, '[^ ]') then b + length(covered) - length(ltrim(covered, ' ')) else b end as b, case when regexp_matches(covered, '[^ ]') then e - length(covered) + length(rtrim(covered, ' ')) else b end as e from {raw} r)"
    cov = f"(select *, substr(text, (b + 1)::bigint, (e - b)::bigint) as covered from {trimmed} t)"
    wide = f"(select *, regexp_full_match(covered, '[0-9]+') or covered = 'Lung' as wide, regexp_extract(substr(text, 1, (b - 1)::bigint), '(\\S*)$', 1) as before, substr(text, (e + 1)::bigint, 1) as nxt from {cov} c where sc = 'STUDYID')"
    study = f"select doc, seq * 1000000 as seq, case when wide then greatest(b - length(before) - 1, 0) else b end as b, case when nxt = '-' then e - 1 else e end as e, mc, sc, text from {wide} w where not (covered in ({_SKIP}) or (wide and before in ({_SKIP})))"
    staff_src = f"(select doc, seq, mc, sc, text as whole, b as sb, covered as text from {cov} c where sc = 'STAFF')"
    staff = f"select doc, seq * 1000000 + i - 1 as seq, sb + b as b, sb + e as e, mc, sc, whole as text from {span_sql(staff_src, '[A-ZÖÄÜ][.]\\s[A-ZÖÄÜ][a-zöäüß]+', key='doc, seq, mc, sc, sb, whole')} x"
    rest = f"select doc, seq * 1000000 as seq, b, e, mc, sc, text from {cov} c where sc not in ('STAFF', 'STUDYID')"
    return f"(select doc, seq, b, e, mc, sc, substr(text, (b + 1)::bigint, (e - b)::bigint) as covered from ({study} union all {staff} union all {rest}))"


def labelled(src: str, found: str) -> str:
    """Tokens with labels: (doc, b, e, token, label, name, pos)."""
    f = f"(select *, coalesce(lag(e) over (partition by doc order by b, e), 0) as prev, max(e) over (partition by doc) as last from {found} f)"
    parts = (
        f"(select f.doc, f.prev as sb, null as name, substr(t.text, (f.prev + 1)::bigint, (f.b - f.prev)::bigint) as text from {f} f join {src} t on t.doc = f.doc"
        f" union all select f.doc, f.b, f.mc || '_' || f.sc, substr(t.text, (f.b + 1)::bigint, (f.e - f.b)::bigint) from {f} f join {src} t on t.doc = f.doc"
        f" union all select t.doc, coalesce(m.last, 0), null, substr(t.text, (coalesce(m.last, 0) + 1)::bigint) from {src} t left join (select doc, max(e) as last from {found} f group by doc) m on m.doc = t.doc)"
    )
    rows = span_sql(parts, "\\S+", key="doc, sb, name")
    return f"(select doc, sb + b as b, sb + e as e, covered as token, name, case when name is null then 'O' when i = 1 then 'B-' || name else 'I-' || name end as label, row_number() over (partition by doc order by sb + b) - 1 as pos from {rows} x)"


_RESOLVED = oracles.resolved(REPORTS, ALL)
_LABELLED = labelled(REPORTS, _RESOLVED)
_SUB = r"[\p{L}\p{N}\p{M}\p{Pc}]+|[^\s\p{L}\p{N}\p{M}\p{Pc}]+"
_CLEAN = cleaned(REPORTS, detect.RADIOLOGY)
_TAG = oracles._TAG


def _annotated(spark, d, keep=()):
    return rewrite.annotate(reports(spark, d).select("doc", "text", *keep), "text", detect.CONTACTS + detect.RADIOLOGY)


# --- detection as it is composed -----------------------------------------------------
SQL["detect_radiology"] = f"select {oracles._COVER} from {_CLEAN}"


@query
def radiology_annotations(spark, d):
    """The radiology set inserted in merge mode, with its source."""
    df = rewrite.annotate(reports(spark, d).select("doc", "text"), "text", detect.RADIOLOGY, merge=True, clean=True, source="radio-regex")
    return _out(spread(df, "spans", "doc").select("doc", "s.begin", "s.end", "s.main_class", "s.sub_class", "s.source"))


SQL["radiology_annotations"] = f"select doc, b::bigint as begin_pos, e::bigint as end_pos, mc as main_class, sc as sub_class, src as source from {folded(_CLEAN, True, 'radio-regex')}"


@query
def deidentify_radiology(spark, d):
    """Reports rewritten from the radiology set as it is applied."""
    return rewrite.deidentify(reports(spark, d), "doc", "text", detect.RADIOLOGY, {}, merge=True, clean=True)


SQL["deidentify_radiology"] = stitched(REPORTS, folded(_CLEAN, True), _TAG)

SHIFT = {"DATE": {"DATE": "shift", "BIRTHDATE": "replace"}, "AGE": {"AGE": "shift"}, "CONTACT": {"PHONE": "redact"}}


@query
def deidentify_shifted(spark, d):
    """Dates moved by the patient's offset (none without a patient), probable birth
    dates tagged, ages moved by the patient's years."""
    r = reports(spark, d).select("doc", "text", catalog.offset_days(F.col("per_number")).alias("days"), catalog.offset_years(F.col("per_number")).alias("years"))
    return rewrite.deidentify(r, "doc", "text", detect.RADIOLOGY + detect.POSTPROCESS[:2], SHIFT, days=F.col("days"), years=F.col("years"))


def _shifted(c: str, days: str) -> str:
    """A covered date of the radiology set, moved."""
    guard = lambda day, form: f"coalesce(case when year({day}) > 1901 and year({day}) < 2007 then '<Date_BIRTHDATE>' else strftime({day}, '{form}') end, '<Date_WRONG>')"
    full = f"(try_strptime({c}, '%d.%m.%Y')::date + {days})"
    two = f"(try_strptime({c}[1:6] || (case when {c}[7:8] >= '69' then '19' else '20' end) || {c}[7:8], '%d.%m.%Y')::date + {days})"
    short = f"(try_strptime({c} || '1900', '%d.%m.%Y')::date + {days})"
    return f"""case when regexp_full_match({c}, '[0-9]{{2}}\\.[0-9]{{2}}\\.[0-9]{{4}}') then {guard(full, '%d.%m.%Y')} when regexp_full_match({c}, '[0-9]{{2}}\\.[0-9]{{2}}\\.[0-9]{{2}}') then {guard(two, '%d.%m.%y')}
      when regexp_full_match({c}, '[0-9]{{2}}\\.[0-9]{{2}}\\.') then coalesce(strftime({short}, '%d.%m.'), '<Date_WRONG>') when regexp_full_match({c}, '[0-9]{{2}}\\.[0-9]{{2}}\\.[0-9]{{3}}') then '<Date_WRONG>' else {c} end"""


_OFF = f"(select doc, case when per_number is not null then {oracles._offset_days('per_number')} end as days, case when per_number is not null then [-2, -1, 1, 2][({oracles._hash(chr(39) + 'y' + chr(39) + ' || per_number')} % 4 + 1)::int] end as years from {REPORTS} r)"


def _deid_shifted() -> str:
    found = f"(select f.*, o.days, o.years from {folded(spans(REPORTS, detect.RADIOLOGY + detect.POSTPROCESS[:2]))} f join {_OFF} o on o.doc = f.doc)"
    sub = f"case when mc = 'Contact' and sc = 'PHONE' then repeat('X', length(covered)) when mc = 'Date' and sc = 'DATE' and days is not null then {_shifted('covered', 'days')} when mc = 'Age' and years is not null then coalesce((try_cast(covered as bigint) + years)::varchar, '<Age_WRONG>') else {_TAG} end"
    out = stitched(REPORTS, found, sub)
    return out.replace("f.mc, f.sc,", "f.mc, f.sc, f.days, f.years,", 1)


SQL["deidentify_shifted"] = _deid_shifted()


@query
def deidentify_substituted(spark, d):
    """Staff names replaced by made-up ones in their shape."""
    return rewrite.deidentify(reports(spark, d), "doc", "text", detect.RADIOLOGY, {"NAME": {"STAFF": "substitute"}}, merge=True, clean=True, first=F.lit("Eva"), last=F.lit("Muster"))


SQL["deidentify_substituted"] = stitched(REPORTS, folded(_CLEAN, True), f"case when mc = 'Name' then 'Eva Muster' else {_TAG} end")


@query
def substitute_names(spark, d):
    """Customers' names in four shapes, replaced: one word, two, with titles, three words (no rule)."""
    k = F.col("c_custkey") % 4
    name = F.when(k == 0, F.col("c_name")).when(k == 1, F.concat(F.lit("Max "), F.col("c_name"))).when(k == 2, F.concat(F.lit("Frau Dr. "), F.col("c_name"))).otherwise(F.concat(F.lit("Max von "), F.col("c_name")))
    return table(spark, d, "customer").select("c_custkey", rewrite.substitute_name(name, F.lit("Eva"), F.lit("Muster")).alias("fake"))


SQL["substitute_names"] = "select c_custkey, case c_custkey % 4 when 0 then 'Muster' when 1 then 'Eva Muster' when 2 then 'Frau Dr. Muster' end as fake from customer"


@query
def postprocess_applied(spark, d):
    """Ages and study names added to a text's annotations, the longest of a clash kept;
    study words of the skip-list are no finding."""
    df = detect.detect_arrays(reports(spark, d).select("doc", "text"), "text", detect.RADIOLOGY, "rules")
    df = detect.detect_arrays(df, "text", detect.POSTPROCESS, "RegEx-post", into="post")
    real = lambda s: (s["sub_class"] != "STUDYID") | models.study_span(F.col("text"), s["begin"], s["end"]).isNotNull()
    later = F.transform(F.filter("post", real), lambda s: s.withField("seq", s["seq"] + F.lit(1_000_000_000).cast("bigint")))
    return _out(spread(df.select("doc", fold_longest(F.concat("spans", later)).alias("spans")), "spans", "doc").select("doc", "s.begin", "s.end", "s.main_class", "s.sub_class", "s.source"))


def _post_sql() -> str:
    post = f"(select s.*, t.text from {spans(REPORTS, detect.POSTPROCESS)} s join {REPORTS} t on t.doc = s.doc)"
    post = f"(select *, regexp_full_match(covered, '[0-9]+') or covered = 'Lung' as wide, regexp_extract(substr(text, 1, (b - 1)::bigint), '(\\S*)$', 1) as before from {post} p)"
    both = f"(select doc, seq, b, e, mc, sc, 'rules' as src from {spans(REPORTS, detect.RADIOLOGY)} r union all select doc, seq + 1000000000, b, e, mc, sc, 'RegEx-post' from {post} p where sc <> 'STUDYID' or not (covered in ({_SKIP}) or (wide and before in ({_SKIP}))))"
    return folded(both).replace("src := 'rules'", "src := src")


SQL["postprocess_applied"] = f"select doc, b::bigint as begin_pos, e::bigint as end_pos, mc as main_class, sc as sub_class, src as source from {_post_sql()}"


@query
def spans_unresolved(spark, d):
    """Always-add: every finding beside those it overlaps."""
    df = detect.detect_arrays(detect.detect_arrays(reports(spark, d).select("doc", "text"), "text", detect.CONTACTS, "a", "x"), "text", detect.RADIOLOGY, "b", "y")
    return _out(spread(df.select("doc", F.concat("x", "y").alias("s")), "s", "doc").select("doc", "s.begin", "s.end", "s.main_class", "s.sub_class", "s.source"))


SQL["spans_unresolved"] = " union all ".join(f"select doc, b::bigint as begin_pos, e::bigint as end_pos, mc as main_class, sc as sub_class, '{n}' as source from {spans(REPORTS, ds)}" for n, ds in (("a", detect.CONTACTS), ("b", detect.RADIOLOGY)))


@query
def covered_sets(spark, d):
    """The surface forms of each class and subclass, a row per form."""
    return detect.detect(reports(spark, d), "doc", "text", ALL).groupBy("main_class", "sub_class", "covered").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc").alias("n_docs"))


SQL["covered_sets"] = f"select mc as main_class, sc as sub_class, covered, count(*) as n, count(distinct doc) as n_docs from {spans(REPORTS, ALL)} group by all"


@query
def suppress_findings(spark, d):
    """Names after an image reference or of a bare form of address, by both readings of the rule."""
    n = catalog._notes(spark, d)
    s = n.select("doc", "text", catalog.find_spans(F.col("text"), r"Customer#[0-9]+|Meier|Frau").alias("s"))
    s = spread(s, "s", "doc", "text").select("doc", "text", "s.begin", "s.end", "s.covered")
    both = {f"dropped{'_compat' if c else ''}": models.suppressed(F.col("text"), F.col("begin"), F.col("end"), c) for c in (False, True)}
    return _out(s.select("doc", "begin", "covered", *[v.alias(k) for k, v in both.items()]))


SQL["suppress_findings"] = f"""select doc, b::bigint as begin_pos, covered, img or bare as dropped, img and bare as dropped_compat from (select s.doc, b, covered, covered in ('Ehefrau', 'Ehemann', 'Herrn', 'Herr', 'Frau', 'Dr', 'Prog') as bare,
    regexp_matches(substr(n.text, greatest(b - 6, 0)::bigint + 1, (e - greatest(b - 6, 0))::bigint), '(?i)ima.*?[0-9]+/[0-9]+') as img from {span_sql(NOTES, 'Customer#[0-9]+|Meier|Frau')} s join {NOTES} n on n.doc = s.doc)"""


class NumberModel:
    """A stand-in for a model: numbers of four and more digits, by white-space tokens."""

    def load(self) -> None:
        import re

        self.word, self.number = re.compile(r"\S+", re.ASCII), re.compile(r"[0-9]{4,}", re.ASCII)

    def predict(self, batch: list[str]) -> list[list[dict]]:
        return [[{"begin": m.start(), "end": m.end(), "label": "ID_NUMBER", "score": 1.0} for m in self.word.finditer(t) if self.number.fullmatch(m.group())] for t in batch]


@query
def model_on_chunks(spark, d):
    """A model over the chunks of every report, its spans led back to the report;
    what two chunks share is found twice and counts once."""
    c = tokens.chunks(reports(spark, d), "doc", "text", 50, 10)
    found = detect.model_spans(c, "doc", "text", NumberModel, start="part_start")
    return _out(found.select("doc", "begin", "end", "main_class", "sub_class").distinct())


SQL["model_on_chunks"] = f"select doc, b::bigint as begin_pos, e::bigint as end_pos, 'ID' as main_class, 'NUMBER' as sub_class from {span_sql(REPORTS, chr(92) + 'S+')} where regexp_full_match(covered, '[0-9]{{4,}}')"


def _halve(a: dict, text: str) -> list[dict]:
    """A callback: long annotations become two, telephone numbers none."""
    if a["sub_class"] == "PHONE":
        return []
    if a["end"] - a["begin"] < 8:
        return [a]
    mid = (a["begin"] + a["end"]) // 2
    return [{**a, "end": mid}, {**a, "begin": mid}]


def _befunde(text: str) -> list[dict]:
    """A callback: every ``Befund`` as an annotation."""
    out, at = [], text.find("Befund")
    while at >= 0:
        out.append({"begin": at, "end": at + 6, "main_class": "Other", "sub_class": "BEFUND", "score": 0.5, "source": "callback"})
        at = text.find("Befund", at + 6)
    return out


@query
def callbacks(spark, d):
    """User functions that rewrite a text's annotations and add others."""
    return _out(detect.apply_callbacks(_annotated(spark, d), "doc", "text", "spans", _halve, _befunde).select("doc", "begin", "end", "main_class", "sub_class"))


SQL["callbacks"] = f"""with a as (select * from {_RESOLVED} r where sc <> 'PHONE') select doc, b::bigint as begin_pos, e::bigint as end_pos, mc as main_class, sc as sub_class from (select doc, b, e, mc, sc from a where e - b < 8
    union all select doc, b, (b + e) // 2, mc, sc from a where e - b >= 8 union all select doc, (b + e) // 2, e, mc, sc from a where e - b >= 8 union all select doc, b, e, 'Other', 'BEFUND' from {span_sql(REPORTS, 'Befund')} s)"""


@query
def base64_texts(spark, d):
    """Texts sent as base64 and decoded again; every third is no base64 and gives null."""
    sent = F.when(F.col("doc") % 3 == 0, "kein base64!").otherwise(F.base64(F.col("text").cast("binary")))
    return reports(spark, d).select("doc", decode_base64(sent).alias("text"))


SQL["base64_texts"] = f"select doc, case when doc % 3 <> 0 then text end as text from {REPORTS} r"


# --- dates ----------------------------------------------------------------------------
@query
def shift_ranges(spark, d):
    """Ranges, weekdays, brackets and old years: what stands around a date."""
    day, k = F.col("o_orderdate"), F.col("o_orderkey") % 5
    f = lambda p, n=0: F.date_format(F.date_add(day, n), p)
    text = F.when(k == 0, F.concat(f("dd.MM."), F.lit("-"), f("dd.MM.", 3))).when(k == 1, F.concat(F.lit("Mittwoch, "), f("dd.MM.yyyy"))).when(k == 2, F.concat(F.lit("("), f("dd.MM.yyyy"), F.lit(")"))).when(k == 3, F.concat(f("dd"), F.lit(" - "), f("dd.MM.yyyy", 5))).otherwise(F.concat(f("dd.MM."), F.lit("1950")))
    o = catalog.texts(spark, d, "orders").select(F.col("o_orderkey").alias("doc"), text.alias("covered"), (F.col("o_orderkey") % 29 - 14).cast("int").alias("days"))
    return o.withColumn("m", dates.shift_date(F.col("covered"), F.col("days"))).select("doc", "covered", F.col("m.written").alias("shifted"), "m.old")


def _ranges_sql() -> str:
    f = lambda x, form: f"strftime({x}, '{form}')"
    text = f"case k5 when 0 then {f('day', '%d.%m.')} || '-' || {f('day + 3', '%d.%m.')} when 1 then 'Mittwoch, ' || {f('day', '%d.%m.%Y')} when 2 then '(' || {f('day', '%d.%m.%Y')} || ')' when 3 then {f('day', '%d')} || ' - ' || {f('day + 5', '%d.%m.%Y')} else {f('day', '%d.%m.')} || '1950' end"
    at = lambda x: f"(try_strptime({x}, '%d.%m.%Y')::date + days)"
    a, b = at(f"{f('day', '%d.%m.')} || '1900'"), at(f"{f('day + 3', '%d.%m.')} || '1900'")
    old = at(f"{f('day', '%d.%m.')} || '1950'")
    head = at(f"{f('day', '%d')} || '.01.1900'")
    plain = lambda x: f"coalesce(year({x}) > 1901 and year({x}) < 2007, false)"
    return f"""select doc, {text} as covered, case k5 when 0 then {f(a, '%d.%m.')} || '-' || {f(b, '%d.%m.')} when 1 then {f('day + days', '%d.%m.%Y')} when 2 then {f('day + days', '%d.%m.%Y')} when 3 then {f(head, '%d')} || ' - ' || {f('day + 5 + days', '%d.%m.%Y')} else {f(old, '%d.%m.%Y')} end as shifted,
      case k5 when 0 then false when 1 then {plain('day + days')} when 2 then {plain('day + days')} when 3 then {plain('day + 5 + days')} else {plain(old)} end as old from (select *, (doc % 5)::int as k5 from {DATES})"""


SQL["shift_ranges"] = _ranges_sql()


# --- labels ------------------------------------------------------------------------------
SQL["bio_labels"] = f"select doc, b::bigint as begin_pos, e::bigint as end_pos, token, label from {_LABELLED}"


@query
def chunk_rows_labelled(spark, d):
    """Dataset rows with both tag columns and the whole text."""
    c = tokens.labelled_chunks(_annotated(spark, d), "doc", "text", "spans", 50, 10)
    flat = lambda x: F.array_join(x, " ")
    return _out(c.select("doc", "num_parts", "part_id", "part_start", "part_end", "text", F.length("fulltext").alias("n_fulltext"), flat("tokens").alias("tokens"), flat("tags_superclass").alias("superclass"), flat("tags_subclass").alias("subclass")))


def _ranges_of(words: str) -> str:
    return f"(select doc, n, p, greatest(p * 50 - 10, 0) as f, least((p + 1) * 50 + 10, n - 1) as l from (select doc, count(*) as n from {words} w group by doc), unnest(range(0, ceil(n / 50)::bigint)) u(p))"


SQL["chunk_rows_labelled"] = f"""with w as (select * from {_LABELLED}), c as (select r.doc, r.n, r.p, min(w.b) as b, max(w.e) as e, string_agg(w.token, ' ' order by w.pos) as tokens, string_agg(w.label, ' ' order by w.pos) as subclass, string_agg(regexp_replace(w.label, '_.*$', ''), ' ' order by w.pos) as superclass
    from {_ranges_of('w')} r join w on w.doc = r.doc and w.pos between r.f and r.l group by all)
    select c.doc, ceil(n / 50)::bigint as num_parts, p::bigint as part_id, b::bigint as part_start, e::bigint as part_end, substr(t.text, (b + 1)::bigint, (e - b)::bigint) as text, length(t.text) as n_fulltext, tokens, superclass, subclass from c join {REPORTS} t on t.doc = c.doc"""


@query
def chunk_subtokens(spark, d):
    """Sub-tokens of each chunk's words with their tags, counted by tag and place."""
    c = tokens.labelled_chunks(_annotated(spark, d), "doc", "text", "spans", 50, 10, subwords=True)
    return _out(c.select("doc", "part_id", F.size("tokens").alias("n"), F.array_join("tokens", " ").alias("tokens"), F.array_join("tags_subclass", " ").alias("tags")))


_SUBLABELS = f"(select doc, pos, i, covered as token, case when i > 1 and label like 'B-%' then 'I-' || name else label end as label from {span_sql('(select doc, pos, name, label, token as text from w)', _SUB, key='doc, pos, name, label')} x)"
SQL["chunk_subtokens"] = f"""with w as (select * from {_LABELLED}), s as (select * from {_SUBLABELS}) select r.doc, p::bigint as part_id, count(*) as n, string_agg(s.token, ' ' order by s.pos, s.i) as tokens, string_agg(s.label, ' ' order by s.pos, s.i) as tags
    from {_ranges_of('w')} r join s on s.doc = r.doc and s.pos between r.f and r.l group by r.doc, p"""


@query
def chunk_spans(spark, d):
    """Each chunk as an annotation: from its first word to its last."""
    c = tokens.chunks(reports(spark, d), "doc", "text", 100, 10)
    return _out(c.select("doc", F.col("part_start").alias("begin"), F.col("part_end").alias("end"), F.lit("Sentence").alias("main_class"), F.size("tokens").alias("n_tokens")))


SQL["chunk_spans"] = f"with w as (select doc, i - 1 as pos, b, e from {span_sql(REPORTS, chr(92) + 'S+')} s) select w.doc, min(b)::bigint as begin_pos, max(e)::bigint as end_pos, 'Sentence' as main_class, count(*) as n_tokens from {_ranges_of('w').replace('50', '100')} r join w on w.doc = r.doc and w.pos between r.f and r.l group by w.doc, p"

LABELS = tokens.label_list(["Contact_EMAIL", "Contact_IPADDRESS", "Contact_PHONE", "Contact_URL", "Date_DATE", "ID_PATIENTID", "ID_STUDYID", "Name_STAFF"])


@query
def subword_labels(spark, d):
    """Label numbers of words led to their sub-words between special pieces, in both
    ways; pieces that don't count masked, numbers turned into names again."""
    w = _annotated(spark, d).select("doc", tokens.labelled_tokens(F.col("text"), F.col("spans")).alias("w"))
    number = F.create_map(*[F.lit(x) for i, n in enumerate(LABELS) for x in (n, i)])
    ids = F.transform("w", lambda x: F.element_at(number, x["label"]))
    pieces = F.flatten(F.transform("w", lambda x, i: F.transform(tokens.sub_labels(x), lambda _: i)))
    special = F.array(F.lit(None).cast("int"))
    df = w.select("doc", ids.alias("l"), F.concat(special, pieces, special).alias("p"))
    df = df.select("doc", tokens.align_subword_labels(F.col("l"), F.col("p")).alias("all"), tokens.align_subword_labels(F.col("l"), F.col("p"), False).alias("first"))
    kept = tokens.masked(F.col("first"), F.col("all"))
    names = tokens.names_of(F.transform(kept, lambda x: x["label"]), LABELS)
    total = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x)
    return _out(df.select("doc", F.size("all").alias("n_pieces"), total("all").alias("sum_all"), total("first").alias("sum_first"), F.size(kept).alias("n_kept"), F.array_join(names, " ").alias("names")))


_ID = "list_position([" + ", ".join(f"'{x}'" for x in LABELS) + "], label) - 1"
SQL["subword_labels"] = f"""with w as (select *, {_ID} as id from {_LABELLED}), n as (select doc, pos, count(*) as k from {span_sql('(select doc, pos, token as text from w)', _SUB, key='doc, pos')} s group by all),
    a as (select w.doc, sum(k) as pieces, sum(k * id) as s, sum(id) as f, sum(k - 1) as later, count(*) as words, string_agg(label, ' ' order by w.pos) as names from w join n on n.doc = w.doc and n.pos = w.pos group by w.doc)
    select r.doc, coalesce(pieces, 0)::bigint + 2 as n_pieces, (coalesce(s, 0) - 200)::bigint as sum_all, (coalesce(f, 0) - 200 - 100 * coalesce(later, 0))::bigint as sum_first, coalesce(words, 0)::bigint as n_kept, coalesce(names, '') as names from {REPORTS} r left join a on a.doc = r.doc"""


@query
def split_labels(spark, d):
    """Full labels taken apart, as a model gives them."""
    label = F.col("label")
    s = detect.detect(reports(spark, d), "doc", "text", ALL).select(evaluate.blind(F.col("main_class"), F.col("sub_class"), F.col("seq") % 3).alias("label"))
    cut_ = F.udf(detect.split_label, "struct<a:string,b:string>")
    return s.groupBy("label").agg(F.count(F.lit(1)).alias("n")).withColumn("p", cut_(label)).select("label", "n", F.col("p.a").alias("main_class"), F.col("p.b").alias("sub_class"))


SQL["split_labels"] = f"with s as (select case seq % 3 when 2 then mc || '_' || sc when 1 then mc else 'REDACTED' end as label from {spans(REPORTS, ALL)}) select label, count(*) as n, split_part(label, '_', 1) as main_class, substr(label, length(split_part(label, '_', 1)) + 2) as sub_class from s group by label"


# --- scores -----------------------------------------------------------------------------------
def _rounded(df):
    return _out(df.withColumn("score", F.round("score", 6)))


@query
def word_aggregate_average(spark, d):
    return _rounded(catalog._words(spark, d, "average"))


@query
def word_aggregate_any_average(spark, d):
    return _rounded(catalog._words(spark, d, "any_average"))


@query
def word_aggregate_any_first(spark, d):
    return _rounded(catalog._words(spark, d, "any_first"))


_FLAT = f"(select doc, word, vec_id, u.c as c, s[u.c + 1] as v, list_position(s, list_max(s)) - 1 as own from {oracles._PIECES} p, unnest(range(0, 5)) u(c))"
_NONE = f"select doc, word, 0 as idx, avg(v) as score from {_FLAT} f where c = 0 group by doc, word having max(own) = 0"
_MEAN = "select doc, word, arg_max(c, (m, -c)) as idx, max(m) as score from (select doc, word, c, avg(v) as m from {} f {} group by all) group by doc, word"
_WORDS = {
    "average": _MEAN.format(_FLAT, ""),
    "any_average": _MEAN.format(_FLAT, "where own > 0") + f" union all {_NONE}",
    "any_first": f"select doc, word, arg_min(own, vec_id) as idx, arg_min(m, vec_id) as score from (select distinct doc, word, vec_id, own, max(v) over (partition by vec_id) as m from {_FLAT} f where own > 0) group by doc, word union all {_NONE}",
}
for _n, _q in _WORDS.items():
    SQL[f"word_aggregate_{_n}"] = f"select doc, word, idx::bigint as idx, round(score::double, 6) as score from ({_q})"


@query
def token_argmax(spark, d):
    """Strategies none, simple and exact: every piece by itself."""
    return _rounded(scores.token_scores(catalog._pieces(spark, d), ["doc", "vec_id"], "scores"))


SQL["token_argmax"] = f"select doc, vec_id, (list_position(s, list_max(s)) - 1)::bigint as idx, round(list_max(s), 6) as score from {oracles._PIECES} p"

NAMES = ["O", "B-Date", "I-Date", "B-Name", "I-Name"]


def _sentence(spark, d, strategy):
    p = catalog._pieces(spark, d).withColumn("sub", F.col("vec_id") % 4 != 0)
    return _rounded(scores.sentence_scores(p, "doc", "vec_id", "scores", NAMES, strategy, "sub"))


@query
def sentence_aggregate_max(spark, d):
    return _sentence(spark, d, "sentence_max")


@query
def sentence_aggregate_average(spark, d):
    return _sentence(spark, d, "sentence_average")


@query
def sentence_aggregate_first(spark, d):
    return _sentence(spark, d, "sentence_first")


def _sentence_sql(kind: str) -> str:
    own = "list_position(s, list_max(s)) - 1"
    t = f"(select doc, vec_id, s, vec_id % 4 <> 0 as sub, {own} as own, {oracles._NAMES}[(list_position(s, list_max(s)))::int] as l from {oracles._PIECES} p)"
    t = f"(select *, lag(l) over (partition by doc order by vec_id) as q from {t} t)"
    t = f"(select *, case when (l = q and (sub or q like 'I-%' or q = 'O')) or (q like 'B-%' and l = 'I-' || substr(q, 3)) then 0 else 1 end as brk from {t} t)"
    t = f"(select *, sum(brk) over (partition by doc order by vec_id) as g from {t} t)"
    ends = f"(select doc, g, min(vec_id) as first, max(vec_id) as last from {t} t group by all)"
    flat = f"(select doc, g, vec_id, u.c as c, s[u.c + 1] as v from {t} t, unnest(range(0, 5)) u(c))"
    if kind == "first":
        best = f"select doc, g, arg_min(own, vec_id) as idx, arg_min(list_max(s), vec_id) as score from {t} t group by doc, g"
    elif kind == "max":
        best = f"select doc, g, arg_max(c, (v, -vec_id, -c)) as idx, max(v) as score from {flat} f group by doc, g"
    else:
        best = f"select doc, g, arg_max(c, (m, -c)) as idx, max(m) as score from (select doc, g, c, avg(v) as m from {flat} f group by all) group by doc, g"
    return f"select e.doc, first, last, idx::bigint as idx, round(score::double, 6) as score from {ends} e join ({best}) b on b.doc = e.doc and b.g = e.g"


for _n in ("max", "average", "first"):
    SQL[f"sentence_aggregate_{_n}"] = _sentence_sql(_n)


def _grouped(spark, d, strategy):
    word = F.when(F.col("pos") % 5 == 0, "#x").when(F.col("pos") % 7 == 0, ".").otherwise("w")
    t = catalog._tagged(spark, d).withColumn("word", word).withColumn("end", F.when(F.col("pos") % 5 == 4, F.col("begin") + 10).otherwise(F.col("end")))
    g = scores.group_entities(t, "doc", "pos", "tag", strategy)
    return g.select("doc", "label", F.col("begin").alias("begin_pos"), F.col("end").alias("end_pos"), F.round("score", 6).alias("score"), "n_words")


@query
def group_entities_exact(spark, d):
    """Entities by exact position: I, or a continuation piece right behind, goes on."""
    return _grouped(spark, d, "exact")


@query
def group_entities_sentence(spark, d):
    """Entities bridging a single punctuation mark."""
    return _grouped(spark, d, "sentence_max")


def _group_sql(kind: str) -> str:
    t = f"(select doc, word as pos, {oracles._NAMES}[(idx + 1)::int] as tag, score, word * 10 as b, case when word % 5 = 4 then word * 10 + 10 else word * 10 + 8 end as e, case when word % 5 = 0 then '#x' when word % 7 = 0 then '.' else 'w' end as w from {oracles._word('max')} x)"
    t = f"(select *, case when tag <> 'O' then regexp_replace(tag, '^[BI]-', '') end as l from {t} t)"
    if kind == "sentence":
        t = f"(select *, lag(l) over o as pl, lead(l) over o as nl, lead(tag) over o as nt from {t} t window o as (partition by doc order by pos))"
        t = f"(select doc, pos, score, b, e, w, case when br then 'I-' || pl else tag end as tag, case when br then pl else l end as l from (select *, coalesce(l is null and w = '.' and pl = nl and nt like 'I-%', false) as br from {t} t))"
        goes = "tag not like 'B-%'"
    else:
        goes = "(tag like 'I-%' or (w like '%#%' and b = pe))"
    t = f"(select *, lag(l) over o as pl, lag(e) over o as pe from {t} t window o as (partition by doc order by pos))"
    t = f"(select *, sum(case when coalesce(l = pl and {goes}, false) then 0 else 1 end) over (partition by doc order by pos) as g from {t} t)"
    return f"select doc, any_value(l) as label, min(b)::bigint as begin_pos, max(e)::bigint as end_pos, round(avg(score)::double, 6) as score, count(*) as n_words from {t} t where l is not null group by doc, g"


for _n in ("exact", "sentence"):
    SQL[f"group_entities_{_n}"] = _group_sql(_n)


@query
def token_accuracy(spark, d):
    """Share of words to which two strategies give one tag."""
    a, b = (catalog._tagged(spark, d, s).select("doc", "pos", F.col("tag").alias(f"tag_{s}")) for s in ("max", "first"))
    return evaluate.token_accuracy(a.join(b, ["doc", "pos"]), "tag_max", "tag_first").withColumn("accuracy", F.round("accuracy", 9))


SQL["token_accuracy"] = f"select count(*) as n_tokens, round(avg((a.idx = b.idx)::int)::double, 9) as accuracy from {oracles._word('max')} a join {oracles._word('first')} b on a.doc = b.doc and a.word = b.word"


# --- evaluation --------------------------------------------------------------------------------
def _gold_and_pred(spark, d):
    n = len(detect.CONTACTS)
    df = detect.detect_arrays(reports(spark, d).select("doc", "text"), "text", detect.CONTACTS + detect.RADIOLOGY[:8], "rules")
    of = lambda ok: F.filter("spans", lambda s: ok(F.floor(s["seq"] / 1_000_000)))
    return df.select("doc", of(lambda k: k < n + 6).alias("gold"), of(lambda k: k >= n).alias("pred"))


@query
def eval_report(spark, d):
    """The four sheets of an evaluation run in one table."""
    return evaluate.report(_gold_and_pred(spark, d), "doc", "gold", "pred")


def _report_sql() -> str:
    out = []
    for lv, (doc, total) in evaluate.SHEETS.items():
        m = oracles._matched(lv)
        by = f"select doc, case when grouping(label) = 1 then 'strict' else label end as eval_name, {oracles._counts('')} from {m} m group by grouping sets ((doc, label), (doc))"
        by = f"{by} union all select doc, 'strict', 0, 0, 0 from {REPORTS} r where doc not in (select doc from {m} m)"
        out.append(oracles._rates(by, extra=f"'{doc}' as sheet, doc as document, "))
        out.append(oracles._rates(f"select case when grouping(label) = 1 then 'strict' else label end as eval_name, {oracles._counts('')} from {m} m group by rollup(label)", extra=f"'{total}' as sheet, null::bigint as document, "))
    return " union all ".join(f"select * from ({x})" for x in out)


SQL["eval_report"] = _report_sql()


@query
def eval_lines(spark, d):
    """The console table of an evaluation, a line per row."""
    return catalog.strict_eval_summary(spark, d).select("eval_name", evaluate.report_line().alias("line"))


SQL["eval_lines"] = f"select eval_name, printf('%-24s P %.4f R %.4f F1 %.4f (tp %d fp %d fn %d)', eval_name, precision, recall, f1, tp, fp, fn) as line from ({oracles._summary(oracles._matched(2))})"

EXPECTED = ["Date_DATE", "Contact_PHONE", "Contact_EMAIL", "Name_STAFF"]


@query
def eval_expected(spark, d):
    """Annotations of the expected labels at both granularities, telephone numbers ignored."""
    s = detect.detect(reports(spark, d), "doc", "text", ALL)
    parts = [evaluate.expected(s, EXPECTED, lv, ("PHONE",)).groupBy("label").agg(F.count(F.lit(1)).alias("n")).select(F.lit(lv).cast("bigint").alias("level"), "label", "n") for lv in (1, 2)]
    return parts[0].unionByName(parts[1])


SQL["eval_expected"] = f"with s as (select mc, sc from {spans(REPORTS, ALL)}) select 2::bigint as level, mc || '_' || sc as label, count(*) as n from s where mc || '_' || sc in ('Date_DATE', 'Contact_EMAIL', 'Name_STAFF') group by all union all select 1, mc, count(*) from s where mc in ('Date', 'Contact', 'Name') group by all"


# --- corpora -----------------------------------------------------------------------------------
@query
def annotated_reports(spark, d):
    """Final reports of enough length with at least one annotation."""
    r = _annotated(spark, d, ("status",)).where("status = 'final' and length(text) >= 1000")
    return corpus.annotated(r, "spans").select("doc", F.size("spans").cast("bigint").alias("n_entities"))


SQL["annotated_reports"] = f"select r.doc, count(*) as n_entities from {REPORTS} r join {_RESOLVED} f on f.doc = r.doc where status = 'final' and length(text) >= 1000 group by r.doc"


def _mapped(spark, d, kind):
    keys = corpus.typed_keys(table(spark, d, "resource_mapping"), "resource_type", kind, ["per_number", "id"], "id")
    have = table(spark, d, "resource").where("valuestring is not null").select("id")
    return keys.join(have, "id", "left_semi")  # documents that exist


@query
def mapped_documents(spark, d):
    """Keys of one document type, each id once, of documents that exist."""
    return _mapped(spark, d, "DiagnosticReport").select("id", "per_number")


def _mapped_sql(kind: str) -> str:
    return f"select id, min(per_number) as per_number from resource_mapping where trim(resource_type) = '{kind}' and id in (select id from resource where valuestring is not null) group by id having count(per_number) = count(*) union all select id, null from resource_mapping where trim(resource_type) = '{kind}' and id in (select id from resource where valuestring is not null) group by id having count(per_number) < count(*)"


SQL["mapped_documents"] = _mapped_sql("DiagnosticReport")


def _corpora(spark, d):
    final = table(spark, d, "radiology_df").where("status = 'final' and length(text) >= 1000")
    radio = corpus.keep_first(final.select("diagnostic_report_id", "per_number", "report_row_id"), ["diagnostic_report_id"], ["report_row_id"])
    parts = {"radio": radio.select(F.col("per_number").alias("patient_id"), F.col("diagnostic_report_id").alias("document_id"))}
    for name, kind in (("patho", "DiagnosticReport"), ("melanoma", "Observation")):
        parts[name] = _mapped(spark, d, kind).select(F.col("per_number").alias("patient_id"), F.col("id").alias("document_id"))
    return corpus.corpus_union(parts)


@query
def corpus_manifest(spark, d):
    """Three corpora, each filtered in its own way, as one manifest with a split by patients."""
    docs = _corpora(spark, d).where("patient_id is not null")
    return corpus.train_test(docs, corpus.sample_patients(docs, "patient_id", 80), "patient_id")


_CORPORA = f"""select 'radio' as document_type, per_number as patient_id, diagnostic_report_id as document_id from (select diagnostic_report_id, arg_min(per_number, report_row_id) as per_number, arg_min(per_number is null, report_row_id) as no from radiology_df where status = 'final' and length(text) >= 1000 group by 1) where not no
    union all select 'patho', per_number, id from ({_mapped_sql('DiagnosticReport')}) union all select 'melanoma', per_number, id from ({_mapped_sql('Observation')})"""
SQL["corpus_manifest"] = f"""with c as (select * from ({_CORPORA}) where patient_id is not null), p as (select distinct patient_id from c), t as (select patient_id from p order by {oracles._hash('patient_id')}, patient_id limit (select ceil(80 * count(*) / 100)::bigint from p))
    select document_type, patient_id, document_id, case when patient_id in (select patient_id from t) then 'train' else 'test' end as phase from c"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
