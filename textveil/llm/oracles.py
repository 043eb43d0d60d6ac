"""The pN_ queries that SQL can state, or what must hold of them, in DuckDB."""

from __future__ import annotations

HEX = "nullif(lower(regexp_extract({c}, '(?:^|[^0-9A-Za-z])([0-9a-fA-F]{{16}})(?:[^0-9A-Za-z]|$)', 1)), '')"
NUMBER = "case when try_cast(nullif(regexp_extract({c}, '^\\s*(?:[A-Za-z]+[\\s_:/#.-]*)?0*([0-9]{{1,18}})(?:\\.0+)?\\s*$', 1), '') as bigint) > 0 then try_cast(regexp_extract({c}, '^\\s*(?:[A-Za-z]+[\\s_:/#.-]*)?0*([0-9]{{1,18}})(?:\\.0+)?\\s*$', 1) as bigint) end"
LOW = "lower(regexp_replace({c}, '^[\\s\\x{{a0}}]+|[\\s\\x{{a0}}]+$', '', 'g'))"


def _hex(c: str) -> str:
    return HEX.format(c=c)


def _node(c: str) -> str:
    return f"coalesce('h' || {_hex(c)}, 'n' || lpad(({NUMBER.format(c=c)})::varchar, 18, '0'))"


def _num(c: str) -> str:
    return f"'n' || lpad(({NUMBER.format(c=c)})::varchar, 18, '0')"


_P = LOW.format(c="phase")
PHASE = f"case when {_P} in ('train', 'training') then 'train' when {_P} in ('validation', 'val', 'valid', 'dev') then 'validation' when {_P} in ('test', 'testing') then 'test' end"

P1 = f"""with recursive m as (select {_hex('id')} as document, {_num('per_number')} as number from resource_mapping), md as (select distinct * from m where document is not null and number is not null),
  r0 as (select split_id, {_node('patient_id')} as node, {_hex("regexp_replace(document_id, '(?i)\\.[a-z]{1,5}\\s*$', '')")} as document, {PHASE} as phase from split_document),
  r as (select split_id, coalesce(r0.node, f.number) as node, r0.document, phase from r0 left join (select document, min(number) as number from md group by 1) f on f.document = r0.document),
  l as (select r.node as a, md.number as b from r join md on md.document = r.document where r.node is not null union select 'h' || {_hex('id')}, {_num('identifier_0_value')} from patient_lookup where {_hex('id')} is not null and {_num('identifier_0_value')} is not null union select node, node from r where node is not null),
  e as (select a, b from l union select b, a from l),
  reach as (select distinct a as x, a as y from e union select reach.x, e.b from reach join e on e.a = reach.y),
  c as (select x as node, min(y) as root, min(y) filter (y like 'n%') as number from reach group by x),
  p as (select r.split_id, r.phase, c.root, substr(c.number, 2)::bigint as person_no from r join c on c.node = r.node where phase is not null)
  select split_id, person_no from p where root in (select root from p group by root having count(distinct phase) > 1)"""

_FILLED = "regexp_matches({c}, '[^\\s]')"
_STATUS = LOW.format(c="status")
P5 = f"""with r as (select {_hex('diagnostic_report_id')} as report_id, report_row_id, case when {_STATUS} in ('final', 'amended', 'corrected') then 0 when {_STATUS} in ('preliminary', 'partial', 'registered') then 1 else 2 end as trust, issued_at,
  {' + '.join(f"coalesce({_FILLED.format(c=f)}, false)::int" for f in ('per_number', 'text', 'modality', 'site', 'lang'))} as n from radiology_df)
  select report_id, report_row_id from (select *, count(*) over (partition by report_id) as k, row_number() over (partition by report_id order by trust, issued_at desc nulls last, n desc, report_row_id) as i from r where report_id is not null) where k > 1 and i = 1"""

_WORDS = "regexp_extract_all(replace(replace(replace(replace(lower(nfc_normalize(text)), 'ß', 'ss'), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), '[\\p{L}\\p{N}]+')"
_GRAMS = "select distinct {k}, array_to_string(w[i:i + 11], ' ') as g from (select {k}, {w} as w from {t} where text is not null) x, unnest(range(1, len(w) - 10)) u(i)"
P7 = f"select distinct d.doc_id, b.item_id from ({_GRAMS.format(k='doc_id', w=_WORDS, t='documents')}) d join ({_GRAMS.format(k='item_id', w=_WORDS, t='benchmark')}) b on b.g = d.g"


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": P1,
        "p1_check": "select count(*)::bigint as n_rows, 0::bigint as n_torn, 0::bigint as n_moved from split_document",
        "p2_check": "select report_row_id, length(regexp_replace(text, '[\\s\\p{Z}]', '', 'g'))::bigint as n_chars, true as apart from radiology_df where regexp_matches(text, '[^\\s\\p{Z}]')",
        "p5_found": P5,
        "p6_found": "select report_row_id from radiology_df where length(text) > 2500",
        "p6_check": "select report_row_id, 0::bigint as first, length(text)::bigint as last, true as fits, true as overlap_fits, true as no_gap from radiology_df where length(text) > 2500",
        "p7_found": P7,
        "p8_check": "select distinct nullif(regexp_replace(lower(trim(source)), '[\\s_]+', '_', 'g'), '') as source, true as near, true as within from mix_target where source is not null",
    }
