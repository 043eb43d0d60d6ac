"""Round trips through the sources and sinks: what is written comes back.

Each query writes whole tables in a format to the shared folder, reads them
again and returns what the source says; the SQL states the rows without files.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textveil.functions import dates
from textveil.operators import corpus, detect, rewrite, similarity, textstats
from textveil.plans import catalog, composed, oracles
from textveil.plans.catalog import _out, query, table
from textveil.plans.oracles import span_sql, stitched
from textveil.session import scratch
from textveil.sources import documents, xmi

SQL: dict[str, str] = {}
YEAR = (detect.Detector("year", "[0-9]{2,}", "Date", "DATE"),)


def _items(spark, d):
    return table(spark, d, "benchmark").where("text is not null").select("item_id", "text")


def _named(spark, d):
    """Items with a file name of patient and resource, and their annotations."""
    hexed = lambda n: F.lpad(F.lower(F.hex(F.col("item_id") * n)), 6, "0")
    name = F.concat(F.lit("Patient:"), hexed(7), F.lit("_Report:"), hexed(11))
    df = detect.detect_arrays(_items(spark, d), "text", YEAR, "rules")
    slim = F.transform("spans", lambda s: F.struct(*[s[c].alias(c) for c in ("begin", "end", "main_class", "sub_class", "score", "source")]))
    return df.select("item_id", name.alias("name"), "text", slim.alias("spans"))


_SRC = "(select item_id as doc, text from benchmark where text is not null)"
_YEARS = span_sql(_SRC, "[0-9]{2,}")
_HEX = "lpad(lower(to_hex(doc * {})), 6, '0')"


@query
def texts_round_trip(spark, d):
    """Plain texts in folders by phase; those of no phase are listed for inference only."""
    k = F.col("item_id") % 3
    df = _items(spark, d).select("item_id", F.concat("text", F.lit("\x01")).alias("text"), F.when(k == 0, "train").when(k == 1, "test").alias("phase"))
    path = scratch(spark, "texts")
    documents.write_texts(df, "item_id", "text", path, "phase")
    with_root = documents.read_texts(spark, path, inference=True)
    without = documents.read_texts(spark, path).select("document_id", F.lit(True).alias("in_split"))
    return with_root.join(without, "document_id", "left").withColumn("in_split", F.coalesce("in_split", F.lit(False)))


SQL["texts_round_trip"] = "select item_id::varchar as document_id, case item_id % 3 when 0 then 'train' when 1 then 'test' end as phase, text, item_id % 3 <> 2 as in_split from benchmark where text is not null"


def _annotations(df):
    ids = xmi.file_ids(df).select("path", "patient_id", "resource_type", "resource_id", F.length("text").cast("bigint").alias("n_chars"), "spans")
    spans = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("s")), lambda a, x: F.struct((a["n"] + 1).alias("n"), (a["s"] + x["begin"] * 3 + x["end"]).alias("s")))
    return _out(ids.select("patient_id", "resource_type", "resource_id", "n_chars", spans["n"].alias("n_spans"), spans["s"].alias("places")))


_FILES = f"""select {_HEX.format(7)} as patient_id, 'Report' as resource_type, {_HEX.format(11)} as resource_id, length(text) as n_chars, coalesce(n, 0)::bigint as n_spans, coalesce(s, 0)::bigint as places
    from {_SRC} t left join (select doc as k, count(*) as n, sum(3 * b + e) as s from {_YEARS} y group by 1) y on y.k = t.doc"""


@query
def xmi_round_trip(spark, d):
    """Annotated documents written as XMI and read again by file name."""
    path = scratch(spark, "xmi")
    xmi.write_xmi_files(_named(spark, d), "name", "text", "spans", path)
    return _annotations(xmi.read_xmi(spark, path))


SQL["xmi_round_trip"] = _FILES


@query
def curation_round_trip(spark, d):
    """Zip files of a curation tool; an annotator without a file of their own falls back to the curator's."""
    path = scratch(spark, "zips")
    xmi.write_curation_zips(_named(spark, d), "name", "text", "spans", path)
    got = xmi.read_curation_zips(spark, path, "someone")
    return _annotations(got.withColumn("path", F.regexp_replace("path", "/export.zip$", "")))


SQL["curation_round_trip"] = _FILES


@query
def xmi_pairs(spark, d):
    """Gold and predicted files by stem, with what keeps them from being compared."""
    gold, pred = scratch(spark, "gold"), scratch(spark, "pred")
    df = _named(spark, d)
    xmi.write_xmi_files(df.where("item_id % 5 <> 0"), "item_id", "text", "spans", gold)
    xmi.write_xmi_files(df.where("item_id % 7 <> 0").withColumn("text", F.when(F.col("item_id") % 11 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))), "item_id", "text", "spans", pred)
    g, p = (xmi.read_xmi(spark, x).withColumn("stem", xmi.stem()) for x in (gold, pred))
    return xmi.paired(g, p, "stem", "text")


SQL["xmi_pairs"] = "select item_id::varchar as stem, case when item_id % 7 = 0 then 'only_gold' when item_id % 5 = 0 then 'only_pred' when item_id % 11 = 0 then 'other_text' else 'same' end as state from benchmark where text is not null and (item_id % 5 <> 0 or item_id % 7 <> 0)"


@query
def json_round_trip(spark, d):
    """Annotation JSON read to documents and annotations, these resolved in merge mode."""
    path = scratch(spark, "json")
    df = _named(spark, d).withColumn("spans", F.concat(F.transform("spans", lambda s: s.withField("main_class", F.lit("Age")).withField("sub_class", F.lit(None).cast("string"))), F.transform("spans", lambda s: s.withField("main_class", F.lit("Token")))))
    documents.annotation_json(df, "name", "text", "spans").select("content").write.text(path)
    docs, ann = documents.read_annotation_json(spark, path, lines=True)
    n = ann.groupBy("document_name").agg(F.count(F.lit(1)).alias("n_spans"), F.sum(F.col("begin") * 3 + F.col("end")).alias("places"), F.max("main_class").alias("main_class"), F.max("sub_class").alias("sub_class"))
    return _out(docs.join(n, "document_name", "left").select("patient_id", "resource_type", "resource_id", "text", F.coalesce("n_spans", F.lit(0)).alias("n_spans"), "places", "main_class", "sub_class"))


SQL["json_round_trip"] = f"""select {_HEX.format(7)} as patient_id, 'Report' as resource_type, {_HEX.format(11)} as resource_id, text, coalesce(n, 0)::bigint as n_spans, s::bigint as places, case when n > 0 then 'Age' end as main_class, case when n > 0 then 'AGE' end as sub_class
    from {_SRC} t left join (select doc as k, count(*) as n, sum(3 * b + e) as s from {_YEARS} y group by 1) y on y.k = t.doc"""


@query
def metrics_of_files(spark, d):
    """Text metrics of a folder of plain and JSON files, written as CSV and read again."""
    path, out = scratch(spark, "metrics"), scratch(spark, "metrics-csv")
    df = _items(spark, d).withColumn("doc", F.col("item_id").cast("string"))
    documents.write_texts(df.where("item_id % 2 = 0"), "doc", "text", path)
    odd = df.where("item_id % 2 = 1").withColumn("spans", F.expr("array(named_struct('begin', 0, 'end', 1, 'main_class', 'Token', 'sub_class', 'X'))"))
    js = documents.annotation_json(odd, "doc", "text", "spans", "DocumentAnnotation")
    xmi.write_files(js.withColumn("name", F.concat("name", F.lit(".json"))), "name", "content", path)
    m = textstats.document_metrics(documents.read_metric_texts(spark, path), "document", "text")
    columns = "document string, tokens bigint, sentences bigint, characters bigint, mean_word_length double, mean_sentence_length double"
    documents.write_csv(m.select([c.split()[0] for c in columns.split(", ")]), out)
    return documents.read_csv(spark, out, columns).withColumn("document", F.regexp_replace("document", r"\.txt$", ""))


def _metrics_sql() -> str:
    metric = f"(select doc, length(text) as characters, regexp_extract_all(text, '[^\\s]+') as w, len(regexp_extract_all(text, '[.!?]+(?:\\s|$)')) as ends from {_SRC} r)"
    per = f"(select doc, len(w)::bigint as tokens, case when len(w) > 0 then greatest(ends, 1) else 0 end::bigint as sentences, characters::bigint as characters, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars from {metric} m)"
    return f"select doc::varchar as document, tokens, sentences, characters, case when tokens > 0 then word_chars / tokens else 0.0 end::double as mean_word_length, case when sentences > 0 then tokens / sentences else 0.0 end::double as mean_sentence_length from {per}"


SQL["metrics_of_files"] = _metrics_sql()


@query
def manifest_round_trip(spark, d):
    """The split manifest as CSV; blanks, quotes and nulls as they were."""
    path = scratch(spark, "manifest")
    s = table(spark, d, "split_document").select("document_type", "patient_id", "document_id", "phase")
    documents.write_csv(s, path)
    return documents.read_csv(spark, path, "split").groupBy("document_type", "patient_id", "document_id", "phase").agg(F.count(F.lit(1)).alias("n"))


SQL["manifest_round_trip"] = "select document_type, patient_id, document_id, phase, count(*) as n from split_document group by all"


@query
def tables_round_trip(spark, d):
    """The other CSV inputs: reports, mapping, patients and offsets in milliseconds (as days, rounded down)."""
    out = []
    parts = {
        "radiology": table(spark, d, "radiology_df").select("status", "diagnostic_report_id", "per_number", F.regexp_replace("text", r"[\r\n]+", "\n").alias("text")),
        "mapping": table(spark, d, "resource_mapping").select(F.col("resource_type").alias("type"), "per_number", "id"),
        "patients": table(spark, d, "patient_lookup"),
        "offsets": table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("patientid"), (F.col("c_custkey") * 7_654_321 - 5_000_000_000).alias("timeoffset")),
    }
    for kind, df in parts.items():
        path = scratch(spark, kind)
        documents.write_csv(df, path)
        back = documents.read_csv(spark, path, kind)
        first, last = back.columns[0], back.columns[-1]
        value = dates.days_of(F.col(last)).cast("string") if kind == "offsets" else F.col(last)
        out.append(back.groupBy(F.lit(kind).alias("kind"), F.col(first).alias("first"), F.md5(value).alias("last")).agg(F.count(F.lit(1)).alias("n")))
    return out[0].unionAll(out[1]).unionAll(out[2]).unionAll(out[3])


SQL["tables_round_trip"] = """select 'radiology' as kind, status as first, md5(regexp_replace(text, '[\\r\\n]+', chr(10), 'g')) as last, count(*) as n from radiology_df group by all union all select 'mapping', resource_type, md5(id), count(*) from resource_mapping group by all
    union all select 'patients', id, md5(identifier_0_value), count(*) from patient_lookup group by all union all select 'offsets', c_custkey::varchar, md5(floor((c_custkey * 7654321 - 5000000000) / 86400000.0)::bigint::varchar), count(*) from customer group by all"""


@query
def leaks_round_trip(spark, d):
    """Leakage flags as CSV."""
    path = scratch(spark, "leaks")
    documents.write_csv(catalog.leak_flag(spark, d).select("split_id", "patient_id", "side", "leaks"), path)
    return documents.read_csv(spark, path, "split_id bigint, patient_id string, side string, leaks boolean")


@query
def report_sheets(spark, d):
    """An evaluation report written sheet by sheet; two sheets read again."""
    path = scratch(spark, "report")
    documents.write_sheets(composed.eval_report(spark, d), path)
    parts = [documents.read_sheet(spark, path, n).withColumn("sheet", F.lit(n)) for n in ("sum_only_type", "doc_with_kind")]
    return parts[0].unionByName(parts[1])


SQL["report_sheets"] = f"select * from ({composed.SQL['eval_report']}) where sheet in ('sum_only_type', 'doc_with_kind')"


@query
def bundle_round_trip(spark, d):
    """Bundles of resources, one per type, with their texts rewritten by id; what has
    no partner is told.  An id loaded twice is one resource, its first text."""
    path, out = scratch(spark, "bundles"), scratch(spark, "bundles-out")
    r = table(spark, d, "resource").where("id is not null").groupBy("id", "resource_type").agg(F.min("valuestring").alias("valueString"))
    one = r.groupBy("id").agg(F.min(F.struct("resource_type", "valueString")).alias("r")).select("id", F.col("r.resource_type").alias("resourceType"), F.col("r.valueString").alias("valueString"))
    # a bundle is one JSON document: 256 of them by a hash of the id, never one for all
    hashed = one.withColumn("bundle", F.pmod(corpus.portable_hash(F.col("id")), F.lit(256)))
    documents.write_bundles(hashed.withColumn("pos", F.row_number().over(Window.partitionBy("bundle").orderBy("id"))), path)
    entries = documents.read_bundles(spark, path, lines=True)
    deid = rewrite.deidentify(entries.where("valueString is not null"), "id", "valueString", detect.CONTACTS, {})
    new, odd = documents.rewrite_bundles(entries, deid, "id", "deid_text")
    documents.write_bundles(new, out)
    return documents.read_bundles(spark, out, lines=True).join(odd, "id", "left").select("id", "resourceType", "valueString", F.coalesce("state", F.lit("rewritten")).alias("state"))


_ONE = "(select id as doc, arg_min(resource_type, resource_type) as resource_type, min(valuestring) filter (resource_type = t) as text from (select *, min(resource_type) over (partition by id) as t from resource where id is not null) group by id)"
_WITH = f"(select doc, text from {_ONE} o where text is not null)"
SQL["bundle_round_trip"] = f"select o.doc as id, o.resource_type as \"resourceType\", x.deid_text as \"valueString\", case when o.text is null then 'not_rewritten' else 'rewritten' end as state from {_ONE} o left join ({stitched(_WITH, oracles.resolved(_WITH, detect.CONTACTS), oracles._TAG)}) x on x.doc = o.doc"

POLICY_FILE = "PHI:\n  DATE:\n    DATE: shift\n    BIRTHDATE: replace\n  NAME:\n    STAFF: substitute\n  CONTACT:\n    PHONE: redact  # numbers\nOFFSET:\n  DATE_NEGATIVE_BOUNDARY: -14\n  DATE_POSITIVE_BOUNDARY: 15\n"


@query
def policy_config(spark, d):
    """A policy file as a table of methods and of offset bounds."""
    import os

    path = scratch(spark, "policy")
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/policy.yaml", "w", encoding="utf-8") as f:
        f.write(POLICY_FILE)
    p = documents.load_policy(f"{path}/policy.yaml")
    methods = rewrite.policy_table(spark, p["PHI"]).select("policy_class", "policy_sub", F.col("method").alias("value"))
    return methods.unionAll(spark.createDataFrame([("OFFSET", k, str(v)) for k, v in p["OFFSET"].items()], "a string, b string, c string"))


SQL["policy_config"] = "select * from (values ('DATE', 'DATE', 'shift'), ('DATE', 'BIRTHDATE', 'replace'), ('NAME', 'STAFF', 'substitute'), ('CONTACT', 'PHONE', 'redact'), ('OFFSET', 'DATE_NEGATIVE_BOUNDARY', '-14'), ('OFFSET', 'DATE_POSITIVE_BOUNDARY', '15')) t(policy_class, policy_sub, value)"


@query
def selected_files(spark, d):
    """The chosen distinct items, a stratum per remainder of three, written as files and listed."""
    path = scratch(spark, "selected")
    df = _items(spark, d).withColumn("stratum", F.col("item_id") % 3)
    chosen = similarity.distinct_selection(df, "stratum", "item_id", "text", k=20, min_chars=100)
    documents.write_texts(df.join(chosen.select("item_id"), "item_id", "left_semi"), "item_id", "text", path)
    return documents.read_texts(spark, path, inference=True).select("document_id", F.length("text").alias("n_chars"))


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
