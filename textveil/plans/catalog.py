"""Named queries over the test tables: each runs an operator over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textveil.functions import dates
from textveil.functions.spans import find_spans, fold_longest, fold_merge, spread
from textveil.operators import corpus, detect, evaluate, letterhead, models, rewrite, scores, similarity, textstats, tokens
from textveil.session import cut

Q = {}


def query(f):
    Q[f.__name__] = f
    return f


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def texts(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table for work within rows.

    A table of a few small files (as in tests) is read by a few tasks, as files
    of one row group don't split; its rows are spread over the cores.  Tables
    with as many splits as half the cores are read as they lie, without a shuffle.
    """
    df = table(spark, d, name)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 < cores else df


def reports(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d, "radiology_df").where("text is not null").select(F.col("report_row_id").alias("doc"), "text", "status", "diagnostic_report_id", "per_number", "issued_at", "modality")


def _spans(df: DataFrame, detectors, source="rules") -> DataFrame:
    return detect.detect(df, "doc", "text", detectors, source)


def _out(df: DataFrame) -> DataFrame:
    """Scalar columns with names that need no quotes."""
    names = {"begin": "begin_pos", "end": "end_pos"}
    df = df.withColumnsRenamed(names)
    return df.select(*[F.col(c).cast("bigint") if t in ("int", "smallint") else F.col(c) for c, t in df.dtypes])


# --- detection and resolution -------------------------------------------------
@query
def deidentify_documents(spark, d):
    return rewrite.deidentify(reports(spark, d), "doc", "text", detect.CONTACTS + detect.RADIOLOGY, {}, merge=False)


@query
def deidentify_merge(spark, d):
    return rewrite.deidentify(reports(spark, d), "doc", "text", detect.RADIOLOGY, {"DATE": {"DATE": "redact"}}, merge=True)


@query
def detect_contacts(spark, d):
    return _out(_spans(reports(spark, d), detect.CONTACTS).select("doc", "seq", "begin", "end", "main_class", "sub_class", "covered"))


@query
def detect_radiology_rules(spark, d):
    return _out(_spans(reports(spark, d), detect.RADIOLOGY).select("doc", "seq", "begin", "end", "main_class", "sub_class", "covered"))


@query
def detect_radiology(spark, d):
    """The radiology set as applied: spaces trimmed, study names fixed, staff runs split.
    ``detect_radiology_rules`` has the raw rule spans."""
    df = detect.detect_arrays(reports(spark, d).select("doc", "text"), "text", detect.RADIOLOGY, "radio-regex")
    found = spread(df.withColumn("spans", models.clean_spans(F.col("text"), F.col("spans"))), "spans", "doc", "text").select("doc", "text", "s.*")
    return _out(found.select("doc", "seq", "begin", "end", "main_class", "sub_class", F.col("text").substr(F.col("begin") + 1, F.col("end") - F.col("begin")).alias("covered")))


@query
def detect_postprocess_rules(spark, d):
    return _out(_spans(texts(spark, d, "documents").where("text is not null").select(F.col("doc_id").alias("doc"), "text"), detect.POSTPROCESS + detect.MISSING).select("doc", "seq", "begin", "end", "main_class", "sub_class", "covered"))


@query
def detect_measures(spark, d):
    return _out(_spans(_notes(spark, d), detect.MEASURES).select("doc", "begin", "end", "sub_class", "covered"))


def _resolved(spark, d, fold) -> DataFrame:
    df = detect.detect_arrays(reports(spark, d).select("doc", "text"), "text", detect.CONTACTS + detect.RADIOLOGY, "rules")
    return spread(df.select("doc", fold(F.col("spans")).alias("spans")), "spans", "doc").select("doc", "s.begin", "s.end", "s.main_class", "s.sub_class")


@query
def resolve_longest(spark, d):
    return _out(_resolved(spark, d, fold_longest))


@query
def resolve_merge(spark, d):
    return _out(_resolved(spark, d, fold_merge))


# --- two models ---------------------------------------------------------------
def _two(spark, d) -> DataFrame:
    """Two models' spans of each text, as arrays; what both have is found once."""
    n = len(detect.CONTACTS)
    df = detect.detect_arrays(reports(spark, d).select("doc", "text"), "text", detect.CONTACTS + detect.RADIOLOGY, "rules")
    number = lambda s: F.floor(s["seq"] / 1_000_000)
    again = lambda s, k: s.withField("seq", s["seq"] - F.lit(k * 1_000_000).cast("bigint"))
    sup = F.transform(F.filter("spans", lambda s: number(s) >= n), lambda s: again(s, n))
    sub = F.filter("spans", lambda s: (number(s) < n) | ((number(s) > n) & (number(s) < n + 4)))
    # the rules 1 to 3 of the radiology set follow the contacts
    sub = F.transform(sub, lambda s: F.when(number(s) > n, again(s, 1)).otherwise(s))
    return df.select("doc", sup.alias("sup"), sub.alias("sub"))


def _pairs(spark, d) -> DataFrame:
    return spread(_two(spark, d).select("doc", models.match_arrays(F.col("sup"), F.col("sub")).alias("m")), "m", "doc")


@query
def match_models_outer(spark, d):
    return _pairs(spark, d).select("doc", F.col("s.a.seq").alias("sup_seq"), F.col("s.b.seq").alias("sub_seq"))


@query
def merge_models(spark, d):
    fields = ["begin", "end", "main_class", "sub_class", "score"]
    flat = _pairs(spark, d).select("doc", F.col("s.a.seq").alias("a_i"), F.col("s.b.seq").alias("b_i"), *[F.col(f"s.{x}.{f}").alias(f"{x}_{f}") for x in "ab" for f in fields])
    return _out(models.merge_models(flat, ["doc"]))


# --- rewriting ----------------------------------------------------------------
POLICY = {"DATE": {"DATE": "redact"}, "CONTACT": {"PHONE": "keep", "EMAIL": "replace"}, "NAME": {"STAFF": "redact"}}


def _rewritten(spark, d, policy, **options) -> DataFrame:
    return rewrite.deidentify(reports(spark, d), "doc", "text", detect.RADIOLOGY, policy, **options)


@query
def redact(spark, d):
    everything = {"DATE": {"DATE": "redact"}, "CONTACT": {"PHONE": "redact"}, "ID": {"PATIENTID": "redact", "STUDYID": "redact"}, "NAME": {"STAFF": "redact"}}
    return _rewritten(spark, d, everything)


@query
def replace_tags(spark, d):
    return _rewritten(spark, d, {}, only_superclass=True)


@query
def keep_all(spark, d):
    everything = {"DATE": {"DATE": "keep"}, "CONTACT": {"PHONE": "keep"}, "ID": {"PATIENTID": "keep", "STUDYID": "keep"}, "NAME": {"STAFF": "keep"}}
    return _rewritten(spark, d, everything)


@query
def show_original(spark, d):
    return _rewritten(spark, d, {}, show_original=True)


@query
def policy_lookup(spark, d):
    s = _spans(reports(spark, d), detect.RADIOLOGY)
    p = rewrite.policy_table(spark, POLICY)
    j = s.join(p, (F.upper("main_class") == F.col("policy_class")) & (F.upper("sub_class") == F.col("policy_sub")), "left")
    return j.groupBy("main_class", "sub_class", F.coalesce("method", F.lit("replace")).alias("method")).agg(F.count(F.lit(1)).alias("n"))


# --- dates: synthetic notes ------------------------------------------------------
def date_text(day: Column, k: Column) -> Column:
    """A date in one of several shapes, by the number ``k``."""
    month = F.element_at(F.array(*[F.lit(m) for m in dates.MONTHS]), F.month(day))
    f = lambda p: F.date_format(day, p)
    shapes = [f("dd.MM.yyyy"), f("d.M.yyyy"), f("yyyy-MM-dd"), f("dd.MM.yy"), f("dd.MM."), F.concat(f("d"), F.lit(". "), month, F.lit(" "), f("yyyy")), f("MM.yyyy"), f("d."), f("dd/MM/yyyy"), F.lit("kein Datum")]
    out = shapes[-1]
    for i, s in enumerate(shapes[:-1]):
        out = F.when(k == i, s).otherwise(out)
    return out


def _dates(spark, d) -> DataFrame:
    o = texts(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("doc"), F.col("o_custkey").alias("patient"), date_text(F.col("o_orderdate"), F.col("o_orderkey") % 10).alias("covered"), (F.col("o_orderkey") % 29 - 14).cast("int").alias("days"), (F.col("o_orderkey") % 5 - 2).cast("int").alias("years"))


@query
def infer_date_format(spark, d):
    return _dates(spark, d).groupBy(dates.infer_format(F.col("covered")).alias("format"), dates.keeps(F.col("covered")).alias("stays")).agg(F.count(F.lit(1)).alias("n"))


@query
def shift_dates(spark, d):
    return _dates(spark, d).select("doc", "covered", dates.shift_date(F.col("covered"), F.col("days"))["written"].alias("shifted"))


@query
def shift_birthdates(spark, d):
    """Birth dates in every shape; null where a year is missing or no date is there."""
    return _dates(spark, d).select("doc", "covered", dates.shift_birthdate(F.col("covered"), F.col("days"), F.col("years")).alias("shifted"))


@query
def shift_ages(spark, d):
    age = F.when(F.col("doc") % 7 == 0, F.concat((F.col("doc") % 90).cast("string"), F.lit(" Jahre"))).otherwise((F.col("doc") % 90).cast("string"))
    return _dates(spark, d).withColumn("age", age).select("doc", "age", dates.shift_age(F.col("age"), F.col("years")).alias("shifted"))


def offset_days(key: Column, low: int = -14, high: int = 14) -> Column:
    """A day offset by hash, never 0."""
    k = corpus.portable_hash(key) % (high - low)
    return F.when(k + low >= 0, k + low + 1).otherwise(k + low).cast("int")


def offset_years(key: Column) -> Column:
    k = corpus.portable_hash(F.concat(F.lit("y"), key.cast("string"))) % 4
    return F.element_at(F.array(*[F.lit(x) for x in (-2, -1, 1, 2)]), (k + 1).cast("int"))


@query
def offset_draw(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("patient"))
    return _out(c.select("patient", offset_days(F.col("patient")).alias("days"), offset_years(F.col("patient")).alias("years")))


@query
def offset_lookup(spark, d):
    """Offsets of a table, one per patient; a patient without any keeps its dates' tags.
    Every third customer's offset is null, as of a patient the table doesn't know."""
    offsets = table(spark, d, "customer").select(F.col("c_custkey").alias("patient"), F.when(F.col("c_custkey") % 3 != 0, offset_days(F.col("c_custkey"))).alias("offset_days")).groupBy("patient").agg(F.min("offset_days").alias("offset_days"))
    j = _dates(spark, d).select("doc", "patient", "covered").join(offsets, "patient", "left")
    s = F.struct(F.lit("Date").alias("main_class"), F.lit("DATE").alias("sub_class"))
    return j.select("doc", rewrite.replacement(s, F.col("covered"), F.lit("shift"), days=F.col("offset_days"), guard=False).alias("shifted"))


def _notes(spark, d) -> DataFrame:
    """Notes made from orders, customers and nations."""
    o, c, n = table(spark, d, "orders"), table(spark, d, "customer"), table(spark, d, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    k = F.col("o_orderkey")
    text = F.concat(
        F.lit("Institut für Pathologie\nEingang "), F.date_format("o_orderdate", "dd.MM.yyyy"), F.lit("\nBefundbericht\nFrau "), F.col("c_name"), F.lit(" aus "), F.col("n_name"), F.lit(", "),
        (k % 90).cast("string"), F.lit(" Jahre, Gewicht: "), (k % 60 + 40).cast("string"), F.lit(" kg, MELANO-"), (k % 9).cast("string"), F.lit(" Studie läuft. Ima "), (k % 7).cast("string"), F.lit("/"), (k % 12).cast("string"),
        F.lit(" Frau Dr Meier.\nKein Anhalt für Malignität. \nProf. Dr. Vogt\n"),
    )
    return j.select(k.alias("doc"), F.col("o_custkey").alias("patient"), text.alias("text"))


@query
def study_names(spark, d):
    s = _spans(_notes(spark, d), (detect.STUDY,)).join(_notes(spark, d).select("doc", "text"), "doc")
    f = models.study_span(F.col("text"), F.col("begin"), F.col("end"))
    return _out(s.select("doc", "begin", "end", f["begin"].alias("fixed_begin"), f["end"].alias("fixed_end")))


@query
def extend_titles(spark, d):
    n = _notes(spark, d)
    s = n.select("doc", "text", F.explode(find_spans(F.col("text"), r"Customer#[0-9]+|Meier")).alias("s")).select("doc", "text", "s.begin", "s.end", "s.covered")
    sup = models.suppressed(F.col("text"), F.col("begin"), F.col("end"))
    return _out(s.select("doc", "covered", "begin", models.extend_title(F.col("text"), F.col("begin"), F.col("end"), F.lit("Name")).alias("new_begin"), sup.alias("dropped")))


@query
def cut_letterhead(spark, d):
    n = _notes(spark, d)
    ann = _spans(n, detect.RADIOLOGY[:2] + (detect.POSTPROCESS[0],)).select("doc", "begin", "end", "main_class")
    docs, kept = letterhead.without_letterhead(n, ann, "doc", "text")
    return _out(docs.join(kept.groupBy("doc").agg(F.count(F.lit(1)).alias("n_kept"), F.min("begin").alias("first_begin")), "doc", "left").select("doc", "text", F.coalesce("n_kept", F.lit(0)).alias("n_kept"), "first_begin"))


# --- evaluation -------------------------------------------------------------------
def _matched(spark, d, level: int) -> DataFrame:
    """Two detector sets as gold and prediction; what both hold is found once."""
    n = len(detect.CONTACTS)
    df = detect.detect_arrays(reports(spark, d).select("doc", "text"), "text", detect.CONTACTS + detect.RADIOLOGY[:8], "rules")
    of = lambda ok: F.filter("spans", lambda s: ok(F.floor(s["seq"] / 1_000_000)))
    df = df.select("doc", of(lambda k: k < n + 6).alias("gold"), of(lambda k: k >= n).alias("pred"))
    return evaluate.matches_within(df, "doc", "gold", "pred", level)


@query
def strict_eval_summary(spark, d):
    return evaluate.strict_summary(_matched(spark, d, 2))


@query
def strict_eval_only_type(spark, d):
    return evaluate.strict_summary(_matched(spark, d, 1))


@query
def strict_eval_document(spark, d):
    docs = reports(spark, d).select("doc")
    return evaluate.strict_by_document(_matched(spark, d, 1), docs)


@query
def blindness_labels(spark, d):
    s = _spans(reports(spark, d), detect.CONTACTS + detect.RADIOLOGY)
    lv = s.select("main_class", "sub_class", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("level"))
    c = F.col
    lab = F.when(c("level") == 2, evaluate.blind(c("main_class"), c("sub_class"), 2)).when(c("level") == 1, evaluate.blind(c("main_class"), c("sub_class"), 1)).otherwise("REDACTED")
    return _out(lv.groupBy("level", lab.alias("label")).agg(F.count(F.lit(1)).alias("n")))


@query
def boxplot_stats(spark, d):
    m = strict_eval_document(spark, d).where("total_gt > 0").withColumn("method", F.when(F.col("eval_name") == "strict", "all").otherwise("class"))
    return evaluate.box_stats(m, ["method"], "f1")


# --- tokens and chunks ----------------------------------------------------------------
@query
def tokenize(spark, d):
    return _out(tokens.tokens(reports(spark, d), "doc", "text"))


@query
def subtokens_bio(spark, d):
    return _out(tokens.subtokens(reports(spark, d), "doc", "text").groupBy("doc").agg(F.count(F.lit(1)).alias("n"), F.sum("begin").alias("sum_begin"), F.max("end").alias("last_end")))


@query
def bio_labels(spark, d):
    return _out(tokens.bio_labels(rewrite.annotate(reports(spark, d).select("doc", "text"), "text", detect.CONTACTS + detect.RADIOLOGY), "doc", "text", "spans"))


@query
def chunk_ranges(spark, d):
    n = reports(spark, d).select("doc", F.size(F.regexp_extract_all("text", F.lit(r"[^\s]+"), F.lit(0))).alias("n"))
    return _out(n.select("doc", F.explode(tokens.chunk_ranges(F.col("n"), 50, 10)).alias("r")).select("doc", "r.part", "r.first", "r.last"))


@query
def chunk_rows(spark, d):
    c = tokens.chunks(reports(spark, d), "doc", "text", 50, 10)
    return _out(c.select("doc", "num_parts", "part_id", "part_start", "part_end", "text", F.size("tokens").alias("n_tokens")))


# --- corpus ---------------------------------------------------------------------------
@query
def dedup_keep_first(spark, d):
    r = table(spark, d, "radiology_df").where("status = 'final'").select("diagnostic_report_id", "report_row_id")
    return corpus.keep_first(r, ["diagnostic_report_id"], ["report_row_id"])


@query
def limit_annotated(spark, d):
    """The first 100 accepted reports (a top-n is what the operator does)."""
    r = table(spark, d, "radiology_df")
    return corpus.first_accepted(r, (F.col("status") == "final") & (F.length("text") >= 1000), ["report_row_id"], 100).select("report_row_id", F.length("text").cast("bigint").alias("n_chars"))


@query
def label_histogram(spark, d):
    return corpus.label_histogram(_spans(reports(spark, d), detect.CONTACTS + detect.RADIOLOGY))


def _patient_spans(spark, d) -> DataFrame:
    r = reports(spark, d)
    return _spans(r, detect.RADIOLOGY).join(r.select("doc", "per_number"), "doc").where("per_number is not null")


@query
def patients_per_label(spark, d):
    return corpus.patients_per_label(_patient_spans(spark, d), "per_number", "Date_DATE")


@query
def split_patients(spark, d):
    p = table(spark, d, "split_document").where("patient_id is not null").select("patient_id")
    return corpus.sample_patients(p, "patient_id", 80)


@query
def split_manifest(spark, d):
    s = table(spark, d, "split_document").where("patient_id is not null")
    return corpus.train_test(s.select("split_id", "document_type", "patient_id", "document_id"), split_patients(spark, d), "patient_id")


@query
def split_balanced(spark, d):
    """Label shares after greedy balancing; the loop sees one row per (patient,
    label), at most MAX_BALANCED of them."""
    spans = cut(_patient_spans(spark, d).select("per_number", "main_class", "sub_class"))
    train = cut(corpus.sample_patients(spans, "per_number", 80))
    kept = corpus.balanced_patients(spans, train, "per_number")
    return corpus.train_share(corpus.train_test(spans, kept, "per_number"))


# Spellings of the phases.
TRAIN, EVALUATION = ("train", "training"), ("validation", "val", "valid", "dev", "test", "testing")


@query
def leak_flag(spark, d):
    """Rows with a phase, with whether their patient_id also stands on the other side:
    training against all evaluation rows, whatever the spelling of the phase."""
    low = F.lower(F.regexp_replace("phase", r"(?U)^\s+|\s+$", ""))
    s = table(spark, d, "split_document").select("split_id", "patient_id", low.alias("phase"))
    train, test = (s.where(F.col("phase").isin(*names)).drop("phase") for names in (TRAIN, EVALUATION))
    return corpus.leak_flags(train, test, "patient_id")


@query
def patient_enrichment(spark, d):
    s, p = table(spark, d, "split_document"), table(spark, d, "patient_lookup").where("identifier_0_value is not null")
    return s.join(p.withColumnRenamed("id", "patient_id"), "patient_id", "left").select("split_id", "patient_id", F.col("identifier_0_value").alias("per_number"))


# --- scores ------------------------------------------------------------------------------
def _pieces(spark, d) -> DataFrame:
    """Score vectors of five classes: of the components of an embedding, each
    class has the largest of every fifth, so all of them count."""
    e = table(spark, d, "embeddings")
    of = lambda c: F.array_max(F.filter(F.transform("embedding", lambda x, i: F.when(i % 5 == c, F.abs(x).cast("double"))), lambda x: x.isNotNull()))
    return e.select(F.floor(F.col("vec_id") / 64).alias("doc"), F.floor(F.col("vec_id") / 4).alias("word"), "vec_id", F.array(*[of(c) for c in range(5)]).alias("scores"))


def _words(spark, d, strategy) -> DataFrame:
    return scores.words_from_pieces(_pieces(spark, d), ["doc", "word"], "vec_id", "scores", strategy)


@query
def word_aggregate_first(spark, d):
    return _out(_words(spark, d, "first"))


@query
def word_aggregate_max(spark, d):
    return _out(_words(spark, d, "max"))


@query
def word_aggregate_any_max(spark, d):
    return _out(_words(spark, d, "any_max"))


def _tagged(spark, d, strategy="max") -> DataFrame:
    names = F.array(*[F.lit(x) for x in ("O", "B-Date", "I-Date", "B-Name", "I-Name")])
    w = _words(spark, d, strategy)
    return w.select("doc", F.col("word").alias("pos"), F.element_at(names, F.col("idx") + 1).alias("tag"), (F.col("word") * 10).alias("begin"), (F.col("word") * 10 + 8).alias("end"), "score", F.lit("w").alias("word"))


@query
def group_entities(spark, d):
    return scores.group_entities(_tagged(spark, d), "doc", "pos", "tag").select("doc", "label", F.col("begin").alias("begin_pos"), F.col("end").alias("end_pos"), F.round("score", 6).alias("score"), "n_words")


@query
def seqeval_scores(spark, d):
    g, p = (evaluate.bio_entities(_tagged(spark, d, s), "doc", "pos", "tag") for s in ("max", "first"))
    return evaluate.strict_summary(evaluate.matches(g, p))


# --- statistics and similarity -----------------------------------------------------------------
@query
def document_metrics(spark, d):
    return textstats.document_metrics(reports(spark, d), "doc", "text")


@query
def corpus_metrics(spark, d):
    r = reports(spark, d)
    per = textstats.document_metrics(r, "doc", "text").join(r.select("doc", "modality"), "doc")
    return textstats.corpus_metrics(per, ["modality"])


@query
def line_cosine_pairs(spark, d):
    """Benchmark items and short texts made from supplier, the rows the SQL restates;
    ``line_cosine_texts`` compares the text tables."""
    b = table(spark, d, "benchmark").select(F.col("item_id").alias("doc"), "text")
    x = table(spark, d, "supplier").select((F.col("s_suppkey") + 1000000).alias("doc"), F.concat_ws("\n", F.element_at(F.split("s_name", "0"), -1), F.concat(F.lit("nation "), F.col("s_nationkey")), F.concat(F.lit("bal "), (F.col("s_acctbal") / 1000).cast("int"))).alias("text"))
    return similarity.line_cosine(b.unionByName(x), "doc", "text", 0.3).select("a", "b", F.round("cosine", 6).alias("cosine"))


TEXT_TABLES = (("benchmark", "item_id", "text"), ("documents", "doc_id", "text"), ("radiology_df", "report_row_id", "text"), ("resource", "resource_row_id", "valuestring"))


def _line_classes(spark, d) -> DataFrame:
    """Classes of all texts; the key is 4 x the row's id + the number of its table."""
    parts = [texts(spark, d, name).select((F.col(key).cast("bigint") * 4 + n).alias("doc"), F.col(text).alias("text")) for n, (name, key, text) in enumerate(TEXT_TABLES)]
    return similarity.line_classes(reduce(DataFrame.unionByName, parts), "doc", "text")


@query
def line_cosine_members(spark, d):
    """The class of every text with lines."""
    names = F.array(*[F.lit(t[0]) for t in TEXT_TABLES])
    return _line_classes(spark, d).select(F.element_at(names, (F.col("doc") % 4 + 1).cast("int")).alias("table_name"), F.floor(F.col("doc") / 4).alias("row_id"), F.col("class").alias("class_id"))


@query
def line_cosine_texts(spark, d):
    """Classes of all texts by common lines, each named by its smallest key."""
    return similarity.class_cosine(_line_classes(spark, d), "doc", 0.3).select("a", "b", F.round("cosine", 6).alias("cosine"))


@query
def distinct_selection(spark, d):
    r = reports(spark, d).where("modality is not null")
    return similarity.distinct_selection(r.select("modality", "doc", "text"), "modality", "doc", "text")


@query
def bundle_rewrite(spark, d):
    """Resources of a bundle with their text rewritten, those without a rewrite unchanged."""
    r = texts(spark, d, "resource").select("resource_row_id", "id", "resource_type", "valuestring")
    deid = rewrite.deidentify(r.where("valuestring is not null"), "resource_row_id", "valuestring", detect.CONTACTS, {})
    return r.drop("valuestring").join(deid, "resource_row_id", "left").select("resource_row_id", "id", F.col("deid_text").alias("valuestring"))


def queries() -> dict:
    """All queries; the modules of composed ones register theirs when they are imported."""
    from textveil.plans import composed, files  # noqa: F401

    return dict(Q)
