"""The pN_ queries: each runs its operator over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textveil.llm import leakage, mixing, overlap, personal, pieces, reading, sentences, splits, survivors
from textveil.llm.keys import table


def _persons(spark: SparkSession, d: str) -> DataFrame:
    return splits.persons(table(spark, d, "split_document"), table(spark, d, "patient_lookup"), table(spark, d, "resource_mapping"))[0]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_conflicts(_persons(spark, d))


def p1_assign(spark: SparkSession, d: str) -> DataFrame:
    return splits.assign_splits(_persons(spark, d)).select("split_id", "person_no", "new_phase", "state")


def p1_batches(spark: SparkSession, d: str) -> DataFrame:
    """Two deliveries by added_at (rows without a time come second), the second with
    the component table and phases of the first: rows per state, persons in more
    than one phase, persons of one phase that were moved."""
    rows = table(spark, d, "split_document")
    middle = rows.agg(F.expr("percentile_approx(added_at, 0.5)").alias("t"))
    first = rows.join(F.broadcast(middle), F.col("added_at") <= F.col("t")).drop("t")  # one row
    return splits.run_batches([first, rows], table(spark, d, "patient_lookup"), table(spark, d, "resource_mapping")).select("split_id", "person_no", "new_phase", "state")


def p1_check(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of p1_assign: every row once, no person in two phases, persons
    delivered in one phase kept there."""
    a = splits.assign_splits(_persons(spark, d))
    per = a.groupBy("root").agg(F.countDistinct("new_phase").alias("n_new"), F.countDistinct("phase").alias("n_old"), F.min("phase").alias("was"), F.min("new_phase").alias("new"), F.count(F.lit(1)).alias("n"))
    bad = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    return per.agg(F.sum("n").alias("n_rows"), bad(F.col("n_new") != 1).alias("n_torn"), bad((F.col("n_old") == 1) & (F.col("was") != F.col("new"))).alias("n_moved"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.survivors(table(spark, d, "radiology_df")).select("report_id", "report_row_id")


def p5_records(spark: SparkSession, d: str) -> DataFrame:
    return survivors.fuse(table(spark, d, "radiology_df"))


def p6_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.split_texts(table(spark, d, "radiology_df"), "report_row_id", "text")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_pieces(spark, d).where("piece_no = 0").select("report_row_id")


def p6_tokens(spark: SparkSession, d: str) -> DataFrame:
    """The same texts in pieces of at most 512 tokens of a public tokenizer, 48 of them repeated."""
    return pieces.split_texts(table(spark, d, "radiology_df"), "report_row_id", "text", 512, 48, spark.conf.get("textveil.vocabulary", mixing.VOCABULARY))


def p6_check(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of p6_pieces, per text: cover, limit, overlap."""
    w = Window.partitionBy("report_row_id").orderBy("piece_no")
    p = p6_pieces(spark, d).withColumn("before", F.lag("end_pos").over(w))
    return p.groupBy("report_row_id").agg(
        F.min("begin_pos").cast("bigint").alias("first"), F.max("end_pos").cast("bigint").alias("last"), (F.max(F.col("end_pos") - F.col("begin_pos")) <= 2500).alias("fits"),
        F.coalesce(F.max(F.col("before") - F.col("begin_pos")) <= 200, F.lit(True)).alias("overlap_fits"), F.coalesce(F.min(F.col("before") - F.col("begin_pos")) >= 0, F.lit(True)).alias("no_gap"),
    )


def p2_check(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of p2_found, per text: units in order, all but white space covered."""
    r = table(spark, d, "radiology_df")
    u = p2_found(spark, d).join(r.select("report_row_id", "text"), "report_row_id")
    bare = F.length(F.regexp_replace(F.col("text").substr(F.col("begin_pos") + 1, F.col("end_pos") - F.col("begin_pos")), r"(?U)\s", ""))
    w = Window.partitionBy("report_row_id").orderBy("begin_pos")
    u = u.withColumn("bare", bare).withColumn("before", F.lag("end_pos").over(w))
    return u.groupBy("report_row_id").agg(F.sum("bare").alias("n_chars"), F.coalesce(F.min(F.col("begin_pos") - F.col("before")) >= 0, F.lit(True)).alias("apart"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentence_units(table(spark, d, "radiology_df"), "report_row_id", "text")


def _notes(spark: SparkSession, d: str) -> DataFrame:
    return personal.texts_of((table(spark, d, "radiology_df"), "radiology_df", "report_row_id", "text"), (table(spark, d, "resource"), "resource", "resource_row_id", "valuestring"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return personal.find_mentions(_notes(spark, d))


def p4_redacted(spark: SparkSession, d: str) -> DataFrame:
    return personal.redact(_notes(spark, d))


def p7_leaked(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked(table(spark, d, "documents"), table(spark, d, "benchmark"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    found = leakage.leaked(table(spark, d, "documents"), table(spark, d, "benchmark"), passages=True)
    return found.where(F.col("longest_run") >= leakage.PASSAGE).select("doc_id", "item_id")


def _overlaps(spark: SparkSession, d: str) -> overlap.Overlaps:
    return overlap.overlaps(table(spark, d, "split_document"), table(spark, d, "resource"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _overlaps(spark, d).pairs().select(F.least("train_id", "eval_id").alias("split_id_a"), F.greatest("train_id", "eval_id").alias("split_id_b")).distinct()


def p3_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Each row with a phase and text: its class, and its links to the other side."""
    return _overlaps(spark, d).links()


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Overlaps counted per phase and document_type of the evaluation rows."""
    return _overlaps(spark, d).report()


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_target"))[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_target"))[1]


def p8_entropy(spark: SparkSession, d: str) -> DataFrame:
    """Natural shares tempered to the entropy of the target shares."""
    targets = table(spark, d, "mix_target")
    goal = {r["source"]: r["target_share"] for r in targets.where("target_share > 0").collect()}  # at most mixing.MAX_SOURCES
    return mixing.mix(table(spark, d, "documents"), targets, nats=mixing.entropy(goal))[1]


def p8_stretched(spark: SparkSession, d: str) -> DataFrame:
    """Target shares tempered by a budget half as large again as the repetition limits allow."""
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_target"), stretch=1.5)[1]


def p8_check(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of p8_mix: shares near their targets, where all sources with
    texts get their part of what those without leave; no text used too often."""
    chosen, shares = mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_target"))
    have = shares.where("source_tokens > 0 and max_repeats > 0").agg(F.sum("target_share").alias("z"))
    goal = F.when((F.col("source_tokens") > 0) & (F.col("max_repeats") > 0), F.col("target_share") / F.col("z")).otherwise(0.0)
    most = chosen.groupBy("source").agg(F.max("repetitions").alias("most"))
    s = shares.join(most, "source", "left").crossJoin(F.broadcast(have))  # one row
    return s.select("source", (F.abs(F.col("reached_share") - goal) <= 0.02).alias("near"), (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("within"))


def p9_levels(spark: SparkSession, d: str) -> DataFrame:
    return reading.reading_levels(table(spark, d, "documents"), table(spark, d, "reading_label"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_levels(spark, d).select("doc_id", "reading_level")


def p9_profile(spark: SparkSession, d: str) -> DataFrame:
    return reading.source_profile(table(spark, d, "documents"), p9_levels(spark, d))


def oracle_sql() -> dict[str, str]:
    from textveil.llm import oracles

    return oracles.oracle_sql()


def queries() -> dict:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1:2].isdigit()}
