"""Counts of tokens, sentences and characters per document and corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SENTENCE_END = r"[.!?]+(?:\s|$)"


def document_metrics(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, tokens, sentences, characters, word_chars, mean_word_length, mean_sentence_length)``.

    Tokens are runs of non-blanks; sentences end at a stop followed by a blank
    or the end; a text with tokens has at least one.
    """
    words = F.regexp_extract_all(F.col(text), F.lit(r"[^\s]+"), F.lit(0))
    d = df.select(key, F.size(words).cast("bigint").alias("tokens"), F.size(F.regexp_extract_all(F.col(text), F.lit(SENTENCE_END), F.lit(0))).cast("bigint").alias("ends"), F.length(text).cast("bigint").alias("characters"), F.aggregate(words, F.lit(0).cast("bigint"), lambda a, w: a + F.length(w)).alias("word_chars"))
    d = d.withColumn("sentences", F.when(F.col("tokens") > 0, F.greatest("ends", F.lit(1).cast("bigint"))).otherwise(F.lit(0).cast("bigint"))).drop("ends")
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return d.withColumn("mean_word_length", ratio("word_chars", "tokens")).withColumn("mean_sentence_length", ratio("tokens", "sentences"))


def corpus_metrics(per_doc: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sums over documents, and means weighted by tokens and sentences."""
    return per_doc.groupBy(*(by or [])).agg(
        F.sum("tokens").alias("tokens"), F.sum("sentences").alias("sentences"), F.sum("characters").alias("characters"),
        (F.sum("word_chars") / F.sum("tokens")).alias("mean_word_length"),
        (F.sum(F.col("sentences") * F.col("mean_sentence_length")) / F.sum("sentences")).alias("mean_sentence_length"),
    )
