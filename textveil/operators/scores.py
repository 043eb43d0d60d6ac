"""Scores of sub-tokens to words, words to entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRATEGIES = ("none", "simple", "first", "average", "max", "any_max", "any_average", "any_first", "exact", "sentence_max", "sentence_average", "sentence_first")


def check_strategy(strategy: str, unfit: tuple[str, ...] = ()) -> None:
    """Raises where the name is unknown, or begins like one that does not fit."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy}")
    if strategy.startswith(unfit or ("\0",)):
        raise ValueError(f"{strategy} does not work on words; see token_scores and sentence_scores")


def argmax(row: Column) -> Column:
    """Place (from 0) of the largest score, the first of equals."""
    return (F.array_position(row, F.array_max(row)) - 1).cast("int")


def word_score(rows: Column, strategy: str, compat: bool = False) -> Column:
    """``struct<idx, score>`` of a word from the scores of its pieces.

    ``any_*``: where every piece says 0 the word is 0 with the mean score of 0;
    else only pieces that say something else count.  ``compat`` reads the score
    of ``any_max`` from the piece of the same number among all pieces.
    """
    check_strategy(strategy)
    kind = strategy.split("_")[-1]
    telling = F.filter(rows, lambda r: argmax(r) > 0)
    use = F.when(F.size(telling) > 0, telling).otherwise(rows) if strategy.startswith("any_") else rows
    if kind == "first":
        idx, score = argmax(use[0]), F.array_max(use[0])
    elif kind == "average":
        idx, score = argmax(_nan_mean(use)), F.array_max(_nan_mean(use))
    else:
        best = F.array_max(F.transform(use, lambda r: F.array_max(r)))
        row = F.array_position(F.transform(use, lambda r: F.array_max(r)), best)
        idx = argmax(F.element_at(use, row.cast("int")))
        score = F.element_at(F.element_at(rows if compat else use, row.cast("int")), idx + 1)
    if strategy.startswith("any_"):
        none = F.size(telling) == 0
        mean0 = F.aggregate(rows, F.lit(0.0), lambda a, r: a + r[0].cast("double")) / F.size(rows)
        return F.when(none, F.struct(F.lit(0).alias("idx"), mean0.alias("score"))).otherwise(F.struct(idx.alias("idx"), score.cast("double").alias("score")))
    return F.struct(idx.alias("idx"), score.cast("double").alias("score"))


def _nan_mean(rows: Column) -> Column:
    """Mean per class over the pieces whose score is a number."""
    at = F.sequence(F.lit(0), F.size(F.get(rows, F.lit(0))) - 1)

    def one(k: Column) -> Column:
        real = F.filter(F.transform(rows, lambda r: F.get(r, k).cast("double")), lambda x: ~F.isnan(x))
        return F.aggregate(real, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(real), F.lit(0))

    return F.transform(at, one)


def token_scores(pieces: DataFrame, keys: list[str], scores: str) -> DataFrame:
    """Strategies ``none``, ``simple`` and ``exact``: each piece by itself, ``keys, idx, score``."""
    return pieces.select(*keys, argmax(F.col(scores)).alias("idx"), F.array_max(scores).cast("double").alias("score"))


def sentence_scores(pieces: DataFrame, key: str, order: str, scores: str, labels: list[str], strategy: str, subword: str, compat: bool = False) -> DataFrame:
    """Strategies ``sentence_*``: runs of pieces that go on, scored as one word.

    A piece goes on where the piece before has its label and it is a sub-word,
    or both are I, or both are O; or where an I follows the B of its name.
    ``(key, first, last, idx, score)``; ``first`` and ``last`` are of ``order``.
    """
    w = Window.partitionBy(key).orderBy(order)
    name = F.get(F.array(*[F.lit(x) for x in labels]), argmax(F.col(scores)))
    df = pieces.select(key, order, scores, F.col(subword).alias("_sub"), name.alias("_l")).withColumn("_p", F.lag("_l").over(w))
    same = F.col("_l") == F.col("_p")
    goes_on = (same & (F.col("_sub") | F.col("_p").startswith("I-") | (F.col("_p") == "O"))) | (F.col("_p").startswith("B-") & (F.col("_l") == F.concat(F.lit("I-"), F.substring("_p", 3, 1_000_000))))
    df = df.withColumn("_g", F.sum((~F.coalesce(goes_on, F.lit(False))).cast("int")).over(w))
    runs = df.groupBy(key, "_g").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.transform(F.array_sort(F.collect_list(F.struct(order, scores))), lambda x: x[scores]).alias("rows"))
    return runs.select(key, "first", "last", word_score(F.col("rows"), strategy.split("_", 1)[1], compat).alias("w")).select(key, "first", "last", "w.idx", "w.score")


def words_from_pieces(pieces: DataFrame, keys: list[str], order: str, scores: str, strategy: str, compat: bool = False) -> DataFrame:
    """One row per word: ``keys, idx, score``.  ``pieces`` has a row per sub-token.

    Strategies that score single pieces or runs of words have functions of their own.
    """
    check_strategy(strategy, ("none", "simple", "exact", "sentence_"))
    rows = pieces.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, scores))), lambda x: x[scores]).alias("rows"))
    return rows.select(*keys, word_score(F.col("rows"), strategy, compat).alias("w")).select(*keys, "w.idx", "w.score")


def group_entities(words: DataFrame, key: str, order: str, tag: str, strategy: str = "first") -> DataFrame:
    """Consecutive words of one label become an entity.

    ``words`` has ``begin, end, score`` and a BIO tag.  A word joins the one
    before if both have one label and it doesn't begin anew (B).  ``exact``: it
    must be I, or a continuation piece (#) right behind.  ``sentence_*``: a
    single punctuation mark between two words of a label is bridged.  O makes
    no entity.  Columns: ``key, label, begin, end, score`` (mean), ``n_words``.
    """
    w = Window.partitionBy(key).orderBy(order)
    name = F.when(F.col(tag) == "O", F.lit(None)).otherwise(F.regexp_replace(tag, "^[BI]-", ""))
    df = words.withColumn("_l", name)
    if strategy.startswith("sentence"):
        between = F.col("_l").isNull() & F.col("word").rlike(r"^\p{Punct}$") & (F.lag("_l").over(w) == F.lead("_l").over(w)) & F.lead(tag).over(w).startswith("I-")
        df = df.withColumn("_l", F.when(between, F.lag("_l").over(w)).otherwise(F.col("_l"))).withColumn(tag, F.when(between, F.concat(F.lit("I-"), F.col("_l"))).otherwise(F.col(tag)))
    same = F.col("_l") == F.lag("_l").over(w)
    goes_on = same & ~F.col(tag).startswith("B-")
    if strategy == "exact":
        piece = F.col("word").contains("#") & (F.col("begin") == F.lag("end").over(w))
        goes_on = same & (F.col(tag).startswith("I-") | piece)
    starts = ~F.coalesce(goes_on, F.lit(False))
    numbered = df.withColumn("_s", starts.cast("int")).withColumn("_g", F.sum("_s").over(w)).where("_l is not null")
    out = numbered.groupBy(key, "_g").agg(F.first("_l").alias("label"), F.min("begin").alias("begin"), F.max("end").alias("end"), F.avg("score").alias("score"), F.count(F.lit(1)).alias("n_words"))
    return out.drop("_g")
