"""Tokens, chunks and BIO labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textveil.functions.spans import find_spans, spread

#: A token of white-space tokenisation.
WORD = r"(?U)\S+"
SUBTOKEN = r"(?U)[\wäöüßÄÜÖ]+|[^\s\w]+"


def tokens(df: DataFrame, key: str, text: str, compat: bool = False) -> DataFrame:
    """White-space tokens ``(key, pos, begin, end, token)``.

    ``compat`` leaves out the last character of a text, as the original
    inference does; the default covers the whole text.
    """
    t = F.col(text).substr(F.lit(1), F.length(text) - 1) if compat else F.col(text)
    out = df.select(key, F.posexplode(find_spans(t, WORD)).alias("pos", "t"))
    return out.select(key, "pos", F.col("t.begin").alias("begin"), F.col("t.end").alias("end"), F.col("t.covered").alias("token"))


def subtokens(df: DataFrame, key: str, text: str) -> DataFrame:
    """Word and punctuation runs within the text: ``(key, pos, begin, end, token)``."""
    out = df.select(key, F.posexplode(find_spans(F.col(text), SUBTOKEN)).alias("pos", "t"))
    return out.select(key, "pos", F.col("t.begin").alias("begin"), F.col("t.end").alias("end"), F.col("t.covered").alias("token"))


def chunk_ranges(n: Column, size: int, overlap: int) -> Column:
    """``array<struct<part, first, last>>``: inclusive ranges of word numbers, widened on both sides."""
    parts = F.ceil(n / F.lit(size)).cast("int")
    at = F.when(parts > 0, F.sequence(F.lit(0), parts - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.transform(at, lambda i: F.struct(i.alias("part"), F.greatest(i * size - overlap, F.lit(0)).alias("first"), F.least((i + 1) * size + overlap, n - 1).cast("int").alias("last")))


def chunks(df: DataFrame, key: str, text: str, size: int = 50, overlap: int = 10) -> DataFrame:
    """Chunk rows: ``(key, num_parts, part_id, part_start, part_end, text, tokens)``.

    Within a row, so no shuffle; a text without tokens has no chunk.
    """
    if size <= 0 or overlap < 0:
        raise ValueError("size must be positive and overlap not negative")
    words = df.select(key, F.col(text).alias("fulltext"), find_spans(F.col(text), WORD).alias("w"))
    ranged = words.select(key, "fulltext", "w", F.ceil(F.size("w") / F.lit(size)).cast("int").alias("num_parts"), F.explode(chunk_ranges(F.size("w"), size, overlap)).alias("r"))
    first, last = F.element_at("w", F.col("r.first") + 1), F.element_at("w", F.col("r.last") + 1)
    return ranged.select(
        key,
        "num_parts",
        F.col("r.part").alias("part_id"),
        first["begin"].alias("part_start"),
        last["end"].alias("part_end"),
        F.col("fulltext").substr(first["begin"] + 1, last["end"] - first["begin"]).alias("text"),
        F.transform(F.slice("w", F.col("r.first") + 1, F.col("r.last") - F.col("r.first") + 1), lambda x: x["covered"]).alias("tokens"),
    )


def label_list(names: list[str]) -> list[str]:
    """O, then B- and I- of each name in order: B is odd, I even, O is 0."""
    return ["O", *(f"{p}-{n}" for n in sorted(names) for p in "BI")]


def labelled_tokens(text: Column, spans: Column) -> Column:
    """White-space tokens with BIO tags: ``array<struct<begin, end, token, label, name>>``.

    Text between annotations and the annotations themselves are tokenised one
    after the other, so tokens end at the edges of annotations; the first token
    of an annotation is B, the others I, those between are O (null ``name``).
    ``spans(begin, end, main_class, sub_class)`` must be disjoint and in order
    (resolve them first); a null text or array gives null.
    """

    def cut(b: Column, e: Column, name: Column) -> Column:
        label = lambda i: F.when(name.isNull(), "O").otherwise(F.concat(F.when(i == 0, "B-").otherwise("I-"), name))
        return F.transform(find_spans(text.substr(b + 1, e - b), WORD), lambda t, i: F.struct((b + t["begin"]).alias("begin"), (b + t["end"]).alias("end"), t["covered"].alias("token"), label(i).alias("label"), name.alias("name")))

    part = lambda b, e, name: F.struct(b.cast("int").alias("b"), e.cast("int").alias("e"), name.alias("name"))
    none = F.lit(None).cast("string")
    before = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    of = F.flatten(F.zip_with(F.slice(before, 1, F.size(spans)), spans, lambda b, s: F.array(part(b, s["begin"], none), part(s["begin"], s["end"], F.concat_ws("_", s["main_class"], s["sub_class"])))))
    parts = F.concat(of, F.array(part(F.element_at(before, -1), F.length(text), none)))
    return F.flatten(F.transform(parts, lambda p: cut(p["b"], p["e"], p["name"])))


def bio_labels(df: DataFrame, key: str, text: str, spans: str) -> DataFrame:
    """``(key, begin, end, token, label)``: a row per token of :func:`labelled_tokens`; no shuffle."""
    return spread(df.select(key, labelled_tokens(F.col(text), F.col(spans)).alias("t")), "t", key).select(key, "s.begin", "s.end", "s.token", "s.label")


def sub_labels(word: Column) -> Column:
    """A labelled token as its word and punctuation runs: the first keeps B, later ones are I."""
    tag = lambda i: F.when((i > 0) & word["label"].startswith("B-"), F.concat(F.lit("I-"), word["name"])).otherwise(word["label"])
    return F.transform(find_spans(word["token"], SUBTOKEN), lambda t, i: F.struct((word["begin"] + t["begin"]).alias("begin"), (word["begin"] + t["end"]).alias("end"), t["covered"].alias("token"), tag(i).alias("label"), word["name"].alias("name")))


def labelled_chunks(df: DataFrame, key: str, text: str, spans: str, size: int = 50, overlap: int = 10, subwords: bool = False) -> DataFrame:
    """Dataset rows: ``(key, num_parts, part_id, part_start, part_end, text,
    fulltext, tokens, tags_superclass, tags_subclass)``.

    Chunks are ranges of :func:`labelled_tokens`, cut within the row.  The
    superclass of a tag is what stands before its underscore.  With ``subwords``
    tokens and tags are those of the sub-tokens of the chunk's words.
    """
    if size <= 0 or overlap < 0:
        raise ValueError("size must be positive and overlap not negative")
    words = df.select(key, F.col(text).alias("fulltext"), labelled_tokens(F.col(text), F.col(spans)).alias("w"))
    ranged = words.select(key, "fulltext", "w", F.ceil(F.size("w") / F.lit(size)).cast("int").alias("num_parts"), chunk_ranges(F.size("w"), size, overlap).alias("_r"))
    c = spread(ranged, "_r", key, "fulltext", "w", "num_parts").withColumn("_w", F.slice("w", F.col("s.first") + 1, F.col("s.last") - F.col("s.first") + 1))
    first, last = F.element_at("_w", 1), F.element_at("_w", -1)
    own = F.flatten(F.transform("_w", sub_labels)) if subwords else F.col("_w")
    c = c.select(key, "num_parts", F.col("s.part").alias("part_id"), first["begin"].alias("part_start"), last["end"].alias("part_end"), "fulltext", own.alias("_w"))
    return c.select(
        key, "num_parts", "part_id", "part_start", "part_end",
        F.col("fulltext").substr(F.col("part_start") + 1, F.col("part_end") - F.col("part_start")).alias("text"), "fulltext",
        F.transform("_w", lambda t: t["token"]).alias("tokens"),
        F.transform("_w", lambda t: F.regexp_replace(t["label"], "_.*$", "")).alias("tags_superclass"),
        F.transform("_w", lambda t: t["label"]).alias("tags_subclass"),
    )


def align_subword_labels(labels: Column, word_ids: Column, label_all: bool = True) -> Column:
    """Labels of sub-words: -100 for special pieces (null word id), the word's
    label for its first piece, for others the same or -100."""
    n = F.size(word_ids)
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("cast(array() as array<int>)"))

    def one(i: Column) -> Column:
        w = F.get(word_ids, i)
        before = F.get(word_ids, i - 1)
        first = (i == 0) | before.isNull() | (before != w)
        return F.when(w.isNull(), -100).when(first | F.lit(label_all), F.get(labels, w)).otherwise(-100)

    return F.transform(at, one)


def masked(labels: Column, predictions: Column) -> Column:
    """Pairs of label and prediction where the label counts (is above -100)."""
    return F.filter(F.arrays_zip(labels.alias("label"), predictions.alias("pred")), lambda x: x["label"] > -100)


def names_of(ids: Column, names: list[str]) -> Column:
    """Label numbers as their names; null for a number without one."""
    return F.transform(ids, lambda i: F.get(F.array(*[F.lit(n) for n in names]), i))


def islands(df: DataFrame, key: str, order: str, tag: str, breaks: Column) -> DataFrame:
    """``df`` with ``island``: the running number of groups, a new one where ``breaks`` holds."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn("_b", F.coalesce(breaks, F.lit(True)).cast("int")).withColumn("island", F.sum("_b").over(w)).drop("_b")
