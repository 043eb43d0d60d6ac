"""Two models' predictions matched, merged and cleaned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textveil.functions.spans import _let, find_spans, touches
from textveil.operators.detect import IMAGE

# Forms of address that a name takes in, and study words that are none.
PREFIXES = ["Ehefrau", "Ehemann", "Herrn", "Herr", "Frau", "Dr", "Prog"]
SKIP_STUDIES = [
    "PET", "MRT", "CT", "PET/MRT", "PET/CT", "PET-MRT", "PET-CT", "Platform", "I", "1", "Phase-I", "Phase-1", "II", "2", "Phase-II", "Phase-2", "III", "3", "Phase-III", "Phase-3",
    "der", "die", "das", "des", "einer", "ein", "eines", "eine", "adjuvante", "andere", "beiden", "bzgl", "durch", "multizentrische", "monozentrische", "multicentrische", "monocentrische",
    "für", "in", "keine", "klinischen", "Klinische", "lehnt", "nicht-interventionelle", "randomisierte", "Einschluss", "Oder",
]


def match_outer(sup: DataFrame, sub: DataFrame, keys: list[str]) -> DataFrame:
    """All touching pairs of a class and a subclass prediction, then those alone.

    Both sides have ``begin, end, main_class, sub_class, score`` and a number
    ``i``; the result prefixes them with ``a_`` and ``b_`` (null where alone).
    """
    fields = ["i", "begin", "end", "main_class", "sub_class", "score"]
    a = sup.select(*keys, *[F.col(f).alias(f"a_{f}") for f in fields])
    b = sub.select(*keys, *[F.col(f).alias(f"b_{f}") for f in fields])
    on = touches(F.col("a_begin"), F.col("a_end"), F.col("b_begin"), F.col("b_end"))
    pairs = a.join(b, keys).where(on)
    alone_a = a.join(pairs.select(*keys, "a_i").distinct(), [*keys, "a_i"], "left_anti").select(*keys, *[f"a_{f}" for f in fields], *[F.lit(None).cast(b.schema[f"b_{f}"].dataType).alias(f"b_{f}") for f in fields])
    alone_b = b.join(pairs.select(*keys, "b_i").distinct(), [*keys, "b_i"], "left_anti").select(*keys, *[F.lit(None).cast(a.schema[f"a_{f}"].dataType).alias(f"a_{f}") for f in fields], *[f"b_{f}" for f in fields])
    return pairs.select(alone_a.columns).unionByName(alone_a).unionByName(alone_b)


def merge_models(matched: DataFrame, keys: list[str]) -> DataFrame:
    """One annotation per match: agreement takes the subclass and the hull; a lone
    class prediction stays without subclass; all else is Other with score 0."""
    both = F.col("a_i").isNotNull() & F.col("b_i").isNotNull() & (F.col("a_main_class") == F.col("b_main_class"))
    lone = F.col("b_i").isNull()
    pick = lambda x, y, z: F.when(both, x).when(lone, y).otherwise(z)
    return matched.select(
        *keys,
        F.least("a_begin", "b_begin").alias("begin"),
        F.greatest("a_end", "b_end").alias("end"),
        pick(F.col("a_main_class"), F.col("a_main_class"), F.lit("Other")).alias("main_class"),
        pick(F.col("b_sub_class"), F.lit(""), F.lit("")).alias("sub_class"),
        pick(F.col("b_score"), F.col("a_score"), F.lit(0.0)).alias("score"),
        pick(F.lit("both-models-agree"), F.lit("supermodel-vs-submodel"), F.lit("submodel-vs-supermodel")).alias("source"),
    )


def suppressed(text: Column, begin: Column, end: Column, compat: bool = False) -> Column:
    """Whether a finding is dropped: it is a bare form of address, or within an
    image reference.  ``compat`` drops only what is both."""
    lo = F.greatest(begin - 6, F.lit(0))
    image = text.substr(lo + 1, end - lo).rlike(IMAGE)
    bare = text.substr(begin + 1, end - begin).isin(PREFIXES)
    return (image & bare) if compat else (image | bare)


def extend_title(text: Column, begin: Column, end: Column, main_class: Column) -> Column:
    """The begin of a name, moved over the form of address right before it."""
    name = text.substr(begin + 1, end - begin)
    lo = F.greatest(begin - 10, F.lit(0))
    window = text.substr(lo + 1, end - lo)
    pattern = F.concat(F.lit(rf"(?i)((?:{'|'.join(PREFIXES)})\s\Q"), F.replace(name, F.lit("\\E"), F.lit("")), F.lit(r"\E)\z"))
    got = F.length(F.call_function("regexp_extract", window, pattern, F.lit(1)))
    return F.when(main_class.contains("Name") & (got > 0), end - got).otherwise(begin)


def study_span(text: Column, begin: Column, end: Column) -> Column:
    """``struct<begin, end>`` of a study name, null where the word is none: digits
    take in the word before; a hyphen right behind takes a character off."""
    word = text.substr(begin + 1, end - begin)
    before = F.regexp_extract(text.substr(F.lit(1), begin - 1), r"(\S*)$", 1)
    wider = word.rlike(r"^\d+$") | (word == "Lung")
    lo = F.when(wider, begin - F.length(before) - 1).otherwise(begin)
    skip = word.isin(SKIP_STUDIES) | (wider & before.isin(SKIP_STUDIES))
    hi = F.when(text.substr(end + 1, F.lit(1)) == "-", end - 1).otherwise(end)
    return F.when(~skip, F.struct(F.greatest(lo, F.lit(0)).alias("begin"), hi.alias("end")))


def match_arrays(sup: Column, sub: Column) -> Column:
    """As :func:`match_outer` for the span arrays of one row: ``array<struct<a, b>>``.

    In order: each span of ``sup`` with all of ``sub`` it touches, then the spans
    of ``sup`` alone, then those of ``sub`` alone (their other side is null).
    """
    touch = lambda a, b: touches(a["begin"], a["end"], b["begin"], b["end"])
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    no_sup = F.get(sup, F.lit(-1))
    no_sub = F.get(sub, F.lit(-1))
    pairs = F.flatten(F.transform(sup, lambda a: F.transform(F.filter(sub, lambda b: touch(a, b)), lambda b: pair(a, b))))
    alone_a = F.transform(F.filter(sup, lambda a: ~F.exists(sub, lambda b: touch(a, b))), lambda a: pair(a, no_sub))
    alone_b = F.transform(F.filter(sub, lambda b: ~F.exists(sup, lambda a: touch(a, b))), lambda b: pair(no_sup, b))
    return F.concat(pairs, alone_a, alone_b)


def split_staff(covered: Column) -> Column:
    """The ``X. Surname`` parts of a run of staff names."""
    return find_spans(covered, r"[A-ZÖÄÜ]\.\s[A-ZÖÄÜ][a-zöäüß]+")


def trim_span(covered: Column, begin: Column, end: Column) -> Column:
    """``struct<begin, end>`` without spaces at either end."""
    left = F.length(covered) - F.length(F.regexp_replace(covered, "^ +", ""))
    right = F.length(covered) - F.length(F.regexp_replace(covered, " +$", ""))
    return F.when(covered.rlike("[^ ]"), F.struct((begin + left).alias("begin"), (end - right).alias("end"))).otherwise(F.struct(begin.alias("begin"), begin.alias("end")))


def clean_spans(text: Column, spans: Column) -> Column:
    """Rule spans of a text as the radiology set is applied: spaces trimmed, study
    names fixed or dropped, runs of staff split into ``X. Surname`` parts (a run
    without any gives none).

    The parts take the place of their run: ``seq`` is spread and counts up in order.
    """

    def parts(s: Column, t: Column) -> Column:
        b, e = t["begin"], t["end"]
        one = lambda b, e: F.array(F.struct(b.cast("int").alias("begin"), e.cast("int").alias("end")))
        names = F.transform(split_staff(text.substr(b + 1, e - b)), lambda x: F.struct((b + x["begin"]).cast("int").alias("begin"), (b + x["end"]).cast("int").alias("end")))
        study = lambda x: F.when(x.isNotNull(), one(x["begin"], x["end"])).otherwise(F.expr("cast(array() as array<struct<begin:int,end:int>>)"))
        return F.when(s["sub_class"] == "STAFF", names).when(s["sub_class"] == "STUDYID", _let(study_span(text, b, e), study)).otherwise(one(b, e))

    def cleaned(s: Column) -> Column:
        covered = text.substr(s["begin"] + 1, s["end"] - s["begin"])
        return F.transform(
            _let(trim_span(covered, s["begin"], s["end"]), lambda t: parts(s, t)),
            lambda p, i: F.struct((s["seq"] * 1_000_000 + i).alias("seq"), p["begin"].alias("begin"), p["end"].alias("end"), s["main_class"].alias("main_class"), s["sub_class"].alias("sub_class"), s["score"].alias("score"), s["source"].alias("source")),
        )

    return F.flatten(F.transform(spans, cleaned))
