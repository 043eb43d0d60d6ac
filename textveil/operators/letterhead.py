"""Letterheads: find the spans of head, page breaks and tail; cut them out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textveil.functions.spans import _let, find_spans, touches


@dataclass(frozen=True)
class Letterhead:
    """Patterns of one kind of letter.  ``gate`` tells whether a text is one;
    ``kinds`` are headings of the body, the first that matches anywhere counts;
    ``finals`` are phrases behind which (``after``) or at which the tail begins;
    ``page_start`` and ``page_end`` enclose a page break."""

    gate: str
    kinds: tuple[str, ...]
    finals: tuple[tuple[str, bool], ...]
    page_start: str = r"(?:Name: Seite Eingang am:|Name: Seite Eingangsdatum:|Seite 1 von 2)"
    page_end: str = r"(?:\n(?:BarcodeDokumentNr)?\s+[A-Z][0-9]+/[0-9]+(?:\+[0-9]+)?\n|Seite 2 von 2)"


# Headings with which the body of a letter begins, in order of rank.
HEADINGS = (
    r"Korrekturbefund\n",
    r"Nachbericht:\n",
    r"Zytologischer Befundbericht\n",
    r"Befundbericht\n",
    r"Schnellschnittdiagnose(?: \(.*?\))?\n",
    r"Nachbericht mit Makroskopie\n",
    r"Nachbericht \(Korrekturbefund\):",
    r"Nachbericht \(nach Paraffineinbettung\):",
    r"[0-9]\.? Befundbericht",
    r"Untersuchter Block:\n",
    r"Sektionsbericht",
    r"Dermatopathologischer Beratungsfall\n",
    r"Neuropathologisch-autoptischer Befund",
    r"Dermatopathologischer Nachbericht\n",
    r"Dermatopathologisches Gutachten\n",
    r"Korrekturbefund \- Nachbericht\n",
    r"Korrekturbefund/Nachbericht\n",
    r"Klinische Angabe(?:n)?(?: \(.*?\))?:?\n",
    r"Schnellschnittgewebe zu .*?:\n",
    r"Makroskopie:\n",
)

DEFAULT = Letterhead(
    gate=r"Institut für (?:Pathologie und Neuropathologie|Pathologie|Neuropathologie|Radiologie)",
    kinds=HEADINGS,
    finals=((r"Kein Anhalt für Malignität.(?=\s*\n)", True), (r"\n(?=Univ\.|Prof\.|PD |Dr\.)", True)),
)


def letterhead_spans(text: Column, rules: Letterhead = DEFAULT) -> Column:
    """``array<struct<begin, end>>`` in order; empty where the text is no letter
    of this kind, or lacks a heading or a tail (instead of failing)."""
    return F.when(text.rlike(rules.gate), _spans_of_letter(text, rules)).otherwise(F.expr("cast(array() as array<struct<begin:int,end:int>>)"))


def _spans_of_letter(text: Column, rules: Letterhead) -> Column:
    n = F.length(text)
    none = F.expr("cast(array() as array<struct<begin:int,end:int>>)")
    # a heading is searched for only where the text has it
    heading = F.coalesce(*[F.when(text.rlike(k), F.try_element_at(find_spans(text, k), F.lit(1))) for k in rules.kinds])
    return _let(heading, lambda first: _around_body(text, rules, n, none, first))


def _around_body(text: Column, rules: Letterhead, n: Column, none: Column, first: Column) -> Column:
    lasts = [F.try_element_at(find_spans(text, p), F.lit(-1)) for p, _ in rules.finals]
    tail_at = F.coalesce(*[(s["end"] if after else s["begin"]) for s, (_, after) in zip(lasts, rules.finals)])
    head = F.struct(F.lit(0).alias("begin"), first["begin"].alias("end"))
    pos = lambda p, part, after: F.transform(F.filter(find_spans(text, p), lambda s: s[after] > first["begin"]), lambda s: s[part])
    pages = F.zip_with(pos(rules.page_start, "begin", "begin"), pos(rules.page_end, "end", "end"), lambda a, b: F.struct(a.cast("int").alias("begin"), b.cast("int").alias("end")))
    pages = F.filter(pages, lambda p: p["begin"].isNotNull() & p["end"].isNotNull() & (p["begin"] < p["end"]))
    body = F.concat(F.array(head), pages)
    end = F.element_at(body, -1)
    joined = F.concat(F.slice(body, 1, F.size(body) - 1), F.array(F.struct(F.least(end["begin"], tail_at).alias("begin"), n.alias("end"))))
    whole = F.when(touches(tail_at, n, end["begin"], end["end"]), joined).otherwise(F.concat(body, F.array(F.struct(tail_at.alias("begin"), n.alias("end")))))
    only_head = F.array(head)
    is_one = first.isNotNull()
    return F.when(is_one & (first["end"] == n), only_head).when(is_one & tail_at.isNotNull(), whole).otherwise(none)


def cut_spans(text: Column, spans: Column) -> Column:
    """The text without the spans (sorted, disjoint)."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("pos"))
    step = lambda acc, s: F.struct(F.concat(acc["out"], text.substr(acc["pos"] + 1, s["begin"] - acc["pos"])).alias("out"), s["end"].alias("pos"))
    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], text.substr(acc["pos"] + 1, F.length(text))))


def outside(spans: Column, begin: Column, end: Column) -> Column:
    """Whether an annotation touches none of the spans."""
    return ~F.exists(spans, lambda s: touches(s["begin"], s["end"], begin, end))


def moved_back(spans: Column, place: Column) -> Column:
    """A place in the text after the spans before it are cut out."""
    return place - F.aggregate(spans, F.lit(0), lambda acc, s: acc + F.when(s["end"] <= place, s["end"] - s["begin"]).otherwise(0))


def without_letterhead(docs: DataFrame, annotations: DataFrame, key: str, text: str, rules: Letterhead = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """``(docs, annotations)`` with letterheads cut out and places moved."""
    spans = docs.withColumn("_lh", letterhead_spans(F.col(text), rules))
    kept = annotations.join(spans.select(key, "_lh"), key).where(outside(F.col("_lh"), F.col("begin"), F.col("end")))
    kept = kept.withColumn("begin", moved_back(F.col("_lh"), F.col("begin"))).withColumn("end", moved_back(F.col("_lh"), F.col("end"))).drop("_lh")
    return spans.withColumn(text, cut_spans(F.col(text), F.col("_lh"))).drop("_lh"), kept
