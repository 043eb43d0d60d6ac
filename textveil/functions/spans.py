"""Spans of text as Column expressions.

A span is ``struct<begin int, end int, ...>`` in code points, half open.  All
expressions stay in the JVM; positions are sums of lengths, never instr.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def find_spans(text: Column, pattern: str, head: str = "", tail: str = "") -> Column:
    """All matches of a Java pattern, left to right: ``array<struct<begin, end, covered>>``.

    ``head`` and ``tail`` are patterns of what a match holds before and after
    the wanted part (a capture group, in other words); they are cut off.
    """
    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda matches: F.when(F.size(matches) > 0, _place(text, matches, pattern, head, tail)).otherwise(F.expr("cast(array() as array<struct<begin:int,end:int,covered:string>>)")))


def quoted(s: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def find_spans_sql(text: str, pattern: str, head: str = "", tail: str = "") -> str:
    """:func:`find_spans` of a named column as one SQL expression: parsed at once,
    where a Column built call by call costs a fifth of a second on the driver."""
    p = quoted(pattern)
    h = f"length(regexp_extract(x.m, {quoted(f'^(?:{head})')}, 0))" if head else "0"
    t = f"length(regexp_extract(x.m, {quoted(f'(?:{tail})$')}, 0))" if tail else "0"
    core = f"substr(x.m, {h} + 1, x.n - {h} - {t})" if head or tail else "x.m"
    pairs = f"zip_with(transform(slice(split({text}, {p}, -1), 1, size(mm)), g -> length(g)), mm, (g, m) -> named_struct('g', g, 'n', length(m), 'm', m))"
    places = "split(aggregate(ps, named_struct('v', 0, 's', ''), (acc, x) -> named_struct('v', acc.v + x.g + x.n, 's', concat(acc.s, cast(acc.v as string), ' ')), acc -> acc.s), ' ', -1)"
    span = f"named_struct('begin', cast(p as int) + x.g + {h}, 'end', cast(p as int) + x.g + x.n - {t}, 'covered', {core})"
    placed = f"transform(array({pairs}), ps -> zip_with(slice({places}, 1, size(ps)), ps, (p, x) -> {span}))[0]"
    return f"transform(array(regexp_extract_all({text}, {p}, 0)), mm -> case when size(mm) > 0 then {placed} else {NO_SPANS} end)[0]"


#: An empty array of found spans.
NO_SPANS = "cast(array() as array<struct<begin:int,end:int,covered:string>>)"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _running(items: Column, step) -> Column:
    """The state before each item, as ``array<string>``.

    The states are strung together and split again: an accumulator that grows
    by an array element a step would be copied, struct by struct, at each.
    """
    start = F.struct(F.lit(0).alias("v"), F.lit("").alias("s"))
    walk = lambda acc, x: F.struct(step(acc["v"], x).alias("v"), F.concat(acc["s"], acc["v"].cast("string"), F.lit(" ")).alias("s"))
    return F.split(F.aggregate(items, start, walk, lambda acc: acc["s"]), " ", -1)


def _place(text: Column, matches: Column, pattern: str, head: str, tail: str) -> Column:
    lengths = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(matches)), lambda g: F.length(g))
    pairs = F.zip_with(lengths, matches, lambda g, m: F.struct(g.alias("g"), F.length(m).alias("n"), m.alias("m")))

    def span(p: Column, x: Column) -> Column:
        lo, m = p.cast("int") + x["g"], x["m"]
        cut_head = F.length(F.regexp_extract(m, f"^(?:{head})", 0)) if head else F.lit(0)
        cut_tail = F.length(F.regexp_extract(m, f"(?:{tail})$", 0)) if tail else F.lit(0)
        core = m.substr(cut_head + 1, x["n"] - cut_head - cut_tail) if head or tail else m
        return F.struct((lo + cut_head).alias("begin"), (lo + x["n"] - cut_tail).alias("end"), core.alias("covered"))

    return _let(pairs, lambda ps: F.zip_with(F.slice(_running(ps, lambda pos, x: pos + x["g"] + x["n"]), 1, F.size(ps)), ps, span))


def overlaps(b1: Column, e1: Column, b2: Column, e2: Column) -> Column:
    """Strict overlap of half-open spans."""
    return (e1 > b2) & (b1 < e2)


def touches(b1: Column, e1: Column, b2: Column, e2: Column) -> Column:
    """The wider test used between models: a span of length 1 next to another touches it."""
    return ((b1 <= b2) & (b2 < e1)) | ((b1 <= e2 - 1) & (e2 - 1 <= e1)) | ((b2 <= b1) & (b1 < e2)) | ((b2 <= e1 - 1) & (e1 - 1 <= e2))


_FIELDS = "struct<seq:bigint,begin:int,end:int,main_class:string,sub_class:string,score:double,source:string>"


def fold_longest(spans: Column) -> Column:
    """Greedy clash resolution in order of ``seq``: the longest of a new span and
    those it overlaps stays, a tie goes to the new one; all it overlaps leave."""

    def step(acc: Column, x: Column) -> Column:
        clash = F.filter(acc, lambda s: overlaps(s["begin"], s["end"], x["begin"], x["end"]))
        winner = F.aggregate(clash, x, lambda cur, s: F.when(s["end"] - s["begin"] > cur["end"] - cur["begin"], s).otherwise(cur))
        rest = F.filter(acc, lambda s: ~overlaps(s["begin"], s["end"], x["begin"], x["end"]))
        return F.array_sort(F.concat(rest, F.array(winner)), _by_place)

    return _fold_clashing(spans, step)


def fold_merge(spans: Column, source: str = "Merge overlapping entities") -> Column:
    """Greedy merge in order of ``seq``: a new span and all it overlaps become
    their hull, with class, subclass and score of the last of these by place."""

    def step(acc: Column, x: Column) -> Column:
        clash = F.filter(acc, lambda s: overlaps(s["begin"], s["end"], x["begin"], x["end"]))
        rest = F.filter(acc, lambda s: ~overlaps(s["begin"], s["end"], x["begin"], x["end"]))
        lo = F.least(x["begin"], F.array_min(F.transform(clash, lambda s: s["begin"])))
        hi = F.greatest(x["end"], F.array_max(F.transform(clash, lambda s: s["end"])))
        last = F.element_at(clash, -1)
        hull = F.struct(x["seq"].alias("seq"), lo.alias("begin"), hi.alias("end"), last["main_class"].alias("main_class"), last["sub_class"].alias("sub_class"), last["score"].alias("score"), F.lit(source).alias("source"))
        return F.array_sort(F.concat(rest, F.array(F.when(F.size(clash) == 0, x).otherwise(hull))), _by_place)

    return _fold_clashing(spans, step)


def _fold_clashing(spans: Column, step) -> Column:
    """The fold over the spans that overlap another; those alone stay as they are.

    A span alone never takes part in a clash, so leaving it out changes nothing,
    and the fold, quadratic in what it keeps, sees few spans.
    """
    placed = F.transform(spans, lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end"), s.alias("s")))

    def split_up(items: Column) -> Column:
        before = _running(items, lambda top, x: F.greatest(top, x["end"]))
        after = F.concat(F.transform(F.slice(items, 2, F.size(items)), lambda x: x["begin"]), F.array(F.lit(2147483647)))
        alone = F.zip_with(F.slice(before, 1, F.size(items)), F.zip_with(items, after, lambda x, n: F.struct(x["s"].alias("s"), n.alias("n"))), lambda m, x: F.struct(((m.cast("int") <= x["s"]["begin"]) & (x["n"] >= x["s"]["end"])).alias("alone"), x["s"].alias("s")))
        pick = lambda rows, yes: F.transform(F.filter(rows, lambda x: x["alone"] == yes), lambda x: x["s"])
        folded = lambda rows: F.aggregate(F.array_sort(pick(rows, False)), F.expr(f"cast(array() as array<{_FIELDS}>)"), step)
        by_place = lambda arr: F.transform(F.array_sort(F.transform(arr, lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end"), s.alias("s")))), lambda x: x["s"])
        return _let(alone, lambda rows: F.when(F.exists(rows, lambda x: ~x["alone"]), by_place(F.concat(pick(rows, True), folded(rows)))).otherwise(pick(rows, True)))

    none = F.expr(f"cast(array() as array<{_FIELDS}>)")
    return F.when(F.size(spans) > 0, _let(F.array_sort(placed), split_up)).when(spans.isNotNull(), none)


def _by_place(a: Column, b: Column) -> Column:
    less = (a["begin"] < b["begin"]) | ((a["begin"] == b["begin"]) & (a["end"] < b["end"]))
    same = (a["begin"] == b["begin"]) & (a["end"] == b["end"])
    return F.when(same, 0).when(less, -1).otherwise(1)


def stitch(text: Column, parts: Column) -> Column:
    """The text with each span of ``parts(begin, end, sub)`` replaced by ``sub``.

    Parts must be sorted by (begin, end).  What a nested span would re-emit is
    left out: the place never moves back.  Gaps are cut out one by one and joined
    once, so the text that is already written is never copied again.
    """

    def joined(ps: Column) -> Column:
        places = _running(ps, lambda pos, x: F.greatest(pos, x["end"]))
        gap = lambda pos, x: F.when(x["begin"] > pos.cast("int"), text.substr(pos.cast("int") + 1, x["begin"] - pos.cast("int"))).otherwise("")
        body = F.array_join(F.zip_with(F.slice(places, 1, F.size(ps)), ps, lambda pos, x: F.concat(gap(pos, x), x["sub"])), "")
        last = F.array_max(F.transform(ps, lambda x: x["end"]))
        return F.concat(body, text.substr(last + 1, F.length(text)))

    return F.when(F.size(parts) > 0, _let(parts, joined)).when(parts.isNotNull(), text)


def spread(df: DataFrame, spans: str, *cols: str) -> DataFrame:
    """A row per element of the array ``spans``, as column ``s``, beside ``cols``.

    An outer explode and a filter on its result: a plain explode makes the
    optimizer infer ``size(spans) > 0``, push it below the projection that finds
    the spans, and so find them again.
    """
    return df.select(*cols, F.explode_outer(spans).alias("s")).where(F.col("s").isNotNull())
