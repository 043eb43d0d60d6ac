from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textveil.functions.spans import find_spans, fold_longest, fold_merge, overlaps, stitch, touches
from textveil.operators import detect, rewrite

SPAN = "struct<seq:bigint,begin:int,end:int,main_class:string,sub_class:string,score:double,source:string>"


def fold(spark, f, spans):
    rows = [([(i, b, e, c, "", 1.0, "x") for i, (b, e, c) in enumerate(spans)],)]
    df = spark.createDataFrame(rows, f"s array<{SPAN}>")
    return [(x.begin, x.end, x.main_class, x.source) for x in df.select(f(F.col("s")).alias("r")).first().r]


def test_longest_golden(spark):
    cases = [([(0, 5, "A"), (3, 10, "B")], ["B"]), ([(0, 7, "A"), (5, 10, "B")], ["A"]), ([(0, 5, "A"), (3, 8, "B")], ["B"]), ([(0, 5, "A"), (5, 8, "B")], ["A", "B"]), ([(0, 3, "A"), (8, 20, "C"), (2, 9, "N")], ["C"]), ([], [])]
    for spans, want in cases:
        assert [x[2] for x in fold(spark, fold_longest, spans)] == want


def test_merge_golden(spark):
    assert fold(spark, fold_merge, [(0, 3, "Date"), (8, 20, "Contact"), (2, 9, "ID")]) == [(0, 20, "Contact", "Merge overlapping entities")]


def test_touch_is_not_overlap(spark):
    rows = [((0, 5), (3, 8), True, True), ((0, 5), (5, 6), True, False), ((5, 6), (0, 5), True, False), ((0, 5), (5, 7), False, False), ((2, 3), (0, 9), True, True)]
    df = spark.createDataFrame([(*a, *b, t, o) for a, b, t, o in rows], "a int, b int, c int, d int, t boolean, o boolean")
    c = [F.col(x) for x in "abcd"]
    assert df.where((touches(*c) != F.col("t")) | (overlaps(*c) != F.col("o"))).isEmpty()


def test_positions_are_code_points(spark):
    df = spark.createDataFrame([("a😀b 12 ü34",), ("",), (None,)], "t string")
    got = [r.s for r in df.select(find_spans(F.col("t"), r"\d+").alias("s")).collect()]
    assert [(x.begin, x.end, x.covered) for x in got[0]] == [(4, 6, "12"), (8, 10, "34")]
    assert got[1] == [] and not got[2]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 10)), max_size=12))
def test_resolved_spans_are_disjoint(spark, raw):
    spans = [(b, b + n, "X") for b, n in raw]
    for f in (fold_longest, fold_merge):
        got = sorted((b, e) for b, e, *_ in fold(spark, f, spans))
        assert all(x[1] <= y[0] for x, y in zip(got, got[1:]))


def test_stitch_golden(spark):
    text = "Herr Max, 54 Jahre."
    spans = [(0, 5, 8, "Name", "PATIENT", 1.0, "x"), (1, 10, 12, "Age", "AGE", 1.0, "x")]
    df = spark.createDataFrame([(text, spans)], f"text string, spans array<{SPAN}>")
    run = lambda policy, **o: rewrite.rewrite(df, "text", "spans", policy, **o).first().deid_text
    every = lambda m: {"NAME": {"PATIENT": m}, "AGE": {"AGE": m}}
    assert run({}) == "Herr <Name_PATIENT>, <Age_AGE> Jahre."
    assert run(every("redact")) == "Herr XXX, XX Jahre."
    assert run(every("keep")) == text
    assert run({"AGE": {"AGE": "shift"}}, years=F.lit(1)) == "Herr <Name_PATIENT>, 55 Jahre."
    assert run({}, only_superclass=True) == "Herr <Name>, <Age> Jahre."
    assert run({"NAME": {"PATIENT": "substitute"}}, first=F.lit("Eva"), last=F.lit("Muster")) == "Herr Muster, <Age_AGE> Jahre."


def test_nested_parts_are_not_emitted_again(spark):
    df = spark.createDataFrame([("abcdef", [(0, 5, "<x>"), (1, 2, "<y>")])], "t string, p array<struct<begin:int,end:int,sub:string>>")
    assert df.select(stitch(F.col("t"), F.col("p")).alias("r")).first().r == "<x><y>f"


def test_detectors_and_model(spark):
    df = spark.createDataFrame([(1, "am 12.03.2020 und ED 03/21, Tel 81234 ."), (2, None), (3, "")], "doc int, text string")
    got = {(r.doc, r.covered) for r in detect.detect(df, "doc", "text", detect.RADIOLOGY).collect()}
    assert {(1, "12.03.2020"), (1, "03/21"), (1, "81234")} <= got

    class Model:
        def load(self):
            pass

        def predict(self, texts):
            return [[{"begin": 0, "end": 2, "label": "Name_STAFF"}] for _ in texts]

    assert [(r.doc, r.main_class, r.sub_class) for r in detect.model_spans(df, "doc", "text", Model).orderBy("doc").collect()] == [(1, "Name", "STAFF"), (3, "Name", "STAFF")]
