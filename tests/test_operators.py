import math
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from textveil.operators import corpus, evaluate, letterhead, models, scores, similarity, textstats, tokens


def test_chunk_ranges_golden(spark):
    df = spark.createDataFrame([(0,), (50,), (120,)], "n int").select("n", tokens.chunk_ranges(F.col("n"), 50, 10).alias("r"))
    got = {r.n: [(x.first, x.last) for x in r.r] for r in df.collect()}
    assert got == {0: [], 50: [(0, 49)], 120: [(0, 60), (40, 110), (90, 119)]}


def test_chunks_cover_all_tokens(spark):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(37))), (2, ""), (3, None)], "doc int, text string")
    c = tokens.chunks(df, "doc", "text", 10, 2).collect()
    assert {t for r in c for t in r.tokens} == {f"w{i}" for i in range(37)} and {r.doc for r in c} == {1}
    with pytest.raises(ValueError):
        tokens.chunks(df, "doc", "text", 0, 2)


def test_tokens_compat_drops_last_char(spark):
    df = spark.createDataFrame([(1, "ab cd")], "doc int, text string")
    assert [r.token for r in tokens.tokens(df, "doc", "text", compat=True).collect()] == ["ab", "c"]
    assert [r.token for r in tokens.tokens(df, "doc", "text").collect()] == ["ab", "cd"]


def annotated_texts(spark, rows):
    return spark.createDataFrame(rows, "doc int, text string, spans array<struct<begin:int,end:int,main_class:string,sub_class:string>>")


def test_bio_splits_tokens_at_edges(spark):
    df = annotated_texts(spark, [(1, "Herr Max-Meier kam", [(5, 8, "Name", "PATIENT")]), (2, "a b", []), (3, None, [])])
    got = [(r.doc, r.begin, r.token, r.label) for r in tokens.bio_labels(df, "doc", "text", "spans").orderBy("doc", "begin").collect()]
    assert got == [(1, 0, "Herr", "O"), (1, 5, "Max", "B-Name_PATIENT"), (1, 8, "-Meier", "O"), (1, 15, "kam", "O"), (2, 0, "a", "O"), (2, 2, "b", "O")]


def test_labelled_chunks(spark):
    df = annotated_texts(spark, [(1, "Herr Dr. Max kam heim", [(5, 12, "Name", "STAFF")])])
    c = tokens.labelled_chunks(df, "doc", "text", "spans", 2, 0).orderBy("part_id").collect()
    assert [(r.text, r.tags_superclass, r.num_parts) for r in c] == [("Herr Dr. Max", ["O", "B-Name", "I-Name"], 3), ("Max kam heim", ["I-Name", "O", "O"], 3), ("heim", ["O"], 3)]
    sub = tokens.labelled_chunks(df, "doc", "text", "spans", 5, 0, subwords=True).first()
    assert sub.tokens == ["Herr", "Dr", ".", "Max", "kam", "heim"] and sub.tags_subclass == ["O", "B-Name_STAFF", "I-Name_STAFF", "I-Name_STAFF", "O", "O"]


def test_subword_labels(spark):
    df = spark.createDataFrame([([3, 0], [None, 0, 0, 1, None])], "l array<int>, w array<int>")
    r = df.select(tokens.align_subword_labels(F.col("l"), F.col("w")).alias("a"), tokens.align_subword_labels(F.col("l"), F.col("w"), False).alias("b")).first()
    assert r.a == [-100, 3, 3, 0, -100] and r.b == [-100, 3, -100, 0, -100]
    assert tokens.label_list(["Name", "Age"]) == ["O", "B-Age", "I-Age", "B-Name", "I-Name"]


def test_word_scores_golden(spark):
    df = spark.createDataFrame([([[0.9, 0.05, 0.05], [0.2, 0.7, 0.1]],)], "s array<array<double>>")
    want = {"first": (0, 0.9), "max": (0, 0.9), "average": (0, 0.55), "any_first": (1, 0.7), "any_average": (1, 0.7), "any_max": (1, 0.7)}
    for k, (i, s) in want.items():
        r = df.select(scores.word_score(F.col("s"), k).alias("w")).first().w
        assert r.idx == i and math.isclose(r.score, s), k
    assert math.isclose(df.select(scores.word_score(F.col("s"), "any_max", True).alias("w")).first().w.score, 0.05)
    none = spark.createDataFrame([([[0.9, 0.1], [0.7, 0.3]],)], "s array<array<double>>").select(scores.word_score(F.col("s"), "any_max").alias("w")).first().w
    assert none.idx == 0 and math.isclose(none.score, 0.8)


def test_group_entities(spark):
    rows = [(1, 0, "B-A", 0, 2, 1.0, "x"), (1, 1, "I-A", 3, 5, 0.0, "y"), (1, 2, "B-A", 6, 8, 1.0, "z"), (1, 3, "O", 9, 10, 1.0, "."), (1, 4, "I-A", 11, 12, 1.0, "w")]
    df = spark.createDataFrame(rows, "doc int, pos int, tag string, begin int, end int, score double, word string")
    assert [(r.begin, r.end, r.score) for r in scores.group_entities(df, "doc", "pos", "tag").orderBy("begin").collect()] == [(0, 5, 0.5), (6, 8, 1.0), (11, 12, 1.0)]
    assert [(r.begin, r.end) for r in scores.group_entities(df, "doc", "pos", "tag", "sentence_max").orderBy("begin").collect()] == [(0, 5), (6, 12)]


def test_strict_eval_golden(spark):
    ent = "doc string, label string, begin int, end int"
    gold = spark.createDataFrame([("d1", "Date_DATE", 0, 5), ("d1", "Name_PATIENT", 10, 15)], ent)
    pred = spark.createDataFrame([("d1", "Date_DATE", 0, 5), ("d1", "Date_DATE", 20, 25), ("d1", "Name_STAFF", 10, 15), ("d1", "Name_STAFF", 10, 15)], ent)
    got = {r.eval_name: (r.tp, r.fp, r.fn, r.precision, r.recall, r.f1) for r in evaluate.strict_summary(evaluate.matches(gold, pred)).collect()}
    assert got == {"strict": (1, 2, 1, 0.3333, 0.5, 0.4), "Date_DATE": (1, 1, 0, 0.5, 1.0, 0.6667), "Name_PATIENT": (0, 0, 1, 0, 0, 0), "Name_STAFF": (0, 1, 0, 0, 0, 0)}
    docs = spark.createDataFrame([("d1",), ("d2",)], "doc string")
    per = evaluate.strict_by_document(evaluate.matches(gold, pred), docs)
    assert {(r.doc, r.tp) for r in per.where("eval_name = 'strict'").collect()} == {("d1", 1), ("d2", 0)}


def test_models_merge(spark):
    s = "doc int, i int, begin int, end int, main_class string, sub_class string, score double"
    sup = spark.createDataFrame([(1, 0, 0, 5, "Name", "", 0.9), (1, 1, 10, 12, "Date", "", 0.8), (1, 2, 20, 25, "ID", "", 0.7)], s)
    sub = spark.createDataFrame([(1, 0, 2, 7, "Name", "STAFF", 0.5), (1, 1, 20, 22, "Age", "AGE", 0.4), (1, 2, 40, 41, "Age", "AGE", 0.3)], s)
    got = {(r.begin, r.end, r.main_class, r.sub_class, r.score) for r in models.merge_models(models.match_outer(sup, sub, ["doc"]), ["doc"]).collect()}
    assert got == {(0, 7, "Name", "STAFF", 0.5), (10, 12, "Date", "", 0.8), (20, 25, "Other", "", 0.0), (40, 41, "Other", "", 0.0)}


def test_titles_studies_and_suppression(spark):
    df = spark.createDataFrame([("sah Frau Meier heute", 9, 14), ("Meier", 0, 5)], "t string, b int, e int")
    assert [r.x for r in df.select(models.extend_title(F.col("t"), F.col("b"), F.col("e"), F.lit("Name")).alias("x")).collect()] == [4, 0]
    st = spark.createDataFrame([("Die MELANO-1 Studie lief", 4, 12), ("die Studie", 0, 3), ("PET Studie", 0, 3)], "t string, b int, e int")
    got = [r.x for r in st.select(models.study_span(F.col("t"), F.col("b"), F.col("e")).alias("x")).collect()]
    assert (got[0].begin, got[0].end) == (4, 12) and got[1:] == [None, None]
    im = spark.createDataFrame([("Ima 3/12 Frau", 4, 8), ("die Frau", 4, 8)], "t string, b int, e int")
    assert [r.x for r in im.select(models.suppressed(F.col("t"), F.col("b"), F.col("e")).alias("x")).collect()] == [True, True]
    assert [r.x for r in im.select(models.suppressed(F.col("t"), F.col("b"), F.col("e"), True).alias("x")).collect()] == [False, False]


def test_letterhead_keeps_covered_text(spark):
    text = "Institut für Pathologie\nBefundbericht\nAlles gut am 1.2.\nKein Anhalt für Malignität. \nProf. Dr. X\n"
    docs = spark.createDataFrame([(1, text), (2, "kein Brief"), (3, None)], "doc int, text string")
    at = text.index("1.2.")
    ann = spark.createDataFrame([(1, at, at + 4), (1, 0, 5)], "doc int, begin int, end int")
    d, a = letterhead.without_letterhead(docs, ann, "doc", "text")
    out = {r.doc: r.text for r in d.collect()}
    r = a.first()
    assert a.count() == 1 and out[1][r.begin : r.end] == "1.2." and out[2] == "kein Brief" and out[3] is None


def test_corpus(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z")], "id string, seq int, v string")
    assert {r.v for r in corpus.keep_first(df, ["id"], ["seq"]).collect()} == {"y", "z"}
    ids = spark.createDataFrame([(f"p{i}",) for i in range(7)], "p string")
    assert corpus.sample_patients(ids, "p", 50).count() == 4 and corpus.sample_patients(ids, "p", 50, seed=42).count() == 4
    counts = [("p1", "ID_X", 3), ("p2", "ID_X", 1), ("p3", "ID_X", 1)]
    out = corpus.balance(counts, {"p1", "p2", "p3"}, 0.5, 0.85)
    assert out == {"p2"}
    leaks = corpus.leak_flags(ids.where("p in ('p1', 'p2')"), ids.where("p in ('p2', 'p3')"), "p")
    assert {(r.p, r.side, r.leaks) for r in leaks.collect()} == {("p1", "train", False), ("p2", "train", True), ("p2", "test", True), ("p3", "test", False)}


def test_similarity_and_statistics(spark):
    df = spark.createDataFrame([(1, "A\nb\nc"), (2, "a\nb"), (3, "x"), (4, None)], "doc int, text string")
    got = {(r.a, r.b): round(r.cosine, 4) for r in similarity.line_cosine(df, "doc", "text").collect()}
    assert got == {(1, 2): round(2 / math.sqrt(6), 4)}
    sel = spark.createDataFrame([("s", i, f"{i % 3}\n" * 3) for i in range(9)], "st string, doc int, text string")
    assert similarity.distinct_selection(sel, "st", "doc", "text", k=3, min_chars=1).count() == 3
    m = {r.doc: r for r in textstats.document_metrics(df, "doc", "text").collect()}
    assert (m[1].tokens, m[1].sentences, m[1].mean_word_length) == (3, 1, 1.0)


def test_distinct_selection_takes_all_texts(spark):
    rows = [("s", i, "gleich" if i % 6 else f"einzeln {i}") for i in range(2500)]
    df = spark.createDataFrame(rows, "st string, doc int, text string")
    alone = {i for i in range(2500) if i % 6 == 0}
    got = {r.doc for r in similarity.distinct_selection(df, "st", "doc", "text", k=len(alone) + 1, min_chars=1).collect()}
    assert got == alone | {1}


def test_distinct_selection_against_plain_average_linkage(spark):
    rng = random.Random(5)
    texts = ["\n".join(f"z{int(rng.random() ** 2 * 40)}" for _ in range(rng.randrange(2, 9))) for _ in range(70)]
    texts += texts[:15]
    bags = [Counter(t.split("\n")) for t in texts]
    norm = lambda b: math.sqrt(sum(v * v for v in b.values()))
    d = np.array([[round(1 - sum(v * y[t] for t, v in x.items()) / norm(x) / norm(y), 12) for y in bags] for x in bags])
    groups = [[i] for i in range(len(texts))]
    while len(groups) > 12:
        _, i, j = min((round(d[np.ix_(a, b)].mean(), 9), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        groups[i] = sorted(groups[i] + groups.pop(j))
    want = {min(g, key=lambda x: (-round(d[x, g].sum(), 9), x)) for g in groups}
    df = spark.createDataFrame([("s", i, t) for i, t in enumerate(texts)], "st string, doc int, text string")
    assert {r.doc for r in similarity.distinct_selection(df, "st", "doc", "text", k=12, min_chars=1).collect()} == want


def _peaks():
    """Peak memory in MB of this machine's Spark workers, by process."""
    out = {}
    for p in Path("/proc").glob("[0-9]*"):
        try:
            if b"pyspark" in (p / "cmdline").read_bytes() and b"java" not in (p / "cmdline").read_bytes():
                out[p.name] = int(re.search(r"VmHWM:\s+(\d+)", (p / "status").read_text()).group(1)) / 1024
        except (OSError, AttributeError):
            pass
    return out


@pytest.mark.skipif(not Path("/proc/self/status").exists(), reason="memory is read from /proc")
def test_distinct_selection_holds_no_square_of_the_classes(spark):
    rng = random.Random(3)
    rows = [("s", i, "\n".join([f"allein {i}", *(f"z{int(rng.random() ** 3 * 900)}" for _ in range(6))])) for i in range(8000)]
    df = spark.createDataFrame(rows, "st string, doc int, text string")
    before = _peaks()
    got = {r.doc for r in similarity.distinct_selection(df, "st", "doc", "text", min_chars=1).collect()}
    assert len(got) == 50
    grown = [mb - before.get(p, 100) for p, mb in _peaks().items()]
    assert grown and max(grown) < 350  # the distances of all pairs are 512 MB


def test_distinct_selection_takes_equal_distances_by_place(spark):
    # each first two share one line: the cosine is 1 / sqrt(a * b), the same number for all pairs but for rounding
    for sides in ([(2, 32), (4, 16), (8, 8)], [(8, 8), (2, 32), (4, 16)], [(3, 48), (6, 24), (9, 16), (12, 12)], [(12, 12), (9, 16), (6, 24), (3, 48)], [(18, 20), (10, 36), (15, 24), (12, 30)], [(12, 30), (15, 24), (10, 36), (18, 20)]):
        texts = ["\n".join([f"gleich {p}", *(f"{p} {side} {i}" for i in range(n - 1))]) for p, pair in enumerate(sides) for side, n in enumerate(pair)]
        df = spark.createDataFrame(list(enumerate(texts)), "doc int, text string").withColumn("st", F.lit("s"))
        for gone in range(1, len(sides)):
            got = {r.doc for r in similarity.distinct_selection(df, "st", "doc", "text", k=len(texts) - gone, min_chars=1).collect()}
            assert got == {i for i in range(len(texts)) if i % 2 == 0 or i >= 2 * gone}


def test_distinct_selection_of_odd_strata(spark):
    many = [("viele", 100 - i, f"{i % 3}\n" * 3) for i in range(90)]  # three classes of thirty texts
    rows = [*many, (None, 1, "a\nb"), (None, 2, "b\na"), (None, 3, "c"), ("leer", 7, "\n\n"), ("leer", 8, "\n\n"), ("leer", 9, None), ("fremd", 5, "x"), ("fremd", 6, "y"), ("fremd", 4, "z")]
    df = spark.createDataFrame(rows, "st string, doc int, text string")
    got = defaultdict(set)
    for r in similarity.distinct_selection(df, "st", "doc", "text", k=2, min_chars=1).collect():
        got[r.st].add(r.doc)
    assert {st: len(docs) for st, docs in got.items()} == {"viele": 2, None: 2, "leer": 2, "fremd": 2}
    assert got[None] == {1, 3} and got["fremd"] == {4, 6}
    kept = {r.doc for r in similarity.distinct_selection(df.where("st = 'viele'"), "st", "doc", "text", k=10, min_chars=1).collect()}
    assert kept == {11, 12, 13, 82, 85, 88, 91, 94, 97, 100}


def test_line_classes_are_compared_once(spark):
    rng = random.Random(8)
    texts = ["\n".join(f"z{int(rng.random() ** 2 * 25)}" for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    rows = list(enumerate(texts + [t.upper() for t in texts[:20]] + [texts[0]] * 30)) + [(900, None), (901, "\n")]
    df = spark.createDataFrame(rows, "doc long, text string")
    classes = similarity.line_classes(df, "doc", "text")
    first = {}
    of = {r.doc: first.setdefault(r["class"], r.doc) for r in classes.orderBy("doc").collect()}
    assert set(of) == set(range(110)) and of[60] == of[0] == of[109]
    for least in (0.0, 0.3):
        got = {(r.a, r.b): r.cosine for r in similarity.class_cosine(classes, "doc", least).collect()}
        want = {(r.a, r.b): r.cosine for r in similarity.line_cosine(df, "doc", "text", least).collect()}
        assert set(got) == {p for p in want if p[0] in first.values() and p[1] in first.values()}
        assert all(abs(v - want[p]) < 1e-9 for p, v in got.items())
        spread = {(a, b) for a in of for b in of if a < b and (of[a] == of[b] or tuple(sorted((of[a], of[b]))) in got)}
        assert spread == set(want)


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables")
def test_line_classes_hold_all_tables(spark):
    from textveil.plans import catalog

    d = "/root/testdata/sf0.001"
    got = {r.table_name: r["count"] for r in catalog.Q["line_cosine_members"](spark, d).groupBy("table_name").count().collect()}
    assert got == {name: catalog.table(spark, d, name).where(F.col(text).rlike(r"[^\n\r]")).count() for name, _, text in catalog.TEXT_TABLES}


def test_radiology_spans_are_cleaned(spark):
    text = "PET Studie. MELANO-1 Studie. Befunderstellung durch von Dr. A. Meier und B. Öztürk \nEnde ED 03/2020 ."
    rows = [(0, 0, 3, "STUDYID"), (1, text.index("MELANO"), text.index(" Studie. Bef"), "STUDYID"), (2, text.index("Dr. A"), text.index("\n"), "STAFF"), (3, text.index(" 03/2020"), len(text) - 1, "DATE"), (4, 0, 3, "STAFF")]
    spans = [(s, b, e, "X", c, 1.0, "r") for s, b, e, c in rows]
    df = spark.createDataFrame([(text, spans), ("", []), (None, [])], "text string, spans array<struct<seq:bigint,begin:int,end:int,main_class:string,sub_class:string,score:double,source:string>>")
    got = [r.c for r in df.select(models.clean_spans(F.col("text"), F.col("spans")).alias("c")).collect()]
    assert [text[s.begin : s.end] for s in got[0]] == ["MELANO-1", "A. Meier", "B. Öztürk", "03/2020"] and got[1:] == [[], []]
    assert [s.seq for s in got[0]] == sorted(s.seq for s in got[0])


def test_match_arrays_equals_match_outer(spark):
    rng = random.Random(11)
    span = lambda i: (i, *sorted(rng.sample(range(40), 2)), "A", "B", 1.0)
    docs = [(k, [span(i) for i in range(rng.randrange(5))], [span(i) for i in range(rng.randrange(5))]) for k in range(30)]
    kind = "array<struct<i:int,begin:int,end:int,main_class:string,sub_class:string,score:double>>"
    df = spark.createDataFrame(docs, f"doc int, sup {kind}, sub {kind}")
    m = df.select("doc", models.match_arrays(F.col("sup"), F.col("sub")).alias("m")).collect()
    got = [(r.doc, x.a and x.a.i, x.b and x.b.i) for r in m for x in r.m]
    flat = lambda c: df.select("doc", F.explode(c).alias("s")).select("doc", "s.*")
    want = [(r.doc, r.a_i, r.b_i) for r in models.match_outer(flat("sup"), flat("sub"), ["doc"]).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    for r in m:  # pairs by place in sup, then sub; then those alone
        pairs = [(x.a.i, x.b.i) for x in r.m if x.a and x.b]
        assert pairs == sorted(pairs) and [bool(x.a and x.b) for x in r.m] == sorted((bool(x.a and x.b) for x in r.m), reverse=True)


def test_detectors_run_once(spark):
    from textveil.operators import detect, rewrite

    df = spark.createDataFrame([(1, "am 12.03.2020 a@b.de2@x.com ----")], "doc int, text string").withColumn("text", F.concat("text", F.lit("")))
    sets = detect.CONTACTS + detect.RADIOLOGY
    for q in (detect.detect(df, "doc", "text", sets).groupBy("main_class").count(), rewrite.deidentify(df, "doc", "text", sets)):
        assert q._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") <= len(sets)
    found = {r.covered for r in detect.detect(df, "doc", "text", sets).collect()}
    assert {"12.03.2020", "a@b.de"} <= found


def test_evaluation_within_rows_equals_join(spark):
    rng = random.Random(4)
    some = lambda: [(b, b + 2, rng.choice(["Date", "Other"]), "X") for b in rng.sample(range(6), rng.randrange(4))]
    kind = "array<struct<begin:int,end:int,main_class:string,sub_class:string>>"
    df = spark.createDataFrame([(i, some(), some()) for i in range(25)] + [(99, None, [(0, 2, "Date", "X")] * 2)], f"doc int, g {kind}, p {kind}")
    flat = lambda c: df.select("doc", F.explode(c).alias("s")).select("doc", evaluate.blind(F.col("s.main_class"), F.col("s.sub_class"), 2).alias("label"), "s.begin", "s.end")
    key = lambda rows: sorted(tuple(r[c] for c in ("doc", "label", "begin", "end", "g", "p")) for r in rows)
    assert key(evaluate.matches_within(df, "doc", "g", "p", 2).collect()) == key(evaluate.matches(flat("g"), flat("p")).collect())
    rep = evaluate.report(df, "doc", "g", "p")
    assert {r.sheet for r in rep.collect()} == {"doc_only_type", "sum_only_type", "doc_with_kind", "sum_with_kind"}
    assert rep.where("sheet = 'doc_with_kind' and eval_name = 'strict'").count() == 26


def test_seeded_offsets_are_repeated():
    a, b = corpus.seeded_offsets(["p2", "p1", "p3"]), corpus.seeded_offsets(["p3", "p2", "p1"])
    assert a == b and [x[0] for x in a] == ["p1", "p2", "p3"]
    assert all(d and -14 <= d <= 14 and y in (-2, -1, 1, 2) for _, d, y in corpus.seeded_offsets(range(300)))


def test_text_functions(spark):
    from textveil.functions.texts import char_diff, decode_base64

    df = spark.createDataFrame([("R3LDvMOfZQ==", "abc", "abd"), ("?", "x", "x"), (None, None, "y")], "b string, p string, q string")
    got = df.select(decode_base64(F.col("b")).alias("t"), char_diff(F.col("p"), F.col("q")).alias("d")).collect()
    assert [r.t for r in got] == ["Grüße", None, None]
    assert got[0].d.split("\n")[3:] == ["-c", "+d"] and got[1].d == "" and got[2].d.endswith("+y")


def test_sample_is_the_first_by_hash(spark):
    ids = spark.createDataFrame([(f"p{i}",) for i in range(3000)] + [("p1",)] * 50, "p string")
    for percent in (0, 0.01, 33, 100):
        n = -(-percent * 3000 // 100)
        want = {r.p for r in ids.distinct().orderBy(corpus.portable_hash(F.col("p")), "p").limit(int(n)).collect()}
        assert {r.p for r in corpus.sample_patients(ids, "p", percent).collect()} == want
    assert corpus.sample_patients(ids.limit(0), "p", 50).count() == 0


def test_balanced_patients(spark):
    rows = [("a", "ID", "X")] * 5 + [("b", "ID", "X"), ("c", "ID", "X")] + [("a", "Date", "D")] * 2
    df = spark.createDataFrame(rows, "p string, main_class string, sub_class string")
    train = df.select("p").distinct()
    kept = {r.p for r in corpus.balanced_patients(df, train, "p", 0.5, 0.9).collect()}
    counts = [tuple(r) for r in df.groupBy("p", F.concat_ws("_", "main_class", "sub_class")).count().collect()]
    assert kept == {"a", "b", "c"} - corpus.balance(counts, {"a", "b", "c"}, 0.5, 0.9)


def test_callbacks_and_models(spark, tmp_path):
    from textveil.operators import detect

    df = annotated_texts(spark, [(1, "ab Befund", [(0, 2, "A", "B")]), (2, None, None), (3, "x", None)])
    twice = lambda a, t: [a, {**a, "begin": a["begin"] + 1}]
    got = detect.apply_callbacks(df, "doc", "text", "spans", twice, lambda t: [{"begin": 0, "end": len(t), "main_class": "W", "sub_class": "T"}])
    assert sorted((r.doc, r.begin, r.end, r.main_class) for r in got.collect()) == [(1, 0, 2, "A"), (1, 0, 9, "W"), (1, 1, 2, "A"), (3, 0, 1, "W")]
    folder = tmp_path / "run_2024-01-02_10-11"
    folder.mkdir()
    (folder / "config.json").write_text('{"_name_or_path": "org/some-model"}')
    assert detect.model_info(str(folder)) == {"name": "some-model", "stamp": "2024-01-02_10-11"}
    assert detect.model_pair_name("a/b", "c") == "b_c" and detect.split_label("Name_A_B") == ("Name", "A_B") and detect.split_label("Name") == ("Name", "")


def test_scores_of_pieces_and_runs(spark):
    o, b, i = [0.9, 0.05, 0.05], [0.1, 0.8, 0.1], [0.2, 0.1, 0.7]
    rows = [(1, 0, o, False), (1, 1, b, False), (1, 2, i, False), (1, 3, [0.3, 0.1, float("nan")], True), (1, 4, b, False), (1, 5, b, True)]
    df = spark.createDataFrame(rows, "doc int, pos int, s array<double>, sub boolean")
    runs = scores.sentence_scores(df.where("pos <> 3"), "doc", "pos", "s", ["O", "B-A", "I-A"], "sentence_max", "sub").orderBy("first").collect()
    assert [(r.first, r.last, r.idx) for r in runs] == [(0, 0, 0), (1, 2, 1), (4, 5, 1)]
    w = spark.createDataFrame([([[0.5, float("nan")], [0.1, 0.4]],)], "r array<array<double>>").select(scores.word_score(F.col("r"), "average").alias("w")).first().w
    assert w.idx == 1 and abs(w.score - 0.4) < 1e-9
    for bad in ("sentence_max", "exact", "none", "unheard"):
        with pytest.raises(ValueError):
            scores.words_from_pieces(df, ["doc"], "pos", "s", bad)


def test_letterhead_headings_in_order(spark):
    body = "Institut für Pathologie\nx\n{}Text\nKein Anhalt für Malignität. \nEnde"
    for head in ("Sektionsbericht", "Nachbericht mit Makroskopie\n", "3. Befundbericht", "Klinische Angaben (kurz):\n"):
        t = body.format(head)
        r = spark.createDataFrame([(t,)], "t string").select(letterhead.letterhead_spans(F.col("t")).alias("s")).first().s
        assert (r[0].begin, r[0].end) == (0, t.index(head)) and r[-1].end == len(t)


def test_cuts_are_dropped(spark):
    from textveil import session

    df = session.cut(spark.createDataFrame([(1,)], "a int"))
    assert df.count() == 1 and session.drop_cuts(spark) >= 1 and session.drop_cuts(spark) == 0
