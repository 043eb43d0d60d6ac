import io
import json
import zipfile

from textveil.operators import detect, rewrite
from textveil.sources import documents, xmi
from textveil.streaming.deid import deidentify_stream, stream_documents

SPANS = [{"begin": 0, "end": 4, "main_class": "Name", "sub_class": "STAFF", "score": 0.5, "source": "a & b"}]


def test_xmi_round_trip(spark, tmp_path):
    text = 'Eva "sagt"\n<nein> & ja\t😀'
    (tmp_path / "d1.xmi").write_text(xmi.write_xmi(text, SPANS), encoding="utf-8")
    r = xmi.read_xmi(spark, str(tmp_path)).first()
    assert r.text == text and [s.asDict() for s in r.spans] == SPANS
    xmi.write_xmi_files(spark.createDataFrame([("n1", text, SPANS)], "name string, text string, spans array<struct<begin:int,end:int,main_class:string,sub_class:string,score:double,source:string>>"), "name", "text", "spans", str(tmp_path / "out"))
    again = xmi.annotations(xmi.read_xmi(spark, str(tmp_path / "out")), "path").collect()
    assert [(a.begin, a.end, a.main_class) for a in again] == [(0, 4, "Name")]


def test_curation_zip(spark, tmp_path):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("CURATION_USER.xmi", xmi.write_xmi("Eva war da", SPANS))
    (tmp_path / "a.zip").write_bytes(buf.getvalue())
    assert xmi.read_curation_zips(spark, str(tmp_path)).first().text == "Eva war da"


def test_annotation_json(spark, tmp_path):
    ann = [{"type": "x.DeidentifiedDocument", "begin": 0, "end": 6, "coveredText": "Eva 45"}, {"type": "x.Age", "begin": 4, "end": 6, "coveredText": "45"}, {"type": "x.Token", "begin": 0, "end": 3, "coveredText": "Eva"}]
    (tmp_path / "a.json").write_text(json.dumps({"payload": {"textAnalysisResultDtos": [{"documentName": "Patient:ab12_Report:cd34.txt", "annotationDtos": ann}]}}))
    docs, spans = documents.read_annotation_json(spark, str(tmp_path))
    d, s = docs.first(), spans.collect()
    assert (d.patient_id, d.resource_id, d.text) == ("ab12", "cd34", "Eva 45")
    assert [(x.main_class, x.sub_class) for x in s] == [("Age", "AGE")]


def test_bundles_texts_csv_policy(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b/1.json").write_text(json.dumps({"entry": [{"resource": {"id": "1", "resourceType": "R", "valueString": "x"}}, {"resource": {"id": "2", "resourceType": "R"}}]}))
    e = documents.read_bundles(spark, str(tmp_path / "b"))
    documents.write_bundles(e, str(tmp_path / "out"))
    assert [x["resource"]["id"] for x in json.loads(spark.read.text(str(tmp_path / "out")).first().value)["entry"]] == ["1", "2"]
    (tmp_path / "t/train").mkdir(parents=True)
    (tmp_path / "t/train/d1.txt").write_bytes("a\x01b\n".encode())
    t = documents.read_texts(spark, str(tmp_path / "t")).first()
    assert (t.document_id, t.phase, t.text) == ("d1", "train", "ab\n")
    df = spark.createDataFrame([("final", "1", "007", 'a "b"\nc')], documents.CSV["radiology"])
    documents.write_csv(df, str(tmp_path / "csv"))
    assert documents.read_csv(spark, str(tmp_path / "csv"), "radiology").collect() == df.collect()
    (tmp_path / "p.yaml").write_text("PHI:\n  DATE:\n    DATE: shift\nOFFSET:\n  DAYS: 3\n")
    assert documents.load_policy(str(tmp_path / "p.yaml")) == {"PHI": {"DATE": {"DATE": "shift"}}, "OFFSET": {"DAYS": 3}}


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(1, "am 12.03.2020"), (2, "a@b.de"), (3, None)], "doc int, text string")
    df.write.parquet(str(tmp_path / "in"))
    q = deidentify_stream(stream_documents(spark, str(tmp_path / "in"), "doc int, text string"), "doc", "text", detect.CONTACTS + detect.RADIOLOGY, {}, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    batch = rewrite.deidentify(df, "doc", "text", detect.CONTACTS + detect.RADIOLOGY, {})
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(batch.collect())


def test_phases_sheets_and_mismatches(spark, tmp_path):
    t = spark.createDataFrame([("a/b:c", "x", "train"), ("d", "y", None), ("e", None, "test"), ("f", "", "test")], "n string, t string, p string")
    documents.write_texts(t, "n", "t", str(tmp_path / "t"), "p")
    assert {(r.document_id, r.phase, r.text) for r in documents.read_texts(spark, str(tmp_path / "t"), True).collect()} == {("a_b:c", "train", "x"), ("d", None, "y")}
    assert documents.read_texts(spark, str(tmp_path / "t")).count() == 1
    sheets = spark.createDataFrame([("s1", 1), ("s2", 2)], "sheet string, v int")
    documents.write_sheets(sheets, str(tmp_path / "s"))
    assert [r.v for r in documents.read_sheet(spark, str(tmp_path / "s"), "s2").collect()] == [2]
    e = spark.createDataFrame([("b", 0, "1", "R", "x"), ("b", 1, "2", "R", "y")], "bundle string, pos int, id string, resourceType string, valueString string")
    new, odd = documents.rewrite_bundles(e, spark.createDataFrame([("1", "X"), ("9", "Z")], "k string, v string"), "k", "v")
    assert {(r.id, r.valueString) for r in new.collect()} == {("1", "X"), ("2", "y")}
    assert {(r.id, r.state) for r in odd.collect()} == {("2", "not_rewritten"), ("9", "not_in_bundle")}


def test_metric_files_and_pairs(spark, tmp_path):
    d = spark.createDataFrame([("j", "Text eins.", [])], "n string, t string, s array<struct<begin:int,end:int,main_class:string,sub_class:string>>")
    js = documents.annotation_json(d, "n", "t", "s", "DocumentAnnotation").collect()
    (tmp_path / "j.json").write_text(js[0].content)
    (tmp_path / "k.txt").write_text("zwei")
    assert {(r.document, r.text) for r in documents.read_metric_texts(spark, str(tmp_path)).collect()} == {("j.txt", "Text eins."), ("k", "zwei")}
    g = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "k string, t string")
    p = spark.createDataFrame([("1", "a"), ("2", "c"), ("3", None), ("4", "d")], "k string, t string")
    assert {(r.k, r.state) for r in xmi.paired(g, p, "k", "t").collect()} == {("1", "same"), ("2", "other_text"), ("3", "same"), ("4", "only_pred")}


def test_csv_keeps_blanks_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([("", None, ' a"b ', "x\ny"), (None, "", "c", "\\N?")], "type string, per_number string, id string, more string")
    documents.write_csv(df, str(tmp_path / "c"))
    assert sorted(documents.read_csv(spark, str(tmp_path / "c"), df._jdf.schema().toDDL()).collect(), key=str) == sorted(df.collect(), key=str)
