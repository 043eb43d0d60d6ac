"""Plain texts, CSV tables, annotation JSON and bundles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textveil.sources.xmi import FILE_NAME, stem, write_files

# Schemas of the CSV inputs.
CSV = {
    "radiology": "status string, diagnostic_report_id string, per_number string, text string",
    "mapping": "type string, per_number string, id string",
    "split": "document_type string, patient_id string, document_id string, phase string",
    "offsets": "patientid string, timeoffset bigint",
    "patients": "id string, identifier_0_value string",
}
# Types in annotation JSON that are metadata.
METADATA = ("DeidentifiedDocument", "DocumentAnnotation", "DocumentMetadata", "Sentence", "Token", "VersionInfo")
_BAD = r"[^\x09\x0A\x0D\x20-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]"


def xml_clean(c: Column) -> Column:
    """Without characters that XML 1.0 can't hold."""
    return F.regexp_replace(c, _BAD, "")


def read_texts(spark: SparkSession, path: str, inference: bool = False) -> DataFrame:
    """``(document_id, phase, text)`` of ``*.txt`` in the folders train and test under
    ``path``, the phase being the name of the folder; with ``inference`` also of
    those in ``path`` itself, which have no phase.  An empty file gives no row, as
    Spark plans no task for it."""
    t = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)
    t = t.select(F.col("path").alias("p"), xml_clean(F.decode("content", "UTF-8")).alias("text"))
    phase = F.element_at(F.split("p", "/"), -2)
    t = t.select(stem("p").alias("document_id"), F.when(phase.isin("train", "test"), phase).alias("phase"), "text")
    return t if inference else t.where("phase is not null")


_CSV_OPTIONS = {"header": True, "escape": '"', "nullValue": "\\N", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A CSV of one of the known schemas, or of a schema given as a string; ids stay strings."""
    return spark.read.options(**_CSV_OPTIONS, multiLine=True).schema(CSV.get(kind, kind)).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A CSV with a header; null is ``\\N``, an empty string is quoted."""
    df.write.mode("overwrite").options(**_CSV_OPTIONS).csv(path)


def write_sheets(df: DataFrame, path: str, sheet: str = "sheet") -> None:
    """A table of several sheets, one folder per sheet."""
    df.write.mode("overwrite").partitionBy(sheet).parquet(path)


def read_sheet(spark: SparkSession, path: str, name: str, sheet: str = "sheet") -> DataFrame:
    """One sheet; only its folder is read."""
    return spark.read.parquet(path).where(F.col(sheet) == name).drop(sheet)


def write_texts(df: DataFrame, name: str, text: str, path: str, phase: str | None = None) -> None:
    """One ``.txt`` per document, in a folder by ``phase`` where there is one (null: none)."""
    file = F.concat(F.regexp_replace(F.col(name).cast("string"), r"[/\\\\]", "_"), F.lit(".txt"))
    file = F.concat_ws("/", F.col(phase), file) if phase else file
    write_files(df.select(file.alias("name"), F.col(text).alias("content")), "name", "content", path)


def read_metric_texts(spark: SparkSession, path: str) -> DataFrame:
    """``(document, text)`` for text metrics: ``*.txt`` files, and of annotation JSON
    the covered text of its DocumentAnnotation rows only."""
    plain = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)
    plain = plain.select(stem("path").alias("document"), F.decode("content", "UTF-8").alias("text"))
    raw = spark.read.option("multiLine", True).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").schema(_JSON).json(path)
    d = raw.select(F.explode("payload.textAnalysisResultDtos").alias("d")).select(F.col("d.documentName").alias("document"), F.explode("d.annotationDtos").alias("a"))
    return plain.unionByName(d.where(F.element_at(F.split("a.type", r"\."), -1) == "DocumentAnnotation").select("document", F.col("a.coveredText").alias("text")))


def annotation_json(docs: DataFrame, name: str, text: str, spans: str, text_type: str = "DeidentifiedDocument") -> DataFrame:
    """``(name, content)``: an annotated text as annotation JSON, its text first."""
    ann = lambda t, k, b, e, c: F.struct(t.alias("type"), k.alias("kind"), b.cast("int").alias("begin"), e.cast("int").alias("end"), c.alias("coveredText"))
    t = F.col(text)
    whole = F.array(ann(F.lit(f"x.{text_type}"), F.lit(None).cast("string"), F.lit(0), F.length(t), t))
    rest = F.transform(spans, lambda s: ann(F.concat(F.lit("x."), s["main_class"]), s["sub_class"], s["begin"], s["end"], t.substr(s["begin"] + 1, s["end"] - s["begin"])))
    dto = F.struct(F.concat(F.col(name), F.lit(".txt")).alias("documentName"), F.concat(whole, rest).alias("annotationDtos"))
    return docs.select(F.col(name).alias("name"), F.to_json(F.struct(F.struct(F.array(dto).alias("textAnalysisResultDtos")).alias("payload"))).alias("content"))


_ANN = "struct<type:string,kind:string,begin:int,end:int,coveredText:string>"
_JSON = f"payload struct<textAnalysisResultDtos:array<struct<documentName:string,annotationDtos:array<{_ANN}>>>>"


def read_annotation_json(spark: SparkSession, path: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(documents, annotations)`` of annotation JSON, one object per file or per line.

    The text is the covered text of the DeidentifiedDocument; metadata types are
    left out; Profession and Age without a kind take their type's name.
    """
    raw = spark.read.option("multiLine", not lines).schema(_JSON).json(path)
    docs = raw.select(F.explode("payload.textAnalysisResultDtos").alias("d")).select(F.col("d.documentName").alias("document_name"), F.posexplode("d.annotationDtos").alias("seq", "a"))
    short = F.element_at(F.split("a.type", r"\."), -1)
    ids = {"patient_id": 1, "resource_type": 2, "resource_id": 3}
    base = docs.select("document_name", *[F.regexp_extract("document_name", FILE_NAME, k).alias(n) for n, k in ids.items()], F.col("seq").cast("bigint").alias("seq"), short.alias("main_class"), F.col("a.kind").alias("kind"), F.col("a.begin").alias("begin"), F.col("a.end").alias("end"), F.col("a.coveredText").alias("covered"))
    documents = base.where("main_class = 'DeidentifiedDocument'").select("document_name", *ids, F.col("covered").alias("text"))
    kind = F.coalesce("kind", F.when(F.col("main_class").isin("Profession", "Age"), F.upper("main_class")), F.lit(""))
    ann = base.where(~F.col("main_class").isin(*METADATA)).select("document_name", "seq", "begin", "end", "main_class", kind.alias("sub_class"), F.lit(1.0).alias("score"), F.lit("json").alias("source"))
    return documents, ann


def read_bundles(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """``(bundle, pos, id, resourceType, valueString)`` of the entries of bundles, one per
    file or, as :func:`write_bundles` leaves them, per line (then ``bundle`` is its text's digest)."""
    schema = "entry array<struct<resource:struct<id:string,resourceType:string,valueString:string>>>"
    if lines:
        raw = spark.read.text(path).select(F.md5("value").alias("bundle"), F.from_json("value", schema).alias("b")).select("bundle", "b.entry")
    else:
        raw = spark.read.option("multiLine", True).schema(schema).json(path).select(F.input_file_name().alias("bundle"), "entry")
    b = raw.select("bundle", F.posexplode("entry").alias("pos", "e"))
    return b.select("bundle", "pos", "e.resource.id", "e.resource.resourceType", "e.resource.valueString")


def write_bundles(entries: DataFrame, path: str) -> None:
    """Bundles as JSON lines, their entries in order."""
    res = F.struct(F.struct("id", "resourceType", "valueString").alias("resource"))
    one = entries.groupBy("bundle").agg(F.array_sort(F.collect_list(F.struct("pos", res.alias("e")))).alias("es"))
    one.select(F.to_json(F.struct(F.lit("Bundle").alias("resourceType"), F.transform("es", lambda x: x["e"]).alias("entry"))).alias("value")).write.mode("overwrite").text(path)


def rewrite_bundles(entries: DataFrame, rewritten: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``(entries with their valueString rewritten, mismatches)``.

    ``rewritten(key, text)`` has one row per resource; a bundle's resource without
    one, and one without a resource, is a mismatch: ``(id, state)``.
    """
    r = rewritten.select(F.col(key).alias("id"), F.col(text).alias("_new"), F.lit(True).alias("_have"))
    out = entries.join(r, "id", "left").withColumn("valueString", F.when(F.col("_have"), F.col("_new")).otherwise(F.col("valueString"))).select(entries.columns)
    ids = entries.select("id", F.lit(True).alias("_in")).distinct()
    state = F.when(F.col("_have").isNull(), "not_rewritten").when(F.col("_in").isNull(), "not_in_bundle")
    return out, ids.join(r, "id", "full").select("id", state.alias("state")).where("state is not null")


def load_policy(path: str) -> dict:
    """A policy file: PHI.<CLASS>.<SUBCLASS> methods and OFFSET numbers."""
    try:
        import yaml
    except ImportError:  # a small subset: two-level maps by indentation
        out: dict = {}
        stack: list[tuple[int, dict]] = [(-1, out)]
        for line in open(path, encoding="utf-8"):
            body = line.split("#")[0].rstrip()
            if body.strip():
                depth = len(body) - len(body.lstrip())
                k, _, v = body.strip().partition(":")
                while stack[-1][0] >= depth:
                    stack.pop()
                if v.strip():
                    stack[-1][1][k] = int(v) if v.strip().lstrip("-").isdigit() else v.strip()
                else:
                    stack[-1][1][k] = {}
                    stack.append((depth, stack[-1][1][k]))
        return out
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)
