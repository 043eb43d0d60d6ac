"""Annotated documents in XMI: read to (documents, annotations), write back.

Also curation exports, zip files that hold one XMI per annotator.
"""

from __future__ import annotations

import io
import uuid
import zipfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from xml.sax.saxutils import quoteattr

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``Patient:<hex>_<Resource>:<hex>`` in a file name.
FILE_NAME = r"Patient:([0-9a-fA-F]+)_([A-Za-z]+):([0-9a-fA-F]+)\.(?:xmi|txt)"
_SCHEMA = "path string, text string, spans array<struct<begin:int,end:int,main_class:string,sub_class:string,score:double,source:string>>"
TYPES = "http:///textveil/ner/type.ecore"


def parse_xmi(data: bytes) -> tuple[str | None, list[dict]]:
    """Text and entity annotations (elements with begin, end and entityType) of one file."""
    root = ET.fromstring(data)
    text, spans = None, []
    for el in root:
        name = el.tag.rpartition("}")[2]
        if name == "Sofa":
            text = el.get("sofaString")
        elif el.get("begin") is not None and "entityType" in el.attrib:
            spans.append({"begin": int(el.get("begin")), "end": int(el.get("end")), "main_class": name, "sub_class": el.get("entityType"), "score": float(el.get("score") or 0.0), "source": el.get("source")})
    return text, sorted(spans, key=lambda s: (s["begin"], s["end"]))


def write_xmi(text: str, spans: list[dict]) -> str:
    """One file's content; read again it gives the same text and spans."""
    attr = lambda v: quoteattr(v, {"\n": "&#10;", "\r": "&#13;", "\t": "&#9;"})
    out = ['<?xml version="1.0" encoding="UTF-8"?>', f'<xmi:XMI xmlns:xmi="http://www.omg.org/XMI" xmlns:cas="http:///uima/cas.ecore" xmlns:type="{TYPES}" xmi:version="2.0">', '  <cas:NULL xmi:id="0"/>']
    for i, s in enumerate(spans):
        out.append(f'  <type:{s["main_class"]} xmi:id="{i + 10}" sofa="1" begin="{s["begin"]}" end="{s["end"]}" entityType={attr(s["sub_class"] or "")} score="{s["score"]}" source={attr(s["source"] or "")}/>')
    out.append(f'  <cas:Sofa xmi:id="1" sofaNum="1" sofaID="_InitialView" mimeType="text/plain" sofaString={attr(text)}/>')
    return "\n".join([*out, "</xmi:XMI>"])


def read_xmi(spark: SparkSession, path: str) -> DataFrame:
    """``(path, text, spans)`` of every ``*.xmi`` under a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xmi").option("recursiveFileLookup", "true").load(path)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [parse_xmi(c) for c in b["content"]]
            yield pd.DataFrame({"path": b["path"], "text": [t for t, _ in got], "spans": [s for _, s in got]})

    return files.select("path", "content").mapInPandas(parse, _SCHEMA)


def read_curation_zips(spark: SparkSession, path: str, user: str = "CURATION_USER") -> DataFrame:
    """``(path, text, spans)`` from zip files; each holds ``<user>.xmi``, else the curator's."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for p, c in zip(b["path"], b["content"]):
                with zipfile.ZipFile(io.BytesIO(c)) as z:
                    names = {n.rpartition("/")[2]: n for n in z.namelist()}
                    pick = names.get(f"{user}.xmi") or names.get("CURATION_USER.xmi")
                    if pick:
                        rows.append((p, *parse_xmi(z.read(pick))))
            yield pd.DataFrame(rows, columns=["path", "text", "spans"])

    return files.select("path", "content").mapInPandas(parse, _SCHEMA)


def stem(path: str = "path") -> Column:
    """The file name of a path without its ending."""
    return F.regexp_replace(F.url_decode(F.element_at(F.split(path, "/"), -1)), r"\.[^.]*$", "")


def file_ids(df: DataFrame, path: str = "path") -> DataFrame:
    """``patient_id, resource_type, resource_id`` from the file name."""
    name = F.url_decode(F.element_at(F.split(path, "/"), -1))
    return df.withColumn("patient_id", F.regexp_extract(name, FILE_NAME, 1)).withColumn("resource_type", F.regexp_extract(name, FILE_NAME, 2)).withColumn("resource_id", F.regexp_extract(name, FILE_NAME, 3))


def annotations(df: DataFrame, key: str) -> DataFrame:
    """One row per span, with its arrival order."""
    return df.select(key, F.posexplode("spans").alias("seq", "s")).select(key, F.col("seq").cast("bigint").alias("seq"), "s.*")


def write_files(df: DataFrame, name: str, content: str, folder: str) -> None:
    """One file per row, named by the column ``name`` (it may hold subfolders).

    ``folder`` must be one that all executors share (any file system pyarrow
    knows by its URI).  A file is written under a name of its own and then
    moved, so a task that is run again, or twice at once, leaves whole files.
    """

    def write(rows) -> None:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        for r in rows:
            data = r[content]
            path = f"{base}/{r[name].replace(':', '%3A')}"  # Hadoop paths take no colon
            system.create_dir(path.rpartition("/")[0], recursive=True)
            part = f"{path}.{uuid.uuid4().hex}.part"
            with system.open_output_stream(part) as f:
                f.write(data.encode("utf-8") if isinstance(data, str) else bytes(data))
            system.move(part, path)

    df.select(name, content).where(F.col(content).isNotNull()).foreachPartition(write)


def xmi_content(df: DataFrame, text: str, spans: str, into: str = "content") -> DataFrame:
    """``df`` with each annotated text as the content of an XMI file; null texts stay null."""
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([*df.schema.fields, StructField(into, StringType())])

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(**{into: [None if t is None else write_xmi(t, [dict(s) for s in (ss if ss is not None else [])]) for t, ss in zip(b[text], b[spans])]})

    return df.mapInPandas(make, schema)


def write_xmi_files(df: DataFrame, name: str, text: str, spans: str, folder: str) -> None:
    """One XMI file per document, ``<name>.xmi``; see :func:`write_files`."""
    named = df.select(F.concat(F.regexp_replace(F.col(name).cast("string"), r"[/\\\\]", "_"), F.lit(".xmi")).alias("name"), text, spans)
    write_files(xmi_content(named, text, spans), "name", "content", folder)


def write_curation_zips(df: DataFrame, name: str, text: str, spans: str, folder: str, user: str = "CURATION_USER") -> None:
    """One zip file per document, ``<name>.xmi/export.zip``, holding ``<user>.xmi``."""
    from pyspark.sql.types import BinaryType, StringType, StructField, StructType

    schema = StructType([StructField("name", StringType()), StructField("content", BinaryType())])

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            names, data = [], []
            for n, t, ss in zip(b["name"], b[text], b[spans]):
                if t is None:
                    continue
                buf = io.BytesIO()
                with zipfile.ZipFile(buf, "w") as z:
                    z.writestr(f"{user}.xmi", write_xmi(t, [dict(s) for s in (ss if ss is not None else [])]))
                names.append(f"{n}.xmi/export.zip")
                data.append(buf.getvalue())
            yield pd.DataFrame({"name": names, "content": data})

    write_files(df.select(F.col(name).cast("string").alias("name"), text, spans).mapInPandas(make, schema), "name", "content", folder)


def paired(gold: DataFrame, pred: DataFrame, key: str, text: str) -> DataFrame:
    """Documents of two annotation sets by key: ``(key, state)`` for what keeps a pair
    from being compared: ``only_gold``, ``only_pred`` or ``other_text``; else ``same``."""
    g = gold.select(key, F.col(text).alias("_g"), F.lit(True).alias("_in_g"))
    p = pred.select(key, F.col(text).alias("_p"), F.lit(True).alias("_in_p"))
    state = F.when(F.col("_in_p").isNull(), "only_gold").when(F.col("_in_g").isNull(), "only_pred").when(F.col("_g").eqNullSafe(F.col("_p")), "same").otherwise("other_text")
    return g.join(p, key, "full").select(key, state.alias("state"))
