"""Rule-based detectors: a declared pattern becomes spans of text.

A detector is (name, pattern, class, subclass, head, tail): head and tail are
the parts of a match around the span itself.  All detectors of a set run within
the row, each over the text once; their place in the set is the arrival order of
their spans.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textveil.functions.spans import NO_SPANS, find_spans_sql, quoted, spread

ANNOTATION = "seq bigint, begin int, end int, main_class string, sub_class string, score double, source string"


@dataclass(frozen=True)
class Detector:
    name: str
    pattern: str
    main_class: str
    sub_class: str
    head: str = ""
    tail: str = ""
    #: What every match contains; texts without it are not searched.
    needs: str = ""
    #: A character class: no match begins inside a run of it.  Spares a search
    #: from every character of a long run, and changes no match.
    run: str = ""

    @property
    def java(self) -> str:
        """The pattern as it is run; behind a match (``\\G``) a run counts as new."""
        return rf"(?:\G|(?<!{self.run})){self.pattern}" if self.run else self.pattern


# Months as the date rule spells them.
_MONTH = "Jan(?:uar)?|Feb(?:ruar)?|Mär(?:z)?|Apr(?:il)?|Mai|Jun(?:i)?|Jul(?:i)?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dez(?:ember)?"
_N = r"[^\p{L}\p{N}_]"
_STUDY = r"\b[0-9\-A-Za-züöäß]+?\b\s*-?\s*Studie[^\p{L}\p{N}_]"
_STUDY_TAIL = r"\s*-?\s*Studie[^\p{L}\p{N}_]"

STUDY = Detector("study", _STUDY, "ID", "STUDYID", "", _STUDY_TAIL, "Studie")
RADIOLOGY = (
    Detector("day_month", r"[0-9]{2}\.[0-9]{2}\.(?:[0-9]{2,4})?", "Date", "DATE"),
    Detector("year", r"2[0-9]{3}", "Date", "DATE"),
    Detector("ed_date", r"ED [0-9]{2}/[0-9]{2,4}", "Date", "DATE", "ED ", "", "ED "),
    Detector("month_year", r"[0-9]{2}/[0-9]{4}", "Date", "DATE"),
    Detector("month_name", rf"(?:{_MONTH}){_N}[0-9]{{4}}", "Date", "DATE"),
    Detector("extension", rf"{_N}8[0-9]{{4}}{_N}", "Contact", "PHONE", _N, _N),
    Detector("bracketed", r"\([0-9]{4}\)", "Contact", "PHONE", r"\(", r"\)"),
    Detector("seven_digits", rf"{_N}[0-9]{{3}}{_N}[0-9]{{4}}{_N}", "Contact", "PHONE", _N, _N),
    Detector("record", r"[A-Z][0-9]{2,7}/[0-9]{2}", "ID", "PATIENTID"),
    Detector("staff", rf"(?:Befunderstellung[^\n]+von|Befundbesprechung[^\n]+vorab[^\n]+mit|Telefonische[^\n]+Befundübermittlung[^\n]+vorab[^\n]+an){_N}[^\n]+\n", "Name", "STAFF", rf"(?:Befunderstellung[^\n]+von|Befundbesprechung[^\n]+vorab[^\n]+mit|Telefonische[^\n]+Befundübermittlung[^\n]+vorab[^\n]+an){_N}", r"\n", "Befund"),
    STUDY,
)
POSTPROCESS = (
    Detector("age_years", r"(?i)[0-9]+\sJahre", "Age", "AGE", "", r"(?i)\sJahre"),
    Detector("age_year_of_life", r"(?i)[0-9]+\.\s(?:Lebensjahr|LJ)", "Age", "AGE", "", r"(?i)\.\s(?:Lebensjahr|LJ)"),
    Detector("study", "(?i)" + _STUDY, "ID", "STUDYID", "", "(?i)" + _STUDY_TAIL, "(?i)studie"),
)
MISSING = (Detector("study", "(?i)" + _STUDY, "ID", "STUDYID", "", "(?i)" + _STUDY_TAIL, "(?i)studie"),)
CONTACTS = (
    Detector("email", r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}", "Contact", "EMAIL", needs="@", run=r"[A-Za-z0-9._%+\-]"),
    Detector("ip", r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", "Contact", "IPADDRESS"),
    Detector("url", r"https?://[A-Za-z0-9./_\-]+", "Contact", "URL", needs="http"),
    Detector("phone", r"\+[0-9]{2}[0-9 ()/\-]{6,18}[0-9]", "Contact", "PHONE"),
)
MEASURES = (
    Detector("weight", rf"{_N}(?:Körper)?[gG]ewicht.\s*(?:[0-9]{{1,3}}|[0-9]{{1,2}}[.,][0-9]{{1,2}})\s*(?:kg|KG|Kg|kG)?{_N}", "Other", "WEIGHT", rf"{_N}(?:Körper)?[gG]ewicht.\s*", _N),
    Detector("size", rf"{_N}(?:Körper)?[gG]röße.\s*(?:[0-9]{{3}}|[1-2][.,][0-9]{{1,2}})\s*(?:cm|m|CM|M|Cm|cM)?{_N}", "Other", "SIZE", rf"{_N}(?:Körper)?[gG]röße.\s*", _N),
)
#: Reference to an image, which suppresses findings within it.
IMAGE = r"(?i)ima.*?[0-9]+/[0-9]+(?:-[0-9]+)?"


def spans_sql(text: str, d: Detector, order: int, source: str, score: float = 1.0) -> str:
    """The spans of one detector in a named column as an SQL expression."""
    found = find_spans_sql(text, d.java, d.head, d.tail)
    if d.needs:
        found = f"case when {text} rlike {quoted(d.needs)} then {found} when {text} is not null then {NO_SPANS} end"
    fields = f"'seq', cast({order} as bigint) * 1000000 + i, 'begin', s.begin, 'end', s.end, 'main_class', {quoted(d.main_class)}, 'sub_class', {quoted(d.sub_class)}, 'score', cast({score} as double), 'source', {quoted(source)}"
    return f"transform({found}, (s, i) -> named_struct({fields}))"


def detect_arrays(df: DataFrame, text: str, detectors: tuple[Detector, ...], source: str, into: str = "spans") -> DataFrame:
    """``df`` with an array of the spans of all detectors, each searched for once."""
    column = "`" + text.replace("`", "``") + "`"
    return df.withColumn(into, F.expr("concat(" + ", ".join(spans_sql(column, d, k, source) for k, d in enumerate(detectors)) + ")"))


def detect(df: DataFrame, key: str, text: str, detectors: tuple[Detector, ...], source: str = "rules") -> DataFrame:
    """One row per span: ``key`` and the fields of an annotation, plus ``covered``."""
    found = spread(detect_arrays(df.select(key, text), text, detectors, source), "spans", key, text)
    return found.select(key, "s.*", F.col(text).substr(F.col("s.begin") + 1, F.col("s.end") - F.col("s.begin")).alias("covered"))


class SpanModel(Protocol):
    """A pluggable model: texts in, spans out.  Loaded once per task."""

    def load(self) -> None: ...

    def predict(self, texts: list[str]) -> list[list[dict]]: ...


def model_info(folder: str) -> dict[str, str]:
    """Name and time stamp of a model folder ``.._<date>_<time>``: the last part of
    the name in its config.json, and the last two parts of the folder's own."""
    with open(os.path.join(folder, "config.json"), encoding="utf-8") as f:
        name = json.load(f)["_name_or_path"].split("/")[-1]
    return {"name": name, "stamp": "_".join(os.path.basename(os.path.normpath(folder)).split("_")[-2:])}


def model_pair_name(superclass: str, subclass: str) -> str:
    """The name of a run of two models; of each the part behind the last slash."""
    return f"{superclass.split('/')[-1]}_{subclass.split('/')[-1]}"


def split_label(label: str) -> tuple[str, str]:
    """``Class_SUB`` as class and subclass; a label without ``_`` has the subclass ''."""
    main, _, sub = label.partition("_")
    return main, sub


def model_spans(df: DataFrame, key: str, text: str, make_model: Callable[[], SpanModel], source: str = "model", start: str | None = None) -> DataFrame:
    """Spans of a model, by Arrow batches; each prediction has begin, end, label and score.

    With ``start`` the texts are chunks that begin there in their document, and
    the spans are led back to it.  Null texts have none.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()
        model.load()
        for b in batches:
            rows = [(k, i, at + p["begin"], at + p["end"], *split_label(p["label"]), float(p.get("score", 1.0)), source) for k, at, ps in zip(b["k"], b["at"], model.predict(b["t"].tolist())) for i, p in enumerate(ps)]
            yield pd.DataFrame(rows, columns=[key, "seq", "begin", "end", "main_class", "sub_class", "score", "source"])

    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"), (F.col(start) if start else F.lit(0)).cast("bigint").alias("at"))
    return rows.where(F.col("t").isNotNull()).mapInPandas(run, f"{key} {kind}, {ANNOTATION}")


def apply_callbacks(df: DataFrame, key: str, text: str, spans: str, fix: Callable[[dict, str], list[dict]] | None = None, new: Callable[[str], list[dict]] | None = None) -> DataFrame:
    """User functions over annotated texts: ``(key, seq, begin, end, main_class, sub_class, score, source)``.

    ``fix(annotation, text)`` answers the annotations that take its place (none,
    one or several); ``new(text)`` gives more.  By Arrow batches; the functions
    must be picklable.  Null texts and arrays count as empty.
    """
    kind = df.schema[key].dataType.simpleString()
    fields = ["begin", "end", "main_class", "sub_class", "score", "source"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, t, ss in zip(b["k"], b["t"], b["s"]):
                if t is None:
                    continue
                given = [dict(s) for s in ss] if ss is not None else []
                out = [x for s in given for x in (fix(s, t) if fix else [s])] + (list(new(t)) if new else [])
                rows += [(k, i, *(x.get(f) for f in fields)) for i, x in enumerate(out)]
            yield pd.DataFrame(rows, columns=[key, "seq", *fields])

    return df.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(spans).alias("s")).mapInPandas(run, f"{key} {kind}, {ANNOTATION}")
