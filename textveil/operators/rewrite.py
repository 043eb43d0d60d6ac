"""Policies and rewriting: keep, redact, replace, shift or substitute a span, and
stitch the text together again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textveil.functions import dates
from textveil.functions.spans import _let, fold_longest, fold_merge, stitch
from textveil.operators.detect import Detector, detect_arrays
from textveil.operators.models import clean_spans

METHODS = ("keep", "redact", "replace", "shift", "substitute")


def policy_table(spark: SparkSession, policy: dict[str, dict[str, str]]) -> DataFrame:
    """The two-level policy as ``(policy_class, policy_sub, method)``, in upper case."""
    rows = [(c.upper(), s.upper(), m) for c, subs in policy.items() for s, m in subs.items()]
    for *_, m in rows:
        if m not in METHODS:
            raise ValueError(f"unknown method {m}")
    return spark.createDataFrame(rows, "policy_class string, policy_sub string, method string")


def method_of(policy: dict[str, dict[str, str]], main_class: Column, sub_class: Column) -> Column:
    """The method for a label; ``replace`` where the policy is silent."""
    pairs = [x for c, subs in policy.items() for s, m in subs.items() for x in (F.lit(f"{c.upper()}.{s.upper()}"), F.lit(m))]
    if not pairs:
        return F.lit("replace")
    return F.coalesce(F.element_at(F.create_map(*pairs), F.concat_ws(".", F.upper(main_class), F.upper(sub_class))), F.lit("replace"))


def tag(main_class: Column, sub_class: Column, only_superclass: bool = False) -> Column:
    return main_class if only_superclass else F.concat_ws("_", main_class, sub_class)


def substitute_name(covered: Column, first: Column, last: Column) -> Column:
    """A fake name in the shape of the covered one: titles stay; one word takes
    the surname, two take both, more give null (no rule)."""
    titles = r"^((?:(?:Prof|Dr|PD|med|Hr|Fr|Herrn?|Frau)\.?\s+)*)"
    kept = F.regexp_extract(covered, titles, 1)
    n = F.size(F.filter(F.split(F.regexp_replace(covered, titles, ""), r"\s+"), lambda w: w != ""))
    return F.when(n == 1, F.concat(kept, last)).when(n == 2, F.concat(kept, first, F.lit(" "), last))


def replacement(s: Column, covered: Column, method: Column, *, days: Column | None = None, years: Column | None = None, first: Column | None = None, last: Column | None = None, guard: bool = True, only_superclass: bool = False, show_original: bool = False) -> Column:
    """The string that stands for a span."""
    main, sub = s["main_class"], s["sub_class"]
    full = tag(main, sub, only_superclass)
    out_tag = (lambda t: F.concat(F.lit("<"), t, F.lit(":"), covered, F.lit(">"))) if show_original else (lambda t: F.concat(F.lit("<"), t, F.lit(">")))
    plain = (lambda t: F.concat(F.lit("<"), t, F.lit(":"), covered, F.lit(">"))) if show_original else (lambda t: t)
    wrong = out_tag(F.concat(main, F.lit("_WRONG")))
    shifted = out_tag(full)
    if days is not None:
        birth = F.lit("Date") if only_superclass else F.lit("Date_BIRTHDATE")
        as_date = _let(dates.shift_date(covered, days), lambda moved: F.when(moved["written"].isNull(), wrong).when(moved["old"] & F.lit(guard), out_tag(birth)).otherwise(plain(moved["written"])))
        as_birth = F.coalesce(plain(dates.shift_birthdate(covered, days, years if years is not None else F.lit(0))), wrong)
        # without an offset nothing is shifted: the tag stands
        shifted = F.when(days.isNull(), shifted).when(sub == "BIRTHDATE", as_birth).when(sub == "DATE", as_date).otherwise(shifted)
    if years is not None:
        shifted = F.when((main == "Age") & years.isNotNull(), F.coalesce(plain(dates.shift_age(covered, years)), wrong)).otherwise(shifted)
    named = out_tag(full)
    if last is not None:
        fake = substitute_name(covered, first if first is not None else F.lit(""), last)
        named = F.when(main == "Name", F.coalesce(plain(fake), out_tag(full))).otherwise(named)
    return F.when(method == "keep", plain(covered)).when(method == "redact", plain(F.repeat(F.lit("X"), F.length(covered)))).when(method == "shift", shifted).when(method == "substitute", named).otherwise(out_tag(full))


def rewrite(df: DataFrame, text: str, spans: str, policy: dict[str, dict[str, str]], into: str = "deid_text", **options) -> DataFrame:
    """``df`` with the text rewritten under the policy, span by span."""
    t = F.col(text)
    guard = policy.get("DATE", {}).get("BIRTHDATE") == "replace"

    def part(s: Column) -> Column:
        covered = t.substr(s["begin"] + 1, s["end"] - s["begin"])
        sub = replacement(s, covered, method_of(policy, s["main_class"], s["sub_class"]), guard=guard, **options)
        return F.struct(s["begin"].alias("begin"), s["end"].alias("end"), sub.alias("sub"))

    return df.withColumn(into, stitch(t, F.transform(F.col(spans), part)))


def deidentify(df: DataFrame, key: str, text: str, detectors: tuple[Detector, ...], policy: dict[str, dict[str, str]] | None = None, merge: bool = False, clean: bool = False, source: str = "rules", **options) -> DataFrame:
    """Detect, resolve, rewrite and stitch: ``(key, deid_text, n_entities)``.

    One scan, no shuffle, no Python: all of it happens within a row.  ``clean``
    trims and splits the rule spans before they are resolved
    (:func:`textveil.operators.models.clean_spans`).  ``days`` and ``years`` may
    be columns of ``df``; a row whose offset is null keeps the tags of its dates.
    """
    out = rewrite(annotate(df, text, detectors, merge, clean, source), text, "spans", policy or {}, **options)
    return out.select(key, "deid_text", F.size("spans").cast("bigint").alias("n_entities"))


def annotate(df: DataFrame, text: str, detectors: tuple[Detector, ...], merge: bool = False, clean: bool = False, source: str = "rules") -> DataFrame:
    """``df`` with the resolved annotations of each text as ``spans``."""
    found = detect_arrays(df, text, detectors, source)
    if clean:
        found = found.withColumn("spans", clean_spans(F.col(text), F.col("spans")))
    return found.withColumn("spans", (fold_merge if merge else fold_longest)(F.col("spans")))
