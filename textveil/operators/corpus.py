"""Corpus preparation: deduplicate, limit, sample, balance, split, check leaks."""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each group in the given order (which must be total to be repeatable)."""
    lead = df.groupBy(*by).agg(F.min(F.struct(*order)).alias("_first")).select(*[F.col(c).alias(f"_{c}") for c in by], *[F.col(f"_first.{o}").alias(f"_o_{o}") for o in order])
    cond = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by] + [F.col(o).eqNullSafe(F.col(f"_o_{o}")) for o in order]
    on = cond[0]
    for c in cond[1:]:
        on = on & c
    return df.join(lead, on, "left_semi")


def first_accepted(df: DataFrame, accept: Column, order: list[str], n: int) -> DataFrame:
    """The first ``n`` accepted rows in order: a top-n, never a full sort into one task."""
    return df.where(accept).orderBy(*order).limit(n)


def annotated(df: DataFrame, spans: str) -> DataFrame:
    """Rows with at least one annotation."""
    return df.where(F.size(spans) > 0)


def typed_keys(mapping: DataFrame, type_column: str, wanted: str, keep: list[str], by: str) -> DataFrame:
    """The columns ``keep`` of the rows of one type, the first of each ``by`` (by all of ``keep``)."""
    rows = mapping.where((F.trim(type_column) == wanted) & F.col(by).isNotNull()).select(*keep)
    first = F.min(F.struct(*[c for c in keep if c != by])).alias("_f")
    return rows.groupBy(by).agg(first).select(*[by if c == by else f"_f.{c}" for c in keep])


def corpus_union(parts: dict[str, DataFrame]) -> DataFrame:
    """Several corpora as one, with their names as ``document_type``."""
    out = None
    for name, df in parts.items():
        tagged = df.select(F.lit(name).alias("document_type"), *df.columns)
        out = tagged if out is None else out.unionByName(tagged)
    return out


def seeded_offsets(ids: list, low: int = -14, high: int = 15, years: tuple[int, int] = (-2, 3), seed: int = 42) -> list[tuple]:
    """``(id, days, years)``: draws of a seeded generator over the sorted ids, never 0.

    For small corpora whose draws must be repeated; ``high`` is excluded.
    """
    rng = random.Random(seed)
    allowed = [[x for x in range(*r) if x] for r in ((low, high), years)]
    return [(i, *(rng.choice(a) for a in allowed)) for i in sorted(ids)]


def portable_hash(c: Column) -> Column:
    """A number from md5 that any engine can repeat."""
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("bigint")


def sample_patients(patients: DataFrame, key: str, percent: float, seed: int | None = None) -> DataFrame:
    """``ceil(percent * n / 100)`` patients: by hash, or with ``seed`` by a seeded
    draw from the sorted ids (driver; for small corpora and repeatability)."""
    ids = patients.select(key).distinct()
    n = ids.count()
    k = math.ceil(percent * n / 100)
    if seed is not None:
        drawn = random.Random(seed).sample(sorted(r[0] for r in ids.collect()), k)
        return ids.where(F.col(key).isin(drawn))
    # a histogram of hashes tells below which all are taken; only the bucket on the edge is put in order
    hashed = ids.withColumn("_h", portable_hash(F.col(key))).withColumn("_b", F.shiftright("_h", 20).cast("int"))
    edge, before = None, 0
    for r in hashed.groupBy("_b").count().orderBy("_b").collect():  # 4,096 buckets at most
        if before + r["count"] > k:
            edge = r["_b"]
            break
        before += r["count"]
    if edge is None:
        return ids
    rest = hashed.where(F.col("_b") == edge).orderBy("_h", key).limit(k - before)
    return hashed.where(F.col("_b") < edge).select(key).unionAll(rest.select(key))


def train_test(docs: DataFrame, train_patients: DataFrame, patient: str) -> DataFrame:
    """``docs`` with ``phase``: train where the patient is sampled, else test."""
    t = train_patients.select(patient).distinct().withColumn("_t", F.lit(1))
    return docs.join(t, patient, "left").withColumn("phase", F.when(F.col("_t") == 1, "train").otherwise("test")).drop("_t")


def label_histogram(annotations: DataFrame) -> DataFrame:
    return annotations.groupBy("main_class", "sub_class").agg(F.count(F.lit(1)).alias("n"))


def patients_per_label(annotations: DataFrame, patient: str, label: str) -> DataFrame:
    """Patients that have the label, with how often."""
    main, _, sub = label.partition("_")
    hit = annotations.where((F.col("main_class") == main) & (F.col("sub_class") == sub))
    return hit.groupBy(patient).agg(F.count(F.lit(1)).alias("n"))


def train_share(annotations: DataFrame) -> DataFrame:
    """Per label: rows in all, in train, and the train share in percent."""
    return annotations.groupBy("main_class", "sub_class").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("phase") == "train").cast("bigint")).alias("n_train")).withColumn("train_percent", F.round(100 * F.col("n_train") / F.col("n"), 2))


#: Labels that are left out of balancing.
SKIP_BALANCE = ("Name_PATIENT", "Name_OTHER", "PROFESSION", "ORGANIZATION")


def balance(counts: list[tuple[str, str, int]], train: set[str], low: float = 0.7, high: float = 0.8) -> set[str]:
    """Patients to take out of train so that no label's train share stays above ``high``.

    ``counts`` is (patient, label, n), one aggregate of the corpus; the loop is
    greedy: rarest label first, its smallest patient whose removal lands
    between the bounds, else the smallest; start again after each removal.
    """
    total: dict[str, int] = {}
    of: dict[str, dict[str, int]] = {}
    for p, label, n in counts:
        total[label] = total.get(label, 0) + n
        of.setdefault(label, {})[p] = of.get(label, {}).get(p, 0) + n
    removed: set[str] = set()
    changed = True
    while changed:
        changed = False
        for label in sorted(total, key=lambda x: (total[x], x)):
            if total[label] <= 1 or any(label == s or label.endswith("_" + s) for s in SKIP_BALANCE):
                continue
            kept = {p: n for p, n in of[label].items() if p in train and p not in removed}
            have = sum(kept.values())
            if have <= high * total[label] or len(kept) < 2:
                continue
            order = sorted(kept.items(), key=lambda x: (x[1], x[0]))
            fit = [p for p, n in order if have - high * total[label] < n < have - low * total[label]]
            removed.add(fit[0] if fit else order[0][0])
            changed = True
            break
    return removed


#: Most (patient, label) counts that the greedy balancing takes to the driver.
MAX_BALANCED = 5_000_000


def balanced_patients(annotations: DataFrame, train: DataFrame, patient: str, low: float = 0.7, high: float = 0.8) -> DataFrame:
    """``train`` without the patients that :func:`balance` takes out.

    The greedy loop is sequential and runs on the driver over one row per
    (patient, label); more than MAX_BALANCED of them raise instead of filling it.
    """
    counts = annotations.groupBy(patient, F.concat_ws("_", "main_class", "sub_class").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    flagged = counts.join(train.select(patient).distinct().withColumn("_t", F.lit(1)), patient, "left")
    rows = flagged.limit(MAX_BALANCED + 1).toArrow()
    if len(rows) > MAX_BALANCED:
        raise ValueError("too many patients and labels to balance; raise MAX_BALANCED or balance a sample")
    p, label, n, t = (rows.column(c).to_pylist() for c in (patient, "label", "n", "_t"))
    out = balance(list(zip(p, label, n)), {x for x, y in zip(p, t) if y}, low, high)
    gone = train.sparkSession.createDataFrame([(x,) for x in sorted(out)], train.select(patient).schema)
    return train.join(gone, patient, "left_anti")


def leak_flags(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Rows of both sides with ``leaks``: whether the key stands in both."""
    common = train.select(key).intersect(test.select(key)).where(F.col(key).isNotNull()).withColumn("_c", F.lit(1))
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.join(common, key, "left").withColumn("leaks", F.col("_c").isNotNull()).drop("_c")
