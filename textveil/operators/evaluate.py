"""Strict evaluation of entities at several granularities, and token accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textveil.functions.spans import spread

# Classes that take part in an evaluation.
CLASSES = ("Age", "Contact", "Date", "ID", "Location", "Name", "Profession", "Other")


def blind(main_class: Column, sub_class: Column, level: int | Column) -> Column:
    """The label at a granularity: 2 class and subclass (Other is REDACTED), 1 class, 0 REDACTED."""
    if isinstance(level, Column):
        return F.when(level == 2, blind(main_class, sub_class, 2)).when(level == 1, main_class).otherwise("REDACTED")
    if level == 2:
        return F.when(main_class == "Other", "REDACTED").otherwise(F.concat_ws("_", main_class, sub_class))
    return main_class if level == 1 else F.lit("REDACTED")


def expected(df: DataFrame, labels: list[str], level: int = 2, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Annotations of the known CLASSES with one of the expected labels, as
    ``label`` at the granularity; ``labels`` are ``Class_SUB``, of which ``ignore``
    (subclasses) are left out first.  At granularity 1 the classes of the labels count."""
    wanted = [x for x in labels if x.partition("_")[2] not in ignore]
    names = sorted({x.partition("_")[0] for x in wanted}) if level == 1 else wanted
    known = df.where(F.col("main_class").isin(*CLASSES))
    return known.withColumn("label", blind(F.col("main_class"), F.col("sub_class"), level)).where(F.col("label").isin(names))


def matches(gold: DataFrame, pred: DataFrame, keys: tuple[str, ...] = ("doc", "label", "begin", "end")) -> DataFrame:
    """Each entity once, with ``g`` and ``p``: whether gold and prediction have it."""
    g = gold.select(*keys).distinct().withColumn("g", F.lit(1))
    p = pred.select(*keys).distinct().withColumn("p", F.lit(1))
    return g.join(p, list(keys), "full").fillna(0, ["g", "p"])


def matches_within(df: DataFrame, key: str, gold: str, pred: str, level: int | Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """As :func:`matches`, for span arrays ``gold`` and ``pred`` of one row: no
    join and no shuffle.  ``(doc, label, begin, end, g, p)``; keys are taken as unique,
    a null array counts as empty.  Columns ``keep`` of the row come along."""
    entity = lambda s: F.struct(blind(s["main_class"], s["sub_class"], level).alias("label"), s["begin"].alias("begin"), s["end"].alias("end"))
    none = F.expr("cast(array() as array<struct<label:string,begin:int,end:int>>)")
    sets = df.select(F.col(key).alias("doc"), *keep, *[F.array_distinct(F.coalesce(F.transform(c, entity), none)).alias(n) for c, n in ((gold, "_g"), (pred, "_p"))])
    rows = sets.withColumn("_all", F.array_union("_g", "_p"))
    flag = lambda side: F.array_contains(side, F.col("s")).cast("int")
    return spread(rows, "_all", "doc", *keep, "_g", "_p").select("doc", *keep, "s.*", flag(F.col("_g")).alias("g"), flag(F.col("_p")).alias("p"))


def _rates(df: DataFrame) -> DataFrame:
    zero = lambda num, den: F.when(den == 0, F.lit(0.0)).otherwise(F.round(num / den, 4))
    df = df.withColumn("total_gt", F.col("tp") + F.col("fn")).withColumn("total_pred", F.col("tp") + F.col("fp"))
    df = df.withColumn("precision", zero(F.col("tp"), F.col("total_pred"))).withColumn("recall", zero(F.col("tp"), F.col("total_gt")))
    both = F.col("precision") + F.col("recall")
    return df.withColumn("f1", zero(2 * F.col("precision") * F.col("recall"), both))


def _counts() -> list:
    return [F.sum(F.expr("g * p")).alias("tp"), F.sum(F.expr("(1 - g) * p")).alias("fp"), F.sum(F.expr("g * (1 - p)")).alias("fn")]


def strict_summary(matched: DataFrame) -> DataFrame:
    """A row per label and one named ``strict`` over all: counts and rates."""
    out = matched.rollup("label").agg(*_counts(), F.grouping("label").alias("_all"))
    out = out.withColumn("eval_name", F.when(F.col("_all") == 1, "strict").otherwise(F.col("label"))).withColumn("tn", F.lit(0).cast("bigint")).fillna(0, ["tp", "fp", "fn"])
    return _rates(out.drop("label", "_all"))


def strict_by_document(matched: DataFrame, docs: DataFrame) -> DataFrame:
    """The same within each document; every document of ``docs(doc)`` has its ``strict`` row."""
    per = matched.groupingSets([("doc", "label"), ("doc",)], "doc", "label").agg(*_counts(), F.grouping("label").alias("_all"))
    per = per.withColumn("eval_name", F.when(F.col("_all") == 1, "strict").otherwise(F.col("label"))).drop("label", "_all")
    empty = docs.select("doc").distinct().join(per.select("doc").distinct(), "doc", "left_anti").select("doc", *[F.lit(0).cast("bigint").alias(c) for c in ("tp", "fp", "fn")], F.lit("strict").alias("eval_name"))
    return _rates(per.unionByName(empty).withColumn("tn", F.lit(0).cast("bigint")))


#: Sheets of a report, by granularity: per document, in all.
SHEETS = {1: ("doc_only_type", "sum_only_type"), 2: ("doc_with_kind", "sum_with_kind")}


def report(df: DataFrame, key: str, gold: str, pred: str) -> DataFrame:
    """The four sheets of an evaluation in one table with the column ``sheet``.

    Both granularities, per document (every document has its ``strict`` row) and
    in all (``document`` is null): one pass over the rows, one aggregate.
    """
    both = df.select(key, gold, pred, F.explode(F.array(F.lit(1), F.lit(2))).alias("level"))
    m = matches_within(both, key, gold, pred, F.col("level"), ("level",))
    # an entity-less marker gives each document its row
    marker = both.select(F.col(key).alias("doc"), "level", *[F.lit(None).cast(m.schema[c].dataType).alias(c) for c in ("label", "begin", "end")], F.lit(0).alias("g"), F.lit(0).alias("p"))
    sets = [("level", "doc", "label"), ("level", "doc"), ("level", "label"), ("level",)]
    out = m.unionByName(marker).groupingSets(sets, "level", "doc", "label").agg(*_counts(), F.grouping("label").alias("_all"), F.grouping("doc").alias("_sum"))
    out = out.where("_all = 1 or label is not null")
    sheet = F.element_at(F.create_map(*[x for lv, names in SHEETS.items() for i, n in enumerate(names) for x in (F.lit(2 * lv + i), F.lit(n))]), 2 * F.col("level") + F.col("_sum"))
    named = out.select(sheet.alias("sheet"), F.col("doc").alias("document"), F.when(F.col("_all") == 1, "strict").otherwise(F.col("label")).alias("eval_name"), "tp", "fp", "fn", F.lit(0).cast("bigint").alias("tn"))
    return _rates(named)


def report_line() -> Column:
    """A metric row as a line of a console table."""
    return F.format_string("%-24s P %.4f R %.4f F1 %.4f (tp %d fp %d fn %d)", "eval_name", "precision", "recall", "f1", "tp", "fp", "fn")


def token_accuracy(pairs: DataFrame, gold: str, pred: str) -> DataFrame:
    """Tokens and the share of them with equal tags."""
    return pairs.agg(F.count(F.lit(1)).alias("n_tokens"), F.avg((F.col(gold) == F.col(pred)).cast("double")).alias("accuracy"))


def bio_entities(toks: DataFrame, key: str, order: str, tag: str) -> DataFrame:
    """Entities of a BIO sequence as ``(doc, label, begin, end)`` over token numbers."""
    from textveil.operators.tokens import islands
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(order)
    name = F.regexp_replace(tag, "^[BI]-", "")
    same = (name == F.lag(name).over(w)) & ~F.col(tag).startswith("B-")
    t = islands(toks.select(key, order, tag), key, order, tag, ~F.coalesce(same, F.lit(False))).where(F.col(tag) != "O")
    return t.groupBy(F.col(key).alias("doc"), "island").agg(F.first(name).alias("label"), F.min(order).alias("begin"), F.max(order).alias("end")).drop("island")


def box_stats(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """What a box plot draws: quartiles, whiskers' ends and the mean per group."""
    p = lambda q: F.percentile(F.col(value), F.lit(q))
    return df.groupBy(*by).agg(F.count(value).alias("n"), F.min(value).alias("low"), p(0.25).alias("q1"), p(0.5).alias("median"), p(0.75).alias("q3"), F.max(value).alias("high"), F.avg(value).alias("mean"))
