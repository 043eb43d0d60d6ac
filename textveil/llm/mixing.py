"""Mixing sources to target weights, in tokens of a public tokenizer.

Weights are tempered: the shares of the sources' tokens are exponentiated, and
the exponent is bisected to a target entropy or to a limit on repetitions.
Where target shares are stated they are the weights themselves, tempered towards
what the repetition limits allow only as far as a larger budget demands.  The
weights are then realised by taking, of each source, whole passes over a fixed
random permutation of its texts and the leading part of one more, block by
block, so that no task ever holds a source.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textveil.llm.keys import filled, label
from textveil.session import cut

#: File of the vocabulary, ranks of a byte-level BPE, where neither the call nor the
#: session (textveil.vocabulary) names one.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the published pattern by which such tokenizers split text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Blocks of a source's permutation; the driver sees one sum of each.
BLOCKS = 256
#: Most sources; their shares are collected.
MAX_SOURCES = 10_000

_encoders: dict[str, object] = {}


def encoder(vocabulary: str):
    """The tokenizer of a vocabulary file, once per process."""
    if vocabulary not in _encoders:
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[vocabulary] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[vocabulary]


def count_tokens(df: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``df`` with ``n_tokens``; null counts 0."""
    rest = [c for c in df.columns if c != text]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in rest], pa.array(n, pa.int64())], [*rest, "n_tokens"])

    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([*[df.schema[c] for c in rest], StructField("n_tokens", LongType())])
    return df.select(*rest, text).mapInArrow(count, schema)


def _bisect(ok, lo: float, hi: float, steps: int = 60) -> float:
    """The largest x in [lo, hi] with ok(x), where ok holds at lo and fails from some x on."""
    if ok(hi):
        return hi
    for _ in range(steps):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if ok(mid) else (lo, mid)
    return lo


def temper(tokens: dict[str, int], exponent: float) -> dict[str, float]:
    """Normalised ``share ** exponent`` of each source with tokens."""
    total = sum(tokens.values())
    w = {s: (n / total) ** exponent for s, n in tokens.items() if n}
    z = sum(w.values())
    return {s: x / z for s, x in w.items()}


def entropy(weights: dict[str, float]) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def weights_for_entropy(tokens: dict[str, int], target: float) -> dict[str, float]:
    """Tempered shares whose entropy is ``target`` (or the nearest there is, between 1 and log n)."""
    return tempered_to(tokens, target)[0]


def tempered_to(tokens: dict[str, int], target: float) -> tuple[dict[str, float], float]:
    """``(weights, exponent)``: entropy falls as the exponent grows from 0 (uniform)."""
    x = _bisect(lambda x: entropy(temper(tokens, x)) >= target, 0.0, 8.0)
    return temper(tokens, x), x


def weights_for_targets(tokens: dict[str, int], targets: dict[str, float], limits: dict[str, int], budget: float | None = None) -> tuple[dict[str, float], float, float]:
    """``(weights, budget, exponent)``.

    Sources with tokens get ``target ** x * capacity ** (1 - x)``, normalised, a
    source's capacity being its share of what the limits allow in all; x is the
    largest in [0, 1] at which no source is repeated beyond its limit at the budget.  Without a budget, the largest one is taken at which
    x = 1 holds: all targets are reached.
    """
    have = {s: t for s, t in targets.items() if tokens.get(s) and t > 0}
    if not have:
        return {}, 0.0, 1.0
    z = sum(have.values())
    goal = {s: t / z for s, t in have.items()}
    most = min(limits[s] * tokens[s] / goal[s] for s in have)
    if budget is None or budget <= most:
        return goal, float(most if budget is None else budget), 1.0
    total = sum(limits[s] * tokens[s] for s in have)
    capacity = {s: limits[s] * tokens[s] / total for s in have}
    budget = min(budget, total)  # more there isn't

    def at(x: float) -> dict[str, float]:
        w = {s: goal[s] ** x * capacity[s] ** (1 - x) for s in have}
        z = sum(w.values())
        return {s: v / z for s, v in w.items()}

    fits = lambda x: all(at(x)[s] * budget <= limits[s] * tokens[s] * (1 + 1e-12) for s in have)
    x = _bisect(fits, 0.0, 1.0)
    return at(x), float(budget), x


def weights_for_mix(tokens: dict[str, int], targets: dict[str, float], limits: dict[str, int], budget: float | None, stretch: float, nats: float | None) -> tuple[dict[str, float], float, float]:
    """``(weights, budget, exponent)`` by a target entropy, else by target shares.

    By entropy the natural shares of all sources that may be used are tempered;
    the budget is the largest at which no limit is passed.  ``stretch`` asks for
    so many times the default budget.
    """
    if nats is None:
        if budget is None and stretch != 1.0:
            budget = stretch * weights_for_targets(tokens, targets, limits)[1]
        return weights_for_targets(tokens, targets, limits, budget)
    have = {s: n for s, n in tokens.items() if n and limits.get(s)}
    if not have:
        return {}, 0.0, 1.0
    w, x = tempered_to(have, nats)
    most = min(limits[s] * have[s] / w[s] for s in have)
    return w, min(most, budget) if budget is not None else most, x


def mix(docs: DataFrame, targets: DataFrame, budget: float | None = None, vocabulary: str | None = None, stretch: float = 1.0, nats: float | None = None) -> tuple[DataFrame, DataFrame]:
    """``(chosen, shares)``.

    ``chosen(doc_id, source, n_tokens, repetitions)``: the records taken, each
    text at most ``max_repeats`` times in all: repeated texts are one text, the
    one with the smallest doc_id among those of a wanted source.
    ``shares(source, target_share, max_repeats, source_tokens, taken_tokens,
    reached_share, exponent)``: what each source of ``targets`` contributes; a
    source without texts reaches 0 and its share goes to the others in
    proportion.  With ``nats`` the shares are the natural ones, tempered to that
    entropy, instead; a ``budget`` in tokens, or a ``stretch`` of the default one,
    beyond what the repetition limits allow tempers the target shares.  Null and
    blank texts, and rows of no wanted source, are not taken; an empty table
    takes nothing.
    """
    vocabulary = vocabulary or docs.sparkSession.conf.get("textveil.vocabulary", VOCABULARY)
    spark = docs.sparkSession
    wanted = targets.select(label(F.col("source")).alias("source"), "target_share", "max_repeats").where("source is not null").dropDuplicates(["source"])
    rows = [r.asDict() for r in wanted.orderBy("source").limit(MAX_SOURCES + 1).collect()]
    if len(rows) > MAX_SOURCES:
        raise ValueError("too many sources")
    names = [r["source"] for r in rows]
    keyed = docs.where(filled(F.col("text"))).select("doc_id", label(F.col("source")).alias("source"), F.sha2("text", 256).alias("digest"), "text").where(F.col("source").isin(names))
    counted = cut(count_tokens(keyed, "text", vocabulary))
    one = counted.groupBy("digest").agg(F.min(F.struct("doc_id", "source", "n_tokens")).alias("r")).select("r.*").where("n_tokens > 0")
    one = cut(one.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(BLOCKS)).cast("int")))
    blocks = one.groupBy("source", "block").agg(F.sum("n_tokens").alias("n")).orderBy("source", "block").collect()
    tokens: dict[str, int] = {}
    for r in blocks:
        tokens[r["source"]] = tokens.get(r["source"], 0) + r["n"]
    limits = {r["source"]: max(0, int(r["max_repeats"] or 0)) for r in rows}
    shares = {r["source"]: float(r["target_share"] or 0.0) if limits[r["source"]] else 0.0 for r in rows}
    weights, size, exponent = weights_for_mix(tokens, shares, limits, budget, stretch, nats)
    # whole passes, and what is left for a part of one more
    plan = {}
    for s, w in weights.items():
        want = min(w * size, limits[s] * tokens[s])
        passes = min(int(want // tokens[s] + 1e-9), limits[s])
        plan[s] = (passes, max(0.0, want - passes * tokens[s]))
    starts, at = [], {}
    for r in blocks:
        if r["source"] in plan:
            starts.append((r["source"], r["block"], at.get(r["source"], 0), *plan[r["source"]]))
            at[r["source"]] = at.get(r["source"], 0) + r["n"]
    begun = spark.createDataFrame(starts, "source string, block int, start bigint, passes int, part double")  # at most MAX_SOURCES * BLOCKS rows
    order = Window.partitionBy("source", "block").orderBy(F.xxhash64("doc_id", F.lit(12)), "doc_id")
    placed = one.join(begun, ["source", "block"]).withColumn("behind", F.col("start") + F.sum("n_tokens").over(order))
    taken = placed.withColumn("repetitions", F.col("passes") + (F.col("behind") <= F.col("part") + 0.5).cast("int"))
    chosen = cut(taken.where("repetitions > 0").select("doc_id", "source", "n_tokens", "repetitions"))
    sums = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repetitions")).alias("taken_tokens"))
    have = spark.createDataFrame([(r["source"], shares[r["source"]], limits[r["source"]], tokens.get(r["source"], 0), exponent) for r in rows], "source string, target_share double, max_repeats int, source_tokens bigint, exponent double") if rows else None
    if have is None:
        have = spark.createDataFrame([], "source string, target_share double, max_repeats int, source_tokens bigint, exponent double")
    total = sums.agg(F.sum("taken_tokens").alias("total"))
    report = have.join(sums, "source", "left").crossJoin(F.broadcast(total))  # one row
    report = report.select("source", "target_share", "max_repeats", "source_tokens", F.coalesce("taken_tokens", F.lit(0)).alias("taken_tokens"), F.coalesce(F.col("taken_tokens") / F.col("total"), F.lit(0.0)).alias("reached_share"), "exponent")
    return chosen, report
