"""Reading level of each text, by a familiar-word formula.

Familiar words come from the corpus itself: document frequencies by language.
A sentence is described by its length and by the shares of its words outside
lists of falling familiarity; a linear formula over these, fitted to rated
texts, gives each sentence a level, and a text has the level of most of its
sentences.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textveil.llm.keys import filled, label
from textveil.session import cut

#: Buckets of words; they bound the lists, which are collected and broadcast.
BUCKETS = 1 << 18
#: Most languages with lists of their own; all others share one list.
LANGUAGES = 15
#: Edges of familiarity: shares of a language's texts that hold a word.
EDGES = np.array([1e-4, 3e-3, 0.01, 0.02, 0.04, 0.08, 0.12, 0.18, 0.25, 0.35])
#: Most rated texts the formula is fitted to (by the order of a hash).
MAX_RATED = 4000
LEVELS = (1, 2, 3, 4)
ROUNDS, STEPS = 4, 200

# where a sentence may end: a stop before a capital letter, a stop at a line end, a blank line, a stop of other scripts
_ENDS = re.compile(r"[.!?](?:([\"“”]?\s+)(?=[A-ZÄÖÜ„“\"])|(\s*[\r\n]))|((?:\r\n|\r|\n)\s*(?:\r\n|\r|\n)|(?<=[。！？।]))")
# what stands before a stop that ends a sentence: a word, a bracket, a decimal, an acronym; no abbreviation or ordinal
_CLOSED = re.compile(r"(?:[^\W\d_]{3}|[)“”\"%]|\d[,.]\d\d?|[A-Z0-9]{3})\Z")
_TOKEN = re.compile(r"[^\W\d_]+|[\x00\x01]")
_MARKS = str.maketrans("\x00\x01", "  ")


def _mark(m: re.Match) -> str:
    """A sentence end becomes a mark; other stops stay."""
    if m.group(3) is not None:
        return "\x00"
    at = m.start()
    if m.group(1) is not None:
        before = m.string[max(0, at - 4) : at]
        if _CLOSED.search(before) and (m.string[at] == "." or not re.search(r"\d[,.]\d\d?\Z", before) or re.search(r"[A-Z0-9]{3}\Z", before)):
            return m.group(0)[0] + "\x00"
        space = m.group(1)
        cut_ = max(space.rfind("\n"), space.rfind("\r"))
        return m.group(0) if cut_ < 0 or space[0] in "\"“”" else m.group(0)[0] + "\x00" + space[cut_ + 1 :]
    return m.group(0)[0] + "\x00"


class _Buckets(dict):
    """Words to their bucket, with their length in the low bits."""

    def __missing__(self, w: str) -> int:
        if len(self) > 300_000:
            self.clear()
            self.update({"\x00": -1, "\x01": -2})
        n = self[w] = (crc32(w.encode("utf-8", "replace")) % BUCKETS) * 64 + min(len(w), 63)
        return n


_bucket = _Buckets({"\x00": -1, "\x01": -2})


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text as its words and the sizes of its sentences: the only pass over text."""
    for b in batches:
        marked = [_ENDS.sub(_mark, t.translate(_MARKS) if "\x00" in t or "\x01" in t else t) for t in b.column("text").to_pylist()]
        got = np.fromiter(map(_bucket.__getitem__, _TOKEN.findall("".join(f"{t}\x00\x01" for t in marked).lower())), np.int64)
        ends = np.flatnonzero(got == -1)
        texts = np.flatnonzero(got == -2)
        before = np.concatenate([[-1], ends[:-1]]) if len(ends) else ends
        size = ends - before - 1
        size -= np.searchsorted(texts, ends) - np.searchsorted(texts, before)  # marks of text ends lie between
        of = np.searchsorted(texts, ends)
        full = size > 0
        words = got[got >= 0]
        n_words = np.bincount(of[full], size[full], b.num_rows).astype(np.int64)
        off = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
        sizes = pa.ListArray.from_arrays(off(np.bincount(of[full], minlength=b.num_rows)), pa.array(size[full].astype(np.int32)))
        ids = pa.ListArray.from_arrays(off(n_words), pa.array(words.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("lang"), sizes, ids], ["doc_id", "lang", "sizes", "ids"])


def _flat(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of all sentences, their texts, all words, and theirs."""
    per, words = np.diff(b.column("sizes").offsets.to_numpy()), np.diff(b.column("ids").offsets.to_numpy())
    m = np.arange(b.num_rows)
    return b.column("sizes").flatten().to_numpy().astype(np.int64), np.repeat(m, per), b.column("ids").flatten().to_numpy().astype(np.int64), np.repeat(m, words)


def _count(languages: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros((len(languages) + 1) * BUCKETS, np.int64)
        number = {l: i for i, l in enumerate(languages)}
        for b in batches:
            _, _, word, of = _flat(b)
            lang = np.array([number.get(l, len(languages)) for l in b.column("lang").to_pylist()], np.int64)
            once = np.unique(of * BUCKETS + (word >> 6))
            df += np.bincount(lang[once // BUCKETS] * BUCKETS + once % BUCKETS, minlength=len(df))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], ["bucket", "n"])

    return count


def familiarity(words: DataFrame) -> np.ndarray:
    """``[language, bucket]``: share of a language's texts that hold the word.

    Languages are codes of two letters that one text in two hundred has, the
    LANGUAGES most frequent of them; the texts of all others, and those without a
    code, make up one list, so every text teaches.  A text is read with the list
    that suits it best.
    """
    all_ = words.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()  # codes of two letters
    n_texts = sum(r["count"] for r in all_)
    if not n_texts:
        return np.full((1, BUCKETS), 5e-5)
    own = [r for r in all_ if r["lang"] is not None and r["count"] >= 0.005 * n_texts][:LANGUAGES]
    names = [r["lang"] for r in own]
    total = np.array([*(r["count"] for r in own), n_texts - sum(r["count"] for r in own)], np.float64)
    got = words.mapInArrow(_count(names), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    flat = np.zeros((len(names) + 1) * BUCKETS)
    flat[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    share = flat.reshape(len(names) + 1, BUCKETS) / np.maximum(total, 1)[:, None]
    return np.maximum(share[total > 0], 5e-5).astype(np.float32)


def describe(b: pa.RecordBatch, share: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(features, text of each row)`` of all sentences of a batch."""
    n, of, word, _ = _flat(b)
    if not len(n):
        return np.zeros((0, len(EDGES) + 5)), np.zeros(0, np.int64)
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    known = np.stack([np.add.reduceat(l[word >> 6].astype(np.float64), first) for l in logs]) / n
    best = known.argmax(0)
    own = np.repeat(best, n)
    level = np.searchsorted(EDGES, share[own, word >> 6])
    bins = np.bincount(np.repeat(np.arange(len(n)), n) * (len(EDGES) + 1) + level, minlength=len(n) * (len(EDGES) + 1)).reshape(len(n), -1) / n[:, None]
    outside = np.cumsum(bins, 1)[:, :-1]  # share of words outside each list
    length = np.add.reduceat((word & 63).astype(np.float64), first) / n
    x = np.column_stack([np.ones(len(n)), n / 10, np.log(n), length / 5, known.max(0) / 5, outside])
    return x, of


class Formula:
    """Linear scores of the levels over standardised features."""

    def __init__(self, w: np.ndarray, mean: np.ndarray, scale: np.ndarray, fallback: int):
        self.w, self.mean, self.scale, self.fallback = w, mean, scale, fallback

    def scores(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.w


def fit(x: np.ndarray, y: np.ndarray, bonus: float = 1.0) -> Formula:
    """Fit the formula to sentences whose texts have levels ``y`` (0-based).

    A rated text also holds sentences of other levels, so the levels of the
    sentences are hidden: they start as the text's and are drawn anew from the
    formula in each round, with a bonus for the text's own.
    """
    k = len(LEVELS)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    mean[0], scale[0] = 0, 1
    z = (x - mean) / scale
    cur = y.copy()
    w = np.zeros((x.shape[1], k))
    for _ in range(ROUNDS):
        weight = 1 / np.sqrt(np.maximum(np.bincount(cur, minlength=k), 1))[cur]
        weight /= weight.sum()
        t = np.eye(k)[cur]
        speed = np.zeros_like(w)
        for _ in range(STEPS):
            s = z @ w
            p = np.exp(s - s.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            speed = 0.8 * speed - 0.5 * (z.T @ ((p - t) * weight[:, None]) + 1e-4 * w)
            w = w + speed
        s = z @ w
        s[np.arange(len(y)), y] += bonus
        cur = s.argmax(1)
    return Formula(w, mean, scale, int(np.bincount(y, minlength=k).argmax()))


def rated_levels(labels: DataFrame) -> DataFrame:
    """``(doc_id, y)``: the level most raters gave (ties: the lower); nulls and others are left out."""
    votes = labels.where(F.col("reading_level").isin(*LEVELS) & F.col("doc_id").isNotNull()).groupBy("doc_id", "reading_level").count()
    best = votes.groupBy("doc_id").agg(F.max(F.struct("count", (-F.col("reading_level")).alias("neg"))).alias("v"))
    return best.select("doc_id", (-F.col("v.neg")).alias("y"))


def reading_levels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id bigint, reading_level bigint, n_sentences int, words_per_sentence
    double, unfamiliar_share double)`` of each text neither null nor blank.

    ``unfamiliar_share`` counts words outside the list of those that at least
    2 % of the language's texts hold.  Ties between levels go to the one with
    the higher total score; a text without words has the level most rated texts
    have.  Without ratings every level is null.  Repeated rows come out again.
    """
    lang = F.substring(label(F.col("lang")), 1, 2)
    texts = docs.where(filled(F.col("text"))).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.nullif(lang, F.lit("un")).alias("lang"), "text")
    words = cut(texts.mapInArrow(_arrays, "doc_id bigint, lang string, sizes array<int>, ids array<int>"))
    share = familiarity(words)
    rated = cut(rated_levels(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_RATED))
    # at most MAX_RATED ids of 16 bytes are broadcast, and the word arrays of as many texts collected
    sample = words.join(F.broadcast(rated), "doc_id").select("y", "sizes", "ids").toArrow()
    formula = None
    if len(sample):
        x, of = describe(sample.combine_chunks().to_batches()[0], share, np.log(share))
        if len(of):
            formula = fit(x, sample.column("y").to_numpy().astype(np.int64)[of] - 1)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, logs = len(LEVELS), np.log(share)
        for b in batches:
            m = b.num_rows
            x, of = describe(b, share, logs)
            sentences = np.bincount(of, minlength=m)
            total = np.bincount(of, x[:, 1] * 10, minlength=m) if len(of) else np.zeros(m)
            odd = np.bincount(of, x[:, 1] * 10 * x[:, 8], minlength=m) if len(of) else np.zeros(m)
            if formula is None:
                levels = pa.nulls(m, pa.int64())
            else:
                s = formula.scores(x)
                p = np.exp(s - s.max(1, keepdims=True)) if len(s) else s
                p = p / p.sum(1, keepdims=True) if len(s) else p
                votes = np.bincount(of * k + p.argmax(1), minlength=m * k).reshape(m, k).astype(float) if len(of) else np.zeros((m, k))
                for j in range(k if len(of) else 0):
                    votes[:, j] += np.bincount(of, p[:, j], minlength=m) / (2 * np.maximum(sentences, 1))
                levels = pa.array(np.where(sentences > 0, votes.argmax(1), formula.fallback) + 1, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), levels, pa.array(sentences.astype(np.int32)), pa.array(total / np.maximum(sentences, 1)), pa.array(odd / np.maximum(total, 1))],
                ["doc_id", "reading_level", "n_sentences", "words_per_sentence", "unfamiliar_share"],
            )

    return words.select("doc_id", "sizes", "ids").mapInArrow(judge, "doc_id bigint, reading_level bigint, n_sentences int, words_per_sentence double, unfamiliar_share double")


def source_profile(docs: DataFrame, levels: DataFrame) -> DataFrame:
    """Texts per source and level, with the mean measures."""
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), label(F.col("source")).alias("source"))
    return levels.join(named, "doc_id").groupBy("source", "reading_level").agg(F.count(F.lit(1)).alias("n_docs"), F.avg("words_per_sentence").alias("words_per_sentence"), F.avg("unfamiliar_share").alias("unfamiliar_share"))
