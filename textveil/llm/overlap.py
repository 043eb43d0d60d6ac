"""Same or near-same texts across splits: an edit-distance segment join.

Word edit distance, at most ``share`` of the longer text's words.  A text of
``n`` words is cut into disjoint segments of ``l`` words, at least one more than
the edits allowed; each edit spoils one segment at most, so of the ``k + 1``
rarest segments at least one stands unchanged in any partner, moved by at most
``k`` places; of the ``k + t`` rarest at least ``t`` do, so what meets less often is
no candidate.  Segments and runs meet under one number made of the words, a band
of lengths and a bucket of places, so hot runs are spread and only what can match
is sent.  Candidates pass a parity sketch (each edit flips at most two bits) and a
bag bound, and the banded dynamic programme decides.  No filter can lose a pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textveil.llm.keys import hex_id, label, phase
from textveil.llm.words import grams, inside, words_of
from textveil.session import cut

SHARE = 0.15
#: Words of a segment, for all but the shortest texts.
SEGMENT = 4
#: 64-bit words of the parity sketch of a text.
SKETCH = 4
#: Of the segments that no edit can spoil, the share that a partner must hold among
#: the rarest: the rest, the commonest ones, need not meet at all.
TAKEN = 0.2
#: Pairs whose distance is worked out at once.
BATCH = 512


def edits(n: int, share: float = SHARE) -> int:
    """Most edits between a text of ``n`` words and any partner within ``share``.

    The partner has at most ``n + k`` words, so ``k = floor(share * (n + k))``.
    """
    k = math.floor(share * n / (1 - share) + 1e-9)
    while k and k > math.floor(share * (n + k) + 1e-9):
        k -= 1
    return k


def segment(n: int, share: float = SHARE) -> int:
    """Words of a segment of a text of ``n`` words: at least ``k + 1`` fit in."""
    return max(1, min(SEGMENT, n // (edits(n, share) + 1)))


def _bounds(share: float) -> np.ndarray:
    """First lengths of bands: texts within ``share`` are in the same or in neighbouring bands."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(math.floor(out[-1] / (1 - share) + 1e-9) + 1)
    return np.array(out, np.int64)


def _band(n: np.ndarray, share: float) -> np.ndarray:
    return np.searchsorted(_bounds(share), n, "right") - 1


def _widths(share: float) -> np.ndarray:
    """For each band, the width of the buckets of places: two at most hold what is
    within the edits of any text of this or a neighbouring band."""
    b = _bounds(share)
    return np.array([2 * edits(int(b[min(j + 2, len(b) - 1)]) - 1, share) + 1 for j in range(len(b))], np.int64)


def _key(run: np.ndarray, band: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """One number for a run of words, a band of lengths and a bucket of places.  Equal
    numbers by chance make candidates, and are found out like all others."""
    h = run.view(np.uint64) ^ (band.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (bucket.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x165667B19E3779F9)
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word array, its digest and its parity sketch for each text with words."""
    for b in batches:
        sizes, flat = words_of(b.column("text").to_pylist())
        keep = np.flatnonzero(sizes)
        n = sizes[keep]
        starts = np.concatenate([[0], np.cumsum(n)])
        w = flat.view(np.uint64)
        text = np.repeat(np.arange(len(n)), n)
        at = (np.arange(len(w)) - starts[:-1][text] + 1).astype(np.uint64)
        mixed = (w ^ (at * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(31)
        again = mixed * np.uint64(0x165667B19E3779F9)
        again ^= again >> np.uint64(29)
        c1, c2 = (np.add.reduceat(x, starts[:-1]).view(np.int64) if len(n) else np.zeros(0, np.int64) for x in (mixed, again))
        bits = np.bincount(text * (64 * SKETCH) + (w >> np.uint64(13)).astype(np.int64) % (64 * SKETCH), minlength=len(n) * 64 * SKETCH) & 1
        sketch = np.packbits(bits.astype(np.uint8)).view(np.int64)
        lists = lambda offsets, values: pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))
        yield pa.RecordBatch.from_arrays(
            [b.column("document").take(pa.array(keep)), pa.array(c1), pa.array(c2), pa.array(n.astype(np.int32)), lists(starts, flat), lists(np.arange(len(n) + 1) * SKETCH, sketch)],
            ["document", "c1", "c2", "n", "ws", "sketch"],
        )


def _flat(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return np.diff(b.column("ws").offsets.to_numpy()), b.column("ws").flatten().to_numpy()


def _lengths(top: int, share: float) -> np.ndarray:
    return np.array([segment(n, share) if n else 1 for n in range(top + 1)], np.int64)


def _segments(share: float):
    """All disjoint segments of a text, and all its runs of a segment's length."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, flat = _flat(b)
            of = _lengths(int(sizes.max(initial=0)), share)[sizes]
            parts = []
            for l in np.unique(of):
                text, place, _ = inside(np.where(of == l, sizes, 0), int(l))
                starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
                take = place % l == 0
                text, place = text[take], place[take]
                parts.append((text, place, grams(flat, int(l))[starts[text] + place]))
            yield _runs(b, parts)

    return cut_up


def _substrings(b: pa.RecordBatch, share: float) -> list:
    """All runs of the texts of a batch that a segment could match: ``(text, place, run)`` by length."""
    sizes, flat = _flat(b)
    top = int(sizes.max(initial=0))
    ls = _lengths(top + edits(max(top, 1), share) + 1, share)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    parts = []
    for l in range(1, SEGMENT + 1):
        # texts that a text of this segment length can be near to
        near = [n for n in range(top + 1) if n >= l and (ls[max(0, n - edits(n, share)) : n + edits(n, share) + 1] == l).any()]
        mine = np.isin(sizes, near)
        if mine.any():
            text, place, _ = inside(np.where(mine, sizes, 0), l)
            parts.append((text, place, grams(flat, l)[starts[text] + place]))
    return parts


class Filter:
    """A bitmap of numbers, put together by the executors: 16 bits for each of them
    (between 2**16 and 2**28 in all), two of which are set.  It lets all of them
    pass, and of others one in seventy; where it had to stay small, more."""

    def __init__(self, numbers_: DataFrame, column: str):
        n = numbers_.count()
        bits = self.bits = 1 << min(28, max(16, math.ceil(math.log2(16 * max(n, 1)))))

        def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at = [np.unique(np.concatenate(self._at(b.column(0).to_numpy()))) for b in batches]
            at = np.unique(np.concatenate(at)) if at else np.zeros(0, np.int64)
            word, first = np.unique(at >> 5, return_index=True)
            value = np.bitwise_or.reduceat(np.int64(1) << (at & 31), first) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value)], ["word", "value"])

        self.map = np.zeros(0, np.uint32)
        got = numbers_.select(column).mapInArrow(collect, "word bigint, value bigint").groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
        self.map = np.zeros(bits >> 5, np.uint32)
        self.map[got.column("word").to_numpy()] = got.column("value").to_numpy().astype(np.uint32)

    def _at(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = x.view(np.uint64)
        again = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(23)
        return (h >> np.uint64(17)).astype(np.int64) % self.bits, again.astype(np.int64) % self.bits

    def passes(self, x: np.ndarray) -> np.ndarray:
        ok = np.ones(len(x), bool)
        for at in self._at(x):
            ok &= (self.map[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1
        return ok


def _counted_runs(share: float, wanted: Filter):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            runs = [p[2][wanted.passes(p[2])] for p in _substrings(b, share)]
            run, n = np.unique(np.concatenate(runs) if runs else np.zeros(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(run), pa.array(n)], ["run", "n"])

    return count


def _probes(share: float):
    """The keys under which the partners of a segment are found: by band and bucket."""
    width = _widths(share)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            run, n, place, k = (b.column(c).to_numpy().astype(np.int64) for c in ("run", "n", "place", "k"))
            rows, keys = [], []
            for step in (-1, 0, 1):
                band = _band(n, share) + step
                ok = np.flatnonzero(band >= 0)
                w = width[band[ok]]
                lo, hi = (place[ok] - k[ok]) // w, (place[ok] + k[ok]) // w
                for bucket, at in ((lo, ok), (hi, ok[hi > lo])):
                    bucket = bucket if at is ok else hi[hi > lo]
                    rows.append(at)
                    keys.append(_key(run[at], band[at], bucket))
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), *[b.column(c).take(at) for c in ("cls", "n", "place", "k", "t", "sketch")]], ["key", "a", "na", "pa", "k", "t", "sketch"])

    return emit


def _wanted_runs(share: float, wanted: Filter):
    """The runs of train texts that a segment may match, by key: numbers only."""
    width = _widths(share)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = _flat(b)[0]
            band = _band(np.maximum(sizes, 1), share)
            parts = []
            for text, place, run in _substrings(b, share):
                key = _key(run, band[text], place // width[band[text]])
                ok = wanted.passes(key)
                parts.append((text[ok], place[ok], key[ok]))
            out = _runs(b, parts)
            text = pa.array(np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([out.column("run"), out.column("cls"), out.column("n"), out.column("place"), b.column("sketch").take(text)], ["key", "b", "nb", "pb", "sketch"])

    return emit


def _runs(b: pa.RecordBatch, parts: list) -> pa.RecordBatch:
    text = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
    place = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
    run = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.int64)
    at = pa.array(text)
    return pa.RecordBatch.from_arrays([b.column("cls").take(at), b.column("n").take(at), pa.array(place.astype(np.int32)), pa.array(run)], ["cls", "n", "place", "run"])


def banded(a: np.ndarray, b: np.ndarray, k: int) -> int:
    """Word edit distance of ``a`` and ``b``, or ``k + 1`` where it is greater."""
    return int(banded_all([np.asarray(a)], [np.asarray(b)], np.array([k]))[0])


def banded_all(left: list[np.ndarray], right: list[np.ndarray], k: np.ndarray) -> np.ndarray:
    """:func:`banded` of many pairs at once, one row of all bands at a time.

    Of each pair only the ``2 k + 1`` diagonals around the main one count; the
    bands are as wide as the widest.
    """
    top, size = int(k.max()), len(left)
    n, m = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    width, rows = 2 * top + 1, int(n.max(initial=0))
    a = np.full((size, rows), -1, np.int64)
    padded = np.full((size, max(rows, int(m.max(initial=0))) + 2 * width + 1), -2, np.int64)
    for i, (x, y) in enumerate(zip(left, right)):
        a[i, : len(x)] = x
        padded[i, top + 1 : top + 1 + len(y)] = y
    off = np.arange(width)
    big = (k + 1)[:, None]
    row = np.where((off >= top) & (off - top <= m[:, None]), off - top, big)
    row = np.minimum(row, big)
    out = np.where((n == 0) & (m <= k), m, k + 1)
    for i in range(1, rows + 1):
        j = i + off - top  # the place in b that a cell stands for
        new = row + (padded[:, i : i + width] != a[:, i - 1 : i])
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        if i <= top:
            new[:, j == 0] = i
        outside = (j < 0) | (j > m[:, None])
        new = np.where(outside, big, new)
        new = np.minimum.accumulate(new - off, axis=1) + off
        row = np.minimum(np.where(outside, big, new), big)
        done = np.flatnonzero(n == i)
        if len(done):
            last = m[done] - i + top
            ok = (last >= 0) & (last < width)
            out[done[ok]] = row[done[ok], last[ok]]
    return np.minimum(out, k + 1)


def _bags(sizes_a: np.ndarray, a: np.ndarray, sizes_b: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair, the words that stand in one text and not in the other; twice the distance at most."""
    pair = np.concatenate([np.repeat(np.arange(len(sizes_a)), sizes_a), np.repeat(np.arange(len(sizes_b)), sizes_b)])
    word = np.concatenate([a, b])
    sign = np.ones(len(word), np.int64)
    sign[len(a) :] = -1
    order = np.lexsort((word, pair))
    pair, word, sign = pair[order], word[order], sign[order]
    if not len(word):
        return np.zeros(len(sizes_a), np.int64)
    first = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (pair[1:] != pair[:-1])))
    return np.bincount(pair[first], np.abs(np.add.reduceat(sign, first)), len(sizes_a)).astype(np.int64)


def _verify(share: float):
    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, flat = zip(*((np.diff(c.offsets.to_numpy()), c.flatten().to_numpy()) for c in (b.column("ws_a"), b.column("ws_b"))))
            k = np.floor(share * np.maximum(*sizes) + 1e-9).astype(np.int64)
            likely = np.flatnonzero(_bags(sizes[0], flat[0], sizes[1], flat[1]) <= 2 * k)
            likely = likely[np.argsort(sizes[0][likely], kind="stable")]
            starts = [np.concatenate([[0], np.cumsum(x)]) for x in sizes]
            keep, dist = [], []
            for lo in range(0, len(likely), BATCH):
                at = likely[lo : lo + BATCH]
                texts = [[flat[s][starts[s][i] : starts[s][i + 1]] for i in at] for s in (0, 1)]
                e = banded_all(texts[0], texts[1], k[at])
                ok = e <= k[at]
                keep += at[ok].tolist()
                dist += e[ok].tolist()
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("a").take(at), b.column("b").take(at), pa.array(dist, pa.int32())], ["a", "b", "distance"])

    return decide


def text_classes(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``(members(document, cls), classes(cls, n, ws, sketch))``: texts with the
    same words share a class.  Texts without a word belong to none."""
    rows = docs.select(F.col(key).alias("document"), F.col(text).alias("text")).where("text is not null")
    found = cut(rows.mapInArrow(_fingerprints, "document string, c1 bigint, c2 bigint, n int, ws array<bigint>, sketch array<bigint>"))
    same = ["c1", "c2", "n"]
    # one document stands for its class; only keys are shuffled to find it
    lead = found.groupBy(*same).agg(F.min("document").alias("document"))
    classes = found.join(lead, [*same, "document"]).dropDuplicates(same)
    classes = cut(classes.withColumn("cls", F.monotonically_increasing_id()))  # numbered once, as written
    members = found.select("document", *same).distinct().join(classes.select("cls", *same), same).select("document", "cls")
    return members, classes.select("cls", "n", "ws", "sketch")


def near_classes(eval_classes: DataFrame, train_classes: DataFrame, share: float = SHARE) -> DataFrame:
    """``(a, b, distance)``: every evaluation class ``a`` and train class ``b``
    within the distance; ``a = b`` with distance 0 is among them."""
    spark = eval_classes.sparkSession
    tasks = 3 * spark.sparkContext.defaultParallelism
    ev = eval_classes.repartition(tasks, "cls")
    tr = cut(train_classes.repartition(tasks, "cls"))
    pieces = cut(ev.mapInArrow(_segments(share), "cls bigint, n int, place int, run bigint"))
    # how often the train texts hold each segment; others of their runs never leave their task
    df = tr.mapInArrow(_counted_runs(share, Filter(pieces, "run")), "run bigint, n bigint").groupBy("run").agg(F.sum("n").alias("df"))
    known = pieces.join(df, "run", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    k = _edits_column(share)
    rank = F.row_number().over(Window.partitionBy("cls").orderBy("df", "run", "place"))
    # of all m segments, m - k or more stand in a partner; of the k + t rarest ones, t
    m = F.count(F.lit(1)).over(Window.partitionBy("cls"))
    t = F.greatest(F.lit(1), F.ceil((m - k) * F.lit(TAKEN))).cast("int")
    ranked = known.withColumns({"rank": rank, "k": k, "t": t})
    rare = ranked.where((F.col("rank") <= F.col("k") + F.col("t")) & (F.col("df") > 0)).select("run", "cls", "n", "place", "k", "t")
    # runs meet under one key of words, length and place; the sketch goes with them, as it
    # stops most of the many meetings of stock phrases before any pair is made
    rare = rare.join(ev.select("cls", "sketch"), "cls")
    bits = [F.col("sketch")[i].alias(f"s{i}") for i in range(SKETCH)]
    a = cut(rare.mapInArrow(_probes(share), "key bigint, a bigint, na int, pa int, k int, t int, sketch array<bigint>").select("key", "a", "na", "pa", "k", "t", *bits))
    b = tr.mapInArrow(_wanted_runs(share, Filter(a, "key")), "key bigint, b bigint, nb int, pb int, sketch array<bigint>").select("key", "b", "nb", "pb", *[c.alias(f"r{i}") for i, c in enumerate(bits)])
    allowed = F.floor(F.greatest("na", "nb") * F.lit(share) + 1e-9)
    flips = sum((F.bit_count(F.col(f"s{i}").bitwiseXOR(F.col(f"r{i}"))) for i in range(SKETCH)), F.lit(0))
    close = (F.abs(F.col("pa") - F.col("pb")) <= F.col("k")) & (F.abs(F.col("na") - F.col("nb")) <= allowed) & (flips <= 2 * allowed)
    met = a.join(b, "key").where(close).groupBy("a", "b").agg(F.count(F.lit(1)).alias("hits"), F.first("t").alias("t"))
    likely = cut(met.where("hits >= t").select("a", "b"))
    wa = eval_classes.select(F.col("cls").alias("a"), F.col("ws").alias("ws_a"))
    wb = train_classes.select(F.col("cls").alias("b"), F.col("ws").alias("ws_b"))
    full = likely.join(wa, "a").join(wb, "b").repartition(tasks, "a", "b")
    return full.mapInArrow(_verify(share), "a bigint, b bigint, distance int")


def _edits_column(share: float):
    """:func:`edits` of column n."""
    k = F.floor(F.col("n") * F.lit(share / (1 - share)) + 1e-9)
    return F.when(k > F.floor((F.col("n") + k) * F.lit(share) + 1e-9), k - 1).otherwise(k).cast("int")


def split_rows(split: DataFrame) -> DataFrame:
    """``(split_id, document, side, document_type, phase)`` of rows with a phase."""
    p = phase(F.col("phase"))
    return split.select("split_id", hex_id(F.regexp_replace("document_id", r"(?i)\.[a-z]{1,5}\s*$", "")).alias("document"), label(F.col("document_type")).alias("document_type"), p.alias("phase")).where("phase is not null and document is not null").withColumn("side", F.when(F.col("phase") == "train", "train").otherwise("eval"))


class Overlaps:
    """What two sides of a split have in common, by classes of equal texts.

    ``rows(split_id, document, side, document_type, phase, cls)`` is the
    membership: each row with a phase, once for each text of its document.
    ``near(a, b, distance)`` has the pairs of an evaluation class and a train
    class; ``a = b`` is among them.  Copies are not expanded.
    """

    def __init__(self, rows: DataFrame, near: DataFrame):
        self.rows, self.near = rows, near

    def pairs(self) -> DataFrame:
        """``(train_id, eval_id, document_type, phase, distance)``: every pair of rows, expanded."""
        e = self.rows.where("side = 'eval'").select(F.col("cls").alias("a"), F.col("split_id").alias("eval_id"), "document_type", "phase")
        t = self.rows.where("side = 'train'").select(F.col("cls").alias("b"), F.col("split_id").alias("train_id"))
        return e.join(self.near, "a").join(t, "b").groupBy("train_id", "eval_id", "document_type", "phase").agg(F.min("distance").alias("distance"))

    def links(self) -> DataFrame:
        """``(split_id, side, cls, n_links)``: each row with its class and the number of
        rows on the other side whose text is near to the class's."""
        n = self.rows.groupBy("cls", "side").agg(F.count(F.lit(1)).alias("n"))
        n = cut(n)
        t = n.where("side = 'train'").select(F.col("cls").alias("b"), "n")
        e = n.where("side = 'eval'").select(F.col("cls").alias("a"), "n")
        of = self.near.join(t, "b").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n_links")).withColumn("side", F.lit("eval"))
        of = of.unionByName(self.near.join(e, "a").groupBy(F.col("b").alias("cls")).agg(F.sum("n").alias("n_links")).withColumn("side", F.lit("train")))
        return self.rows.join(of, ["cls", "side"], "left").select("split_id", "side", "cls", F.coalesce("n_links", F.lit(0)).alias("n_links"))

    def report(self) -> DataFrame:
        """Per phase and document_type of the evaluation rows: rows with a train partner,
        pairs, and pairs of the same words; from counts per class, without expanding
        copies (a document with several texts counts for each)."""
        t = self.rows.where("side = 'train'").groupBy(F.col("cls").alias("b")).agg(F.count(F.lit(1)).alias("n"))
        per = self.near.join(t, "b").groupBy("a").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("distance") == 0, F.col("n")).otherwise(0)).alias("same"))
        e = self.rows.where("side = 'eval'").join(per.withColumnRenamed("a", "cls"), "cls")
        return e.groupBy("phase", "document_type").agg(F.sum("n").alias("n_pairs"), F.countDistinct("split_id").alias("n_eval_rows"), F.sum("same").alias("n_same"))


def overlaps(split: DataFrame, docs: DataFrame, share: float = SHARE) -> Overlaps:
    """The evaluation and train rows whose documents have the same or nearly the same text.

    Rows without phase, document or text have no partners.  An id loaded twice
    counts with its texts that are not null; repeated rows are rows.  Keys are
    spelled in any way hex_id knows.  Empty tables give empty results.
    """
    rows = cut(split_rows(split))
    wanted = rows.select("document").distinct()
    texts = docs.select(hex_id(F.col("id")).alias("document"), "valuestring").join(wanted, "document", "left_semi")
    members, classes = text_classes(texts, "document", "valuestring")
    of = cut(rows.join(members, "document"))
    sides = of.select("cls", "side").distinct()
    ev = classes.join(sides.where("side = 'eval'"), "cls", "left_semi")
    tr = classes.join(sides.where("side = 'train'"), "cls", "left_semi")
    return Overlaps(of, cut(near_classes(cut(ev), cut(tr), share)))
