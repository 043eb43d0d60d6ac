"""Evaluation texts that leak into training texts.

The runs of SEED words of the items are seeds, held in an index that every task
has; a text's own runs are looked up in it, and each hit joins the text to the
items that hold the run, at a diagonal (place in the text less place in the item).

* Exact passages of PASSAGE words hold the rarest run of each of their windows,
  so only those are seeds (rarity is counted over the items: it is what decides
  how many pairs a hit makes), and the words along the diagonal are compared.
* Edited copies have lost some runs, and which ones no count can tell, so all
  runs are seeds, and a pair needs NEAR of them close together.  A passage that
  scores LEAST_SCORE with at most EDITS of its words edited always has them: with
  ``e`` edits and ``m`` words left it keeps ``m - 3 (e + 1)`` runs or more.

Smith-Waterman alignment of the words around the hits scores every pair.  All of
it happens in the task that reads the text: nothing is shuffled.  Items are
indexed in blocks of a fixed number of words, one pass over the texts for each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textveil.llm.words import grams, inside, numbers, words, words_of
from textveil.session import cut

#: Words of a seed, and of the shortest passage that counts.
SEED, PASSAGE = 4, 12
#: Least score of a pair: that of the shortest passage, word for word.
LEAST_SCORE = 2 * PASSAGE
#: Share of edited words up to which a passage is certain to be found.
EDITS = 0.15
#: Hits that lie close together where a passage is: so many, within so many words
#: of the item, on diagonals that differ by so much at most.
NEAR, REACH, DRIFT = 4, 24, 3
#: Words of the items in one block (about 40 bytes each on every executor).
BLOCK_WORDS = 1_000_000
#: Pairs aligned at once.
BATCH = 256


def align(a: np.ndarray, b: np.ndarray, match: int = 2, mismatch: int = -1, gap: int = -1) -> tuple[int, int, int, int]:
    """Smith-Waterman over words: ``(score, end in a, end in b, longest exact run)``.

    Ends are the places behind the last aligned word.
    """
    if not len(a) or not len(b):
        return 0, 0, 0, 0
    return tuple(int(x[0]) for x in align_all([a], [b], match, mismatch, gap))


def align_all(left: list[np.ndarray], right: list[np.ndarray], match: int = 2, mismatch: int = -1, gap: int = -1) -> tuple[np.ndarray, ...]:
    """:func:`align` of many pairs at once, one row of all matrices at a time."""
    size, n, m = len(left), max(map(len, left)), max(map(len, right))
    codes = np.unique(np.concatenate([*left, *right]), return_inverse=True)[1].astype(np.int32) + 1
    a, b = np.zeros((size, n), np.int32), np.full((size, m), -1, np.int32)
    at = 0
    for to, rows in ((a, left), (b, right)):
        for i, r in enumerate(rows):
            to[i, : len(r)] = codes[at : at + len(r)]
            at += len(r)
    kind = np.int16 if max(match, 1) * m < 16_000 and -gap * m < 16_000 else np.int32
    steps = (np.arange(m + 1) * -gap).astype(kind)
    prev, run, row = (np.zeros((size, m + 1), kind) for _ in range(3))
    best, ea, eb, longest = (np.zeros(size, np.int32) for _ in range(4))
    for i in range(n):
        eq = b == a[:, i : i + 1]
        diagonal = np.multiply(eq, kind(match - mismatch), dtype=kind)
        diagonal += prev[:, :-1]
        diagonal += kind(mismatch)
        np.maximum(diagonal, prev[:, 1:] + kind(gap), out=row[:, 1:])
        np.maximum(row, 0, out=row)
        row[:, 0] = 0
        row += steps  # gaps within the row: a running maximum
        np.maximum.accumulate(row, axis=1, out=row)
        row -= steps
        top = row.max(1)
        better = np.flatnonzero(top > best)
        if len(better):
            best[better], ea[better], eb[better] = top[better], i + 1, row[better].argmax(1)
        run[:, 1:] = run[:, :-1] + kind(1)
        run[:, 1:] *= eq
        np.maximum(longest, run.max(1), out=longest)
        prev, row = row, prev
    return best, ea, eb, longest


class Index:
    """The runs of a block of items: sorted, with the items and places of each.

    ``rare`` keeps of every window of PASSAGE words the run that the fewest items
    hold (ties by the run's number), and the other runs only if a window needs them.
    """

    def __init__(self, keys: np.ndarray, texts: list[np.ndarray], rare: bool):
        self.keys, self.texts = keys, texts
        sizes = np.array([len(t) for t in texts], np.int64)
        flat = np.concatenate(texts) if texts else np.zeros(0, np.int64)
        item, place, at = inside(sizes, SEED)
        runs = grams(flat, SEED)[at] if len(at) else np.zeros(0, np.int64)
        if rare and len(runs):
            one = np.unique(np.column_stack([runs, item]), axis=0)[:, 0]
            kinds, held = np.unique(one, return_counts=True)
            rank = np.lexsort((kinds, held)).argsort()[np.searchsorted(kinds, runs)]
            keep, width = np.zeros(len(runs), bool), PASSAGE - SEED + 1
            first = np.concatenate([[0], np.cumsum(np.maximum(sizes - SEED + 1, 0))])
            for lo, hi in zip(first[:-1], first[1:]):
                if hi - lo >= width:
                    keep[lo + np.lib.stride_tricks.sliding_window_view(rank[lo:hi], width).argmin(1) + np.arange(hi - lo - width + 1)] = True
            item, place, runs = item[keep], place[keep], runs[keep]
        order = np.argsort(runs, kind="stable")
        self.item, self.place = item[order].astype(np.int32), place[order].astype(np.int32)
        self.runs, self.first = np.unique(runs[order], return_index=True)
        self.first = np.append(self.first, len(runs))

    def hits(self, sizes: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, ...]:
        """``(text, place, item, place in the item)`` of every run that texts and items share."""
        none = (np.zeros(0, np.int64),) * 4
        text, place, at = inside(sizes, SEED)
        if not len(at) or not len(self.runs):
            return none
        runs = grams(flat, SEED)[at]
        k = np.minimum(np.searchsorted(self.runs, runs), len(self.runs) - 1)
        hit = np.flatnonzero(self.runs[k] == runs)
        k = k[hit]
        n = self.first[k + 1] - self.first[k]
        to = np.repeat(self.first[k], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(text[hit], n), np.repeat(place[hit], n), self.item[to].astype(np.int64), self.place[to].astype(np.int64)


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])[:-1]


def exact_windows(index: Index, sizes: np.ndarray, flat: np.ndarray) -> list[tuple[int, int, int, int]]:
    """``(text, item, from, to)``: places of texts around PASSAGE or more words that stand in an item."""
    text, p, item, q = index.hits(sizes, flat)
    start, out = _starts(sizes), []
    if not len(text):
        return out
    lines = np.unique(np.column_stack([text, item, p - q]), axis=0)
    for t, i, d in lines.tolist():
        words_ = index.texts[i]
        lo, hi = max(0, -d), min(len(words_), int(sizes[t]) - d)
        same = np.concatenate([[False], flat[start[t] + d + lo : start[t] + d + hi] == words_[lo:hi], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        if len(edge) and (edge[1::2] - edge[::2]).max() >= PASSAGE:
            out.append((t, i, max(0, d + lo), d + hi))
    return out


def near_windows(index: Index, sizes: np.ndarray, flat: np.ndarray) -> list[tuple[int, int, int, int]]:
    """``(text, item, from, to)``: places of texts where NEAR hits of an item lie close together."""
    text, p, item, q = index.hits(sizes, flat)
    if not len(text):
        return []
    pair = text * len(index.keys) + item
    # any hits within REACH and DRIFT share a cell of twice the size, in one of four shifted grids
    found = []
    d = p - q
    order = np.argsort(pair, kind="stable")
    pair, p, q, d = pair[order], p[order], q[order], d[order]
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    n = np.diff(np.append(first, len(pair)))
    many = np.repeat(n, n) >= NEAR
    pair, p, q, d = pair[many], p[many], q[many], d[many]
    if not len(pair):
        return []
    low = int(d.min())
    for sq in (0, REACH):
        for sd in (0, DRIFT + 1):
            cell = np.column_stack([pair, (q + sq) // (2 * REACH), (d - low + sd) // (2 * (DRIFT + 1))])
            by = np.lexsort((q, cell[:, 2], cell[:, 1], cell[:, 0]))
            c, cq = cell[by], q[by]
            edge = np.flatnonzero(np.append(True, (c[1:] != c[:-1]).any(1)))
            new = np.append(True, (c[1:] != c[:-1]).any(1) | (cq[1:] != cq[:-1]))
            n = np.add.reduceat(new.astype(np.int64), edge)
            ok = n >= NEAR
            if ok.any():
                found.append(np.column_stack([c[edge, 0], np.minimum.reduceat(p[by], edge), np.maximum.reduceat(p[by], edge)])[ok])
    if not found:
        return []
    found = np.unique(np.concatenate(found), axis=0)
    out: list[tuple[int, int, int, int]] = []
    for k, lo, hi in found.tolist():
        t, i = divmod(k, len(index.keys))
        # an alignment reaches so far beyond its hits: the item's words, with EDITS of them or more put in
        far = math.ceil(1.25 * len(index.texts[i]))
        lo, hi = max(0, lo - far), min(int(sizes[t]), hi + SEED + far)
        if out and out[-1][:2] == (t, i) and lo <= out[-1][3]:
            out[-1] = (t, i, out[-1][2], max(hi, out[-1][3]))
        else:
            out.append((t, i, lo, hi))
    return out


_SCHEMA = "key bigint, item bigint, score int, end_word int, item_end_word int, longest_run int, item_words int"


def _search(index: Index, passages: bool):
    windows = exact_windows if passages else near_windows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, flat = words_of(b.column("text").to_pylist(), True)
            start = _starts(sizes)
            todo = sorted(windows(index, sizes, flat), key=lambda w: w[3] - w[2])
            best: dict[tuple[int, int], tuple[int, ...]] = {}
            for lo in range(0, len(todo), BATCH):
                part = todo[lo : lo + BATCH]
                res = align_all([flat[start[t] + x : start[t] + y] for t, _, x, y in part], [index.texts[i] for _, i, _, _ in part])
                for (t, i, x, _), s, ea, eb, longest in zip(part, *(r.tolist() for r in res)):
                    old = best.get((t, i))
                    if old is None or (s, -x) > (old[0], -old[1]):
                        best[t, i] = (s, x + ea, eb, max(longest, old[3] if old else 0))
                    elif longest > old[3]:
                        best[t, i] = (*old[:3], longest)
            rows = [(k, v) for k, v in best.items() if v[0] >= LEAST_SCORE]
            at = pa.array([t for (t, _), _ in rows], pa.int64())
            cols = [pa.array([v[c] for _, v in rows], pa.int32()) for c in range(4)]
            items = [i for (_, i), _ in rows]
            yield pa.RecordBatch.from_arrays([b.column("key").take(at), pa.array(index.keys[items] if items else np.zeros(0, np.int64)), *cols, pa.array([len(index.texts[i]) for i in items], pa.int32())], [c.split()[0] for c in _SCHEMA.split(", ")])

    return run


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [numbers(words(t, True)) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("item"), pa.array(got, pa.list_(pa.int64()))], ["item", "ws"])


def leaked(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", passages: bool = False) -> DataFrame:
    """Pairs of a text and an item that align with LEAST_SCORE or more.

    With ``passages`` only pairs with PASSAGE or more consecutive words in
    common; all of these are there.  Without, pairs with NEAR shared runs of SEED
    words close together: every passage that scores LEAST_SCORE with EDITS or
    fewer of its words edited is among them; heavier edited ones may be missing.

    Columns ``(<doc_key> bigint, <item_key> bigint, score, end_word,
    item_end_word, longest_run, item_words)``; ``end_word`` is a place in the
    text, ``longest_run`` the longest exact run around the hits.  Letter case,
    punctuation, spacing and the spelling of umlauts don't count.  Null and
    empty texts, and items shorter than SEED words, have no pairs; repeated
    texts each have theirs; keys are taken as unique; an empty table gives none.
    """
    spark = docs.sparkSession
    rows = items.select(F.col(item_key).cast("bigint").alias("item"), F.col(text).alias("text")).where(F.col("text").isNotNull() & F.col("item").isNotNull())
    item_ws = cut(rows.mapInArrow(_item_words, "item bigint, ws array<bigint>").where(F.size("ws") >= SEED))
    total = item_ws.agg(F.sum(F.size("ws"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_WORDS))
    source = docs.select(F.col(doc_key).cast("bigint").alias("key"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    out = None
    for k in range(blocks):
        # one block of items on the driver at a time: about BLOCK_WORDS words
        block = item_ws.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).orderBy("item").toArrow()
        index = Index(block.column("item").to_numpy(), [np.array(w, np.int64) for w in block.column("ws").to_pylist()], passages)
        part = source.mapInArrow(_search(index, passages), _SCHEMA)
        out = part if out is None else out.unionAll(part)
    return out.withColumnsRenamed({"key": doc_key, "item": item_key})
