"""Sentence units in many scripts, by a hidden-event language model.

Words are strung with hidden events (boundary or none).  What a text leaves
open - a stop after an abbreviation, a number, an initial, and every gap between
two words - is decided by the posterior of the event given the word before, the
word after and the event before, from forward and backward sums.  What the layout
settles (blank lines, headings, list items, spaces of scripts that put them between
clauses, quotations) enters as events of known value.

The model is a set of counts over all texts, in arrays of fixed size:

* how often a word closed by a stop ends a block (where the boundary is known)
  and how often it stands inside one;
* how often a word opens a block, and how often it follows a closed word;
* how often each word, in any spelling, ends and opens what stops and blank lines
  close, and how often each pair of words stands with nothing but blanks between.

Three passes: find the gaps (one scan of each text), count (aggregates), decide
(numpy only, over whole batches).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textveil.session import cut

#: Buckets of words; they bound the model, which is collected and broadcast.
WORDS = 1 << 16
#: Buckets of pairs of words.
PAIRS = 1 << 20
#: Log-odds, before its words are looked at, that a unit closed by marks or layout is several run together.
RUN_ON = -1.0
#: Count of a pair of words that was never seen.
UNSEEN = 0.1
#: Boundaries without a mark that may stand among the occurrences of a pair of words, for each one expected with a mark.
UNMARKED = 4.0
#: Most that the word after a gap can say for (and, 1 less it, against) a boundary.
OPENS_AT_MOST = 0.97
#: Column at which lines of wrapped sentences end, at most.
WRAP = 72

_FULL = "。！？।؟۔።։។៕"
_STOP = ".!?…" + _FULL
_CLOSE = "\"“”»’'\\)\\]）」』】"
#: Thai, Lao, Burmese and Khmer: scripts that put a space between clauses, not words.
_THAI = "฀-๿຀-໿က-႟ក-៿"
#: Gaps: stops with what closes them, blank lines, line ends, Thai spaces.
_GAP = re.compile(
    rf"(?=[\s.!?…{_FULL}])(?:(?P<n>[^\S\r\n]*(?:\r\n|\r|\n)\s*)"
    rf"|(?P<s>[.!?…]+[{_CLOSE}]*)(?:(?P<w>\s+)|(?=[^\W\d_a-zß-öø-ÿ]|[„«]))"
    rf"|(?P<c>[{_FULL}][{_CLOSE}]*)(?P<v>\s*)"
    rf"|(?P<t>(?<=[{_THAI}])[^\S\r\n]+(?=[{_THAI}])))"
)
_QUOTE = re.compile(r"„[^“”„]*[“”]|«[^«»]*»|「[^「」]*」|『[^『』]*』|“[^“”]*”|(?<![^\s(])\"[^\"\r\n]+\"")
_OPENS = re.compile("[„«「『“\"]")
_BLANK = re.compile(r"(?:\r\n|\r|\n)[^\S\r\n]*(?:\r\n|\r|\n)")
_BULLET = re.compile(r"[-•*‣▪●·◦][^\S\r\n]+(?=\S)|\d{1,2}[.)][^\S\r\n]+(?=\S)")
_DIGITS = re.compile(r"\d+")
#: A word, up to a gap within it.
_FIRST = re.compile(rf"\S(?:[^\s.!?…{_FULL}]|[.!?…]+(?![^\W\d_a-zß-öø-ÿ]|[„«]))*")

#: Kinds of a gap.
STOP, LINE, SURE, NEVER = 0, 1, 2, 3
#: Flags of a gap.
F_NEWLINE, F_LOWER, F_ITEM, F_BANG, F_ADJACENT, F_CLOSED, F_SMALL = 1, 2, 4, 8, 16, 32, 64

_memo: dict[str, int] = {}
#: Vowel signs and accents, which belong to words.
_SIGNS = "".join(chr(c) for c in range(0x300, 0x2000) if unicodedata.category(chr(c))[0] == "M")
_BARE_WORD = re.compile(rf"([\w{_SIGNS}]+)")
_RULED = re.compile(rf"[{_THAI}]")
_CLOSING = re.compile(rf"[\s{_CLOSE}]+")


def _plain(w: str) -> int:
    """The bucket of a word without regard to case and punctuation."""
    return crc32(_DIGITS.sub(_shape, w.lower()).encode("utf-8", "replace")) % WORDS


def _word(w: str) -> int:
    """The bucket of a word; numbers count by their shape."""
    got = _memo.get(w)
    if got is None:
        if len(_memo) > 200_000:
            _memo.clear()
        got = _memo[w] = crc32(_DIGITS.sub(_shape, w).encode("utf-8", "replace")) % WORDS
    return got


def _host(w: str) -> str:
    """An address counts by what stands after its at-sign: the whole of it is seen once."""
    return w.rsplit("@", 1)[-1]


def _shape(m: re.Match) -> str:
    return "9" if len(m.group()) < 3 else "99"


def gaps(text: str) -> tuple[list, ...]:
    """The gaps of one text that have a stop, a line end or a rule of their own (``between`` has all others).

    Parallel lists: end of the unit before, start of the unit after, kind, word
    before, word after, flags, place within its line, length of the word after; the
    last entry is the end of the text.  A text without any non-blank character has none.
    Then the places of its quotations.
    """
    n = len(text.rstrip())
    start = len(text) - len(text.lstrip())
    if start >= n:
        return [], [], [], [], [], [], [], [], []
    quotes = [m.span() for m in _QUOTE.finditer(text) if not _BLANK.search(text, m.start(), m.end())] if _OPENS.search(text) else []
    ends: list[int] = []
    nexts: list[int] = []
    kinds: list[int] = []
    left: list[int] = []
    right: list[int] = []
    flags: list[int] = []
    place: list[int] = []
    wide: list[int] = []
    line = start  # start of the current line
    m = _BULLET.match(text, start)
    counter = m.end() if m else -1
    item = bool(m)
    opener = _word(_FIRST.match(text, start).group())
    q, nq = 0, len(quotes)
    prev = start  # start of what follows the gap before
    for m in _GAP.finditer(text, start, n):
        group = m.lastgroup
        if group == "n":
            a, b = m.span()
            if b >= n:
                break
            gap = m.group()
            blank = gap.count("\n") + (gap.count("\r") if "\n" not in gap else 0) > 1
            kind, flag, word = (SURE if blank else LINE), F_NEWLINE, opener
        elif group == "t":
            a, b = m.span()
            kind, flag, word = SURE, 0, 0
        else:
            a = m.end("c") if m.group("c") else m.end("s")
            b = m.end()
            if b >= n:
                break
            gap = text[a:b]
            flag = F_CLOSED
            kind = STOP
            if "\n" in gap or "\r" in gap:
                flag |= F_NEWLINE
                if gap.count("\n") > 1 or (gap.count("\r") > 1 and "\n" not in gap) or gap.count("\r\n") > 1:
                    kind = SURE
            elif b == counter:
                kind = NEVER
            if m.group("c"):
                kind = max(kind, SURE)
            token = text[prev:a].rsplit(None, 1)[-1]
            if token[-1] in "!?" or token.rstrip("\"“”»’')]）」』】")[-1:] in ("!", "?"):
                flag |= F_BANG
            word = _word(_host(token))
            if len(token) == a - prev:
                flag |= F_ADJACENT
        while q < nq and quotes[q][1] <= a - 1:
            q += 1
        if kind != SURE and q < nq and quotes[q][0] < a < quotes[q][1]:
            kind = NEVER
        elif group == "v" and not flag & F_NEWLINE and q < nq and quotes[q][0] < a <= quotes[q][1]:
            kind = NEVER  # a quotation belongs to the sentence around it
        first = text[b]
        if "a" <= first <= "z" or first.islower():
            flag |= F_LOWER
        if item:
            flag |= F_ITEM
        if flag & F_NEWLINE and kind != NEVER:
            # layout: list items and headings are lines of their own
            mb = _BULLET.match(text, b)
            head = text[a - 1] in ":：" and prev == line and a - line <= 60
            thai = "฀" <= text[a - 1] <= "๿" or "฀" <= first <= "๿"
            if kind == LINE:
                if head or item or thai or (mb and not first.isdigit() and not first.isalpha()):
                    kind = SURE
                elif text[a - 1] > "⹿" or first > "⹿":
                    kind = SURE  # scripts without spaces don't wrap between words
            elif mb or item:
                kind = SURE
        ends.append(a)
        nexts.append(b)
        kinds.append(kind)
        left.append(word)
        mf = _FIRST.match(text, b)
        right.append(_word(mf.group()))
        flags.append(flag)
        place.append(a - line)
        wide.append(mf.end() - b)
        if flag & F_NEWLINE:
            line = b
            mb = _BULLET.match(text, b)
            counter = mb.end() if mb else -1
            item = bool(mb) and not (kind == LINE and first.isdigit() and _fills(place[-1], wide[-1]))
            opener = right[-1]
        elif kind == SURE:
            opener = right[-1]
        prev = b
    # the end of the text is a known boundary; its last word teaches
    ends.append(n)
    nexts.append(n)
    kinds.append(SURE)
    closed = text[n - 1] in _STOP or (text[n - 1] in "\"“”»)" and text[n - 2] in _STOP)
    left.append(_word(_host(text[prev:n].rsplit(None, 1)[-1])) if closed else opener)
    right.append(0)
    flags.append(F_NEWLINE | (F_ITEM if item else 0) | (F_CLOSED if closed else 0))
    place.append(n - line)
    wide.append(0)
    return ends, nexts, kinds, left, right, flags, place, wide, quotes


#: What is added to the bucket of a word of a script with a rule of its own, and to that of a word with a small first letter.
RULED, SMALL = WORDS, 2 * WORDS


class _Words(dict):
    """Words to their plain bucket, and RULED for scripts with a rule of their own, SMALL for a small first letter."""

    def __missing__(self, w: str) -> int:
        if len(self) > 200_000:
            self.clear()
        k = self[w] = _plain(w) + (RULED if _RULED.search(w) else 0) + (SMALL if w[0].islower() else 0)
        return k


class _Numbered(dict):
    """Strings to their place in the order of first sight."""

    def __missing__(self, x: str) -> int:
        k = self[x] = len(self)
        return k


def _blank(x: str) -> tuple[int, int, int]:
    """What stands between two words: end of the unit before, start of the unit after, bucket of its marks (-1: none but closing ones).

    The places are counted from the end of the word before.  What has no blank, or a line end, or is settled by rule, is no
    candidate; its end is -1.
    """
    at = max((i + 1 for i, c in enumerate(x) if c.isspace()), default=0)
    if not at or _RULED.search(x) or any(c in "\r\n\0" for c in x):
        return -1, -1, -1
    marks = _CLOSING.sub("", x)
    return len(x[:at].rstrip()), at, _plain(marks) if marks else -1


_words_of = _Words()


def between(texts: list[str], of: np.ndarray, ends: np.ndarray, nexts: np.ndarray, quotes: list[list[tuple[int, int]]]):
    """All gaps between two words of a line that ``gaps`` doesn't have, of many texts at once.

    ``of``, ``ends``, ``nexts``: text and places of the gaps that it has; ``quotes``: places of quotations by text,
    within which nothing ends.  Answers the new gaps (text, end of the unit before, start of the unit after, bucket
    before, word after, whether one word stands between it and the new gap before) and, for the gaps given, the
    words before and after, -1 where there is none; the same of the word that opens each text.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    base = np.cumsum(sizes) - sizes
    parts = _BARE_WORD.split("\0".join(texts) + "\0")
    at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])
    starts, stops = at[1:-1:2], at[2::2][: len(parts) // 2]  # of words
    code = np.fromiter(map(_words_of.__getitem__, parts[1::2]), np.int64, len(starts))
    bucket, ruled = code % WORDS, code & RULED > 0
    if not len(starts):
        none = np.zeros(0, np.int64)
        return (none, none, none, none, none, none > 0), np.full(len(of), -1), np.full(len(of), -1), np.full(len(texts), -1)

    def word(k: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Word ``k`` if it stands in this text."""
        at = np.clip(k, 0, len(starts) - 1)
        return np.where((k == at) & (starts[at] >= base[text]) & (starts[at] < base[text] + sizes[text]), code[at], -1)

    i = np.searchsorted(stops, base[of] + ends, "right") - 1
    before = word(i, of)
    after = np.where(nexts > ends, word(np.searchsorted(starts, base[of] + nexts), of), -1)
    first = word(np.searchsorted(starts, base), np.arange(len(texts)))
    # gaps between words k and k + 1
    seen = _Numbered()
    kind = np.fromiter(map(seen.__getitem__, parts[2:-1:2]), np.int64, len(starts) - 1)
    stop, go, marks = np.array([_blank(x) for x in seen], np.int64).reshape(-1, 3).T
    ok = (stop[kind] >= 0) & ~ruled[:-1] & ~ruled[1:]
    ok[i[(i >= 0) & (i < len(ok))]] = False
    end = stops[:-1] + stop[kind]
    spans = np.array([(base[k] + x, base[k] + y) for k, q in enumerate(quotes) for x, y in q], np.int64).reshape(-1, 2)
    if len(spans):
        q = np.searchsorted(spans[:, 0], end, "right") - 1
        ok &= ~((q >= 0) & (end < spans[q, 1]))
    k = np.flatnonzero(ok)
    text = np.searchsorted(base, stops[k], "right") - 1
    linked = np.concatenate([[False], k[1:] == k[:-1] + 1])[: len(k)]
    kind = kind[k]
    left = np.where(marks[kind] >= 0, marks[kind], bucket[k])
    return (text, end[k] - base[text], stops[k] + go[kind] - base[text], left, code[k + 1], linked), before, after, first


#: What is kept of a gap of ``gaps``, and of one between words (places, buckets, whether linked, and small).  A text's gaps are one binary
#: value, with ends as distances from the end before and starts as distances from the end, which compress well.
_GAPS = np.dtype([("ends", "i4"), ("nexts", "i4"), ("kinds", "i1"), ("words", "u2"), ("after", "u2"), ("flags", "i1"), ("place", "i4"), ("wide", "i4"), ("last", "i4"), ("next", "i4")])
_BETWEEN = np.dtype([("ends", "i4"), ("nexts", "i4"), ("left", "u2"), ("right", "u2"), ("linked", "i1"), ("small", "i1")])


def _packed(rows: np.dtype, offsets: np.ndarray, cols: list) -> pa.Array:
    """Rows of all texts to one binary value a text."""
    out = np.empty(offsets[-1], rows)
    for name, c in zip(rows.names, cols):
        out[name] = c
    end = out["ends"].astype(np.int64)
    out["nexts"] -= out["ends"]
    heads = offsets[:-1][np.diff(offsets) > 0]
    step = np.diff(end, prepend=0)
    step[heads] = end[heads]
    out["ends"] = step
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * rows.itemsize).astype(np.int32)), pa.py_buffer(out)])


def _parts(batches: Iterator[pa.RecordBatch], most: int = 1 << 26) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes, or one row, as a column of binary values holds 2 GB."""
    for b in batches:
        step = max(1, len(b) * most // max(b.nbytes, most, 1))
        for i in range(0, len(b), step):
            yield b.slice(i, step)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _parts(batches):
        offsets = [0]
        cols: list[list[int]] = [[] for _ in range(8)]
        starts, firsts, quotes = [], [], []
        texts = b.column("text").to_pylist()
        for t in texts:
            got = gaps(t)
            for c, g in zip(cols, got):
                c += g
            quotes.append(got[8])
            starts.append(len(t) - len(t.lstrip()))
            firsts.append(_word(_FIRST.search(t).group()))
            offsets.append(len(cols[0]))
        of = np.repeat(np.arange(len(texts)), np.diff(offsets))
        (text, end, nxt, left, right, linked), last, after, opens = between(texts, of, np.array(cols[0], np.int64), np.array(cols[1], np.int64), quotes)
        cols[5] = np.array(cols[5], np.int64) | np.where(after >= SMALL, F_SMALL, 0)
        last, after = (np.where(x >= 0, x % WORDS, -1) for x in (last, after))
        own = _packed(_GAPS, np.array(offsets), [*cols, last, after])
        bare = _packed(_BETWEEN, np.searchsorted(text, np.arange(len(texts) + 1)), [end, nxt, left, right % WORDS, linked, right >= SMALL])
        yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(starts, pa.int32()), pa.array(firsts, pa.int32()), pa.array(opens, pa.int32()), own, bare], ["key", "start", "first", "opens", "gaps", "between"])


def _flat(b: pa.RecordBatch, column: str, rows: np.dtype) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """How many rows each text has, and the rows of all texts by name."""
    x = b.column(column)
    at = np.frombuffer(x.buffers()[1], np.int32)[x.offset : x.offset + len(x) + 1] if len(x) else np.zeros(1, np.int32)
    got = np.frombuffer(x.buffers()[2], np.uint8)[at[0] : at[-1]].view(rows) if at[-1] > at[0] else np.zeros(0, rows)
    sizes = np.diff(at) // rows.itemsize
    out = {n: got[n].astype(np.int64) for n in rows.names}
    total = np.concatenate([[0], np.cumsum(out["ends"])])
    out["ends"] = total[1:] - np.repeat(total[np.cumsum(sizes) - sizes], sizes)
    out["nexts"] += out["ends"]
    return sizes, out


#: Offsets of the model's arrays in the one space of counters: closed words, then plain ones (at known ends and stops, after
#: known ends and stops, before and after blanks), then pairs of plain ones.
_END, _IN, _OPEN, _AFTER, _SHORT, _WRAPPED, _P_END, _P_STOP, _P_OPEN, _P_AFTER, _P_LEFT, _P_RIGHT, _PAIR = (k * WORDS for k in range(13))
_SIZE = _PAIR + PAIRS


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left * 0x9E3779B1 + right * 0x85EBCA6B) % 0x7FFFFFFF % PAIRS


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_SIZE, np.int64)
    for b in batches:
        _, g = _flat(b, "gaps", _GAPS)
        if not len(g["ends"]):
            continue
        kind, flag = g["kinds"], g["flags"]
        sure = kind == SURE
        line_end = sure & (flag & F_CLOSED > 0) & (flag & F_ITEM == 0)
        stop = kind == STOP
        parts = [_END + g["words"][line_end], _IN + g["words"][stop], _OPEN + g["after"][sure & (g["nexts"] > g["ends"])], _AFTER + g["after"][stop]]
        parts.append(_OPEN + b.column("first").to_numpy().astype(np.int64))
        bare = kind == LINE
        bare &= g["place"] <= WRAP
        full = _fills(g["place"], g["wide"])
        parts += [_SHORT + g["words"][bare & ~full], _WRAPPED + g["words"][bare & full]]
        # plain words: at ends and stops, after them, and in pairs with nothing but blanks between
        before, after, opens = g["last"], g["next"], b.column("opens").to_numpy().astype(np.int64)
        parts += [_P_END + before[sure & (flag & F_ITEM == 0) & (before >= 0)], _P_STOP + before[stop & (before >= 0)]]
        parts += [_P_OPEN + after[sure & (after >= 0)], _P_AFTER + after[stop & (after >= 0)], _P_OPEN + opens[opens >= 0] % WORDS]
        _, w = _flat(b, "between", _BETWEEN)
        parts += [_P_LEFT + w["left"], _P_RIGHT + w["right"], _PAIR + _pair(w["left"], w["right"])]
        total += np.bincount(np.concatenate(parts), minlength=_SIZE)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])


def _fills(width, nxt):
    """Whether a line of this width, with a word of length ``nxt`` next, is one that wrapping makes."""
    return (width <= WRAP) & (width + 1 + nxt >= WRAP - 1)


def train(found: DataFrame) -> np.ndarray:
    """The counts over all texts, one array of fixed size."""
    counts = np.zeros(_SIZE, np.int64)
    got = found.mapInArrow(_count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return counts


class Model:
    """Probabilities of the events from counts.

    Inside a block the boundaries are hidden, at its ends they are known.  Words
    that only ever close (open) units stand at the ends and inside at one rate,
    ``odds``; the rate times a word's count at the ends is the number of hidden
    boundaries to expect after (before) it inside.
    """

    def __init__(self, counts: np.ndarray):
        c = counts.astype(np.float64)
        self.ends = self._events(c[_P_END:_P_STOP], c[_P_STOP:_P_OPEN])
        self.opens = self._events(c[_P_OPEN:_P_AFTER], c[_P_AFTER:_P_LEFT])
        self.left, self.right, self.pairs = c[_P_LEFT:_P_RIGHT], c[_P_RIGHT:_PAIR], c[_PAIR:]
        end, inside, opens, after = c[_END:_IN], c[_IN:_OPEN], c[_OPEN:_AFTER], c[_AFTER:_SHORT]
        self.p_close, self.base = self._share(end, inside)
        self.p_open, _ = self._share(opens, after)
        short, full = c[_SHORT:_WRAPPED], c[_WRAPPED:_P_END]
        self.p_line = (short + 0.05) / (short + full + 1.0)

    @staticmethod
    def _expect(known: np.ndarray, hidden: np.ndarray) -> np.ndarray:
        """Hidden boundaries to expect at each word."""
        both = (known >= 20) & (hidden >= 20)
        odds = float(np.median((hidden / np.maximum(known, 1))[both])) if both.sum() >= 5 else 2.0
        return np.minimum(known * odds, hidden)

    @classmethod
    def _share(cls, known: np.ndarray, hidden: np.ndarray) -> tuple[np.ndarray, float]:
        expect = cls._expect(known, hidden)
        base = (expect.sum() + 1) / (hidden.sum() + 2)
        return (expect + 2 * base) / (hidden + 2), base

    @classmethod
    def _events(cls, known: np.ndarray, hidden: np.ndarray) -> np.ndarray:
        return known + cls._expect(known, hidden)

    def bare_log_odds(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of a boundary between two words with nothing but a blank between them.

        Set against each other are how often the one would end and the other open if boundaries paired words at random, and how
        often the two do stand side by side, this once left out and beyond what boundaries without marks may add.
        """
        apart = self.ends[left] * self.opens[right] / max(self.opens.sum(), 1.0)
        chance = np.maximum(self.left[left] - 1, 0) * np.maximum(self.right[right] - 1, 0) / max(self.right.sum(), 1.0)
        together = self.pairs[_pair(left, right)] - 1
        return np.log(apart + 1e-4) - np.log(np.maximum(together - UNMARKED * apart, 0) + chance + UNSEEN)

    def log_odds(self, words: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of a boundary between a closed word and the word after it."""
        # a word that opens units says less than one that never does: it may do both
        return _logit(self.p_close[words]) + _logit(np.clip(self.p_open[after], 1 - OPENS_AT_MOST, OPENS_AT_MOST)) - _logit(np.float64(self.base))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p) - np.log1p(-p)


def posteriors(log_odds: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """P(boundary) at each gap of a chain, by forward and backward sums.

    ``linked[i]``: gap ``i`` follows gap ``i - 1`` after one word; two
    boundaries around a single closed word are unlikely.  Chains are the runs
    of linked gaps; all are summed at once, position by position.
    """
    n = len(log_odds)
    if not n:
        return np.zeros(0)
    idx = np.arange(n)
    head = np.maximum.accumulate(np.where(linked, -1, idx))
    pos = idx - head
    e1 = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    emit = np.stack([1 - e1, e1], 1)
    stay = np.array([[1.0, 1.0], [1.0, 0.05]])
    fwd = emit.copy()
    order = np.argsort(pos, kind="stable")
    edges = np.searchsorted(pos[order], np.arange(pos.max() + 2))
    steps = [order[edges[k] : edges[k + 1]] for k in range(1, len(edges) - 1)]
    for at in steps:
        f = emit[at] * (fwd[at - 1] @ stay)
        fwd[at] = f / f.sum(1, keepdims=True)
    bwd = np.ones((n, 2))
    for at in reversed(steps):
        g = (emit[at] * bwd[at]) @ stay.T
        bwd[at - 1] = g / g.sum(1, keepdims=True)
    post = fwd * bwd
    return post[:, 1] / post.sum(1)


def decide(model: Model, g: dict[str, np.ndarray], doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether each gap is a boundary."""
    kind, flag = g["kinds"], g["flags"]
    lo = model.log_odds(g["words"], g["after"])
    newline, lower = flag & F_NEWLINE > 0, flag & F_LOWER > 0
    lo = np.where(flag & F_BANG > 0, 6.0, lo)
    # small letters open units only on a new line
    lo = np.where(lower & ~newline, np.minimum(lo, 0) - 8.0, lo)
    # after a line end the word before counts more than the word after
    lo = np.where(newline & (flag & F_BANG == 0) & lower, _logit(model.p_close[g["words"]]), lo)
    lo = np.where(kind == SURE, 30.0, np.where((kind == NEVER) | (kind == LINE), -30.0, lo))
    linked = (flag & F_ADJACENT > 0) & (kind != SURE)
    linked[:1] = False
    linked[1:] &= doc[1:] == doc[:-1]
    yes = posteriors(lo, linked) > 0.5
    # a line end without a stop: sentences wrap when the line is full, closing lines end
    bare = np.flatnonzero(kind == LINE)
    idx = np.arange(len(kind))
    last = np.concatenate([[-1], np.maximum.accumulate(np.where(yes | newline, idx, -1))[:-1]])[bare]
    same = (last >= 0) & (doc[last] == doc[bare])
    width = g["ends"][bare] - np.where(same, g["nexts"][last], start[doc[bare]])
    whole = ~same | newline[last]
    yes[bare] = whole & (~_fills(width, g["wide"][bare]) | (model.p_line[g["words"][bare]] > 0.25))
    return yes


def run_on(model: Model, w: dict[str, np.ndarray], unit: np.ndarray, small: np.ndarray) -> np.ndarray:
    """Whether each gap between words is a boundary; ``unit`` is the unit it lies in by marks and layout, in order.

    ``small``: whether that unit opens with a small letter; in the others small letters open nothing.

    A unit is one sentence or several run together.  The odds of the latter grow with all its gaps: one without any boundary
    has the product of their ``1 - p``.  In a unit of several, forward and backward sums decide.
    """
    lo = model.bare_log_odds(w["left"], w["right"])
    lo = np.where((w["small"] > 0) & ~small, np.minimum(lo, 0) - 8.0, lo)
    several = RUN_ON + np.bincount(unit, np.logaddexp(0, lo))[unit] if len(unit) else np.zeros(0)
    yes = np.zeros(len(unit), bool)
    at = np.flatnonzero(several > 0)  # elsewhere no gap can be above one half
    linked = w["linked"][at] > 0
    linked[:1] = False
    linked[1:] &= (unit[at][1:] == unit[at][:-1]) & (at[1:] == at[:-1] + 1)
    yes[at] = posteriors(lo[at], linked) / (1 + np.exp(-several[at])) > 0.5
    return yes


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("text").rlike(r"(?U)\S"))


def find_gaps(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per text with its gaps packed; null and blank texts give none."""
    kind = df.schema[key].dataType.simpleString()
    return _rows(df, key, text).mapInArrow(_find, f"key {kind}, start int, first int, opens int, gaps binary, between binary")


def _units(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes, g = _flat(b, "gaps", _GAPS)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        start = b.column("start").to_numpy().astype(np.int64)
        yes = decide(model, g, doc, start) if len(doc) else np.zeros(0, bool)
        of, end, nxt = doc[yes], g["ends"][yes], g["nexts"][yes]
        # within these units, between words; places of all texts on one line
        sizes, w = _flat(b, "between", _BETWEEN)
        text = np.repeat(np.arange(len(sizes)), sizes)
        unit = np.searchsorted((of << 32) + end, (text << 32) + w["ends"])
        opens = b.column("opens").to_numpy() >= SMALL
        small = np.where(np.concatenate([[True], of[1:] != of[:-1]])[: len(of)], opens[of], np.concatenate([[False], g["flags"][yes][:-1] & F_SMALL > 0])[: len(of)])
        more = run_on(model, w, unit, small[unit])
        of, end, nxt = (np.concatenate([x, y[more]]) for x, y in ((of, text), (end, w["ends"]), (nxt, w["nexts"])))
        order = np.argsort((of << 32) + end, kind="stable")
        of, end, nxt = of[order], end[order], nxt[order]
        begin = np.where(np.concatenate([[True], of[1:] != of[:-1]])[: len(of)], start[of], np.concatenate([[0], nxt[:-1]])[: len(of)])
        i32 = pa.int32()
        yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(of, pa.int64())), pa.array(begin.astype(np.int32), i32), pa.array(end.astype(np.int32), i32)], ["key", "begin_pos", "end_pos"])


def sentence_units(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, begin_pos int, end_pos int)``: the units of every text.

    Positions are code points of the text as it stands, without white space at
    the ends of a unit.  The units of a text don't overlap and hold all that is
    not white space.  Null and blank texts and an empty table give no rows; a
    repeated row gives its units again; other columns are not looked at.
    """
    found = cut(find_gaps(df, key, text))
    model = Model(train(found))
    kind = df.schema[key].dataType.simpleString()
    out = found.mapInArrow(lambda it: _units(model, it), f"key {kind}, begin_pos int, end_pos int")
    return out.withColumnRenamed("key", key)
