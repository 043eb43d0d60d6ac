"""Words of texts as arrays of 64-bit numbers."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import xxhash

_WORD = re.compile(r"[^\W_]+")
_UMLAUTS = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue"})
_memo: dict[str, int] = {}


def words(text: str, umlauts: bool = False) -> list[str]:
    """Runs of letters and digits in one letter case; ``umlauts``: ä as ae, ß as ss."""
    if "̈" in text:
        text = unicodedata.normalize("NFC", text)
    text = text.casefold() if umlauts else text.lower()
    return _WORD.findall(text.translate(_UMLAUTS) if umlauts else text)


def numbers(ws: list[str]) -> list[int]:
    """A 64-bit number for each word, the same in every process."""
    out = []
    for w in ws:
        n = _memo.get(w)
        if n is None:
            if len(_memo) > 500_000:
                _memo.clear()
            n = _memo[w] = xxhash.xxh64_intdigest(w) - (1 << 63)
        out.append(n)
    return out


class _Numbers(dict):
    """Words to their numbers, worked out when first asked for; emptied when it is large."""

    def __missing__(self, w: str) -> int:
        if len(self) > 500_000:
            self.clear()
        n = self[w] = xxhash.xxh64_intdigest(w) - (1 << 63)
        return n


_number = _Numbers()
_OR_END = re.compile(r"[^\W_]+|\x00")


def words_of(texts: list[str | None], umlauts: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``(words per text, their numbers)`` of many texts in one pass; null has none.

    The same as :func:`words` and :func:`numbers` text by text.
    """
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    all_ = "\0".join((t or "").replace("\0", " ") for t in texts) + "\0"
    if "\u0308" in all_:
        all_ = unicodedata.normalize("NFC", all_)
    all_ = all_.casefold() if umlauts else all_.lower()
    if umlauts:
        all_ = all_.replace("ä", "ae").replace("ö", "oe").replace("ü", "ue")
    got = np.fromiter(map(_number.__getitem__, _OR_END.findall(all_)), np.int64)
    ends = np.flatnonzero(got == _number["\0"])
    return np.diff(ends, prepend=-1) - 1, np.delete(got, ends)


def grams(flat: np.ndarray, n: int) -> np.ndarray:
    """A number for each run of ``n`` words that starts at a place of ``flat``.

    The last ``n - 1`` places, and those whose run leaves its text, are not
    meaningful; see :func:`inside`.
    """
    size = max(0, len(flat) - n + 1)
    h = np.full(size, n, np.uint64)
    w = flat.view(np.uint64)
    for k in range(n):
        h = (h ^ w[k : k + size]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def inside(sizes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, place in the text, place in the flat array)`` of every run of ``n`` words."""
    runs = np.maximum(sizes - n + 1, 0)
    text = np.repeat(np.arange(len(sizes)), runs)
    first = np.concatenate([[0], np.cumsum(runs)])[:-1]
    place = np.arange(runs.sum()) - first[text]
    start = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    return text, place, start[text] + place
