"""Splitting oversized texts at natural boundaries.

The prefix sums of item sizes (code points by default, or tokens of any
tokenizer) and the sorted boundary arrays of one text are searched by
bisection; no text is looked at beyond its own row.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Natural boundaries, the best first: where a piece may end (and its
#: successor's overlap may begin).
_PARAGRAPH = re.compile(r"(?:\r\n|\r|\n)[^\S\r\n]*(?:\r\n|\r|\n)\s*")
_UNIT = re.compile(r"(?:\r\n|\r|\n)\s*|(?<=[^\W\d_]{3}[.!?])[\"“”»’)\]]*\s+(?=[^\W\d_a-zäöüß]|[„«\"])|(?<=[。！？।؟])[”」』）]*\s*|(?<=[฀-๿])\s+(?=[฀-๿])")
_WORD = re.compile(r"\s+")
#: A better kind of boundary is taken if it leaves a piece of at least this share of the limit.
FILL = (0.5, 0.25, 0.0)


def boundaries(text: str) -> tuple[list[int], list[int], list[int]]:
    """Sorted starts after paragraphs, units and words."""
    return tuple([m.end() for m in p.finditer(text)] for p in (_PARAGRAPH, _UNIT, _WORD))


def cut_text(n: int, kinds: tuple[list[int], ...], limit: int, overlap: int, prefix: Sequence[int] | None = None) -> list[tuple[int, int]]:
    """Pieces ``[begin, end)`` of a text of ``n`` positions, each of size <= ``limit``.

    ``prefix[i]`` is the size of the first ``i`` positions (default: ``i``, as a
    range).  Each piece ends at the last paragraph, unit or word boundary under
    the limit that leaves it filled enough, else exactly at the limit.  The next
    piece begins ``overlap`` before that end, or later at a natural boundary if
    there is one in the overlap.  Every position lies in a piece, and each piece
    ends behind the one before.
    """
    prefix = range(n + 1) if prefix is None else prefix
    size = prefix.__getitem__
    out, begin = [], 0
    done = 0  # end of the piece before
    while True:
        if size(n) - size(begin) <= limit:
            out.append((begin, n))
            return out
        top = bisect_right(prefix, prefix[begin] + limit) - 1
        end = 0
        for cuts, fill in zip(kinds, FILL):
            k = bisect_right(cuts, top) - 1
            if k >= 0 and cuts[k] > max(done, begin) and size(cuts[k]) - size(begin) >= fill * limit:
                end = cuts[k]
                break
        if not end:
            end = top if top > done else done + 1  # a hard cut always goes on
        out.append((begin, end))
        done = end
        back = bisect_left(prefix, prefix[end] - overlap)
        back = max(back, begin + 1)
        begin = back
        for cuts in kinds:  # the earliest natural start in the overlap; paragraphs first
            k = bisect_left(cuts, back)
            if k < len(cuts) and cuts[k] < end:
                begin = cuts[k]
                break


def token_prefix(text: str, tokens: list[int], starts: list[int]) -> list[int]:
    """Prefix sums of tokens by code point: ``starts`` are the places where tokens begin.

    A token counts from its first code point on, so a piece has as many as begin in it.
    """
    count = np.bincount(np.asarray(starts, np.int64), minlength=len(text))[: len(text)]
    return np.concatenate([[0], np.cumsum(count)]).tolist()


def sizes_in_tokens(text: str, vocabulary: str) -> list[int]:
    """:func:`token_prefix` of a text under the tokenizer of a vocabulary file."""
    from textveil.llm.mixing import encoder

    enc = encoder(vocabulary)
    tokens = enc.encode_ordinary(text)
    return token_prefix(text, tokens, enc.decode_with_offsets(tokens)[1])


def split_texts(df: DataFrame, key: str, text: str, limit: int = 2500, overlap: int = 200, vocabulary: str | None = None) -> DataFrame:
    """Pieces of each text longer than ``limit``, in code points or, with the file
    of a ``vocabulary``, in tokens of its tokenizer.

    Columns ``(key, piece_no int, begin_pos int, end_pos int)``, positions in
    code points of the text as it stands.  Texts within the limit, empty and
    null texts give no row (texts with no more code points than the limit never
    leave the JVM, as a token has at least one); repeated rows give repeated
    pieces.  ``overlap`` must be smaller than half the limit.
    """
    if not 0 <= overlap * 2 < limit:
        raise ValueError("overlap must be smaller than half the limit")
    kind = df.schema[key].dataType.simpleString()
    long = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.length("text") > limit)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[int] = []
            no: list[int] = []
            lo: list[int] = []
            hi: list[int] = []
            for i, t in enumerate(b.column("text").to_pylist()):
                prefix = None
                if vocabulary is not None:
                    prefix = sizes_in_tokens(t, vocabulary)
                    if prefix[-1] <= limit:
                        continue
                got = cut_text(len(t), boundaries(t), limit, overlap, prefix)
                rows += [i] * len(got)
                no += range(len(got))
                lo += [x for x, _ in got]
                hi += [y for _, y in got]
            i32 = pa.int32()
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(rows, pa.int64())), pa.array(no, i32), pa.array(lo, i32), pa.array(hi, i32)], ["key", "piece_no", "begin_pos", "end_pos"])

    out = long.mapInArrow(pieces, f"key {kind}, piece_no int, begin_pos int, end_pos int")
    return out.withColumnRenamed("key", key)
