"""Small text functions: decoding and differences."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_base64(c: Column) -> Column:
    """The text of a base64 column; null where it is none."""
    return F.call_function("try_to_binary", c, F.lit("base64")).cast("string")


def char_diff(a: Column, b: Column) -> Column:
    """A unified difference of two texts, character by character, as one string.

    Spark has no such function, so difflib runs over Arrow batches.  Null counts as empty.
    """

    @F.pandas_udf("string")
    def diff(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(["\n".join(difflib.unified_diff(list(p or ""), list(q or ""), lineterm="", n=0)) for p, q in zip(x, y)], dtype=object)

    return diff(a, b)
