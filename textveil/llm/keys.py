"""Spelling of keys: Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The spellings of a phase.
PHASES = {
    "train": "train", "training": "train",
    "validation": "validation", "val": "validation", "valid": "validation", "dev": "validation",
    "test": "test", "testing": "test",
}


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def hex_id(c: Column) -> Column:
    """The sixteen hex digits of an id in lower case, whatever stands around them; else null."""
    return F.nullif(F.lower(F.regexp_extract(c, r"(?<![0-9A-Za-z])([0-9a-fA-F]{16})(?![0-9A-Za-z])", 1)), F.lit(""))


def person_number(c: Column) -> Column:
    """A per_number as a positive whole number (``PER02023719``, ``2030782.0``); else null."""
    digits = F.regexp_extract(c, r"^\s*(?:[A-Za-z]+[\s_:/#.-]*)?0*([0-9]{1,18})(?:\.0+)?\s*$", 1)
    n = digits.try_cast("bigint")
    return F.when(n > 0, n)


def phase(c: Column) -> Column:
    """train, validation, test or null."""
    low = F.lower(strip(c))
    out = F.lit(None).cast("string")
    for name in ("train", "validation", "test"):
        out = F.when(low.isin([k for k, v in PHASES.items() if v == name]), F.lit(name)).otherwise(out)
    return out


def label(c: Column) -> Column:
    """A category in lower case, words tied by one underscore; blank is null."""
    return F.nullif(F.regexp_replace(F.lower(strip(c)), r"(?U)[\s_]+", "_"), F.lit(""))


def filled(c: Column) -> Column:
    """Whether a string is neither null nor blank."""
    return F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))
