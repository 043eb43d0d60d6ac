"""Dates in notes: recognise the format, shift, and write in the same format.

Pure expressions.  ``shift_date`` answers null where the text is no date that
can be shifted; the caller puts the error tag.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vague dates that stay as they are.
KEEP = [
    r"\d{1,2}(\.|/) ?\d{4}", r"\d{1,2}/\d{1,2}", r"\d{2}-\d{2}/\d{4}", r"\d{2}\.\d{4}-\d{2}\.\d{4}", r"\d{2}/\d{2}(-| - )\d{2}/\d{2}",
    r"\d{4}", r"\d{2}", r"\d{4}/\d{4}", r"[A-Za-zäüö]+([^\p{L}\p{N}_]+\d{2,4})?", r"[A-Za-zäüö]+\.", r"[0-9](-[0-9])? [A-Za-zä]+\.",
]
# Words that stand before a date and are dropped.
WEEKDAYS = ["montag", "dienstag", "mittwoch", "donnerstag", "freitag", "samstag", "sonntag", "sommerhitze", "mo", "fr"]
MONTHS = ["Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember"]
SHORT = [m[:3] for m in MONTHS]

# What selects a date format, in this order.
_D, _M = r"(3[01]|[12]\d|0[1-9]|[1-9])", r"(1[0-2]|0[1-9]|[1-9])"
#: name: (what selects the format, how it is read, groups of day, month, year, separators, layout)
_FORMATS = [
    ("ymd", r"\d{4}(\.|/|-)\d{1,2}(\.|/|-)\d{1,2}", rf"(\d{{4}})(\.|/|-){_M}(\.|/|-){_D}", 5, 3, 1, (2, 4), "ymd"),
    ("dmy", r"\d{1,2}([^\p{L}\p{N}_]*?)\d{1,2}([^\p{L}\p{N}_]*?)\d{4}", rf"{_D}([^\p{{L}}\p{{N}}_]*?){_M}([^\p{{L}}\p{{N}}_]*?)(\d{{4}})", 1, 3, 5, (2, 4), "dmy"),
    ("dmy2", r"\d{1,2}(\.|/|-)\d{1,2}(\.|/|-)\d{2}", rf"{_D}(\.|/|-){_M}(\.|/|-)(\d{{2}})", 1, 3, 5, (2, 4), "dmy2"),
    ("my", r"\d{1,2}(\.|/|-)\d{4}", None, 0, 0, 0, (), ""),
    ("dm", r"\d{1,2}(\.|/|-)\d{1,2}(\.?)", rf"{_D}(\.|/|-){_M}(\.?)", 1, 3, 0, (2, 4), "dm"),
    ("d", r"\d{1,2}(\.?)", rf"{_D}(\.?)", 1, 0, 0, (2,), "d"),
    ("db", r"\d{1,2}(\.?) [A-Z][äa-z]{2}", rf"{_D}(\.?) ({'|'.join(SHORT)})", 1, 3, 0, (2,), "db"),
    ("dB", r"\d{1,2}(\.?) [A-Z][äa-z]+( (\d{2,4}))?", rf"{_D}(\.?) ({'|'.join(MONTHS)})( (\d{{4}}))?", 1, 3, 5, (2,), "dB"),
    ("Bd", r"[A-Z][äa-z]+ \d{1,2}(\.?)( (\d{2,4}))?", rf"({'|'.join(MONTHS)}) {_D}(\.?)( (\d{{4}}))?", 2, 1, 5, (3,), "Bd"),
]


#: Stands between the groups of a match; a text that holds it is no date.
_MARK = "\x1f"


def _whole(pattern: str) -> str:
    return rf"^(?:{pattern})\z"


def keeps(text: Column) -> Column:
    """Whether a date is so vague that it stays."""
    return text.rlike(_whole("|".join(f"(?:{p})" for p in KEEP)))


def infer_format(text: Column) -> Column:
    """The name of the first format that fits the text, or null."""
    out = F.lit(None).cast("string")
    for name, select, *_ in reversed(_FORMATS):
        out = F.when(text.rlike(_whole(select)), F.lit(name)).otherwise(out)
    return out


def _month_number(name: Column) -> Column:
    pairs = [x for i, (long, short) in enumerate(zip(MONTHS, SHORT)) for n in {long, short} for x in (F.lit(n), F.lit(f"{i + 1:02d}"))]
    return F.element_at(F.create_map(*pairs), name)


def _year(text: Column, digits: int) -> Column:
    if digits == 4:
        return text
    return F.when(text >= "69", F.concat(F.lit("19"), text)).otherwise(F.concat(F.lit("20"), text))


def _parse(text: Column) -> Column:
    """``struct<day, layout, s0, s1, named_year>`` by the inferred format; null day where it fails."""
    none = F.lit(None).cast("string")
    failed = F.struct(none.alias("day"), none.alias("layout"), none.alias("s0"), none.alias("s1"), F.lit(False).alias("named_year"))
    out = failed
    for _, select, read, gd, gm, gy, seps, layout in reversed(_FORMATS):
        value = failed
        if read is not None:
            # one match gives all groups, strung together
            n = max(gd, gm, gy, *seps)
            groups = F.split(F.regexp_replace(text, _whole(read), _MARK.join(f"${k}" for k in range(1, n + 1))), _MARK, -1)

            def got(g: Column) -> Column:  # noqa: B023 (called at once)
                named = layout in ("db", "dB", "Bd")
                m = (_month_number(g[gm - 1]) if named else F.lpad(g[gm - 1], 2, "0")) if gm else F.lit("01")
                y = _year(g[gy - 1], 2) if layout == "dmy2" else F.when(g[gy - 1] == "", "1900").otherwise(g[gy - 1]) if gy else F.lit("1900")
                s = [g[k - 1] for k in seps] + [F.lit("")]
                has = (g[gy - 1] != "") if named and gy else F.lit(False)
                return F.struct(F.concat_ws("-", y, m, F.lpad(g[gd - 1], 2, "0")).alias("day"), F.lit(layout).alias("layout"), s[0].alias("s0"), s[1].alias("s1"), has.alias("named_year"))

            value = F.when(text.rlike(_whole(read)) & ~text.contains(_MARK), _let(groups, got)).otherwise(failed)
        out = F.when(text.rlike(_whole(select)), value).otherwise(out)
    return out


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _write(p: Column, new: Column) -> Column:
    dd, mm, yyyy = F.date_format(new, "dd"), F.date_format(new, "MM"), F.lpad(F.year(new).cast("string"), 4, "0")
    long = F.element_at(F.array(*[F.lit(x) for x in MONTHS]), F.month(new))
    tail = F.when(p["named_year"], F.concat(F.lit(" "), yyyy)).otherwise("")
    lay, s0, s1 = p["layout"], p["s0"], p["s1"]
    return (
        F.when(lay == "ymd", F.concat(yyyy, s0, mm, s1, dd))
        .when(lay == "dmy", F.concat(dd, s0, mm, s1, yyyy))
        .when(lay == "dmy2", F.concat(dd, s0, mm, s1, F.substring(yyyy, 3, 2)))
        .when(lay == "dm", F.concat(dd, s0, mm, s1))
        .when(lay == "d", F.concat(dd, s0))
        .when(lay == "db", F.concat(dd, s0, F.lit(" "), F.substring(long, 1, 3)))
        .when(lay == "dB", F.concat(dd, s0, F.lit(" "), long, tail))
        .when(lay == "Bd", F.concat(long, F.lit(" "), dd, s0, tail))
    )


def _parse_and_write(text: Column, add_days: Column, add_years: Column | None) -> Column:
    """``struct<date, written>`` in the inferred format; null parts where it fails."""

    def moved(p: Column) -> Column:
        base = F.try_to_date(p["day"], "yyyy-MM-dd")
        if add_years is not None:
            year = F.lpad((F.substring(p["day"], 1, 4).cast("int") + add_years).cast("string"), 4, "0")
            base = F.when(base.isNotNull(), F.try_to_date(F.concat(year, F.substring(p["day"], 5, 6)), "yyyy-MM-dd"))
        return _let(F.date_add(base, add_days), lambda new: F.struct(new.alias("date"), _write(p, new).alias("written")))

    return _let(_parse(text), moved)


def range_separator(text: Column) -> Column:
    """What stands between the two dates of a range (or a weekday and its date), else ''."""
    # fixed values: the three shapes of a range
    r1 = r"\d{1,2}(\.|/)(\d{1,2}(\.?))?(-| - )\d{1,2}(\.|/)\d{1,2}(\.?)"
    r2 = r"[A-Z]*[a-z]+(.*?)\d{1,2}(\.|/|-)\d{1,2}(\.?)((\.|/|-)\d{2,4})?"
    r3 = r"\d{1,2}(-| - )\d{1,2}(\.|/)\d{1,2}(\.|/)\d{4}"
    get = lambda p, k: F.regexp_extract(text, _whole(p), k)
    return F.when(text.rlike(_whole(r1)), get(r1, 4)).when(text.rlike(_whole(r2)), get(r2, 1)).when(text.rlike(_whole(r3)), get(r3, 1)).otherwise("")


def shift_date(covered: Column, days: Column, guard_before: int = 2007) -> Column:
    """A date, or a range of dates, moved by ``days``.

    ``struct<written, old>``: null ``written`` means no date that can be moved;
    ``old`` tells that a year in (1901, guard_before) came out, probably a birth
    date.  Vague dates come out as they were.
    """
    value = F.regexp_replace(F.regexp_replace(covered, r"(?U)^\s+|\s+\z", ""), r"[()]", "")

    def joined(sep: Column, moved: Column) -> Column:
        bad = F.exists(moved, lambda m: m["written"].isNull())
        old = F.exists(moved, lambda m: (F.year(m["date"]) > 1901) & (F.year(m["date"]) < guard_before))
        text = F.call_function("array_join", F.transform(moved, lambda m: m["written"]), sep)
        return F.struct(F.when(~bad, text).alias("written"), F.coalesce(old, F.lit(False)).alias("old"))

    def by_parts(value: Column, sep: Column) -> Column:
        parts = F.when(sep == "", F.array(value)).otherwise(F.split(value, F.concat(F.lit("\\Q"), sep, F.lit("\\E")), -1))
        kept = F.filter(parts, lambda d: ~F.lower(d).isin(WEEKDAYS))
        return _let(F.transform(kept, lambda d: _parse_and_write(d, days, None)), lambda moved: joined(sep, moved))

    shifted = lambda v: F.when(keeps(v), F.struct(covered.alias("written"), F.lit(False).alias("old"))).otherwise(_let(range_separator(v), lambda sep: by_parts(v, sep)))
    return _let(value, shifted)


def shift_birthdate(covered: Column, days: Column, years: Column) -> Column:
    """A birth date with its year replaced, then moved by ``days``; null where that fails."""
    return _parse_and_write(covered, days, years)["written"]


def shift_age(covered: Column, years: Column) -> Column:
    """An age plus ``years``; unchanged for 0, null for what is no whole number."""
    number = F.when(covered.rlike(r"^\s*[+-]?\d{1,9}\s*\z"), F.trim(covered).cast("int"))
    return F.when(years == 0, covered).otherwise((number + years).cast("string"))


def days_of(milliseconds: Column) -> Column:
    """Whole days of an offset in milliseconds, rounded down."""
    return F.floor(milliseconds / F.lit(86400000.0)).cast("int")
