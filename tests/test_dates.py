from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from textveil.functions import dates

SHIFTED = {  # +3 days; None: no date that can be moved
    "20.07.2021": "23.07.2021", "7.7.2020": "10.07.2020", "2019-8-15": "2019-08-18", "20072021": "23072021", "19.09.22": "22.09.22", "30.08": "02.09", "20.07.": "23.07.", "9.": "12.",
    "20. Juli 2021": "23. Juli 2021", "20. Juli 21": None, "12-2022": "0402-2022", "08-2022": None, "8-2022": None, "29.02.": None, "08.2022": "08.2022", "10/20": "10/20", "2021": "2021", "97": "97",
    "Oktober": "Oktober", "Juli 2021": "Juli 2021", "2021/2022": "2021/2022", "02/20-03/20": "02/20-03/20", "20.08-30.08": "23.08-02.09", "7.7.-8.8.": "10.07.-11.08.", "15 - 20.08.2020": "18 - 23.08.2020",
    "29-30.06.2020": "01-03.07.2020", "20.07.2021-25.07.2021": None, "Mittwoch, 20.12.2020": "23.12.2020", "(20.07.2021)": "23.07.2021", "01.01.1950": "04.01.1950", "kein": "kein", "": None,
}


def test_shift_golden(spark):
    df = spark.createDataFrame([(k,) for k in SHIFTED], "d string")
    got = {r.d: r.w for r in df.select("d", dates.shift_date(F.col("d"), F.lit(3))["written"].alias("w")).collect()}
    assert got == SHIFTED


def test_old_year_guard(spark):
    df = spark.createDataFrame([("01.01.1950",), ("01.01.2020",)], "d string")
    assert [r.o for r in df.select(dates.shift_date(F.col("d"), F.lit(3))["old"].alias("o")).collect()] == [True, False]


def test_birthdate_and_age(spark):
    b = spark.createDataFrame([("20.07.1980",), ("29.02.2020",), (None,)], "d string").select(dates.shift_birthdate(F.col("d"), F.lit(3), F.lit(1)).alias("x")).collect()
    assert [r.x for r in b] == ["23.07.1981", None, None]
    a = spark.createDataFrame([("45", 2), ("45 Jahre", 2), ("45 Jahre", 0)], "d string, y int").select(dates.shift_age(F.col("d"), F.col("y")).alias("x")).collect()
    assert [r.x for r in a] == ["47", None, "45 Jahre"]


def moved_birthdate(text, days, years):
    """By datetime: read in the shape's format, replace the year, add days, write alike."""
    month = {m: f"{i:02d}" for i, m in enumerate(dates.MONTHS, 1)}
    words = text.split(" ")
    if len(words) == 3:  # d. Month yyyy
        text = f"{words[0]} {month[words[1]]} {words[2]}"
    for form in ("%d.%m.%Y", "%Y-%m-%d", "%d/%m/%Y", "%d. %m %Y", "%d.%m.%y", "%d.%m.", "%d%m.%Y", "%d."):
        try:
            if form == "%d%m.%Y" and text[0] != "1":  # MM.yyyy is read as d, M, yyyy where it can be
                continue
            day = datetime.strptime(text, form)
            new = (day.replace(year=day.year + years) + timedelta(days=days)).strftime(form)
        except ValueError:
            continue
        if len(words) == 3:
            d, m, y = new.split(" ")
            return f"{d} {dates.MONTHS[int(m) - 1]} {y}"
        return new
    return None


def test_birthdates_of_every_shape(spark):
    cases = {"20.07.97": "24.07.99", "20.07.": "24.07.", "20. Juli 1997": "24. Juli 1999", "29. Februar 1996": None, "29.02.": None, "12.1997": "0502.1999", "07.1997": None, "9.": "13.", "kein Datum": None}
    df = spark.createDataFrame([(k,) for k in cases], "d string").select("d", dates.shift_birthdate(F.col("d"), F.lit(4), F.lit(2)).alias("x"))
    assert {r.d: r.x for r in df.collect()} == cases == {k: moved_birthdate(k, 4, 2) for k in cases}


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables")
def test_birthdates_of_all_rows(spark):
    from textveil.plans import catalog

    d = "/root/testdata/sf0.001"
    given = {r.doc: (r.covered, r.days, r.years) for r in catalog._dates(spark, d).collect()}
    got = {r.doc: (r.covered, r.shifted) for r in catalog.Q["shift_birthdates"](spark, d).collect()}
    assert got == {k: (text, moved_birthdate(text, days, years)) for k, (text, days, years) in given.items()}


@pytest.mark.parametrize("days", [1, 14, -30])
def test_there_and_back(spark, days):
    df = spark.createDataFrame([("20.07.2021",), ("2019-08-15",), ("01/12/2020",)], "d string")
    there = df.select("d", dates.shift_date(F.col("d"), F.lit(days))["written"].alias("w"))
    assert all(r.d == r.b for r in there.select("d", dates.shift_date(F.col("w"), F.lit(-days))["written"].alias("b")).collect())


def test_days_of(spark):
    got = spark.range(1).select(dates.days_of(F.lit(-1)).alias("a"), dates.days_of(F.lit(86400000 * 3)).alias("b")).first()
    assert (got.a, got.b) == (-1, 3)
