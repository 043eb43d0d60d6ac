"""Golden cases of each detector, worked out by hand: text, then what is found in it."""

import pytest
from pyspark.sql import functions as F

from textveil.operators import detect

R = {d.name: d for d in detect.RADIOLOGY + detect.CONTACTS + detect.MEASURES}
P = {d.name: d for d in detect.POSTPROCESS}
CASES = [
    (R["day_month"], "am 20.07.2021, 20.07.21 und 20.07. sowie 7.7.2020", ["20.07.2021", "20.07.21", "20.07."]),
    (R["day_month"], "1.2.3 und 20.7.", []),
    (R["year"], "seit 2019, nicht 1999, 20211", ["2019", "2021"]),
    (R["ed_date"], "ED 03/2020, ED 03/20 und 03/2020", ["03/2020", "03/20"]),
    (R["month_year"], "08/2022, 8/2022, 08.2022", ["08/2022"]),
    (R["month_name"], "Juli 2021, Okt 2020, Oct 2020, Mai-2019, Mai 19", ["Juli 2021", "Oct 2020", "Mai-2019"]),
    (R["extension"], "Tel 81234. 8123, 812345, (85678)", ["81234", "85678"]),
    (R["bracketed"], "(1234), (123), 1234", ["1234"]),
    (R["seven_digits"], "Tel 723-1234, 7231234 und 723/12345", ["723-1234"]),
    (R["record"], "E12345/20, e12345/20, AB12/19", ["E12345/20", "B12/19"]),
    (R["staff"], "Befunderstellung heute von Dr. A. Meier\nvon B. Kurz\n", ["Dr. A. Meier"]),
    (R["staff"], "Telefonische Befundübermittlung vorab an C. Lang \n", ["C. Lang "]),
    (R["study"], "Die MELANO-1 Studie lief, die CT-Studie auch.", ["MELANO-1", "CT"]),
    (R["email"], "a.b+c@x-y.org, @x.de, a@b, aa@bb.dede2@x.com", ["a.b+c@x-y.org", "aa@bb.dede", "2@x.com"]),
    (R["email"], "-" * 3000 + " a@b.de", ["a@b.de"]),
    (R["ip"], "10.0.0.1 und 1.2.3", ["10.0.0.1"]),
    (R["url"], "siehe https://x.org/a_b-1, ftp://y", ["https://x.org/a_b-1"]),
    (R["phone"], "+49 201 723-1234, 0201 723", ["+49 201 723-1234"]),
    (R["weight"], "sein Gewicht: 80 kg, Körpergewicht 75,5kg.", ["80 kg", "75"]),
    (R["size"], "die Größe: 180 cm. Körpergröße 1,80 m!", ["180 cm", "1,80 m"]),
    (P["age_years"], "45 Jahre, 45 JAHRE alt, 45-jährig", ["45", "45"]),
    (P["age_year_of_life"], "im 45. Lebensjahr, 46. LJ", ["45", "46"]),
    (P["study"], "Die Studie", []),
    (P["study"], "Die Studie lief", ["Die"]),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_detector(spark, k):
    d, text, want = CASES[k]
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc int, text string")
    got = detect.detect(df, "doc", "text", (d,)).orderBy("begin").collect()
    assert [r.covered for r in got] == want and all(text[r.begin : r.end] == r.covered for r in got)


def test_order_of_a_set(spark):
    df = spark.createDataFrame([(1, "ED 03/2020")], "doc int, text string")
    rows = detect.detect(df, "doc", "text", detect.RADIOLOGY).select("seq", "covered").orderBy("seq").collect()
    assert [r.covered for r in rows] == ["2020", "03/2020", "03/2020"]
    assert detect.detect(df.where(F.lit(False)), "doc", "text", detect.RADIOLOGY).count() == 0
