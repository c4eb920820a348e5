import datetime

from pyspark.sql import functions as F

from concord.functions import dates, numbers

COUNTS = {
    "12": 12,
    " 1,234 ": 1234,
    "1 000": 1000,
    "12.9": 12,
    "-3.7": -3,
    "1e3": 1000,
    ".5": 0,
    "7.": 7,
    "": 0,
    "n/a": 0,
    "nan": 0,
    "inf": 0,
    "1d": 0,
    "0x1A": 0,
    "1 2": 0,
    "9007199254740993": 9007199254740993,
    None: 0,
}
KEYS = {
    "007": "7",
    "7.0": "7",
    " 1,000 ": "1000",
    "1e5": "100000",
    "-0.0": "0",
    "1_000": "1000",
    "12.5": "12.5",
    "AB-7": "AB-7",
    "nan": "nan",
    "inf": "inf",
    "1d": "1d",
    "": "",
    "  ": "",
    "12345678901234567890123": str(int(float("12345678901234567890123"))),
    "9007199254740993": "9007199254740992",
    None: "",
}
DAYS = {
    "2021-05-11": (2021, 5, 11),
    "2021/5/1": (2021, 5, 1),
    "May 11, 2021": (2021, 5, 11),
    "may 1,2021": (2021, 5, 1),
    "September 3, 2020": (2020, 9, 3),
    "11 May 2021": (2021, 5, 11),
    "11-May-2021": (2021, 5, 11),
    "05/11/2021": (2021, 5, 11),
    "25/05/2021": (2021, 5, 25),
    "25.05.2021": (2021, 5, 25),
    "20210511": (2021, 5, 11),
    "2021-05-11T08:30:00": (2021, 5, 11),
    "  2021-05-11   23:59:59.123 ": (2021, 5, 11),
    "2021-13-01": None,
    "2021-02-30": None,
    "pending": None,
    "": None,
    None: None,
}


def table(spark, cells, **functions):
    frame = spark.createDataFrame([(c,) for c in cells], "c string")
    out = frame.select("c", *[f(F.col("c")).alias(n) for n, f in functions.items()])
    return {r["c"]: r for r in out.collect()}


def test_to_int(spark):
    found = table(spark, COUNTS, n=numbers.to_int)
    assert {c: found[c]["n"] for c in COUNTS} == COUNTS


def test_normalize_id_key(spark):
    found = table(spark, KEYS, k=numbers.normalize_id_key)
    wanted = dict(KEYS)
    long = "12345678901234567890123"
    assert float(found[long]["k"]) == float(long)  # digits beyond a double's are not defined
    wanted[long] = found[long]["k"]
    assert {c: found[c]["k"] for c in KEYS} == wanted


def test_to_rate(spark):
    found = table(spark, ["0.5", "n/a", None, " 7 "], r=numbers.to_rate)
    assert {c: r["r"] for c, r in found.items()} == {"0.5": 0.5, "n/a": None, None: None, " 7 ": 7.0}


def test_dates(spark):
    found = table(spark, DAYS, d=dates.parse_date, t=dates.parse_date_text)
    wanted = {c: d and datetime.date(*d) for c, d in DAYS.items()}
    assert {c: found[c]["d"] for c in DAYS} == wanted
    assert {c: found[c]["t"] for c in DAYS} == {c: str(d) if d else "" for c, d in wanted.items()}


def test_time_of_day_is_kept(spark):
    found = table(spark, ["May 11, 2021 14:05"], t=dates.parse_timestamp)
    assert found["May 11, 2021 14:05"]["t"] == datetime.datetime(2021, 5, 11, 14, 5)
