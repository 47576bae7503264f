import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from statement_lake.functions import typed as P
from statement_lake.functions.fingerprint import fingerprint
from tests.helpers import sha

BAD = "bad"


def parse(spark, kind, raws, **options):
    rows = spark.createDataFrame([(i, raw) for i, raw in enumerate(raws)], "i int, raw string")
    text = P.value_text(F.col("raw"))
    value = P.typed(text, kind, **options)
    out = rows.select("i", value.alias("v"), P.is_bad(text, value).alias("bad")).collect()
    strict = kind in P.STRICT_TYPES
    return [BAD if row.bad and strict else row.v for row in sorted(out, key=lambda row: row.i)]


def test_dates(spark):
    day = dt.date(2024, 1, 2)
    cases = {
        None: None, "": None, "20240102": day, " 20240102 ": day, "2024-01-02": day,
        "2024-1-2": day, "20240230": BAD, "2024-02-30": BAD, "  ": BAD, "2024/01/02": BAD,
        "2024-01-02T00:00:00": BAD, "00000101": BAD, "0000-01-01": BAD, "240102": BAD,
        "\t20240102\n": day,
    }
    assert parse(spark, "date", list(cases)) == list(cases.values())


def test_timestamps(spark):
    at = dt.datetime(2024, 1, 2, 9, 30)
    cases = {
        None: None, "": None, "20240102093000": at, "20240102": dt.datetime(2024, 1, 2),
        "2024-01-02;09:30:00": at, "2024-01-02 09:30:00": at, "2024-01-02T09:30:00": at,
        "2024-1-2 9:30:0": at, "2024-01-02  09:30:00": at, "20240102;093000": BAD,
        "2024-01-02T09:30:00Z": BAD, "2024-01-02 09:30": BAD, "2024-01-02 24:00:00": BAD,
        "20240102246000": BAD, "2024-01-02": BAD, "   ": BAD,
        "2024-03-10 02:30:00": dt.datetime(2024, 3, 10, 2, 30),
    }
    assert parse(spark, "timestamp_ntz", list(cases)) == list(cases.values())
    assert parse(spark, "timestamp_ntz", ["20240102;093000"], accept_compact=True) == [at]


def test_timestamps_do_not_follow_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = spark.createDataFrame([("2024-03-10 02:30:00",)], "raw string")
        text = rows.select(P.timestamp_of(F.col("raw")).cast("string").alias("t")).first().t
        assert text == "2024-03-10 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_numbers(spark):
    cases = {
        None: None, "": None, "1,234.5": 1234.5, "-0": -0.0, "1e3": 1000.0, ".5": 0.5, "5.": 5.0,
        " 7 ": 7.0, "1_000": 1000.0, "inf": math.inf, "-Infinity": -math.inf, "abc": BAD,
        "1d": BAD, "1f": BAD, "  ": BAD, ",": BAD, "1__0": BAD, "0x10": BAD, "+1.5E-1": 0.15,
        "1 2": BAD,
    }
    assert parse(spark, "double", list(cases)) == list(cases.values())
    assert math.isnan(parse(spark, "double", ["NaN"])[0])
    assert math.isnan(parse(spark, "double", ["-nan"])[0])


def test_whole_numbers(spark):
    cases = {
        None: None, "": None, "12": 12, " 12 ": 12, "-3": -3, "+4": 4, "1.5": None, "1,000": None,
        "abc": None, "  ": None, "9007199254740993": 9007199254740993, "1_000": 1000,
        "99999999999999999999": None,
    }
    assert parse(spark, "bigint", list(cases)) == list(cases.values())


def test_flags(spark):
    cases = {None: None, "": None, "Y": True, "n": False, " y ": True, "X": None}
    assert parse(spark, "boolean", list(cases)) == list(cases.values())


@pytest.mark.parametrize(
    "attributes",
    [
        {"b": "2", "a": "1"},
        {"a": ""},
        {"a": "x", "a1": "y", "Zed": "z"},
        {"n": " padded & é|= "},
    ],
)
def test_fingerprint(spark, attributes):
    rows = spark.createDataFrame([(attributes,)], "m map<string,string>")
    assert rows.select(fingerprint(F.col("m"))).first()[0] == sha(attributes)
