import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewire.functions import casts


def column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def one(df, col):
    return [r[1] for r in rows(df.select("i", col))]


def test_integers_round_half_away_from_zero(spark):
    df = column(spark, ["3.7", "2.5", "-2.5", "1e3", " 4 ", None, "7", "-0.4"])
    expected = [4, 3, -3, 1000, 4, None, 7, 0]
    assert one(df, casts.strict_int(F.col("v"))) == expected
    assert one(df, casts.lenient_int(F.col("v"))) == expected


def test_long_keeps_all_digits(spark):
    df = column(spark, ["9007199254740993", "197001010001", "12.5"])
    assert one(df, casts.strict_int(F.col("v"), "bigint")) == [9007199254740993, 197001010001, 13]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("text", ["", "abc", "NaN", "12d", "99999999999"])
def test_bad_integer_fails_or_is_null(spark, text, ansi):
    df = column(spark, [text])
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert one(df, casts.lenient_int(F.col("v"))) == [None]
        with pytest.raises(Exception):
            df.select(casts.strict_int(F.col("v"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("text", ["", "north", "1.5d"])
def test_bad_double_fails_or_is_null(spark, text):
    df = column(spark, [text])
    assert one(df, casts.lenient_double(F.col("v"))) == [None]
    with pytest.raises(Exception):
        df.select(casts.strict_double(F.col("v"))).collect()


def test_doubles(spark):
    assert one(column(spark, ["33.5", "-1e-2", None]), casts.strict_double(F.col("v"))) == [33.5, -0.01, None]


def test_timestamps_drop_the_offset(spark):
    values = ["2025-12-01T15:32:56Z", "2025-12-01T15:32:56+02:00", "2025-12-01", "bad", "2025", None]
    noon = dt.datetime(2025, 12, 1, 15, 32, 56)
    expected = [noon, noon, dt.datetime(2025, 12, 1), None, None, None]
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert one(column(spark, values), casts.to_ntz(F.col("v"))) == expected
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_iso_text_round_trip(spark):
    df = column(spark, ["2025-12-01T15:32:56Z", None])
    assert one(df, casts.ntz_to_iso(casts.to_ntz(F.col("v")))) == ["2025-12-01T15:32:56Z", None]
