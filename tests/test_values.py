import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import values
from tidemark.functions.payload import normalized_payload, raw_payload

WIDE = " \tx y \n"


def test_trim_covers_every_white_space_character(spark):
    texts = [f"{c}a{c}b{c}" for c in values.WHITE_SPACE] + [WIDE, "a  b", "", "​z"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.v for r in rows.select(values.trimmed(F.col("t")).alias("v")).collect()]
    assert got == [t.strip(values.WHITE_SPACE) for t in texts]
    assert got[-4:] == ["x y", "a  b", "", "​z"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-02 03:04:00", "2024-01-02T03:04:00Z"),
        ("2024-01-02 03:04:05.12", "2024-01-02T03:04:05.12Z"),
        ("2024-01-02 03:04:05.000001", "2024-01-02T03:04:05.000001Z"),
        ("1969-12-31 23:59:59.5", "1969-12-31T23:59:59.5Z"),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_timestamps_without_zone(spark, text, expected, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        row = spark.sql(f"SELECT timestamp_ntz '{text}' AS t").select(
            values.utc_text(F.col("t"), T.TimestampNTZType()).alias("v")
        )
        assert row.first().v == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-02 03:04:05+03:00", "2024-01-02T00:04:05Z"),
        # Inside the hour that New York skips, and in the one it repeats.
        ("2024-03-10 02:30:00.25Z", "2024-03-10T02:30:00.25Z"),
        ("2024-11-03 06:30:00Z", "2024-11-03T06:30:00Z"),
    ],
)
def test_timestamps_with_zone(spark, text, expected, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        row = spark.sql(f"SELECT timestamp '{text}' AS t").select(
            values.utc_text(F.col("t"), T.TimestampType()).alias("v")
        )
        assert row.first().v == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_dates_and_nulls(spark):
    row = spark.sql("SELECT date '2024-01-02' AS d, cast(NULL AS date) AS n")
    got = row.select(
        values.utc_text(F.col("d"), T.DateType()).alias("d"),
        values.utc_text(F.col("n"), T.DateType()).alias("n"),
    ).first()
    assert (got.d, got.n) == ("2024-01-02T00:00:00Z", None)


def test_binary_becomes_text_untrimmed(spark):
    rows = spark.createDataFrame([(bytearray(b"12"), bytearray(b" A"))], "a binary, b binary")
    got = values.normalized(rows).first()
    assert (got.a, got.b) == ("12", " A")


def test_other_types_stay(spark):
    rows = spark.sql("SELECT 1 AS i, 1.5D AS d, true AS b, array(1.5F) AS a, cast(NULL AS int) AS n")
    assert values.normalized(rows).dtypes == rows.dtypes
    assert values.normalized(rows).collect() == rows.collect()


def test_names(spark):
    rows = spark.createDataFrame([(1, 2)], "` Id ` int, `B.c` int")
    assert values.normalized(rows).columns == ["id", "b.c"]


def test_name_collision_names_both(spark):
    rows = spark.createDataFrame([(1, 2)], "`Id` int, `id ` int")
    with pytest.raises(ValueError, match="'Id'.*'id '"):
        values.normalized(rows)


def test_payload_keeps_nulls_order_and_microseconds(spark):
    rows = spark.sql(
        "SELECT 2 AS b, cast(NULL AS string) AS c, timestamp_ntz '2024-01-01 00:00:07.179575' AS a,"
        " array(timestamp_ntz '2024-01-01 00:00:07.179575') AS n"
    )
    text = '{"a":"2024-01-01T00:00:07.179575Z","b":2,"c":null,"n":["2024-01-01T00:00:07.179575"]}'
    got = rows.select(raw_payload(rows).alias("r"), normalized_payload(rows).alias("n")).first()
    assert (got.r, got.n) == (text, text)


def test_raw_payload_keeps_names_and_encodes_bytes(spark):
    rows = spark.createDataFrame([(" x ", bytearray(b"12"))], "` Id ` string, b binary")
    got = rows.select(raw_payload(rows).alias("r"), normalized_payload(rows).alias("n")).first()
    assert got.r == '{" Id ":" x ","b":"MTI="}'
    assert got.n == '{"b":"12","id":"x"}'


def test_find_column_ignores_case_and_space(spark):
    rows = spark.createDataFrame([(1,)], "` Updated_At ` int")
    assert values.find_column(rows, "UPDATED_AT").name == " Updated_At "
    assert values.find_column(rows, "other") is None
    with pytest.raises(ValueError, match="other"):
        values.require_column(rows, "other")


def test_utc_clock_of_zoned_time(spark):
    row = spark.sql("SELECT timestamp '2024-01-02 03:04:05.000007Z' AS t")
    got = row.select(values.utc_clock(F.col("t"), T.TimestampType()).alias("t")).first().t
    assert got == datetime.datetime(2024, 1, 2, 3, 4, 5, 7)
