from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from caseflow.functions import timestamps as ts

CASES = [
    ("2024-03-19T11:05:46.000Z", datetime(2024, 3, 19, 11, 5, 46), "iso8601_Z"),
    ("2024-03-19T11:05:46Z", datetime(2024, 3, 19, 11, 5, 46), "iso8601_Z"),
    ("20230522230301", datetime(2023, 5, 22, 23, 3, 1), "num_yyyymmddhhmmss"),
    ("20020926000000", datetime(2002, 9, 26), "num_yyyymmddhhmmss"),
    (" 20230522230301 ", datetime(2023, 5, 22, 23, 3, 1), "num_yyyymmddhhmmss"),
    ("2024-03-19T11:05:46", None, "iso8601_semZ"),
    ("202407171711", None, "num_yyyymmddhhmm"),
    ("20240717", None, "num_yyyymmdd"),
    ("abc", None, "outro"),
    ("", None, "vazio/NA"),
    ("  ", None, "vazio/NA"),
    (None, None, "vazio/NA"),
    ("20231322230301", None, "num_yyyymmddhhmmss"),
    ("2023-02-30T10:00:00Z", None, "iso8601_Z"),
    ("1938-03-31T00:00:00.000Z", datetime(1938, 3, 31), "iso8601_Z"),
]


def test_parse_and_class(spark):
    frame = spark.createDataFrame([(i, raw) for i, (raw, _, _) in enumerate(CASES)], "i int, raw string")
    rows = frame.select(
        "i", F.date_format(ts.parse_timestamp(F.col("raw")), "yyyy-MM-dd HH:mm:ss").alias("t"),
        ts.format_class(F.col("raw")).alias("c")).orderBy("i").collect()
    for row, (_, when, label) in zip(rows, CASES):
        assert row.t == (when.strftime("%Y-%m-%d %H:%M:%S") if when else None)
        assert row.c == label


@pytest.mark.parametrize("raw, shown", [
    ("20230522230301", "22/05/2023 23:03:01"),
    ("20231399999999", "99/13/2023 99:99:99"),
    ("2023", "2023"), ("", ""), (None, None)])
def test_compact_display_only_moves_characters(spark, raw, shown):
    frame = spark.createDataFrame([(raw,)], "raw string")
    assert frame.select(ts.compact_to_display(F.col("raw"))).first()[0] == shown


def test_query_time_is_really_parsed(spark):
    frame = spark.createDataFrame([("20240131_101112",), ("20241331_101112",)], "raw string")
    assert [r[0] for r in frame.select(ts.query_time_to_display(F.col("raw"))).collect()] == [
        "31/01/2024 10:11:12", None]


def test_durations_months_midnight(spark):
    row = spark.sql("""SELECT TIMESTAMP '2024-01-01 00:00:00' a, TIMESTAMP '2024-01-02 12:00:00' b,
                       TIMESTAMP '1967-06-06 00:00:00' old""").select(
        ts.days_between(F.col("a"), F.col("b")).alias("d"),
        ts.years_since("2023-01-01", F.col("a")).alias("y"),
        ts.is_midnight(F.col("a")).alias("m1"), ts.is_midnight(F.col("b")).alias("m2"),
        ts.is_midnight(F.col("old")).alias("m3"), ts.month_start(F.col("b")).alias("month"),
        F.size(ts.month_sequence("2015-01-01", "2025-10-01")).alias("months")).first()
    assert row.d == 1.5 and abs(row.y - 365 / 365.25) < 1e-12
    assert (row.m1, row.m2, row.m3) == (True, False, True)
    assert row.month == date(2024, 1, 1) and row.months == 130


def test_prefix_parsers(spark):
    row = spark.createDataFrame([("2024-03-19T11:05:46.123-03:00",)], "x string").select(
        ts.parse_date_prefix(F.col("x")).alias("d"),
        F.date_format(ts.parse_iso_prefix(F.col("x")), "yyyy-MM-dd HH:mm:ss").alias("t")).first()
    assert row.d == date(2024, 3, 19) and row.t == "2024-03-19 11:05:46"
