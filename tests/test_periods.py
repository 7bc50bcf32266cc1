import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import ts
from storetally.functions.periods import calendar_parts, split_window, window_end, window_start


@pytest.mark.parametrize(
    "window, start, end",
    [
        ("1 month", "2024-05-01", "2024-06-01"),
        ("2 months", "2024-05-01", "2024-07-01"),
        ("5 months", "2024-03-01", "2024-08-01"),
        ("1 quarter", "2024-04-01", "2024-07-01"),
        ("1 year", "2024-01-01", "2025-01-01"),
        ("10 years", "2020-01-01", "2030-01-01"),
        ("1 day", "2024-05-31", "2024-06-01"),
    ],
)
def test_windows(spark, window, start, end):
    frame = spark.createDataFrame([(ts("2024-05-31 23:59:59.999999"),)], "t timestamp_ntz")
    found = (
        frame.withColumn("start", window_start(F.col("t"), window).cast("timestamp_ntz"))
        .withColumn("end", window_end(F.col("start"), window).cast("timestamp_ntz"))
        .first()
    )
    assert (found["start"], found["end"]) == (ts(start), ts(end))


def test_months_before_the_epoch(spark):
    frame = spark.createDataFrame([(ts("1969-12-31 00:00:00"),)], "t timestamp_ntz")
    assert frame.select(window_start(F.col("t"), "1 quarter")).first()[0] == dt.date(1969, 10, 1)


def test_window_text():
    assert split_window("2 weeks") == (2, "week")
    assert split_window(" 1 MONTH ") == (1, "month")
    for wrong in ("month", "0 days", "1 fortnight", "1.5 days", "-1 days"):
        with pytest.raises(ValueError):
            split_window(wrong)


def test_calendar_parts(spark):
    frame = spark.createDataFrame([(ts("2024-12-30 17:05:00"),)], "t timestamp_ntz")
    found = frame.select(*[part.alias(name) for name, part in calendar_parts(F.col("t")).items()]).first()
    assert found.asDict() == {
        "date": dt.date(2024, 12, 30),
        "hour": 17,
        "day_of_week": 0,
        "month": 12,
        "quarter": 4,
        "year": 2024,
    }
