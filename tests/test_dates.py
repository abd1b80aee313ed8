import datetime as dt

import pytest
from pyspark.sql import functions as F

from starload.functions.dates import parse_date, parse_date_report, parse_timestamp
from starload.plans.calendar import date_dimension


def test_calendar_full_range(spark):
    cal = date_dimension(spark)
    assert cal.count() == 95_328
    assert len(cal.columns) == 22
    row = cal.where(F.col("date") == dt.date(1900, 12, 31)).first()
    assert row["centurys"] == 19 and row["decade"] == 1900
    row = cal.where(F.col("date") == dt.date(1901, 1, 1)).first()
    assert row["centurys"] == 20


def test_calendar_attributes_of_one_day(spark):
    r = date_dimension(spark, "2024-02-29", "2024-02-29").first().asDict()
    assert r == {
        "date": dt.date(2024, 2, 29), "date_key": 20240229, "day_of_month": 29,
        "day_of_year": 60, "day_of_week": 4, "day_name": "Thursday", "day_short_name": "Thu",
        "week_number": 9, "week_of_month": 5, "week": dt.date(2024, 2, 26), "month_number": 2,
        "month_name": "February", "month_short_name": "Feb",
        "first_day_of_month": dt.date(2024, 2, 1), "last_day_of_month": dt.date(2024, 2, 29),
        "quarter_number": 1, "quarter_name": "Q1", "first_day_of_quarter": dt.date(2024, 1, 1),
        "last_day_of_quarter": dt.date(2024, 3, 31), "year": 2024, "decade": 2020, "centurys": 21,
    }


def test_sunday_is_zero(spark):
    r = date_dimension(spark, "2024-01-07", "2024-01-07").first()
    assert r["day_of_week"] == 0 and r["day_name"] == "Sunday"


def test_parse_timestamp_single_digit_fields(spark):
    df = spark.createDataFrame([("9.1.2016 9:00:01",), ("12.01.2016 13:5:7",)], "s string")
    got = [r[0] for r in df.select(parse_timestamp("s")).collect()]
    assert got == [dt.datetime(2016, 1, 9, 9, 0, 1), dt.datetime(2016, 1, 12, 13, 5, 7)]


def test_parse_timestamp_strict_raises_lenient_nulls(spark):
    df = spark.createDataFrame([("31.02.2016 1:1:1",)], "s string")
    assert df.select(parse_timestamp("s", strict=False)).first()[0] is None
    with pytest.raises(Exception):
        df.select(parse_timestamp("s")).collect()


def test_parse_date_report_counts_rejects(spark):
    df = spark.createDataFrame([("1.2.2020",), ("bad",), (None,)], "s string")
    r = parse_date_report(df, "s").first()
    assert (r["rows"], r["parsed"], r["rejected"], r["all_parsed"]) == (3, 1, 1, False)
    assert [x[0] for x in df.select(parse_date("s")).collect()] == [dt.date(2020, 2, 1), None, None]
