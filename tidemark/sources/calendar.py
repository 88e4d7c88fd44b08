"""The calendar dimension (DimDate, S5): a pipe-delimited CSV with a header.

``calendar_rows`` derives the 17 columns from a date span (the CSV itself is
produced outside the pipeline; these are our definitions of its columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import staging_schema

CSV_OPTIONS = {"header": "true", "sep": "|", "dateFormat": "yyyy-MM-dd"}


def read_calendar_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed read with the declared schema (no inference pass over the file)."""
    return spark.read.schema(staging_schema("DimDate")).options(**CSV_OPTIONS).csv(path)


def write_calendar_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def calendar_rows(span: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """One row per day of each (start, end) span, with the calendar columns."""
    d = F.col("Date")
    q = F.quarter(d)
    days = span.select(F.explode(F.sequence(F.col(start_col), F.col(end_col))).alias("Date"))
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("DateNum"),
        d,
        F.year(d).alias("YearId"),
        (F.year(d) * 100 + F.month(d)).cast("int").alias("YearMonthNum"),
        F.concat(F.lit("Q"), q.cast("string"), F.lit("-"), F.year(d).cast("string")).alias("Calendar_Quarter"),
        F.month(d).alias("MonthNum"),
        F.date_format(d, "MMMM").alias("MonthName"),
        F.date_format(d, "MMM").alias("MonthShortName"),
        F.weekofyear(d).alias("WeekNum"),
        F.dayofyear(d).alias("DayNumOfYear"),
        F.dayofmonth(d).alias("DayNumOfMonth"),
        (F.weekday(d) + 1).cast("int").alias("DayNumOfWeek"),
        F.date_format(d, "EEEE").alias("DayName"),
        F.date_format(d, "EEE").alias("DayShortName"),
        q.alias("Quarter"),
        (F.year(d) * 10 + q).cast("int").alias("YearQuarterNum"),
        (F.datediff(d, F.date_trunc("quarter", d).cast("date")) + 1).cast("int").alias("DayNumOfQuarter"),
    )
