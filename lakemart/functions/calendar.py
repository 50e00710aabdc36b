"""Calendar attributes of a DATE column, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_key(d: Column) -> Column:
    """yyyymmdd as INT."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(d: Column) -> list[Column]:
    """The calendar dimension columns for date ``d``.

    week_of_year counts Sunday-started weeks (0-53, first Sunday opens
    week 1); day_of_week is ISO (1 = Monday .. 7 = Sunday).
    """
    iso_dow = F.weekday(d) + 1
    nxt = F.date_add(d, 1)
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int").alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        iso_dow.isin(6, 7).alias("is_weekend"),
        (F.dayofmonth(d) == 1).alias("is_month_start"),
        (F.dayofmonth(nxt) == 1).alias("is_month_end"),
        (F.month(d).isin(1, 4, 7, 10) & (F.dayofmonth(d) == 1)).alias("is_quarter_start"),
        (F.month(d).isin(3, 6, 9, 12) & (F.dayofmonth(nxt) == 1)).alias("is_quarter_end"),
    ]
