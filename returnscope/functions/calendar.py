"""Calendar attributes of a date column (the date dimension's columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .labels import col_


def calendar_columns(d) -> list[Column]:
    d = col_(d)
    iso_dow = F.extract(F.lit("DAYOFWEEK_ISO"), d).cast("int")
    return [
        d.alias("date_key"),
        iso_dow.alias("iso_dow"),
        F.dayofmonth(d).alias("day_of_month"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month"),
        # PostgreSQL's 'Month' pattern: full name, blank-padded to 9 characters.
        F.rpad(F.date_format(d, "MMMM"), 9, " ").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.trunc(d, "week").alias("week_start"),
        F.trunc(d, "month").alias("month_start"),
        F.trunc(d, "quarter").alias("quarter_start"),
        F.trunc(d, "year").alias("year_start"),
        iso_dow.isin(6, 7).alias("is_weekend"),
    ]
