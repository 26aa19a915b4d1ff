"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# First and last day of the standard calendar, inclusive.
STANDARD_FIRST, STANDARD_LAST = "2024-01-01", "2027-12-31"


def calendar(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per day from ``first`` to ``last``; both are columns of the one-row ``bounds``."""
    day = F.col("date_key")
    days = bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date_key"))
    return days.select(
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def fixed_calendar(spark, first: str = STANDARD_FIRST, last: str = STANDARD_LAST) -> DataFrame:
    return calendar(spark.range(1), F.lit(first).cast("date"), F.lit(last).cast("date"))


def calendar_of(events: DataFrame, day: str) -> DataFrame:
    """Whole years that cover every date of ``events``."""
    bounds = events.agg(
        F.trunc(F.min(day), "YEAR").alias("first"),
        F.date_sub(F.add_months(F.trunc(F.max(day), "YEAR"), 12), 1).alias("last"),
    )
    return calendar(bounds, F.col("first"), F.col("last"))
