"""Calendar column expressions and date axes."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Frequencies of a date axis and the step of each.
FREQUENCIES = {"H": "1 hour", "D": "1 day", "W": "7 days", "MS": "1 month", "QS": "3 months", "YS": "1 year"}


def ts_like(df: DataFrame, column: str, value: datetime) -> Column:
    """A literal of the column's own timestamp type, so that the filter reaches the scan."""
    kind = df.schema[column].dataType.simpleString()
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(kind)


def calendar_columns(ts: Column) -> dict[str, Column]:
    """date, hour, day_of_week (Monday = 0) and ISO week."""
    return {
        "date": F.to_date(ts),
        "hour": F.hour(ts).cast("bigint"),
        "day_of_week": F.weekday(ts).cast("bigint"),
        "week_of_year": F.weekofyear(ts).cast("bigint"),
    }


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def run_id_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def first_point(start: datetime, freq: str) -> datetime:
    """Rolls forward to the next Sunday, month, quarter or year start; the time of day stays."""
    months = {"MS": 1, "QS": 3, "YS": 12}.get(freq)
    if freq == "W":
        return start + timedelta(days=6 - start.weekday())
    if months is None or (start.day == 1 and (start.month - 1) % months == 0):
        return start
    ahead = start.year * 12 + (start.month - 1) // months * months + months
    return start.replace(year=ahead // 12, month=ahead % 12 + 1, day=1)


def date_range(spark: SparkSession, start: datetime, end: datetime, freq: str = "D") -> DataFrame:
    """One row per point of the axis from the first point on, the end included."""
    first, last = (f"TIMESTAMP_NTZ '{t:%Y-%m-%d %H:%M:%S.%f}'" for t in (first_point(start, freq), end))
    step = FREQUENCIES[freq]
    return spark.sql(f"SELECT explode(IF({first} <= {last}, sequence({first}, {last}, INTERVAL {step}), array())) AS date")
