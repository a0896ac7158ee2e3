"""Load stamps. The value is a parameter so that a run can be repeated exactly."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.schemas import LOAD_STAMP


def stamp_time(df: DataFrame, at: datetime | None = None) -> DataFrame:
    value = F.current_timestamp() if at is None else F.to_timestamp(F.lit(at.isoformat(sep=" ")))
    return df.withColumn(LOAD_STAMP, value)


def stamp_day(df: DataFrame, on: date | None = None) -> DataFrame:
    return df.withColumn(LOAD_STAMP, F.current_date() if on is None else F.lit(on))
