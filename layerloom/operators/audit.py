"""Row counts over several tables as one frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.sources import tables


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per frame: its name and how many rows it has."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionAll, counts)


REPORT = "table_name string, n_rows long, error string"


def table_report(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Row counts of catalog tables, each counted by a job of its own.

    A table that cannot be resolved, whose files are gone, or whose files cannot be read is listed
    with its error and leaves the other counts alone.
    """
    rows = []
    for name in names:
        try:
            place = tables.location_of(spark, name)
            if place is not None and not tables.path_exists(spark, place):
                rows.append((name, None, f"location is missing: {place}"))
            else:
                rows.append((name, spark.table(name).count(), None))
        except (PySparkException, Py4JJavaError) as e:
            known = e.getCondition() if isinstance(e, PySparkException) else None
            rows.append((name, None, known or str(e).splitlines()[0]))
    return spark.createDataFrame(rows, REPORT)
