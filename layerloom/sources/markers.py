"""Success markers: which steps of a run are done, and on what input.

A marker is a small file named after its step. It holds a digest of what the step worked on, so a
step whose input or settings changed is not taken for done.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession


def digest(*what) -> str:
    return hashlib.sha256(repr(what).encode()).hexdigest()


def input_digest(df: DataFrame) -> str:
    """Names and sizes of the files ``df`` reads; a frame without files counts as the same always."""
    spark = df.sparkSession
    sizes = []
    for name in sorted(df.inputFiles()):
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        status = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place)
        sizes.append((name, status.getLen(), status.getModificationTime()))
    return digest(df.schema.simpleString(), sizes)


class Markers:
    """The markers of one run, in a folder of its own."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def done(self, step: str, of: str) -> bool:
        place = self.path(f"{self.folder}/{step}")
        if not self.fs.exists(place):
            return False
        return self.spark.read.text(place.toString()).first()[0] == of

    def mark(self, step: str, of: str) -> None:
        out = self.fs.create(self.path(f"{self.folder}/{step}"), True)
        out.write(bytearray(of.encode()))
        out.close()
