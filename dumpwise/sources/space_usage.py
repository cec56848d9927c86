"""Site space-usage JSON documents as rows ``(source, text)``: one row per file, whole file text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_space_reports(spark: SparkSession, path: str) -> DataFrame:
    """Every file under ``path`` as one document: ``source`` (file path) and ``text``.

    Site reports are a few kilobytes each; each file is read whole by one task,
    many files spread over many tasks.
    """
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source"), F.col("value").alias("text"))
