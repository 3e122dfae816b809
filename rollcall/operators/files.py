"""Files that still have to be fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.schema import FILE_FIELDS, RECORD


def stored_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(file_name, path, n_bytes, changed) of the files below ``folder``, listed by Spark; their content is never read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    return found.select(
        F.substring_index("path", "/", -1).alias("file_name"), "path", F.col("length").alias("n_bytes"), F.col("modificationTime").alias("changed")
    )


def pending(snapshot: DataFrame, stored: DataFrame, fields: list[str] = FILE_FIELDS) -> DataFrame:
    """(record, field, file name) for every named file not in the store yet."""
    long = snapshot.unpivot([RECORD], fields, "field", "file_name")
    named = long.filter(F.coalesce(F.col("file_name"), F.lit("")) != "")
    return named.join(stored.select("file_name"), "file_name", "left_anti").select(
        RECORD, "field", "file_name"
    )
