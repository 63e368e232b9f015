"""Files on shared storage as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.html import lower_keys
from docloom.functions.text import unix_newlines


def plain_path(path: Column) -> Column:
    return F.regexp_replace(path, r"^file:/+", "/")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)


#: Bytes that one value of a row can hold.
LARGEST = 2**31 - 1


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``files(path, length)``; contents are not read."""
    return _files(spark, path).select(plain_path(F.col("path")).alias("path"), "length")


def decode_strict(content: Column) -> Column:
    """UTF-8 text with LF line ends, null when the bytes are not valid UTF-8."""
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), unix_newlines(text))


def read_bodies(spark: SparkSession, path: str, largest: int = LARGEST) -> DataFrame:
    """``bodies(path, body)``, one row per file of at most ``largest`` bytes; a body that is not valid UTF-8 is null.

    Larger files can't be a value of a row; `operators.large_files` reads them by ranges.
    """
    files = _files(spark, path).where(F.col("length") <= largest)
    return files.select(plain_path(F.col("path")).alias("path"), decode_strict(F.col("content")).alias("body"))


def too_large(spark: SparkSession, path: str, largest: int = LARGEST) -> DataFrame:
    """``(path, error)`` of the files `read_bodies` leaves out, for quarantine where their format can't be read by ranges."""
    return list_files(spark, path).where(F.col("length") > largest).select(
        "path", F.concat(F.lit("file has "), F.col("length").cast("string"), F.lit(" bytes")).alias("error")
    )


def normalise_pages(pages: DataFrame) -> DataFrame:
    """Landed responses ``(url, content, headers)`` with header names in lower case."""
    return pages.withColumn("headers", lower_keys(F.col("headers")))
