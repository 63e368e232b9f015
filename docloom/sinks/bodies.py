"""Stored bodies: a dataset keyed by path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.utils import AnalysisException

from docloom.session import pinned
from docloom.sinks.partitions import bucket, only_touched, ready_to_write

BUCKETS = 64
SCHEMA = "path string, content binary, bucket int"


def overwrite_bodies(bodies: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Store ``bodies(path, content)``: same paths are overwritten, others stay. Buckets are fixed per dataset."""
    spark = bodies.sparkSession
    change = pinned(bodies.select("path", "content").withColumn("bucket", bucket("path", buckets)))
    try:
        stored = spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException:  # nothing stored yet
        stored = change.limit(0)
    kept = only_touched(stored, change, ["bucket"]).join(change.select("path"), "path", "left_anti")
    merged = ready_to_write(kept.select("path", "content", "bucket").unionByName(change), ["bucket"])
    writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("bucket").parquet(path)


def stored_bodies(spark, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path).select("path", "content")
