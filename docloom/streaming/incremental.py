"""Incremental ingest of landed bodies.

Chunks are upserted by key, so a batch that is repeated after a failure gives the same table and no state
has to be kept between batches. A batch's intermediate tables and shuffle files go when it ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.operators.chunking import chunk_documents
from docloom.session import step
from docloom.sinks.chunk_table import replace_documents, upsert_chunks


def ingest_stream(
    bodies: DataFrame,
    sources: DataFrame,
    table: str,
    checkpoint: str,
    run_date: str | None = None,
    replace: bool = False,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Chunk a stream of ``bodies(document_id, body)`` into ``table`` and stop once all of it is taken in.

    Bodies that can't be read or that have no source go to ``quarantine`` (by default a folder beside ``checkpoint``), one
    folder per batch, which a repeated batch overwrites; `read_quarantine` reads them.
    """
    write = replace_documents if replace else upsert_chunks
    home = quarantine or beside(checkpoint)

    def take_in(batch: DataFrame, batch_id: int) -> None:
        with step(batch.sparkSession):
            chunked = chunk_documents(batch, sources, run_date, report_missing=False).stored()
            stray = batch.join(sources.select("document_id"), "document_id", "left_anti")
            lost = chunked.quarantine.unionByName(
                stray.select("document_id", F.lit(None).cast("string").alias("input_format"), F.lit("no source").alias("error"))
            )
            lost.write.mode("overwrite").parquet(f"{home}/batch={batch_id}")
            write(batch.sparkSession, table, chunked.chunks)

    stream = bodies.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()


def beside(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-quarantine"


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """``(document_id, input_format, error, batch)`` of everything a stream could not take in."""
    return spark.read.schema("document_id string, input_format string, error string, batch int").parquet(path)
