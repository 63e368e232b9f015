"""Exact deduplication as a stream with keyed state.

Documents come as a stream of small records: identifier, digest of the normalised text, and where the text lies (its
file). The state, kept by the RocksDB store in the checkpoint folder and never expired, holds per digest the largest
identifier with its record and the number of documents, so a later run that finds new files goes on where the last
one ended. Spark aggregates before it shuffles, so a digest that a third of all documents share arrives as
one record per task.

A digest that was met before is a hit. Hits are checked on their full bytes: the texts of documents in groups of two
and more are compared with the text that stays. Should texts of one digest differ, they are grouped by the text itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import ascii_lower, table
from docloom.session import pinned, run_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Settings of the state while a stream runs; every store would reserve several MB of disk for logs beforehand.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
RECORD = "key BIGINT, row BIGINT, digest BINARY, sha STRING, locator STRING"


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def records(docs: DataFrame, key: str, text: str, digest=None) -> DataFrame:
    """What the stream carries of each document. ``digest`` makes a binary digest of a text column."""
    whole = normalised(F.col(text))
    return docs.select(
        F.col(key).cast("bigint").alias("key"),
        F.monotonically_increasing_id().alias("row"),
        (F.unhex(F.sha2(whole, 256)) if digest is None else digest(whole)).alias("digest"),
        F.sha2(whole, 256).alias("sha"),
        F.input_file_name().alias("locator"),
    )


def run_stream(spark: SparkSession, source: str, state: str, out: str, files_per_batch: int | None = None) -> None:
    """Take in all record files of ``source`` that the state in ``state`` hasn't seen.

    Every batch writes the digests it changed to ``out``, in a folder of its own, which a repeated batch overwrites.
    """
    before = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)
    try:
        reader = spark.readStream.schema(RECORD)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        seen = (
            reader.parquet(source)
            .groupBy("digest")
            .agg(F.max(F.struct("key", "row", "locator")).alias("kept"), F.count("*").alias("n"))
        )

        def store(changed: DataFrame, batch: int) -> None:
            changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")

        seen.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", state).trigger(
            availableNow=True
        ).start().awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def groups(spark: SparkSession, out: str) -> DataFrame:
    """The latest state of every digest: digest, kept (key, row, locator), n."""
    kept = "STRUCT<key: BIGINT, row: BIGINT, locator: STRING>"
    changes = spark.read.schema(f"digest BINARY, kept {kept}, n BIGINT, batch INT").parquet(out)
    last = changes.groupBy("digest").agg(F.max(F.struct("batch", "kept", "n")).alias("last"))
    return last.select("digest", "last.kept", "last.n")


def exact_dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", digest=None, files_per_batch: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256, keep_locator.

    Texts are equal when identical after lower-casing A-Z; null counts as the empty text. Of equal texts the row with
    the largest key stays; of rows that repeat a key and a text exactly one has ``kept``. A null key is smaller than any
    other. An empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    home = f"{run_dir(spark)}/exact-{uuid.uuid4()}"
    taken = docs.select(key, text)
    records(taken, key, text, digest).write.parquet(f"{home}/records")
    run_stream(spark, f"{home}/records", f"{home}/state", f"{home}/groups", files_per_batch)
    found = pinned(
        spark.read.schema(RECORD)
        .parquet(f"{home}/records")
        # stored, so that adaptive execution can split the join on a digest that very many documents have
        .join(pinned(groups(spark, f"{home}/groups")), "digest")
        .select("key", "row", "digest", "sha", "kept", "n")
    )
    # by key and text, so that a row meets one hit only, however many rows have its key or none
    hits = found.where("n > 1").select(F.col("key").alias("hit"), "sha", "digest", F.col("kept.key").alias("keep")).distinct()
    whole = taken.select(F.col(key).cast("bigint").alias("hit"), normalised(F.col(text)).alias("whole"))
    hashed = whole.withColumn("sha", F.sha2("whole", 256)).alias("t")
    met = hashed.join(hits.alias("h"), (F.col("t.sha") == F.col("h.sha")) & F.col("t.hit").eqNullSafe(F.col("h.hit")))
    texts = pinned(met.select("t.hit", "digest", "keep", "whole"))
    other = different(texts)
    return with_corrections(found, texts, other).select(
        F.col("key").alias(key), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"), "keep_locator"
    )


def different(texts: DataFrame) -> DataFrame:
    """Digests under which the full bytes of some text differ from those that stay."""
    stays = texts.where(F.col("hit").eqNullSafe(F.col("keep"))).select(
        F.col("digest").alias("of"), F.col("whole").alias("standing")
    )
    # one standing text is enough to tell whether there are different ones; stored, so that the join can be split
    stays = pinned(stays.dropDuplicates(["of"]))
    unequal = texts.join(stays, F.col("digest") == F.col("of")).where("whole <> standing")
    # stored before it is grouped: a grouping on the digest would keep the join from being split on a frequent one
    return pinned(pinned(unequal.select("digest")).distinct())


def with_corrections(found: DataFrame, texts: DataFrame, other: DataFrame) -> DataFrame:
    """Group the documents of those digests by text; the digest of the text finds each document's own group."""
    exact = found.join(other, "digest").groupBy("digest", "sha").agg(
        F.max(F.struct("key", "row")).alias("largest"), F.count("*").alias("members")
    )
    # stored: it is mostly empty, and the join then moves no rows
    joined = found.join(pinned(exact), ["digest", "sha"], "left")
    keep = F.coalesce(F.col("largest"), F.struct(F.col("kept.key").alias("key"), F.col("kept.row").alias("row")))
    return joined.select(
        "key",
        "sha",
        keep.getField("key").alias("keep_id"),
        F.coalesce("members", "n").alias("group_size"),
        (F.col("row") == keep.getField("row")).alias("kept"),
        F.when(F.col("largest").isNull(), F.col("kept.locator")).alias("keep_locator"),
    )


ORACLE = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS whole FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY whole)
"""


def query(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
