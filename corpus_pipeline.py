"""A training corpus from raw documents: toxic ones out, one of each group of copies and near copies, mixed, packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs.
All stages but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import exact_dedup, mixing, packing, similar, toxicity
from docloom.llm.common import table
from docloom.session import run_dir

#: A name that no column of documents has, for what is joined on.
MARK = "_pipeline_key"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic, unchanged. It learns as `op3` does, from rows not held out."""
    labels = table(spark, sf_dir, "labels")
    seen = ~toxicity.held_out("doc_id")
    return toxicity.without_toxic(docs, toxicity.train(docs.where(seen), labels.where(seen)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id; of rows that repeat an id and a text, one."""
    found = exact_dedup.exact_dedup(docs)
    key = lambda sha: F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), sha)
    stay = found.where("kept").select(key(F.col("text_sha256")).alias(MARK)).distinct()
    marked = docs.withColumn(MARK, key(F.sha2(exact_dedup.normalised(F.col("text")), 256)))
    return marked.join(stay, MARK).dropDuplicates([MARK]).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts with similar five-word shingles the document with the smallest doc_id.

    Candidates are what `simhash` links, as `op6` does, and texts that share min-wise keys, since fingerprints of 64 bits alone are too
    coarse for this similarity; the exact similarity confirms both.
    """
    return similar.one_of_each_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. Rows that repeat an id and a text count together."""
    marked = docs.withColumn(MARK, F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.sha2(F.coalesce("text", F.lit("")), 256)))
    mixed = mixing.mix(marked, key=MARK).groupBy(MARK).agg(F.sum("copies").cast("int").alias(f"{MARK}_times"))
    rows = marked.join(mixed.where(f"{MARK}_times > 0"), MARK).dropDuplicates([MARK])
    repeated = F.explode(F.array_repeat(F.lit(0), F.col(f"{MARK}_times"))).alias(f"{MARK}_copy")
    return rows.select(*docs.columns, repeated).select(*docs.columns)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch and slot of every row that is left, repeats included."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

#: The classifier is trained, which SQL can't express; tests hold `run` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    home = f"{run_dir(spark)}/pipeline-{uuid.uuid4()}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{name}")
        docs = spark.read.parquet(f"{home}/{name}")
    return docs
