"""The chunk table: namespaces as partitions, keyed upsert, document replacement, namespace deletion.

Below the namespace lie hash buckets of documents, as many as its size asks for: a power of two that is kept in the table's
properties and grows when a change would bring more than `BUCKET_ROWS` rows to a bucket. The buckets of a namespace with n of them are
numbered from n to 2n - 1, so those of different sizes never share a partition. A namespace that grows is rewritten once, to
partitions that nobody reads until the property names their number; what has the old number is dropped afterwards. A run that dies
in between leaves partitions without meaning, which the next change of the namespace drops.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from docloom.constants import BATCH_SIZE, METRIC, TEXT_FIELD, WORDING
from docloom.functions.text import strip
from docloom.schemas import CHUNKS, RECORD_COLUMNS
from docloom.session import pinned
from docloom.sinks.partitions import one_of, only_touched

KEY = ["namespace", "_id"]
DOCUMENT = ["namespace", "document_id"]
PARTITION = ["namespace", "bucket"]
BUCKET_ROWS = 100_000
#: Partitions that are rewritten at once: what a change needs on disk beside the table is bounded by their rows.
AT_ONCE = 8
#: Property that holds a namespace's number of buckets; 1 where there is none.
BUCKETS = "buckets/"


class NamespaceError(ValueError):
    """A namespace is missing or blank."""


class DuplicateKeys(ValueError):
    """A payload has a key twice under the same date; the first few are named."""


# --- the same changes as plain DataFrame operations ------------------------------------------------------------


def latest(chunks: DataFrame) -> DataFrame:
    """One row per key, the latest date winning; copies are reduced before they are moved."""
    rest = [c for c in chunks.columns if c not in KEY]
    newest = F.max(F.struct("document_date", *[c for c in rest if c != "document_date"]))
    return chunks.groupBy(*KEY).agg(newest.alias("_r")).select(*[F.col(c if c in KEY else f"_r.{c}") for c in chunks.columns])


def settled(new: DataFrame) -> DataFrame:
    """``new`` stored, with one row per key. Of a key's rows the one with the latest date counts; two of that date are an error.

    Ids of chunks are unique as long as ids of documents are, so mostly only keys are moved to see that.
    """
    change = pinned(new)
    rest = [c for c in change.columns if c not in KEY]
    repeated = change.groupBy(*KEY).agg(F.count("*").alias("_n"), F.max("document_date").alias("_last")).filter("_n > 1")
    repeated = pinned(repeated)
    if repeated.isEmpty():
        return change
    last = change.join(repeated, KEY).filter("document_date = _last").groupBy(*KEY).agg(F.countDistinct(F.struct(*rest)).alias("_n"))
    double = last.filter("_n > 1").orderBy(*KEY).limit(5).collect()
    if double:
        raise DuplicateKeys(", ".join(f"{r.namespace}/{r._id}" for r in double))
    return pinned(latest(change))


def _put(old: DataFrame, change: DataFrame) -> DataFrame:
    kept = old.join(change.select(*KEY), KEY, "left_anti")
    return kept.select(old.columns).unionByName(change)


def _replace(old: DataFrame, change: DataFrame) -> DataFrame:
    documents = change.select(*DOCUMENT).distinct()
    kept = old.join(documents, DOCUMENT, "left_anti")
    return kept.select(old.columns).unionByName(change)


def upserted(old: DataFrame, new: DataFrame) -> DataFrame:
    """``old`` with the rows of ``new`` added, or put in place of those with the same key.

    ``new`` is used twice, so it is written to the shared folder once. Only its keys meet ``old``: when they
    are few, Spark broadcasts them and ``old`` is not shuffled.
    """
    return _put(old, settled(new))


def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
    """Like `upserted`, but chunks a document no longer has are dropped too."""
    return _replace(old, settled(new))


def is_blank(namespace: Column) -> Column:
    return F.coalesce(strip(namespace), F.lit("")) == ""


def named(spark: SparkSession, namespace: str | None) -> str:
    """A namespace as it is stored, by the same rule as for columns."""
    given = F.lit(namespace).cast("string")
    found = spark.range(1).select(strip(given).alias("name"), is_blank(given).alias("blank")).first()
    if found.blank:
        raise NamespaceError(WORDING["empty_namespace"])
    return found.name


def without_namespace(chunks: DataFrame, namespace: str) -> DataFrame:
    """Everything but the records of one namespace; records without one stay."""
    return chunks.filter(~F.col("namespace").eqNullSafe(named(chunks.sparkSession, namespace)))


def upsert_summary(chunks: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Per namespace: records, batches they make, and the size of the last one. Counting needs no order."""
    size = batch_size if batch_size > 0 else BATCH_SIZE
    counts = chunks.groupBy("namespace").agg(F.count("*").alias("upserted_count"))
    batches = F.ceil(F.col("upserted_count") / F.lit(size))
    return counts.withColumn("batches", batches).withColumn(
        "last_batch", F.col("upserted_count") - (F.col("batches") - 1) * F.lit(size)
    )


# --- changes of the stored table -------------------------------------------------------------------------------


def create_chunk_table(spark: SparkSession, table: str, location: str | None = None, bucket_rows: int = BUCKET_ROWS) -> None:
    """Create the table unless it exists; running it again changes nothing."""
    columns = ", ".join(f"`{f.name}` STRING" for f in CHUNKS.fields if f.name != "namespace")
    at = f"LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, namespace STRING, bucket INT) USING parquet "
        f"PARTITIONED BY (namespace, bucket) {at} "
        f"TBLPROPERTIES ('text_field'='{TEXT_FIELD}', 'metric'='{METRIC}', 'bucket_rows'='{bucket_rows}')"
    )


def table_properties(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key").isin("text_field", "metric", "bucket_rows"))


def bucket_counts(spark: SparkSession, table: str) -> DataFrame:
    """``(namespace, buckets)`` of the namespaces that have several."""
    listed = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key").startswith(BUCKETS))
    return listed.select(F.substring("key", F.lit(len(BUCKETS) + 1), F.length("key")).alias("namespace"), F.col("value").cast("bigint").alias("buckets"))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bucket(buckets: Column) -> Column:
    return (buckets + F.pmod(F.xxhash64("document_id"), buckets)).cast("int")


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _current(spark: SparkSession, table: str) -> DataFrame:
    """The rows in partitions of each namespace's present number of buckets."""
    spark.catalog.refreshTable(table)
    stored, counts = spark.table(table), bucket_counts(spark, table)
    n = F.coalesce("buckets", F.lit(1).cast("bigint"))
    return stored.join(counts, "namespace", "left").where((F.col("bucket") >= n) & (F.col("bucket") < 2 * n)).select(stored.columns)


def _sized(spark: SparkSession, table: str, change: DataFrame) -> DataFrame:
    """``(namespace, had, buckets)`` of the namespaces in ``change``: how many buckets they had and how many they get. Stored."""
    limit = int(spark.sql(f"SHOW TBLPROPERTIES {table} ('bucket_rows')").first()["value"])
    new = change.groupBy("namespace").agg(F.count("*").alias("new"))
    old = only_touched(_current(spark, table), change, ["namespace"]).groupBy("namespace").agg(F.count("*").alias("old"))
    rows = F.col("new") + F.coalesce("old", F.lit(0).cast("bigint"))
    wanted = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(rows / F.lit(limit), F.lit(1.0))))).cast("bigint")
    had = F.coalesce("buckets", F.lit(1).cast("bigint"))
    joined = new.join(old, "namespace", "left").join(bucket_counts(spark, table), "namespace", "left")
    return pinned(joined.select("namespace", had.alias("had"), F.greatest(had, wanted).alias("buckets")))


def _drop_partitions(spark: SparkSession, table: str, namespace: str, keep: range) -> int:
    """Drop a namespace's partitions but those with a number in ``keep``. Returns how many there were."""
    listed = spark.sql(f"SHOW PARTITIONS {table} PARTITION (namespace={_literal(namespace)})").collect()
    numbers = [n for r in listed if (n := int(r.partition.rsplit("bucket=", 1)[1])) not in keep]
    if numbers:
        parts = ", ".join(f"PARTITION (namespace={_literal(namespace)}, bucket={n})" for n in numbers)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
    return len(numbers)


def _apply(spark: SparkSession, table: str, chunks: DataFrame, key: list[str]) -> DataFrame | None:
    """Put ``chunks`` in place of the rows with the same ``key``. The table's rows move only to be dealt to their buckets, and, where
    many of them are replaced, to meet the keys that are."""
    settled_change = settled(chunks.select(*CHUNKS.names))
    if settled_change.isEmpty():
        return None
    if not settled_change.filter(is_blank(F.col("namespace"))).isEmpty():
        raise NamespaceError(WORDING["empty_namespace"])
    sizes = _sized(spark, table, settled_change)
    change = settled_change.join(sizes, "namespace").withColumn("bucket", _bucket(F.col("buckets")))
    columns = [*settled_change.columns, "bucket"]
    # few: a namespace doubles its buckets once in as many rows as it has
    grown = sizes.where("buckets > had").collect()
    for r in grown:
        _drop_partitions(spark, table, r.namespace, range(r.had, 2 * r.had))
    current = _current(spark, table).select(columns)
    stored = only_touched(current, change.where("buckets = had"), PARTITION)
    if grown:
        moved = only_touched(current, sizes.where("buckets > had"), ["namespace"]).join(sizes, "namespace")
        stored = stored.unionByName(moved.withColumn("bucket", _bucket(F.col("buckets"))).select(columns))
    # a namespace that grows is rewritten whole, also what no row of the change falls in
    named = {*change.select(*PARTITION).distinct().collect(), *(Row(namespace=r.namespace, bucket=n) for r in grown for n in range(r.buckets, 2 * r.buckets))}
    named = sorted(named)
    with _dynamic_overwrite(spark):
        for i in range(0, len(named), AT_ONCE):
            some = one_of(named[i : i + AT_ONCE], PARTITION)
            old, new = stored.where(some), change.select(columns).where(some)
            gone = pinned(old.select(*key).join(new.select(*key), key, "left_semi").distinct())
            merged = old.join(gone, key, "left_anti").select(columns).unionByName(new)
            # what is overwritten stays until all of the new files are there
            merged.select(spark.table(table).columns).hint("rebalance", *PARTITION).write.insertInto(table, overwrite=True)
    for r in grown:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_literal(BUCKETS + r.namespace)}='{r.buckets}')")
        _drop_partitions(spark, table, r.namespace, range(r.buckets, 2 * r.buckets))
    spark.catalog.refreshTable(table)
    return upsert_summary(settled_change)


def upsert_chunks(spark: SparkSession, table: str, chunks: DataFrame) -> DataFrame | None:
    """Upsert by ``(namespace, _id)``; an empty payload changes nothing and gives None."""
    return _apply(spark, table, chunks, KEY)


def replace_documents(spark: SparkSession, table: str, chunks: DataFrame) -> DataFrame | None:
    """Upsert, and drop the chunks the given documents had before and have no more."""
    return _apply(spark, table, chunks, DOCUMENT)


def delete_namespace(spark: SparkSession, table: str, namespace: str) -> int:
    """Drop the partitions of one namespace, a change of metadata and files only. Returns how many there were."""
    name = named(spark, namespace)
    dropped = _drop_partitions(spark, table, name, range(0))
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({_literal(BUCKETS + name)})")
    return dropped


def read_chunks(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is now, also after a stream or another session has written to it."""
    return _current(spark, table).select("namespace", *RECORD_COLUMNS)
