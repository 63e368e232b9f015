"""The registry of sources: load, coerce, select, change, save.

A registry is a table with one row per document id (`schemas.SOURCES`); ``pos`` keeps the order of entries.
A null column stands for a key the entry does not have.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.constants import REGISTRY_KEYS, WORDING
from docloom.functions.text import quoted, strip, worded
from docloom.schemas import SOURCES

try:
    import yaml
except ImportError:
    yaml = None

VALUES = tuple(REGISTRY_KEYS.values())

# An entry as found: a null key is not a string, a null map is not a mapping, a null value is not a string.
ENTRY = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("entry", T.MapType(T.StringType(), T.StringType())),
    ]
)
FILE = T.StructType(
    [T.StructField("entries", T.ArrayType(ENTRY)), T.StructField("error", T.StringType())]
)
ENTRIES = "pos bigint, key string, entry map<string,string>"


class InvalidSources(Exception):
    """The registry does not pass its checks. The first issues are named, ``issues`` holds all of them."""

    SHOWN = 20

    def __init__(self, issues: DataFrame):
        self.issues = issues
        ordered = issues.orderBy("pos", "seq") if "seq" in issues.columns else issues
        found = [r.message for r in ordered.select("message").limit(self.SHOWN + 1).collect()]
        lines = [f"- {m}" for m in found[: self.SHOWN]]
        if len(found) > self.SHOWN:
            lines.append("- (more in the issues table)")
        super().__init__("invalid registry:\n" + "\n".join(lines))


@F.arrow_udf(FILE)
def _parse_file(files: pa.Array) -> pa.Array:
    """Entries of a registry file, without judging them."""

    def text(value):
        return value if isinstance(value, str) else None

    def parse(raw):
        try:
            tree = yaml.safe_load(raw)
        except yaml.YAMLError as exc:
            return {"entries": [], "error": f"configuration file cannot be parsed: {exc}"}
        if tree is None:
            return {"entries": [], "error": None}
        if not isinstance(tree, dict):
            return {"entries": [], "error": WORDING["not_a_registry"]}
        entries = [
            {
                "key": text(key),
                "entry": [(str(k), text(v)) for k, v in value.items()] if isinstance(value, dict) else None,
            }
            for key, value in tree.items()
        ]
        return {"entries": entries, "error": None}

    entry = pa.struct([("key", pa.string()), ("entry", pa.map_(pa.string(), pa.string()))])
    kind = pa.struct([("entries", pa.list_(entry)), ("error", pa.string())])
    return pa.array([parse(raw) for raw in files.to_pylist()], kind)


def read_entries(spark: SparkSession, path: str, fmt: str = "yaml") -> DataFrame:
    """Raw entries of a registry file (``yaml``), or of a dataset with the columns of `ENTRIES` (any reader)."""
    if fmt != "yaml":
        return spark.read.schema(ENTRIES).format(fmt).load(path)
    if yaml is None:
        raise RuntimeError("reading a YAML registry needs a YAML parser")
    parsed = spark.read.text(path, wholetext=True).select(_parse_file("value").alias("f"))
    failed = parsed.filter("f.error is not null").select("f.error").limit(1).collect()
    if failed:
        raise ValueError(failed[0].error)
    return parsed.select(F.posexplode("f.entries").alias("pos", "e")).select(
        F.col("pos").cast("bigint").alias("pos"), "e.key", "e.entry"
    )


def coerce_entries(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(sources, issues)`` of raw entries; keys the schema does not know are dropped."""
    bad_key = F.col("key").isNull() | (strip(F.col("key")) == "")

    def issue(when: Column, rule: str, *values: Column) -> Column:
        message = worded(WORDING[rule], *values)
        if rule != "invalid_id":
            message = F.concat(F.col("key"), F.lit(": "), message)
        return F.when(when, F.struct(F.lit(rule).alias("rule"), message.alias("message")))

    found = [
        issue(bad_key, "invalid_id", quoted(F.coalesce("key", F.lit("")))),
        issue(~bad_key & F.col("entry").isNull(), "not_a_mapping"),
    ]
    for key in REGISTRY_KEYS:
        has = F.map_contains_key("entry", key)
        found.append(issue(~bad_key & ~has, "missing_key", F.lit(key)))
        found.append(issue(~bad_key & has & F.col("entry")[key].isNull(), "not_a_string", F.lit(key)))
    kept = F.filter(F.array(*found), lambda i: i.isNotNull())
    checked = entries.withColumn("_issues", kept)
    issues = checked.select("pos", F.col("key").alias("document_id"), F.posexplode("_issues").alias("seq", "_i")).select(
        "pos", "document_id", "seq", "_i.rule", "_i.message"
    )
    good = checked.filter(F.size("_issues") == 0)
    values = [F.col("entry")[key].alias(column) for key, column in REGISTRY_KEYS.items()]
    sources = good.select("pos", F.col("key").alias("document_id"), *values).select(SOURCES.names)
    return sources, issues


def first_failure(issues: DataFrame) -> DataFrame:
    """Issues of the first entry that has any, where a strict load stops."""
    first = issues.agg(F.min("pos").alias("pos"))
    return issues.join(F.broadcast(first), "pos")  # one row


def load_sources(spark: SparkSession, path: str, fmt: str = "yaml", strict: bool = True) -> DataFrame:
    """Sources of a registry; in strict mode the first entry that cannot be coerced raises."""
    sources, issues = coerce_entries(read_entries(spark, path, fmt))
    if strict and not issues.isEmpty():
        raise InvalidSources(first_failure(issues))
    return sources


def save_sources(sources: DataFrame, path: str, issues: DataFrame | None = None) -> None:
    """Write the whole registry, in order, once ``issues`` (from `validate_sources`) is known to be empty.

    It is written as a new version beside the others and found by its number, so that a write which fails half way leaves
    the registry as it was. Older versions stay.
    """
    if issues is not None and not issues.isEmpty():
        raise InvalidSources(issues)
    spark = sources.sparkSession
    number = max(versions(spark, path), default=-1) + 1
    sources.select(SOURCES.names).sort("pos").write.parquet(f"{path}/version={number}")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that were written completely."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(folder)
    return sorted(int(f.getPath().getParent().getName().removeprefix("version=")) for f in found or ())


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """The last version of a saved registry."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no registry at {path}")
    return spark.read.schema(SOURCES).parquet(f"{path}/version={found[-1]}")


def edit_sources(
    spark: SparkSession, path: str, validate, changes: DataFrame | None = None, removals: DataFrame | None = None, strict: bool = True
) -> DataFrame:
    """Load a saved registry, put ``changes`` in, take ``removals(document_id)`` out, check the whole, and save it.

    ``validate`` gives the issues of a registry (`validate_sources` with its folder and files). Nothing is saved if there
    are any, or if ``strict`` and an id to remove is unknown. Returns the registry as saved.
    """
    sources = read_sources(spark, path)
    if changes is not None:
        sources = upsert_sources(sources, changes)
    if removals is not None:
        sources = remove_sources(sources, removals, strict)
    save_sources(sources, path, validate(sources))
    return read_sources(spark, path)


def select_sources(sources: DataFrame, all_docs: bool = False, single_id: str | None = None) -> DataFrame:
    """All sources or one; ``all_docs`` wins when both are given."""
    if all_docs:
        return sources
    if not single_id:
        raise ValueError(WORDING["no_selection"])
    return find_source(sources, single_id)


def find_source(sources: DataFrame, document_id: str) -> DataFrame:
    found = sources.filter(F.col("document_id") == document_id)
    if found.isEmpty():
        raise KeyError(WORDING["unknown_id"].format(repr(document_id)))
    return found


def look_up(sources: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(known, unknown)`` of requested ``ids(document_id)``."""
    return (
        ids.select("document_id").join(sources, "document_id"),
        ids.select("document_id").join(sources, "document_id", "left_anti"),
    )


def upsert_sources(sources: DataFrame, changes: DataFrame) -> DataFrame:
    """Add or replace entries by id. A replaced entry keeps its position, new ones follow in their own order."""
    if not changes.filter(F.coalesce("document_id", F.lit("")) == "").isEmpty():
        raise ValueError(WORDING["empty_document_id"])
    last = sources.agg(F.coalesce(F.max("pos"), F.lit(-1)).alias("last")).scalar()
    incoming = changes.groupBy("document_id").agg(F.max_by(F.struct("pos", *VALUES), "pos").alias("_new"))
    placed = incoming.join(sources.select("document_id", F.col("pos").alias("_old")), "document_id", "left").select(
        F.coalesce("_old", last + F.lit(1) + F.col("_new.pos")).alias("pos"),
        "document_id",
        *[F.col(f"_new.{v}").alias(v) for v in VALUES],
    )
    kept = sources.join(changes, "document_id", "left_anti").select(SOURCES.names)
    return kept.unionByName(placed.select(SOURCES.names))


def remove_sources(sources: DataFrame, ids: DataFrame, strict: bool = True) -> DataFrame:
    """Registry without ``ids(document_id)``; an unknown id is an error in strict mode."""
    if strict:
        unknown = look_up(sources, ids)[1].limit(1).collect()
        if unknown:
            raise KeyError(WORDING["unknown_id"].format(repr(unknown[0].document_id)))
    return sources.join(ids.select("document_id"), "document_id", "left_anti").select(SOURCES.names)
