"""Documents to chunk records, one pass over the input for all formats.

Every stage is a projection: no rows are moved between tasks, whatever the number and size of the
documents. The two Arrow functions see null for each row that does not need them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.constants import MAX_CHARS, OVERLAP
from docloom.functions import markdown, nested
from docloom.functions.split import PIECES, check_limits, split_each_udf, whole_piece
from docloom.functions.text import once, unix_newlines
from docloom.schemas import RECORD_COLUMNS
from docloom.session import pinned

SECTIONS = "array<struct<section_no:bigint,section_id:string,content:string>>"


def today() -> str:
    """The one UTC date a run gives to all its chunks."""
    return dt.datetime.now(dt.UTC).strftime("%Y-%m-%d")


def dispatch(input_format: Column) -> Column:
    """Splitter a format goes to; unknown and missing formats are treated as markdown."""
    fmt = F.lower(input_format)
    return F.when(fmt.isin("text", "pdf", "json", "yaml"), fmt).otherwise("markdown")


def _with_long_pieces(df: DataFrame, max_chars: int, overlap: int) -> DataFrame:
    """Add ``_long``: per section its pieces when it is too long, else null."""
    too_long = F.transform("_sections", lambda s: F.when(F.length(s["content"]) > max_chars, s["content"]))
    any_long = F.exists("_sections", lambda s: F.length(s["content"]) > max_chars)
    return df.withColumn("_long", split_each_udf(max_chars, overlap)(F.when(any_long, too_long)))


def _short_piece(section: Column) -> Column:
    """Pieces of a section within the limit; markdown content is stripped already."""
    content = section["content"]
    piece = F.struct(
        F.lit(0).cast("bigint").alias("start"),
        F.length(content).cast("bigint").alias("end"),
        content.alias("content"),
    )
    return F.when(section["section_id"].isNull(), whole_piece(content)).otherwise(F.array(piece))


def _flat_pieces() -> Column:
    per_section = F.transform(
        F.col("_sections"),
        lambda s, j: F.transform(
            F.coalesce(F.get(F.col("_long"), j), _short_piece(s)),
            lambda p: F.struct(
                s["section_no"].alias("section_no"),
                s["section_id"].alias("section_id"),
                p["start"].alias("start"),
                p["end"].alias("end"),
                p["content"].alias("content"),
                F.lit(False).alias("oversize"),
            ),
        ),
    )
    return F.flatten(per_section)


def pieces_of_sections(df: DataFrame, max_chars: int = MAX_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """Add ``pieces`` of the array ``_sections``; only sections over the limit cross to Python."""
    return _with_long_pieces(df, max_chars, overlap).withColumn("pieces", _flat_pieces()).drop("_long")


def split_documents(
    documents: DataFrame, body: str = "body", max_chars: int = MAX_CHARS, overlap: int = OVERLAP
) -> DataFrame:
    """Add ``pieces`` and ``error`` to documents that have ``input_format`` and a body column."""
    check_limits(max_chars, overlap)
    fmt = dispatch(F.col("input_format"))
    text = unix_newlines(F.col(body))
    df = documents.withColumn("_fmt", fmt).withColumn("_text", text)
    df = markdown.with_sections(df, F.when(F.col("_fmt") == "markdown", F.col("_text")), "_md")
    is_nested = F.col("_fmt").isin("json", "yaml")
    df = df.withColumn(
        "_nested",
        nested.split_nested_udf(max_chars)(F.when(is_nested, F.col("_text")), F.col("_fmt")),
    )
    plain = F.array(
        F.struct(
            F.lit(0).cast("bigint").alias("section_no"),
            F.lit(None).cast("string").alias("section_id"),
            F.col("_text").alias("content"),
        )
    ).cast(SECTIONS)
    df = once(
        df,
        "_sections",
        F.when(F.col("_text").isNull() | is_nested, F.array().cast(SECTIONS))
        .when(F.col("_fmt") == "markdown", F.col("_md").cast(SECTIONS))
        .otherwise(plain),
    )
    df = _with_long_pieces(df, max_chars, overlap)
    from_nested = F.transform(
        "_nested.pieces",
        lambda p: F.struct(
            F.lit(0).cast("bigint").alias("section_no"),
            F.lit(None).cast("string").alias("section_id"),
            F.lit(None).cast("bigint").alias("start"),
            F.lit(None).cast("bigint").alias("end"),
            p["content"].alias("content"),
            p["oversize"].alias("oversize"),
        ),
    )
    df = df.withColumn("pieces", F.when(is_nested, from_nested).otherwise(_flat_pieces()))
    df = df.withColumn(
        "error",
        F.when(F.col("_text").isNull(), F.lit("body is missing or not valid UTF-8")).otherwise(
            F.col("_nested.error")
        ),
    )
    return df.drop("_fmt", "_text", "_md", "_nested", "_sections", "_long")


def numbered_pieces(split: DataFrame, *columns: str) -> DataFrame:
    """One row per piece: ``columns``, its number ``i`` in the document, and the piece's fields.

    The array is wrapped because Spark derives a "not empty" filter from a bare column, and pushing that
    below the Python functions would run them twice.
    """
    pieces = F.coalesce("pieces", F.array().cast(split.schema["pieces"].dataType))
    return split.select(*columns, F.posexplode(pieces).alias("i", "_p")).select(*columns, "i", "_p.*")


def record_id(document_id: Column, i: Column) -> Column:
    return F.concat(document_id, F.lit(":chunk"), i.cast("string"))


def to_records(pieces: DataFrame, run_date: str | None = None) -> DataFrame:
    """Chunk records (with ``namespace``) of numbered pieces."""
    date = run_date or today()
    dt.date.fromisoformat(date)
    values = {
        "_id": record_id(F.col("document_id"), F.col("i")),
        "document_date": F.lit(date),
        "chunk_content": F.col("content"),
        "chunk_section_id": F.col("section_id"),
    }
    return pieces.select("namespace", *[values.get(c, F.col(c)).alias(c) for c in RECORD_COLUMNS])


#: What quarantine says of a source that has neither a body nor pages.
NO_BODY = "no body"


@dataclass(frozen=True)
class Chunked:
    """Result of `chunk_documents`: both tables come from ``split``, and `stored` splits once for both."""

    split: DataFrame
    run_date: str
    missing: DataFrame | None = None
    #: chunks of documents that came as page texts, or in parts
    pages: DataFrame | None = None
    #: ``(document_id, input_format, error)`` of documents that never came to be split
    lost: DataFrame | None = None

    @property
    def chunks(self) -> DataFrame:
        pieces = numbered_pieces(self.split, "namespace", "document_id", "document_url")
        records = to_records(pieces, self.run_date)
        return records if self.pages is None else records.unionByName(self.pages)

    @property
    def quarantine(self) -> DataFrame:
        failed = self.split.filter(F.col("error").isNotNull()).select("document_id", "input_format", "error")
        if self.lost is not None:
            failed = failed.unionByName(self.lost)
        if self.missing is None:
            return failed
        absent = self.missing.select("document_id", "input_format", F.lit(NO_BODY).alias("error"))
        return failed.unionByName(absent)

    def stored(self) -> Chunked:
        """The same, split once and written to the shared folder; for jobs that use both tables."""
        pages = None if self.pages is None else pinned(self.pages)
        return Chunked(pinned(self.split), self.run_date, self.missing, pages, self.lost)

    def strict(self, named: int = 5) -> Chunked:
        """Raise when any document failed; up to ``named`` of them are named, all are in ``quarantine``."""
        failed = self.quarantine.limit(named).collect()
        if failed:
            raise RuntimeError("; ".join(f"{r.document_id}: {r.error}" for r in failed))
        return self


def chunk_documents(
    bodies: DataFrame,
    sources: DataFrame,
    run_date: str | None = None,
    max_chars: int = MAX_CHARS,
    overlap: int = OVERLAP,
    report_missing: bool = True,
) -> Chunked:
    """Split every source that has a body; the ones without go to quarantine (unless ``report_missing`` is off).

    ``bodies(document_id, body)``; ``sources`` as in `schemas.SOURCES`. Neither side is assumed small: Spark
    broadcasts the registry when its measured size allows, and splits skewed join partitions otherwise. Missing
    bodies are found by an anti join that reads ids only, because an outer join would shuffle the bodies.
    """
    documents = sources.select("document_id", "document_url", "namespace", "input_format").join(
        bodies.select("document_id", "body"), "document_id"
    )
    missing = sources.join(bodies.select("document_id"), "document_id", "left_anti") if report_missing else None
    split = split_documents(documents, "body", max_chars, overlap).drop("body")
    return Chunked(split, run_date or today(), missing)
