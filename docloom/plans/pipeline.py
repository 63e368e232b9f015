"""The whole run: sources and stored files in, chunk table out."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import urls
from docloom.operators.chunking import NO_BODY, Chunked, chunk_documents, dispatch, to_records
from docloom.operators.landing import land_pages, landed_bodies, missing_bodies, run_status
from docloom.operators.longdocs import split_pages
from docloom.operators.markdown_pages import split_markdown_pages
from docloom.operators.validation import require_valid
from docloom.sinks.chunk_table import upsert_chunks
from docloom.session import pinned
from docloom.operators.large_files import read_large
from docloom.sources.files import LARGEST, decode_strict, read_bodies, too_large


@dataclass(frozen=True)
class Prepared:
    """Sources joined to their bodies; ``landed`` is what had to be landed for it."""

    sources: DataFrame
    bodies: DataFrame
    landed: DataFrame

    def status(self) -> DataFrame:
        return run_status(self.landed)


def prepare(sources: DataFrame, stored: DataFrame, pages: DataFrame, base_dir: str = "/", strict: bool = True) -> Prepared:
    """Land what is missing, then validate with files required.

    ``stored(path, content)`` are the bodies there are, ``pages`` the fetched responses for the others. What was landed is
    written to the shared folder once, since validation, splitting and the status all read it. A path has one body:
    the stored one, else that of the first source that lands there.
    """
    absent = missing_bodies(sources, stored, base_dir).select(sources.columns)
    landed = pinned(land_pages(pages, absent, base_dir))
    added = landed_bodies(landed).join(stored.select("path"), "path", "left_anti")
    available = stored.select("path", "content").unionByName(added)
    if strict:
        require_valid(sources, base_dir, available)
    resolved = sources.withColumn("path", urls.resolve(F.col("document_path"), base_dir))
    bodies = resolved.select("document_id", "path").join(available, "path")
    return Prepared(sources, bodies.select("document_id", decode_strict(F.col("content")).alias("body")), landed)


def ingest(
    spark: SparkSession,
    table: str,
    prepared: Prepared,
    run_date: str | None = None,
    strict: bool = True,
    page_texts: DataFrame | None = None,
) -> tuple[Chunked, DataFrame | None]:
    """Chunk and upsert; returns the chunks (with their quarantine) and the summary per namespace.

    ``page_texts(document_id, page_no, page_text)`` are the extracted pages of the PDF sources; a PDF source without
    pages is reported as missing, like any other without a body.
    """
    chunked = chunk_all(prepared, run_date, page_texts).stored()
    if strict:
        chunked.strict()
    return chunked, upsert_chunks(spark, table, chunked.chunks)


def chunk_all(prepared: Prepared, run_date: str | None = None, page_texts: DataFrame | None = None) -> Chunked:
    """Bodies and page texts of all sources in chunks."""
    if page_texts is None:
        return chunk_documents(prepared.bodies, prepared.sources, run_date)
    is_pdf = dispatch(F.col("input_format")) == "pdf"
    chunked = chunk_documents(prepared.bodies, prepared.sources.filter(~is_pdf), run_date)
    pdfs = prepared.sources.filter(is_pdf)
    without = pdfs.join(page_texts.select("document_id").distinct(), "document_id", "left_anti")
    missing = chunked.missing.unionByName(without.select(chunked.missing.columns))
    return replace(chunked, missing=missing, pages=chunk_pages(page_texts, pdfs, chunked.run_date))


def chunk_files(
    spark: SparkSession, folder: str, sources: DataFrame, run_date: str | None = None, base_dir: str = "/", largest: int = LARGEST
) -> Chunked:
    """Chunk the stored files of all sources, however large they are.

    Files of more than ``largest`` bytes are read by byte ranges and split from parts, as text or as markdown; a JSON or YAML body must be
    read as a whole, so one of that size goes to quarantine with its size.
    """
    resolved = sources.withColumn("path", urls.resolve(F.col("document_path"), base_dir)).withColumn("kind", dispatch(F.col("input_format")))
    beyond = resolved.join(too_large(spark, folder, largest), "path")
    whole = sources.join(beyond.select("document_id"), "document_id", "left_anti")
    bodies = resolved.select("document_id", "path").join(read_bodies(spark, folder, largest), "path")
    chunked = chunk_documents(bodies, whole, run_date)

    large = read_large(spark, folder, largest)
    own = beyond.select(F.col("path").alias("file"), F.col("document_id").alias("own_id"), "kind")

    def pieces_of(kinds: list[str], split) -> DataFrame:
        files = own.where(F.col("kind").isin(kinds)).select(F.col("file").alias("document_id"))
        some = replace(large, parts=large.parts.join(files.distinct(), "document_id", "left_semi"))
        found = split(some).withColumnRenamed("document_id", "file").join(own, "file").withColumnRenamed("own_id", "document_id")
        return found if "section_id" in found.columns else found.withColumn("section_id", F.lit(None).cast("string"))

    texts = pieces_of(["text", "pdf"], lambda f: f.pieces())
    columns = ["document_id", "section_id", "i", "content"]
    pieces = texts.select(columns).unionByName(pieces_of(["markdown"], lambda f: f.markdown_pieces()).select(columns))
    unread = large.errors.withColumnRenamed("document_id", "path").join(beyond.drop("error"), "path").where(~F.col("kind").isin("json", "yaml"))
    lost = beyond.where(F.col("kind").isin("json", "yaml")).select("document_id", "input_format", "error")
    lost = lost.unionByName(unread.select("document_id", "input_format", "error"))
    return replace(chunked, pages=_records_of(pieces, sources, chunked.run_date), lost=lost)


def report(sources: DataFrame, chunked: Chunked) -> DataFrame:
    """``(document_id, outcome, n_chunks, error)`` of every source: chunked, quarantined, missing or blank."""
    counts = chunked.chunks.groupBy("document_id").agg(F.count("*").alias("n_chunks"))
    joined = sources.select("document_id").join(counts, "document_id", "left").join(
        chunked.quarantine.select("document_id", "error"), "document_id", "left"
    )
    outcome = (
        F.when(F.col("error") == NO_BODY, F.lit("missing"))
        .when(F.col("error").isNotNull(), F.lit("quarantined"))
        .when(F.col("n_chunks") > 0, F.lit("chunked"))
        .otherwise(F.lit("blank"))
    )
    n = F.coalesce("n_chunks", F.lit(0)).cast("bigint").alias("n_chunks")
    return joined.select("document_id", outcome.alias("outcome"), n, "error")


def _records_of(pieces: DataFrame, sources: DataFrame, run_date: str | None) -> DataFrame:
    described = sources.select("document_id", "document_url", "namespace")
    return to_records(pieces.join(described, "document_id"), run_date)


def chunk_pages(pages: DataFrame, sources: DataFrame, run_date: str | None = None, **limits) -> DataFrame:
    """Chunk records of documents given as page texts (extracted PDFs), of any size."""
    pieces = split_pages(pages, **limits).withColumn("section_id", F.lit(None).cast("string"))
    return _records_of(pieces, sources, run_date)


def chunk_markdown_pages(pages: DataFrame, sources: DataFrame, run_date: str | None = None, **limits) -> DataFrame:
    """Chunk records of markdown documents given as many rows, of any size."""
    return _records_of(split_markdown_pages(pages, **limits), sources, run_date)
