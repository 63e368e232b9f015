"""Landing: fetched responses to stored bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.constants import STATUS_FAILED, STATUS_OK
from docloom.functions import html, urls
from docloom.functions.text import strip


def landing_targets(sources: DataFrame, base_dir: str = "/") -> DataFrame:
    """Add ``mode`` and ``target``.

    A text document whose address is not a ``.txt`` file is a web page: it is converted and stored as
    ``docs/<id>.txt``. Everything else is stored as it is, at its configured path.
    """
    fmt = F.lower(strip(F.coalesce("input_format", F.lit(""))))
    url = strip(F.coalesce("document_url", F.lit("")))
    convert = (fmt == "text") & ~urls.is_txt(url)
    page = F.concat(F.lit("docs/"), "document_id", F.lit(".txt"))
    return sources.withColumn("mode", F.when(convert, F.lit("convert")).otherwise(F.lit("raw"))).withColumn(
        "target", urls.resolve(F.when(convert, page).otherwise(F.col("document_path")), base_dir)
    )


def land_pages(pages: DataFrame, sources: DataFrame, base_dir: str = "/") -> DataFrame:
    """``(document_id, pos, target, mode, content, error)`` of every source.

    ``pages(url, content, headers)`` are fetched responses, one per address. A source without one, or whose address is not
    http(s), or whose charset is unknown, has an error and no content; the others are not affected.
    """
    targets = landing_targets(sources, base_dir).withColumn("url", strip(F.col("document_url")))
    fetched = pages.select(
        "url", F.col("content").alias("_raw"), html.charset(html.lower_keys(F.col("headers"))["content-type"]).alias("_charset")
    )
    joined = targets.join(fetched, "url", "left")
    convert = F.col("mode") == "convert"
    decoded = joined.withColumn("_page", html.decode_body(F.when(convert, F.col("_raw")), F.col("_charset")))
    shown = html.with_text(decoded, F.col("_page"), "_text")
    content = F.when(convert, F.encode("_text", "utf-8")).otherwise(F.col("_raw"))
    error = (
        F.when(~F.coalesce(urls.scheme(F.col("url")).isin("http", "https"), F.lit(False)), F.lit("URL must start with http(s)"))
        .when(F.col("_raw").isNull(), F.lit("download failed"))
        .when(convert & F.col("_page").isNull(), F.lit("unknown charset"))
    )
    return shown.withColumn("error", error).select(
        "document_id", "pos", "target", "mode", F.when(F.col("error").isNull(), content).alias("content"), "error"
    )


def landed_bodies(landed: DataFrame) -> DataFrame:
    """``(path, content)`` of what was landed, one body per path: that of the source with the lowest position.

    A later source with the same target finds the file there.
    """
    first = F.min_by("content", F.struct("pos", "document_id")).alias("content")
    return landed.filter(F.col("error").isNull()).groupBy(F.col("target").alias("path")).agg(first)


def write_landed(landed: DataFrame, path: str) -> None:
    """Store bodies; the ones stored before at the same target are overwritten, others stay."""
    from docloom.sinks.bodies import overwrite_bodies

    overwrite_bodies(landed_bodies(landed), path)


def run_status(landed: DataFrame) -> DataFrame:
    """One row: documents, failures and the exit code; one failure does not stop the others but shows here."""
    failed = F.col("error").isNotNull()
    return landed.agg(
        F.count("*").alias("documents"),
        F.count_if(failed).alias("failed"),
        F.max(F.when(failed, F.lit(STATUS_FAILED)).otherwise(F.lit(STATUS_OK))).alias("status"),
    )


def missing_bodies(sources: DataFrame, files: DataFrame, base_dir: str = "/") -> DataFrame:
    """Sources whose file is not there."""
    resolved = sources.withColumn("path", urls.resolve(F.col("document_path"), base_dir))
    return resolved.join(files.select("path"), "path", "left_anti")


def misplaced(sources: DataFrame, base_dir: str = "/") -> DataFrame:
    """Web pages whose configured path is not where they land, a warning worth giving before a run."""
    targets = landing_targets(sources, base_dir)
    return targets.filter(F.col("target") != urls.resolve(F.col("document_path"), base_dir)).select(
        "document_id", F.lit("landing_path_differs").alias("rule"), "target"
    )
