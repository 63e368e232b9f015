"""Listing of configured documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import urls
from docloom.functions.text import pad

COLUMNS = ("Document", "Format", "Namespace", "Path", "URL")
EMPTY = "No documents configured."


def listing(sources: DataFrame, base_dir: str = "/") -> DataFrame:
    """Document, Format, Namespace, Path (relative when under ``base_dir``) and URL, by document id."""
    shown = urls.relative_to(urls.resolve(F.col("document_path"), base_dir), base_dir)
    return sources.select(
        F.col("document_id").alias("Document"),
        F.col("input_format").alias("Format"),
        F.col("namespace").alias("Namespace"),
        shown.alias("Path"),
        F.col("document_url").alias("URL"),
    ).orderBy("Document")


def widths(table: DataFrame) -> DataFrame:
    """One row with the widest value of every column, headers included."""
    widest = [F.greatest(F.max(F.length(c)), F.lit(len(c))) for c in table.columns]
    return table.agg(*[F.coalesce(w, F.lit(len(c))).alias(c) for w, c in zip(widest, table.columns)])


def padded(table: DataFrame) -> DataFrame:
    """``line``: a header and the values by document, padded to their column and joined; or a message when there are none.

    The widths and the number of rows come from one aggregate, as a scalar subquery.
    """
    widest = [F.greatest(F.max(F.length(c)), F.lit(len(c))).alias(c) for c in table.columns]
    found = table.agg(F.struct(F.count("*").alias("n"), *widest).alias("w")).scalar()

    def line(values) -> Column:
        return F.concat_ws(" | ", *[pad(v, found[c]) for v, c in zip(values, table.columns)]).alias("line")

    none = F.lit(None).cast("string")
    rows = table.select(F.lit(1).alias("part"), F.col("Document").alias("id"), line(F.coalesce(c, F.lit("")) for c in table.columns))
    first = table.sparkSession.range(1)
    header = first.filter(found["n"] > 0).select(F.lit(0), none, line(map(F.lit, table.columns)))
    message = first.filter(found["n"] == 0).select(F.lit(0), none, F.lit(EMPTY))
    return rows.union(header).union(message).orderBy("part", "id").select("line")


def tabbed(sources: DataFrame) -> DataFrame:
    """``line``: id, format and address apart by tabs, in registry order."""
    return sources.orderBy("pos").select(F.concat_ws("\t", "document_id", "input_format", "document_url").alias("line"))
