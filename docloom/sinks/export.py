"""Export of chunk records as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.numbering import before, running
from docloom.schemas import RECORD_COLUMNS
from docloom.session import pinned
from docloom.sources.files import list_files


def record_json(chunks: DataFrame) -> Column:
    """One record as compact JSON; a null section id is left out, an empty one stays."""
    return F.to_json(F.struct(*[F.col(c) for c in RECORD_COLUMNS]))


def export_records(chunks: DataFrame, path: str) -> None:
    """JSON lines, a folder per namespace. Large namespaces are spread over several files."""
    spread = chunks.hint("rebalance", "namespace")
    spread.select("namespace", *RECORD_COLUMNS).write.mode("overwrite").partitionBy("namespace").json(path)


def exported_bytes(chunks: DataFrame) -> DataFrame:
    """Records and their UTF-8 bytes per namespace, line ends not counted."""
    return chunks.groupBy("namespace").agg(
        F.count("*").alias("records"), F.sum(F.octet_length(record_json(chunks))).alias("bytes")
    )


def _text(value: Column) -> Column:
    """A string as JSON text."""
    quoted = F.to_json(F.array(value))
    return F.substring(quoted, F.lit(2), F.length(quoted) - F.lit(2))


def _indented(columns) -> Column:
    fields = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f'    "{c}": '), _text(F.col(c)))) for c in columns]
    return F.concat(F.lit("  {\n"), F.array_join(F.array_compact(F.array(*fields)), ",\n"), F.lit("\n  }"))


def array_lines(numbered: DataFrame) -> DataFrame:
    """``line`` rows of an indented JSON array of the records, sorted by document and chunk number ``i``.

    The rows in order, a line end after each, are the array: no step holds it whole. The comma stands in
    front of a record, the first record is found by a scalar subquery, and the brackets are rows of their own.
    The records are read more than once (first record, ranges, rows): give a stored table.
    """
    first = numbered.agg(F.min(F.struct("document_id", "i"))).scalar()
    at = [F.col("document_id"), F.col("i").cast("bigint").alias("i")]
    lead = F.when(F.struct("document_id", "i") == first, F.lit("")).otherwise(F.lit(",\n"))
    rows = numbered.select(F.lit(1).alias("_at"), *at, F.concat(lead, _indented(RECORD_COLUMNS)).alias("line"))
    brackets = numbered.sparkSession.createDataFrame(
        [(0, None, None, "["), (2, None, None, "]")], "_at int, document_id string, i bigint, line string"
    )
    return rows.unionByName(brackets).orderBy("_at", "document_id", "i").select("line")


def array_index(numbered: DataFrame) -> DataFrame:
    """``(document_id, i, byte_offset, n_bytes)``: where each record stands in the array that `array_lines` makes.

    Counted from lengths alone. `file_starts` tells which part file holds a byte, so a record can be read without the ones
    before it.
    """
    sized = numbered.select("document_id", F.col("i").cast("bigint").alias("i"), F.octet_length(_indented(RECORD_COLUMNS)).cast("bigint").alias("n_bytes"))
    # behind the opening bracket, and with a comma and two line ends after each record before it
    offsets = running(sized.withColumn("byte_offset", F.col("n_bytes") + 3), [], ["document_id", "i"], ["byte_offset"])
    return offsets.select("document_id", "i", (F.col("byte_offset") + 2).alias("byte_offset"), "n_bytes")


def file_starts(spark, path: str) -> DataFrame:
    """``(path, start, length)`` of the part files of an export, ``start`` being the bytes of the files before it."""
    files = list_files(spark, path).where(F.col("path").rlike("/part-[^/]*$"))
    return files.select("path", F.coalesce(before(F.col("length"), [], ["path"]), F.lit(0).cast("bigint")).alias("start"), "length")


def export_array(numbered: DataFrame, path: str) -> int:
    """Write the array so that its part files, joined in name order, are one JSON document. Returns its bytes."""
    lines = array_lines(pinned(numbered))
    lines.write.mode("overwrite").text(path)
    return numbered.sparkSession.read.text(path).agg(F.sum(F.octet_length("value") + 1)).first()[0]
