"""Files that are too large for a value of a row, read by byte ranges.

Spark's text reader deals the ranges of a file over tasks and gives lines. A part of the document begins at the first line of
every `PART_BYTES` bytes or so that is empty and follows one that isn't, so parts are joined by a blank line as pages are, and
the part chains of `longdocs` and `markdown_pages` split them: the pieces are those of the whole text. Line ends of any
kind are told apart only inside a part. Characters are whole, because ranges end at line ends.

The task that reads a range puts its lines together to parts and stores them; only the first and the last lines of a range move, where its
file has others.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.constants import MAX_CHARS, OVERLAP
from docloom.functions.text import unix_newlines
from docloom.operators.longdocs import JOINER, PART, numbered_parts, split_parts
from docloom.operators.markdown_pages import split_markdown_parts
from docloom.operators.numbering import before
from docloom.session import pinned
from docloom.sources.files import LARGEST, list_files, plain_path

PART_BYTES = 4 << 20
#: A paragraph of more bytes can't be held in a row; its file is an error.
LONGEST = 1 << 29
#: Spark's reader leaves it out at the beginning of a file.
BYTE_ORDER_MARK = "\ufeff"
NOT_UTF8 = "body is missing or not valid UTF-8"


@dataclass(frozen=True)
class LargeFiles:
    """``parts(document_id, section_no, part_no, body)`` with their ``index``, and ``errors(document_id, error)``; a document's id is its path."""

    parts: DataFrame
    index: DataFrame
    errors: DataFrame

    def pieces(self, max_chars: int = MAX_CHARS, overlap: int = OVERLAP) -> DataFrame:
        """``(document_id, i, start, end, content)`` of plain text."""
        found = split_parts(self.parts, self.index, max_chars, overlap)
        return found.select("document_id", "i", "start", "end", "content")

    def markdown_pieces(self, max_chars: int = MAX_CHARS, overlap: int = OVERLAP) -> DataFrame:
        return split_markdown_parts(self.parts, self.index, max_chars, overlap)


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with the range they were read in, in the order they were read; a line that alone is too long has no text."""
    read = spark.read.option("lineSep", "\n").text(paths)
    name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    block, size, raw = F.col("_metadata.file_block_start"), F.col("_metadata.file_size"), F.col("value")
    blank = raw.isin("", "\r")
    n = (F.octet_length(raw) + 1).cast("bigint")
    return read.select(
        plain_path(name).alias("path"),
        block.alias("block"),
        size.alias("size"),
        ((block > 0) | (block + F.col("_metadata.file_block_length") < size)).alias("several"),
        n.alias("n"),
        F.is_valid_utf8(raw).alias("valid"),
        blank.alias("blank"),
        # a run of line ends begins behind the line before, so that the blank line parts paragraphs wherever it is read from
        (~blank & ~raw.endswith("\r\r")).alias("ends"),
        F.when(n <= LONGEST, raw.cast("binary")).alias("raw"),
    )


#: The lines of a part in one range. Those before the first border have ``seq`` 0 and belong to the part before; ``tail`` has the range's last
#: line. ``text`` is null without lines, and where the file is an error; ``total`` are the bytes of a file that is a single range, on its first and last run.
RUN = "path string, block long, size long, several boolean, seq long, tail boolean, bytes long, valid boolean, total long, text binary"
KINDS = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}


def _runs(lines: DataFrame, part_bytes: int) -> DataFrame:
    """`RUN` rows of the lines of each range, made by the task that reads them: no line moves, and a task holds one run, or two."""
    schema = pa.schema([(name, KINDS[kind]) for name, kind in map(str.split, RUN.split(", "))])
    longest = LONGEST

    def packed(runs):
        rows = [r | {"text": b"\n".join(r["text"]) if r["text"] else None} for r in runs]
        return pa.RecordBatch.from_pylist(rows, schema)

    def ended(run, held, at):
        """What is left of a range at its end."""
        total = None if run["several"] else at
        return [r | {"total": total} for r in (*held, run | {"tail": True})]

    def read(batches):
        run, held, at, slot, border = None, [], 0, -1, False
        for batch in batches:
            done, since, raw = [], 0, batch.column("raw")

            def take(upto):
                """The open run gets the lines that come before ``upto``."""
                if not run["valid"] or run["bytes"] > longest:
                    run["text"] = []
                elif upto > since:
                    run["text"].append(b"\n".join(raw.slice(since, upto - since).to_pylist()))

            columns = [batch.column(c).to_pylist() for c in ("path", "block", "size", "several", "n", "valid", "blank", "ends")]
            for i, (path, block, size, several, n, valid, blank, ends) in enumerate(zip(*columns)):
                other = run is None or block != run["block"] or path != run["path"]
                # a line that begins where a range does is read with the range before
                place = at + (block > 0)
                if other or (blank and border and place // part_bytes != slot):
                    if run is not None:
                        take(i)
                    if other:
                        done += ended(run, held, at) if run is not None else []
                        held, at, slot, seq = [], 0, -1, 0
                    else:
                        # the first run of a file that is one range waits for the file's bytes
                        (done if several or run["seq"] else held).append(run)
                        slot, seq = place // part_bytes, run["seq"] + 1
                    # the blank line a part begins with belongs to what joins it to the one before
                    since = i if other else i + 1
                    run = dict(path=path, block=block, size=size, several=several, seq=seq, tail=False, bytes=0, valid=True, total=None, text=[])
                run["bytes"] += n
                run["valid"] &= valid
                at, border = at + n, ends
            if run is not None:
                take(batch.num_rows)
            if done:
                yield packed(done)
        if run is not None:
            yield packed(ended(run, held, at))

    return lines.mapInArrow(read, RUN)


def read_large(spark: SparkSession, path: str, larger_than: int = LARGEST, part_bytes: int = PART_BYTES) -> LargeFiles:
    """All files under ``path`` of more than ``larger_than`` bytes, as parts that are stored.

    The driver lists these files, which are as many as the data has multiples of ``larger_than`` at most. A file that isn't valid UTF-8, or
    that has a paragraph of more than `LONGEST` bytes, has an error and no part.
    """
    found = list_files(spark, path).where(F.col("length") > larger_than).select("path").collect()
    if not found:
        none = spark.createDataFrame([], "document_id string, section_no long, part_no long, body string")
        return LargeFiles(none, numbered_parts(none.select(*PART, F.lit(0).cast("bigint").alias("size"))), spark.createDataFrame([], "document_id string, error string"))
    runs = pinned(_runs(_lines(spark, [r.path for r in found]), part_bytes))
    # all but the texts: what is found out about a file is joined to them only where the file has several ranges or an error
    per_range = runs.groupBy("path", "block").agg(F.max("seq").alias("n"), F.max("several").alias("several"))
    base = F.coalesce(before(F.col("n"), ["path"], ["block"]), F.lit(0).cast("bigint"))
    ranges = pinned(per_range.select("path", "block", "several", base.alias("base")))
    no = F.coalesce("base", F.lit(0).cast("bigint")) + F.col("seq")
    small = runs.join(ranges.where("several").select("path", "block", "base"), ["path", "block"], "left")
    sizes = small.groupBy("path", no.alias("no")).agg(F.sum("bytes").alias("bytes"), F.bool_and("valid").alias("valid"))
    whole = sizes.groupBy("path").agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("longest"), F.bool_and("valid").alias("valid"), F.max("no").alias("last"))
    long = F.concat(F.lit("file has a paragraph of "), F.col("longest").cast("string"), F.lit(" bytes"))
    error = F.when(~F.col("valid"), F.lit(NOT_UTF8)).when(F.col("longest") > LONGEST, long)
    whole = pinned(whole.select("path", "bytes", "last", error.alias("error")))
    errors = whole.where("error IS NOT NULL").select(F.col("path").alias("document_id"), "error")
    known = pinned(ranges.join(whole, "path").where("several OR error IS NOT NULL").select("path", "block", "base", "last", F.col("bytes").alias("all"), F.col("error").isNotNull().alias("lost")))
    texts = runs.join(known, ["path", "block"], "left").where("lost IS NULL OR NOT lost").select(
        "path", no.alias("no"), "block", "size", F.coalesce("all", "total").alias("bytes"), F.coalesce(F.col("last") == no, "tail").alias("is_last"),
        F.expr("several AND (seq = 0 OR tail)").alias("shared"), F.col("text").cast("string").alias("raw"),
    )
    # only the first and the last run of a range can be a part together with runs of others
    lines = F.when(F.col("raw").isNotNull(), F.struct("block", "raw"))
    shared = texts.where("shared").groupBy("path", "no").agg(
        F.max("size").alias("size"), F.max("bytes").alias("bytes"), F.max("is_last").alias("is_last"), F.sort_array(F.collect_list(lines)).alias("lines")
    )
    joined = F.when(F.size("lines") > 0, F.array_join(F.transform("lines", lambda x: x["raw"]), "\n"))
    columns = ["path", "no", "size", "bytes", "is_last", "raw"]
    shared = pinned(shared.withColumn("raw", joined).select(columns))

    # lines have an end, all but the last one of some files; that of a part's last line belongs to what joins the next part to it
    raw = F.col("raw")
    text = unix_newlines(F.concat(raw, F.lit("\n")))
    open_end = F.col("size").isin(F.col("bytes") - 1, F.col("bytes") + 2)
    mark = F.when((F.col("no") == 0) & (F.col("size") > F.col("bytes")), F.lit(BYTE_ORDER_MARK)).otherwise(F.lit(""))
    body = F.concat(
        mark,
        F.when(raw.isNull(), F.lit(""))
        .when(F.col("is_last") & open_end, unix_newlines(raw))
        .when(F.col("is_last"), text)
        .otherwise(F.substring(text, F.lit(1), F.length(text) - 1)),
    )
    parts = texts.where("NOT shared").select(columns).unionByName(shared).select(
        F.col("path").alias("document_id"), F.lit(0).cast("bigint").alias("section_no"), F.col("no").alias("part_no"), body.alias("body")
    )
    index = numbered_parts(parts.select(*PART, (F.length("body") + len(JOINER)).cast("bigint").alias("size")))
    return LargeFiles(parts, index, errors)
