"""Header sections of markdown.

A header is a line that, stripped, starts with one to five ``#`` and a space, outside code fences. It puts
every deeper header out of force. Lines are stripped; a section's content is its lines without the header
line, with blank lines reduced to one between paragraphs. Content before the first header belongs to a
section with the empty id.

`sections_of` works inside one row: lines are classified in the JVM and only their class numbers (not their
text) cross to Python, where the running header levels are found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.text import strip

LEVELS = 5
# Lines that open or close a code block. Backticks that are closed on their own line open nothing, but like any
# line that begins with the block's own fence they end one.
BACKTICKS, TILDES, INLINE = LEVELS + 1, LEVELS + 2, LEVELS + 3
# State behind a fence line, by the state before it: 0 no block, 1 one of backticks, 2 one of tildes.
AFTER = {BACKTICKS: (1, 0, 2), TILDES: (2, 1, 0), INLINE: (0, 0, 2)}
STATES = 3

HEADER = r"^(#{1,5}) "

# Stands for a header in force that is in an earlier part of the document.
INHERITED = -2

# first line (from 0), number of lines, and per level the line of the header in force (-1: none)
SECTION = T.StructType(
    [
        T.StructField("first", T.IntegerType()),
        T.StructField("lines", T.IntegerType()),
        T.StructField("headers", T.ArrayType(T.IntegerType())),
    ]
)


def line_class(line: Column) -> Column:
    """0 for content, 1 to 5 for a header of that level, more for a fence line; ``line`` is stripped."""
    level = F.length(F.regexp_extract(line, HEADER, 1))
    closed = F.locate("```", line, 4) > 0
    backticks = F.when(closed, F.lit(INLINE)).otherwise(F.lit(BACKTICKS))
    return (
        F.when(line.startswith("#"), level)
        .when(line.startswith("```"), backticks)
        .when(line.startswith("~~~"), F.lit(TILDES))
        .otherwise(F.lit(0))
    )


def block_states(classes: np.ndarray, state: int = 0) -> np.ndarray:
    """The state behind every line."""
    at = np.flatnonzero(classes > LEVELS)
    states = [state]
    for c in classes[at].tolist():
        states.append(AFTER[c][states[-1]])
    return np.repeat(states, np.diff(np.concatenate([[0], at, [len(classes)]])))


def title(line: Column) -> Column:
    """Title of a header line."""
    return strip(F.regexp_replace(line, r"^#+", ""))


def header_sections(classes: np.ndarray, state: int = 0, outer: int = -1) -> list[tuple[int, int, list[int]]]:
    """``(first line, lines, header line per level)`` of the sections of one document, or of a part that begins in ``state``.

    ``outer`` stands for the headers in force at the beginning.
    """
    fenced = block_states(classes, state) > 0
    found, in_force = [], [outer] * LEVELS
    starts = np.flatnonzero((classes > 0) & (classes <= LEVELS) & ~fenced).tolist()
    first = 0
    for line in [*starts, len(classes)]:
        if line > first:
            found.append((first, line - first, list(in_force)))
        if line < len(classes):
            level = int(classes[line])
            in_force[level - 1 :] = [line] + [-1] * (LEVELS - level)
        first = line + 1
    return found


def section_array(documents) -> pa.Array:
    """Arrow ``list<section>`` from the sections of each document (None: null), built column by column."""
    offsets, first, lines, headers = [], [], [], []
    for sections in documents:
        offsets.append(len(first) if sections is not None else None)
        for start, count, in_force in sections or ():
            first.append(start)
            lines.append(count)
            headers.extend(in_force)
    offsets.append(len(first))
    per_level = pa.ListArray.from_arrays(
        pa.array(range(0, len(headers) + 1, LEVELS), pa.int32()), pa.array(headers, pa.int32())
    )
    structs = pa.StructArray.from_arrays(
        [pa.array(first, pa.int32()), pa.array(lines, pa.int32()), per_level], ["first", "lines", "headers"]
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)


@F.arrow_udf(T.ArrayType(SECTION))
def find_sections(documents: pa.Array) -> pa.Array:
    values = (classes.values for classes in documents)
    return section_array(None if v is None else header_sections(v.to_numpy(zero_copy_only=False)) for v in values)


def paragraphs(lines: Column) -> Column:
    """Text of an array of stripped lines, paragraphs apart by one blank line."""
    text = F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n")
    return F.btrim(text, F.lit("\n"))


def with_sections(df, body: Column, out: str = "sections"):
    """Add ``out``: ``array<struct<section_no, section_id, content>>`` of a markdown column (null stays null)."""
    lined = df.withColumn("_lines", F.transform(F.split(body, "\n"), strip))
    found = lined.withColumn("_found", find_sections(F.transform("_lines", line_class)))
    section = lambda s, i: F.struct(
        i.cast("bigint").alias("section_no"),
        F.array_join(
            F.transform(
                F.filter(s["headers"], lambda h: h >= 0),
                lambda h: title(F.get(F.col("_lines"), h)),
            ),
            "|",
        ).alias("section_id"),
        paragraphs(F.slice(F.col("_lines"), s["first"] + F.lit(1), s["lines"])).alias("content"),
    )
    cut = F.filter(F.transform(F.col("_found"), section), lambda s: s["content"] != "")
    return found.withColumn(out, cut).drop("_lines", "_found")
