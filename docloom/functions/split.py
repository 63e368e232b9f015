"""Splitting one text into overlapping pieces of bounded length.

Separators are tried from coarse to fine: blank line, newline, space, single character. A text is cut in
front of every occurrence of the first separator it holds, and the cuts are packed greedily into pieces of
at most ``max_chars`` characters. A new piece starts at the earliest cut that repeats at most ``overlap``
characters and still leaves room for what follows. A stretch without a cut that is longer than
``max_chars`` ends the piece before it, is split by the finer separators on its own, and is not overlapped.

Only bodies longer than ``max_chars`` reach this code; the rest is one piece and stays in the JVM
(`pieces_of`).
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.constants import MAX_CHARS, OVERLAP
from docloom.functions.text import strip
from docloom.schemas import PIECE

SEPARATORS = ("\n\n", "\n", " ")
PIECES = T.ArrayType(PIECE)
#: Bytes of a batch that are Python objects at once.
BLOCK_BYTES = 1 << 20


def check_limits(max_chars: int, overlap: int) -> None:
    if not 0 <= overlap < max_chars:
        raise ValueError("overlap must be at least 0 and smaller than max_chars")


def cuts(text: str, lo: int, hi: int, sep: str) -> list[int]:
    """Borders of the stretches of ``text[lo:hi]``, both ends included."""
    inner = [m.start() for m in re.compile(re.escape(sep)).finditer(text, lo, hi)]
    if inner and inner[0] == lo:
        del inner[0]
    return [lo, *inner, hi]


def step(borders: list[int], at: int, max_chars: int, overlap: int) -> tuple[int, int | None]:
    """Border where the piece starting at border ``at`` ends, and where the next one starts (None: done).

    The end equals ``at`` when the stretch behind it is too long and must be split by a finer separator.
    """
    last = len(borders) - 1
    end = bisect_right(borders, borders[at] + max_chars) - 1
    if end == at:
        return at, (at + 1 if at + 1 < last else None)
    if end == last:
        return end, None
    after = borders[end + 1]
    if after - borders[end] > max_chars:
        return end, end
    return end, bisect_left(borders, max(borders[end] - overlap, after - max_chars))


def spans(text: str, lo: int, hi: int, max_chars: int, overlap: int, level: int = 0):
    """Yield ``(start, end)`` of the pieces of ``text[lo:hi]``, not yet stripped."""
    while level < len(SEPARATORS):
        borders = cuts(text, lo, hi, SEPARATORS[level])
        level += 1
        if len(borders) > 2 or hi - lo <= max_chars:
            break
    else:
        start = lo
        while hi - start > max_chars:
            yield start, start + max_chars
            start += max_chars - overlap
        yield start, hi
        return
    at = 0
    while at is not None:
        end, following = step(borders, at, max_chars, overlap)
        if end == at:
            yield from spans(text, borders[at], borders[at + 1], max_chars, overlap, level)
        else:
            yield borders[at], borders[end]
        at = following


def stripped(text: str, found):
    """Yield ``(start, end, content)`` with outer white space taken off and empty pieces left out."""
    for lo, hi in found:
        raw = text[lo:hi]
        left = raw.lstrip()
        content = left.rstrip()
        if content:
            start = lo + len(raw) - len(left)
            yield start, start + len(content), content


def split_text(text: str, max_chars: int = MAX_CHARS, overlap: int = OVERLAP) -> list[tuple[int, int, str]]:
    """Pieces of one text as ``(start, end, content)``."""
    return list(stripped(text, spans(text, 0, len(text), max_chars, overlap)))


def _piece_array(lists: list[list[tuple[int, int, str]] | None]) -> pa.Array:
    """Arrow ``list<struct<start,end,content>>`` from Python lists, built column by column."""
    offsets, starts, ends, contents = [], [], [], []
    for pieces in lists:
        offsets.append(len(starts) if pieces is not None else None)
        for start, end, content in pieces or ():
            starts.append(start)
            ends.append(end)
            contents.append(content)
    offsets.append(len(starts))
    structs = pa.StructArray.from_arrays(
        [pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(contents, pa.string())],
        ["start", "end", "content"],
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)


def in_blocks(make, *columns: pa.Array) -> pa.Array:
    """``make`` over the columns of a batch, in slices of about `BLOCK_BYTES` (or one larger row).

    Spark bounds a batch in rows and bytes; texts and pieces take several times that as Python objects, so they exist for a slice only.
    """
    n = len(columns[0])
    rows = max(1, n * BLOCK_BYTES // max(1, sum(c.nbytes for c in columns)))
    if rows >= n:
        return make(*columns)
    return pa.concat_arrays([make(*[c.slice(i, rows) for c in columns]) for i in range(0, n, rows)])


def split_udf(max_chars: int = MAX_CHARS, overlap: int = OVERLAP):
    """Arrow function ``string -> array<piece>``; null in, null out."""

    @F.arrow_udf(PIECES)
    def split_long(texts: pa.Array) -> pa.Array:
        return in_blocks(split_block, texts)

    def split_block(texts):
        return _piece_array(
            [None if t is None else split_text(t, max_chars, overlap) for t in texts.to_pylist()]
        )

    return split_long


def split_each_udf(max_chars: int = MAX_CHARS, overlap: int = OVERLAP):
    """Arrow function ``array<string> -> array<array<piece>>``; null elements stay null."""

    @F.arrow_udf(T.ArrayType(PIECES))
    def split_each_long(groups: pa.Array) -> pa.Array:
        return in_blocks(split_block, groups)

    def split_block(groups):
        offsets, flat = [], []
        for texts in groups.to_pylist():
            offsets.append(len(flat) if texts is not None else None)
            flat.extend(None if t is None else split_text(t, max_chars, overlap) for t in texts or ())
        offsets.append(len(flat))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), _piece_array(flat))

    return split_each_long


def whole_piece(text: Column) -> Column:
    """``array<piece>`` of a text that needs no split: its stripped self, or nothing when it is blank."""
    content = strip(text)
    start = F.length(text) - F.length(F.ltrim(text, _ws()))
    piece = F.struct(
        start.cast("bigint").alias("start"),
        (start + F.length(content)).cast("bigint").alias("end"),
        content.alias("content"),
    )
    return F.when(text.isNull() | (content == ""), F.array().cast(PIECES)).otherwise(F.array(piece))


def _ws() -> Column:
    from docloom.constants import WHITESPACE

    return F.lit(WHITESPACE)


def pieces_of(text: Column, max_chars: int = MAX_CHARS, overlap: int = OVERLAP) -> Column:
    """Pieces of a text column.

    The function sees null for every text within the limit, so short bodies never cross to Python, and one
    scan serves both branches.
    """
    check_limits(max_chars, overlap)
    long_text = F.when(F.length(text) > max_chars, text)
    return F.coalesce(split_udf(max_chars, overlap)(long_text), whole_piece(text))
