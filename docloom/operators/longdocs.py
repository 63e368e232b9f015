"""Documents that arrive as many rows, however large one of them is, along one path.

Page texts of a document are joined by a blank line and split as one text. The pages of `PART_PAGES` consecutive numbers
are a part; most documents are a single one. No row holds more text than a part, and no task more than it can stream:

1. Where a piece starts decides alone where the next one starts. So each part of a document that has several is turned, in
   parallel, into a small map: for every place where a piece may start at the head of the part, where the first piece
   behind the part starts and how many pieces lie between.
2. The maps of a document, some hundred bytes a part, are followed one after the other, which gives the start and the
   piece number of every part. A document's only part starts at 0 and has no map.
3. Each part then emits its own pieces. The head of the following text is joined to it, because the last
   piece of a part reaches into it.

All of it is one plan, made without running a job.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.constants import MAX_CHARS, OVERLAP, PART_PAGES
from docloom.functions.split import _piece_array, PIECES, check_limits, cuts, in_blocks, spans, step, stripped, whole_piece
from docloom.functions.text import strip
from docloom.operators.numbering import before

JOINER = "\n\n"
KEY = ["document_id", "section_no"]
PART = [*KEY, "part_no"]
#: Characters of a document whose surroundings one task looks up.
STRETCH = 1 << 28
DONE = -1

HOPS = T.ArrayType(
    T.StructType(
        [
            T.StructField("entry", T.LongType()),
            T.StructField("exit", T.LongType()),
            T.StructField("n", T.LongType()),
        ]
    )
)


# --- gathering pages -------------------------------------------------------------------------------------


def _keyed(pages: DataFrame) -> DataFrame:
    return pages if "section_no" in pages.columns else pages.withColumn("section_no", F.lit(0).cast("bigint"))


def clean_pages(pages: DataFrame) -> DataFrame:
    """Pages with stripped text; a missing text counts as empty and empty pages are dropped."""
    text = strip(F.coalesce("page_text", F.lit("")))
    page_no = F.col("page_no").cast("bigint").alias("page_no")
    return _keyed(pages).select(*KEY, page_no, text.alias("page_text")).filter("page_text != ''")


def into_parts(pages: DataFrame, part_pages: int = PART_PAGES) -> DataFrame:
    """``(key, part_no, body)``: the joined text of every ``part_pages`` consecutive page numbers; numbers of parts may have gaps."""
    numbered = pages.withColumn("part_no", part_of(part_pages))
    ordered = F.sort_array(F.collect_list(F.struct("page_no", "page_text")))
    body = F.array_join(F.transform("_pages", lambda p: p["page_text"]), JOINER)
    return numbered.groupBy(*PART).agg(ordered.alias("_pages")).select(*PART, body.alias("body"))


def part_of(part_pages: int) -> Column:
    return F.floor(F.col("page_no").cast("bigint") / F.lit(part_pages))


def with_several_parts(pages: DataFrame, part_pages: int = PART_PAGES) -> DataFrame:
    """Keys of the documents that may have several parts, from page numbers alone."""
    part = part_of(part_pages)
    return _keyed(pages).groupBy(*KEY).agg(F.min(part).alias("_low"), F.max(part).alias("_high")).where("_low < _high").select(*KEY)


def part_index(pages: DataFrame, several: DataFrame, part_pages: int = PART_PAGES) -> DataFrame:
    """``(key, part_no, no, offset, size, last)``: the parts of the documents in ``several`` numbered from 0, and where each begins.

    Made from lengths alone, which are summed per part before they move.
    """
    size = (F.length("page_text") + len(JOINER)).cast("bigint")
    totals = pages.join(several, KEY).groupBy(*KEY, part_of(part_pages).alias("part_no")).agg(F.sum(size).alias("size"))
    return numbered_parts(totals)


def numbered_parts(totals: DataFrame) -> DataFrame:
    """``(key, part_no, size)`` with the number of each part, its offset, and whether it is the last."""
    in_order = Window.partitionBy(*KEY).orderBy("part_no")
    return totals.select(
        *PART,
        "size",
        (F.row_number().over(in_order) - 1).cast("bigint").alias("no"),
        F.coalesce(before(F.col("size"), KEY, ["part_no"]), F.lit(0).cast("bigint")).alias("offset"),
        F.lead("part_no").over(in_order).isNull().alias("last"),
    )


def assemble_pages(pages: DataFrame, part_pages: int = PART_PAGES) -> DataFrame:
    """``bodies(document_id, part_no, body)`` from ``pages(document_id, page_no, page_text)``.

    A row is the text of ``part_pages`` consecutive page numbers; a document's text is its parts in order, joined by a blank line.
    """
    return into_parts(clean_pages(pages), part_pages).select("document_id", "part_no", "body")


# --- splitting a document held as parts ---------------------------------------------------------------------


def text_ahead(parts: DataFrame, index: DataFrame, head_chars: int) -> DataFrame:
    """``(key, part_no, no, offset, ahead)``: the first ``head_chars`` characters, or some more, of what follows each part of the index.

    A part asks at the place where it ends; heads of parts that begin there or up to ``head_chars`` further answer, however
    short they are. Places are looked up by stretches of the document, so a long one is dealt over many tasks.
    """
    head = F.concat(F.lit(JOINER), F.substring("body", 1, head_chars))
    heads = parts.select(*PART, head.alias("_head")).join(index.select(*PART, "no", "offset", "size"), PART)
    begin, end = F.col("offset"), F.col("offset") + F.col("size")
    answer = lambda asks: F.lit(None).cast("string") if asks else F.col("_head")
    row = lambda asks, place, stretch: F.struct(
        F.lit(asks).alias("_asks"), place.alias("_place"), F.floor(stretch / F.lit(STRETCH)).alias("_stretch"), answer(asks).alias("_answer")
    )
    # an answer near the beginning of a stretch is given in the one before it, too
    rows = F.array(row(True, end, end), row(False, begin, begin), row(False, begin, F.when(begin % STRETCH <= head_chars, begin - STRETCH)))
    dealt = heads.select(*PART, "no", "offset", F.inline(rows)).where("_stretch IS NOT NULL")
    following = Window.partitionBy(*KEY, "_stretch").orderBy("_place").rangeBetween(Window.currentRow, head_chars)
    answers = F.collect_list(F.when(~F.col("_asks"), F.struct("_place", "_answer"))).over(following)
    found = dealt.select(*PART, "no", "offset", "_asks", answers.alias("_heads"))
    ahead = F.array_join(F.transform(F.sort_array("_heads"), lambda h: h["_answer"]), "")
    return found.where("_asks").select(*PART, "no", "offset", ahead.alias("ahead"))


class PartChain:
    """Piece starts of one part. Positions count from the start of the part's text.

    Every part but the first begins with the blank line that joins it to the one before.
    """

    def __init__(self, body: str, first: bool, ahead: str, max_chars: int, overlap: int):
        own = body if first else JOINER + body
        self.text, self.own = own + ahead, len(own)
        self.max_chars, self.overlap = max_chars, overlap
        self.borders = cuts(self.text, 0, len(self.text), JOINER)

    def pieces(self, at: int) -> tuple[list[tuple[int, int, str]], int | None]:
        """Pieces that start at border ``at`` before the next start, and that start."""
        end, following = step(self.borders, at, self.max_chars, self.overlap)
        lo, hi = self.borders[at], self.borders[end if end > at else at + 1]
        found = [(lo, hi)] if end > at else spans(self.text, lo, hi, self.max_chars, self.overlap, 1)
        return list(stripped(self.text, found)), following

    def hops(self) -> list[tuple[int, int, int]]:
        """``(entry, exit, pieces)`` for every border at which a piece could be the first of this part."""
        reach: dict[int, tuple[int, int]] = {}
        starts = range(len(self.borders) - 1)
        for at in reversed(starts):
            position = self.borders[at]
            if position >= self.own:
                if position - self.own < self.max_chars:
                    reach[at] = (position - self.own, 0)
                continue
            found, following = self.pieces(at)
            if following is None:
                reach[at] = (DONE, len(found))
            else:
                out, n = reach.get(following, (self.borders[following] - self.own, 0))
                reach[at] = (out, n + len(found))
        if not self.text[self.own :]:
            # nothing follows: whatever still starts behind this part is the end of the document
            reach = {at: (DONE, n) for at, (_, n) in reach.items()}
        return [(self.borders[at], *reach[at]) for at in sorted(reach) if self.borders[at] < self.max_chars]

    def emit(self, entry: int) -> list[tuple[int, int, str]]:
        if entry == DONE or entry >= self.own:
            return []
        at, out = self.borders.index(entry), []
        while at is not None and self.borders[at] < self.own:
            found, at = self.pieces(at)
            out += found
        return out


def _chains(max_chars, overlap, *columns):
    for body, first, ahead in zip(*columns):
        yield None if body is None else PartChain(body, first, ahead, max_chars, overlap)


def hops_udf(max_chars: int, overlap: int):
    @F.arrow_udf(HOPS)
    def part_hops(body: pa.Array, first: pa.Array, ahead: pa.Array) -> pa.Array:
        return in_blocks(hops_block, body, first, ahead)

    def hops_block(body, first, ahead):
        rows = _chains(max_chars, overlap, body.to_pylist(), first.to_pylist(), ahead.to_pylist())
        names = ("entry", "exit", "n")
        kind = pa.list_(pa.struct([(name, pa.int64()) for name in names]))
        return pa.array([chain and [dict(zip(names, hop)) for hop in chain.hops()] for chain in rows], kind)

    return part_hops


def emit_udf(max_chars: int, overlap: int):
    @F.arrow_udf(PIECES)
    def part_pieces(body: pa.Array, first: pa.Array, ahead: pa.Array, entry: pa.Array) -> pa.Array:
        return in_blocks(pieces_block, body, first, ahead, entry)

    def pieces_block(body, first, ahead, entry):
        rows = _chains(max_chars, overlap, body.to_pylist(), first.to_pylist(), ahead.to_pylist())
        return _piece_array([chain and chain.emit(at) for chain, at in zip(rows, entry.to_pylist())])

    return part_pieces


def part_entries(hops: DataFrame) -> DataFrame:
    """``(key, no, entry, base)`` from ``(key, no, hops)`` of parts numbered from 0; a document's maps are streamed in order.

    Other columns are kept; rows without a number are left out.
    """
    kept = [f for f in hops.schema if f.name != "hops"]
    names = [f.name for f in kept]

    def follow(batches):
        document, at, base = None, 0, 0
        for batch in batches:
            batch = batch.filter(batch.column("no").is_valid())
            out = {"entry": [], "base": []}
            for key, section, no, ways in zip(*[batch.column(c).to_pylist() for c in (*KEY, "no", "hops")]):
                if (key, section) != document or not no:
                    document, at, base = (key, section), 0, 0
                out["entry"].append(at)
                out["base"].append(base)
                if at != DONE:
                    way = next(w for w in ways if w["entry"] == at)
                    at, base = way["exit"], base + way["n"]
            columns = [*[batch.column(c) for c in names], pa.array(out["entry"], pa.int64()), pa.array(out["base"], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "entry", "base"])

    in_order = hops.select(*names, "hops").repartition(*KEY).sortWithinPartitions(*KEY, "no")
    return in_order.mapInArrow(follow, T.StructType([*kept, *(T.StructField(c, T.LongType()) for c in ("entry", "base"))]))


def split_parts(parts: DataFrame, index: DataFrame, max_chars: int, overlap: int) -> DataFrame:
    """``(key, i, start, end, content)`` of documents held as parts; those that aren't in ``index`` are their document's only one."""
    columns = ("body", "first", "ahead")
    near = text_ahead(parts, index, 2 * max_chars + 2 * len(JOINER))
    zero = F.lit(0).cast("bigint")
    around = parts.join(near, PART, "left").select(
        *PART, "body", "no", F.coalesce(F.col("no") == 0, F.lit(True)).alias("first"), F.coalesce("ahead", F.lit("")).alias("ahead"), F.coalesce("offset", zero).alias("offset")
    )
    # the same rows, columns and keys, so that both uses of `around` read one exchange and a body moves once
    ways = hops_udf(max_chars, overlap)(F.when(F.col("no").isNotNull(), F.col("body")), "first", "ahead")
    entries = part_entries(around.select(*PART, "no", "offset", ways.alias("hops"))).select(*PART, "entry", "base")
    entered = around.join(entries, PART, "left").withColumns({c: F.coalesce(c, zero) for c in ("entry", "base")})
    short = F.col("first") & (F.col("ahead") == "") & (F.length("body") <= max_chars)
    emitted = F.coalesce(
        F.when(short, whole_piece(F.col("body"))).otherwise(emit_udf(max_chars, overlap)(F.when(~short, F.col("body")), "first", "ahead", "entry")),
        F.array().cast(PIECES),
    )
    origin = F.col("offset") - F.when(F.col("first"), 0).otherwise(len(JOINER))
    found = entered.select(*KEY, "base", origin.alias("_origin"), F.posexplode(emitted).alias("_pos", "_p"))
    return found.select(
        *KEY,
        (F.col("base") + F.col("_pos")).cast("bigint").alias("i"),
        (F.col("_origin") + F.col("_p.start")).alias("start"),
        (F.col("_origin") + F.col("_p.end")).alias("end"),
        F.col("_p.content").alias("content"),
    )


def split_pages(pages: DataFrame, max_chars: int = MAX_CHARS, overlap: int = OVERLAP, part_pages: int = PART_PAGES) -> DataFrame:
    """Pieces ``(document_id, section_no, i, start, end, content)`` of the joined pages of every document."""
    check_limits(max_chars, overlap)
    if part_pages < 1:
        raise ValueError("part_pages must be at least 1")
    cleaned = clean_pages(pages)
    index = part_index(cleaned, with_several_parts(pages, part_pages), part_pages)
    return split_parts(into_parts(cleaned, part_pages), index, max_chars, overlap).select(*KEY, "i", "start", "end", "content")
