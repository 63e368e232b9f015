"""Markdown documents that arrive as many rows, however large one of them is, along one path.

Pages are joined to parts (`longdocs.into_parts`), and the lines of each part are scanned inside its row. What a part finds
depends on what is open where it begins: which code block, and the header of each level. So each part of a document that has
several is turned into a small map from the three states of code blocks to what is open behind it; a document's maps are
followed in order, and each part is entered with what the ones before it leave open. A document's only part begins with
nothing open and needs no map. Sections inside a part are split in its row; one that reaches over parts is split like a
document of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.constants import MAX_CHARS, OVERLAP, PART_PAGES
from docloom.functions.markdown import INHERITED, LEVELS, SECTION, STATES, block_states, header_sections, line_class, paragraphs, section_array, title
from docloom.functions.split import check_limits
from docloom.functions.text import strip
from docloom.operators.chunking import SECTIONS, pieces_of_sections
from docloom.operators.longdocs import JOINER, KEY, PART, clean_pages, into_parts, numbered_parts, part_index, split_parts, with_several_parts
from docloom.operators.numbering import before
from docloom.session import pinned

COLUMNS = ["document_id", "section_id", "i", "start", "end", "content"]
OPEN = T.ArrayType(T.StructType([T.StructField("state", T.IntegerType()), T.StructField("headers", T.ArrayType(T.IntegerType()))]))
#: Per state at the beginning: the state behind the part, and per level its header in force (null: none) or that it is still the one from before.
LEFT_OPEN = "array<struct<state:int,headers:array<struct<kept:boolean,pos:bigint,title:string>>>>"
IN_FORCE = "array<struct<pos:bigint,title:string>>"


@F.arrow_udf(OPEN)
def _left_open(parts: pa.Array) -> pa.Array:
    """For each state at the beginning of a part: the state behind it and the line of the last header of each level."""
    found = []
    for classes in parts:
        values = classes.values.to_numpy(zero_copy_only=False)
        found.append([])
        for state in range(STATES):
            behind = block_states(values, state)
            headers = [INHERITED] * LEVELS
            for line in np.flatnonzero((values > 0) & (values <= LEVELS) & (behind == 0)).tolist():
                level = int(values[line])
                headers[level - 1 :] = [line] + [-1] * (LEVELS - level)
            found[-1].append({"state": int(behind[-1]), "headers": headers})
    kind = pa.list_(pa.struct([("state", pa.int32()), ("headers", pa.list_(pa.int32()))]))
    return pa.array(found, kind)


@F.arrow_udf(T.ArrayType(SECTION))
def _sections_from(parts: pa.Array, states: pa.Array) -> pa.Array:
    found = zip(parts, states.to_pylist())
    return section_array([header_sections(p.values.to_numpy(zero_copy_only=False), s, INHERITED) for p, s in found])


def _position(line: Column) -> Column:
    """A line's place among the lines of its document, never 0; places grow, but not one by one."""
    return F.shiftleft(F.col("part_no") + 1, 31) + line + F.lit(1)


def _entered(lined: DataFrame, index: DataFrame) -> DataFrame:
    """``(PART, no, last, state, headers)``: what is open where each part of the documents in ``index`` begins."""
    header = lambda h: F.struct(
        (h == INHERITED).alias("kept"),
        F.when(h >= 0, _position(h)).alias("pos"),
        F.when(h >= 0, title(F.get(F.col("_lines"), h))).alias("title"),
    )
    maps = F.transform(_left_open("_classes"), lambda o: F.struct(o["state"].alias("state"), F.transform(o["headers"], header).alias("headers")))
    members = lined.join(index, PART).select(*PART, "no", "last", maps.cast(LEFT_OPEN).alias("maps"))

    def follow(batches):
        document, state, headers = None, 0, []
        kind = pa.list_(pa.struct([("pos", pa.int64()), ("title", pa.string())]))
        for batch in batches:
            states, all_headers = [], []
            for key, no, maps in zip(*[batch.column(c).to_pylist() for c in ("document_id", "no", "maps")]):
                if key != document or not no:
                    document, state, headers = key, 0, [None] * LEVELS
                states.append(state)
                all_headers.append(headers)
                behind = maps[state]
                state = behind["state"]
                headers = [a if b["kept"] else {"pos": b["pos"], "title": b["title"]} for a, b in zip(headers, behind["headers"])]
            names = [*PART, "no", "last"]
            columns = [*[batch.column(c) for c in names], pa.array(states, pa.int32()), pa.array(all_headers, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "state", "headers"])

    in_order = members.repartition("document_id").sortWithinPartitions("document_id", "no")
    return in_order.mapInArrow(follow, f"document_id string, section_no long, part_no long, no long, last boolean, state int, headers {IN_FORCE}")


def scanned(parts: DataFrame, index: DataFrame | None) -> DataFrame:
    """One row per part, ``(PART, several, sections)``; a section has its number, id, content and whether it reaches over parts.

    A section's number is the place of its header, 0 before the first. Parts that aren't in ``index`` are their document's only one;
    without an index all are.
    """
    # parts are joined by an empty line
    lined = parts.withColumn("_lines", F.transform(F.concat(F.split("body", "\n"), F.array(F.lit(""))), strip))
    lined = lined.select(*PART, "_lines", F.transform("_lines", line_class).alias("_classes"))
    if index is None:
        kinds = {"no": "bigint", "last": "boolean", "state": "int", "headers": IN_FORCE}
        entered = lined.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items()})
    else:
        entered = lined.join(_entered(lined, index.select(*PART, "no", "last")), PART, "left")
    began = F.coalesce("state", F.lit(0))
    found = entered.withColumn("_found", _sections_from("_classes", began))

    def section(s, i):
        in_force = F.transform(
            s["headers"],
            lambda h, k: F.when(h >= 0, F.struct(_position(h).alias("pos"), title(F.get(F.col("_lines"), h)).alias("title"))).when(
                h == INHERITED, F.get(F.col("headers"), k)
            ),
        )
        number = F.coalesce(F.array_max(F.transform(in_force, lambda h: h["pos"])), F.lit(0).cast("bigint"))
        from_before = (F.col("no") > 0) & (s["first"] == 0)
        goes_on = ~F.col("last") & (i == F.size("_found") - 1)
        return F.struct(
            number.alias("section_no"),
            F.array_join(F.transform(in_force, lambda h: h["title"]), "|").alias("section_id"),
            paragraphs(F.slice(F.col("_lines"), s["first"] + F.lit(1), s["lines"])).alias("content"),
            F.coalesce(from_before | goes_on, F.lit(False)).alias("spread"),
        )

    sections = F.filter(F.transform("_found", section), lambda s: s["content"] != "")
    return found.select(*PART, F.col("no").isNotNull().alias("several"), sections.alias("sections"))


def _parts_of(pages: DataFrame, part_pages: int) -> tuple[DataFrame, DataFrame]:
    cleaned = clean_pages(pages)
    return into_parts(cleaned, part_pages), part_index(cleaned, with_several_parts(pages, part_pages), part_pages)


def markdown_sections(pages: DataFrame, part_pages: int = PART_PAGES) -> DataFrame:
    """``(document_id, section_no, section_id, part_no, content)`` in reading order.

    A row is what one part (``part_pages`` consecutive page numbers) has of a section; a blank line joins the rows of a section.
    """
    found = scanned(*_parts_of(pages, part_pages))
    # wrapped: Spark derives a filter from a bare column and would run the Python function for it a second time
    rows = found.select("document_id", "part_no", F.explode(F.coalesce("sections", F.array().cast(found.schema["sections"].dataType))).alias("_s"))
    return rows.select("document_id", "_s.section_no", "_s.section_id", "part_no", "_s.content")


def split_markdown_pages(pages: DataFrame, max_chars: int = MAX_CHARS, overlap: int = OVERLAP, part_pages: int = PART_PAGES) -> DataFrame:
    """Pieces of markdown documents given as ``pages(document_id, page_no, page_text)``, joined by blank lines."""
    parts, index = _parts_of(pages, part_pages)
    # from page numbers alone; without such a document the steps below that none of them has rows for are left out
    none = with_several_parts(pages, part_pages).head() is None
    return split_markdown_parts(parts, None if none else index, max_chars, overlap)


def split_markdown_parts(parts: DataFrame, index: DataFrame | None, max_chars: int = MAX_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """The same of documents held as parts."""
    check_limits(max_chars, overlap)
    found = scanned(parts, index)
    plain = lambda s: F.struct(*[s[c].alias(c) for c in ("section_no", "section_id", "content")])
    inside = found.withColumn("_sections", F.transform(F.filter("sections", lambda s: ~s["spread"]), plain).cast(SECTIONS))
    inside = pieces_of_sections(inside, max_chars, overlap).select("document_id", "part_no", "several", "_sections", "pieces")

    if index is None:
        rows = inside.select("document_id", F.posexplode(F.coalesce("pieces", F.array().cast(inside.schema["pieces"].dataType))).alias("i", "_p"))
        return rows.select("document_id", "_p.*", F.col("i").cast("bigint").alias("i")).select(COLUMNS)
    # only documents of several parts have such sections; what is used again is stored
    spread = found.where("several").select("document_id", "part_no", F.explode(F.filter("sections", lambda s: s["spread"])).alias("_s"))
    spread = pinned(spread.select("document_id", "_s.section_no", "part_no", "_s.section_id", F.col("_s.content").alias("body")))
    index = numbered_parts(spread.select(*PART, (F.length("body") + len(JOINER)).cast("bigint").alias("size")))
    over_parts = pinned(split_parts(spread.select(*PART, "body"), index, max_chars, overlap))

    # a part's own sections stand between those that reach into it and out of it
    own = inside.where("several").select("document_id", F.array_min(F.transform("_sections", lambda s: s["section_no"])).alias("at"), F.size("pieces").cast("bigint").alias("_n"), "part_no")
    units = own.where("at IS NOT NULL").unionByName(
        over_parts.groupBy("document_id", F.col("section_no").alias("at")).agg(F.count("*").alias("_n")).withColumn("part_no", F.lit(None).cast("bigint"))
    )
    numbered = units.withColumn("offset", F.coalesce(before(F.col("_n"), ["document_id"], ["at"]), F.lit(0).cast("bigint")))
    at_part = numbered.where("part_no IS NOT NULL").select("document_id", "part_no", "offset")
    sections = numbered.where("part_no IS NULL").select("document_id", F.col("at").alias("section_no"), "offset")

    zero = F.lit(0).cast("bigint")
    pieces = F.coalesce("pieces", F.array().cast(inside.schema["pieces"].dataType))
    rows = inside.join(at_part, ["document_id", "part_no"], "left").select("document_id", F.coalesce("offset", zero).alias("offset"), F.posexplode(pieces).alias("_pos", "_p"))
    rows = rows.select("document_id", "_p.section_id", (F.col("offset") + F.col("_pos")).alias("i"), "_p.start", "_p.end", "_p.content")
    ids = spread.select("document_id", "section_no", "section_id").distinct()
    more = over_parts.join(sections.join(ids, ["document_id", "section_no"]), ["document_id", "section_no"])
    return rows.unionByName(more.withColumn("i", F.col("i") + F.col("offset")).select(COLUMNS)).select(COLUMNS)
