"""Documents spread over many rows give the same pieces as the joined text, whatever their size."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import docloom as dl
from docloom.functions.split import split_text
from docloom.operators import longdocs
from docloom.operators.longdocs import PART, PartChain, numbered_parts, part_entries, split_parts
from docloom.session import pinned

SCHEMA = "document_id string, page_no int, page_text string"


def page(rng):
    kind = rng.random()
    if kind < 0.1:
        return rng.choice(["", "  ", None])
    if kind < 0.5:
        return " ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(1, 60)))
    if kind < 0.7:
        return "\n\n".join("x" * rng.randint(1, 300) for _ in range(rng.randint(1, 5))) + " "
    if kind < 0.8:
        return "z" * rng.randint(1700, 6000)
    if kind < 0.9:
        return "\n".join("y " * rng.randint(1, 900) for _ in range(rng.randint(1, 4)))
    return "\n\n\n".join("q" * rng.randint(1, 40) for _ in range(30))


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(5)
    # one document holds most of the pages
    counts = {"one": (1, 1), "few": (3, 1), "gaps": (60, 7), "hot": (400, 1), "blank": (0, 1)}
    rows = [(d, n * gap, page(rng)) for d, (count, gap) in counts.items() for n in range(count)]
    rows += [("grid", n, "g" * 97) for n in range(300)] + [("blank", 1, " "), ("blank", 2, None)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).cache()


def joined(pages):
    texts = {}
    for r in pages.orderBy("document_id", "page_no").collect():
        texts.setdefault(r.document_id, []).append((r.page_text or "").strip())
    return {d: "\n\n".join(t for t in ts if t) for d, ts in texts.items() if any(ts)}


def found(pieces):
    out = {}
    for r in pieces.orderBy("document_id", "i").collect():
        assert r.i == len(out.setdefault(r.document_id, []))
        out[r.document_id].append((r.start, r.end, r.content))
    return out


def test_documents_of_one_part(spark, pages):
    assert found(dl.split_pages(pages, part_pages=10**6)) == {d: split_text(t) for d, t in joined(pages).items()}


@pytest.mark.parametrize("part_pages", [1, 7, 128])
def test_documents_of_many_parts(spark, pages, part_pages):
    spread = dl.split_pages(pages, part_pages=part_pages)
    assert found(spread) == {d: split_text(t) for d, t in joined(pages).items()}


def test_surroundings_are_found_over_stretches(spark, pages, monkeypatch):
    monkeypatch.setattr(longdocs, "STRETCH", 8192)
    assert found(dl.split_pages(pages, part_pages=3)) == {d: split_text(t) for d, t in joined(pages).items()}


def test_plans_are_made_without_a_job(spark, pages):
    """Only an action runs jobs, however large the documents are."""
    pages.count()
    seen = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "no job")
    try:
        for make in (dl.split_pages, dl.markdown_sections, dl.assemble_pages):
            make(pages, part_pages=2)
        assert list(seen.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setJobGroup("default", "")


def test_assembly_in_parts_joins_to_the_whole(spark, pages):
    for part_pages in (7, 10**6):
        got = {}
        for r in dl.assemble_pages(pages, part_pages=part_pages).orderBy("document_id", "part_no").collect():
            got.setdefault(r.document_id, []).append(r.body)
        assert {d: "\n\n".join(b) for d, b in got.items()} == joined(pages)
        assert (len(got["hot"]) > 10) == (part_pages == 7) and len(got["one"]) == 1


LIMIT, REPEAT = 12, 4
paragraphs = st.sampled_from(["a", "bb cc", "d" * 11, "e" * 12, "f" * 13, "g" * 30, "h\ni", "k  l", "m" * 100, "n\n\n\no"])


@settings(max_examples=500, deadline=None)
@given(st.lists(paragraphs, min_size=1, max_size=60), st.integers(1, 9))
def test_any_split_into_parts_gives_the_same_pieces(texts, part_pages):
    """The steps on one document, without Spark."""
    parts = {}
    for n, text in enumerate(texts):
        parts.setdefault(n // part_pages, []).append(text)
    bodies = ["\n\n".join(p) for _, p in sorted(parts.items())]
    head = 2 * LIMIT + 4
    entry, origin, found = 0, 0, []
    for n, body in enumerate(bodies):
        ahead = "".join("\n\n" + b for b in bodies[n + 1 :])[:head]
        chain = PartChain(body, n == 0, ahead, LIMIT, REPEAT)
        shift = origin - (2 if n else 0)
        pieces = chain.emit(entry)
        found += [(shift + s, shift + e, c) for s, e, c in pieces]
        hops = {h[0]: h[1:] for h in chain.hops()}
        if entry != -1:
            entry, count = hops[entry]
            assert count == len(pieces)
        origin += len(body) + 2
    assert entry == -1
    assert found == split_text("\n\n".join(texts), LIMIT, REPEAT)


def test_a_part_hands_on_every_possible_entry():
    body = "\n\n".join("g" * 97 for _ in range(200))
    chain = PartChain(body, False, ("\n\n" + "g" * 97) * 40, 1792, 128)
    entries = {entry: (out, n) for entry, out, n in chain.hops()}
    assert len(entries) == 19 and len({out for out, _ in entries.values()}) > 1
    for entry, (_, n) in entries.items():
        assert len(chain.emit(entry)) == n


def test_entries_follow_the_maps_in_order(spark):
    rows = [("d", 0, n, [{"entry": 0, "exit": 0, "n": n}]) for n in range(40)]
    hops = spark.createDataFrame(rows, "document_id string, section_no long, no long, hops array<struct<entry:long,exit:long,n:long>>")
    got = {r.no: (r.entry, r.base) for r in part_entries(hops.repartition(5)).collect()}
    assert got == {n: (0, n * (n - 1) // 2) for n in range(40)}


def test_bodies_of_parts_move_once(spark, capsys):
    rows = [(d, 0, n, "some words of it\n\n" * 50) for d, count in (("many", 30), ("one", 1), (None, 1)) for n in range(count)]
    parts = pinned(spark.createDataFrame(rows, "document_id string, section_no long, part_no long, body string"))
    index = numbered_parts(parts.where("document_id = 'many'").select(*PART, (F.length("body") + 2).cast("bigint").alias("size")))
    pieces = split_parts(parts, index, 100, 20)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        pieces.explain("formatted")
        assert len(re.findall(r"\) Exchange\nInput \[\d+\]: \[.*\bbody#", capsys.readouterr().out)) == 1
        got = {}
        for r in pieces.orderBy("document_id", "i").collect():
            got.setdefault(r.document_id, []).append((r.start, r.end, r.content))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    text = rows[0][3]
    assert got == {d: split_text("\n\n".join([text] * n), 100, 20) for d, n in (("many", 30), ("one", 1), (None, 1))}


def test_spread_markdown_documents(spark):
    rng = random.Random(7)

    def part(plain):
        lines = []
        for _ in range(rng.randint(0, 12)):
            kind = rng.random()
            if kind < 0.2 and not plain:
                lines.append("#" * rng.randint(1, 7) + " " + "t" * rng.randint(0, 5))
            elif kind < 0.25:
                lines.append(rng.choice(["```py", "~~~", "  ```", "```in``` line", "~~~~ x"]))
            elif kind < 0.4:
                lines.append("")
            elif kind < 0.45:
                lines.append("w " * rng.randint(800, 1800))
            else:
                lines.append(" " + "word " * rng.randint(1, 30))
        return "\n".join(lines)

    counts = {"one": 1, "mixed": 80, "headless": 120}
    rows = [(d, n * 2, part(d == "headless")) for d, count in counts.items() for n in range(count)]
    parts = spark.createDataFrame(rows, SCHEMA).cache()
    whole = dl.split_markdown_pages(parts, part_pages=10**6)
    spread = dl.split_markdown_pages(parts, part_pages=5)
    assert spread.count() == whole.count() > 100
    assert whole.exceptAll(spread).count() == 0 and spread.exceptAll(whole).count() == 0
    sections = dl.markdown_sections(parts, part_pages=10**6)
    split = dl.markdown_sections(parts, part_pages=5)
    text = lambda df: df.groupBy("document_id").agg(F.sum(F.length(F.translate("content", "\n", ""))).alias("n"))
    assert text(sections).exceptAll(text(split)).count() == 0
    assert split.filter("part_no > 0").count() > 0
