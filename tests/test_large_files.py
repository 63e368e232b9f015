"""Files read by byte ranges give the pieces of the whole text."""

import random
import re

import pytest

import docloom as dl
from docloom.functions.split import split_text
from docloom.operators import large_files
from docloom.operators.large_files import read_large
from docloom.plans import pipeline
from docloom.session import pinned


def text(rng, end):
    out = []
    for _ in range(rng.randint(1, 120)):
        kind = rng.random()
        out.append("é" * rng.randint(0, 40) if kind < 0.3 else " ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(1, 60))))
        out.append(end * rng.choice([1, 1, 2, 2, 3, 4, 5]) if kind < 0.9 else rng.choice(["\r", "\n", "\r\n"]) * 2)
    return "".join(out[: rng.choice([-1, len(out)])])


@pytest.fixture
def folder(spark, tmp_path):
    rng = random.Random(3)
    texts = {f"{i}.txt": text(rng, rng.choice(["\n", "\r\n"])) for i in range(24)}
    texts |= {"mark.txt": "﻿after the mark\n\nmore", "a b+c%.txt": "name\n\nwith signs " * 300, "ends.txt": "one " * 600 + "\n\n"}
    for name, body in texts.items():
        (tmp_path / name).write_bytes(body.encode())
    (tmp_path / "bad.txt").write_bytes(b"good line\n\n" * 50 + b"\xff\xfe\n\nmore")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    yield tmp_path, texts
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("part_bytes", [300, 1 << 22])
def test_pieces_of_files_read_by_ranges(spark, folder, part_bytes):
    path, texts = folder
    large = read_large(spark, str(path), larger_than=0, part_bytes=part_bytes)
    assert [(r.document_id.rsplit("/", 1)[1], r.error) for r in large.errors.collect()] == [("bad.txt", "body is missing or not valid UTF-8")]
    bodies = {}
    for r in large.parts.orderBy("document_id", "part_no").collect():
        bodies.setdefault(r.document_id.rsplit("/", 1)[1], []).append(r.body)
    unix = {n: t.replace("\r\n", "\n").replace("\r", "\n") for n, t in texts.items()}
    assert {n: "\n\n".join(b) for n, b in bodies.items()} == {n: t for n, t in unix.items() if t}
    assert max(map(len, bodies.values())) > 4
    got = {}
    for r in large.pieces().orderBy("document_id", "i").collect():
        got.setdefault(r.document_id.rsplit("/", 1)[1], []).append((r.start, r.end, r.content))
    assert got == {n: p for n, t in unix.items() if (p := split_text(t))}


def test_markdown_of_files_read_by_ranges(spark, tmp_path):
    rng = random.Random(4)
    lines = ["# A", "## B", "```", "~~~", "", "", "text of some words", "- list"]
    body = "\n".join(rng.choice(lines) + (" " + "w" * rng.randint(1, 200) if rng.random() < 0.5 else "") for _ in range(800))
    (tmp_path / "a.md").write_text(body)
    large = read_large(spark, str(tmp_path), larger_than=0, part_bytes=2000)
    assert large.parts.count() > 5
    got = large.markdown_pieces().select("section_id", "i", "start", "end", "content")
    whole = spark.createDataFrame([("a", 0, body)], "document_id string, page_no int, page_text string")
    want = dl.split_markdown_pages(whole).select(got.columns)
    assert got.count() == want.count() > 20
    assert got.exceptAll(want).count() == 0


def test_files_of_any_size_are_chunked_and_reported(spark, tmp_path):
    bodies = {
        "s.txt": "small", "l.txt": "one two three\n\n" * 300, "s.md": "# A\ntext", "l.md": "# A\n" + "some text of it\n\n" * 300 + "## B\nend",
        "l.json": '{"a": "' + "x" * 300 + '"}', "s.json": '{"a": 1}', "bad.txt": None,
    }
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(b"\xff" * 300 if body is None else body.encode())
    formats = {"txt": "text", "md": "markdown", "json": "json"}
    rows = [(i, n, "https://u", n, "ns", formats[n.split(".")[1]]) for i, n in enumerate([*bodies, "gone.txt"])]
    sources = spark.createDataFrame(rows, "pos long, document_id string, document_url string, document_path string, namespace string, input_format string")
    chunked = pipeline.chunk_files(spark, str(tmp_path), sources, "2024-01-01", str(tmp_path), largest=100)
    got = {r.document_id: (r.outcome, r.n_chunks, r.error) for r in pipeline.report(sources, chunked.stored()).collect()}
    whole = dl.chunk_documents(spark.createDataFrame([(n, b) for n, b in bodies.items() if b and n != "l.json"], "document_id string, body string"), sources, "2024-01-01").chunks
    want = {n: ("chunked", c, None) for n, c in whole.groupBy("document_id").count().collect()}
    want |= {"l.json": ("quarantined", 0, "file has 309 bytes"), "bad.txt": ("quarantined", 0, "body is missing or not valid UTF-8"), "gone.txt": ("missing", 0, "no body")}
    assert got == want and got["l.txt"][1] > 2
    same = lambda df: sorted(map(tuple, df.select("_id", "chunk_content", "chunk_section_id").collect()))
    assert same(chunked.chunks) == same(whole)


def test_only_larger_files_are_read(spark, tmp_path):
    (tmp_path / "small.txt").write_text("small")
    (tmp_path / "large.txt").write_text("large " * 10)
    assert [r.body for r in read_large(spark, str(tmp_path), larger_than=50).parts.collect()] == ["large " * 10]
    none = read_large(spark, str(tmp_path), larger_than=500)
    assert none.pieces().count() == none.markdown_pieces().count() == none.errors.count() == 0


@pytest.mark.parametrize("range_bytes, several", [(2000, True), (1 << 27, False)])
def test_lines_stay_in_the_task_that_reads_them(spark, folder, monkeypatch, capsys, range_bytes, several):
    moved, gathered = [], []

    def seen(df):
        df.explain("formatted")
        moved.extend(re.findall(r"\) Exchange\nInput \[\d+\]: \[.*\b(?:raw|text|body|value)#.*", capsys.readouterr().out))
        stored = pinned(df)
        if "raw" in df.columns:
            gathered.append(stored.count())
        return stored

    monkeypatch.setattr(large_files, "pinned", seen)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    large = read_large(spark, str(folder[0]), larger_than=0, part_bytes=300)
    assert large.parts.count() > 50
    assert moved == []
    # of files with several ranges, the ends of these
    assert len(gathered) == 1 and (gathered[0] > 0) == several


def test_a_paragraph_that_is_too_long_over_ranges_is_an_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(large_files, "LONGEST", 3000)
    (tmp_path / "lines.txt").write_bytes(b"start\n\n" + b"some words\n" * 600 + b"\nend\n\n" * 9)
    (tmp_path / "line.txt").write_bytes(b"start\n\n" + b"w" * 4000 + b"\n\nend")
    (tmp_path / "good.txt").write_bytes(b"some words\n\n" * 600)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for limit in ("1000", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
            large = read_large(spark, str(tmp_path), larger_than=0, part_bytes=100)
            assert {(r.document_id.rsplit("/", 1)[1], r.error.rsplit(" ", 2)[0]) for r in large.errors.collect()} == {
                ("lines.txt", "file has a paragraph of"), ("line.txt", "file has a paragraph of")
            }
            assert [r.document_id.rsplit("/", 1)[1] for r in large.parts.select("document_id").distinct().collect()] == ["good.txt"]
            bodies = [r.body for r in large.parts.orderBy("part_no").collect()]
            assert "\n\n".join(bodies) == "some words\n\n" * 600
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
