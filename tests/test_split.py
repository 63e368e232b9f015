import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.functions import split
from docloom.functions.split import pieces_of, split_text


def brute(text, limit, overlap, separators=("\n\n", "\n", " ", "")):
    """The contract written with lists of strings, as a check of the offsets arithmetic."""
    sep, rest = next((s, separators[n + 1 :]) for n, s in enumerate(separators) if s == "" or s in text[len(s) and 1 :])
    if sep:
        first, *others = text.split(sep)
        parts = [first] * (first != "") + [sep + o for o in others]
    else:
        parts = list(text)
    out, window = [], []

    def flush():
        if "".join(window).strip():
            out.append("".join(window).strip())

    for part in parts:
        if len(part) > limit:
            if window:
                flush()
            window = []
            out += brute(part, limit, overlap, rest)
            continue
        if window and sum(map(len, window)) + len(part) > limit:
            flush()
            while window and (sum(map(len, window)) > overlap or sum(map(len, window)) + len(part) > limit):
                window.pop(0)
        window.append(part)
    if window:
        flush()
    return out


texts = st.text(alphabet=st.sampled_from("ab c\n\n  é😀\t"), max_size=160)
words = st.lists(st.sampled_from(["a", "bb", "ccccc", "\n", "\n\n", " ", "d" * 30, "\n\n\n"]), max_size=60).map("".join)


@settings(max_examples=400, deadline=None)
@given(texts | words, st.integers(2, 40), st.integers(0, 39))
def test_same_as_brute_force(text, limit, overlap):
    overlap = min(overlap, limit - 1)
    found = split_text(text, limit, overlap)
    assert [c for _, _, c in found] == (brute(text, limit, overlap) if text else [])
    covered, last = set(), (-1, -1)
    for start, end, content in found:
        assert text[start:end] == content and 0 < len(content) <= limit and content == content.strip()
        assert start >= last[0] and end >= last[1]
        last = start, end
        covered.update(range(start, end))
    assert all(i in covered for i, c in enumerate(text) if not c.isspace())
    for (_, end, _), (start, _, _) in zip(found, found[1:]):
        assert end - start <= overlap


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("", []),
        (" \n\n \t", []),
        ("\n" * 4000, []),
        ("x" * 1792, [(0, 1792)]),
        ("x" * 1793, [(0, 1792), (1664, 1793)]),
        ("y" * 5000, [(0, 1792), (1664, 3456), (3328, 5000)]),
        ("😀" * 1793, [(0, 1792), (1664, 1793)]),
    ],
)
def test_edges(text, expected):
    assert [(s, e) for s, e, _ in split_text(text)] == expected


def test_lines_of_99_characters_step_by_16():
    text = "\n".join("x" * 99 for _ in range(40))
    assert [(s // 100, (e + 1) // 100) for s, e, _ in split_text(text)] == [(0, 17), (16, 33), (32, 40)]


def test_long_stretch_ends_the_piece_before_it_without_overlap():
    text = "a b\n\n" + "c" * 30 + "\n\nd"
    assert [c for _, _, c in split_text(text, 20, 5)] == ["a b", "c" * 19, "c" * 16, "d"]


@pytest.mark.parametrize("overlap", [1792, 2000, -1])
def test_overlap_must_be_smaller_than_the_limit(spark, overlap):
    with pytest.raises(ValueError):
        pieces_of(F.col("t"), 1792, overlap)


def test_column_form_agrees_for_short_and_long_bodies(spark):
    bodies = ["", "  ", " a ", "w " * 3000, "x" * 1792, "　" * 1000 + "x" * 900, None]
    df = spark.createDataFrame(list(enumerate(bodies)), "n int, t string").select("n", pieces_of(F.col("t")).alias("p"))
    for row in df.collect():
        got = [(p.start, p.end, p.content) for p in row.p]
        assert got == (split_text(bodies[row.n]) if bodies[row.n] is not None else [])


def test_short_bodies_do_not_cross_to_python(spark):
    df = spark.createDataFrame([("a",)], "t string").select(pieces_of(F.col("t")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ArrowEvalPython \[split_long\(CASE WHEN \(length\(t", plan)


def test_batches_are_split_in_slices():
    sizes = []

    def lengths(texts, marks):
        sizes.append(texts.nbytes)
        assert marks.to_pylist() == [t and t[:1] for t in texts.to_pylist()]
        return pa.array([[len(t)] if t is not None else None for t in texts.to_pylist()], pa.list_(pa.int64()))

    texts = [None if i % 7 == 0 else chr(97 + i % 26) * (i % 5000) for i in range(3000)]
    marks = [t and t[:1] for t in texts]
    got = split.in_blocks(lengths, pa.array(texts, pa.string()), pa.array(marks, pa.string()))
    assert got.to_pylist() == [None if t is None else [len(t)] for t in texts]
    assert len(sizes) > 3 and max(sizes) < 2 * split.BLOCK_BYTES
    assert split.in_blocks(lengths, pa.array([], pa.string()), pa.array([], pa.string())).to_pylist() == []
