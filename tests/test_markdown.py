import pytest
from pyspark.sql import functions as F

from docloom.functions.markdown import with_sections
from docloom.operators.chunking import numbered_pieces, split_documents


def sections(spark, body):
    df = with_sections(spark.createDataFrame([(body,)], "body string"), F.col("body"))
    return [(s.section_id, s.content) for s in df.first().sections]


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        ("# Intro\n\n## Details\n\nParagraph text.", [("Intro|Details", "Paragraph text.")]),
        ("before\n# A\nx", [("", "before"), ("A", "x")]),
        ("# A\n### C\nx\n## B\ny\n# D\nz", [("A|C", "x"), ("A|B", "y"), ("D", "z")]),
        ("# A\n###### six\n#nospace\n#", [("A", "###### six\n#nospace\n#")]),
        ("# A\n```\n# no\n```\n## B\ny", [("A", "```\n# no\n```"), ("A|B", "y")]),
        ("# A\n~~~py\n# no", [("A", "~~~py\n# no")]),
        ("# A\nx\n# A\ny", [("A", "x"), ("A", "y")]),
        ("# A\n## B\n", []),
        ("# A\n\n\n  x  \n\ty\n\n\n\nz\n\n", [("A", "x\ny\n\nz")]),
        ("  ##  Spaced  \nx", [("Spaced", "x")]),
        ("", []),
    ],
)
def test_sections(spark, body, expected):
    assert sections(spark, body) == expected


def test_numbers_run_over_sections_and_no_piece_crosses_one(spark):
    body = "# A\n" + "word " * 1000 + "\n# B\nend"
    df = spark.createDataFrame([("m", "markdown", body)], "document_id string, input_format string, body string")
    rows = numbered_pieces(split_documents(df), "document_id").orderBy("i").collect()
    assert [r.i for r in rows] == list(range(len(rows)))
    assert [r.section_id for r in rows] == ["A"] * 3 + ["B"]
    assert rows[-1].content == "end" and all(len(r.content) <= 1792 for r in rows)
