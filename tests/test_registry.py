import pytest
from pyspark.sql import functions as F

import docloom as dl
from docloom.operators.landing import misplaced
from docloom.sources.registry import first_failure, read_entries

SCHEMA = "pos bigint, document_id string, document_url string, document_path string, namespace string, input_format string"
GOOD = ("doc", "https://example.com/source", "sample.md", "ns", "markdown")


def registry(spark, *entries):
    return spark.createDataFrame([(n, *e) for n, e in enumerate(entries)], SCHEMA)


def messages(spark, entry, files=None):
    return [r.message for r in dl.validate_sources(registry(spark, entry), "/b", files).orderBy("seq").collect()]


def listing_of(spark, *paths):
    return spark.createDataFrame([(p,) for p in paths] or [("/none",)], "path string")


def test_valid_entry_and_required_file(spark):
    assert messages(spark, GOOD, listing_of(spark, "/b/sample.md")) == []
    assert messages(spark, GOOD) == []
    assert messages(spark, GOOD, listing_of(spark)) == ["doc: 'document-path' does not exist: /b/sample.md"]


@pytest.mark.parametrize(
    ("fmt", "path"),
    [("pdf", "a.pdf"), ("json", "a.JSON"), ("yaml", "a.yaml"), (" YAML ", "a.yml"), ("markdown", "a.txt.md"), ("text", "a.txt")],
)
def test_suffixes_that_match(spark, fmt, path):
    assert messages(spark, ("d", "http://x", path, "n", fmt)) == []


def test_every_rule_in_order(spark):
    assert messages(spark, ("d", "ftp://invalid", "sample.md", "n", "pdf")) == [
        "d: 'document-url' must be an absolute http(s) URL; got 'ftp://invalid'",
        "d: expected a .pdf file for input-format=pdf; got sample.md",
    ]
    assert messages(spark, ("d", "http://x", "a.md", None, None)) == [
        "d: missing keys: ['input-format', 'pinecone-namespace']",
        "d: 'input-format' is required and must be a non-empty string",
        "d: 'pinecone-namespace' must be non-empty",
    ]
    assert messages(spark, ("d", " ", "", "\t", "docx")) == [
        "d: 'document-path' must be a non-empty string",
        "d: 'document-url' must be a non-empty string",
        "d: 'pinecone-namespace' must be a non-empty string",
        "d: 'input-format' must be one of ['json', 'markdown', 'pdf', 'text', 'yaml']; got 'docx'",
        "d: 'document-url' must be an absolute http(s) URL; got ' '",
        "d: 'pinecone-namespace' must be non-empty",
    ]
    assert messages(spark, ("", "x", "x", "x", "x")) == ["invalid document id: '' (must be non-empty str)"]


def test_strict_check_lists_the_issues(spark):
    bad = registry(spark, GOOD, ("d", "ftp://x", "a.md", "n", "markdown"))
    with pytest.raises(dl.InvalidSources, match=r"- d: 'document-url' must be an absolute http\(s\)"):
        dl.require_valid(bad)


def test_yaml_file(spark, tmp_path):
    file = tmp_path / "r.yaml"
    file.write_text(
        "b:\n  document-url: https://e.com/b\n  document-path: docs/b.md\n  pinecone-namespace: n\n"
        "  input-format: markdown\n  extra: 1\n"
        "a:\n  document-url: https://e.com/a\n  document-path: docs/a.txt\n  pinecone-namespace: n\n  input-format: text\n"
    )
    rows = dl.load_sources(spark, str(file)).orderBy("pos").collect()
    assert [(r.pos, r.document_id, r.input_format) for r in rows] == [(0, "b", "markdown"), (1, "a", "text")]
    file.write_text("")
    assert dl.load_sources(spark, str(file)).count() == 0
    file.write_text("- x")
    with pytest.raises(ValueError, match="mapping at the top level"):
        dl.load_sources(spark, str(file))


def test_coercion_stops_at_the_first_bad_entry(spark, tmp_path):
    file = tmp_path / "r.yaml"
    file.write_text("a: 3\n' ': {}\n5: {}\nb: {document-url: 1, document-path: p, input-format: text}\n")
    _, issues = dl.coerce_entries(read_entries(spark, str(file)))
    assert [r.rule for r in issues.orderBy("pos", "seq").collect()] == [
        "not_a_mapping", "invalid_id", "invalid_id", "not_a_string", "missing_key",
    ]
    assert [r.message for r in first_failure(issues).collect()] == ["a: entry must be a mapping of configuration values"]
    with pytest.raises(dl.InvalidSources, match="a: entry must be a mapping"):
        dl.load_sources(spark, str(file))


def test_select_look_up_upsert_remove(spark):
    two = registry(spark, GOOD, ("b", *GOOD[1:]))
    assert dl.select_sources(two, all_docs=True, single_id="b").count() == 2
    assert [r.document_id for r in dl.select_sources(two, single_id="b").collect()] == ["b"]
    with pytest.raises(KeyError):
        dl.select_sources(two, single_id="nope")
    with pytest.raises(ValueError):
        dl.select_sources(two)
    known, unknown = dl.look_up(two, spark.createDataFrame([("b",), ("x",)], "document_id string"))
    assert (known.count(), [r[0] for r in unknown.collect()]) == (1, ["x"])

    changed = dl.upsert_sources(two, registry(spark, ("new", *GOOD[1:]), ("doc", "https://n", *GOOD[2:])))
    assert [(r.pos, r.document_id, r.document_url) for r in changed.orderBy("pos").collect()] == [
        (0, "doc", "https://n"), (1, "b", GOOD[1]), (2, "new", GOOD[1]),
    ]
    with pytest.raises(ValueError):
        dl.upsert_sources(two, registry(spark, ("", *GOOD[1:])))
    left = dl.remove_sources(two, spark.createDataFrame([("doc",)], "document_id string"))
    assert [r.document_id for r in left.collect()] == ["b"]
    with pytest.raises(KeyError):
        dl.remove_sources(two, spark.createDataFrame([("x",)], "document_id string"))


def test_save_and_read_back(spark, tmp_path):
    two = registry(spark, GOOD, ("b", *GOOD[1:]))
    path = str(tmp_path / "saved")
    dl.save_sources(two, path, dl.validate_sources(two))
    assert dl.read_sources(spark, path).orderBy("pos").collect() == two.orderBy("pos").collect()
    bad = registry(spark, ("b", "ftp://x", *GOOD[2:]))
    with pytest.raises(dl.InvalidSources):
        dl.save_sources(bad, path, dl.validate_sources(bad))
    assert dl.read_sources(spark, path).count() == 2


def test_listing(spark):
    table = dl.listing(registry(spark, ("z", "https://u", "/b/docs/z.md", "n", "markdown"), ("doc", "https://url", "docs/doc.md", "n", "markdown"), ("y", "https://u", "/else/y.md", "n", "markdown")), "/b")
    assert [(r.Document, r.Path) for r in table.collect()] == [("doc", "docs/doc.md"), ("y", "/else/y.md"), ("z", "docs/z.md")]
    lines = [r.line for r in dl.padded(table).collect()]
    assert lines[0] == "Document | Format   | Namespace | Path        | URL        "
    assert lines[1] == "doc      | markdown | n         | docs/doc.md | https://url"
    assert [x.split()[0] for x in lines] == ["Document", "doc", "y", "z"]
    empty = dl.listing(spark.createDataFrame([], SCHEMA), "/b")
    assert [r.line for r in dl.padded(empty).collect()] == ["No documents configured."]
    assert dl.widths(empty.select("Document")).first()[0] == len("Document")
    assert [r.line for r in dl.tabbed(registry(spark, GOOD)).collect()] == ["doc\tmarkdown\thttps://example.com/source"]


def pages_of(spark, *rows):
    return spark.createDataFrame(list(rows), "url string, content binary, headers map<string,string>")


def test_landing(spark):
    sources = registry(
        spark,
        ("sample", "https://e.com/api", "docs/other.txt", "n", "text"),
        ("raw", "https://e.com/x.txt", "docs/raw.txt", "n", "text"),
        ("md", "https://e.com/m", "docs/m.md", "n", "markdown"),
        ("ftp", "ftp://e.com/m", "docs/f.md", "n", "markdown"),
        ("gone", "https://e.com/gone", "docs/g.md", "n", "markdown"),
        ("odd", "https://e.com/odd", "docs/odd.txt", "n", "text"),
    )
    html = b"<html><body><h1>Title</h1><p>Body caf\xe9</p></body></html>"
    pages = pages_of(
        spark,
        ("https://e.com/api", html, {"Content-Type": "text/html; charset=latin-1"}),
        ("https://e.com/x.txt", b"raw <b>\xff", {}),
        ("https://e.com/m", b"binary-data\r\n", None),
        ("https://e.com/odd", html, {"content-type": "text/html; charset=none-such"}),
    )
    landed = dl.land_pages(pages, sources, "/b")
    rows = {r.document_id: r for r in landed.collect()}
    assert rows["sample"].target == "/b/docs/sample.txt" and bytes(rows["sample"].content).decode() == "Title Body café"
    assert rows["raw"].target == "/b/docs/raw.txt" and bytes(rows["raw"].content) == b"raw <b>\xff"
    assert bytes(rows["md"].content) == b"binary-data\r\n"
    assert {k: r.error for k, r in rows.items() if r.error} == {
        "ftp": "URL must start with http(s)", "gone": "download failed", "odd": "unknown charset",
    }
    assert tuple(dl.run_status(landed).first()) == (6, 3, 3)
    assert [r.document_id for r in misplaced(sources, "/b").collect()] == ["sample"]


def test_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.txt").write_bytes("é\r\nb".encode())
    (tmp_path / "bad.txt").write_bytes(b"\xff")
    listed = dl.list_files(spark, str(tmp_path))
    assert {r.path: r.length for r in listed.collect()} == {f"{tmp_path}/d/a.txt": 5, f"{tmp_path}/bad.txt": 1}
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    assert {r.path[-5:]: r.body for r in dl.read_bodies(spark, str(tmp_path)).collect()} == {"a.txt": "é\nb", "d.txt": None}
    sources = registry(spark, ("a", "https://u", "d/a.txt", "n", "text"), ("c", "https://u", "d/c.txt", "n", "text"))
    missing = dl.missing_bodies(sources, listed, str(tmp_path)).select(F.col("document_id"))
    assert [r[0] for r in missing.collect()] == ["c"]
