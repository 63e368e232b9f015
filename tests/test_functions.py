import pytest
from pyspark.sql import functions as F

from docloom.functions import html, text, urls
from docloom.sources.files import decode_strict


def test_strip_equals_python_for_every_character(spark):
    df = spark.range(1, 0x10000).filter("id < 55296 or id > 57343").select("id", F.chr("id").alias("_"))
    points = [r.id for r in df.collect()]
    rows = spark.createDataFrame([(p, f"{chr(p)}a{chr(p)}") for p in points], "p int, t string")
    kept = {r.p for r in rows.select("p", text.strip(F.col("t")).alias("s")).filter("s != 'a'").collect()}
    assert kept == {p for p in points if not chr(p).isspace()}


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("a\r\nb\rc", "a\nb\nc"),
        ("a\t\x0b\x0c\tb", "a b"),
        ("x \n\n y", "x\n y"),
        ("a\n\n\n\nb", "a\n\nb"),
        ("a    b", "a b"),
        ("  a ", "a"),
    ],
)
def test_normalize_whitespace(one, raw, expected):
    assert one(text.normalize_whitespace(F.col("t")), "t string", raw) == expected


def test_truncate(one):
    assert one(text.truncate(F.col("t"), 5), "t string", "abcde") == "abcde"
    assert one(text.truncate(F.col("t"), 5), "t string", "abcdef") == "ab..."
    assert len(one(text.truncate(F.col("t")), "t string", "x" * 501)) == 500


@pytest.mark.parametrize(
    ("titles", "expected"),
    [
        ({"Header_2": "Second", "Header_1": "Intro"}, "Intro|Second"),
        ({"Header_1": " a ", "Header_2": "", "Header_3": "  "}, "a|"),
        ({"x": "last", "Header_9": "n", "Header_11": "after"}, "n|last|after"),
        ({}, ""),
    ],
)
def test_section_id(one, titles, expected):
    assert one(text.section_id(F.col("m")), "m map<string,string>", titles) == expected


PAGES = [
    "<html><body><h1>Title</h1><p>Body</p></body></html>",
    "a<b>b</b>c",
    "&amp;lt; and &amp;amp;lt;",
    "<p>x&nbsp;</p>y",
    "<script>var t='</p>';</script>z<style>p{}</style>",
    "<!-- a > b <script> -->c",
    "<p>tail &am",
    "<a title='a>b'>q</a>",
    "1 < 2 <b>3</b>",
    "<p>&eacute;&copy;&#8364;&ampx</p>",
    "<!DOCTYPE html><title>t</title><p>a\r\nb\tc",
    "<SCRIPT>x</SCRIPT >y<Style>z</STYLE>",
    "<![CDATA[x]]>y",
    "<script>never closed",
    "<p unclosed",
    "",
]


def test_html_is_what_the_parser_shows(spark):
    rows = [(page, html.visible_text(page)) for page in PAGES]
    shown = html.with_text(spark.createDataFrame(rows, "p string, shown string"), F.col("p"))
    for row in shown.withColumn("shown", text.normalize_whitespace(F.col("shown"))).collect():
        assert row.text == row.shown, row.p


def test_html_golden(spark):
    page = "<h1>T</h1><script>x</script><p>a &amp;lt; b</p>\n\n\n<!-- c --><i>d</i>"
    assert html.with_text(spark.createDataFrame([(page,)], "p string"), F.col("p")).first().text == "T a < b d"


def test_charset(one):
    for value, expected in (
        ("text/html; charset=utf-8", "utf-8"),
        ("a; CHARSET=ISO-8859-1; charset=x", "ISO-8859-1"),
        ("text/html", "utf-8"),
        (None, "utf-8"),
    ):
        assert one(html.charset(F.col("c")), "c string", value) == expected


def test_decode_leaves_out_bad_bytes(spark):
    rows = [(b"caf\xe9", "latin-1", "café"), (b"a\xff\xc3b", "utf-8", "ab"), ("é".encode(), "UTF-8", "é"), (b"x", "nope", None)]
    df = spark.createDataFrame(rows, "b binary, c string, e string")
    assert all(r.d == r.e for r in df.select("e", html.decode_body(F.col("b"), F.col("c")).alias("d")).collect())


def test_strict_decoding_and_line_ends(one):
    assert one(decode_strict(F.col("b")), "b binary", b"a\r\nb\rc") == "a\nb\nc"
    assert one(decode_strict(F.col("b")), "b binary", b"a\xff") is None


def test_header_names_are_lower_case(one):
    assert one(html.lower_keys(F.col("m")), "m map<string,string>", {"Content-Type": "x", "ETag": "y"}) == {
        "content-type": "x",
        "etag": "y",
    }


@pytest.mark.parametrize(
    ("url", "http", "base", "txt"),
    [
        ("https://example.com/source", True, "source", False),
        ("HTTP://User@Host:80/a/B.TXT?x=1#y", True, "B.TXT", True),
        ("http://h/a b/c d.txt", True, "c d.txt", True),
        ("http://h/dir/", True, "dir", False),
        ("http://h", True, "", False),
        ("http:///x", False, "x", False),
        ("ftp://invalid", False, "", False),
        ("//h/x.txt", False, "x.txt", True),
        ("http://a_b/x.txt;v=1", True, "x.txt", True),
        ("  http://h/x", True, "x", False),
        ("plain.txt", False, "plain.txt", True),
    ],
)
def test_urls(spark, url, http, base, txt):
    c = F.col("u")
    row = spark.createDataFrame([(url,)], "u string").select(
        urls.is_http(c).alias("http"), urls.url_basename(c).alias("base"), urls.is_txt(c).alias("txt")
    )
    assert tuple(row.first()) == (http, base, txt)


@pytest.mark.parametrize(
    ("path", "full", "suffix"),
    [
        ("docs/a.MD", "/b/docs/a.MD", ".md"),
        ("/abs/x.txt.md", "/abs/x.txt.md", ".md"),
        ("./a//b/./c.tar.gz", "/b/a/b/c.tar.gz", ".gz"),
        ("docs/.txt", "/b/docs/.txt", ""),
        ("docs/none", "/b/docs/none", ""),
    ],
)
def test_paths(spark, path, full, suffix):
    resolved = urls.resolve(F.col("p"), "/b/")
    row = spark.createDataFrame([(path,)], "p string").select(resolved.alias("r"), urls.suffix(resolved).alias("s"))
    assert tuple(row.first()) == (full, suffix)


def test_sql_functions(spark):
    from docloom.functions.sql import register

    register(spark)
    spark.createDataFrame([("a", "w " * 1000), ("b", None)], "id string, body string").createOrReplaceTempView("bodies_v")
    rows = spark.sql("SELECT id, i, length(content) AS n FROM bodies_v, LATERAL split_text(body) ORDER BY i").collect()
    assert [(r.id, r.i) for r in rows] == [("a", 0), ("a", 1)] and all(r.n <= 1792 for r in rows)
    spark.createDataFrame([('{"a": 1}',), ("{x",), ("b: 2",)], "body string").createOrReplaceTempView("nested_v")
    found = {tuple(r) for r in spark.sql("SELECT body, content FROM nested_v, LATERAL split_json(body)").collect()}
    assert ('{"a": 1}', '{"a":1}') in found and ("{x", None) in found
    found = {tuple(r) for r in spark.sql("SELECT body, content FROM nested_v, LATERAL split_yaml(body)").collect()}
    assert ("b: 2", '{"b":2}') in found
    assert spark.sql("SELECT html_text('<b>x</b>y') AS t").first().t == "x y"
