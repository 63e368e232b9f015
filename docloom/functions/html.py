"""Landed web pages to plain text.

The common case is a chain of built-in expressions. Pages the chain cannot render exactly (references
outside the short list below, a ``>`` inside a quoted attribute, unclosed markup, declarations) are found
by `needs_parser` and go through the standard HTML parser instead, in the same pass.
"""

from __future__ import annotations

import html as _html
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.text import normalize_whitespace, once, strip

# References the chain knows, in an order that unescapes each place once (& comes last).
ENTITIES = (
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&nbsp;", " "),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&amp;", "&"),
)

# Fixed patterns. Whatever MARKUP matches becomes a mark between text fragments.
MARK = "\x01"
MARKUP = (
    r"(?is)<script\b[^>]*>.*?</script\s*>"
    r"|<style\b[^>]*>.*?</style\s*>"
    r"|<!--.*?-->"
    r"|<[/!a-z][^>]*>"
)

# Pages to hand to the parser, seen in the raw page. Alternatives share their first character, since the
# matcher tries each of them at every position.
HARD_PAGE = (
    # `>` within a quoted attribute value
    r"""=\s*(?:"[^"<>]*>|'[^'<>]*>)"""
    + r"|<(?:"
    # elements whose content is read as plain text, marked sections, odd comments
    + r"(?i:textarea|xmp|iframe|noembed|noframes|plaintext|noscript|svg|math)\b|!\[|!---?>"
    # markup in a title, script and style blocks that never close
    + r"|(?i:title)\b[^>]*>[^<]*<(?!/(?i:title))"
    + r"|(?i:script)\b(?!(?is:.*?</script\s*>))|(?i:style)\b(?!(?is:.*?</style\s*>)))"
)
# An open reference among the last characters, which the parser never gives out.
OPEN_END = r"&[^\s;<]*\z"
OPEN_END_CHARS = 40
# Seen in what is left without markup: a reference outside the list, one that only appears after the first
# unescaping. (A `<` is looked for separately: unclosed markup, or a place where the parser cuts the text.)
HARD_TEXT = r"&(?:(?!(?:copy|middot|nbsp|quot|#39|lt|gt|amp);)#?[a-zA-Z0-9]|amp;(?!amp;)#?[a-zA-Z0-9])"


def unescape(c: Column) -> Column:
    """One pass over the known references."""
    for name, char in ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def _without_markup(page: Column) -> Column:
    return F.regexp_replace(page, MARKUP, MARK)


def needs_parser(page: Column, bare: Column) -> Column:
    """True where the chain of built-in expressions could differ from the parser."""
    return (
        page.contains(MARK)
        | page.contains("--!>")
        | bare.contains("<")
        | F.right(page, F.lit(OPEN_END_CHARS)).rlike(OPEN_END)
        | (bare.contains("&") & bare.rlike(HARD_TEXT))
        | page.rlike(HARD_PAGE)
    )


def _chain(bare: Column) -> Column:
    fragments = F.transform(F.split(unescape(bare), MARK), strip)
    return unescape(F.array_join(F.filter(fragments, lambda f: f != ""), " "))


def visible_text(page: str) -> str:
    """Text outside script and style, each run of it stripped, apart by a space, references unescaped once more.

    The parser itself knows which element's raw content it is in. It is not closed: what it still holds back at
    the end of the page is left out.
    """
    parser, seen = HTMLParser(), []
    parser.handle_data = lambda run: seen.append("" if parser.cdata_elem in ("script", "style") else run.strip())
    parser.feed(page)
    return _html.unescape(" ".join(run for run in seen if run))


@F.arrow_udf(T.StringType())
def parsed_text(pages: pa.Array) -> pa.Array:
    return pa.array([None if p is None else visible_text(p) for p in pages.to_pylist()], pa.string())


def with_text(df: DataFrame, page: Column, out: str = "text") -> DataFrame:
    """Add the plain text of a page. The parser sees null for every page the built-in chain renders exactly."""
    bare = once(df, "_bare", _without_markup(page))
    hard = parsed_text(F.when(needs_parser(page, F.col("_bare")), page))
    rendered = bare.withColumn(out, normalize_whitespace(F.coalesce(hard, _chain(F.col("_bare")))))
    return rendered.drop("_bare")


def charset(content_type: Column) -> Column:
    """First ``charset=`` of a content type, ``utf-8`` when there is none."""
    found = F.regexp_extract(content_type, r"(?i)charset=([\w.-]+)", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("utf-8"))


@F.arrow_udf(T.StringType())
def decode_ignore(contents: pa.Array, charsets: pa.Array) -> pa.Array:
    """Bytes to text, leaving out what cannot be decoded. An unknown charset gives null."""

    def decode(content, name):
        try:
            return content.decode(name or "utf-8", errors="ignore")
        except LookupError:
            return None

    rows = zip(contents.to_pylist(), charsets.to_pylist())
    return pa.array([None if c is None else decode(c, n) for c, n in rows], pa.string())


def decode_body(content: Column, name: Column) -> Column:
    """Bytes to text. Clean UTF-8 is cast in the JVM; only the rest goes to `decode_ignore`."""
    clean = F.lower(name).isin("utf-8", "utf8") & F.is_valid_utf8(content.cast("string"))
    return F.coalesce(decode_ignore(F.when(~clean, content), name), F.when(clean, content.cast("string")))


def lower_keys(headers: Column) -> Column:
    """Header names in lower case; of names that then coincide the last one stays."""
    pairs = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"]))
    last = lambda e, i: ~F.exists(
        F.slice(pairs, i + F.lit(2), F.size(pairs)), lambda later: later["key"] == e["key"]
    )
    return F.map_from_entries(F.filter(pairs, last))
