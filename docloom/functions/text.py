"""Column expressions over text. All of them run in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.constants import TRUNCATE_AT, WHITESPACE


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is evaluated once per row.

    A plain projection over a Python function is inlined into each later use, which would evaluate the
    expression several times; a one-element generator stays a step of its own.
    """
    return df.select("*", F.explode(F.array(F.struct(value.alias(name)))).alias("_o")).select(
        *df.columns, F.col("_o")[name].alias(name)
    )


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends (Spark's plain ``trim`` removes spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def unix_newlines(c: Column) -> Column:
    """Turn CRLF and lone CR into LF."""
    return F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def _where_found(c: Column, marks: tuple[str, ...], pattern: str, by: str) -> Column:
    """Replace ``pattern``, skipping texts that hold none of ``marks``, which most texts do not.

    The lambda names the text, so that it is computed once and not again in each branch.
    """

    def replaced(t):
        found = reduce(Column.__or__, [t.contains(m) for m in marks])
        return F.when(found, F.regexp_replace(t, pattern, by)).otherwise(t)

    return F.transform(F.array(c), replaced)[0]


def normalize_whitespace(c: Column) -> Column:
    """Collapse white space; the order of the steps matters.

    A space before newlines swallows all but one of them, while a newline followed by a space stays.
    ``\\x0B`` is spelled out because ``\\v`` means every vertical space in Java patterns.
    """
    c = unix_newlines(c)
    c = _where_found(c, ("\t", "\f", "\x0b"), r"[\t\f\x0B]+", " ")
    c = _where_found(c, (" \n",), r" \n+", "\n")
    c = _where_found(c, ("\n\n\n",), r"\n{3,}", "\n\n")
    c = _where_found(c, ("  ",), r" {2,}", " ")
    return strip(c)


def worded(wording: str, *values: Column) -> Column:
    """``wording`` with a value at each ``{}``."""
    first, *others = wording.split("{}")
    parts = [F.lit(first)]
    for value, text in zip(values, others, strict=True):
        parts += [value, F.lit(text)]
    return F.concat(*parts)


def quoted(c: Column) -> Column:
    """A string as Python shows it: in double quotes if it has single ones only, control characters escaped."""
    shown = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    control = shown
    for code in [*range(32), *range(127, 161), 173]:
        control = F.replace(control, F.lit(chr(code)), F.lit(repr(chr(code))[1:-1]))
    shown = F.when(c.rlike(r"[\x00-\x1f\x7f-\xa0\xad]"), control).otherwise(shown)
    single = F.concat(F.lit("'"), F.replace(shown, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(c.contains("'") & ~c.contains('"'), F.concat(F.lit('"'), shown, F.lit('"'))).otherwise(single)


def truncate(c: Column, limit: int = TRUNCATE_AT) -> Column:
    """Cut to ``limit`` characters, the last three being dots when something was cut."""
    cut = F.concat(F.substring(c, 1, limit - 3), F.lit("..."))
    return F.when(F.length(c) <= limit, c).otherwise(cut)


def section_id(titles: Column, sep: str = "|") -> Column:
    """Join a map such as ``{Header_2: b, Header_1: a}`` into ``a|b``.

    Empty titles are left out; a title of white space only stays as an empty segment. Keys are ordered by
    their trailing number, keys without one count as 10, and ties keep the order of the map.
    """
    kept = F.map_entries(F.map_filter(titles, lambda k, v: v.isNotNull() & (v != "")))
    trailing = lambda k: F.regexp_extract(k, r"(\d+)$", 1)
    ranked = F.transform(
        kept,
        lambda e, i: F.struct(
            F.when(trailing(e["key"]) == "", F.lit(10).cast("bigint"))
            .otherwise(trailing(e["key"]).try_cast("bigint"))
            .alias("level"),
            i.alias("pos"),
            strip(e["value"]).alias("title"),
        ),
    )
    return F.array_join(F.transform(F.array_sort(ranked), lambda e: e["title"]), sep)


def pad(c: Column, width: Column) -> Column:
    """Fill with spaces on the right up to ``width``; longer values stay whole."""
    return F.rpad(c, F.greatest(width, F.length(c)), F.lit(" "))
