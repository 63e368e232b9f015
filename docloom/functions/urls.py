"""Column expressions over URLs and paths.

Spark's own ``parse_url`` rejects addresses the checks must accept (spaces, underscores in the host), so
the parts come from the generic pattern of RFC 3986, appendix B.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RFC3986 = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?"

# Leading characters an address parser skips: C0 controls and the space.
LEADING = "".join(map(chr, range(0x21)))


def _clean(url: Column) -> Column:
    return F.regexp_replace(F.ltrim(url, F.lit(LEADING)), r"[\t\r\n]", "")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(_clean(url), RFC3986, 2))


def authority(url: Column) -> Column:
    return F.regexp_extract(_clean(url), RFC3986, 4)


def path(url: Column) -> Column:
    """Path without query, fragment and the ``;parameters`` of the last segment."""
    return F.regexp_replace(F.regexp_extract(_clean(url), RFC3986, 5), r";[^/]*$", "")


def is_http(url: Column) -> Column:
    """Absolute http(s) address: a known scheme and a non-empty authority."""
    return scheme(url).isin("http", "https") & (authority(url) != "")


def _segments(p: Column) -> Column:
    return F.filter(F.split(p, "/"), lambda s: (s != "") & (s != "."))


def basename(p: Column) -> Column:
    """Last segment of a path, empty when there is none."""
    return F.coalesce(F.try_element_at(_segments(p), F.lit(-1)), F.lit(""))


def url_basename(url: Column) -> Column:
    return basename(path(url))


def is_txt(url: Column) -> Column:
    return F.lower(url_basename(url)).endswith(".txt")


def suffix(p: Column) -> Column:
    """Lower-case last suffix of the file name; a leading dot alone makes no suffix."""
    return F.lower(F.regexp_extract(basename(p), r"^.+(\.[^.]+)$", 1))


def resolve(p: Column, base_dir: str) -> Column:
    """Absolute path: absolute ones stay, relative ones go under ``base_dir``."""
    full = F.when(p.startswith("/"), p).otherwise(F.concat(F.lit(base_dir.rstrip("/") + "/"), p))
    return F.concat(F.lit("/"), F.array_join(_segments(full), "/"))


def relative_to(p: Column, base_dir: str) -> Column:
    """Path below ``base_dir``, or the path itself when it lies elsewhere."""
    prefix = base_dir.rstrip("/") + "/"
    return F.when(p.startswith(prefix), F.substring(p, len(prefix) + 1, 2**31 - 1)).otherwise(p)
