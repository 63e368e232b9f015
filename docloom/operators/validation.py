"""Checks of registry entries: every problem becomes a row, in the order of entries and rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.constants import FORMAT_SUFFIXES, FORMATS, REGISTRY_KEYS, WORDING
from docloom.functions import urls
from docloom.functions.text import quoted, strip, worded
from docloom.sources.registry import InvalidSources


def _issue(when: Column, rule: str, wording: str, *values: Column) -> Column:
    """The problem of an entry, or null."""
    message = F.concat(F.col("document_id"), F.lit(": "), worded(WORDING[wording], *values))
    return F.when(when, F.struct(F.lit(rule).alias("rule"), message.alias("message")))


def _value(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def required_strings() -> list[Column]:
    """Keys that are missing, named in one sorted list, then keys that are there but blank, sorted."""
    keys = sorted(REGISTRY_KEYS)
    present = F.array_compact(F.array(*[F.when(F.col(REGISTRY_KEYS[k]).isNotNull(), F.lit(k)) for k in keys]))
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, keys)), present))
    listed = F.array_join(F.transform(missing, quoted), ", ")
    found = [_issue(F.size(missing) > 0, "missing_keys", "missing_keys", listed)]
    for key in keys:
        column = REGISTRY_KEYS[key]
        blank = F.col(column).isNotNull() & (strip(F.col(column)) == "")
        found.append(_issue(blank, f"blank_{column}", "blank", F.lit(key)))
    return found


def input_format() -> list[Column]:
    fmt = strip(_value("input_format"))
    unknown = (fmt != "") & ~F.lower(fmt).isin(*FORMATS)
    return [
        _issue(fmt == "", "format_required", "format_required"),
        _issue(unknown, "format_unknown", "format_unknown", quoted(_value("input_format"))),
    ]


def url_field() -> list[Column]:
    url = _value("document_url")
    return [_issue((url != "") & ~urls.is_http(url), "url_not_http", "url_not_http", quoted(url))]


def path_and_suffix(resolved: Column, exists: Column) -> list[Column]:
    """File presence, and the suffix the format asks for (skipped for an unknown format)."""
    given = _value("document_path") != ""
    fmt = F.lower(strip(_value("input_format")))
    found = [_issue(given & ~exists, "path_missing", "path_missing", resolved)]
    for name, allowed in FORMAT_SUFFIXES.items():
        wrong = given & (fmt == name) & ~urls.suffix(resolved).isin(*allowed)
        found.append(_issue(wrong, "suffix_mismatch", f"suffix_{name}", urls.basename(resolved)))
    return found


def namespace_field() -> list[Column]:
    return [_issue(strip(_value("namespace")) == "", "namespace_required", "namespace_required")]


def with_issues(sources: DataFrame, base_dir: str = "/", files: DataFrame | None = None) -> DataFrame:
    """Add ``issues``, the ordered array of ``(rule, message)`` of each entry.

    ``files(path)`` turns the presence check on. It is a join on the path: nothing is gathered per entry,
    since all rules of an entry are evaluated in its row.
    """
    df = sources.withColumn("_path", urls.resolve(_value("document_path"), base_dir))
    if files is None:
        df = df.withColumn("_exists", F.lit(True))
    else:
        present = files.select(F.col("path").alias("_path")).distinct().withColumn("_there", F.lit(True))
        df = df.join(present, "_path", "left").withColumn("_exists", F.coalesce("_there", F.lit(False)))
    rules = F.array_compact(
        F.array(
            *required_strings(),
            *input_format(),
            *url_field(),
            *path_and_suffix(F.col("_path"), F.col("_exists")),
            *namespace_field(),
        )
    )
    no_id = F.col("document_id") == ""
    bad_id = F.struct(
        F.lit("invalid_id").alias("rule"),
        F.lit(WORDING["empty_id"]).alias("message"),
    )
    return df.withColumn("issues", F.when(no_id, F.array(bad_id)).otherwise(rules)).select(*sources.columns, "issues")


def validate_sources(sources: DataFrame, base_dir: str = "/", files: DataFrame | None = None) -> DataFrame:
    """``issues(pos, document_id, seq, rule, message)``, one row per problem."""
    checked = with_issues(sources, base_dir, files)
    return checked.select("pos", "document_id", F.posexplode(F.array_compact("issues")).alias("seq", "_i")).select(
        "pos", "document_id", "seq", "_i.rule", "_i.message"
    )


def error_report(sources: DataFrame, base_dir: str = "/", files: DataFrame | None = None) -> DataFrame:
    """``(document_id, n_issues, report)`` of the entries that fail, the report being one bullet per issue."""
    checked = with_issues(sources, base_dir, files).filter(F.size("issues") > 0)
    lines = F.transform("issues", lambda i: F.concat(F.lit("- "), i["message"]))
    return checked.select("document_id", F.size("issues").alias("n_issues"), F.array_join(lines, "\n").alias("report"))


def require_valid(sources: DataFrame, base_dir: str = "/", files: DataFrame | None = None) -> DataFrame:
    """The sources themselves, or `InvalidSources` when any entry has an issue."""
    issues = validate_sources(sources, base_dir, files)
    if not issues.isEmpty():
        raise InvalidSources(issues)
    return sources
