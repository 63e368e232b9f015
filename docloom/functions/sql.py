"""The splitters for SQL users.

``register(spark)`` makes available, under these names:

- ``split_text(body)``, ``split_json(body)``, ``split_yaml(body)``: table functions for ``LATERAL``, one row per piece;
- ``html_text(page)``: the visible text of a page.

The table functions are SQL themselves, so a query over them is planned as a generator in the scan's stage. Bodies within the
limit stay in the JVM; longer ones cross to Python in Arrow batches, by the same functions that the DataFrame side uses.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from docloom.constants import MAX_CHARS, WHITESPACE
from docloom.functions import nested, split
from docloom.functions.html import parsed_text

LONG, NESTED = "docloom_long_pieces", "docloom_nested_pieces"

_WHOLE = f"""array(named_struct('start', length(body) - length(ltrim('{WHITESPACE}', body)) + 0L,
  'end', length(rtrim('{WHITESPACE}', body)) + 0L, 'content', btrim(body, '{WHITESPACE}')))"""

TEXT = f"""CREATE OR REPLACE TEMPORARY FUNCTION split_text(body STRING)
RETURNS TABLE (i INT, start BIGINT, end BIGINT, content STRING)
RETURN SELECT pos, p.start, p.end, p.content FROM (SELECT posexplode(
  CASE WHEN length(body) > {MAX_CHARS} THEN {LONG}(CASE WHEN length(body) > {MAX_CHARS} THEN body END)
       WHEN btrim(body, '{WHITESPACE}') <> '' THEN {_WHOLE} ELSE array() END) AS (pos, p))"""


def _nested(fmt: str) -> str:
    return f"""CREATE OR REPLACE TEMPORARY FUNCTION split_{fmt}(body STRING)
RETURNS TABLE (i INT, content STRING, oversize BOOLEAN, error STRING)
RETURN SELECT pos, p.content, p.oversize, error
FROM (SELECT posexplode_outer(n.pieces) AS (pos, p), n.error AS error FROM (SELECT {NESTED}(body, '{fmt}') AS n))
WHERE p IS NOT NULL OR error IS NOT NULL"""


def register(spark: SparkSession) -> None:
    spark.udf.register(LONG, split.split_udf())
    spark.udf.register(NESTED, nested.split_nested_udf())
    for function in (TEXT, _nested("json"), _nested("yaml")):
        spark.sql(function)
    spark.udf.register("html_text", parsed_text)
