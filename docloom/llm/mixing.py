"""Mixing sources to target weights by Pareto order sampling.

A source's target is reached by whole copies of all its documents plus a sample. The whole copies,
``floor(target / size of the source)``, are certain. The remaining words are a sample without replacement of the
documents: each has an inclusion probability ``p``, draws ``u`` from its identifier, and is ranked by its random
odds ``u / (1 - u)`` divided by its inclusion odds ``p / (1 - p)``. The sample is the head of that order which
comes nearest to the remaining words, so its size is fixed in words, not only on average.

The order is never sorted in one task: running sums go over ranges of (source, rank value), of which only one
total each is summed in a window, so that a source with a third of all rows spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import n_words, uniform
from docloom.operators.numbering import running
from docloom.session import pinned

#: Smallest and largest inclusion probability that has odds.
EDGE = 1e-9


def source_targets(sizes: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.0, most: int = 3) -> DataFrame:
    """One row per source of ``sizes`` (source, source_size): its number ``sno``, weight and ``target``.

    Sources in the order of their code points, null last, take the weights in turn. Targets share ``share`` of all
    sizes by weight; none is above ``most`` times its source's size, the excess goes to the others by weight. In
    the order of ``cap / weight`` the sources that stop at their cap come first, so one pass finds the level.
    There is one row per source here, which is what the unpartitioned windows sort.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("sno", F.row_number().over(ordered)).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sno") - 1) % len(weights) + 1)
    )
    caps = weighed.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rising = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), "sno")
    earlier = rising.rowsBetween(Window.unboundedPreceding, -1)
    placed = caps.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("words"),
        F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)).alias("capped"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))).alias("rest"),
    ).withColumn("stops", F.col("cap") / F.col("weight") <= (F.col("words") - F.col("capped")) / F.col("rest"))
    level = placed.select(
        "*",
        F.sum(F.when(F.col("stops"), F.col("cap")).otherwise(0.0)).over(everything).alias("taken_by_caps"),
        F.sum(F.when(F.col("stops"), 0.0).otherwise(F.col("weight"))).over(everything).alias("free"),
    )
    target = F.when(F.col("stops"), F.col("cap")).otherwise(
        F.col("weight") * (F.col("words") - F.col("taken_by_caps")) / F.col("free")
    )
    return level.select("source", "source_size", "sno", "weight", target.alias("target"))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    size: Column | None = None,
    source: str = "source",
    weights: tuple = (5, 2, 1),
    share: float = 1.0,
    most: int = 3,
    odds: Column | None = None,
    seed: int = 1,
) -> DataFrame:
    """One row per row of ``docs``: key, source, size, source_size, target, copies, taken (``copies * size``).

    ``size`` defaults to the number of words of ``text``. ``odds`` is a weight of the document's inclusion odds
    (default 1: documents of a source are equally likely); it must be positive.

    Null texts and empty ones have size 0; null sources are one source, the last. Null keys draw as the empty key.
    Rows that repeat a key draw the same number and are taken in any fixed order, each as a row of its own. An empty
    table gives an empty result; a source without words has target 0 and takes nothing. Other columns are ignored.
    """
    counted = n_words(F.col("text")) if size is None else F.coalesce(size, F.lit(0)).cast("bigint")
    sized = pinned(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).alias("source"),
            counted.alias("size"),
            (F.lit(1.0) if odds is None else odds.cast("double")).alias("odds"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    plan = targets.withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    rows = sized.join(plan.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    share_left = F.coalesce(F.try_divide(F.col("left"), F.col("source_size").cast("double")), F.lit(0.0))
    p = F.least(F.greatest(share_left, F.lit(EDGE)), F.lit(1 - EDGE))
    u = uniform(F.col("key"), seed)
    ranked = rows.withColumn("rank", (u / (1 - u)) / (F.col("odds") * p / (1 - p))).withColumn("before", F.col("size"))
    summed = running(ranked, ["sno"], ["rank", "key", "row"], ["before"])
    sampled = F.col("before") + F.col("size") / F.lit(2.0) <= F.col("left")
    copies = F.col("whole") + F.when(sampled & (F.col("whole") < most), 1).otherwise(0)
    return summed.select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target",
        copies.cast("int").alias("copies"), (copies * F.col("size")).alias("taken"),
    )


#: The same mix in SQL: the draws are MD5 digests, so both engines take the same documents.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM {documents}
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sno
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, ([5.0, 2.0, 1.0])[((sno - 1) % 3 + 1)::INT]::DOUBLE AS weight, 3.0::DOUBLE * source_size AS cap FROM per
), placed AS (
  SELECT *, sum(source_size) OVER ()::DOUBLE AS words,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, sno ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, sno ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
  FROM weighed
), level AS (
  SELECT *, sum(CASE WHEN stops THEN cap ELSE 0 END) OVER () AS taken_by_caps, sum(CASE WHEN stops THEN 0 ELSE weight END) OVER () AS free
  FROM (SELECT *, cap / weight <= (words - capped) / rest AS stops FROM placed)
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole
  FROM (SELECT *, CASE WHEN stops THEN cap ELSE weight * (words - taken_by_caps) / free END AS target FROM level)
), drawn AS (
  SELECT s.doc_id, s.source, s.size, p.source_size, p.target, p.whole, p.sno, p.target - p.whole * p.source_size AS remaining,
    (('0x' || substr(md5('1:' || s.doc_id::VARCHAR), 1, 13))::BIGINT + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
), summed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY sno ORDER BY (u / (1 - u)) / (p / (1 - p)), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM (SELECT *, least(greatest(coalesce(remaining / nullif(source_size, 0), 0), 1e-9), 1 - 1e-9) AS p FROM drawn)
)
"""

ORACLE = MIX_SQL.format(documents="documents") + """
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN earlier + size / 2.0 <= remaining AND whole < 3 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""


def query(spark, sf_dir: str) -> DataFrame:
    from docloom.llm.common import table

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
