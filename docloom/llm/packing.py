"""Packing documents into padded batches over optimal length buckets.

All lengths are counted in one histogram. A dynamic programme over it chooses the bucket boundaries for which the
padding of all documents is smallest; inside each bucket documents in a fixed random order form batches of at most
``budget`` padded tokens.

Only the histogram reaches the driver, in columns of numbers. It and the plan are exact for any input: texts with m different
lengths have m * m / 2 tokens at least, so a million lengths need half a trillion tokens. The cost of a bucket obeys the quadrangle
inequality, so the best beginning of the last bucket never moves back as its end moves on, and each bucket takes m log m steps.
Positions inside a bucket come from running counts over ranges, so a bucket with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import n_words, uniform
from docloom.operators.numbering import running
from docloom.session import pinned

EXACT_BITS = 10
STEPS_BITS = 6
#: Ends of a bucket whose best beginnings are looked for at once.
MOST_LENGTHS = 5000


def bin_end(length: Column) -> Column:
    """The upper end of the bin of a length, for histograms to look at; the plan takes the lengths themselves."""
    shift = F.greatest(F.length(F.bin(length)) - 1 - STEPS_BITS, F.lit(0))
    step = F.pow(F.lit(2.0), shift.cast("double"))
    return F.when(length <= 2**EXACT_BITS, length).otherwise((F.ceil(length / step) * step).cast("bigint"))


def histogram_of(sized: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rising lengths and their numbers of documents."""
    counted = sized.groupBy("n_tokens").agg(F.count("*").alias("n")).toArrow().sort_by("n_tokens")
    return counted["n_tokens"].to_numpy(), counted["n"].to_numpy()


def best_boundaries(lengths: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """Boundaries (a subset of ``lengths``, which rise) of at most ``buckets`` buckets with the least padding.

    ``least[j]`` is the least padded total when the first ``j`` lengths are covered; one more bucket that ends at length
    ``j`` and starts behind length ``i`` adds ``length[j] * (documents in between)``.
    """
    ends = np.concatenate([[0], lengths]).astype(float)
    upto = np.concatenate([[0], np.cumsum(counts)]).astype(float)
    m = len(lengths)
    least, chosen = np.where(np.arange(m + 1) == 0, 0.0, np.inf), []
    for _ in range(min(buckets, m)):
        total, start = cheapest_starts(least, ends, upto)
        better = total < least
        chosen.append(np.where(better, start, -1))
        least = np.where(better, total, least)
    out, j = [], m
    for nearest in reversed(chosen):
        if j > 0 and nearest[j] >= 0:
            out.append(int(lengths[j - 1]))
            j = int(nearest[j])
    return out[::-1]


def cheapest_starts(least: np.ndarray, ends: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every end ``j`` the least total with one more bucket, and the first start ``i < j`` that gives it.

    Ends are halved again and again; between two whose starts are known only the starts between these come into question.
    """
    m = len(ends) - 1
    total, start = np.full(m + 1, np.inf), np.zeros(m + 1, np.int64)
    known = np.zeros(m + 2, np.int64)
    known[m + 1] = m
    step = 1 << m.bit_length()
    while step > 1:
        step //= 2
        level = np.arange(step, m + 1, 2 * step)
        for at in range(0, len(level), MOST_LENGTHS):
            j = level[at : at + MOST_LENGTHS]
            low, high = known[j - step], np.minimum(known[np.minimum(j + step, m + 1)], j - 1)
            width = high - low + 1
            begin = np.cumsum(width) - width
            i = np.arange(width.sum()) + np.repeat(low - begin, width)
            cost = least[i] + np.repeat(ends[j], width) * (np.repeat(upto[j], width) - upto[i])
            total[j] = np.minimum.reduceat(cost, begin)
            hit = np.where(cost == np.repeat(total[j], width), i, m)
            start[j] = known[j] = np.minimum.reduceat(hit, begin)
    return total, start


def pack(
    docs: DataFrame, key: str = "doc_id", length: Column | None = None, buckets: int = 16, budget: int = 65_536, seed: int = 1
) -> DataFrame:
    """One row per row of ``docs``: key, n_tokens, bucket_length, batch, slot, padding.

    ``length`` defaults to the words of ``text`` plus one end token; negative or null lengths count as 0. Every document
    is packed whole: a document longer than ``budget`` forms a batch alone. A batch is known by its bucket_length and
    its number ``batch`` in the bucket; ``slot`` is the place in the batch, from 0.

    Null and empty texts have one token, the end. Rows that repeat a key are packed each; null keys sort first. An empty
    table gives an empty result. Other columns are ignored.
    """
    tokens = n_words(F.col("text")) + 1 if length is None else F.greatest(F.coalesce(length, F.lit(0)), F.lit(0))
    sized = pinned(
        docs.select(
            F.col(key).alias("key"), tokens.cast("bigint").alias("n_tokens"), F.monotonically_increasing_id().alias("row")
        )
    )
    ends = best_boundaries(*histogram_of(sized), buckets)
    # an empty table has no boundary; the one given here is never used
    bound = F.element_at(
        F.filter(F.array(*[F.lit(e).cast("bigint") for e in ends or [0]]), lambda e: e >= F.col("n_tokens")), 1
    )
    placed = sized.select(
        "*", bound.alias("bucket_length"), uniform(F.col("key"), seed).alias("u"), F.lit(1).cast("bigint").alias("place")
    )
    placed = running(placed, ["bucket_length"], ["u", "key", "row"], ["place"])
    room = F.greatest(F.floor(F.lit(budget) / F.greatest(F.col("bucket_length"), F.lit(1))), F.lit(1))
    return placed.select(
        F.col("key").alias(key),
        "n_tokens",
        "bucket_length",
        F.floor(F.col("place") / room).alias("batch"),
        (F.col("place") % room).cast("int").alias("slot"),
        (F.col("bucket_length") - F.col("n_tokens")).alias("padding"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    from docloom.llm.common import table

    return pack(table(spark, sf_dir, "documents"))
