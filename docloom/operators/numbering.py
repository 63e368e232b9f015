"""Running numbers that do not put a whole group into one task.

A window over a group would send all its rows to one task, and one namespace may hold a third of all rows.
Here rows are sorted into ranges over group *and* order columns, so that a large group spreads over many
ranges; only one total per range and group is summed up in a plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.constants import BATCH_SIZE
from docloom.session import pinned


def before(value: Column, group: list[str], order: list[str], how=F.sum) -> Column:
    """``how`` of ``value`` over the earlier rows of the group, null on the first row."""
    return how(value).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))


def running(df: DataFrame, group: list[str], order: list[str], values: list[str], how=F.sum) -> DataFrame:
    """Replace ``values`` by their ``how`` (`F.sum` or `F.max`) over the earlier rows of the group.

    ``df`` has one row per group and order value. The ranges are written to the shared folder once, so that
    a lost executor cannot move rows between them.
    """
    ranged = pinned(df.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy(*group, "_range").agg(*[how(v).alias(v) for v in values])
    carried = totals.select(
        *group, "_range", *[before(F.col(v), group, ["_range"], how).alias(f"_carry_{v}") for v in values]
    )
    local = ranged.withColumns(
        {f"_local_{v}": before(F.col(v), [*group, "_range"], order, how) for v in values}
    ).join(carried, [*group, "_range"])

    def both(v):
        earlier, inside = F.col(f"_carry_{v}"), F.col(f"_local_{v}")
        if how is F.sum:
            zero = F.lit(0).cast("bigint")
            return F.coalesce(earlier, zero) + F.coalesce(inside, zero)
        return F.greatest(earlier, inside)

    return local.select(*[both(c).alias(c) if c in values else F.col(c) for c in df.columns])


def running_offsets(counts: DataFrame, group: list[str], order: list[str], n: str) -> DataFrame:
    """Add ``offset``: sum of ``n`` over the earlier rows of the group, in the given order."""
    return running(counts.withColumn("offset", F.col(n)), group, order, ["offset"])


def number_pieces(pieces: DataFrame, group: list[str], document: str = "document_id", i: str = "i") -> DataFrame:
    """Add ``seq``: position of every chunk in its group, documents in order, chunks by their number ``i``.

    The numbers inside a document are known, so only documents are counted and ordered, not chunks. ``pieces``
    is read twice: give a stored table, or one that is cheap to read.
    """
    per_document = pieces.groupBy(*group, document).agg(F.count("*").alias("_n"))
    offsets = running_offsets(per_document, group, [document], "_n").select(*group, document, "offset")
    joined = pieces.join(offsets, [*group, document])
    return joined.withColumn("seq", F.col("offset") + F.col(i)).drop("offset")


def assign_batches(pieces: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Add ``batch_no``: consecutive slices of a namespace; a non-positive size means the default."""
    size = batch_size if batch_size > 0 else BATCH_SIZE
    numbered = number_pieces(pieces, ["namespace"])
    return numbered.withColumn("batch_no", F.floor(F.col("seq") / F.lit(size)))
