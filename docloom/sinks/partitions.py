"""Rewriting only the partitions a change touches.

Parquet has no row-level merge, so a change rewrites the partitions it falls in: they are merged into the
shared folder first and then swapped in by a dynamic partition overwrite. A run that dies in between can be
repeated, since every change is keyed. A hash bucket below the natural partition bounds what one changed
document rewrites, also in a namespace that holds a third of all rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.session import pinned


def bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def only_touched(table: DataFrame, change: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``table`` in the partitions that ``change`` falls in, which are named in the filter of the scan.

    The names are as many as the partitions to be rewritten, which the catalog and the driver list in any case.
    """
    named = change.select(*columns).distinct().collect()
    return table.filter(one_of(named, columns)) if named else table.limit(0)


def one_of(named: list, columns: list[str]) -> Column:
    """Whether ``columns`` have the values of one of the rows ``named``, of which there is one at least."""
    if len(columns) == 1:
        return F.col(columns[0]).isin([row[0] for row in named])
    *outer, last = columns
    values: dict[tuple, list] = {}
    for row in named:
        values.setdefault(tuple(row[c] for c in outer), []).append(row[last])
    # keys with the same inner values share a term, so the filter stays short when whole namespaces are touched
    alike: dict[tuple, list] = {}
    for key, found in values.items():
        alike.setdefault(tuple(sorted(found)), []).append(key)
    same = []
    for found, keys in alike.items():
        inner = F.col(last).isin(list(found))
        if len(outer) == 1:
            same.append(F.col(outer[0]).isin([k[0] for k in keys]) & inner)
        else:
            same += [reduce(Column.__and__, [F.col(c) == v for c, v in zip(outer, key)], inner) for key in keys]
    while len(same) > 1:  # a balanced tree: a chain of hundreds of terms would be too deep to plan
        same = [same[i] | same[i + 1] if i + 1 < len(same) else same[i] for i in range(0, len(same), 2)]
    return same[0]


def ready_to_write(df: DataFrame, columns: list[str]) -> DataFrame:
    """Written to the shared folder, grouped by partition with large partitions split over tasks.

    The files read back keep that grouping, so the write itself moves no rows.
    """
    return pinned(df.hint("rebalance", *columns))
