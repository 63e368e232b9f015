"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

Fingerprints of 64 bits link when they differ in at most ``radius`` bits. Every bit position gets a non-zero vector of
``radius + 1`` bits; a table belongs to every non-zero vector ``v`` and keeps the positions whose vector has an odd
product with ``v``. For any ``radius`` positions some ``v`` has an even product with all their vectors, so two
fingerprints within the radius agree in all kept bits of that table: no pair is missed (Pagh, 2016).

Equal fingerprints are one node, so copies make no links. In a bucket of a table the links are found in memory and
only a spanning forest of them is given out, at most one link per fingerprint, never all pairs. Buckets beyond
``ALL_PAIRS`` fingerprints look up the neighbours of each fingerprint instead of comparing all pairs: what a bucket does
grows with its size, not with the square.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import table
from docloom.llm.components import components
from docloom.llm.words import LOWER, Words, in_pieces, single_spaced
from docloom.session import pinned

SEED = 42
ALL_PAIRS = 1024
#: Shingles whose bits are counted at once.
SHINGLES = 1 << 17


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all runs of ``k`` words of single-spaced texts, and where each text's hashes begin."""
    words = Words(data, offsets)
    counts = words.counts()
    runs = np.where(counts == 0, 0, np.maximum(counts - k + 1, 1))
    begin = np.concatenate([[0], np.cumsum(runs)])
    number = np.arange(begin[-1]) - np.repeat(begin[:-1], runs)
    head = np.repeat(words.first[:-1], runs) + number
    tail = head + np.repeat(np.minimum(counts, k), runs) - 1
    whole, digest = data.tobytes(), xxhash.xxh64_intdigest
    spans = zip(words.starts[head].tolist(), words.ends[tail].tolist(), strict=True)
    return np.fromiter((digest(whole[s:e], SEED) for s, e in spans), np.uint64, int(begin[-1])), begin


def fingerprints_of(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Bit by bit what more than half of a text's hashes have; zero for texts without any."""
    n = len(begin) - 1
    votes = np.zeros((n, 64), np.int64)
    for low in range(0, len(hashes), SHINGLES):
        part = hashes[low : low + SHINGLES]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        texts = np.searchsorted(begin, np.arange(low, low + len(part)), "right") - 1
        cuts = np.flatnonzero(np.concatenate([[True], texts[1:] != texts[:-1]]))
        votes[texts[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    bits = 2 * votes > np.diff(begin)[:, None]
    return np.packbits(bits, axis=1).view(">u8").reshape(n).astype(np.uint64)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """key, fp (bigint with the 64 bits) of every row; null and empty texts have fingerprint 0."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            for rows_, data, offsets in in_pieces(batch, "text"):
                hashes, begin = shingle_hashes(*single_spaced(LOWER[data], offsets), shingle)
                fps = fingerprints_of(hashes, begin).view(np.int64)
                yield pa.RecordBatch.from_arrays([rows_.column("key"), pa.array(fps)], names=["key", "fp"])

    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, fp bigint")


def masks(radius: int) -> list[int]:
    """The kept bits of every table."""
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(64)]
    odd = lambda x: bin(x).count("1") % 2
    return [sum(odd(vectors[i] & v) << i for i in range(64)) for v in range(1, 2 ** (radius + 1))]


def forest(fps: np.ndarray, mask: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root of its group) among distinct fingerprints that agree on ``mask``."""
    fps = np.sort(fps)
    if len(fps) <= ALL_PAIRS:
        a, b = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius)
    else:
        free = [np.uint64(1 << i) for i in range(64) if not mask >> i & 1]
        found = []
        for r in range(1, radius + 1):
            for flips in combinations(free, r):
                other = fps ^ np.bitwise_or.reduce(np.array(flips))
                at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
                hit = np.flatnonzero(fps[at] == other)
                found.append((hit, at[hit]))
        a, b = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    label = np.arange(len(fps))
    while True:
        lowest = label.copy()
        np.minimum.at(lowest, a, label[b])
        lowest = lowest[lowest]
        if (lowest == label).all():
            break
        label = lowest
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return fps[linked], fps[label[linked]]


def near_links(nodes: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) that connect what pairs of distinct ``fp`` within ``radius`` bits connect."""
    kept = masks(radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in kept]
    tables = nodes.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("bigint")) for m in signed])).alias("t", "part"),
    )
    buckets = tables.repartition("t", "part").sortWithinPartitions("t", "part")

    def run(batches):
        rest = None
        for batch in batches:
            t, part, fp = (batch.column(c).to_numpy() for c in ("t", "part", "fp"))
            if rest is not None:
                t, part, fp = (np.concatenate(x) for x in zip(rest, (t, part, fp), strict=True))
            cuts = np.concatenate([[0], np.flatnonzero((t[1:] != t[:-1]) | (part[1:] != part[:-1])) + 1])
            rest = t[cuts[-1] :], part[cuts[-1] :], fp[cuts[-1] :]
            yield linked(t, fp, cuts)
        if rest is not None:
            yield linked(rest[0], rest[2], np.array([0, len(rest[0])]))

    def linked(t, fp, cuts):
        out = [forest(fp[i:j].view(np.uint64), kept[t[i]], radius) for i, j in zip(cuts, cuts[1:], strict=False) if j - i > 1]
        sides = [np.concatenate([np.empty(0, np.uint64), *[o[i] for o in out]]).view(np.int64) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(s) for s in sides], names=["a", "b"])

    return buckets.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """One row per row of ``docs``: key, fingerprint (16 hex digits), component_id (smallest key reachable by links).

    Null and empty texts have fingerprint zero and link like any other. Null keys are never the smallest; a component
    of null keys alone has a null component_id. Rows that repeat a key give a row each. An empty table gives an
    empty result. Other columns are ignored.
    """
    marked = pinned(fingerprints(docs, key, text, shingle))
    nodes = pinned(marked.groupBy("fp").agg(F.min("key").alias("least")))
    roots = components(near_links(nodes, radius))
    grouped = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    grouped = pinned(grouped)
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    members = pinned(grouped.join(pinned(smallest), "root").select("fp", "component_id"))
    return marked.join(members, "fp").select(
        F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
