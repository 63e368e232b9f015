"""Groups of texts whose five-word shingles have a similarity of 0.8 or more, for the pipeline.

Candidates come in two ways. The fingerprints of `simhash`, linked by covering masks, give the nearest copies, whatever their
shingles' minima. They can't reach all pairs: at that similarity 64-bit fingerprints differ in about ten bits, and a cover of radius
ten needs 2,047 tables. So others come from min-wise hashing: ``BANDS`` keys of ``ROWS`` minima each, of which a
pair at 0.8 shares one with probability 0.997. Texts that share a key are sorted by range, so that a key of very many texts is
dealt over tasks, and each is compared with the first of its range and with the one before it; the first ones of the ranges of a
key are compared with the first of all. Pairs whose numbers of shingles rule out the similarity are left out, and the rest
is confirmed by the exact similarity of the sets.

That takes a number of pairs in proportion to the texts and connects most of what is alike, but a text may be like another one of its
key than these. So then all pairs of a key (or of a component of fingerprints) that are not connected yet are compared, by
signatures of ``BITS`` bits that rule out only pairs below the similarity; what these leave is confirmed in the same way. Keys of more
than ``BLOCK`` texts are compared block by block, so no task holds more than two blocks. Groups are what confirmed pairs connect.

A text is known by its digest: rows that repeat a text are one, whatever their keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm import simhash
from docloom.llm.components import components
from docloom.llm.words import LOWER, Words, in_pieces, mixed
from docloom.session import pinned

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 6
#: Shingles that are hashed anew at once.
STEP = 2048
#: Bits of a signature; texts of a key that are compared at once with as many others.
BITS, BLOCK = 1024, 1024
#: In place of a number of a band: texts of a component of fingerprints.
COMPONENT = -1
_rng = np.random.default_rng(11)
TIMES = _rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
PLUS = _rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted hashes of the different runs of ``k`` words of each text; of all its words if there are fewer."""
    words = Words(LOWER[data], offsets)
    hashes, out = words.hashes(), []
    runs = words.hashes_of_runs(hashes, k)
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if high - low >= k:
            out.append(np.unique(runs[low : high - k + 1]))
        else:
            out.append(words.hashes_of_runs(hashes[low:high], high - low) if high > low else np.empty(0, np.uint64))
    return out


def band_keys(shingles: np.ndarray) -> np.ndarray:
    lowest = np.full(BANDS * ROWS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(shingles), STEP):
        np.minimum(lowest, (shingles[i : i + STEP, None] * TIMES + PLUS).min(0), out=lowest)
    value = np.zeros(BANDS, np.uint64)
    for column in lowest.reshape(BANDS, ROWS).T:
        value = mixed(value ^ column)
    return value.view(np.int64)


def signature(shingles: np.ndarray) -> bytes:
    """Bit by bit, whether the number of shingles that fall on it is odd: two sets differ in as many shingles at least as these in bits."""
    odd = np.bincount((shingles % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def sketches(texts: DataFrame) -> DataFrame:
    """(digest, n, bands, signature) of (digest, text): number of different shingles, the keys and the signature; texts without words
    have no keys."""

    def run(batches):
        for batch in batches:
            for rows, data, offsets in in_pieces(batch, "text"):
                sets = shingle_sets(data, offsets)
                keys = [band_keys(s) for s in sets if len(s)]
                ends = np.cumsum([0, *[BANDS * (len(s) > 0) for s in sets]])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *keys])))
                marks = pa.array([signature(s) for s in sets], pa.binary())
                columns = [rows.column("digest"), pa.array([len(s) for s in sets], pa.int64()), lists, marks]
                yield pa.RecordBatch.from_arrays(columns, names=["digest", "n", "bands", "signature"])

    return texts.mapInArrow(run, "digest binary, n bigint, bands array<bigint>, signature binary")


def close(a: str = "n_a", b: str = "n_b") -> Column:
    """Whether the numbers of shingles allow the similarity."""
    return F.least(a, b) >= F.greatest(a, b) * F.lit(SIMILARITY)


def keyed(sketched: DataFrame) -> DataFrame:
    """What texts with a common key have: rows (band, value, a, n_a) of these texts, and with (b, n_b) those of the pairs that are
    compared first. The first text of a task's first and last key, which may go on in other tasks, is in it in any case, as ``edge``."""
    keys = sketched.select("digest", "n", F.posexplode("bands").alias("band", "value"))
    ranged = keys.repartitionByRange("band", "value", "digest").sortWithinPartitions("band", "value", "digest")

    def run(batches):
        key, first, before, edge = None, None, None, True
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(list(zip(*rows)) or [[]] * 7, KINDS)], names=NAMES)
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("band", "value", "digest", "n")]
            for band, value, digest, n in zip(*columns):
                if (band, value) != key:
                    edge = key is None
                    key, first, before = (band, value), (digest, n), None
                    if edge:
                        out.append((*key, *first, None, None, True))
                elif digest != first[0] and (before is None or digest != before[0]):
                    if before is None:
                        out.append((*key, *first, None, None, False))
                    out.append((*key, digest, n, None, None, False))
                    out.append((*key, digest, n, *first, False))
                    if before is not None:
                        out.append((*key, digest, n, *before, False))
                    before = (digest, n)
            yield batch_of(out)
        if key is not None and not edge:
            yield batch_of([(*key, *first, None, None, True)])

    return ranged.mapInArrow(run, "band int, value bigint, a binary, n_a bigint, b binary, n_b bigint, edge boolean")


def candidates(sketched: DataFrame) -> DataFrame:
    """Pairs (a, b) of digests that share a key and whose sizes allow the similarity, each once: those that are compared first."""
    return first_pairs(pinned(keyed(sketched)))


def first_pairs(found: DataFrame) -> DataFrame:
    heads = found.where("edge").select("band", "value", "a", "n_a")
    lowest = heads.groupBy("band", "value").agg(F.min(F.struct("a", "n_a")).alias("l"), F.count("*").alias("ranges")).where("ranges > 1")
    over_ranges = heads.join(lowest, ["band", "value"]).select("a", "n_a", F.col("l.a").alias("b"), F.col("l.n_a").alias("n_b")).where("a <> b")
    pairs = found.where("b IS NOT NULL").select("a", "n_a", "b", "n_b").unionByName(over_ranges)
    return pairs.where(close()).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def fingerprinted(texts: DataFrame, sketched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of digests whose fingerprints `simhash` links and whose sizes allow the similarity, each once; and the texts of its
    components, as those of `keyed`.

    Each is paired with the smallest digest of its component and with the one before it among equal or neighbouring fingerprints.
    """
    found = pinned(simhash.near_duplicates(texts, key="digest"))
    ranged = found.repartitionByRange("component_id", "fingerprint", "digest").sortWithinPartitions("component_id", "fingerprint", "digest")

    def run(batches):
        component, before = None, None
        for batch in batches:
            a, b = [], []
            for root, digest in zip(batch.column("component_id").to_pylist(), batch.column("digest").to_pylist()):
                if root != component:
                    component, before = root, None
                for other in {root, before} - {digest, None}:
                    a.append(min(digest, other))
                    b.append(max(digest, other))
                before = digest
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    pairs = pinned(ranged.select("component_id", "digest").mapInArrow(run, "a binary, b binary").distinct())
    asked = pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct()
    sizes = pinned(sketched.select("digest", "n").where("n > 0").join(asked, "digest", "left_semi").distinct())
    of = lambda c: sizes.select(F.col("digest").alias(c), F.col("n").alias(f"n_{c}"))
    value = F.xxhash64("component_id").alias("value")
    members = found.join(sizes, "digest").select(F.lit(COMPONENT).alias("band"), value, F.col("digest").alias("a"), F.col("n").alias("n_a"))
    return pairs.join(of("a"), "a").join(of("b"), "b").where(close()).select("a", "b"), members


NAMES = ["band", "value", "a", "n_a", "b", "n_b", "edge"]
KINDS = [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.bool_()]


def unconnected(members: DataFrame, roots: DataFrame, sketched: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of digests with the same (band, value) and different roots that can have the similarity, each once.

    A key with one root has none, so a large group of copies that is connected costs nothing here.
    """
    marked = members.distinct().join(roots.select(F.col("node").alias("a"), "root"), "a", "left").withColumn("root", F.coalesce("root", "a"))
    marked = pinned(marked)
    keys = marked.groupBy("band", "value").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("texts"))
    keys = keys.where("least <> most").select("band", "value", F.ceil(F.col("texts") / F.lit(block)).cast("int").alias("blocks"))
    some = pinned(marked.join(keys, ["band", "value"]))
    asked = some.select(F.col("a").alias("digest")).distinct()
    signatures = sketched.join(asked, "digest", "left_semi").select(F.col("digest").alias("a"), "signature").dropDuplicates(["a"])
    own = F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int")
    dealt = some.join(signatures, "a").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = ["band", "value", "low", "high"]
    dealt = dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    rows = dealt.select(*group, "own", "a", "root", "n_a", "signature").repartition(*group).sortWithinPartitions(*group)

    def run(batches):
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            columns = [t.column(c).to_numpy() for c in group]
            cuts = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1).tolist()]
            yield from (compared(t.slice(i, j - i)) for i, j in zip(cuts, cuts[1:]))
            rest = t.slice(cuts[-1])
        if rest is not None and rest.num_rows:
            yield compared(rest)

    def compared(t):
        fixed = lambda c: np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint64).reshape(t.num_rows, -1)
        digest, root, marks = t.column("a").to_pylist(), fixed("root"), fixed("signature")
        n, own = t.column("n_a").to_numpy(), t.column("own").to_numpy()
        low, high = t.column("low")[0].as_py(), t.column("high")[0].as_py()
        right, a, b = np.flatnonzero(own == high), [], []
        for i in np.flatnonzero(own == low).tolist():
            j = right[right > i] if low == high else right
            j = j[(root[j] != root[i]).any(axis=1)]
            j = j[np.minimum(n[j], n[i]) >= np.maximum(n[j], n[i]) * SIMILARITY]
            apart = np.bitwise_count(marks[j] ^ marks[i]).sum(axis=1, dtype=np.int64)
            # sets of n and m shingles have the similarity s if at most (n + m) * (1 - s) / (1 + s) are in one of them only
            for k in j[apart * (1 + SIMILARITY) <= (n[j] + n[i]) * (1 - SIMILARITY) * (1 + 1e-9)].tolist():
                a.append(min(digest[i], digest[k]))
                b.append(max(digest[i], digest[k]))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return rows.mapInArrow(run, "a binary, b binary").distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs whose sets of shingles have the similarity."""

    def sets(batches):
        for batch in batches:
            for rows, data, offsets in in_pieces(batch, "text"):
                packed = pa.array([s.tobytes() for s in shingle_sets(data, offsets)], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column("digest"), packed], names=["digest", "hashes"])

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    asked = pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct()
    known = pinned(texts.join(asked, "digest").dropDuplicates(["digest"]).mapInArrow(sets, "digest binary, hashes binary"))
    of = lambda c, name: known.select(F.col("digest").alias(c), F.col("hashes").alias(name))
    return pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").mapInArrow(check, "a binary, b binary")


def one_of_each_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group: that with the smallest key, null last, of equal keys the smallest digest.

    Equal texts are a group; null counts as the empty text, and texts without words are like no other. Rows that repeat a key and
    a text count once. Rows of one key with unrelated texts are told apart by their texts. An empty table stays empty; all columns
    are kept as they are.
    """
    digest = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    marks = {"_similar_digest": digest, "_similar_row": F.xxhash64(F.col(key).cast("string"), F.col(text))}
    texts = docs.select(digest.alias("digest"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sketched = pinned(sketches(texts))
    found = pinned(keyed(sketched))
    linked, members = fingerprinted(texts, sketched)
    pairs = pinned(first_pairs(found).union(linked).distinct())
    links = pinned(confirmed(pairs, texts))
    members = members.union(found.where("b IS NULL").select("band", "value", "a", "n_a"))
    others = pinned(unconnected(members, components(links), sketched).join(pairs, ["a", "b"], "left_anti"))
    roots = components(links.union(confirmed(others, texts)))
    grouped = docs.select(digest.alias("node"), F.col(key).alias("key")).join(roots, "node", "left")
    order = F.struct(F.col("key").isNull().alias("none"), "key", "node")
    stay = pinned(grouped.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min(order).alias("s")).select(F.col("s.node").alias("_similar_digest"), F.col("s.key").alias("_similar_key")))
    kept = docs.withColumns(marks).join(stay, "_similar_digest").where(F.col(key).eqNullSafe(F.col("_similar_key")))
    return kept.dropDuplicates(["_similar_digest"]).select(*[docs[c] for c in docs.columns])
