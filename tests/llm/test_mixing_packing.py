import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import mixing, packing
from tests.llm.conftest import words


def test_mix_counts_targets_and_sample(spark, docs, corpus):
    got = mixing.mix(docs).toPandas()
    assert len(got) == len(corpus)
    sizes = sorted((r[0] is None, r[0], len(words(r[1]))) for r in corpus)
    mine = got.assign(none=got.doc_id.isna()).sort_values(["none", "doc_id", "size"])
    assert mine["size"].tolist() == [s for *_, s in sorted(sizes, key=lambda s: (s[0], s[1] or 0, s[2]))]
    total = got["size"].sum()
    per = got.groupby("source", dropna=False).agg(size=("size", "sum"), own=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert (per["size"] == per.own).all() and (per.target <= 3 * per.own + 1e-6).all()
    assert per.target.sum() == pytest.approx(total)
    assert (got.taken <= 3 * got["size"]).all()
    # a sample ends at the document after which the sum is nearest
    assert ((per.taken - per.target).abs() <= per.most / 2 + 1e-6).all()
    again = mixing.mix(docs.repartition(5)).toPandas()
    order = ["doc_id", "size", "source", "taken"]
    assert again.sort_values(order)[order].reset_index(drop=True).equals(got.sort_values(order)[order].reset_index(drop=True))


def test_targets_stop_at_three_times_the_source(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 0)], "source STRING, source_size BIGINT")
    got = {r.source: (r.sno, r.target) for r in mixing.source_targets(sizes).collect()}
    # weights 5, 2, 1, 5: a and the empty one stop at 30 and 0, b and c share the rest as 2 to 1
    assert got == {"a": (1, 30.0), "b": (2, 2 * 1480 / 3), "c": (3, 1480 / 3), None: (4, 0.0)}


def test_larger_odds_are_taken_more_often(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(10).alias("n"))
    other = spark.range(4000).select((F.col("id") + 4000).alias("doc_id"), F.lit("t").alias("source"), F.lit(10).alias("n"))
    heavy = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)
    got = mixing.mix(rows.union(other), size=F.col("n"), weights=(1, 4), odds=heavy).where("source = 's'").toPandas()
    assert got.taken.sum() == pytest.approx(got.target.iloc[0], abs=10)
    even, odd = got[got.doc_id % 2 == 0].copies.mean(), got[got.doc_id % 2 == 1].copies.mean()
    assert even > 1.5 * odd


def test_bin_ends(spark):
    lengths = [0, 1, 1023, 1024, 1025, 1040, 1041, 2047, 2048, 2049, 133_719, 10**12]
    got = spark.createDataFrame([(n,) for n in lengths], "n BIGINT").select("n", packing.bin_end(F.col("n")).alias("e")).collect()
    for n, end in got:
        step = 1 if n <= 1024 else 2 ** (n.bit_length() - 7)
        assert end == -(-n // step) * step


@pytest.mark.parametrize("buckets", [1, 2, 3, 9])
def test_boundaries_are_optimal(buckets):
    lengths, counts = [1, 2, 5, 9, 14, 15, 40], [30, 4, 4, 1, 7, 2, 1]

    def padded(ends):
        return sum(c * min(e for e in ends if e >= n) for n, c in zip(lengths, counts))

    every = [(*c, 40) for k in range(min(buckets, 7)) for c in itertools.combinations(lengths[:-1], k)]
    got = packing.best_boundaries(lengths, counts, buckets)
    assert len(got) <= buckets and padded(got) == min(map(padded, every))


def test_batches_hold_every_document_once(docs, corpus):
    got = packing.pack(docs, buckets=4, budget=400).toPandas()
    assert sorted(got.n_tokens) == sorted(len(words(r[1])) + 1 for r in corpus)
    assert (got.padding == got.bucket_length - got.n_tokens).all() and (got.padding >= 0).all()
    assert got.bucket_length.nunique() <= 4
    for (length, _), batch in got.groupby(["bucket_length", "batch"]):
        assert sorted(batch.slot) == list(range(len(batch)))
        assert len(batch) == 1 or len(batch) * length <= 400
    for length, bucket in got.groupby("bucket_length"):
        room = max(1, 400 // length)
        assert bucket.batch.nunique() == -(-len(bucket) // room)


@pytest.mark.parametrize("most", [5000, 3])
def test_boundaries_are_real_lengths(spark, monkeypatch, most):
    monkeypatch.setattr(packing, "MOST_LENGTHS", most)
    lengths = [1025] * 3 + [1027] + [2051] * 2 + [2079] + [5001]
    frame = spark.createDataFrame(list(enumerate(lengths)), "doc_id BIGINT, n BIGINT")
    got = packing.pack(frame, length=F.col("n"), buckets=2).toPandas()
    ends = [*(e for e in set(lengths) if e < 5001)]
    best = min(sum(min(b for b in (e, 5001) if b >= n) - n for n in lengths) for e in ends)
    assert set(got.bucket_length) <= set(lengths) and got.padding.sum() == best


def test_plan_is_exact_for_any_number_of_lengths(spark):
    frame = spark.range(6000).select(F.col("id").alias("doc_id"), (F.col("id") * 3 + 1100).alias("n"))
    frame = frame.withColumn("n", F.explode(F.array_repeat("n", 1 + (F.col("doc_id") * F.col("doc_id") % 7).cast("int"))))
    lengths = np.sort(frame.toPandas().n.to_numpy())
    # one boundary besides the longest length
    upto = np.searchsorted(lengths, np.unique(lengths), "right")
    best = (np.unique(lengths) * upto + lengths[-1] * (len(lengths) - upto)).min() - lengths.sum()
    assert packing.pack(frame, length=F.col("n"), buckets=2).agg(F.sum("padding")).first()[0] == best


def test_starts_are_those_of_all_pairs():
    rng = np.random.default_rng(3)
    for m in range(1, 40):
        lengths, counts = np.cumsum(rng.integers(1, 9, m)), rng.integers(1, 30, m)
        ends, upto = np.concatenate([[0], lengths]).astype(float), np.concatenate([[0], np.cumsum(counts)]).astype(float)
        least = np.where(np.arange(m + 1) == 0, 0.0, np.inf)
        for _ in range(4):
            total, start = packing.cheapest_starts(least, ends, upto)
            every = [least[:j] + ends[j] * (upto[j] - upto[:j]) for j in range(1, m + 1)]
            assert total[1:].tolist() == [e.min() for e in every] and start[1:].tolist() == [e.argmin() for e in every]
            least = np.minimum(least, total)


def test_empty_tables(nothing):
    assert mixing.mix(nothing).count() == 0 and packing.pack(nothing).count() == 0
