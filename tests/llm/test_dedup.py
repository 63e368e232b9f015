import hashlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from docloom.llm import components, exact_dedup, simhash, substring
from docloom.llm.words import Words
from tests.llm.conftest import words


def groups_of(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    out = defaultdict(list)
    for n in nodes:
        out[find(n)].append(n)
    return {n: min(g) for g in out.values() for n in g}


def test_words_and_their_hashes():
    texts = [b"", b" a  b\n", "é a".encode(), b"x" * 50 + b" a", b"\xc2\xa0a a"]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = Words(np.frombuffer(b"".join(texts), np.uint8), offsets)
    want = [t.split() for t in texts]
    flat = [w for t in want for w in t]
    assert got.counts().tolist() == [len(t) for t in want]
    assert [got.data[a:b].tobytes() for a, b in zip(got.starts, got.ends)] == flat
    hashes = got.hashes().tolist()
    assert len(set(hashes)) == len(set(flat)) == len(set(zip(hashes, flat)))


def check_exact(got, corpus):
    lower = lambda t: (t or "").encode().lower()
    groups = defaultdict(list)
    for r in corpus:
        groups[lower(r[1])].append(r[0])
    top = {t: max(ids, key=lambda i: -1 if i is None else i) for t, ids in groups.items()}
    want = Counter((r[0], top[lower(r[1])], len(groups[lower(r[1])]), hashlib.sha256(lower(r[1])).hexdigest()) for r in corpus)
    plain = got.astype(object).where(got.notna(), None)
    assert Counter(zip(plain.doc_id, plain.keep_id, plain.group_size, plain.text_sha256)) == want
    assert got.kept.sum() == len(groups)


def test_exact_dedup(docs, corpus):
    check_exact(exact_dedup.exact_dedup(docs).toPandas(), corpus)


def test_exact_dedup_compares_bytes_where_digests_agree(docs, corpus):
    weak = lambda text: F.unhex(F.substring(F.md5(text), 1, 1))
    check_exact(exact_dedup.exact_dedup(docs, digest=weak, files_per_batch=1).toPandas(), corpus)


def test_exact_dedup_of_very_many_null_and_repeated_keys(spark):
    nulls = spark.range(100_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('text ', id % 30000) AS text")
    repeated = spark.range(100_000).selectExpr("CAST(7 AS BIGINT) AS doc_id", "'the same' AS text")
    got = exact_dedup.exact_dedup(nulls.union(repeated).repartition(8))
    found = got.groupBy("doc_id").agg(F.count("*").alias("rows"), F.sum(F.col("kept").cast("int")).alias("kept"), F.max("group_size").alias("size")).collect()
    assert {tuple(r) for r in found} == {(None, 100_000, 30_000, 4), (7, 100_000, 1, 100_000)}


def test_stream_goes_on_where_it_ended(spark, docs, tmp_path):
    source, state, out = (str(tmp_path / x) for x in ("records", "state", "groups"))
    for i in range(2):
        exact_dedup.records(docs, "doc_id", "text").coalesce(2).write.mode("append").parquet(source)
        exact_dedup.run_stream(spark, source, state, out, files_per_batch=1)
    once = exact_dedup.exact_dedup(docs).where("kept").select("text_sha256", "group_size").toPandas()
    twice = exact_dedup.groups(spark, out).select(F.lower(F.hex("digest")).alias("sha"), "n").toPandas()
    assert dict(zip(twice.sha, twice.n)) == {s: 2 * n for s, n in zip(once.text_sha256, once.group_size)}


@pytest.mark.parametrize("links", [[], [(1, 1), (2, None)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(70, 71), (71, 72), (72, 70), (70, 71)]])
def test_components(spark, links):
    frame = spark.createDataFrame(links, "a BIGINT, b BIGINT")
    got = {r.node: r.root for r in components.components(frame).collect()}
    real = [(a, b) for a, b in links if b is not None and a != b]
    want = groups_of(real, {n for link in real for n in link})
    assert set(got) == set(want)
    assert len(set(got.values())) == len(set(want.values())) == len(set(zip(got.values(), (want[n] for n in got))))


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair(radius):
    import itertools

    kept = simhash.masks(radius)
    assert len(kept) == 2 ** (radius + 1) - 1
    rng = np.random.default_rng(1)
    flips = itertools.chain(itertools.combinations(range(64), min(radius, 2)), (tuple(rng.choice(64, radius, False)) for _ in range(500)))
    assert all(any(not sum(1 << int(b) for b in f) & m for m in kept) for f in flips)


@pytest.mark.parametrize("n", [300, 3000])
def test_forest_of_a_bucket(n, monkeypatch):
    rng = np.random.default_rng(2)
    mask = simhash.masks(2)[0]
    free = np.uint64(~mask & (1 << 64) - 1)
    fps = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) & free & rng.integers(0, 1 << 63, n, dtype=np.uint64) & rng.integers(0, 1 << 63, n, dtype=np.uint64))
    near = np.argwhere(np.triu(np.bitwise_count(fps[:, None] ^ fps) <= 2, 1))
    want = groups_of([(int(fps[a]), int(fps[b])) for a, b in near], fps.tolist())
    for limit in (1, 10**6):
        monkeypatch.setattr(simhash, "ALL_PAIRS", limit)
        a, b = simhash.forest(fps, mask, 2)
        got = groups_of(zip(a.tolist(), b.tolist()), fps.tolist())
        assert got == want and len(a) < len(fps)


def test_simhash_equals_brute_force(docs, corpus):
    def fingerprint(text):
        w = words((text or "").encode().lower().decode())
        hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))

    prints = [fingerprint(r[1]) for r in corpus]
    n = len(prints)
    group = groups_of([(i, j) for i in range(n) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2], range(n))
    least = {}
    for i, r in enumerate(corpus):
        if r[0] is not None:
            least[group[i]] = min(r[0], least.get(group[i], r[0]))
    want = Counter((r[0], f"{p:016x}", least.get(group[i])) for i, (r, p) in enumerate(zip(corpus, prints)))
    got = simhash.near_duplicates(docs).toPandas()
    got = got.astype(object).where(got.notna(), None)
    assert Counter(zip(got.doc_id, got.fingerprint, got.component_id)) == want


def test_repeats_equal_brute_force(docs, corpus):
    first = {}
    texts = [(r[0], words(r[1])) for r in corpus]
    for i, w in texts:
        if i is not None:
            for k in range(len(w) - 49):
                window = tuple(w[k : k + 50])
                first[window] = min(i, first.get(window, i))
    want = Counter()
    for i, w in texts:
        gone = set()
        if i is not None:
            for k in range(len(w) - 49):
                if first[tuple(w[k : k + 50])] < i:
                    gone.update(range(k, k + 50))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want[i, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    got = substring.drop_repeats(docs).toPandas()
    spans = got.removed_spans.map(lambda s: sum(s[1::2]) - sum(s[::2]))
    assert (spans == got.n_removed).all() and got.n_removed.sum() > 20_000
    got = got.astype(object).where(got.notna(), None)
    assert Counter(zip(got.doc_id, got.n_words, got.n_removed, got.kept_sha256)) == want


def test_empty_tables(nothing):
    assert exact_dedup.exact_dedup(nothing).count() == 0
    assert simhash.near_duplicates(nothing).count() == 0
    assert substring.drop_repeats(nothing).count() == 0
