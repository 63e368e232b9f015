import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import katz, licences, packed, toxicity, vectors
from tests.llm.conftest import words

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("x", [[], [0, 1, 255], [256, 3], [2**40, 1], [0.5, -1.0]])
def test_packed_arrays(x):
    assert packed.unpack(packed.pack(np.array(x))).tolist() == x


def discounts(counts):
    n = Counter(counts)
    common = 6 * n[6] / n[1] if n[1] else 1
    out = {}
    for r in range(1, 6):
        if n[1] and n[r] and common < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
            out[r] = d if 0 < d <= 1 else 1
    return lambda r: out.get(r, 1)


def check_katz(got, rows):
    """``rows``: key, words with the end, whether to train."""
    single, pair, texts = Counter(), Counter(), 0
    for _, w, train in rows:
        if train:
            texts += 1
            single.update(w)
            pair.update(zip(["start", *w[:-1]], w))
    total, types = sum(single.values()), len(single)
    d1, d2 = discounts(single.values()), discounts(pair.values())
    freed = total - sum(d1(c) * c for c in single.values())
    divisor = total if freed > 0 else total + 1
    unknown = (freed if freed > 0 else 1) / divisor

    def p1(w):
        return d1(single[w]) * single[w] / divisor if single[w] else unknown

    after = defaultdict(dict)
    for (h, w), c in pair.items():
        after[h][w] = c
    model = {}
    for h, seen in after.items():
        n = sum(seen.values())
        free = sum(c - d2(c) * c for c in seen.values())
        n, free = (n, free) if free > 1e-12 else (n + 1, 1)
        model[h] = (n, free / n / (1 - sum(map(p1, seen))))
        # the probabilities of all known words and of the unknown one make 1
        rest = sum(p1(w) for w in single if w not in seen) + unknown
        assert sum(d2(c) * c / n for c in seen.values()) + model[h][1] * rest == pytest.approx(1)
    want = []
    for key, w, train in rows:
        score = base = 0
        for h, x in zip(["start", *w[:-1]], w):
            base += math.log10((single[x] + 0.1) / (total + 0.1 * (types + 1)))
            if h in model:
                c = after[h].get(x, 0)
                p = d2(c) * c / model[h][0] if c else model[h][1] * p1(x)
            else:
                p = p1(x)
            score += math.log10(p)
        want.append((-1 if key is None else key, train, len(w), sum(single[x] > 0 for x in w), total, base, score))
    got = got.assign(key=got.key.fillna(-1)).sort_values(["key", "score"])
    want.sort(key=lambda r: (r[0], r[-1]))
    assert got[["key", "train", "n_tokens", "n_known", "train_tokens"]].values.tolist() == [list(r[:5]) for r in want]
    assert got.base_score.tolist() == pytest.approx([r[5] for r in want])
    assert got.score.tolist() == pytest.approx([r[6] for r in want])


@pytest.mark.parametrize("block", [katz.BLOCK, 2000])
def test_katz_equals_brute_force(docs, corpus, block, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK", block)
    made = katz.katz(docs, F.pmod(F.col("doc_id"), F.lit(4)) != 0)
    rows = [(r[0], words((r[1] or "").encode().lower().decode()) + ["end"], r[0] is not None and r[0] % 4 != 0) for r in corpus]
    check_katz(made.scores.toPandas(), rows)
    table = made.pairs.toPandas()
    stored = sum(int(packed.unpack(bytes(c)).sum()) for c in table.counts)
    assert stored == sum(len(w) for _, w, train in rows if train)


def test_katz_of_little(spark, nothing):
    assert katz.katz(nothing, F.lit(True)).scores.count() == 0
    one = spark.createDataFrame([(1, "a a a a a a a a"), (2, "b")], "doc_id BIGINT, text STRING")
    check_katz(katz.katz(one, F.col("doc_id") == 1).scores.toPandas(), [(1, [b"a"] * 8 + ["end"], True), (2, [b"b", "end"], False)])
    none = katz.katz(one, F.lit(None).cast("boolean")).scores.toPandas()
    assert none.n_known.sum() == 0 and none.score.abs().sum() == 0


def labelled(spark, n=600, seed=3):
    rng = np.random.default_rng(seed)
    clean, bad = [f"w{i}" for i in range(400)], ["vilexa", "vilexo", "grumb", "snarl"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = list(rng.choice(clean, rng.integers(5, 60)))
        if toxic:
            for w in rng.choice(bad, 3):
                text.insert(rng.integers(len(text)), w.upper() if i % 2 else w)
        rows.append((i, " ".join(text)))
        if i % 3:
            labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), spark.createDataFrame(labels, "doc_id BIGINT, toxic INT")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    got = toxicity.toxicity(docs, labels).toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    apart = got[got.held_out]
    assert (apart.predicted == (apart.doc_id % 5 == 0)).mean() > 0.97
    assert (got.predicted == (got.score >= 0.5)).all() and got.score.between(0, 1).all()


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = labelled(spark)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [toxicity.toxicity(docs, x).orderBy("doc_id").toPandas().score.tolist() for x in (labels, turned)]
    assert scores[0] == pytest.approx(scores[1])


def test_risk_of_unlabelled_text_is_corrected():
    # a feature of all toxic texts, in a fifth of the unlabelled ones: those are toxic, and must score so
    confirmed = np.array([True] * 50 + [False] * 500)
    row = np.array([*range(50), *range(50, 150)])
    weights, bias = toxicity.fit(row, np.zeros(150, int), confirmed, 1, prior=0.2)
    assert weights[0] + bias > 0 > bias


def test_toxicity_of_odd_rows(spark, docs, corpus, nothing):
    none = spark.createDataFrame([], "doc_id BIGINT, toxic INT")
    odd = spark.createDataFrame([(None, 1), (3, None), (4, 1), (4, 0), (5, 0)], "doc_id BIGINT, toxic INT")
    for labels in (none, odd):
        got = toxicity.toxicity(docs, labels).toPandas()
        assert len(got) == len(corpus) and got.score.between(0, 1).all()
    assert toxicity.toxicity(nothing, none).count() == 0
    model = toxicity.train(docs, none)
    assert toxicity.without_toxic(docs, model).count() == len(corpus)


def brute_links(x, least):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    links = u @ u.T >= least
    np.fill_diagonal(links, False)
    return links


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 40)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(700, 24)).astype(np.float32)
    x[100:250] = x[0] + rng.normal(scale=0.05, size=(150, 24))  # near copies
    x[250:300] = x[1] * 2  # the same direction
    x[300:330] = x[2]  # copies
    x[330:400] = x[3] + rng.normal(scale=0.28, size=(70, 24))  # about the threshold
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [None, [0.0] * 24, [1.0, None] * 12, [float("nan")] * 24, [float("inf")] * 24, [1.0], []]
    rows += [(1000 + i, v) for i, v in enumerate(odd)] + [(None, x[2].tolist())]
    frame = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>").repartition(4)
    got = vectors.near_vectors(frame, probes=6).toPandas()
    assert len(got) == len(rows)
    none = got[got.vec_id.isna() | (got.vec_id >= 1000)]
    assert (none.n_links == 0).all() and len(none) == 8
    assert (none.kept == none.vec_id.notna()).all() and (none.component_id.dropna() == none.vec_id.dropna()).all()
    got = got[got.vec_id < 1000].sort_values("vec_id")
    want = brute_links(x.astype(float), 0.9)
    assert got.n_links.sum() >= 0.98 * want.sum() and (got.n_links.to_numpy() <= want.sum(1)).all()
    assert (got.kept == (got.vec_id == got.component_id)).all()
    # all lists probed: nothing can be missed
    whole = vectors.near_vectors(frame, probes=10**6).where("vec_id < 1000").toPandas().sort_values("vec_id")
    assert (whole.n_links.to_numpy() == want.sum(1)).all()


def test_lists_searched_grow_until_links_are_found(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 8))
    x = np.concatenate([x, x + rng.normal(scale=0.4, size=x.shape), x + rng.normal(scale=0.4, size=x.shape)])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    want = brute_links(x, 0.9).sum(1)
    got = vectors.near_vectors(frame, lists=1000, probes=2).toPandas().sort_values("vec_id").n_links.to_numpy()
    assert (got <= want).all() and got.sum() >= 0.995 * want.sum()
    # two lists alone, as many as are asked for at least, don't find them
    few = vectors.near_vectors(frame, lists=1000, probes=2, recall=0.0).toPandas().n_links.sum()
    assert few < 0.97 * want.sum()


def test_number_of_lists_searched():
    links = np.array([[0, 1, 90], [0, 12, 10], [1, 3, 1], [1, 40, 1]])
    assert vectors.recall_of(links, 3) == pytest.approx(0.7) and vectors.recall_of(links, 40) == 1
    assert [vectors.searched(links, r, 8) for r in (0.5, 0.74, 1.0)] == [8, 12, 40]
    assert vectors.searched(links[:0], 1.0, 8) == 8


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id BIGINT, embedding ARRAY<FLOAT>, n INT, id STRING")
    assert vectors.near_vectors(frame).count() == 0
    one = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    assert sorted(map(tuple, vectors.near_vectors(one).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of", "under", "license", "work"]
    return licences.train([" ".join(rng.choice(vocabulary, 12)) for _ in range(400)])


def test_licence_families_of_new_variants(model):
    rng = np.random.default_rng(99)
    lines, family = licences.variants(rng, [["other", "words", "before"]], 5)
    line, key = licences.places(licences.features_of(lines), model.keys)
    p = model.probabilities(line, key, len(lines))
    assert (p.argmax(1) == family).mean() > 0.97
    assert 0.5 <= model.least <= 0.9


def test_licence_scan(spark, model, docs, corpus, nothing):
    notice = "Licensed under the Apache License, Version 2.0."
    texts = [notice, f"some text\n\n{notice}\nReleased under the MIT License.", "my driving license is under the work of the public", None, "", "x " * 50_000 + "\n" + notice.upper()]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id INT, text STRING")
    got = {r.doc_id: (r.n_lines, [(n.line, n.family) for n in r.notices]) for r in licences.scan(rows, model).collect()}
    assert got == {0: (1, [(0, "Apache")]), 1: (4, [(2, "Apache"), (3, "MIT")]), 2: (1, []), 3: (1, []), 4: (1, []), 5: (2, [(1, "Apache")])}
    every = licences.scan(docs, model).collect()
    assert len(every) == len(corpus) and not any(r.notices for r in every)
    assert licences.scan(nothing, model).count() == 0


def test_licence_query_finds_the_notices_of_the_table(spark):
    got = licences.query(spark, SF).toPandas().set_index("doc_id").families
    texts = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id").text
    marks = {"MIT": "MIT License", "GPL": "GNU General Public", "Apache": "Apache License", "CC-BY-NC": "CC BY-NC"}
    want = texts.map(lambda t: ",".join(sorted(k for k, v in marks.items() if v in t)))
    assert (got.sort_index() == want.sort_index()).all() and (want != "").any()


OTHER_LICENCES = [
    "Licensed under the Eclipse Public License, version 2.0", "Artistic License, Version 2.0", "SPDX-License-Identifier: EPL-2.0",
    "Licensed under CC BY-ND 4.0", "Licensed under CC BY-NC-SA 4.0", "Released under the ISC License", "Licensed under the zlib License",
    "Boost Software License, Version 1.0", "Licensed under the European Union Public Licence, version 1.2", "SPDX-License-Identifier: Unlicense",
    "SPDX-License-Identifier: CDDL-1.0", "This work is licensed under the Open Data Commons Attribution License",
    "Licensed under the Common Development and Distribution License, version 1.0", "Released under the PostgreSQL License",
    "Licensed under the SIL Open Font License, Version 1.1", "Released under the Python Software Foundation License",
    "Licensed under the Microsoft Public License", "Licensed under the IBM Public License, version 1.0", "SPDX-License-Identifier: BSL-1.1",
    "This work is licensed under the Creative Commons Attribution-NoDerivatives 4.0 International License", "Licensed under the Zope Public License, version 2.1",
]


def test_licences_outside_the_families_are_unknown(spark, model):
    rows = [(i, t) for i, t in enumerate(OTHER_LICENCES)] + [(100, "Licensed under the Mozilla Public License, version 2.0"), (101, "Licensed under CC BY-NC 4.0")]
    got = licences.scan(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), model).collect()
    assert {r.doc_id: [n.family for n in r.notices] for r in got} == dict.fromkeys(range(len(OTHER_LICENCES)), []) | {100: ["MPL"], 101: ["CC-BY-NC"]}
