import hashlib
import math
import random
import unicodedata
import zlib
from collections import Counter, defaultdict
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.llm import language, trie, whitening
from docloom.llm.words import buffers

SF = "/root/testdata/sf0.001"


# --- language -------------------------------------------------------------------------------------------------------


def grams(text):
    """Folded n-grams of a text, by plain Python."""
    out = ""
    for c in text:
        kind = unicodedata.category(c)[0]
        low = c.lower() if kind == "L" and len(c.lower()) == 1 else c
        c = low if kind in "LM" else " "
        if c != " " or not out.endswith(" "):
            out += c
    return Counter(out[i : i + n] for n in (1, 2, 3) for i in range(len(out) - n + 1))


TEXTS = ["", "a", "Ab  c\n\nDé", "  ", "né̀ 1,2 ß", "日本語 テキスト", "x" * 50 + " " * 50 + "yZ" * 40, "İI ıi", "..", "a b" * 30]


@pytest.mark.parametrize("piece", [1 << 20, 7, 2])
def test_ngrams_are_those_of_plain_python_however_texts_are_cut(piece, monkeypatch):
    monkeypatch.setattr(language, "PIECE", piece)
    data, offsets = buffers(pa.array(TEXTS))
    found, lettered, names = defaultdict(Counter), set(), defaultdict(set)
    for text, place, some in language.runs(data, offsets):
        for t, p in zip(text.tolist(), place.tolist()):
            found[t][p] += 1
        lettered |= set(some.tolist())
    for i, text in enumerate(TEXTS):
        want = grams(text)
        assert sorted(found[i].values()) == sorted(want.values())
        assert (i in lettered) == any(unicodedata.category(c)[0] == "L" for c in text)
        for gram, n in want.items():
            names[n, gram].add(i)
    # one text as a whole or among others has the same places
    alone = buffers(pa.array([TEXTS[2]]))
    assert Counter(p for _, place, _ in language.runs(*alone) for p in place.tolist()) == found[2]


def test_ftrl_takes_the_steps_of_the_scalar_form():
    rng = np.random.default_rng(3)
    rows = [(np.array([0, 2]), np.array([0.6, 0.8])), (np.array([1]), np.array([1.0])), (np.array([0, 1, 2]), np.array([0.5, 0.5, 0.7]))]
    y = rng.integers(0, 2, len(rows))
    rate, beta, l1, l2 = 0.5, 1.0, 0.45, 0.2
    got, bias = language.fit(rows, y, 3, 2, 2, rate, beta, l1, l2)
    z, n = [[0.0, 0.0] for _ in range(4)], [[0.0, 0.0] for _ in range(4)]

    def weight(i, k):
        a, b = (0, 0) if i == 3 else (l1, l2)
        if abs(z[i][k]) <= a:
            return 0.0
        return -(z[i][k] - math.copysign(a, z[i][k])) / ((beta + math.sqrt(n[i][k])) / rate + b)

    for _ in range(2):
        for (at, x), true in zip(rows, y):
            at, x = [*at.tolist(), 3], [*x.tolist(), 1.0]
            w = [[weight(i, k) for k in range(2)] for i in at]
            e = [math.exp(sum(v * wi[k] for v, wi in zip(x, w))) for k in range(2)]
            for i, v, wi in zip(at, x, w):
                for k in range(2):
                    g = v * (e[k] / sum(e) - (k == true))
                    s = (math.sqrt(n[i][k] + g * g) - math.sqrt(n[i][k])) / rate
                    z[i][k] += g - s * wi[k]
                    n[i][k] += g * g
    assert got.tolist() == pytest.approx(np.array([[weight(i, k) for k in range(2)] for i in range(3)]))
    assert bias.tolist() == pytest.approx([weight(3, 0), weight(3, 1)])
    assert (got == 0).any()


def test_temperature_is_the_best_of_a_grid():
    rng = np.random.default_rng(0)
    true = rng.normal(size=(400, 3))
    y = np.array([rng.choice(3, p=p) for p in language.softmax(true)])
    found = language.temperature(true * 4, y)
    loss = lambda t: -np.log(language.softmax(true * 4 / t)[np.arange(400), y]).mean()
    assert loss(found) <= min(loss(t) for t in np.linspace(0.5, 15, 100)) + 1e-6
    assert found == pytest.approx(4, rel=0.3)
    assert language.temperature(np.empty((0, 3)), np.empty(0, int)) == 1


def test_idf_and_features_come_from_all_learning_rows(spark):
    rows = [("ab", "x"), ("ab!", "x"), ("ac", "y"), ("ad", "y"), ("..", "y"), (None, "x")]
    df = spark.createDataFrame(rows, "text string, lang string").where("text IS NOT NULL")
    counts = language.document_counts(df)
    totals = {r.lang: r.n for r in counts.where("place = -1").collect()}
    assert totals == {"x": 2, "y": 2}
    # a is in all texts and tells nothing; b and ab are in both texts of x
    places, idf = language.chosen(counts, totals, 2, least=1)
    want = sorted(next(iter(place)) for place in ({p for _, ps, _ in language.runs(*buffers(pa.array(["b"]))) for p in ps.tolist()},))
    assert want[0] in places
    assert idf.tolist() == pytest.approx([math.log(5 / 3) + 1] * 2)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count()
    want = [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]
    assert got.held_out.tolist() == want
    assert (got[got.held_out].lang_pred == got[got.held_out].lang).mean() >= 0.95
    assert got.score.between(0, 1).all()


def test_languages_take_odd_tables(spark, docs, nothing):
    assert language.languages(nothing).count() == 0
    got = language.languages(docs).toPandas()
    assert len(got) == docs.count()
    odd = docs.where("text IS NULL OR NOT text RLIKE '\\\\p{L}'").count()
    assert (got.lang_pred == "und").sum() == odd > 0
    assert set(got[got.lang_pred != "und"].score) == {1.0}  # one language
    unlabelled = language.languages(docs.withColumn("lang", F.lit(None).cast("string"))).toPandas()
    assert set(unlabelled.lang_pred) == {"und"} and set(unlabelled.score) == {0.0}


def test_held_out_rows_teach_nothing(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, "wort und satz" if i % 2 else "mot et phrase", ("de" if i % 2 else "fr") if i not in ids else "zz") for i in range(400)]
    got = language.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).toPandas()
    assert set(got.lang_pred) == {"de", "fr"}
    assert all(r.lang_pred == ("de" if r.doc_id % 2 else "fr") for r in got.itertuples())


# --- trie -------------------------------------------------------------------------------------------------------------


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    turns = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = turns.get(c - int(math.fmod(c, 100)), [])[:h] + turns[c][h:]
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c in sorted(paths):
        path = tuple(paths[c])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[: d - 1]].add(path[:d])
        ends[path].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = sum(saved[x] for x in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    return sorted(
        (m[0], len(x), members[x[:-1]][0] if x else None, len(m), len(children[x]), leaves[x], saved[x], hashlib.sha256(",".join(map(str, ends[x])).encode()).hexdigest())
        for x, m in members.items()
    )


def trie_rows(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r[n] for n in names) for r in df.collect())


TURNS = "conv_id long, turn long, role string, text string, depth string, conv string, node int, h int"


def turns_table(spark, rows):
    return spark.createDataFrame([(*r, "d", "c", 1, 2) for r in rows], TURNS).repartition(3)


def test_trie_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 4)
    rng = random.Random(4)
    rows = []
    for c in [*range(0, 40), *range(100, 130), 250, 260, -7, 0]:
        n = rng.randint(1, 9)
        rows += [(c, t, rng.choice(["user", "bot"]), rng.choice(["hi", "ho", "é日", ""])) for t in range(n)]
    # a caterpillar: each one leaves the long one a turn later; some end on it
    long = [("user", f"t{i % 3}") for i in range(60)]
    for c in range(300, 340):
        rows += [(c, t, *x) for t, x in enumerate(long[: c - 290])] + ([(c, 99, "user", str(c))] if c % 3 else [])
    rows += [(300, t + 200, *x) for t, x in enumerate(long)]
    rows += [(c, t, "user", "copy") for c in range(400, 440) for t in range(3)]
    rows += [(5, None, None, None), (5, None, "user", None), (5, 2, "user", "again"), (5, 2, "user", "again"), (None, 1, "user", "x"), (700, 0, "user", "one turn")]
    assert trie_rows(trie.prefix_trie(turns_table(spark, rows))) == brute_trie(rows)


def test_trie_of_odd_tables(spark):
    assert trie.prefix_trie(turns_table(spark, [])).count() == 0
    assert trie.prefix_trie(turns_table(spark, [(None, 0, "user", "x")])).count() == 0
    # 101 lends three turns of 100, which isn't there, and has one of its own: no turn is left
    alone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 3)
    rows = [(alone, 0, "user", "x")]
    assert trie_rows(trie.prefix_trie(turns_table(spark, rows))) == brute_trie(rows) == [
        (alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())
    ]


def test_the_search_tells_where_sequences_leave(spark, monkeypatch):
    rows = [(c, t, "user", str(c >> t)) for c in range(128) for t in range(8)] + [(200 + c, t, "bot", str(c >> (9 - t))) for c in range(160) for t in range(10)]
    want, found = brute_trie(rows), []

    def kept(active, nodes, paths):
        found.append(search(active, nodes, paths))
        return found[-1]

    search = trie.search
    monkeypatch.setattr(trie, "search", kept)
    assert trie_rows(trie.prefix_trie(turns_table(spark, rows))) == want
    assert len(found) == 1 and len({r.a for r in found[0].where("a < size").collect()}) > 3
    monkeypatch.setattr(trie, "search", lambda active, nodes, paths: active)
    assert trie_rows(trie.prefix_trie(turns_table(spark, rows))) != want


@pytest.mark.parametrize("early", [1, 3, 1 << 40])
def test_batches_of_any_size_give_the_same_trie(spark, monkeypatch, early):
    monkeypatch.setattr(trie, "EARLY", early)
    rows = [(c, t, "user", str(c % (t + 2))) for c in range(60) for t in range(c % 9 + 1)]
    assert trie_rows(trie.prefix_trie(turns_table(spark, rows))) == brute_trie(rows)


def test_two_fattest_depths(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", trie.fattest("a", "b").alias("f")).collect()
    for a, b, f in got:
        assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)


# --- whitening ----------------------------------------------------------------------------------------------------------


def test_characteristic_polynomial_is_exact(spark):
    rng = random.Random(2)
    m = [[rng.randint(-50, 50) for _ in range(6)] for _ in range(5)]
    a = [[sum(r[i] * r[j] for r in m) for j in range(6)] for i in range(6)]  # of rank 5
    # Faddeev and LeVerrier, in fractions
    want, b, identity = [Fraction(1)], [[Fraction(0)] * 6 for _ in range(6)], range(6)
    for k in range(1, 7):
        b = [[sum(a[i][x] * (b[x][j] + (want[-1] if x == j else 0)) for x in identity) for j in identity] for i in identity]
        want.append(-sum(b[i][i] for i in identity) / k)
    got = whitening.characteristic_polynomial(spark, a)
    assert got == [int(v) for v in reversed(want)]
    assert got[0] == 0 and whitening.roots_above(got, 0) == 5
    assert whitening.characteristic_polynomial(spark, [[0, 0], [0, 0]]) == [0, 0, 1]


def test_roots_with_repeats():
    c = [1]
    for root in (7, 7, 7, 3, 0, 2, 2):
        c = [(c[i - 1] if i else 0) - root * (c[i] if i < len(c) else 0) for i in range(len(c) + 1)]
    one = 1 << whitening.ROOT_BITS
    assert [whitening.kth_root(c, k, 23) for k in range(1, 7)] == [(7 * one, 0, 3), (7 * one, 1, 3), (7 * one, 2, 3), (3 * one, 0, 1), (2 * one, 0, 2), (2 * one, 1, 2)]
    golden = [-1, -1, 1]  # one root above 0, no whole number
    assert Decimal(whitening.kth_root(golden, 1, 3)[0]) / one == pytest.approx(Decimal(5).sqrt() / 2 + Decimal("0.5"), abs=Decimal(10) ** -25)


@pytest.mark.parametrize("value", [0, 1, -1, 2**32, -(2**32), 2**100 + 12345, -(2**100) - 3, 2**31])
def test_limbs(value):
    parts = list(whitening.limbs(value))
    assert sum(v << 32 * place for place, v in parts) == value
    assert all(abs(v) <= 1 << 32 for _, v in parts)


VECTORS = "vec_id long, embedding array<float>, component string, y int, k int"


def vectors_table(spark, rows):
    return spark.createDataFrame([(i, v, "c", 1, 2) for i, v in rows], VECTORS).repartition(3)


def test_whitening_equals_plain_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(150, 40)) @ np.diag(np.linspace(0.2, 3, 40))
    rows = [(i % 140, v.tolist()) for i, v in enumerate(x)]
    odd = [(900, None), (901, [1.0] * 39 + [None]), (902, [float("nan")] * 40), (903, [float("inf")] + [0.0] * 39), (904, [1.0]), (905, []), (None, rows[0][1])]
    got = whitening.whiten(vectors_table(spark, rows + odd)).toPandas()
    whole = np.floor(np.vstack([np.array(v, np.float32) for _, v in rows] + [np.array(rows[0][1], np.float32)]).astype(float) * 64) + 1_000_000
    n = len(whole)
    assert len(got) == n * 32 and set(got.n) == {n}
    centred = whole - whole.mean(0)
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:32], v[:, ::-1][:, :32]
    want = centred @ v / np.sqrt(e)
    deviation = ((n * whole - whole.sum(0)) ** 2).sum(1).astype(np.int64)
    for i in (0, 77, n - 1):
        key = None if i == n - 1 else rows[i][0]
        mine = got[got.vec_id.isna() if key is None else got.vec_id == key]
        mine = mine[mine.deviation == deviation[i]].sort_values("component")
        assert mine.component.tolist() == list(range(1, 33))
        assert np.abs(mine.whitened.to_numpy()) == pytest.approx(np.abs(want[i]), abs=1e-8)
    assert sorted(got.deviation) == sorted(np.repeat(deviation, 32))
    share = e / np.trace(centred.T @ centred / n)
    assert got.groupby("component").explained.first().to_numpy() == pytest.approx(share, rel=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_whitening_with_repeated_and_no_eigenvalues(spark):
    # five directions that vary alike, one that varies more, one that doesn't vary
    rows = [(2 * i + s, [float(6 if i == j == 5 else i == j and 2) * (1 if s else -1) for j in range(6)] + [4.0]) for i in range(6) for s in (0, 1)]
    got = whitening.whiten(vectors_table(spark, rows)).toPandas()
    assert sorted(got.component.unique()) == [1, 2, 3, 4, 5, 6]
    assert got.identity_error.iloc[0] < 1e-9
    assert got.groupby("component").explained.first().tolist() == pytest.approx([36 / 56] + [4 / 56] * 5)


def test_whitening_of_odd_tables(spark):
    columns = {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, []), (2, [])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = whitening.whiten(vectors_table(spark, rows))
        assert got.count() == 0 and set(got.columns) == columns
    huge = whitening.whiten(vectors_table(spark, [(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [-1e30, 2.0]), (4, [1e9, 2.0])])).toPandas()
    assert len(huge) == 8 and huge.deviation.isna().any()
    assert huge.identity_error.iloc[0] < 1e-4
