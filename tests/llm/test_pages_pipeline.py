import html
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docloom import session
from docloom.llm import queries, similar, wrappers
from tests.llm.conftest import words

SF = "/root/testdata/sf0.001"


def test_blocks_of_a_page():
    page = """<!doctype html><head><title>No</title><style>p{}</style></head><body class="x"><header>Top</header>
    <nav><ul><li><a href=/a>A</a></li></ul></nav><div class="ad">Buy</div><div id="cookie-notice">We <b>use</b> cookies</div>
    <article><header><h1>A &amp; B&nbsp;&#233;</h1></header><p>One<b>two</b> three<br>four<p>five <!-- <p>no</p> -->six
    <script>var t = "</p>";</script><aside>Side</aside><form>Name<input><button>Go</button></form>
    <blockquote>q &lt;i&gt; &amp</blockquote><div class="comments"><p>First!</p><div>Me too</div></div><p>end</p></article>
    <footer>&copy;</footer></body>"""
    assert " ".join(t for _, t in wrappers.read(page)[2]) == "A & B é Onetwo three four five six q <i> & end"


@pytest.mark.parametrize("page", ["", "<", "<<<>", "plain  text", "<nav>never closed<p>x", "<p a='>'>x", "<article>", "</article></nav>", "<!-- open", "<script>x"])
def test_broken_pages_are_read(page):
    _, _, found = wrappers.read(page)
    assert " ".join(t for _, t in found) in ("", "<", "<<< >", "<< <>", "<<<>", "plain text", "x")


def test_repeats_fold_from_the_inside():
    stream = "<ul> <li> # </li> <li> # </li> </ul> <ul> <li> # </li> <li> # </li> <li> # </li> </ul> #".split()
    symbols, kept = wrappers.fold(stream)
    assert symbols == ["(<ul> (<li> # </li>)+ </ul>)+", "#"] and kept == [5]
    assert wrappers.body_of(symbols[0]) == ["<ul>", "(<li> # </li>)+", "</ul>"]
    assert wrappers.fold([]) == ([], [])


def test_alignment_finds_slots_options_and_repeats():
    a = wrappers.entries("<h1> # </h1> (<p> # </p>)+ <div> # </div>".replace("(<p> # </p>)+", "G").split(), [1, 7], [1, 7])
    b = wrappers.entries("<h1> # </h1> <p> # </p> <b> </b> <div> # </div>".split(), [2, 5, 7], [2, 5, 7])
    a = [("(<p> # </p>)+", *x[1:]) if x[0] == "G" else x for x in a]
    assert wrappers.expression(wrappers.align(a, b)) == "<h1> # </h1> (<p> # </p>)+ <b>? </b>? <div> text </div>"


def test_template_text_is_left_out_and_articles_are_not(spark):
    plain = "<html><body><p>Welcome</p><div>{}</div><p>Call us</p></body></html>"
    rows = [(i, "http://A.example/x", plain.format(f"text {i}")) for i in range(5)]
    rows += [(10 + i, "http://b.example/y", "<article><p>same</p></article>") for i in range(5)]
    rows += [(20, "http://c.example/z", plain.format("alone")), (21, None, None), (21, None, ""), (None, "x", "<p>no host")]
    frame = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").withColumns({"host": F.lit(1), "text": F.lit("t"), "key": F.lit(0)}).repartition(3)
    got = Counter((r.page_id, r.text) for r in wrappers.main_text(frame).collect())
    want = [(i, f"text {i}") for i in range(5)] + [(10 + i, "same") for i in range(5)]
    assert got == Counter(want + [(20, "Welcome alone Call us"), (21, ""), (21, ""), (None, "no host")])
    found = {r.host: r for r in wrappers.wrappers(frame).collect()}
    a = found["a.example"]
    assert a.pages == 5
    assert wrappers.expression(list(zip(a.symbol, a.optional, a.low, a.high))) == "<html> <body> <p> text </p> <div> # </div> <p> text </p> </body> </html>"
    assert wrappers.main_text(frame.limit(0)).count() == 0


def test_pages_of_the_table(spark):
    def main(page):
        inside = re.sub(r"</?b>", "", re.search(r"<article>(.*)</article>", page, re.S)[1])
        return " ".join(" ".join(html.unescape(x).split()) for x in re.split(r"<(?:/?p|/?h1|br)>", inside) if x.strip())

    got = wrappers.query(spark, SF).toPandas().set_index("page_id")
    pages = spark.read.parquet(f"{SF}/pages.parquet").toPandas().set_index("page_id").html
    assert (got.text.sort_index() == pages.map(main).sort_index()).all() and (got.n_chars == got.text.str.len()).all()


def test_stages_take_odd_tables(spark, docs, nothing, tmp_path):
    labels = [(i, int(i % 9 == 0)) for i in range(0, 60, 2)] + [(None, 1), (3, None)]
    spark.createDataFrame(labels, "doc_id BIGINT, toxic INT").write.parquet(str(tmp_path / "labels.parquet"))
    for rows in (docs, nothing):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, rows, str(tmp_path))
            got.write.parquet(str(tmp_path / f"{name}-{rows.count()}"))
            if name != "packing":
                assert got.columns == rows.columns
    exact = spark.read.parquet(str(tmp_path / f"exact_dedup-{docs.count()}")).toPandas()
    whole = docs.toPandas()
    lower = lambda t: t.fillna("").map(lambda x: x.encode().lower())
    assert sorted(lower(exact.text)) == sorted(set(lower(whole.text)))


def five(text):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def alike(a, b):
    return bool(a) and len(a & b) >= 0.8 * len(a | b)


def test_near_copies_are_those_of_brute_force(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 60, 200, 3000]))] for _ in range(40)]
    rows = []
    for i, w in enumerate(base):
        rows.append((i, " ".join(w)))
        for k in range(rng.randint(0, 6)):  # a few words changed, more or less than the similarity allows
            copy = list(w)
            for _ in range(rng.randint(0, max(1, len(w) // 30))):
                copy[rng.randrange(len(copy))] = "x" + rng.choice(vocabulary)
            rows.append((100 + 10 * i + k, " ".join(copy).upper() if k % 2 else "\n".join(copy)))
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(5)
    sets = {i: five(t) for i, t in rows}
    root = {i: i for i in sets}
    for _ in range(5):
        for i in sets:
            for j in sets:
                if root[j] < root[i] and alike(sets[i], sets[j]):
                    root[i] = root[j]
    assert sorted(r.doc_id for r in similar.one_of_each_group(frame).collect()) == sorted(i for i in root if root[i] == i)


def test_near_copies_are_told_apart_by_text(spark, nothing):
    near = " ".join(f"w{i}" for i in range(100))
    rows = [(3, near), (7, near + " end"), (7, "an unrelated text of the same id"), (7, "an unrelated text of the same id"), (None, near + " more"), (None, "no id"), (5, None), (6, ""), (8, "  "), (9, "one two")]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id BIGINT, text STRING, digest INT, n INT")
    got = similar.one_of_each_group(frame)
    assert got.columns == frame.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == [(0, "no id"), (3, near), (5, ""), (7, "an unrelated text of the same id"), (8, "  "), (9, "one two")]
    assert similar.one_of_each_group(nothing).count() == 0


def test_large_groups_are_dealt_over_ranges(spark):
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*base, f"end{i}"])) for i in range(600)] + [(1000 + i, f"alone {i} " + " ".join(f"v{i}{j}" for j in range(9))) for i in range(100)]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(6)
    pairs = similar.candidates(similar.sketches(frame.selectExpr("unhex(md5(text)) AS digest", "text")))
    assert pairs.count() < 600 * 12
    assert sorted(r.doc_id for r in similar.one_of_each_group(frame).collect()) == [0, *range(1000, 1100)]


def test_fingerprints_bring_in_pairs_without_a_common_key(spark):
    r = random.Random(239)
    same = "again and again " * 300 + " ".join(f"w{r.randrange(10**6)}" for _ in range(32))
    rows = [(i, f"{same} " + " ".join(f"{c}{r.randrange(10**6)}" for _ in range(4))) for i, c in ((1, "x"), (2, "y"))]
    assert alike(*(five(t) for _, t in rows))
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert similar.candidates(similar.sketches(frame.selectExpr("unhex(md5(text)) AS digest", "text"))).count() == 0
    assert [row.doc_id for row in similar.one_of_each_group(frame).collect()] == [1]


def crowd(n):
    """Pairs of texts with a similarity of 0.81 inside, all of which have one of 0.79 to the others and keys in common with them."""
    base = [f"w{i}" for i in range(89)]
    return [(i + n * side, " ".join([*base, f"own{i}", *[f"{side}-{i}-{j}" for j in range(10)]])) for i in range(n) for side in (0, 1)]


def test_all_texts_of_a_key_are_compared(spark):
    rows = crowd(60)
    sets = {i: five(t) for i, t in rows}
    assert {(i, j) for i in sets for j in sets if i < j and alike(sets[i], sets[j])} == {(i, i + 60) for i in range(60)}
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    assert sorted(r.doc_id for r in similar.one_of_each_group(frame).collect()) == list(range(60))


def test_unconnected_texts_are_compared_in_blocks(spark):
    texts = spark.createDataFrame(crowd(20), "doc_id BIGINT, text STRING").selectExpr("unhex(md5(text)) AS digest", "text")
    sketched = session.pinned(similar.sketches(texts))
    members = session.pinned(similar.keyed(sketched).where("b IS NULL").select("band", "value", "a", "n_a"))
    alone = spark.createDataFrame([], "node BINARY, root BINARY")
    found = [sorted((bytes(r.a), bytes(r.b)) for r in similar.unconnected(members, alone, sketched, block).collect()) for block in (1000, 3)]
    sets = {bytes(r.digest): five(r.text) for r in texts.collect()}
    pairs = {(a, b) for a in sets for b in sets if a < b and alike(sets[a], sets[b])}
    assert found[0] == found[1] and len(pairs) == 20 and pairs <= set(found[0]) and len(set(found[0])) == len(found[0])
    one = texts.selectExpr("digest AS node", "unhex('00') AS root")
    assert similar.unconnected(members, one, sketched).count() == 0


def test_signatures_never_rule_out_similar_sets():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (1, 7, 300, 5000):
        a, b = rng.integers(0, 1 << 63, (2, n), np.uint64)
        b[: n * 9 // 10] = a[: n * 9 // 10]
        bits = [np.frombuffer(similar.signature(np.unique(x)), np.uint8) for x in (a, b)]
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(a, b)) and len(bits[0]) == similar.BITS // 8


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Each stage's decisions are those of its operator's query form, which other tests hold against brute force."""
    from docloom.llm import exact_dedup, mixing, packing, toxicity

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    toxic = toxicity.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).toPandas()
    left = {i: texts[i] for i in toxic[toxic.predicted == 0].doc_id}
    last = {}
    for i in sorted(left):
        last[left[i].encode().lower()] = i
    left = {i: texts[i] for i in last.values()}
    shingles = {i: five(t) for i, t in left.items()}
    root = {i: i for i in left}
    moved = True
    while moved:
        moved = False
        for i in left:
            for j in left:
                if root[j] < root[i] and alike(shingles[i], shingles[j]):
                    root[i], moved = root[j], True
    left = {i: t for i, t in left.items() if root[i] == i}
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert set(got.doc_id) <= set(left)
    counts = Counter(got.doc_id)
    sources = {r.doc_id: r.source for r in docs.collect()}
    words = {i: len(t.encode().split()) for i, t in left.items()}
    order = sorted({sources[i] for i in left})
    per = {s: sum(words[i] for i in left if sources[i] == s) for s in order}
    targets = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(per.items()), "source STRING, source_size BIGINT")).collect()}
    for s in order:
        mine = [i for i in left if sources[i] == s]
        assert abs(sum(counts[i] * words[i] for i in mine) - targets[s]) <= max(words[i] for i in mine) / 2
        assert all(int(targets[s] / per[s]) <= counts[i] <= min(3, int(targets[s] / per[s]) + 1) for i in mine)
    assert (got.n_tokens == got.doc_id.map(words) + 1).all()
    assert not got.duplicated(["bucket_length", "batch", "slot"]).any()


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
    assert zlib.crc32(b"0") % 5 is not None


def main_texts(spark, rows):
    frame = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").repartition(3)
    return {r.page_id: r.text for r in wrappers.main_text(frame).collect()}


def test_template_text_inside_articles_is_left_out(spark):
    page = "<body><article><h1>Title {0}</h1><div>Read our offer</div><p>text {0}</p><ul><li><a>One</a></li><li><a>Two</a></li></ul></article></body>"
    rows = [(i, "http://a.example/x", page.format(i)) for i in range(6)]
    # a copied article makes no template
    rows += [(10 + i, "http://b.example/x", "<article><p>same</p></article>") for i in range(6)]
    got = main_texts(spark, rows)
    assert got == {i: f"Title {i} text {i}" for i in range(6)} | {10 + i: "same" for i in range(6)}


def test_odd_pages_of_a_host_keep_its_template(spark):
    page = "<body><div>Welcome</div><p>Join us</p><p>text {0}</p><p>more {0}</p><div>Call us</div></body>"
    rows = [(i, "http://a.example/x", page.format(i)) for i in range(8)]
    odd = [(20, None), (21, ""), (22, "<h1>Error</h1>"), (23, "<table><tr><td>9</td></tr></table>")]
    got = main_texts(spark, rows + [(i, "http://a.example/x", h) for i, h in odd])
    assert got == {i: f"text {i} more {i}" for i in range(8)} | {20: "", 21: "", 22: "Error", 23: "9"}


def test_streams_of_a_host_are_aligned_in_bounded_parts(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "FAN", 4)
    monkeypatch.setattr(wrappers, "WIDE", 30)
    tags = "h2 h3 h4 h5 h6 pre dl table section figure".split()

    def page(i):
        return "<p>Welcome</p>" + "".join(f"<{t}>{t} {i}</{t}>" for k, t in enumerate(tags[:7]) if i >> k & 1) + f"<div>text {i}</div><p>Call us</p>"

    rows = [(i, "http://a.example/x", page(i)) for i in range(100)]
    frame = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    found = wrappers.streams(wrappers.pinned(wrappers.looks(wrappers.prepared(frame, "page_id", "url", "html"))))
    made = found.groupBy("part").count().toPandas()
    assert made["count"].sum() == 100 and made["count"].max() <= 16 and len(made) > 15
    one = wrappers.wrappers(frame).collect()
    assert len(one) == 1 and one[0].pages == 100
    got = main_texts(spark, rows)
    want = {i: " ".join([*(f"{t} {i}" for k, t in enumerate(tags[:7]) if i >> k & 1), f"text {i}"]) for i in range(100)}
    assert got == want


def test_texts_that_a_wide_wrapper_drops_still_have_a_place(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "FAN", 64)
    monkeypatch.setattr(wrappers, "WIDE", 30)
    tags = "h3 h4 h5 h6 pre dl".split()
    plain = "<address>text {0}</address>" + "".join(f"<h2>{t} {{0}}</h2><{t}>more {{0}}</{t}>" for t in tags)
    rows = [(i, "http://a.example/x", plain.format(i)) for i in range(40)]

    def page(i):
        return f"<section>Subscribe today</section><address>text {i}</address>" + "".join(f"<{t}>{t} {i}</{t}>" for k, t in enumerate(tags) if i >> k & 1)

    # too few of each kind to stay in the wrapper, but more than half of the host's pages together
    rows += [(i, "http://a.example/x", page(i)) for i in range(100, 160)]
    got = main_texts(spark, rows)
    assert got == {i: " ".join([f"text {i}", *(f"{t} {i} more {i}" for t in tags)]) for i in range(40)} | {
        i: " ".join([f"text {i}", *(f"{t} {i}" for k, t in enumerate(tags) if i >> k & 1)]) for i in range(100, 160)
    }


@pytest.mark.parametrize("open_, close", [
    ('<html class="no-menu"><body><p>', "</p></body></html>"), ('<body class="has-sidebar"><p>', "</p></body>"), ('<main class="search results"><p>', "</p></main>"),
    ('<body><article class="post share"><p>', "</p></article></body>"), ('<article><h1>T</h1><div class="share text">', "</div></article>"),
])
def test_class_words_leave_out_no_whole_page(open_, close):
    words = " ".join(["text"] * 20)
    page = f'{open_}{words}<div class="ad">Buy</div>{close}'
    assert " ".join(t for _, t in wrappers.read(page)[2]).removeprefix("T ").startswith(words)


def test_class_words_still_leave_out_comments_and_notices():
    page = '<main><article class="post share"><p>long enough text of the page</p></article><div class="comments"><article class="comment">Me</article></div></main><p class="ad">Buy</p>'
    assert [t for _, t in wrappers.read(page)[2]] == ["long enough text of the page"]


@pytest.mark.parametrize("page, want", [
    # reader comments and sidebars longer than the article
    ('<article><p>short</p><div class="comments">' + "long " * 50 + "</div></article>", "short"),
    ('<p>short</p><div class="sidebar">' + "long " * 50 + "</div>", "short"),
    ('<article><p>text</p></article><div class="comments"><article>Me</article><article>You</article></div>', "text"),
    # elements end without a tag
    ('<article><p class="notice">Note<p>Second<p>Third</article>', "Second Third"),
    ('<article><ul><li class="share">Tell<ul><li>them</ul><li>One more of them<li>Two</ul></article>', "One more of them Two"),
    ('<article><table><tr><td class="ad">Buy<td>Cell<tr><td>Next</table></article>', "Cell Next"),
    ('<article><dl><dt class="ad">Buy<dd>Kept</dl></article>', "Kept"),
    ('<article><p class="ad">Buy</article><article>More</article>', "More"),
    # names that only look like it
    ('<article><section class="search results">Found</section><p class="related work">Before us</p><div class="banner-image">Shown</div></article>', "Found Before us Shown"),
    ('<article><div class="has-sidebar">Kept</div><div class="related-links">See</div><div class="cookie-banner">Eat</div><div id="search">Find</div></article>', "Kept"),
    ('<article><p>a <span class="ad">Buy</span> b<br>c &amp; d</p></article>', "a b c & d"),
])
def test_elements_that_are_left_out(page, want):
    assert " ".join(t for _, t in wrappers.read(page)[2]) == want


def test_headings_that_articles_share_stay(spark):
    page = "<nav>Home</nav><article><h1>Cake {0}</h1><h2>Ingredients</h2><p>flour {0}</p><div>Rate this recipe</div><h2>Method</h2><p>bake {0} times</p></article>"
    got = main_texts(spark, [(i, "http://a.example/x", page.format(i)) for i in range(6)])
    assert got == {i: f"Cake {i} Ingredients flour {i} Method bake {i} times" for i in range(6)}


def test_a_very_long_page(spark):
    page = "<article>" + "".join(f"<p>par {i} <b>x</b></p><h3>t{i}</h3>" for i in range(8000)) + "</article>"
    rows = [(1, "http://a.example/x", page), (2, "http://a.example/y", "<article><p>short</p></article>")]
    got = main_texts(spark, rows)
    assert got[2] == "short" and got[1] == " ".join(f"par {i} x t{i}" for i in range(8000))
