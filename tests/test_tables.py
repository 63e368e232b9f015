import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import docloom as dl
from docloom import session
from docloom.operators.chunking import numbered_pieces, to_records
from docloom.plans.queries import QUERIES
from docloom.sinks import chunk_table as ct
from docloom.sinks.bodies import overwrite_bodies, stored_bodies
from docloom.streaming import incremental

CHUNK = "namespace string, _id string, document_id string, document_url string, document_date string, chunk_content string, chunk_section_id string"


def chunk(ns, doc, i, content, date="2024-01-01", section=None):
    return (ns, f"{doc}:chunk{i}", doc, "https://u", date, content, section)


def chunks(spark, *rows):
    return spark.createDataFrame(list(rows), CHUNK)


def contents(df):
    return {(r.namespace, r._id): r.chunk_content for r in df.collect()}


@pytest.fixture
def table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    dl.create_chunk_table(spark, name, str(tmp_path / name), bucket_rows=4)
    yield name
    spark.sql(f"DROP TABLE {name}")


def test_create_is_idempotent_and_keeps_properties(spark, table):
    dl.upsert_chunks(spark, table, chunks(spark, chunk("n", "d", 0, "x")))
    dl.create_chunk_table(spark, table)
    assert dl.read_chunks(spark, table).count() == 1
    assert {r.key: r.value for r in ct.table_properties(spark, table).collect()} == {
        "text_field": "chunk_content", "metric": "cosine", "bucket_rows": "4",
    }


def test_upsert_replace_delete(spark, table):
    first = chunks(spark, *[chunk("a", "d", i, f"old{i}") for i in range(3)], chunk("b", "d", 0, "other"), chunk("it's", "e", 0, "q"))
    summary = dl.upsert_chunks(spark, table, first)
    assert {tuple(r) for r in summary.collect()} == {("a", 3, 1, 3), ("b", 1, 1, 1), ("it's", 1, 1, 1)}
    shorter = chunks(spark, chunk("a", "d", 0, "new0", "2024-02-01"), chunk("a", "x", 0, "added"))
    dl.upsert_chunks(spark, table, shorter)
    assert contents(dl.read_chunks(spark, table)) == {
        ("a", "d:chunk0"): "new0", ("a", "d:chunk1"): "old1", ("a", "d:chunk2"): "old2", ("a", "x:chunk0"): "added",
        ("b", "d:chunk0"): "other", ("it's", "e:chunk0"): "q",
    }
    dl.replace_documents(spark, table, shorter)
    assert contents(dl.read_chunks(spark, table)) == {
        ("a", "d:chunk0"): "new0", ("a", "x:chunk0"): "added", ("b", "d:chunk0"): "other", ("it's", "e:chunk0"): "q",
    }
    assert dl.delete_namespace(spark, table, " a ") > 0
    assert dl.delete_namespace(spark, table, "unknown") == 0
    assert dl.delete_namespace(spark, table, "it's") == 1
    assert contents(dl.read_chunks(spark, table)) == {("b", "d:chunk0"): "other"}


def test_empty_payload_is_a_no_op_and_blank_namespaces_are_errors(spark, table):
    assert dl.upsert_chunks(spark, table, chunks(spark, chunk("a", "d", 0, "x")).limit(0)) is None
    with pytest.raises(ct.NamespaceError):
        dl.upsert_chunks(spark, table, chunks(spark, chunk(" ", "d", 0, "x")))
    for name in ("", "  ", None):
        with pytest.raises(ct.NamespaceError):
            dl.delete_namespace(spark, table, name)


def test_copies_of_a_key_keep_the_latest(spark):
    new = chunks(spark, chunk("n", "d", 0, "a", "2024-01-02"), chunk("n", "d", 0, "b", "2024-01-03"), chunk("m", "d", 0, "c"))
    assert contents(ct.upserted(new.limit(0), new)) == {("n", "d:chunk0"): "b", ("m", "d:chunk0"): "c"}


def test_batches(spark):
    rows = chunks(spark, *[chunk("n", f"d{d}", i, "x") for d in range(3) for i in range(50)], chunk("m", "d9", 0, "x"))
    pieces = rows.select("namespace", "document_id", F.substring_index("_id", "chunk", -1).cast("int").alias("i"))
    planned = dl.assign_batches(pieces, 0).collect()
    assert sorted(r.seq for r in planned if r.namespace == "n") == list(range(150))
    ordered = sorted((r.document_id, r.i, r.batch_no) for r in planned if r.namespace == "n")
    assert [b for *_, b in ordered] == [k // 64 for k in range(150)]
    assert {tuple(r) for r in dl.upsert_summary(rows, -1).collect()} == {("n", 150, 3, 22), ("m", 1, 1, 1)}
    assert {tuple(r) for r in dl.upsert_summary(rows.limit(3), 2).collect()} == {("n", 3, 2, 1)}


def test_json_lines_keep_empty_section_and_drop_null(spark, tmp_path):
    rows = chunks(spark, chunk("n", "d", 0, "é", section=""), chunk("n", "d", 1, "x"))
    dl.export_records(rows, str(tmp_path / "out"))
    lines = [json.loads(x) for f in (tmp_path / "out" / "namespace=n").glob("*.json") for x in f.read_text().splitlines()]
    found = {r["_id"]: r for r in lines}
    assert found["d:chunk0"]["chunk_section_id"] == "" and "chunk_section_id" not in found["d:chunk1"]
    assert found["d:chunk0"]["chunk_content"] == "é"
    raw = sum(len(json.dumps({k: v for k, v in r.items()}, ensure_ascii=False, separators=(",", ":")).encode()) for r in lines)
    assert tuple(dl.exported_bytes(rows).first()) == ("n", 2, raw)


def test_array_export_is_one_json_document(spark, tmp_path):
    values = ['q"uo\\te', "line\nbreak\ttab", "é😀/", "plain"]
    rows = [chunk("n", f"d{n % 2}", n // 2, v, section="" if n == 0 else None) for n, v in enumerate(values)]
    numbered = chunks(spark, *rows).withColumn("i", F.substring_index("_id", "chunk", -1).cast("int")).repartition(4)
    size = dl.export_array(numbered, str(tmp_path / "a"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "a").glob("part-*")))
    records = json.loads(text)
    assert [r["_id"] for r in records] == ["d0:chunk0", "d0:chunk1", "d1:chunk0", "d1:chunk1"]
    assert {r["chunk_content"] for r in records} == set(values)
    assert size == len(text.encode())
    assert json.dumps(records, ensure_ascii=False, indent=2) == text.rstrip("\n").replace("\n,\n", ",\n")
    dl.export_array(numbered.limit(0), str(tmp_path / "e"))
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "e").glob("part-*")))) == []


def test_stored_bodies_overwrite_by_path(spark, tmp_path):
    path = str(tmp_path / "bodies")
    make = lambda *r: spark.createDataFrame(list(r), "path string, content binary")
    overwrite_bodies(make(("/a", b"1"), ("/b", b"2")), path, 2)
    overwrite_bodies(make(("/a", b"3"), ("/c", b"4")), path, 2)
    assert {r.path: bytes(r.content) for r in stored_bodies(spark, path).collect()} == {"/a": b"3", "/b": b"2", "/c": b"4"}


SOURCES = "pos bigint, document_id string, document_url string, document_path string, namespace string, input_format string"


def six_sources(spark):
    kinds = [("m", "md", "markdown"), ("t", "txt", "text"), ("j", "json", "json"), ("y", "yml", "yaml"), ("bad", "json", "json"), ("p", "pdf", "pdf")]
    return spark.createDataFrame(
        [(n, d, f"https://e.com/{d}", f"docs/{d}.{s}", "ns", f) for n, (d, s, f) in enumerate(kinds)], SOURCES
    )


def test_whole_run(spark, table):
    stored = spark.createDataFrame(
        [("/docs/m.md", b"# A\r\nx"), ("/docs/j.json", b'{"a": 1}'), ("/docs/y.yml", b"b: 2"), ("/docs/bad.json", b"{not: json"), ("/docs/p.pdf", b"%PDF\xff")],
        "path string, content binary",
    )
    pages = spark.createDataFrame([("https://e.com/t", b"<p>Hi</p>", {})], "url string, content binary, headers map<string,string>")
    prepared = dl.prepare(six_sources(spark), stored, pages)
    assert tuple(prepared.status().first()) == (1, 0, 0)
    with pytest.raises(RuntimeError, match="bad: Invalid JSON input"):
        dl.ingest(spark, table, prepared, "2024-01-01")
    assert dl.read_chunks(spark, table).count() == 0
    undecoded, _ = dl.ingest(spark, table, prepared, "2024-01-01", strict=False)
    assert {r.document_id for r in undecoded.quarantine.collect()} == {"bad", "p"}
    texts = spark.createDataFrame([("p", 2, "two "), ("p", 1, "one")], "document_id string, page_no int, page_text string")
    chunked, summary = dl.ingest(spark, table, prepared, "2024-01-01", strict=False, page_texts=texts)
    assert [r.document_id for r in chunked.quarantine.collect()] == ["bad"]
    assert tuple(summary.first()) == ("ns", 5, 1, 5)
    rows = {r.document_id: r for r in dl.read_chunks(spark, table).collect()}
    assert {k: (r.chunk_content, r.chunk_section_id, r.document_date) for k, r in rows.items()} == {
        "m": ("x", "A", "2024-01-01"), "t": ("Hi", None, "2024-01-01"),
        "p": ("one\n\ntwo", None, "2024-01-01"), "j": ('{"a":1}', None, "2024-01-01"), "y": ('{"b":2}', None, "2024-01-01"),
    }


def files_of(spark, table):
    """Data files by partition."""
    rows = spark.table(table).select("namespace", "bucket", F.input_file_name().alias("f")).distinct().collect()
    found = {}
    for r in rows:
        found.setdefault((r.namespace, r.bucket), set()).add(r.f)
    return found


def test_buckets_grow_with_their_namespace(spark, table):
    hot = [chunk("hot", f"d{i}", 0, f"t{i}") for i in range(40)]
    for part in (hot[:3], hot[3:20], hot[20:]):
        dl.upsert_chunks(spark, table, chunks(spark, *part, chunk("small", "s", 0, "x")))
    assert {tuple(r) for r in ct.bucket_counts(spark, table).collect()} == {("hot", 16)}
    before = files_of(spark, table)
    assert {b for n, b in before if n == "small"} == {1} and {b for n, b in before if n == "hot"} <= set(range(16, 32))
    assert len(before) > 8
    expected = contents(chunks(spark, *hot, chunk("small", "s", 0, "x")))
    assert contents(dl.read_chunks(spark, table)) == expected
    # one changed document rewrites one bucket
    dl.replace_documents(spark, table, chunks(spark, chunk("hot", "d7", 0, "changed", "2024-02-01")))
    after = files_of(spark, table)
    assert len([k for k in after if after[k] != before.get(k)]) == 1
    assert contents(dl.read_chunks(spark, table)) == expected | {("hot", "d7:chunk0"): "changed"}
    assert dl.delete_namespace(spark, table, "hot") > 8
    assert ct.bucket_counts(spark, table).count() == 0
    dl.upsert_chunks(spark, table, chunks(spark, *hot[:2]))
    assert contents(dl.read_chunks(spark, table)) == contents(chunks(spark, *hot[:2], chunk("small", "s", 0, "x")))


def test_partitions_of_a_run_that_died_mean_nothing(spark, table):
    rows = [chunk("n", f"d{i}", 0, f"t{i}") for i in range(6)]
    dl.upsert_chunks(spark, table, chunks(spark, *rows[:3]))
    # written for eight buckets, but never named
    left = chunks(spark, *[chunk("n", f"d{i}", 0, "left") for i in range(40, 60)]).withColumn("bucket", F.lit(9))
    left.select(spark.table(table).columns).write.insertInto(table)
    assert contents(dl.read_chunks(spark, table)) == contents(chunks(spark, *rows[:3]))
    dl.upsert_chunks(spark, table, chunks(spark, *rows[3:], *[chunk("n", f"e{i}", 0, "e") for i in range(24)]))
    got = contents(dl.read_chunks(spark, table))
    assert len(got) == 30 and "left" not in got.values()
    assert ct.bucket_counts(spark, table).first().buckets == 8


def test_sources_without_a_body_are_reported(spark):
    bodies = spark.createDataFrame([("t", "x")], "document_id string, body string")
    chunked = dl.chunk_documents(bodies, six_sources(spark), "2024-01-01")
    assert {r.document_id: r.error for r in chunked.quarantine.collect()} == dict.fromkeys(["m", "j", "y", "bad", "p"], "no body")
    assert chunked.chunks.count() == 1
    assert dl.chunk_documents(bodies, six_sources(spark), report_missing=False).quarantine.count() == 0


def test_stream_takes_in_new_bodies_and_can_repeat(spark, table, tmp_path):
    bodies = tmp_path / "bodies"
    schema = "document_id string, body string"
    write = lambda *r: spark.createDataFrame(list(r), schema).write.mode("append").parquet(str(bodies))

    def run(checkpoint):
        stream = spark.readStream.schema(schema).parquet(str(bodies))
        query = dl.ingest_stream(stream, six_sources(spark), table, str(tmp_path / checkpoint), "2024-01-01")
        query.awaitTermination()

    write(("t", "one"))
    run("c1")
    write(("m", "# A\nx"))
    run("c1")
    expected = {("ns", "t:chunk0"): "one", ("ns", "m:chunk0"): "x"}
    assert contents(dl.read_chunks(spark, table)) == expected
    run("c2")
    assert contents(dl.read_chunks(spark, table)) == expected


def folders(spark):
    return {str(p) for p in Path(session.run_dir(spark).removeprefix("file:")).glob("*")}


def test_batches_of_a_stream_leave_no_intermediate_tables(spark, table, tmp_path):
    schema = "document_id string, body string"
    for i in range(3):
        spark.createDataFrame([("t", f"text {i}"), (f"d{i}", "x")], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    sources = six_sources(spark)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    session.pinned(spark.range(1))
    before, kept = folders(spark), spark.conf.get(session.DROP_SHUFFLES, None)
    dl.ingest_stream(stream, sources, table, str(tmp_path / "state"), "2024-01-01").awaitTermination()
    assert folders(spark) == before and spark.conf.get(session.DROP_SHUFFLES, None) == kept
    assert contents(dl.read_chunks(spark, table)) == {("ns", "t:chunk0"): "text 2"}
    lost = incremental.read_quarantine(spark, incremental.beside(str(tmp_path / "state")))
    assert {(r.document_id, r.batch) for r in lost.collect()} == {("d0", 0), ("d1", 1), ("d2", 2)}


def test_a_step_that_fails_leaves_no_intermediate_tables(spark):
    session.pinned(spark.range(1))
    before = folders(spark)
    with pytest.raises(ZeroDivisionError), session.step(spark):
        assert session.pinned(spark.range(3)).count() == 3
        assert folders(spark) != before
        1 / 0
    assert folders(spark) == before


def test_an_upsert_stores_no_copy_of_the_table(spark, table):
    dl.upsert_chunks(spark, table, chunks(spark, *[chunk("n", f"d{i}", 0, " ".join(uuid.uuid4().hex for _ in range(500))) for i in range(3)]))
    before = folders(spark)
    dl.upsert_chunks(spark, table, chunks(spark, chunk("n", "d0", 0, "new"), chunk("n", "e", 0, "e")))
    added = sum(f.stat().st_size for p in folders(spark) - before for f in Path(p).glob("*.parquet"))
    assert added < 20_000
    got = contents(dl.read_chunks(spark, table))
    assert len(got) == 4 and got["n", "d0:chunk0"] == "new" and len(got["n", "d1:chunk0"]) == 16_499


def test_partitions_are_rewritten_some_at_once(spark, table):
    dl.upsert_chunks(spark, table, chunks(spark, *[chunk("n", f"d{i}", 0, f"x{i}") for i in range(64)], chunk("m", "a", 0, "m")))
    assert ct.bucket_counts(spark, table).first().buckets == 16 > ct.AT_ONCE
    dl.upsert_chunks(spark, table, chunks(spark, *[chunk("n", f"d{i}", 0, f"y{i}") for i in range(0, 64, 2)]))
    dl.upsert_chunks(spark, table, chunks(spark, chunk("n", "new", 0, "new")))  # touches one bucket of the 32 there are now
    assert ct.bucket_counts(spark, table).first().buckets == 32
    expected = {("n", f"d{i}:chunk0"): f"{'x' if i % 2 else 'y'}{i}" for i in range(64)}
    assert contents(dl.read_chunks(spark, table)) == expected | {("n", "new:chunk0"): "new", ("m", "a:chunk0"): "m"}


def test_the_ingest_stream_query_keeps_its_result_only(spark, tmp_path):
    docs = [(i, f"s{i % 2}", f"text {i}") for i in range(40)]
    spark.createDataFrame(docs, "doc_id bigint, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    session.pinned(spark.range(1))
    before = folders(spark)
    got = {(r.document_id, r.chunk_content, r.error) for r in QUERIES["ingest_stream"](spark, str(tmp_path)).collect()}
    assert got == {(f"doc{i}", None if i % 11 == 5 else t, "no source" if i % 11 == 5 else None) for i, _, t in docs}
    assert len(folders(spark) - before) == 1


def test_records_have_the_fixed_shape(spark):
    docs = spark.createDataFrame([("d", "u", "n", "text", "a\n\nb")], "document_id string, document_url string, namespace string, input_format string, body string")
    pieces = numbered_pieces(dl.split_documents(docs), "namespace", "document_id", "document_url")
    row = to_records(pieces, "2024-05-06").first()
    assert row.asDict() == {
        "namespace": "n", "_id": "d:chunk0", "document_id": "d", "document_url": "u", "document_date": "2024-05-06",
        "chunk_content": "a\n\nb", "chunk_section_id": None,
    }
    with pytest.raises(ValueError):
        to_records(pieces, "06.05.2024")
