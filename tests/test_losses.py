"""Nothing gets lost or doubled: shared paths, unreadable bodies, missing pages, null namespaces, many partitions."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import docloom as dl
from docloom import session
from docloom.functions.markdown import block_states
from docloom.functions.text import quoted
from docloom.plans import pipeline
from docloom.schemas import CHUNKS
from docloom.sinks import chunk_table
from docloom.sinks.partitions import bucket, only_touched
from docloom.sources import registry
from docloom.streaming import incremental

SOURCES = "pos BIGINT, document_id STRING, document_url STRING, document_path STRING, namespace STRING, input_format STRING"


def source(pos, name, path, fmt="markdown"):
    return (pos, name, f"http://h/{name}", path, "ns", fmt)


def test_a_shared_path_has_one_body(spark):
    sources = spark.createDataFrame([source(0, "a", "x.md"), source(1, "b", "x.md"), source(2, "c", "y.md")], SOURCES)
    pages = spark.createDataFrame([(f"http://h/{n}", n.encode(), {"Content-Type": "text/plain"}) for n in "abc"], "url STRING, content BINARY, headers MAP<STRING, STRING>")
    stored = spark.createDataFrame([("/y.md", b"stored")], "path STRING, content BINARY")
    prepared = dl.prepare(sources, stored, pages, strict=False)
    assert sorted(map(tuple, prepared.bodies.collect())) == [("a", "a"), ("b", "a"), ("c", "stored")]


def test_every_source_is_accounted_for(spark):
    sources = spark.createDataFrame(
        [source(0, "ok", "a.txt", "text"), source(1, "bad", "b.json", "json"), source(2, "gone", "c.txt", "text"),
         source(3, "pages", "d.pdf", "pdf"), source(4, "nopages", "e.pdf", "pdf"), source(5, "blank", "f.txt", "text")], SOURCES
    )
    bodies = spark.createDataFrame([("ok", "text"), ("bad", "{"), ("blank", "  ")], "document_id STRING, body STRING")
    pages = spark.createDataFrame([("pages", 1, "page")], "document_id STRING, page_no INT, page_text STRING")
    chunked = pipeline.chunk_all(pipeline.Prepared(sources, bodies, None), "2024-01-01", pages).stored()
    got = {r.document_id: (r.outcome, r.n_chunks) for r in pipeline.report(sources, chunked).collect()}
    assert got == {"ok": ("chunked", 1), "bad": ("quarantined", 0), "gone": ("missing", 0), "pages": ("chunked", 1), "nopages": ("missing", 0), "blank": ("blank", 0)}
    with pytest.raises(RuntimeError, match="nopages: no body"):
        chunked.strict()


def test_a_stream_keeps_what_it_cannot_take_in(spark, tmp_path):
    table = "losses_stream"
    dl.create_chunk_table(spark, table, str(tmp_path / "table"))
    spark.createDataFrame([("ok", "text"), ("bad", "{"), ("stray", "x")], "document_id STRING, body STRING").write.parquet(str(tmp_path / "in"))
    sources = spark.createDataFrame([source(0, "ok", "a.txt", "text"), source(1, "bad", "b.json", "json")], SOURCES)
    stream = spark.readStream.schema("document_id STRING, body STRING").parquet(str(tmp_path / "in"))
    dl.ingest_stream(stream, sources, table, str(tmp_path / "state"), "2024-01-01").awaitTermination()
    lost = incremental.read_quarantine(spark, incremental.beside(str(tmp_path / "state"))).collect()
    assert {r.document_id for r in lost} == {"bad", "stray"}
    assert {r.document_id for r in dl.read_chunks(spark, table).collect()} == {"ok"}
    spark.sql(f"DROP TABLE {table}")


def test_records_without_a_namespace_stay(spark):
    rows = spark.createDataFrame([("a",), (None,), (" b",)], "namespace STRING")
    assert chunk_table.without_namespace(rows, " a ").count() == 2
    for blank in (None, "", " 　"):
        with pytest.raises(chunk_table.NamespaceError):
            chunk_table.without_namespace(rows, blank)


def test_many_touched_partitions_are_still_pruned(spark, tmp_path):
    columns = F.col("id").cast("string").alias("_id"), F.concat(F.lit("ns"), F.col("id") % 700).alias("namespace")
    rows = spark.range(1400).select(*columns).withColumn("bucket", bucket("_id", 1))
    rows.coalesce(1).write.partitionBy("namespace", "bucket").parquet(str(tmp_path / "t"))
    stored = spark.read.schema("_id string, namespace string, bucket int").parquet(str(tmp_path / "t"))
    touched = only_touched(stored, rows.where("namespace < 'ns65'"), ["namespace", "bucket"])
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "namespace#" in plan.split("PartitionFilters: [")[1].split("ReadSchema")[0]
    assert touched.count() == rows.where("namespace < 'ns65'").count() > 1000


@pytest.mark.parametrize("value", ["plain", "it's", 'say "x"', "it's \"x\"", "a\\b", "tab\there", "nl\n'", "\x00\x7f\xa0\xad", ""])
def test_values_are_shown_as_in_python(one, value):
    assert one(quoted(F.col("v")), "v STRING", value) == repr(value)


def test_code_blocks_end_with_their_own_fence():
    import numpy as np

    # 6 backticks, 7 tildes, 8 backticks closed on the line
    assert block_states(np.array([1, 6, 2, 7, 8, 1, 7, 6, 8, 7, 8, 1])).tolist() == [0, 1, 1, 1, 0, 0, 2, 2, 2, 0, 0, 0]
    assert block_states(np.array([], int)).tolist() == []


def test_registry_edit_saves_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "registry")
    rows = spark.createDataFrame([source(0, "a", "a.md"), source(1, "b", "b.md")], SOURCES)
    registry.save_sources(rows, path)
    check = lambda s: dl.validate_sources(s, "/")
    changed = registry.edit_sources(spark, path, check, spark.createDataFrame([source(0, "c", "c.md")], SOURCES), spark.createDataFrame([("a",)], "document_id STRING"))
    assert sorted(r.document_id for r in changed.collect()) == ["b", "c"]
    with pytest.raises(registry.InvalidSources):
        registry.edit_sources(spark, path, check, spark.createDataFrame([source(0, "d", "d.txt")], SOURCES))
    with pytest.raises(KeyError, match="unknown document id: 'zz'"):
        registry.edit_sources(spark, path, check, removals=spark.createDataFrame([("zz",)], "document_id STRING"))
    assert sorted(r.document_id for r in registry.read_sources(spark, path).collect()) == ["b", "c"]
    with pytest.raises(FileNotFoundError):
        registry.read_sources(spark, str(tmp_path / "none"))


def test_a_cluster_must_name_its_shared_folder():
    def cluster(master):
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: "/kept"), conf=SimpleNamespace(get=lambda name, default: None))

    assert session.shared_dir(cluster("local[4]")) == "/kept"
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(cluster(master))


def test_intermediate_tables_can_be_removed(spark):
    kept = session.pinned(spark.range(3))
    assert kept.count() == 3 and CHUNKS.names
    # only this frame's own folder is removed here: other tests share the application's
    path = kept.inputFiles()[0].rsplit("/", 1)[0]
    assert path.startswith(session.run_dir(spark)) or session.run_dir(spark) in path


def test_files_beyond_a_row_are_listed_not_opened(spark, tmp_path):
    from docloom.sources import files

    (tmp_path / "small.txt").write_text("small")
    (tmp_path / "large.txt").write_text("x" * 100)
    assert [r.body for r in files.read_bodies(spark, str(tmp_path), largest=50).collect()] == ["small"]
    assert [(r.path.rsplit("/", 1)[1], r.error) for r in files.too_large(spark, str(tmp_path), largest=50).collect()] == [("large.txt", "file has 100 bytes")]


def test_a_payload_with_a_key_twice_is_rejected(spark):
    rows = [("n", "a:chunk0", "a", "u", "2024-01-01", text, None) for text in ("x", "y")]
    old, new = spark.createDataFrame(rows[:1], CHUNKS), spark.createDataFrame(rows, CHUNKS)
    for change in (chunk_table.upserted, chunk_table.replaced):
        with pytest.raises(chunk_table.DuplicateKeys, match="n/a:chunk0"):
            change(old, new)
    assert [r.chunk_content for r in chunk_table.upserted(old, new.where("chunk_content = 'y'")).collect()] == ["y"]
