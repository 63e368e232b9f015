"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import html, text, urls
from docloom.functions.split import pieces_of
from docloom.functions import sql as sql_functions
from docloom.operators import chunking, landing, large_files, listing, longdocs, markdown_pages, numbering, validation
from docloom.plans import inputs, pipeline
from docloom.plans.inputs import BASE, LATER, RUN_DATE, of, read
from docloom.session import pinned, remove, run_dir, step
from docloom.sinks import chunk_table, export
from docloom.sources import files as file_source
from docloom.sources import registry
from docloom.streaming import incremental

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _chunks(documents: DataFrame, run_date: str = RUN_DATE) -> DataFrame:
    return chunking.Chunked(chunking.split_documents(documents), run_date).chunks


def _pieces(documents: DataFrame, *columns: str) -> DataFrame:
    """Numbered pieces of plain text documents."""
    numbered = documents.select(*columns, F.posexplode(pieces_of(F.col("body"))).alias("i", "_p"))
    return numbered.select(
        *columns,
        "i",
        F.col("_p.start").alias("piece_start"),
        F.col("_p.end").alias("piece_end"),
        F.col("_p.content").alias("content"),
    )


# --- sources ---------------------------------------------------------------------------------------------------


@query
def registry_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.coerce_entries(inputs.entries(spark, sf_dir))[0]


@query
def registry_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.coerce_entries(inputs.entries(spark, sf_dir))[1]


@query
def body_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = F.replace(F.col("text"), F.lit(" la "), F.lit("\r\nla\r"))
    tail = F.when(F.col("n_chars") % 13 == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    content = F.concat(F.encode(stored, "utf-8"), tail)
    return read(spark, sf_dir, "documents").select("doc_id", file_source.decode_strict(content).alias("body"))


@query
def page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = file_source.normalise_pages(inputs.responses(spark, sf_dir))
    return pages.select(
        "page_id",
        F.col("headers")["content-type"].alias("content_type"),
        F.array_join(F.sort_array(F.map_keys("headers")), ",").alias("names"),
        F.length("content").alias("n_bytes"),
    )


@query
def pdf_page_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longdocs.assemble_pages(inputs.pdf_pages(spark, sf_dir))


@query
def large_file_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files of fifty documents each, read by byte ranges and split from their parts."""
    path = f"{run_dir(spark)}/{uuid.uuid4()}"
    text = F.concat(F.coalesce("text", F.lit("")), F.lit("\n"))
    texts = read(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("doc_id") / 50).alias("file_no"), text.alias("value"))
    texts.repartition("file_no").sortWithinPartitions("file_no", "doc_id").select("file_no", "value").write.partitionBy("file_no").text(path)
    large = large_files.read_large(spark, path, larger_than=0, part_bytes=1 << 15)
    file_no = F.regexp_extract("document_id", "file_no=([0-9]+)", 1).cast("bigint").alias("file_no")
    return large.pieces().select(file_no, "i", F.col("start").alias("piece_start"), "content")


@query
def missing_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources, files = inputs.sources(spark, sf_dir), inputs.files(spark, sf_dir)
    return landing.missing_bodies(sources, files, BASE).select("document_id", "path")


@query
def source_body_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = inputs.sources(spark, sf_dir).withColumn("path", urls.resolve(F.col("document_path"), BASE))
    return resolved.join(inputs.files(spark, sf_dir), "path").select("document_id", "input_format", "path", "length")


# --- registry --------------------------------------------------------------------------------------------------


@query
def registry_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validate_sources(inputs.broken_sources(spark, sf_dir), BASE, inputs.files(spark, sf_dir))


@query
def registry_error_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.error_report(inputs.broken_sources(spark, sf_dir), BASE)


@query
def registry_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.listing(inputs.sources(spark, sf_dir), BASE)


@query
def listing_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.widths(listing.listing(inputs.sources(spark, sf_dir), BASE))


@query
def listing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.padded(listing.listing(inputs.sources(spark, sf_dir), BASE))


@query
def listing_tabbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.tabbed(inputs.sources(spark, sf_dir))


@query
def select_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.select_sources(inputs.sources(spark, sf_dir), all_docs=True, single_id="page7")


@query
def select_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.select_sources(inputs.sources(spark, sf_dir), single_id="page7")


@query
def lookup_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = read(spark, sf_dir, "labels").selectExpr("concat('page', doc_id) AS document_id")
    return registry.look_up(inputs.sources(spark, sf_dir), wanted)[1]


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels")
    return labels.selectExpr(
        "doc_id AS pos",
        "concat('page', doc_id) AS document_id",
        "concat('https://changed.example.org/', doc_id) AS document_url",
        f"{of(inputs.PATH, 'doc_id')} AS document_path",
        "concat('q', quality) AS namespace",
        f"{of(inputs.FORMAT, 'doc_id')} AS input_format",
    )


@query
def registry_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.upsert_sources(inputs.sources(spark, sf_dir), _changes(spark, sf_dir))


@query
def registry_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = _changes(spark, sf_dir).select("document_id")
    return registry.remove_sources(inputs.sources(spark, sf_dir), gone, strict=False)


@query
def registry_save(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = inputs.sources(spark, sf_dir)
    path = f"{run_dir(spark)}/registry-{uuid.uuid4()}"
    registry.save_sources(sources, path, validation.validate_sources(sources, BASE))
    return registry.read_sources(spark, path)


@query
def registry_edit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved registry with some entries changed, added and removed in one validated step."""
    path = f"{run_dir(spark)}/registry-{uuid.uuid4()}"
    registry.save_sources(inputs.sources(spark, sf_dir), path)
    changes = _changes(spark, sf_dir)
    gone = changes.where("pos % 4 = 1").select("document_id")
    return registry.edit_sources(spark, path, lambda s: validation.validate_sources(s, BASE), changes, gone)


@query
def land_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies after landing what is missing: some sources have a stored body, and pairs of sources share a path."""
    sources = inputs.sources(spark, sf_dir).withColumn("document_path", F.expr(inputs.SHARED_PATH)).withColumn(
        "input_format", F.lit("markdown")
    )
    stored = sources.where("pos % 5 = 0").select(
        urls.resolve(F.col("document_path"), BASE).alias("path"), F.encode(F.concat(F.lit("stored "), F.col("pos")), "utf-8").alias("content")
    )
    prepared = pipeline.prepare(sources, stored, inputs.responses(spark, sf_dir), BASE, strict=False)
    return prepared.bodies.select("document_id", "body")


@query
def ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every source: texts, JSON with broken bodies, page texts, and PDF sources without pages."""
    entry = lambda name, fmt: F.struct(
        F.lit(0).cast("bigint").alias("pos"), name.alias("document_id"), F.lit("https://example.org/").alias("document_url"),
        F.lit("docs/x").alias("document_path"), F.lit("ns").alias("namespace"), F.lit(fmt).alias("input_format"),
    )
    texts = inputs.text_documents(spark, sf_dir).select("document_id", "body")
    nested = inputs.broken_bodies(spark, sf_dir).select("document_id", "body")
    pages = inputs.pdf_pages(spark, sf_dir)
    without = read(spark, sf_dir, "labels").selectExpr("concat('none', doc_id) AS document_id")
    listed = [(texts, "text"), (nested, "json"), (pages.select("document_id").distinct(), "pdf"), (without, "pdf")]
    sources = reduce(DataFrame.union, [df.select(entry(F.col("document_id"), fmt).alias("s")).select("s.*") for df, fmt in listed])
    prepared = pipeline.Prepared(sources, texts.union(nested), None)
    chunked = pipeline.chunk_all(prepared, RUN_DATE, pages).stored()
    return pipeline.report(sources, chunked).select("document_id", "outcome", "n_chunks")


@query
def path_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = "CASE WHEN page_id % 2 = 0 THEN concat('/abs//', page_id, '/./a.md') ELSE concat('docs/', page_id, '.md') END"
    pages = read(spark, sf_dir, "pages").selectExpr("page_id", f"{given} AS document_path")
    resolved = urls.resolve(F.col("document_path"), BASE)
    return pages.select("page_id", resolved.alias("path"), urls.suffix(resolved).alias("suffix"))


# --- landing ---------------------------------------------------------------------------------------------------


@query
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.with_text(read(spark, sf_dir, "pages"), F.col("html")).select("page_id", "text")


@query
def whitespace_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    ragged = F.replace(F.col("text"), F.lit(". "), F.lit(". \t\x0b\r\n\r\n\r\n \f\n"))
    ragged = F.replace(ragged, F.lit(" de "), F.lit("  de\t \n\n\n"))
    return read(spark, sf_dir, "documents").select("doc_id", text.normalize_whitespace(ragged).alias("text"))


@query
def charset_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.expr(
        "CASE page_id % 4 WHEN 0 THEN concat('text/html; CHARSET=iso-8859-', page_id % 9 + 1) "
        "WHEN 1 THEN 'text/html' WHEN 2 THEN 'text/html;charset=utf-16;charset=x' ELSE 'a/b; charset=\"u\"' END"
    )
    return read(spark, sf_dir, "pages").select("page_id", html.charset(kind).alias("charset"))


@query
def decode_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("doc_id") % 3
    name = F.when(kind == 0, F.lit("utf-8")).when(kind == 1, F.lit("UTF-8")).otherwise(F.lit("utf-16-le"))
    content = (
        F.when(kind == 0, F.encode("text", "utf-8"))
        .when(kind == 1, F.concat(F.unhex(F.lit("FFC3")), F.encode("text", "utf-8"), F.unhex(F.lit("E282"))))
        .otherwise(F.encode("text", "UTF-16LE"))
    )
    return read(spark, sf_dir, "documents").select("doc_id", html.decode_body(content, name).alias("text"))


@query
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").selectExpr("page_id", f"{of(inputs.URL_VARIANT, 'page_id')} AS url")
    url = F.col("url")
    return pages.select(
        "page_id",
        urls.scheme(url).alias("scheme"),
        urls.authority(url).alias("authority"),
        urls.path(url).alias("path"),
        urls.url_basename(url).alias("basename"),
        urls.is_txt(url).alias("is_txt"),
        urls.is_http(url).alias("is_http"),
    )


def _land(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = f"{of(inputs.LANDED_URL, 'pos')}"
    sources = inputs.sources(spark, sf_dir).withColumnRenamed("document_url", "url").withColumn("url", F.expr(changed))
    return landing.land_pages(
        inputs.responses(spark, sf_dir).drop("page_id"), sources.withColumnRenamed("url", "document_url"), BASE
    )


@query
def landing_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    variant = F.expr(of(inputs.URL_VARIANT.replace("url", "document_url"), "pos"))
    sources = inputs.sources(spark, sf_dir).withColumn("document_url", variant)
    return landing.landing_targets(sources, BASE).select("document_id", "mode", "target")


@query
def landing_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed bodies, stored and read back."""
    from docloom.sinks.bodies import stored_bodies

    path = f"{run_dir(spark)}/bodies-{uuid.uuid4()}"
    landing.write_landed(_land(spark, sf_dir), path)
    return stored_bodies(spark, path).select("path", F.col("content").cast("string").alias("body"))


@query
def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.run_status(_land(spark, sf_dir))


# --- chunking --------------------------------------------------------------------------------------------------


@query
def truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", text.truncate(F.col("text")).alias("text"))


@query
def section_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = F.expr(
        "map('Header_10', concat(' ', doc_id), 'Other', lang, 'Header_2', concat(source, ' '), "
        "'Header_1', CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN '  ' ELSE lang END, 'Header_3', NULL)"
    )
    return read(spark, sf_dir, "documents").select("doc_id", text.section_id(titles).alias("section_id"))


@query
def text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"))
    return _pieces(documents, "doc_id")


@query
def sql_text_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql_functions.register(spark)
    return spark.sql(
        "SELECT doc_id, i, start AS piece_start, end AS piece_end, content FROM {documents}, LATERAL split_text(text)",
        documents=read(spark, sf_dir, "documents"),
    )


@query
def text_chunks_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it needs a split, and its only piece where it does not."""
    documents = read(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"))
    found = documents.select("doc_id", (F.length("body") > 1792).alias("is_long"), pieces_of(F.col("body")).alias("p"))
    return found.select("doc_id", "is_long", F.when(~F.col("is_long"), F.get("p", F.lit(0))["content"]).alias("content"))


@query
def text_chunks_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies of lines of 99 characters, as many as the document has hundreds of characters."""
    lines = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("n_chars") / 100)),
        lambda k: F.lpad(F.concat_ws("_", F.col("doc_id"), k), 99, "x"),
    )
    documents = read(spark, sf_dir, "documents").select("doc_id", F.array_join(lines, "\n").alias("body"))
    return _pieces(documents, "doc_id").select("doc_id", "i", "content")


@query
def record_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all documents, sources joined to bodies."""
    bodies = inputs.text_documents(spark, sf_dir).select("document_id", "body")
    return chunking.chunk_documents(bodies, inputs.text_sources(spark, sf_dir), RUN_DATE).chunks


@query
def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _chunks(inputs.text_documents(spark, sf_dir))
    return chunks.groupBy("document_id").agg(F.count("*").alias("n_chunks"))


@query
def pdf_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longdocs.split_pages(inputs.pdf_pages(spark, sf_dir)).select("document_id", "i", "content")


@query
def md_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = markdown_pages.markdown_sections(inputs.markdown_pages(spark, sf_dir))
    return found.select("document_id", "section_id", "part_no", "content")


@query
def md_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = markdown_pages.split_markdown_pages(inputs.markdown_pages(spark, sf_dir))
    return found.select("document_id", "i", "section_id", "content")


def _nested_chunks(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    split = chunking.split_documents(inputs.json_bodies(spark, sf_dir, fmt))
    return chunking.numbered_pieces(split, "document_id").select("document_id", "i", "content", "oversize")


@query
def json_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nested_chunks(spark, sf_dir, "json")


@query
def yaml_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nested_chunks(spark, sf_dir, "yaml")


def _nested_bodies(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    split = chunking.split_documents(inputs.nested_bodies(spark, sf_dir, fmt))
    return chunking.numbered_pieces(split, "document_id").select("document_id", "i", "content", "oversize")


@query
def yaml_block_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """YAML in block style, nested, with lists and leaves that are too large."""
    return _nested_bodies(spark, sf_dir, "yaml")


@query
def json_nested_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nested_bodies(spark, sf_dir, "json")


def _quarantine(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    split = chunking.split_documents(inputs.broken_bodies(spark, sf_dir, fmt))
    bad = chunking.Chunked(split, RUN_DATE).quarantine
    return bad.select("document_id", "input_format", "error")


@query
def json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarantine(spark, sf_dir, "json")


@query
def yaml_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarantine(spark, sf_dir, "yaml")


@query
def format_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and chunks per splitter; formats are written in several ways, and unknown ones are markdown."""
    written = F.expr("CASE doc_id % 4 WHEN 0 THEN 'text' WHEN 1 THEN 'Text' WHEN 2 THEN 'PDF' ELSE 'other' END")
    plain = read(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("document_id"),
        written.alias("input_format"),
        F.col("text").alias("body"),
    )
    columns = ["document_id", "input_format", "body"]
    documents = plain.unionByName(inputs.json_bodies(spark, sf_dir, "json").select(columns)).unionByName(
        inputs.json_bodies(spark, sf_dir, "yaml").select(columns)
    )
    split = chunking.split_documents(documents)
    return split.groupBy(chunking.dispatch(F.col("input_format")).alias("splitter")).agg(
        F.count("*").alias("documents"), F.sum(F.size("pieces")).alias("chunks")
    )


# --- records and the chunk table -------------------------------------------------------------------------------


@query
def record_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _chunks(inputs.text_documents(spark, sf_dir))
    return chunks.select("_id", export.record_json(chunks).alias("record"))


@query
def record_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.exported_bytes(_chunks(inputs.text_documents(spark, sf_dir)))


@query
def record_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = chunking.numbered_pieces(
        chunking.split_documents(inputs.text_documents(spark, sf_dir)), "namespace", "document_id", "document_url"
    )
    records = chunking.to_records(pieces, RUN_DATE).select("*", F.substring_index("_id", ":chunk", -1).alias("i"))
    return export.array_lines(pinned(records.withColumn("i", F.col("i").cast("bigint"))))


@query
def record_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as JSON lines, a folder per namespace, and read back."""
    path = f"{run_dir(spark)}/{uuid.uuid4()}"
    export.export_records(_chunks(inputs.text_documents(spark, sf_dir)), path)
    return spark.read.schema("value STRING, namespace STRING").text(path).select("namespace", F.col("value").alias("record"))


@query
def array_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = chunking.numbered_pieces(
        chunking.split_documents(inputs.text_documents(spark, sf_dir)), "namespace", "document_id", "document_url"
    )
    records = chunking.to_records(pieces, RUN_DATE).select("*", F.substring_index("_id", ":chunk", -1).cast("bigint").alias("i"))
    return export.array_index(records)


def _revised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents, revised: their language is put in front of the text."""
    labelled = read(spark, sf_dir, "labels").selectExpr("concat('doc', doc_id) AS document_id")
    lang = read(spark, sf_dir, "documents").selectExpr("concat('doc', doc_id) AS document_id", "lang")
    documents = inputs.text_documents(spark, sf_dir).join(lang, "document_id").join(labelled, "document_id", "left_semi")
    return documents.withColumn("body", F.concat(F.col("lang"), F.lit(": "), F.col("body")))


@query
def chunk_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _chunks(inputs.text_documents(spark, sf_dir))
    return chunk_table.upserted(old, _chunks(_revised(spark, sf_dir), LATER))


@query
def document_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _chunks(inputs.text_documents(spark, sf_dir))
    return chunk_table.replaced(old, _chunks(_revised(spark, sf_dir), LATER))


@query
def namespace_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_table.without_namespace(_chunks(inputs.text_documents(spark, sf_dir)), " hot ")


@query
def upsert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_table.upsert_summary(_chunks(inputs.text_documents(spark, sf_dir)))


@query
def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = chunking.split_documents(inputs.text_documents(spark, sf_dir))
    pieces = chunking.numbered_pieces(split, "namespace", "document_id").select("namespace", "document_id", "i")
    return numbering.assign_batches(pinned(pieces)).select("namespace", "document_id", "i", "batch_no")


@query
def table_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chunk table created (twice, which changes nothing), filled, one namespace deleted, and summed up."""
    name = f"chunks_{uuid.uuid4().hex}"
    location = f"{run_dir(spark)}/{name}"
    for _ in range(2):
        chunk_table.create_chunk_table(spark, name, location)
    chunk_table.upsert_chunks(spark, name, _chunks(inputs.text_documents(spark, sf_dir)))
    chunk_table.replace_documents(spark, name, _chunks(_revised(spark, sf_dir), LATER))
    chunk_table.delete_namespace(spark, name, "ns1")
    counts = chunk_table.read_chunks(spark, name).groupBy("namespace", "document_date").agg(
        F.count("*").alias("chunks"), F.sum(F.length("chunk_content")).alias("characters")
    )
    result = pinned(counts)
    spark.sql(f"DROP TABLE {name}")
    return result


@query
def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed bodies taken in by about four batches of files, a third of them twice: the chunks, and what has no source.

    Each task lands files of its own, so neither a task's nor a file's size grows with the table."""
    home = f"{run_dir(spark)}/{uuid.uuid4()}"
    name = f"chunks_{uuid.uuid4().hex}"
    bodies = read(spark, sf_dir, "documents").selectExpr("concat('doc', doc_id) AS document_id", "text AS body", "doc_id % 3 AS third")
    with step(spark):
        # rows of one document are in one file, so in one batch
        bodies.repartition("document_id").write.partitionBy("third").parquet(f"{home}/landed")
        bodies.where("third = 1").drop("third").repartition("document_id").write.parquet(f"{home}/landed/third=3")
        files = max(1, len(spark.read.parquet(f"{home}/landed").inputFiles()) // 4)
        chunk_table.create_chunk_table(spark, name, f"{home}/table")
        sources = inputs.text_sources(spark, sf_dir).where("pos % 11 <> 5")
        # landed files go once they are taken in
        landed = spark.readStream.schema("document_id STRING, body STRING, third INT").option("cleanSource", "delete")
        stream = landed.option("maxFilesPerTrigger", files).parquet(f"{home}/landed")
        incremental.ingest_stream(stream, sources, name, f"{home}/state", RUN_DATE).awaitTermination()
    remove(spark, f"{home}/landed")
    lost = incremental.read_quarantine(spark, incremental.beside(f"{home}/state")).select("document_id", "error").distinct()
    chunks = chunk_table.read_chunks(spark, name).select("namespace", "_id", "document_id", "chunk_content", F.lit(None).cast("string").alias("error"))
    none = F.lit(None).cast("string")
    result = pinned(chunks.unionByName(lost.select(none.alias("namespace"), none.alias("_id"), "document_id", none.alias("chunk_content"), "error")))
    spark.sql(f"DROP TABLE {name}")
    remove(spark, home)
    return result
