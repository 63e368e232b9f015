"""Corpus ingest on Spark: sources, landing, chunking and a chunk table, all as DataFrames."""

from docloom.constants import BATCH_SIZE, MAX_CHARS, OVERLAP
from docloom.operators.chunking import Chunked, chunk_documents, split_documents
from docloom.operators.landing import land_pages, landing_targets, missing_bodies, run_status, write_landed
from docloom.operators.listing import listing, padded, tabbed, widths
from docloom.operators.longdocs import assemble_pages, split_pages
from docloom.operators.markdown_pages import markdown_sections, split_markdown_pages
from docloom.operators.numbering import assign_batches, number_pieces
from docloom.operators.validation import error_report, require_valid, validate_sources
from docloom.plans.pipeline import chunk_files, chunk_markdown_pages, chunk_pages, ingest, prepare
from docloom.sinks.chunk_table import (
    create_chunk_table,
    delete_namespace,
    read_chunks,
    replace_documents,
    upsert_chunks,
    upsert_summary,
)
from docloom.sinks.export import export_array, export_records, exported_bytes
from docloom.sources.files import list_files, read_bodies
from docloom.sources.registry import (
    InvalidSources,
    coerce_entries,
    load_sources,
    look_up,
    read_sources,
    remove_sources,
    save_sources,
    select_sources,
    upsert_sources,
)
from docloom.streaming.incremental import ingest_stream
