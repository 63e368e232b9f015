"""Schemas of the tables the library reads and writes."""

from pyspark.sql import types as T


def _strings(*names, nullable=()):
    return [T.StructField(n, T.StringType(), n in nullable) for n in names]


SOURCES = T.StructType(
    [
        T.StructField("pos", T.LongType(), False),
        *_strings("document_id"),
        *_strings(
            "document_url",
            "document_path",
            "namespace",
            "input_format",
            nullable=("document_url", "document_path", "namespace", "input_format"),
        ),
    ]
)

RECORD_COLUMNS = (
    "_id",
    "document_id",
    "document_url",
    "document_date",
    "chunk_content",
    "chunk_section_id",
)

CHUNKS = T.StructType(_strings("namespace", *RECORD_COLUMNS, nullable=("chunk_section_id",)))

ISSUE = T.StructType(_strings("rule", "message"))

PIECE = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("content", T.StringType()),
    ]
)
