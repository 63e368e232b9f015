"""Fixed values shared by every module.

These values define the record format and the checks, so they are stated once, plainly, here.
"""

# Chunk limits in characters (Unicode code points).
MAX_CHARS = 1792
OVERLAP = 128

# Records per upsert batch; also what a non-positive batch size falls back to.
BATCH_SIZE = 64

# Longest text that summaries show.
TRUNCATE_AT = 500

# Formats and the file suffixes each of them accepts.
FORMAT_SUFFIXES = {
    "json": (".json",),
    "markdown": (".md", ".markdown", ".mdown", ".mkd"),
    "pdf": (".pdf",),
    "text": (".txt",),
    "yaml": (".yml", ".yaml"),
}
FORMATS = tuple(FORMAT_SUFFIXES)

# Keys of a registry entry in a YAML or JSON file, and the column each one becomes.
REGISTRY_KEYS = {
    "document-url": "document_url",
    "document-path": "document_path",
    "pinecone-namespace": "namespace",
    "input-format": "input_format",
}

# Wording of the problems a registry can have. Entries are put in front as "<id>: ".
WORDING = {
    # when an entry is coerced
    "invalid_id": "invalid document id: {} (must be a non-empty string)",
    "not_a_mapping": "entry must be a mapping of configuration values",
    "missing_key": "missing required key '{}'",
    "not_a_string": "key '{}' must be a string",
    "not_a_registry": "configuration file must contain a mapping at the top level",
    # when it is validated
    "empty_id": "invalid document id: '' (must be non-empty str)",
    "missing_keys": "missing keys: [{}]",
    "blank": "'{}' must be a non-empty string",
    "format_required": "'input-format' is required and must be a non-empty string",
    "format_unknown": "'input-format' must be one of ['json', 'markdown', 'pdf', 'text', 'yaml']; got {}",
    "url_not_http": "'document-url' must be an absolute http(s) URL; got {}",
    "path_missing": "'document-path' does not exist: {}",
    "suffix_json": "expected a .json file for input-format=json; got {}",
    "suffix_markdown": "expected a markdown file (.md/.markdown/.mdown/.mkd) for input-format=markdown; got {}",
    "suffix_pdf": "expected a .pdf file for input-format=pdf; got {}",
    "suffix_text": "expected a .txt file for input-format=text; got {}",
    "suffix_yaml": "expected a .yml/.yaml file for input-format=yaml; got {}",
    "namespace_required": "'pinecone-namespace' must be non-empty",
    # when it is looked up or changed
    "no_selection": "either all_docs or single_id must be given",
    "unknown_id": "unknown document id: {}",
    "empty_document_id": "document id must be a non-empty string",
    # when chunks are stored or deleted
    "empty_namespace": "namespace must be a non-empty string",
}

# Index properties recorded on the chunk table.
TEXT_FIELD = "chunk_content"
METRIC = "cosine"

# Exit codes of a landing run.
STATUS_OK = 0
STATUS_SELECTION_ERROR = 2
STATUS_FAILED = 3

# Every character Python's str.strip() removes: the Unicode white space set.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Consecutive page numbers that make one part of a document: what one row holds of it (operators/longdocs.py).
PART_PAGES = 128
