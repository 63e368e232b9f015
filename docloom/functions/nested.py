"""Splitting JSON and YAML bodies into JSON chunks of bounded size.

Objects are walked in document order. Lists, scalars and empty objects are leaves; a leaf is carried with
its whole key path and leaves are packed in order while the compact text of the chunk stays within
``max_chars``. A leaf that alone is larger gets a chunk of its own, marked ``oversize``.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.constants import MAX_CHARS
from docloom.functions.split import in_blocks

try:
    import yaml
except ImportError:  # YAML bodies then go to quarantine with that reason
    yaml = None

NESTED_PIECE = T.StructType(
    [T.StructField("content", T.StringType()), T.StructField("oversize", T.BooleanType())]
)
NESTED = T.StructType(
    [T.StructField("pieces", T.ArrayType(NESTED_PIECE)), T.StructField("error", T.StringType())]
)

JSON_ERROR = "Invalid JSON input: "
YAML_ERROR = "Invalid YAML input: "

_LONE_SURROGATE = re.compile("[\ud800-\udfff]")


def compact(value) -> str:
    """Compact JSON text with non-ASCII kept; half surrogate pairs, which UTF-8 cannot hold, are escaped."""
    text = json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    return _LONE_SURROGATE.sub(lambda m: f"\\u{ord(m.group()):04x}", text)


def leaves(tree: dict):
    """Yield ``(path, text)`` of every leaf in document order; keys are JSON text already."""
    path, stack = [], [iter(tree.items())]
    while stack:
        for key, value in stack[-1]:
            name = compact(key)
            if isinstance(value, dict) and value:
                path.append(name)
                stack.append(iter(value.items()))
                break
            yield (*path, name), compact(value)
        else:
            stack.pop()
            if path:
                path.pop()


def split_object(tree: dict, max_chars: int = MAX_CHARS) -> list[tuple[str, bool]]:
    """Chunks of one object as ``(json_text, oversize)``."""
    done: list[tuple[str, bool]] = []
    parts: list[str] = []
    size, open_path = 0, ()

    def close():
        text = "".join(parts) + "}" * len(open_path)
        done.append((text, len(text) > max_chars))
        parts.clear()

    for path, value in leaves(tree):
        if parts:
            shared = 0
            while shared < len(open_path) - 1 and shared < len(path) - 1 and open_path[shared] == path[shared]:
                shared += 1
            added = "}" * (len(open_path) - 1 - shared) + "," + ":{".join(path[shared:]) + ":" + value
            # Closing braces only move: the size grows by the new text and the objects it opens.
            grown = size + len(added) - (len(open_path) - 1 - shared) + (len(path) - 1 - shared)
            if grown <= max_chars:
                parts.append(added)
                size, open_path = grown, path
                continue
            close()
        parts.append("{" + ":{".join(path) + ":" + value)
        size, open_path = len(parts[0]) + len(path), path
    if parts:
        close()
    return done


def split_json(text: str, max_chars: int = MAX_CHARS) -> tuple[list | None, str | None]:
    """``(pieces, error)`` of a JSON body."""
    try:
        tree = json.loads(text)
    except (ValueError, RecursionError) as exc:
        return None, f"{JSON_ERROR}{exc}"
    if not isinstance(tree, dict):
        return None, f"{JSON_ERROR}top level is not an object"
    return split_object(tree, max_chars), None


def split_yaml(text: str, max_chars: int = MAX_CHARS) -> tuple[list | None, str | None]:
    """``(pieces, error)`` of a YAML body."""
    if yaml is None:
        return None, f"{YAML_ERROR}no YAML parser installed"
    try:
        tree = yaml.load(text, getattr(yaml, "CSafeLoader", yaml.SafeLoader))
        if not isinstance(tree, dict):
            return None, f"{YAML_ERROR}top level is not a mapping"
        # Through JSON once: keys become strings, and values JSON cannot carry are reported.
        return split_object(json.loads(json.dumps(tree)), max_chars), None
    except Exception as exc:  # noqa: BLE001 - any failure of the parser belongs to the document
        return None, f"{YAML_ERROR}{exc}"


def split_nested_udf(max_chars: int = MAX_CHARS):
    """Arrow function ``(body, 'json'|'yaml') -> struct<pieces, error>``; null body in, null out."""

    @F.arrow_udf(NESTED)
    def split_nested(bodies: pa.Array, formats: pa.Array) -> pa.Array:
        return in_blocks(split_block, bodies, formats)

    def split_block(bodies, formats):
        offsets, contents, oversize, errors, missing = [0], [], [], [], []
        for body, fmt in zip(bodies.to_pylist(), formats.to_pylist()):
            pieces, error = None, None
            if body is not None:
                pieces, error = (split_json if fmt == "json" else split_yaml)(body, max_chars)
            for content, over in pieces or ():
                contents.append(content)
                oversize.append(over)
            offsets.append(len(contents))
            errors.append(error)
            missing.append(body is None)
        items = pa.StructArray.from_arrays(
            [pa.array(contents, pa.string()), pa.array(oversize, pa.bool_())], ["content", "oversize"]
        )
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items), pa.array(errors, pa.string())],
            ["pieces", "error"],
            mask=pa.array(missing, pa.bool_()),
        )

    return split_nested
