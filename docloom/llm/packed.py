"""Number arrays as small binaries: narrowed, bytes of equal rank together, compressed."""

from __future__ import annotations

import numpy as np
import zstandard

KINDS = "BHIQd"


def pack(x: np.ndarray) -> bytes:
    """Non-negative integers of any width, or doubles."""
    x = np.ascontiguousarray(x)
    if x.dtype.kind != "f":
        most = int(x.max()) if len(x) else 0
        x = x.astype("BHIQ"[sum(most >= 1 << bits for bits in (8, 16, 32))])
    code = KINDS.index(x.dtype.char if x.dtype.char in KINDS else "Q")
    parts = x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() if len(x) else b""
    return bytes([code]) + zstandard.ZstdCompressor(level=3).compress(parts)


def unpack(data: bytes) -> np.ndarray:
    """Unsigned integers come back as int64 (beyond its range as uint64), doubles as such."""
    kind = np.dtype(KINDS[data[0]])
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    x = np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)
    if kind.char == "Q":
        return x.view(np.int64) if not len(x) or x.max() < 1 << 63 else x
    return x if kind.char == "d" else x.astype(np.int64)
