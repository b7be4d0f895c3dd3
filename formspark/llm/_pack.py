"""Numpy arrays as compact binary values of a row, for tables and shuffles of long arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_KINDS = ["u1", "u2", "u4", "u8", "f8"]
#: Shorter arrays are stored as they are.
SMALL = 256


def pack(v: np.ndarray) -> bytes:
    """Non-negative integers in the fewest bytes, or doubles; byte planes compressed with zstd."""
    if v.dtype.kind == "f":
        kind = 4
    else:
        top = int(v.max()) if len(v) else 0
        kind = 0 if top < 1 << 8 else 1 if top < 1 << 16 else 2 if top < 1 << 32 else 3
    raw = v.astype(_KINDS[kind])
    if raw.nbytes < SMALL:
        return bytes([kind]) + raw.tobytes()
    planes = np.ascontiguousarray(raw.view(np.uint8).reshape(len(raw), -1).T)
    return bytes([kind | 8]) + len(raw).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(b: bytes) -> np.ndarray:
    """The array of :func:`pack`: int64 or float64 (unsigned 64-bit where it was that wide)."""
    kind = _KINDS[b[0] & 7]
    if b[0] & 8:
        n, width = int.from_bytes(b[1:9], "little"), int(kind[1])
        planes = np.frombuffer(pa.decompress(b[9:], decompressed_size=n * width, codec="zstd", asbytes=True), np.uint8)
        out = np.ascontiguousarray(planes.reshape(width, n).T).view(kind).ravel()
    else:
        out = np.frombuffer(b[1:], kind)
    return out if kind in ("u8", "f8") else out.astype(np.int64)


def column(values: list[np.ndarray]) -> pa.Array:
    return pa.array([pack(v) for v in values], pa.binary())


def flat(col: pa.ChunkedArray, dtype=np.int64) -> tuple[np.ndarray, np.ndarray]:
    """(all values one behind the other, length of each row) of a packed column."""
    parts = [unpack(x.as_py()) for x in col]
    out = np.concatenate(parts) if parts else np.zeros(0)
    return out.astype(dtype, copy=False), np.array([len(x) for x in parts], dtype=np.int64)
