"""Arrays of many records in one binary value: what meets by bucket travels in few rows."""

from __future__ import annotations

import numpy as np


def pack(*arrays: np.ndarray) -> bytes:
    return b"".join([np.array([len(a) for a in arrays], np.int64).tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])


def unpack(raw: bytes, *kinds) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(raw, np.int64, len(kinds)), 8 * len(kinds), []
    for n, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out
