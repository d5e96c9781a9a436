"""Arrays of numbers as small byte strings, for messages that move between tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of integers from 0 (in as few bytes as the largest needs) or of doubles, byte plane by byte plane, compressed."""
    kinds, planes = [], []
    for a in map(np.asarray, arrays):
        if a.dtype.kind != "f":
            a = a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))
        kinds.append(f"{a.dtype.kind}{a.dtype.itemsize}:{len(a)}")
        planes.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    return " ".join(kinds).encode() + b"\n" + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpacked(raw: bytes) -> list[np.ndarray]:
    """The arrays that ``packed`` took, as int64 or double."""
    head, _, body = raw.partition(b"\n")
    kinds = [(np.dtype(kind), int(n)) for kind, n in (x.split(":") for x in head.decode().split(" "))]
    planes = np.frombuffer(pa.decompress(body, decompressed_size=sum(kind.itemsize * n for kind, n in kinds), codec="zstd", asbytes=True), dtype=np.uint8)
    out, at = [], 0
    for kind, n in kinds:
        own = planes[at:at + n * kind.itemsize].reshape(kind.itemsize, n).T
        at += n * kind.itemsize
        out.append(np.ascontiguousarray(own).view(kind).reshape(n).astype(np.float64 if kind.kind == "f" else np.int64))
    return out


def steps(rising: np.ndarray) -> np.ndarray:
    """First value and differences of a sequence that never falls; numpy's cumsum undoes it."""
    return np.diff(rising, prepend=0)
