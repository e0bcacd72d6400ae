"""Byte-aligned variable-length integers with separate control bytes.

Four values share one control byte that holds four 2-bit lengths (1 to 4
bytes); the value bytes, little-endian, stand in a second stream.  Decoding
looks the lengths up in a 256-row table and gathers the bytes with numpy.
"""

from __future__ import annotations

import numpy as np

#: control byte -> lengths of its four values
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned values below 2**32."""
    v = np.ascontiguousarray(values, dtype="<u4")
    n = len(v)
    extra = ((v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)).astype(np.uint8)
    padded = np.zeros(-(-n // 4) * 4, np.uint8)
    padded[:n] = extra
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4) <= extra[:, None]
    return control.astype(np.uint8).tobytes(), v.view(np.uint8).reshape(n, 4)[used].tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    sizes = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(sizes, dtype=np.int64)
    at = ends - sizes
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[at].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(sizes > k)
        if len(more) == 0:
            break
        out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out
