"""Words of a batch of texts as numpy arrays: boundaries and 64-bit word keys.

One buffer holds the bytes of all texts of a batch; words are (start, end)
offsets into it.  Nothing here loops over words in Python.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
#: longer words are hashed one by one
LONG_WORD = 512

#: every byte outside 0-9, A-Z, a-z and 0x80.. becomes a space; A-Z become a-z
WORD_TABLE = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256))


def normalized(text: str | None) -> bytes:
    """Words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, separated by spaces."""
    return (text or "").encode("utf-8").translate(WORD_TABLE)


def spans(buf: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of runs of non-space bytes; a run never crosses a document."""
    if len(buf) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    on = buf != 0x20
    first = on.copy()
    first[1:] &= ~on[:-1]
    inner = doc_starts[(doc_starts > 0) & (doc_starts < len(buf))]
    first[inner] = on[inner]
    last = on.copy()
    last[:-1] &= ~on[1:] | first[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def eight(buf: bytes) -> np.ndarray:
    """Little-endian 64-bit load at every byte offset (the buffer is padded)."""
    padded = np.frombuffer(buf + b"\0" * 8, dtype=np.uint8)
    return np.ndarray(shape=(len(buf) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def keys(buf: bytes, starts: np.ndarray, ends: np.ndarray, loads: np.ndarray | None = None) -> np.ndarray:
    """64-bit key of each word; equal words have equal keys in every batch."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    loads = eight(buf) if loads is None else loads
    size = ends - starts
    h = size.astype(np.uint64) * _MUL
    short = np.minimum(size, 8)
    h = mix((h ^ (loads[starts] & _MASKS[short])) * _MUL)
    at = 8
    todo = np.flatnonzero((size > at) & (size <= LONG_WORD))
    while len(todo):
        left = np.minimum(size[todo] - at, 8)
        h[todo] = mix((h[todo] ^ (loads[starts[todo] + at] & _MASKS[left])) * _MUL)
        at += 8
        todo = todo[size[todo] > at]
    for i in np.flatnonzero(size > LONG_WORD):
        h[i] = int.from_bytes(blake2b(buf[starts[i]:ends[i]], digest_size=8).digest(), "little")
    return h


class WordBatch:
    """Words of several texts: ``starts``, ``ends``, ``keys`` and the word range of each text."""

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.buf = b"".join(texts)
        self.doc_starts = np.concatenate([[0], np.cumsum(sizes)])[:-1] if len(texts) else np.zeros(0, np.int64)
        arr = np.frombuffer(self.buf, dtype=np.uint8)
        self.starts, self.ends = spans(arr, self.doc_starts)
        self.keys = keys(self.buf, self.starts, self.ends)
        #: words of text i are first[i] .. first[i + 1]
        self.first = np.searchsorted(self.starts, np.append(self.doc_starts, len(self.buf)))

    def word(self, i: int) -> bytes:
        return self.buf[self.starts[i]:self.ends[i]]


def groups_by_size(texts: list, limit: int = 4 << 20):
    """Slices of ``texts`` of about ``limit`` bytes, one text at least."""
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end] or "") <= limit):
            size += len(texts[end] or "")
            end += 1
        yield at, end
        at = end
