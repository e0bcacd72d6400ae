"""Exact token ids of whole texts, each distinct piece of text encoded once per worker.

A text is cut where the tokenizer cuts it anyway: before white space that
follows other text, and between an ASCII letter and a punctuation mark that
is no apostrophe.  Pieces are encoded by the ``tokenizers`` library, kept in
a bounded table per worker, and the ids of a batch are put together by numpy.
Texts with white space beyond ASCII or with ``<|`` (special tokens) are
encoded whole.  Tokenizers of another kind are always used whole, and so are
the texts of a batch in which two different pieces share a 64-bit key.
"""

from __future__ import annotations

import json
import re
import sys

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

from .words import LONG_WORD, _MASKS, eight, groups_by_size, keys

#: distinct pieces kept per worker before the table is started anew
MAX_PIECES = 600_000
#: one of these stands in every text that _UNSAFE matches; looked for first, as a search for a literal is quick
_HINTS = (b"<|", b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80",
          b"\x1c", b"\x1d", b"\x1e", b"\x1f")
_UNSAFE = re.compile(rb"<\||\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|[\x1c-\x1f]")
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b".,!?;:%$&*#|")] = True
_PLAIN = {"drop": re.compile("[a-zß-öø-ÿ]+"), "lead": re.compile(" [A-Za-zÀ-ÖØ-öø-ÿ]+")}


def byte_letters() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(plain))
    out = {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}
    return [out[b] for b in range(256)]


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.full = Tokenizer.from_file(path)
        self.kind = self._kind(spec)
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        self.joined = self.letters | {0x0A: "\n"}           # of plain pieces, which hold no line feed, one per line
        self.bare = Tokenizer(self.full.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        n = self.full.get_vocab_size()
        self.vocab_size = n
        mark = np.zeros(n, bool)                    # tokens that end a word, or begin one
        end = spec["model"].get("end_of_word_suffix")
        space = self.letters[0x20]
        for token, i in self.full.get_vocab().items():
            mark[i] = bool(end) and token.endswith(end) if self.kind == "drop" else token.startswith(space)
        self.mark = mark
        self._reset()

    @staticmethod
    def _kind(spec: dict) -> str:
        pre, norm, model = spec.get("pre_tokenizer") or {}, spec.get("normalizer"), spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or spec.get("truncation"):
            return "whole"
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or not t["content"].startswith("<|")
               for t in spec.get("added_tokens", [])):
            return "whole"
        if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            return "lead"
        steps = [x["type"] for x in (norm or {}).get("normalizers", [])]
        inner = [x["type"] for x in pre.get("pretokenizers", [])]
        if steps == ["NFC", "Replace", "Lowercase"] and inner == ["Split", "ByteLevel"] and model.get("end_of_word_suffix"):
            return "drop"
        return "whole"

    def _reset(self) -> None:
        self.n = 0                                          # pieces kept
        self.key = np.zeros(0, np.uint64)                   # their keys, sorted, and their numbers
        self.number = np.zeros(0, np.int64)
        self.bytes, self.filled = np.zeros(1 << 20, np.uint8), 0
        self.begin = np.zeros(1 << 16, np.int64)            # by number: where its bytes begin, and their count
        self.length = np.zeros(1 << 16, np.int64)
        self.at = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int64)
        self.pool = np.zeros(1 << 20, np.uint32)
        self.used = 0

    # -- pieces -----------------------------------------------------------
    def _cut(self, buf: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        space = _SPACE[buf]
        start = np.zeros(len(buf), bool)
        start[1:] = _PUNCT[buf[1:]] & _LETTER[buf[:-1]]
        if self.kind == "drop":
            start[1:] |= ~space[1:] & space[:-1]
            start[doc_starts] = True
            start &= ~space
            last = ~space
            last[:-1] &= space[1:] | start[1:]
            inner = doc_starts[doc_starts > 0] - 1
            last[inner] = ~space[inner]
            return np.flatnonzero(start), np.flatnonzero(last) + 1
        start[1:] |= space[1:] & ~space[:-1]
        start[2:] |= (buf[1:-1] == 10) & ~space[2:] & ~space[:-2]
        start[doc_starts] = True
        at = np.flatnonzero(start)
        return at, np.append(at[1:], len(buf))

    def _plain(self, piece: bytes) -> bool:
        ascii_ = piece.isalpha() if self.kind == "drop" else piece[:1] == b" " and piece[1:].isalpha()
        return ascii_ or bool(_PLAIN[self.kind].fullmatch(piece.decode("utf-8")))

    def _ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places of the pieces in the order of their ids, ids, ids per piece)."""
        is_plain = np.fromiter(map(self._plain, pieces), bool, len(pieces))
        plain, other = np.flatnonzero(is_plain), np.flatnonzero(~is_plain)
        found: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        if len(plain):
            joined = b"\n".join([pieces[i] for i in plain.tolist()]).decode("latin-1").translate(self.joined)
            ids = np.array(self.bare.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype=np.uint32)
            hit = np.flatnonzero(self.mark[ids])
            bounds = np.concatenate([[0], hit + 1]) if self.kind == "drop" else np.append(hit, len(ids))
            if len(bounds) != len(plain) + 1 or bounds[0] != 0 or bounds[-1] != len(ids):
                other, plain = np.arange(len(pieces)), plain[:0]      # the marks do not separate these words
            else:
                sizes.append(np.diff(bounds))
                found.append(ids)
        if len(other):
            got = self.full.encode_batch_fast([pieces[i].decode("utf-8") for i in other.tolist()], add_special_tokens=False)
            lists = [e.ids for e in got]
            sizes.append(np.array([len(x) for x in lists], dtype=np.int64))
            found.append(np.array([i for x in lists for i in x], dtype=np.uint32))
        return np.concatenate([plain, other]), np.concatenate(found), np.concatenate(sizes)

    def _add(self, pieces: list[bytes], key: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Numbers of new pieces; ``key``, sorted, is to stand before ``place`` among the keys."""
        order, ids, size = self._ids(pieces)
        n, k = self.n, len(pieces)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        length = np.fromiter(map(len, pieces), np.int64, k)
        while n + k > len(self.at):
            for name in ("at", "size", "begin", "length"):
                setattr(self, name, np.append(getattr(self, name), np.zeros_like(getattr(self, name))))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.append(self.pool, np.zeros_like(self.pool))
        while self.filled + len(data) + 8 > len(self.bytes):
            self.bytes = np.append(self.bytes, np.zeros_like(self.bytes))
        self.pool[self.used:self.used + len(ids)] = ids
        self.at[n + order] = self.used + np.cumsum(size) - size
        self.size[n + order] = size
        self.bytes[self.filled:self.filled + len(data)] = data
        self.begin[n:n + k] = self.filled + np.cumsum(length) - length
        self.length[n:n + k] = length
        self.used, self.filled, self.n = self.used + len(ids), self.filled + len(data), n + k
        self.key = np.insert(self.key, place, key)
        self.number = np.insert(self.number, place, np.arange(n, n + k))
        return np.arange(n, n + k)

    def _numbers(self, data: bytes, loads: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: np.ndarray) -> np.ndarray | None:
        """Number of each of these different pieces, new ones are added; None if one has the key of another kept."""
        order = np.argsort(key)
        asked = key[order]
        place = np.searchsorted(self.key, asked)
        known = np.zeros(len(key), bool)
        if self.n:
            known = self.key[np.minimum(place, self.n - 1)] == asked
        out = np.empty(len(key), np.int64)
        out[order[known]] = self.number[place[known]]
        old, new = order[known], order[~known]
        kept = np.ndarray(shape=(len(self.bytes) - 7,), dtype="<u8", buffer=self.bytes.data, strides=(1,))
        begin, length = self.begin[out[old]], self.length[out[old]]
        if not _equal(data, loads, starts[old], ends[old], self.bytes, kept, begin, begin + length):
            return None
        if len(new):
            pieces = [data[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            out[new] = self._add(pieces, asked[~known], place[~known])
        return out

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.full.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)

    def _unsafe(self, data: bytes) -> bool:
        return self.kind == "whole" or any(h in data for h in _HINTS) and bool(_UNSAFE.search(data))

    def _prepared(self, data: bytes) -> bytes:
        return data.lower() if self.kind == "drop" else data

    def _encode_cut(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids, ids per text); None if two different pieces share a key."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        data = b"".join(texts)
        offsets = np.cumsum(sizes) - sizes
        if not data:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        buf = np.frombuffer(data, dtype=np.uint8)
        starts, ends = self._cut(buf, offsets[sizes > 0])
        if len(starts) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        loads = eight(data)
        key = keys(data, starts, ends, loads)
        codes, rep = _codes(key)
        if not _same_pieces(data, loads, starts, ends, rep[codes]):
            return None
        if self.n > MAX_PIECES:
            self._reset()
        k = self._numbers(data, loads, starts[rep], ends[rep], key[rep])
        if k is None:
            return None
        n_ids, at = self.size[k][codes], self.at[k][codes]
        cum = np.cumsum(n_ids)
        ids = self.pool[np.repeat(at - (cum - n_ids), n_ids) + np.arange(cum[-1])]
        before = np.concatenate([[0], cum])
        ranges = before[np.searchsorted(starts, np.append(offsets, len(data)))]
        return ids, np.diff(ranges)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids (uint32) of each text; null counts as empty."""
        out: list = [None] * len(texts)
        fast: list[int] = []
        data: list[bytes] = []
        whole: list[int] = []
        for i, t in enumerate(texts):
            b = (t or "").encode("utf-8")
            if self._unsafe(b):
                whole.append(i)
            else:
                fast.append(i)
                data.append(self._prepared(b))
        for a, b in groups_by_size(data):
            got = self._encode_cut(data[a:b])
            if got is None:
                whole += fast[a:b]
                continue
            ids, counts = got
            for i, part in zip(fast[a:b], np.split(ids, np.cumsum(counts)[:-1])):
                out[i] = part
        for i in whole:
            out[i] = self._whole(texts[i] or "")
        return out


def _same_pieces(data: bytes, loads: np.ndarray, starts: np.ndarray, ends: np.ndarray, like: np.ndarray) -> bool:
    """Is every piece, byte by byte, the piece ``like`` that stands for it?"""
    todo = np.flatnonzero(like != np.arange(len(like)))
    to = like[todo]
    return _equal(data, loads, starts[todo], ends[todo], data, loads, starts[to], ends[to])


def _equal(a: bytes | np.ndarray, a_loads: np.ndarray, a_starts: np.ndarray, a_ends: np.ndarray,
           b: bytes | np.ndarray, b_loads: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> bool:
    """Are the pieces of ``a``, byte by byte, those of ``b``?"""
    size = a_ends - a_starts
    if (size != b_ends - b_starts).any():
        return False
    short = np.flatnonzero(size < 8)
    if ((a_loads[a_starts[short]] ^ b_loads[b_starts[short]]) & _MASKS[size[short]]).any():
        return False
    todo, at = np.flatnonzero((size >= 8) & (size <= LONG_WORD)), 0
    while len(todo):                       # eight bytes at a time; the last eight may overlap
        off = np.minimum(at, size[todo] - 8)
        if (a_loads[a_starts[todo] + off] != b_loads[b_starts[todo] + off]).any():
            return False
        at += 8
        todo = todo[size[todo] > at]
    return all(bytes(a[a_starts[i]:a_ends[i]]) == bytes(b[b_starts[i]:b_ends[i]]) for i in np.flatnonzero(size > LONG_WORD))


def _codes(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of each key (0..n-1) and the position of one representative per code."""
    import pandas as pd
    codes, uniques = pd.factorize(key)
    rep = np.empty(len(uniques), dtype=np.int64)
    rep[codes[::-1]] = np.arange(len(key) - 1, -1, -1)
    return codes, rep


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, kept for its next tasks."""
    kept = vars(sys).setdefault("_cohortkit_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]
