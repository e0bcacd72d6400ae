"""Removal of repeated passages by level-wise doubling of word windows.

A window is ``window`` consecutive words of one document; the words it covers
go if the same word sequence starts in a document with a smaller id.

Levels.  The first level looks at windows of half the length, picked by their
content (the least key among the half windows that start inside one window),
so that every window holds a picked one and its copies hold the same.  Picked
windows that only one text has end there.  Around the others, all windows of
the full length are keyed; those that only one text has end there, and the
places where a repeated one stands in a document with a larger id are covered.
From there on, windows repeated at one length are extended to twice that
length (at the picked places), until no candidate survives: the longest length
a text takes part in is reported.  The key of a window of twice the length is
made from the keys of its two halves.

Exact copies are one class per text (its smallest id stands for it), so a
group of copies of any size adds one text to the levels; all rows of a class
with a larger id lose every window.  Every level is an aggregate by key with
a map-side part and a join by key; a document's places are the only thing
gathered in one row.

Keys of full windows have 128 bits; those of the first level, a mere filter,
have 64.

Defined results: a null text has no words, and no kept text either (empty);
a document shorter than a window loses nothing; a null id counts as larger
than any id; repeated rows (same id and text) keep the same words; different
texts under one id do not cover each other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import TEXT_ROWS, materialize, only, unwrapped, wrapped
from .words import WordBatch, groups_by_size, mix

WINDOW = 50
#: bytes of text whose windows are held at once
GROUP = 1 << 20
_A = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_B = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))
_SPACES = bytes(0x20 if 9 <= b <= 13 else b for b in range(256))
_LAST = (1 << 63) - 1


def spaced(text: str | None) -> bytes:
    """The text in UTF-8 with each white space (space, 0x09-0x0D) as a space."""
    return (text or "").encode("utf-8").translate(_SPACES)


def joined_keys(a: np.ndarray, b: np.ndarray, shift: int, by: tuple) -> np.ndarray:
    """Keys of windows made of one at each place and one ``shift`` words on."""
    n = max(0, len(b) - shift)
    return mix(a[:n] * by[0] + b[shift:shift + n] * by[1])


def window_keys(words: np.ndarray, size: int, by: tuple = _A) -> np.ndarray:
    """Keys of all windows of ``size`` consecutive words, from powers of two."""
    out, at, power, width = None, 0, words, 1
    while True:
        if size & width:
            out = mix(power * by[0]) if out is None else joined_keys(out, power, at, by)
            at += width
        if at == size:
            return out[:max(0, len(words) - size + 1)]
        power = joined_keys(power, power, width, by)
        width *= 2


def sliding(f: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``f`` over every ``width`` consecutive values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = f(x[:len(x) - step], x[step:])
        have += step
    return x


def picked(half: np.ndarray, whole: np.ndarray, size: int, window: int) -> np.ndarray:
    """Which half windows are least among those of some window; ``whole``: does a window start here?"""
    span = window - size + 1
    if len(whole) == 0:
        return np.zeros(len(half), bool)
    low = np.where(whole, sliding(np.minimum, half, span)[:len(whole)], np.uint64(0))
    pad = np.zeros(span - 1, np.uint64)
    best = sliding(np.maximum, np.concatenate([pad, low, pad]), span)
    return (best == half) & (best > 0)


class _Texts:
    """Word keys of several texts and the places where a window starts."""

    def __init__(self, texts: list[bytes], window: int):
        self.b = WordBatch(texts)
        self.first, self.window = self.b.first, window
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.count)), self.count)
        self.size = -(-window // 2)
        self.half = window_keys(self.b.keys, self.size)
        n = max(0, len(self.b.keys) - window + 1)
        self.whole = self.doc[:n] == self.doc[len(self.doc) - n:]


def _anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [spaced(t) for t in b.column(1).to_pylist()]
            names = b.column(0).to_numpy()
            for x, y in groups_by_size(texts, GROUP):
                s = _Texts(texts[x:y], window)
                at = np.flatnonzero(picked(s.half, s.whole, s.size, window))
                doc = s.doc[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[x:y][doc]), pa.array((at - s.first[doc]).astype(np.int32)),
                     pa.array(s.half[at].view(np.int64))], ["t", "pos", "key"])
    return run


def _windows(window: int):
    """All windows around the picked places; at these, also the keys of twice the length and so on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [spaced(t) for t in b.column(2).to_pylist()]
            names, firsts = b.column(0).to_numpy(), b.column(1).to_numpy()
            places = b.column(3).to_pylist()
            for x, y in groups_by_size(texts, GROUP):
                s = _Texts(texts[x:y], window)
                if len(s.whole) == 0:
                    continue
                at = np.concatenate([np.array(p, np.int64) + s.first[i] for i, p in enumerate(places[x:y])])
                shift = window - s.size
                edge = np.zeros(len(s.half) + 1, np.int64)
                np.add.at(edge, np.maximum(at - shift, 0), 1)
                np.add.at(edge, at + 1, -1)
                near = (np.cumsum(edge)[:len(s.whole)] > 0) & s.whole
                rows = np.flatnonzero(near)
                anchor = np.zeros(len(s.whole), bool)
                anchor[at[at < len(s.whole)]] = True
                long = np.flatnonzero(anchor[rows])
                one = joined_keys(s.half, s.half, shift, _A)
                two = window_keys(s.b.keys, s.size, _B)
                two = joined_keys(two, two, shift, _B)
                k1, k2 = one[rows], two[rows]
                doc = s.doc[rows]
                left = s.first[doc + 1] - rows
                # doubled lengths at the picked places, as far as the text goes
                steps = np.zeros(len(rows), np.int64)
                own, keys, width = rows[long], [], window
                while True:
                    go = left[long] >= 2 * width
                    if not go.any():
                        break
                    one, two = joined_keys(one, one, width, _A), joined_keys(two, two, width, _B)
                    width *= 2
                    long, own = long[go], own[go]
                    steps[long] += 1
                    keys.append((long, one[own], two[own]))
                ends = np.cumsum(2 * steps)
                flat = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
                for j, (r, a, c) in enumerate(keys):
                    flat[ends[r] - 2 * steps[r] + 2 * j] = a
                    flat[ends[r] - 2 * steps[r] + 2 * j + 1] = c
                for a in range(0, len(rows), 1 << 16):
                    z = min(len(rows), a + (1 << 16))
                    base = int(ends[a] - 2 * steps[a])
                    offs = np.concatenate([[0], ends[a:z] - base]).astype(np.int32)
                    more = pa.ListArray.from_arrays(pa.array(offs), pa.array(flat[base:int(ends[z - 1])].view(np.int64)))
                    d = doc[a:z]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[x:y][d]), pa.array(firsts[x:y][d]), pa.array((rows[a:z] - s.first[d]).astype(np.int32)),
                         pa.array(k1[a:z].view(np.int64)), pa.array(k2[a:z].view(np.int64)), more],
                        ["t", "first", "pos", "k1", "k2", "more"])
    return run


def _repeated(rows: DataFrame, name: str) -> DataFrame:
    """(k1, k2, lo): keys that more than one text has, with the smallest id."""
    return materialize(rows.groupBy("k1", "k2").agg(F.min("first").alias("lo"), F.min("t").alias("t0"), F.max("t").alias("t1"))
                       .filter("t0 <> t1").select("k1", "k2", "lo"), name)


def repeated_places(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(t, t2, first, gone, longest), one row per distinct text: its smallest id, the spans of words (start, end, ...)
    that stand in a document with a smaller id, and the greatest length of the levels at which it shares a window that
    begins at a picked place (0: none)."""
    base = only(docs, o=F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), t=F.xxhash64("text"),
                t2=F.xxhash64(F.lit(window), "text"), text="text")
    classes = materialize(base.groupBy("t", "t2").agg(F.min("o").alias("first")), "passage-classes")
    anchors = materialize(base.select("t", "text").mapInArrow(_anchors(window), "t long, pos int, key long"), "passage-anchors", TEXT_ROWS)
    shared = materialize(anchors.groupBy("key").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
                         .filter("lo <> hi").select("key"), "passage-shared")
    # the places of one text
    places = materialize(anchors.join(shared, "key", "left_semi").groupBy("t").agg(F.collect_set("pos").alias("at")),
                         "passage-places")
    near = materialize(classes.join(places, "t").select("t", "t2", F.col("first").alias("o"), "at"), "passage-near")
    texts = base.join(near, ["t", "t2", "o"]).select("t", F.col("o").alias("first"), "text", "at")
    rows = materialize(texts.mapInArrow(
        _windows(window), "t long, first long, pos int, k1 long, k2 long, more array<long>"), "passage-windows", TEXT_ROWS)
    alive = materialize(rows.join(_repeated(rows, "passage-repeated"), ["k1", "k2"])
                        .select("t", "first", "pos", (F.col("lo") < F.col("first")).alias("covered"), "more"), "passage-alive")
    cover = alive.filter("covered").groupBy("t", "first").agg(F.sort_array(F.collect_set("pos")).alias("places")) \
        .mapInArrow(_spans(window), "t long, first long, gone array<int>")
    # twice the length, as long as any candidate survives
    lengths = alive.select("t", "first", F.lit(window).alias("n")).distinct()
    size, level = window, alive.filter(F.size("more") > 0).select("t", "first", "more").distinct()
    while True:
        level = materialize(level.select("t", "first", F.element_at("more", 1).alias("k1"), F.element_at("more", 2).alias("k2"),
                                         F.slice("more", 3, 1 << 20).alias("more")), "passage-level")
        size *= 2
        kept = materialize(level.join(_repeated(level, "passage-repeated"), ["k1", "k2"], "left_semi")
                           .select("t", "first", "more"), "passage-kept")
        if kept.isEmpty():
            break
        lengths = lengths.unionByName(kept.select("t", "first", F.lit(size).alias("n")).distinct())
        level = kept.filter(F.size("more") > 0)
    longest = lengths.groupBy("t", "first").agg(F.max("n").alias("longest"))
    return materialize(classes.join(materialize(cover, "passage-cover"), ["t", "first"], "left")
                       .join(materialize(longest, "passage-longest"), ["t", "first"], "left")
                       .select("t", "t2", "first", "gone", F.coalesce("longest", F.lit(0)).alias("longest")), "passage-classes")


def _spans(window: int):
    """(t, first, gone): the words under the windows that start at the sorted places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for places in b.column(2):
                at = places.values.to_numpy()
                cut = np.flatnonzero(np.diff(at) > window)
                out.append(np.stack([at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)] + window], axis=1).ravel().tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.int32()))], ["t", "first", "gone"])
    return run


def _kept(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, total, gone = [], [], []
            for text, copy, gone_at in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                w = spaced(text).split()
                n = len(w)
                cut = n if copy and n >= window else 0
                if not cut and gone_at:
                    starts, ends = gone_at[::2], gone_at[1::2]
                    w = [x for a, z in zip([0, *ends], [*starts, n]) for x in w[a:z]]
                    cut = n - len(w)
                total.append(n)
                gone.append(cut)
                out.append("" if cut == n else b" ".join(w).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), b.column(4)],
                ["_row", "text", "n_words", "n_removed", "longest"])
    return run


def without_repeated_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(_row, text, n_words, n_removed, longest): all columns of ``docs`` in ``_row``, the kept words joined by a space."""
    cls = repeated_places(docs, window)
    rows = wrapped(docs, text="text", _o=F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), t=F.xxhash64("text"),
                   t2=F.xxhash64(F.lit(window), "text"))
    rows = rows.join(cls, ["t", "t2"]).select("_row", "text", (F.col("_o") > F.col("first")).alias("copy"), "gone", "longest")
    schema = StructType([rows.schema["_row"], rows.schema["text"], StructField("n_words", LongType()),
                         StructField("n_removed", LongType()), StructField("longest", IntegerType())])
    return rows.mapInArrow(_kept(window), schema)


def passage_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the kept words as text (``n_chars``, where there is one, follows)."""
    return unwrapped(without_repeated_passages(docs, window), docs, "text")


def passage_report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    rows = without_repeated_passages(only(docs, doc_id="doc_id", text="text"), window)
    return rows.select(F.col("_row.doc_id").alias("doc_id"), "n_words", "n_removed",
                       F.sha2("text", 256).alias("kept_sha256"), "longest")
