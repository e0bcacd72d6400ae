"""Hard negatives by rotated one-bit codes.

Vectors are made integer (floor of 256 times a component) and rotated by one
fixed orthogonal matrix.  A row is stored with the signs of its rotated vector
(one bit each; the code vector c has entries +-1/sqrt(d)), its length, and the
alignment a = v.c of vector and code.  The query side is rotated too and
quantised into bit planes, so that q.c is a sum of popcounts.  With
v = a c + r, r orthogonal to c,

    q.v = a (q.c) + q.r,   |q.r| <= sqrt(|q|^2 - (q.c)^2) sqrt(|v|^2 - a^2)

by Cauchy-Schwarz, which gives a certain interval for every score; the error
of the quantised q is added to it.  Only pairs whose interval can reach the
result are scored in integers, and only these scores are compared.  Where
floating point holds every sum of a tile exactly, the scores of many such
pairs come from one matrix product.

Anchors (a stated query set) are compared with all rows in tiles: a block of
rows with a block of anchors, both of bounded size.  A tile returns a bounded
number of rows per anchor, or per anchor and positive; the first ones over
all tiles are picked by Spark.  Positives come first; their scores then bound
the negatives.  Blocks of both sides meet by a shuffle, never on the driver.

Defined results: rows with a null id, label or vector, or with any null or
non-finite component take no part; rows of different length are not compared;
other rows are those with another id; repeated rows count each by itself, as
anchors, positives and negatives; ties are ordered by the smaller id; scores
beyond 64 bits are held at the ends of that range; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, only

PLANES, SEED = 6, 42
#: rows and anchors of a block, pairs whose intervals are held at once, blocks of rows in a strip, and tiles in one
#: Arrow batch, which holds both blocks of each
ROWS, ANCHORS, AT_ONCE, STRIP, TILES = 8192, 2048, 1 << 17, 16, 4
#: a sum of products below it is exact in 64 bits, and in the floating point types
_EXACT, _FLOATS = 1 << 62, ((np.float32, 1 << 24), (np.float64, 1 << 53))
#: share of the pairs from which one matrix product is less work than picking them
_MANY = 1 / 16
_END = (1 << 63) - 1


def integer_rows(vectors: DataFrame, relabel: int, labels: int, scale: int) -> DataFrame:
    """(vec_id, label, v): sound rows, the vector as integers; labels of ids divisible by ``relabel`` are moved on."""
    rows = only(vectors, vec_id=F.col("vec_id").cast("long"), label=F.col("label").cast("long"), e="embedding")
    fine = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x).cast("double") < F.lit(float("inf"))))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("e").isNotNull() & fine)
    moved = F.when(F.col("vec_id") % relabel == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return rows.select("vec_id", moved.alias("label"), F.transform("e", lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def rotation(d: int) -> np.ndarray:
    """One orthogonal matrix for each dimension."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, d]).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    n, d = bits.shape
    words = np.zeros((n, -(-d // 64) * 64), np.uint8)
    words[:, :d] = bits
    return np.packbits(words, axis=1, bitorder="little").view("<u8")


class Codes:
    """Sign codes of rotated vectors with their alignment and the length of the residual."""

    def __init__(self, rotated: np.ndarray):
        d = rotated.shape[1]
        self.bits = packed(rotated > 0)
        self.align = np.abs(rotated).sum(axis=1) / np.sqrt(d)
        self.rest = np.sqrt(np.maximum((rotated * rotated).sum(axis=1) - self.align ** 2, 0.0))

    def part(self, at: np.ndarray) -> Codes:
        some = object.__new__(Codes)
        some.bits, some.align, some.rest = self.bits[at], self.align[at], self.rest[at]
        return some


def intervals(query: np.ndarray, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) of the inner products of rotated ``query`` rows with the coded rows."""
    n, d = query.shape
    size = np.sqrt((query * query).sum(axis=1))
    query = query / np.where(size > 0, size, 1.0)[:, None]
    low, high = query.min(axis=1), query.max(axis=1)
    step = np.maximum((high - low) / ((1 << PLANES) - 1), np.finfo(float).tiny)
    level = np.rint((query - low[:, None]) / step[:, None]).astype(np.int64)
    near = low[:, None] + step[:, None] * level
    # sum of near over the set bits, by planes; q.c is twice that less the sum of all
    total = np.zeros((n, len(codes.bits)), np.uint16 if d << PLANES < 1 << 16 else np.int64)
    both, count = np.empty(total.shape, np.uint64), np.empty(total.shape, np.uint8)
    for p in reversed(range(PLANES)):
        plane = packed((level >> p) & 1)
        total <<= 1
        for w in range(plane.shape[1]):
            np.bitwise_and(plane[:, w, None], codes.bits[None, :, w], out=both)
            total += np.bitwise_count(both, out=count)
    # 32 bits, where they hold the products: every sum below is of terms under 8 sqrt(d), some of them rounded six times
    kind = np.float32 if size.max(initial=0) * (codes.align + codes.rest).max(initial=0) < 1e36 else np.float64
    align, rest, ones = (x.astype(kind) for x in (codes.align, codes.rest, np.bitwise_count(codes.bits).sum(axis=1, dtype=np.int64)))
    off = np.sqrt(((query - near) ** 2).sum(axis=1)) + 4e-6 * np.sqrt(d)
    unit, sums = 2 / np.sqrt(d), near.sum(axis=1) / np.sqrt(d)
    step, low, sums, off, size = (x.astype(kind)[:, None] for x in (unit * step, unit * low, sums, off, size))
    qc = total * step
    qc += low * ones
    qc -= sums
    # 1 - (q.c)^2 with q.c off by at most ``off``
    half = np.abs(qc)
    half -= off
    np.maximum(half, 0, out=half)
    half *= half
    np.subtract(kind(1 + 1e-5), half, out=half)
    np.maximum(half, 0, out=half)
    np.sqrt(half, out=half)
    half += kind(4e-6)
    half *= rest
    half += (off + kind(4e-6)) * align
    qc *= align
    low = qc - half
    half += qc
    low *= size
    half *= size
    return low, half


def scores(a: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products of one vector with rows; beyond 64 bits at the ends of the range."""
    if len(v) == 0:
        return np.zeros(0, np.int64)
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(v.astype(np.float64)).max(initial=0)) * max(1, v.shape[1])
    if most < _EXACT:
        return v @ a
    exact = v.astype(object) @ a.astype(object)
    return np.array([max(-_END - 1, min(_END, int(x))) for x in exact], np.int64)


class Exact:
    """Scores of anchors with rows: by matrix products where floating point holds every sum, else one by one."""

    def __init__(self, anchors: np.ndarray, v: np.ndarray):
        self.anchors, self.v, self.a, self.rows = anchors, v, None, None
        most = np.prod([float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (anchors, v)]) * max(1, v.shape[1])
        kind = next((k for k, end in _FLOATS if most < end), None)
        if kind is not None:
            self.a, self.rows = anchors.astype(kind), np.ascontiguousarray(v.T.astype(kind))

    def of(self, x: int, reach: np.ndarray, least: np.ndarray | None = None,
           most: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, row numbers, scores) of the pairs in ``reach``, whose first anchor is number ``x``; with ``least``
        and ``most``, pairs with scores outside of them may be left out."""
        dense = self.a is not None and np.count_nonzero(reach) > _MANY * reach.size
        if dense:
            s = self.a[x:x + len(reach)] @ self.rows
            if least is not None:
                reach = reach & (s >= least.astype(s.dtype)[:, None]) & (s <= most.astype(s.dtype)[:, None])
        for k in range(len(reach)):
            at = np.flatnonzero(reach[k])
            yield x + k, at, s[k, at].astype(np.int64) if dense else scores(self.anchors[x + k], self.v[at])


class Block:
    """Rows of one length: ids, labels and integer vectors, plain and rotated by ``turn``."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, turn: np.ndarray | None):
        self.ids, self.labels, self.v = ids, labels, v
        self.rotated = v.astype(np.float64) @ turn if v.shape[1] else np.zeros((len(v), 1))


def narrow(v: np.ndarray) -> np.ndarray:
    """The same integers in 2, 4 or 8 bytes."""
    for kind in ("<i2", "<i4"):
        if v.size == 0 or (v.min() >= np.iinfo(kind).min and v.max() <= np.iinfo(kind).max):
            return v.astype(kind)
    return v.astype("<i8")


def wide(blob: bytes, n: int, d: int) -> np.ndarray:
    if n * d == 0:
        return np.zeros((n, d), np.int64)
    return np.frombuffer(blob, f"<i{len(blob) // (n * d)}").reshape(n, d).astype(np.int64)


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, ids, labels, v): rows of one length in blocks of ROWS at most."""
    held: dict[int, list] = {}

    def flush(d: int) -> pa.RecordBatch:
        ids, labels, v = (np.concatenate(c) for c in zip(*held.pop(d)))
        return pa.RecordBatch.from_arrays(
            [pa.array([d], pa.int32()), pa.array([ids.tolist()], pa.list_(pa.int64())),
             pa.array([labels.tolist()], pa.list_(pa.int64())), pa.array([narrow(v).tobytes()], pa.binary())],
            ["d", "ids", "labels", "v"])

    for b in batches:
        if b.num_rows == 0:
            continue
        col = b.column(2)
        offsets, values = np.asarray(col.offsets), col.values.to_numpy(zero_copy_only=False).astype(np.int64)
        size = np.diff(offsets)
        for d in np.unique(size).tolist():
            at = np.flatnonzero(size == d)
            for x in range(0, len(at), ROWS):
                part = at[x:x + ROWS]
                held.setdefault(d, []).append((b.column(0).to_numpy()[part], b.column(1).to_numpy()[part],
                                               values[offsets[part][:, None] + np.arange(d)]))
                if sum(len(p[0]) for p in held[d]) >= ROWS:
                    yield flush(d)
    for d in list(held):
        yield flush(d)


def _tile(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, Block, np.ndarray, pa.StructArray]]:
    """(rows, anchors, row numbers of the anchors, the anchors as they came) of every joined row."""
    turns: dict[int, np.ndarray] = {}
    for b in batches:
        for i in range(b.num_rows):
            d = b.column("d")[i].as_py()
            if d and d not in turns:
                turns = {d: rotation(d)}
            ids, labels = (b.column(c)[i].values.to_numpy() for c in ("ids", "labels"))
            rows = Block(ids, labels, wide(b.column("v")[i].as_py(), len(ids), d), turns.get(d))
            own = b.column("anchors")[i].values
            v = own.field("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(own), d)
            yield rows, Block(own.field("vec_id").to_numpy(), own.field("label").to_numpy(), v, turns.get(d)), \
                own.field("name").to_numpy(), own


def _bounds(anchors: np.ndarray, codes: Codes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first anchor, low, high) of the scores of a few rotated anchors with all coded rows."""
    few = max(1, AT_ONCE // max(1, len(codes.bits)))
    for x in range(0, len(anchors), few):
        yield x, *intervals(anchors[x:x + few], codes)


def _first(ids: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """The first n by falling score, ties by smaller id."""
    return np.lexsort((ids, ~score))[:n]


def _columns(out: list[tuple], names: list[str]) -> pa.RecordBatch:
    """Rows of numbers and, at the end, two arrays of one length; the numbers hold for every element."""
    size, cols = [len(row[-1]) for row in out], list(zip(*out)) or [()] * len(names)
    flat = [np.repeat(np.array(c, np.int64), size) for c in cols[:-2]] \
        + [np.concatenate([np.zeros(0, np.int64), *c]) for c in cols[-2:]]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in flat], names)


def _positives(n: int):
    """Of every tile the first ``n`` other rows of each anchor's label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, anchors, names, _ in _tile(batches):
            codes, out = Codes(rows.rotated), []
            for label in np.unique(anchors.labels):
                own, same = np.flatnonzero(anchors.labels == label), np.flatnonzero(rows.labels == label)
                if len(same) == 0:
                    continue
                ids, exact = rows.ids[same], Exact(anchors.v[own], rows.v[same])
                for x, low, high in _bounds(anchors.rotated[own], codes.part(same)):
                    reach = ids != anchors.ids[own[x:x + len(low)], None]
                    if len(same) > n:            # n rows reach ``least`` for certain
                        low[~reach] = -np.inf
                        reach &= high >= np.partition(low, len(same) - n, axis=1)[:, [len(same) - n]]
                    for k, at, s in exact.of(x, reach):
                        if len(at) > n:
                            best = s >= np.partition(s, len(s) - n)[len(s) - n]
                            at, s = at[best], s[best]
                        top = _first(ids[at], s, n)
                        if len(top):
                            out.append((names[own[k]], anchors.ids[own[k]], ids[at][top], s[top]))
            yield _columns(out, ["name", "anchor_id", "positive_id", "positive_score"])
    return run


def _negatives(n: int, share: int, whole: int):
    """Of every tile the first ``n`` rows of another label in the band below each positive's score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, anchors, names, own in _tile(batches):
            codes, exact, out = Codes(rows.rotated), Exact(anchors.v, rows.v), []
            bands = [[(p["rank"], p["id"], p["score"], -(-share * p["score"] // whole), p["score"]) for p in x or []]
                     for x in own.field("positives").to_pylist()]
            least = np.array([min((x[3] for x in b), default=np.inf) for b in bands], np.float64)
            most = np.array([max((x[4] for x in b), default=-np.inf) for b in bands], np.float64)
            for x, low, high in _bounds(anchors.rotated, codes):
                z = x + len(low)
                reach = rows.labels != anchors.labels[x:z, None]
                reach &= high >= least[x:z, None]
                reach &= low <= most[x:z, None]
                for k, at, s in exact.of(x, reach, least[x:z], most[x:z]):
                    if len(at) == 0:
                        continue
                    order = _first(rows.ids[at], s, len(at))
                    falling, ids = s[order], rows.ids[at][order]
                    first = np.searchsorted(~falling, [~x[4] for x in bands[k]], "left").tolist()
                    last = np.searchsorted(~falling, [~max(x[3], -_END - 1) for x in bands[k]], "right").tolist()
                    for (rank, name, score, *_), a, e in zip(bands[k], first, last):
                        if a < e:
                            e = min(e, a + n)
                            out.append((names[k], anchors.ids[k], rank, name, score, ids[a:e], falling[a:e]))
            yield _columns(out, ["name", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"])
    return run


def _tiles(blocks: DataFrame, anchors: DataFrame, n: tuple[int, int, int], run, schema: str) -> DataFrame:
    """Every block of rows with every block of anchors of its length, in bounded tiles.

    ``n``: blocks, rows and anchors there are.  The anchors travel to the blocks of rows: a block draws one of so many
    strips, and every block of anchors is sent to each strip, so that no length and no block is one task's work.  There
    are as many strips as blocks while no more anchors are sent than there are rows, then one for STRIP blocks.  The
    planner's sizes do not count how often an anchor is sent, so the join says that it is by shuffle: a small table of
    anchors would be gathered on the driver as often as there are strips.
    """
    n_blocks, n_rows, n_anchors = n
    strips = max(1, min(n_blocks, max(-(-n_blocks // STRIP), n_rows // max(1, n_anchors))))
    held = [c for c in ("name", "vec_id", "label", "v", "positives") if c in anchors.columns]
    groups = (anchors.withColumn("d", F.array_size("v"))
              .withColumn("block", F.pmod(F.xxhash64("name"), F.lit(-(-n_anchors // ANCHORS) or 1)))
              .groupBy("d", "block").agg(F.collect_list(F.struct(*held)).alias("anchors"))
              .select("d", "anchors", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("at")))
    at = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(strips)).cast("int")
    # the strip is the side that is held for each block of anchors
    return groups.hint("merge").join(blocks.withColumn("at", at), ["d", "at"]).select("d", "ids", "labels", "v", "anchors") \
        .mapInArrow(run, schema)


def _top(rows: DataFrame, group: list[str], score: str, name: str, n: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(F.col(score).desc(), F.col(name))
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def hard_negatives(vectors: DataFrame, every: int = 100, relabel: int = 7, labels: int = 10, scale: int = 256,
                   positives: int = 5, negatives: int = 5, share: int = 80, whole: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for the rows whose id is divisible
    by ``every`` and each of their first ``positives`` rows of the same label, the first ``negatives`` rows of another
    label that score between ``share / whole`` of the positive and the positive."""
    rows = materialize(integer_rows(vectors, relabel, labels, scale), "negatives-rows")
    blocks = materialize(rows.mapInArrow(block_rows, "d int, ids array<long>, labels array<long>, v binary"), "negatives-blocks")
    anchors = materialize(rows.filter(F.col("vec_id") % every == 0).withColumn("name", F.monotonically_increasing_id()),
                          "negatives-anchors")
    n = blocks.count(), rows.count(), anchors.count()
    near = _tiles(blocks, anchors, n, _positives(positives), "name long, anchor_id long, positive_id long, positive_score long")
    near = materialize(_top(near, ["name"], "positive_score", "positive_id", positives), "negatives-positives", rows=TILES)
    own = near.groupBy("name").agg(F.collect_list(F.struct(
        "rank", F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives"))
    found = _tiles(blocks, anchors.join(own.hint("merge"), "name"), n, _negatives(negatives, share, whole),
                   "name long, anchor_id long, place long, positive_id long, positive_score long, "
                   "negative_id long, negative_score long")
    found = materialize(_top(found, ["name", "place"], "negative_score", "negative_id", negatives), "negatives-found", rows=TILES)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
