"""Best-fit packing by bin completion.

Documents are cut into pieces of at most ``capacity`` tokens.  What has to be
decided depends only on how many pieces there are of each length, and that
table has at most ``capacity`` rows whatever the corpus.  The search runs on
it: around the largest length left, fillings of the free room are enumerated
by branch and bound (largest lengths first, so dominated fillings come after
the one that dominates them), pruned by the least waste still possible, with
the best-fit filling as the incumbent.  The filling found is used as often as
its lengths allow, so every step uses up one length at least.  Spark then
deals the pieces of each length out to the places planned for that length.

Defined results: null text counts as empty (one piece, the end id); repeated
rows are packed as often as they occur; no rows give no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, only, rank_in_group, small_batches
from .encoding import encoder

#: branch-and-bound nodes looked at for one filling; the incumbent stands beyond
NODES = 4000
_PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for d, ids in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist())):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, (s, n) in enumerate(cut(len(ids), capacity)):
                    part = ids[s:s + n]
                    for c, v in zip(out, (d, k, s, n, zlib.crc32(part.tobytes()), part if with_ids else None)):
                        out[c].append(v)
            cols = [pa.array(out["doc_id"], pa.int64()), pa.array(out["piece"], pa.int32()),
                    pa.array(out["start"], pa.int64()), pa.array(out["length"], pa.int32()),
                    pa.array(out["ids_crc32"], pa.int64())]
            if with_ids:
                cols.append(pa.array(out["ids"], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(cols, list(out)[:len(cols)])

    small_batches(docs.sparkSession)
    rows = only(docs, doc_id=F.col("doc_id").cast("long"), text="text")
    return rows.mapInArrow(run, _PIECES + (", ids array<long>" if with_ids else ""))


# -- the search ------------------------------------------------------------

def _reachable(counts: np.ndarray, capacity: int) -> list[int]:
    """Bit r of entry s: room r can be filled exactly by lengths up to s (as often as liked)."""
    full, bits, out = (1 << (capacity + 1)) - 1, 1, [1]
    for s in range(1, capacity + 1):
        if counts[s]:
            step = s
            while step <= capacity:
                bits = (bits | bits << step) & full
                step *= 2
        out.append(bits)
    return out


def filling(counts: np.ndarray, lengths: list[int], room: int, reach: list[int]) -> list[int]:
    """Lengths that leave the least of ``room`` empty; among those, the largest first."""
    best: list[int] = []
    r = room
    for s in lengths:                          # best fit: the incumbent
        k = min(int(counts[s]), r // s)
        best += [s] * k
        r -= k * s
    waste, nodes = r, 0
    if waste == 0:
        return best

    def least(top: int, left: int) -> int:
        """The least waste possible in ``left`` with lengths up to ``top``."""
        have = reach[min(top, left)] & ((1 << (left + 1)) - 1)
        return left - (have.bit_length() - 1)

    def search(i: int, left: int, chosen: list[int]) -> None:
        nonlocal best, waste, nodes
        if left < waste:
            best, waste = list(chosen), left
        while i < len(lengths) and waste and nodes < NODES:
            s = lengths[i]
            i += 1
            if s > left:
                continue
            if least(s, left) >= waste:        # nothing from here on beats the incumbent
                return
            nodes += 1
            for k in range(min(int(counts[s]), left // s), 0, -1):
                if least(s - 1, left - k * s) < waste:
                    search(i, left - k * s, [*chosen, *[s] * k])

    search(next((i for i, s in enumerate(lengths) if s <= room), len(lengths)), room, [])
    return best


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Fillings with how often each is used; together they use up ``counts``."""
    c = np.zeros(capacity + 1, dtype=np.int64)
    for s, n in counts.items():
        c[s] = n
    out: list[tuple[list[int], int]] = []
    reach = None
    while True:
        left = np.flatnonzero(c)
        if len(left) == 0:
            return out
        a = int(left[-1])
        if a == capacity:
            out.append(([a], int(c[a])))
            c[a] = 0
            continue
        if reach is None:
            reach = _reachable(c, capacity)
        c[a] -= 1
        bin_ = [a, *filling(c, [int(s) for s in left[::-1] if c[s]], capacity - a, reach)]
        c[a] += 1
        use = np.bincount(bin_, minlength=capacity + 1)
        kinds = np.flatnonzero(use)
        times = int((c[kinds] // use[kinds]).min())
        c[kinds] -= times * use[kinds]
        if (c[kinds] == 0).any():
            reach = None
        out.append((bin_, times))


def places(fillings: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """For each length, rank ranges and where their pieces go, sorted by (length, first rank)."""
    rows, base, used, flat = [], 0, {}, []
    for lengths, times in fillings:
        offsets: dict[int, list[int]] = {}
        at = 0
        for s in lengths:
            offsets.setdefault(s, []).append(at)
            at += s
        for s, o in offsets.items():
            rows.append((s, used.get(s, 0), base, times, len(flat)))
            flat += o
            used[s] = used.get(s, 0) + times * len(o)
        base += times
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return {"key": (cols[:, 0] << 44) + cols[:, 1], "rank": cols[:, 1], "base": cols[:, 2],
            "times": cols[:, 3], "at": cols[:, 4], "offsets": np.array(flat, dtype=np.int64)}


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    ranked, totals = rank_in_group(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "_rank", "pieces")
    where = spark.sparkContext.broadcast(places(plan(dict(totals), capacity)))   # bounded by the capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = where.value
        for b in batches:
            size = b.column(b.schema.get_field_index("length")).to_numpy().astype(np.int64)
            rank = b.column(b.schema.get_field_index("_rank")).to_numpy()
            e = np.searchsorted(w["key"], (size << 44) + rank, "right") - 1
            j = rank - w["rank"][e]
            seq = w["base"][e] + j % w["times"][e]
            off = w["offsets"][w["at"][e] + j // w["times"][e]]
            keep = [n for n in b.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(n)) for n in keep),
                                              pa.array(seq), pa.array(off)], [*keep, "sequence_id", "offset"])

    schema = ", ".join(f"{n} {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"
    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024,
                   with_ids: bool = False) -> DataFrame:
    """One row per piece: where it comes from and where it goes."""
    pieces = materialize(pieces_of(docs, tokenizer, end_id, capacity, with_ids), "packing-pieces")
    return pack(pieces, capacity).withColumn("length", F.col("length").cast("long"))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of a frame packed ``with_ids``; a sequence has at most ``capacity`` ids."""
    return (packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("x"))
            .select("sequence_id", F.flatten(F.transform("x", lambda p: p["ids"])).alias("ids")))
