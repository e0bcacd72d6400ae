"""Sharding by minimax contiguous partition.

Rows with equal texts form one atomic group.  Groups stand in the order of
their text's 64-bit hash, after the oversize ones (more than an even share
of what is left; fewer than the shard count), which get a shard each.  The
smallest feasible shard capacity is found by binary search with a greedy
check, and the shards are cut within that capacity, as close to even as it
allows.

The driver never sees all groups.  It sees the sizes of at most 65,536 hash
ranges; ranges in which a cut can fall are split 256-fold until the ranges
left there hold single groups, so the capacity found is exact.

Defined results: null text counts as empty (no bytes, group of the empty
text); repeated rows stay together; an empty table gives no rows; a null id
sorts first within its shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, only, rank_in_group, text_or_empty

ROW_BYTES = 8
TOP_SHIFT, STEP = 48, 8


def smallest_capacity(sizes: np.ndarray, n: int) -> int:
    """Smallest C with which greedy contiguous filling needs at most n shards."""
    if len(sizes) == 0:
        return 0
    prefix = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    total = int(prefix[-1])
    lo, hi = max(-(-total // n), int(sizes.max())), total
    while lo < hi:
        mid = (lo + hi) // 2
        if greedy_cuts(prefix, mid, n)[-1] == len(sizes):
            hi = mid
        else:
            lo = mid + 1
    return lo


def greedy_cuts(prefix: np.ndarray, capacity: int, n: int) -> list[int]:
    """Exclusive end index of each of n shards, filled as far as they go."""
    cuts, at = [], 0
    for _ in range(n):
        at = int(np.searchsorted(prefix, prefix[at] + capacity, "right")) - 1
        cuts.append(at)
    return cuts


def even_cuts(prefix: np.ndarray, capacity: int, n: int) -> list[int]:
    """Cuts within the capacity, each as close to its even share as possible."""
    total, m = int(prefix[-1]), len(prefix) - 1
    earliest = [0] * (n + 1)
    earliest[n] = m
    for j in range(n - 1, 0, -1):
        earliest[j] = int(np.searchsorted(prefix, prefix[earliest[j + 1]] - capacity, "left"))
    cuts, at = [], 0
    for j in range(1, n):
        goal = total * j / n
        k = int(np.searchsorted(prefix, goal, "left"))
        if k > 0 and goal - prefix[k - 1] <= prefix[min(k, m)] - goal:
            k -= 1
        latest = int(np.searchsorted(prefix, prefix[at] + capacity, "right")) - 1
        at = min(max(k, earliest[j], at), latest)
        cuts.append(at)
    return [*cuts, m]


def _ranges(groups: DataFrame, shift: int, inside: list[tuple[int, int]] | None) -> dict[int, tuple]:
    """Bytes, groups and largest group of each hash range of width 2**shift."""
    r = F.shiftright("key", shift)
    df = groups.select(r.alias("r"), "bytes")
    if inside is not None:
        up = groups.sparkSession.createDataFrame([(x,) for x, _ in inside], "u long")
        df = (groups.withColumn("u", F.shiftright("key", shift + STEP))
              .join(F.broadcast(up), "u").select(r.alias("r"), "bytes"))   # opened ranges: bounded
    rows = df.groupBy("r").agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n"),
                               F.max("bytes").alias("m")).collect()
    return {x["r"]: (x["b"], x["n"], x["m"]) for x in rows}


def find_cuts(groups: DataFrame, n_shards: int) -> tuple[list[int], list[int], int]:
    """(keys of the oversize groups, first key of every later shard, capacity)."""
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    largest = groups.orderBy(F.desc("bytes"), "key").limit(n_shards).collect()
    big: list[int] = []
    left = total
    for r in largest:
        free = n_shards - len(big)
        if free > 1 and r["bytes"] * free > left:
            big.append(r["key"])
            left -= r["bytes"]
    n = n_shards - len(big)
    rest = groups.filter(~F.col("key").isin(big)) if big else groups
    shift = TOP_SHIFT
    # blocks: first key -> (bytes, groups, largest group, shift)
    blocks = {r << shift: (*v, shift) for r, v in _ranges(rest, shift, None).items()}
    while True:
        keys = sorted(blocks)
        sizes = np.array([blocks[k][0] for k in keys], dtype=np.int64)
        many = np.array([blocks[k][1] > 1 for k in keys], dtype=bool)
        if len(sizes) == 0:
            return big, [], 0
        prefix = np.concatenate([[0], np.cumsum(sizes)])
        hi = smallest_capacity(sizes, n)
        lo = max(-(-int(prefix[-1]) // n), max(blocks[k][2] for k in keys))
        todo = np.zeros(len(keys), dtype=bool)
        low = up = 0
        for j in range(1, n):
            low = int(prefix[max(0, int(np.searchsorted(prefix, low + lo, "right")) - 1)])
            up = min(up + hi, int(prefix[-1]))
            a = int(np.searchsorted(prefix, low, "right")) - 1
            b = int(np.searchsorted(prefix, up, "left"))
            g = int(np.searchsorted(prefix, int(prefix[-1]) * j / n, "left"))
            todo[a:b] = True
            todo[max(0, g - 1):g + 1] = True
        todo &= many
        if shift == 0 or not todo.any():
            break
        shift -= STEP
        opened = [keys[i] for i in np.flatnonzero(todo)]
        parts = _ranges(rest, shift, [(k >> (shift + STEP), k) for k in opened])
        for k in opened:
            del blocks[k]
        blocks.update({r << shift: (*v, shift) for r, v in parts.items()})
    cap = smallest_capacity(sizes, n)
    cuts = even_cuts(prefix, cap, n)
    # first key of shards 1..n-1; a shard past the end starts after every key
    return big, [keys[c] if c < len(keys) else None for c in cuts[:-1]], cap


def shard_of(key: Column, big: list[int], starts: list[int | None]) -> Column:
    s = F.lit(len(big))
    for k in starts:
        if k is not None:
            s = s + (key >= F.lit(k)).cast("int")
    for i, k in enumerate(big):
        s = F.when(key == F.lit(k), F.lit(i)).otherwise(s)
    return s.cast("int")


def assign_shards(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``shard``: sizes as near equal as whole groups allow."""
    key = F.xxhash64(text_or_empty(text_col))
    size = (F.octet_length(text_or_empty(text_col)) + ROW_BYTES).cast("long")
    groups = materialize(docs.select(key.alias("key"), size.alias("b")).groupBy("key")
                         .agg(F.sum("b").alias("bytes")), "shard-groups")
    big, starts, _ = find_cuts(groups, n_shards)
    return docs.withColumn("shard", shard_of(key, big, starts))


def write_shards(docs: DataFrame, path: str, n_shards: int) -> None:
    """One folder per shard; a shard of any size is written by many tasks."""
    assign_shards(docs, n_shards).write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    base = only(docs, doc_id="doc_id", text="text")
    rows = assign_shards(base, n_shards).select(
        "doc_id",
        (F.octet_length(text_or_empty("text")) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text_or_empty("text"), "UTF-8")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard")
    out, _ = rank_in_group(rows, ["shard"], ["doc_id", "text_crc32"], "slot", "shard-slots")
    return out.withColumn("grown_shard", F.lit(None).cast("int"))
