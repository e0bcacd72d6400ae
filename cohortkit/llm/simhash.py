"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within d bits share a variant within d/2 bits of each.
Every distinct fingerprint emits all variants within that half radius, a
shuffle brings equal variants together, and the pairs that meet there are
verified by their bit distance.  A variant holds at most as many different
fingerprints as its own ball has (65 for one bit), whatever the corpus, and
each links to the smallest one there.  Exact copies share a fingerprint and
are classes, never pairs.

Defined results: a text without words (null, empty) has fingerprint zero and
links like any other; repeated rows share a class; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, only, small_batches, unwrapped, wrapped
from .components import components

SEED, BITS = 42, 64


def shingle_hashes(text: str | None, k: int) -> list[int]:
    words = (text or "").encode("utf-8").lower().split()      # bytes: A-Z and ASCII white space only
    if not words:
        return []
    line, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= k:
        return [h(line, SEED)]
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = [s - 1 for s in starts[k:]] + [len(line)]
    return [h(line[a:b], SEED) for a, b in zip(starts, ends)]


def fingerprint(hashes: list[int]) -> int:
    """Bit b is 1 if it is set in over half of the hashes (64-bit, unsigned)."""
    if not hashes:
        return 0
    raw = np.array(hashes, dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(raw), 1 << 16):
        part = raw[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(raw), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, h, fp): the fingerprint as a signed long; h is the text's hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(shingle_hashes(t, shingle)) for t in b.column(2).to_pylist()], dtype="<u8")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view("<i8"))],
                                             ["doc_id", "h", "fp"])

    small_batches(docs.sparkSession)
    rows = only(docs, doc_id=F.col("doc_id").cast("long"), h=F.xxhash64("text"), text="text")
    return rows.mapInArrow(run, "doc_id long, h long, fp long")


def ball(radius: int) -> list[int]:
    """Bit masks of at most ``radius`` ones, as signed longs."""
    masks = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(BITS), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def fingerprint_links(distinct: DataFrame, distance: int) -> DataFrame:
    """(a, b) between different fingerprints: every link within ``distance`` bits is kept up to connection."""
    half = (distance + 1) // 2
    variants = distinct.select("fp", F.explode(F.array(*[F.lit(m) for m in ball(half)])).alias("mask")) \
        .select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("v"))
    shared = materialize(variants.groupBy("v").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"))
                         .filter("lo < hi"), "simhash-shared")
    # the members of a shared variant lie in its ball: a bounded set
    met = variants.join(shared.select("v"), "v").groupBy("v").agg(F.collect_set("fp").alias("m"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    if 2 * half == distance:                  # all members of a variant are within the distance
        pairs = met.select(F.array_min("m").alias("b"), F.explode("m").alias("a"))
    else:
        pairs = met.select(F.explode("m").alias("a"), "m").select("a", F.explode("m").alias("b"))
    return pairs.filter(F.col("b") < F.col("a")).filter(close).distinct()


def near_duplicate_classes(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, h, fp, component_id): the smallest id reachable by links."""
    fps = materialize(fingerprints(docs, shingle), "simhash-fp")
    classes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    comp = components(fingerprint_links(classes.select("fp"), distance), "simhash-components")
    rooted = materialize(classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
                         .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    best = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-best")
    by_fp = materialize(rooted.join(best, "root").select("fp", "component_id"), "simhash-by-fp")
    return fps.join(by_fp, "fp").select("doc_id", "h", "fp", "component_id")


def fingerprint_hex(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_dedup(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id (then text hash, then any)."""
    classes = materialize(near_duplicate_classes(docs, shingle, distance), "simhash-rows")
    # a group without any id still has to keep one document
    first = classes.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("f")) \
        .agg(F.min_by(F.struct("doc_id", "h"), F.struct(F.col("doc_id").isNull(), "doc_id", "h")).alias("k"))
    keep = first.select(F.col("k.doc_id").alias("_id"), F.col("k.h").alias("_h"))
    counts = classes.groupBy(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    keep = materialize(keep.join(counts, keep["_id"].eqNullSafe(counts["_id"]) & (keep["_h"] == counts["_h"]))
                       .select(keep["_id"], keep["_h"], "_n"), "simhash-keep")

    def rows(k: DataFrame) -> DataFrame:
        src = wrapped(docs, _d=F.col("doc_id").cast("long"), _t=F.xxhash64("text"))
        return src.join(k, src["_d"].eqNullSafe(k["_id"]) & (src["_t"] == k["_h"]), "left_semi")

    out = rows(keep.filter("_n = 1"))
    again = keep.filter("_n > 1")
    if not again.isEmpty():                    # repeated rows: one of each
        out = out.unionByName(rows(again).dropDuplicates(["_d", "_t"]))
    return unwrapped(out, docs)
