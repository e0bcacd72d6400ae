"""Token-id files: frequency-ranked ids in separate-control variable-length coding.

A folder ``blocks`` holds blocks of whole documents in ascending id order
(part files of increasing number, blocks in file order), a folder ``ranks``
the rank of every id: 0 for the most frequent id of the whole corpus, ties
by id.  Spark writes and commits the files, so lost executors cost only
their own tasks, and any shared store serves.

Defined results: null text counts as empty; a document always has its end
id, so it is never empty; repeated ids stand next to each other, ordered by
the hash of the text; a null id sorts first; no rows give no blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, only, small_batches, width
from .encoding import encoder
from .streamvbyte import decode, encode

BLOCK_IDS = 1 << 17

_IDS = "doc_id long, h long, n_tokens long, ids binary"
_BLOCKS = ("part int, block int, first long, n_ids long, doc_ids array<long>, "
           "n_tokens array<long>, control binary, data binary")
_READ = "part int, doc_id long, local long, n_tokens long, ids_crc32 long"


def _pack(ids: np.ndarray, z: zstandard.ZstdCompressor) -> bytes:
    return z.compress(ids.astype("<u2" if not len(ids) or int(ids.max()) < 1 << 16 else "<u4").tobytes())


def _unpack(blob: bytes, n: int, z: zstandard.ZstdDecompressor) -> np.ndarray:
    raw = z.decompress(blob)
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype(np.uint32)


def token_ids(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, h, n_tokens, ids): compressed ids of each document with its end id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, z = encoder(tokenizer), zstandard.ZstdCompressor(level=1)
        for b in batches:
            full = [np.append(i, np.uint32(end_id)) for i in enc.encode(b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(i) for i in full], pa.int64()),
                 pa.array([_pack(i, z) for i in full], pa.binary())], ["doc_id", "h", "n_tokens", "ids"])

    rows = only(docs, doc_id=F.col("doc_id").cast("long"), h=F.xxhash64("text"), text="text")
    return rows.mapInArrow(run, _IDS)


def id_counts(ids: DataFrame) -> np.ndarray:
    """Frequency of every id over all documents: one row per id and task, summed by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, total = zstandard.ZstdDecompressor(), np.zeros(0, np.int64)
        for b in batches:
            held = [_unpack(blob, n, z) for blob, n in zip(b.column("ids").to_pylist(), b.column("n_tokens").to_pylist())]
            if not held:
                continue
            c = np.bincount(np.concatenate(held))
            if len(c) > len(total):
                total = np.append(total, np.zeros(len(c) - len(total), np.int64))
            total[:len(c)] += c
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    rows = (ids.select("ids", "n_tokens").mapInArrow(run, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")).collect())        # at most the vocabulary
    out = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        out[r["id"]] = r["n"]
    return out


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    spark = docs.sparkSession
    small_batches(spark)
    ids = materialize(token_ids(docs, tokenizer, end_id), "token-ids")
    counts = id_counts(ids)
    by_rank = np.lexsort((np.arange(len(counts)), -counts))
    rank = np.empty(len(counts), np.uint32)
    rank[by_rank] = np.arange(len(counts))
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(by_rank)], "rank long, id long") \
        .coalesce(1).write.parquet(f"{path}/ranks")
    ranks = spark.sparkContext.broadcast(rank)          # one entry per id of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, part = zstandard.ZstdDecompressor(), TaskContext.get().partitionId()
        names, sizes, parts, held, first, block = [], [], [], 0, 0, 0

        def flush():
            control, data = encode(ranks.value[np.concatenate(parts)])
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([first]), pa.array([held]),
                 pa.array([names], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                ["part", "block", "first", "n_ids", "doc_ids", "n_tokens", "control", "data"])

        for b in batches:
            for d, n, blob in zip(b.column("doc_id").to_pylist(), b.column("n_tokens").to_pylist(),
                                  b.column("ids").to_pylist()):
                names.append(d)
                sizes.append(n)
                parts.append(_unpack(blob, n, z))
                held += n
                if held >= BLOCK_IDS:
                    yield flush()
                    names, sizes, parts, first, held, block = [], [], [], first + held, 0, block + 1
        if names:
            yield flush()

    (ids.repartitionByRange(width(spark), "doc_id", "h").sortWithinPartitions("doc_id", "h")
     .select("doc_id", "n_tokens", "ids").mapInArrow(run, _BLOCKS)
     .write.option("compression", "uncompressed").parquet(f"{path}/blocks"))


def _by_rank(spark: SparkSession, path: str):
    rows = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()    # at most the vocabulary
    return spark.sparkContext.broadcast(np.array([r["id"] for r in rows], dtype=np.uint32))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) decoded from the files, in file order by ``start``."""
    small_batches(spark, 64)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    by_rank = _by_rank(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids = by_rank.value[decode(r["control"], r["data"], r["n_ids"])].astype("<u4")
                sizes = np.array(r["n_tokens"], np.int64)
                ends = np.cumsum(sizes)
                view = memoryview(ids.tobytes())
                crc = [zlib.crc32(view[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["part"]] * len(sizes), pa.int32()), pa.array(r["doc_ids"], pa.int64()),
                     pa.array(r["first"] + ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())],
                    ["part", "doc_id", "local", "n_tokens", "ids_crc32"])

    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()     # one row per part file
    rows, base = [], 0
    for r in sorted(totals, key=lambda r: r["part"]):
        rows.append((r["part"], base))
        base += r["n"]
    bases = spark.createDataFrame(rows, "part int, base long")
    docs = blocks.mapInArrow(run, _READ)
    return docs.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("local") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids) decoded from the files."""
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    by_rank = _by_rank(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids = by_rank.value[decode(r["control"], r["data"], r["n_ids"])].astype(np.int64)
                offsets = np.concatenate([[0], np.cumsum(r["n_tokens"])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))],
                    ["doc_id", "ids"])

    return blocks.mapInArrow(run, "doc_id long, ids array<long>")
