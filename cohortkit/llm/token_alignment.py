"""Alignment of two tokenizers by inverted pair bitmaps.

Every text is encoded by both tokenizers.  Byte places where tokens of both
end cut them into groups, and the two tokens that end there are linked.  For
every linked pair of ids there is a posting: the documents that hold it, as
compressed bitmaps, one per binary digit of its multiplicity there (planes).
Documents are numbered inside chunks, a chunk being a bounded part of one
task's input; a plane of one chunk is a sorted list of numbers, or plain bits
where that is smaller.  The OR of the planes, popcounted, is the pair's number
of documents, the popcounts weighted by the planes' digits its number of
links; Spark sums them over the chunks.

The scores go back through the postings: each posting is joined with its
pair's counts, the postings of a chunk meet, and every document adds up
multiplicity times count.  So no row per link is ever shuffled, a pair that
stands in every document costs one row per chunk, and no pair or document is
gathered beyond a chunk.

Special tokens' strings inside texts are plain text.  Pieces of text between
spaces are encoded once per worker.

Defined results: texts that are null, empty or that one of the tokenizers
does not give back byte by byte have no tokens (zeros, empty column); no token
of a public vocabulary is empty, so that places where both end are links one
to one; repeated rows count as often as they occur; null ids are kept; an
empty table gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TEXT_ROWS, materialize, only, width
from .encoding import Encoder, byte_letters
from .words import groups_by_size

#: a chunk is closed beyond so many links or documents
CHUNK_LINKS, CHUNK_DOCS = 1 << 21, 1 << 16


class PieceEncoder(Encoder):
    """A sentencepiece model behind the same table of pieces; no piece of it goes over from text to a space."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.kind = "whole" if any("▁" in p.lstrip("▁") for p in pieces) else "spaces"
        self.space = self.model.piece_to_id("▁")
        self.vocab_size = n
        self._reset()

    def token_bytes(self) -> list[bytes]:
        m = self.model
        return [bytes([int(p[1:-1], 16)]) if m.is_byte(i) else b"" if m.is_control(i) else p.replace("▁", " ").encode("utf-8")
                for i, p in ((i, m.id_to_piece(i)) for i in range(self.vocab_size))]

    def _cut(self, buf: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        space = buf == 0x20
        start = np.zeros(len(buf), bool)
        start[1:] = space[1:] & ~space[:-1]
        start[doc_starts] = True
        at = np.flatnonzero(start)
        return at, np.append(at[1:], len(buf))

    def _lists(self, pieces: list[bytes]) -> list[list[int]]:
        """Every piece begins with the space that the model adds by itself."""
        got = self.model.encode([p[1:].decode("utf-8") for p in pieces], num_threads=1)
        return [ids if len(p) > 1 else [self.space] for ids, p in zip(got, pieces)]

    def _ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists = self._lists(pieces)
        return np.arange(len(pieces)), np.array([i for x in lists for i in x], np.uint32), np.array([len(x) for x in lists], np.int64)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text[1:], num_threads=1), np.uint32)

    def _unsafe(self, data: bytes) -> bool:
        return self.kind == "whole" or b"\xe2\x96\x81" in data

    def _prepared(self, data: bytes) -> bytes:
        return data


def byte_token_bytes(enc: Encoder) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary."""
    value = {c: b for b, c in enumerate(byte_letters())}
    out = [b""] * enc.vocab_size
    for token, i in enc.full.get_vocab().items():
        out[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode("utf-8")
    return out


class Aligner:
    """Both tokenizers with the bytes of their tokens and the texts of their ids."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Encoder(path_a), PieceEncoder(path_b)
        self.a.full.encode_special_tokens = True
        bytes_a, bytes_b = byte_token_bytes(self.a), self.b.token_bytes()
        self.tokens = [np.array(x, dtype=object) for x in (bytes_a, bytes_b)]
        self.size = [np.array([len(t) for t in x], np.int64) for x in (bytes_a, bytes_b)]
        self.n_b = len(bytes_b)
        # the text of an id with what follows it: inside a side, at the side's end
        self.shift = 2 * len(bytes_a)
        self.text = np.array([f"{i}{c}".encode() for i in range(len(bytes_a)) for c in ",|"]
                             + [f"{i}{c}".encode() for i in range(len(bytes_b)) for c in ",;"], dtype=object)

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """((n_a, n_b, n_groups) of each text, digests, text of each link, its pair)."""
        spaced = [" " + t if t else "" for t in texts]
        data = [t.encode("utf-8") for t in spaced]
        ids = [self.a.encode(spaced), self.b.encode(spaced)]
        sound = [bool(d) and all(b"".join(self.tokens[s][ids[s][i]].tolist()) == d for s in (0, 1)) for i, d in enumerate(data)]
        empty = np.zeros(0, np.uint32)
        ids = [[x if ok else empty for x, ok in zip(side, sound)] for side in ids]
        count = np.array([[len(x) for x in side] for side in ids], np.int64).reshape(2, len(texts))
        flat = [np.concatenate([empty, *side]).astype(np.int64) for side in ids]
        ends = [np.cumsum(self.size[s][flat[s]]) for s in (0, 1)]
        total = int(ends[0][-1]) if len(ends[0]) else 0
        at_end = [np.zeros(total + 1, bool) for _ in (0, 1)]
        for s in (0, 1):
            at_end[s][ends[s]] = True
        last = [at_end[1 - s][ends[s]] for s in (0, 1)]            # does a token of the other side end here too?
        pairs = flat[0][last[0]] * self.n_b + flat[1][last[1]]
        closed = [np.concatenate([[0], np.cumsum(x)]) for x in last]
        bound = [np.concatenate([[0], np.cumsum(c)]) for c in count]
        groups = np.diff(closed[0][bound[0]])
        owner = np.repeat(np.arange(len(texts)), groups)
        # both sides of a group behind each other
        after = [np.concatenate([[0], np.flatnonzero(x) + 1]) for x in last]       # tokens before each group
        place = [np.arange(len(flat[0])) + after[1][closed[0][:-1]], np.arange(len(flat[1])) + after[0][closed[1][:-1] + 1]]
        code = np.empty(len(flat[0]) + len(flat[1]), np.int64)
        code[place[0]] = 2 * flat[0] + last[0]
        code[place[1]] = self.shift + 2 * flat[1] + last[1]
        cuts = bound[0] + bound[1]
        digests = []
        for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            line = b"".join(self.text[code[x:y]].tolist())
            digests.append(sha256(line[:-1]).hexdigest() if line else "")
        return np.vstack([count, groups[None, :]]), digests, owner, pairs


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner for two files, kept for its next tasks."""
    kept = vars(sys).setdefault("_cohortkit_aligners", {})
    if (path_a, path_b) not in kept:
        kept[path_a, path_b] = Aligner(path_a, path_b)
    return kept[path_a, path_b]


# -- bitmaps of one chunk: sorted document numbers, or bits where these are smaller --

def packed_plane(docs: np.ndarray) -> bytes:
    if 2 * len(docs) <= (int(docs[-1]) >> 3) + 1:
        return b"L" + docs.astype("<u2").tobytes()
    bits = np.zeros(int(docs[-1]) + 1, np.uint8)
    bits[docs] = 1
    return b"B" + np.packbits(bits, bitorder="little").tobytes()


def plane_docs(blob: bytes) -> np.ndarray:
    if blob[:1] == b"L":
        return np.frombuffer(blob, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, offset=1), bitorder="little"))


def popcount(blob: bytes) -> int:
    if blob[:1] == b"L":
        return (len(blob) - 1) // 2
    return int(np.bitwise_count(np.frombuffer(blob, np.uint8, offset=1)).sum())


def united(planes: list[bytes]) -> bytes:
    """OR of bitmaps."""
    if len(planes) == 1:
        return planes[0]
    return packed_plane(np.unique(np.concatenate([plane_docs(p) for p in planes])))


def postings(docs: np.ndarray, pairs: np.ndarray) -> Iterator[tuple[int, list[int], list[bytes]]]:
    """(pair, digits, planes) from the links of a chunk."""
    key, times = np.unique(pairs << 16 | docs, return_counts=True)
    pair, doc = key >> 16, key & 0xFFFF
    edge = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
    most = np.maximum.reduceat(times, edge) if len(edge) else edge
    for a, z, top in zip(edge.tolist(), [*edge[1:].tolist(), len(pair)], most.tolist()):
        if top == 1:
            yield int(pair[a]), [0], [packed_plane(doc[a:z])]
            continue
        digits = [j for j in range(top.bit_length()) if ((times[a:z] >> j) & 1).any()]
        yield int(pair[a]), digits, [packed_plane(doc[a:z][(times[a:z] >> j) & 1 == 1]) for j in digits]


_ROWS = ("chunk long, doc int, doc_id {id}, n_a long, n_b long, n_groups long, groups_sha256 string, "
         "pair long, docs long, links long, digits array<int>, planes array<binary>")


def _align(path_a: str, path_b: str, id_type: pa.DataType):
    names = ["chunk", "doc", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pair", "docs", "links", "digits", "planes"]
    kinds = [pa.int64(), pa.int32(), id_type, pa.int64(), pa.int64(), pa.int64(), pa.string(),
             pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.binary())]

    def batch(n: int, **cols) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [cols[c] if isinstance(cols.get(c), pa.Array) else pa.array(cols[c], k) if c in cols else pa.nulls(n, k)
             for c, k in zip(names, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        chunk, used, held, parts = TaskContext.get().partitionId() << 20, 0, 0, []

        def closed() -> Iterator[pa.RecordBatch]:
            rows = postings(np.concatenate([d for d, _ in parts]), np.concatenate([p for _, p in parts])) if parts else iter(())
            some: list[tuple] = []
            for pair, digits, planes in rows:
                some.append((pair, popcount(united(planes)), sum(popcount(p) << j for j, p in zip(digits, planes)), digits, planes))
                if len(some) == 1 << 14:
                    yield made(some)
                    some = []
            if some:
                yield made(some)

        def made(some: list[tuple]) -> pa.RecordBatch:
            cols = dict(zip(("pair", "docs", "links", "digits", "planes"), map(list, zip(*some))))
            return batch(len(some), chunk=[chunk] * len(some), **cols)

        for b in batches:
            texts = b.column(1).to_pylist()
            for x, y in groups_by_size(texts, 2 << 20):
                for at in range(x, y, CHUNK_DOCS // 2):
                    to = min(y, at + CHUNK_DOCS // 2)
                    if used + to - at > CHUNK_DOCS or held > CHUNK_LINKS:
                        yield from closed()
                        chunk, used, held, parts = chunk + 1, 0, 0, []
                    count, digests, owner, pairs = both.align(texts[at:to])
                    yield batch(to - at, chunk=[chunk] * (to - at), doc=pa.array(np.arange(used, used + to - at, dtype=np.int32)),
                                doc_id=b.column(0).slice(at, to - at), n_a=pa.array(count[0]), n_b=pa.array(count[1]),
                                n_groups=pa.array(count[2]), groups_sha256=digests)
                    parts.append((owner + used, pairs))
                    used, held = used + to - at, held + len(pairs)
        yield from closed()
    return run


def _returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, doc, n_best, count_sum) from postings that are sorted by chunk."""
    now, best, total = None, None, None

    def done() -> pa.RecordBatch:
        at = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), now, np.int64)), pa.array(at.astype(np.int32)),
                                           pa.array(best[at]), pa.array(total[at])], ["chunk", "doc", "n_best", "count_sum"])

    for b in batches:
        for c, n, is_best, digits, planes in zip(*(b.column(x).to_pylist() for x in ("chunk", "links", "best", "digits", "planes"))):
            if c != now:
                if now is not None:
                    yield done()
                now, best, total = c, np.zeros(CHUNK_DOCS, np.int64), np.zeros(CHUNK_DOCS, np.int64)
            for j, plane in zip(digits, planes):
                at = plane_docs(plane)
                total[at] += n << j
                if is_best:
                    best[at] += 1 << j
    if now is not None:
        yield done()


def pair_counts(rows: DataFrame, n_b: int) -> DataFrame:
    """(pair, a, b, docs, links, best): corpus-wide counts of every linked pair; best: highest of its B id."""
    b = F.col("pair") % n_b
    sums = materialize(rows.filter("pair is not null").groupBy("pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links")),
                       "pairs-sums").withColumn("b", b)
    most = materialize(sums.groupBy("b").agg(F.max("links").alias("most")), "pairs-most")
    return materialize(sums.join(most, "b").select(
        "pair", F.floor(F.col("pair") / n_b).cast("long").alias("a"), "b", "docs", "links", (F.col("links") == F.col("most")).alias("best")),
        "pairs-counts")


def aligned(docs: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """(documents with their counts and scores, pairs with their counts)."""
    import sentencepiece
    spark = docs.sparkSession
    base = only(docs, doc_id="doc_id", text="text")
    kind = dict(base.dtypes)["doc_id"]
    id_type = pa.int32() if kind == "int" else pa.int64()
    if kind not in ("int", "bigint"):
        base, kind = base.withColumn("doc_id", F.col("doc_id").cast("long")), "bigint"
    rows = materialize(base.mapInArrow(_align(path_a, path_b, id_type), _ROWS.format(id=kind)), "pairs-rows", TEXT_ROWS)
    n_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    counts = pair_counts(rows, n_b)
    held = rows.filter("pair is not null").select("chunk", "pair", "digits", "planes") \
        .join(counts.select("pair", "links", "best"), "pair").select("chunk", "links", "best", "digits", "planes")
    scores = held.repartition(width(spark), "chunk").sortWithinPartitions("chunk") \
        .mapInArrow(_returned, "chunk long, doc int, n_best long, count_sum long")
    scores = materialize(scores, "pairs-scores")
    texts = rows.filter("pair is null").select("chunk", "doc", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
    zero = F.lit(0).cast("long")
    out = texts.join(scores, ["chunk", "doc"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
    return out, counts
