"""Fuzzy line deduplication by MinHash.

Lines (split at line feeds; trimmed and lower-cased for comparison) have
signatures of ``BANDS`` x ``ROWS`` minima over their shingles of ``SHINGLE``
characters.  Lines that agree on a whole band share a bucket; their exact
Jaccard similarity is computed; distributed union-find joins the verified
pairs; one line of each component, the first occurrence by (document id,
text hash, line number), stays.

A bucket of any size is compared in tiles: its lines fall into blocks of
bounded size (in lines and in characters), dealt out as (bucket, block,
block).  Buckets of the same two lines are one; a pair is looked at only in
the first bucket that its lines share (a row carries its bucket keys).  A
tile counts the shingles that its lines have in common, all pairs at once,
and returns no pairs but a forest: one link, verified on the shingles
themselves, for each line it could connect.  So the rows that move grow with
the lines of a bucket, not with its pairs.

At a Jaccard similarity of 0.8, 99.7 % of the pairs share a bucket.

Defined results: blank lines are no units and stay; null texts stay null; a
text that loses all its lines becomes empty, its row stays; repeated rows
(same id and text) count as one document and keep the same lines; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TEXT_ROWS, materialize, only, quoted, unwrapped, width
from .components import components
from .words import mix

SHINGLE, ROWS, BANDS, SIMILARITY = 8, 3, 8, 0.8
#: lines and characters of a block of a bucket, about
BLOCK_LINES, BLOCK_CHARS = 256, 1 << 20
#: shingles whose occurrences are held at once as a dense block
COLUMNS = 2048
#: tiles of so few lines are listed without numpy (same pairs, less overhead)
FEW = 12
#: join hint: the other side is not sorted
HASHED = "shuffle_hash"
_P = np.uint64(0x100000001B3)
_CHUNK = 1 << 17


def units(text: str | None) -> list[tuple[int, str]]:
    """(line number, line as compared) of the lines that are not blank."""
    out = []
    for i, line in enumerate((text or "").split("\n")):
        line = line.strip()
        if line:
            out.append((i, line.lower()))
    return out


def line_id(line: str) -> int:
    h = xxhash.xxh64_intdigest(line.encode("utf-8"), 0)
    return h - (1 << 64) if h >> 63 else h


def shingles(line: str) -> set[str]:
    return {line[i:i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def jaccard(a: set[str], b: set[str]) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def shingle_hashes(lines: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, hashes, first hash of each line) of parts of ``lines``: every shingle's hash, repeats included."""
    pad = "\0" * (SHINGLE - 1)
    at = 0
    while at < len(lines):
        end, size = at, 0
        while end < len(lines) and (end == at or size + len(lines[end]) <= _CHUNK):
            size += len(lines[end])
            end += 1
        part = lines[at:end]
        chars = np.frombuffer((pad.join(part) + pad).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        sizes = np.array([len(x) for x in part], np.int64)
        starts = np.cumsum(sizes + SHINGLE - 1) - (sizes + SHINGLE - 1)
        n = len(chars) - SHINGLE + 1
        # powers of _P times the characters: two halves of a span make one twice as long
        h, span, power = chars, 1, np.array([_P])
        while 2 * span <= SHINGLE:
            h = h[:-span] * power + h[span:]
            span, power = 2 * span, power * power
        for k in range(span, SHINGLE):
            h = h[:-1] * _P + chars[k:]
        count = np.maximum(1, sizes - SHINGLE + 1)
        # the shingles of each line, without those that reach into the padding
        first = np.cumsum(count) - count
        pick = np.repeat(starts - first, count) + np.arange(int(count.sum()))
        yield at, end, mix(h[pick] * np.uint64(0x9E3779B97F4A7C15)), first
        at = end


def band_keys(lines: list[str]) -> np.ndarray:
    """(lines, BANDS) bucket keys of lines that are not empty."""
    rng = np.random.default_rng(11)
    mul = rng.integers(0, 1 << 32, ROWS * BANDS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    add = rng.integers(0, 1 << 32, ROWS * BANDS, dtype=np.uint64).astype(np.uint32)
    low = np.empty((len(lines), ROWS * BANDS), np.uint32)
    for at, end, h, first in shingle_hashes(lines):
        x = (h >> np.uint64(32)).astype(np.uint32)
        for p in range(ROWS * BANDS):
            low[at:end, p] = np.minimum.reduceat(x * mul[p] + add[p], first)
    keys = np.empty((len(lines), BANDS), np.uint64)
    for b in range(BANDS):
        k = np.full(len(lines), b + 1, np.uint64)
        for r in range(ROWS):
            k = mix(k * np.uint64(0x9E3779B97F4A7C15) + low[:, b * ROWS + r].astype(np.uint64))
        keys[:, b] = k
    return keys.view(np.int64)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, h, no, id, chars, bands) of every line; of equal lines of a batch, the first has the bands."""
    for b in batches:
        row, no, ids, fresh = [], [], [], []
        seen: dict[str, int] = {}
        for i, t in enumerate(b.column(2).to_pylist()):
            for n, line in units(t):
                row.append(i)
                no.append(n)
                fresh.append(line not in seen)
                ids.append(seen.setdefault(line, len(seen)))
        if not row:
            continue
        lines = list(seen)
        code = np.array(ids)
        name = np.array([line_id(x) for x in lines], np.int64)[code]
        chars = np.array([len(x) for x in lines], np.int64)[code]
        take = pa.array(row)
        # the lines are numbered as they come, so the rows with bands are in their order
        ends = np.concatenate([[0], np.cumsum(fresh)]).astype(np.int32) * BANDS
        bands = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(band_keys(lines).ravel()))
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(take), b.column(1).take(take), pa.array(no, pa.int32()), pa.array(name), pa.array(chars), bands],
            ["doc_id", "h", "no", "id", "chars", "bands"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, line) of the lines of a batch, each once."""
    for b in batches:
        lines = list({line for t in b.column(0).to_pylist() for _, line in units(t)})
        yield pa.RecordBatch.from_arrays([pa.array([line_id(x) for x in lines], pa.int64()),
                                          pa.array(lines, pa.string())], ["id", "line"])


def _root(up: list[int], i: int) -> int:
    while up[i] != i:
        up[i] = up[up[i]]
        i = up[i]
    return i


def _common(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(size of each line's shingle set, number of common shingles of every two lines), by hashes."""
    row, code = [], []
    for at, end, h, first in shingle_hashes(lines):
        row.append(np.repeat(np.arange(at, end), np.diff(np.append(first, len(h)))))
        code.append(h)
    row, code = np.concatenate(row), np.concatenate(code)
    order = np.lexsort((row, code))
    row, code = row[order], code[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
    row, code = row[fresh], code[fresh]
    size = np.bincount(row, minlength=len(lines))
    new = np.ones(len(code), bool)
    new[1:] = code[1:] != code[:-1]
    number = np.cumsum(new) - 1
    often = np.bincount(number) > 1                # the others are in one line alone
    keep = often[number]
    row, number = row[keep], (np.cumsum(often) - 1)[number[keep]]
    both = np.zeros((len(lines), len(lines)), np.float32)
    for a in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        lo, hi = np.searchsorted(number, [a, a + COLUMNS])
        x = np.zeros((len(lines), COLUMNS), np.float32)
        x[row[lo:hi], number[lo:hi] - a] = 1.0
        both += x @ x.T
    return size, both


def shingle_codes(lines: list[str]) -> list[np.ndarray]:
    """Distinct shingles of each line as sorted numbers: equal numbers within a call are equal shingles, nothing is hashed.

    Lines of fewer characters than a shingle have none.
    """
    try:
        data = [x.encode("latin-1") for x in lines]
    except UnicodeEncodeError:
        letters = set().union(*lines)
        if len(letters) > 256:
            number: dict[str, int] = {}
            return [np.sort(np.array([number.setdefault(s, len(number)) for s in shingles(x)] if len(x) >= SHINGLE else [], np.uint64))
                    for x in lines]
        code = {ord(c): i for i, c in enumerate(letters)}
        data = [x.translate(code).encode("latin-1") for x in lines]
    out = []
    for d in data:
        # eight characters of a byte each are one number
        x = np.ndarray(max(0, len(d) - SHINGLE + 1), "<u8", d.ljust(SHINGLE), strides=(1,)).copy()
        x.sort()
        new = np.empty(len(x), bool)
        new[:1] = True
        np.not_equal(x[1:], x[:-1], out=new[1:])
        out.append(x[new])
    return out


def alike(u: np.ndarray, v: np.ndarray, similarity: float) -> bool:
    """Is the Jaccard similarity of two arrays of shingle_codes at least ``similarity``?"""
    if not len(u) or not len(v) or min(len(u), len(v)) < similarity * max(len(u), len(v)):
        return False
    x = np.concatenate((u, v))
    x.sort()
    both = int(np.count_nonzero(x[1:] == x[:-1]))
    return both / (len(u) + len(v) - both) >= similarity


def tile_links(band: int, lines: list[str], keys: list[list[int]], side: list[int] | None, similarity: float) -> list[tuple[int, int]]:
    """A forest of verified links between the lines of a tile (``side``: only between the two blocks)."""
    n, at = len(lines), keys[0].index(band)
    if n <= FEW:
        pairs = [(a, b) for a in range(n) for b in range(a + 1, n) if (side is None or side[a] != side[b])
                 and not any(map(eq, keys[a][:at], keys[b][:at]))]          # those did not meet in an earlier bucket
    else:
        i, j = np.triu_indices(n, 1)
        if side is not None:
            part = np.array(side)
            cross = part[i] != part[j]
            i, j = i[cross], j[cross]
        own = np.array(keys, np.int64)
        for b in range(at):
            apart = own[i, b] != own[j, b]
            i, j = i[apart], j[apart]
        if len(i) > 4 * n:
            count, both = _common(lines)
            near = both[i, j] >= similarity * (count[i] + count[j] - both[i, j]) - 0.5
            i, j = i[near], j[near]
        pairs = list(zip(i.tolist(), j.tolist()))
    if not pairs:
        return []
    up, out = list(range(n)), []
    used = sorted({k for pair in pairs for k in pair})
    codes = dict(zip(used, shingle_codes([lines[k] for k in used])))
    for a, b in pairs:
        x, y = _root(up, a), _root(up, b)
        if x != y and alike(codes[a], codes[b], similarity):
            up[x] = y
            out.append((a, b))
    return out


def _linked(similarity: float):
    """Links of the tiles; the rows come sorted by (band, p, q)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        name = None

        def done() -> list[tuple[int, int]]:
            if len(held) < 2:
                return []
            band, p, q = name
            ids, lines, side, keys = (list(c) for c in zip(*held))
            return [(ids[a], ids[b]) for a, b in tile_links(band, lines, keys, side if p != q else None, similarity)]

        def batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for b in batches:
            found: list[tuple[int, int]] = []
            band, p, q, ids, side = (b.column(c).to_numpy().tolist() for c in ("band", "p", "q", "id", "side"))
            keys = b.column("keys").flatten().to_numpy().reshape(len(b), -1).tolist()
            for k, row in zip(zip(band, p, q), zip(ids, b.column("line").to_pylist(), side, keys)):
                if k != name:
                    found += done()
                    held, name = [], k
                held.append(row)
            # the links of the tiles that end in a batch go together
            if found:
                yield batch(found)
        found = done()
        if found:
            yield batch(found)
    return run


def distinct_lines(lines: DataFrame) -> DataFrame:
    """(id, k0, k1, ..., chars, n) of every different line: its bucket keys, its length, how often it occurs."""
    chars = F.max("chars") if "chars" in lines.columns else F.lit(0).cast("long")
    return materialize(lines.groupBy("id").agg(*[F.max(F.get("bands", F.lit(b))).alias(f"k{b}") for b in range(BANDS)],
                                               chars.alias("chars"), F.count(F.lit(1)).alias("n")), "lines-each")


def line_components(lines: DataFrame, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, root) of the lines that are linked with others; ``lines`` as made by _occurrences (``chars``, where given,
    bounds the blocks too)."""
    return linked_lines(distinct_lines(lines), docs, similarity)


def linked_lines(each: DataFrame, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, root) of the lines that are linked with others; ``each`` as made by distinct_lines."""
    spark = docs.sparkSession
    names = [f"k{b}" for b in range(BANDS)]
    banded = each.select("id", "chars", F.explode(F.array(*names)).alias("band")).filter("band is not null")
    size = F.greatest(F.col("n") / BLOCK_LINES, F.col("chars") / BLOCK_CHARS)
    shared = (banded.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"),
                                         F.min("id").alias("lo"), F.max("id").alias("hi")).filter("n > 1"))
    # buckets of the same two lines are one
    shared = materialize(shared.groupBy("lo", "hi", F.when(F.col("n") > 2, F.col("band")).alias("own"))
                         .agg(F.min("band").alias("band"), F.max("n").alias("n"), F.max("chars").alias("chars"))
                         .select("band", F.ceil(size).cast("int").alias("blocks")), "lines-shared")
    # hashed sides have one narrow row per bucket or line, so the long sides need no sort
    placed = each.select("id", F.posexplode(F.array(*names)).alias("at", "band")).filter("band is not null")
    places = materialize(placed.join(shared.hint(HASHED), "band"), "lines-places")
    # a key that no bucket left is named after its line, so it equals no other
    need = materialize(places.groupBy("id").agg(F.array(*[F.coalesce(F.max(F.when(F.col("at") == b, F.col("band"))), F.col("id"))
                                                          for b in range(BANDS)]).alias("keys")), "lines-needed")
    found = docs.select("text").mapInArrow(_texts, "id long, line string")
    texts = materialize(found.join(need.hint(HASHED), "id").groupBy("id").agg(F.any_value("line").alias("line"), F.any_value("keys").alias("keys")),
                        "lines-texts", TEXT_ROWS)
    tiles = (places.select("id", "band", "blocks").join(texts, "id")
             .withColumn("side", F.pmod(F.xxhash64("id", "band"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("band", F.least("side", "other").alias("p"), F.greatest("side", "other").alias("q"),
                     "id", "line", "side", "keys"))
    links = tiles.repartition(width(spark), "band", "p", "q").sortWithinPartitions("band", "p", "q") \
        .mapInArrow(_linked(similarity), "a long, b long")
    return components(materialize(links, "lines-links", TEXT_ROWS), "lines-components")


def dropped_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, h, drop): numbers of the lines that go, for every document that loses any."""
    base = only(docs, doc_id=F.col("doc_id").cast("long"), h=F.xxhash64("text"), text="text")
    lines = materialize(base.mapInArrow(_occurrences, "doc_id long, h long, no int, id long, chars long, bands array<long>"),
                        "lines", TEXT_ROWS)
    each = distinct_lines(lines)
    comp = linked_lines(each, base, similarity)
    # only lines that occur several times, or have near copies, can go; a root is the least id of its component
    roots = materialize(each.filter("n > 1").select("id", F.col("id").alias("root"))
                        .unionByName(comp.select(F.col("node").alias("id"), "root"))
                        .groupBy("id").agg(F.min("root").alias("root")), "lines-rooted")
    held = materialize(lines.select("doc_id", "h", "no", "id").join(roots.hint(HASHED), "id").drop("id"), "lines-held")
    place = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "h", "no")
    keep = materialize(held.groupBy("root").agg(F.min(place).alias("keep")), "lines-keep")
    gone = held.join(keep.hint(HASHED), "root").filter(place != F.col("keep"))
    # the line numbers of one document
    return materialize(gone.groupBy("doc_id", "h").agg(F.sort_array(F.collect_set("no")).alias("drop")), "lines-gone")


def without_repeated_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(_row, text, n_lines, n_dropped): the other columns of ``docs`` in ``_row``, the text without its repeated lines."""
    drop = dropped_lines(docs, similarity).withColumnsRenamed({"doc_id": "_i", "h": "_g"}).hint(HASHED)
    # the text goes beside the row only: it is the bulk of what is shuffled here
    row = F.struct(*[F.col(quoted(c)) for c in docs.columns if c != "text"]).alias("_row")
    rows = docs.select(row, "text", F.col("doc_id").cast("long").alias("_d"), F.xxhash64("text").alias("_t"))
    rows = rows.join(drop, rows["_d"].eqNullSafe(drop["_i"]) & (rows["_t"] == drop["_g"]), "left")
    rest = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains("drop", i))
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    loses = F.col("drop").isNotNull()
    return rows.select("_row", F.when(loses, F.array_join(rest, "\n")).otherwise(F.col("text")).alias("text"),
                       (F.coalesce(breaks, F.lit(0)) + 1).cast("long").alias("n_lines"),
                       F.when(loses, F.size("drop")).otherwise(0).cast("long").alias("n_dropped"))


def line_dedup(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without repeated and nearly repeated lines (``n_chars``, where there is one, follows the text)."""
    return unwrapped(without_repeated_lines(docs, similarity), docs, "text")


def line_report(docs: DataFrame) -> DataFrame:
    rows = without_repeated_lines(only(docs, doc_id="doc_id", text="text"))
    return rows.select(F.col("_row.doc_id").alias("doc_id"), "n_lines", "n_dropped", "text")
