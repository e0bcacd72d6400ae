"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds the words of the test items.  Documents are streamed
through it word by word; the longest match that ends at each word says
whether a window of ``window`` item words ends there (every item has its
windows; a shorter item is one window whole).  Stretches in which no match
can be long enough, because two neighbouring words stand side by side in no
item, are skipped by numpy before the automaton sees them.

Test items are taken in blocks of bounded word count (by item hash); each
block's automaton is broadcast as flat arrays and sees all documents, so the
broadcast does not grow with the benchmark.  Spans of all blocks are cut
together, and texts that were cut are looked at again, so the cut texts do not
depend on the blocks; one block takes the same path as many.

A hit carries the automaton's state, never the items that hold its window:
the states of different windows have disjoint marks, so the items of a text
are one pass over at most a block's marks.  Texts with the same states share
one row of items, and documents with the same text one row of spans, so a
passage that thousands of items and of documents share costs items plus
documents, not their product.

Defined results: null or wordless texts have no words, no hits; wordless or
null items have no window; an item without id hits but is not listed;
repeated rows and repeated items change nothing else; empty tables give no
rows or no hits.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ARROW_ROWS, materialize, only, unwrapped, wrapped
from .words import WordBatch, groups_by_size, keys, normalized

#: words of one automaton, about
BLOCK_WORDS = 500_000
_SPANS = "starts array<int>, ends array<int>, marks array<int>"
#: unions of marks a task remembers
UNIONS = 256


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.items = [i for i, _ in items]
        self.vocab: dict[bytes, int] = {}
        seqs = [[self.vocab.setdefault(w, len(self.vocab)) for w in words] for _, words in items]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        marks = []
        for n, seq in enumerate(seqs):
            last = 0
            for c in seq:
                last = self._extend(last, c)
                marks.append((last, n))
        self._tour(marks)
        #: groups of equal items shorter than the window; state -> [(length, group)] of those that end there
        self.groups: list[list[int]] = []
        self.whole: dict[int, list[tuple[int, int]]] = {}
        at: dict[tuple[int, int], int] = {}
        for n, seq in enumerate(seqs):
            if 0 < len(seq) < window:
                s = 0
                for c in seq:
                    s = self.next[s][c]
                g = at.setdefault((s, len(seq)), len(self.groups))
                if g == len(self.groups):
                    self.groups.append([])
                    self.whole.setdefault(s, []).append((len(seq), g))
                self.groups[g].append(n)
        #: nearest state with whole items on the way to the root; the shortest state that still holds a window
        near, top = [-1] * len(self.link), [-1] * len(self.link)
        for s in sorted(range(len(self.link)), key=self.size.__getitem__):
            up = self.link[s]
            near[s] = s if s in self.whole else near[up] if s else -1
            if self.size[s] >= window:
                top[s] = top[up] if self.size[up] >= window else s
        self.shortest = min([window, *(len(s) for s in seqs if s)])
        words = sorted(self.vocab, key=self.vocab.get)
        self.n_words = len(words)
        data = b"".join(words)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64) if words else np.zeros(0, np.int64)
        starts = ends - np.array([len(w) for w in words], dtype=np.int64)
        k = keys(data, starts, ends)
        self.order = np.argsort(k)
        self.keys = k[self.order]
        pairs = {a * len(words) + b for s in seqs for a, b in zip(s, s[1:])}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self._flatten(near, top)
        self._views()

    def _flatten(self, near: list[int], top: list[int]) -> None:
        """The steps of all states as two arrays, ordered by (state, word); states as small integers."""
        n = sum(map(len, self.next))
        step = np.fromiter((s * self.n_words + c for s, m in enumerate(self.next) for c in m), np.int64, n)
        to = np.fromiter((t for m in self.next for t in m.values()), np.int32, n)
        by = np.argsort(step)
        self.flat = {"step": step[by], "to": to[by],
                     **{k: np.array(v, np.int32) for k, v in (
                         ("link", self.link), ("size", self.size), ("near", near), ("top", top),
                         ("enter", self.enter), ("leave", self.leave))}}
        for k in ("next", "link", "size", "enter", "leave"):
            delattr(self, k)

    def _views(self) -> None:
        #: memory views give plain integers, faster one at a time than the arrays
        self.at = {k: memoryview(v) for k, v in self.flat.items()}
        self.unions: dict[tuple[int, ...], np.ndarray] = {}

    def packed(self) -> dict:
        """What a broadcast carries."""
        return {k: v for k, v in vars(self).items() if k not in ("at", "unions")}

    @classmethod
    def load(cls, state: dict) -> Automaton:
        """From a broadcast: plain data, since executors need no copy of this class."""
        a = cls.__new__(cls)
        a.__dict__.update(state)
        a._views()
        return a

    def _state(self, size: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.size.append(size)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        clone = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.size[q] == self.size[last] + 1 else self._split(last, q, c)
        new, p = self._state(self.size[last] + 1, {}, 0), last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, q, c)
        return new

    def _tour(self, marks: list[tuple[int, int]]) -> None:
        """Entry and exit times in the link tree; the marks in entry order."""
        kids: list[list[int]] = [[] for _ in self.link]
        for s, p in enumerate(self.link):
            if p >= 0:
                kids[p].append(s)
        self.enter, self.leave = [0] * len(self.link), [0] * len(self.link)
        clock, stack = 0, [(0, False)]
        while stack:
            s, done = stack.pop()
            if done:
                self.leave[s] = clock
                continue
            self.enter[s] = clock
            clock += 1
            stack.append((s, True))
            stack += [(k, False) for k in kids[s]]
        order = sorted((self.enter[s], n) for s, n in marks)
        self.mark_at = np.array([e for e, _ in order], dtype=np.int64)
        self.mark_item = np.array([n for _, n in order], dtype=np.int64)

    def holders(self, marks: tuple[int, ...]) -> np.ndarray:
        """Items behind the marks of ``stream``: those that hold the words of a state, or a group of whole items."""
        got = self.unions.get(marks)
        if got is None:
            flag = np.zeros(len(self.items), bool)
            for m in marks:
                if m < 0:
                    flag[self.groups[~m]] = True
                else:
                    a, b = np.searchsorted(self.mark_at, [self.at["enter"][m], self.at["leave"][m]])
                    flag[self.mark_item[a:b]] = True
            if len(self.unions) >= UNIONS:
                self.unions.clear()
            got = self.unions[marks] = np.flatnonzero(flag)
        return got

    def stream(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(first, end, mark) of the windows that end at each word; the mark is the state
        of a window, or ~group of whole items."""
        step, to, link, size, near, top = (self.at[k] for k in ("step", "to", "link", "size", "near", "top"))
        n_steps, n_words, vocab, window = len(step), self.n_words, self.vocab, self.window
        s = length = 0
        for i, w in enumerate(words):
            c = vocab.get(w, -1)
            if c < 0:
                s = length = 0
                continue
            while True:
                k = s * n_words + c
                j = bisect_left(step, k)
                if j < n_steps and step[j] == k:
                    s = to[j]
                    length += 1
                    break
                if s == 0:
                    length = 0
                    break
                s = link[s]
                length = size[s]
            if length >= window:
                yield i + 1 - window, i + 1, top[s]
            u = near[s]
            while u != -1:
                for n, group in self.whole[u]:
                    if n <= length:
                        yield i + 1 - n, i + 1, ~group
                u = near[link[u]] if u else -1

    def runs(self, batch: WordBatch) -> list[tuple[int, int]]:
        """Word ranges of the batch in which a window can stand; none crosses a document."""
        if self.n_words == 0 or len(batch.keys) == 0:
            return []
        at = np.minimum(np.searchsorted(self.keys, batch.keys), self.n_words - 1)
        known = self.keys[at] == batch.keys
        ids = np.where(known, self.order[at], -1)
        linked = np.zeros(len(ids), bool)               # word i may follow word i - 1
        both = np.flatnonzero(known[1:] & known[:-1]) + 1
        pair = ids[both - 1].astype(np.int64) * self.n_words + ids[both]
        if len(self.pairs):
            p = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            linked[both] = self.pairs[p] == pair
        starts = batch.first[:-1]
        linked[starts[starts < len(ids)]] = False
        first = np.flatnonzero(known & ~linked)
        last = np.flatnonzero(known & ~np.append(linked[1:], False)) + 1
        long = last - first >= self.shortest
        return list(zip(first[long].tolist(), last[long].tolist()))

    def match(self, texts: list[bytes]) -> list[tuple[int, np.ndarray, np.ndarray, tuple[int, ...], WordBatch, int]]:
        """Per text: words, starts and ends of merged hit spans (words from 0), different marks
        in order (see ``holders``), and where it lies."""
        b = WordBatch(texts)
        hits: dict[int, list[tuple[int, int, int]]] = {}
        for a, e in self.runs(b):
            doc = int(np.searchsorted(b.first, a, "right")) - 1
            base = int(b.first[doc])
            got = hits.setdefault(doc, [])
            got += [(a - base + x, a - base + y, m) for x, y, m in self.stream([b.word(k) for k in range(a, e)])]
        out = []
        for doc in range(len(texts)):
            n = int(b.first[doc + 1] - b.first[doc])
            got = hits.get(doc, ())
            spans = joined((x, y) for x, y, _ in got)
            out.append((n, np.array([x for x, _ in spans], np.int64), np.array([y for _, y in spans], np.int64),
                        tuple(sorted({m for _, _, m in got})), b, doc))
        return out


def without(raw: bytes, b: WordBatch, base: int, spans: Iterable[tuple[int, int]]) -> str:
    """The text without the spans (ordered, apart); its words are those of ``b`` from ``base``."""
    keep, at = [], 0
    for x, y in spans:
        keep.append(raw[at:b.starts[base + x]])
        at = int(b.ends[base + y - 1])
    return b"".join([*keep, raw[at:]]).decode("utf-8")


def joined(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that meet or overlap as one, ordered."""
    out: list[tuple[int, int]] = []
    for x, y in sorted(spans):
        if out and x <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], y))
        else:
            out.append((x, y))
    return out


def automata(benchmark: DataFrame, window: int) -> list:
    """Broadcast automata of bounded blocks of items."""
    sc = benchmark.sparkSession.sparkContext
    items = only(benchmark, item_id=F.col("item_id").cast("string"), text="text")
    words = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + words // (6 * BLOCK_WORDS)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    out = []
    for k in range(n):
        rows = items.filter(block == k).distinct().collect()          # about BLOCK_WORDS words
        seqs = [(r["item_id"], normalized(r["text"]).split()) for r in sorted(rows, key=str)]
        out.append(sc.broadcast(Automaton([s for s in seqs if s[1]], window).packed()))
    return out


def _searched(rows: DataFrame, auto) -> DataFrame:
    """Spans and marks of one block's automaton for each row of (doc_id, text, h, g)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = Automaton.load(auto.value)
        for b in batches:
            texts = [normalized(t) for t in b.column(1).to_pylist()]
            n, starts, ends, marks = [], [], [], []
            for x, y in groups_by_size(texts):
                for words, s, e, m, _, _ in a.match(texts[x:y]):
                    n.append(words)
                    starts.append(s)
                    ends.append(e)
                    marks.append(m)
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), pa.array(n, pa.int64()), pa.array(starts, ints),
                 pa.array(ends, ints), pa.array(marks, ints)],
                ["doc_id", "h", "g", "n_words", "starts", "ends", "marks"])
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, h long, g long, n_words long, {_SPANS}")


def _named(marks: DataFrame, auto) -> DataFrame:
    """(marks, items): the items behind each different list of marks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = Automaton.load(auto.value)
        for b in batches:
            found = [[a.items[i] for i in a.holders(tuple(m)) if a.items[i] is not None] for m in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.string()))], ["marks", "items"])
    return marks.mapInArrow(run, "marks array<int>, items array<string>")


def found(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the automata find, each thing once.

    ``docs``: (doc_id, h, g, n_words), a row per document; ``texts``: (h, g, starts, ends, sets), a row per
    different text that is hit, with the merged spans of every block; ``items``: (sets, items), a row per
    different list of item sets.  (h, g) are two 64-bit hashes of the text.
    """
    rows = only(docs, doc_id="doc_id", text="text", h=F.xxhash64("text"), g=F.xxhash64(F.lit(1), "text"))
    every, texts, sets = None, [], []
    for k, auto in enumerate(automata(benchmark, window)):
        part = _searched(rows, auto)
        if k:                                       # the first block says how many words there are
            part = part.filter(F.size("starts") > 0)
        part = materialize(part, "decontaminate-found", ARROW_ROWS)
        every = part.select("doc_id", "h", "g", "n_words") if every is None else every
        hit = part.filter(F.size("starts") > 0)
        name = F.sha1(F.concat_ws(",", F.lit(str(k)), F.col("marks").cast("array<string>")).cast("binary")).alias("set")
        texts.append(hit.select("h", "g", "starts", "ends", name).dropDuplicates(["h", "g"]))
        names = materialize(_named(hit.select("marks").distinct(), auto), "decontaminate-items", ARROW_ROWS)
        sets.append(names.select(name, "items"))
    # at most one row per block in each of these groups
    text = (reduce(DataFrame.unionByName, texts).groupBy("h", "g")
            .agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"),
                 F.array_sort(F.collect_list("set")).alias("sets")))
    text = materialize(text, "decontaminate-texts")
    item = (text.select("sets").distinct().withColumn("set", F.explode("sets"))
            .join(reduce(DataFrame.unionByName, sets), "set").groupBy("sets")
            .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    return every, text, materialize(item, "decontaminate-sets")


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """(doc_id, n_words, starts, ends, items): hit spans in words, merged within a block of items,
    and the items they come from."""
    every, text, item = found(docs, benchmark, window)
    m = every.join(text.join(item, "sets"), ["h", "g"], "left")
    none, no_item = F.array().cast("array<int>"), F.array().cast("array<string>")
    return m.select("doc_id", "n_words", F.coalesce("starts", none).alias("starts"), F.coalesce("ends", none).alias("ends"),
                    F.coalesce("items", no_item).alias("items"))


def hit_words(starts: Column, ends: Column) -> Column:
    """Words inside any of the spans."""
    spans = F.array_sort(F.arrays_zip(starts.alias("s"), ends.alias("e")))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("at"))
    return F.aggregate(spans, zero, lambda acc, x: F.struct(
        (acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["at"]))).alias("n"),
        F.greatest(acc["at"], x["e"]).alias("at")), lambda acc: acc["n"].cast("long"))


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Words, hit words, and number and digest of the items of each document."""
    every, text, item = found(docs, benchmark, window)
    digest = F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256)
    text = text.join(item.select("sets", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256")), "sets")
    text = text.select("h", "g", hit_words(F.col("starts"), F.col("ends")).alias("n_hit"), "n_items", "items_sha256")
    m = every.join(text, ["h", "g"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return m.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                    F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
                    (n_hit > 0).alias("contaminated"))


def _hit_texts(texts: DataFrame, autos: list) -> DataFrame:
    """(h, g, text, starts, ends): the different texts that any block hits, with the spans of all blocks;
    one automaton in a task at a time."""
    def find(auto, k):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            a = Automaton.load(auto.value)
            for b in batches:
                norm = [normalized(t) for t in b.column(2).to_pylist()]
                at, starts, ends = [], [], []
                for x, y in groups_by_size(norm):
                    for i, (_, s, e, *_rest) in enumerate(a.match(norm[x:y]), x):
                        if len(s):
                            at.append(i)
                            starts.append(s)
                            ends.append(e)
                hit = b.take(pa.array(at, pa.int64()))
                ints = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*hit.columns, pa.array([k] * len(at), pa.int32()), pa.array(starts, ints), pa.array(ends, ints)],
                    ["h", "g", "text", "block", "starts", "ends"])
        return run

    schema = "h long, g long, text string, block int, starts array<int>, ends array<int>"
    parts = [materialize(texts.mapInArrow(find(auto, k), schema), "decontaminate-hits", ARROW_ROWS)
             for k, auto in enumerate(autos)]
    # copies of a text become one row; then at most one row per block in a group
    once = reduce(DataFrame.unionByName, parts).dropDuplicates(["block", "h", "g"])
    return once.groupBy("h", "g").agg(F.first("text").alias("text"), F.flatten(F.collect_list("starts")).alias("starts"),
                                      F.flatten(F.collect_list("ends")).alias("ends"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        col = [without(t.encode("utf-8"), WordBatch([normalized(t)]), 0, joined(zip(s, e)))
               for t, s, e in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(col, pa.string())], ["h", "g", "text"])


def cut_texts(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame | None:
    """(h, g, text): what is left of each different text that is hit, by the hashes of the whole text;
    None where no text is.  The spans of all blocks are cut together, and texts that were cut go through
    all blocks again, until none is hit."""
    autos = automata(benchmark, window)
    texts = only(docs, h=F.xxhash64("text"), g=F.xxhash64(F.lit(1), "text"), text="text")
    rounds: list[DataFrame] = []
    while True:
        cut = materialize(_hit_texts(texts, autos).mapInArrow(_cut, "h long, g long, text string"),
                          "decontaminate-cut", ARROW_ROWS)
        if cut.isEmpty():
            break
        rounds.append(cut)
        texts = cut
    if not rounds:
        return None
    # a round holds the texts that the one before it left with a hit
    last = [r.join(after.select("h", "g"), ["h", "g"], "left_anti") for r, after in zip(rounds, rounds[1:])]
    return reduce(DataFrame.unionByName, [*last, rounds[-1]])


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` with the hit spans cut out of ``text``; every row and every other column stays
    (``n_chars``, where there is one, follows the text).

    Only the different texts that are hit are written and cut; rows get theirs by a join on two 64-bit
    hashes, which the planner broadcasts or shuffles by the written size.
    """
    cut = cut_texts(docs, benchmark, window)
    rows = wrapped(docs, text="text", h=F.xxhash64("text"), g=F.xxhash64(F.lit(1), "text"))
    if cut is not None:
        rows = rows.join(cut.withColumnRenamed("text", "cut"), ["h", "g"], "left").withColumn("text", F.coalesce("cut", "text"))
    return unwrapped(rows, docs, "text")
