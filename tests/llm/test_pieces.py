"""Task-side helpers against plain Python, without Spark."""
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortkit.llm.words import mix  # noqa: E402
from cohortkit.llm import decontaminate, embedding_dedup, line_dedup, packing, sharding, simhash, streamvbyte, warc, words
from cohortkit.llm.encoding import Encoder

ODD = ["", " ", "a", "a  b", "a \n b\n\nc", "\n\nx", "don't. stop's", "<|endoftext|> a", "a\xa0 b", "É.È x\ty", "a.\nB",
       "á.b", "THE!!", "  lead", "x \n", "é!'s", "\nWord", "1.5,6", "İstanbul ẞ ﬁ", "\x00a\x1cb", "a b", "..a..b",
       "a\r\nb", "we've done. It'll", "日本 語。", "x" * 5000, " " * 300, "a\n" * 50]


@pytest.fixture(scope="module", params=["word_bpe_49k.json", "byte_bpe_50k.json"])
def enc(request):
    return Encoder(public_tokenizers.path(request.param))


def whole(enc, texts):
    return [e.ids for e in enc.full.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_encoder_equals_library_on_odd_texts(enc):
    assert enc.kind in ("drop", "lead")
    assert [i.tolist() for i in enc.encode([*ODD, None])] == whole(enc, [*ODD, None])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abAÉé .,'!\n\t\xa0 ́s1t<|>?"), max_size=30), max_size=5))
def test_encoder_equals_library(texts):
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        e = ENCODERS.setdefault(name, Encoder(public_tokenizers.path(name)))
        assert [i.tolist() for i in e.encode(texts)] == whole(e, texts)


ENCODERS: dict = {}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50))
def test_streamvbyte_round_trip(values):
    v = np.array(values, np.uint32)
    control, data = streamvbyte.encode(v)
    assert len(control) == -(-len(v) // 4)
    assert streamvbyte.decode(control, data, len(v)).tolist() == values


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB9é -_\x00|", max_size=40), max_size=6))
def test_words(texts):
    b = words.WordBatch([words.normalized(t) for t in texts])
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in texts]
    expect = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t) for t in low]
    got = [[b.word(k).decode() for k in range(b.first[i], b.first[i + 1])] for i in range(len(texts))]
    assert got == expect
    flat = [w for d in expect for w in d]
    assert len(set(zip(flat, b.keys.tolist()))) == len(set(flat)) == len(set(b.keys.tolist()))


def test_word_keys_of_long_words():
    t = [b"x" * n for n in (7, 8, 9, 16, 17, 511, 512, 513, 2000)]
    k = words.WordBatch(t).keys
    assert len(set(k.tolist())) == len(t)
    assert words.WordBatch([b" ".join(t)]).keys.tolist() == k.tolist()


def test_fingerprint_of_repeats_and_short_texts():
    assert simhash.fingerprint(simhash.shingle_hashes(None, 3)) == 0
    one = simhash.shingle_hashes("A b", 3)
    assert len(one) == 1 and simhash.fingerprint(one) == one[0]
    assert simhash.shingle_hashes("x x x x x", 3)[0] == simhash.shingle_hashes("X x x", 3)[0]
    assert len(simhash.shingle_hashes("x x x x x", 3)) == 3


def test_smallest_capacity_against_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        sizes = [rng.choice([1, 2, 5, 30]) for _ in range(rng.randint(1, 9))]
        n = rng.randint(1, 5)
        def best(at, k):
            if k == 1:
                return sum(sizes[at:])
            return min(max(sum(sizes[at:c]), best(c, k - 1)) for c in range(at, len(sizes) + 1))
        cap = sharding.smallest_capacity(np.array(sizes), n)
        assert cap == best(0, n)
        prefix = np.concatenate([[0], np.cumsum(sizes)])
        cuts = [0, *sharding.even_cuts(prefix, cap, n)]
        assert cuts[-1] == len(sizes) and len(cuts) == n + 1
        assert all(0 <= prefix[b] - prefix[a] <= cap for a, b in zip(cuts, cuts[1:]))


def test_plan_uses_every_piece_once_and_stays_near_the_bound():
    rng = np.random.default_rng(5)
    for sizes in (rng.integers(1, 1025, 4000), rng.integers(340, 520, 300), np.full(7, 1024), rng.integers(1, 60, 999),
                  np.array([600] * 5 + [424] * 5)):
        counts = dict(zip(*(x.tolist() for x in np.unique(sizes, return_counts=True))))
        plan = packing.plan(counts, 1024)
        used = {}
        for lengths, times in plan:
            assert sum(lengths) <= 1024 and times > 0
            for s in lengths:
                used[s] = used.get(s, 0) + times
        assert used == counts
        free, bfd = {}, 0                                    # best-fit decreasing for comparison
        for s in sorted(sizes.tolist(), reverse=True):
            room = next((r for r in range(s, 1025) if free.get(r)), None)
            if room is None:
                bfd, room = bfd + 1, 1024
            else:
                free[room] -= 1
            free[room - s] = free.get(room - s, 0) + 1
        assert sum(t for _, t in plan) <= bfd


def test_cut():
    assert packing.cut(1024, 1024) == [(0, 1024)]
    assert packing.cut(1025, 1024) == [(0, 1), (1, 1024)]
    assert packing.cut(1, 1024) == [(0, 1)]
    assert [n for _, n in packing.cut(5000, 1024)] == [904, 1024, 1024, 1024, 1024]


def brute_windows(items, doc, window):
    hit, found = [False] * len(doc), set()
    for name, seq in items:
        n = min(window, len(seq))
        for k in range(len(seq) - n + 1) if n else ():
            for i in range(len(doc) - n + 1):
                if doc[i:i + n] == seq[k:k + n]:
                    hit[i:i + n] = [True] * n
                    found.add(name)
    return hit, found


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9), max_size=5),
       st.lists(st.lists(st.sampled_from("abcd"), max_size=20), max_size=4), st.integers(1, 5))
def test_automaton_against_brute_force(seqs, docs, window):
    items = [(str(i), [w.encode() for w in s]) for i, s in enumerate(seqs) if s]
    a = decontaminate.Automaton(items, window)
    got = a.match([" ".join(d).encode() for d in docs])
    for d, (n, starts, ends, marks, _, _) in zip(docs, got):
        hit, names = brute_windows([(i, s) for i, s in items], [w.encode() for w in d], window)
        mine = [False] * n
        for s, e in zip(starts, ends):
            mine[s:e] = [True] * (e - s)
        assert mine == hit and {a.items[i] for i in a.holders(marks)} == names


def test_cut_removes_what_only_removal_joins(spark):
    items = spark.createDataFrame([("1", "a b c")], "item_id string, text string")
    texts = ["x A, b c. y", "a b a b c c z", "x y", None, "x A, b c. y"]
    docs = spark.createDataFrame([(i, t, -1) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in decontaminate.decontaminated(docs, items, 3).collect()}
    assert got == {0: ("x . y", 5), 1: (" z", 2), 2: ("x y", 3), 3: (None, None), 4: ("x . y", 5)}
    assert decontaminate.cut_texts(docs.filter("doc_id between 2 and 3"), items, 3) is None


def test_loser_tree():
    rng = random.Random(1)
    for k in range(0, 9):
        runs = [sorted((rng.randint(0, 9),) for _ in range(rng.randint(0, 12))) for _ in range(k)]
        merged = [runs[r][p] for r, p in warc.LoserTree(runs)]
        assert merged == sorted(x for r in runs for x in r)


def test_stretches_are_merged_in_order(monkeypatch):
    monkeypatch.setattr(warc, "AHEAD", 3)
    rng = random.Random(4)
    for n in [0, 1, 2, 40, 300]:
        rows = [(f"k{rng.randint(0, 3)}", f"t{rng.randint(0, 2)}", rng.choice([None, 1, 2, -5]), f"r{rng.randint(0, 4)}", p)
                for p in range(n)]

        def place(r):
            return r[0], r[1], r[2] is not None, r[2] or 0, r[3], r[4]
        # sorted pieces of all lengths, some of one run
        cuts = sorted(rng.randint(0, n) for _ in range(6))
        pieces = [sorted(rows[a:b], key=place) for a, b in zip([0, *cuts], [*cuts, n])]
        names = ("url_key", "ts", "page_id", "run", "position")
        kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
        batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*piece), kinds)], names)
                   for piece in pieces if piece]
        got = [tuple(r.values()) for b in warc._merge(iter(batches)) for r in b.to_pylist()]
        assert got == sorted(rows, key=place)


def test_url_key():
    assert warc.url_key("http://www.A.Example.org:80/x?y=1#z") == "org,example,a)/x?y=1"
    assert warc.url_key("https://a.example.org") == "org,example,a)/"
    assert warc.url_key("") == ")/"


def test_band_recall_at_the_threshold():
    rng = random.Random(7)
    hits = total = 0
    while total < 300:
        base = [rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(rng.randint(80, 600))]
        other = list(base)
        for _ in range(rng.randint(1, 8)):
            other[rng.randrange(len(other))] = rng.choice("0123456789")
        x, y = "".join(base).strip(), "".join(other).strip()
        if not 0.8 <= line_dedup.jaccard(line_dedup.shingles(x), line_dedup.shingles(y)) < 0.86:
            continue
        total += 1
        a, b = line_dedup.band_keys([x, y])
        hits += bool((a == b).any())
    assert hits / total >= 0.98


def test_band_keys_do_not_depend_on_neighbours():
    lines = ["ab", "abcdefgh", "abcdefghi", "é" * 20, "x" * 3000]
    together = line_dedup.band_keys(lines)
    assert all((together[i] == line_dedup.band_keys([x])[0]).all() for i, x in enumerate(lines))


def test_cross_polytope_recall():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.9 * x + np.sqrt(1 - 0.81) * z
    a, b = (embedding_dedup.buckets(embedding_dedup.unit(v)) for v in (x, y))
    met = (a[:, :, :, None] == b[:, :, None, :]).any(axis=(1, 2, 3))
    assert met.mean() >= 0.98


def test_hadamard_keeps_lengths_and_is_its_own_inverse():
    v = np.random.default_rng(0).normal(size=(3, 16))
    h = embedding_dedup.hadamard(v)
    assert np.allclose((h * h).sum(axis=1), 16 * (v * v).sum(axis=1))
    assert np.allclose(embedding_dedup.hadamard(h) / 16, v)


def test_crc_of_split_ids_is_that_of_the_bytes():
    ids = np.array([1, 70000, 3], "<u4")
    assert zlib.crc32(ids.tobytes()) == zlib.crc32(b"\x01\0\0\0\x70\x11\x01\0\x03\0\0\0")


def test_line_links_grow_with_the_lines(spark, monkeypatch):
    """Near copies 0.5 to 0.95 alike: rows that move grow linearly, and every line pair of 0.8 is connected."""
    import random
    from itertools import combinations
    base = " ".join(random.Random(1).choice(["alpha", "beta", "gamma", "delta", "river", "stone", "cloud"]) + str(i) for i in range(60))

    def copies(n):
        rnd = random.Random(n)
        out = set()
        while len(out) < n:
            x = list(base)
            for _ in range(rnd.choice([0, 1, 2, 4, 8])):
                x[rnd.randrange(len(x))] = rnd.choice("qxz")
            out.add("".join(x))
        return sorted(out)

    made = []
    real = line_dedup.components
    monkeypatch.setattr(line_dedup, "components", lambda e, name: made.append(e.count()) or real(e, name))
    for n, block in ((100, 40), (200, 512)):
        monkeypatch.setattr(line_dedup, "BLOCK_LINES", block)
        lines = copies(n)
        docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
        keys = line_dedup.band_keys(lines)
        own = spark.createDataFrame([(line_dedup.line_id(x), k.tolist()) for x, k in zip(lines, keys)], "id long, bands array<long>")
        root = {r["node"]: r["root"] for r in line_dedup.line_components(own, docs).collect()}
        sets = {x: line_dedup.shingles(x) for x in lines}
        up = {x: x for x in lines}

        def top(x):
            while up[x] != x:
                x = up[x]
            return x

        for (i, x), (j, y) in combinations(enumerate(lines), 2):
            if (keys[i] == keys[j]).any() and line_dedup.jaccard(sets[x], sets[y]) >= 0.8:
                up[top(x)] = top(y)
        groups = {}
        for x in lines:
            groups.setdefault(top(x), set()).add(line_dedup.line_id(x))
        assert {frozenset(g) for g in groups.values() if len(g) > 1} == \
            {frozenset(k for k, v in root.items() if v == r) for r in set(root.values())}
    assert made[1] < line_dedup.BANDS * 200               # at most a forest for each band


def test_common_shingles_are_exact():
    lines = ["abcdefghij", "abcdefghij klm", "short", "short", "xbcdefghij", "é" * 30]
    size, both = line_dedup._common(lines)
    sets = [line_dedup.shingles(x) for x in lines]
    assert size.tolist() == [len(x) for x in sets]
    assert all(both[i, j] == len(sets[i] & sets[j]) for i in range(6) for j in range(6) if i != j)


def test_notices_on_random_words(spark):
    """Notices need different grams in the template's order: repeated or turned grams are no notice."""
    from itertools import combinations
    from cohortkit.llm import license_scan
    rnd = random.Random(5)
    notices = {"all rights reserved": "arr", "one two three four five six": "num"}
    vocabulary = ["all", "rights", "reserved", "one", "two", "three", "four", "five", "six", "x"]
    texts = ["all rights all rights", "rights reserved rights reserved", "rights reserved x all rights", "all rights reserved",
             "one two three x four five six", "four five six one two three", "one two three four five", "all rights x rights reserved"]
    texts += [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(2, 9))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, spans = license_scan.scan(docs, {}, notices)
    got = {}
    for r in rows.join(spans, "row").select("doc_id", "label", "coverage").collect():
        got[r["doc_id"], r["label"]] = max(got.get((r["doc_id"], r["label"]), 0), r["coverage"])
    for d in range(4):
        assert ((d, "arr") in got) == (d == 3)
    # one word put in, turned halves, one word left out, a span too long for its template
    assert got[4, "num"] == 0.8 and (5, "num") not in got and got[6, "num"] == 0.8 and (7, "arr") not in got
    for (d, label), c in got.items():
        t = next(p for p, lb in notices.items() if lb == label).split()
        w, need = texts[d].split(), round(c * (len(t) - 1))
        hits = [(i, j) for i in range(len(w) - 1) for j in range(len(t) - 1) if w[i:i + 2] == t[j:j + 2]]
        assert any(all(a[0] < b[0] and a[1] < b[1] for a, b in zip(s, s[1:])) for s in combinations(sorted(hits), need)), texts[d]


def test_features_by_hand():
    from cohortkit.llm import quality
    rnd = np.random.default_rng(1)
    vectors = rnd.normal(size=(quality.BUCKETS, quality.DIM)).astype(np.float32)
    texts = [b"", b"one", b"one two", b"a b c, d 12 e!", b" ".join(b"w%d" % (i % 50) for i in range(5000))]
    got = quality.features(texts, vectors)
    for t, row in zip(texts, got):
        v = vectors[quality.tokens([t])[0]].astype(float)
        for d in range(3):
            own = v if d == 0 else v[:-d] * v[d:]
            want = own.sum(axis=0) / max(len(v) - d, 1) if len(own) else np.zeros(quality.DIM)
            assert np.allclose(row[d * quality.DIM:(d + 1) * quality.DIM], want, atol=1e-4)


def test_long_sides_of_line_joins_are_not_sorted(spark, monkeypatch):
    """Texts meet the needed lines, and lines their shared buckets, without a sort of the long side."""
    plans, plain = {}, line_dedup.materialize

    def noted(df, name, rows=None):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, name, rows)

    monkeypatch.setattr(line_dedup, "materialize", noted)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        line = "a line that comes back with %d small changes in its middle, nearly the same"
        docs = spark.createDataFrame([(i, line % i + f"\nown text number {i * i * 7919}") for i in range(20)], "doc_id long, text string")
        got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.line_report(docs).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert got[0] == 0 and sum(got.values()) > 10
    assert "SortMergeJoin" not in plans["lines-needed"] + plans["lines-texts"]


def test_shingle_hashes_are_the_polynomial():
    lines = ["short", "x", "a line of more than eight characters", "é" * 20]
    for _, _, h, first in line_dedup.shingle_hashes(lines):
        want = []
        for x in lines:
            c = [ord(y) for y in x] + [0] * max(0, line_dedup.SHINGLE - len(x))
            for i in range(len(c) - line_dedup.SHINGLE + 1):
                v = 0
                for y in c[i:i + line_dedup.SHINGLE]:
                    v = (v * int(line_dedup._P) + y) % 2 ** 64
                want.append(v * 0x9E3779B97F4A7C15 % 2 ** 64)
        assert h.tolist() == mix(np.array(want, np.uint64)).tolist()


def test_shingle_codes_are_the_shingles():
    from itertools import combinations
    rnd = random.Random(3)
    latin = ["".join(rnd.choice("ab\0é ") for _ in range(rnd.randint(1, 60))) for _ in range(20)]
    near = ["a line that is nearly the same as another one, up to its end %d" % i for i in range(4)]
    greek = [x.replace("a", "α") for x in near] + near
    many = ["".join(map(chr, range(0x4E00 + k, 0x4E00 + k + 300))) + "tail" for k in (0, 1, 200)]
    linked = 0
    for lines in (latin, near, greek, many, ["short", "abcdefgh", "abcdefgh" * 3], ["x"]):
        sets = [line_dedup.shingles(x) if len(x) >= line_dedup.SHINGLE else set() for x in lines]
        codes = line_dedup.shingle_codes(lines)
        assert [len(x) for x in codes] == [len(x) for x in sets]
        for i, j in combinations(range(len(lines)), 2):
            assert len(np.intersect1d(codes[i], codes[j])) == len(sets[i] & sets[j])
            want = bool(sets[i] and sets[j]) and line_dedup.jaccard(sets[i], sets[j]) >= 0.8
            assert line_dedup.alike(codes[i], codes[j], 0.8) == want
            linked += want
    assert linked > 10


def test_two_lines_are_placed_in_one_bucket(spark, monkeypatch):
    """Two near copies share most of their buckets; their texts are sent to one of these only."""
    placed, plain = [], line_dedup.materialize

    def noted(df, name, rows=None):
        out = plain(df, name, rows)
        if name == "lines-places":
            placed.append(out.count())
            assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()
        return out

    monkeypatch.setattr(line_dedup, "materialize", noted)
    line = "two lines that differ by their last letter alone and so meet in nearly all buckets of their bands "
    keys = line_dedup.band_keys([line + "a", line + "b"])
    assert (keys[0] == keys[1]).sum() > 1
    docs = spark.createDataFrame([(1, line + "a\nother"), (2, line + "b"), (3, line + "b")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.line_report(docs).collect()}
    assert got == {1: 0, 2: 1, 3: 1} and placed == [2]


def test_text_is_shuffled_once(spark):
    docs = spark.createDataFrame([(1, "a\nb\n\na\n"), (2, None), (3, ""), (4, "b"), (5, "\n"), (None, "a\r\nb")], "doc_id long, text string")
    rows = line_dedup.without_repeated_lines(docs.withColumn("lang", F.lit("x")))
    assert rows.schema["_row"].dataType.names == ["doc_id", "lang"]
    assert "MapInArrow" not in rows._jdf.queryExecution().optimizedPlan().toString()
    got = {r["doc_id"]: tuple(r)[1:] for r in line_dedup.line_report(docs).select("doc_id", "text", "n_lines", "n_dropped").collect()}
    assert got == {1: ("a\nb\n\n", 5, 1), 2: (None, 1, 0), 3: ("", 1, 0), 4: ("", 1, 1), 5: ("\n", 2, 0), None: ("", 2, 2)}
