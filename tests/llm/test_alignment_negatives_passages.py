"""Token alignment, hard negatives and substring dedup against brute force, on the given tables and odd inputs."""
import hashlib
import os
import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle import compare, duck  # noqa: E402

from cohortkit.llm import encoding, hard_negatives, queries, substring_dedup, token_alignment  # noqa: E402

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(f"wort{i % 997}" for i in range(30_000))
ODD = [None, "", " ", "  two", "trailing ", "a\n\nb\t c", "<|endoftext|> and </s> <s>", "under ▁ line", "é" * 40, "x\x00y",
       "日本語のテキスト 漢字", "🙂🙂 ok", "One. Two!", "One. Two!", LONG, "a" * 5000, "tab\tand\xa0nbsp", "\r\nx", "<0x0A>"]
SCHEMA = "doc_id long, text string, n_words int, t string, pair long, _row int, chunk long"


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x", 2, 3, 4) for d, t in rows], SCHEMA).repartition(3)


# -- token alignment --------------------------------------------------------------

def brute_alignment(rows):
    ta, tb = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    ta.encode_special_tokens = True
    value = {c: b for b, c in enumerate(encoding.byte_letters())}
    links, count, best = [], Counter(), Counter()
    for d, t in rows:
        one = [(i, bytes(value[c] for c in ta.id_to_token(i))) for i in ta.encode(" " + (t or ""), add_special_tokens=False).ids]
        two = []
        for i in tb.encode(t or ""):
            p = tb.id_to_piece(i)
            two.append((i, bytes([int(p[3:5], 16)]) if tb.is_byte(i) else p.replace("▁", " ").encode()))
        want = (" " + (t or "")).encode()
        if not t or b"".join(x for _, x in one) != want or b"".join(x for _, x in two) != want:
            links.append((d, [], [], [], ""))
            continue
        ends = [dict(), dict()]
        for s, side in enumerate((one, two)):
            at = 0
            for k, (i, x) in enumerate(side):
                at += len(x)
                ends[s][at] = k
        both = sorted(set(ends[0]) & set(ends[1]))
        own = [(one[ends[0][e]][0], two[ends[1][e]][0]) for e in both]
        groups, x, y = [], 0, 0
        for e in both:
            groups.append(",".join(str(i) for i, _ in one[x:ends[0][e] + 1]) + "|" + ",".join(str(i) for i, _ in two[y:ends[1][e] + 1]))
            x, y = ends[0][e] + 1, ends[1][e] + 1
        links.append((d, one, two, own, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        count.update(own)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(d, len(one), len(two), len(own), len(own), sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own), h)
            for d, one, two, own, h in links], count


COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_of_odd_texts(spark):
    rows = list(enumerate(ODD)) + [(None, "no id"), (3, "  two"), (3, "  two")]
    got, counts = token_alignment.aligned(docs_of(spark, rows), A, B)
    want, pairs = brute_alignment(rows)
    assert got.columns == COLS
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    held = {(r["a"], r["b"]): (r["links"], r["docs"], r["best"]) for r in counts.collect()}
    assert {p: h[0] for p, h in held.items()} == dict(pairs)
    assert got.filter("n_a = 0").count() == 3                                # null, empty, U+2581
    empty, none = token_alignment.aligned(docs_of(spark, []), A, B)
    assert empty.count() == 0 and none.count() == 0


def test_alignment_of_the_table_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "CHUNK_LINKS", 300)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op11_token_alignment(spark, SF).select(COLS).collect()]
    assert sorted(got) == sorted(brute_alignment(rows)[0])


def test_planes():
    rng = np.random.default_rng(1)
    for n, top in ((1, 1), (5, 60000), (3000, 60000), (40000, 60000), (60, 64)):
        docs = np.sort(rng.choice(top, min(n, top), replace=False))
        blob = token_alignment.packed_plane(docs)
        assert token_alignment.plane_docs(blob).tolist() == docs.tolist() and token_alignment.popcount(blob) == len(docs)
    a, b = token_alignment.packed_plane(np.array([1, 5])), token_alignment.packed_plane(np.array([5, 900]))
    assert token_alignment.plane_docs(token_alignment.united([a, b])).tolist() == [1, 5, 900]
    got = list(token_alignment.postings(np.array([0, 0, 0, 2, 7]), np.array([9, 9, 9, 9, 4])))
    assert [(p, d, [token_alignment.plane_docs(x).tolist() for x in b]) for p, d, b in got] == \
        [(4, [0], [[7]]), (9, [0, 1], [[0, 2], [0]])]


def test_key_conflicts_are_encoded_whole(monkeypatch):
    texts = ["some words here", "other words there, and more", "<|endoftext|>", None, "x" * 2000 + " " + "y" * 2000]
    want = [encoding.Encoder(A).full.encode(t or "", add_special_tokens=False).ids for t in texts]
    for key in (lambda d, s, e, loads=None: np.zeros(len(s), np.uint64), lambda d, s, e, loads=None: (e - s).astype(np.uint64)):
        monkeypatch.setattr(encoding, "keys", key)
        assert [x.tolist() for x in encoding.Encoder(A).encode(texts)] == want
    data = b"abcdefghijklmnop|abcdefghXjklmnop|abcdefghijklmnop"
    starts, ends = np.array([0, 17, 34]), np.array([16, 33, 50])
    loads = encoding.eight(data)
    assert encoding._same_pieces(data, loads, starts, ends, np.array([0, 1, 0]))
    assert not encoding._same_pieces(data, loads, starts, ends, np.array([0, 0, 0]))


def test_key_conflicts_with_earlier_batches(monkeypatch):
    """Pieces kept from one batch are compared byte by byte with those of the next, short, long and very long ones."""
    monkeypatch.setattr(encoding, "keys", lambda d, s, e, loads=None: (e - s).astype(np.uint64))
    for path in (A, public_tokenizers.path("word_bpe_49k.json")):
        enc = encoding.Encoder(path)
        for t in ("a word", "a ward", "a longerthaneight", "a langerthaneight", "q" * 700, "r" * 700, "a word", None):
            assert enc.encode([t])[0].tolist() == enc.full.encode(t or "", add_special_tokens=False).ids


def test_known_pieces_are_looked_up_together():
    """Calls made for a batch do not grow with its distinct pieces (one look-up in a dict each, before)."""
    calls = []
    for n in (50, 5000):
        enc, texts = encoding.Encoder(public_tokenizers.path("word_bpe_49k.json")), [" ".join(f"w{i} x{i * 7}" for i in range(n))]
        first = enc.encode(texts)[0].tolist()
        made = [0]

        def count(frame, event, arg):
            made[0] += event == "c_call"

        sys.setprofile(count)
        try:
            again = enc.encode(texts)[0].tolist()
        finally:
            sys.setprofile(None)
        assert first == again == enc.full.encode(texts[0], add_special_tokens=False).ids
        calls.append(made[0])
    assert calls[1] < calls[0] + 100


# -- hard negatives ---------------------------------------------------------------

VEC = "vec_id long, label int, embedding array<float>, name long, rank int, d string"


def brute_negatives(rows, every=100):
    sound = []
    for i, lab, e in rows:
        if i is None or lab is None or e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        v = [int(np.floor(256 * float(np.float32(x)))) for x in e]
        sound.append((i, (lab + 1) % 10 if i % 7 == 0 else lab, v))
    out = []
    for a, lab, v in sound:
        if a % every:
            continue
        s = sorted((-sum(x * y for x, y in zip(v, w)), i, other == lab) for i, other, w in sound if i != a and len(w) == len(v))
        for p, i, _ in [x for x in s if x[2]][:5]:
            band = [x for x in s if not x[2] and 80 * -p <= 100 * -x[0] <= 100 * -p][:5]
            out += [(a, i, r + 1, j, -p, -q) for r, (q, j, _) in enumerate(band)]
    return sorted(out)


def test_negatives_of_the_table(spark):
    con = duck(SF)
    n, problems = compare(spark, con, queries.op12_hard_negatives, queries.ORACLES["op12_hard_negatives"], SF)
    assert n > 0 and not problems


def test_negatives_of_odd_rows(spark, monkeypatch):
    rnd = random.Random(3)
    monkeypatch.setattr(hard_negatives, "ROWS", 16)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 2)
    rows = [(i, rnd.randrange(3), [rnd.choice([-1.0, 0.0, 0.25, 0.5, 1.0]) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, i % 3, [0.5] * 6) for i in range(20)]                          # ties
    rows += [rows[0], rows[5], rows[5], (None, 1, [1.0] * 6), (300, None, [1.0] * 6), (301, 1, None),
             (302, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (303, 1, [float("nan")] * 6), (304, 1, [float("inf")] * 6),
             (400, 1, []), (401, 1, []), (402, 2, []), (500, 0, [1.0, 2.0]), (501, 0, [1.0, 1.0]), (503, 1, [0.9, 1.0]),
             (600, 1, [0.0] * 6), (700, 2, [-1.0] * 6)]
    df = spark.createDataFrame([(*r, 5, 6, "x") for r in rows], VEC).repartition(4)
    got = hard_negatives.hard_negatives(df, every=10)
    assert sorted(tuple(r) for r in got.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()) == brute_negatives(rows, 10)
    assert hard_negatives.hard_negatives(df.limit(0)).count() == 0


def test_anchors_meet_the_blocks_by_shuffle(spark, monkeypatch):
    """The planner's sizes do not count how often anchors are sent: a broadcast would gather all of that on the driver."""
    rnd, steps, write = random.Random(4), [], hard_negatives.materialize
    monkeypatch.setattr(hard_negatives, "ROWS", 4)
    monkeypatch.setattr(hard_negatives, "materialize", lambda df, *a, **b: write(steps.append(df) or df, *a, **b))
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") not in ("-1", "0")
    rows = [(i, rnd.randrange(3), [rnd.uniform(-1, 1) for _ in range(6)], 5, 6, "x") for i in range(200)]
    steps.append(hard_negatives.hard_negatives(spark.createDataFrame(rows, VEC).repartition(4), every=10))
    assert steps[-1].count() > 0
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in steps]
    assert sum("SortMergeJoin" in x for x in plans) == 2 and not any("Broadcast" in x for x in plans)


@pytest.mark.parametrize("scale", [1, 1 << 12, 1 << 22])          # sums within 32-bit floats, 64-bit floats, integers
@pytest.mark.parametrize("many", [0, 2])
def test_negatives_in_strips_by_product_or_one_by_one(spark, monkeypatch, scale, many):
    rnd = random.Random(scale)
    for k, v in (("ROWS", 8), ("ANCHORS", 4), ("STRIP", 3), ("AT_ONCE", 20), ("_MANY", many)):
        monkeypatch.setattr(hard_negatives, k, v)
    rows = [(i, rnd.randrange(3), [rnd.choice([-1.0, 0.25, 0.5, 1.0]) * scale for _ in range(5)]) for i in range(60)]
    rows += [(70 + i, i % 2, [0.5 * scale] * 5) for i in range(12)] + rows[:3] + [(90, 1, [1.0] * 3), (91, 1, [1.0] * 3), (92, 2, [1.0] * 3)]
    df = spark.createDataFrame([(*r, 5, 6, "x") for r in rows], VEC).repartition(3)
    got = hard_negatives.hard_negatives(df, every=2)
    assert sorted(tuple(r) for r in got.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()) == brute_negatives(rows, 2)


def test_intervals_hold_every_score():
    rng = np.random.default_rng(5)
    for d in (1, 3, 64, 100):
        v, q = (np.floor(rng.normal(size=(n, d)) * 100).astype(np.int64) for n in (200, 20))
        v[:3], q[0] = 0, 7
        v[3:6] = q[1]
        turn = hard_negatives.rotation(d)
        low, high = hard_negatives.intervals(q @ turn, hard_negatives.Codes(v @ turn))
        exact = q @ v.T
        assert (low <= exact).all() and (exact <= high).all()


@pytest.mark.parametrize("size", [1, 1 << 20, 1 << 40, 1 << 58])
def test_intervals_hold_scores_of_any_size_and_along_a_code(size):
    rng = np.random.default_rng(6)
    for d in (2, 65, 1100):
        turn = hard_negatives.rotation(d)
        v, q = (np.floor(rng.normal(size=(n, d)) * size).astype(np.int64) for n in (100, 12))
        v[:3], q[0], v[3:6], v[6], v[7] = 0, 0, q[2], -q[3], q[4] * 2
        v[8:12] = q[5:8] = np.rint(np.sign(rng.normal(size=d)) @ turn.T * min(size, 1 << 40) * 10).astype(np.int64)
        low, high = hard_negatives.intervals(q @ turn, hard_negatives.Codes(v @ turn))
        exact = (q.astype(object) @ v.T.astype(object)).ravel().tolist()
        assert all(a <= x <= b for a, x, b in zip(low.ravel().tolist(), exact, high.ravel().tolist()))


def test_large_scores_stay_in_range():
    a = np.array([1 << 40, 1 << 40])
    assert hard_negatives.scores(a, np.array([[1 << 40, 1 << 40], [-(1 << 40), -(1 << 40)], [3, 4]])).tolist() == \
        [(1 << 63) - 1, -(1 << 63), 7 << 40]


# -- substring dedup --------------------------------------------------------------

def brute_passages(rows, window):
    own = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    least = defaultdict(lambda: float("inf"))
    for d, w in own:
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            least[g] = min(least[g], float("inf") if d is None else d)
    out = []
    for d, w in own:
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < (float("inf") if d is None else d):
                gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def passages(df, window):
    return sorted((tuple(r)[:4] for r in substring_dedup.passage_report(df, window).collect()), key=str)


@pytest.mark.parametrize("window", [1, 2, 5, 8])
def test_passages_of_random_texts(spark, window):
    rnd = random.Random(window)
    rows = [(rnd.randrange(25), " ".join(rnd.choice("ab") for _ in range(rnd.randrange(40)))) for _ in range(30)]
    rows += [(None, rows[0][1]), (None, "a b a b"), (40, None), (41, ""), (42, " \t"), rows[1], rows[1]]
    assert passages(docs_of(spark, rows), window) == brute_passages(rows, window)


def test_passages_of_odd_texts(spark):
    shared = " ".join(f"w{i}" for i in range(400))
    rows = [(9, f"x {shared} y"), (2, shared.replace(" ", "\n")), (5, f"{shared} {shared}"), (5, f"{shared} {shared}"),
            (7, LONG), (8, LONG + " end"), (3, shared[:150]), (11, "ä b " * 60), (12, "ä b " * 61), (None, LONG),
            *[(100 + i, f"copy {shared}") for i in range(30)]]
    df = docs_of(spark, rows)
    assert passages(df, 50) == brute_passages(rows, 50)
    longest = {r["doc_id"]: r["longest"] for r in substring_dedup.passage_report(df, 50).collect()}
    # from a picked place on, so at least a quarter of the longest common run
    assert longest[9] in (100, 200, 400) and longest[7] >= 50 << 7 and longest[3] == 0
    out = substring_dedup.passage_dedup(df, 50)
    assert out.columns == df.columns and out.count() == len(rows)
    assert passages(docs_of(spark, []), 50) == []


def test_passages_of_the_table(spark):
    n, problems = compare(spark, duck(SF), queries.op13_substring_dedup, queries.ORACLES["op13_substring_dedup"], SF)
    assert n > 0 and not problems


def test_windows_hold_a_picked_place():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 3, 500).astype(np.uint64)
    half = substring_dedup.window_keys(words, 25)
    at = np.flatnonzero(substring_dedup.picked(half, np.ones(451, bool), 25, 50))
    assert all(((at >= i) & (at <= i + 25)).any() for i in range(451))
    assert (substring_dedup.window_keys(words[10:], 25) == half[10:]).all()
