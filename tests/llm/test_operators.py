"""The ten operators and the pipeline on small tables: brute force, round trips and odd inputs."""
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cohortkit.llm import (components, decontaminate, embedding_dedup, license_scan, line_dedup, packing, quality,
                           queries, sharding, simhash, token_files, warc)
from cohortkit.session import scratch_path

SF = "/root/testdata/sf0.001"
WORD, BYTE = (public_tokenizers.path(p) for p in ("word_bpe_49k.json", "byte_bpe_50k.json"))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, `score` string, `_row` int, key long"
LONG = " ".join(f"wort{i % 997}" for i in range(30_000))
PASSAGE = "the quick brown fox jumps over the lazy dog and then it sleeps under a tree until the evening comes"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))


ROWS = [(d, t, "en", "s", len(t or ""), 5, "x", 1, 9) for d, t in [
    (1, None), (2, ""), (3, " \n\n "), (4, "One. Two!"), (5, LONG), (6, "Same line here\nother words"),
    (7, "same line here \nmore words"), (7, "same line here \nmore words"), (8, f"intro {PASSAGE.upper()} outro"),
    (9, "cc by CC-BY apache license"), (None, "no id at all"), (10, "é" * 40), (11, "One. Two!"), (12, "x\x00y")]]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, PASSAGE, 0), (2, "One, two", 0), (3, None, 0), (4, "", 0), (None, "é" * 40, 0),
                                  (1, PASSAGE, 0)], "item_id long, text string, n_words int")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(4)] + [(None, 1, 0), (7, None, 0)],
                                 "doc_id long, quality int, toxic int")


def rows_of(df, *key):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: str(r))


def texts_by_id():
    return {d: t for d, t, *_ in ROWS}


# -- op1 ----------------------------------------------------------------------

def test_token_files(spark, odd, none):
    path = scratch_path(spark, "t1")
    token_files.write_token_files(odd, path, WORD, 1)
    got = token_files.read_token_files(spark, path).collect()
    tok = Tokenizer.from_file(WORD)
    expect = {(d, t): np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for d, t, *_ in ROWS}
    by_start = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in by_start] == sorted((r[0] for r in ROWS), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in by_start:
        assert r["start"] == at
        at += r["n_tokens"]
    for (d, t), ids in expect.items():
        assert any(r["n_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids.tobytes()) for r in got if r["doc_id"] == d)
    ids = {r["doc_id"]: r["ids"] for r in token_files.read_ids(spark, path).collect()}
    assert all(ids[d] == expect[(d, t)].tolist() for d, t, *_ in ROWS)
    empty = scratch_path(spark, "t1")
    token_files.write_token_files(none, empty, WORD, 1)
    assert token_files.read_token_files(spark, empty).count() == 0


# -- op2 ----------------------------------------------------------------------

def brute_base(text):
    w, places, labels = words(text), [], set()
    for phrase, label in license_scan.BASE.items():
        p = phrase.split()
        for k in range(len(w) - len(p) + 1):
            if w[k:k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_base_places(spark, odd, none):
    for docs, texts in ((odd, [(d, t) for d, t, *_ in ROWS]),):
        got = sorted((str(r["doc_id"]), r["n_words"], r["n_base"], str(r["first_word"]), str(r["last_word"]), r["base_labels"])
                     for r in license_scan.license_report(docs).collect())
        want = sorted((str(d), n, k, str(a), str(z), ls) for d, t in texts for n, k, a, z, ls in [brute_base(t)])
        assert got == want
    assert license_scan.license_report(none).count() == 0


def test_license_base_on_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in license_scan.license_report(docs).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(texts[r["doc_id"]])


def test_license_notice_with_changes(spark):
    text = next(t for t, label in license_scan.NOTICES.items() if label == "mit-text")
    changed = text.replace("free of charge", "entirely free of any charge").replace("documentation", "")
    docs = spark.createDataFrame([(1, f"intro words {changed} more words"), (2, text[:30])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.license_report(docs).collect()}
    assert got[1]["labels"] == "mit-text" and license_scan.COVERAGE <= got[1]["score"] < 1
    assert got[2]["labels"] == "" and got[2]["score"] == 0


def test_license_notice_back_to_back(spark):
    text = "All rights reserved. All rights reserved."
    long = next(t for t, label in license_scan.NOTICES.items() if label == "apache-2.0")
    docs = spark.createDataFrame([(1, text), (2, f"{text} page 2 {text}"), (3, f"{long} {long}"), (4, "all rights")],
                                 "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan.license_report(docs).collect()}
    assert got[1] == got[2] == ("all-rights-reserved", 1.0) and got[4] == ("", 0.0)
    assert got[3][1] == 1.0 and "apache-2.0" in got[3][0].split(",")


# -- op3 ----------------------------------------------------------------------

def brute_lines(docs, similarity=0.8):
    occ = {}
    for d, t in docs:
        for n, line in line_dedup.units(t):
            occ.setdefault(line, []).append((d, n))
    lines = list(occ)
    sets = [line_dedup.shingles(x) for x in lines]
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(lines)):
        for j in range(i):
            if line_dedup.jaccard(sets[i], sets[j]) >= similarity:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i, x in enumerate(lines):
        groups.setdefault(find(i), []).extend(occ[x])
    gone = {o for g in groups.values() for o in g if o != min(g)}
    return {d: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) not in gone) for d, t in docs}


def test_line_dedup_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 1500")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(docs).collect()}
    assert got == brute_lines(texts)


def test_line_dedup_of_many_near_copies(spark):
    base = ("a sentence that is long enough to be hardly touched by one small change at the end of it, "
            "with some more words so that its shingles outnumber the change ")
    docs = spark.createDataFrame([(i, f"{base}{i:03d}\nown line {i} {hashlib.md5(str(i).encode()).hexdigest()}") for i in range(300)],
                                 "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(docs).collect()}
    assert got[0].count("\n") == 1 and all(t.startswith("own line") for d, t in got.items() if d)


def test_line_components_of_two_sizes_in_crowded_buckets(spark):
    # the hubs of every round but the last are long lines, whose size excludes the short ones
    long, short = ("".join(hashlib.md5(f"{k}{i}".encode()).hexdigest() for i in range(n)) for k, n in (("l", 8), ("s", 4)))
    longs = [f"{long}{i:04d}" for i in range(600)]
    top = max(line_dedup.line_id(x) for x in longs)
    shorts = [x for x in (f"{short}{i:04d}" for i in range(20_000)) if line_dedup.line_id(x) > top][:5]
    assert len(shorts) == 5
    lines = spark.createDataFrame([(line_dedup.line_id(x), [1, 2]) for x in longs + shorts],
                                  "id long, bands array<long>")
    docs = spark.createDataFrame([(1, "\n".join(longs + shorts))], "doc_id long, text string")
    root = {r["node"]: r["root"] for r in line_dedup.line_components(lines, docs).collect()}
    for group in (longs, shorts):
        assert {root.get(line_dedup.line_id(x)) for x in group} == {min(map(line_dedup.line_id, group))}


def test_line_dedup_odd(odd, none):
    out = {r["doc_id"]: r for r in line_dedup.line_dedup(odd).collect()}
    assert line_dedup.line_dedup(odd).columns == odd.columns and line_dedup.line_dedup(odd).count() == len(ROWS)
    assert out[1]["text"] is None and out[3]["text"] == " \n\n "
    assert out[6]["text"] == "Same line here\nother words" and out[7]["text"] == "more words"
    assert out[11]["text"] == "" and out[11]["n_chars"] == 0 and out[11]["h"] == 5
    assert line_dedup.line_dedup(none).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)]
    got = dict(components.components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- op4 ----------------------------------------------------------------------

def test_archives_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 40_000)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 20)
    monkeypatch.setattr(warc, "RANGE_ROWS", 7)
    size = [0, 10, 900, 3_000, 9_000, 17_000, 60_000]
    df = spark.createDataFrame([(i, f"http://h{i % 3}.org/{i % 5}", chr(97 + i % 26) + str(i) * (size[i % 7] // len(str(i))))
                                for i in range(140)], "page_id long, url string, html string")
    path = scratch_path(spark, "warc")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    index = warc.archive_pages(df, path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("length", "content").collect()
    for f in files:
        assert f["length"] <= 40_000 or len(list(warc.records(bytes(f["content"])))) == 1
    got = index.collect()
    assert [(r["url_key"], r["ts"], r["page_id"]) for r in got] == sorted((r["url_key"], r["ts"], r["page_id"]) for r in got)
    assert {r["page_id"]: r["payload_bytes"] for r in got} == {r["page_id"]: len(r["html"]) for r in df.collect()}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    with pytest.raises(Exception, match="(?i)exists"):
        warc.write_warc(df, path)


def test_warc_round_trip(spark):
    big = "<p>é\r\n\r\nWARC/1.0\r\n" + "x" * 1200
    pages = [(1, "http://a.org/x", big, 0), (2, "http://a.org/y", big, 0), (5, "http://A.org/x", big, 0), (3, None, None, 0),
             (4, "http://b.org/\r\nX: y", "tiny", 0), (6, "u", "tiny", 0), (None, "u", big, 0), (5, "http://A.org/x", big, 0)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, digest int")
    got = warc.archive_pages(df, scratch_path(spark, "warc")).collect()
    want = sorted((str(p), len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(),
                   "revisit" if h == big and p != 5 else "response", 5 if h == big and p != 5 else None) for p, _, h, _ in pages)
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                  for r in got) == want
    order = [(r["url_key"], r["ts"], r["page_id"] is not None, r["page_id"] or 0) for r in got]
    assert order == sorted(order)
    assert warc.archive_pages(df.limit(0), scratch_path(spark, "warc")).count() == 0


# -- op5 ----------------------------------------------------------------------

def brute_simhash(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    s = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_simhash_classes(spark, odd, none):
    got = queries.op5_simhash(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fp = {d: brute_simhash(t) for d, t in texts.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {d: f"{v:016x}" for d, v in fp.items()}
    low = {d: d for d in fp}
    change = True
    while change:
        change = False
        for a in fp:
            for b in fp:
                if low[b] < low[a] and (fp[a] ^ fp[b]).bit_count() <= 2:
                    low[a], change = low[b], True
    assert {r["doc_id"]: r["component_id"] for r in got} == low
    rows = simhash.near_duplicate_classes(odd).collect()
    assert len(rows) == len(ROWS) and {r["component_id"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    kept = simhash.near_dedup(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 4, 5, 6, 7, 8, 9, 10, None, 12]))
    assert simhash.near_dedup(none).count() == 0


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_fingerprint_links_keep_components(spark, distance):
    rng = np.random.default_rng(distance)
    seeds = rng.integers(0, 2**63, 6)
    fps = {int(s) ^ sum(1 << int(b) for b in rng.choice(62, k, replace=False)) for s in seeds for k in (0, 1, 1, 2, 3, 4)}
    links = simhash.fingerprint_links(spark.createDataFrame([(f,) for f in fps], "fp long"), distance)
    got = dict(components.components(links).collect())
    low = {f: f for f in fps}
    change = True
    while change:
        change = False
        for a in fps:
            for b in fps:
                if low[b] < low[a] and (a ^ b).bit_count() <= distance:
                    low[a], change = low[b], True
    assert {f: got.get(f, f) for f in fps} == low


# -- op6 ----------------------------------------------------------------------

def test_quality_learns_and_ignores_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = {r["doc_id"]: r for r in quality.quality_report(docs, labels).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in out.items())
    held = [(out[d]["score"], q) for d, q in truth.items() if out[d]["held_out"]]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality.quality_report(docs, flipped).collect()}
    assert all(abs(again[d] - r["score"]) < 1e-9 for d, r in out.items())


def test_quality_learns_from_few_rows():
    r = np.random.default_rng(1)
    for n in (2, 4, 9):
        y = np.arange(n) % 2.0
        side = np.where(np.arange(3 * quality.DIM) % 2, 1, -1) * 0.1
        def some(y):
            return np.outer(2 * y - 1, side) + r.normal(0, 0.02, (len(y), 3 * quality.DIM))
        net = quality.fit(some(y), y)
        new = np.arange(40) % 2.0
        score = net.score(some(new))
        assert score[new == 1].min() > 0.5 > score[new == 0].max(), n
    assert (quality.fit(np.zeros((4, 3 * quality.DIM)), np.array([0, 1, 1, 1.0])).score(some(new)) > 0.5).all()
    assert (quality.fit(some(np.ones(3)), np.ones(3)).score(some(new)) == 1).all()


def test_quality_odd(spark, odd, none, labels):
    out = quality.quality_report(odd, labels).collect()
    assert len(out) == len(ROWS) and all(0 <= r["score"] <= 1 for r in out)
    assert quality.quality_report(none, labels).count() == 0
    assert all(r["score"] == 0.5 for r in quality.quality_report(odd, labels.limit(0)).collect())
    assert quality.quality_filter(odd, labels).columns == odd.columns


# -- op7 ----------------------------------------------------------------------

def check_packing(got, texts, capacity, end_id):
    tok = Tokenizer.from_file(BYTE)
    seqs, per_doc = {}, {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        per_doc.setdefault(r["doc_id"], []).append(r)
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= capacity
    for d, t in texts.items():
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, end_id], "<u4")
        mine = sorted(per_doc[d], key=lambda r: r["piece"])
        assert [(r["start"], r["length"]) for r in mine] == packing.cut(len(ids), capacity)
        assert all(zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in mine)
    return len(seqs)


def test_packing(spark, odd, none):
    texts = texts_by_id()
    n = check_packing(packing.pack_documents(odd.dropDuplicates(["doc_id"]), BYTE).collect(), texts, 1024, 2)
    total = sum(len(Tokenizer.from_file(BYTE).encode(t or "", add_special_tokens=False).ids) + 1 for t in texts.values())
    assert n == -(-total // 1024)
    packed = packing.pack_documents(odd, BYTE, capacity=64, with_ids=True)
    ids = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    assert sum(map(len, ids.values())) == packed.agg(F.sum("length")).first()[0]
    assert packing.pack_documents(none, BYTE).count() == 0


# -- op8 ----------------------------------------------------------------------

def brute_vectors(rows, cosine):
    ids = [i for i, _ in rows]
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    link = {i: set() for i in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                    link[a].add(b)
                    link[b].add(a)
    low = list(ids)
    change = True
    while change:
        change = False
        for a, s in link.items():
            for b in s:
                if low[b] < low[a]:
                    low[a], change = low[b], True
    return {i: (len(link[k]), low[k], low[k] == i) for k, i in enumerate(ids)}


def test_embedding_links(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)        # several blocks in a bucket
    rng = np.random.default_rng(4)
    rows = []
    for c in range(6):
        center = rng.normal(size=24)
        rows += [(center + rng.normal(size=24) * s).tolist() for s in [0.0] + [0.12] * (40 if c == 0 else 5)]
    rows += [rows[0], rows[0], [2 * x for x in rows[3]], None, [], [0.0] * 24, [float("nan")] * 24,
             [1.0, None] * 12, [float("inf")] + [0.0] * 23, [1.0], [2.0], [-1.0]]
    rows = [(i * 3, v) for i, v in enumerate(rows)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1)).repartition(5)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicate_vectors(df).collect()}
    want = brute_vectors(rows, 0.9)
    assert got == want
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


# -- op9 ----------------------------------------------------------------------

def test_sharding(spark, odd, none):
    rows = [(i, "x" * (i * 7 % 50) if i % 4 else "the same text again") for i in range(200)] + [(500, None), (501, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sharding.shard_documents(df, 5).collect()
    shards = {}
    for r in got:
        assert r["size"] == len((dict(rows)[r["doc_id"]] or "").encode()) + 8
        assert r["text_crc32"] == zlib.crc32((dict(rows)[r["doc_id"]] or "").encode())
        shards.setdefault(r["shard"], []).append(r)
    assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in shards.values())
    assert set(shards) <= set(range(5))
    by_text = {}
    for r in got:
        by_text.setdefault(dict(rows)[r["doc_id"]] or "", set()).add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    assert sharding.shard_documents(odd, 24).count() == len(ROWS)
    assert sharding.shard_documents(none, 24).count() == 0


def test_refined_cuts_equal_those_on_all_groups(spark):
    rng = np.random.default_rng(9)
    keys = np.unique(np.concatenate([rng.integers(-2**63, 2**63 - 1, 400), 12345 + np.arange(300)]))   # a crowded range
    sizes = rng.integers(8, 900, len(keys))
    df = spark.createDataFrame([(int(k), int(s)) for k, s in zip(keys, sizes)], "key long, bytes long")
    big, starts, cap = sharding.find_cuts(df, 24)
    assert big == [] and cap == sharding.smallest_capacity(sizes, 24)
    edges = [0, *(len(keys) if s is None else int(np.searchsorted(keys, s)) for s in starts), len(keys)]
    assert max(sizes[a:b].sum() for a, b in zip(edges, edges[1:])) <= cap


# -- op10 -----------------------------------------------------------------------

def test_decontamination(spark, odd, none, items):
    got = {r["doc_id"]: r for r in decontaminate.report(odd, items, 10).collect()}
    assert got[8]["n_hit"] == len(PASSAGE.split()) and got[8]["items_sha256"] == hashlib.sha256(b"1").hexdigest()
    assert got[4]["n_hit"] == 2 and got[4]["n_items"] == 1 and got[11]["contaminated"]
    assert got[10]["n_hit"] == 1 and got[10]["n_items"] == 0 and got[10]["contaminated"]
    assert got[1]["n_words"] == 0 and got[1]["items_sha256"] == hashlib.sha256(b"").hexdigest()
    out = decontaminate.decontaminated(odd, items, 10)
    assert out.columns == odd.columns and out.count() == len(ROWS)
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    assert text[8] == "intro  outro" and text[1] is None and text[5] == LONG
    assert decontaminate.report(none, items).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.report(odd, items.limit(0)).collect())


def test_decontamination_in_blocks_of_items(spark, odd, items, monkeypatch):
    one = rows_of(decontaminate.report(odd, items, 10))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 10)
    assert len(decontaminate.automata(items, 10)) > 1
    assert rows_of(decontaminate.report(odd, items, 10)) == one
    assert {r["doc_id"]: r["text"] for r in decontaminate.decontaminated(odd, items).collect()}[8] == "intro  outro"


def test_decontamination_of_a_passage_shared_by_many_items(spark):
    # 2,000 items hold one passage, a text holds 2,000 copies of it; copies of texts and short equal items too
    words = [f"w{i}" for i in range(30)]
    items = spark.createDataFrame([(i, " ".join([f"own{i}", *words])) for i in range(2000)]
                                  + [(3000 + i, "tiny one") for i in range(500)], "item_id long, text string")
    hot = " x ".join([" ".join(words)] * 2000)
    docs = spark.createDataFrame([(1, hot), (2, hot), (2, hot), (3, "a tiny one b"), (4, " ".join(words[5:15]) + " tiny one"),
                                  (5, "own7 " + " ".join(words[:9])), (6, None)], "doc_id long, text string")
    got = sorted(decontaminate.report(docs, items, 10).collect())

    def sha(ids):
        return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
    long, tiny = range(2000), range(3000, 3500)
    want = [(1, 61999, 60000, 2000, sha(long)), (2, 61999, 60000, 2000, sha(long)), (2, 61999, 60000, 2000, sha(long)),
            (3, 4, 2, 500, sha(tiny)), (4, 12, 12, 2500, sha([*long, *tiny])), (5, 10, 10, 1, sha([7])), (6, 0, 0, 0, sha([]))]
    assert [tuple(r)[:5] for r in got] == want
    listed = decontaminate.matches(docs, items, 10).filter("doc_id = 4").first()["items"]
    assert listed == sorted(map(str, [*long, *tiny]))


def test_decontaminated_text_does_not_depend_on_the_blocks(spark, monkeypatch):
    # windows that only a cut of another block joins, in every order, and windows of two blocks that overlap
    seq = [[f"{k}{i}" for i in range(12)] for k in "abcdef"]
    items = spark.createDataFrame([(i, " ".join(s)) for i, s in enumerate(seq)] + [(9, " ".join(seq[0][6:] + seq[1][:6]))],
                                  "item_id long, text string")
    texts = [" ".join(["in", *x[:5], *y, *x[5:], "out"]) for x in seq for y in seq if x is not y]
    texts += [" ".join(["in", *seq[0], *seq[1], "out"]), " ".join(["in", *seq[0][:5], *seq[1][:5], *seq[2], *seq[1][5:], *seq[0][5:], "out"]),
              None, "nothing to cut", "in out"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one = rows_of(decontaminate.decontaminated(docs, items, 10))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 5)
    assert len(decontaminate.automata(items, 10)) > 2
    assert rows_of(decontaminate.decontaminated(docs, items, 10)) == one


# -- SQL and pipeline -----------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    from oracle import compare, duck
    _, problems = compare(spark, duck(SF), queries.QUERIES[name], queries.ORACLES[name], SF)
    assert not problems, problems


def test_stages_on_odd_tables(spark, odd, none, tmp_path):
    docs = odd.withColumn("n_chars", F.length("text").cast("long"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= len(ROWS)
        assert stage(spark, none, SF).count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, SF).count() >= len(ROWS) and last(spark, none, SF).count() == 0


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r["doc_id"] for r in quality.quality_report(docs, labels).collect() if r["predicted"]}
    texts = sorted((r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in kept)
    after = brute_lines_fast(texts)
    fp = {d: brute_simhash(t) for d, t in after.items()}
    low = {d: d for d in fp}
    change = True
    while change:
        change = False
        for a in fp:
            for b in fp:
                if low[b] < low[a] and (fp[a] ^ fp[b]).bit_count() <= 2:
                    low[a], change = low[b], True
    left = {d: after[d] for d in after if low[d] == d}
    items = [(str(r["item_id"]), [w.encode() for w in words(r["text"])])
             for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = {tuple(s[k:k + 10]) for _, s in items for k in range(max(1, len(s) - 9))}
    for d, t in left.items():
        while True:
            at = [(m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))]
            w = [lower(t[a:b]).encode() for a, b in at]
            hit = [False] * len(w)
            for k in range(len(w) - 9):
                if tuple(w[k:k + 10]) in grams:
                    hit[k:k + 10] = [True] * 10
            if not any(hit):
                break
            out, pos, i = [], 0, 0
            while i < len(w):
                if hit[i]:
                    j = i
                    while j + 1 < len(w) and hit[j + 1]:
                        j += 1
                    out.append(t[pos:at[i][0]])
                    pos, i = at[j][1], j
                i += 1
            t = "".join(out) + t[pos:]
        left[d] = t
    check_packing(corpus_pipeline.run(spark, SF).collect(), left, 1024, 2)


def brute_lines_fast(docs):
    """As brute_lines, with candidate pairs from shared shingles."""
    from collections import Counter
    occ, sets, inv = {}, [], {}
    for d, t in docs:
        for n, line in line_dedup.units(t):
            occ.setdefault(line, []).append((d, n))
    lines = list(occ)
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, x in enumerate(lines):
        s = line_dedup.shingles(x)
        sets.append(s)
        near = Counter(j for g in s for j in inv.get(g, ()))
        for j, both in near.items():
            if both / (len(s) + len(sets[j]) - both) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for g in s:
            inv.setdefault(g, []).append(i)
    groups = {}
    for i, x in enumerate(lines):
        groups.setdefault(find(i), []).extend(occ[x])
    gone = {o for g in groups.values() for o in g if o != min(g)}
    return {d: "\n".join(x for n, x in enumerate((t or "").split("\n")) if (d, n) not in gone) for d, t in docs}
