"""License scans by diagonal voting.

Every rolling word k-gram of every document is hashed and joined by Spark to
the positions of the same gram in the license templates.  Document position
minus template position is the diagonal of a match; votes are counted per
(document, template, diagonal).  A phrase stands at a place where one
diagonal has all its votes.  Words left out or put in shift a passage to a
neighbouring diagonal, so diagonals a few words apart are merged, and the
merged span is verified: enough *different* grams of the template, in the
template's order, in a span about as long as the template.  A second hash of the gram, carried in the row, checks
the first.  A notice that stands whole on one diagonal is a span by itself;
only partial diagonals are merged.

The template table is a constant of this module, so its broadcast is bounded.

Defined results: null and wordless texts have no words and no labels (empty
strings, score 0); overlapping places all count; repeated rows are reported
as often as they occur; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, only, small_batches
from .words import WordBatch, groups_by_size, mix, normalized

K = 2
#: merged diagonals lie at most so many words apart
DRIFT = 4
#: least share of a template's grams in a verified span
COVERAGE = 0.7

# Phrases and the label each stands for.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Openings of well-known license notices, matched approximately.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction": "mit-text",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
    "with the license": "apache-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license as published by the free software foundation": "gpl-notice",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "released under the mit license": "mit-release",
    "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met": "bsd-text",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights-reserved",
}


def gram_keys(b: WordBatch, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, position, key) of every rolling k-gram inside one text."""
    n = len(b.keys)
    doc = np.repeat(np.arange(len(b.first) - 1), np.diff(b.first))
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h = mix((h ^ b.keys[i:n - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15))
    at = np.flatnonzero(doc[:n - k + 1] == doc[k - 1:])
    return doc[at], at - b.first[doc[at]], h[at]


def check_bits(b: WordBatch, text: np.ndarray, pos: np.ndarray, k: int) -> np.ndarray:
    """31 further bits of each gram, from sizes, heads and tails of its words."""
    at = b.first[text] + pos
    h = np.zeros(len(at), np.uint64)
    for i in range(k):
        w = b.keys[at + i]
        size = (b.ends[at + i] - b.starts[at + i]).astype(np.uint64)
        h = mix(h * np.uint64(31) + (w >> np.uint64(7)) + size)
    return (h >> np.uint64(33)).astype(np.int64)


def templates(phrases: dict[str, str], k: int) -> list[tuple[int, int, int, int]]:
    """(template, position, key, check) of the grams of each phrase."""
    b = WordBatch([normalized(p) for p in phrases])
    if max(np.diff(b.first), default=0) > 62:
        raise ValueError("a template of more than 62 words: its votes are kept as bits of one long")
    text, pos, key = gram_keys(b, k)
    check = check_bits(b, text, pos, k)
    return list(zip(text.tolist(), pos.tolist(), key.view(np.int64).tolist(), check.tolist()))


_GRAMS = "row long, doc_id {id}, n_words long, key long, place long"


def grams(docs: DataFrame, k: int) -> DataFrame:
    """One row per gram (place: position and check bits) and one per text (key null, with its word count)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [normalized(t) for t in b.column(2).to_pylist()]
            rows = np.asarray(b.column(0).to_numpy())
            for x, y in groups_by_size(texts):
                words = WordBatch(texts[x:y])
                m = y - x
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(x, m), b.column(1).slice(x, m), pa.array(np.diff(words.first)),
                     pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())],
                    ["row", "doc_id", "n_words", "key", "place"])
                text, pos, key = gram_keys(words, k)
                place = pos << 31 | check_bits(words, text, pos, k)
                own = rows[x:y][text]
                for a in range(0, len(key), 1 << 18):
                    z = min(len(key), a + (1 << 18))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[a:z]), pa.nulls(z - a, b.column(1).type), pa.nulls(z - a, pa.int64()),
                         pa.array(key[a:z].view(np.int64)), pa.array(place[a:z])],
                        ["row", "doc_id", "n_words", "key", "place"])

    small_batches(docs.sparkSession)
    rows = only(docs, doc_id="doc_id", text="text")
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return rows.mapInArrow(run, _GRAMS.format(id=dict(rows.dtypes)["doc_id"]))


def scan(docs: DataFrame, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): (row, doc_id, n_words), and the verified spans
    (row, template, label, exact, start, end, coverage) of words."""
    spark = docs.sparkSession
    phrases = {**base, **notices}
    labels = list(phrases.values())
    sizes = [len(p.split()) for p in phrases]
    table = spark.createDataFrame(templates(phrases, K), "template int, at int, tkey long, tcheck long")
    g = grams(docs, K)
    hits = g.join(F.broadcast(table), g["key"] == table["tkey"], "left")        # a constant table
    same = F.col("place").bitwiseAND(F.lit((1 << 31) - 1)) == F.col("tcheck")
    hits = materialize(hits.filter(F.col("key").isNull() | same).select(
        "row", "doc_id", "n_words", "template", "at", F.shiftright("place", 31).alias("pos")), "license-hits")
    info = spark.createDataFrame([(i, labels[i], i < len(base), sizes[i]) for i in range(len(labels))],
                                 "template int, label string, base boolean, size int")
    votes = (hits.filter("template is not null")
             .groupBy("row", "template", (F.col("pos") - F.col("at")).alias("diagonal"))
             .agg(F.count(F.lit(1)).alias("votes"), F.bit_or(F.expr("shiftleft(1L, at)")).alias("mask"),
                  F.min("pos").alias("lo"), F.max("pos").alias("hi"))
             .join(F.broadcast(info), "template"))
    full = F.col("size") - K + 1
    exact = votes.filter(F.col("base") & (F.col("votes") == full)).select(
        "row", "template", "label", F.lit(True).alias("exact"), F.col("diagonal").alias("start"),
        (F.col("diagonal") + F.col("size")).alias("end"), F.lit(1.0).alias("coverage"))
    # a notice that is all there on one diagonal is a span of its own
    whole = votes.filter(~F.col("base") & (F.col("votes") == full)).select(
        "row", "template", "label", F.lit(False).alias("exact"), F.col("diagonal").alias("start"),
        (F.col("diagonal") + F.col("size")).alias("end"), F.lit(1.0).alias("coverage"))
    # one document and template at a time: neighbours by diagonal, near each other in the text
    w = Window.partitionBy("row", "template").orderBy("diagonal", "lo")
    near = (F.col("diagonal") - F.lag("diagonal").over(w) <= DRIFT) & \
        (F.col("lo") - F.lag("hi").over(w) <= F.col("size")) & (F.lag("lo").over(w) - F.col("hi") <= F.col("size"))
    merged = (votes.filter(~F.col("base") & (F.col("votes") < full))
              .withColumn("new", (~F.coalesce(near, F.lit(False))).cast("int"))
              .withColumn("span", F.sum("new").over(w))
              .groupBy("row", "template", "label", "size", "span")
              .agg(F.bit_or("mask").alias("mask"), F.min("lo").alias("start"), (F.max("hi") + K).alias("end")))
    near = merged.filter((F.bit_count("mask") / full >= COVERAGE) & (F.col("end") - F.col("start") <= 1.5 * F.col("size")))
    # the grams of a span, bounded by its length: how many stand in the template's order?
    placed = near.join(hits.filter("template is not null").select(F.col("row").alias("r"), F.col("template").alias("t"), "pos", "at"),
                       (F.col("row") == F.col("r")) & (F.col("template") == F.col("t"))
                       & (F.col("pos") >= F.col("start")) & (F.col("pos") <= F.col("end") - K))
    spans = placed.groupBy("row", "template", "label", "size", "span", "start", "end").agg(
        F.array_sort(F.collect_set(F.struct("pos", (-F.col("at")).alias("back")))).alias("grams"))
    fuzzy = spans.withColumn("coverage", in_order("grams", full) / full).filter(F.col("coverage") >= COVERAGE).select(
        "row", "template", "label", F.lit(False).alias("exact"), "start", "end", "coverage")
    return hits.filter("template is null").select("row", "doc_id", "n_words"), exact.unionByName(whole).unionByName(fuzzy)


def in_order(grams: str, full: Column) -> Column:
    """Length of the longest run of rising template positions among ``grams`` (pos, -at), sorted."""
    zero = F.transform(F.sequence(F.lit(1), full), lambda x: F.lit(0))

    def take(best: Column, g: Column) -> Column:
        at = -g["back"]
        before = F.when(at > 0, F.array_max(F.slice(best, F.lit(1), at))).otherwise(0)
        return F.transform(best, lambda x, i: F.when(i == at, F.greatest(x, before + 1)).otherwise(x))

    return F.aggregate(F.col(grams), zero, take, lambda best: F.array_max(best))


def license_report(docs: DataFrame) -> DataFrame:
    texts, spans = scan(docs)
    def names(c):
        return F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = spans.groupBy("row").agg(
        F.count_if("exact").alias("n_base"),
        F.min(F.when(F.col("exact"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("exact"), F.col("start"))).alias("last_word"),
        names(F.when(F.col("exact"), F.col("label"))).alias("base_labels"), names("label").alias("labels"),
        F.max("coverage").alias("score"))
    return texts.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
