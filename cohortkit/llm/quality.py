"""Quality classifier: random-indexing word vectors and a two-layer network.

Every word has a random index vector (a few +1 and -1, by its hash).  A
word's context vector is the sum of the index vectors around it, over the
whole corpus; words share ``BUCKETS`` hashed rows, so the table is bounded.
The sums are integers, added up by Spark, so they do not depend on the
partitioning.  A document is the mean of its words' vectors, and of the
products of those one and two words apart.  A two-layer numpy network is fitted on a
sample of at most ``SAMPLE`` labelled documents (those with the smallest
hash of their id), a fifth of which sets the temperature that calibrates
its probabilities.

Scores depend on the text alone.  Defined results: null and empty texts get
the score of the zero vector; labels without id or quality, and documents
without label, teach nothing; the fewer labelled rows there are, the stronger
the weight decay and the nearer the temperature to 1; without both labels to
learn from, every score is the share of label 1 (0.5 without labels); no rows
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import only, small_batches, unwrapped, wrapped
from .words import eight, groups_by_size, keys

BUCKETS, DIM, NONZERO, WINDOW = 8192, 64, 2, 2
SAMPLE, HIDDEN, EPOCHS, SEED = 20_000, 32, 60, 7
THRESHOLD = 0.7
#: tokens whose vectors are held at once
PART = 2048

#: 0: white space and control, 1: digit, 2: letter or beyond ASCII, 3: other marks
_KIND = np.array([0 if b <= 0x20 or b == 0x7F else 1 if 0x30 <= b <= 0x39 else
                  2 if b >= 0x80 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A else 3 for b in range(256)], np.uint8)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each bucket's index vector."""
    r = np.random.default_rng(SEED)
    return (np.argsort(r.random((BUCKETS, DIM)), axis=1)[:, :NONZERO],
            r.choice([-1, 1], size=(BUCKETS, NONZERO)))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each token, first token of each text and the end): runs of letters, digits or marks."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = b"".join(texts)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    if not data:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    kind = _KIND[np.frombuffer(data, np.uint8)]
    first = np.ones(len(kind), bool)
    first[1:] = kind[1:] != kind[:-1]
    first[offsets[:-1][sizes > 0]] = True
    edges = np.append(np.flatnonzero(first), len(kind))
    starts, ends = edges[:-1], edges[1:]
    on = kind[starts] > 0
    starts, ends = starts[on], ends[on]
    k = keys(data, starts, ends, eight(data))
    return (k % np.uint64(BUCKETS)).astype(np.int64), np.searchsorted(starts, offsets)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, sign = index_vectors()
    total = np.zeros(BUCKETS * DIM, np.int64)
    for b in batches:
        texts = [(t or "").encode("utf-8") for t in b.column(0).to_pylist()]
        for x, y in groups_by_size(texts):
            t, first = tokens(texts[x:y])
            doc = np.repeat(np.arange(y - x), np.diff(first))
            for d in range(1, WINDOW + 1):
                near = np.flatnonzero(doc[d:] == doc[:-d]) if len(t) > d else np.zeros(0, np.int64)
                for u, v in ((t[near], t[near + d]), (t[near + d], t[near])):
                    for s in range(NONZERO):
                        total += np.bincount(u * DIM + place[v, s], sign[v, s], BUCKETS * DIM).astype(np.int64)
    m = total.reshape(BUCKETS, DIM)
    at = np.flatnonzero(m.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(m[at, k]) for k in range(DIM))],
                                     ["b", *(f"c{k}" for k in range(DIM))])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """(BUCKETS, DIM) vectors from the contexts of the whole corpus."""
    cols = [f"c{k}" for k in range(DIM)]
    small_batches(docs.sparkSession)
    rows = (docs.select(F.col("text").alias("text")).mapInArrow(_contexts, "b long, " + ", ".join(f"{c} long" for c in cols))
            .groupBy("b").agg(*[F.sum(c).alias(c) for c in cols]).collect())      # at most BUCKETS rows
    m = np.zeros((BUCKETS, DIM))
    for r in rows:
        m[r[0]] = r[1:]
    return _normalized(m)


def _normalized(m: np.ndarray) -> np.ndarray:
    """Unit rows around their common direction; a bucket without contexts stays zero."""
    size = np.linalg.norm(m, axis=1, keepdims=True)
    some = size[:, 0] > 0
    u = np.divide(m, size, where=size > 0, out=np.zeros_like(m))
    if some.any():
        u[some] -= u[some].mean(axis=0)
        u[some] /= np.maximum(np.linalg.norm(u[some], axis=1, keepdims=True), 1e-12)
    return u.astype(np.float32)


def features(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """(texts, 3 DIM): mean word vector, and mean products of words one and two apart.

    A text goes through one small buffer in parts of PART tokens, so its vectors stay in the cache.
    """
    out = np.zeros((len(texts), 3 * DIM), np.float32)
    buf = np.empty((PART + 2, DIM), np.float32)
    for x, y in groups_by_size(texts, 1 << 20):
        t, first = tokens(texts[x:y])
        for i, (a, z) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            n = z - a
            if n == 0:
                continue
            total = np.zeros((3, DIM))
            for at in range(a, z, PART):
                end, more = min(at + PART, z), min(at + PART + 2, z)     # with the two words after the part
                v = np.take(vectors, t[at:more], axis=0, out=buf[:more - at], mode="clip")
                own = v[:end - at]
                total[0] += own.sum(axis=0)
                for d in (1, 2):
                    after = v[d:d + end - at]
                    total[d] += np.einsum("ij,ij->j", own[:len(after)], after)
            out[x + i] = (total / np.array([[n], [max(n - 1, 1)], [max(n - 2, 1)]])).ravel()
    return out


# -- the network -------------------------------------------------------------

class Network:
    """tanh hidden layer, logistic output, temperature."""

    def __init__(self, w: dict[str, np.ndarray] | None, prior: float):
        self.w, self.prior = w, prior

    def logit(self, x: np.ndarray) -> np.ndarray:
        w = self.w
        z = np.tanh(((x - w["mean"]) / w["scale"]) @ w["a"] + w["p"])
        return z @ w["b"] + w["q"]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.w is None:
            return np.full(len(x), self.prior)
        return sigmoid(self.logit(x.astype(np.float64)) / self.w["temperature"])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    prior = float(y.mean()) if len(y) else 0.5
    if len(y) == 0 or y.min() == y.max():
        return Network(None, prior)
    # what few rows cannot say fades smoothly with their number: 1 for none, 0.5 for sqrt(20), 0.002 for 100
    doubt = 20 / (20 + len(y) ** 2)
    decay = 1e-4 + 0.2 * doubt
    r = np.random.default_rng(SEED)
    order = r.permutation(len(y))
    n_held = len(y) // 5
    held, train = order[:n_held], order[n_held:]
    x = x.astype(np.float64)
    spread = x[train].std(axis=0) + 1e-6
    # a feature that hardly differs in a few rows says nothing; the score starts at the share of label 1
    w = {"mean": x[train].mean(axis=0), "scale": spread + doubt * max(float(spread.mean()), 0.01),
         "a": r.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), "p": np.zeros(HIDDEN),
         "b": (1 - doubt) * r.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "q": np.array(doubt * np.log(prior / (1 - prior))),
         "temperature": np.ones(())}
    z = (x - w["mean"]) / w["scale"]
    names = ("a", "p", "b", "q")
    m1, m2 = ({k: np.zeros_like(w[k]) for k in names} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        perm = r.permutation(train)
        for at in range(0, len(perm), 128):
            i = perm[at:at + 128]
            h = np.tanh(z[i] @ w["a"] + w["p"])
            e = (sigmoid(h @ w["b"] + w["q"]) - y[i]) / len(i)
            back = np.outer(e, w["b"]) * (1 - h * h)
            grad = {"a": z[i].T @ back + decay * w["a"], "p": back.sum(axis=0), "b": h.T @ e + decay * w["b"], "q": e.sum()}
            step += 1
            for k in names:
                m1[k] = 0.9 * m1[k] + 0.1 * grad[k]
                m2[k] = 0.999 * m2[k] + 0.001 * grad[k] ** 2
                w[k] = w[k] - 2e-3 * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(w, prior)
    if n_held == 0:
        return net
    logit = net.logit(x[held])
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
    loss = [-np.mean(np.log(np.clip(np.where(y[held] == 1, sigmoid(logit / t), sigmoid(-logit / t)), 1e-9, 1))) for t in grid]
    # a temperature from few held-out rows is drawn towards 1
    w["temperature"] = np.array(grid[int(np.argmin(loss))] ** (n_held / (n_held + 20)))
    return net


# -- on tables -----------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    """Documents whose labels are for testing only."""
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame):
    """Broadcast (word vectors, weights, prior): vectors from all of ``docs``, the network from labelled rows not held out."""
    spark = docs.sparkSession
    vectors = spark.sparkContext.broadcast(word_vectors(docs))
    known = only(labels, id=F.col("doc_id").cast("long"), quality=F.col("quality").cast("int")) \
        .filter("id is not null and quality in (0, 1)").filter(~held_out(F.col("id"))) \
        .groupBy("id").agg(F.max("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(SAMPLE)             # the documented bound

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = features([(t or "").encode("utf-8") for t in b.column(2).to_pylist()], vectors.value)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in x], pa.binary())],
                                             ["id", "quality", "x"])

    small_batches(spark)
    texts = only(docs, doc_id=F.col("doc_id").cast("long"), text="text")
    rows = (texts.join(F.broadcast(sample), texts["doc_id"] == sample["id"]).select("id", "quality", "text")
            .mapInArrow(run, "id long, quality int, x binary"))
    # repeated ids can make the sample longer than its bound: it is cut again
    got = rows.orderBy(F.xxhash64("id"), "id", "x").limit(SAMPLE).collect()
    x = np.array([np.frombuffer(r["x"], np.float32) for r in got]).reshape(len(got), 3 * DIM)
    net = fit(x, np.array([r["quality"] for r in got], dtype=np.float64))
    # plain data: executors need no copy of the class
    return spark.sparkContext.broadcast((vectors.value, net.w, net.prior))


def scored(texts: DataFrame, model) -> DataFrame:
    """``texts`` (with a column ``text``) and a column ``score``."""
    small_batches(texts.sparkSession)
    names = [c for c in texts.columns if c != "text"]
    schema = StructType([*(texts.schema[c] for c in names), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, *parts = model.value
        net = Network(*parts)
        for b in batches:
            x = features([(t or "").encode("utf-8") for t in b.column(b.num_columns - 1).to_pylist()], vectors)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(net.score(x), pa.float64())], [*names, "score"])

    return texts.select(*names, "text").mapInArrow(run, schema)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    s = scored(only(docs, doc_id="doc_id", text="text"), train(docs, labels))
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def quality_filter(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts."""
    s = scored(wrapped(docs, text="text"), train(docs, labels))
    return unwrapped(s.filter(F.col("score") >= THRESHOLD), docs)
