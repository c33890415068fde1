"""Toxicity by a factorization machine over hashed terms.

Terms are a text's words, after lower-casing A-Z, and the first 4 to 8 bytes of longer words, hashed to
2^20 places. score = sigmoid(bias + sum of weights + sum over pairs of present terms of the inner product of
their factors), so a pair of terms can weigh more, or less, than both alone. The model is fitted on at most
`sample` labelled rows, those of the least hashes. Terms enter it by tests of document frequencies in both
classes: a term's own, and, for terms that tell nothing alone, those of their pairs. So the many words of a
long text add nothing by their number, and a pair of terms that are harmless alone is learned. Both classes
weigh alike in the fit, however rare one is.

Null and empty texts, and texts without known terms, get the bias's score. Rows with a null label or id are
not learned from. Without labelled rows of both kinds the score is the share of ones, or 0.5. Repeated rows
are scored one by one; other columns stay, `score` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.llm.common import map_arrow
from quadrille.llm.words import NOT_ALNUM, Words, groups, mix, pieces, utf8

BITS = 20
PREFIXES = (4, 5, 6, 7, 8)
#: Labelled rows that the model is fitted on, at most.
SAMPLE = 12_000
FACTORS = 8
#: Terms of the model, at most, and their least standard score.
TERMS, Z = 4096, 3.0
#: Pairs are tested among so many terms, the most frequent ones of neither all nor few rows; their least standard
#: score is higher, as there are millions of them; and at most so many terms enter by them.
PAIR_TERMS, PAIR_Z, PAIRED = 1024, 7.0, 512


def _terms(texts: Sequence[bytes | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(a, document, term): distinct pairs, sorted; documents count from a."""
    shift = np.uint64(64 - BITS)
    gap = b"\x00"
    for a, b in groups(texts):
        part = [t or b"" for t in texts[a:b]]
        n = b - a
        if n == 1 and len(part[0]) > 1 << 20:
            cut = list(pieces(part[0], NOT_ALNUM))
        else:
            cut = [gap.join(part)]
        codes = []
        offsets = np.cumsum([0] + [len(t) + 1 for t in part])
        for piece in cut:
            w = Words(piece, NOT_ALNUM)
            doc = np.searchsorted(offsets, w.starts, "right") - 1 if len(cut) == 1 else np.zeros(len(w.starts), np.int64)
            length = w.ends - w.starts
            codes.append((doc << BITS) | (w.hashes >> shift).astype(np.int64))
            for k in PREFIXES:
                long = np.flatnonzero(length > k)
                codes.append((doc[long] << BITS) | (mix(w.prefix(k)[long] + np.uint64(k)) >> shift).astype(np.int64))
        pairs = np.unique(np.concatenate(codes))
        yield a, n, pairs >> BITS, pairs & ((1 << BITS) - 1)


@dataclass
class Machine:
    terms: np.ndarray  # sorted
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, doc: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Of n documents, by their pairs (document, index of a term)."""
        out = self.bias + np.bincount(doc, self.weights[term], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[term, f]
            out += 0.5 * (np.bincount(doc, v, n) ** 2 - np.bincount(doc, v * v, n))
        return out

    def scores(self, texts: Sequence[bytes | None]) -> np.ndarray:
        place = np.full(1 << BITS, -1, np.int32)
        place[self.terms] = np.arange(len(self.terms))
        out = np.empty(len(texts))
        for a, n, doc, term in _terms(texts):
            at = place[term]
            keep = at >= 0
            out[a : a + n] = self.raw(doc[keep], at[keep], n)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit(docs: Sequence[np.ndarray], labels: np.ndarray, epochs: int = 200, rate: float = 0.1, decay: float = 1e-5, seed: int = 7) -> Machine:
    """docs: each one's distinct terms."""
    n, ones = len(docs), float(labels.sum())
    if n == 0 or ones in (0, n):
        p = ones / n if n else 0.5
        return Machine(np.empty(0, np.int64), float(np.log((p + 1e-6) / (1 - p + 1e-6))), np.empty(0), np.empty((0, FACTORS)))
    every, in_ones = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for d, y in zip(docs, labels.tolist(), strict=True):
        every[d] += 1
        in_ones[d] += y
    z = _standard(every, in_ones, n, ones)
    terms = np.argsort(-np.abs(z), kind="stable")[:TERMS]
    terms = np.union1d(terms[np.abs(z[terms]) >= Z], _paired(docs, labels, every, ones))
    place = np.full(1 << BITS, -1, np.int64)
    place[terms] = np.arange(len(terms))
    known = [place[d][place[d] >= 0] for d in docs]
    doc, term = np.repeat(np.arange(n), [len(k) for k in known]), np.concatenate(known)
    m, rng = len(terms), np.random.default_rng(seed)
    share = np.where(labels > 0, 0.5 / ones, 0.5 / (n - ones))
    model = Machine(terms, 0.0, np.zeros(m), rng.normal(0, 0.02, (m, FACTORS)))
    sq_b, sq_w, sq_v = 1e-8, np.full(m, 1e-8), np.full((m, FACTORS), 1e-8)
    for epoch in range(2 * epochs):  # AdaGrad on the whole sample: the same result each time; the weights go before the factors
        s = [np.bincount(doc, model.factors[term, f], n) for f in range(FACTORS)]
        g = (1 / (1 + np.exp(-np.clip(model.raw(doc, term, n), -30, 30))) - labels) * share
        gb = g.sum()
        gw = np.bincount(term, g[doc], m) + decay * model.weights
        sq_b += gb * gb
        sq_w += gw * gw
        for f in range(FACTORS if epoch >= epochs else 0):
            v = model.factors[:, f]
            gv = np.bincount(term, g[doc] * (s[f][doc] - v[term]), m) + decay * v
            sq_v[:, f] += gv * gv
            model.factors[:, f] = v - 0.1 * rate * gv / np.sqrt(sq_v[:, f])
        model.bias -= rate * gb / np.sqrt(sq_b)
        model.weights -= rate * gw / np.sqrt(sq_w)
    return model


def _standard(every: np.ndarray, in_ones: np.ndarray, n: int, ones: float) -> np.ndarray:
    """Standard scores of the difference between the classes' shares; 0 for what is in under three documents."""
    p = every / n
    z = (in_ones / ones - (every - in_ones) / (n - ones)) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / ones + 1 / (n - ones)))
    z[every < 3] = 0
    return z


def _paired(docs: Sequence[np.ndarray], labels: np.ndarray, every: np.ndarray, ones: float) -> np.ndarray:
    """Terms of pairs whose joint frequency tells the classes apart better than either term's own, best first by pair."""
    n = len(docs)
    some = np.flatnonzero((every >= max(8, n // 500)) & (every <= n // 2))
    some = np.sort(some[np.argsort(-every[some], kind="stable")[:PAIR_TERMS]])
    k = len(some)
    if k < 2:
        return np.empty(0, np.int64)
    place = np.full(1 << BITS, -1, np.int64)
    place[some] = np.arange(k)
    together, in_ones = np.zeros((k, k)), np.zeros((k, k))
    for a in range(0, n, 1024):
        x = np.zeros((min(1024, n - a), k), np.float32)
        for i, d in enumerate(docs[a : a + 1024]):
            at = place[d]
            x[i, at[at >= 0]] = 1
        together += x.T @ x
        x = x[labels[a : a + 1024] > 0]
        in_ones += x.T @ x
    z = np.abs(_standard(together.ravel(), in_ones.ravel(), n, ones)).reshape(k, k)
    alone = np.diag(z).copy()
    z = np.triu(np.where(z > np.maximum(alone[:, None], alone[None, :]) + 2, z, 0), 1)
    a, b = np.nonzero(z >= PAIR_Z)
    order = np.argsort(-z[a, b], kind="stable")
    ends = np.column_stack((a[order], b[order])).reshape(-1)
    _, first = np.unique(ends, return_index=True)
    return some[ends[np.sort(first)[:PAIRED]]]


def held_out(id: Column) -> Column:
    return F.crc32(id.cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Machine:
    """labels: (id, label) rows to learn from. At most `sample` rows of them, joined with docs, are used, those of the least hashes; their terms come to the driver."""
    chosen = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull()).select(F.col(id).alias("_id"), F.col(label).cast("double").alias("_y")).orderBy(F.xxhash64("_id"), "_id", "_y").limit(sample)
    # at most `sample` rows of two numbers
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = utf8(b.column("_text"))
            found: list[bytes] = []
            for _, n, doc, term in _terms(texts):
                edges = np.searchsorted(doc, np.arange(n + 1))
                found += [term[edges[i] : edges[i + 1]].astype("<i4").tobytes() for i in range(n)]
            yield pa.RecordBatch.from_arrays([b.column("_id").cast(pa.string()), b.column("_y"), pa.array(found, pa.binary())], names=["id", "y", "terms"])

    # ids may repeat in docs, with other texts: then the bound goes by hash, so it is the same rows each time
    if rows.count() > sample:
        rows = rows.orderBy(F.xxhash64("_id"), "_id", F.xxhash64("_text"), "_text", "_y").limit(sample)
    got = sorted((r["id"], r["y"], bytes(r["terms"])) for r in map_arrow(rows, each, "id string, y double, terms binary").toLocalIterator())
    return fit([np.frombuffer(t, "<i4") for _, _, t in got], np.array([y for _, y, _ in got]))


def score(docs: DataFrame, model: Machine, text: str = "text") -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("score")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sent.value.scores(utf8(b.column(text))), pa.float64())], names=[*b.schema.names, "score"])

    return map_arrow(kept, each, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields), "score double"]))


def train_on_table(spark, docs: DataFrame, sf_dir: str) -> Machine:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where(~held_out(F.col("doc_id")))
    return train(docs.select("doc_id", "text"), labels)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score(docs, train_on_table(spark, docs, sf_dir)).drop("text")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))
