"""Quality by kernel ridge regression over document statistics, calibrated.

STATISTICS of a text are standardised by their means and deviations over all documents; random Fourier
features approximate a Gaussian kernel on them. Each partition of the labelled rows sums its normal
equations; those are summed by row of the matrix, and one ridge solution gives raw scores. Isotonic
regression over all labelled rows, counted in bins of the raw score, makes them probabilities.

Null and empty texts have all statistics 0 and are scored so. Rows with a null label or id are not learned
from. Without labelled rows the score is 0.5. Repeated rows are scored one by one; other columns stay,
`score` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.common import map_arrow, stored
from quadrille.llm.toxicity import held_out
from quadrille.llm.words import WHITE, utf8, words_of

STATISTICS = ("log_bytes", "log_words", "word_bytes", "upper", "digits", "marks", "odd_marks", "bars", "lines", "high", "distinct", "repeats", "top_word", "distinct_pairs", "word_entropy", "repeated_lines", "line_bytes")
FEATURES = 256
RIDGE = 1e-3
#: Width of the kernel, in standard deviations of all statistics together.
WIDTH = 0.7
BINS = 2000
#: The normal equations of so many partitions, or of as many as the cluster has cores, are summed; more partitions are brought together first.
PARTS = 128


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_UPPER, _DIGITS = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("0123456789")
_MARKS = _table("".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()))
_ODD = _MARKS & ~_table(".,;:!?'\"()-")
_HIGH = np.arange(256) >= 128


def _of_bytes(text: bytes) -> tuple[float, ...]:
    n = len(text)
    if not n:
        return (0.0,) * 9
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lines = text.split(b"\n")
    return (np.log1p(n), *(float(count[t].sum()) / n for t in (_UPPER, _DIGITS, _MARKS, _ODD, _HIGH)), float(count[124]) / n, float(count[10]) / n, 1 - len(set(lines)) / len(lines))


def statistics(texts: Sequence[bytes | None]) -> np.ndarray:
    out = np.zeros((len(texts), len(STATISTICS)))
    at = {s: i for i, s in enumerate(STATISTICS)}
    for a, _, bounds, h in words_of(texts, WHITE):
        for i in range(len(bounds) - 1):
            text, w = texts[a + i] or b"", h[bounds[i] : bounds[i + 1]]
            row = out[a + i]
            row[at["log_bytes"]], *shares = _of_bytes(text)
            for s, v in zip(("upper", "digits", "marks", "odd_marks", "high", "bars", "lines", "repeated_lines"), shares, strict=True):
                row[at[s]] = v
            n = len(w)
            if not n:
                continue
            sort = np.sort(w)
            runs = np.diff(np.concatenate(([0], np.flatnonzero(sort[1:] != sort[:-1]) + 1, [n])))
            p = runs / n
            pairs = np.sort(w[1:] ^ (w[:-1] * np.uint64(0x9E3779B97F4A7C15)))
            row[at["log_words"]] = np.log1p(n)
            row[at["word_bytes"]] = np.log(len(text) / n)
            row[at["distinct"]] = len(runs) / n**0.8
            row[at["repeats"]] = float((w[1:] == w[:-1]).mean()) if n > 1 else 0
            row[at["top_word"]] = p.max()
            row[at["distinct_pairs"]] = (1 + int((pairs[1:] != pairs[:-1]).sum())) / max(1, n - 1) if n > 1 else 1
            row[at["word_entropy"]] = -(p * np.log(p)).sum() / np.log(n + 1)
            row[at["line_bytes"]] = np.log1p(len(text) / (1 + text.count(b"\n")))
    return out


@dataclass
class Scorer:
    mean: np.ndarray
    scale: np.ndarray
    solution: np.ndarray
    edges: np.ndarray  # of raw scores, ascending
    values: np.ndarray  # calibrated, at the edges

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(11)
        d = len(self.mean)
        w = rng.normal(0, WIDTH / np.sqrt(d), (d, FEATURES))
        b = rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        # the statistics themselves stand beside the kernel's features
        return np.concatenate((np.ones((len(x), 1)), z, np.sqrt(2 / FEATURES) * np.cos(z @ w + b)), axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lifted(x) @ self.solution

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.edges, self.values), 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means of adjacent violators, pooled; at the weighted centres of the pools."""
    pools: list[list[float]] = []
    for a, b, w in zip(x.tolist(), y.tolist(), weight.tolist(), strict=True):
        pools.append([a * w, b * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [u + v for u, v in zip(pools[-1], last, strict=True)]
    p = np.array(pools)
    return p[:, 0] / p[:, 2], p[:, 1] / p[:, 2]


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    kept = docs.drop("statistics")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = statistics(utf8(b.column(text)))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in b.schema.names if c != text], pa.array(rows.tolist(), pa.list_(pa.float64()))], names=[*[c for c in b.schema.names if c != text], "statistics"])

    return map_arrow(kept, each, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != text), "statistics array<double>"]))


def fit(rows: DataFrame, labelled: DataFrame, label: str) -> Scorer:
    """rows: all documents' statistics; labelled: those to learn from, with the label."""
    k = len(STATISTICS)
    at = [F.col("statistics")[i] for i in range(k)]
    row = rows.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(at)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(at)]).first()
    mean = np.array([row[f"m{i}"] or 0.0 for i in range(k)])
    scale = np.array([max(row[f"s{i}"] or 0.0, 1e-6) for i in range(k)])
    scorer = Scorer(mean, scale, np.zeros(1 + k + FEATURES), np.array([0.0]), np.array([0.5]))
    size = 1 + k + FEATURES
    pairs = labelled.select("statistics", F.col(label).cast("double").alias("y"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, c = np.zeros((size, size)), np.zeros(size)
        any_ = False
        for b in batches:
            z = scorer.lifted(np.array(b.column("statistics").to_pylist(), float).reshape(-1, k))
            a += z.T @ z
            c += z.T @ b.column("y").to_numpy()
            any_ = True
        if any_:
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(np.column_stack((a, c)).tolist(), pa.list_(pa.float64()))], names=["i", "v"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": [group["i"].iloc[0]], "v": [np.sum(np.stack(group["v"].to_list()), axis=0).tolist()]})

    parts = map_arrow(pairs.coalesce(max(PARTS, pairs.sparkSession.sparkContext.defaultParallelism)), sums, "i int, v array<double>")
    got = {r["i"]: r["v"] for r in parts.groupBy("i").applyInPandas(add, "i int, v array<double>").collect()}
    if len(got) < size or not got[0][0]:
        return scorer
    m = np.array([got[i] for i in range(size)])
    n = m[0, 0]
    scorer.solution = np.linalg.solve(m[:, :-1] + RIDGE * n * np.diag([1e-6] + [1.0] * (size - 1)), m[:, -1])
    sent = rows.sparkSession.sparkContext.broadcast(scorer)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = sent.value.raw(np.array(b.column("statistics").to_pylist(), float).reshape(-1, k))
            yield pa.RecordBatch.from_arrays([pa.array(np.clip(np.round(r * BINS), -BINS, 2 * BINS).astype(np.int32)), b.column("y")], names=["bin", "y"])

    counts = sorted((r["bin"], r["ones"], r["n"]) for r in map_arrow(pairs, raw, "bin int, y double").groupBy("bin").agg(F.sum("y").alias("ones"), F.count(F.lit(1)).alias("n")).collect())
    x, ones, weight = (np.array(c, float) for c in zip(*counts, strict=True))
    scorer.edges, scorer.values = isotonic(x / BINS, ones / weight, weight)
    return scorer


def train(rows: DataFrame, labels: DataFrame, label: str = "quality", id: str = "doc_id") -> Scorer:
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull()).select(id, label)
    return fit(rows, stored(rows.select(id, "statistics").join(known, id), "quality-rows"), label)


def score(rows: DataFrame, scorer: Scorer) -> DataFrame:
    """rows have statistics."""
    sent = rows.sparkSession.sparkContext.broadcast(scorer)
    kept = rows.drop("score")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column("statistics").to_pylist(), float).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sent.value.scores(x), pa.float64())], names=[*b.schema.names, "score"])

    return map_arrow(kept, each, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields), "score double"]))


def query(spark, sf_dir: str) -> DataFrame:
    rows = stored(with_statistics(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")), "quality-statistics")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").where(~held_out(F.col("doc_id")))
    scored = score(rows, train(rows, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
