"""Benchmark decontamination by a generalised suffix automaton of the normalised test items.

Words are maximal runs of characters outside [\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] after lower-casing A-Z. A
window is `window` consecutive words of an item; an item of fewer words, but not none, is one window.
The automaton reads a document's words and tracks the longest suffix that occurs in an item; where that
reaches the window's length, the window's words are hit. Before it, vectorised tests find the stretches of
words in which each neighbouring pair occurs in some item: outside of them no window can occur.

Null and empty texts have no words and no hits; items without words are left out; the windows of an item
without an id hit words, but such an item has no name that could be counted or listed; items of equal texts
are all found; no items, no hits. Repeated rows are judged one by one; other
columns stay, those named like an output are replaced.

The items' words are counted first. Up to SHARD_WORDS go to the executors as one automaton; more are split
into shards, and the documents pass them one after another, each pass written to the shared folder.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.common import map_arrow, stored
from quadrille.llm.words import NOT_ALNUM, utf8, words_of

WINDOW = 13
SHARD_WORDS = 200_000
#: Of texts whose A-Z are not folded.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class Automaton:
    """Suffix automaton of several word sequences. step[state * width + word] is the next state."""

    def __init__(self, items: Sequence[tuple[str | None, bytes]], window: int = WINDOW):
        self.window, self.names = window, []
        hashed: list[np.ndarray] = []
        for (name, _), h in zip(items, _hashes([t for _, t in items]), strict=True):
            if len(h):
                self.names.append(name)
                hashed.append(h)
        every = np.concatenate(hashed) if hashed else np.empty(0, np.uint64)
        self.vocabulary = np.unique(every)
        self.width = len(self.vocabulary) + 1
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True
        self.length, self.link, self.step = [0], [-1], {}
        self._out: list[list[int]] = [[]]
        rows = [np.searchsorted(self.vocabulary, h).tolist() for h in hashed]
        pairs = [np.array(r[:-1], np.int64) * self.width + np.array(r[1:], np.int64) for r in rows]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
        self.least = min((min(len(r), window) for r in rows), default=window)
        for r in rows:
            last = 0
            for w in r:
                last = self._extend(last, w)
        del self._out
        self.items: dict[int, set[int]] = {}  # of the states of windows
        self.short: dict[int, list[tuple[int, int]]] = {}  # of the states of items shorter than a window
        for k, r in enumerate(rows):
            state = 0
            for i, w in enumerate(r):
                state = self.step[state * self.width + w]
                if i + 1 >= window:
                    self.items.setdefault(self._window_state(state), set()).add(k)
            if len(r) < window:
                self.short.setdefault(state, []).append((len(r), k))
        self._near: dict[int, int] = {}

    def _extend(self, last: int, w: int) -> int:
        step, width, link, length = self.step, self.width, self.link, self.length
        q = step.get(last * width + w)
        if q is not None:
            return q if length[last] + 1 == length[q] else self._clone(last, q, w)
        new = self._add(length[last] + 1, 0)
        while last >= 0 and last * width + w not in step:
            self._put(last, w, new)
            last = link[last]
        if last >= 0:
            q = step[last * width + w]
            link[new] = q if length[last] + 1 == length[q] else self._clone(last, q, w)
        return new

    def _add(self, length: int, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self._out.append([])
        return len(self.length) - 1

    def _put(self, state: int, w: int, to: int) -> None:
        self.step[state * self.width + w] = to
        self._out[state].append(w)

    def _clone(self, p: int, q: int, w: int) -> int:
        c = self._add(self.length[p] + 1, self.link[q])
        for x in set(self._out[q]):
            self._put(c, x, self.step[q * self.width + x])
        while p >= 0 and self.step.get(p * self.width + w) == q:
            self.step[p * self.width + w] = c
            p = self.link[p]
        self.link[q] = c
        return c

    def _window_state(self, state: int) -> int:
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _short_above(self, state: int) -> int:
        """The nearest state along suffix links, itself included, at which short items end; -1 if none."""
        path, s = [], state
        while s > 0 and s not in self.short and s not in self._near:
            path.append(s)
            s = self.link[s]
        found = -1 if s <= 0 else s if s in self.short else self._near[s]
        for x in path:
            self._near[x] = found
        return found

    def walk(self, words: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit spans, not merged, and items found in a stretch of word numbers."""
        step, width, link, length = self.step, self.width, self.link, self.length
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        state = n = 0
        for i, w in enumerate(words):
            while state and state * width + w not in step:
                state = link[state]
                n = length[state]
            state = step.get(state * width + w, 0)
            n = n + 1 if state else 0
            if n >= self.window:
                spans.append((i + 1 - self.window, i + 1))
                found |= self.items[self._window_state(state)]
            s = self._short_above(state) if self.short else -1
            while s > 0:
                for size, k in self.short[s]:
                    if size <= n:
                        spans.append((i + 1 - size, i + 1))
                        found.add(k)
                s = self._short_above(link[s])
        return spans, found

    def scan(self, texts: Sequence[bytes | None]) -> Iterator[Hits]:
        for _, _, bounds, h in words_of(texts, NOT_ALNUM):
            n = len(h)
            number = np.full(n, -1, np.int64)
            maybe = np.flatnonzero(self.seen[(h >> np.uint64(44)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.vocabulary, h[maybe]), self.width - 2) if self.width > 1 else maybe
            right = self.vocabulary[at] == h[maybe] if self.width > 1 else np.zeros(len(maybe), bool)
            number[maybe[right]] = at[right]
            known = number >= 0
            if self.least > 1:
                both = np.flatnonzero(known[:-1] & known[1:])
                code = number[both] * self.width + number[both + 1]
                pos = np.minimum(np.searchsorted(self.pairs, code), max(0, len(self.pairs) - 1))
                linked = np.zeros(n + 1, bool)  # linked[i]: words i - 1 and i
                if len(self.pairs):
                    linked[both[self.pairs[pos] == code] + 1] = True
                linked[bounds] = False
                edge = np.flatnonzero(np.diff(np.concatenate(([False], linked[1:], [False])).astype(np.int8)))
                a, b = edge[::2], edge[1::2] + 1
            else:
                joined = np.concatenate(([False], known, [False]))
                edge = np.flatnonzero(joined[1:] != joined[:-1])
                a, b = _cut(edge[::2], edge[1::2], bounds)
            keep = b - a >= self.least
            a, b = a[keep], b[keep]
            doc = np.searchsorted(bounds, a, "right") - 1
            got: dict[int, tuple[list[tuple[int, int]], set[int]]] = {}
            for x, y, d in zip(a.tolist(), b.tolist(), doc.tolist(), strict=True):
                spans, found = self.walk(number[x:y].tolist())
                if spans:
                    base = x - int(bounds[d])
                    have = got.setdefault(d, ([], set()))
                    have[0].extend((s + base, e + base) for s, e in spans)
                    have[1].update(found)
            for d in range(len(bounds) - 1):
                spans, found = got.get(d, ((), ()))
                yield Hits(int(bounds[d + 1] - bounds[d]), merged(spans), sorted({self.names[k] for k in found} - {None}))


class Hits(NamedTuple):
    n_words: int
    spans: list[tuple[int, int]]
    items: list[str]


def _cut(a: np.ndarray, b: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches a..b, cut at the bounds of documents."""
    inner = bounds[1:-1]
    k = np.searchsorted(b, inner, "right")
    inner, k = inner[k < len(b)], k[k < len(b)]
    cuts = inner[a[k] < inner]
    return np.sort(np.concatenate((a, cuts))), np.sort(np.concatenate((b, cuts)))


def _hashes(texts: Sequence[bytes]) -> Iterator[np.ndarray]:
    for _, _, bounds, h in words_of(texts, NOT_ALNUM):
        for i in range(len(bounds) - 1):
            yield h[bounds[i] : bounds[i + 1]]


def merged(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, text[last:]])


def _shards(items: DataFrame, id: str, text: str) -> list[Callable[[], list[tuple[str | None, bytes]]]]:
    rows = items.where(F.col(text).isNotNull()).select(F.col(id).cast("string").alias("id"), F.col(text).alias("text"))
    words = rows.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))).first()[0] or 0
    n = -(-words // SHARD_WORDS) or 1
    return [lambda k=k: [(r["id"], r["text"].encode()) for r in rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).toLocalIterator()] for k in range(n)]


def find_hits(
    docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW, item_id: str = "item_id", item_text: str = "text", then: Callable[[pa.RecordBatch], pa.RecordBatch] = lambda b: b
) -> DataFrame:
    """docs with n_words, hit_spans (word ranges) and hit_items (sorted as strings). `then` is done to the batches of the last pass, in its tasks."""
    spark = docs.sparkSession
    new = ("n_words", "hit_spans", "hit_items")
    out = docs.drop(*new).select("*", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<array<long>>").alias("hit_spans"), F.array().cast("array<string>").alias("hit_items"))
    shards = _shards(items, item_id, item_text)
    for k, shard in enumerate(shards):
        if k:
            out = stored(out, "decontamination")
        automaton = spark.sparkContext.broadcast(Automaton(shard(), window))

        def scan(batches: Iterator[pa.RecordBatch], automaton=automaton, finish=then if k == len(shards) - 1 else lambda b: b) -> Iterator[pa.RecordBatch]:
            for b in batches:
                hits = list(automaton.value.scan(utf8(b.column(text))))
                spans = [merged([*map(tuple, old), *h.spans]) for old, h in zip(b.column("hit_spans").to_pylist(), hits, strict=True)]
                names = [sorted({*old, *h.items}) for old, h in zip(b.column("hit_items").to_pylist(), hits, strict=True)]
                fresh = {"n_words": pa.array([h.n_words for h in hits], pa.int64()), "hit_spans": pa.array([[list(s) for s in x] for x in spans], pa.list_(pa.list_(pa.int64()))), "hit_items": pa.array(names, pa.list_(pa.string()))}
                yield finish(pa.RecordBatch.from_arrays([fresh.get(c, b.column(c)) for c in b.schema.names], names=b.schema.names))

        out = map_arrow(out, scan, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields))
    return out


def n_hit():
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])


def contaminated():
    """The rule: some word is hit, and at least one in twenty."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))


def remove_spans(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW, longest: int = 50, coverage: float = 0.05) -> DataFrame:
    """docs without rows whose hit share reaches `coverage`; from the others, spans of over `longest` words are cut."""
    share = Fraction(str(coverage))  # as floats, 0.05 * 140 is above 7
    least, of = share.numerator, share.denominator

    def cut(b: pa.RecordBatch) -> pa.RecordBatch:
        raw, keep = b.column(text).to_pylist(), []
        for i, (n, spans) in enumerate(zip(b.column("n_words").to_pylist(), b.column("hit_spans").to_pylist(), strict=True)):
            hit = sum(e - s for s, e in spans)
            keep.append(hit == 0 or of * hit < least * n)
            if keep[-1] and (big := [tuple(s) for s in spans if s[1] - s[0] > longest]):
                raw[i] = without(raw[i].encode(), big).decode()
        return pa.RecordBatch.from_arrays([pa.array(raw, pa.string()) if c == text else b.column(c) for c in b.schema.names], names=b.schema.names).filter(pa.array(keep, pa.bool_()))

    return find_hits(docs, items, text, window, then=cut).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    names = F.array_join("hit_items", ",")
    return find_hits(docs, items).select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"), F.sha2(names.cast("binary"), 256).alias("items_sha256"), contaminated().alias("contaminated")
    )


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
v AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
p AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM v) WHERE len(w) >= n)),
m AS (SELECT doc_id, i, p.n, item_id FROM p JOIN v ON p.g = v.g AND p.n = v.n),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
