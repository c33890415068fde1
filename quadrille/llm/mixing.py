"""Mixing sources to target weights by a low-discrepancy schedule.

Sources get weights by their rank; their targets share the total, stop at `most` times their size, and what
is above is shared anew. Slot i of the schedule is the golden-ratio point frac(i * 0.618...), mapped through
the cumulative targets to a source. A source's slots are ranked; the slot of rank r takes the block of
words [r * block, (r + 1) * block) of the source's documents, shuffled by a hash and laid end to end, over and
over; the last block is cut where the target is reached, and slots beyond that are void. So each source gets
its target to a word, spread evenly over the schedule, and no document is taken more than `most` times.

mix_plan() has the words of each document that each slot takes. mix_documents() keeps the words of a document
together: a row stands at the slot of its first word, and rows are sorted by slot.

Word: [^\\x20\\x09-\\x0D]+. Null and empty texts have no words and are not taken. The null source is a source,
the last. Rows that repeat an id are documents of their own; those of one text, too, are interchangeable. No rows, or
rows without words, give targets of 0. Other columns stay in mix_documents(), and are left out of mix_plan().

Positions are sums over hash ranges of about BUCKET_ROWS documents, so a source that has a third of
all rows is spread over as many tasks as its rows need. The hash is of id and text, so rows that share an id, or have none,
are spread as well; only rows that are equal in both stay together.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import partial
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quadrille.llm.common import map_arrow, stored
from quadrille.llm.words import utf8

WEIGHTS = (5, 2, 1)
GOLDEN = 0.6180339887498949
#: The block is as long as makes about this many slots, but of no more words than BLOCK_WORDS; so from some four million
#: million words on the schedule grows with the input, by three numbers for a block.
SLOTS = 1 << 18
BLOCK_WORDS = 1 << 24
BUCKET_ROWS = 250
#: Bits of the finest ranges that are counted, and of the coarse ones, whose sums are taken first.
FINE, COARSE = 26, 12
#: One row for each source reaches the driver.
MAX_SOURCES = 1_000_000
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_LAST = "\U0010ffff\U0010ffff"  # the key of the null source


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, most: int = 3, share: Fraction = Fraction(1)) -> list[Fraction]:
    """Of sources in order."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    total = share * sum(sizes)
    out: dict[int, Fraction] = {}
    free = [i for i, s in enumerate(sizes) if s]
    while free:
        unit = (total - sum(out.values())) / sum(weight[i] for i in free)
        above = [i for i in free if unit * weight[i] > most * sizes[i]]
        if not above:
            return [out.get(i, unit * weight[i] if sizes[i] else Fraction(0)) for i in range(len(sizes))]
        out |= {i: Fraction(most * sizes[i]) for i in above}
        free = [i for i in free if i not in out]
    return [out.get(i, Fraction(0)) for i in range(len(sizes))]


def schedule(wanted: list[int], block: int) -> pd.DataFrame:
    """Slots (slot, source, rank, start, end): words of the source's endless stream. wanted: words of each source."""
    need = np.array([-(-w // block) for w in wanted], np.int64)
    bounds = np.cumsum(np.array(wanted, np.float64))
    n = int(need.sum())
    if not n:
        return pd.DataFrame({k: pd.Series(dtype="int64") for k in ("slot", "source", "rank", "start", "end")})
    while True:  # until each source has its blocks; a few steps, as the points are spread evenly
        u = np.arange(1, n + 1) * GOLDEN % 1.0
        source = np.minimum(np.searchsorted(bounds, u * bounds[-1], "right"), len(wanted) - 1)
        if (np.bincount(source, minlength=len(wanted)) >= need).all() or n > 64 * need.sum() + 1024:
            break
        n += max(16, n // 8)
    order = np.argsort(source, kind="stable")
    first = np.concatenate(([0], np.cumsum(np.bincount(source, minlength=len(wanted)))))
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n) - first[source[order]]
    keep = rank < need[source]
    slot, source, rank = np.flatnonzero(keep), source[keep], rank[keep]
    # sources too small for the points met so far go to the end
    have = np.bincount(source, minlength=len(wanted))
    more = need - have
    late = np.repeat(np.arange(len(wanted)), more)
    slot, source = np.concatenate((slot, n + np.arange(len(late)))), np.concatenate((source, late))
    rank = np.concatenate((rank, have[late] + np.arange(len(late)) - np.repeat(np.cumsum(more) - more, more)))
    end = np.minimum((rank + 1) * block, np.array(wanted, np.int64)[source])
    return pd.DataFrame({"slot": slot, "source": source, "rank": rank, "start": rank * block, "end": end})


def _measured(docs: DataFrame, id: str, text: str, source: str, seed: str) -> DataFrame:
    """docs with _size, _key (the source's) and _h, by which a source's documents are shuffled."""
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    named = F.concat(F.coalesce(F.col(id).cast("string"), F.lit("-")), F.lit(f":{seed}:"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    return docs.select("*", words.alias("_size"), F.coalesce(F.col(source).cast("string"), F.lit(_LAST)).alias("_key"), F.md5(named.cast("binary")).alias("_h"))


def _positions(rows: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """rows with _at (words before, in the source's shuffled order), without _h; the sources' sizes."""
    place = F.conv(F.substring("_h", 1, 8), 16, 10).cast("long")
    fine = stored(rows.groupBy("_key", F.shiftright(place, 32 - FINE).alias("_f")).agg(F.sum("_size").alias("_n"), F.count(F.lit(1)).alias("_rows")), "mix-ranges")
    counted = fine.groupBy("_key").agg(F.sum("_n").alias("n"), F.sum("_rows").alias("rows")).limit(MAX_SOURCES + 1).collect()
    if len(counted) > MAX_SOURCES:
        raise ValueError(f"over {MAX_SOURCES} sources")
    bits = min(FINE, max(0, (sum(r["rows"] for r in counted) // BUCKET_ROWS).bit_length()))
    low = max(0, bits - COARSE)
    sums = fine.groupBy("_key", F.shiftright("_f", FINE - bits).alias("_b")).agg(F.sum("_n").alias("_n")).withColumn("_c", F.shiftright("_b", low))
    # two levels, so that no source's ranges are all in one task
    top = sums.groupBy("_key", "_c").agg(F.sum("_n").alias("_m"))
    top = top.select("_key", "_c", (F.sum("_m").over(Window.partitionBy("_key").orderBy("_c")) - F.col("_m")).alias("_top"))
    inner = sums.withColumn("_before", F.sum("_n").over(Window.partitionBy("_key", "_c").orderBy("_b")) - F.col("_n"))
    before = inner.join(top, ["_key", "_c"]).select("_key", "_b", (F.col("_top") + F.col("_before")).alias("_before"))
    order = Window.partitionBy("_key", "_b").orderBy("_h").rowsBetween(Window.unboundedPreceding, 0)
    at = rows.withColumn("_b", F.shiftright(place, 32 - bits)).join(before, ["_key", "_b"]).withColumn("_at", F.col("_before") + F.sum("_size").over(order) - F.col("_size"))
    return at.drop("_before", "_b", "_h"), {r["_key"]: r["n"] for r in counted}


def _planned(measured: DataFrame, weights: tuple[int, ...], most: int, slots: int) -> tuple[DataFrame, Callable[..., tuple]]:
    """Rows with _size, _at, _source_size, _target, _first (number of the source's slots before rank 0) and _need (its slots); what joins them with the slots."""
    spark = measured.sparkSession
    at, found = _positions(measured)
    names = sorted(found, key=lambda s: s.encode())
    sizes = [found[s] for s in names]
    goal = targets(sizes, weights, most)
    wanted = [int(round(g)) for g in goal]
    block = min(BLOCK_WORDS, max(1, sum(wanted) // slots))
    plan = schedule(wanted, block).sort_values(["source", "rank"])
    need = np.bincount(plan["source"].to_numpy(np.int64), minlength=len(names))[: len(names)]
    first = np.cumsum(need) - need
    table = spark.createDataFrame([(s, n, float(g), int(f), int(k)) for s, n, g, f, k in zip(names, sizes, goal, first, need, strict=True)] or [], "_key string, _source_size long, _target double, _first long, _need long")
    rows = at.join(F.broadcast(table) if len(names) <= 100_000 else table, "_key")
    return rows, partial(_pieces, block, *(plan[c].to_numpy(np.int64) for c in ("slot", "start", "end")))


def _pieces(block: int, slot: np.ndarray, start: np.ndarray, end: np.ndarray, at: np.ndarray, size: np.ndarray, total: np.ndarray, first: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, copy, slot, from, to) of what the slots take of documents, by row, copy and word; from and to are words of the document.

    slot, start, end: of the slots by source and rank. A document of _size words at _at of a stream of total words
    is met at _at, total + _at, and so on; first and need say where the source's slots are."""
    some = (size > 0) & (need > 0)
    stop = np.zeros(len(at), np.int64)  # words of the stream that slots take
    stop[some] = end[(first + need - 1)[some]]
    copies = np.zeros(len(at), np.int64)
    copies[some] = -(-(stop - at)[some] // total[some])
    copies = np.maximum(copies, 0)
    row = np.repeat(np.arange(len(at)), copies)
    copy = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
    low = copy * total[row] + at[row]
    high = np.minimum(low + size[row], stop[row])
    rank = low // block
    n = (high - 1) // block - rank + 1
    k = np.repeat(np.arange(len(row)), n)
    i = first[row[k]] + rank[k] + np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
    return row[k], copy[k], slot[i], np.maximum(low[k], start[i]) - low[k], np.minimum(high[k], end[i]) - low[k]


_PLACE = ("_at", "_size", "_source_size", "_first", "_need")


def mix_plan(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = 3, seed: str = "mix", slots: int = SLOTS) -> DataFrame:
    """(id, size, source_size, target, taken, source, slots) of each document. slots: (slot, start, end), the words of the document that slots take, copy by copy."""
    # texts are read once, and what the plan needs of them is kept; the columns have names of this module's own
    named = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"), F.col(source).alias("_source"))
    measured = stored(_measured(named, "_id", "_text", "_source", seed).drop("_text"), "mix-sizes")
    rows, pieces = _planned(measured, weights, most, slots)
    rows = rows.select("_id", "_source", "_target", *_PLACE)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, _, slot, start, end = pieces(*(b.column(c).to_numpy() for c in _PLACE))
            taken = np.zeros(b.num_rows, np.int64)
            np.add.at(taken, row, end - start)
            bounds = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=b.num_rows))))
            parts = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (slot, start, end)], names=["slot", "start", "end"])
            found = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), parts)
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_size"), b.column("_source_size"), b.column("_target"), pa.array(taken), b.column("_source"), found], names=["id", "size", "source_size", "target", "taken", "source", "slots"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    out = map_arrow(rows, each, f"id {kinds[id]}, size long, source_size long, target double, taken long, source {kinds[source]}, slots array<struct<slot: long, start: long, end: long>>")
    return out.withColumnsRenamed({"id": id, "source": source})


def mix_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = 3, seed: str = "mix", slots: int = SLOTS) -> DataFrame:
    """The mix in the order of the schedule, with the columns of docs. A row for each time that slots take of a document, at the slot
    of its first word: the document, or where the source's last block ends within it, its words up to there."""
    names = docs.columns
    # columns by number, so that none clashes with those made here
    held = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    at_ = {c: f"c{names.index(c)}" for c in (id, text, source)}
    rows, pieces = _planned(_measured(held, at_[id], at_[text], at_[source], seed), weights, most, slots)
    fields = held.schema.fields
    names, text = held.columns, at_[text]
    rows = rows.select(*names, *_PLACE)

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, size, *place = (b.column(c).to_numpy() for c in _PLACE)
            row, copy, slot, _, end = pieces(at, size, *place)
            # the pieces of one copy follow one another: its first says where it stands, its last where it ends
            new = np.concatenate(([True], (row[1:] != row[:-1]) | (copy[1:] != copy[:-1]))) if len(row) else np.zeros(0, bool)
            begin = np.flatnonzero(new)
            row, slot, end = row[begin], slot[begin], np.maximum.reduceat(end, begin) if len(begin) else end
            turn = copy[begin] if len(begin) else copy
            # copies one by one, as texts are long
            for k in range(int(turn.max(initial=-1)) + 1):
                of = turn == k
                r, n = row[of], end[of]
                kept = b.select(names).take(pa.array(r))
                cut = np.flatnonzero(n < size[r])
                if len(cut):
                    texts = kept.column(text).to_pylist()
                    for j, raw in zip(cut.tolist(), utf8(kept.column(text).take(pa.array(cut))), strict=True):
                        *_, m = islice(_WORDS.finditer(raw), int(n[j]))
                        texts[j] = raw[: m.end()].decode()
                    kept = kept.set_column(names.index(text), text, pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(slot[of]), pa.array(k * place[0][r] + at[r])], names=[*names, "_slot", "_from"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "_slot long, _from long"])
    mixed = map_arrow(rows, copies, schema).orderBy("_slot", "_from").select(*names)
    return mixed.toDF(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return mix_plan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("source", "slots")


#: The slots of a source cover the first `wanted` words of its stream, so what they take of a document follows from where it lies.
SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':mix:' || md5(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY h ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS pos FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY 3.0 * n / w, source NULLS LAST) AS k FROM s WHERE n > 0),
c AS (SELECT *, CAST((SELECT sum(n) FROM s) - coalesce(sum(3 * n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest,
    CAST(sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS ws FROM r),
f AS (SELECT k, rest, ws FROM c WHERE rest * w <= 3 * n * ws ORDER BY k LIMIT 1),
t AS (SELECT c.source, c.n, CASE WHEN c.k < f.k THEN 3 * c.n * f.ws ELSE c.w * f.rest END AS num, f.ws AS den FROM c, f),
g AS (SELECT source, n, num / den AS target, num // den + CASE WHEN 2 * (num % den) > den OR 2 * (num % den) = den AND (num // den) % 2 = 1 THEN 1 ELSE 0 END AS wanted FROM t)
SELECT doc_id, CAST(size AS BIGINT) AS size, coalesce(n, 0) AS source_size, coalesce(target, 0.0) AS target,
    CAST(CASE WHEN coalesce(n, 0) = 0 THEN 0 ELSE wanted // n * size + greatest(0, least(size, wanted % n - pos)) END AS BIGINT) AS taken
FROM p LEFT JOIN g ON p.source IS NOT DISTINCT FROM g.source
"""
