"""N-gram Jaccard join by parity sketches.

A document's set is that of its distinct shingles of `width` words; with fewer words, the whole sequence.
Two documents link when the intersection is at least `percent` hundredths of the union.

Sketches: each shingle's hash is XORed into one block of a sketch, so a shingle in both of two sets cancels
out, and at most as many blocks differ as the symmetric difference has shingles. Sizes fall into bands;
for a band the largest symmetric difference D of a linking pair is known, and the sketch has k > D + 1
blocks. A linking pair has at least k - D blocks alike, so it still has one when each side leaves out its
k - D - 1 blocks of fewest shingles (a block's count and value order blocks alike on both sides). The D + 1
kept blocks are the join's keys. A document joins in its own band and in those of smaller partners.
Candidates are thinned by sizes and by a second sketch, of SKETCH_BITS parity bits, whose Hamming distance
cannot be above the symmetric difference; then whole sets are compared.

Equal sets become one class first. Of the documents that share a key only the pairs with two pivots, the
least and the greatest id, are compared; those link most of a group of near copies at once. Keys whose other documents
then lie in several components are unsettled: where one has more than PAIRED documents, other pivots are taken, TURNS times at
most; after that all pairs that share a key, lie in different components and were not compared yet are compared, in
blocks of PAIRED documents, so no component is missed and no task holds more than two blocks.
The number of links is counted after that, over all pairs of different sets of a component.

Null and empty texts have the empty set, link with nothing and are components of their own. Rows that
repeat an id are one document with several texts, in one component. A null id has a null component.
Hashes have 64 bits, a set's name 128: a false link needs a collision within one pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quadrille.llm.common import BROADCAST_LIMIT_BYTES, lookup, map_arrow, stored
from quadrille.llm.words import WHITE, mix, shingles, utf8, words_of

SKETCH_BITS = 1024
#: Sets and their shingles in a block of link_counts(), about; COLUMNS hashes are multiplied at once; a hash that more than DENSE pairs share is.
BLOCK_SETS, BLOCK_SHINGLES = 512, 1 << 21
COLUMNS, DENSE = 2048, 64
#: Documents of an unsettled key that are compared in one block; turns of other pivots for larger keys.
PAIRED, TURNS = 256, 1
_U = np.uint64


@lru_cache(maxsize=4)
def _bands(percent: int) -> tuple[list[int], list[int]]:
    """First sizes of the bands, up to 2^40, and the largest symmetric difference of a pair whose smaller set is in the band."""
    first = [1]
    while first[-1] < 1 << 40:
        first.append(max(first[-1] + 1, -(-first[-1] * 100 // percent), first[-1] * 5 // 4))
    # as the larger set has at most 100 / percent times the smaller one's shingles
    most = [(top - 1) * (100 - percent) // percent for top in first[1:]]
    return first, most


def join_keys(s: np.ndarray, percent: int) -> np.ndarray:
    """The keys of a set, given as sorted distinct hashes."""
    n = len(s)
    if not n:
        return np.empty(0, _U)
    first, most = _bands(percent)
    low = int(np.searchsorted(first, -(-n * percent // 100), "right")) - 1
    high = int(np.searchsorted(first, n, "right")) - 1
    out = []
    place, value = s >> _U(32), mix(s ^ _U(0x5851F42D4C957F2D))
    for band in range(low, high + 1):
        d = most[band]
        if d == 0:
            continue  # only equal sets link here
        k = (3 * (d + 1) + 1) // 2
        block = (place * _U(k)) >> _U(32)
        # s is sorted, so its blocks are in order
        cut = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        index, count = block[cut], np.diff(np.concatenate((cut, [n])))
        xor = np.bitwise_xor.reduceat(value, cut)
        if len(index) < k:
            none = np.setdiff1d(np.arange(k, dtype=np.uint64), index)
            index, count, xor = np.concatenate((index, none)), np.concatenate((count, np.zeros(len(none), np.int64))), np.concatenate((xor, np.zeros(len(none), _U)))
        key = mix(xor ^ mix(index + _U((band + 1) << 40)))
        out.append(key[np.lexsort((key, -count))[: d + 1]])
    return np.concatenate(out) if out else np.empty(0, _U)


def parity(s: np.ndarray) -> np.ndarray:
    bits = np.bincount((mix(s) & _U(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def name_of(s: np.ndarray) -> bytes | None:
    """A name of 128 bits of a set; none of the empty one."""
    return np.array([s.sum(dtype=_U), mix(s + _U(0x632BE59BD9B4E019)).sum(dtype=_U) ^ _U(len(s))]).tobytes() if len(s) else None


def sketches(docs: DataFrame, width: int, percent: int, id: str, text: str) -> DataFrame:
    """(id, n, sid, parity) of each document; sid names its set."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("id")
            for a, z, bounds, h in words_of(utf8(b.column("text")), WHITE):
                n, sid, bits = [], [], []
                for s in shingles(h, bounds, width):
                    n.append(len(s))
                    sid.append(name_of(s))
                    bits.append(parity(s))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, z - a), pa.array(n, pa.int64()), pa.array(sid, pa.binary()), pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1) * (SKETCH_BITS // 64), pa.int32()), pa.array(np.concatenate(bits), pa.int64()))],
                    names=["id", "n", "sid", "parity"],
                )

    return map_arrow(docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")), each, "id long, n long, sid binary, parity array<long>")


def key_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(key, id) of documents (id, text). The keys are several times the sketches' size, so they are made again where they are read, and not stored."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("id")
            for a, z, bounds, h in words_of(utf8(b.column("text")), WHITE):
                keys = [join_keys(s, percent).view(np.int64) for s in shingles(h, bounds, width)]
                lengths = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate(keys), pa.int64())), ids.slice(a, z - a)], names=["keys", "id"])

    return map_arrow(docs.select("id", "text"), each, "keys array<long>, id long").select(F.explode("keys").alias("key"), "id")


def _verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int, id: str, text: str) -> DataFrame:
    """Those of the pairs (a, b) that link."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct()
    small = needed.count() * 32 <= BROADCAST_LIMIT_BYTES
    chosen = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).join(F.broadcast(needed) if small else needed, F.col("id") == F.col("_id"), "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z, bounds, h in words_of(utf8(b.column("text")), WHITE):
                yield pa.RecordBatch.from_arrays([b.column("id").slice(a, z - a), pa.array([s.tobytes() for s in shingles(h, bounds, width)], pa.binary())], names=["id", "s"])

    table = stored(map_arrow(chosen, sets, "id long, s binary"), "jaccard-sets")
    both = pairs.join(table.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b").join(table.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("sa"), b.column("sb"), strict=True):
                u, v = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                whole = np.concatenate((u, v))
                whole.sort(kind="stable")
                same = int((whole[1:] == whole[:-1]).sum())
                keep.append(100 * same >= percent * (len(whole) - same))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(mask), b.column("b").filter(mask)], names=["a", "b"])

    return stored(map_arrow(both.select("a", "b", "sa", "sb"), compare, "a long, b long").distinct(), "jaccard-links")


def _possible(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs with na, nb, pa, pb whose sizes and parities allow a link."""
    far = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return pairs.where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & ((100 + percent) * far <= (100 - percent) * (F.col("na") + F.col("nb"))))


def components(links: DataFrame) -> DataFrame:
    """(id, component): the least id that links (a, b) reach. Ids without links are absent."""
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "component-links")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("component")), "component-labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("m"))
        step = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "m").alias("c"))
        up = labels.select(F.col("id").alias("c"), F.col("component").alias("cc"))
        new = stored(step.join(up, "c", "left").select("id", "old", F.least("c", F.coalesce("cc", "c")).alias("component")), "component-labels")
        changed = new.where("component <> old").limit(1).count()
        labels = new.drop("old")
        if not changed:
            return labels


def set_rows(docs: DataFrame, width: int) -> DataFrame:
    """(sid, s) of documents (id, text): the set's name and its sorted hashes as bytes."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, bounds, h in words_of(utf8(b.column("text")), WHITE):
                sets = list(shingles(h, bounds, width))
                yield pa.RecordBatch.from_arrays([pa.array([name_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["sid", "s"])

    return map_arrow(docs.select("text"), each, "sid binary, s binary")


def linked(u: list[np.ndarray], v: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sets u link with which of the sets v, as a matrix."""
    n, m = (np.array([len(s) for s in x], np.int64) for x in (u, v))
    common, where = np.unique(np.concatenate(u), return_inverse=True)
    row = np.repeat(np.arange(len(u)), n)
    other = np.concatenate(v)
    at = np.minimum(np.searchsorted(common, other), len(common) - 1)
    met = common[at] == other
    col, other = np.repeat(np.arange(len(v)), m)[met], at[met]
    # hashes in the order of their use; those of few sets are counted one by one, others a matrix of COLUMNS of them at a time
    used = np.bincount(other, minlength=len(common))
    by_u, by_v = np.argsort(where, kind="stable"), np.argsort(other, kind="stable")
    row, where, col, other = row[by_u], where[by_u], col[by_v], other[by_v]
    weight = np.bincount(where, minlength=len(common)) * used
    dense = weight > DENSE
    same = np.zeros(len(u) * len(v), np.int64)
    # rare hashes: all pairs of a hash's sets
    starts = np.concatenate(([0], np.cumsum(used)))
    rare = np.flatnonzero(~dense[where] & (used[where] > 0))
    for a in range(0, len(rare), 1 << 14):
        i = rare[a : a + (1 << 14)]
        k = used[where[i]]
        j = np.repeat(starts[where[i]] - np.cumsum(k) + k, k) + np.arange(int(k.sum()))
        same += np.bincount(np.repeat(row[i], k) * len(v) + col[j], minlength=len(same))
    same = same.reshape(len(u), len(v))
    often = np.flatnonzero(dense)
    for a in range(0, len(often), COLUMNS):
        part = often[a : a + COLUMNS]
        place = np.full(len(common), -1, np.int64)
        place[part] = np.arange(len(part))
        x, y = np.zeros((len(u), len(part)), np.float32), np.zeros((len(v), len(part)), np.float32)
        i, j = place[where] >= 0, place[other] >= 0
        x[row[i], place[where[i]]] = 1
        y[col[j], place[other[j]]] = 1
        same += (x @ y.T).astype(np.int64)
    return 100 * same >= percent * (n[:, None] + m[None, :] - same)


def link_counts(members: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(sid, links) of the classes (sid, id, n, component): how many others link with each. docs: (id, text).

    Linking sets lie in one component, so all pairs of a component are compared, once: its classes are dealt by their
    names to blocks, and each two blocks meet in a task of their own. The work grows with the square of a component."""
    groups = members.groupBy("component").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("size")).where("k > 1")
    blocks = groups.select("component", F.ceil(F.greatest(F.col("k") / BLOCK_SETS, F.col("size") / BLOCK_SHINGLES)).cast("long").alias("of"))
    dealt = members.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("sid"), F.col("of"))).select("sid", "id", "component", "of", "block")
    dealt = stored(dealt, "jaccard-blocks")
    needed = dealt.select("id").distinct()
    sets = set_rows(docs.join(F.broadcast(needed) if needed.count() * 32 <= BROADCAST_LIMIT_BYTES else needed, "id", "left_semi"), width)
    rows = stored(dealt.join(sets.dropDuplicates(["sid"]), "sid"), "jaccard-sets")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("of") - 1))
    met = rows.withColumn("o", other).select("component", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "sid", "s")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, ([], [])

        def done() -> pa.RecordBatch:
            (a, u), (b, v) = (([x for x, _ in h], [np.frombuffer(y, _U) for _, y in h]) for h in held)
            if key[1] == key[2]:
                n = linked(u, u, percent).sum(axis=1) - 1  # each set links with itself
                return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(n, pa.int64())], names=["sid", "links"])
            links = linked(u, v, percent) if u and v else np.zeros((len(u), len(v)), bool)
            return pa.RecordBatch.from_arrays([pa.array(a + b, pa.binary()), pa.array(np.concatenate((links.sum(axis=1), links.sum(axis=0))), pa.int64())], names=["sid", "links"])

        for batch in batches:
            for c, i, j, block, sid, s in zip(*(batch.column(x).to_pylist() for x in ("component", "i", "j", "block", "sid", "s")), strict=True):
                if (c, i, j) != key:
                    if key is not None:
                        yield done()
                    key, held = (c, i, j), ([], [])
                held[block != i].append((sid, s))
        if key is not None:
            yield done()

    grouped = met.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    return map_arrow(grouped, count, "sid binary, links long").groupBy("sid").agg(F.sum("links").alias("links"))


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text", links: bool = True) -> DataFrame:
    """(id, n_shingles, component_id, links): a row for each row of docs. links counts the other distinct sets that link with the row's;
    it is left out, and not counted, if links is False."""
    counted = links
    every = stored(sketches(docs, width, percent, id, text), "jaccard-sketches")
    total = every.count()
    # one row for each distinct set; the least id stands for all
    one = every.where("n > 0 and id is not null").groupBy("sid").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "n", "parity")).alias("r"))
    classes = stored(one.select("sid", "copies", "r.*"), "jaccard-classes")
    named = stored(lookup(every.select("id", "n", "sid"), classes.select("sid", "copies", F.col("id").alias("rep")), "sid", "copies", total).select("id", "n", "sid", F.coalesce("rep", "id").alias("rep")), "jaccard-named")

    # keys of the classes' own documents; the others are left out, by a list of them if it is short
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    copies = named.where("rep <> id or n = 0").select("id").join(classes.select("id"), "id", "left_anti")
    if copies.count() * 32 <= BROADCAST_LIMIT_BYTES:
        texts = texts.where("id is not null").join(F.broadcast(copies), "id", "left_anti")
    else:
        texts = texts.join(classes.select("id"), "id", "left_semi")
    # the keys are dealt once, whatever their number: each row meets its key's pivots where they are found
    own = Window.partitionBy("key")
    rows = key_rows(texts, width, percent).select("key", "id", F.min("id").over(own).alias("p1"), F.max("id").over(own).alias("p2"))
    members = stored(rows.where("p1 < p2"), "jaccard-members")
    sizes = classes.select("id", "n", "parity")

    def measured(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(sizes.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("parity").alias(f"p{side}")), side)
        return pairs

    met = members.select("id", F.explode(F.array("p1", "p2")).alias("p")).where("id <> p").select(F.least("id", "p").alias("a"), F.greatest("id", "p").alias("b")).distinct()
    tested = stored(_possible(measured(met), percent).select("a", "b"), "jaccard-pairs")
    links = _verified(tested, docs, width, percent, id, text)
    # an id that repeats with other texts joins its classes
    repeated = every.where("n > 0 and id is not null").groupBy("id").agg(F.count_distinct("sid").alias("k")).where("k > 1").select("id")
    again = named.join(F.broadcast(repeated) if repeated.limit(100_001).count() <= 100_000 else repeated, "id", "left_semi").where("rep <> id").select(F.least("id", "rep").alias("a"), F.greatest("id", "rep").alias("b")).distinct()
    found = components(links.unionByName(again))

    # what the pivots left: keys whose other documents lie in several components; the pivots were compared with all of them
    def unsettled(rows: DataFrame) -> DataFrame:
        known = found.select("id", F.col("component").alias("c"))
        known = F.broadcast(known) if known.count() * 32 <= BROADCAST_LIMIT_BYTES else known
        now = rows.select("key", "id").join(known, "id", "left").withColumn("c", F.coalesce("c", "id"))
        several = now.select("*", F.min("c").over(own).alias("c1"), F.max("c").over(own).alias("c2"), F.count(F.lit(1)).over(own).alias("m"))
        return stored(several.where("c1 <> c2").select("key", "id", "c", "m"), "jaccard-left")

    def compared(pairs: DataFrame) -> None:
        nonlocal tested, links, found
        fresh = stored(_possible(measured(pairs.distinct()), percent).select("a", "b").join(tested, ["a", "b"], "left_anti"), "jaccard-pairs")
        tested = tested.unionByName(fresh)
        links = stored(links.unionByName(_verified(fresh, docs, width, percent, id, text)), "jaccard-links")
        found = components(links.unionByName(again))

    left = unsettled(members.where("id <> p1 and id <> p2"))
    for turn in range(TURNS):
        large = left.where(F.col("m") > PAIRED)
        if not large.limit(1).count():
            break
        by = F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), F.col("id").alias("id"), F.col("c").alias("c"))
        pivot = large.groupBy("key").agg(F.min(by).alias("p1"), F.max(by).alias("p2")).select("key", F.explode(F.array("p1", "p2")).alias("p"))
        compared(large.join(pivot, "key").where("c <> p.c").select(F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b")))
        left = unsettled(left)
    if left.limit(1).count():
        dealt = left.join(sizes, "id").withColumn("of", F.ceil(F.col("m") / PAIRED).cast("long")).withColumn("block", F.pmod(F.xxhash64("id"), F.col("of")))
        dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("of") - 1))).withColumns({"i": F.least("block", "o"), "j": F.greatest("block", "o")})
        one, other = (dealt.select("key", "i", "j", *[F.col(c).alias(f"{c}{side}") for c in ("id", "c", "n", "parity", "block")]) for side in ("1", "2"))
        near = one.join(other, ["key", "i", "j"]).where("c1 <> c2 and (block1 < block2 or block1 = block2 and i = j and id1 < id2)")
        near = _possible(near.withColumnsRenamed({"n1": "na", "n2": "nb", "parity1": "pa", "parity2": "pb"}), percent)
        compared(near.select(F.least("id1", "id2").alias("a"), F.greatest("id1", "id2").alias("b")))
    # an id that stands for several of its texts is one row of these
    known = found.join(classes.groupBy("id").agg(F.sum("copies").alias("copies")), "id").withColumnRenamed("id", "rep")
    out = lookup(named.withColumn("rep_", F.col("rep")), stored(known, "jaccard-found"), "rep", "copies", total)
    made = [F.col("id").alias(id), F.col("n").alias("n_shingles"), F.coalesce("component", "rep_").alias("component_id")]
    if not counted:
        return out.select(*made)
    counts = link_counts(classes.join(found, "id").select("sid", "id", "n", "component"), docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")), width, percent)
    return lookup(out.drop("copies"), stored(counts.join(classes.select("sid", "copies"), "sid"), "jaccard-counts"), "sid", "copies", total).select(*made, F.coalesce("links", F.lit(0).cast("long")).alias("links"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_components(docs, 3, 90, links=False)


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + least(3, len(w)) - 1], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 90 * (na.n + nb.n - k)),
f AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS t FROM d UNION SELECT r.doc_id, f.b FROM r JOIN f ON r.t = f.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.t) AS component_id FROM d JOIN r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""
