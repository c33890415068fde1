"""A read-only store of quads in Parquet, and its graphs."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.engine import query as run_query
from quadrille.plans.compiler import DEFAULT, Scope
from quadrille.sources.nquads import read_nquads
from quadrille.sources.quads import CodedSource, QuadSource
from quadrille.terms import BAD_IRI, Blank, Iri, Literal, Term

LAYOUTS = ("spelled", "dictionary")
#: Predicates whose statements are counted for the order of joins, the most frequent ones.
KNOWN_PREDICATES = 10_000


class ReadOnly(TypeError):
    pass


@dataclass(frozen=True)
class Options:
    """in_memory: keep the quads cached. union: the default graph is the set of all graphs' triples."""

    in_memory: bool = False
    union: bool = True


def canonical_literals(quads: DataFrame) -> DataFrame:
    """Objects with their canonical spelling, for stores whose DISTINCT goes by value: 042 and 42 are one integer."""
    from quadrille.functions.values import Val, is_literal, let, number, term, written_datatype

    o = F.col("o")
    n = number(Val("term", o))
    # the value is written back under its own datatype
    text = let(n, lambda x: F.when(x["r"] == 0, F.regexp_replace(F.regexp_extract(o, r'^"\+?(-?)0*([0-9]+)"', 0), r'^"\+?(-?)0*([0-9]+)"', "$1$2")).otherwise(F.regexp_extract(term(Val("num", x)), r'^"([^"]*)"', 1)))
    spelled = F.concat(F.lit('"'), text, F.lit('"^^<'), written_datatype(o), F.lit(">"))
    return quads.withColumn("o", F.when(is_literal(o) & n.isNotNull(), F.coalesce(spelled, o)).otherwise(o)).distinct()


def build(spark: SparkSession, quads: DataFrame | str, path: str, layout: str = "spelled", normalize_literals: bool = False, by_object: bool = False) -> None:
    """Writes a store. quads: (s, p, o, g), or the path of N-Quads text.

    spelled: terms in the quads, which are laid out by predicate and sorted by subject; by_object adds a copy sorted by object.
    dictionary: numbers in the quads, and a table of terms, the numbers in the terms' order."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout: one of {LAYOUTS}")
    df = read_nquads(spark, quads) if isinstance(quads, str) else quads.select("s", "p", "o", "g").distinct()
    if normalize_literals:
        df = canonical_literals(df)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    raw = f"{path}/quads"
    if layout == "spelled":
        # ranges over (p, s) keep a frequent predicate from being one partition
        df.repartitionByRange(parts, "p", "s").sortWithinPartitions("p", "s").write.mode("overwrite").parquet(raw)
        if by_object:
            spark.read.parquet(raw).repartitionByRange(parts, "p", "o").sortWithinPartitions("p", "o").write.mode("overwrite").parquet(f"{path}/by_object")
    else:
        df.write.mode("overwrite").parquet(f"{path}/spelled")
        df = spark.read.parquet(f"{path}/spelled")
        names = df.select(F.explode(F.array("s", "p", "o", "g")).alias("term")).distinct().repartitionByRange(parts, "term").sortWithinPartitions("term")
        names.select(F.spark_partition_id().alias("part"), "term").withColumn("row", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{path}/numbered")
        names = spark.read.schema("part int, term string, row long").parquet(f"{path}/numbered")
        # numbers without gaps: a partition's rows go on from those before it
        sizes = {r["part"]: r["n"] for r in names.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
        starts, at = [], 0
        for p in sorted(sizes):
            starts.append((p, at))
            at += sizes[p]
        first = spark.createDataFrame(starts, "part int, start long")
        coded = names.join(F.broadcast(first), "part").select((F.col("start") + F.col("row").bitwiseAND((1 << 33) - 1)).alias("code"), "term")
        coded.write.mode("overwrite").parquet(f"{path}/terms")
        terms = spark.read.parquet(f"{path}/terms")
        for c in ("s", "p", "o", "g"):
            df = df.join(terms.select(F.col("term").alias(c), F.col("code").alias(f"{c}_code")), c).drop(c).withColumnRenamed(f"{c}_code", c)
        df.select("s", "p", "o", "g").write.mode("overwrite").parquet(raw)
    quads_ = spelled_quads(spark, path, layout)
    counts = {r["p"]: r["n"] for r in quads_.groupBy("p").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).limit(KNOWN_PREDICATES).collect()}
    total = quads_.count()
    repeats = quads_.select("s", "p", "o").distinct().count() != total
    write_meta(spark, path, {"layout": layout, "quads": total, "repeats": repeats, "by_object": by_object and layout == "spelled", "counts": counts})


def write_meta(spark: SparkSession, path: str, meta: dict) -> None:
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_meta")


def read_meta(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/_meta").first()[0])


def spelled_quads(spark: SparkSession, path: str, layout: str) -> DataFrame:
    df = spark.read.parquet(f"{path}/quads")
    if layout == "spelled":
        return df
    terms = spark.read.parquet(f"{path}/terms")
    for c in ("s", "p", "o", "g"):
        df = df.join(terms.select(F.col("code").alias(c), F.col("term").alias(f"{c}_term")), c).drop(c).withColumnRenamed(f"{c}_term", c)
    return df.select("s", "p", "o", "g")


class RdfStore:
    """Reads only. `query` sees the union of all graphs, or, with union=False, the default graph."""

    def __init__(self, spark: SparkSession, quads: DataFrame, options: Options | None = None, meta: dict | None = None, path: str | None = None):
        self.spark, self.options, self.meta, self.path = spark, options or Options(), meta or {}, path
        self.df = quads.cache() if self.options.in_memory else quads
        self.closed = False

    @classmethod
    def open(cls, spark: SparkSession, path: str, **options) -> RdfStore:
        meta = read_meta(spark, path)
        return cls(spark, spelled_quads(spark, path, meta["layout"]), Options(**options), meta, path)

    @classmethod
    def from_rows(cls, spark: SparkSession, rows: list[tuple[str, str, str, str]], **options) -> RdfStore:
        return cls(spark, spark.createDataFrame(rows or [], "s string, p string, o string, g string").distinct(), Options(**options))

    @classmethod
    def from_nquads(cls, spark: SparkSession, path: str, **options) -> RdfStore:
        return cls(spark, read_nquads(spark, path), Options(**options))

    @property
    def layout(self) -> str | None:
        return self.meta.get("layout")

    @property
    def indexes(self) -> list[str]:
        return ["by_object"] if self.meta.get("by_object") else []

    def close(self) -> None:
        self.df.unpersist()
        self.closed = True

    def _open(self) -> None:
        if self.closed:
            raise ValueError("the store is closed")

    def source(self, union: bool | None = None) -> QuadSource:
        self._open()
        union = self.options.union if union is None else union
        repeats, counts = self.meta.get("repeats", True), self.meta.get("counts")
        if self.layout == "dictionary" and not self.options.in_memory:
            return CodedSource(self.spark.read.parquet(f"{self.path}/quads"), self.spark.read.parquet(f"{self.path}/terms"), union, repeats, counts)
        by_object = self.spark.read.parquet(f"{self.path}/by_object") if self.meta.get("by_object") and not self.options.in_memory else None
        return QuadSource(self.df, union, repeats, counts, by_object=by_object)

    def query(self, text: str, bindings: dict[str, Term] | None = None, union: bool | None = None, **more) -> DataFrame:
        return run_query(self.spark, self.source(union), text, bindings, **more)

    # ---- graphs

    def graph(self, name: Iri | Blank | str | None) -> Graph:
        """A named graph; None for the default graph."""
        if isinstance(name, Literal):
            raise ValueError("a graph's name is an IRI or a blank node")
        name = Iri(name) if isinstance(name, str) else name
        return Graph(self, "" if name is None else name.spelled())

    def union(self) -> Graph:
        return Graph(self, None)

    def quads(self, s: Term | None = None, p: Term | None = None, o: Term | None = None, g: str | None = None) -> DataFrame:
        """Statements of a pattern, as (s, p, o, graphs): a triple in several graphs is one row."""
        self._open()
        df = self.df if g is None else self.df.where(F.col("g") == g)
        if isinstance(s, Literal) or p is not None and not isinstance(p, Iri) or any(isinstance(x, Iri) and BAD_IRI.search(x.value) for x in (s, p, o)):
            df = df.where(F.lit(False))
        for c, x in (("s", s), ("p", p), ("o", o)):
            if x is not None:
                df = df.where(F.col(c) == x.spelled())
        return df.groupBy("s", "p", "o").agg(F.sort_array(F.collect_set("g")).alias("graphs"))

    def contexts(self, triple: tuple[Term, Term, Term] | None = None) -> DataFrame:
        df = self.df
        for c, x in zip("spo", triple or (), strict=False):
            df = df.where(F.col(c) == x.spelled())
        return df.select("g").distinct()

    def __len__(self) -> int:
        return len(self.union() if self.options.union else self.graph(None))

    def _refuse(self, *_, **__):
        raise ReadOnly("the store is read-only")

    add = addN = remove = remove_graph = update = _refuse

    def add_graph(self, graph) -> None:
        """Graphs exist by their statements; nothing to do."""

    # prefixes belong to queries; the store keeps none
    def bind(self, prefix: str, namespace: str) -> None:
        return None

    def namespaces(self) -> list:
        return []


@dataclass
class Graph:
    store: RdfStore
    name: str | None  # spelled; None for the union

    @property
    def scope(self) -> Scope:
        return DEFAULT if not self.name else Scope("named", self.name[1:-1])

    def triples(self, s: Term | None = None, p: Term | None = None, o: Term | None = None) -> DataFrame:
        return self.store.quads(s, p, o, self.name).select("s", "p", "o")

    def contains(self, s: Term, p: Term, o: Term) -> bool:
        return self.triples(s, p, o).limit(1).count() > 0

    def query(self, text: str, bindings: dict[str, Term] | None = None, **more) -> DataFrame:
        df = self.store.df if self.name is None else self.store.df.where(F.col("g") == self.name)
        repeats = self.name is None and self.store.meta.get("repeats", True)
        return run_query(self.store.spark, QuadSource(df, True, repeats, self.store.meta.get("counts")), text, bindings, **more)

    def __len__(self) -> int:
        if self.name is not None:
            return self.store.df.where(F.col("g") == self.name).count()
        df = self.store.df.select("s", "p", "o")
        return (df.distinct() if self.store.meta.get("repeats", True) else df).count()

