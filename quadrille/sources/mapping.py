"""An RDF view of relational tables, read without making quads.

Subject: <urn:t:{table}/{key}>; predicate: <urn:p:{column}>; object: the column's value as a literal, or
for a foreign key the IRI of the row that it names, with the plain value under <urn:p:{column}_lit>. NULL
gives no triple. Graph: <urn:g:{table}>. Patterns with one subject are one scan of one table, joins on
subjects are joins on keys, and filters on literals are comparisons of columns.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrille.functions.values import Val, constant, term
from quadrille.operators.relation import Branches, Info, Relation, disjoint, empty, physical, union
from quadrille.plans.parser import Triple
from quadrille.terms import Iri, Literal, Term, Var


@dataclass
class Table:
    name: str
    df: DataFrame
    key: tuple[str, ...]
    foreign: dict[str, str] = field(default_factory=dict)  # column to table
    graphs: tuple[str, ...] = ()
    tags: dict[str, str] = field(default_factory=dict)  # text column to column of language tags

    def __post_init__(self):
        self.graphs = self.graphs or (f"urn:g:{self.name}",)

    @property
    def prefix(self) -> str:
        return f"urn:t:{self.name}/"

    def subject(self) -> Column:
        if len(self.key) == 1:
            return F.col(self.key[0])
        return F.concat_ws("/", *[F.col(k).cast("string") for k in self.key])

    def is_subject(self, t: Term) -> Column | None:
        """The row is that resource; None if no row is. The parts of a key are compared one by one."""
        if not isinstance(t, Iri) or not t.value.startswith(self.prefix):
            return None
        rest = t.value[len(self.prefix) :]
        kinds = [self.df.schema[k].dataType for k in self.key]
        if len(self.key) > 1 and any(isinstance(k, T.StringType) for k in kinds):
            return self.subject() == F.lit(rest)  # a text may hold the separator
        parts = rest.split("/") if len(self.key) > 1 else [rest]
        if len(parts) != len(self.key):
            return None
        found = [same_key(F.col(k), kind, x) for k, kind, x in zip(self.key, kinds, parts, strict=True)]
        return None if any(c is None for c in found) else reduce(lambda a, b: a & b, found)

    def is_object(self, predicate: str, v: Val, t: Term) -> Column | None:
        """The predicate's object is that term; None if it never is."""
        if v.kind != "key":
            return equals(v, t)
        if not isinstance(t, Iri) or not t.value.startswith(v.prefix):
            return None
        column = predicate.removeprefix("urn:p:")
        return same_key(F.col(column), self.df.schema[column].dataType, t.value[len(v.prefix) :])

    def objects(self) -> dict[str, Val]:
        """By predicate."""
        out: dict[str, Val] = {}
        for f in self.df.schema.fields:
            v = literal(f)
            if v is None:
                continue
            if f.name in self.tags:
                t = F.col(f.name)
                v = Val("term", F.concat(F.lit('"'), t, F.when(F.col(self.tags[f.name]).isNull(), F.lit('"')).otherwise(F.concat(F.lit('"@'), F.lower(self.tags[f.name])))))
            if f.name in self.foreign:
                out[f"urn:p:{f.name}_lit"] = v
                v = Val("key", v.col, f"urn:t:{self.foreign[f.name]}/")
            out[f"urn:p:{f.name}"] = v
        return out


def literal(f: T.StructField) -> Val | None:
    c, t = F.col(f.name), f.dataType
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return Val("int", c.cast("bigint") if not isinstance(t, T.LongType) else c)
    if isinstance(t, T.DoubleType):
        return Val("dbl", c)
    if isinstance(t, T.FloatType):
        return Val("flt", c)
    if isinstance(t, T.DecimalType):
        return Val("dec", c)
    if isinstance(t, T.StringType):
        return Val("str", c)
    if isinstance(t, T.BooleanType):
        return Val("bool", c)
    if isinstance(t, T.TimestampNTZType):
        return Val("ts", c)
    if isinstance(t, T.TimestampType):
        return Val("ts", c.cast("timestamp_ntz"))
    return None  # arrays and the like have no RDF term


class MappedSource:
    def __init__(self, tables: list[Table]):
        self.tables = {t.name: t for t in tables}
        self._objects = {t.name: t.objects() for t in tables}
        self.default: list[str] | None = None
        self.named: list[str] | None = None

    def restricted(self, default: list[str], named: list[str]) -> MappedSource:
        out = MappedSource(list(self.tables.values()))
        out.default, out.named = [g[1:-1] for g in default], [g[1:-1] for g in named]
        return out

    def stars(self, triples: list[Triple]) -> list[list[Triple]]:
        by_subject: dict[object, list[Triple]] = {}
        alone = []
        for t in triples:
            if isinstance(t.p, Iri):
                by_subject.setdefault(t.s, []).append(t)
            else:
                alone.append([t])
        return [*by_subject.values(), *alone]

    def cost(self, ts: list[Triple], scope) -> float:
        if isinstance(ts[0].s, Iri):
            return 0
        if not isinstance(ts[0].p, Iri):
            return 9
        return 5 - sum(isinstance(t.o, (Iri, Literal)) for t in ts)

    def _placed(self, t: Table, scope) -> list[str]:
        """The graphs of the scope that hold the table; for one default graph, one entry."""
        if scope.kind == "named":
            return [g for g in t.graphs if g == scope.name and (self.named is None or g in self.named)]
        if scope.kind == "var":
            return [g for g in t.graphs if self.named is None or g in self.named]
        return [""] if self.default is None or any(g in self.default for g in t.graphs) else []

    def graphs(self, name: str) -> Relation:
        i = Info(physical(name))
        rows = sorted({(f"<{g}>",) for t in self.tables.values() for g in t.graphs if self.named is None or g in self.named})
        spark = next(iter(self.tables.values())).df.sparkSession
        return Relation(spark.createDataFrame(rows, f"{i.column} string"), {name: i})

    def triples(self, scope, only: str | None = None) -> DataFrame:
        """All triples, spelled."""
        out: DataFrame | None = None
        for t in self.tables.values():
            if only is not None and t.name != only:
                continue
            s = term(Val("key", t.subject(), t.prefix))
            pairs = F.array(*[F.struct(F.lit(f"<{p}>").alias("p"), term(v).alias("o")) for p, v in self._objects[t.name].items()])
            df = t.df.select(s.alias("s"), F.explode(pairs).alias("x")).where("s is not null and x.o is not null").select("s", "x.p", "x.o")
            placed = self._placed(t, scope)
            for g in placed:
                part = df.withColumn("g", F.lit(f"<{g}>")) if scope.kind == "var" else df
                out = part if out is None else out.unionByName(part)
        if out is None:
            spark = next(iter(self.tables.values())).df.sparkSession
            return spark.createDataFrame([], "s string, p string, o string" + (", g string" if scope.kind == "var" else ""))
        return out

    def match(self, spark: SparkSession, ts: list[Triple], scope) -> Relation:
        names = [x.name for t in ts for x in (t.s, t.p, t.o) if isinstance(x, Var)] + ([scope.name] if scope.kind == "var" else [])
        if isinstance(ts[0].p, Var):
            return self._any(spark, ts[0], scope)
        if isinstance(ts[0].s, Literal):
            return empty(spark, dict.fromkeys(names))
        out: Relation | None = None
        for t in self.tables.values():
            if any(x.p.value not in self._objects[t.name] for x in ts if isinstance(x.p, Iri)) or any(not isinstance(x.p, Iri) for x in ts):
                continue
            if isinstance(ts[0].s, Iri) and not ts[0].s.value.startswith(t.prefix):
                continue
            for g in self._placed(t, scope):
                part = self._star(t, ts, g if scope.kind == "var" else None, scope)
                if part is not None:
                    out = part if out is None else union(out, part)
        return out if out is not None else empty(spark, dict.fromkeys(names))

    def _star(self, t: Table, ts: list[Triple], g: str | None, scope) -> Relation | None:
        bound: dict[str, Val] = {}
        conditions: list[Column] = []
        subject = Val("key", t.subject(), t.prefix)

        def meet(x: object, v: Val, same: Callable[[Term], Column | None]) -> bool:
            """False if nothing can match."""
            if isinstance(x, Var):
                if x.name in bound:
                    a = bound[x.name]
                    if disjoint(Info("", a.kind, a.prefix), Info("", v.kind, v.prefix)):
                        return False
                    conditions.append(a.col == v.col if (a.kind, a.prefix) == (v.kind, v.prefix) else term(a) == term(v))
                else:
                    bound[x.name] = v
                return True
            c = same(x)
            if c is None:
                return False
            conditions.append(c)
            return True

        if not meet(ts[0].s, subject, t.is_subject):
            return None
        for x in ts:
            v = self._objects[t.name][x.p.value]
            conditions.append(v.col.isNotNull())
            if not meet(x.o, v, partial(t.is_object, x.p.value, v)):
                return None
        conditions += [F.col(k).isNotNull() for k in t.key]
        df = t.df
        for c in conditions:
            df = df.where(c)
        infos = {n: Info(physical(n), v.kind, v.prefix) for n, v in bound.items()}
        columns = [v.col.alias(infos[n].column) for n, v in bound.items()]
        if g is not None:
            if scope.name in infos:  # the graph's variable in a pattern
                return None
            infos[scope.name] = Info(physical(scope.name), "iri")
            columns.append(F.lit(g).alias(infos[scope.name].column))
        return Relation(df.select(*columns) if columns else df.select(F.lit(0).alias(physical("unit"))), infos)

    def _any(self, spark: SparkSession, t: Triple, scope) -> Relation:
        """A variable predicate: all columns. One branch for each table and graph, so that subjects stay keys and tables can be left out."""
        parts = [p for table in self.tables.values() for g in self._placed(table, scope) if (p := self._columns(table, t, g if scope.kind == "var" else None, scope)) is not None]
        if parts:
            return Branches(parts)
        return empty(spark, dict.fromkeys([x.name for x in (t.s, t.p, t.o) if isinstance(x, Var)] + ([scope.name] if scope.kind == "var" else [])))

    def _columns(self, table: Table, t: Triple, g: str | None, scope) -> Relation | None:
        df = table.df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in table.key]))
        if isinstance(t.s, (Iri, Literal)):
            if (c := table.is_subject(t.s)) is None:
                return None
            df = df.where(c)
        objects = self._objects[table.name]
        if isinstance(t.o, (Iri, Literal)):
            fits = {p: c for p, v in objects.items() if (c := table.is_object(p, v, t.o)) is not None}
            if not fits:
                return None
            df = df.where(reduce(lambda a, b: a | b, fits.values()))
            objects = {p: Val("term", F.when(c, F.lit(t.o.spelled()))) for p, c in fits.items()}
        pairs = F.array(*[F.struct(F.lit(f"<{p}>").alias("p"), term(v).alias("o")) for p, v in objects.items()])
        s, x = physical("s"), physical("x")
        df = df.select(table.subject().alias(s), F.explode(pairs).alias(x)).where(F.col(x)["o"].isNotNull())
        values = [(t.s, Val("key", F.col(s), table.prefix)), (t.p, Val("term", F.col(x)["p"])), (t.o, Val("term", F.col(x)["o"]))]
        if g is not None:
            values.append((Var(scope.name), Val("iri", F.lit(g))))
        bound: dict[str, Val] = {}
        for name, v in [(y.name, v) for y, v in values if isinstance(y, Var)]:
            if name in bound:
                df = df.where(term(bound[name]) == term(v))
            else:
                bound[name] = v
        infos = {n: Info(physical(n), v.kind, v.prefix) for n, v in bound.items()}
        return Relation(df.select(*[v.col.alias(infos[n].column) for n, v in bound.items()]) if bound else df.select(F.lit(0).alias(physical("unit"))), infos)


_INTEGER = re.compile(r"0|-?[1-9][0-9]{0,17}")


def same_key(c: Column, kind: T.DataType, text: str) -> Column | None:
    """The column's value is written so; None if none is. Numbers are compared as such, so that the filter reaches the scan."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c == F.lit(int(text)) if _INTEGER.fullmatch(text) else None
    if isinstance(kind, T.StringType):
        return c == F.lit(text)
    return c.cast("string") == F.lit(text)


def equals(v: Val, t: Term) -> Column | None:
    """The column is that term, as it is written; None if it can't be. Plain comparisons where they say the same."""
    if v.kind == "term":
        return v.col == t.spelled()
    if v.kind == "key":
        if not isinstance(t, Iri) or not t.value.startswith(v.prefix):
            return None
        rest = t.value[len(v.prefix) :]
        return v.col.cast("string") == rest
    if not isinstance(t, Literal):
        return None
    c = constant(t)
    if c.kind == "term" or c.kind != v.kind:
        return None
    if v.kind == "str":
        return v.col == c.col
    if v.kind == "int":
        return v.col == c.col if str(int(t.lexical)) == t.lexical else None
    if v.kind in ("dbl", "flt"):
        return (v.col == c.col) & (term(v) == t.spelled())
    return term(v) == t.spelled()


# Keys of the driver's tables. Fixed values.
FOREIGN = {
    "customer": {"c_nationkey": "nation"},
    "supplier": {"s_nationkey": "nation"},
    "nation": {"n_regionkey": "region"},
    "orders": {"o_custkey": "customer"},
    "lineitem": {"l_orderkey": "orders", "l_partkey": "part", "l_suppkey": "supplier"},
    "labels": {"doc_id": "documents"},
}
KEYS = {"lineitem": ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"), "conversations": ("conv_id", "turn")}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations", "embeddings")


def warehouse(spark: SparkSession, folder: str, tables: tuple[str, ...] = TABLES, tag_documents: bool = False) -> MappedSource:
    out = []
    for name in tables:
        df = spark.read.parquet(f"{folder}/{name}.parquet")
        graphs = ("urn:g:nation", "urn:g:nation2") if name == "nation" else ()
        tags = {"text": "lang"} if name == "documents" and tag_documents else {}
        out.append(Table(name, df, KEYS.get(name, (df.columns[0],)), FOREIGN.get(name, {}), graphs, tags))
    return MappedSource(out)
