"""Patterns over a table of quads (s, p, o, g), terms spelled."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.operators.relation import Info, Relation, empty, physical
from quadrille.plans.parser import Triple
from quadrille.terms import BAD_IRI, Iri, Literal, Var


class QuadSource:
    """union: the default graph is the set of all graphs' triples; else only the default graph's own.

    repeats: False if it is known that no triple is in two graphs, so that the union needs no distinct.
    counts: statements by predicate, for the order of joins. by_object: a copy laid out by object, for patterns that know only that."""

    def __init__(self, df: DataFrame, union: bool = True, repeats: bool = True, counts: dict[str, int] | None = None, default: list[str] | None = None, named: list[str] | None = None, by_object: DataFrame | None = None):
        self.df, self.union, self.repeats, self.counts, self.by_object = df, union, repeats, counts or {}, by_object
        self.default, self.named = default, named

    def restricted(self, default: list[str], named: list[str]) -> QuadSource:
        """FROM and FROM NAMED."""
        return QuadSource(self.df, self.union, True, self.counts, default, named, self.by_object)

    def stars(self, triples: list[Triple]) -> list[list[Triple]]:
        return [[t] for t in triples]

    def cost(self, ts: list[Triple], scope) -> float:
        t = ts[0]
        fixed = [not isinstance(x, Var) for x in (t.s, t.p, t.o)]
        n = self.counts.get(t.p.spelled(), 0) if isinstance(t.p, Iri) and self.counts else 1e6
        weight = 1e-6 if fixed[0] else 1e-3 if fixed[2] else 1.0
        return weight * (n if fixed[1] else 1e7)

    def triples(self, scope) -> DataFrame:
        """(s, p, o), distinct; under a graph variable (s, p, o, g)."""
        return self._in_scope(self.df, scope, lambda g: g)

    def _in_scope(self, df: DataFrame, scope, graph) -> DataFrame:
        """The statements of a table of quads that the scope reads. graph: what stands for a graph's spelled name in the table."""
        g = F.col("g")
        if scope.kind == "named":
            name = f"<{scope.name}>"
            df = df.where(g == graph(name) if self.named is None or name in self.named else F.lit(False))
            return df.select("s", "p", "o")
        if scope.kind == "var":
            return df.where(g != graph("") if self.named is None else g.isin([graph(x) for x in self.named]))
        if self.default is not None:
            return df.where(g.isin([graph(x) for x in self.default])).select("s", "p", "o").distinct()
        if not self.union:
            return df.where(g == graph("")).select("s", "p", "o")
        df = df.select("s", "p", "o")
        return df.distinct() if self.repeats else df

    def graphs(self, name: str) -> Relation:
        i = Info(physical(name))
        if self.named is not None:
            rows = [(g,) for g in self.named]
            return Relation(self.df.sparkSession.createDataFrame(rows, f"{i.column} string"), {name: i})
        return Relation(self.df.where("g <> ''").select(F.col("g").alias(i.column)).distinct(), {name: i})

    def match(self, spark: SparkSession, ts: list[Triple], scope) -> Relation:
        t = ts[0]
        where = {"s": t.s, "p": t.p, "o": t.o}
        names = [x.name for x in where.values() if isinstance(x, Var)] + ([scope.name] if scope.kind == "var" else [])
        refused = isinstance(t.s, Literal) or isinstance(t.p, Literal) or any(isinstance(x, Iri) and BAD_IRI.search(x.value) for x in where.values())
        if refused:
            return empty(spark, dict.fromkeys(names))
        # filters before the union's distinct: Catalyst moves them below it anyway
        known_by_object = self.by_object is not None and isinstance(t.s, Var) and not isinstance(t.o, Var)
        df = self._in_scope(self.by_object if known_by_object else self.df, scope, lambda g: g)
        infos: dict[str, Info] = {}
        columns = []
        for c, x in where.items():
            if not isinstance(x, Var):
                df = df.where(F.col(c) == x.spelled())
            elif x.name in infos:
                first = next(k for k, y in where.items() if isinstance(y, Var) and y.name == x.name)
                df = df.where(F.col(c) == F.col(first))
            else:
                infos[x.name] = Info(physical(x.name))
                columns.append(F.col(c).alias(infos[x.name].column))
        if scope.kind == "var":
            infos[scope.name] = Info(physical(scope.name))
            columns.append(F.col("g").alias(infos[scope.name].column))
        return Relation(df.select(*columns) if columns else df.select(F.lit(0).alias(physical("unit"))), infos)


class CodedSource(QuadSource):
    """Quads of numbers, and a table (code, term). Patterns' constants are looked up, a scan compares numbers, and only what a
    pattern binds is decoded, after its filters."""

    #: A number that no term has.
    NONE = -1

    def __init__(self, quads: DataFrame, terms: DataFrame, union: bool = True, repeats: bool = True, counts: dict[str, int] | None = None, default: list[str] | None = None, named: list[str] | None = None, codes: dict[str, int] | None = None):
        super().__init__(quads, union, repeats, counts, default, named)
        self.terms, self._codes = terms, {} if codes is None else codes

    def restricted(self, default: list[str], named: list[str]) -> CodedSource:
        return CodedSource(self.df, self.terms, self.union, True, self.counts, default, named, self._codes)

    def codes(self, spelled: list[str]) -> dict[str, int]:
        """Of a pattern's constants; they are few."""
        if unknown := [x for x in spelled if x not in self._codes]:
            self._codes |= dict.fromkeys(unknown, self.NONE) | {r["term"]: r["code"] for r in self.terms.where(F.col("term").isin(unknown)).collect()}
        return self._codes

    def _decoded(self, df: DataFrame, columns: list[str]) -> DataFrame:
        for c in columns:
            df = df.join(self.terms.select(F.col("code").alias(c), F.col("term").alias(f"{c}_term")), c).drop(c).withColumnRenamed(f"{c}_term", c)
        return df

    def _scope_codes(self, scope):
        known = self.codes(["", *([f"<{scope.name}>"] if scope.kind == "named" else []), *(self.default or []), *(self.named or [])])
        return lambda g: F.lit(known[g])

    def triples(self, scope) -> DataFrame:
        df = self._in_scope(self.df, scope, self._scope_codes(scope))
        columns = ["s", "p", "o", *(["g"] if scope.kind == "var" else [])]
        return self._decoded(df, columns).select(*columns)

    def graphs(self, name: str) -> Relation:
        if self.named is not None:
            return super().graphs(name)
        i = Info(physical(name))
        found = self._decoded(self.df.where(F.col("g") != F.lit(self.codes([""])[""])).select("g").distinct(), ["g"])
        return Relation(found.select(F.col("g").alias(i.column)), {name: i})

    def match(self, spark: SparkSession, ts: list[Triple], scope) -> Relation:
        t = ts[0]
        where = {"s": t.s, "p": t.p, "o": t.o}
        fixed = {c: x.spelled() for c, x in where.items() if not isinstance(x, Var)}
        known = self.codes(list(fixed.values()))
        bound: dict[str, str] = {}
        df = self._in_scope(self.df, scope, self._scope_codes(scope))
        for c, x in where.items():
            if c in fixed:
                df = df.where(F.col(c) == F.lit(known[fixed[c]]))
            elif x.name in bound:
                df = df.where(F.col(c) == F.col(bound[x.name]))
            else:
                bound[x.name] = c
        if scope.kind == "var":
            if scope.name in bound:
                df = df.where(F.col("g") == F.col(bound[scope.name]))
            else:
                bound[scope.name] = "g"
        if any(known[x] == self.NONE for x in fixed.values()):
            return empty(spark, dict.fromkeys(bound))
        if not bound:
            return Relation(df.select(F.lit(0).alias(physical("unit"))), {})
        df = self._decoded(df.select(*bound.values()), list(bound.values()))
        infos = {n: Info(physical(n)) for n in bound}
        return Relation(df.select(*[F.col(c).alias(infos[n].column) for n, c in bound.items()]), infos)
