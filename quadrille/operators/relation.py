"""Relations: multisets of solutions as DataFrames, with what is known of each variable when the plan is made.

A variable's column is native where its values' kind is known (functions.values.Val); it is a term's
spelling otherwise. `maybe` names the variables that may be unbound, that is NULL: only joins on those
need more than an equi-join: each side is split by what is bound, and the parts meet by equi-joins. No row numbers are made, which
could differ between two reads of one side; rows are told apart by their values.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations, count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.functions.values import Val, term

_names = count()


def physical(name: str) -> str:
    """A column name of its own: variables differ by case, columns do not."""
    return f"v{next(_names)}_" + "".join(c if c.isascii() and c.isalnum() else "_" for c in name)


@dataclass(frozen=True)
class Info:
    column: str
    kind: str = "term"
    prefix: str = ""


@dataclass
class Relation:
    df: DataFrame
    vars: dict[str, Info] = field(default_factory=dict)
    maybe: frozenset[str] = frozenset()
    #: at most one row with no columns that matter
    unit: bool = False

    def val(self, name: str) -> Val:
        i = self.vars[name]
        return Val(i.kind, F.col(i.column), i.prefix)

    def keep(self, names) -> Relation:
        kept = {n: i for n, i in self.vars.items() if n in names}
        return Relation(self.df.select(*[i.column for i in kept.values()]) if kept or self.vars else self.df, kept, self.maybe & kept.keys())

    def where(self, condition: Column) -> Relation:
        return Relation(self.df.where(condition), self.vars, self.maybe)

    def with_var(self, name: str, v: Val, maybe: bool = True) -> Relation:
        c = physical(name)
        return Relation(self.df.withColumn(c, v.col), {**self.vars, name: Info(c, v.kind, v.prefix)}, self.maybe | {name} if maybe else self.maybe)

    def general(self, *names: str) -> Relation:
        """These variables as terms."""
        todo = [n for n in names if self.vars[n].kind != "term"]
        if not todo:
            return self
        new = {n: Info(physical(n)) for n in todo}
        df = self.df.withColumns({new[n].column: term(self.val(n)) for n in todo}).drop(*[self.vars[n].column for n in todo])
        return Relation(df, {**self.vars, **new}, self.maybe)


class Branches(Relation):
    """A union whose parts are still known, so that a filter can be decided for each."""

    def __init__(self, parts: list[Relation]):
        self.parts = parts
        whole = reduce(union, parts)
        super().__init__(whole.df, whole.vars, whole.maybe)


def unit(spark: SparkSession) -> Relation:
    return Relation(spark.range(1).select(F.lit(0).alias(physical("unit"))), {}, frozenset(), True)


def empty(spark: SparkSession, names=()) -> Relation:
    infos = {n: Info(physical(n)) for n in names}
    schema = ", ".join(f"{i.column} string" for i in infos.values()) or f"{physical('none')} int"
    return Relation(spark.createDataFrame([], schema), infos)


def disjoint(a: Info, b: Info) -> bool:
    """No value of one is a value of the other."""
    if "term" in (a.kind, b.kind):
        return False
    if a.kind == b.kind == "key":
        return not (a.prefix.startswith(b.prefix) or b.prefix.startswith(a.prefix))
    if {a.kind, b.kind} <= {"iri", "key"}:
        return False
    return a.kind != b.kind and "num" not in (a.kind, b.kind)


def _alike(l: Relation, r: Relation, names) -> tuple[Relation, Relation]:
    """Shared variables in one form on both sides."""
    for n in names:
        a, b = l.vars[n], r.vars[n]
        if (a.kind, a.prefix) != (b.kind, b.prefix) or a.kind == "num":
            l, r = l.general(n), r.general(n)
    return l, r


def _apart(r: Relation) -> Relation:
    """r with column names of its own, for a join with what may come from the same frame."""
    new = {n: Info(physical(n), i.kind, i.prefix) for n, i in r.vars.items()}
    return Relation(r.df.select(*[F.col(i.column).alias(new[n].column) for n, i in r.vars.items()]) if r.vars else r.df.select(F.lit(0).alias(physical("unit"))), new, r.maybe)


def _condition(l: Relation, r: Relation, shared) -> Column | None:
    """Compatible: equal, or unbound on a side."""
    parts = []
    for n in shared:
        x, y = F.col(l.vars[n].column), F.col(r.vars[n].column)
        c = x == y
        if n in l.maybe:
            c = c | x.isNull()
        if n in r.maybe:
            c = c | y.isNull()
        parts.append(c)
    return reduce(lambda a, b: a & b, parts) if parts else None


def _merged(l: Relation, r: Relation, df: DataFrame, shared, maybe) -> Relation:
    columns, infos = [], {}
    for n, i in l.vars.items():
        c = F.col(i.column)
        if n in shared and n in l.maybe:
            c = F.coalesce(c, F.col(r.vars[n].column)).alias(i.column)
        columns.append(c)
        infos[n] = i
    for n, i in r.vars.items():
        if n not in infos:
            columns.append(F.col(i.column))
            infos[n] = i
    return Relation(df.select(*columns) if columns else df, infos, frozenset(maybe))


def join(l: Relation, r: Relation) -> Relation:
    if l.unit:
        return r
    if r.unit:
        return l
    shared = [n for n in l.vars if n in r.vars]
    if any(disjoint(l.vars[n], r.vars[n]) and n not in l.maybe | r.maybe for n in shared):
        l = l.where(F.lit(False))
    l, r = _alike(l, r, shared)
    r = _apart(r)
    maybe = {n for n in l.maybe | r.maybe if not (n in shared and not (n in l.maybe and n in r.maybe))}
    if shared and not _strict(l, r, shared) and (split := _split(l, r, shared)):
        parts = [left.join(right, on) if on is not None else left.crossJoin(right) for left, _, sides in split for right, _, on in sides]
        return _merged(l, r, reduce(DataFrame.unionByName, parts), shared, maybe)
    on = _condition(l, r, shared)
    return _merged(l, r, l.df.join(r.df, on) if on is not None else l.df.crossJoin(r.df), shared, maybe)


#: Parts of both sides together, at most; with more variables that may be unbound, the condition stays one.
PARTS = 16


def _strict(l: Relation, r: Relation, shared) -> list[str]:
    return [n for n in shared if n not in l.maybe and n not in r.maybe]


def _by_bound(r: Relation, shared) -> list[tuple[DataFrame, frozenset[str]]]:
    """The rows by which of the shared variables are bound."""
    loose = [n for n in shared if n in r.maybe]
    out = []
    for k in range(len(loose), -1, -1):
        for bound in combinations(loose, k):
            df = r.df
            for n in loose:
                c = F.col(r.vars[n].column)
                df = df.where(c.isNotNull() if n in bound else c.isNull())
            out.append((df, frozenset(bound) | {n for n in shared if n not in loose}))
    return out


def _split(l: Relation, r: Relation, shared) -> list[tuple[DataFrame, frozenset[str], list[tuple[DataFrame, frozenset[str], Column | None]]]] | None:
    """Parts of l, each with the parts of r and the equi-join that makes them compatible (None: all pairs are), and what is bound in them; None if there are too many."""
    if 2 ** len([n for n in shared if n in l.maybe]) * 2 ** len([n for n in shared if n in r.maybe]) > PARTS:
        return None
    right = _by_bound(r, shared)

    def on(a: frozenset[str], b: frozenset[str]) -> Column | None:
        parts = [F.col(l.vars[n].column) == F.col(r.vars[n].column) for n in shared if n in a and n in b]
        return reduce(lambda x, y: x & y, parts) if parts else None

    return [(df, bound, [(other, b, on(bound, b)) for other, b in right]) for df, bound in _by_bound(l, shared)]


def same_values(columns: list[tuple[str, str]]) -> Column:
    """Pairs of columns with the same values, or both NULL."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in columns]) if columns else F.lit(True)


def keyed(l: Relation, names: list[str]) -> tuple[Relation, list[tuple[str, str]]]:
    """l with copies of these variables' columns, as hidden variables that no join changes; pairs (column, hidden variable)."""
    copies = {n: physical("key") for n in names}
    df = l.df.withColumns({c: F.col(l.vars[n].column) for n, c in copies.items()}) if copies else l.df
    hidden = {f" key {c}": Info(c, "opaque") for c in copies.values()}
    return Relation(df, {**l.vars, **hidden}, l.maybe), [(l.vars[n].column, f" key {c}") for n, c in copies.items()]


def lonely(l: Relation, met: Relation, keys: list[tuple[str, str]], how: str) -> DataFrame:
    """Rows of l whose values are (left_semi), or are not (left_anti), among those that met has in the hidden variables of keys."""
    names = {h: physical("met") for _, h in keys}
    seen = met.df.select(*[F.col(met.vars[h].column).alias(c) for h, c in names.items()]).distinct() if names else met.df.select(F.lit(1).alias(physical("met"))).limit(1)
    return l.df.join(seen, same_values([(x, names[h]) for x, h in keys]), how)


def left_join(l: Relation, r: Relation, condition=None) -> Relation:
    """condition: None, or a function of the merged relation that gives a BOOLEAN column."""
    shared = [n for n in l.vars if n in r.vars]
    new = [n for n in r.vars if n not in l.vars]
    strict = [n for n in shared if n not in l.maybe and n not in r.maybe]
    if l.unit:
        l = Relation(l.df, {}, frozenset())
    if strict or not shared:
        l2, r2 = _alike(l, r, shared)
        r2 = _apart(r2)
        on = _condition(l2, r2, shared)
        if condition is not None:
            both = Relation(l2.df, {**r2.vars, **l2.vars}, l2.maybe | r2.maybe)
            c = condition(both)
            on = c if on is None else on & c
        df = l2.df.join(r2.df, on if on is not None else F.lit(True), "left")
        return _merged(l2, r2, df, shared, l2.maybe | set(new))
    # only variables that may be unbound are shared: match by the split join, then add the rows that met nothing
    l, r = _alike(l, r, shared)
    r = _apart(r)
    split = _split(l, r, shared)
    seed, keys = (l, []) if split else keyed(l, list(l.vars))
    met = join(seed, r)
    if condition is not None:
        met = met.where(F.coalesce(condition(met), F.lit(False)))
    if not split:
        alone = lonely(l, met, keys, "left_anti")
        return union(met.keep([n for n in met.vars if not n.startswith(" key ")]), Relation(alone, l.vars, l.maybe))
    alone = None
    for left, bound, sides in split:
        for right, b, on in sides:
            if condition is not None:
                seen = {**r.vars, **l.vars, **{n: r.vars[n] for n in shared if n in b and n not in bound}}
                c = condition(Relation(left, seen, l.maybe | r.maybe))
                left = left.join(right, c if on is None else on & c, "left_anti")
            else:
                left = left.join(right if on is not None else right.limit(1), on if on is not None else F.lit(True), "left_anti")
        alone = left if alone is None else alone.unionByName(left)
    return union(met, Relation(alone, l.vars, l.maybe))


def union(l: Relation, r: Relation) -> Relation:
    names = [*l.vars, *[n for n in r.vars if n not in l.vars]]
    for n in names:
        if n in l.vars and n in r.vars:
            l, r = _alike(l, r, [n])
    columns = {}
    for n in names:
        i = l.vars.get(n) or r.vars[n]
        columns[n] = Info(physical(n), i.kind, i.prefix)

    def side(x: Relation, other: Relation) -> DataFrame:
        out = []
        for n in names:
            c = F.col(x.vars[n].column) if n in x.vars else F.lit(None).cast(other.df.schema[other.vars[n].column].dataType)
            out.append(c.alias(columns[n].column))
        return x.df.select(*out) if out else x.df.select(F.lit(0).alias("unit"))

    maybe = l.maybe | r.maybe | {n for n in names if n not in l.vars or n not in r.vars}
    return Relation(side(l, r).unionByName(side(r, l)), columns, frozenset(maybe))


def minus(l: Relation, r: Relation, ignored: frozenset[str] = frozenset()) -> Relation:
    """Rows of l without a compatible row of r that shares a bound variable. ignored: shared, but no reason by itself."""
    shared = [n for n in l.vars if n in r.vars]
    if not [n for n in shared if n not in ignored]:
        return l
    if any(disjoint(l.vars[n], r.vars[n]) and n not in l.maybe | r.maybe for n in shared):
        return l
    r = r.keep(shared)
    l, r = _alike(l, r, shared)
    r = _apart(r)
    if not any(n in l.maybe | r.maybe for n in shared):
        on = _condition(l, r, shared)
        return Relation(l.df.join(r.df, on, "left_anti"), l.vars, l.maybe)
    right = Relation(r.df.distinct(), r.vars, r.maybe)
    counts = [n for n in shared if n not in ignored]
    if 2 ** len([n for n in shared if n in l.maybe]) * 2 ** len([n for n in shared if n in r.maybe]) > PARTS:
        some = reduce(lambda a, b: a | b, [F.col(l.vars[n].column).isNotNull() & F.col(right.vars[n].column).isNotNull() for n in counts])
        return Relation(l.df.join(right.df, _condition(l, right, shared) & some, "left_anti"), l.vars, l.maybe)
    out: DataFrame | None = None
    for df, bound in _by_bound(l, shared):
        for other, b in _by_bound(right, shared):
            both = [n for n in shared if n in bound and n in b]
            if any(n in counts for n in both):
                df = df.join(other, reduce(lambda x, y: x & y, [F.col(l.vars[n].column) == F.col(right.vars[n].column) for n in both]), "left_anti")
        out = df if out is None else out.unionByName(df)
    return Relation(out, l.vars, l.maybe)


def semi(l: Relation, r: Relation, negated: bool, condition=None) -> Relation | None:
    """Rows of l with, or without, a compatible row in r; None if that takes more than an equi-join.

    condition: None, or a function of the merged relation that gives a BOOLEAN column."""
    shared = [n for n in l.vars if n in r.vars]
    if not shared or any(n in l.maybe | r.maybe for n in shared):
        return None
    l, r = _alike(l, r if condition is not None else r.keep(shared), shared)
    r = _apart(r)
    on = _condition(l, r, shared)
    if condition is not None:
        on = on & condition(Relation(l.df, {**r.vars, **l.vars}, l.maybe | r.maybe))
    return Relation(l.df.join(r.df, on, "left_anti" if negated else "left_semi"), l.vars, l.maybe)


def distinct(r: Relation) -> Relation:
    return Relation(r.df.distinct(), r.vars, r.maybe)
