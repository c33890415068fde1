"""Syntax trees to DataFrame plans.

Groups are evaluated bottom-up, as the specification's algebra says: patterns join in order, OPTIONAL is a
left join whose filters see both sides, MINUS an anti join, filters apply to their whole group. The
planner of Spark does the rest; what it cannot know is done here: patterns with one subject become one scan
where the source can do that, patterns are put in an order that stays connected and starts at the most
selective, and joins on variables that may be unbound are the only ones that are not equi-joins.

GRAPH ?g adds a hidden variable for the graph to every pattern below it and equates it with ?g at the end.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass, fields, is_dataclass, replace
from itertools import count
from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quadrille.functions import builtins
from quadrille.functions.values import RANK, Val, arithmetic, compare, constant, ebv, error, negative, null, number, sort_keys, spelled_constant, term
from quadrille.operators import aggregate, paths
from quadrille.operators.relation import Branches, Info, Relation, distinct, empty, join, keyed, left_join, lonely, minus, physical, same_values, semi, union, unit
from quadrille.plans import parser as ast
from quadrille.plans.parser import AGGREGATES, Call, Exists, Path, Triple
from quadrille.terms import XSD, Blank, Iri, Literal, Var


class UnsupportedQuery(ValueError):
    pass


@dataclass(frozen=True)
class Scope:
    """Which graph patterns read: the default one, a named one, or any named one, bound to a variable."""

    kind: str  # default, named, var
    name: str = ""


DEFAULT = Scope("default")


def _filter_vars(e: object) -> set[str]:
    if isinstance(e, Var):
        return {e.name}
    if isinstance(e, Call):
        return set().union(*[_filter_vars(a) for a in e.args]) if e.args else set()
    return set()


def _has(e: object, kind) -> bool:
    return isinstance(e, kind) or isinstance(e, Call) and any(_has(a, kind) for a in e.args)


def _mentioned(x: object) -> set[str]:
    """All variables anywhere in a piece of syntax."""
    if isinstance(x, Var):
        return {x.name}
    if isinstance(x, (list, tuple)):
        return set().union(*map(_mentioned, x)) if x else set()
    if is_dataclass(x):
        return set().union(*[_mentioned(getattr(x, f.name)) for f in fields(x)]) if fields(x) else set()
    return set()


def _decided(e: object, r: Relation) -> bool | None:
    """What a filter says of all rows, if the IRIs' prefixes tell; else None."""
    if not isinstance(e, Call):
        return None
    if e.name in ("&&", "||"):
        x, y = (_decided(a, r) for a in e.args)
        strong = e.name == "||"
        return strong if strong in (x, y) else (not strong if x is y is (not strong) else None)
    if e.name == "!":
        x = _decided(e.args[0], r)
        return None if x is None else not x
    if e.name == "STRSTARTS" and isinstance(e.args[0], Call) and e.args[0].name == "STR" and isinstance(e.args[0].args[0], Var) and isinstance(e.args[1], Literal) and e.args[1].lang is None and e.args[1].datatype is None:
        i = r.vars.get(e.args[0].args[0].name)
        if i is not None and i.kind == "key" and e.args[0].args[0].name not in r.maybe:
            if i.prefix.startswith(e.args[1].lexical):
                return True
            if not e.args[1].lexical.startswith(i.prefix):
                return False
    return None


def _conjuncts(e: object) -> list:
    return [x for a in e.args for x in _conjuncts(a)] if isinstance(e, Call) and e.name == "&&" else [e]


class Compiler:
    def __init__(self, spark: SparkSession, source, now: str | None = None, base: str = ""):
        self.spark, self.source, self.base = spark, source, base
        self.now = now or f'"{datetime.datetime.now(datetime.UTC).isoformat().replace("+00:00", "Z")}"^^<{XSD}dateTime>'
        self._count = count()

    def fresh(self) -> str:
        return f"{id(self)}-{next(self._count)}"

    def resolved(self, c: Column) -> Column:
        if not self.base:
            return c
        root = urljoin(self.base, "x")[:-1]
        return F.when(c.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), c).otherwise(F.concat(F.lit(root), c))

    # ---- expressions

    def value(self, e: object, r: Relation) -> Val:
        if isinstance(e, Var):
            return r.val(e.name) if e.name in r.vars else error()
        if isinstance(e, (Iri, Literal)):
            return constant(e)
        if isinstance(e, Exists):
            raise UnsupportedQuery("EXISTS in this place")
        name, args = e.name, e.args
        if name == "BOUND":
            return Val("bool", r.val(args[0].name).col.isNotNull() if args[0].name in r.vars else F.lit(False))
        if name == "COALESCE":
            return self.one_of([self.value(a, r) for a in args], lambda cols: F.coalesce(*cols))
        if name == "IF":
            test = self.truth(args[0], r)
            return self.one_of([self.value(a, r) for a in args[1:]], lambda cols: F.when(test, cols[0]).when(~test, cols[1]))
        if name in ("||", "&&"):
            x, y = self.truth(args[0], r), self.truth(args[1], r)
            return Val("bool", x | y if name == "||" else x & y)
        if name == "!":
            return Val("bool", ~self.truth(args[0], r))
        if name == "IN":
            x = self.value(args[0], r)
            out = F.lit(False)
            for a in args[1:]:
                out = out | compare(x, self.value(a, r), "=")
            return Val("bool", out)
        if name == "REGEX":
            return builtins.regex(self.value(args[0], r), self.text(args[1]), self.text(args[2]) if len(args) > 2 else "")
        if name == "REPLACE":
            return builtins.replace(self.value(args[0], r), self.text(args[1]), self.value(args[2], r), self.text(args[3]) if len(args) > 3 else "")
        if name == "!MARK":  # an EXISTS, solved before
            return Val("bool", F.coalesce(F.col(args[0]), F.lit(False)))
        vals = [self.value(a, r) for a in args]
        if name == "!=":
            return Val("bool", ~compare(*vals, "="))
        if name in ("=", "<", ">", "<=", ">="):
            return Val("bool", compare(*vals, name))
        if name in ("+", "-", "*", "/"):
            return arithmetic(*vals, name)
        if name == "u-":
            return negative(vals[0])
        if name == "u+":
            return vals[0] if vals[0].kind in RANK else Val("num", number(vals[0]))
        if name in AGGREGATES:
            raise UnsupportedQuery(f"{name} outside of a projection, HAVING or ORDER BY")
        found = builtins.call(name, vals, self)
        return found if found is not None else error()

    def text(self, e: object) -> str | None:
        """A constant simple literal, or None for an error."""
        if isinstance(e, Literal) and e.lang is None and e.datatype is None:
            return e.lexical
        if isinstance(e, (Var, Call)):
            raise UnsupportedQuery("a pattern or flags that are not constant")
        return None

    def one_of(self, vals: list[Val], f) -> Val:
        if not vals:
            return error()
        kinds = {(v.kind, v.prefix) for v in vals}
        if len(kinds) == 1 and vals[0].kind != "num":
            return Val(vals[0].kind, f([v.col for v in vals]), vals[0].prefix)
        if all(v.numeric for v in vals):
            return Val("num", f([number(v) for v in vals]))
        return Val("term", f([term(v) for v in vals]))

    def truth(self, e: object, r: Relation) -> Column:
        return ebv(self.value(e, r))

    # ---- patterns

    def group(self, g: ast.Group, scope: Scope, seed: Relation | None = None) -> Relation:
        r = seed if seed is not None else unit(self.spark)
        filters: list = []
        for i, part in enumerate(g.parts):
            if isinstance(part, ast.Bgp):
                # filters wait for the group's end, but those on this pattern's own variables reach its scan through Catalyst
                r = join(r, self.bgp(part.triples, scope))
            elif isinstance(part, ast.Filter):
                filters.append(part.expr)
            elif isinstance(part, ast.Bind):
                if part.var.name in r.vars:
                    raise UnsupportedQuery(f"BIND: ?{part.var.name} is in use")
                r, e = self.marked(part.expr, r, scope)
                r = self.bound(r, part.var.name, e)
            elif isinstance(part, ast.Optional):
                r = self.optional(r, part.group, scope)
            elif isinstance(part, ast.Minus):
                hidden = frozenset({scope.name}) if scope.kind == "var" else frozenset()
                r = minus(r, self.group(part.group, scope), hidden)
            elif isinstance(part, ast.Union):
                branches = [self.group(b, scope) for b in part.groups]
                u = branches[0]
                for b in branches[1:]:
                    u = union(u, b)
                r = join(r, u)
            elif isinstance(part, ast.Group):
                r = join(r, self.group(part, scope))
            elif isinstance(part, ast.Graph):
                r = join(r, self.graph(part, scope))
            elif isinstance(part, ast.Values):
                r = join(r, self.inline(part))
            elif isinstance(part, ast.SubSelect):
                r = join(r, self.select(part.query, scope))
            elif isinstance(part, ast.Service):
                if not part.silent:
                    raise UnsupportedQuery("SERVICE: there is no federation; SILENT gives one empty solution")
            else:
                raise UnsupportedQuery(type(part).__name__)
        if scope.kind == "var" and scope.name not in r.vars:
            r = join(r, self.source.graphs(scope.name))
        for f in filters:
            r = self.filtered(r, f, scope)
        return r

    def bound(self, r: Relation, name: str, e: object) -> Relation:
        if isinstance(e, (Iri, Literal)):
            return r.with_var(name, spelled_constant(e), False)
        return r.with_var(name, self.value(e, r))

    def filtered(self, r: Relation, e: object, scope: Scope) -> Relation:
        if isinstance(r, Branches) and not _has(e, Exists):
            # a filter may decide about a whole branch, which then is not read
            kept = [p if (d := _decided(e, p)) else p.where(self.truth(e, p)) for p in r.parts if (d := _decided(e, p)) is not False]
            return Branches(kept) if kept else r.where(F.lit(False))
        for c in _conjuncts(e):
            inner = c
            negated = False
            while isinstance(inner, Call) and inner.name == "!":
                inner, negated = inner.args[0], not negated
            if isinstance(inner, Exists):
                r = self.exists(r, inner, inner.negated != negated, scope)
            else:
                r, c = self.marked(c, r, scope)
                r = r.where(self.truth(c, r))
        return r

    def _plain(self, g: ast.Group) -> bool:
        """A body that can be solved by itself: patterns only, so that no filter sees the outer row."""
        return all(isinstance(p, ast.Bgp) for p in g.parts) and bool(g.parts)

    def exists(self, r: Relation, e: Exists, negated: bool, scope: Scope) -> Relation:
        patterns = ast.Group([p for p in e.group.parts if not isinstance(p, ast.Filter)])
        tests = [p.expr for p in e.group.parts if isinstance(p, ast.Filter)]
        if self._plain(patterns) and not any(_has(t, Exists) for t in tests):
            body = self.group(patterns, scope)
            # a filter in the body sees the row's bindings too: it is a part of the join's condition
            if (found := semi(r, body, negated, (lambda both: self._all(tests, both)) if tests else None)) is not None:
                return found
        met, keys = self.met_rows(r, e, scope)
        return Relation(lonely(r, met, keys, "left_anti" if negated else "left_semi"), r.vars, r.maybe)

    def _all(self, tests: list, r: Relation) -> Column:
        out = self.truth(tests[0], r)
        for t in tests[1:]:
            out = out & self.truth(t, r)
        return out

    def met_rows(self, r: Relation, e: Exists, scope: Scope) -> tuple[Relation, list[tuple[str, str]]]:
        """What the body gives for the distinct bindings of the variables that it mentions: it is solved with them in it, as substitution says."""
        used = _mentioned(e.group)
        names = [n for n in r.vars if n in used or n == scope.name]
        few = r.keep(names) if names else unit(self.spark)
        seed, keys = keyed(distinct(few) if names else few, names)
        if not names:
            seed = unit(self.spark)
        return self.group(e.group, scope, seed), [(r.vars[n].column, h) for n, (_, h) in zip(names, keys, strict=True)]

    def marked(self, e: object, r: Relation, scope: Scope) -> tuple[Relation, object]:
        """EXISTS inside an expression becomes a flag."""
        if not _has(e, Exists):
            return r, e
        if isinstance(e, Exists):
            flag = physical("exists")
            met, keys = self.met_rows(r, e, scope)
            names = {h: physical("met") for _, h in keys}
            seen = met.df.select(*[F.col(met.vars[h].column).alias(c) for h, c in names.items()]).distinct() if names else met.df.select(F.lit(1).alias(physical("met"))).limit(1)
            seen = seen.withColumn(flag, F.lit(True))
            df = r.df.join(seen, same_values([(x, names[h]) for x, h in keys]), "left").drop(*[c for c in seen.columns if c != flag])
            mark = Call("!MARK", (flag,))
            return Relation(df, r.vars, r.maybe), Call("!", (mark,)) if e.negated else mark
        args = []
        for a in e.args:
            r, a = self.marked(a, r, scope)
            args.append(a)
        return r, Call(e.name, tuple(args), e.distinct, e.separator)

    def optional(self, r: Relation, g: ast.Group, scope: Scope) -> Relation:
        conditions = [p.expr for p in g.parts if isinstance(p, ast.Filter)]
        body = self.group(ast.Group([p for p in g.parts if not isinstance(p, ast.Filter)]), scope)
        if r.unit:
            r = Relation(r.df, {}, frozenset())
        own, cross = [], []
        for c in conditions:
            for x in _conjuncts(c):
                (own if _filter_vars(x) <= body.vars.keys() - r.vars.keys() and not _has(x, Exists) else cross).append(x)
        for x in own:
            body = body.where(self.truth(x, body))
        if any(_has(x, Exists) for x in cross):
            seed, keys = keyed(r, list(r.vars))
            met = join(seed, body)
            for x in cross:
                met = self.filtered(met, x, scope)
            alone = Relation(lonely(r, met, keys, "left_anti"), r.vars, r.maybe)
            return union(met.keep([n for n in met.vars if not n.startswith(" key ")]), alone)
        return left_join(r, body, (lambda both: self._all(cross, both)) if cross else None)

    def graph(self, part: ast.Graph, scope: Scope) -> Relation:
        if isinstance(part.name, Iri):
            return self.group(part.group, Scope("named", part.name.value))
        if not isinstance(part.name, Var):
            return empty(self.spark)
        hidden = f" g{next(self._count)}"
        r = self.group(part.group, Scope("var", hidden))
        outer = part.name.name
        if outer not in r.vars:
            return Relation(r.df, {outer if n == hidden else n: i for n, i in r.vars.items()}, frozenset(outer if n == hidden else n for n in r.maybe))
        return self.equated(r, outer, hidden)

    def equated(self, r: Relation, a: str, b: str) -> Relation:
        """r with a = b, or a bound from b, without b."""
        x, y = r.val(a), r.val(b)
        r = r.where((term(x) == term(y)) | (x.col.isNull() if a in r.maybe else F.lit(False)))
        if a in r.maybe:
            r = Relation(r.df, {n: i for n, i in r.vars.items() if n != a}, r.maybe - {a}).with_var(a, Val("term", F.coalesce(term(x), term(y))), False)
        return r.keep([n for n in r.vars if n != b])

    def inline(self, v: ast.Values) -> Relation:
        names = [x.name for x in v.vars]
        infos, columns, maybe = {}, [], set()
        for i, n in enumerate(names):
            vals = [row[i] for row in v.rows]
            kinds = {constant(t).kind for t in vals if t is not None}
            kind = kinds.pop() if len(kinds) == 1 and kinds <= {"str", "int", "iri"} else "term"
            infos[n] = Info(physical(n), kind)
            if any(t is None for t in vals):
                maybe.add(n)
            columns.append([None if t is None else t.value if kind == "iri" else int(t.lexical) if kind == "int" else t.lexical if kind == "str" else t.spelled() for t in vals])
            # an integer that is not written plainly would lose its spelling
            if kind == "int" and any(t is not None and str(int(t.lexical)) != t.lexical for t in vals):
                infos[n] = Info(infos[n].column)
                columns[-1] = [None if t is None else t.spelled() for t in vals]
        rows = list(zip(*columns, strict=True)) if columns else [(0,)] * len(v.rows)
        schema = ", ".join(f"{i.column} {'bigint' if i.kind == 'int' else 'string'}" for i in infos.values()) or f"{physical('unit')} int"
        return Relation(self.spark.createDataFrame(rows, schema), infos, frozenset(maybe))

    # ---- basic graph patterns

    def bgp(self, triples: list[Triple], scope: Scope) -> Relation:
        if not triples:
            return unit(self.spark)
        plain = [t for t in triples if not isinstance(t.p, Path)]
        rest = [t for t in triples if isinstance(t.p, Path)]
        r = None
        todo = [("star", star) for star in self.source.stars(plain)] + [("path", [t]) for t in rest]
        known: set[str] = set()
        while todo:
            # connected patterns first; of those the most selective
            def rank(item) -> tuple:
                kind, ts = item
                names = {x.name for t in ts for x in (t.s, t.p, t.o) if isinstance(x, Var)}
                return (bool(known) and not names & known, kind == "path", self.source.cost(ts, scope) if kind == "star" else 0)

            best = min(todo, key=rank)
            todo.remove(best)
            kind, ts = best
            found = self.source.match(self.spark, ts, scope) if kind == "star" else paths.path(self, ts[0].s, ts[0].p, ts[0].o, scope)
            known |= found.vars.keys()
            r = found if r is None else join(r, found)
        return r

    # ---- query forms

    def counted(self, q: ast.Query, scope: Scope) -> Relation | None:
        """SELECT (COUNT(*) AS ?n) over one basic pattern of several scans: each side is counted by what it shares before it meets the
        other, so that no task makes the pairs of a frequent value. None for other queries."""
        plain = not (q.group_by or q.having or q.order_by or q.distinct or q.reduced or q.values or q.offset or q.limit is not None)
        if not plain or scope.kind == "var" or q.select is None or len(q.select) != 1 or q.select[0][1] != Call("COUNT", ()):
            return None
        if len(q.where.parts) != 1 or not isinstance(q.where.parts[0], ast.Bgp) or any(isinstance(t.p, Path) for t in q.where.parts[0].triples):
            return None
        scans = self.source.stars(q.where.parts[0].triples)
        if len(scans) < 2:
            return None
        todo = [self.source.match(self.spark, ts, scope) for ts in sorted(scans, key=lambda ts: self.source.cost(ts, scope))]
        acc: Relation | None = None
        while todo:
            known = set() if acc is None else acc.vars.keys()
            found = next((r for r in todo if r.vars.keys() & known), todo[0])
            todo.remove(found)
            later = set().union(*[r.vars.keys() for r in todo]) if todo else set()
            found = self._tallied(found, (found.vars.keys() & later) | (found.vars.keys() & known))
            acc = found if acc is None else self._tallied(join(acc, found), (acc.vars.keys() | found.vars.keys()) & later)
        n = Val("int", F.coalesce(F.sum(acc.vars[" tally"].column), F.lit(0).cast("bigint")))
        i = Info(physical(q.select[0][0].name), "int")
        return Relation(acc.df.agg(n.col.alias(i.column)), {q.select[0][0].name: i})

    def _tallied(self, r: Relation, names) -> Relation:
        """The relation's rows, counted by these variables, with the counts in ' tally …'."""
        names = sorted(n for n in names if not n.startswith(" tally"))
        for n in names:
            if r.vars[n].kind == "num":
                r = r.general(n)
        times = [F.col(i.column) for n, i in r.vars.items() if n.startswith(" tally")]
        each = F.count(F.lit(1))
        if times:
            product = times[0]
            for t in times[1:]:
                product = product * t
            each = F.sum(product)
        tally = physical("tally")
        df = r.df.groupBy(*[r.vars[n].column for n in names]).agg(each.cast("bigint").alias(tally))
        kept = {n: i for n, i in r.vars.items() if n in names}
        return Relation(df, {**kept, " tally" if times else f" tally {tally}": Info(tally, "opaque")})

    def select(self, q: ast.Query, scope: Scope, keep: tuple[str, ...] = ()) -> Relation:
        if not keep and (found := self.counted(q, scope)) is not None:
            return found
        r = self.group(q.where, scope)
        if scope.kind == "var":
            keep = (*keep, scope.name)
        return self.solution_modifiers(q, r, scope, keep)

    def solution_modifiers(self, q: ast.Query, r: Relation, scope: Scope, keep: tuple[str, ...]) -> Relation:
        if q.values is not None:
            r = join(r, self.inline(q.values))
        select = q.select
        visible = [n for n in r.vars if not n.startswith(" ")]
        having, order = list(q.having), list(q.order_by)
        grouped = bool(q.group_by) or any(_has(e, Call) and aggregate.aggregates(e) for _, e in select or [] if e is not None) or any(aggregate.aggregates(h) for h in having) or any(aggregate.aggregates(e) for e, _ in order)
        if grouped:
            if select is None:
                raise UnsupportedQuery("SELECT * with GROUP BY")
            # EXISTS inside an aggregate or a key is solved before the groups are made
            def solved(e: object) -> object:
                nonlocal r
                if not _has(e, Exists) or not isinstance(e, Call):
                    return e
                if e.name in AGGREGATES:
                    r, e = self.marked(e, r, scope)
                    return e
                return Call(e.name, tuple(solved(a) for a in e.args), e.distinct, e.separator)

            keys = []
            for e, v in q.group_by:
                r, e = self.marked(e, r, scope)
                keys.append((e, v))
            q = replace(q, group_by=keys)
            select = [(v, e if e is None else solved(e)) for v, e in select]
            having, order = [solved(h) for h in having], [(solved(e), d) for e, d in order]
            r, select, having, order = aggregate.grouped(self, q, r, select, having, order, keep)
        for h in having:
            r = self.filtered(r, h, scope)
        if select is None:
            names = visible
        else:
            names = []
            for v, e in select:
                if v.name in names:
                    raise UnsupportedQuery(f"?{v.name} is projected twice")
                if e is not None:
                    if v.name in r.vars and not grouped:
                        raise UnsupportedQuery(f"SELECT: ?{v.name} is in use")
                    r, e = self.marked(e, r, scope)
                    r = self.bound(r, v.name, e)
                elif v.name not in r.vars:
                    r = r.with_var(v.name, error())
                names.append(v.name)
        names = [*names, *[k for k in keep if k in r.vars]]
        for k, (e, down) in enumerate(order):
            r, e = self.marked(e, r, scope)
            order[k] = (e, down)
        keys = [(c, down) for e, down in order for c in sort_keys(self.value(e, r))]
        if q.distinct or q.reduced:
            sort = [(physical("sort"), c, down) for c, down in keys]
            shown = r.keep(names)
            if not sort:
                r = distinct(shown)
            elif all(isinstance(e, Var) and e.name in names for e, _ in order):
                r = distinct(shown)
                keys = [(c, down) for e, down in order for c in sort_keys(self.value(e, r))]
            else:  # ordered by what is not shown: each row stands where its first copy stands
                df = r.df.withColumns({n: c for n, c, _ in sort})
                least = F.struct(*[F.col(n) for n, _, _ in sort])
                downs = {d for _, _, d in sort}
                held, shown_columns = physical("first"), [r.vars[n].column for n in names]
                if len(downs) == 1:
                    df = df.groupBy(*shown_columns).agg((F.max(least) if downs == {True} else F.min(least)).alias(held))
                else:  # no least struct says which comes first if the directions differ
                    turn = physical("turn")
                    first = Window.partitionBy(*shown_columns).orderBy(*[F.col(n).desc_nulls_last() if d else F.col(n).asc_nulls_first() for n, _, d in sort])
                    df = df.withColumn(turn, F.row_number().over(first)).where(F.col(turn) == 1).select(*shown_columns, least.alias(held))
                r = Relation(df, shown.vars, shown.maybe)
                keys = [(F.col(held)[n], d) for n, _, d in sort]
        df = r.df
        if keys:
            df = df.orderBy(*[c.desc_nulls_last() if down else c.asc_nulls_first() for c, down in keys])
        if q.offset:
            df = df.offset(q.offset)
        if q.limit is not None:
            df = df.limit(q.limit)
        return Relation(df, r.vars, r.maybe).keep(names)

    def ask(self, q: ast.Query) -> DataFrame:
        if q.group_by or q.having:
            # what is grouped is not shown: any expression will do
            q.select = [(Var(" ask"), Call("COUNT", ()))]
            r = self.select(q, DEFAULT, (" ask",))
        else:
            r = self.solution_modifiers(ast.Query("SELECT", q.where, None, limit=q.limit, offset=q.offset, values=q.values), self.group(q.where, DEFAULT), DEFAULT, ())
        return r.df.limit(1).agg((F.count(F.lit(1)) > 0).alias("ask"))

    def construct(self, q: ast.Query) -> DataFrame:
        r = self.solution_modifiers(ast.Query("SELECT", q.where, None, group_by=[], having=q.having, order_by=q.order_by, limit=q.limit, offset=q.offset, values=q.values), self.group(q.where, DEFAULT), DEFAULT, ())
        if not q.template:
            return self.spark.createDataFrame([], "s string, p string, o string")
        # all triples of a solution in one pass, so that its blank nodes have one number
        rid = physical("row")
        numbered = r.df.withColumn(rid, F.monotonically_increasing_id())
        triples = [F.struct(*[self.template_term(x, r, rid).alias(c) for c, x in zip("spo", (t.s, t.p, t.o), strict=True)]) for t in q.template]
        out = numbered.select(F.explode(F.array(*triples)).alias("t")).select("t.s", "t.p", "t.o")
        # ill-formed triples are left out
        return out.where(F.col("s").isNotNull() & ~F.col("s").startswith('"') & F.col("p").startswith("<") & F.col("o").isNotNull()).distinct()

    def template_term(self, x: object, r: Relation, rid: str) -> Column:
        if isinstance(x, Var):
            if x.name.startswith(" "):  # a blank node of its own for each solution
                return F.concat(F.lit(f"_:c{x.name.strip().removeprefix('_:')}_"), F.col(rid).cast("string"))
            return term(r.val(x.name)) if x.name in r.vars else null()
        return F.lit(x.spelled() if isinstance(x, (Iri, Literal, Blank)) else str(x))

    def describe(self, q: ast.Query) -> DataFrame:
        """Quads of the resources, and of blank nodes that they lead to."""
        r = self.solution_modifiers(ast.Query("SELECT", q.where, None, order_by=q.order_by, limit=q.limit, offset=q.offset, values=q.values), self.group(q.where, DEFAULT), DEFAULT, ())
        wanted: DataFrame | None = None
        names = [n for n in r.vars if not n.startswith(" ")] if q.describe == [None] else [v.name for v in q.describe if isinstance(v, Var) and v.name in r.vars]
        for n in names:
            part = r.df.select(term(r.val(n)).alias("s"))
            wanted = part if wanted is None else wanted.unionByName(part)
        if irise := [(t.spelled(),) for t in q.describe if isinstance(t, Iri)]:
            part = self.spark.createDataFrame(irise, "s string")
            wanted = part if wanted is None else wanted.unionByName(part)
        if wanted is None:
            return self.spark.createDataFrame([], "s string, p string, o string")
        every = self.source.triples(DEFAULT)
        wanted = wanted.where("s is not null").distinct()
        out = every.join(wanted, "s", "left_semi")
        seen, front = wanted, out.where(F.col("o").startswith("_:")).select(F.col("o").alias("s")).distinct().join(wanted, "s", "left_anti")
        while front.limit(1).count():
            front = paths.cut(front)
            more = every.join(front, "s", "left_semi")
            out, seen = out.unionByName(more), paths.cut(seen.unionByName(front))
            front = more.where(F.col("o").startswith("_:")).select(F.col("o").alias("s")).distinct().join(seen, "s", "left_anti")
        return out.distinct()

