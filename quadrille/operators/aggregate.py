"""GROUP BY and the aggregates. Spark sums partial results before it shuffles; nothing here works against that."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadrille.functions.values import DEC, RANK, Val, let, null, number, sort_keys, term, text_of
from quadrille.operators.relation import Info, Relation, physical
from quadrille.plans.parser import AGGREGATES, Call, Exists
from quadrille.terms import Var

_NUM = "struct<r:int,d:decimal(38,18),f:double>"


def aggregates(e: object) -> list[Call]:
    if not isinstance(e, Call):
        return []
    return [e] if e.name in AGGREGATES else [x for a in e.args for x in aggregates(a)]


def _holds_exists(e: object) -> bool:
    return isinstance(e, Exists) or isinstance(e, Call) and any(_holds_exists(a) for a in e.args)


def _replaced(e: object, by: dict) -> object:
    if isinstance(e, Exists):
        return e
    if not _holds_exists(e) and e in by:
        return by[e]
    return Call(e.name, tuple(_replaced(a, by) for a in e.args), e.distinct, e.separator) if isinstance(e, Call) else e


def grouped(compiler, q, r: Relation, select, having, order, keep):
    """The grouped relation, and the expressions that then read its variables."""
    keys: list[str] = list(k for k in keep if k in r.vars)
    by: dict = {}
    for i, (e, v) in enumerate(q.group_by):
        if isinstance(e, Var) and v is None:
            if e.name not in r.vars:
                r = r.with_var(e.name, Val("term", null()))
            name = e.name
        else:
            name = v.name if v else f" key{i}"
            r = r.with_var(name, compiler.value(e, r))
            by[e] = Var(name)
        if r.vars[name].kind == "num":
            r = r.general(name)
        keys.append(name)
    found: dict[Call, str] = {}
    for e in [*[e for _, e in select if e is not None], *having, *[e for e, _ in order]]:
        for a in aggregates(e):
            found.setdefault(a, f" agg{len(found)}")
    infos, columns = {}, []
    for a, name in found.items():
        v = _aggregate(compiler, a, r)
        infos[name] = Info(physical(name), v.kind, v.prefix)
        columns.append(v.col.alias(infos[name].column))
    by |= {a: Var(n) for a, n in found.items()}
    frame = r.df.groupBy(*[r.vars[k].column for k in dict.fromkeys(keys)])
    df = frame.agg(*columns) if columns else frame.agg(F.lit(0).alias(physical("none")))
    out = Relation(df, {**{k: r.vars[k] for k in keys}, **infos}, r.maybe & set(keys) | set(infos))
    shown = []
    for v, e in select:
        if e is None and v.name not in out.vars:
            raise ValueError(f"?{v.name} is neither grouped nor aggregated")
        shown.append((v, None if e is None else _replaced(e, by)))
    return out, shown, [_replaced(h, by) for h in having], [(_replaced(e, by), d) for e, d in order]


def _aggregate(compiler, a: Call, r: Relation) -> Val:
    if a.name == "COUNT" and not a.args:
        if not a.distinct:
            return Val("int", F.count(F.lit(1)))
        visible = [i.column for n, i in r.vars.items() if not n.startswith(" ")]
        return Val("int", F.count_distinct(F.struct(*visible)) if visible else F.least(F.count(F.lit(1)), F.lit(1)))
    e = a.args[0]
    v = compiler.value(e, r)
    sure = isinstance(e, Var) and e.name in r.vars and e.name not in r.maybe
    if a.name == "COUNT":
        c = term(v) if v.kind == "num" else v.col
        return Val("int", F.count_distinct(c) if a.distinct else F.count(c))
    if a.name == "SAMPLE":
        return Val(v.kind, F.any_value(v.col, F.lit(True)), v.prefix)
    if a.name == "GROUP_CONCAT":
        texts = F.collect_set(text_of(v)) if a.distinct else F.collect_list(text_of(v))
        # the order is not specified; a sorted one makes results repeatable
        return Val("str", F.array_join(F.array_sort(texts), a.separator))
    if a.name in ("MIN", "MAX"):
        f, by = (F.min, F.min_by) if a.name == "MIN" else (F.max, F.max_by)
        if v.kind in ("int", "dec", "str", "ts", "bool", "iri"):
            return Val(v.kind, f(v.col))
        if v.kind in ("dbl", "flt", "key"):
            return Val(v.kind, f(v.col) if v.kind != "key" else by(v.col, text_of(v)), v.prefix)
        t = term(v)
        return Val("term", by(t, F.when(t.isNotNull(), F.struct(*sort_keys(Val("term", t))))))
    return _sum_or_average(a, v, sure)


def _whole(c: Column, every: Column, sure: bool) -> Column:
    """One value that is an error makes the result one."""
    return c if sure else F.when(every, c)


def _sum_or_average(a: Call, v: Val, sure: bool) -> Val:
    average = a.name == "AVG"
    if v.kind in RANK:
        c = v.col
        if v.kind == "int" and average:
            c = c.cast("decimal(38,0)")
        total = F.sum_distinct(c) if a.distinct else F.try_sum(c) if v.kind == "int" else F.sum(c)
        n = F.count_distinct(c) if a.distinct else F.count(c)
        every = F.count(c) == F.count(F.lit(1))
        if v.kind in ("dbl", "flt"):
            made, kind = (F.try_divide(total, n) if average else total), v.kind
            cast = "double" if kind == "dbl" else "float"
        elif average:
            made, kind, cast = F.try_divide(total.cast("decimal(38,9)"), n.cast("decimal(20,0)")), "dec", DEC
        else:
            made, kind, cast = total, v.kind, "bigint" if v.kind == "int" else DEC
        return Val(kind, _whole(F.when(F.count(F.lit(1)) == 0, F.lit(0).cast(cast)).otherwise(made.try_cast(cast)), every, sure))
    if v.kind not in ("term", "num"):
        return Val("int", F.when(F.count(F.lit(1)) == 0, F.lit(0).cast("bigint")))
    if a.distinct:
        numbers = F.transform(F.collect_set(term(v)), lambda t: number(Val("term", t)))
        zero = F.struct(F.lit(0).alias("r"), F.lit(0).cast(DEC).alias("d"), F.lit(0.0).alias("f")).cast(_NUM)
        total = F.aggregate(numbers, zero, lambda s, x: F.struct(F.greatest(s["r"], x["r"]).alias("r"), F.try_add(s["d"], x["d"]).try_cast(DEC).alias("d"), (s["f"] + x["f"]).alias("f")).cast(_NUM))
        n, every = F.size(numbers), ~F.exists(numbers, lambda x: x.isNull())
    else:
        x = number(v)
        total = F.struct(F.coalesce(F.max(x["r"]), F.lit(0)).alias("r"), F.coalesce(F.try_sum(x["d"]), F.lit(0)).cast(DEC).alias("d"), F.coalesce(F.sum(x["f"]), F.lit(0.0)).alias("f"))
        n, every = F.count(x), F.count(x) == F.count(F.lit(1))
    every = every & (F.count(term(v)) == F.count(F.lit(1)))

    def finish(p: Column) -> Column:
        t, k = p["t"], p["n"]
        d, f = t["d"], t["f"]
        r = t["r"]
        if average:
            d = F.when(k == 0, F.lit(0).cast(DEC)).otherwise(F.try_divide(d.cast("decimal(38,9)"), k.cast("decimal(20,0)")).try_cast(DEC))
            f = F.when(k == 0, F.lit(0.0)).otherwise(F.try_divide(f, k))
            r = F.when(k == 0, 0).otherwise(F.greatest(r, F.lit(1)))
        return F.struct(r.alias("r"), F.when(r < 2, d).alias("d"), F.when(r < 2, d.cast("double")).otherwise(f).alias("f"))

    return Val("num", F.when(every, let(F.struct(total.alias("t"), n.alias("n")), finish)))
