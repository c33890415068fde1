"""Queries over a source: text in, DataFrame out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.functions.values import Val, term, text_of
from quadrille.operators.relation import Relation
from quadrille.plans import parser as ast
from quadrille.plans.compiler import DEFAULT, Compiler
from quadrille.plans.parser import parse
from quadrille.terms import Term, Var

RESULTS = ("native", "terms")


def output(r: Relation, names: list[str], results: str) -> DataFrame:
    """native: numbers, texts, times and truth values as Spark's own, IRIs as text, other terms spelled. terms: all spelled."""
    columns = []
    for n in names:
        v: Val = r.val(n)
        if results == "terms":
            c = term(v)
        elif v.kind in ("key", "iri"):
            c = text_of(v)
        elif v.kind == "num":
            c = v.col["f"]
        else:
            c = v.col
        columns.append(c.alias(n))
    return r.df.select(*columns) if columns else r.df.select(F.lit(True).alias("solution"))


def query(spark: SparkSession, source, text: str, bindings: dict[str, Term] | None = None, results: str = "native", base: str = "", prefixes: dict[str, str] | None = None) -> DataFrame:
    """SELECT gives a column for each variable, ASK one row `ask`, CONSTRUCT and DESCRIBE (s, p, o), spelled.

    bindings: variables that have a value already, for patterns and filters, and in the result."""
    if results not in RESULTS:
        raise ValueError(f"results: one of {RESULTS}")
    q = parse(text, base, prefixes)
    if bindings:
        # a row of values that every part of the query's group joins with
        pre = ast.Values([Var(n) for n in bindings], [list(bindings.values())])
        q.where = ast.Group([pre, *q.where.parts])
    if q.default_graphs is not None:
        source = source.restricted([g.spelled() for g in q.default_graphs], [g.spelled() for g in q.named_graphs or []])
    c = Compiler(spark, source, base=base)
    if q.form == "ASK":
        return c.ask(q)
    if q.form == "CONSTRUCT":
        return c.construct(q)
    if q.form == "DESCRIBE":
        return c.describe(q)
    r = c.select(q, DEFAULT)
    names = [n for n in r.vars if not n.startswith(" ")] if q.select is None else [v.name for v, _ in q.select]
    return output(r, names, results)
