"""Property paths. Closures are semi-naive loops over frontiers; each round is cut by a checkpoint."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.operators.relation import Info, Relation, join, physical, union
from quadrille.plans.parser import Path, Triple
from quadrille.terms import Iri, Literal, Var


def shared_root(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; where none is set, a temporary folder if all runs in one process, as in tests, else an error."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: executors on other machines need a shared folder")
    return (root or "file://" + os.path.join(tempfile.gettempdir(), "quadrille-checkpoints")).rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """A checkpoint in the session's folder."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def path(compiler, s: object, p: object, o: object, scope) -> Relation:
    if isinstance(p, (Iri, Var)):
        return compiler.source.match(compiler.spark, [Triple(s, p, o)], scope)
    if p.op == "link":
        return path(compiler, s, p.args[0], o, scope)
    if p.op == "inv":
        return path(compiler, o, p.args[0], s, scope)
    if p.op == "seq":
        r, at = None, s
        for i, step in enumerate(p.args):
            to = o if i == len(p.args) - 1 else Var(f" p{compiler.fresh()}")
            part = path(compiler, at, step, to, scope)
            r = part if r is None else join(r, part)
            at = to
        return r.keep([n for n in r.vars if not n.startswith(" p")])
    if p.op == "alt":
        r = path(compiler, s, p.args[0], o, scope)
        for x in p.args[1:]:
            r = union(r, path(compiler, s, x, o, scope))
        return r
    if p.op == "neg":
        return _negated(compiler, s, p, o, scope)
    return _closure(compiler, s, p, o, scope)


def _negated(compiler, s: object, p: Path, o: object, scope) -> Relation:
    out = None
    for inverse in (False, True):
        refused = [i for i, inv in p.args if inv == inverse]
        # !() without inverse links still asks for forward ones
        if not refused and (inverse or p.args):
            continue
        v = Var(f" n{compiler.fresh()}")
        t = Triple(o, v, s) if inverse else Triple(s, v, o)
        r = compiler.source.match(compiler.spark, [t], scope).general(v.name)
        if refused:
            r = r.where(~F.col(r.vars[v.name].column).isin(*[i.spelled() for i in refused]))
        r = r.keep([n for n in r.vars if n != v.name])
        out = r if out is None else union(out, r)
    return out


def _closure(compiler, s: object, p: Path, o: object, scope) -> Relation:
    """p?, p+ or p*: distinct pairs; zero steps join each node, or bound term, with itself."""
    if not isinstance(o, Var) and isinstance(s, Var):
        return _closure(compiler, o, Path(p.op, (Path("inv", (p.args[0],)),)), s, scope)
    x, y = Var(f" x{compiler.fresh()}"), Var(f" y{compiler.fresh()}")
    inner = path(compiler, x, p.args[0], y, scope).general(x.name, y.name)
    g = inner.vars.get(scope.name) if scope.kind == "var" else None
    if g is not None:
        inner = inner.general(scope.name)
        g = inner.vars[scope.name]
    graph = [F.col(g.column).alias("g")] if g is not None else [F.lit("").alias("g")]
    edges = inner.df.select(F.col(inner.vars[x.name].column).alias("x"), F.col(inner.vars[y.name].column).alias("y"), *graph).where("x is not null and y is not null").distinct()
    fixed = None if isinstance(s, Var) else s.spelled()
    first = edges.where(F.col("x") == fixed) if fixed is not None else edges
    if p.op == "opt":
        reached = first
    else:
        edges = cut(edges)
        reached = front = cut(edges.where(F.col("x") == fixed) if fixed is not None else edges)
        while front.limit(1).count():
            step = front.select("x", F.col("y").alias("m"), "g").join(edges.select(F.col("x").alias("m"), "y", "g"), ["m", "g"]).select("x", "y", "g").distinct()
            front = cut(step.join(reached, ["x", "y", "g"], "left_anti"))
            reached = cut(reached.unionByName(front))
    if p.op in ("opt", "star"):
        reached = reached.unionByName(_zero(compiler, s, o, scope, fixed)).distinct()
    infos: dict[str, Info] = {}
    columns = []
    for name, t in (("x", s), ("y", o)):
        if isinstance(t, Var):
            if t.name in infos:
                reached = reached.where("x = y")
                continue
            infos[t.name] = Info(physical(t.name))
            columns.append(F.col(name).alias(infos[t.name].column))
        else:
            reached = reached.where(F.col(name) == t.spelled())
    if g is not None:
        infos[scope.name] = Info(physical(scope.name))
        columns.append(F.col("g").alias(infos[scope.name].column))
    if not columns:
        columns.append(F.lit(0).alias(physical("unit")))
    return Relation(reached.select(*columns), infos)


def _zero(compiler, s: object, o: object, scope, fixed: str | None) -> DataFrame:
    spark = compiler.spark
    if scope.kind == "var":
        graphs = compiler.source.graphs(scope.name).general(scope.name)
        g = graphs.df.select(F.col(graphs.vars[scope.name].column).alias("g"))
    else:
        g = spark.range(1).select(F.lit("").alias("g"))
    constants = [t.spelled() for t in (s, o) if isinstance(t, (Iri, Literal))]
    if fixed is not None:
        return g.select(F.lit(fixed).alias("x"), F.lit(fixed).alias("y"), "g")
    triples = compiler.source.triples(scope)
    graph = F.col("g") if scope.kind == "var" else F.lit("").alias("g")
    nodes = triples.select(F.col("s").alias("x"), graph).unionByName(triples.select(F.col("o").alias("x"), graph)).distinct()
    for c in constants:
        nodes = nodes.unionByName(g.select(F.lit(c).alias("x"), "g")).distinct()
    return nodes.select("x", F.col("x").alias("y"), "g")

