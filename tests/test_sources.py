"""N-Quads, stores and their layouts, streams, the view of tables, and the registered queries."""

import glob
import os

import duckdb
import pytest

from quadrille import catalog
from quadrille.plans.parser import Triple
from quadrille.sources.mapping import warehouse
from quadrille.sources.nquads import read_nquads, to_lines, write_nquads
from quadrille.sources.store import ReadOnly, RdfStore, build
from quadrille.streaming.quads import append_to_store, match, read_stream
from quadrille.terms import Blank, Iri, Literal, Var, ntriples, term

LINES = r"""
# harbours

<http://e/turku> <http://e/says> "one\ttwo" .
<http://e/turku> <http://e/says> "a \"quay\"\r\nC:\\new" <http://e/coast> .
<http://e/turku> <http://e/says> "\u00C5bo\U0001F6A2"@sv-FI <http://e/coast> . # the other name
<http://e/turku> <http://e/says> "port"^^<http://www.w3.org/2001/XMLSchema#string> <http://e/inland> .
<http://e/turku> <http://e/says> "port" <http://e/coast> .
<http://e/turku> <http://e/depth> "+8"^^<http://www.w3.org/2001/XMLSchema#integer> .
<http://e/naantali> <http://e/depth> "8"^^<http://www.w3.org/2001/XMLSchema#integer> .
_:pier <http://e/says> _:ship _:chart .
"""
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def file(tmp_path_factory):
    p = tmp_path_factory.mktemp("nq") / "data.nq"
    p.write_text(LINES, encoding="utf-8")
    return str(p)


def test_read_and_write(spark, file, tmp_path):
    df = read_nquads(spark, file)
    rows = {tuple(r) for r in df.collect()}
    assert len(rows) == 8
    texts = {r[2] for r in rows}
    assert '"one\ttwo"' in texts and '"a "quay"\r\nC:\\new"' in texts and '"Åbo🚢"@sv-fi' in texts
    assert {r[3] for r in rows if r[2] == '"port"'} == {"<http://e/coast>", "<http://e/inland>"}
    write_nquads(df, str(tmp_path / "out"))
    assert {tuple(r) for r in read_nquads(spark, str(tmp_path / "out")).collect()} == rows
    assert {r[0] for r in to_lines(df).collect()} == {" ".join([ntriples(term(x)) for x in r[:3]] + ([r[3]] if r[3] else []) + ["."]) for r in rows}


def test_a_bad_line_fails(spark, tmp_path):
    (tmp_path / "bad.nq").write_text("<http://e/a> <http://e/p> .\n")
    with pytest.raises(Exception, match="not a statement"):
        read_nquads(spark, str(tmp_path / "bad.nq")).collect()
    assert read_nquads(spark, str(tmp_path / "bad.nq"), strict=False).count() == 0


@pytest.mark.parametrize("layout", ["spelled", "dictionary"])
def test_layouts(spark, file, tmp_path, layout):
    build(spark, file, str(tmp_path / "st"), layout, by_object=True)
    st = RdfStore.open(spark, str(tmp_path / "st"))
    assert st.layout == layout and st.meta["quads"] == 8 and st.meta["repeats"] is True
    assert len(st) == 7 and len(st.graph("http://e/coast")) == 3 and len(st.graph(None)) == 3 and len(st.graph(Blank("chart"))) == 1
    assert {r[0] for r in st.contexts().collect()} == {"", "<http://e/coast>", "<http://e/inland>", "_:chart"}
    (row,) = st.quads(o=Literal("port")).collect()
    assert row["graphs"] == ["<http://e/coast>", "<http://e/inland>"]
    assert st.quads(s=Literal("port")).count() == 0 and st.union().contains(Iri("http://e/turku"), Iri("http://e/says"), Literal("port"))
    assert st.query("SELECT (COUNT(*) AS ?n) { ?s ?p ?o }").first()["n"] == 7
    for call in (st.add, st.addN, st.remove, st.remove_graph):
        with pytest.raises(ReadOnly):
            call(1)
    st.add_graph("http://e/new")
    st.close()


def test_dictionary_numbers_follow_the_terms(spark, file, tmp_path):
    build(spark, file, str(tmp_path / "st"), "dictionary")
    rows = sorted((r["code"], r["term"]) for r in spark.read.parquet(str(tmp_path / "st" / "terms")).collect())
    assert [r[0] for r in rows] == list(range(len(rows))) and [r[1] for r in rows] == sorted((r[1] for r in rows), key=lambda t: t.encode())


def test_canonical_literals(spark, file, tmp_path):
    build(spark, file, str(tmp_path / "st"), normalize_literals=True)
    st = RdfStore.open(spark, str(tmp_path / "st"), in_memory=True)
    assert st.query("SELECT (COUNT(DISTINCT ?n) AS ?k) { ?s <http://e/depth> ?n }").first()["k"] == 1


def test_stream(spark, file, tmp_path):
    incoming, out = tmp_path / "in", str(tmp_path / "store")
    incoming.mkdir()
    (incoming / "1.nq").write_text(LINES, encoding="utf-8")
    for _ in range(2):
        append_to_store(read_stream(spark, str(incoming)), out, str(tmp_path / "ck")).awaitTermination()
    (incoming / "2.nq").write_text(LINES + "<http://e/new> <http://e/says> <http://e/x> .\n", encoding="utf-8")
    append_to_store(read_stream(spark, str(incoming)), out, str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(out + "/quads").count() == 9
    st = RdfStore.open(spark, out)
    assert st.meta["quads"] == 9 and st.meta["repeats"] is True and st.meta["counts"]["<http://e/says>"] == 7 and len(st) == 8
    assert match(read_stream(spark, str(incoming)), Triple(Var("s"), Iri("http://e/depth"), Var("o"))).df.isStreaming


def test_a_store_stays_right_as_it_grows(spark, tmp_path):
    """The same triple in more graphs: the union still has it once."""
    (tmp_path / "one.nq").write_text("<http://e/s> <http://e/p> <http://e/o> <http://e/first> .\n")
    build(spark, str(tmp_path / "one.nq"), str(tmp_path / "st"), by_object=True)
    assert RdfStore.open(spark, str(tmp_path / "st")).meta["repeats"] is False
    incoming = tmp_path / "in"
    incoming.mkdir()
    (incoming / "1.nq").write_text("".join(f"<http://e/{s}> <http://e/p> <http://e/o> <http://e/g{g}> .\n" for s, g in (("s", 1), ("s", 2), ("t", 1))) + "no statement at all\n")
    with pytest.raises(Exception, match="not a statement"):
        append_to_store(read_stream(spark, str(incoming)), str(tmp_path / "st"), str(tmp_path / "ck0")).awaitTermination()
    with pytest.raises(ValueError, match="rejected"):
        append_to_store(read_stream(spark, str(incoming), strict=False), str(tmp_path / "st"), str(tmp_path / "ck1"))
    append_to_store(read_stream(spark, str(incoming), strict=False), str(tmp_path / "st"), str(tmp_path / "ck1"), str(tmp_path / "bad")).awaitTermination()
    assert [r[0] for r in spark.read.text(str(tmp_path / "bad")).select("value").collect()] == ["no statement at all"]
    st = RdfStore.open(spark, str(tmp_path / "st"))
    assert st.meta["repeats"] is True and st.meta["quads"] == 4 and len(st) == 2
    assert st.query("SELECT (COUNT(*) AS ?n) { ?s ?p ?o }").first()["n"] == 2
    assert st.query("SELECT ?s { ?s <http://e/p> <http://e/o> }").count() == 2
    build(spark, str(tmp_path / "one.nq"), str(tmp_path / "coded"), "dictionary")
    with pytest.raises(Exception, match="layout"):
        append_to_store(read_stream(spark, str(incoming), strict=False), str(tmp_path / "coded"), str(tmp_path / "ck2"), str(tmp_path / "bad2")).awaitTermination()


@pytest.mark.parametrize("layout", ["spelled", "dictionary"])
def test_layouts_answer_alike(spark, file, tmp_path, layout):
    build(spark, file, str(tmp_path / "st"), layout, by_object=True)
    st, plain = RdfStore.open(spark, str(tmp_path / "st")), RdfStore.from_nquads(spark, file)
    texts = (
        "SELECT ?s ?o { ?s <http://e/says> ?o }",
        "SELECT ?s { ?s ?p 'port' }",
        "SELECT ?g ?s { GRAPH ?g { ?s ?p 'port' } }",
        "SELECT ?x { ?x <http://e/says> ?x }",
        "SELECT ?x { <http://e/nowhere> ?x ?y }",
        "SELECT ?g { GRAPH ?g { } }",
        "SELECT ?s ?o { GRAPH <http://e/coast> { ?s ?p ?o } }",
        "SELECT ?a ?b { ?a <http://e/says> 'port' ; <http://e/depth> ?b }",
        "SELECT ?o FROM <http://e/coast> { ?s ?p ?o }",
        "SELECT ?o FROM NAMED <http://e/coast> { GRAPH ?g { ?s ?p ?o } }",
        "SELECT ?s ?x { ?s <http://e/says>* ?x }",
        "ASK { <http://e/turku> <http://e/says> 'port' }",
    )
    for i, text in enumerate(texts):
        for union in (True, False) if i < 2 else (True,):
            a, b = (sorted(map(tuple, x.query(text, union=union, results="terms").collect()), key=repr) for x in (st, plain))
            assert a == b, (text, union)
    df = st.query("SELECT ?s { ?s <http://e/says> 'port' }")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # one scan, of the copy by object; or one of the numbers and one of the terms, for what is bound
    if layout == "spelled":
        assert plan.count("FileScan") == 1 and all("/by_object/" in f for f in df.inputFiles())
    else:
        assert plan.count("FileScan") == 2 and "EqualTo(p," in plan and "EqualTo(o," in plan
    st.close()
    with pytest.raises(ValueError, match="closed"):
        st.query("ASK { ?s ?p ?o }")


def test_view_and_quads_agree(spark):
    """The same queries over the tables, and over the quads that the view stands for."""
    view = warehouse(spark, SF, ("region", "nation", "supplier", "customer"))
    from quadrille.engine import query
    from quadrille.plans.compiler import Scope
    from quadrille.sources.quads import QuadSource

    quads = QuadSource(view.triples(Scope("var", "g")).cache())
    for text in (
        "SELECT ?n ?r { ?s <urn:p:s_name> ?n ; <urn:p:s_nationkey>/<urn:p:n_regionkey> ?k . ?k <urn:p:r_name> ?r }",
        "SELECT ?r (COUNT(*) AS ?n) (SUM(?b) AS ?t) { ?c <urn:p:c_nationkey> ?k ; <urn:p:c_acctbal> ?x BIND(<http://www.w3.org/2001/XMLSchema#integer>(?x) AS ?b) ?k <urn:p:n_regionkey> ?r } GROUP BY ?r",
        "SELECT ?c { ?c <urn:p:c_acctbal> ?b FILTER(?b > 9000) MINUS { ?c <urn:p:c_mktsegment> 'BUILDING' } }",
        "SELECT ?g (COUNT(*) AS ?n) { GRAPH ?g { ?s ?p ?o } } GROUP BY ?g",
        "SELECT ?p ?o { <urn:t:nation/3> ?p ?o }",
        "SELECT ?s { ?s ?p <urn:t:nation/3> }",
        "SELECT ?s ?p { ?s ?p 'BUILDING' }",
        "SELECT ?g ?s ?p { GRAPH ?g { ?s ?p 3 } }",
        "SELECT ?s { ?s ?p ?s }",
        "SELECT ?s ?o { ?s ?p ?o FILTER(!STRSTARTS(STR(?s), 'urn:t:customer/') && STRSTARTS(STR(?s), 'urn:t:')) }",
        "SELECT ?s ?o { ?s ?p ?o FILTER(STRSTARTS(STR(?s), 'urn:t:customer/14')) }",
        "SELECT ?n ?c { ?k <urn:p:n_name> ?n OPTIONAL { ?c <urn:p:c_nationkey> ?k ; <urn:p:c_acctbal> ?b FILTER(?b < 0) } }",
    ):
        a, b = (sorted(map(tuple, query(spark, s, text, results="terms").collect()), key=repr) for s in (view, quads))
        assert a == b and a, text


def test_keys_of_several_parts(spark):
    view = warehouse(spark, SF, ("conversations", "lineitem"))
    from quadrille.engine import query

    (row,) = view.tables["conversations"].df.orderBy("conv_id", "turn").limit(1).collect()
    ask = lambda key: query(spark, view, f"SELECT ?r {{ <urn:t:{key}> <urn:p:role> ?r }}")
    assert [r[0] for r in ask(f"conversations/{row['conv_id']}/{row['turn']}").collect()] == [row["role"]]
    for key in ("conversations/7", "conversations/1/2/3", "conversations/x/0", "conversations/01/0", "lineitem/7"):
        assert query(spark, view, f"SELECT ?r {{ <urn:t:{key}> ?p ?r }}").collect() == ask(key).collect() == []


def test_plans(spark):
    """Filters and columns reach the scan; a star is one scan; joins on keys are equi-joins."""
    plan = catalog.run("any_predicate", spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "EqualTo(n_nationkey,3)" in plan
    plan = catalog.run("graph_count", spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "customer.parquet" not in plan and plan.count("FileScan") <= 3
    plan = catalog.run("exists_correlated", spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "LeftSemi" in plan
    df = catalog.run("bgp_star", spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "EqualTo(c_mktsegment,BUILDING)" in plan
    for name in ("bgp_snowflake", "optional_filter", "minus", "not_exists", "group_sum"):
        plan = catalog.run(name, spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan, name


SOME = ["bgp_star", "bgp_snowflake", "optional_nullable_key", "minus_nullable", "exists_in_expression", "values_undef", "group_sum", "group_concat", "graph_variable", "path_plus", "order_distinct_hidden", "string_functions", "casts", "construct", "filter_date", "having_exists", "order_exists", "aggregate_exists", "order_distinct_mixed", "values_undef_two", "skewed_join", "exists_in_optional", "path_optional", "any_object", "store_graph_count", "store_chain", "coded_chain", "coded_graph_scan", "store_statements"]


@pytest.mark.parametrize("name", SOME)
def test_catalogue(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    cur = con.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    want = sorted(repr(tuple(float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in r)) for r in cur.fetchall())
    got = sorted(repr(tuple(float(r[c]) if isinstance(r[c], (int, float)) and not isinstance(r[c], bool) else r[c] for c in columns)) for r in catalog.queries()[name](spark, SF).collect())
    assert got == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
