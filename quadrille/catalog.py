"""The registered queries: SPARQL over the RDF view of the driver's tables, and over stores built from it, and the SQL that says the same.

Sums of doubles depend on the order of addition, so both sides round them to two places.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.engine import query
from quadrille.operators.paths import shared_root
from quadrille.plans.compiler import Scope
from quadrille.sources.mapping import MappedSource, warehouse
from quadrille.sources.store import RdfStore, build
from quadrille.terms import Iri


@dataclass(frozen=True)
class Entry:
    sparql: str
    sql: str | None
    rounded: tuple[str, ...] = ()
    casts: tuple[tuple[str, str], ...] = ()
    tags: bool = False


def _p(text: str) -> str:
    """`:name` is a column, `t:`, `g:` tables and graphs."""
    return "PREFIX : <urn:p:> PREFIX t: <urn:t:> PREFIX g: <urn:g:> PREFIX xsd: <http://www.w3.org/2001/XMLSchema#>\n" + text


IRI_C, IRI_O, IRI_N = "'urn:t:customer/' || c_custkey", "'urn:t:orders/' || o_orderkey", "'urn:t:nation/' || n_nationkey"

ENTRIES: dict[str, Entry] = {
    # ---- basic graph patterns, projections, filters
    "bgp_star": Entry(
        'SELECT ?n ?b WHERE { ?c :c_mktsegment "BUILDING" ; :c_name ?n ; :c_acctbal ?b FILTER(?b > 5000) }',
        "SELECT c_name AS n, c_acctbal AS b FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000",
    ),
    "bgp_chain": Entry(
        "SELECT ?o ?c ?n ?r { ?o :o_custkey ?c . ?c :c_nationkey ?k . ?k :n_name ?n ; :n_regionkey ?g . ?g :r_name ?r }",
        f"SELECT {IRI_O} AS o, {IRI_C} AS c, n_name AS n, r_name AS r FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    ),
    "bgp_snowflake": Entry(
        'SELECT ?rn (SUM(?p * (1 - ?d)) AS ?revenue) (COUNT(*) AS ?lines) { ?l :l_orderkey ?o ; :l_suppkey ?s ; :l_extendedprice ?p ; :l_discount ?d . ?o :o_custkey ?c . ?c :c_nationkey ?n . ?s :s_nationkey ?n . ?n :n_regionkey ?r . ?r :r_name ?rn } GROUP BY ?rn',
        "SELECT r_name AS rn, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey AND s_nationkey = c_nationkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY r_name",
        ("revenue",),
    ),
    "point_lookup": Entry("SELECT ?n ?x { t:customer\\/7 :c_name ?n ; :c_acctbal ?x }", "SELECT c_name AS n, c_acctbal AS x FROM customer WHERE c_custkey = 7"),
    "object_lookup": Entry("SELECT ?o { ?o :o_custkey t:customer\\/7 }", f"SELECT {IRI_O} AS o FROM orders WHERE o_custkey = 7"),
    "any_predicate": Entry(
        "SELECT (STR(?p) AS ?pred) (STR(?o) AS ?obj) { t:nation\\/3 ?p ?o }",
        "SELECT 'urn:p:n_nationkey' AS pred, CAST(n_nationkey AS VARCHAR) AS obj FROM nation WHERE n_nationkey = 3 UNION ALL SELECT 'urn:p:n_name', n_name FROM nation WHERE n_nationkey = 3 UNION ALL SELECT 'urn:p:n_regionkey_lit', CAST(n_regionkey AS VARCHAR) FROM nation WHERE n_nationkey = 3 UNION ALL SELECT 'urn:p:n_regionkey', 'urn:t:region/' || n_regionkey FROM nation WHERE n_nationkey = 3",
    ),
    "blank_node_variable": Entry("SELECT ?n { [ :c_nationkey [ :n_name ?n ] ] }", "SELECT n_name AS n FROM customer JOIN nation ON c_nationkey = n_nationkey"),
    "unbound_projection": Entry("SELECT ?n (BOUND(?zz) AS ?b) { ?r :r_name ?n }", "SELECT r_name AS n, false AS b FROM region"),
    "unsatisfiable": Entry('SELECT ?x { "literal" :c_name ?x }', "SELECT c_name AS x FROM customer WHERE false"),
    "repeated_variable": Entry("SELECT ?o ?q { ?o :o_orderkey ?q ; :o_custkey_lit ?q }", f"SELECT {IRI_O} AS o, o_orderkey AS q FROM orders WHERE o_orderkey = o_custkey"),
    "shared_literal": Entry("SELECT (COUNT(*) AS ?n) { ?a :c_nationkey_lit ?k . ?b :s_nationkey_lit ?k }", "SELECT count(*) AS n FROM customer JOIN supplier ON c_nationkey = s_nationkey"),
    "filter_range": Entry("SELECT ?l ?q { ?l :l_quantity ?q ; :l_discount ?d FILTER(?q >= 10 && ?q < 12 && ?d > 0.05) }", "SELECT 'urn:t:lineitem/' || l_orderkey || '/' || l_linenumber || '/' || l_partkey || '/' || l_suppkey || '/' || strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l, l_quantity AS q FROM lineitem WHERE l_quantity >= 10 AND l_quantity < 12 AND l_discount > 0.05"),
    "filter_arith": Entry("SELECT ?o ?t { ?o :o_totalprice ?t ; :o_orderkey ?k FILTER(?t * 2 + ?k > 400000) }", f"SELECT {IRI_O} AS o, o_totalprice AS t FROM orders WHERE o_totalprice * 2 + o_orderkey > 400000"),
    "filter_class": Entry(
        'SELECT ?x (COUNT(*) AS ?n) { ?c ?p ?o FILTER(STRSTARTS(STR(?c), "urn:t:customer/")) BIND(IF(isIRI(?o), "iri", IF(isNumeric(?o), "number", "text")) AS ?x) } GROUP BY ?x',
        "SELECT x, sum(n) AS n FROM (SELECT unnest(['iri', 'number', 'text']) AS x, unnest([count(c_nationkey), count(c_custkey) + count(c_nationkey) + count(c_acctbal), count(c_name) + count(c_mktsegment)]) AS n FROM customer) GROUP BY x",
    ),
    "filter_datatype": Entry(
        'SELECT ?n (COUNT(*) AS ?k) { ?s ?p ?o FILTER(STRSTARTS(STR(?s), "urn:t:orders/")) BIND(STR(DATATYPE(?o)) AS ?n) } GROUP BY ?n',
        "SELECT CASE WHEN n <> '' THEN 'http://www.w3.org/2001/XMLSchema#' || n END AS n, k FROM (SELECT unnest(['integer', 'double', 'string', 'dateTime', '']) AS n, unnest([count(o_orderkey) + count(o_custkey), count(o_totalprice), count(o_orderstatus) + count(o_orderpriority), count(o_orderdate), count(o_custkey)]) AS k FROM orders)",
    ),
    "filter_regex": Entry("SELECT ?n { ?p :p_name ?n FILTER REGEX(?n, \"^part_1[0-9]*5$\", \"i\") }", "SELECT p_name AS n FROM part WHERE regexp_matches(p_name, '^part_1[0-9]*5$', 'i')"),
    "filter_lang": Entry("SELECT ?d (LANG(?t) AS ?l) { ?d :text ?t ; :source ?s FILTER langMatches(LANG(?t), \"de\") }", "SELECT 'urn:t:documents/' || doc_id AS d, lang AS l FROM documents WHERE lang = 'de'", tags=True),
    "filter_in": Entry('SELECT ?k (COUNT(*) AS ?n) { ?o :o_orderpriority ?k FILTER(?k IN ("1-URGENT", "2-HIGH") ) } GROUP BY ?k', "SELECT o_orderpriority AS k, count(*) AS n FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1"),
    "filter_not_in": Entry('SELECT ?k (COUNT(*) AS ?n) { ?o :o_orderstatus ?k FILTER(?k NOT IN ("F") ) } GROUP BY ?k', "SELECT o_orderstatus AS k, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F') GROUP BY 1"),
    "filter_date": Entry('SELECT (COUNT(*) AS ?n) { ?o :o_orderdate ?d FILTER(?d >= "1995-01-01T00:00:00"^^xsd:dateTime && ?d < "1996-01-01T00:00:00"^^xsd:dateTime) }', "SELECT count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01'"),
    "filter_error": Entry('SELECT ?n { ?r :r_name ?n FILTER(?n + 1 > 2 || ?n = "ASIA") }', "SELECT r_name AS n FROM region WHERE r_name = 'ASIA'"),
    "filter_two_variables": Entry("SELECT (COUNT(*) AS ?n) { ?l :l_quantity ?q ; :l_extendedprice ?p ; :l_partkey ?x . ?x :p_retailprice ?r FILTER(?p > ?q * ?r) }", "SELECT count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_extendedprice > l_quantity * p_retailprice"),
    "filter_same_term": Entry("SELECT (COUNT(*) AS ?n) { ?c :c_nationkey ?x . ?s :s_nationkey ?y FILTER sameTerm(?x, ?y) }", "SELECT count(*) AS n FROM customer JOIN supplier ON c_nationkey = s_nationkey"),
    # ---- joins
    "band_join": Entry("SELECT (COUNT(*) AS ?n) { ?o :o_custkey ?c ; :o_totalprice ?t . ?c :c_acctbal ?b FILTER(?t < ?b + 50000 && ?t > ?b - 50000) }", "SELECT count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice < c_acctbal + 50000 AND o_totalprice > c_acctbal - 50000"),
    "cross_product": Entry("SELECT ?a ?b { ?x :r_name ?a . ?y :r_name ?b }", "SELECT a.r_name AS a, b.r_name AS b FROM region a, region b"),
    "group_join": Entry("SELECT ?n ?m { { ?c :c_nationkey ?k ; :c_name ?n } { ?k :n_name ?m } }", "SELECT c_name AS n, n_name AS m FROM customer JOIN nation ON c_nationkey = n_nationkey"),
    "optional": Entry("SELECT ?n ?o { ?c :c_name ?n OPTIONAL { ?o :o_custkey ?c } }", f"SELECT c_name AS n, {IRI_O} AS o FROM customer LEFT JOIN orders ON o_custkey = c_custkey"),
    "optional_filter": Entry("SELECT ?n ?t { ?c :c_name ?n ; :c_acctbal ?b OPTIONAL { ?o :o_custkey ?c ; :o_totalprice ?t FILTER(?t > ?b * 40) } }", "SELECT c_name AS n, o_totalprice AS t FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > c_acctbal * 40"),
    "optional_constant_false": Entry("SELECT ?n ?t { ?c :c_name ?n OPTIONAL { ?c :c_acctbal ?t FILTER(false) } }", "SELECT c_name AS n, CAST(NULL AS DOUBLE) AS t FROM customer"),
    "optional_nested": Entry("SELECT ?n ?o ?q { ?c :c_name ?n OPTIONAL { ?o :o_custkey ?c OPTIONAL { ?l :l_orderkey ?o ; :l_quantity ?q FILTER(?q > 49) } } }", f"SELECT c_name AS n, {IRI_O} AS o, l_quantity AS q FROM customer LEFT JOIN (orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_quantity > 49) ON o_custkey = c_custkey"),
    "optional_nullable_key": Entry('SELECT ?n ?k ?m { ?c :c_name ?n OPTIONAL { ?c :c_nationkey ?k ; :c_acctbal ?b FILTER(?b > 9000) } OPTIONAL { ?k :n_name ?m ; :n_regionkey t:region\\/2 } FILTER(BOUND(?k)) }', "WITH r AS (SELECT * FROM nation WHERE n_regionkey = 2), a AS (SELECT c_name, CASE WHEN c_acctbal > 9000 THEN c_nationkey END AS k FROM customer) SELECT c_name AS n, 'urn:t:nation/' || coalesce(k, n_nationkey) AS k, n_name AS m FROM a LEFT JOIN r ON k = n_nationkey OR k IS NULL WHERE coalesce(k, n_nationkey) IS NOT NULL"),
    "negated_optional": Entry("SELECT ?n { ?c :c_name ?n OPTIONAL { ?o :o_custkey ?c ; :o_totalprice ?t FILTER(?t > 300000) } FILTER(!BOUND(?o)) }", "SELECT c_name AS n FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)"),
    "minus": Entry("SELECT ?n { ?c :c_name ?n MINUS { ?o :o_custkey ?c } }", "SELECT c_name AS n FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"),
    "minus_disjoint": Entry("SELECT ?n { ?c :r_name ?n MINUS { ?o :n_name ?m } }", "SELECT r_name AS n FROM region"),
    "minus_nullable": Entry("SELECT ?n ?k { ?c :c_name ?n OPTIONAL { ?c :c_nationkey ?k ; :c_acctbal ?b FILTER(?b > 5000) } MINUS { ?k :n_regionkey t:region\\/1 } }", "SELECT c_name AS n, CASE WHEN c_acctbal > 5000 THEN 'urn:t:nation/' || c_nationkey END AS k FROM customer WHERE NOT coalesce(c_acctbal > 5000 AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1), false)"),
    "exists": Entry("SELECT ?n { ?c :c_name ?n FILTER EXISTS { ?o :o_custkey ?c ; :o_orderstatus \"P\" } }", "SELECT c_name AS n FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')"),
    "not_exists": Entry("SELECT ?n { ?c :c_name ?n FILTER NOT EXISTS { ?o :o_custkey ?c } }", "SELECT c_name AS n FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)"),
    "exists_correlated": Entry("SELECT ?n { ?c :c_name ?n ; :c_acctbal ?b FILTER EXISTS { ?o :o_custkey ?c ; :o_totalprice ?t FILTER(?t > ?b * 50) } }", "SELECT c_name AS n FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > c_acctbal * 50)"),
    "exists_in_expression": Entry("SELECT ?n { ?c :c_name ?n ; :c_acctbal ?b FILTER(?b < 0 || EXISTS { ?o :o_custkey ?c ; :o_totalprice ?t FILTER(?t > 400000) }) }", "SELECT c_name AS n FROM customer WHERE c_acctbal < 0 OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)"),
    "exists_uncorrelated": Entry("SELECT ?n { ?r :r_name ?n FILTER EXISTS { ?c :c_mktsegment \"BUILDING\" } }", "SELECT r_name AS n FROM region WHERE EXISTS (SELECT 1 FROM customer WHERE c_mktsegment = 'BUILDING')"),
    "values_join": Entry('SELECT ?s ?n { VALUES ?s { "BUILDING" "MACHINERY" } ?c :c_mktsegment ?s ; :c_name ?n }', "SELECT c_mktsegment AS s, c_name AS n FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')"),
    "values_undef": Entry('SELECT ?s ?k { VALUES (?s ?k) { ("BUILDING" UNDEF) ("MACHINERY" 3) } ?c :c_mktsegment ?s ; :c_nationkey_lit ?k }', "SELECT c_mktsegment AS s, CAST(c_nationkey AS BIGINT) AS k FROM customer WHERE c_mktsegment = 'BUILDING' OR (c_mktsegment = 'MACHINERY' AND c_nationkey = 3)"),
    "values_trailing": Entry("SELECT ?n { ?r :r_name ?n ; :r_regionkey ?k } VALUES ?k { 1 3 }", "SELECT r_name AS n FROM region WHERE r_regionkey IN (1, 3)"),
    "union": Entry("SELECT ?n { { ?c :c_name ?n ; :c_acctbal ?b FILTER(?b > 9000) } UNION { ?s :s_name ?n } }", "SELECT c_name AS n FROM customer WHERE c_acctbal > 9000 UNION ALL SELECT s_name FROM supplier"),
    "union_partial": Entry("SELECT ?k ?n ?m { { ?k :n_name ?n } UNION { ?k :n_regionkey_lit ?m } }", f"SELECT {IRI_N} AS k, n_name AS n, CAST(NULL AS BIGINT) AS m FROM nation UNION ALL SELECT {IRI_N}, NULL, n_regionkey FROM nation"),
    "bind": Entry("SELECT ?n ?x { ?c :c_name ?n ; :c_acctbal ?b BIND(?b * 2 AS ?x) FILTER(?x > 15000) }", "SELECT c_name AS n, c_acctbal * 2 AS x FROM customer WHERE c_acctbal * 2 > 15000"),
    "select_expression": Entry("SELECT (CONCAT(?n, \"!\") AS ?x) { ?r :r_name ?n }", "SELECT r_name || '!' AS x FROM region"),
    "subselect": Entry("SELECT ?n ?k { ?c :c_name ?n { SELECT ?c (COUNT(?o) AS ?k) { ?o :o_custkey ?c } GROUP BY ?c HAVING(COUNT(?o) > 15) } }", "SELECT c_name AS n, count(*) AS k FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name HAVING count(*) > 15"),
    "skewed_join": Entry("SELECT (COUNT(*) AS ?n) { ?a :o_orderstatus ?x . ?b :l_linestatus ?x }", "SELECT count(*) AS n FROM orders JOIN lineitem ON o_orderstatus = l_linestatus"),
    "composite_key": Entry("SELECT ?r ?x { t:conversations\\/1\\/0 :role ?r ; :text ?x }", "SELECT role AS r, text AS x FROM conversations WHERE conv_id = 1 AND turn = 0"),
    "ill_formed_key": Entry("SELECT ?r { t:conversations\\/1 ?p ?r }", "SELECT role AS r FROM conversations WHERE false"),
    "any_object": Entry("SELECT ?s (STR(?p) AS ?x) { ?s ?p t:nation\\/3 }", "SELECT '<urn:t:customer/' || c_custkey || '>' AS s, 'urn:p:c_nationkey' AS x FROM customer WHERE c_nationkey = 3 UNION ALL SELECT '<urn:t:supplier/' || s_suppkey || '>', 'urn:p:s_nationkey' FROM supplier WHERE s_nationkey = 3"),
    "exists_in_optional": Entry("SELECT ?n ?o { ?c :c_name ?n OPTIONAL { ?o :o_custkey ?c FILTER EXISTS { ?l :l_orderkey ?o ; :l_quantity ?q FILTER(?q > 49) } } }", f"SELECT c_name AS n, {IRI_O} AS o FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)"),
    "exists_union": Entry('SELECT ?n { ?k :n_name ?n FILTER EXISTS { { ?c :c_nationkey ?k ; :c_acctbal ?b FILTER(?b > 9900) } UNION { ?s :s_nationkey ?k ; :s_acctbal ?b FILTER(?b > 9900) } } }', "SELECT n_name AS n FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900 UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 9900)"),
    "having_exists": Entry('SELECT ?c (COUNT(*) AS ?n) { ?o :o_custkey ?c } GROUP BY ?c HAVING(COUNT(*) > 5 && EXISTS { ?c :c_mktsegment "BUILDING" })', "SELECT 'urn:t:customer/' || o_custkey AS c, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING' GROUP BY o_custkey HAVING count(*) > 5"),
    "order_exists": Entry("SELECT ?n { ?c :c_name ?n ; :c_custkey ?k } ORDER BY DESC(EXISTS { ?o :o_custkey ?c ; :o_totalprice ?t FILTER(?t > 400000) }) ?k LIMIT 10", "SELECT c_name AS n FROM customer ORDER BY EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000) DESC, c_custkey LIMIT 10"),
    "aggregate_exists": Entry("SELECT ?m (SUM(IF(EXISTS { ?o :o_custkey ?c }, 1, 0)) AS ?n) { ?c :c_mktsegment ?m } GROUP BY ?m", "SELECT c_mktsegment AS m, CAST(sum(CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 1 ELSE 0 END) AS BIGINT) AS n FROM customer GROUP BY 1"),
    "values_undef_two": Entry('SELECT ?s ?k (COUNT(*) AS ?n) { VALUES (?s ?k) { ("BUILDING" UNDEF) (UNDEF 3) } { SELECT ?s ?k { ?c :c_mktsegment ?s ; :c_nationkey_lit ?k } } } GROUP BY ?s ?k', "SELECT c_mktsegment AS s, CAST(c_nationkey AS BIGINT) AS k, count(*) * (CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey = 3 THEN 2 ELSE 1 END) AS n FROM customer WHERE c_mktsegment = 'BUILDING' OR c_nationkey = 3 GROUP BY c_mktsegment, c_nationkey"),
    "truth_values": Entry('SELECT ?n (IF(?n, "yes", "no") AS ?a) (IF(?k, "yes", "no") AS ?b) (IF(?k - ?k, "yes", "no") AS ?c) (IF(SUBSTR(?n, 99), "yes", "no") AS ?d) { ?r :r_name ?n ; :r_regionkey ?k }', "SELECT r_name AS n, 'yes' AS a, CASE WHEN r_regionkey <> 0 THEN 'yes' ELSE 'no' END AS b, 'no' AS c, 'no' AS d FROM region"),
    "graph_position": Entry("SELECT (COUNT(*) AS ?n) { GRAPH ?g { ?g ?p ?o FILTER(STRSTARTS(STR(?g), \"urn:g:nation\")) } }", "SELECT CAST(0 AS BIGINT) AS n"),
    "graph_nested": Entry("SELECT ?g ?n { GRAPH g:region { ?r :r_name ?m GRAPH ?g { ?k :n_name ?n ; :n_regionkey ?r } } }", "SELECT unnest(['urn:g:nation', 'urn:g:nation2']) AS g, n_name AS n FROM nation JOIN region ON n_regionkey = r_regionkey"),
    # ---- aggregates
    "count_all": Entry("SELECT (COUNT(*) AS ?n) { ?l :l_quantity ?q }", "SELECT count(*) AS n FROM lineitem"),
    "count_variable": Entry("SELECT (COUNT(?o) AS ?n) (COUNT(*) AS ?m) { ?c :c_name ?x OPTIONAL { ?o :o_custkey ?c } }", "SELECT count(o_orderkey) AS n, count(*) AS m FROM customer LEFT JOIN orders ON o_custkey = c_custkey"),
    "count_distinct": Entry("SELECT (COUNT(DISTINCT ?s) AS ?n) { ?l :l_suppkey ?s }", "SELECT count(DISTINCT l_suppkey) AS n FROM lineitem"),
    "count_distinct_all": Entry("SELECT (COUNT(DISTINCT *) AS ?n) { ?l :l_suppkey ?s ; :l_partkey ?p ; :l_returnflag ?r }", "SELECT count(*) AS n FROM lineitem"),
    "count_empty": Entry('SELECT (COUNT(*) AS ?n) (SUM(?q) AS ?s) { ?l :l_quantity ?q FILTER(?q < 0) }', "SELECT CAST(0 AS BIGINT) AS n, CAST(0 AS DOUBLE) AS s"),
    "group_empty": Entry("SELECT ?q (COUNT(*) AS ?n) { ?l :l_quantity ?q FILTER(?q < 0) } GROUP BY ?q", "SELECT l_quantity AS q, count(*) AS n FROM lineitem WHERE false GROUP BY 1"),
    "group_count": Entry("SELECT ?f ?s (COUNT(*) AS ?n) { ?l :l_returnflag ?f ; :l_linestatus ?s } GROUP BY ?f ?s", "SELECT l_returnflag AS f, l_linestatus AS s, count(*) AS n FROM lineitem GROUP BY 1, 2"),
    "group_sum": Entry(
        'SELECT ?f ?s (SUM(?q) AS ?sum_qty) (SUM(?p) AS ?sum_base) (SUM(?p * (1 - ?d)) AS ?sum_disc) (SUM(?p * (1 - ?d) * (1 + ?t)) AS ?sum_charge) (COUNT(*) AS ?n) { ?l :l_returnflag ?f ; :l_linestatus ?s ; :l_quantity ?q ; :l_extendedprice ?p ; :l_discount ?d ; :l_tax ?t ; :l_shipdate ?w FILTER(?w <= "1998-09-02T00:00:00"^^xsd:dateTime) } GROUP BY ?f ?s',
        "SELECT l_returnflag AS f, l_linestatus AS s, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2",
        ("sum_qty", "sum_base", "sum_disc", "sum_charge"),
    ),
    "group_avg": Entry("SELECT ?m (AVG(?b) AS ?a) { ?c :c_mktsegment ?m ; :c_acctbal ?b } GROUP BY ?m", "SELECT c_mktsegment AS m, round(avg(c_acctbal), 2) AS a FROM customer GROUP BY 1", ("a",)),
    "group_avg_integer": Entry("SELECT (xsd:double(AVG(?s)) AS ?a) { ?p :p_size ?s }", "SELECT round(avg(p_size), 6) AS a FROM part", ("a:6",)),
    "group_sum_integer": Entry("SELECT ?b (SUM(?s) AS ?t) { ?p :p_brand ?b ; :p_size ?s } GROUP BY ?b", "SELECT p_brand AS b, CAST(sum(p_size) AS BIGINT) AS t FROM part GROUP BY 1"),
    "sum_distinct": Entry("SELECT (SUM(DISTINCT ?s) AS ?t) { ?p :p_size ?s }", "SELECT CAST(sum(DISTINCT p_size) AS BIGINT) AS t FROM part"),
    "sum_error": Entry("SELECT ?n (SUM(?x) AS ?t) (COUNT(?x) AS ?k) { ?r :r_name ?n BIND(?n + 1 AS ?x) } GROUP BY ?n", "SELECT r_name AS n, CAST(NULL AS BIGINT) AS t, CAST(0 AS BIGINT) AS k FROM region"),
    "min_max": Entry("SELECT ?s (MIN(?d) AS ?lo) (MAX(?d) AS ?hi) (MIN(?p) AS ?lp) (MAX(?p) AS ?hp) { ?o :o_orderstatus ?s ; :o_orderdate ?d ; :o_orderpriority ?p } GROUP BY ?s", "SELECT o_orderstatus AS s, min(o_orderdate) AS lo, max(o_orderdate) AS hi, min(o_orderpriority) AS lp, max(o_orderpriority) AS hp FROM orders GROUP BY 1"),
    "having": Entry("SELECT ?c (SUM(?t) AS ?v) { ?o :o_custkey ?c ; :o_totalprice ?t } GROUP BY ?c HAVING (SUM(?t) > 2000000 && COUNT(*) > 3)", "SELECT 'urn:t:customer/' || o_custkey AS c, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY o_custkey HAVING sum(o_totalprice) > 2000000 AND count(*) > 3", ("v",)),
    "group_concat": Entry('SELECT ?r (GROUP_CONCAT(?n; SEPARATOR="|") AS ?x) { ?k :n_name ?n ; :n_regionkey_lit ?r } GROUP BY ?r', "SELECT CAST(n_regionkey AS BIGINT) AS r, string_agg(n_name, '|' ORDER BY n_name) AS x FROM nation GROUP BY 1"),
    "group_expression": Entry("SELECT ?y (COUNT(*) AS ?n) { ?o :o_orderdate ?d } GROUP BY (YEAR(?d) AS ?y)", "SELECT CAST(year(o_orderdate) AS BIGINT) AS y, count(*) AS n FROM orders GROUP BY 1"),
    "group_sample": Entry("SELECT ?n (SAMPLE(?n) AS ?m) { ?r :r_name ?n } GROUP BY ?n", "SELECT r_name AS n, r_name AS m FROM region"),
    "group_unbound_key": Entry("SELECT ?o (COUNT(*) AS ?n) { ?c :c_name ?x OPTIONAL { ?o :o_custkey ?c ; :o_totalprice ?t FILTER(?t > 450000) } } GROUP BY ?o", f"SELECT CASE WHEN o_orderkey IS NOT NULL THEN {IRI_O} END AS o, count(*) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 450000 GROUP BY o_orderkey"),
    # ---- distinct, order, slices, forms
    "distinct": Entry("SELECT DISTINCT ?m ?n { ?c :c_mktsegment ?m ; :c_nationkey ?k . ?k :n_name ?n }", "SELECT DISTINCT c_mktsegment AS m, n_name AS n FROM customer JOIN nation ON c_nationkey = n_nationkey"),
    "distinct_predicate": Entry("SELECT DISTINCT (STR(?p) AS ?x) { ?s ?p ?o FILTER(isIRI(?o)) }", "SELECT unnest(['urn:p:c_nationkey', 'urn:p:s_nationkey', 'urn:p:n_regionkey', 'urn:p:o_custkey', 'urn:p:l_orderkey', 'urn:p:l_partkey', 'urn:p:l_suppkey', 'urn:p:doc_id']) AS x"),
    "reduced": Entry("SELECT REDUCED ?m { ?c :c_mktsegment ?m }", "SELECT DISTINCT c_mktsegment AS m FROM customer"),
    "order_limit": Entry("SELECT ?n ?b { ?c :c_name ?n ; :c_acctbal ?b } ORDER BY DESC(?b) ?n LIMIT 10", "SELECT c_name AS n, c_acctbal AS b FROM customer ORDER BY c_acctbal DESC, c_name LIMIT 10"),
    "order_offset": Entry("SELECT ?n { ?k :n_name ?n } ORDER BY ?n LIMIT 7 OFFSET 5", "SELECT n_name AS n FROM nation ORDER BY n_name LIMIT 7 OFFSET 5"),
    "order_expression": Entry("SELECT ?n { ?c :c_name ?n ; :c_acctbal ?b ; :c_custkey ?k } ORDER BY ABS(?b) ?k LIMIT 5", "SELECT c_name AS n FROM customer ORDER BY abs(c_acctbal), c_custkey LIMIT 5"),
    "order_unbound_first": Entry("SELECT ?n ?o { ?c :c_name ?n OPTIONAL { ?c :c_acctbal ?o FILTER(?o > 0) } } ORDER BY ?o ?n LIMIT 20", "SELECT c_name AS n, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS o FROM customer ORDER BY o NULLS FIRST, n LIMIT 20"),
    "order_distinct_hidden": Entry("SELECT DISTINCT ?m { ?c :c_mktsegment ?m ; :c_acctbal ?b } ORDER BY ?b LIMIT 3", "SELECT c_mktsegment AS m FROM customer GROUP BY 1 ORDER BY min(c_acctbal) LIMIT 3"),
    "order_distinct_mixed": Entry("SELECT DISTINCT ?m { ?c :c_mktsegment ?m ; :c_nationkey_lit ?k ; :c_acctbal ?b } ORDER BY ?k DESC(?b) LIMIT 3", "SELECT m FROM (SELECT c_mktsegment AS m, c_nationkey AS k, c_acctbal AS b, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey, c_acctbal DESC) AS i FROM customer) WHERE i = 1 ORDER BY k, b DESC LIMIT 3"),
    "limit_zero": Entry("SELECT ?n { ?r :r_name ?n } LIMIT 0", "SELECT r_name AS n FROM region LIMIT 0"),
    "ask": Entry('ASK { ?c :c_mktsegment "BUILDING" ; :c_acctbal ?b FILTER(?b > 9990) }', "SELECT count(*) > 0 AS ask FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 9990"),
    "ask_false": Entry('ASK { ?c :c_mktsegment "NOTHING" }', "SELECT false AS ask"),
    "construct": Entry("CONSTRUCT { ?c <urn:x:in> ?n . ?n <urn:x:name> ?m } { ?c :c_nationkey ?n . ?n :n_name ?m }", "SELECT '<urn:t:customer/' || c_custkey || '>' AS s, '<urn:x:in>' AS p, '<urn:t:nation/' || c_nationkey || '>' AS o FROM customer UNION SELECT '<urn:t:nation/' || n_nationkey || '>', '<urn:x:name>', '\"' || n_name || '\"' FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)"),
    "describe": Entry("DESCRIBE t:region\\/1", "SELECT '<urn:t:region/1>' AS s, '<urn:p:r_name>' AS p, '\"' || r_name || '\"' AS o FROM region WHERE r_regionkey = 1 UNION ALL SELECT '<urn:t:region/1>', '<urn:p:r_regionkey>', '\"1\"^^<http://www.w3.org/2001/XMLSchema#integer>'"),
    # ---- graphs
    "graph_named": Entry("SELECT ?n { GRAPH g:nation { ?k :n_name ?n } }", "SELECT n_name AS n FROM nation"),
    "graph_star": Entry("SELECT ?n ?b { GRAPH g:customer { ?c :c_name ?n ; :c_acctbal ?b } FILTER(?b < 0) }", "SELECT c_name AS n, c_acctbal AS b FROM customer WHERE c_acctbal < 0"),
    "graph_variable": Entry("SELECT ?g ?n { GRAPH ?g { ?k :n_name ?n } }", "SELECT unnest(['urn:g:nation', 'urn:g:nation2']) AS g, n_name AS n FROM nation"),
    "graph_count": Entry("SELECT (STR(?g) AS ?x) (COUNT(*) AS ?n) { GRAPH ?g { ?s ?p ?o FILTER(STRSTARTS(STR(?s), \"urn:t:nation/\") || STRSTARTS(STR(?s), \"urn:t:region/\")) } } GROUP BY ?g", "SELECT unnest(['urn:g:nation', 'urn:g:nation2']) AS x, 4 * count(*) AS n FROM nation UNION ALL SELECT 'urn:g:region', 2 * count(*) FROM region"),
    "graph_names": Entry("SELECT DISTINCT (STR(?g) AS ?x) { GRAPH ?g { ?s :n_name ?o } }", "SELECT unnest(['urn:g:nation', 'urn:g:nation2']) AS x"),
    "graph_join": Entry("SELECT ?n ?r { GRAPH g:nation2 { ?k :n_name ?n ; :n_regionkey ?z } GRAPH g:region { ?z :r_name ?r } }", "SELECT n_name AS n, r_name AS r FROM nation JOIN region ON n_regionkey = r_regionkey"),
    "graph_chain_one": Entry("SELECT ?g ?n ?r { GRAPH ?g { ?k :n_name ?n ; :n_regionkey ?z . ?z :r_name ?r } }", "SELECT 'x' AS g, n_name AS n, 'x' AS r FROM nation WHERE false"),
    "graph_optional": Entry("SELECT ?g ?n ?r { GRAPH ?g { ?k :n_name ?n ; :n_regionkey ?z OPTIONAL { ?z :r_name ?r } } }", "SELECT unnest(['urn:g:nation', 'urn:g:nation2']) AS g, n_name AS n, CAST(NULL AS VARCHAR) AS r FROM nation"),
    "graph_not_exists": Entry("SELECT ?g ?n { GRAPH ?g { ?k :n_name ?n FILTER NOT EXISTS { ?k :n_regionkey t:region\\/1 } } }", "SELECT unnest(['urn:g:nation', 'urn:g:nation2']) AS g, n_name AS n FROM nation WHERE n_regionkey <> 1"),
    "graph_empty_group": Entry("SELECT (COUNT(?g) AS ?n) { GRAPH ?g { } }", "SELECT CAST(15 AS BIGINT) AS n"),
    "union_default": Entry("SELECT (COUNT(*) AS ?n) { ?k :n_name ?n2 }", "SELECT count(*) AS n FROM nation"),
    "from": Entry("SELECT (STR(?m) AS ?n) FROM g:region FROM g:supplier WHERE { { ?r :r_name ?m } UNION { ?k :n_name ?m } }", "SELECT r_name AS n FROM region"),
    "from_named": Entry("SELECT ?g ?n FROM NAMED g:nation2 WHERE { GRAPH ?g { ?k :n_name ?n } }", "SELECT 'urn:g:nation2' AS g, n_name AS n FROM nation"),
    # ---- property paths
    "path_sequence": Entry("SELECT ?n ?r { ?c :c_name ?n ; :c_nationkey/:n_regionkey/:r_name ?r }", "SELECT c_name AS n, r_name AS r FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"),
    "path_inverse": Entry("SELECT ?r ?c { ?k ^:c_nationkey ?c . ?k :n_name ?r }", f"SELECT n_name AS r, {IRI_C} AS c FROM customer JOIN nation ON c_nationkey = n_nationkey"),
    "path_alternative": Entry("SELECT ?x { ?k :n_name|:r_name ?x }", "SELECT n_name AS x FROM nation UNION ALL SELECT r_name FROM region"),
    "path_negated": Entry("SELECT (STR(?x) AS ?y) { t:region\\/2 !(:r_regionkey|:other) ?x }", "SELECT r_name AS y FROM region WHERE r_regionkey = 2"),
    "path_optional": Entry(
        "SELECT (COUNT(*) AS ?n) { GRAPH g:nation { ?x :n_regionkey? ?y } }",
        "SELECT 2 * count(*) + count(DISTINCT n_name) + count(DISTINCT n_regionkey) + (SELECT count(*) FROM (SELECT n_nationkey FROM nation UNION SELECT n_regionkey FROM nation)) AS n FROM nation",
    ),
    "path_plus": Entry(
        "SELECT ?m (COUNT(*) AS ?n) { ?x (:o_custkey|:c_nationkey|:n_regionkey)+ ?y . ?y :r_name ?m } GROUP BY ?m",
        "WITH c AS (SELECT c_custkey, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey) SELECT r_name AS m, count(*) AS n FROM (SELECT n_regionkey FROM nation UNION ALL SELECT n_regionkey FROM c UNION ALL SELECT n_regionkey FROM orders JOIN c ON o_custkey = c_custkey) JOIN region ON n_regionkey = r_regionkey GROUP BY 1",
    ),
    "path_graph": Entry("SELECT ?g (COUNT(*) AS ?n) { GRAPH ?g { ?x :n_regionkey+ ?y } } GROUP BY ?g", "SELECT unnest(['<urn:g:nation>', '<urn:g:nation2>']) AS g, count(*) AS n FROM nation"),
    "path_star": Entry("SELECT (COUNT(*) AS ?n) { ?x (:c_nationkey|:n_regionkey)* t:region\\/1 }", "SELECT 1 + (SELECT count(*) FROM nation WHERE n_regionkey = 1) + (SELECT count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1) AS n"),
    # ---- functions
    "string_functions": Entry(
        'SELECT ?n (UCASE(?n) AS ?u) (LCASE(?n) AS ?l) (STRLEN(?n) AS ?k) (SUBSTR(?n, 2, 3) AS ?s) (STRBEFORE(?n, "_") AS ?b) (STRAFTER(?n, "_") AS ?a) (CONTAINS(?n, "1") AS ?c) (STRENDS(?n, "1") AS ?e) (REPLACE(?n, "[0-9]+", "#") AS ?r) (ENCODE_FOR_URI(CONCAT(?n, " ~*ä")) AS ?x) { ?z :n_name ?n }',
        "SELECT n_name AS n, upper(n_name) AS u, lower(n_name) AS l, CAST(length(n_name) AS BIGINT) AS k, substr(n_name, 2, 3) AS s, split_part(n_name, '_', 1) AS b, CASE WHEN n_name LIKE '%\\_%' ESCAPE '\\' THEN substr(n_name, position('_' IN n_name) + 1) ELSE '' END AS a, contains(n_name, '1') AS c, ends_with(n_name, '1') AS e, regexp_replace(n_name, '[0-9]+', '#', 'g') AS r, n_name || '%20~%2A%C3%A4' AS x FROM nation",
    ),
    "date_functions": Entry("SELECT ?d (YEAR(?d) AS ?y) (MONTH(?d) AS ?m) (DAY(?d) AS ?a) (HOURS(?d) AS ?h) (MINUTES(?d) AS ?i) (TZ(?d) AS ?z) { ?e :ts ?d }", "SELECT ts AS d, CAST(year(ts) AS BIGINT) AS y, CAST(month(ts) AS BIGINT) AS m, CAST(day(ts) AS BIGINT) AS a, CAST(hour(ts) AS BIGINT) AS h, CAST(minute(ts) AS BIGINT) AS i, '' AS z FROM events"),
    "math_functions": Entry("SELECT ?b (ABS(?b) AS ?a) (CEIL(?b) AS ?c) (FLOOR(?b) AS ?f) (ROUND(?b) AS ?r) (-?b AS ?m) { ?x :c_acctbal ?b }", "SELECT c_acctbal AS b, abs(c_acctbal) AS a, ceil(c_acctbal) AS c, floor(c_acctbal) AS f, floor(c_acctbal + 0.5) AS r, -c_acctbal AS m FROM customer"),
    "hash_functions": Entry("SELECT ?n (MD5(?n) AS ?a) (SHA1(?n) AS ?b) (SHA256(?n) AS ?c) { ?r :r_name ?n }", "SELECT r_name AS n, md5(r_name) AS a, sha1(r_name) AS b, sha256(r_name) AS c FROM region"),
    "hash_functions_long": Entry("SELECT (STRLEN(SHA384(?n)) AS ?a) (STRLEN(SHA512(?n)) AS ?b) { ?r :r_name ?n }", "SELECT CAST(96 AS BIGINT) AS a, CAST(128 AS BIGINT) AS b FROM region"),
    "casts": Entry('SELECT ?k (xsd:string(?k) AS ?s) (xsd:double(?k) AS ?d) (xsd:boolean(?k) AS ?b) (xsd:integer("x") AS ?e) { ?r :r_regionkey ?k }', "SELECT CAST(r_regionkey AS BIGINT) AS k, CAST(r_regionkey AS VARCHAR) AS s, CAST(r_regionkey AS DOUBLE) AS d, r_regionkey <> 0 AS b, CAST(NULL AS DECIMAL(38,0)) AS e FROM region"),
    "conditionals": Entry('SELECT ?n ?x ?y ?z { ?r :r_name ?n ; :r_regionkey ?k BIND(IF(?k > 2, "big", "small") AS ?x) BIND(COALESCE(?nope, ?k + ?n, ?k * 10) AS ?y0) BIND(xsd:double(?y0) AS ?y) BIND(IF(?n + 1, "a", "b") AS ?z) }', "SELECT r_name AS n, CASE WHEN r_regionkey > 2 THEN 'big' ELSE 'small' END AS x, CAST(r_regionkey * 10 AS DOUBLE) AS y, CAST(NULL AS VARCHAR) AS z FROM region"),
    "term_functions": Entry('SELECT ?k (STR(?k) AS ?s) (isIRI(?k) AS ?i) (isLiteral(?n) AS ?l) (isBlank(?k) AS ?b) (STR(DATATYPE(?n)) AS ?d) (LANG(STRLANG(?n, "EN")) AS ?g) (STR(IRI(CONCAT("urn:z:", ?n))) AS ?u) (STR(STRDT("5", xsd:integer)) AS ?t) { ?k :n_name ?n }', f"SELECT {IRI_N} AS k, {IRI_N} AS s, true AS i, true AS l, false AS b, 'http://www.w3.org/2001/XMLSchema#string' AS d, 'en' AS g, 'urn:z:' || n_name AS u, '5' AS t FROM nation"),
    "arithmetic": Entry("SELECT ?k (?k + 1 AS ?a) (?k - 2 AS ?b) (?k * 3 AS ?c) (xsd:double(?k / 4) AS ?d) (?k / 0 AS ?e) { ?r :r_regionkey ?k }", "SELECT CAST(r_regionkey AS BIGINT) AS k, r_regionkey + 1 AS a, r_regionkey - 2 AS b, r_regionkey * 3 AS c, r_regionkey / 4.0 AS d, CAST(NULL AS DOUBLE) AS e FROM region", casts=(("a", "int"), ("b", "int"), ("c", "int"), ("e", "double"))),
}


_CUSTOMER_QUADS = "(SELECT count(c_custkey) + count(c_name) + 2 * count(c_nationkey) + count(c_acctbal) + count(c_mktsegment) FROM customer)"
_PART_QUADS = "(SELECT count(p_partkey) + count(p_name) + count(p_brand) + count(p_type) + count(p_size) + count(p_retailprice) FROM part)"
_SUPPLIER_QUADS = "(SELECT count(s_suppkey) + count(s_name) + 2 * count(s_nationkey) + count(s_acctbal) FROM supplier)"
_NATION_QUADS, _REGION_QUADS = "(SELECT 4 * count(*) FROM nation)", "(SELECT 2 * count(*) FROM region)"

#: Over a store that is built from the quads of STORED, some 220,000 at sf0.1. Terms are spelled, as a store's columns are not typed.
STORED = ("region", "nation", "supplier", "customer", "part")
STORE_ENTRIES: dict[str, Entry] = {
    "lookup": Entry("SELECT ?n ?m { t:customer\\/7 :c_name ?n ; :c_mktsegment ?m }", "SELECT '\"' || c_name || '\"' AS n, '\"' || c_mktsegment || '\"' AS m FROM customer WHERE c_custkey = 7"),
    "object_lookup": Entry("SELECT ?c { ?c ?p t:nation\\/3 }", "SELECT '<urn:t:customer/' || c_custkey || '>' AS c FROM customer WHERE c_nationkey = 3 UNION ALL SELECT '<urn:t:supplier/' || s_suppkey || '>' FROM supplier WHERE s_nationkey = 3"),
    "ask": Entry('ASK { t:part\\/1 :p_brand ?b . ?x :p_brand ?b FILTER(?x != t:part\\/1) }', "SELECT count(*) > 1 AS ask FROM part WHERE p_brand = (SELECT p_brand FROM part WHERE p_partkey = 1)"),
    "scan": Entry("SELECT ?c ?m { ?c :c_mktsegment ?m }", "SELECT '<urn:t:customer/' || c_custkey || '>' AS c, '\"' || c_mktsegment || '\"' AS m FROM customer"),
    "count": Entry("SELECT (COUNT(*) AS ?n) { ?s ?p ?o }", f"SELECT {_CUSTOMER_QUADS} + {_PART_QUADS} + {_SUPPLIER_QUADS} + {_NATION_QUADS} + {_REGION_QUADS} AS n"),
    "predicates": Entry("SELECT ?p (COUNT(*) AS ?n) { ?s ?p ?o FILTER(STRSTARTS(STR(?p), \"urn:p:s_\")) } GROUP BY ?p", "SELECT '<urn:p:' || unnest(['s_suppkey', 's_name', 's_nationkey', 's_nationkey_lit', 's_acctbal']) || '>' AS p, count(*) AS n FROM supplier"),
    "graph_names": Entry("SELECT DISTINCT ?g { GRAPH ?g { ?s ?p ?o } }", "SELECT unnest(['<urn:g:region>', '<urn:g:nation>', '<urn:g:nation2>', '<urn:g:supplier>', '<urn:g:customer>', '<urn:g:part>']) AS g"),
    "graph_count": Entry("SELECT ?g (COUNT(*) AS ?n) { GRAPH ?g { ?s ?p ?o } } GROUP BY ?g", f"SELECT '<urn:g:region>' AS g, {_REGION_QUADS} AS n UNION ALL SELECT '<urn:g:nation>', {_NATION_QUADS} UNION ALL SELECT '<urn:g:nation2>', {_NATION_QUADS} UNION ALL SELECT '<urn:g:supplier>', {_SUPPLIER_QUADS} UNION ALL SELECT '<urn:g:customer>', {_CUSTOMER_QUADS} UNION ALL SELECT '<urn:g:part>', {_PART_QUADS}"),
    "graph_scan": Entry("SELECT ?g ?s ?o { GRAPH ?g { ?s :p_brand ?o } }", "SELECT '<urn:g:part>' AS g, '<urn:t:part/' || p_partkey || '>' AS s, '\"' || p_brand || '\"' AS o FROM part"),
    "star": Entry('SELECT ?n ?k { ?c :c_mktsegment "BUILDING" ; :c_name ?n ; :c_nationkey ?k }', "SELECT '\"' || c_name || '\"' AS n, '<urn:t:nation/' || c_nationkey || '>' AS k FROM customer WHERE c_mktsegment = 'BUILDING'"),
    "chain": Entry("SELECT ?c ?r { ?c :c_nationkey ?k . ?k :n_regionkey ?g . ?g :r_name ?r }", "SELECT '<urn:t:customer/' || c_custkey || '>' AS c, '\"' || r_name || '\"' AS r FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"),
    "path": Entry("SELECT ?r (COUNT(*) AS ?n) { ?c :c_nationkey/:n_regionkey ?r } GROUP BY ?r", "SELECT '<urn:t:region/' || n_regionkey || '>' AS r, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"),
    "optional": Entry("SELECT ?n ?s { ?k :n_name ?n OPTIONAL { ?s :s_nationkey ?k } }", "SELECT '\"' || n_name || '\"' AS n, '<urn:t:supplier/' || s_suppkey || '>' AS s FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey"),
    "minus": Entry("SELECT ?k { ?k :n_name ?n MINUS { ?s :s_nationkey ?k ; :s_nationkey_lit 3 } }", "SELECT '<urn:t:nation/' || n_nationkey || '>' AS k FROM nation WHERE n_nationkey <> 3 OR n_nationkey NOT IN (SELECT s_nationkey FROM supplier)"),
    "not_exists": Entry("SELECT ?k { ?k :n_name ?n FILTER NOT EXISTS { ?s :s_nationkey ?k } }", "SELECT '<urn:t:nation/' || n_nationkey || '>' AS k FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier)"),
    "filter": Entry("SELECT ?p ?s { ?p :p_size ?s FILTER(DATATYPE(?s) = xsd:integer && ?s < 5) }", "SELECT '<urn:t:part/' || p_partkey || '>' AS p, '\"' || p_size || '\"^^<http://www.w3.org/2001/XMLSchema#integer>' AS s FROM part WHERE p_size < 5"),
    "distinct": Entry("SELECT DISTINCT ?b ?t { ?p :p_brand ?b ; :p_type ?t }", "SELECT DISTINCT '\"' || p_brand || '\"' AS b, '\"' || p_type || '\"' AS t FROM part"),
    "order_limit": Entry("SELECT ?n { ?c :c_custkey ?k ; :c_name ?n } ORDER BY DESC(?k) LIMIT 5", "SELECT '\"' || c_name || '\"' AS n FROM customer ORDER BY c_custkey DESC LIMIT 5"),
    "union": Entry("SELECT ?n { { ?x :r_name ?n } UNION { ?x :n_name ?n } }", "SELECT '\"' || r_name || '\"' AS n FROM region UNION ALL SELECT '\"' || n_name || '\"' FROM nation"),
    "values": Entry("SELECT ?k ?c { VALUES ?k { t:nation\\/1 t:nation\\/2 } ?c :c_nationkey ?k }", "SELECT '<urn:t:nation/' || c_nationkey || '>' AS k, '<urn:t:customer/' || c_custkey || '>' AS c FROM customer WHERE c_nationkey IN (1, 2)"),
    "band": Entry("SELECT (COUNT(*) AS ?n) { t:part\\/1 :p_size ?r . ?p :p_size ?s FILTER(?s < ?r + 3 && ?s > ?r - 3) }", "SELECT count(*) AS n FROM part, (SELECT p_size AS r FROM part WHERE p_partkey = 1) WHERE p_size < r + 3 AND p_size > r - 3"),
}
#: Those that are asked of the dictionary layout too.
CODED = ("lookup", "object_lookup", "scan", "count", "graph_names", "graph_count", "graph_scan", "star", "chain", "optional", "minus")

_OPEN: dict[tuple[str, str, bool], MappedSource] = {}
_BUILT: dict[tuple[str, str, str], RdfStore] = {}


def built(spark: SparkSession, sf_dir: str, layout: str) -> RdfStore:
    """The store of a folder's STORED tables, built once in a session, in the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir, layout)
    if key not in _BUILT:
        path = f"{shared_root(spark)}/quadrille/store-{uuid.uuid4().hex[:12]}"
        build(spark, warehouse(spark, sf_dir, STORED).triples(Scope("var", "g")), path, layout, by_object=True)
        _BUILT[key] = RdfStore.open(spark, path)
    return _BUILT[key]


def run_stored(name: str, spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    return built(spark, sf_dir, layout).query(_p(STORE_ENTRIES[name].sparql))


def store_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store's own interface: statements of a pattern, with their graphs."""
    rows = built(spark, sf_dir, "spelled").quads(p=Iri("urn:p:n_name"))
    return rows.select("s", "o", F.array_join("graphs", " ").alias("graphs"))


def store_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir, "spelled").contexts()


def store_graph_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir, "spelled").graph("urn:g:nation2").triples(o=Iri("urn:t:region/1"))


_INTERFACE = {
    "store_statements": (store_statements, "SELECT '<urn:t:nation/' || n_nationkey || '>' AS s, '\"' || n_name || '\"' AS o, '<urn:g:nation2> <urn:g:nation>' AS graphs FROM nation"),
    "store_contexts": (store_contexts, "SELECT unnest(['<urn:g:region>', '<urn:g:nation>', '<urn:g:nation2>', '<urn:g:supplier>', '<urn:g:customer>', '<urn:g:part>']) AS g"),
    "store_graph_triples": (store_graph_triples, "SELECT '<urn:t:nation/' || n_nationkey || '>' AS s, '<urn:p:n_regionkey>' AS p, '<urn:t:region/1>' AS o FROM nation WHERE n_regionkey = 1"),
}


def opened(spark: SparkSession, sf_dir: str, tags: bool) -> MappedSource:
    """The view over a folder, opened once in a session: it holds schemas, no rows."""
    key = (spark.sparkContext.applicationId, sf_dir, tags)
    if key not in _OPEN:
        _OPEN[key] = warehouse(spark, sf_dir, tag_documents=tags)
    return _OPEN[key]


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    e = ENTRIES[name]
    df = query(spark, opened(spark, sf_dir, e.tags), _p(e.sparql))
    for c in e.rounded:
        c, _, places = c.partition(":")
        df = df.withColumn(c, F.round(c, int(places or 2)))
    for c, kind in e.casts:
        df = df.withColumn(c, F.col(c).cast(kind))
    return df


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {n: lambda spark, sf_dir, n=n: run(n, spark, sf_dir) for n in ENTRIES}
    found |= {f"store_{n}": lambda spark, sf_dir, n=n: run_stored(n, spark, sf_dir, "spelled") for n in STORE_ENTRIES}
    found |= {f"coded_{n}": lambda spark, sf_dir, n=n: run_stored(n, spark, sf_dir, "dictionary") for n in CODED}
    return found | {n: f for n, (f, _) in _INTERFACE.items()}


def oracle_sql() -> dict[str, str]:
    found = {n: e.sql for n, e in ENTRIES.items() if e.sql}
    found |= {f"store_{n}": e.sql for n, e in STORE_ENTRIES.items()} | {f"coded_{n}": STORE_ENTRIES[n].sql for n in CODED}
    return found | {n: sql for n, (_, sql) in _INTERFACE.items()}
