"""Value semantics of filters: errors, promotion, effective truth, equality, order."""

import pytest

from tests.helpers import answers, expected, store

#: Depths of wells, some of them known to be dry or not.
WELLS = [(":w1", ":depth", "3"), (":w2", ":depth", "8"), (":w3", ":depth", "15"), (":w4", ":depth", "22"), (":w5", ":depth", "40"), (":w2", ":dry", '"true"^^boolean'), (":w4", ":dry", '"false"^^boolean')]
#: Twelve knots, and what is not.
SPEEDS = [
    (":int", ":speed", "12"),
    (":dec", ":speed", '"12.00"^^decimal'),
    (":flt", ":speed", '"1.2E1"^^float'),
    (":dbl", ":speed", '"12e0"^^double'),
    (":short", ":speed", '"12"^^short'),
    (":nan", ":speed", '"NaN"^^float'),
    (":inf", ":speed", '"INF"^^double'),
    (":wide", ":speed", '"40000"^^short'),
    (":text", ":speed", '"12"'),
    (":dutch", ":speed", '"twaalf"@nl'),
    (":day", ":speed", '"2021-06-01"^^date'),
    (":link", ":speed", ":fast"),
    (":own", ":speed", '"12"^^<http://e/knots>'),
]
#: Truth values of all sorts.
SIGNS = [(":no", ":sign", '"false"^^boolean'), (":yes", ":sign", '"true"^^boolean'), (":perhaps", ":sign", '"perhaps"^^boolean'), (":zero", ":sign", '"0.0"^^decimal'), (":minus", ":sign", "-1"), (":inf", ":sign", '"-INF"^^double'), (":word", ":sign", '"x"'), (":void", ":sign", '""'), (":space", ":sign", '" "@nl'), (":own", ":sign", '"1"^^<http://e/knots>'), (":link", ":sign", ":x"), (":day", ":sign", '"2021-06-01"^^date')]
SMALL = [(":f", ":part", '"0.3"^^float'), (":e", ":part", '"0.3"^^double'), (":d", ":part", '"0.3"^^decimal'), (":up", ":part", '"16777217"^^float')]
DEPARTURES = [
    (":utc", ":at", '"2022-05-04T10:00:00Z"^^dateTime'),
    (":east", ":at", '"2022-05-04T13:30:00+03:30"^^dateTime'),
    (":open", ":at", '"2022-05-04T10:00:00"^^dateTime'),
    (":old", ":at", '"-0753-04-21T00:00:00Z"^^dateTime'),
    (":wrong", ":at", '"2022-04-31T00:00:00Z"^^dateTime'),
    (":night", ":at", '"2022-05-03T24:00:00Z"^^dateTime'),
]

CASES = [
    ("an error beside truth", WELLS, "?s :depth ?d FILTER(?gone || ?d >= 22)", [":w4", ":w5"]),
    ("an error beside falsehood", WELLS, "?s :depth ?d FILTER(!(?gone && ?d >= 22))", [":w1", ":w2", ":w3"]),
    ("an error after falsehood", WELLS, "?s :depth ?d FILTER(!(?d >= 22 && ?gone))", [":w1", ":w2", ":w3"]),
    ("a flag that is bound", WELLS, "?s :depth ?d OPTIONAL { ?s :dry ?f } FILTER(BOUND(?f) && !?f)", [":w4"]),
    ("a comparison has a value", WELLS, "?s :depth ?d FILTER((?d > 10) = false && DATATYPE(?d > 10) = xsd:boolean && STR(?d > 10) = 'false' && sameTerm(?d > 10, false))", [":w1", ":w2"]),
    ("among values", WELLS, "?s :depth ?d FILTER(?d IN (8.0, 4e1))", [":w2", ":w5"]),
    ("not among values", WELLS, "?s :depth ?d FILTER(?d NOT IN (3, 8, 15.0))", [":w4", ":w5"]),
    ("among none", WELLS, "?s :depth ?d FILTER(?d IN ())", []),
    ("equal numbers of all types", SPEEDS, "?s :speed ?v FILTER(?v = 12)", [":int", ":dec", ":flt", ":dbl", ":short"]),
    ("unequal, where that is known", SPEEDS, "?s :speed ?v FILTER(?v != 12)", [":nan", ":inf", ":text", ":dutch", ":day", ":link"]),
    ("not among, where that is known", SPEEDS, "?s :speed ?v FILTER(?v NOT IN (12))", [":nan", ":inf", ":text", ":dutch", ":day", ":link"]),
    ("above", SPEEDS, "?s :speed ?v FILTER(?v > 11)", [":int", ":dec", ":flt", ":dbl", ":short", ":inf"]),
    ("not above", SPEEDS, "?s :speed ?v FILTER(!(?v > 11))", [":nan"]),
    ("an equal text", SPEEDS, "?s :speed ?v FILTER(?v = '12')", [":text"]),
    ("another text", SPEEDS, "?s :speed ?v FILTER(?v != '12')", [":int", ":dec", ":flt", ":dbl", ":short", ":nan", ":inf", ":dutch", ":day", ":link"]),
    ("texts in order", SPEEDS, "?s :speed ?v FILTER(?v <= '2')", [":text"]),
    ("an equal text with a tag", SPEEDS, "?s :speed ?v FILTER(?v = 'twaalf'@NL)", [":dutch"]),
    ("texts with tags have no order", SPEEDS, "?s :speed ?v FILTER(?v > 'a'@nl)", []),
    ("an equal resource", SPEEDS, "?s :speed ?v FILTER(?v = :fast)", [":link"]),
    ("a type of one's own equals itself", SPEEDS, "?s :speed ?v FILTER(?v = '12'^^:knots)", [":own"]),
    ("a constant out of its type's range", SPEEDS, '?s :speed ?v FILTER(?v < "40000"^^xsd:short)', []),
    ("one term", SPEEDS, '?s :speed ?v FILTER(sameTerm(?v, "40000"^^xsd:short) || sameTerm(?v, "12"^^xsd:short))', [":wide", ":short"]),
    ("numbers", SPEEDS, "?s :speed ?v FILTER(isNumeric(?v))", [":int", ":dec", ":flt", ":dbl", ":short", ":nan", ":inf"]),
    ("resources and tags", SPEEDS, "?s :speed ?v FILTER(isIRI(?v) || LANG(?v) = 'nl')", [":link", ":dutch"]),
    ("products of all types", SPEEDS, "?s :speed ?v FILTER(?v * 2 = 24)", [":int", ":dec", ":flt", ":dbl", ":short"]),
    ("a product's type", SPEEDS, "?s :speed ?v FILTER(DATATYPE(?v * 1.5) = xsd:decimal || DATATYPE(?v * 1) = xsd:float)", [":int", ":dec", ":short", ":flt", ":nan"]),
    ("between two rows", SPEEDS, "?s :speed ?v . ?t :speed ?u FILTER(?t = :inf && ?v < ?u)", [":int", ":dec", ":flt", ":dbl", ":short"]),
    ("truth", SIGNS, "?s :sign ?v FILTER(?v)", [":yes", ":minus", ":inf", ":word", ":space"]),
    ("no truth", SIGNS, "?s :sign ?v FILTER(!?v)", [":no", ":perhaps", ":zero", ":void"]),
    ("a decimal against a float", SMALL, "?s :part ?v FILTER(?v = 0.3)", [":f", ":e", ":d"]),
    ("a float against a double", SMALL, "?s :part ?v FILTER(?v = 3e-1)", [":e", ":d"]),
    ("a float is rounded", SMALL, "?s :part ?v FILTER(?v = 16777216)", [":up"]),
    ("one instant", DEPARTURES, '?s :at ?t FILTER(?t = "2022-05-04T10:00:00Z"^^xsd:dateTime)', [":utc", ":east"]),
    ("without a zone, undecided", DEPARTURES, '?s :at ?t FILTER(?t != "2022-05-04T10:00:00Z"^^xsd:dateTime)', [":old", ":night"]),
    ("far enough to decide", DEPARTURES, '?s :at ?t FILTER(?t < "2022-05-06T00:00:00"^^xsd:dateTime)', [":utc", ":east", ":open", ":old", ":night"]),
    ("the end of a day", DEPARTURES, '?s :at ?t FILTER(?t = "2022-05-04T00:00:00Z"^^xsd:dateTime)', [":night"]),
    ("beyond 64 bits", [(":far", ":steps", "70000000000000000000"), (":near", ":steps", "7")], "?s :steps ?n FILTER(?n > 9300000000000000000)", [":far"]),
    ("as it is written", [(":a", ":code", '"007"^^integer'), (":b", ":code", "7")], '?s :code ?c FILTER(STR(?c) = "007" || sameTerm(?c, 7))', [":a", ":b"]),
    ("a pattern that is none", WELLS, '?s :depth ?d FILTER(REGEX(STR(?d), "(") || !REGEX(STR(?d), "["))', []),
    ("the very end", [(":a", ":line", '"end"'), (":b", ":line", '"end\n"')], '?s :line ?t FILTER REGEX(?t, "d$")', [":a"]),
    ("flags", [(":a", ":name", '"N.O."'), (":b", ":name", '"nxo."')], '?s :name ?t FILTER REGEX(?t, "n.o", "iq")', [":a"]),
    ("tags and ranges", [(":a", ":word", '"ja"@nl'), (":b", ":word", '"ja"@nl-be'), (":c", ":word", '"ja"@nlx'), (":d", ":word", '"ja"')], '?s :word ?t FILTER langMatches(LANG(?t), "NL")', [":a", ":b"]),
    ("any tag", [(":a", ":word", '"ja"@nl'), (":d", ":word", '"ja"')], '?s :word ?t FILTER langMatches(LANG(?t), "*")', [":a"]),
    ("tags of arguments", [(":a", ":word", '"kade"@nl'), (":b", ":word", '"kade"@de'), (":c", ":word", '"kade"')], '?s :word ?t FILTER STRENDS(?t, "de"@nl)', [":a"]),
    ("a filter sees its own group", WELLS, "?s :depth ?d { ?t :dry ?f FILTER(?d > 5) }", []),
]


@pytest.fixture(scope="module")
def stores(spark):
    made = {}

    def get(rows):
        key = id(rows)
        if key not in made:
            st = store(spark, rows)
            st.df = st.df.cache()
            made[key] = st
        return made[key]

    return get


@pytest.mark.parametrize("name,rows,pattern,want", CASES, ids=[c[0] for c in CASES])
def test_filter(stores, name, rows, pattern, want):
    assert answers(stores(rows), f"SELECT ?s {{ {pattern} }}") == expected(*want)


FUNCTIONS = [
    ("CONCAT('ka'@nl, 'de'@nl)", '"kade"@nl'),
    ("CONCAT('ka'@nl, 'de')", '"kade"'),
    ("STRBEFORE('harbour'@en, 'b')", '"har"@en'),
    ("STRAFTER('harbour', 'q')", '""'),
    ("SUBSTR('harbour', 0, 3)", '"ha"'),
    ("STRLEN('Tromsø')", "6"),
    ("1 / 4", '"0.25"^^decimal'),
    ("7 / 0", None),
    ("7e0 / 0", '"INF"^^double'),
    ("-(3)", "-3"),
    ("ROUND(-2.5)", '"-2.0"^^decimal'),
    ("CEIL(2.1)", '"3.0"^^decimal'),
    ("ABS('-3'^^xsd:byte)", "3"),
    ("IF('x' + 1, 1, 2)", None),
    ("COALESCE('x' + 1, 9)", "9"),
    ("xsd:integer('12')", "12"),
    ("xsd:integer('1.5')", None),
    ("xsd:integer(-1.5)", "-1"),
    ("xsd:decimal('1e2')", None),
    ("xsd:boolean('T')", None),
    ("xsd:dateTime('2020-01-01')", '"2020-01-01T00:00:00"^^dateTime'),
    ("YEAR('-0044-03-15T01:02:03Z'^^xsd:dateTime)", "-44"),
    ("SECONDS('2020-03-15T01:02:03.5Z'^^xsd:dateTime)", '"3.5"^^decimal'),
    ("TZ('2020-03-15T01:02:03+05:30'^^xsd:dateTime)", '"+05:30"'),
    ("TIMEZONE('2020-03-15T01:02:03-05:30'^^xsd:dateTime)", '"-PT5H30M"^^dayTimeDuration'),
    ("ENCODE_FOR_URI('a b~*')", '"a%20b~%2A"'),
    ("REPLACE('abab', 'B', 'z', 'i')", '"azaz"'),
    ("STRDT('x', xsd:string)", '"x"'),
    ("IRI('http://e/q')", ":q"),
    ("DATATYPE('x'@en)", "<http://www.w3.org/1999/02/22-rdf-syntax-ns#langString>"),
    ("MD5('abc')", '"900150983cd24fb0d6963f7d28e17f72"'),
    ("<http://e/unknown>(1)", None),
    ("UCASE('x'@en)", '"X"@en'),
]


def test_functions(spark):
    st = store(spark, [(":a", ":b", ":c")])
    items = " ".join(f"({f} AS ?x{i})" for i, (f, _) in enumerate(FUNCTIONS))
    (row,) = answers(st, f"SELECT {items} {{ ?s ?p ?o }}")
    (want,) = expected(tuple(w for _, w in FUNCTIONS))
    assert {f: r for (f, _), r in zip(FUNCTIONS, row)} == {f: w for (f, _), w in zip(FUNCTIONS, want)}
