"""Small stores from a short notation, and answers as sets."""

from collections import Counter

from quadrille.sources.store import RdfStore

XSD = "http://www.w3.org/2001/XMLSchema#"
PREFIXES = f"PREFIX : <http://e/> PREFIX xsd: <{XSD}> "


def full(t: str) -> str:
    """`:a` is an IRI, `7`, `7.5` numbers, `"x"^^byte` a typed literal."""
    if t.startswith(":"):
        return f"<http://e/{t[1:]}>"
    if t and t.lstrip("-").isdigit():
        return f'"{t}"^^<{XSD}integer>'
    if "^^" in t and not t.endswith(">"):
        body, _, dt = t.rpartition("^^")
        return f"{body}^^<{XSD}{dt}>"
    return t


def store(spark, rows, **options) -> RdfStore:
    """rows: (s, p, o) or (s, p, o, g)."""
    return RdfStore.from_rows(spark, [(full(r[0]), full(r[1]), full(r[2]), full(r[3]) if len(r) > 3 else "") for r in rows], **options)


def answers(st, text: str, **more) -> Counter:
    rows = st.query(PREFIXES + text, results="terms", **more).collect()
    return Counter(tuple(r) for r in rows)


def expected(*rows) -> Counter:
    return Counter(tuple(None if x is None else full(x) for x in (r if isinstance(r, tuple) else (r,))) for r in rows)
