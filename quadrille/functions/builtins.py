"""Built-in functions of SPARQL 1.1, on Vals."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadrille.functions.values import DATATYPE, DEC, RANK, SPACE, XSD, Val, boolean, ebv, error, instant, is_literal, language, let, lexical, null, number, simple_text, term, text_of, written_datatype
from quadrille.terms import BAD_IRI, RDF


def string_argument(v: Val) -> tuple[Column, Column | None]:
    """Text and tag of a string literal; NULL for anything else."""
    if v.kind == "str":
        return v.col, None
    if v.kind != "term":
        return null(), None
    return let(v.col, lambda t: F.when(is_literal(t) & (t.endswith('"') | language(t).isNotNull()), lexical(t))), language(v.col)


def tagged(text: Column, tag: Column | None) -> Val:
    if tag is None:
        return Val("str", text)
    return Val("term", F.concat(F.lit('"'), text, F.lit('"'), F.coalesce(F.concat(F.lit("@"), tag), F.lit(""))))


def simple_argument(v: Val) -> Column:
    return v.col if v.kind == "str" else simple_text(v.col) if v.kind == "term" else null()


def _compatible(a: Column | None, b: Column | None) -> Column:
    """The second's tag, if any, is the first's."""
    if b is None:
        return F.lit(True)
    return b.isNull() | (F.lit(False) if a is None else F.coalesce(a == b, F.lit(False)))


def _java_pattern(pattern: str, flags: str) -> str | None:
    """An XPath pattern for Java, or None if it is no pattern."""
    if re.search(r"[^ismxq]", flags):
        return None
    if "q" in flags:
        out = re.sub(r"([^\w\s])", r"\\\1", pattern)
        return ("(?iu)" if "i" in flags else "") + out
    out, i, depth = [], 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            if i + 1 >= len(pattern):
                return None
            if pattern[i + 1] in "zZAbBGQE" or pattern[i + 1].isdigit() and depth:
                return None
            out.append(pattern[i : i + 2])
            i += 2
            continue
        if c == "[":
            # within a class Java reads '&&' as intersection, XPath does not
            depth += 1
        elif c == "]" and depth:
            depth -= 1
        if c == "$" and not depth and "m" not in flags:
            out.append(r"\z")
        elif c == "&" and depth:
            out.append(r"\&")
        elif c == "(" and not depth and pattern[i + 1 : i + 2] == "?" and pattern[i + 2 : i + 3] != ":":
            return None
        else:
            out.append(c)
        i += 1
    body = "".join(out)
    try:  # the check is Python's: what it refuses, Java refuses, in the patterns that XPath shares
        re.compile(re.sub(r"\\z", r"\\Z", re.sub(r"\\[pPiIcC](\{\w+\})?", "a", body)))
    except re.error:
        return None
    used = "".join(f for f in "ismx" if f in flags)
    return (f"(?{used}{'u' if 'i' in used else ''})" if used else "") + body


def regex(text: Val, pattern: str | None, flags: str | None) -> Val:
    """pattern and flags are constants; others are refused by the compiler."""
    body = _java_pattern(pattern, flags or "") if pattern is not None and flags is not None else None
    s, _ = string_argument(text)
    return Val("bool", s.rlike(body) if body is not None else null("boolean"))


def replace(text: Val, pattern: str | None, by: Val, flags: str | None) -> Val:
    body = _java_pattern(pattern or "", flags or "") if pattern is not None and flags is not None else None
    if body is None or re.search(body.replace(r"\z", r"\Z") if "(?" not in body[:2] else "x", "") and "(?" not in body[:2]:
        return error()  # a pattern that matches the empty string is an error
    s, tag = string_argument(text)
    return tagged(F.regexp_replace(s, F.lit(body), simple_argument(by)), tag)


def _both(a: Val, b: Val, f) -> Column:
    (x, tx), (y, ty) = string_argument(a), string_argument(b)
    return F.when(_compatible(tx, ty), f(x, y))


def lang_matches(tag: Val, range_: Val) -> Val:
    t, r = F.lower(simple_argument(tag)), F.lower(simple_argument(range_))
    return Val("bool", F.when(r == "*", t != "").otherwise((t == r) | t.startswith(F.concat(r, F.lit("-")))))


def _rounded(v: Val, f, exact) -> Val:
    if v.kind == "int":
        return v
    if v.kind == "dec":
        return Val("dec", exact(v.col).cast(DEC))
    if v.kind in ("flt", "dbl"):
        return Val(v.kind, f(v.col).cast("float" if v.kind == "flt" else "double"))
    if SPACE.get(v.kind, "n") != "n":
        return error()
    return Val("num", let(number(v), lambda x: F.when(x.isNotNull(), F.struct(x["r"].alias("r"), exact(x["d"]).cast(DEC).alias("d"), F.when(x["r"] < 2, exact(x["d"]).cast("double")).otherwise(f(x["f"])).alias("f")))))


def _kept(f):
    """floor and ceil of doubles without a detour through BIGINT."""
    big = lambda c: F.isnan(c) | (F.abs(c) >= 2.0**53)
    return lambda c: F.when(big(c), c).otherwise(f(F.when(~big(c), c)).cast("double"))


def _part(v: Val, i: int, kind: str) -> Val:
    """A part of a dateTime as it is written."""
    from quadrille.functions.values import DATETIME

    if v.kind == "ts":
        c = (F.year, F.month, F.dayofmonth, F.hour, F.minute)[i - 1](v.col).cast("bigint") if i < 6 else F.regexp_extract(text_of(v), DATETIME, 6).cast(DEC)
        return Val(kind, c)
    if v.kind != "term":
        return error()
    lex = let(v.col, lambda t: F.when(written_datatype(t).isin(XSD + "dateTime", XSD + "date") & (instant(lexical(t), False).isNotNull() | instant(lexical(t), True).isNotNull()), lexical(t)))
    return Val(kind, F.nullif(F.regexp_extract(lex, DATETIME, i), F.lit("")).try_cast("bigint" if kind == "int" else DEC))


def _zone(v: Val) -> Column:
    from quadrille.functions.values import DATETIME

    if v.kind == "ts":
        return F.when(v.col.isNotNull(), F.lit(""))
    return let(v.col, lambda t: F.when(written_datatype(t) == XSD + "dateTime", F.regexp_extract(F.when(instant(lexical(t), False).isNotNull(), lexical(t)), DATETIME, 7)))


def _hash(v: Val, f) -> Val:
    s = v.col if v.kind == "str" else simple_text(v.col) if v.kind == "term" else null()
    return Val("str", f(s.cast("binary")))


def _cast(v: Val, to: str) -> Val:
    if to == "string":
        return Val("str", text_of(v) if v.kind != "term" else lexical(v.col))
    if v.kind in ("iri", "key"):
        return error()
    if v.kind == "ts" and to != "dateTime":
        return error()
    if v.numeric or v.kind == "bool":
        if to == "boolean":
            return Val("bool", ebv(v)) if v.kind != "num" else Val("bool", ebv(v))
        n = number(v) if v.kind != "bool" else None
        whole = v.col.cast("int").cast(DEC) if n is None else F.coalesce(n["d"], F.when(~F.isnan(n["f"]), n["f"].try_cast(DEC)))
        if to == "integer":
            return Val("int", F.when(whole < 0, F.ceil(whole)).otherwise(F.floor(whole)).try_cast("decimal(38,0)"))
        if to == "decimal":
            return Val("dec", whole)
        kind = {"float": "flt", "double": "dbl"}.get(to)
        return Val(kind, (v.col.cast("int") if n is None else n["f"]).cast(to)) if kind else error()
    if to == "dateTime" and v.kind == "ts":
        return v
    # from a literal's text
    from quadrille.functions.values import DECIMAL, DOUBLE, INTEGER

    if v.kind == "str":
        lex, typed = v.col, None
    else:
        lex, typed = let(v.col, lambda t: F.when(is_literal(t) & language(t).isNull(), lexical(t))), v
    if to == "dateTime":
        day = F.when(instant(lex, True).isNotNull(), F.regexp_replace(lex, r"^(-?[0-9]+-[0-9]{2}-[0-9]{2})", "$1T00:00:00"))
        return Val("term", F.concat(F.lit('"'), F.when(instant(lex, False).isNotNull(), lex).otherwise(day), F.lit(f'"^^<{XSD}dateTime>')))
    if to == "boolean":
        plain = F.when(lex.isin("true", "1"), F.lit(True)).when(lex.isin("false", "0"), F.lit(False))
        return Val("bool", plain if typed is None else F.coalesce(boolean(v.col), F.when(number(v).isNotNull(), ebv(Val("num", number(v)))), F.when(v.col.endswith('"'), plain)))
    pattern = {"integer": INTEGER, "decimal": DECIMAL, "float": DOUBLE, "double": DOUBLE}[to]
    text = F.when(lex.rlike(pattern), F.regexp_replace(lex, "INF", "Infinity"))
    native = {"integer": "decimal(38,0)", "decimal": DEC, "float": "float", "double": "double"}[to]
    kind = {"integer": "int", "decimal": "dec", "float": "flt", "double": "dbl"}[to]
    plain = text.try_cast(native)
    if typed is None:
        return Val(kind, plain)
    converted = _cast(Val("num", number(v)), to).col
    truth = F.when(boolean(v.col).isNotNull(), boolean(v.col).cast("int")).cast(native)
    return Val(kind, F.when(number(v).isNotNull(), converted).when(boolean(v.col).isNotNull(), truth).when(v.col.endswith('"'), plain))


def call(name: str, args: list[Val], context) -> Val | None:
    """None for an unknown function. context: now, fresh() for blank nodes, base."""
    a = args[0] if args else None
    b = args[1] if len(args) > 1 else None
    if name.startswith(XSD):
        to = name.removeprefix(XSD)
        return _cast(a, to) if to in ("boolean", "integer", "decimal", "float", "double", "string", "dateTime") and len(args) == 1 else None
    if name == "STR":
        return Val("str", text_of(a) if a.kind != "term" else lexical(a.col))
    if name == "LANG":
        if a.kind == "term":
            return Val("str", F.when(is_literal(a.col), F.coalesce(language(a.col), F.lit(""))))
        return error() if a.kind in ("iri", "key") else Val("str", F.when(a.col.isNotNull(), F.lit("")))
    if name == "DATATYPE":
        if a.kind in DATATYPE:
            return Val("iri", F.when(a.col.isNotNull(), F.lit(DATATYPE[a.kind])))
        if a.kind in ("iri", "key"):
            return error()
        return Val("iri", let(term(a), lambda t: F.when(is_literal(t), F.when(language(t).isNotNull(), F.lit(RDF + "langString")).otherwise(F.coalesce(written_datatype(t), F.lit(XSD + "string"))))))
    if name == "LANGMATCHES":
        return lang_matches(a, b)
    if name == "SAMETERM":
        return Val("bool", a.col == b.col if a.kind == b.kind and a.prefix == b.prefix and a.kind in ("str", "iri", "key") else term(a) == term(b))
    if name in ("ISIRI", "ISURI", "ISBLANK", "ISLITERAL"):
        mark = {"ISIRI": "<", "ISURI": "<", "ISBLANK": "_:", "ISLITERAL": '"'}[name]
        if a.kind == "term":
            return Val("bool", a.col.startswith(mark))
        is_iri = a.kind in ("iri", "key")
        return Val("bool", F.when(a.col.isNotNull(), F.lit(mark == ("<" if is_iri else '"'))))
    if name == "ISNUMERIC":
        return Val("bool", F.when(a.col.isNotNull(), number(a).isNotNull()))
    if name in ("STRSTARTS", "STRENDS", "CONTAINS"):
        f = {"STRSTARTS": lambda x, y: x.startswith(y), "STRENDS": lambda x, y: x.endswith(y), "CONTAINS": lambda x, y: x.contains(y)}[name]
        return Val("bool", _both(a, b, f))
    if name in ("STRBEFORE", "STRAFTER"):
        (x, tx), (y, ty) = string_argument(a), string_argument(b)
        pos = F.position(y, x)
        found = F.substring(x, F.lit(1), pos - 1) if name == "STRBEFORE" else F.substring(x, pos + F.length(y), F.length(x))
        if tx is None:
            return Val("str", F.when(_compatible(tx, ty), F.when(pos > 0, found).otherwise(F.lit(""))))
        return Val("term", F.when(_compatible(tx, ty), F.when(pos > 0, term(tagged(found, tx))).when(pos == 0, F.lit('""'))))
    if name in ("UCASE", "LCASE"):
        s, tag = string_argument(a)
        return tagged((F.upper if name == "UCASE" else F.lower)(s), tag)
    if name == "STRLEN":
        return Val("int", F.length(string_argument(a)[0]).cast("bigint"))
    if name == "SUBSTR":
        s, tag = string_argument(a)
        half = lambda v: F.floor(number(v)["f"] + 0.5).cast("int") if v.kind not in ("int",) else v.col.cast("int")
        start = half(b)
        first = F.greatest(start, F.lit(1))
        size = F.length(s) if len(args) == 2 else F.greatest(F.lit(0), start + half(args[2]) - first)
        return tagged(F.when(start.isNotNull() & size.isNotNull(), F.substring(s, first, size)), tag)
    if name == "CONCAT":
        parts = [string_argument(v) for v in args]
        text = F.concat(*[p[0] for p in parts]) if parts else F.lit("")
        if not parts or any(t is None for _, t in parts):
            return Val("str", text)
        same = parts[0][1]
        alike = F.lit(True)
        for _, t in parts[1:]:
            alike = alike & F.coalesce(t == same, F.lit(False))
        return tagged(text, F.when(alike, same))
    if name == "ENCODE_FOR_URI":
        s, _ = string_argument(a)
        return Val("str", F.replace(F.replace(F.replace(F.url_encode(s), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")))
    if name in ("IRI", "URI"):
        if a.kind in ("iri", "key"):
            return a
        if a.kind == "str":
            return Val("iri", F.when(~a.col.rlike(BAD_IRI.pattern), context.resolved(a.col)))
        if a.kind != "term":
            return error()
        return Val("term", let(a.col, lambda t: F.when(t.startswith("<"), t).otherwise(F.concat(F.lit("<"), context.resolved(F.when(~simple_text(t).rlike(BAD_IRI.pattern), simple_text(t))), F.lit(">")))))
    if name == "BNODE":
        if a is None:
            return Val("term", F.concat(F.lit("_:u"), F.replace(F.uuid(), F.lit("-"))))
        return Val("term", F.concat(F.lit("_:h"), F.substring(F.sha1(F.concat(simple_argument(a), F.lit(context.fresh())).cast("binary")), 1, 24)))
    if name == "STRDT":
        dt = b.col if b.kind == "iri" else text_of(b) if b.kind == "key" else F.when(term(b).startswith("<"), lexical(term(b)))
        return Val("term", let(dt, lambda d: F.when(d == XSD + "string", F.concat(F.lit('"'), simple_argument(a), F.lit('"'))).otherwise(F.concat(F.lit('"'), simple_argument(a), F.lit('"^^<'), d, F.lit(">")))))
    if name == "STRLANG":
        return Val("term", F.concat(F.lit('"'), simple_argument(a), F.lit('"@'), F.lower(F.nullif(simple_argument(b), F.lit("")))))
    if name == "ABS":
        if a.kind in RANK:
            return Val(a.kind, F.abs(a.col))
        return error() if SPACE.get(a.kind, "n") != "n" else Val("num", let(number(a), lambda x: F.when(x.isNotNull(), F.struct(x["r"].alias("r"), F.abs(x["d"]).alias("d"), F.abs(x["f"]).alias("f")))))
    if name == "CEIL":
        return _rounded(a, _kept(F.ceil), F.ceil)
    if name == "FLOOR":
        return _rounded(a, _kept(F.floor), F.floor)
    if name == "ROUND":
        return _rounded(a, _kept(lambda c: F.floor(c + 0.5)), lambda c: F.floor(c + F.lit("0.5").cast("decimal(2,1)")))
    if name == "RAND":
        return Val("dbl", F.rand())
    if name == "UUID":
        return Val("iri", F.concat(F.lit("urn:uuid:"), F.uuid()))
    if name == "STRUUID":
        return Val("str", F.uuid())
    if name == "NOW":
        return Val("term", F.lit(context.now))
    if name in ("YEAR", "MONTH", "DAY", "HOURS", "MINUTES"):
        return _part(a, ("YEAR", "MONTH", "DAY", "HOURS", "MINUTES").index(name) + 1, "int")
    if name == "SECONDS":
        return _part(a, 6, "dec")
    if name == "TZ":
        return Val("str", _zone(a))
    if name == "TIMEZONE":
        z = F.nullif(_zone(a), F.lit(""))
        h, m = F.substring(z, 2, 2).try_cast("int"), F.substring(z, 5, 2).try_cast("int")
        text = F.when(z.isin("Z", "+00:00", "-00:00"), F.lit("PT0S")).otherwise(F.concat(F.when(z.startswith("-"), F.lit("-")).otherwise(F.lit("")), F.lit("PT"), F.when(h > 0, F.concat(h.cast("string"), F.lit("H"))).otherwise(F.lit("")), F.when(m > 0, F.concat(m.cast("string"), F.lit("M"))).otherwise(F.lit(""))))
        return Val("term", F.concat(F.lit('"'), text, F.lit(f'"^^<{XSD}dayTimeDuration>')))
    if name in ("MD5", "SHA1"):
        return _hash(a, F.md5 if name == "MD5" else F.sha1)
    if name in ("SHA256", "SHA384", "SHA512"):
        return _hash(a, lambda c: F.sha2(c, int(name[3:])))
    return None
