"""RDF terms, and the strings that stand for them in columns.

`<iri>`, `_:label`, `"text"`, `"text"@tag`, `"text"^^<datatype>`: one string for each term, so that Spark joins, groups and
compares terms as plain strings. Texts are written as they are, without escapes, tags in lower case; a
datatype of `xsd:string` is left out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

XSD = "http://www.w3.org/2001/XMLSchema#"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"


@dataclass(frozen=True)
class Iri:
    value: str

    def spelled(self) -> str:
        return f"<{self.value}>"


@dataclass(frozen=True)
class Blank:
    label: str

    def spelled(self) -> str:
        return f"_:{self.label}"


@dataclass(frozen=True)
class Literal:
    lexical: str
    datatype: str | None = None  # None for simple and tagged literals
    lang: str | None = None

    def spelled(self) -> str:
        if self.lang:
            return f'"{self.lexical}"@{self.lang.lower()}'
        if self.datatype and self.datatype != XSD + "string":
            return f'"{self.lexical}"^^<{self.datatype}>'
        return f'"{self.lexical}"'


@dataclass(frozen=True)
class Var:
    name: str


Term = Iri | Blank | Literal

TRUE, FALSE = Literal("true", XSD + "boolean"), Literal("false", XSD + "boolean")

_SPELLED = re.compile(r'"(.*)"(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?', re.DOTALL)
# What the letters after a back slash stand for.
_ESCAPED = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}
_CODE_DIGITS = {"u": 4, "U": 8}
#: Characters that no IRI has.
BAD_IRI = re.compile(r'[\x00-\x20<>"{}|^`\\]')


def term(spelled: str) -> Term:
    if spelled.startswith("<"):
        return Iri(spelled[1:-1])
    if spelled.startswith("_:"):
        return Blank(spelled[2:])
    m = _SPELLED.fullmatch(spelled)
    if not m:
        raise ValueError(f"not a term: {spelled!r}")
    return Literal(m[1], m[3], m[2])


def unescape(text: str) -> str:
    out, at = [], 0
    while (k := text.find("\\", at)) >= 0:
        out.append(text[at:k])
        mark = text[k + 1 : k + 2]
        if n := _CODE_DIGITS.get(mark):
            digits = text[k + 2 : k + 2 + n]
            if not re.fullmatch(f"[0-9A-Fa-f]{{{n}}}", digits):
                raise ValueError(f"escape \\{mark}{digits}")
            out.append(chr(int(digits, 16)))
            at = k + 2 + n
        elif mark in _ESCAPED:
            out.append(_ESCAPED[mark])
            at = k + 2
        else:
            raise ValueError(f"escape \\{mark}")
    return "".join([*out, text[at:]])


def ntriples(t: Term) -> str:
    """The canonical N-Triples form."""
    if not isinstance(t, Literal):
        return t.spelled()
    body = t.lexical.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\r", "\\r")
    return Literal("\x00", t.datatype, t.lang).spelled().replace("\x00", body, 1)
