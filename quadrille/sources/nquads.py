"""N-Quads and N-Triples text to quads of spelled terms, and back; JVM-side expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.terms import XSD

_IRI, _BLANK = r"<[^<>\"{}|^`\x00-\x20]*>", r"_:[^\s<>\"]+?"
_LIT = r"\"(?:[^\"\\\n\r]|\\.)*+\"(?:@[A-Za-z]+(?:-[A-Za-z0-9]+)*|\^\^<[^<>\"{}|^`\x00-\x20]*>)?"
LINE = rf"^\s*({_IRI}|{_BLANK})\s*({_IRI})\s*({_IRI}|{_LIT}|_:[^\s<>\"]+?)\s*({_IRI}|_:[^\s<>\"]+?)?\s*\.\s*(?:#.*)?$"


def _unescaped(text: Column) -> Column:
    """Backslash escapes. Most texts have none, and are passed on."""
    # \\ goes to a placeholder that no text has, so that what follows it is not read as an escape
    hold = "﷐"
    c = F.replace(text, F.lit("\\\\"), F.lit(hold))
    for a, b in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r"), ('\\"', '"'), ("\\'", "'"), ("\\b", "\b"), ("\\f", "\f")):
        c = F.replace(c, F.lit(a), F.lit(b))
    pieces = F.split(c, r"(?=\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8})")

    def one(x: Column) -> Column:
        def code(n: int) -> Column:
            return F.decode(F.unhex(F.lpad(F.substring(x, 3, n), 8, "0")), "utf-32")

        return F.when(x.rlike(r"^\\u[0-9A-Fa-f]{4}"), F.concat(code(4), F.substring(x, F.lit(7), F.length(x)))).when(x.rlike(r"^\\U[0-9A-Fa-f]{8}"), F.concat(code(8), F.substring(x, F.lit(11), F.length(x)))).otherwise(x)

    c = F.when(c.contains("\\"), F.array_join(F.transform(pieces, one), "")).otherwise(c)
    return F.when(text.contains("\\"), F.replace(c, F.lit(hold), F.lit("\\"))).otherwise(text)


def _spelled(t: Column) -> Column:
    parts = r"(?s)^\"(.*)\"(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?\z"
    lang, dt = F.regexp_extract(t, parts, 2), F.regexp_extract(t, parts, 3)
    body = F.concat(F.lit('"'), _unescaped(F.regexp_extract(t, parts, 1)), F.lit('"'))
    literal = F.when(lang != "", F.concat(body, F.lit("@"), F.lower(lang))).when((dt != "") & (dt != XSD + "string"), F.concat(body, F.lit("^^<"), _unescaped(dt), F.lit(">"))).otherwise(body)
    return F.when(t.startswith('"'), literal).when(t.startswith("<"), _unescaped(t)).otherwise(t)


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """(s, p, o, g, bad): bad is the line where it is no statement. Blank lines and comments are left out."""
    c = F.col(column)
    blank = c.rlike(r"^\s*(#.*)?$")
    kept = lines.where(~blank)
    ok = c.rlike(LINE)
    part = lambda i: _spelled(F.when(ok, F.regexp_extract(c, LINE, i)))
    return kept.select(part(1).alias("s"), part(2).alias("p"), part(3).alias("o"), part(4).alias("g"), F.when(~ok & ~blank, c).alias("bad"))  # filters may be tried in any order: a blank line is never bad


def read_nquads(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Distinct quads; the default graph is the empty string. strict: a line that is no statement fails the job."""
    parsed = parse_lines(spark.read.text(path))
    if strict:
        parsed = parsed.withColumn("s", F.when(F.col("bad").isNotNull(), F.raise_error(F.concat(F.lit("not a statement: "), F.col("bad")))).otherwise(F.col("s")))
    return parsed.where(F.col("s").isNotNull()).drop("bad").distinct()


def to_lines(quads: DataFrame) -> DataFrame:
    """One column `value` of N-Quads lines."""

    def out(c: Column) -> Column:
        parts = r'(?s)^"(.*)"((?:@[A-Za-z0-9-]+|\^\^<[^>]*>)?)\z'
        body = F.regexp_extract(c, parts, 1)
        for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
            body = F.replace(body, F.lit(a), F.lit(b))
        return F.when(c.startswith('"'), F.concat(F.lit('"'), body, F.lit('"'), F.regexp_extract(c, parts, 2))).otherwise(c)

    g = F.when(F.col("g") != "", F.concat(F.lit(" "), F.col("g"))).otherwise(F.lit("")) if "g" in quads.columns else F.lit("")
    return quads.select(F.concat(out(F.col("s")), F.lit(" "), F.col("p"), F.lit(" "), out(F.col("o")), g, F.lit(" .")).alias("value"))


def write_nquads(quads: DataFrame, path: str) -> None:
    to_lines(quads).write.text(path)
