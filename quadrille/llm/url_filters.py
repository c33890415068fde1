"""URL filters: pattern rules, indexed by their rarest literal token.

A URL's tokens fetch the candidate rules; regular expressions run on those only. DataFrame functions
throughout: one pass that counts the rules' tokens in all URLs, one that judges each URL in place.

A null URL, or one without "://", has empty host and path, and fits only patterns that fit the empty
string's tokens, so none: its verdict is the default. Rows are judged one by one, so repeated rows,
ties and extra columns need no care; input columns stay, those named like an output are replaced.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.llm.common import ascii_lower, spare

#: Rules are embedded in the plan; more are refused, and to be split over several calls.
MAX_RULES = 200_000


@dataclass(frozen=True)
class Rule:
    """name: what `rule` reports, or None; regex: on host + path, of which only the path has a slash, at its start; tokens: whole tokens that every fitting URL has."""

    name: str | None
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    rank: int


def prefix_rule(verdict: str, text: str) -> Rule:
    """`example.net/en/`: that host and its subdomains, paths that start so. The longest fitting rule wins."""
    host, slash, path = text.partition("/")
    host, path = host.lower(), slash + path
    whole = path if path.endswith("/") else path[: max((path.rfind(c) for c in "/-._~"), default=0) + 1]
    tokens = [f"h:{x}" for x in _pieces(host)] + [f"p:{x}" for x in _pieces(whole)]
    return Rule(text, verdict, rf"\A(?:[^/]*\.)?{_quoted(host)}{_quoted(path) if path else r'(?:/|\z)'}", tuple(tokens), 1000 + len(text))


def word_rule(verdict: str, word: str) -> Rule:
    """A host with that word between dots, dashes or ends. Any prefix rule goes before it."""
    return Rule(None, verdict, rf"\A(?:[^/]*[.-])?{_quoted(word)}(?:[.-][^/]*)?(?:/|\z)", (f"h:{word}",), len(word))


#: Host words of sellers and adult sites. Fixed values.
BLOCKED_WORDS = ("adult", "bets", "betting", "casino", "pills", "poker", "porn", "spam", "viagra", "xxx")


def default_rules() -> list[Rule]:
    return [word_rule("block", w) for w in BLOCKED_WORDS]


def _pieces(text: str) -> list[str]:
    return [x for x in re.split(r"[^A-Za-z0-9]+", text) if x]


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"\A[^?#]*", 0)
    return ascii_lower(host), path


def _tokens(host: Column, path: Column) -> Column:
    of = lambda c, kind: F.transform(F.filter(F.split(c, "[^A-Za-z0-9]+"), lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    return F.array_distinct(F.concat(of(host, "h:"), of(path, "p:")))


def _with_parts(pages: DataFrame, url: str) -> DataFrame:
    host, path = host_and_path(F.coalesce(F.col(url), F.lit("")))
    return pages.withColumn("host", host).withColumn("path", path)


def rarest_tokens(pages: DataFrame, rules: list[Rule], url: str = "url") -> dict[Rule, str]:
    """Each rule's token with the fewest URLs. The counts cover all URLs; what reaches the driver is a row per token of a rule."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    parts = _with_parts(pages.select(url), url).select(_tokens(F.col("host"), F.col("path")).alias("_t"))
    known = F.array_intersect(F.col("_t"), F.from_json(F.lit(json.dumps(wanted)), "array<string>"))
    counts = {r["token"]: r["n"] for r in parts.select(F.explode(known).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {r: min(r.tokens, key=lambda t: (counts.get(t, 0), t)) for r in rules if r.tokens}


def judge_urls(pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule and verdict."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} in one call")
    if bad := [r for r in rules if not r.tokens]:
        raise ValueError(f"rules without a whole literal token: {[r.name or r.regex for r in bad][:5]}")
    by_token = rarest_tokens(pages, rules, url)
    n = max(1, 2 * len(rules))
    slots: list[list[dict]] = [[] for _ in range(n)]
    spark = pages.sparkSession
    order = list(by_token)
    if order:
        # the slot of a token, computed by the same expression that the plan uses
        tokens = sorted(set(by_token.values()))
        row = spark.range(1).select(F.transform(F.from_json(F.lit(json.dumps(tokens)), "array<string>"), lambda t: F.pmod(F.xxhash64(t), F.lit(n)).cast("int")).alias("s")).first()
        slot = dict(zip(tokens, row["s"], strict=True))
        for r in order:
            slots[slot[by_token[r]]].append({"token": by_token[r], "regex": r.regex, "rank": r.rank, "rule": r.name, "verdict": r.verdict})
    kind = "array<array<struct<token:string,regex:string,rank:int,rule:string,verdict:string>>>"
    index = F.from_json(F.lit(json.dumps(slots)), kind)  # constant: folded once, when the plan is made
    df = _with_parts(pages, url)
    t, c, x, b = (spare(df.columns, n) for n in ("_t", "_c", "_x", "_b"))
    fetched = F.flatten(F.transform(F.col(t), lambda k: F.filter(F.element_at(index, F.pmod(F.xxhash64(k), F.lit(n)).cast("int") + 1), lambda r: r["token"] == k)))
    df = df.withColumn(t, _tokens(F.col("host"), F.col("path"))).withColumn(c, fetched).withColumn(x, F.concat("host", "path"))
    fitting = F.filter(F.col(c), lambda r: F.regexp_like(F.col(x), r["regex"]))
    best = F.array_max(F.transform(fitting, lambda r: F.struct(r["rank"].alias("rank"), F.coalesce(r["rule"], F.lit("")).alias("by"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    df = df.withColumn(b, F.when(F.size(c) > 0, best))
    return df.withColumn("rule", F.col(f"{b}.rule")).withColumn("verdict", F.coalesce(F.col(f"{b}.verdict"), F.lit(default))).drop(t, c, x, b)


#: The rules of the contract.
CONTRACT = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, [prefix_rule(*r) for r in CONTRACT] + default_rules()).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH a AS (SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM a),
c AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
d AS (SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM c)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches('.' || replace(host, '-', '.') || '.', '\.(adult|bets|betting|casino|pills|poker|porn|spam|viagra|xxx)\.') THEN 'block'
    ELSE 'allow' END AS verdict FROM d
"""
