"""Each operator against a plain version, on small tables with nulls, empty and long texts, ties, repeats and clashing columns."""

import base64
import hashlib
import html as htmllib
import io
import random
import re
import struct
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.llm import common, decontamination, html_extraction, jaccard_join, media, mixing, quality, token_files, toxicity, url_filters, warc
from quadrille.llm.common import shared_folder

RNG = random.Random(5)
VOCABULARY = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(2, 6))) for _ in range(400)]


def words(n, rng=RNG):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


DOCS = "doc_id long, text string, source string, score string, n_words string"  # the last two clash with outputs


def edge_rows():
    long = " ".join(words(30_000))
    return [(1, None, "a", "x", "y"), (2, "", "a", "x", "y"), (3, "  \n ", None, "x", "y"), (4, long, "b", None, None), (5, "one", "b", "x", "y"), (6, "one", "b", "x", "y"), (6, "one", "b", "x", "y"), (7, "Two words", None, "x", "y"), (None, "no id at all", "a", "x", "y"), (8, long + " end", "c", "x", "y")]


# ---- 1


def plain_components(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.setdefault(i, []).append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    ids = sorted(sets)
    top = {i: i for i in ids}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}, {i: sorted(len(s) for s in sets[i]) for i in ids}


def near_rows(seed):
    rng = random.Random(seed)
    rows, i = [], 0
    for size in (1, 2, 3, 5, 8, 11, 20, 21, 60, 200):
        for _ in range(4):
            base = words(size, rng)
            for _ in range(rng.randint(1, 6)):
                w = list(base)
                for _ in range(rng.choice((0, 0, 1, 1, 2, 4))):
                    w[rng.randrange(len(w))] = rng.choice(VOCABULARY)
                if rng.random() < 0.3:
                    w += words(rng.randint(1, 3), rng)
                rows.append((i, " ".join(w)))
                i += 1
    # a chain: each links with the next, the ends do not
    w = words(60, rng)
    for _ in range(12):
        rows.append((i, " ".join(w)))
        i += 1
        w = w[1:] + words(1, rng)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width,percent,seed", [(3, 90, 1), (5, 80, 2)])
def test_jaccard_join(spark, width, percent, seed):
    rows = [*near_rows(seed), (9001, None), (9002, ""), (9003, " \t"), (9004, "dup"), (9004, "dup")]
    want, sizes = plain_components(rows, width, percent)
    got = jaccard_join.jaccard_components(frame(spark, rows, "doc_id long, text string"), width, percent).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["n_shingles"] in sizes[r["doc_id"]] for r in got)


def test_jaccard_join_of_odd_tables(spark):
    docs = frame(spark, [*edge_rows(), (6, "another text of the same id", "b", "x", "y")], DOCS)
    got = [(r["doc_id"], r["component_id"]) for r in jaccard_join.jaccard_components(docs).collect()]
    assert len(got) == 11 and (None, None) in got and (6, 5) in got and (5, 5) in got and (8, 4) in got and (1, 1) in got
    assert jaccard_join.jaccard_components(docs.limit(0)).collect() == []


def test_jaccard_links_are_counted(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 16)
    rng = random.Random(8)
    base = words(200, rng)
    rows = []
    for i in range(60):  # near one another: most pairs link, and no pair but those with the pivots is needed for the component
        w = list(base)
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(i + 1000, t) for i, t in near_rows(3)] + [(5000, None), (5001, " ".join(base)), (5001, "other text of the id"), (5001, rows[7][1] + " more"), (5002, ""), (5002, " ".join(base) + " z"), (None, rows[3][1])]
    got = jaccard_join.jaccard_components(frame(spark, rows, "doc_id long, text string"), 3, 90).collect()
    of = lambda t: frozenset(zip(*(t.split()[k:] for k in range(min(3, len(t.split())))))) if t else frozenset()
    sets = {of(t) for i, t in rows if t and i is not None}
    want = {s: sum(a != s and 100 * len(s & a) >= 90 * len(s | a) for a in sets) for s in sets}
    assert sorted((r["doc_id"], r["n_shingles"], r["links"]) for r in got if r["doc_id"] is not None) == sorted((i, len(of(t)), want.get(of(t), 0)) for i, t in rows if i is not None)
    assert max(want.values()) > 40 and len(got) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == plain_components([x for x in rows if x[0] is not None], 3, 90)[0]


def test_keys_of_linking_sets_meet():
    rng = np.random.default_rng(3)
    for n in (9, 10, 19, 40, 333, 2000):
        for percent in (80, 90):
            a = np.unique(rng.integers(1, 1 << 63, n, dtype=np.uint64))
            out = len(a) * (100 - percent) // 100
            for b in (a[out:], np.concatenate((a, rng.integers(1, 1 << 63, out, dtype=np.uint64)))):
                b = np.unique(b)
                same = len(np.intersect1d(a, b))
                if len(b) != len(a) and 100 * same >= percent * (len(a) + len(b) - same):
                    assert len(np.intersect1d(jaccard_join.join_keys(a, percent), jaccard_join.join_keys(b, percent))), (n, percent)


# ---- 2

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body class="comments-open"><header><h2>Site</h2></header><nav><ul><li><a href=x>Menu</a></li><li>Two</li></ul></nav>
<div class="cookie-notice">We use cookies</div><article><header><h1>Title &amp; more</h1></header><p>First <b>bo</b>ld&nbsp;text &#233;<p>Second<br>line<aside>side</aside><form><input>Send</form><ul><li>i1<li>i2</ul><div class="ad">buy</div><div id="comments"><p>reader says</div></article>
<div class=sidebar>More</div><footer>&copy; X</footer></body></html>"""
PLAIN = "<html><body><div class='nav'>Home</div><div><p>{0} alpha beta gamma delta.</p><p>{0} more words of the text here.</p></div><div><a href=q>link {0}</a></div></body></html>"


def test_html_extraction(spark):
    rows = [(1, "http://a/1", PAGE, 9), (2, "http://a/2", PAGE.replace("Second", "Other <!-- c --> thing"), 9), (3, "http://b/1", PLAIN.format("One"), 9), (4, "http://b/2", PLAIN.format("Two"), 9), (5, None, None, 9), (6, "http://a/3", "", 9), (7, None, "<p>broken <b", 9), (3, "http://b/1", PLAIN.format("One"), 9)]
    got = html_extraction.extract(frame(spark, rows, "page_id long, url string, html string, n_chars int"))
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    by = {}
    for r in got.collect():
        by.setdefault(r["page_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert by[1] == ["Title & more First bold text é Second line i1 i2"]
    assert by[2] == ["Title & more First bold text é Other thing line i1 i2"]
    assert by[3] == ["One alpha beta gamma delta. One more words of the text here."] * 2 and by[4][0].startswith("Two alpha")
    assert by[5] == [""] and by[6] == [""]
    assert html_extraction.extract(got.limit(0)).count() == 0
    assert "html" not in html_extraction.extract(got, keep_html=False).columns
    named = frame(spark, rows, "page_id long, url string, html string, n_chars int").withColumnRenamed("html", "text")
    assert {r["page_id"]: r["text"] for r in html_extraction.extract(named, html="text", keep_html=False).collect()} == {i: t[0] for i, t in by.items()}


def level_of(html, fixed=()):
    page = html_extraction.Page(html)
    return html_extraction.fold(page.roots, page, {html_extraction.hash_of(t) for t in fixed}, [html_extraction.hash_of(t) for t in page.texts])


def test_wrappers_fold_and_align():
    both = lambda x, y: html_extraction.expression(html_extraction.align(level_of(x), level_of(y)))
    a, b = "<ul><li>1</li><li>2</li><li>3</li></ul><p>x</p>", "<ul><li>1</li></ul><hr><div>new</div><p>x</p><p>y</p>"
    assert html_extraction.expression(level_of(a)) == "<ul>(<li>#</li>)+</ul><p>#</p>"
    assert both(a, b) == both(b, a) == "<ul>(<li>#</li>)+</ul>(<div>#</div>)?(<p>#</p>)+"
    assert html_extraction.expression(html_extraction.align(html_extraction.align(level_of(a), level_of(b)), level_of(a))) == both(a, b)
    # what recurs among others is a group; a level that is too wide is one as well
    assert html_extraction.expression(level_of("<h1>t</h1><p>a</p><h2>s</h2><p>b</p><ul><li>z</ul>")) == "<h1>#</h1>((<h2>#</h2>)?(<p>#</p>)?)+<ul><li>#</li></ul>"
    assert both("<div><p>a</p><dl><dt>t</dt><dd>d</dd></dl></div>", "<div><p>a</p><dl><dt>t</dt><dd>d</dd><dt>t</dt><dd>d</dd></dl></div>") == "<div><p>#</p><dl>((<dd>#</dd>)?(<dt>#</dt>)?)+</dl></div>"
    assert html_extraction.expression(level_of("".join(f"<x{i}>a</x{i}><y>b</y>" for i in range(150)))).startswith("((")
    # template texts are told from slots, and parts that hold the one from parts that hold the other
    assert html_extraction.expression(level_of("<div>Home</div><div>text</div><div>more</div>", ["Home"])) == "<div>=</div>(<div>#</div>)+"
    # a neighbour of its like is a repetition, not an option
    assert both("<div>a</div><hr><table><tr><td>1</table>", "<div>a</div><div>b</div><table><tr><td>1</table>") == "(<div>#</div>)+<table><tr><td>#</td></tr></table>"


#: Neither an article element nor a telling name; the parts' order and number differ from page to page.
BARE = "<html><body><div><a href=/>Home</a> <a href=/a>About us</a></div>{banner}<div><h2>{title}</h2>{paragraphs}</div><div>All rights of this text are with the house of letters, as told before at length in the terms of the house.</div></body></html>"


def bare_pages():
    rng = random.Random(12)
    rows, want = [], {}
    for i in range(40):
        body = [" ".join(words(rng.randint(8, 30), rng)) for _ in range(rng.randint(1, 6))]
        title = f"Title {i} " + " ".join(words(3, rng))
        banner = "<div><p>Read the house paper every day, it is the best paper that there is in all the land.</p></div>" if i % 4 else ""
        rows.append((i, f"http://bare.org/{i}", BARE.format(banner=banner, title=title, paragraphs="".join(f"<p>{p}</p>" for p in body))))
        want[i] = " ".join([title, *body])
    return rows, want


def test_the_wrapper_decides(spark):
    rows, want = bare_pages()
    pages = frame(spark, rows, "page_id long, url string, html string").withColumns({"_host": F.lit("kept"), "_wrapper": F.lit(1)})
    got = html_extraction.extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == want and all(r["_host"] == "kept" and r["_wrapper"] == 1 for r in got)
    hosted = frame(spark, [*rows, (99, "http://else.org/", "<article><p>x</p></article>")], "page_id long, url string, html string").withColumn("host", html_extraction.host_and_path(F.col("url"))[0])
    found = html_extraction.wrappers(hosted).cache()
    (w,) = [r for r in found.collect() if r["host"] == "bare.org"]
    assert w["expression"] == "<html><body><div>=</div>(<div><p>=</p></div>)?<div><h2>#</h2>(<p>#</p>)+</div><div>=</div></body></html>" and w["pages"] == 40
    # without its wrapper a page has no text; with another one, another text
    none = html_extraction.extract_by(hosted, found.withColumn("wrapper", F.lit("[]")))
    assert {r["text"] for r in none.collect()} == {""}
    level = html_extraction.judge(html_extraction.align(level_of("<html><body><div><h2>t</h2></div></body></html>"), level_of("<html><body><div><p>x</p></div></body></html>")))
    for u in html_extraction._slots(level):
        u[2][2] = int(u[2][0] and u is next(html_extraction._slots(level)))
    page = html_extraction.Page("<html><body><div><h2>Only this</h2><p>not this</p></div></body></html>")
    mine = html_extraction.fold(page.roots, page, set(), None)
    assert html_extraction.text_of(page, mine, html_extraction.matched(level, mine)) == "Only this"


def test_merging_in_parts_gives_one_wrapper(spark, monkeypatch):
    rows, want = bare_pages()
    pages = frame(spark, rows, "page_id long, url string, html string").repartition(6)
    monkeypatch.setattr(html_extraction, "ROUNDS", (7, 3, 1))
    monkeypatch.setattr(html_extraction, "SHAPES", 2)
    monkeypatch.setattr(html_extraction, "BROADCAST_LIMIT_BYTES", 0)
    assert {r["page_id"]: r["text"] for r in html_extraction.extract(pages).collect()} == want


@pytest.mark.parametrize(
    "page,text",
    [
        ("<a " * 350_000, None),
        ("<div>" * 100_000 + "deep", "deep"),
        ("<article>" + "<div>x" * 100_000, " ".join("x" * 100_000)),
        ("<a x=\"'>" * 100_000 + "y", ""),
        ("<a x='" * 150_000 + ">", ""),
        ("<p>a<b>" * 50_000, " ".join("a" * 50_000)),
        ("</a>" * 200_000 + "z", "z"),
        ("<article>" * 50_000 + "x", "x"),
        ("<nav>" * 50_000 + "x" + "</nav>" * 50_000 + "y", "y"),
        ("<p title=it's>one</p><p title=\"a > b\">two</p><p>don't</p>", "one two don't"),
    ],
    ids=["open tags", "deep", "deep with texts", "open quotes", "quotes to the end", "paragraphs", "end tags", "articles", "left out", "quotation marks"],
)
def test_hostile_pages(page, text):
    import time

    began = time.time()
    p = html_extraction.Page(page)
    level = html_extraction.fold(p.roots, p, set(), None)
    taken = html_extraction.matched(html_extraction.judge(html_extraction._copied(level)), level)
    got = html_extraction.text_of(p, level, taken)
    assert time.time() - began < 10
    assert got == (page.strip() if text is None else text)


def test_hidden_is_an_attribute_name(spark):
    shown = """<article style="overflow: hidden"><p title="a hidden gem" data-x='b hidden'>one</p><p alt=" class=nav ">two</p><p data-hidden not-hidden=hidden>three</p></article>"""
    left_out = """<article><p hidden>no</p><p class="x"hidden>no</p><p HIDDEN="">no</p><p title="x" aria-hidden = true>no</p><p id='nav'>no</p><p>yes</p></article>"""
    rows = frame(spark, [(1, "http://a/1", shown), (2, "http://b/1", left_out)], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_extraction.extract(rows).collect()} == {1: "one two three", 2: "yes"}


def test_copies_of_a_page_are_one_page(spark):
    page = "<html><body><h1>Name</h1><div><p>All the text of {0} page.</p></div></body></html>"
    rows = [(1, "http://a/1", page.format("this")), (2, "http://a/2", page.format("this")), (3, "http://a/3", page.format("this") + "<!-- 3 -->"), (4, "http://b/1", page.format("one")), (5, "http://c/1", page.format("one")), (6, "http://c/2", page.format("one")), (7, "http://c/3", page.format("another"))]
    got = {r["page_id"]: r["text"] for r in html_extraction.extract(frame(spark, rows, "page_id long, url string, html string")).collect()}
    alone = "All the text of {0} page."
    assert got == {1: alone.format("this"), 2: alone.format("this"), 3: alone.format("this"), 4: alone.format("one"), 5: alone.format("one"), 6: alone.format("one"), 7: alone.format("another")}


def test_html_of_one_template(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in html_extraction.extract(pages).collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.DOTALL)[1]
        assert r["text"] == " ".join(htmllib.unescape(re.sub(r"</?(?:p|h1|br)>", " ", body).replace("<b>", "").replace("</b>", "")).split())


# ---- 3


def test_url_filters(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://Sub.EXAMPLE.net/en/x?q#f", "http://example.net", "http://example.net/EN/", "http://notexample.net/de", "ftp://a.org/fr/?x", "http://org/fr/a", "http://www.example.com/de/1", "http://example.com/des", "http://net:80/x", "http://x.cheap-pills.example.org/", "http://spamlike.org/a", "a://b?c://d/e"]
    rows = [(i, u, "h", 1) for i, u in enumerate(urls)] + [(4, urls[4], "h", 1)]
    rules = [url_filters.prefix_rule(*r) for r in url_filters.CONTRACT] + url_filters.default_rules()
    df = url_filters.judge_urls(frame(spark, rows, "page_id long, url string, host string, rule int"), rules)

    def plain(u):
        rest = u.partition("://")[2] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fit = [(len(t), t, v) for v, t in url_filters.CONTRACT if ("." + host).endswith("." + t.partition("/")[0]) and path.startswith("/" + t.partition("/")[2])]
        junk = set(re.split(r"[.-]", host)) & set(url_filters.BLOCKED_WORDS)
        return (host, path, max(fit)[1], max(fit)[2]) if fit else (host, path, None, "block" if junk else "allow")

    got = df.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain(r["url"]), r["url"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert url_filters.judge_urls(df.select("url").limit(0), rules).count() == 0 and url_filters.judge_urls(df.select("url"), []).count() == len(rows)


# ---- 4, 5


def labelled(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(500):
        w = words(rng.randint(5, 200), rng)
        toxic = rng.random() < 0.25
        good = rng.random() < 0.7
        if toxic:
            for _ in range(1 + len(w) // 40):
                w[rng.randrange(len(w))] = rng.choice(("vilewort", "grimslur", "vileness"))
        text = " ".join(w) if good else " ".join(x.upper() + "!!" for x in w[:40]) + " same" * 30
        docs.append((i, text))
        labels.append((i, int(good), int(toxic)))
    return frame(spark, docs, "doc_id long, text string"), frame(spark, [*labels, (None, 1, 1), (3000, None, None)], "doc_id long, quality int, toxic int")


def right(df, labels, label, at):
    m = df.join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).select("score", label).collect()
    return sum((r["score"] >= at) == bool(r[label]) for r in m) / len(m)


def test_toxicity(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    assert right(toxicity.score(docs, model), labels, "toxic", 0.7) > 0.93
    odd = toxicity.score(frame(spark, edge_rows(), DOCS), model)
    assert odd.columns == ["doc_id", "text", "source", "n_words", "score"] and odd.count() == 10 and odd.where("score between 0 and 1").count() == 10
    nothing = toxicity.train(docs, labels.limit(0))
    assert toxicity.score(docs, nothing).where("score <> 0.5").count() == 0
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_pairs_weigh_more_than_sums():
    """Two terms that are harmless alone, and toxic together."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, (800, 2))
    docs = [np.array([i for i in (3, 9) if r[int(i == 9)]] + [20 + int(rng.integers(0, 5))]) for r in x]
    y = (x[:, 0] & x[:, 1]).astype(float)
    m = toxicity.fit([np.unique(d) for d in docs], y)
    at = {t: i for i, t in enumerate(m.terms.tolist())}
    score = lambda *t: m.raw(np.zeros(len(t), int), np.array([at[k] for k in t]), 1)[0]
    assert score(3, 9) > 0 > max(score(3), score(9))


def test_quality(spark):
    docs, labels = labelled(spark)
    rows = quality.with_statistics(docs)
    scorer = quality.train(rows, labels.where(~toxicity.held_out(F.col("doc_id"))))
    assert right(quality.score(rows, scorer), labels, "quality", 0.5) > 0.95
    odd = quality.score(quality.with_statistics(frame(spark, edge_rows(), DOCS)), scorer)
    assert odd.count() == 10 and odd.where("score between 0 and 1").count() == 10
    nothing = quality.train(rows, labels.limit(0))
    assert quality.score(rows, nothing).where("score <> 0.5").count() == 0


def test_isotonic():
    x, y = quality.isotonic(np.array([0.0, 1, 2, 3]), np.array([0.0, 0.6, 0.2, 1]), np.ones(4))
    assert y.tolist() == [0.0, 0.4, 1.0] and x.tolist() == [0.0, 1.5, 3.0]


# ---- 6


def plain_hits(text, items, window):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, found = set(), set()
    for name, t in items:
        v = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        n = min(window, len(v))
        grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(name)
    return len(w), len(hit), sorted(str(x) for x in found if x is not None)


@pytest.mark.parametrize("window,shard", [(4, 200_000), (4, 30), (13, 200_000)])
def test_decontamination(spark, monkeypatch, window, shard):
    monkeypatch.setattr(decontamination, "SHARD_WORDS", shard)
    rng = random.Random(window)
    small = ["a", "b", "c", "dé"]
    items = [(i, " ".join(rng.choice(small) for _ in range(rng.choice((2, 3, 5, 9, 20))))) for i in range(12)] + [(50, "Solo"), (51, ""), (52, None), (None, "lost item here"), (53, items_text := " ".join(words(40))), (54, items_text)]
    docs = [(i, " , ".join(rng.choice([*small, "x"]) for _ in range(rng.randint(0, 60)))) for i in range(80)] + [(100, None), (101, "solo!"), (102, " ".join(words(30)) + " " + items_text.upper() + " " + " ".join(words(2000)))]
    docs += docs[:3]
    got = decontamination.find_hits(frame(spark, docs, "doc_id long, text string").withColumn("n_words", F.lit("x")), frame(spark, items, "item_id long, text string"), window=window).select("*", decontamination.n_hit().alias("n_hit")).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r["n_words"], r["n_hit"], r["hit_items"]) == plain_hits(r["text"], items, window), r["doc_id"]


def test_spans_are_removed(spark):
    passage = " ".join(f"Q{i}" for i in range(60))
    filler = " ".join(words(3000))
    docs = frame(spark, [(1, f"{filler} {passage}. {filler}", 7), (2, passage, 7), (3, "clean", 7), (4, None, 7)], "doc_id long, text string, hit_items int")
    got = {r["doc_id"]: r["text"] for r in decontamination.remove_spans(docs, frame(spark, [("i", passage)], "item_id string, text string")).collect()}
    assert got == {1: f"{filler} . {filler}", 3: "clean", 4: None}
    assert decontamination.find_hits(docs, frame(spark, [], "item_id string, text string")).where("size(hit_items) > 0").count() == 0


# ---- 7


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_token_files(spark):
    from tokenizers import Tokenizer

    rows = [*edge_rows(), (20, "It's DON'T <|endoftext|> x y-z 12,5 Ünï ΑΣ \u0301", "a", "x", "y")]
    folder = shared_folder(spark, "test-tokens")
    docs = frame(spark, rows, DOCS)
    files = token_files.write_token_files(docs, folder, tokenizer())
    got = token_files.read_token_files(files).collect()
    t = Tokenizer.from_file(tokenizer())
    want = sorted((r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "") for r in rows)
    at = 0
    for r, (has, i, _, text) in zip(sorted(got, key=lambda r: r["start"]), want, strict=True):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i if has else None, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_files.token_output(docs.limit(0), tokenizer()).count() == 0


def test_token_file_frames(tmp_path, monkeypatch):
    import zstandard

    monkeypatch.setattr(token_files, "FRAME_IDS", 10)
    docs = [(k, np.arange(n, dtype=np.uint32) + (k or 9)) for k, n in ((1, 4), (2, 5), (3, 30), (4, 0), (None, 2))]
    chunks, n, total = token_files.file_bytes(iter(docs))
    path = tmp_path / "x.tok"
    path.write_bytes(b"".join(chunks))
    r = token_files.Reader(str(path))
    assert (n, total, len(r), r.keys) == (5, 41, 5, [1, 2, 3, 4, None]) and len(r.sizes) == 3
    for i in (4, 0, 2, 3, 1):
        assert r.ids(i).tolist() == docs[i][1].tolist()
    # any zstandard reader reads the whole as one stream of ids
    raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(path.read_bytes()), read_across_frames=True).read()
    assert np.frombuffer(raw, "<u4").tolist() == np.concatenate([d[1] for d in docs]).tolist()
    bad = bytearray(path.read_bytes())
    bad[int(r.offsets[1]) + 9] ^= 1
    path.write_bytes(bytes(bad))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.Reader(str(path)).ids(2)


# ---- 8


def test_targets():
    assert mixing.targets([100, 100, 100]) == [Fraction(1500, 8), Fraction(600, 8), Fraction(300, 8)]
    t = mixing.targets([10, 1000, 1000, 0])
    assert t[0] == 30 and t[3] == 0 and sum(t) == 2010 and t[1] == 2 * t[2]
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0, 0]


def test_schedule_is_even():
    plan = mixing.schedule([5000, 2000, 1000, 7], 10)
    for s, n in enumerate((5000, 2000, 1000, 7)):
        part = plan[plan["source"] == s].sort_values("rank")
        assert part["end"].max() == n and (part["rank"] == range(len(part))).all() and (part.sort_values("slot")["rank"].diff().dropna() == 1).all()
    half = plan[plan["slot"] < plan["slot"].max() / 2]
    assert abs(len(half[half["source"] == 0]) / len(half) - 5 / 8) < 0.02


def test_mixing(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng.randint(0, 60), rng)), rng.choice(["hot", "hot", "hot", "b", "c", None, "é"])) for i in range(600)] + [(900, "tiny source", "z"), (1, None, "b"), (1, "again", "b"), (1, "again", "b")]
    docs = frame(spark, rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.mix_plan(docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix_plan(docs.repartition(7)).collect()), key=repr) and len(got) == len(rows)
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = [sum(count(r[1]) for r in rows if r[2] == s) for s in names]
    for s, size, goal in zip(names, sizes, mixing.targets(sizes)):
        part = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in part} == {size} and {r["target"] for r in part} == {float(goal)}
        assert abs(sum(r["taken"] for r in part) - goal) <= 1 and all(0 <= r["taken"] <= 3 * r["size"] for r in part)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    by: dict = {}
    for r in mixed.collect():
        by[r["source"]] = by.get(r["source"], 0) + count(r["text"])
    assert by == {s: sum(r["taken"] for r in got if r["source"] == s) for s in names}
    assert mixing.mix_plan(docs.limit(0)).count() == 0 and mixing.mix_documents(docs.limit(0)).count() == 0


def test_mix_follows_the_schedule(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(words(rng.randint(0, 60), rng)), rng.choice("aaab") if i % 50 else None) for i in range(400)]
    docs = frame(spark, rows, "doc_id long, text string, source string")
    got = mixing.mix_plan(docs, slots=300).collect()
    names = ["a", "b", None]
    wanted = [sum(r["taken"] for r in got if r["source"] == s) for s in names]
    block = sum(wanted) // 300
    plan = mixing.schedule(wanted, block)
    # each slot is filled by its own source, to its own length
    filled: dict = {}
    for r in got:
        assert r["taken"] == sum(p["end"] - p["start"] for p in r["slots"]) and all(0 <= p["start"] < p["end"] <= r["size"] for p in r["slots"])
        for p in r["slots"]:
            source, n = filled.get(p["slot"], (r["source"], 0))
            assert source == r["source"]
            filled[p["slot"]] = (source, n + p["end"] - p["start"])
    assert filled == {p.slot: (names[p.source], p.end - p.start) for p in plan.itertuples()}
    # rows stand at the slots of their first words: once for each copy
    starts = sorted((p["slot"], r["doc_id"]) for r in got for p in r["slots"] if p["start"] == 0)
    mixed = mixing.mix_documents(docs, slots=300).collect()
    slot_of: dict = {}
    for slot, i in starts:
        slot_of.setdefault(i, []).append(slot)
    met = [slot_of[r["doc_id"]].pop(0) for r in mixed]
    assert met == sorted(met) and not any(slot_of.values())
    assert sum(len(r["text"].split()) for r in mixed) == sum(wanted)
    half = [r["source"] for r in mixed[: len(mixed) // 2]]
    assert set(half) == set(names)


# ---- 9


def bmp(a, bits):
    h, w = a.shape[:2]
    if bits >= 24:
        pixel = a[:, :, ::-1] if bits == 24 else np.concatenate((a[:, :, ::-1], np.zeros((h, w, 1), np.uint8)), axis=2)
        rows, table = [r.tobytes() for r in pixel[::-1]], b""
    else:
        rows, table = [r.tobytes() for r in a[::-1, :, 0]], b"".join(bytes((i, i, i, 0)) for i in range(256))
    body = b"".join(r + b"\x00" * (-len(r) % 4) for r in rows)
    start = 54 + len(table)
    return b"BM" + struct.pack("<IHHI", start + len(body), 0, 0, start) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, bits, 0, len(body), 0, 0, 0, 0) + table + body


def test_images():
    rng = np.random.default_rng(1)
    grey, colour = rng.integers(0, 256, (7, 5, 1), dtype=np.uint8), rng.integers(0, 256, (7, 5, 3), dtype=np.uint8)
    text = lambda a: " ".join(map(str, a.reshape(-1).tolist())).encode()
    for data, want in (
        (b"P5\n# c\n5 7\n255\n" + grey.tobytes(), grey),
        (b"P2 5 7 255\n" + text(grey), grey),
        (b"P6 5 7 255\n" + colour.tobytes(), colour),
        (b"P3 5 7 255\n" + text(colour), colour),
        (bmp(grey, 8), np.repeat(grey, 3, axis=2)),
        (bmp(colour, 24), colour),
        (bmp(colour, 32), colour),
    ):
        assert np.array_equal(media.decode(data), want)
    bits = rng.integers(0, 2, (3, 10), dtype=np.uint8)
    packed = np.packbits(bits, axis=1).tobytes()
    assert np.array_equal(media.decode(b"P4 10 3\n" + packed)[:, :, 0], 255 * (1 - bits)) and np.array_equal(media.decode(b"P1 10 3\n" + text(bits))[:, :, 0], 255 * (1 - bits))
    assert media.decode(b"P5 1 2 65535\n\x01\x00\x00\x02").reshape(-1).tolist() == [256, 2]
    for bad in (b"", b"P5", b"P5 9 9 255\nxx", b"BM12", b"GIF89a", b"P5 0 1 255\n"):
        with pytest.raises(ValueError):
            media.decode(bad)
    a = rng.random((13, 11))
    fine = np.repeat(np.repeat(a, 8 * 1, axis=0), 9, axis=1)
    want = fine.reshape(8, 13, 9, 11).mean(axis=(1, 3))
    assert np.allclose(media.area_resize(a, 8, 9), want)
    assert np.array_equal(np.load(io.BytesIO(media.npy(colour))), colour) and np.array_equal(media.from_npy(media.npy(colour)), colour)


def test_media(spark):
    rows = edge_rows()
    got = media.read_back(media.encode_media(media.text_images(frame(spark, rows, DOCS)))).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        raw = (texts[r["doc_id"]] or "").encode()
        pay = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(pay), hashlib.sha256(pay).hexdigest(), zlib.crc32(pay[-32:]))
    same = [r[3:] for r in map(tuple, got) if r[0] in (5, 6)]
    assert len(set(same)) == 1
    images = frame(spark, [(1, bytearray(b"P5 2 1 255\n\x00\xff"), "x"), (2, None, "x"), (3, bytearray(b"junk"), "x")], "id long, image binary, error string")
    out = {r["id"]: r for r in media.encode_media(images).collect()}
    assert out[1]["width"] == 2 and out[1]["error"] is None and out[2]["media"] is None and out[3]["error"]
    assert media.encode_media(images.limit(0)).count() == 0


# ---- 10


def test_warc(spark):
    rows = [(1, "http://B.example.com/x?q=1#f", "<p>same</p>", 0), (2, "http://a.example.com/", "<p>same</p>", 0), (3, None, None, 0), (4, "http://b.example.com/x?q=1", "", 0), (5, "http://u ser@c.org:80/é\n", "ü", 0), (None, "http://d.org/", "<p>same</p>", 0), (5, "http://c.org/", "ü", 0)]
    pages = frame(spark, rows, "page_id long, url string, html string, payload int")
    captures, directory = warc.archive(pages)
    got = warc.read_all(directory).collect()
    assert len(got) == len(rows) == captures.count()
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    top = {digest("<p>same</p>"): 2, digest(""): 4, digest("ü"): 5}
    want = sorted((repr((i, len((h or "").encode()), digest(h), "response" if i == top[digest(h)] else "revisit", None if i == top[digest(h)] else top[digest(h)])) for i, _, h, _ in rows))
    assert sorted(repr(tuple(r)[:5]) for r in got) == want
    assert {bytes(r["payload"]).decode() for r in got if r["payload"] is not None} == {"<p>same</p>", "", "ü"}
    index = warc.CaptureIndex(directory)
    assert sorted(x["id"] for x in index.find("http://b.example.com/x?q=1")) == [1, 4]
    assert [r["payload"] for r in index.fetch("http://a.example.com/")] == [b"<p>same</p>"] and index.find("http://nowhere/") == []
    assert warc.read_all(warc.archive(pages.limit(0))[1]).count() == 0
    small = warc.read_all(warc.archive(pages, min_payload=100)[1])
    assert {r["record_type"] for r in small.collect()} == {"response"}


def test_index_blocks(spark):
    urls = [f"http://h{i % 7}.org/p{i % 40}" for i in range(300)]
    pages = frame(spark, [(i, u, f"text {i}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    captures = warc.write_archives(pages, shared_folder(spark, "test-warc"))
    directory = warc.write_index(captures, shared_folder(spark, "test-index"), block_lines=9)
    index = warc.CaptureIndex(directory)
    assert len(index.keys) > 30
    for u in set(urls):
        assert sorted(x["id"] for x in index.find(u)) == [i for i, v in enumerate(urls) if v == u]
    assert warc.url_key("http://User@WWW.Example.com:8080/A?b#c") == "com,example,www:8080)/a?b"


def test_windows_of_items_without_an_id_hit(spark):
    docs = frame(spark, [(1, "x alpha beta gamma y"), (2, "x")], "doc_id long, text string")
    items = frame(spark, [(None, "alpha beta gamma"), (7, "beta"), (7, "gamma y")], "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n"], r["hit_items"]) for r in decontamination.find_hits(docs, items).select("*", decontamination.n_hit().alias("n")).collect()}
    assert got == {1: (5, 4, ["7"]), 2: (1, 0, [])}


def test_line_ends_in_urls(spark):
    rows = [(1, "http://a\nx.example.net/en/"), (2, "http://x.org/fr/\n?"), (3, "http://casino\n.net"), (4, "http://a\n-spam/x"), (5, "http://spam\n/x")]
    docs = frame(spark, rows, "page_id long, url string").withColumns({"_t": F.lit("kept"), "_b": F.lit(1)})
    got = {r["page_id"]: r for r in url_filters.judge_urls(docs, [url_filters.prefix_rule(*r) for r in (*url_filters.CONTRACT, ("block", "org"))] + url_filters.default_rules()).collect()}
    assert [(got[i]["rule"], got[i]["verdict"]) for i in range(1, 6)] == [("example.net/en/", "allow"), ("org/fr/", "allow"), (None, "allow"), (None, "block"), (None, "allow")]
    assert all(r["_t"] == "kept" and r["_b"] == 1 for r in got.values())


def test_pairs_of_terms_that_tell_nothing_alone():
    """The label is the exclusive or of two terms, so neither has a marginal effect."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2, (4000, 2))
    y = (x[:, 0] ^ x[:, 1]).astype(float)
    docs = [np.unique(np.array([7] * r[0] + [9] * r[1] + list(rng.integers(100, 600, 12)), dtype=np.int64)) for r in x]
    m = toxicity.fit(docs[:3000], y[:3000])
    assert {7, 9} <= set(m.terms.tolist())
    place = {t: i for i, t in enumerate(m.terms.tolist())}
    raw = lambda d: m.raw(np.zeros(len(d), int), np.array(d, int), 1)[0]
    assert np.mean([(raw([place[t] for t in d.tolist() if t in place]) > 0) == bool(k) for d, k in zip(docs[3000:], y[3000:])]) > 0.95


def test_machine_sums_over_pairs():
    rng = np.random.default_rng(5)
    m = toxicity.Machine(np.arange(30), 0.3, rng.normal(size=30), rng.normal(size=(30, 8)))
    docs = [np.sort(rng.choice(30, k, replace=False)) for k in (0, 1, 2, 9, 30)]
    want = [m.bias + m.weights[d].sum() + sum(m.factors[i] @ m.factors[j] for a, i in enumerate(d) for j in d[a + 1 :]) for d in docs]
    got = m.raw(np.repeat(np.arange(5), [len(d) for d in docs]), np.concatenate(docs), 5)
    assert np.allclose(got, want)


def test_training_rows_are_the_same_each_time(spark):
    rows = [(i % 50, f"text {i} " + ("bad" if i % 3 else "good")) for i in range(400)]
    docs, labels = frame(spark, rows, "doc_id long, text string"), frame(spark, [(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    a, b = (toxicity.train(d, labels, sample=60) for d in (docs, docs.repartition(7).orderBy(F.rand())))
    assert a.bias == b.bias and np.array_equal(a.terms, b.terms) and np.array_equal(a.weights, b.weights)


def test_quality_is_ridge_on_random_features(spark):
    """Against one matrix of all rows, and a plain isotonic fit."""
    docs, labels = labelled(spark)
    rows = quality.with_statistics(docs.repartition(5)).cache()
    scorer = quality.train(rows, labels)
    y = {r["doc_id"]: r["quality"] for r in labels.where("quality is not null and doc_id is not null").collect()}
    got = {r["doc_id"]: np.array(r["statistics"]) for r in rows.collect()}
    x = np.array([got[i] for i in sorted(y)])
    t = np.array([y[i] for i in sorted(y)], float)
    assert np.allclose(scorer.mean, x.mean(axis=0)) and np.allclose(scorer.scale, np.maximum(x.std(axis=0), 1e-6))
    rng = np.random.default_rng(11)
    w, b = rng.normal(0, quality.WIDTH / np.sqrt(x.shape[1]), (x.shape[1], quality.FEATURES)), rng.uniform(0, 2 * np.pi, quality.FEATURES)
    z = np.clip((x - x.mean(axis=0)) / np.maximum(x.std(axis=0), 1e-6), -8, 8)
    a = np.column_stack([np.ones(len(z)), z, np.sqrt(2 / quality.FEATURES) * np.cos(z @ w + b)])
    penalty = np.full(a.shape[1], quality.RIDGE * len(a))
    penalty[0] *= 1e-6
    # ridge as least squares over rows that stand for the penalty
    plain = np.linalg.lstsq(np.vstack([a, np.diag(np.sqrt(penalty))]), np.concatenate([t, np.zeros(a.shape[1])]), rcond=None)[0]
    assert np.allclose(a @ plain, scorer.raw(x), atol=1e-6)
    raw = np.clip(np.round(scorer.raw(x) * quality.BINS), -quality.BINS, 2 * quality.BINS)
    # isotonic regression as the largest of the least means
    bins = np.unique(raw)
    sums, n = np.array([t[raw == v].sum() for v in bins]), np.array([(raw == v).sum() for v in bins])
    cs, cn = np.concatenate(([0], np.cumsum(sums))), np.concatenate(([0], np.cumsum(n)))
    k = len(bins)
    fitted = [max(min((cs[j + 1] - cs[i]) / (cn[j + 1] - cn[i]) for j in range(v, k)) for i in range(v + 1)) for v in range(k)]
    at = np.interp(bins / quality.BINS, scorer.edges, scorer.values)
    assert all(abs(u - v) < 1e-9 or scorer.values.min() <= u <= scorer.values.max() for u, v in zip(at, fitted))
    centres = {round(float(e), 9): v for e, v in zip(scorer.edges, scorer.values)}
    for level in np.unique(np.round(fitted, 12)):
        of = np.isclose(fitted, level, atol=1e-12)
        centre = float((bins[of] * n[of]).sum() / n[of].sum() / quality.BINS)
        assert np.isclose(centres[round(centre, 9)], level)


def test_tokenizers_that_keep_white_space_get_whole_texts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert token_files.works_by_chunk(tokenizer()) and not token_files.works_by_chunk(path)
    texts = ["a  b\n\nc", "", "Words and  more"]
    t = Tokenizer.from_file(path)
    got = token_files.Encoder(path).encode(texts)
    assert [x.tolist() for x in got] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_rows_of_one_id_go_to_several_files(spark):
    docs = frame(spark, [(None, " ".join(words(9))) for _ in range(400)], "doc_id long, text string")
    assert token_files.write_token_files(docs, shared_folder(spark, "test-tokens"), tokenizer()).count() > 1


def test_taken_words_of_each_document(spark, monkeypatch):
    """Against a stream of documents walked word by word, and against the SQL."""
    import duckdb

    rng = random.Random(14)
    rows = [(i, " ".join(words(rng.randint(0, 9), rng)), rng.choice(["hot", "hot", "hot", "b", None])) for i in range(120)] + [(500, "a b", "z"), (501, "", "void"), (1, "again and again", "b"), (1, "again and again", "b"), (None, "no id", "b"), (None, "none either", "b")]
    docs = frame(spark, rows, "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 2)
    got = sorted(((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in mixing.mix_plan(docs, slots=40).collect()), key=repr)
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(len(r[1].split()) for r in rows if r[2] == s) for s in names]
    want = []
    for s, size, goal in zip(names, sizes, mixing.targets(sizes)):
        stream = sorted((r for r in rows if r[2] == s), key=lambda r: md5(f"{'-' if r[0] is None else r[0]}:mix:{md5(r[1])}"))
        taken, left = [0] * len(stream), round(goal)
        while left and size:
            for k, r in enumerate(stream):
                n = min(left, len(r[1].split()))
                taken[k] += n
                left -= n
        want += [(r[0], len(r[1].split()), size, float(goal), n) for r, n in zip(stream, taken)]
    assert got == sorted(want, key=repr)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    assert sorted(con.execute(mixing.SQL).fetchall(), key=repr) == got
    monkeypatch.setattr(mixing, "schedule", lambda wanted, block, real=mixing.schedule: real([0] * len(wanted), block))
    assert sum(r["taken"] for r in mixing.mix_plan(docs).collect()) == 0


def test_mixed_rows_keep_clashing_columns(spark):
    docs = frame(spark, [(i, "w " * (i % 5), "s", i, f"k{i}", 0, 1) for i in range(30)], "doc_id long, text string, source string, _size int, _key string, _at int, _slot int")
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and all(r["_size"] == r["doc_id"] and r["_key"] == f"k{r['doc_id']}" and r["_slot"] == 1 for r in mixed.collect())
    assert sum(len(r["text"].split()) for r in mixed.collect()) == 60


@pytest.mark.parametrize("turns,paired,limit", [(3, 256, 0), (2, 3, 64 << 20), (0, 2, 64 << 20)])
def test_jaccard_join_of_unsettled_keys(spark, monkeypatch, turns, paired, limit):
    """Texts that share a long template, so that most share keys and few link; all three ways to settle a key."""
    monkeypatch.setattr(jaccard_join, "TURNS", turns)
    monkeypatch.setattr(jaccard_join, "PAIRED", paired)
    monkeypatch.setattr(jaccard_join, "BROADCAST_LIMIT_BYTES", limit)
    rng = random.Random(31)
    template = words(40, rng)
    rows = []
    for family in range(12):
        own = words(25, rng)
        for _ in range(4):
            w = [*template, *own]
            w[rng.randrange(50, 60)] = rng.choice(VOCABULARY)
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    rows = [(rng.randrange(10**6), t) for _, t in rows]
    want, _ = plain_components(rows, 3, 70)
    got = jaccard_join.jaccard_components(frame(spark, rows, "doc_id long, text string"), 3, 70, links=False).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want and 1 < len(set(want.values())) < len(rows)


def test_jaccard_keys_are_dealt_once_and_pairs_of_pivots_are_settled(spark, monkeypatch):
    """Keys of two documents each, which do not link: nothing is left to compare, and however many keys there are, they are made once."""
    seen = []
    monkeypatch.setattr(jaccard_join, "BROADCAST_LIMIT_BYTES", 0)
    kept = jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df, label: seen.append((label, df._jdf.queryExecution().toString(), out := kept(df, label))) or out)
    rng = random.Random(7)
    rows = []
    for i in range(8):
        shared = words(60, rng)
        rows += [(2 * i + k, " ".join([*shared, *(f"w{i}x{k}x{j}" for j in range(25))])) for k in range(2)]
    got = jaccard_join.jaccard_components(frame(spark, rows, "doc_id long, text string"), 5, 80, links=False).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == plain_components(rows, 5, 80)[0]
    assert sum("explode(keys" in plan for _, plan, _ in seen) == 1
    assert next(df for label, _, df in seen if label == "jaccard-members").count() > 0
    assert [df.count() for label, _, df in seen if label == "jaccard-left"] == [0]


def test_tasks_give_free_memory_back(spark):
    def pages():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    kept = []

    def each(batches):
        arrays = [np.ones(5000) for _ in range(5000)]
        kept.append(np.ones(5000))  # above the others, so that the heap's end does not fall by itself
        yield from ()
        arrays.clear()

    from types import SimpleNamespace

    run = common.map_arrow(SimpleNamespace(sparkSession=spark, mapInArrow=lambda f, schema: f), each, "n long")
    before = pages()
    assert list(run(iter([]))) == [] and kept
    assert pages() - before < 60e6  # of 200 MB


def plain_hash(samples):
    """Of a grey map 24 wide: means over the 8 x 9 areas, each source pixel by its overlap, then left against right."""
    h, w = samples.shape

    def shares(n, parts):
        out = np.zeros((parts, n))
        for i in range(parts):
            a, b = Fraction(i * n, parts), Fraction((i + 1) * n, parts)
            for k in range(n):
                out[i, k] = float(max(Fraction(0), min(b, Fraction(k + 1)) - max(a, Fraction(k))) / (b - a))
        return out

    small = shares(h, 8) @ samples.astype(float) @ shares(w, 9).T
    bits = [int(small[i, j + 1] > small[i, j] + 1e-9) for i in range(8) for j in range(8)]
    return "".join(f"{int(''.join(map(str, bits[i : i + 8])), 2):02x}" for i in range(0, 64, 8))


def test_stored_media_against_plain(spark):
    texts = [None, "", "a", "short text", "Ünï " * 200, " ".join(words(500)), "\n".join(words(40)), "z" * 576, "z" * 577]
    docs = frame(spark, list(enumerate(texts)), "doc_id long, text string")
    made = {r["id"]: bytes(r["media"]) for r in media.encode_media(media.text_images(docs)).collect()}
    got = {r["doc_id"]: r for r in media.read_back(media.encode_media(media.text_images(docs))).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        pay = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        stack = np.load(io.BytesIO(made[i]))
        assert stack.dtype == np.uint8 and stack.shape == (len(pay) // 576, 24, 24) and stack.tobytes() == pay
        assert (got[i]["media_bytes"], got[i]["media_sha256"]) == (len(made[i]), hashlib.sha256(made[i]).hexdigest())
        assert got[i]["feature"] == plain_hash(np.frombuffer(pay, np.uint8).reshape(-1, 24)), i


def test_encoder_knows_words_by_letters_and_marks(monkeypatch):
    """Forms of a word with other marks and capitals are no new ones: they neither crowd out others nor are encoded anew."""
    from itertools import product

    monkeypatch.setattr(token_files, "CACHE_CHUNKS", 2000)
    words = ["".join(x) for x in product("abcdefghij", repeat=3)]
    texts = [" ".join(f(w) + m for w in words) for f in (str, str.upper, str.title) for m in ("", ",", "!?")]
    e = token_files.Encoder(tokenizer())
    first = [e.encode([t])[0].tolist() for t in texts]

    class Silent:
        def __getattr__(self, name):
            raise AssertionError(f"{name}: all is known")

    library, e.tokenizer = e.tokenizer, Silent()
    assert [e.encode([t])[0].tolist() for t in texts] == first
    assert first == [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)]


def test_encoder_units(monkeypatch):
    """Ids are the library's, whatever the marks, letters and special tokens, across pieces, and where hashes are equal."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer())
    special = [x.content for x in t.get_added_tokens_decoder().values()]
    texts = ["", None, " ", "\n", "A", "!", "Ab,", ",ab", "a,b", "a.b c,d e", "x \n\n y", "Ärger über Straße ÀÉ×÷ÿ ß", "é ́e É É", "İı Σας ΣΑΣ", "привет, Мир! 東京 京", "a\tb\r\nc d e", "don't I'LL 's '", "12,5% $3.00 #a &b* |", "\x00 \x1f", "ab" * 3000 + "!" * 3000, *special, *[x.upper() + " " + x.lower() for x in special], "a" + "".join(special) + "b", "🙂 a🙂b c🙂,", "É" * 40 + " é" * 40]
    texts += [" ".join(x or "" for x in texts), "Ab, c! " * 500]
    want = [x.ids for x in t.encode_batch_fast([x or "" for x in texts], add_special_tokens=False)]
    for piece in (1 << 20, 97):
        for module in ("token_files", "words"):
            monkeypatch.setattr(f"quadrille.llm.{module}.PIECE", piece)
        for places in (1 << 21, 1 << 11):
            monkeypatch.setattr(token_files, "PLACES", places)
            monkeypatch.setattr(token_files, "CACHE_CHUNKS", places // 16)
            e = token_files.Encoder(tokenizer())
            for _ in range(2):
                assert [x.tolist() for x in e.encode(texts)] == want, (piece, places)
    monkeypatch.setattr(token_files, "range_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    e = token_files.Encoder(tokenizer())
    assert [x.tolist() for x in e.encode(texts)] == want


def test_workers_keep_what_tasks_use(spark):
    from types import SimpleNamespace

    task = lambda each: list(common.map_arrow(SimpleNamespace(sparkSession=spark, mapInArrow=lambda f, schema: f), each, "n long")(iter([])))
    made = []
    token = lambda batches: iter([common.kept("big", lambda: made.append(1) or len(made))])
    other = lambda batches: iter([])
    assert task(token) == task(token) == [1]
    task(other)
    assert not common._KEPT and task(token) == [2]
    task(other)


def test_spans_are_removed_in_the_pass_that_finds_them(spark, monkeypatch):
    """Each text goes to one Python worker a pass, so a task holds one, not two; with one shard of items and with several."""
    rng = random.Random(3)
    items = [(f"i{k}", " ".join(f"q{k}x{j}" for j in range(60))) for k in range(4)]
    filler = words(3000, rng)
    rows = [(k, " ".join([*filler, items[k][1], *filler])) for k in range(4)] + [(9, items[0][1]), (10, ""), (11, None)]
    docs, bench = frame(spark, rows, "doc_id long, text string"), frame(spark, items, "item_id string, text string")
    want = {**{k: " ".join(filler) + "  " + " ".join(filler) for k in range(4)}, 10: "", 11: None}
    for shard in (decontamination.SHARD_WORDS, 100):
        monkeypatch.setattr(decontamination, "SHARD_WORDS", shard)
        out = decontamination.remove_spans(docs, bench)
        assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        assert {r["doc_id"]: r["text"] for r in out.collect()} == want
