"""Main text of pages, by wrappers inferred for each host.

A page becomes a tree of elements and texts. Texts that are on more than half of a host's different pages, and
on two at least, are the template's; other texts are slots. In a page, neighbours that are alike are folded into
repeated groups, and what recurs in a run of paragraphs, headings and lists into one repeated group of
optional parts. The pages of a host are then aligned one after another, level by level: what both have stays,
what one lacks becomes optional, or, where it stands beside its like, repeated. So the wrapper is a regular
expression without unions, of tags, template texts (=), text slots (#), `?`, `+` and `*`.

The wrapper decides the text: each page is aligned with its host's wrapper, and every text of it falls to one of
the wrapper's slots, or has none. Taken are the slots inside <article>, <main> or what is named so, with
template texts in them; on a page without such texts, the slots of the element of the wrapper that holds most
text outside of links, without template texts and links. Menus, headers, footers, sidebars, notices, adverts,
forms, comments, scripts and styles are tags of the wrapper without content, known by their elements, roles,
classes and ids. A text without a slot goes as the wrapper's element in which it stands, or as the wrapper's articles
if it stands in one of the same name.

In the text, character references are decoded, white space inside a block is one space, and blocks are joined
by one space in page order. A null html, and a page without content slots, has an empty text. A null url's
host is empty, a host as any other. Repeated rows are treated one by one; other columns stay, `text` and
`n_chars` are replaced. A tag that never ends is text. Pages are read in time linear in their length:
elements more than DEPTH deep are read as parts of the element at that depth, with all their text; a level
of more than WIDTH parts becomes a repeated group of optional parts, which fits any such level.

A host's pages that are the same but for attributes and markup inside text count once. Wrappers are merged
in rounds, in parts of a host that a hash of the page's shape deals, so no task holds more than two wrappers, and a
host of a third of all pages is merged by many tasks.
"""

from __future__ import annotations

import hashlib
import html as htmllib
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm.common import BROADCAST_LIMIT_BYTES, lookup, map_arrow, spare, stored
from quadrille.llm.url_filters import host_and_path

#: Parts of a host in the rounds of merging.
ROUNDS = (4096, 64, 1)
#: Elements nested deeper are parts of the one at that depth.
DEPTH = 100
#: More parts of one element become a repeated group.
WIDTH = 200
#: Shapes of pages that a task remembers.
SHAPES = 5000

# Elements of HTML, and common names of parts of pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
LEFT_OUT = frozenset("aside audio button canvas datalist dialog embed footer form head iframe map menu nav noembed noframes noscript object option script select style svg template textarea title video xmp".split())
LEFT_OUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
LEFT_OUT_NAMES = frozenset(
    "ad ads adv advert advertisement adverts advertisements banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disclaimer disqus footer form gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
MAIN = frozenset("article main".split())
MAIN_NAMES = frozenset("article articlebody content entry maincontent post story".split())
#: An opening tag of the key ends an open element of the values.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}}
ENDS_P = frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())

_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _kind(name: str, rest: str, inside_main: bool) -> str:
    """'-' for elements left out, '+' for those that hold the article, '' for others."""
    names: set[str] = set()
    role = ""
    if rest:
        for m in _ATTRIBUTE.finditer(rest):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                return "-"
            if key == "role":
                role = value.lower()
            elif key in ("class", "id"):
                names |= {x.lower() for x in _NAME.findall(value)} | {x.lower() for x in re.split(r"[\s]+", value)}
    if name in LEFT_OUT or role in LEFT_OUT_ROLES or name == "header" and not inside_main:
        return "-"
    if name in MAIN or role in MAIN:
        return "+"
    if name in ("html", "body"):
        return ""
    if names & LEFT_OUT_NAMES and not (name.startswith("h") and name[1:].isdigit()):
        return "-"
    return "+" if names & MAIN_NAMES else ""


_TAG = r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>%s)>|(?P<text>[^<]+|<)"""
_TOKEN = re.compile(_TAG % r"""(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+""", re.DOTALL)
#: Once a quoted value goes beyond the last tag's end, no later tag is tried with quoted values.
_PLAIN_TOKEN = re.compile(_TAG % r"[^>]*", re.DOTALL)
_STARTS = re.compile("</?[A-Za-z]")
# Elements that text is written in. The second also hold other parts, so they can be the article's holder.
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr thead tbody tfoot caption blockquote pre figure figcaption hr ul ol dl table address center".split())
CELLS = frozenset("td th".split())


class Page:
    """roots: the tree, of elements [label, parts] and texts [number]; texts: each block's; links: how many of its characters are in links."""

    def __init__(self, page: str):
        self.texts: list[str] = []
        self.links: list[int] = []
        self.roots: list = []
        self._block: list[str] = []
        self._linked = 0
        self._read(page)

    def _close_block(self, parts: list) -> None:
        if self._block:
            raw = "".join(self._block)
            if words := " ".join(htmllib.unescape(raw).split()):
                parts.append([len(self.texts)])
                self.texts.append(words)
                self.links.append(min(len(words), len(words) * self._linked // len(raw)))
            self._block.clear()
            self._linked = 0

    def _read(self, page: str) -> None:
        # (name, parts of the element or of what it is a part of, is it left out, does it hold the article, has it a node)
        stack: list[tuple[str, list, bool, bool, bool]] = []
        opened: Counter[str] = Counter()
        blocks: list[int] = []  # places in the stack of what is not inline
        at, n, last = 0, len(page), page.rfind(">")
        out = links = main = depth = 0
        here = self.roots
        token = _TOKEN

        def close(to: int) -> None:
            nonlocal here, out, links, main, depth
            while len(stack) > to:
                name, parts, left, holds, node = stack.pop()
                opened[name] -= 1
                if name not in INLINE:
                    blocks.pop()
                    if not out:
                        self._close_block(here)
                links -= name == "a"
                out -= left
                main -= holds
                depth -= node
                here = stack[-1][1] if stack else self.roots

        while at < n:
            if at > last:  # no tag ends any more
                text = page[at:]
                at = n
            else:
                m = token.match(page, at)
                if m["text"] == "<" and token is _TOKEN and _STARTS.match(page, at):
                    token = _PLAIN_TOKEN
                    m = token.match(page, at)
                at = m.end()
                text = m["text"]
            if text is not None:
                if not out:
                    self._block.append(text)
                    self._linked += len(text) * (links > 0)
                elif self._block and not text.isspace():
                    self._block.append(" ")  # what is left out keeps words apart
                continue
            if m["name"] is None:
                continue
            name = m["name"].lower()
            if m["end"]:
                if opened[name]:
                    i = len(stack) - 1
                    while stack[i][0] != name:
                        i -= 1
                    close(i)
                elif name in ("p", "br") and not out:
                    self._close_block(here)
                continue
            if name in ENDS_P and blocks and stack[blocks[-1]][0] == "p":
                close(blocks[-1])
            if name in ENDS:
                while blocks and stack[blocks[-1]][0] in ENDS[name]:
                    close(blocks[-1])
            rest = m["rest"]
            inline = name in INLINE
            if not inline and not out:
                self._close_block(here)
            if name in VOID:
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}[\s/>]", re.IGNORECASE).search(page, at)
                at = (page.find(">", end.start()) + 1 or n) if end else n
                continue
            if rest.endswith("/") and name in ("svg", "path"):
                continue
            kind = "" if out else _kind(name, rest, main > 0)
            holds = kind == "+" and not inline
            parts, node = here, False
            if not out and not inline and (depth < DEPTH or holds and not main):
                parts, node = [], True
                here.append([name + kind, parts])
            stack.append((name, parts, kind == "-", holds, node))
            opened[name] += 1
            links += name == "a"
            out += kind == "-"
            main += holds
            depth += node
            if not inline:
                blocks.append(len(stack) - 1)
            here = parts
        close(0)
        if not out:
            self._close_block(here)


# A part of a level is [label, how often, body, content]. Labels: of an element; "#" and "=", slots and template texts, whose body is
# [characters, characters in links, content, numbers of texts]; "()", a group of parts in any order. How often: 1, ?, + or *.
# Content: whether what has no slot of its own is taken; 2 in the article, 1 where there is none, 0, or None if not judged.


def _more(p: str, q: str, repeated: bool = False) -> str:
    repeated = repeated or p in "+*" or q in "+*"
    optional = p in "?*" or q in "?*"
    return "*" if repeated and optional else "+" if repeated else "?" if optional else "1"


def _shape(level: list) -> str:
    return "".join(u[0] + u[1] if u[0] in "#=" else f"{u[0]}{u[1]}<{_shape(u[2])}>" for u in level)


def _paths(u: list) -> frozenset[str]:
    """What is in a part, to tell how much alike two are."""
    found: set[str] = set()

    def go(level: list, above: str) -> None:
        for x in level:
            p = above if x[0] == "()" else f"{above}/{x[0]}"
            found.add(p)
            if x[0] not in "#=":
                go(x[2], p)

    if u[0] not in "#=":
        go(u[2], "")
    return frozenset(found)


def _of_template(u: list) -> bool:
    """All its texts are template texts."""
    if u[0] in "#=":
        return u[0] == "="
    return bool(u[2]) and all(_of_template(x) or x[0] not in "#=" and not x[2] for x in u[2]) and any(_of_template(x) for x in u[2])


def _like(u: list, v: list) -> bool:
    """Repetitions of one part."""
    if u[0] != v[0] or u[0] == "()":
        return False
    if u[0] in "#=":
        return True
    return _of_template(u) == _of_template(v) and (u[0] in FLOW or u[0] in CELLS or _paths(u) == _paths(v))


def _joined(u: list, v: list, repeated: bool = False) -> list:
    """One part for both."""
    how = _more(u[1], v[1], repeated)
    content = u[3] if u[3] is not None else v[3]
    if u[0] in "#=":
        x, y = u[2], v[2]
        taken = y[2] if x[2] is None else x[2] if y[2] is None else max(x[2], y[2])
        x[3].extend(y[3])
        return [u[0], how, [x[0] + y[0], x[1] + y[1], taken, x[3]], content]
    if u[0] == "()":
        return ["()", how, _any_order([*u[2], *v[2]]), content]
    return [u[0], how, align(u[2], v[2]), content]


def _any_order(parts: list) -> list:
    """One optional part for each label, in a fixed order."""
    held: dict[tuple[str, bool], list] = {}
    for u in parts:
        if u[0] == "()":
            for x in u[2]:
                k = (x[0], _of_template(x))
                held[k] = _joined(held[k], x) if k in held else x
            continue
        k = (u[0], _of_template(u))
        held[k] = _joined(held[k], u) if k in held else u
    return [[u[0], "?", u[2], u[3]] for _, u in sorted(held.items(), key=lambda x: x[0])]


def _flows(u: list) -> bool:
    return u[0] == "()" or u[0] == "#" or u[0] in FLOW and not _of_template(u)


def settle(level: list, grouped: bool = False) -> list:
    """Runs of text in which a label recurs become one group; so does a level that is too wide. grouped: every run does."""
    out: list = []
    i = 0
    while i < len(level):
        if not _flows(level[i]):
            out.append(level[i])
            i += 1
            continue
        j = i
        while j < len(level) and _flows(level[j]):
            j += 1
        run = level[i:j]
        seen = Counter(u[0] for u in run)
        if grouped or seen["()"]:
            a, b = 0, len(run) if len(run) > 1 or seen["()"] or grouped else 0
        else:
            again = [k for k, u in enumerate(run) if seen[u[0]] > 1]
            a, b = (again[0], again[-1] + 1) if again else (0, 0)
        out += [*run[:a], *([["()", "+", _any_order(run[a:b]), None]] if b > a else []), *run[b:]]
        i = j
    return [["()", "+", _any_order(out), None]] if len(out) > WIDTH else out


def fold(parts: list, page: Page, fixed: frozenset[int] | set[int], hashes: list[int] | None) -> list:
    """The level of a page's tree."""
    out: list = []
    for x in parts:
        if len(x) == 1:
            i = x[0]
            u = ["=" if hashes is not None and hashes[i] in fixed else "#", "1", [len(page.texts[i]), page.links[i], None, [i]], None]
        else:
            u = [x[0], "1", fold(x[1], page, fixed, hashes), None]
        if out and _like(out[-1], u):
            out[-1] = _joined(out[-1], u, repeated=True)
        else:
            out.append(u)
    return settle(out)


def align(a: list, b: list) -> list:
    """A level that both fit. Both are used up."""
    if len(a) == len(b) and _shape(a) == _shape(b):
        return [_joined(u, v) for u, v in zip(a, b, strict=True)]
    if any(u[0] == "()" for u in a) or any(u[0] == "()" for u in b):
        a, b = settle(a, True), settle(b, True)
    head = 0
    shapes = [[_shape([u]) for u in x] for x in (a, b)]
    while head < min(len(a), len(b)) and shapes[0][head] == shapes[1][head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and shapes[0][-1 - tail] == shapes[1][-1 - tail]:
        tail += 1
    pairs = [(i, i) for i in range(head)] + [(i + head, j + head) for i, j in _matched(a[head : len(a) - tail], b[head : len(b) - tail])] + [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]
    out: list = []
    lone = False  # the last part is on one side only

    def add(u: list, alone: bool) -> None:
        nonlocal lone
        if out and (alone or lone) and _like(out[-1], u):
            lone = lone and alone
            optional = out[-1][1] in "?*" and (alone or u[1] in "?*")
            out[-1] = _joined(out[-1], u, repeated=True)
            out[-1][1] = "*" if optional else "+"
            return
        out.append([u[0], _more(u[1], "?"), u[2], u[3]] if alone else u)
        lone = alone

    i = j = 0
    for p, q in [*pairs, (len(a), len(b))]:
        for u in (*a[i:p], *b[j:q]):
            add(u, True)
        if p < len(a):
            add(_joined(a[p], b[q]), False)
        i, j = p + 1, q + 1
    return settle(out)


def _matched(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of equal labels, in order, that are most alike in sum."""
    if not a or not b:
        return []
    x, y = ([(u[0], _of_template(u), _paths(u)) for u in level] for level in (a, b))
    best = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        label, template, paths = x[i]
        for j in range(len(b) - 1, -1, -1):
            top = below[j] if below[j] >= row[j + 1] else row[j + 1]
            if y[j][0] == label:
                union = len(paths | y[j][2])
                s = below[j + 1] + 1 + (template == y[j][1]) + (len(paths & y[j][2]) / union if union else 1)
                top = max(top, s)
            row[j] = top
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if best[i][j] == best[i + 1][j]:
            i += 1
        elif best[i][j] == best[i][j + 1]:
            j += 1
        else:
            out.append((i, j))
            i, j = i + 1, j + 1
    return out


def expression(level: list) -> str:
    """The wrapper as text."""
    out = []
    for label, how, body, *_ in level:
        text = label if label in "#=" else expression(body) if label == "()" else f"<{label}>{expression(body)}</{label}>"
        out.append(text if how == "1" else f"({text}){how}")
    return "".join(out)


def judge(level: list) -> list:
    """Marks what is content, in place."""
    holders: list[tuple[list | None, list]] = []  # of slots outside of articles

    def go(parts: list, holder: list | None, article: bool) -> None:
        for u in parts:
            if u[0] in "#=":
                u[2][2] = 2 if article else 0
                if not article and u[0] == "#":
                    holders.append((holder, u))
            else:
                inside = article or u[0].endswith("+")
                u[3] = 2 if inside else 0
                go(u[2], holder if u[0] == "()" or u[0] in FLOW else u, inside)

    go(level, None, False)
    weight: dict[int, int] = {}
    for h, u in holders:
        weight[id(h)] = weight.get(id(h), 0) + u[2][0] - 2 * u[2][1]
    if not weight:
        return level
    best = max(weight, key=lambda k: weight[k])  # the first of equals

    def take(parts: list, inside: bool) -> None:
        for u in parts:
            if u[0] in "#=":
                if inside and u[0] == "#" and u[2][2] == 0 and 2 * u[2][1] <= u[2][0]:
                    u[2][2] = 1
            else:
                within = inside or id(u) == best
                if within and u[3] == 0:
                    u[3] = 1
                take(u[2], within)

    take(level, best == id(None))
    return level


def _copied(level: list) -> list:
    return [[u[0], u[1], [*u[2][:3], list(u[2][3])] if u[0] in "#=" else _copied(u[2]), u[3]] for u in level]


def _slots(level: list) -> Iterator[list]:
    for u in level:
        if u[0] in "#=":
            yield u
        else:
            yield from _slots(u[2])


def _labels(level: list) -> Iterator[str]:
    for u in level:
        yield u[0]
        if u[0] not in "#=":
            yield from _labels(u[2])


def matched(wrapper: list, level: list) -> list[int]:
    """For each slot of a page's level, in order, whether the wrapper takes it: 2, 1 or 0."""
    level = _copied(level)
    for k, u in enumerate(_slots(level)):
        u[2][3] = [k]
    wrapper = _copied(wrapper)
    for u in _slots(wrapper):
        u[2][3] = []
    articles = {x for x in _labels(wrapper) if x.endswith("+")}
    found: dict[int, int] = {}

    def go(parts: list, content: int) -> None:
        for u in parts:
            if u[0] in "#=":
                taken = u[2][2]
                if taken is None:
                    taken = content if content == 2 or content and u[0] == "#" and 2 * u[2][1] <= u[2][0] else 0
                for k in u[2][3]:
                    found[k] = taken
            else:
                go(u[2], max(content, u[3] if u[3] is not None else 2 if u[0] in articles else 0))

    go(align(wrapper, level), 0)
    return [found[k] for k in range(len(found))]


def hash_of(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def text_of(page: Page, level: list, taken: list[int]) -> str:
    by: dict[int, list[int]] = {0: [], 1: [], 2: []}
    for u, k in zip(_slots(level), taken, strict=True):
        by[k] += u[2][3]
    return " ".join(page.texts[i] for i in sorted(by[2] or by[1]))


class _Stored:
    """A page read back from its stored tree: texts are told by hashes."""

    def __init__(self, tree: str):
        self.roots, sizes, self.links, self.hashes = json.loads(tree)
        self.texts = [range(n) for n in sizes]


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))


def wrappers(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages have `host`. Returns (host, pages, wrapper, fixed, expression), a row for each host; pages counts different ones."""
    trees_of = {"host": pa.string(), "digest": pa.int64(), "tree": pa.string(), "hashes": pa.list_(pa.int64())}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for host, raw in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                page = Page(raw or "")
                hashes = [hash_of(t) for t in page.texts]
                tree = json.dumps((page.roots, [len(t) for t in page.texts], page.links, hashes), separators=(",", ":"))
                rows.append((host, hash_of(tree), tree, list(set(hashes))))
            if rows:
                yield _batch(rows, trees_of)

    read_once = map_arrow(pages.select("host", F.col(html).alias("html")), read, "host string, digest long, tree string, hashes array<long>")
    trees = stored(read_once.dropDuplicates(["host", "digest"]), "html-trees")
    totals = stored(trees.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "html-hosts")
    total = trees.count()
    often = trees.select("host", F.explode("hashes").alias("h")).groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # a host's template texts are at most twice as many as its pages have texts on average
    fixed = lookup(often, totals, "host", "pages", total).where("2 * n > pages").groupBy("host").agg(F.sort_array(F.collect_list("h")).alias("fixed"))
    hosts = stored(totals.join(fixed, "host", "left").select("host", "pages", F.coalesce("fixed", F.array().cast("array<long>")).alias("fixed")), "html-fixed")

    parts_of = {"host": pa.string(), "shape": pa.int64(), "level": pa.string()}

    def row(host: str, level: list) -> tuple:
        return host, hash_of(_shape(level)), json.dumps(level, separators=(",", ":"))

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], list] = {}
        for b in batches:
            for host, tree, known in zip(b.column("host").to_pylist(), b.column("tree").to_pylist(), b.column("fixed").to_pylist(), strict=True):
                page = _Stored(tree)
                level = fold(page.roots, page, set(known), page.hashes)
                for u in _slots(level):
                    u[2][3] = []
                k = (host, _shape(level))
                held[k] = align(held[k], level) if k in held else level
            if len(held) > SHAPES:
                yield _batch([row(h, w) for (h, _), w in held.items()], parts_of)
                held.clear()
        if held:
            yield _batch([row(h, w) for (h, _), w in held.items()], parts_of)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        done: list[tuple] = []
        for b in batches:
            for host, salt, text in zip(*(b.column(c).to_pylist() for c in ("host", "salt", "level")), strict=True):
                level = json.loads(text)
                if (host, salt) == key:
                    held = align(held, level)
                    continue
                if key is not None:
                    done.append(row(key[0], held))
                key, held = (host, salt), level
            if len(done) > 256:
                yield _batch(done, parts_of)
                done = []
        if key is not None:
            yield _batch([*done, row(key[0], held)], parts_of)

    kind = "host string, shape long, level string"
    level = map_arrow(lookup(trees.select("host", "tree"), hosts, "host", "pages", total), folded, kind)
    for n in ROUNDS:
        dealt = level.withColumn("salt", F.pmod(F.col("shape"), F.lit(n))).repartition("host", "salt").sortWithinPartitions("host", "salt", "shape", "level")
        level = map_arrow(dealt, merge, kind)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            levels = [judge(json.loads(x)) for x in b.column("level").to_pylist()]
            made = [pa.array([f(w) for w in levels], pa.string()) for f in (lambda w: json.dumps(w, separators=(",", ":")), expression)]
            yield pa.RecordBatch.from_arrays([b.column("host"), *made], names=["host", "wrapper", "expression"])

    return stored(map_arrow(level, judged, "host string, wrapper string, expression string").join(hosts, "host").select("host", "pages", "wrapper", "fixed", "expression"), "html-wrappers")


def extract(pages: DataFrame, url: str = "url", html: str = "html", keep_html: bool = True) -> DataFrame:
    """pages with text and n_chars, and without their html if that is not to be kept."""
    host = spare(pages.columns, "_host")
    rows = pages.withColumn(host, host_and_path(F.coalesce(F.col(url), F.lit("")))[0])
    found = wrappers(rows.select(F.col(host).alias("host"), F.col(html).alias("html")))
    return extract_by(rows, found, host, html, keep_html).drop(host)


def extract_by(rows: DataFrame, found: DataFrame, host: str = "host", html: str = "html", keep_html: bool = True) -> DataFrame:
    """rows, by wrappers that were inferred before; a host without a wrapper has no text."""
    for c in ("text", "n_chars"):
        if c in rows.columns and c != html:
            rows = rows.drop(c)
    size, total = found.agg(F.sum(F.octet_length("wrapper") + F.octet_length("host") + 8 * F.size("fixed")), F.sum("pages")).first()
    w = spare(rows.columns, "_wrapper")
    n = spare([*rows.columns, w], "_pages")
    slots = found.select(F.col("host").alias(host), F.col("pages").alias(n), F.struct("wrapper", "fixed").alias(w))
    if (size or 0) * 2 <= BROADCAST_LIMIT_BYTES:
        met = rows.join(F.broadcast(slots.drop(n)), host, "left")
    else:
        met = lookup(rows, slots, host, n, total or 0)
    kept = [f for f in rows.schema.fields if f.name not in ("text", "n_chars") and (keep_html or f.name != html)]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[list, set[int], dict[str, list[int]]]] = {}
        shapes = 0
        for b in batches:
            texts = []
            column = b.column(w)
            for i, (name, raw) in enumerate(zip(b.column(host).to_pylist(), b.column(html).to_pylist(), strict=True)):
                if not raw or not column[i].is_valid:
                    texts.append("")
                    continue
                if name not in known:
                    if len(known) > 2000 or shapes > SHAPES:
                        known.clear()
                        shapes = 0
                    s = column[i].as_py()
                    known[name] = (json.loads(s["wrapper"]), set(s["fixed"]), {})
                wrapper, fixed, taken = known[name]
                page = Page(raw)
                level = fold(page.roots, page, fixed, [hash_of(t) for t in page.texts])
                shape = _shape(level)
                if shape not in taken:
                    taken[shape] = matched(wrapper, level)
                    shapes += 1
                texts.append(text_of(page, level, taken[shape]))
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*[f.name for f in kept], "text", "n_chars"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "text string, n_chars long"])
    return map_arrow(met.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*[f.name for f in kept], host, html, w])]), each, schema)


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages, keep_html=False).select("page_id", "url", "text", "n_chars")
