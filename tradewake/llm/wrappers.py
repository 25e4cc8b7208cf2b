"""Main text of web pages by wrapper inference.

The pages of a host come from few templates. A wrapper is a union-free regular expression over their
token streams, kept as a tree: tags with children in order, where a child may be optional or
repeated, and texts that are constant or slots. A page is a wrapper of its own once its repeated
siblings are folded. Two wrappers are aligned child list by child list: what matches is merged, what
doesn't becomes optional, repeats fold into repeated groups, and texts that differ become slots. As
wrappers of wrappers align the same way, every task folds its pages per host, and few small trees
per host meet. The wrapper then tells which of its parts are article text; every page is aligned to
it once more and its own texts in those parts are put out.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, in_batches, rows_of

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"""
    r"""<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)>|"""
    r"""<(/?)([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)""", re.S)
_NAMING = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# HTML elements by how they behave.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title xmp iframe noembed noframes".split())
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s "
              "samp small span strike strong sub sup time tt u var wbr".split())
_CLOSES = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}),
           "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}),
           "th": ("td th", {"tr", "table"}), "option": ("option", {"select"})}
_NO_TEXT = set("script style noscript template iframe svg canvas object embed nav footer aside form "
               "button select option textarea head title menu dialog map audio video".split())
_WHOLE = {"html", "body", "main"}
_SIDE_NAMES = re.compile(
    r"(?:^|[-_ .#])(?:ads?|adverts?|advertisements?|adsense|sponsor\w*|promo\w*|banners?|cookies?|"
    r"consent|gdpr|notices?|alerts?|popups?|modal|overlay|newsletter|subscribe|subscription|nav|"
    r"navbar|navigation|menus?|breadcrumbs?|sidebars?|side|widgets?|footer|foot|masthead|comments?|"
    r"commentlist|disqus|repl(?:y|ies)|respond|discussion|shar(?:e|ing)|social|related|recommend\w*|"
    r"pagination|pager|toolbar|skip|login|signup|complementary|contentinfo|search)(?:$|[-_ .#])", re.I)
_HEADER = re.compile(r"(?:^|[-_ .#])(?:header|site-header|page-header)(?:$|[-_ .#])", re.I)
_BODY_NAMES = re.compile(
    r"(?:^|[ .#])(?:main|content|main-content|article|article-body|articlebody|post|post-content|"
    r"post-body|entry|entry-content|story|story-body|body-text)(?:$|[ .#])", re.I)

#: Elements nested deeper are taken as part of the one at this depth; their text stays. Parts that are
#: left out and parts that hold articles remain nodes of their own, as one more level of each kind.
DEEPEST = 60


class Node:
    """An element or a text of a page."""

    __slots__ = ("symbol", "children", "text")

    def __init__(self, symbol: str, text: str | None = None):
        self.symbol, self.children, self.text = symbol, [], text


def _symbol(name: str, attributes: str) -> str:
    if not attributes or "=" not in attributes or name in _INLINE:
        return name
    names = " ".join(a or b or c for _, a, b, c in _NAMING.findall(attributes))
    return f"{name} {re.sub('[0-9]+', '#', names).lower().strip()}" if names else name


def parse(page: str) -> Node:
    """The tree of a page, with the end tags that authors leave out or misplace."""
    root = Node("page")
    # All open elements: the node that takes their text, their name and the kinds of nodes that
    # stand below the deepest level; where each name is open, and where elements that aren't inline.
    stack: list[Node] = [root]
    names: list[str] = ["page"]
    below: list[frozenset] = [frozenset()]
    open_at: dict[str, list[int]] = {}
    blocks: list[int] = [0]
    at = 0

    def text(raw: str) -> None:
        if raw:
            stack[-1].children.append(Node("#text", entities.unescape(raw)))

    def close(depth: int) -> None:
        ended = None
        while len(names) > depth:
            name = names.pop()
            open_at[name].pop()
            if name not in _INLINE:
                blocks.pop()
                ended = name
            # Without a node of its own a block still ends the words before it.
            bare = stack.pop() is stack[-1]
            below.pop()
        if ended and bare:
            stack[-1].children.append(Node(ended))

    def nearest(some) -> int:
        return max((open_at[n][-1] for n in some if open_at.get(n)), default=0)

    while at < len(page):
        found = _TOKEN.search(page, at)
        if not found:
            break
        text(page[at:found.start()])
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        if found[1] or found[4]:
            k = nearest((name,))
            # A misplaced end of an inline element doesn't end the blocks inside it.
            if k and (name not in _INLINE or blocks[-1] < k):
                close(k)
            continue
        if name not in _INLINE:
            if names[blocks[-1]] == "p" and blocks[-1]:  # a block ends the paragraph before it
                close(blocks[-1])
            if name in _CLOSES:
                inner, outer = _CLOSES[name]
                k = nearest(inner.split())
                if k > nearest(outer):
                    close(k)
        node = Node(_symbol(name, found[3] or ""))
        stack[-1].children.append(node)
        if name in _RAW:
            end = re.compile(f"</{re.escape(name)}", re.I).search(page, at)
            at = end.start() if end else len(page)
            if end:
                at = page.find(">", at) + 1 or len(page)
        elif name not in _VOID:
            kinds = below[-1]
            if len(stack) >= DEEPEST:
                kind = _level(node.symbol)
                if kind and "out" not in kinds and kind not in kinds:
                    kinds = kinds | {kind}
                else:
                    node = stack[-1]
            open_at.setdefault(name, []).append(len(names))
            if name not in _INLINE:
                blocks.append(len(names))
            stack.append(node)
            names.append(name)
            below.append(kinds)
    text(page[at:])
    return root


# A wrapper is a dict: "s" symbol, "c" children, "o" optional, "r" repeated, "t" the text of a
# constant (its hash if long) or None for a slot, "p" the pages that have it, "h" a hash of all
# its text on a page or None if pages differ, "n" characters of text and "a" those in links.

def _digest(text: str) -> str:
    return hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()[:16]


def _leaf(node: Node, in_link: bool, own: dict) -> dict:
    """The wrapper of one page part; ``own`` gets the page's nodes of each wrapper part."""
    symbol = node.symbol
    w = {"s": symbol, "c": [], "o": 0, "r": 0, "t": None, "h": None, "p": 1, "n": 0, "a": 0}
    own[id(w)] = [node]
    if node.text is not None:
        plain = " ".join(node.text.split())
        w["t"] = plain if len(plain) <= 80 else "#" + _digest(plain)
        w["h"] = _digest(plain)
        w["n"] = len(plain)
        w["a"] = len(plain) if in_link else 0
        return w
    in_link = in_link or symbol.split(" ")[0] == "a"
    w["c"] = _fold([_leaf(c, in_link, own) for c in node.children
                    if c.text is None or c.text.strip()], own)
    return w


def _fold(items: list[dict], own: dict | None) -> list[dict]:
    """Repeated neighbours, single or in groups of up to four, become one that is repeated."""
    changed = True
    while changed:
        changed = False
        for size in (1, 2, 3, 4):
            out: list[dict] = []
            for item in items:
                out.append(item)
                if len(out) >= 2 * size and all(
                        out[-k]["s"] == out[-k - size]["s"] for k in range(1, size + 1)):
                    for k in range(size):
                        _merge(out[-2 * size + k], out[-size + k], own)
                        out[-2 * size + k]["r"] = 1
                    del out[-size:]
                    changed = True
            items = out
    return items


def _merge(a: dict, b: dict, own: dict | None = None) -> dict:
    """Merge ``b`` into ``a``, both of one symbol."""
    if own is not None:
        own[id(a)] += own.pop(id(b))
    a["o"] |= b["o"]
    a["r"] |= b["r"]
    if own is None:
        a["p"] += b["p"]
        if a["h"] != b["h"]:
            a["h"] = None
    elif a["h"]:  # within a page: the texts of all that is folded
        a["h"] = _digest(a["h"] + b["h"])
    a["n"] += b["n"]
    a["a"] += b["a"]
    if a["t"] != b["t"]:
        a["t"] = None
    if [x["s"] for x in a["c"]] == [x["s"] for x in b["c"]]:
        for x, y in zip(a["c"], b["c"]):
            _merge(x, y, own)
        return a
    out: list[dict] = []
    for x, y in _aligned(a["c"], b["c"]):
        if x is None or y is None:
            out.append(x or y)
            out[-1]["o"] = 1
        else:
            out.append(_merge(x, y, own))
    a["c"] = _fold(out, own)
    return a


def _aligned(a: list[dict], b: list[dict]) -> list[tuple[dict | None, dict | None]]:
    """Pairs of a longest common subsequence of symbols, the rest alone, in order.

    Row ``i`` has a bit per symbol of ``b``, from the last one on: 0 where that symbol makes the
    subsequence of what follows in both lists longer. A row is one operation on whole integers.
    """
    m, n = len(a), len(b)
    places: dict[str, int] = {}
    for j, x in enumerate(b):
        places[x["s"]] = places.get(x["s"], 0) | 1 << (n - 1 - j)
    full = (1 << n) - 1
    rows = [full] * (m + 1)
    for i in range(m - 1, -1, -1):
        row = rows[i + 1]
        hit = row & places.get(a[i]["s"], 0)
        rows[i] = (row + hit | row - hit) & full

    def longest(i: int, j: int) -> int:
        return n - j - (rows[i] & (1 << (n - j)) - 1).bit_count()

    out, i, j = [], 0, 0
    while i < m and j < n:
        if a[i]["s"] == b[j]["s"]:
            out.append((a[i], b[j]))
            i, j = i + 1, j + 1
        elif longest(i + 1, j) >= longest(i, j + 1):
            out.append((a[i], None))
            i += 1
        else:
            out.append((None, b[j]))
            j += 1
    return out + [(x, None) for x in a[i:]] + [(None, y) for y in b[j:]]


def expression(w: dict) -> str:
    """The wrapper as a regular expression over tags and texts, for reading."""
    if w["s"] == "#text":
        inner = "#slot" if w["t"] is None else repr(w["t"])
    else:
        inner = f"<{w['s']}> " + " ".join(map(expression, w["c"])) + f" </{w['s'].split(' ')[0]}>"
    mark = ("*" if w["o"] else "+") if w["r"] else "?" if w["o"] else ""
    return f"( {inner} ){mark}" if mark else inner


def _aside(symbol: str, in_article: bool) -> bool:
    name, _, names = symbol.partition(" ")
    if name in _NO_TEXT:
        return True
    if name in _WHOLE:  # names of a page's frame tell its layout, not what it is
        return False
    if names and _SIDE_NAMES.search(names):
        # A part named as content is left out only by a name of its own, such as "comment", not by
        # one that says something about it, such as "cookie-accepted".
        content = name == "article" or _BODY_NAMES.search(names)
        return not content or any(_SIDE_NAMES.fullmatch(x) for x in names.split()
                                  if "-" not in x and "_" not in x)
    return not in_article and (name == "header" or bool(names and _HEADER.search(names)))


def _kind(symbol: str) -> str | None:
    """How a part is marked as one that holds an article."""
    name, _, names = symbol.partition(" ")
    return "article" if name == "article" else \
        "main" if name == "main" or "main" in names.split() else \
        "named" if names and _BODY_NAMES.search(names) else None


def _level(symbol: str) -> str | None:
    """What a part needs a node of its own for, at any depth."""
    return "out" if _aside(symbol, True) else "header" if _aside(symbol, False) else _kind(symbol)


def judge(w: dict) -> dict:
    """Mark the parts of a host's wrapper that hold its articles with ``k``.

    The outermost ``article`` parts; without one the ``main`` part, without that the part that is
    named as content, and otherwise the one with the most text outside links among its own children.
    Menus, adverts, comments and the like are left out of all of these, and blocks of constant text.
    """
    kinds: dict[str, list[dict]] = {"article": [], "main": [], "named": []}
    masses: list[tuple[int, int, dict]] = []

    def visit(x: dict, inside: set[str]) -> None:
        if _aside(x["s"], "article" in inside):
            return
        kind = _kind(x["s"])
        if kind and kind not in inside:
            kinds[kind].append(x)
            inside = inside | {kind}
        mass = sum(_words(c) for c in x["c"] if c["s"].split(" ")[0] in
                   {"#text", "p", "br", "blockquote", "pre", *_INLINE})
        masses.append((mass, -len(masses), x))
        for c in x["c"]:
            visit(c, inside)

    visit(w, set())
    chosen = kinds["article"] or kinds["main"] or kinds["named"] or \
        [max(masses, key=lambda m: m[:2])[2]]
    for x in chosen:
        x["k"] = 1
        _mark_constants(x)
    return w


def _mark_constants(part: dict, least: int = 5, share: float = .8) -> None:
    """Mark with ``d`` the blocks of a part that read the same wherever the part occurs.

    They belong to the template: on ``share`` of the part's pages, ``least`` at the least, and not
    repeated; headings stay. Where less than half of the part's text differs between pages, they are
    copies of each other rather than pages of one template, and nothing is marked.
    """
    need = max(least, share * part["p"])
    found: list[dict] = []
    total = differs = 0

    def constant(x: dict) -> bool:
        if x["r"] or x["p"] < need or re.match(r"h[1-6]\b", x["s"]):
            return False
        return x["t"] is not None if x["s"] == "#text" else all(map(constant, x["c"]))

    def visit(x: dict, inside: bool) -> None:
        nonlocal total, differs
        total += x["n"]
        differs += x["n"] if x["s"] == "#text" and x["h"] is None else 0
        for c in x["c"]:
            if not _aside(c["s"], True):
                block = not inside and c["s"].split(" ")[0] not in {"#text", *_INLINE}
                template = block and constant(c)
                if template:
                    found.append(c)
                visit(c, inside or template)

    visit(part, bool(part["r"]))
    if 2 * differs >= total:
        for c in found:
            c["d"] = 1


def _words(x: dict) -> int:
    return x["n"] - x["a"] + sum(map(_words, x["c"]))


def _same_text(w: dict, x: dict) -> bool:
    """Whether a page's part holds just the constant texts of the wrapper's part."""
    return w["t"] == x["t"] and [c["s"] for c in w["c"]] == [c["s"] for c in x["c"]] \
        and all(map(_same_text, w["c"], x["c"]))


def main_text(page: str | None, wrapper: dict) -> str:
    """The text of the page's parts that its host's wrapper marks."""
    if not page:
        return ""
    tree = parse(page)
    own: dict[int, list[Node]] = {}
    shape = _leaf(tree, False, own)
    keep: set[int] = set()
    drop: set[int] = set()

    def match(w: dict, x: dict) -> None:
        if w.get("k"):
            keep.update(id(n) for n in own[id(x)])
        if w.get("d") and _same_text(w, x):
            drop.update(id(n) for n in own[id(x)])
            return
        for a, b in _aligned(w["c"], x["c"]):
            if a is not None and b is not None:
                match(a, b)

    match(wrapper, shape)
    if not keep:  # a page without the part: judged by itself
        match(judge(shape), shape)
    blocks: list[str] = []
    run: list[str] = []

    def end() -> None:
        block = " ".join("".join(run).split())
        run.clear()
        if block:
            blocks.append(block)

    def walk(node: Node, kept: bool) -> None:
        if node.text is not None:
            if kept:
                run.append(node.text)
            return
        start = id(node) in keep
        if kept and not start and (id(node) in drop or _aside(node.symbol, True)):
            end()
            return
        inline = node.symbol.split(" ")[0] in _INLINE
        if not inline:
            end()
        for c in node.children:
            walk(c, kept or start)
        if not inline:
            end()

    walk(tree, False)
    end()
    return " ".join(blocks)


_FOLDED = pa.schema([("host", pa.string()), ("part", pa.int64()), ("wrapper", pa.string())])
_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


def _fold_pages(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()

    def rows():
        held: dict[str, dict] = {}
        for host, page in rows_of(batches, "host", "html"):
            if page:
                w = _leaf(parse(page), False, {})
                held[host] = _merge(held[host], w) if host in held else w
            if len(held) > most:
                yield from ((h, part, json.dumps(x)) for h, x in held.items())
                held.clear()
        yield from ((h, part, json.dumps(x)) for h, x in held.items())
    return in_batches(_FOLDED, rows())


def _merge_folded(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """Wrappers of equal ``host`` and ``part``, which come one after the other, as one."""
    def rows():
        key, now = None, None
        for host, part, text in rows_of(batches, "host", "part", "wrapper"):
            w = json.loads(text)
            if (host, part) == key:
                now = _merge(now, w)
                continue
            if now is not None:
                yield (*key, json.dumps(judge(now) if last else now))
            key, now = (host, part), w
        if now is not None:
            yield (*key, json.dumps(judge(now) if last else now))
    return in_batches(_FOLDED, rows())


def infer(pages: DataFrame, stage: Stage, salts: int = 64, most_hosts: int = 2000) -> DataFrame:
    """``host, wrapper`` over all pages: folded per task, then per host in two steps.

    ``pages`` has ``host`` and ``html``. A host sends one wrapper from every task, however many
    pages it has; ``salts`` spreads those of a host that is everywhere.
    """
    kind = "host string, part long, wrapper string"
    folded = stage.save(pages.mapInArrow(partial(_fold_pages, most=most_hosts), kind))
    salted = folded.withColumn("part", F.pmod("part", F.lit(salts)))
    some = salted.repartition("host", "part").sortWithinPartitions("host", "part").mapInArrow(
        partial(_merge_folded, last=False), kind)
    return some.withColumn("part", F.lit(0).cast("long")).repartition("host") \
        .sortWithinPartitions("host").mapInArrow(partial(_merge_folded, last=True), kind) \
        .select("host", "wrapper")


_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()),
                    ("n_chars", pa.int64()), ("host", pa.string())])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        last, wrapper = None, None
        for page_id, url, page, host, text in rows_of(
                batches, "page_id", "url", "html", "host", "wrapper"):
            if text != last:
                last, wrapper = text, json.loads(text) if text else None
            found = main_text(page, wrapper) if wrapper else ""
            yield page_id, url, found, len(found), host
    return in_batches(_TEXTS, rows())


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, host`` for every page.

    ``pages`` has ``page_id, url, html``; other columns are ignored. Character references are
    decoded, white space within a block is one space, and blocks are joined in page order by one
    space. A null or empty page, or one without text, has an empty text; plain text without markup
    is text. A block that reads the same on most pages of its host is part of the template and left
    out. Wrappers of a host depend on the order in which its pages are merged, where their child
    lists align in more than one way. Broken and cut-off markup is read as far as it goes. A null url is a host of its own,
    repeated rows are extracted alike, and an empty table gives an empty table.
    """
    stage = Stage(pages.sparkSession, "wrappers")
    hosts = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.coalesce(
        F.lower(F.regexp_extract("url", _HOST, 1)), F.lit("")).alias("host"))
    wrappers = stage.save(infer(hosts.select("host", "html"), stage))
    return hosts.join(wrappers, "host", "left").select(
        "page_id", "url", "html", "host", "wrapper").mapInArrow(
        _apply, "page_id long, url string, text string, n_chars long, host string")
