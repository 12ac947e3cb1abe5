"""Main text of web pages, with site templates removed.

A page becomes a tree of elements. Every element's subtree is hashed (tags and text); Spark
counts on how many different pages of its host a hash occurs, and subtrees that recur on many
are template and deleted (``is_template``). Pages of a host with the same text, templates
included, are copies and count once. What the markup itself names as no part of the article
(``DROP``, ``NAMES``: menus, headers, footers, sidebars, notices, adverts, forms, scripts,
reader comments) goes wherever it stands, as most of it differs from page to page; if the page
has an ``article`` or ``main`` element, only such elements count. Text of an ``article`` or
``main`` element is what is asked for even where pages share a passage, so there only
subtrees without a paragraph, heading or other ``TEXTUAL`` element can be template.

A page that would lose all its text to templates gets back the rarest of them, and more until
there is text: so a page that a host holds many times under different menus keeps its body.

Counting combines in each partition first; a page gets the hashes to delete by a join on
its own key, so neither a large host nor a host with many templates meets in one task.
Trees are built and read without recursion in time linear in the page, however deep or broken.

Defined results: a null or empty html gives an empty text; text outside of any element
counts as a block; unclosed elements end with their parent; an unfinished tag or comment at
the end is markup; very long pages are read whole; repeated rows each give a row; of ties in
rarity all come back; a url without a host belongs to the host of the empty name; an empty
table gives an empty result; extra columns take no part.
"""

from __future__ import annotations

import html as entities
import re
from hashlib import blake2b

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import arrow_rows, cut

#: A template recurs on so many different pages of its host and on this share of them;
MIN_PAGES, MIN_SHARE = 5, 0.1
#: or, on small hosts, on fewer pages and a larger share of them; or on so many pages, whatever the host's size.
FEW_PAGES, FEW_SHARE = 3, 0.6
MANY_PAGES = 50
#: Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template svg iframe".split())
DROP = frozenset("head script style noscript template svg iframe nav header footer aside form button select textarea input menu dialog title object canvas audio video".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 dd dt pre blockquote td th figcaption".split())
INLINE = frozenset("b i em strong a span code q li".split())
#: Which open elements the start of another one closes, and which elements keep it from doing so.
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
CLOSES = {tag: (own.split(), bounds.split()) for tag, (own, bounds) in CLOSES.items()}
#: Words in a class, id or role that name what is no part of an article, and words that may stand beside them.
NAMES = frozenset(
    "menu nav navbar navigation header masthead footer sidebar complementary contentinfo notice cookie consent gdpr "
    "ad ads advert adverts advertisement advertising sponsor sponsored banner promo form search login signup subscribe newsletter "
    "comment comments disqus reply replies respond".split()
)
BESIDE = frozenset("site page main top bottom left right inner outer area bar block body box container content group item items link links list panel row section slot thread unit user reader wrap wrapper widget".split())
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)>""")
PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
NAMED = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden)(?![\w-])(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
KEEP_ROOT = frozenset(("article", "main"))


class Node:
    """An element; ``noise``: named as no part of the article, ``hidden``: it or an element around it is, ``inside`` an article."""

    __slots__ = ("code", "hidden", "inside", "noise", "parts", "tag", "textual")

    def __init__(self, tag: str, parent: Node | None = None, noise: bool = False) -> None:
        self.tag, self.noise, self.parts, self.code, self.textual = tag, noise, [], b"", tag in TEXTUAL
        self.hidden = noise or (parent is not None and parent.hidden)
        self.inside = tag in KEEP_ROOT or (parent is not None and parent.inside)


def names_noise(value: str) -> bool:
    """Whether a class, id or role has a word of ``NAMES``, alone or beside words that say nothing else."""
    for word in value.lower().split():
        parts = [p for p in re.split(r"[-_0-9]+", word) if p]
        if NAMES.intersection(parts) and all(p in NAMES or p in BESIDE for p in parts):
            return True
    return False


def _noisy(tag: str, attributes: str) -> bool:
    if tag in DROP:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, *values in NAMED.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if (name != "id" or tag not in TEXTUAL) and name != "aria-hidden" and names_noise(value):
            return True
    return False


def tree(html: str) -> list[Node]:
    """The elements of a page in page order, the root first; forgiving as browsers are about what is not closed."""
    root = Node("#root")
    nodes, stack, at, size = [root], [root], 0, len(html)
    opened: dict[str, list[int]] = {}  # places in the stack by tag
    tags, cdata = TAG, True

    def last(names: list[str]) -> int:
        return max((opened[n][-1] for n in names if opened.get(n)), default=-1)

    def close(k: int) -> None:
        for node in stack[k:]:
            opened[node.tag].pop()
        del stack[k:]

    while at < size:
        start = html.find("<", at)
        if start < 0:
            stack[-1].parts.append(html[at:])
            break
        if start > at:
            stack[-1].parts.append(html[at:start])
        second = html[start + 1 : start + 2]
        if second == "!" or second == "?":
            if html.startswith("<!--", start):
                end = html.find("-->", start + 2)
                at = end + 3 if end >= 0 else size
                continue
            if cdata and html.startswith("<![CDATA[", start):
                end = html.find("]]>", start)
                cdata = end >= 0  # no end from here on, so none later
                if cdata:
                    stack[-1].parts.append(entities.escape(html[start + 9 : end]))
                    at = end + 3
                    continue
            end = html.find(">", start)
            at = end + 1 if end >= 0 else size
            continue
        name = html[start + 2 : start + 3] if second == "/" else second
        if not (name.isascii() and name.isalpha()):
            if second == "/" and name:
                end = html.find(">", start)
                at = end + 1 if end >= 0 else size
            else:
                stack[-1].parts.append("<")
                at = start + 1
            continue
        m = tags.match(html, start)
        if m is None:
            if tags is TAG:  # quotes hide every later end of a tag: from here on they don't count
                tags = PLAIN
                m = tags.match(html, start)
            if m is None:
                break
        at = m.end()
        tag = m[2].lower()
        if m[1]:
            if opened.get(tag):
                close(opened[tag][-1])
            continue
        if tag in BLOCK and opened.get("p"):  # closes an open paragraph, with whatever inline elements are open in it
            close(opened["p"][-1])
        if tag in CLOSES:
            own, bounds = CLOSES[tag]
            if (k := last(own)) > last(bounds):
                close(min(opened[n][-1] for n in own if opened.get(n) and opened[n][-1] > last(bounds)))
        node = Node(tag, stack[-1], _noisy(tag, m[3]))
        stack[-1].parts.append(node)
        nodes.append(node)
        if m[3].endswith("/") or tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            if tag not in DROP:
                node.parts.append(html[at : end.start() if end else size])
            at = end.end() if end else size
        else:
            opened.setdefault(tag, []).append(len(stack))
            stack.append(node)
    return nodes


def _squeeze(text: str) -> str:
    return " ".join(text.split())


def _number(code: bytes) -> int:
    return int.from_bytes(code, "little", signed=True)


def content_hash(nodes: list[Node]) -> int:
    """Number of a page's text, templates included: copies have the same one."""
    return _number(blake2b("\n".join(_blocks(nodes, frozenset())).encode("utf-8", "replace"), digest_size=8).digest())


def coded(nodes: list[Node]) -> dict[int, int]:
    """Element -> number of its subtree (tags and text), for those that may be template."""
    found = {}
    for node in reversed(nodes):  # what an element holds comes after it
        h = blake2b(node.tag.encode(), digest_size=8)
        for x in node.parts:
            if isinstance(x, Node):
                h.update(b"\1" + x.code)
                node.textual = node.textual or x.textual
            else:
                h.update(b"\2" + _squeeze(x).encode("utf-8", "replace"))
        node.code = h.digest()
        if node.tag in ("#root", "html", "body", "br") or (node.inside and (node.textual or node.tag in KEEP_ROOT or node.tag in INLINE)):
            continue
        found[id(node)] = _number(node.code)
    return found


def blocks(html: str | None, template: dict[int, int] | None = None) -> list[str]:
    """Text blocks of the article, in page order, without subtrees of ``template`` (number of a subtree -> pages that have it)."""
    nodes = tree(html or "")
    if not template:
        return _blocks(nodes, frozenset())
    codes = coded(nodes)
    while True:
        out = _blocks(nodes, {x for x, code in codes.items() if code in template})
        if out or not template:
            return out
        rarest = min(template.values())
        template = {code: n for code, n in template.items() if n > rarest}


def _blocks(nodes: list[Node], gone: set[int] | frozenset[int]) -> list[str]:
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        if text := _squeeze(entities.unescape("".join(held))):
            out.append(text)
        held.clear()

    tops = [x for x in nodes if x.tag in KEEP_ROOT and not x.hidden]
    if tops:  # the outermost ones
        within = {id(y) for x in nodes if x.inside for y in x.parts if isinstance(y, Node)}
        tops = [x for x in tops if id(x) not in within]
    for top in tops or nodes[:1]:
        walk: list[Node | str | None] = list(reversed(top.parts))
        while walk:
            x = walk.pop()
            if x is None:
                flush()
            elif not isinstance(x, Node):
                held.append(x)
            elif x.noise or id(x) in gone:
                if x.tag in BLOCK or x.tag in DROP:
                    flush()
            elif x.tag == "br":
                held.append(" ")
            elif x.tag in BLOCK:
                flush()
                walk.append(None)
                walk.extend(reversed(x.parts))
            else:
                walk.extend(reversed(x.parts))
        flush()
    return out


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def is_template(n: Column, pages: Column, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> Column:
    """Whether a subtree on ``n`` of a host's ``pages`` different pages is template."""
    return ((n >= min_pages) & (n >= min_share * pages)) | ((n >= FEW_PAGES) & (n >= FEW_SHARE * pages)) | (n >= MANY_PAGES)


def templates(subtrees: DataFrame, hosts: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """``host, code, content`` (of each page and subtree) and ``host, content`` (of each page) -> the recurring ``host, code, n``."""
    counts = subtrees.groupBy("host", "code").agg(F.count_distinct("content").alias("n")).where(F.col("n") >= min(min_pages, FEW_PAGES))
    sizes = hosts.groupBy(F.col("host").alias("of")).agg(F.count_distinct("content").alias("pages"))
    return counts.join(sizes, F.col("host") == F.col("of")).where(is_template(F.col("n"), F.col("pages"), min_pages, min_share)).select("host", "code", "n")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """Pages -> ``page_id, url, text, n_chars``."""
    whole = pages.select(pages["page_id"].alias("page_id"), pages["url"].cast("string").alias("url"), pages["html"].cast("string").alias("html"))
    keyed = whole.withColumn("host", host_of(F.col("url"))).withColumn("row", F.xxhash64("page_id", "url", "html"))

    def hashes(cols: dict[str, list]) -> dict[str, list]:
        found = []
        for r, h, t in zip(cols["row"], cols["host"], cols["html"], strict=True):
            nodes = tree(t or "")
            content = content_hash(nodes)
            found += [(r, h, c, content) for c in (None, *set(coded(nodes).values()))]  # no code: the page itself
        return {n: [x[i] for x in found] for i, n in enumerate(("row", "host", "code", "content"))}

    counted = cut(arrow_rows(keyed.select("row", "host", "html"), hashes, "row bigint, host string, code bigint, content bigint"), "subtrees")
    subtrees = counted.where("code is not null")
    recurring = cut(templates(subtrees, counted.where("code is null"), min_pages, min_share), "templates").withColumnsRenamed({"host": "h", "code": "c"})
    doomed = subtrees.join(recurring, F.expr("host = h and code = c")).groupBy(F.col("row").alias("r")).agg(F.collect_set(F.struct("code", "n")).alias("codes"))
    joined = keyed.join(doomed, F.expr("row = r"), "left").select("page_id", "url", "html", "codes")

    def texts(cols: dict[str, list]) -> dict[str, list]:
        found = [blocks(t, {x["code"]: x["n"] for x in c or ()}) for t, c in zip(cols["html"], cols["codes"], strict=True)]
        return {"page_id": cols["page_id"], "url": cols["url"], "text": ["\n".join(x) for x in found]}

    kind = pages.schema["page_id"].dataType.simpleString()
    out = arrow_rows(joined, texts, f"page_id {kind}, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
