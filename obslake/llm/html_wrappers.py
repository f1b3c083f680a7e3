"""Main text of web pages by wrappers: one union-free regular expression per host, inferred by aligning its pages.

A page is a tree of elements (tag with its class, id and role) and texts. Sibling runs of one kind, and groups of two or three
kinds that follow each other again, are folded into repeated groups. Two pages, or a page and a wrapper, are aligned
child list by child list: what stands in one only becomes optional, texts that differ become a slot, equal ones stay text
with the hashes of the first few different pages that have them. Text is template only if pages of different words share it: copies of one
page, and lines that come again within a page, are one. There are no alternatives, so a wrapper grows with a host's layouts,
not with its pages.

Every page of every host takes part. Tasks fold their own pages first, so a host with a third of all pages reaches the merge as one
wrapper per task; those are merged in two steps. Wrappers are sent to the tasks if they are small together (measured), else
pages and wrappers are joined by host.

Nodes are judged: menus, headers, footers, sidebars, notices, adverts, forms, scripts and comments by tag, role and name; the article
region by the first element of those that hold articles that the page itself has, so that a host's layouts don't empty each other's
pages; and template text that many pages share, in blocks other than headings, paragraphs and the like.
A page is read along its host's wrapper, and the texts of kept nodes make its main text.

Null and empty pages have an empty text. A null or odd url is the host "". Repeated rows give repeated results and count once.
Only page_id, url and html are read. Pages are parsed and read at any depth; in a wrapper all that is nested deeper than ``DEPTH`` stands in
one list of its ancestor at that depth.
"""

from __future__ import annotations

import functools
import hashlib
import html
import json
import re
from difflib import SequenceMatcher
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from obslake.llm.common import batches
from obslake.session import cut_lineage

DEPTH = 120
SHARED = 3  # different pages that make a text template; so many are known of a text
_SMALL = 32 << 20  # bytes of wrappers that are sent to every task
_FLUSH = 5_000  # wrappers a task holds before it passes them on

#: How HTML reads its tags.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
            " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody"
            " td tfoot th thead title tr ul".split())
CLOSES_P = BLOCK - {"br", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "legend", "body", "head", "html"}
SAME = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"),
        "th": ("td th", "tr table"), "option": ("option", "select"), "thead": ("thead tbody tfoot", "table"),
        "tbody": ("thead tbody tfoot tr td th", "table"), "tfoot": ("thead tbody tfoot tr td th", "table")}
DROPPED = set("head title script style noscript template svg math iframe object embed canvas audio video nav footer aside form button select"
              " option textarea input label dialog menu datalist fieldset".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar status".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | set("p blockquote pre li td th dd dt figcaption".split())
TEMPLATED = BLOCK - PROSE

_NAMED = re.compile(
    r"(?:^|[-_ ])(?:ads?|adv|advert\w*|adslot|adbox|sponsor\w*|promo\w*|banners?|cookies?|consent|gdpr|notices?|notification\w*|alerts?"
    r"|popups?|modals?|overlay|newsletter|subscri\w*|sidebars?|sidenav|widgets?|menus?|nav|navbar|navigation|breadcrumbs?|masthead|topbar"
    r"|footers?|comments?|commentlist|disqus|respond|replies|reply|related|recommend\w*|shar(?:e|ing)|social|toolbar|pagination|pager"
    r"|login|signup|search\w*|hidden|skip\w*|paywall|outbrain|taboola)(?:$|[-_ ])", re.I)
_HEADER = re.compile(r"(?:^|[-_ ])(?:headers?|byline|meta)(?:$|[-_ ])", re.I)
_CONTENT = re.compile(r"(?:^|[-_ ])(?:content|article|post|entry|story|main|body-?text)(?:$|[-_ ])", re.I)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|title|textarea|xmp|noembed|noframes)\b[^>]*>(?P<inner>.*?)(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>", re.S | re.I)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|\b(hidden)\b")
_DIGITS = re.compile(r"\d+")


@functools.lru_cache(maxsize=50_000)
def kind_of(tag: str, rest: str) -> str:
    """An element's kind: tag, and what of its attributes names its part in the page."""
    if "=" not in rest and "hidden" not in rest:
        return tag
    found = {(k or flag).lower(): html.unescape(v.strip("\"'")) if k else "" for k, v, flag in _ATTRIBUTE.findall(rest)}
    names = " ".join(sorted(_DIGITS.sub("0", f"{found.get('class', '')} {found.get('id', '')}").split()))
    role = found.get("role", "").lower()
    unseen = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    return "|".join((tag, names, role, "unseen" if unseen else "")).rstrip("|")


class Element:
    __slots__ = ("kind", "tag", "children")

    def __init__(self, kind: str, tag: str) -> None:
        self.kind, self.tag = kind, tag
        self.children: list[Element | str] = []


def parse(page: str) -> Element:
    """A page as a tree; raw elements (scripts, styles, titles) are left out."""
    root = Element("", "")
    open_: list[Element] = [root]
    places: dict[str, list[int]] = {}  # of the open elements, by tag: no depth makes a tag slow

    def close(i: int) -> None:
        for element in open_[i:]:
            places[element.tag].pop()
        del open_[i:]

    def last(tags: tuple[str, ...]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def close_to(names: tuple[str, ...], within: tuple[str, ...]) -> None:
        i = last(names)
        if i > last(within):
            close(i)

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            open_[-1].children.append(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if m["close"]:
            if places.get(tag):
                close(places[tag][-1])
            continue
        if tag in CLOSES_P and places.get("p"):
            close_to(("p",), ("table", "td", "th", "button"))
        if tag in SAME:
            names, within = SAME[tag]
            for _ in range(3):
                close_to(tuple(names.split()), tuple(within.split()))
        element = Element(kind_of(tag, m["rest"]), tag)
        open_[-1].children.append(element)
        if tag not in VOID and not m["rest"].endswith("/"):
            places.setdefault(tag, []).append(len(open_))
            open_.append(element)
    if at < len(page):
        open_[-1].children.append(page[at:])
    return root


def words_hash(element: Element) -> int:
    """A hash of a page's words, which copies share whatever their scripts and attributes hold."""
    out, todo = [], [element]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo += x.children
    return int.from_bytes(hashlib.blake2b(" ".join(" ".join(out).split()).encode("utf-8", "surrogatepass"), digest_size=7).digest(), "big")


# --- wrappers: [kind, optional, repeated, children] or ["#", optional, text or None for a slot, times, hashes of pages ...] ----

def _merged_text(a: list, b: list) -> list:
    if a[2] is None or a[2] != b[2]:
        return ["#", a[1] or b[1], None, a[3] + b[3]]
    # the least few of all hashes, whatever the order of merging: no fewer than that are known if there are more
    return ["#", a[1] or b[1], a[2], a[3] + b[3], *sorted({*a[4:], *b[4:]})[:SHARED]]


def merged(a: list, b: list) -> list:
    if a[0] == "#":
        return _merged_text(a, b)
    return [a[0], a[1] or b[1], a[2] or b[2], align(a[3], b[3])]


def _optional(node: list) -> list:
    return [node[0], True, *node[2:]]


def align(a: list[list], b: list[list]) -> list[list]:
    """Both child lists as one: common kinds in common order, the rest optional."""
    kinds_a, kinds_b = [x[0] for x in a], [x[0] for x in b]
    if kinds_a == kinds_b:
        return [merged(x, y) for x, y in zip(a, b)]
    out = []
    for op, i, j, k, n in SequenceMatcher(None, kinds_a, kinds_b, autojunk=False).get_opcodes():
        if op == "equal":
            out += [merged(x, y) for x, y in zip(a[i:j], b[k:n])]
        else:
            out += [_optional(x) for x in a[i:j]] + [_optional(x) for x in b[k:n]]
    return fold(out)


def _as_repeated(a: list, b: list) -> list:
    m = merged(a, b)
    return m if m[0] == "#" else [m[0], m[1], True, m[3]]


def fold(nodes: list[list]) -> list[list]:
    """Runs of one kind, and groups of two or three kinds that come again, as one repeated node."""
    out: list[list] = []
    for node in nodes:
        if out and out[-1][0] == node[0]:
            out[-1] = _as_repeated(out[-1], node)
        else:
            out.append(node)
    for size in (2, 3):
        i = 0
        while i + size <= len(out):
            group = [x[0] for x in out[i:i + size]]
            if i + 2 * size <= len(out) and [x[0] for x in out[i + size:i + 2 * size]] == group and len(set(group)) > 1:
                joined = [_as_repeated(x, y) if x[0] != "#" else _merged_text(x, y) for x, y in zip(out[i:i + size], out[i + size:i + 2 * size])]
                out[i:i + 2 * size] = joined
            else:
                i += 1
    return out


def _parts(element: Element, page: tuple[int, ...]) -> list[list | Element]:
    """An element's texts as nodes and its child elements, in order."""
    out, text = [], ""

    def close_text() -> None:
        words = " ".join(html.unescape(text).split())
        if words:
            out.append(["#", False, words, 1, *page] if len(words) <= 80 else ["#", False, None, 1])

    for child in element.children:
        if isinstance(child, str):
            text += child
        else:
            if text:
                close_text()
                text = ""
            out.append(child)
    if text:
        close_text()
    return out


def _flat(element: Element, page: tuple[int, ...]) -> list[list]:
    """An element and all within it, in one list; each holds its own texts."""
    out, todo = [], [element]
    while todo:
        x = todo.pop()
        parts = _parts(x, page)
        out.append([x.kind, False, False, fold([p for p in parts if isinstance(p, list)])])
        todo += [p for p in reversed(parts) if not isinstance(p, list)]
    return out


def wrapper_of(element: Element, *page: int, depth: int = 1) -> list:
    """The wrapper of one page's element; texts of more than 80 characters are slots at once. ``page``: the hash of its words."""
    children = []
    for part in _parts(element, page):
        if isinstance(part, list):
            children.append(part)
        elif depth < DEPTH:
            children.append(wrapper_of(part, *page, depth=depth + 1))
        else:
            children += _flat(part, page)
    return [element.kind, False, False, fold(children)]


def _names(kind: str) -> tuple[str, str, str, bool]:
    tag, names, role, unseen = (kind.split("|") + ["", "", ""])[:4]
    return tag, names, role, unseen == "unseen"


class Wrapper:
    """A host's wrapper with each node judged; ``text_of`` reads a page along it."""

    def __init__(self, tree: list, shared_by: int = SHARED) -> None:
        self.tree, self.shared_by = tree, shared_by

    def _dropped(self, kind: str, in_region: bool) -> bool:
        tag, names, role, unseen = _names(kind)
        if tag in DROPPED or unseen or role in ROLES or (tag not in ("html", "body", "article", "main", "") and _NAMED.search(names)):
            return True
        if tag == "article" and re.search(r"comment|related|promo|teaser", names, re.I):
            return True
        return not in_region and (tag == "header" or bool(_HEADER.search(names) and tag not in HEADINGS | {"html", "body"}))

    def _region(self, page: Element):
        """Which elements hold the article: the first of these that the page has outside dropped parts, else None for all of it."""
        tests = (
            lambda tag, names, role: tag == "article", lambda tag, names, role: tag == "main" or role == "main",
            lambda tag, names, role: tag in ("div", "section", "td") and bool(_CONTENT.search(names)))
        for test in tests:
            todo = [page]
            while todo:
                element = todo.pop()
                if isinstance(element, str) or self._dropped(element.kind, True):
                    continue
                if test(*_names(element.kind)[:3]):
                    return test
                todo += element.children
        return None

    def text_of(self, page: Element) -> str:
        """Blocks are parted by a mark that no text holds; character references are read after that, block by block."""
        out: list[str] = []
        region = self._region(page)

        def opened(element: Element, node: list | None, parts: list, inside: bool, header: bool | None) -> tuple:
            """``inside``: in the article region; ``header``: in a header there, of which only headings are kept.

            ``parts``: the nodes of its children, and the place of the last one met.
            """
            template = {x[2] for x in node[3] if x[0] == "#" and len(x) - 4 >= self.shared_by} if node and element.tag in TEMPLATED else set()
            block = element.tag in BLOCK
            if block:
                out.append("\0")
            return iter(element.children), parts, template, inside, header, block

        stack = [opened(page, self.tree, [self.tree[3], 0], region is None, None)]
        while stack:
            children, parts, template, inside, header, block = stack[-1]
            for child in children:
                if isinstance(child, str):
                    if inside and not header and not (template and " ".join(html.unescape(child).split()) in template):
                        out.append(child.replace("\0", " "))
                    continue
                if child.tag == "br":
                    out.append("\0")
                    continue
                nodes, place = parts
                k = next((i for i in range(place, len(nodes)) if nodes[i][0] == child.kind), None)
                if k is None:
                    k = next((i for i, x in enumerate(nodes) if x[0] == child.kind), None)
                else:
                    parts[1] = k
                here = inside or (region is not None and region(*_names(child.kind)[:3]))
                if self._dropped(child.kind, here and inside):
                    if child.tag in BLOCK:
                        out.append("\0")
                    continue
                in_header = header
                if inside and (child.tag == "header" or _HEADER.search(_names(child.kind)[1])):
                    in_header = True
                if child.tag in HEADINGS:
                    in_header = None
                node = nodes[k] if k is not None else None
                below = [node[3] if node else [], 0] if len(stack) < DEPTH else parts
                stack.append(opened(child, node, below, here, in_header))
                break
            else:
                if block:
                    out.append("\0")
                stack.pop()
        return " ".join(" ".join(html.unescape(x) for x in "".join(out).split("\0")).split())


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


_WRAPPER = pa.schema([("host", pa.string()), ("wrapper", pa.string())])


def infer(pages: DataFrame, parts: int = 64) -> DataFrame:
    """(host, wrapper) of all hosts, from all their pages."""

    def run(it):
        known: dict[str, list] = {}
        for batch in it:
            for url, page in zip(batch["url"].to_pylist(), batch["html"], strict=True):
                host, tree = host_of(url), parse(page.as_py())
                tree = wrapper_of(tree, words_hash(tree))
                known[host] = merged(known[host], tree) if host in known else tree
            if len(known) >= _FLUSH:
                yield from batches([(h, json.dumps(t)) for h, t in known.items()], _WRAPPER, 500)
                known.clear()
        yield from batches([(h, json.dumps(t)) for h, t in known.items()], _WRAPPER, 500)

    def joined(key, rows):
        trees = (json.loads(w) for w in sorted(rows["wrapper"].to_pylist()))
        total = next(trees)
        for t in trees:
            total = merged(total, t)
        return pa.table({"host": [key[0].as_py()], "wrapper": [json.dumps(total)]}, schema=_WRAPPER)

    found = _readable(pages).select("url", "html").mapInArrow(run, "host string, wrapper string")
    found = found.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(parts)))
    found = found.groupBy("host", "part").applyInArrow(joined, "host string, wrapper string")
    return found.groupBy("host").applyInArrow(joined, "host string, wrapper string")


def _readable(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"))


_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _text_rows(batch: pa.RecordBatch, wrappers) -> list[tuple]:
    out = []
    for page_id, url, page in zip(batch["page_id"].to_pylist(), batch["url"].to_pylist(), batch["html"], strict=True):
        text = wrappers(url).text_of(parse(page.as_py()))
        out.append((page_id, url, text, len(text)))
    return out


def extract(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    wrappers = cut_lineage(infer(pages))
    size = wrappers.agg(F.coalesce(F.sum(F.octet_length("wrapper") + F.octet_length("host") + 100), F.lit(0))).first()[0]
    rows, schema = _readable(pages), "page_id long, url string, text string, n_chars long"
    if size <= _SMALL:
        sent = pages.sparkSession.sparkContext.broadcast({r["host"]: r["wrapper"] for r in wrappers.collect()})

        def run(it):
            of = functools.lru_cache(maxsize=1_000)(lambda host: Wrapper(json.loads(sent.value[host])))
            for batch in it:
                yield from batches(_text_rows(batch, lambda url: of(host_of(url))), _TEXT, 500)

        return rows.mapInArrow(run, schema)

    host = F.udf(host_of, "string")

    def run_joined(it):
        of = functools.lru_cache(maxsize=100)(lambda text: Wrapper(json.loads(text)))
        for batch in it:
            for i in range(batch.num_rows):
                yield from batches(_text_rows(batch.slice(i, 1), lambda _: of(batch["wrapper"][i].as_py())), _TEXT, 1)

    return rows.withColumn("host", host("url")).join(wrappers, "host").select("page_id", "url", "html", "wrapper").mapInArrow(run_joined, schema)
