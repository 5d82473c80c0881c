"""Main text of a web page by tree scoring.

Paragraphs pass points for their length and commas to their ancestors, a container's sum is
discounted by the share of its text that stands in links, and the best container is kept
together with those of its siblings that score well or read like prose. Elements whose tag, role, class or id
names a menu, header, footer, sidebar, notice, advert, form or comment section take no part, unless they
hold the article or nearly all of the page's text (`settle`). Hidden elements never do.

A null or empty page, and one without text, gives the empty string. Unclosed, crossed and stray tags
are accepted. Pages are read whole. Repeated pages give repeated rows, an empty table an empty one.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)"
                    r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.DOTALL)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
WORD = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])|display\s*:\s*none|visibility\s*:\s*hidden")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object math select "
                "canvas audio video".split())
# Their unclosed elements end with the page, those of the other kinds at the next block or with their parent.
TO_END = frozenset("script style textarea".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre section summary table tbody tfoot thead tr ul".split())
SPACED = frozenset("br td th".split())
# A start tag of the second kind ends an open element of the first, up to the given borders.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}),
        "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
P_BORDERS = frozenset("td th table article section main body html li".split())

UNLIKELY_TAGS = frozenset("nav footer aside form button menu dialog fieldset label input".split())
UNLIKELY_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert "
                           "alertdialog menu menubar form toolbar".split())
UNLIKELY_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments commentlist consent cookie cookies discussion disqus footer gdpr header login masthead "
    "menu menus modal nav navbar navigation newsletter notice notices notification outbrain overlay "
    "pager pagination paywall popup promo promoted promotion recommended related replies reply respond "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola "
    "toolbar topbar tracking widget widgets sticky alert disclaimer".split())
TALK = frozenset("comment comments commentlist discussion disqus replies reply respond".split())
LITTLE = 250  # characters
LIKELY_TAGS = frozenset("html body article main".split())
SCORED = frozenset("p pre blockquote td li dd figcaption h1 h2 h3 h4 h5 h6".split())


class Node:
    """`drop` is why a node takes no part: "hidden", "talk", "named" or, if it does, empty."""

    __slots__ = ("tag", "parent", "children", "score", "drop", "length", "linked", "head", "prose", "open")

    def __init__(self, tag, parent, drop="", head=False):
        self.tag, self.parent, self.drop, self.head = tag, parent, drop, head
        self.children, self.score, self.length, self.linked = [], 0.0, 0, 0
        self.prose = self.open = 0


def attributes_of(attributes: str) -> tuple[dict, str]:
    """Lower-case attributes that have values, and the rest."""
    lower = attributes.lower()
    return ({m[1]: m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(lower)},
            ATTRIBUTE.sub(" ", lower))


def unlikely_words(found: dict) -> set[str]:
    return UNLIKELY_WORDS.intersection(
        WORD.findall(f"{found.get('class', '')} {found.get('id', '')}"))


def unlikely(tag: str, attributes: str, in_article: bool) -> str:
    if tag in LIKELY_TAGS:
        return ""
    found, bare = attributes_of(attributes) if attributes else ({}, "")
    if (HIDDEN.search(bare) or HIDDEN.search(found.get("style", ""))
            or found.get("aria-hidden") == "true"):
        return "hidden"
    words = unlikely_words(found)
    if not TALK.isdisjoint(words):
        return "talk"
    if (tag in UNLIKELY_TAGS or tag == "header" and not in_article
            or found.get("role") in UNLIKELY_ROLES or words):
        return "named"
    return ""


def matched(tag: str, page: str) -> dict[int, int]:
    """Ends of the start tags of a kind -> ends of their end tags."""
    ends, waiting = {}, []
    for m in re.finditer(rf"<(/?){re.escape(tag)}(?=[\s>/])[^>]*>", page, re.IGNORECASE):
        if not m[1]:
            if not m[0].endswith("/>"):
                waiting.append(m.end())
        elif waiting:
            ends[waiting.pop()] = m.end()
    return ends


def parse(page: str) -> Node:
    """The tree of a page; text children are strings."""
    root = node = Node("#root", None)
    articles = 0
    ends_of: dict[str, dict[int, int]] = {}
    lost = None  # an unclosed element whose text is no text of the page
    at, end = 0, len(page)
    while at < end:
        m = MARKUP.search(page, at)
        if m is None:
            node.children.append(page[at:])
            break
        if m.start() > at:
            node.children.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            target = node
            while target is not root and target.tag != tag:
                if tag not in BLOCKS and target.tag in BLOCKS:
                    target = root  # an inline end tag does not close blocks
                    break
                target = target.parent
            if target is not root:
                while node is not target.parent:
                    articles -= node.tag == "article"
                    node = node.parent
            continue
        if tag in RAW:
            node.children.append(" ")
            if m[3].rstrip().endswith("/"):
                continue
            if tag in TO_END:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s>/])[^>]*>", re.IGNORECASE)
                found = close.search(page, at)
                at = found.end() if found else end
                continue
            if tag not in ends_of:
                ends_of[tag] = matched(tag, page)
            if at in ends_of[tag]:
                at = ends_of[tag][at]
            else:
                child = Node(tag, node, "hidden")
                node.children.append(child)
                node = child
                lost = lost or child
            continue
        if lost is not None and tag in BLOCKS:
            target = node
            while target is not root and target is not lost:
                target = target.parent
            if target is lost:
                node = lost.parent
            lost = None
        if tag in ENDS or tag in BLOCKS:
            closing, borders = ENDS.get(tag, (frozenset(), frozenset()))
            target, found = node, None
            while target is not root and target.tag not in (borders if closing else P_BORDERS):
                if target.tag == "p" and tag in BLOCKS or target.tag in closing:
                    found = target
                target = target.parent
                if closing and target.tag in borders:
                    break
            if found is not None:
                while node is not found.parent:
                    node = node.parent
        head = tag in ("article", "main") and not unlikely_words(attributes_of(m[3])[0])
        child = Node(tag, node, unlikely(tag, m[3], articles > 0), head)
        node.children.append(child)
        if tag not in VOID and not m[3].rstrip().endswith("/"):
            node = child
            articles += tag == "article"
    return root


def ordered(root: Node) -> list[Node]:
    """All nodes that take part, parents first."""
    nodes, at = [root], 0
    while at < len(nodes):
        nodes += [c for c in nodes[at].children if isinstance(c, Node) and not c.drop]
        at += 1
    return nodes


def settle(root: Node) -> None:
    """Let elements that were named as no part of the article take part after all, if they hold it.

    Such an element is a wrapper when it has an article or main inside and half of the text, not
    counting that of other named elements. Then the largest of the others are let in, one by one, as
    long as what stands outside them is nothing, or little beside them; comments only if the page has no
    article.
    """
    nodes, at = [root], 0
    while at < len(nodes):
        nodes += [c for c in nodes[at].children if isinstance(c, Node) and c.drop != "hidden"]
        at += 1
    tagged = any(n.tag in ("article", "main") for n in nodes)
    for node in reversed(nodes):
        kept = [c for c in node.children if isinstance(c, Node) and c.drop != "hidden"]
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        if node.tag != "a":
            node.prose = own + sum(c.prose for c in kept)
            node.open = own + sum(c.open for c in kept if not c.drop or c.head)
        # From here on: has an article with text at or below it.
        node.head = node.head and node.prose > 0 or any(c.head for c in kept)

    def reach(top: Node) -> tuple[int, bool, list[Node]]:
        """Characters that take part, whether an article does, and the dropped elements on the way."""
        size, article, closed, stack = 0, False, [], [top]
        while stack:
            node = stack.pop()
            if node.tag == "a":
                continue
            for child in node.children:
                if isinstance(child, str):
                    size += len(child.strip())
                elif not child.drop:
                    stack.append(child)
                elif child.drop != "hidden":
                    closed.append(child)
            article = article or node.tag in ("article", "main") and node.head
        return size, article, closed

    for node in nodes:
        if node.drop and node.head and node.open >= 0.5 * root.open:
            node.drop = ""
    rest, article, closed = reach(root)
    while closed:
        node = max(closed, key=lambda n: n.prose)
        inside, talk = node.prose, node.drop == "talk"
        if rest == 0 and not tagged:
            wanted = inside > 0
        elif inside < LITTLE or article and talk:
            wanted = False
        else:
            wanted = (not article and rest < LITTLE and 4 * rest < inside
                      or not talk and 10 * rest < inside)
        if not wanted:
            break
        node.drop = ""
        closed.remove(node)
        size, has_article, inner = reach(node)
        rest, article = rest + size, article or has_article
        closed += inner


def own_text(node: Node) -> str:
    """Text of a node with its inline descendants, without that of blocks inside it."""
    parts, stack = [], [iter(node.children)]
    while stack:
        for child in stack[-1]:
            if isinstance(child, str):
                parts.append(child)
            elif not child.drop and child.tag not in BLOCKS:
                stack.append(iter(child.children))
                break
        else:
            stack.pop()
    return "".join(parts)


def score(nodes: list[Node]) -> None:
    for node in reversed(nodes):
        text = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        kept = [c for c in node.children if isinstance(c, Node) and not c.drop]
        node.length = text + sum(c.length for c in kept)
        node.linked = node.length if node.tag == "a" else sum(c.linked for c in kept)
    for node in nodes:
        if node.tag not in SCORED and node.tag not in BLOCKS:
            continue
        text = own_text(node).strip()
        if node.tag not in SCORED and len(text) < 25 or not text:
            continue
        share = node.linked / node.length if node.length else 0.0
        points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - min(share, 1.0))
        # Text that stands in a container itself counts for that container in full.
        above, level = (node.parent if node.tag in SCORED else node), 0
        while above is not None:
            above.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            above, level = above.parent, level + 1


def density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def blocks(nodes: list[Node]) -> list[str]:
    """Text blocks below the given nodes in page order, white space squeezed."""
    out, parts = [], []

    def close():
        text = " ".join("".join(parts).split())
        if text:
            out.append(text)
        parts.clear()

    for top in nodes:
        close()
        stack = [(top, iter(top.children))]
        while stack:
            node, children = stack[-1]
            for child in children:
                if isinstance(child, str):
                    parts.append(html.unescape(child) if "&" in child else child)
                elif not child.drop:
                    if child.tag in BLOCKS:
                        close()
                    elif child.tag in SPACED:
                        parts.append(" ")
                    stack.append((child, iter(child.children)))
                    break
            else:
                stack.pop()
                if node.tag in BLOCKS or node is top:
                    close()
                elif node.tag in SPACED:
                    parts.append(" ")
    close()
    return out


def main_text(page: str) -> str:
    if not page:
        return ""
    root = parse(page)
    settle(root)
    nodes = ordered(root)
    score(nodes)
    best = max(nodes, key=lambda n: n.score * (1 - density(n)))
    if best.score <= 0:
        return "\n\n".join(blocks([root]))
    above = best
    while above is not None:  # an article is wanted whole, not its best section alone
        if above.tag in ("article", "main") and density(above) < 0.5:
            best = above
        above = above.parent
    for node in nodes:  # lists of links inside the article
        if node.tag in ("ul", "ol", "div", "section", "table") and node is not best:
            if density(node) > 0.5 and node.length < 0.5 * best.length:
                node.drop = "named"
    if best.parent is None:
        return "\n\n".join(blocks([best]))
    least = 0.2 * best.score * (1 - density(best))
    kept = []
    for sibling in best.parent.children:
        if sibling is best:
            kept.append(sibling)
        elif isinstance(sibling, Node) and not sibling.drop and best.tag not in ("body", "html"):
            good = (sibling.score * (1 - density(sibling)) >= least if sibling.tag not in SCORED
                    else sibling.length > 80 and density(sibling) < 0.25)
            if good:
                kept.append(sibling)
    return "\n\n".join(blocks(kept))


def extracted(page: Column) -> Column:
    @F.arrow_udf("string")
    def texts(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py() or "") for p in pages], pa.string())

    return texts(page)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url",
            page: str = "html") -> DataFrame:
    """Key, url, main text and its number of code points for every page."""
    return (pages.select(key, url, extracted(F.col(page)).alias("text"))
            .select(key, url, "text", F.char_length("text").cast("bigint").alias("n_chars")))
