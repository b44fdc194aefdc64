"""A page as nodes and the stream of its text."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element names of HTML by their role in the page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("script style noscript template iframe object svg canvas audio video math select textarea button title".split())
RAW = set("script style textarea title iframe noscript".split())
IN_HEAD = set("title meta link script style base noscript template".split())
INLINE = set(
    "b i u s em strong small big sub sup code mark abbr cite q del ins time font tt kbd samp var dfn bdi bdo acronym "
    "strike data label nobr wbr img".split()
)
FLOW = set("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre figure figcaption table address hr".split())
ENDS_P = FLOW | set("div section article main nav header footer aside form details fieldset center dir menu".split())
BOXES = ENDS_P | set("li dt dd tr td th thead tbody tfoot caption summary body a span dialog head".split())
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "tr", "td", "th"}, {"table"}),
}
# Words in class, id and role that tell what a part of a page is.
WORDS = {
    "menu": "nav navbar navigation menu menubar breadcrumb pagination pager toolbar tab toc",
    "head": "header masthead banner topbar",
    "foot": "footer contentinfo copyright legal colophon",
    "side": "sidebar aside widget complementary related recommended trending rail",
    "notice": "cookie consent gdpr notice alert popup modal overlay dialog newsletter subscribe subscription paywall disclaimer",
    "ad": "ad advert advertisement advertising adsense sponsor sponsored promo promotion promoted banner",
    "form": "search login signup register share sharing social form",
    "talk": "comment disqus reply respond discussion",
    "main": "article content main post story entry body text",
}
HINTS = {word: kind for kind, words in reversed(WORDS.items()) for word in words.split()}

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*+(?:>|\Z)|<\?[^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/>])", re.I)
SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
DEPTH = 64


@dataclass
class Page:
    """Nodes in document order; ``stream`` holds (node, text, in a link) and None where a block begins or ends."""

    keys: list[str] = field(default_factory=lambda: ["body"])
    parents: list[int] = field(default_factory=lambda: [-1])
    stream: list[tuple[int, str, bool] | None] = field(default_factory=list)


def hint(more: str) -> str:
    """What the attributes say about the part they belong to, or nothing."""
    found = set()
    for name, *values in ATTRIBUTE.findall(more):
        value, name = "".join(values), name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "hidden"
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return "hidden"
            continue
        for word in SPLIT.split(value):
            word = word.lower()
            kind = HINTS.get(word) or HINTS.get(word.removesuffix("s"))
            if kind:
                found.add(kind)
    return next((kind for kind in WORDS if kind in found and kind != "main"), "main" if found else "")


def read(source: str) -> Page:
    """Cut *source* into nodes; unclosed, crossed and cut-off elements are closed as a browser would."""
    page = Page()
    keys, parents, stream = page.keys, page.parents, page.stream
    open_: list[tuple[str, int]] = [("body", 0)]
    links = 0
    at, size = 0, len(source)
    lowered: str | None = None

    def close(to: int) -> None:
        nonlocal links
        links -= sum(name == "a" for name, _ in open_[to:])
        del open_[to:]

    while at < size:
        tag = TAG.search(source, at)
        until = tag.start() if tag else size
        if until > at and open_[-1][0] != "head":
            stream.append((open_[-1][1], html.unescape(source[at:until]), links > 0))
        if not tag:
            break
        at = tag.end()
        if tag["name"] is None:
            continue
        name, more = tag["name"].lower(), tag["more"]
        if tag["end"]:
            if name in INLINE:
                continue
            place = next((i for i in range(len(open_) - 1, 0, -1) if open_[i][0] == name), 0)
            if place:
                close(place)
            if name not in ("a", "span"):
                stream.append(None)
            continue
        if name in UNSEEN:
            if not more.rstrip(">").endswith("/"):
                if lowered is None:
                    lowered = source.lower() if len(source.lower()) == size else "".join(c.lower() if c.isascii() else c for c in source)
                end = lowered.find(f"</{name}", at)
                if end >= 0 or name in RAW:
                    at = size if end < 0 else end
            if name not in IN_HEAD:
                stream.append(None)
            continue
        if name in ("html", "body"):
            if open_[-1][0] == "head":
                close(len(open_) - 1)
            continue
        if open_[-1][0] == "head" and name not in IN_HEAD:
            close(len(open_) - 1)
        if name in VOID:
            if name not in ("img", "wbr", "input", "meta", "link"):
                stream.append(None)
            continue
        if name in INLINE:
            continue
        kind = hint(more) if more.strip(" />") else ""
        if name == "span" and kind in ("", "main"):
            continue
        if name in ENDS_P:
            place = next((i for i in range(len(open_) - 1, 0, -1) if open_[i][0] not in ("a", "span")), 0)
            if open_[place][0] == "p":
                close(place)
        if name in CLOSES:
            same, within = CLOSES[name]
            for i in range(len(open_) - 1, 0, -1):
                if open_[i][0] in within:
                    break
                if open_[i][0] in same:
                    close(i)
        if name not in ("a", "span"):
            stream.append(None)
        node = open_[-1][1]
        if len(open_) <= DEPTH:
            key = name if name in BOXES else "div"
            keys.append(f"{key}.{kind}" if kind else key)
            parents.append(node)
            node = len(keys) - 1
        links += name == "a"
        open_.append((name, node))
    return page
