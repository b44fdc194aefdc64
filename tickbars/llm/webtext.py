"""Main text of web pages by wrappers inferred for each host.

Every page gives an expression of its elements (``markup``, ``wrappers``) with figures of
the text in each.  Pages of a host with the same expression are added up in hash
aggregates, so a host with a third of all pages sends a few rows for each task.  What
differs is then aligned and folded into one union-free regular expression for each host:
in rounds, sixteen expressions at most on average meeting in a group, in an order given
by their hashes, so that neither the number of pages nor that of expressions lands in
one task and every run gives the same wrapper.  The wrapper tells which parts are the
same on every page, which hold links, and where the text is; pages then meet their
host's wrapper in a join, whose small side Spark broadcasts only if it finds it small.

A part is left out if its element or the words of its class, id or role say that it is a
menu, header, footer, sidebar, notice, advert, form or discussion, if it is hidden, if its
text never changes over most pages of a host whose pages differ, or if it is mostly
links outside the article.  Of what is left the article is kept: ``article`` elements,
else ``main``, else the part marked as content, else the box that holds most of the text.
A page without that part keeps all that is not left out.

Defined results: null and empty pages have empty text.  Unclosed and cut-off markup is
closed as browsers do; a script without an end reaches to the end of the page.  Elements
deeper than ``markup.DEPTH`` count as part of the one at that depth.  A null or odd url
belongs to the host without a name.  Pages that repeat, ids that are null, long pages and
an empty table need no care.  Other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.llm import markup, wrappers
from tickbars.session import stored

FAN_BITS = 4
HELD = 1 << 14
FIGURES = ("n", "chars", "links", "low", "high")
PARTS = "host string, skeleton string, node int, n long, chars long, links long, low long, high long"

# Elements that hold no article text, and words of WORDS that say so.
LEFT_OUT = set("nav footer aside dialog menu head".split())
WORDS_OUT = set("hidden menu head foot side notice ad form talk".split())
BOXES = set("div section td tr tbody table center form fieldset article main header".split())
MOST_PAGES = 0.5
LEAST_PAGES = 3
LINKED = 2 / 3
NARROW = 0.8


def host(url: Column) -> Column:
    """The host of an address, in lower case; empty where there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def _expressions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each host and expression of a task's pages: the figures of every part."""
    held: dict[tuple[str, str], list[list[int]]] = {}

    def rows() -> pa.RecordBatch:
        out = [(h, s, i, *f) for (h, s), found in held.items() for i, f in enumerate(found) if f]
        held.clear()
        names = PARTS.replace(",", "").split()[::2]
        types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    for batch in batches:
        for name, source in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = wrappers.expression(markup.read(source.as_py()))
            key, mine = (name, wrappers.bare(found)), [part[3] for part in wrappers.in_order(found)]
            old = held.get(key)
            held[key] = [wrappers.added(a, b) for a, b in zip(old, mine)] if old else mine
        if len(held) > HELD:
            yield rows()
    if held:
        yield rows()


def _dressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for skeleton, found in zip(batch.column("skeleton").to_pylist(), batch.column("figures").to_pylist()):
            figures = {f["node"]: [f[name] for name in FIGURES] for f in found}
            out.append(json.dumps(wrappers.dressed(skeleton, figures), separators=(",", ":")))
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("place"), pa.array(out)], ["host", "place", "wrapper"])


def _folded(table: pa.Table) -> pa.Table:
    table = table.sort_by([("place", "ascending"), ("wrapper", "ascending")])
    whole = wrappers.fold([json.loads(w) for w in table.column("wrapper").to_pylist()])
    first = table.slice(0, 1)
    text = pa.array([json.dumps(whole, separators=(",", ":"))])
    return pa.table({"host": first.column("host"), "place": first.column("to"), "wrapper": text})


def infer(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """A stored row for each host: its wrapper, as JSON."""
    named = pages.select(host(F.col(url)).alias("host"), F.col(html).cast("string").alias("html"))
    parts = named.where(F.length("html") > 0).mapInArrow(_expressions, PARTS)
    added = parts.groupBy("host", "skeleton", "node").agg(
        *[F.sum(name).alias(name) for name in FIGURES[:3]], F.min("low").alias("low"), F.max("high").alias("high")
    )
    each = added.groupBy("host", "skeleton").agg(F.collect_list(F.struct("node", *FIGURES)).alias("figures"))
    forms = stored(each, "page-forms")
    most = forms.groupBy("host").count().agg(F.max("count")).first()[0] or 1
    rounds = max(1, -(-(most - 1).bit_length() // FAN_BITS))
    place = F.shiftright(F.xxhash64("skeleton"), 1).bitwiseAND(F.lit((1 << (rounds * FAN_BITS)) - 1))
    folded = forms.withColumn("place", place).mapInArrow(_dressed, "host string, place long, wrapper string")
    for _ in range(rounds):
        to = F.shiftright("place", FAN_BITS)
        folded = folded.withColumn("to", to).groupBy("host", "to").applyInArrow(
            _folded, "host string, place long, wrapper string"
        )
    return stored(folded.select("host", "wrapper"), "wrappers")


class Rules:
    """What of a host's pages is kept."""

    def __init__(self, wrapper: str):
        self.keys, self.shapes, self.children, self.figures = wrappers.flat(json.loads(wrapper))
        size = len(self.keys)
        self.parent = [-1] * size
        for node, inside in enumerate(self.children):
            for child in inside:
                self.parent[child] = node
        self.tags = [k.split(".")[0] for k in self.keys]
        self.holds = [{t} for t in self.tags]
        for node in range(size - 1, 0, -1):
            self.holds[self.parent[node]] |= self.holds[node]
        self.in_article = [False] * size
        self.out = [False] * size
        for node in range(size):
            above = self.parent[node]
            self.in_article[node] = self.tags[node] in ("article", "main") or (above >= 0 and self.in_article[above])
            self.out[node] = (above >= 0 and self.out[above]) or self.left_out(
                self.keys[node], self.holds[node], above >= 0 and self.in_article[above]
            )
        pages, varied = self.figures[0][0], self.figures[0][3] != self.figures[0][4]
        self.fixed = [
            varied and f[0] >= max(LEAST_PAGES, MOST_PAGES * pages) and f[3] == f[4] for f in self.figures
        ]
        self._weigh()
        for node in range(1, size):
            if not self.in_article[node] and self.tags[node] not in ("a", "body") and self.links[node] > LINKED * self.chars[node]:
                self.out[node] = True
            self.out[node] |= self.out[self.parent[node]]
        self._weigh()
        self.region = self._region()
        self.kept = [False] * size
        for node in range(size):
            inside = node in self.region or (self.parent[node] >= 0 and self.kept[self.parent[node]])
            self.kept[node] = inside and not self.out[node]

    @staticmethod
    def left_out(key: str, holds: set[str], in_article: bool) -> bool:
        """Whether an element says of itself that it isn't part of the article; *holds* are the elements within."""
        tag, _, kind = key.partition(".")
        if tag in LEFT_OUT:
            return True
        if tag == "form":
            return not holds & {"article", "main", "h1"}
        if tag == "header":
            return not (in_article and "h1" in holds)
        if kind not in WORDS_OUT or tag in ("main", "body"):
            return False
        if kind in ("hidden", "talk", "ad"):
            return True
        heading = kind == "head" and tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        return not heading and not holds & {"article", "main"}

    def _weigh(self) -> None:
        """Characters in each element, and how many of them in links, less what is out or the same on all pages."""
        size = len(self.keys)
        counts = [not self.out[n] and not self.fixed[n] for n in range(size)]
        self.chars = [f[1] if c else 0 for f, c in zip(self.figures, counts)]
        self.links = [f[2] if c else 0 for f, c in zip(self.figures, counts)]
        for node in range(size - 1, 0, -1):
            self.chars[self.parent[node]] += self.chars[node]
            self.links[self.parent[node]] += self.links[node]

    def _tops(self, wanted) -> list[int]:
        """Elements that are *wanted* and stand in no other such element."""
        found: list[int] = []
        within = [False] * len(self.keys)
        for node in range(len(self.keys)):
            above = self.parent[node]
            within[node] = above >= 0 and (within[above] or above in found)
            if not within[node] and not self.out[node] and wanted(node):
                found.append(node)
        return found

    def _region(self) -> set[int]:
        articles = self._tops(lambda n: self.tags[n] == "article")
        mains = self._tops(lambda n: self.tags[n] == "main")
        most = max((self.chars[n] for n in articles), default=0)
        if articles and 2 * sum(self.chars[n] for n in articles) >= sum(self.chars[n] for n in mains):
            return {n for n in articles if 5 * self.chars[n] >= most}
        if mains:
            return set(mains)
        marked = self._tops(lambda n: self.keys[n].endswith(".main"))
        best = max(marked, key=lambda n: self.chars[n], default=0)
        node = best if 2 * self.chars[best] >= self.chars[0] else 0
        while True:
            inner = [c for c in self.children[node] if self.tags[c] in BOXES and not self.out[c]]
            top = max(inner, key=lambda n: self.chars[n], default=None)
            if top is None or self.chars[top] < NARROW * self.chars[node] or not self.chars[top]:
                return {node}
            node = top

    def text(self, page: markup.Page) -> str:
        """The text of the parts that are kept, white space as single spaces."""
        place = wrappers.places(page, self.keys, self.shapes, self.children)
        anywhere = not any(p in self.region for p in place)
        kept, fixed = [False] * len(place), [False] * len(place)
        inner = None
        for node, p in enumerate(place):
            above = page.parents[node]
            if p >= 0:
                kept[node] = not self.out[p] if anywhere else self.kept[p]
                fixed[node] = self.fixed[p]
            else:
                if inner is None:
                    inner = [{k.split(".")[0]} for k in page.keys]
                    for n in range(len(place) - 1, 0, -1):
                        inner[page.parents[n]] |= inner[n]
                kept[node] = kept[above] and not self.left_out(page.keys[node], inner[node], True)
            if above >= 0 and anywhere:
                kept[node] = kept[node] and kept[above]
        pieces = [" " if s is None else s[1] for s in page.stream if s is None or (kept[s[0]] and not fixed[s[0]])]
        return " ".join("".join(pieces).split())


def extract(pages: DataFrame, found: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars; *found* are the wrappers of the hosts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules: dict[str, Rules] = {}
        for batch in batches:
            texts = []
            for wrapper, source in zip(batch.column(3), batch.column(2)):
                wrapper, source = wrapper.as_py(), source.as_py()
                if not source:
                    texts.append("")
                    continue
                if wrapper not in rules:
                    if len(rules) > HELD:
                        rules.clear()
                    rules[wrapper] = Rules(wrapper)
                texts.append(rules[wrapper].text(markup.read(source)))
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.col(html).cast("string").alias("html"), host(F.col(url)).alias("_host"),
    )
    both = rows.join(found.withColumnRenamed("host", "_host"), "_host", "left")
    return both.select("page_id", "url", "html", "wrapper").mapInArrow(
        task, "page_id long, url string, text string, n_chars long"
    )


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Infer the wrappers of all hosts of *pages* and extract the main text of each page."""
    return extract(pages, infer(pages, html, url), page_id, url, html)
