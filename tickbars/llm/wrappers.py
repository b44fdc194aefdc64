"""Wrappers: union-free regular expressions that the pages of a host have in common.

An expression is ``[key, marks, parts, figures]``: an element, whether it is optional or
repeated, what stands inside, in order, and figures of its own text over all pages: how
many pages have it, its characters, those in links, the smallest and largest digest of the
text.  The part ``#`` is a text slot.  A run of flow content
(paragraphs, headings, lists) is one repeated group ``~`` of parts that are each
optional.  Neighbours of one key and like shape become one repeated part.  Two
expressions are aligned part by part; a part with no counterpart becomes optional.
"""

from __future__ import annotations

import json
from functools import reduce
from hashlib import blake2b

from tickbars.llm.markup import FLOW, Page

OPTIONAL, REPEATED = 1, 2
MOST_PARTS = 64
ALIKE = 0.5

Expression = list


def figures(text: str, links: int) -> list[int]:
    """Figures of an element that occurs once with *text*, *links* characters of it in links."""
    digest = int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=7).digest(), "little")
    return [1, len(text), links, digest, digest]


def added(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return a or b
    return [a[0] + b[0], a[1] + b[1], a[2] + b[2], min(a[3], b[3]), max(a[4], b[4])]


def is_flow(key: str) -> bool:
    return key.split(".")[0] in FLOW


def shape(e: Expression) -> set[str]:
    """Keys of the parts of *e*, those of a group in the group's place."""
    return {k for part in e[2] for k in ([p[0] for p in part[2]] if part[0] == "~" else [part[0]])}


def likeness(a: set[str], b: set[str]) -> float:
    return len(a & b) / len(a | b) if a or b else 1.0


def _by_key(parts: list[Expression], always: bool) -> list[Expression]:
    """Parts of one group, one for each key; *always* is false where not every repetition has them all."""
    found: dict[str, Expression] = {}
    for part in parts:
        old = found.get(part[0])
        found[part[0]] = merge(old, part) if old else part
    return [[k, e[1] | (0 if always else OPTIONAL), *e[2:]] for k, e in sorted(found.items())]


def _settled(parts: list[Expression]) -> list[Expression]:
    """Repeated neighbours as one part; a list that grows without an order becomes a group."""
    out: list[Expression] = []
    for part in parts:
        last = out[-1] if out else None
        if last and last[0] == part[0] and (part[0] in "#~" or likeness(shape(last), shape(part)) >= ALIKE):
            both = merge(last, part)
            out[-1] = [both[0], (last[1] & part[1] & OPTIONAL) | REPEATED, *both[2:]]
        else:
            out.append(part)
    if len(out) > MOST_PARTS:
        flat = [p for part in out for p in (part[2] if part[0] == "~" else [part])]
        return [["~", REPEATED, _by_key(flat, False), []]]
    return out


def contained(a: set[str], b: set[str]) -> float:
    """1 where *b* has room for all of *a*, else less than 0."""
    return 1.0 if a <= b else len(a & b) / len(a) - 2


def align(left: list[set[str]], right: list[set[str]], keys: list[str], others: list[str], how=likeness) -> list[tuple[int, int]]:
    """Pairs of places, in order on both sides, of parts that have a key in common and are most alike."""
    n, m = len(keys), len(others)
    score = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below = score[i], score[i + 1]
        for j in range(m - 1, -1, -1):
            best = max(below[j], row[j + 1])
            if keys[i] == others[j] and (not left[i] or not right[j] or left[i] & right[j]):
                best = max(best, below[j + 1] + 1 + how(left[i], right[j]))
            row[j] = best
    pairs, i, j = [], 0, 0
    while i < n and j < m:
        if score[i][j] == score[i + 1][j]:
            i += 1
        elif score[i][j] == score[i][j + 1]:
            j += 1
        else:
            pairs.append((i, j))
            i, j = i + 1, j + 1
    return pairs


def matches(a: list[Expression], b: list[Expression]) -> list[tuple[int, int]]:
    keys, others = [e[0] for e in a], [e[0] for e in b]
    if keys == others and len(set(keys)) == len(keys):
        return [(i, i) for i in range(len(keys))]
    return align([shape(e) for e in a], [shape(e) for e in b], keys, others)


def merge(a: Expression, b: Expression) -> Expression:
    """The expression for what either *a* or *b* matches; both have one key."""
    marks = a[1] | b[1]
    if a[0] == "#":
        return ["#", marks, [], []]
    if a[0] == "~":
        ours, theirs = {p[0] for p in a[2]}, {p[0] for p in b[2]}
        parts = [
            [e[0], e[1] | (0 if e[0] in ours and e[0] in theirs else OPTIONAL), *e[2:]] for e in _by_key(a[2] + b[2], True)
        ]
        return ["~", marks, parts, []]
    parts, i, j = [], 0, 0
    for x, y in [*matches(a[2], b[2]), (len(a[2]), len(b[2]))]:
        parts += [[e[0], e[1] | OPTIONAL, *e[2:]] for e in a[2][i:x] + b[2][j:y]]
        if x < len(a[2]):
            parts.append(merge(a[2][x], b[2][y]))
        i, j = x + 1, y + 1
    return [a[0], marks, _settled(parts), added(a[3], b[3])]


def fold(expressions: list[Expression]) -> Expression:
    return reduce(merge, expressions)


def expression(page: Page) -> Expression:
    """The expression of one page."""
    parts: list[list[Expression]] = [[] for _ in page.keys]
    order: list[list[int]] = [[] for _ in page.keys]  # children in order, -1 for text
    seen = 1
    texts: list[list[str]] = [[] for _ in page.keys]
    links = [0] * len(page.keys)
    for piece in page.stream:
        if piece is None or not piece[1].strip():
            continue
        node = piece[0]
        texts[node].append(piece[1])
        links[node] += len(piece[1]) if piece[2] else 0
        while seen <= node:
            order[page.parents[seen]].append(seen)
            seen += 1
        if not order[node] or order[node][-1] != -1:
            order[node].append(-1)
    for child in range(seen, len(page.keys)):
        order[page.parents[child]].append(child)
    for node in range(len(page.keys) - 1, -1, -1):
        found: list[Expression] = []
        for child in order[node]:
            if child < 0:
                found.append(["#", 0, [], []])
                continue
            part = [page.keys[child], 0, parts[child], figures("".join(texts[child]), links[child])]
            found.append(["~", REPEATED, [part], []] if is_flow(part[0]) else part)
        parts[node] = _settled(found)
    own, whole = "".join(texts[0]), "".join(t for found in texts for t in found)
    # the digest of a page's body is that of all its text: it tells whether pages differ
    out = ["body", 0, parts[0], [1, len(own), links[0], *figures(whole, 0)[3:]]]
    for part in in_order(out):
        part[3][:1] = [1] if part[3] else []
    return out


def places(page: Page, keys: list[str], shapes: list[set[str]], children: list[list[int]]) -> list[int]:
    """For each node of *page* its number in a flat expression (see :func:`flat`), -1 where it has none."""
    out = [-1] * len(page.keys)
    out[0] = 0
    kids: list[list[int]] = [[] for _ in page.keys]
    for node in range(1, len(page.keys)):
        kids[page.parents[node]].append(node)
    for node in range(len(page.keys)):
        at = out[node]
        if at < 0 or not kids[node]:
            continue
        options = children[at]
        named = [keys[o] for o in options]
        mine = [page.keys[k] for k in kids[node]]
        if len(set(named)) == len(named):
            only = dict(zip(named, options))
            for k in kids[node]:
                out[k] = only.get(page.keys[k], -1)
            continue
        ours = [{page.keys[g] for g in kids[k]} for k in kids[node]]
        theirs = [shapes[o] for o in options]
        for i, j in align(ours, theirs, mine, named, contained):
            out[kids[node][i]] = options[j]
        # a repeated part takes the neighbours of a node that found its place too
        for i, k in enumerate(kids[node]):
            if out[k] < 0:
                near = [o for o, name in zip(options, named) if name == page.keys[k]]
                out[k] = max(near, key=lambda o: contained(ours[i], shapes[o]), default=-1)
    return out


def flat(e: Expression) -> tuple[list[str], list[set[str]], list[list[int]], list[list[int]]]:
    """Elements of an expression in order: keys, shapes, the numbers of the elements inside each, figures."""
    keys, shapes, children, found = [], [], [], []

    def visit(part: Expression) -> int:
        here = len(keys)
        keys.append(part[0])
        shapes.append(shape(part) - {"#"})
        children.append([])
        found.append(part[3] or [0, 0, 0, 0, 0])
        for inner in part[2]:
            for each in inner[2] if inner[0] == "~" else [inner]:
                if each[0] != "#":
                    children[here].append(visit(each))
        return here

    visit(e)
    return keys, shapes, children, found


def bare(e: Expression) -> str:
    """The expression without its figures, as text."""
    def visit(part: Expression) -> list:
        return [part[0], part[1], [visit(p) for p in part[2]]]

    return json.dumps(visit(e), separators=(",", ":"))


def in_order(e: Expression) -> list[Expression]:
    """*e* and all parts within, in order."""
    return [e] + [within for part in e[2] for within in in_order(part)]


def dressed(text: str, found: dict[int, list[int]]) -> Expression:
    """An expression from its text and the figures of its parts, by their place in order."""
    def visit(part: list) -> Expression:
        here = next(number)
        return [part[0], part[1], [visit(p) for p in part[2]], found.get(here, [])]

    number = iter(range(1 << 62))
    return visit(json.loads(text))


def readable(e: Expression) -> str:
    """The expression as text, e.g. ``<div>#(<p>#</p>)+</div>``."""
    inside = "".join(readable(p) for p in e[2])
    body = "#" if e[0] == "#" else f"({inside})" if e[0] == "~" else f"<{e[0]}>{inside}</{e[0]}>"
    mark = {0: "", OPTIONAL: "?", REPEATED: "+", OPTIONAL | REPEATED: "*"}[e[1]]
    return f"({body}){mark}" if mark and e[0] not in "#~" else body + mark
