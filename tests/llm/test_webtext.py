import html as H
import json
import random
import re

import pytest
from docs import prose
from pyspark.sql import functions as F

from tickbars.llm import markup, webtext, wrappers

SCHEMA = "page_id long, url string, html string"


def esc(text):
    return H.escape(text, quote=False)


def flat(*blocks):
    return " ".join(" ".join(b.split()) for b in blocks)


def semantic(i, blocks):
    body = "".join(f"<p>{esc(b)}" + ("</p>" if k % 2 else "") for k, b in enumerate(blocks[1:]))
    notice = "<div class='cookie-notice'>We use cookies</div>" if i % 2 else ""
    return (
        f"<!DOCTYPE html><html><head><title>{esc(blocks[0])}</title><style>p{{}}</style><script>var a='</p><article>';</script></head>"
        f"<body>{notice}<header><h1>The Daily {i % 3}</h1></header><nav><ul><li><a href='/a'>Home</a></li></ul></nav><!-- <article>no</article> -->"
        f"<main><article><header><h1>{esc(blocks[0])}</h1></header>{body}<div class=\"adBox\">buy {i} now</div>"
        f"<form><p>Your mail {i}</p><input name=q></form></article><section id=comments><article class=comment><p>first! {prose(i, 30)}</p></article></section>"
        f"</main><aside><p>{prose(i + 5, 20)}</p></aside><footer>&copy; {i}</footer></body>"
    )


def plain(i, blocks):
    """No word or element tells the parts: only what the pages of the host have in common."""
    rows = "".join(f"<p>{esc(b)}</p>" for b in blocks[1:])
    links = "".join(f"<li><a href='/{k}'>{prose(i * 7 + k, 2)}</a></li>" for k in range(5))
    extra = f"<div><ul>{links}</ul></div>"
    return (
        f"<html><body><div><b>My site</b></div>{extra}<div><div><h2>{esc(blocks[0])}</h2>{rows}</div>"
        f"<div>All rights are ours and nobody else may copy this text in any way</div></div></body></html>"
    )


def pages():
    rows, want, number = [], {}, 0
    for kind, name, count in ((semantic, "news.example.org", 40), (plain, "www.example.com:80", 30), (semantic, "one.example.net", 1)):
        for i in range(count):
            rnd = random.Random(number)
            blocks = [prose(1000 + number, 6)] + [prose(number * 31 + k, rnd.randint(5, 60)) + " a < b & c" for k in range(rnd.randint(1, 8))]
            rows.append((number, f"HTTPS://u@{name}/p/{number}?x=1", kind(i, blocks)))
            want[number] = flat(*blocks)
            number += 1
    return rows, want


def test_main_text_of_several_layouts(spark):
    rows, want = pages()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit("old") for c in ("host", "_host", "wrapper", "text", "place", "to")})
    got = webtext.main_text(df).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got) and len(got) == len(rows)


def test_given_pages(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in webtext.main_text(table).collect()}
    for r in table.collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S).group(1)
        blocks = [H.unescape(re.sub("<[^>]*>", "", b)) for b in re.split(r"</?(?:p|h1|br)>", inner)]
        assert got[r.page_id] == flat(" ".join(blocks))


def test_awkward_pages(spark):
    article = "<article><p>one&nbsp;two</p><br>three<b>four</b>"
    rows = [
        (1, None, article), (None, "http://a/", article), (2, "http://a/", None), (3, "http://a/", ""), (3, "http://a/", ""),
        (4, "nonsense", "<p>cut &am"), (5, "http://a/", "<p>text<script>x"), (6, "http://a/", "a < b and <i"), (7, "http://a/", "plain &lt;p&gt;"),
        (8, "http://b/", "<div>" * 3000 + "deep" + "</div>" * 10), (9, "http://b/", "<p>x</p>" * 50_000), (10, "http://c/", "<p class='a\" b>q</p>"),
    ]
    got = sorted((r.page_id or 0, r.text) for r in webtext.main_text(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [
        (0, "one two threefour"), (1, "one two threefour"), (2, ""), (3, ""), (3, ""), (4, "cut &am"), (5, "text"), (6, "a < b and"),
        (7, "plain <p>"), (8, "deep"), (9, " ".join("x" * 50_000)), (10, "q"),
    ]
    assert webtext.main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_copies_of_one_article_stay(spark):
    rows, want = pages()
    copies = [(500 + i, "http://copies.example/", rows[3][2]) for i in range(200)]
    got = webtext.main_text(spark.createDataFrame(copies, SCHEMA)).select("text").distinct().collect()
    assert [r.text for r in got] == [want[3]]


def test_wrapper_of_a_host(spark):
    sources = [
        "<div><h1>a</h1><p>b</p><p>c</p></div>",
        "<div><h1>a</h1><p>b</p></div><div class=ad>x</div>",
        "<div><h1>z</h1></div><div class=ad>y</div>",
    ]
    found = webtext.infer(spark.createDataFrame([(i, "http://h/", s) for i, s in enumerate(sources)], SCHEMA)).collect()
    assert [r.host for r in found] == ["h"]
    assert wrappers.readable(json.loads(found[0].wrapper)) == "<body><div>((<h1>#</h1>)?(<p>#</p>)?)+</div>(<div.ad>#</div.ad>)?</body>"


@pytest.mark.parametrize("seed", range(6))
def test_merging_keeps_every_page_in_its_place(seed):
    """A folded expression has a place for every element of each of its pages."""
    rnd = random.Random(seed)

    def random_page():
        parts = []
        for _ in range(rnd.randint(1, 12)):
            tag = rnd.choice(["div", "p", "h2", "ul", "section"])
            inner = "".join(f"<{t}>x</{t}>" for t in rnd.choices(["p", "a", "span", "div"], k=rnd.randint(0, 3)))
            parts.append(f"<{tag}>{inner}t</{tag}>")
        return markup.read("".join(parts))

    made = [random_page() for _ in range(20)]
    whole = wrappers.fold([wrappers.expression(p) for p in made])
    keys, shapes, children, figures = wrappers.flat(whole)
    assert figures[0][0] == 20
    assert sum(f[1] for f in figures) == sum(len(s[1]) for p in made for s in p.stream if s)
    for page in made:
        found = wrappers.places(page, keys, shapes, children)
        assert all(keys[p] == page.keys[n] for n, p in enumerate(found) if p >= 0) and -1 not in found
