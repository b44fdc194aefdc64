import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from docs import ASCII_LOWER, awkward, frame, prose
from pyspark.sql import functions as F

from tickbars.llm import intervals, search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def brute(rows, items, k=20):
    docs = [(i, Counter(terms(t))) for i, t, *_ in rows]
    docs = [(i, c, c.total()) for i, c in docs if c]
    n_docs, total = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        asked = Counter(terms(text))
        scores = []
        for doc_id, c, n in docs:
            m = 100 - 25 + (25 * n * n_docs) // total
            score = sum(
                q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                for t, q in asked.items() if c[t]
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (s, null, doc_id) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, None if null else doc_id, -s))
    return Counter(out)


def items_for(rows):
    return [(1, rows[0][1]), (2, "the cat, the CAT; éà"), (3, None), (4, "..."), (5, prose(100, 12)), (6, "nowhere else"),
            (7, rows[-1][1]), (7, rows[-2][1]), (None, prose(4, 20)), (8, "an an an be ca")]


@pytest.mark.parametrize("documents", [3, 8192])
def test_equals_brute_force(spark, monkeypatch, documents):
    monkeypatch.setattr(search, "BLOCK_DOCUMENTS", documents)
    rows = awkward() + [(1000 + i, prose(7, 30), "en", "a", 1) for i in range(60)]
    rows += [(2000 + i, prose(i, 5 + i % 40), "en", "a", 1) for i in range(300)]
    items = items_for(rows)
    docs = frame(spark, rows, clashes=True).withColumns({c: F.lit("old") for c in ("question", "rank", "seen", "ids")})
    queries = spark.createDataFrame(items, ITEMS).withColumn("doc_id", F.lit("old"))
    got = search.search(docs, queries).collect()
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == brute(rows, items)


def test_questions_in_several_parts(spark, monkeypatch):
    monkeypatch.setattr(search, "PART_TERMS", 30)
    rows = [(i, prose(i, 30), "en", "a", 1) for i in range(80)]
    items = items_for(rows)
    got = search.search(frame(spark, rows), spark.createDataFrame(items, ITEMS), k=5).collect()
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == brute(rows, items, 5)


def test_empty(spark):
    rows = [(1, "some words", "en", "a", 1)]
    full, none = frame(spark, rows), spark.createDataFrame([], ITEMS)
    asked = spark.createDataFrame([(1, "words")], ITEMS)
    assert search.search(full, none).count() == 0 and search.search(frame(spark, []), asked).count() == 0
    assert search.search(frame(spark, [(1, None, "en", "a", 1)]), asked).count() == 0


def test_range_maxima():
    rnd = random.Random(5)
    values = np.array([rnd.randint(0, 9) for _ in range(77)])
    table = intervals.range_maxima(values, 77)
    for _ in range(300):
        a = rnd.randrange(77)
        b = rnd.randrange(a + 1, 78)
        at = intervals.largest(table, values, np.array([a]), np.array([b]))[0]
        assert at == a + int(np.argmax(values[a:b]))


def test_search_leaves_most_documents_unscored():
    rng = np.random.default_rng(2)
    n, terms_ = 4000, 40
    keys = np.unique(rng.integers(0, terms_, 60_000) * (1 << 32) + rng.integers(0, n, 60_000))
    impact = rng.integers(1, 1000, len(keys)) ** 2
    block = intervals.Block(np.arange(n), keys & 0xFFFFFFFF, keys >> 32, impact)
    questions = intervals.Questions(np.array([0, 1, 2, 5]), np.array([9, 5, 1, 7]), np.array([0, 3, 4]))
    best = intervals.Best(2, 10)
    assert block.search(questions, best) < n
    scores = defaultdict(int)
    for key, value in zip(keys, impact):
        for q, t, w in ((0, 0, 9), (0, 1, 5), (0, 2, 1), (1, 5, 7)):
            if key >> 32 == t:
                scores[q, int(key & 0xFFFFFFFF)] += w * int(value)
    for q in range(2):
        want = sorted(((-s, d) for (p, d), s in scores.items() if p == q))[:10]
        mine = best.question == q
        assert [(-s, d) for s, d in zip(best.score[mine].tolist(), best.id[mine].tolist())] == want
