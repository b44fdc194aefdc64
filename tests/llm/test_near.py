import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from docs import awkward, edited, frame, prose, shingles

from tickbars.llm import graph, near, words
from tickbars.session import SCRATCH, shared_dir

NONE = 1 << 62


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), NONE), NONE if r[0] is None else r[0])
    of = lambda i: None if least[find(i)] == NONE else least[find(i)]
    return Counter((r[0], len(sets[i]), of(i)) for i, r in enumerate(rows)), len(least)


def test_components(spark):
    base = prose(9, 300)
    # a chain: neighbours are linked, its ends are not
    chain, text = [], base
    for i in range(6):
        chain.append((300 + i, text, "en", "a", 1))
        text = edited(text, i, 0.02)
    copies = [(400 + i, edited(base, 50 + i, 0.01), "en", "a", 1) for i in range(40)]
    rows = awkward() + chain + copies + [(500 + i, prose(9, 300 - 20 * i), "en", "a", 1) for i in range(10)]
    got = near.dedup(frame(spark, rows, clashes=True)).collect()
    want, n_groups = brute(rows)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert sum(r.kept for r in got) == n_groups


def test_keep(spark):
    rows = awkward()
    docs = frame(spark, rows, clashes=True)
    kept = near.keep(docs)
    assert kept.columns == docs.columns and kept.count() == brute(rows)[1]
    assert near.dedup(frame(spark, [])).count() == 0 and near.keep(frame(spark, [])).count() == 0


def test_sketch_of_a_union_is_the_merge_and_registers_agree_like_the_sets():
    rnd = np.random.default_rng(1)
    agree, wrong = [], 0
    for _ in range(60):
        every = np.unique(rnd.integers(0, 1 << 63, 1750, dtype=np.uint64))
        one, other = every[:1500], every[250:]  # 1250 in common of 1750
        a, b = near.registers(one), near.registers(other)
        assert (near.merge(a, b) == near.registers(every)).all()
        agree.append((a == b).mean())
        sizes = np.array([len(one)], float), np.array([len(other)], float)
        wrong += not near.may_be_linked(a[None], b[None], *sizes)[0]
        far = near.registers(every[1400:])
        assert not near.may_be_linked(a[None], far[None], sizes[0], np.array([350.0]))[0]
    assert np.mean(agree) == pytest.approx(1250 / 1750, abs=0.02) and wrong == 0


def test_shingle_sets_match_words():
    texts = [r[1] or "" for r in awkward()]
    data = [t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    sets = near.shingle_sets(np.frombuffer(b"".join(data), np.uint8), offsets)
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert len(np.intersect1d(sets[0], sets[4])) == len(shingles(texts[0]) & shingles(texts[4]))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_graphs(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(1000, 1001 + i) for i in range(50)] + [(7, 7)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        parent[b] = a
    got = dict(graph.components(spark.createDataFrame(edges, "u long, v long")).collect())
    alone = {x for x in parent if find(x) == x and not any(y != x and find(y) == x for y in parent)}
    assert got == {x: find(x) for x in parent if x not in alone}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_keys_of_ranges_differ_only_with_their_bytes():
    rnd = random.Random(3)
    parts = [bytes(rnd.choice(b"ab\x00") for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    keys = words.range_keys(data, starts, ends - starts).tolist()
    assert len(set(keys)) == len(set(parts)) == len(set(zip(keys, parts)))
    many = np.sort(np.array(rnd.sample(range(1 << 60), 500), np.uint64))
    assert (words.unpack_sorted(words.pack_sorted(many)) == many).all() and len(words.unpack_sorted(words.pack_sorted(many[:0]))) == 0


def test_pairs_that_share_a_band_or_two_are_tested(spark, monkeypatch):
    monkeypatch.setattr(near, "BANDS", 2)
    base = prose(900, 400)
    rows = []
    for i in range(14):
        one = edited(base, 1000 + i, 0.028)  # too far from its likes to be linked, near enough to meet them
        rows += [(2 * i, one, "en", "a", 1), (2 * i + 1, edited(one, 2000 + i, 0.004), "en", "a", 1)]
    got = {r.doc_id: r.component_id for r in near.dedup(frame(spark, rows)).collect()}
    # all but the one pair that shares neither band
    assert [i for i in range(14) if got[2 * i] != got[2 * i + 1]] == [11]


def test_only_the_placed_rows_stay_in_scratch(spark):
    folder = Path(shared_dir(spark), SCRATCH)
    tables = lambda: {p.name for p in folder.iterdir()} if folder.exists() else set()
    before = tables()
    got = near.dedup(frame(spark, awkward()))
    assert [name.split("-")[0] for name in tables() - before] == ["placed"]
    assert got.count() == len(awkward())
