import random
from collections import Counter, defaultdict

import pytest
from docs import WORD, awkward, frame, prose
from pyspark.sql import functions as F

from tickbars.llm import mix


def wanted(sizes):
    """Targets by repeated capping, in plain Python."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mix.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left, share = total - sum(capped.values()), sum(weight[s] for s in free)
        over = {s: 3.0 * sizes[s] for s in free if left * weight[s] / share > 3 * sizes[s]} if share else {}
        if not over:
            return {s: capped.get(s, left * weight[s] / share if share else 0) for s in names}
        capped |= over


def check(spark, rows, near):
    got = mix.mix(frame(spark, rows, clashes=True)).collect()
    again = mix.mix(frame(spark, rows[::-1])).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.size, r.taken)
    assert sorted(map(key, got), key=str) == sorted(map(key, again), key=str)
    sizes, source = defaultdict(int), {}
    for doc_id, text, _, s, _ in rows:
        sizes[s] += len(WORD.findall(text or ""))
        source[doc_id] = s
    targets = wanted(sizes)
    taken = defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(targets[s], rel=1e-9) and 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s, target in targets.items():
        assert abs(taken[s] - target) <= near + 0.02 * target, s
    return got


def test_awkward(spark):
    got = check(spark, awkward(), mix.BLOCK_TOKENS)
    assert Counter(r.size for r in got) == Counter(len(WORD.findall(r[1] or "")) for r in awkward())


def test_many_shards_and_a_hot_source(spark, monkeypatch):
    monkeypatch.setattr(mix, "SHARD_TOKENS", 2000)
    rnd = random.Random(1)
    rows = [(i, prose(i, rnd.randint(1, 300)), "en", rnd.choice(["hot"] * 6 + ["b", "c", "é", None, "A"]), 1) for i in range(300)]
    check(spark, rows, mix.BLOCK_TOKENS)


def test_mix_as_documents(spark):
    docs = frame(spark, awkward(), clashes=True)
    kept = mix.keep(docs)
    assert kept.columns == docs.columns
    n = {(r.doc_id, r.size): r.taken for r in mix.mix(docs).where("size > 0").collect()}
    once = kept.groupBy("doc_id", mix.n_words(F.col("text")).alias("size")).count().collect()
    assert all(r["count"] <= 3 * 2 and n[r.doc_id, r["size"]] > 0 for r in once)
    assert mix.mix(frame(spark, [])).count() == 0 and mix.keep(frame(spark, [])).count() == 0
    assert [r.taken for r in mix.mix(frame(spark, [(1, None, "en", "a", 1), (2, "", "en", None, 1)])).collect()] == [0, 0]


@pytest.mark.parametrize("seed", range(3))
def test_apportion_gives_seats_by_highest_quotients(spark, seed):
    rnd = random.Random(seed)
    rows, want = [], {}
    for g in range(6):
        votes = [rnd.choice([0.0, 1.0, 3.0, rnd.random() * 1000]) for _ in range(rnd.randint(1, 12))]
        house = rnd.randint(0, 40)
        most = [rnd.choice([3, 100]) for _ in votes]
        if sum(m for m, v in zip(most, votes) if v) < house:
            house = 0
        seats = [0] * len(votes)
        for _ in range(house):
            best = max((v / (2 * s + 1), -k) for k, (v, s, m) in enumerate(zip(votes, seats, most)) if s < m and v)
            seats[-best[1]] += 1
        rows += [(g, f"k{k:02d}", v, m, house) for k, (v, m) in enumerate(zip(votes, most))]
        want |= {(g, f"k{k:02d}"): s for k, s in enumerate(seats)}
    df = spark.createDataFrame(rows, "g int, key string, votes double, most long, house long")
    got = {(r.g, r.key): r.seats for r in mix.apportion(df, ["g"], "key").collect()}
    by_group = lambda x: {g: sorted(s for (h, _), s in x.items() if h == g) for g in range(6)}
    assert {k: sum(v) for k, v in by_group(got).items()} == {k: sum(v) for k, v in by_group(want).items()}
    capped = {g for g, _, _, m, _ in rows if m == 3}
    assert all(got[k] == want[k] for k in want if k[0] not in capped)


def test_rank(spark):
    names = [f"n{i}" for i in random.Random(1).sample(range(1000), 200)]
    got = mix.ranked(spark.createDataFrame([(n,) for n in names], "key string").repartition(7), "key").collect()
    assert {r["key"]: r["rank"] for r in got} == {n: i for i, n in enumerate(sorted(names))}
