import random

from docs import awkward, frame, prose
from pyspark.sql import functions as F

from tickbars.llm import splitters


def sizes(df):
    body = F.coalesce(F.col("text"), F.lit(""))
    return df.select("doc_id", "text", "shard", "slot", (F.octet_length(body) + 8).alias("size")).collect()


def test_awkward(spark):
    docs = frame(spark, awkward(), clashes=True)
    out = splitters.shard(docs, 5)
    assert set(out.columns) == set(docs.columns)
    got = sizes(out)
    assert len(got) == len(awkward())
    for shard in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))
    assert {r["shard"] for r in got} <= set(range(5))


def test_even_shards_with_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(splitters, "LANE_BYTES", 4000)
    rnd = random.Random(2)
    rows = [(i, "copy " * 20, "en", "a", 1) for i in range(900)] + [(1000 + i, prose(i, rnd.randint(1, 60)), "en", "a", 1) for i in range(2000)]
    got = sizes(splitters.shard(frame(spark, rows), 24))
    total = [0] * 24
    for r in got:
        total[r["shard"]] += r["size"]
    mean = sum(total) / 24
    assert max(total) - min(total) <= 2 * max(r["size"] for r in got) and abs(max(total) - mean) < 0.05 * mean
    slots = {s: sorted(r["slot"] for r in got if r["shard"] == s) for s in range(24)}
    assert all(v == list(range(len(v))) for v in slots.values())


def test_small_groups_stay_together(spark):
    rows = [(10 * i + j, prose(i, 40), "en", "a", 1) for i in range(600) for j in range(3)]
    got = sizes(splitters.shard(frame(spark, rows), 6))
    shards = {}
    for r in got:
        shards.setdefault(r["text"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())


def test_splitters_are_exact(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([5, rnd.randint(-(2**63), 2**63 - 1)]), rnd.randint(-50, 50), rnd.randint(1, 9)) for _ in range(3000)]
    keys = spark.createDataFrame(rows, "high long, low long, weight long")
    cuts, total = splitters.splitters(keys, 10, 0.0)
    assert total == sum(r[2] for r in rows) and cuts == sorted(cuts)
    heaviest = {}
    for h, l, w in rows:  # noqa: E741
        heaviest[h, l] = heaviest.get((h, l), 0) + w
    for i, cut in enumerate(cuts, 1):
        below = sum(w for h, l, w in rows if (h, l) < cut)  # noqa: E741
        assert abs(below - total * i / 10) <= max(heaviest.values())


def test_edges(spark):
    assert splitters.shard(frame(spark, [])).count() == 0
    one = sizes(splitters.shard(frame(spark, [(1, None, None, None, None)])))
    assert len(one) == 1 and one[0]["slot"] == 0 and one[0]["size"] == 8
    same = sizes(splitters.shard(frame(spark, [(1, "a b", "en", "a", 1)] * 50), 3))
    assert len({r["shard"] for r in same}) == 1 and sorted(r["slot"] for r in same) == list(range(50))
