import math
from collections import Counter

import pytest
from docs import WORD, awkward, frame, prose
from pyspark.sql import functions as F

from tickbars.llm import quality


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text), dup, len(inside)


def test_measures(spark):
    rows = awkward() + [(50, "a\na\n \n a\nb", "en", "a", 1), (51, "p q r p q r p q", "en", "a", 1)]
    got = quality.score(frame(spark, rows, clashes=True)).collect()
    assert len(got) == len(rows)
    want = Counter((r[0], *brute(r[1])) for r in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_em_finds_the_accuracies_of_planted_votes(spark):
    good = F.rand(1) < 0.8
    right = {"symbols": (0.95, 0.9), "word_length": (1, 0), "lines": (0.9, 0.6), "repeats": (0.85, 0.7), "stop_words": (0.9, 0.8), "letters": (0.97, 0.9)}
    df = spark.range(20_000).select(good.alias("good"))
    voted = quality.stored(df.select("good", *[
        F.when(F.rand(i + 10) < 0.2, 0).when(F.col("good"), F.when(F.rand(i + 20) < right[r][0], 1).otherwise(-1))
        .otherwise(F.when(F.rand(i + 30) < right[r][1], -1).otherwise(1)).alias(r)
        for i, r in enumerate(quality.RULES)
    ]))
    model = quality.fit(voted.drop("good"))
    assert model.prior == pytest.approx(0.8, abs=0.03)
    for rule, (on_good, on_bad) in right.items():
        if rule == "word_length":  # votes for all: no word on either kind
            assert model.on_good[rule] + model.on_bad[rule] == pytest.approx(1)
            continue
        assert model.on_good[rule] == pytest.approx(on_good, abs=0.03) and model.on_bad[rule] == pytest.approx(on_bad, abs=0.05)
    sure = voted.withColumn("p", model.posterior())
    assert sure.where("good = (p >= 0.5)").count() > 0.97 * sure.count()


def test_keep_drops_junk_and_keeps_clean_rows_as_they_are(spark):
    clean = [(i, prose(i, 120) + " the and of it", "en", "a", i) for i in range(60)]
    junk = [(100 + i, " ".join(f"{w}###" for w in prose(i, 120).split()), "en", "a", i) for i in range(8)]
    docs = frame(spark, clean + junk + clean[:1], clashes=True)
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in clean + clean[:1])


def test_empty_table_and_plan(spark):
    empty = frame(spark, [])
    assert quality.score(empty).count() == 0 and quality.keep(empty).count() == 0
    plan = quality.keep(frame(spark, awkward()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan.replace("Exchange RoundRobin", "")


def plain_model(patterns, rounds=40):
    """EM in a plain loop: prior and each rule's shares of votes for, among good and among bad rows."""
    prior, good, bad = 0.8, [0.9] * len(quality.RULES), [0.6] * len(quality.RULES)
    clip = lambda x: min(max(x, 0.02), 0.98)
    likelihood = []
    for _ in range(rounds):
        total, share = 0.0, {}
        for pattern, n in patterns.items():
            on_good, on_bad = prior, 1 - prior
            for at, vote in enumerate(pattern):
                on_good *= {1: good[at], -1: 1 - good[at], 0: 1}[vote]
                on_bad *= {1: bad[at], -1: 1 - bad[at], 0: 1}[vote]
            share[pattern] = on_good / (on_good + on_bad)
            total += n * math.log(on_good + on_bad)
        likelihood.append(total)
        new = min(max(sum(n * share[p] for p, n in patterns.items()) / sum(patterns.values()), 0.05), 0.95)
        moved = abs(new - prior)
        prior = new
        for at in range(len(good)):
            voted = [(p[at] == 1, n * share[p], n * (1 - share[p])) for p, n in patterns.items() if p[at]]
            of_good, of_bad = sum(v[1] for v in voted), sum(v[2] for v in voted)
            if not of_good or not of_bad:
                continue
            a, b = sum(v[1] for v in voted if v[0]) / of_good, sum(v[2] for v in voted if v[0]) / of_bad
            if a < b:
                a = b = sum(v[1] + v[2] for v in voted if v[0]) / (of_good + of_bad)
            moved = max(moved, abs(clip(a) - good[at]) + abs(clip(b) - bad[at]))
            good[at], bad[at] = clip(a), clip(b)
        if moved < 1e-4:
            break
    return share_of(prior, good, bad), likelihood


def share_of(prior, good, bad):
    def share(pattern):
        odds = math.log(prior / (1 - prior))
        for at, vote in enumerate(pattern):
            odds += {1: math.log(good[at] / bad[at]), -1: math.log((1 - good[at]) / (1 - bad[at])), 0: 0.0}[vote]
        return 1 / (1 + math.exp(-odds))

    return share


def test_posterior_and_verdict_equal_a_plain_loop(spark):
    junk = [(500 + i, " ".join(f"{w}###" if i % 2 else w * 6 for w in prose(i, 90).split()), "en", "a", i) for i in range(14)]
    some = [(600 + i, prose(i, 40 + i) + " the and of it" * (i % 3), "en", "a", i) for i in range(60)]
    rows = quality.score(frame(spark, awkward() + junk + some)).collect()
    patterns = Counter(tuple(r[rule] for rule in quality.RULES) for r in rows)
    share, likelihood = plain_model(patterns)
    assert len(patterns) > 5 and all(b >= a - 1e-9 for a, b in zip(likelihood, likelihood[1:], strict=False))
    for r in rows:
        want = share(tuple(r[rule] for rule in quality.RULES))
        assert r.posterior == pytest.approx(want, abs=1e-9) and r.kept == (not r.base_failed and r.posterior >= 0.5)


def test_a_vote_never_speaks_for_the_other_side():
    assert quality.accuracies(30, 100, 60, 100) == (pytest.approx(0.45), pytest.approx(0.55))
    assert quality.accuracies(90, 100, 10, 50) == (pytest.approx(0.9), pytest.approx(0.8))
    assert quality.accuracies(100, 100, 0, 50) == (0.98, 0.98)


def test_keep_gives_the_rows_that_score_keeps(spark):
    rows = awkward() + [(700 + i, prose(i, 90) + " the and of", "en", "a", i) for i in range(30)]
    docs = frame(spark, rows, clashes=True)
    want = Counter(r.doc_id for r in quality.score(docs).where("kept").collect())
    assert Counter(r.doc_id for r in quality.keep(docs).collect()) == want
