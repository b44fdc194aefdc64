import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from docs import ASCII_LOWER, WORD, awkward, frame, prose

from tickbars.llm import ctw, words


def test_kt_and_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 7.25, 1000.5, 3e7])
    assert ctw._log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-11, abs=1e-11)
    # 0 then 1 then 1: 1/2 * 1/4 * 1/2
    assert math.exp(ctw.kt(np.array([1.0]), np.array([2.0]))[0]) == pytest.approx(1 / 16)


def brute_predict(train, contexts, depth):
    """P(byte | context) by plain recursion over nodes (context, bits)."""
    counts = Counter()
    for context, byte in train:
        bits = "1"
        for bit in f"{byte:08b}":
            for d in range(depth + 1):
                counts[context[depth - d :], bits, bit] += 1
            bits += bit
    below = {}
    for context, bits, _ in counts:
        if context:
            below.setdefault((context[1:], bits), set()).add(context)

    def estimate(context, bits):
        zeros, ones = counts[context, bits, "0"], counts[context, bits, "1"]
        return float(ctw.kt(np.array([zeros * 1.0]), np.array([ones * 1.0]))[0]), zeros, ones

    def weighted(context, bits):
        own = estimate(context, bits)[0]
        if len(context) == depth:
            return own
        inside = sum(weighted(c, bits) for c in below.get((context, bits), ()))
        return math.log(0.5) + np.logaddexp(own, inside)

    def bit_one(context, bits):
        held, weight = 0.0, 1.0
        for d in range(depth + 1):
            node = context[depth - d :]
            own, zeros, ones = estimate(node, bits)
            one = (ones + 0.5) / (zeros + ones + 1)
            if d and not zeros + ones:
                return held  # never seen: as its parent
            longer = context[depth - d - 1 :] if d < depth else None
            if d == depth or not any(counts[longer, bits, b] for b in "01"):
                return held + weight * one
            inside = sum(weighted(c, bits) for c in below.get((node, bits), ()))
            share = 1 / (1 + math.exp(inside - own))
            held, weight = held + weight * share * one, weight * (1 - share)
        return held

    out = []
    for context, byte in contexts:
        p, bits = 1.0, "1"
        for bit in f"{byte:08b}":
            one = bit_one(context, bits)
            p *= one if bit == "1" else 1 - one
            bits += bit
        out.append(p)
    return out


def test_values_equal_the_plain_recursion():
    depth = 3
    train = words.text_bytes(pa.array(["abra cadabra", "abracadabra abr", "zz"]))
    test = words.text_bytes(pa.array(["abra zab", "qq"]))
    grams = {}
    for name, (data, offsets) in (("train", train), ("test", test)):
        _, _, closed, edges = ctw.tokens(data, offsets)
        grams[name] = ctw.grams(closed, edges, depth)
    split = lambda g: [(bytes(int(x >> 8).to_bytes(depth, "big")[::-1]), int(x) & 255) for x in g]
    keys, counts = np.unique(grams["train"], return_counts=True)
    new = np.setdiff1d(grams["test"], keys)
    every = np.concatenate([keys, new])
    counts = np.concatenate([counts, np.zeros(len(new), np.int64)])
    order = np.argsort(every)
    every, counts = every[order], counts[order]
    top = ctw.finish_top(*ctw.bucket_top(every, counts, depth))
    value = ctw.bucket_values(every, counts, top, depth)
    asked = np.concatenate([grams["train"][:8], grams["test"]])
    got = 10.0 ** value[np.searchsorted(every, asked)]
    assert got == pytest.approx(brute_predict(split(grams["train"]), split(asked), depth), rel=1e-9)


def test_predictions_of_a_context_sum_to_one():
    depth = 3
    data, offsets = words.text_bytes(pa.array([prose(1, 300)]))
    _, _, closed, edges = ctw.tokens(data, offsets)
    keys, counts = np.unique(ctw.grams(closed, edges, depth), return_counts=True)
    context = (keys[50] >> np.uint64(8)) << np.uint64(8)
    asked = context | np.arange(256, dtype=np.uint64)
    new = np.setdiff1d(asked, keys)
    every = np.concatenate([keys, new])
    order = np.argsort(every)
    counts = np.concatenate([counts, np.zeros(len(new), np.int64)])[order]
    every = every[order]
    value = ctw.bucket_values(every, counts, ctw.finish_top(*ctw.bucket_top(every, counts, depth)), depth)
    assert (10.0 ** value[np.searchsorted(every, asked)]).sum() == pytest.approx(1.0)


def base(rows):
    tokens = [[*WORD.findall((r[1] or "").translate(ASCII_LOWER)), None] for r in rows]
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows]
    c = Counter(t for ts, h in zip(tokens, held) if not h for t in ts)
    n, v = sum(c.values()), len(c)
    return [(r[0], h, len(ts), sum(c[t] > 0 for t in ts), n, sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts))
            for r, h, ts in zip(rows, held, tokens)]


@pytest.mark.parametrize("salt_chunks", [1, 1024])
def test_base_and_held_out_gain(spark, monkeypatch, salt_chunks):
    monkeypatch.setattr(ctw, "SALT_CHUNKS", salt_chunks)
    rows = awkward() + [(1000 + i, prose(i, 150), "en", "a", 1) for i in range(150)]
    got = ctw.score(frame(spark, rows, clashes=True)).collect()
    key = lambda x: (str(x[0]), x[2], x[5])
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    for have, want in zip(got, sorted(base(rows), key=key), strict=True):
        assert have[:5] == want[:5] and have[5] == pytest.approx(want[5], rel=1e-9)
    held = [r for r in got if r[1] and r[2] > 100]
    assert held and sum(r[6] for r in held) > sum(r[5] for r in held)
    assert all(r[6] < 0 for r in got)


def test_no_training_and_no_rows(spark):
    assert ctw.score(frame(spark, [])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = ctw.score(frame(spark, [(held, "ab", "en", "a", 1)])).first()
    assert row.held_out and row.train_tokens == 0 and row.n_known == 0
    assert row.score == pytest.approx(-4 * math.log10(256))
