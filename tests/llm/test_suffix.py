import random

import numpy as np
import pytest
from docs import awkward, frame, prose

from tickbars.llm import merging, suffix

LAST = 1 << 62


def brute(rows):
    """Spans and kept bytes of each row by a set of all strings of WINDOW bytes, in order of the id."""
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: LAST if r[0] is None else r[0]):
        data = (r[1] or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - suffix.WINDOW + 1):
            window = data[i : i + suffix.WINDOW]
            if window in seen:
                gone[i : i + suffix.WINDOW] = b"\1" * suffix.WINDOW
            seen.add(window)
        spans = []
        for i, g in enumerate(gone):
            if g and (not i or not gone[i - 1]):
                spans.append([i, i])
            if g:
                spans[-1][1] = i + 1
        out.append((str(r[0]), len(data), tuple(map(tuple, spans)), bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.n_bytes, tuple(tuple(s) for s in r.spans), bytes(r.kept)) for r in df.collect())


def repeats(seed, n):
    rnd = random.Random(seed)
    passages = [prose(50 + i, rnd.randint(15, 60)) for i in range(6)]
    rows = []
    for i in range(n):
        parts = [rnd.choice(passages)[rnd.randint(0, 40) :] if rnd.random() < 0.5 else prose(seed * 1000 + i * 10 + j, rnd.randint(1, 30)) for j in range(4)]
        rows.append((i, " ".join(parts), "en", "a", 1))
    return rows


@pytest.mark.parametrize("hot, chunk", [(suffix.HOT, suffix.CHUNK_BYTES), (0, 2000), (3, 500)])
def test_spans(spark, monkeypatch, hot, chunk):
    monkeypatch.setattr(suffix, "CHUNK_BYTES", chunk)
    base = prose(1, 400)
    rows = repeats(1, 25) + [(100, base, "en", "a", 1), (101, base, "en", "a", 1), (102, base[:1500] + "Q" + base[1500:], "en", "a", 1)]
    rows += [(110, "ab" * 300, "en", "a", 1), (111, "x" * 99, "en", "a", 1), (112, "x" * 100, "en", "a", 1), (113, "y" * 250, "en", "a", 1),
             (114, None, "en", "a", 1), (115, "", "en", "a", 1), (None, base[700:1200], "en", "a", 1), (116, "日本語テキスト" * 30, "en", "a", 1)]
    random.Random(5).shuffle(rows)
    assert found(suffix.remove(frame(spark, rows, clashes=True), hot=hot)) == brute(rows)


def test_long_texts_are_cut_in_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix, "SEGMENT", 700)
    rows = repeats(2, 8) + [(50, prose(2, 3000) + prose(51, 40), "en", "a", 1)]
    data = "".join(r[1] for r in rows).encode()
    offsets = np.cumsum([0, *(len(r[1].encode()) for r in rows)])
    starts = []
    for at, to, low, high in suffix.segments(offsets):
        place, _, first, last = suffix.anchors(np.frombuffer(data, np.uint8)[low:high], np.clip(offsets[at : to + 1], low, high) - low)
        starts += [s for a, b in zip(first + low, last + low) for s in range(a, b + 1)]
        assert ((place >= first) & (place <= last + suffix.BEFORE) & (last - first <= suffix.BEFORE)).all() if len(place) else True
    want = [s for a, b in zip(offsets[:-1], offsets[1:]) for s in range(a, b - suffix.WINDOW + 1)]
    assert sorted(starts) == want  # each window has one anchor
    one = suffix.suffix_runs(
        np.frombuffer(data, np.uint8), offsets, np.array([r[0] for r in rows]), np.arange(len(rows)),
        np.ones(len(suffix.Anchors(np.frombuffer(data, np.uint8), offsets).place), np.uint8), suffix.Anchors(np.frombuffer(data, np.uint8), offsets), 1,
    )
    runs = [suffix.unpack_run(suffix.pack_run(r)) for r in one[0].values()]
    spans = {tuple(s) for s in np.concatenate(suffix.covered(runs)).tolist()} | {(t, a - offsets[t], b - offsets[t]) for t, a, b in one[1].tolist()}
    gone = {i: set() for i in range(len(rows))}
    for text, a, b in spans:
        gone[text] |= set(range(a, b))
    want = {i: {p for a, b in spans for p in range(a, b)} for i, (_, _, spans, _) in enumerate(sorted(brute(rows), key=lambda x: int(x[0])))}
    assert gone == want


def test_awkward_and_empty(spark):
    rows = [r for r in awkward() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    assert found(suffix.remove(frame(spark, rows))) == brute(rows)
    assert suffix.remove(frame(spark, awkward(), clashes=True)).count() == len(awkward())
    assert suffix.remove(frame(spark, [])).count() == 0


def test_loser_tree_merges_front_coded_runs():
    rnd = random.Random(1)
    for n_runs in (1, 2, 3, 5, 8, 13):
        runs = []
        for _ in range(n_runs):
            rows = sorted(bytes(rnd.choice(b"ab") for _ in range(12)) for _ in range(rnd.randint(0, 40)))
            keys = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 12)
            common = merging.prefixes(keys)
            back = merging.restored(common.tolist(), merging.front_coded(keys, common), 12)
            assert back == rows
            runs.append((back, common.tolist()))
        out = list(merging.merged(runs))
        got = [runs[r][0][i] for r, i, _ in out]
        assert got == sorted(k for keys, _ in runs for k in keys)
        if got:
            assert [c for _, _, c in out] == merging.prefixes(np.frombuffer(b"".join(got), np.uint8).reshape(-1, 12)).tolist()
            assert [(r, i) for r, i, _ in out if not r] == [(0, i) for i in range(len(runs[0][0]))]
    assert list(merging.merged([])) == []


def test_equal_windows_have_equal_anchors():
    text = prose(3, 600).encode()
    data = np.frombuffer(b"#" * 37 + text + b"?" * 11 + text, np.uint8)
    place, key, first, last = suffix.anchors(data, np.array([0, len(data)]))
    of = {s: p - s for p, a, b in zip(place, first, last) for s in range(a, b + 1)}
    shift = len(text) + 11
    assert all(of[s] == of[s + shift] for s in range(37, 37 + len(text) - suffix.WINDOW + 1))
