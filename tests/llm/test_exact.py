import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from docs import awkward, frame

from tickbars.llm import exact

TOP = 1 << 62


def brute(rows):
    groups = defaultdict(list)
    for i, (doc_id, text, *_) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), TOP if doc_id is None else doc_id, i))
    out = []
    for key, members in groups.items():
        best = min(members)
        digest = hashlib.sha256(key.encode()).hexdigest()
        out += [(rows[i][0], rows[best[2]][0], len(members), digest) for _, _, i in members]
    return Counter(out), len(groups)


def test_groups(spark):
    rows = awkward() + [(1000 + i, "many copies of this", "en", "a", 1) for i in range(500)]
    got = exact.dedup(frame(spark, rows, clashes=True)).collect()
    want, n_groups = brute(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == n_groups and all(r.doc_id == r.keep_id for r in got if r.kept)


def test_keep(spark):
    rows = awkward()
    docs = frame(spark, rows, clashes=True)
    kept = exact.keep(docs)
    _, n_groups = brute(rows)
    assert kept.columns == docs.columns and kept.count() == n_groups


def test_empty(spark):
    assert exact.dedup(frame(spark, [])).count() == 0 and exact.keep(frame(spark, [])).count() == 0


def test_a_run_keeps_one_entry_across_batches():
    import pyarrow as pa

    digests = [bytes([i // 3]) * 32 for i in range(30)]
    table = pa.table({
        "digest": pa.array(digests, pa.binary()), "n_points": np.zeros(30, np.int64), "keep_id": np.arange(30),
        "keep_row": np.arange(30), "group_size": np.ones(30, np.int64),
    })
    out = pa.Table.from_batches(list(exact.one_for_each(iter(table.to_batches(max_chunksize=7)))))
    assert out.column("keep_id").to_pylist() == list(range(0, 30, 3)) and set(out.column("group_size").to_pylist()) == {3}


def some_runs(seed, n_runs, n, kinds):
    """Sorted runs, each with an entry for each of some digests; bytes of zero stand at the end of many."""
    rnd = np.random.default_rng(seed)
    runs = []
    for _ in range(n_runs):
        numbers = np.sort(rnd.choice(kinds, min(n, kinds), replace=False))
        run = np.empty(len(numbers), exact.WIRE)
        run["digest"] = [int(k).to_bytes(4, "big") + bytes(28) for k in numbers]
        run["n_points"], run["keep_id"] = rnd.integers(0, 3, len(run)), rnd.integers(0, 4, len(run))
        run["no_id"] = rnd.random(len(run)) < 0.3
        run["keep_id"][run["no_id"]] = 0
        run["keep_row"], run["group_size"] = rnd.permutation(len(run)), rnd.integers(1, 9, len(run))
        runs.append(run)
    return runs


def plain_merge(runs):
    groups = defaultdict(list)
    for e in np.concatenate(runs).tolist():
        groups[e[0].ljust(32, b"\0")].append((-e[1], e[2], e[3], e[4], e[5]))
    return [(d, *min(m)[:4], sum(x[4] for x in m)) for d, m in sorted(groups.items())]


def plain(entries):
    return [(e[0].ljust(32, b"\0"), -e[1], *e[2:]) for e in entries.tolist()]


@pytest.mark.parametrize("seed,n_runs,n,kinds", [(1, 4, 200, 300), (2, 7, 50, 50), (3, 1, 20, 40), (4, 3, 1, 1), (5, 4, 999, 100_000)])
def test_runs_merge_as_they_would_in_a_plain_loop(monkeypatch, seed, n_runs, n, kinds):
    runs = some_runs(seed, n_runs, n, kinds)
    # no two of the best rows of a digest are alike in all of length, id and row, as in a table
    for i, run in enumerate(runs):
        run["keep_row"] += i * 1_000_000
    want = plain_merge(runs)
    assert plain(exact.all_merged(runs)) == want
    monkeypatch.setattr(exact, "WINDOW", 64)
    blocks = [(i, run[at : at + 16]["digest"][0].ljust(32, b"\0"), run[at : at + 16]) for i, run in enumerate(runs) for at in range(0, len(run), 16)]
    pieces = list(exact.merged_blocks(iter(sorted(blocks, key=lambda b: b[1]))))
    assert [e for p in pieces for e in plain(p)] == want
    assert max(map(len, pieces)) <= 64 + 16 * (n_runs + 1)


def test_entries_keep_their_values_in_a_block():
    run = some_runs(6, 1, 60, 90)[0]
    batch = exact.unpacked(run)
    assert batch.column("keep_id").null_count == run["no_id"].sum() > 0
    assert exact.packed(batch.slice(7, 20)).tolist() == run[7:27].tolist()


def test_runs_are_sorted_once(spark):
    text = exact.dedup(frame(spark, awkward()))._jdf.queryExecution().analyzed().toString()
    assert text.count("Sort [digest") == 1
