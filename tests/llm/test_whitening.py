import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickbars.llm import spectral, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(row):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in row]


def usable(rows, width):
    return [
        (i, whole(v)) for i, v, *_ in rows
        if v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v)
    ]


def table(n=400, width=8, seed=1):
    rng = np.random.default_rng(seed)
    mixed = rng.standard_normal((n, width)) @ rng.standard_normal((width, width))
    return [(i, [float(np.float32(c)) for c in row], i % 3) for i, row in enumerate(mixed)]


def awkward():
    rows = table()
    rows += rows[:3] + [(None, rows[5][1], None), (900, None, 1), (901, [], 1), (902, [1.0, None] * 4, 1)]
    rows += [(903, [float("nan")] * 8, 1), (904, [float("inf")] + [0.0] * 7, 1), (905, [1.0] * 7, 1)]
    return rows


def check(got, rows, width, count):
    fit = usable(rows, width)
    x = np.array([v for _, v in fit], dtype=object)
    n, s = len(fit), x.sum(axis=0)
    y = np.array([[float(v * n - t) / n for v, t in zip(row, s)] for row in x])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == n * count
    rows_of = {}
    for r in got:
        rows_of.setdefault((r.vec_id, r.deviation), {})[r.component] = r
        assert r.n == n and abs(r.identity_error) < 1e-9
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-10
    signs = {}
    for k, (vec_id, v) in enumerate(fit):
        deviation = sum((n * a - t) ** 2 for a, t in zip(v, s))
        for c in range(count):
            want = y[k] @ vectors[:, c] / math.sqrt(values[c])
            have = rows_of[vec_id, deviation][c + 1].whitened
            if abs(want) > 0.1:
                assert signs.setdefault(c, have * want > 0) == (have * want > 0)
            assert abs(abs(have) - abs(want)) < 1e-7


def test_components_equal_a_plain_computation(spark):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    df = df.withColumns({c: F.lit("old") for c in ("component", "n", "deviation", "whitened", "cell", "value")})
    check(whitening.components(df).collect(), rows, 8, 8)
    check(whitening.components(df, count=3).collect(), rows, 8, 3)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [1.0, 2.0], 1)], [(i, [1.0, 2.0], 1) for i in range(5)]])
def test_nothing_that_varies(spark, rows):
    assert whitening.components(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_a_dimension_without_variance_has_no_component(spark):
    rows = [(i, [*v[:4], 0.5, v[0]], 0) for i, v, _ in table(200, 4)]
    got = whitening.components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 200 * 4 and max(r.identity_error for r in got) < 1e-9


def test_large_entries_are_exact_or_null(spark):
    rows = [(i, [3e6 * i, float(i)], 0) for i in range(4)] + [(9, [3e38, 1.0], 0)]
    got = whitening.components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.deviation for r in got} == {None} and len(got) == 5
    got = whitening.components(spark.createDataFrame(rows[:4], SCHEMA)).collect()
    x = [whole(v) for _, v, _ in rows[:4]]
    s = [sum(c) for c in zip(*x)]
    assert {r.deviation for r in got} == {sum((4 * a - t) ** 2 for a, t in zip(v, s)) for v in x}


def test_whiten_carries_columns(spark):
    df = spark.createDataFrame(awkward(), SCHEMA).withColumn("whitened", F.lit("old")).withColumn("_row", F.lit(1))
    model = whitening.fit(df)
    out = whitening.whiten(df, model).toPandas()
    assert list(out.columns) == ["vec_id", "embedding", "label", "_row", "whitened"] and len(out) == 404
    white = np.stack(out["whitened"])
    assert np.abs(np.cov(white.T, bias=True) - np.eye(8)).max() < 1e-9


@pytest.mark.parametrize("kind", ["plain", "clusters", "scales", "diagonal", "zero", "pair"])
def test_eigenvectors(kind):
    rng = np.random.default_rng(3)
    d = 40
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    spectrum = {
        "plain": rng.standard_normal(d), "clusters": np.repeat([5.0, 1.0, 0.0, -2.0], 10),
        "scales": np.geomspace(1, 1e-9, d), "diagonal": np.arange(d) * 1.0, "zero": np.zeros(d),
        "pair": np.concatenate([np.ones(d - 2), [2.0, 2.0 + 1e-9]]),
    }[kind]
    a = np.diag(spectrum) if kind == "diagonal" else q @ np.diag(spectrum) @ q.T
    values, vectors = spectral.eigenvectors(a)
    assert np.allclose(values, np.sort(spectrum)[::-1], atol=1e-13) and (np.diff(values) <= 0).all()
    assert np.abs(vectors.T @ vectors - np.eye(d)).max() < 1e-13
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13
