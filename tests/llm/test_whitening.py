"""Whitening against eigenvectors worked out in one place."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from brisa.llm import catalog, whitening
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>, n string, x int, component string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "n", 1, "c") for i, v in vectors], SCHEMA)


def brute(vectors):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    a = u - u.mean(axis=0)
    e, v = np.linalg.eigh(a.T @ a / len(u))
    deviation = [sum((len(u) * int(p) - int(s)) ** 2 for p, s in zip(r, u.sum(axis=0))) for r in x]
    return len(u), deviation, e[::-1], v[:, ::-1], x - u.mean(axis=0)


def check(rows, ids, vectors, top=16, rel=1e-9):
    n, deviation, e, v, centred = brute(vectors)
    keep = int((e > 1e-20 * e[0]).sum())
    assert len(rows) == len(ids) * min(top, keep)
    signs, at = {}, {}
    for place, i in enumerate(ids):
        at.setdefault(i, place)
    for r in rows:
        i, k = at[r.vec_id], r.component - 1
        assert r.n == n and r.deviation == deviation[i] and r.identity_error <= 1e-4
        assert r.explained == pytest.approx(e[k] / e.sum(), rel=1e-6)
        want = float(centred[i] @ v[:, k] / np.sqrt(e[k]))
        sign = signs.setdefault(k, 1.0 if abs(r.whitened - want) <= abs(r.whitened + want) else -1.0) if abs(want) > 1e-6 else signs.get(k, 1.0)
        assert r.whitened == pytest.approx(sign * want, rel=rel, abs=1e-6)


def test_whole_table(spark):
    got = catalog.QUERIES["op11_whitening"](spark, SF_SMALL).collect()
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    check(got, [r.vec_id for r in table], [r.embedding for r in table])
    assert {r.component for r in got} == set(range(1, 17))


def test_repeated_rows_count_once_and_stay(spark):
    rng = np.random.default_rng(3)
    vectors = [rng.normal(0, 2, 5).tolist() for _ in range(40)]
    rows = list(enumerate(vectors)) + [(7, vectors[7])] * 300 + [(None, vectors[9])]
    got = whitening.whiten(frame(spark, rows).repartition(7)).collect()
    assert {r.n for r in got} == {40} and sum(r.vec_id is None for r in got) == 5 and sum(r.vec_id == 7 for r in got) == 301 * 5
    _, deviation, *_ = brute(vectors)
    assert all(r.deviation == deviation[r.vec_id] for r in got if r.vec_id is not None)
    once = {(r.vec_id, r.component, r.whitened) for r in got if r.vec_id == 7}
    assert len(once) == 5


def test_ill_conditioned_and_singular(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(0, 1, (600, 3)) * [1e6, 100.0, 3.0]
    vectors = (base @ rng.normal(size=(3, 6))).tolist()
    model = whitening.fit(frame(spark, list(enumerate(vectors))))
    _, _, e, _, _ = brute(vectors)
    a = np.array([np.floor(64 * np.array(v)) for v in vectors])
    s = np.linalg.svd(a - a.mean(axis=0), compute_uv=False) ** 2 / len(a)
    assert np.allclose(model.values, s, rtol=1e-5) and model.identity_error <= 1e-4 and model.passes >= 2
    flat = [[float(i), float(i), 5.0] for i in range(50)]  # rank 1
    got = whitening.whiten(frame(spark, list(enumerate(flat)))).collect()
    assert len(got) == 50 and {r.component for r in got} == {1} and got[0].explained == pytest.approx(1.0)
    assert np.var([r.whitened for r in got]) == pytest.approx(1.0)


def test_rows_that_take_no_part(spark):
    good = [(i, [float(i), float(i * i % 7), float(i % 3)]) for i in range(30)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [float("inf"), 0.0, 0.0]), (104, []), (105, [1.0]), (106, [1e300, 0.0, 0.0])]
    got = whitening.whiten(frame(spark, good + bad)).collect()
    check(got, [i for i, _ in good], [v for _, v in good])


def test_large_entries_are_exact(spark):
    vectors = [[2.0 ** 50 + 64 * i, float(i % 5), -2.0 ** 30 * i] for i in range(20)]
    model = whitening.fit(frame(spark, list(enumerate(vectors))))
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors]
    assert model.sums == [sum(c) for c in zip(*x)]
    got = {r.vec_id: r.deviation for r in whitening.transform(frame(spark, list(enumerate(vectors))), model).collect()}
    exact = [sum((20 * p - s) ** 2 for p, s in zip(r, model.sums)) for r in x]
    assert got == {i: (t if t < 2 ** 63 else None) for i, t in enumerate(exact)}


def test_nothing_to_scale(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(9)])).count() == 0
    floats = spark.createDataFrame([(1, [0.5, 1.0]), (2, [1.5, -1.0])], "vec_id int, embedding array<float>")
    got = whitening.whiten(floats).collect()
    assert len(got) == 2 and {abs(round(r.whitened, 9)) for r in got} == {1.0}


def test_sign_is_fixed(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    a, b = whitening.fit(df), whitening.fit(df.repartition(5).orderBy(F.desc("vec_id")))
    assert np.allclose(a.vectors, b.vectors, atol=1e-9)
