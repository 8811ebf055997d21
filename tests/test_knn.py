"""Grid nearest-neighbour search equals brute force (ties, duplicates, skew)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brisa.operators import knn as KNN
from brisa.operators.evaluate import r2_score


def brute(train: pd.DataFrame, test: pd.DataFrame, k: int, group=False) -> dict:
    out = {}
    for _, q in test.iterrows():
        t = train[train.g == q.g] if group else train
        d2 = (q.x1 - t.x1) * (q.x1 - t.x1) + (q.x2 - t.x2) * (q.x2 - t.x2)
        order = pd.DataFrame({"d2": d2.values, "id": t.id.values, "y": t.y.values}).sort_values(["d2", "id"])
        top = order.head(k)
        out[(q.g if group else 0, q.id)] = (list(top.id), top.y.mean())
    return out


def _frames(rng, n_train, n_test, hot=0.0, dup=0.0, lattice=False):
    x = rng.normal(size=(n_train, 2))
    if hot:
        h = int(n_train * hot)
        x[:h] = rng.normal(scale=1e-4, size=(h, 2)) + 0.5       # a third of rows in one tiny spot
    if dup:
        d = int(n_train * dup)
        x[-d:] = [0.25, -0.75]                                   # exact duplicates
    if lattice:
        x = np.round(x * 2) / 2
    train = pd.DataFrame({"id": np.arange(n_train), "x1": x[:, 0], "x2": x[:, 1],
                          "y": rng.integers(0, 10, n_train).astype(float), "g": rng.integers(0, 3, n_train)})
    q = rng.normal(size=(n_test, 2))
    if hot:
        q[: n_test // 3] = rng.normal(scale=1e-4, size=(n_test // 3, 2)) + 0.5
    if lattice:
        q = np.round(q * 2) / 2
    test = pd.DataFrame({"id": np.arange(n_test) + 10_000, "x1": q[:, 0], "x2": q[:, 1],
                         "g": rng.integers(0, 3, n_test)})
    return train, test


@pytest.mark.parametrize("case", [
    dict(hot=0.0, dup=0.0), dict(hot=0.34, dup=0.0), dict(hot=0.0, dup=0.34), dict(lattice=True),
])
def test_nearest_equals_brute_force(spark, case):
    rng = np.random.default_rng(7)
    train, test = _frames(rng, 600, 60, **case)
    k = 7
    got = KNN.nearest(spark.createDataFrame(train), spark.createDataFrame(test), k).toPandas()
    want = brute(train, test, k)
    for (g, qid), (ids, mean) in want.items():
        sub = got[got.qid == qid].sort_values("rk")
        assert list(sub.rid) == ids, (qid, list(sub.rid), ids)
        assert list(sub.rk) == list(range(1, k + 1))


def test_outliers_neither_grow_leaves_nor_candidates(spark):
    """A dense cluster and one far row: leaves stay O(k), and a query joins a few of them."""
    rng = np.random.default_rng(9)
    k = 5
    x = rng.random((20_000, 2))
    x[0] = [1e6, 1e6]
    tr = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "x1": x[:, 0], "x2": x[:, 1], "y": 1.0}))
    sizes = KNN.build_index(tr, k).rows.groupBy("path").count().toPandas()["count"]
    assert sizes.sum() == len(x) and sizes.max() <= KNN.leaf_rows(k)
    train = pd.DataFrame({"id": np.arange(len(x)), "x1": x[:, 0], "x2": x[:, 1], "y": 1.0, "g": 0})
    test = pd.DataFrame({"id": np.arange(40), "x1": np.append(rng.random(39), 5e5), "x2": np.append(rng.random(39), 0.5), "g": 0})
    df = KNN.nearest(spark.createDataFrame(train), spark.createDataFrame(test), k)
    got = df.toPandas()
    for (g, qid), (ids, _) in brute(train, test, k).items():
        assert list(got[got.qid == qid].sort_values("rk").rid) == ids


def test_infinite_and_null_features_take_no_part(spark):
    inf = float("inf")
    tr = spark.createDataFrame([(1, 0.0, 0.0, 1.0), (2, inf, 0.0, 9.0), (3, None, 0.0, 9.0), (4, float("nan"), 0.0, 9.0), (5, -inf, 1.0, 9.0)],
                               "id long, x1 double, x2 double, y double")
    te = spark.createDataFrame([(1, 0.5, 0.5), (2, inf, 0.0), (3, None, 1.0)], "id long, x1 double, x2 double")
    assert [tuple(r) for r in KNN.knn_predict(tr, te, 3).select("qid", "prediction").collect()] == [(1, 1.0)]
    assert KNN.knn_predict(tr.limit(0), te, 3).count() == 0 and KNN.knn_predict(tr, te.limit(0), 3).count() == 0


@pytest.mark.parametrize("admit", ["other", "upto"])
def test_tags_admit_rows(spark, admit):
    rng = np.random.default_rng(1)
    train, test = _frames(rng, 300, 45, hot=0.34)
    got = KNN.nearest(spark.createDataFrame(train), spark.createDataFrame(test), 6, tag_col="g", admit=admit).toPandas()
    for q in test.itertuples():
        t = train[train.g != q.g] if admit == "other" else train[train.g <= q.g]
        want = brute(t.assign(g=0), test[test.id == q.id].assign(g=0), 6)
        assert list(got[(got.qid == q.id) & (got.g == q.g)].sort_values("rk").rid) == list(want.values())[0][0]


def test_grouped_search_and_small_groups(spark):
    rng = np.random.default_rng(3)
    train, test = _frames(rng, 90, 30)
    train = train[~((train.g == 2) & (train.id > 20))]       # group 2 has very few rows
    k = 12
    got = KNN.knn_predict(spark.createDataFrame(train), spark.createDataFrame(test), k,
                          group_col="g").toPandas()
    want = brute(train, test, k, group=True)
    assert len(got) == len(want)
    for r in got.itertuples():
        assert abs(r.prediction - want[(r.g, r.qid)][1]) < 1e-9


def test_all_k_curve_equals_direct_predictions(spark):
    rng = np.random.default_rng(11)
    train, test = _frames(rng, 300, 40, lattice=True)
    tr, te = spark.createDataFrame(train), spark.createDataFrame(test)
    curve = KNN.knn_all_k(tr, te, 15).toPandas()
    for k in (1, 4, 15):
        direct = KNN.knn_predict(tr, te, k).toPandas().set_index("qid").prediction
        at_k = curve[curve.k == k].set_index("qid").prediction
        assert np.allclose(direct.sort_index(), at_k.sort_index())


def test_k_larger_than_training_set(spark):
    train = pd.DataFrame({"id": [1, 2, 3], "x1": [0.0, 1.0, 2.0], "x2": [0.0] * 3, "y": [1.0, 2.0, 6.0]})
    test = pd.DataFrame({"id": [9], "x1": [0.1], "x2": [0.0]})
    r = KNN.knn_predict(spark.createDataFrame(train), spark.createDataFrame(test), 10).first()
    assert r.prediction == 3.0


def test_equal_distance_ties_use_lower_id(spark):
    train = pd.DataFrame({"id": [5, 3, 8, 1], "x1": [1.0, -1.0, 0.0, 0.0], "x2": [0.0, 0.0, 1.0, -1.0],
                          "y": [10.0, 20.0, 30.0, 40.0]})
    test = pd.DataFrame({"id": [0], "x1": [0.0], "x2": [0.0]})
    nb = KNN.nearest(spark.createDataFrame(train), spark.createDataFrame(test), 2).orderBy("rk").collect()
    assert [r.rid for r in nb] == [1, 3]


def test_lattice_variant_takes_boundary_point_whole(spark):
    train = pd.DataFrame({"id": [1, 2, 3, 4], "x1": [0.0, 1.0, 1.0, 1.0], "x2": [0.0] * 4,
                          "y": [0.0, 3.0, 6.0, 9.0]})
    test = pd.DataFrame({"id": [9], "x1": [0.0], "x2": [0.0]})
    r = KNN.knn_lattice(spark.createDataFrame(train), spark.createDataFrame(test), 2).first()
    assert r.prediction == pytest.approx((0 + 3 + 6 + 9) / 4)


def test_hash_split_is_partition_independent(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = KNN.hash_split(df, "k").filter("is_test").select("k")
    b = KNN.hash_split(df.repartition(13), "k").filter("is_test").select("k")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    share = a.count() / 2000
    assert 0.2 < share < 0.3


def test_r2_constant_truth(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert r2_score(df, "y", "p").first().r2 == 1.0
    df2 = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, p double")
    assert r2_score(df2, "y", "p").first().r2 == 0.0


def test_plan_has_window_group_limit_and_no_python(spark):
    rng = np.random.default_rng(1)
    train, test = _frames(rng, 200, 20)
    df = KNN.knn_predict(spark.createDataFrame(train), spark.createDataFrame(test), 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_lattice_matches_pandas_on_dense_lattice(spark):
    """Many duplicates per lattice point: most queries resolve in round A,
    so the carried row count must survive that round too."""
    rng = np.random.default_rng(5)
    train, test = _frames(rng, 800, 80, lattice=True)
    k = 6
    got = KNN.knn_lattice(spark.createDataFrame(train), spark.createDataFrame(test), k).toPandas()
    pts = train.groupby(["x1", "x2"]).agg(n=("id", "size"), sum_y=("y", "sum"), pid=("id", "min")).reset_index()
    for _, q in test.iterrows():
        d2 = (q.x1 - pts.x1) * (q.x1 - pts.x1) + (q.x2 - pts.x2) * (q.x2 - pts.x2)
        o = pts.assign(d2=d2).sort_values(["d2", "pid"]).head(k)
        o = o[o.n.cumsum() - o.n < k]
        want = o.sum_y.sum() / o.n.sum()
        assert abs(got[got.qid == q.id].prediction.iloc[0] - want) < 1e-9


def test_null_and_nan_features_are_skipped(spark):
    train = pd.DataFrame({"id": [1, 2, 3, 4], "x1": [0.0, 1.0, None, float("nan")], "x2": [0.0, 0.0, 0.0, 0.0],
                          "y": [1.0, 3.0, 100.0, 100.0]})
    test = pd.DataFrame({"id": [9, 10], "x1": [0.2, None], "x2": [0.0, 0.0]})
    got = KNN.knn_predict(spark.createDataFrame(train, "id long, x1 double, x2 double, y double"),
                          spark.createDataFrame(test, "id long, x1 double, x2 double"), 2).collect()
    assert [(r.qid, r.prediction) for r in got] == [(9, 2.0)]


def test_a_point_is_searched_once(spark, monkeypatch):
    """Sixty queries at six points, tags apart: one search for each point and tag, and each query has its neighbours."""
    rng = np.random.default_rng(12)
    train, test = _frames(rng, 500, 6)
    test = pd.concat([test.assign(id=test.id + 100 * i, g=i % 2) for i in range(10)], ignore_index=True)
    asked = []
    real = KNN.LV.candidates
    monkeypatch.setattr(KNN.LV, "candidates", lambda index, points, *more: asked.append(points.count()) or real(index, points, *more))
    got = KNN.nearest(spark.createDataFrame(train), spark.createDataFrame(test), 4, tag_col="g", admit="other").toPandas()
    assert asked == [12]
    for q in test.itertuples():
        want = brute(train[train.g != q.g].assign(g=0), test[test.id == q.id].assign(g=0), 4)
        assert list(got[got.qid == q.id].sort_values("rk").rid) == list(want.values())[0][0]


def test_only_rows_within_the_radius_are_ranked(spark):
    rng = np.random.default_rng(13)
    train, test = _frames(rng, 4000, 50)
    index = KNN.build_index(spark.createDataFrame(train), 5)
    te, repeated = KNN._asked(index, spark.createDataFrame(test), ("x1", "x2"), "id", None, None, None)
    met = KNN.LV.candidates(index, te.select("g", "qt", "q0", "q1").distinct(), 5, "true").join(index.rows, ["g", "path"])
    every, near = met.count(), met.filter(KNN._distance(["q0", "q1"], ["c0", "c1"]) <= F.col("r") * (1 + KNN.LV.EPS)).count()
    assert not repeated and 50 * 5 <= near < every
    plan = KNN.search(index, spark.createDataFrame(test), 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "* (1.0 + 1.0E-9)" in plan or "1.000000001" in plan


def test_rows_that_share_an_id_are_one_query(spark):
    rng = np.random.default_rng(14)
    train, test = _frames(rng, 300, 8)
    two = pd.concat([test, test.assign(x1=test.x1 + 0.3)], ignore_index=True)
    got = KNN.nearest(spark.createDataFrame(train), spark.createDataFrame(two), 5).toPandas()
    for qid in test.id:
        d2 = [((q.x1 - t.x1) * (q.x1 - t.x1) + (q.x2 - t.x2) * (q.x2 - t.x2), t.id) for q in two[two.id == qid].itertuples() for t in train.itertuples()]
        assert list(got[got.qid == qid].sort_values("rk").rid) == [i for _, i in sorted(d2)[:5]]
    mean = KNN.knn_predict(spark.createDataFrame(train), spark.createDataFrame(two), 5).toPandas().set_index("qid").prediction
    last = KNN.knn_all_k(spark.createDataFrame(train), spark.createDataFrame(two), 5).filter("k = 5").toPandas().set_index("qid").prediction
    want = got.groupby("qid").y.mean()
    assert np.allclose(mean.sort_index(), want) and np.allclose(last.sort_index(), want)
