"""Leaf directory: bounded leaves at any size, boxes that hold their rows, searches in any number of features."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brisa.operators import knn as KNN
from brisa.operators import leaves as LV


def brute(train: np.ndarray, test: np.ndarray, k: int) -> list:
    out = []
    for q in test:
        d2 = ((q - train) ** 2).sum(axis=1) if train.shape[1] != 2 else (q[0] - train[:, 0]) ** 2 + (q[1] - train[:, 1]) ** 2
        out.append(list(np.lexsort([np.arange(len(train)), d2])[:k]))
    return out


def frame(spark, x, **more):
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), **{f"f{i}": x[:, i] for i in range(x.shape[1])}, "y": 1.0, **more}))


def names(d):
    return [f"f{i}" for i in range(d)]


@pytest.mark.parametrize("n", [100_000, 1_000_000])
def test_the_largest_leaf_does_not_grow(spark, n):
    """A third of the rows in a tiny spot, an outlier, and a feature with few values."""
    k, u = 99, F.rand(5)
    hot = F.col("id") % 3 == 0
    rows = spark.range(n).select("id", F.when(F.col("id") == 7, 1e9).when(hot, F.rand(1) * 1e-6).otherwise(F.rand(2)).alias("f0"),
                                 F.floor(F.rand(3) * 16).cast("double").alias("f1"), F.when(hot, 0.5).otherwise(u).alias("f2"), F.lit(1.0).alias("y"))
    index = KNN.build_index(rows, k, names(3))
    sizes = index.rows.groupBy("path").count().agg(F.max("count").alias("most"), F.sum("count").alias("n"), F.count("*").alias("leaves")).first()
    assert sizes.n == n and sizes.most <= KNN.leaf_rows(k)
    assert sizes.leaves <= 12 * n / KNN.leaf_rows(k)
    assert index.nodes.agg(F.max(F.size("children"))).first()[0] <= LV.FAN
    # the edge of the hot spot, where its rows lie among others, takes a few levels more
    assert len(index.sizes) <= 4 + np.log(n / KNN.leaf_rows(k)) / np.log(LV.FAN) * 2


@pytest.mark.parametrize("d", [1, 2, 3, 5])
def test_any_number_of_features(spark, d):
    rng = np.random.default_rng(d)
    x = rng.normal(size=(1500, d))
    x[:500] = rng.normal(scale=1e-4, size=(500, d)) + 0.5
    x[500:600] = 0.25
    q = np.concatenate([rng.normal(size=(25, d)), x[:5], np.full((1, d), 50.0)])
    k = 6
    got = KNN.nearest(frame(spark, x), frame(spark, q), k, names(d)).toPandas().sort_values(["qid", "rk"])
    for i, want in enumerate(brute(x, q, k)):
        assert list(got[got.qid == i].rid) == want


def test_boxes_hold_their_rows(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(3000, 2)), 1)
    index = KNN.build_index(frame(spark, x, t=rng.integers(0, 3, 3000)), 5, names(2), tag_col="t")
    rows = index.rows.toPandas()
    seen = 0
    for node in index.nodes.collect():
        for box in node.children:
            inside = rows[(rows.path == box.path) | rows.path.str.startswith(box.path + ".")]
            assert {t.t: t.n for t in box.tags} == inside.groupby("t").size().to_dict()
            assert [inside.c0.min(), inside.c1.min()] == box.lo and [inside.c0.max(), inside.c1.max()] == box.hi
            seen += len(inside) if box.leaf else 0
    assert seen == len(rows)


def test_splits_where_quantiles_cannot(spark):
    """Nearly all rows share a value; the node still splits, and a single point is a leaf."""
    x = np.array([[0.0, 0.0]] + [[5.0, 1.0]] * 400 + [[5.0, 2.0 + i * 1e-9] for i in range(40)])
    index = KNN.build_index(frame(spark, x), 30, names(2))
    sizes = index.rows.groupBy("path").agg(F.count("*").alias("n"), F.countDistinct("c0", "c1").alias("points")).collect()
    assert all(r.n <= KNN.leaf_rows(30) or r.points == 1 for r in sizes)
    assert index.rows.filter("c0 = 5 AND c1 = 1").count() == 30  # of one point, k rows at most


def test_saved_index_gives_the_same_neighbours(spark, tmp_dir):
    rng = np.random.default_rng(4)
    x, q = rng.normal(size=(900, 3)), rng.normal(size=(40, 3))
    index = KNN.build_index(frame(spark, x), 9, names(3))
    index.save(f"{tmp_dir}/index")
    again = LV.Directory.load(spark, f"{tmp_dir}/index")
    assert again.sizes == index.sizes and again.dims == 3
    for k in (1, 9):
        got = KNN.search(again, frame(spark, q), k, names(3)).toPandas().sort_values(["qid", "rk"])
        assert [list(got[got.qid == i].rid) for i in range(len(q))] == brute(x, q, k)


def test_groups_of_unlike_sizes(spark):
    """One group is a single leaf, another has levels, a third has no training rows."""
    rng = np.random.default_rng(6)
    x, g = rng.normal(size=(2000, 2)), np.repeat([0, 1], [1990, 10])
    q, h = rng.normal(size=(30, 2)), np.arange(30) % 3
    got = KNN.nearest(frame(spark, x, g=g), frame(spark, q, g=h), 4, names(2), group_col="g").toPandas().sort_values(["qid", "rk"])
    for i in range(30):
        mine = np.flatnonzero(g == h[i])
        want = [int(mine[j]) for j in brute(x[mine], q[i:i + 1], 4)[0]] if len(mine) else []
        assert list(got[got.qid == i].rid) == want


def test_large_levels_are_shuffled(spark, monkeypatch):
    """Without broadcasts: the same neighbours, and neither cross joins nor broadcasts in the plan."""
    monkeypatch.setattr(LV, "SMALL_NODES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rng = np.random.default_rng(8)
        x, q = rng.normal(size=(800, 2)), rng.normal(size=(20, 2))
        df = KNN.nearest(frame(spark, x), frame(spark, q), 3, names(2))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "Broadcast" not in plan
        got = df.toPandas().sort_values(["qid", "rk"])
        assert [list(got[got.qid == i].rid) for i in range(20)] == brute(x, q, 3)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_walk_is_dealt_over_all_tasks_and_by_cells(spark):
    """Many queries beside few leaves: cells are walked, not points, and the walk's exchange is not merged by its few bytes."""
    rng = np.random.default_rng(4)
    x = np.stack([rng.random(2000), rng.integers(0, 3, 2000) * 45.0], axis=1)
    q = np.stack([rng.random(1500), rng.integers(0, 6, 1500) * 22.5], axis=1)
    index = KNN.build_index(frame(spark, x), 5, names(2))
    te, _ = KNN._asked(index, frame(spark, q), names(2), "id", None, None, None)
    points = te.select("g", "qt", "q0", "q1").distinct()
    cells, cell = LV._cells(index, points)
    assert points.count() == 1500 and cells.select(*cell).distinct().count() < 1500 / 4
    met = LV.candidates(index, points, 5, "true")
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and met.count() < 1500 * 20
    got = KNN.search(index, frame(spark, q), 5, names(2)).toPandas().sort_values(["qid", "rk"])
    for i, want in enumerate(brute(x, q[:50], 5)):
        assert list(got[got.qid == i].rid) == want


def test_neighbouring_leaves_are_one_cell_but_not_across_outliers(spark):
    """Points of several dense leaves are walked together; an outlier among the leaves widens no dense cell."""
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.random((4000, 2)), [[1e9, 0.5]]])
    q = np.concatenate([rng.random((1000, 2)), [[1e6, 0.5], [9e8, 0.5]]])
    index = KNN.build_index(frame(spark, x), 5, names(2))
    te, _ = KNN._asked(index, frame(spark, q), names(2), "id", None, None, None)
    cells, cell = LV._cells(index, te.select("g", "qt", "q0", "q1"))
    box = cells.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"), (F.max("q0") - F.min("q0")).alias("wide")).toPandas()
    assert len(box) < index.rows.select("path").distinct().count() / 3
    assert box[box.wide <= 1].n.sum() > 900
    got = KNN.search(index, frame(spark, q), 5, names(2)).toPandas().sort_values(["qid", "rk"])
    assert [list(got[got.qid == i].rid) for i in range(len(q))] == brute(x, q, 5)


def test_small_nodes_are_split_where_they_are_and_points_find_their_leaf(spark, monkeypatch):
    """Nodes that fit a task need no pass over all rows for each level, and cuts lead every row to its own leaf (odd ties too)."""
    rng = np.random.default_rng(15)
    x = np.concatenate([np.round(rng.normal(size=(2500, 2)), 1), [[-9.0, 0.0]] * 3, [[9.0, 0.0]] * 400, rng.normal(size=(800, 2)), [[1e9, 0.5]]])
    passes = []
    real = LV._cuts
    monkeypatch.setattr(LV, "_cuts", lambda *a: passes.append(1) or real(*a))
    for block, least, most in ((1 << 15, 0, 0), (512, 1, 4)):
        monkeypatch.setattr(LV, "BLOCK", block, raising=False)
        passes.clear()
        index = KNN.build_index(frame(spark, x), 500, names(2))
        assert least <= len(passes) <= most
        small = LV.build(index.rows.drop("path"), 2, 16)
        leaves = small.rows.groupBy("path").agg(F.count("*").alias("n"), F.countDistinct("c0", "c1").alias("points")).collect()
        assert sum(r.n for r in leaves) == len(x) and all(r.n <= 16 or r.points == 1 for r in leaves)
        asked = small.rows.select("g", F.lit(0).alias("qt"), F.col("c0").alias("q0"), F.col("c1").alias("q1"), "path")
        own, _ = LV._cells(small, asked)
        assert own.filter("own <> path").count() == 0


def test_points_see_the_boxes_of_their_part_of_a_cell(spark):
    """A cell of many leaves is walked once; its points by leaf are left with a few boxes before each has its radius."""
    rng = np.random.default_rng(16)
    x, q = rng.random((6000, 2)), rng.random((900, 2)) * 1.2 - 0.1
    index = KNN.build_index(frame(spark, x), 5, names(2))
    te, _ = KNN._asked(index, frame(spark, q), names(2), "id", None, None, None)
    points = te.select("g", "qt", "q0", "q1").distinct()
    cells, cell = LV._cells(index, points)
    assert cells.select(*cell).distinct().count() < cells.select(*cell, "own").distinct().count()
    met = LV.candidates(index, points, 5, "true")
    assert "own" in met._jdf.queryExecution().executedPlan().toString() and met.count() < 900 * 20
    got = KNN.search(index, frame(spark, q), 5, names(2)).toPandas().sort_values(["qid", "rk"])
    assert [list(got[got.qid == i].rid) for i in range(len(q))] == brute(x, q, 5)


def test_carried_columns_may_have_any_name(spark):
    """Names that the build uses itself: carried columns keep their values."""
    rng = np.random.default_rng(17)
    x, used = rng.normal(size=(300, 2)), ["n", "dim", "dims", "block", "open", "value", "cuts", "part", "wide", "inner", "kept", "lo0"]
    got = KNN.nearest(frame(spark, x, **{c: np.arange(300) + j for j, c in enumerate(used)}), frame(spark, x[:9]), 3, names(2), carry=used).toPandas().sort_values(["qid", "rk"])
    assert [list(got[got.qid == i].rid) for i in range(9)] == brute(x, x[:9], 3)
    assert all((got[c] == got.rid + j).all() for j, c in enumerate(used))
