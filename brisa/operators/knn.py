"""Exact k-nearest-neighbour regression built from equi-joins, for any number of features.

No cross join and no all-pairs step: candidates come from leaves of bounded size.

1. Training rows are deduplicated per exact feature point down to ``k``
   rows (lowest ids) - rows past the k-th at one point can never be among
   the k nearest.  ``row_number() <= k`` plans as a ``WindowGroupLimit``
   that trims map-side, so a point holding a third of all rows is cut
   before the shuffle.
2. ``leaves.build`` splits the rows level by level into leaves of at most
   ``leaf_rows(k)`` rows, whatever their number, and keeps the tree as a table.
3. ``leaves.candidates`` walks small cells of queries down the tree; all of a
   query's k nearest lie in the few leaves it ends with.
4. One equi-join on the leaf and one ranking by ``(distance, id)``.

Ties are broken by training id, so the result is deterministic and equals
a brute-force ranking by ``(squared distance, id)``.  ``group`` columns
restrict neighbours to the same group.  ``admit`` relates a tag of the
query to a tag of the training row (few different values, e.g. CV folds):
``"other"`` takes rows with another tag, ``"upto"`` rows with a tag of at
most the query's.  So all folds share one index, and every row is in it once.
An index can be built once, saved, and searched by many jobs (``build_index``,
``search``).
"""

from __future__ import annotations

import functools
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisa.operators import leaves as LV
from brisa.session import cut_lineage

ADMIT = {None: "true", "other": "{t} <> {q}", "upto": "{t} <= {q}"}


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def hash_bucket(key_col: str, seed: str, start: int = 1, width: int = 1) -> Column:
    """Integer from hex digits of ``md5(key || seed)`` (stable, engine independent)."""
    h = F.md5(F.concat(F.col(key_col).cast("string"), F.lit(seed)))
    return F.conv(F.substring(h, start, width), 16, 10).cast("int")


def hash_split(df: DataFrame, key_col: str, seed: str = "420", test_sixteenths: int = 4,
               out_col: str = "is_test") -> DataFrame:
    """Deterministic train/test split: first md5 hex digit < ``test_sixteenths``
    is test (4/16 = 25%).  Unlike ``randomSplit`` it does not depend on the
    partitioning."""
    return df.withColumn(out_col, hash_bucket(key_col, seed) < test_sixteenths)


def hash_fold(df: DataFrame, key_col: str, n_folds: int = 5, seed: str = "420",
              out_col: str = "fold") -> DataFrame:
    """Fold number from md5 hex digits 2-5 modulo ``n_folds``."""
    return df.withColumn(out_col, F.pmod(hash_bucket(key_col, seed, 2, 4), F.lit(n_folds)))


def _finite(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(F.col(c)) & (F.abs(F.col(c)) < F.lit(float("inf")))


def _all_finite(cols: Sequence[str]) -> Column:
    return functools.reduce(Column.__and__, [_finite(c) for c in cols])


def leaf_rows(k: int) -> int:
    """Most rows of a leaf: small leaves bound the k nearest tightly, so few rows are ranked."""
    return max(64, k // 2)


def build_index(train: DataFrame, k: int, features: Sequence[str] = ("x1", "x2"), train_id: str = "id", y_col: str = "y",
                group_col: str | None = None, carry: Sequence[str] = (), tag_col: str | None = None) -> LV.Directory:
    """Leaf directory of the training rows, for searches of up to ``k`` neighbours."""
    group = F.col(group_col) if group_col else F.lit(0)
    tag = F.col(tag_col).cast("int") if tag_col else F.lit(0)
    at = [f"c{i}" for i in range(len(features))]
    tr = train.select(group.alias("g"), tag.alias("t"), F.col(train_id).alias("rid"), *(_d(f).alias(c) for f, c in zip(features, at)),
                      _d(y_col).alias("y"), *carry).filter(_all_finite(at))
    # at most k rows per exact feature point and tag (lowest ids win ties anyway)
    same = Window.partitionBy("g", "t", *at).orderBy("rid")
    tr = tr.withColumn("__dup", F.row_number().over(same)).filter(F.col("__dup") <= k).drop("__dup")
    return LV.build(tr, len(features), leaf_rows(k))


def _asked(index: LV.Directory, test: DataFrame, features: Sequence[str], test_id: str, group_col: str | None, tag_col: str | None,
           admit: str | None) -> tuple[DataFrame, bool]:
    """The queries (g, qt, qid, q0..), written, and whether an id is asked more than once in a group or tag."""
    group = F.col(group_col) if group_col else F.lit(0)
    tag = F.col(tag_col).cast("int") if admit else F.lit(0)
    asked = [f"q{i}" for i in range(len(features))]
    te = test.select(group.alias("g"), tag.alias("qt"), F.col(test_id).alias("qid"), *(_d(f).alias(c) for f, c in zip(features, asked))).filter(_all_finite(asked))
    # a constant group would fold the join with the directory into a cross join; a checkpointed one is a plain key
    te = cut_lineage(te)
    again = te.groupBy("qt" if admit else "g", "qid").count().filter("count > 1")
    return te, not again.isEmpty()


def _ranked(index: LV.Directory, te: DataFrame, k: int, admit: str | None, carry: Sequence[str]) -> DataFrame:
    """(g, qt, q0.., rk, rid, y, d2, *carry): the ``k`` nearest rows of each different point of ``te``.

    Queries at one point (and tag) have the same neighbours, so a point is searched once.
    """
    at, asked = [f"c{i}" for i in range(index.dims)], [f"q{i}" for i in range(index.dims)]
    point = ["g", "qt", *asked]
    points = te.select(*point).distinct()
    met = LV.candidates(index, points, k, ADMIT[admit]).join(index.rows, ["g", "path"])
    met = met.filter(F.expr(ADMIT[admit].format(t="t", q="qt"))).withColumn("d2", _distance(asked, at))
    # no row beyond the radius is ranked
    met = met.filter(F.col("d2") <= F.col("r") * (1 + LV.EPS)).select(*point, "rid", "y", "d2", *carry)
    order = Window.partitionBy(*point).orderBy("d2", "rid")
    return met.withColumn("rk", F.row_number().over(order)).filter(F.col("rk") <= k)


def _by_query(te: DataFrame, found: DataFrame, admit: str | None) -> DataFrame:
    """What was found for the points, by (g, qid) of the queries at them."""
    point = ["g", "qt", *(c for c in te.columns if c not in ("g", "qt", "qid"))]
    met = te.join(found, point)
    return met.select((F.col("qt") if admit else F.col("g")).alias("g"), "qid", *(c for c in found.columns if c not in point))


def search(index: LV.Directory, test: DataFrame, k: int, features: Sequence[str] = ("x1", "x2"), test_id: str = "id",
           group_col: str | None = None, carry: Sequence[str] = (), tag_col: str | None = None, admit: str | None = None) -> DataFrame:
    """The ``k`` nearest rows of an index (built for ``k`` or more) for every row of ``test``; see ``nearest``."""
    return _search(index, *_asked(index, test, features, test_id, group_col, tag_col, admit), k, admit, carry)


def _search(index: LV.Directory, te: DataFrame, repeated: bool, k: int, admit: str | None, carry: Sequence[str] = ()) -> DataFrame:
    met = _by_query(te, _ranked(index, te, k, admit, carry), admit)
    if repeated:  # rows that share an id are one query: the nearest of them all
        order = Window.partitionBy("g", "qid").orderBy("d2", "rid")
        met = met.withColumn("rk", F.row_number().over(order)).filter(F.col("rk") <= k)
    return met.select("g", "qid", "rk", "rid", "y", "d2", *carry)


def _distance(asked: Sequence[str], at: Sequence[str]) -> Column:
    parts = [(F.col(q) - F.col(c)) * (F.col(q) - F.col(c)) for q, c in zip(asked, at)]
    return functools.reduce(Column.__add__, parts)


def nearest(train: DataFrame, test: DataFrame, k: int, features: Sequence[str] = ("x1", "x2"),
            train_id: str = "id", test_id: str = "id", y_col: str = "y",
            group_col: str | None = None, carry: Sequence[str] = (),
            tag_col: str | None = None, admit: str | None = None) -> DataFrame:
    """The ``k`` nearest training rows of every test row.

    Returns ``(g, qid, rk, rid, y, d2, *carry)``: rank 1..k by
    ``(squared Euclidean distance, training id)``.  When fewer than ``k``
    training rows may be taken all of them are returned.  With ``admit``,
    ``g`` is the query's tag.  Rows whose features are null, NaN or infinite
    are neither neighbours nor queries; an id may be asked once for each
    group or tag.
    """
    index = build_index(train, k, features, train_id, y_col, group_col, carry, tag_col if admit else None)
    return search(index, test, k, features, test_id, group_col, carry, tag_col, admit)


def _prepared(train: DataFrame, test: DataFrame, k: int, features: Sequence[str] = ("x1", "x2"), train_id: str = "id", test_id: str = "id",
              y_col: str = "y", group_col: str | None = None, tag_col: str | None = None, admit: str | None = None):
    index = build_index(train, k, features, train_id, y_col, group_col, (), tag_col if admit else None)
    return index, *_asked(index, test, features, test_id, group_col, tag_col, admit), k, admit


def knn_predict(train: DataFrame, test: DataFrame, k: int, **kw) -> DataFrame:
    """Uniform-weight KNN regression: mean target of the k nearest rows."""
    return _predict(*_prepared(train, test, k, **kw))


def search_predict(index: LV.Directory, test: DataFrame, k: int, features: Sequence[str] = ("x1", "x2"), test_id: str = "id",
                   group_col: str | None = None, tag_col: str | None = None, admit: str | None = None) -> DataFrame:
    """``knn_predict`` with an index that is there already."""
    return _predict(index, *_asked(index, test, features, test_id, group_col, tag_col, admit), k, admit)


def _predict(index: LV.Directory, te: DataFrame, repeated: bool, k: int, admit: str | None) -> DataFrame:
    if repeated:
        return _search(index, te, repeated, k, admit).groupBy("g", "qid").agg(F.avg("y").alias("prediction"))
    point = ["g", "qt", *(f"q{i}" for i in range(index.dims))]
    return _by_query(te, _ranked(index, te, k, admit, ()).groupBy(*point).agg(F.avg("y").alias("prediction")), admit)


def knn_all_k(train: DataFrame, test: DataFrame, k_max: int, **kw) -> DataFrame:
    """Predictions for every k in 1..k_max from one neighbour search.

    The running mean over the neighbour rank gives the k-NN prediction for
    each k at once; ``(g, qid, k, prediction)``.
    """
    return knn_curves(train, test, k_max, **kw).select("g", "qid", F.posexplode("curve").alias("k", "prediction")).withColumn("k", F.col("k") + 1)


def knn_curves(train: DataFrame, test: DataFrame, k_max: int, **kw) -> DataFrame:
    """(g, qid, curve): the predictions for k = 1, 2.. of a query as one array, so that joins move a row per query."""
    index, te, repeated, k, admit = _prepared(train, test, k_max, **kw)
    if repeated:
        return _curves(_search(index, te, repeated, k, admit), ["g", "qid"])
    return _by_query(te, _curves(_ranked(index, te, k, admit, ()), ["g", "qt", *(f"q{i}" for i in range(index.dims))]), admit)


def _curves(ranked: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("rk").rowsBetween(Window.unboundedPreceding, 0)
    means = ranked.select(*keys, "rk", F.avg("y").over(w).alias("prediction"))
    return means.groupBy(*keys).agg(F.expr("transform(array_sort(collect_list(struct(rk, prediction))), x -> x.prediction)").alias("curve"))


def knn_lattice(train: DataFrame, test: DataFrame, k: int, features: Sequence[str] = ("x1", "x2"),
                train_id: str = "id", test_id: str = "id", y_col: str = "y",
                group_col: str | None = None) -> DataFrame:
    """Lattice variant for features on a grid (e.g. speed steps x 16 angles).

    Training rows are first summed per distinct feature point into
    ``(n, sum_y)``; points are ranked by distance and the point that
    reaches ``k`` rows is taken whole, so the prediction is the weighted
    mean over whole points (a documented tie policy, not row-exact).
    """
    keys = ([group_col] if group_col else []) + list(features)
    pts = train.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(_d(y_col)).alias("sum_y"),
                                   F.min(train_id).alias("pid"))
    nb = nearest(pts, test, k, features, "pid", test_id, "sum_y", group_col, carry=["n"])
    w = Window.partitionBy("g", "qid").orderBy("rk").rowsBetween(Window.unboundedPreceding, 0)
    nb = nb.withColumn("cum", F.sum("n").over(w))
    taken = nb.filter(F.col("cum") - F.col("n") < k)
    return taken.groupBy("g", "qid").agg((F.sum("y") / F.sum("n")).alias("prediction"))
