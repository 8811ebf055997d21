"""Property tests: grid neighbour search vs brute force on small random sets."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from brisa.operators import knn as KNN

coords = st.integers(min_value=-3, max_value=3).map(lambda v: v / 2.0)   # many exact ties
points = st.lists(st.tuples(coords, coords, st.integers(0, 9)), min_size=1, max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(train=points, queries=st.lists(st.tuples(coords, coords), min_size=1, max_size=6),
       k=st.integers(1, 8))
def test_grid_search_equals_brute_force(spark, train, queries, k):
    tr = pd.DataFrame([(i, a, b, float(y)) for i, (a, b, y) in enumerate(train)], columns=["id", "x1", "x2", "y"])
    te = pd.DataFrame([(100 + i, a, b) for i, (a, b) in enumerate(queries)], columns=["id", "x1", "x2"])
    got = KNN.nearest(spark.createDataFrame(tr, "id long, x1 double, x2 double, y double"),
                      spark.createDataFrame(te, "id long, x1 double, x2 double"), k).toPandas()
    for q in te.itertuples():
        d2 = (q.x1 - tr.x1) ** 2 + (q.x2 - tr.x2) ** 2
        want = pd.DataFrame({"d2": d2, "id": tr.id}).sort_values(["d2", "id"]).head(k).id.tolist()
        assert got[got.qid == q.id].sort_values("rk").rid.tolist() == want
