"""Approximate nearest neighbours by cosine: an NN-descent graph and greedy search on it.

Building: vectors that are equal after normalising are one node; nodes are
numbered by their least id, so wherever candidates are cut, ties go to the node
with the smaller id.  ``TREES`` rounds of random
hyperplane signs deal the nodes into buckets of about ``LEAF`` and give each
node a first list of ``K`` neighbours.  Then iterations of Spark joins let
neighbours of neighbours meet: a node's forward and (sampled) reverse
neighbours come together with their vectors, are compared with each other, and
every one of them gets the best it met; lists are merged by node.

Search: a query starts from its own node's list and in each hop joins its best
``EXPAND`` unexpanded nodes to the graph, whose rows carry the neighbours'
vectors (16-bit codes), and keeps the best ``POOL``.  At the end the best
``RERANK`` are scored in double precision on the original vectors.

No step compares all with all: buckets larger than twice ``LEAF`` are dealt
out at random, lists, pools and samples have fixed sizes per node or query,
and every group is one node's or one query's.  All nodes are indexed.

Defined results: vectors that are null, zero, or hold null or non-finite
components, and rows with a null id, take no part; shorter vectors count as
padded with zeros; rows that repeat id and vector count once; equal vectors
under other ids are neighbours at full similarity, ties go to the smaller id;
a query has fewer than five neighbours where there are fewer candidates; empty
tables give no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisa.llm.common import group_starts, prepare, stored, whole_groups

TOP = 5
K = 26
TREES = 8
LEAF = 400
ITERATIONS = 3
MEET = 40
GIVE = 10
POOL = 240
EXPAND = 80
HOPS = 10
RERANK = 80

_LIST = "node bigint, ids binary, sims binary"


def nodes(vectors: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(points: node, same, vec - float64 bytes of its least id; members: node, vec_id, the TOP + 1 least ids of a node; rows: vec_id, same).

    ``same`` is a hash of the normalised vector.
    """
    prepare(vectors.sparkSession)
    clean = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where(
        "vec_id IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity')) AND exists(v, x -> x <> 0)")
    clean = stored(clean, "nnd-clean")
    width = clean.agg(F.max(F.size("v"))).first()[0] or 0

    def pack(column: pa.Array) -> pa.Array:
        out = [np.pad(np.asarray(x, np.float64), (0, width - len(x))).tobytes() for x in (c.values.to_numpy() for c in column)]
        return pa.array(out, pa.binary())

    def direction(column: pa.Array) -> pa.Array:
        if not len(column):
            return pa.array([], pa.binary())
        x = np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x = x / np.sqrt((x * x).sum(axis=1, keepdims=True)) + 0.0  # no negative zeros
        return pa.array([r.tobytes() for r in x], pa.binary())

    rows = clean.select("vec_id", F.arrow_udf(pack, "binary")("v").alias("vec"))
    rows = stored(rows.withColumn("same", F.xxhash64(F.arrow_udf(direction, "binary")("vec"))), "nnd-rows")
    points = rows.groupBy("same").agg(F.min(F.struct("vec_id", "vec")).alias("least"))
    points = points.orderBy("least.vec_id", "same").select(F.monotonically_increasing_id().alias("node"), "same", F.col("least.vec").alias("vec"))
    points = stored(points, "nnd-points")  # numbers are fixed by writing them
    rank = F.row_number().over(Window.partitionBy("same").orderBy("vec_id"))
    members = rows.select("same", "vec_id").distinct().withColumn("rank", rank).where(F.col("rank") <= TOP + 1)
    members = members.join(points.select("same", "node"), "same").select("node", "vec_id")
    return points, stored(members, "nnd-members"), rows.select("vec_id", "same")


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _encode(raw: list[bytes]) -> list[bytes]:
    """16-bit code of the unit vector, then its scale (similarities are off by about 1e-5)."""
    x = _unit(raw)
    top = np.abs(x).max(axis=1, keepdims=True)
    code = np.rint(x / top * 32767).astype("<i2")
    scale = (top / 32767).astype("<f4")
    return [c.tobytes() + s.tobytes() for c, s in zip(code, scale)]


def _decode(raw: bytes, n: int) -> np.ndarray:
    a = np.frombuffer(raw, np.uint8).reshape(n, -1)
    return np.ascontiguousarray(a[:, :-4]).view("<i2").astype(np.float32) * np.ascontiguousarray(a[:, -4:]).view("<f4")


def _lists(node, ids: list, sims: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array([np.asarray(i, "<i8").tobytes() for i in ids], pa.binary()),
                                       pa.array([np.asarray(s, "<f4").tobytes() for s in sims], pa.binary())], ["node", "ids", "sims"])


def _best(sim: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k greatest values of each row; ties go to the first columns."""
    sim = sim - 1e-12 * np.arange(sim.shape[1])
    return np.argpartition(-sim, k - 1, axis=1)[:, :k] if k < sim.shape[1] else np.tile(np.arange(sim.shape[1]), (len(sim), 1))


def _meet(keys: list[str], give: int):
    """Kernel over rows sorted by ``keys`` (with node, code): nodes of a group are compared, each gets its best ``give``."""

    def go(batches):
        for table in whole_groups(batches, *keys):
            cut = group_starts(*(table.column(k).to_numpy() for k in keys))
            node, code = table.column("node").to_numpy(), table.column("code").to_pylist()
            out: list = [[], [], []]
            for a, b in zip(cut[:-1], cut[1:]):
                mine, at = np.unique(node[a:b], return_index=True)
                if len(mine) < 2:
                    continue
                x = _decode(b"".join([code[a + i] for i in at]), len(mine))
                sim = x @ x.T
                np.fill_diagonal(sim, -2)
                pick = _best(sim, min(give, len(mine) - 1))
                for to, part in zip(out, (mine, mine[pick], np.take_along_axis(sim, pick, axis=1))):
                    to.extend(part)
                if len(out[0]) > 5000:
                    yield _lists(*out)
                    out = [[], [], []]
            if out[0]:
                yield _lists(*out)

    return go


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """One list of the best ``k`` different ids for each node."""

    def go(batches):
        for table in whole_groups(batches, "node"):
            ids, sims = table.column("ids").to_pylist(), table.column("sims").to_pylist()
            size = np.array([len(s) // 4 for s in sims])
            node = np.repeat(table.column("node").to_numpy(), size)
            one, sim = np.frombuffer(b"".join(ids), "<i8"), np.frombuffer(b"".join(sims), "<f4")
            order = np.lexsort((-sim, one, node))
            node, one, sim = node[order], one[order], sim[order]
            first = group_starts(node, one)[:-1]
            node, one, sim = node[first], one[first], sim[first]
            keep = one != node
            node, one, sim = node[keep], one[keep], sim[keep]
            order = np.lexsort((one, -sim, node))
            node, one, sim = node[order], one[order], sim[order]
            if not len(node):
                continue
            cut = group_starts(node)
            ends = np.minimum(cut[1:], cut[:-1] + k)
            yield _lists(node[cut[:-1]], [one[a:b] for a, b in zip(cut, ends)], [sim[a:b] for a, b in zip(cut, ends)])

    return lists.repartition("node").sortWithinPartitions("node").mapInArrow(go, _LIST)


def _edges(lists: DataFrame) -> DataFrame:
    """v, node, back: every list entry in both directions (back: 0 forward, 1 reverse)."""

    def go(batches):
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            other = np.frombuffer(b"".join(ids), "<i8")
            mine = np.repeat(batch.column("node").to_numpy(), [len(i) // 8 for i in ids])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([mine, other])), pa.array(np.concatenate([other, mine])),
                                              pa.array(np.repeat(np.array([0, 1], np.int32), len(mine)))], ["v", "node", "back"])

    return lists.mapInArrow(go, "v bigint, node bigint, back int")


def _around(lists: DataFrame, codes: DataFrame, forward: int, reverse: int, salt: int) -> DataFrame:
    """v, node, code: up to so many neighbours of each node in either direction, by a hash where there are more."""
    order = Window.partitionBy("v", "back").orderBy(F.xxhash64(F.lit(salt), "v", "node"))
    edges = _edges(lists).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= max(forward, reverse))
    edges = edges.where(F.col("rank") <= F.when(F.col("back") == 0, forward).otherwise(reverse)).select("v", "node")
    return edges.join(codes, "node")


def build(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lists: node, ids, sims - the graph; codes: node, code) of all points."""
    encode = F.arrow_udf(lambda c: pa.array(_encode(c.to_pylist()) if len(c) else [], pa.binary()), "binary")
    codes = stored(points.select("node", encode("vec").alias("code")), "nnd-codes")
    n = codes.count()
    bits = max(0, math.ceil(math.log2(max(n, 1) / LEAF)))

    def deal(batches):
        for batch in batches:
            code = batch.column("code").to_pylist()
            if not code:
                continue
            x = _decode(b"".join(code), len(code))
            for t in range(TREES):
                planes = np.random.default_rng(1000 + t).normal(size=(x.shape[1], bits)).astype(np.float32)
                leaf = ((x @ planes) > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(leaf * TREES + t), batch.column("node"), batch.column("code")], ["leaf", "node", "code"])

    dealt = codes.mapInArrow(deal, "leaf bigint, node bigint, code binary")
    sizes = dealt.groupBy("leaf").agg(F.count("*").alias("n"))  # TREES * 2 ** bits rows
    part = F.pmod(F.xxhash64("leaf", "node"), F.ceil(F.col("n") / (2 * LEAF)))
    dealt = dealt.join(sizes, "leaf").select("leaf", part.alias("part"), "node", "code")
    dealt = dealt.repartition("leaf", "part").sortWithinPartitions("leaf", "part")
    lists = stored(_merged(dealt.mapInArrow(_meet(["leaf", "part"], K), _LIST), K), "nnd-lists")
    for i in range(ITERATIONS):
        around = _around(lists, codes, MEET // 2, MEET // 2, i).repartition("v").sortWithinPartitions("v")
        lists = stored(_merged(lists.unionByName(around.mapInArrow(_meet(["v"], GIVE), _LIST)), K), "nnd-lists")
    return lists, codes


def _pick(pool: np.ndarray) -> np.ndarray:
    """Places of the best EXPAND entries that were not expanded (the pool is sorted)."""
    return np.flatnonzero(pool["done"] == 0)[:EXPAND]


_ENTRY = np.dtype([("id", "<i8"), ("sim", "<f4"), ("done", "<i4")])


def search(lists: DataFrame, codes: DataFrame, queries: DataFrame) -> DataFrame:
    """q, node: the pool each query node (``queries``: node) ends with, best RERANK by code."""

    def whole(batches):
        for table in whole_groups(batches, "v"):
            v, node, code = table.column("v").to_numpy(), table.column("node").to_numpy(), table.column("code").to_pylist()
            first = group_starts(*(x[order] for order in [np.lexsort((node, v))] for x in (v, node)))[:-1]
            keep = np.lexsort((node, v))[first]  # a neighbour in both directions counts once
            v, node, code = v[keep], node[keep], [code[i] for i in keep]
            cut = group_starts(v)
            for lo in range(0, len(cut) - 1, 256):
                part = cut[lo:lo + 257]
                yield pa.RecordBatch.from_arrays([
                    pa.array(v[part[:-1]]), pa.array([node[a:b].astype("<i8").tobytes() for a, b in zip(part, part[1:])], pa.binary()),
                    pa.array([b"".join(code[a:b]) for a, b in zip(part, part[1:])], pa.binary())], ["node", "near", "codes"])

    around = _around(lists, codes, K, K, -1).repartition("v").sortWithinPartitions("v")
    graph = stored(around.mapInArrow(whole, "node bigint, near binary, codes binary"), "nnd-graph")
    # kept dealt out by node, so a hop shuffles only the queries' frontiers
    graph = graph.repartition(int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions")), "node").persist(StorageLevel.DISK_ONLY)

    def begin(batches):
        for batch in batches:
            pools = []
            for ids, sims in zip(batch.column("ids").to_pylist(), batch.column("sims").to_pylist()):
                pool = np.zeros(len(ids) // 8, _ENTRY)
                pool["id"], pool["sim"] = np.frombuffer(ids, "<i8"), np.frombuffer(sims, "<f4")
                pools.append(pool.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("code"), pa.array(pools, pa.binary())], ["q", "code", "pool"])

    def frontier(batches):
        for batch in batches:
            q, code, node = [], [], []
            for x, c, raw in zip(batch.column("q").to_pylist(), batch.column("code").to_pylist(), batch.column("pool").to_pylist()):
                pool = np.frombuffer(raw, _ENTRY)
                picked = pool["id"][_pick(pool)].tolist()
                q += [x] * len(picked)
                code += [c] * len(picked)
                node += picked
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(code, pa.binary()), pa.array(node, pa.int64())], ["q", "code", "node"])

    def look(batches):
        for batch in batches:
            out = []
            for q, code, near, codes_ in zip(*(batch.column(c).to_pylist() for c in ("q", "code", "near", "codes"))):
                ids = np.frombuffer(near, "<i8")
                found = np.zeros(len(ids), _ENTRY)
                found["id"], found["sim"] = ids, _decode(codes_, len(ids)) @ _decode(code, 1)[0]
                out.append(found[ids != q].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("q"), pa.nulls(len(out), pa.binary()), pa.array(out, pa.binary())], ["q", "code", "pool"])

    def settle(batches):
        for table in whole_groups(batches, "q"):
            q, code, raw = table.column("q").to_numpy(), table.column("code").to_pylist(), table.column("pool").to_pylist()
            cut = group_starts(q)
            codes_, pools, more = [], [], []
            for a, b in zip(cut[:-1], cut[1:]):
                own = next(i for i in range(a, b) if code[i] is not None)
                old = np.frombuffer(raw[own], _ENTRY).copy()
                old["done"][_pick(old)] = 1
                pool = np.concatenate([old] + [np.frombuffer(raw[i], _ENTRY) for i in range(a, b) if i != own])
                pool = pool[np.lexsort((-pool["done"], pool["id"]))]
                pool = pool[group_starts(pool["id"])[:-1]] if len(pool) else pool
                pool = pool[np.lexsort((pool["id"], -pool["sim"]))][:POOL]
                pools.append(pool.tobytes())
                codes_.append(code[own])
                more.append(bool((pool["done"] == 0).any()))
            yield pa.RecordBatch.from_arrays([pa.array(q[cut[:-1]]), pa.array(codes_, pa.binary()), pa.array(pools, pa.binary()), pa.array(more)], ["q", "code", "pool", "open"])

    schema = "q bigint, code binary, pool binary"
    schema = "q bigint, code binary, pool binary"
    state = stored(queries.select("node").distinct().join(lists, "node").join(codes, "node").mapInArrow(begin, schema), "nnd-search")
    for _ in range(HOPS):
        met = state.mapInArrow(frontier, "q bigint, code binary, node bigint").join(graph, "node").select("q", "code", "near", "codes").mapInArrow(look, schema)
        step = stored(state.unionByName(met).repartition("q").sortWithinPartitions("q").mapInArrow(settle, f"{schema}, open boolean"), "nnd-search")
        state = step.drop("open")
        if step.where("open").limit(1).count() == 0:
            break
    graph.unpersist()

    def end(batches):
        for batch in batches:
            pools = [np.frombuffer(raw, _ENTRY)["id"][:RERANK] for raw in batch.column("pool").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("q").to_numpy(), [len(p) for p in pools])),
                                              pa.array(np.concatenate([np.zeros(0, np.int64), *pools]))], ["q", "node"])

    return state.mapInArrow(end, "q bigint, node bigint")


def _cosine(a: pa.Array, b: pa.Array) -> pa.Array:
    x, y = (np.frombuffer(b"".join(c.to_pylist()), np.float64).reshape(len(c), -1) if len(c) else np.zeros((0, 1)) for c in (a, b))
    return pa.array((x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))))


def nearest(vectors: DataFrame, asked: Column, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score of each asked row's nearest others (``asked``: a condition on vec_id)."""
    points, members, rows = nodes(vectors)
    lists, codes = build(points)
    queries = rows.where(asked).distinct().join(points.select("same", "node"), "same").select("node", F.col("vec_id").alias("query_id"))
    queries = stored(queries, "nnd-queries")
    pool = search(lists, codes, queries)
    pool = pool.unionByName(queries.select(F.col("node").alias("q"), "node").distinct())  # equal vectors under other ids
    x, y = points.select(F.col("node").alias("q"), F.col("vec").alias("x")), points.select("node", F.col("vec").alias("y"))
    scored = pool.join(x, "q").join(y, "node").select("q", "node", F.arrow_udf(_cosine, "double")("x", "y").alias("score"))
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "node")
    scored = scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= 2 * top + 1)
    found = queries.join(scored, queries["node"] == scored["q"]).select("query_id", scored["node"].alias("at"), "score")
    found = found.join(members.withColumnRenamed("node", "at"), "at").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
