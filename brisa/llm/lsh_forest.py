r"""Near duplicates by an LSH forest (2-word shingles, Jaccard similarity 0.8 or more).

Texts with the same set of shingles are one node.  A node has ``COORDS``
min-hash coordinates; each tree of the forest is an order of them, and sorts
the nodes by the coordinates in that order.  Nodes that agree in a tree's first
``depth`` coordinates are a *region* of it.

1. Neighbours.  In every tree's sorted order a node and its successor share the
   longest prefix.  Each class of nodes takes its successor of the longest
   common prefix, the pair is confirmed on whole sets, and classes grow for a
   few turns: groups of near copies, however large, become one class here for
   about one confirmed pair a node.
2. Regions.  Two nodes at the threshold share a region of some tree with a
   chance of 1 - (1 - 0.8 ** depth) ** trees, over 0.9999 for every step of
   ``FOREST``.  A region whose nodes are one class is done.  Else its nodes of
   different classes are compared by their coordinates: directly up to ``WIDE``
   nodes; in blocks if a single class holds almost all.  Wider regions are dense,
   and their nodes go deeper: the next step of ``FOREST`` has longer prefixes and
   as many more trees as the chance needs.  What is wide at the last step is
   compared in salted blocks, all against all, so no depth or size drops a pair.
3. Confirmation.  The classes that step 2 connects are compared on whole sets,
   in blocks of ``BLOCK`` nodes, pairs of one class excepted.  Only spanning links
   leave a block.

Links are exact: 100 * intersection >= 80 * union on whole shingle sets.  Words
are lower-cased runs of ``[^\x20\x09-\x0D]`` (A-Z only).  Work is dealt by
(tree, prefix) or block, and a group of copies costs one row a task.

Defined results: a text of one word has one shingle, that word; a null text or
one without words has no shingles, is alone and kept; component_id is the least
doc_id of the component (null ids are passed over, and are kept only where
there is no other); repeated rows are copies, and each row with the least id
is kept; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import LOWER, SPACED, chunks, group_starts, mix, prepare, shingle_hashes, stored, whole_groups, word_hashes, words
from brisa.llm.components import components, spanning
from brisa.llm.phrase_index import digest

SHINGLE = 2
COORDS = 128
#: (depth, trees) of the steps.
FOREST = ((5, 32), (8, 72), (12, 176))
#: Coordinates after the prefix by which a tree sorts on.
TAIL = 8
#: Turns of confirmed neighbours, and the common prefix beyond the region's that makes a neighbour worth it.
TURNS, LCP = 2, 2
WIDE = 2048
#: Nodes outside the largest class up to which a wide region is compared class against rest.
FEW = 64
BLOCK = 256
BROADCAST_ROWS = 1 << 20
#: Agreeing coordinates of a candidate: four standard deviations under 0.8 * COORDS.
AGREE = math.floor(0.8 * COORDS - 4 * math.sqrt(0.8 * 0.2 * COORDS))
_LOW48 = np.uint64((1 << 48) - 1)
_FACTORS = mix(np.arange(1, 2 * COORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def orders(step: int) -> np.ndarray:
    """(trees, depth + TAIL) coordinate numbers; shuffled decks are dealt out, so a tree's prefixes overlap as little as can be."""
    depth, trees = FOREST[step]
    rng = np.random.default_rng([step, 13])
    out = []
    deck: list[int] = []
    for _ in range(trees):
        if len(deck) < depth:
            deck = rng.permutation(COORDS).tolist()
        head, deck = deck[:depth], deck[depth:]
        rest = rng.permutation(np.setdiff1d(np.arange(COORDS), head))[:TAIL]
        out.append([*head, *rest])
    return np.array(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and each text's first.

    The upper bits hold no row number in a chunk of one text, and few where texts are short, so hashes
    keep 48 bits at least; all are cut to 48 bits after the distinct ones are counted.
    """
    data = LOWER[data]
    starts, ends, first = words(data, offsets, SPACED)
    h, at = shingle_hashes(word_hashes(data, starts, ends), first, SHINGLE)
    n = len(at) - 1
    row = np.repeat(np.arange(n, dtype=np.uint64), np.diff(at))
    out, cut = [], [0]
    for lo in range(0, n, 1 << 16):
        hi = min(lo + (1 << 16), n)
        bits = np.uint64(max(hi - lo - 1, 0).bit_length())
        part = slice(at[lo], at[hi])
        if bits:
            u = np.unique((row[part] - np.uint64(lo)) << (np.uint64(64) - bits) | (h[part] >> bits))
            edge = np.searchsorted(u >> (np.uint64(64) - bits), np.arange(1, hi - lo, dtype=np.uint64))
            u = u << bits
        else:
            u, edge = np.unique(h[part]), np.zeros(0, np.int64)
        cut.extend(cut[-1] + np.append(edge, len(u)))
        out.append(u >> np.uint64(16))
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.array(cut)


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    raw = np.ascontiguousarray(rows)
    width = raw.shape[1] * raw.itemsize
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(np.arange(0, (len(raw) + 1) * width, width, dtype=np.int32)[:len(raw) + 1].tobytes()), pa.py_buffer(raw.tobytes())])


def _matrix(column: pa.Array, kind=np.uint32) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, shape (128-bit hash of the set; null without words), n_shingles, digest, sketch (at a shape's first row in a task)."""

    def embed(batches):
        seen: set[bytes] = set()
        for batch in batches:
            ids, digests = batch.column("doc_id"), batch.column("digest")
            for lo, hi, data, offsets in chunks(batch.column("text")):
                s, at = shingle_sets(data, offsets)
                size = np.diff(at)
                has = size > 0
                heads = at[:-1][has]
                shape: list = [None] * (hi - lo)
                sketch: list = [None] * (hi - lo)
                if len(heads):
                    full = np.flatnonzero(has)
                    two = np.stack([mix(np.add.reduceat(mix(s + np.uint64(k)), heads) + size[has].astype(np.uint64)) for k in (1, 1 << 60)], axis=1)
                    names = [r.tobytes() for r in two]
                    low = np.zeros((len(heads), COORDS), np.uint32)
                    for j in range(COORDS):
                        low[:, j] = np.minimum.reduceat((s * _FACTORS[j] + _FACTORS[-1 - j]) >> np.uint64(32), heads)
                    for i, name, mine in zip(full.tolist(), names, low):
                        shape[i] = name
                        if name not in seen:
                            sketch[i] = mine.tobytes()
                            if len(seen) < 500_000:
                                seen.add(name)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(shape, pa.binary()), pa.array(size.astype(np.int64)), digests.slice(lo, hi - lo), pa.array(sketch, pa.binary())],
                                                 ["doc_id", "shape", "n_shingles", "digest", "sketch"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", digest().alias("digest"), "text").mapInArrow(embed, f"doc_id {kind}, shape binary, n_shingles bigint, digest binary, sketch binary")
    return stored(rows, "forest-rows")


def _trees(sketches: DataFrame, step: int) -> DataFrame:
    """key (tree and prefix), tail (the next coordinates), node for every tree."""
    order, depth = orders(step), FOREST[step][0]

    def go(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                sketch = _matrix(part.column("sketch"))
                for t, coords in enumerate(order):
                    key = np.full(len(sketch), np.uint64((step << 32) + t + 1))
                    for j in coords[:depth]:
                        key = mix(key * np.uint64(0x9FB21C651E98DF25) + sketch[:, j])
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), _binary(sketch[:, coords[depth:]].astype(np.uint16)), part.column("node")], ["key", "tail", "node"])

    return sketches.select("node", "sketch").mapInArrow(go, "key bigint, tail binary, node bigint")


def _regions(sketches: DataFrame, step: int) -> DataFrame:
    """key, node, next (its successor in the region), lcp (coordinates shared with it beyond the prefix) of nodes that are not alone.

    Ranges of the sorted order go to tasks, so a large region is spread over several.  At the edges of a
    range a row is kept without being looked at, and the successor there is not known.
    """

    def go(batches):
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, node, tail = batch.column("key").to_numpy(), batch.column("node").to_numpy(), _matrix(batch.column("tail"), np.uint16)
            if before is not None:
                key, node, tail = np.append(before[0], key), np.append(before[1], node), np.concatenate([before[2], tail])
            same = key[1:] == key[:-1]
            lcp = np.cumprod(tail[1:] == tail[:-1], axis=1).sum(axis=1).astype(np.int32)
            keep = np.zeros(len(key), bool)
            keep[:-1] |= same
            keep[1:] |= same
            keep[0] = True  # its predecessor is not known here
            keep[-1] = False
            at = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays([pa.array(key[at]), pa.array(node[at]), pa.array(node[at + 1], mask=~same[at]), pa.array(lcp[at], mask=~same[at])], ["key", "node", "next", "lcp"])
            before = key[-1:], node[-1:], tail[-1:]
        if before is not None:
            yield pa.RecordBatch.from_arrays([pa.array(before[0]), pa.array(before[1]), pa.array([None], pa.int64()), pa.array([None], pa.int32())], ["key", "node", "next", "lcp"])

    rows = stored(_trees(sketches, step), "forest-trees")
    return stored(rows.repartitionByRange("key", "tail", "node").sortWithinPartitions("key", "tail", "node").mapInArrow(go, "key bigint, node bigint, next bigint, lcp int"), "forest-regions")


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has few enough rows; else Spark's shuffled join takes it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, shingles (six bytes each, ascending) for nodes (node, digest)."""

    def extract(batches):
        seen: set[int] = set()
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            for lo, hi, data, offsets in chunks(batch.column("text")):
                s, at = shingle_sets(data, offsets)
                new = [i for i in range(hi - lo) if nodes[lo + i] not in seen and not seen.add(nodes[lo + i])]
                packed = np.ascontiguousarray(s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
                yield pa.RecordBatch.from_arrays([pa.array([nodes[lo + i] for i in new], pa.int64()), pa.array([packed[at[i]:at[i + 1]].tobytes() for i in new], pa.binary())], ["node", "shingles"])

    texts = docs.select(digest().alias("digest"), "text").join(_small(nodes), "digest").select("node", "text")
    return stored(texts.mapInArrow(extract, "node bigint, shingles binary").groupBy("node").agg(F.max("shingles").alias("shingles")), "forest-sets")


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _linked(both, a, b):
    """100 * intersection >= 80 * union, in whole numbers."""
    return 5 * both >= 4 * (a + b - both)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""

    def alike(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for p, q in zip(x, y):
            p, q = _unpack(p.as_py()), _unpack(q.as_py())
            near = 5 * min(len(p), len(q)) >= 4 * max(len(p), len(q))
            out.append(bool(near and _linked(len(np.intersect1d(p, q, assume_unique=True)), len(p), len(q))))
        return pa.array(out)

    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias("s" + c))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(F.arrow_udf(alike, "boolean")("sa", "sb")).select("a", "b")


def _labelled(rows: DataFrame, labels: DataFrame | None, node: str, name: str) -> DataFrame:
    if labels is None:
        return rows.withColumn(name, F.col(node))
    own = labels.select(F.col("node").alias(node), F.col("label").alias("__l"))
    return rows.join(own, node, "left").withColumn(name, F.coalesce("__l", node)).drop("__l")


def _neighbours(docs: DataFrame, regions: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """Classes (node, label) after the turns of confirmed neighbours."""
    near = regions.where(F.col("next").isNotNull() & (F.col("lcp") >= LCP)).groupBy(F.least("node", "next").alias("a"), F.greatest("node", "next").alias("b")).agg(F.max("lcp").alias("lcp"))
    near = stored(near, "forest-near")
    wanted = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = _sets(docs, nodes.join(wanted, "node").select("node", "digest"))
    labels = None
    for _ in range(TURNS):
        apart = _labelled(_labelled(near, labels, "a", "la"), labels, "b", "lb").where("la <> lb")
        best = F.max(F.struct("lcp", F.xxhash64("a", "b").alias("h"), "a", "b")).alias("best")
        both = apart.unionByName(apart.select("a", "b", "lcp", F.col("lb").alias("la"), F.col("la").alias("lb")))
        picks = both.groupBy("la").agg(best).select("best.a", "best.b").distinct()
        found = stored(_confirmed(picks, sets), "forest-links")
        if found.limit(1).count() == 0:
            break
        labels = _classes(labels, found)
    return labels


def _classes(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """node, label after more links; known classes enter as stars, so paths are short."""
    return components(links if labels is None else links.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))))


def _union(frames: list) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more)
    return out


def _compare(rows: DataFrame, sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs (a, b) of classes with nodes that share ``keys`` and agree often enough; a spanning set for each group of a task."""

    def compare(batches):
        for table in whole_groups(batches, *keys):
            label, sketch = table.column("label").to_numpy(), _matrix(table.column("small"), np.uint8)
            cols = [table.column(k).to_numpy() for k in keys]
            starts = group_starts(*cols)
            run = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            for lo in range(0, len(starts) - 1, 4096):  # groups at a time
                s, e = starts[lo], starts[min(lo + 4096, len(starts) - 1)]
                found = []
                live = np.arange(s, e)
                d = 0
                while len(live):
                    d += 1
                    live = live[live + d < e]
                    live = live[run[live] == run[live + d]]
                    for part in np.array_split(live, max(1, len(live) // 65536)):
                        part = part[label[part] != label[part + d]]
                        hit = part[(sketch[part] == sketch[part + d]).sum(axis=1) >= AGREE]
                        if len(hit):
                            found.append(np.stack([hit, hit + d]))
                if found:
                    i, j = np.concatenate(found, axis=1)
                    names, at = np.unique(label[s:e], return_inverse=True)
                    a, b = spanning(len(names), at[i - s], at[j - s])
                    yield pa.RecordBatch.from_arrays([pa.array(names[a]), pa.array(names[b])], ["a", "b"])

    full = rows.join(sketches.select("node", "small"), "node").select(*keys, "label", "small")
    return full.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a bigint, b bigint")


def _blocks(n) -> F.Column:
    return F.greatest(F.ceil(n / F.lit(WIDE)), F.lit(1).cast("long"))


def _step(regions: DataFrame, sketches: DataFrame, labels: DataFrame | None, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """Candidate pairs of classes, and the nodes of regions to look at more deeply."""
    rows = stored(_labelled(regions.select("key", "node"), labels, "node", "label"), "forest-labelled")
    parts = rows.groupBy("key", "label").agg(F.count("*").alias("c"))
    sizes = parts.groupBy("key").agg(F.sum("c").alias("n"), F.count("*").alias("classes"), F.max(F.struct("c", "label")).alias("top")).where("classes > 1")
    sizes = sizes.select("key", "n", F.col("top.c").alias("c"), F.col("top.label").alias("most"),
                         F.when(F.col("n") <= WIDE, "direct").when(F.col("n") - F.col("top.c") <= FEW, "lopsided").otherwise("wide").alias("kind"))
    open_ = stored(rows.join(sizes, "key"), "forest-open")
    zero = F.lit(0).cast("long")
    direct = open_.where("kind = 'direct'").select("key", zero.alias("block"), "node", "label")
    lop, mine = open_.where("kind = 'lopsided'"), F.col("label") == F.col("most")
    dealt = F.when(mine, F.array(F.pmod(F.xxhash64("node"), _blocks(F.col("c"))))).otherwise(F.sequence(zero, _blocks(F.col("c")) - 1))
    direct = direct.unionByName(lop.select("key", F.explode(dealt).alias("block"), "node", "label"))
    found = _compare(direct, sketches, ["key", "block"])
    wide = open_.where("kind = 'wide'")
    if wide.limit(1).count() == 0:
        return found, None
    if not last:
        return found, wide.select("node").distinct()
    blocks = _blocks(F.col("n"))
    own = wide.withColumn("own", F.pmod(F.xxhash64("node"), blocks)).withColumn("other", F.explode(F.sequence(zero, blocks - 1)))
    salted = own.select("key", (F.least("own", "other") * blocks + F.greatest("own", "other")).alias("block"), "node", "label")
    return found.unionByName(_compare(salted, sketches, ["key", "block"])), None


def _confirm_blocks(docs: DataFrame, nodes: DataFrame, labels: DataFrame | None, candidates: DataFrame) -> DataFrame:
    """Spanning links between classes that ``candidates`` (pairs of classes) connect, on whole sets."""
    groups = components(candidates).select(F.col("node").alias("label"), F.col("label").alias("grp"))
    members = stored(_labelled(nodes.select("node", "digest"), labels, "node", "label").join(groups, "label"), "forest-members")
    sets = _sets(docs, members.select("node", "digest"))
    sizes = members.groupBy("grp", "label").agg(F.count("*").alias("c"))
    large = F.col("c") > BLOCK
    few = sizes.where(~large).groupBy("grp").agg(F.sum("c").alias("rest"))
    spread = F.greatest(F.ceil(F.coalesce("rest", F.lit(0)) / F.lit(BLOCK)), F.lit(1).cast("long"))
    # a large class has blocks of its own, the small ones share blocks; equal owners are never compared
    rows = members.join(sizes, ["grp", "label"]).join(few, "grp", "left").select(
        "grp", "label", "node", F.when(large, F.col("label")).alias("owner"),
        F.when(large, F.pmod(F.xxhash64("node"), F.ceil(F.col("c") / F.lit(BLOCK)))).otherwise(F.pmod(F.xxhash64("label"), spread)).alias("at"))
    rows = rows.withColumn("block", F.xxhash64(F.coalesce("owner", F.lit(-1).cast("long")), F.col("owner").isNull(), "at"))
    blocks = rows.select("grp", "owner", "block").distinct()
    other = blocks.select("grp", F.col("owner").alias("owner2"), F.col("block").alias("block2"))
    jobs = blocks.join(other, "grp").where("block <= block2 AND NOT (owner <=> owner2 AND owner IS NOT NULL)")
    tasks = jobs.select("grp", F.explode(F.array_distinct(F.array("block", "block2"))).alias("block"), F.col("block").alias("x"), F.col("block2").alias("y"))

    def confirm(batches):
        for table in whole_groups(batches, "grp", "x", "y"):
            label, node, raw = table.column("label").to_numpy(), table.column("node").to_numpy(), table.column("shingles").to_pylist()
            starts = group_starts(*(table.column(k).to_numpy() for k in ("grp", "x", "y")))
            for s, e in zip(starts, starts[1:]):
                if e - s < 2:
                    continue
                alike = _similar([_unpack(r) for r in raw[s:e]])
                i, j = np.nonzero(np.triu(alike & (label[s:e, None] != label[None, s:e])))
                names, at = np.unique(label[s:e], return_inverse=True)
                if len(i):
                    first = np.zeros(len(names), np.int64)
                    first[at[::-1]] = node[s:e][::-1]
                    a, b = spanning(len(names), at[i], at[j])
                    yield pa.RecordBatch.from_arrays([pa.array(first[a]), pa.array(first[b])], ["a", "b"])

    full = rows.join(tasks, ["grp", "block"]).join(sets, "node").select("grp", "x", "y", "label", "node", "shingles")
    return stored(full.repartition("grp", "x", "y").sortWithinPartitions("grp", "x", "y").mapInArrow(confirm, "a bigint, b bigint"), "forest-confirmed")


def _similar(sets: list[np.ndarray], wide: int = 4096) -> np.ndarray:
    """Boolean matrix of the pairs of sets that are linked, from products of their incidence, ``wide`` shared shingles at a time."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    row = np.repeat(np.arange(len(sets)), size)
    _, item, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    rank = np.cumsum(shared) - 1
    keep = shared[item]
    col, row = rank[item[keep]], row[keep]
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    both = np.zeros((len(sets), len(sets)))
    for lo in range(0, int(shared.sum()), wide):
        a, b = np.searchsorted(col, [lo, lo + wide])
        m = np.zeros((len(sets), wide), np.float32)
        m[row[a:b], col[a:b] - lo] = 1
        both += m @ m.T
    out = _linked(both.astype(np.int64), size[:, None], size[None, :])
    np.fill_diagonal(out, False)
    return out


def cluster(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    prepare(docs.sparkSession)
    rows = _rows(docs)
    own = rows.where(F.col("shape").isNotNull()).groupBy("shape").agg(F.min("doc_id").alias("least"), F.max("digest").alias("digest"), F.max("sketch").alias("sketch"))
    nodes = stored(own.withColumn("node", F.monotonically_increasing_id()), "forest-nodes")
    sketches = stored(_narrow(nodes), "forest-sketches")
    regions = _regions(sketches, 0)
    labels = _neighbours(docs, regions, nodes)
    found = []
    for step in range(len(FOREST)):
        pairs, deeper = _step(regions, sketches, labels, step == len(FOREST) - 1)
        found.append(stored(pairs.distinct(), "forest-candidates"))
        if deeper is None:
            break
        regions = _regions(sketches.join(deeper, "node", "left_semi"), step + 1)
    candidates = _union(found)
    if candidates.limit(1).count():
        labels = _classes(labels, _confirm_blocks(docs, nodes, labels, candidates))
    known = _labelled(nodes.select("node", "shape", "least"), labels, "node", "label")
    ids = known.groupBy("label").agg(F.min("least").alias("component_id"))
    known = known.join(ids, "label").select("shape", "component_id")
    full = rows.where(F.col("shape").isNotNull()).select("doc_id", "n_shingles", "shape").join(known, "shape").select("doc_id", "n_shingles", "component_id")
    bare = rows.where(F.col("shape").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.unionByName(bare).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _narrow(nodes: DataFrame) -> DataFrame:
    """node, sketch, small (the low byte of every coordinate, for comparing)."""

    def cut(batches):
        for batch in batches:
            sketch = _matrix(batch.column("sketch"))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("sketch"), _binary((sketch & np.uint32(255)).astype(np.uint8))], ["node", "sketch", "small"])

    return nodes.select("node", "sketch").mapInArrow(cut, "node bigint, sketch binary, small binary")
