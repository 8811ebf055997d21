r"""N-gram Jaccard join by chosen paths (5-word shingles, similarity 0.8 or more).

Texts with the same set of shingles are one node.  A node's set is embedded as
``COORDS`` min-hash coordinates.  In each run every node follows the paths it
shares with similar nodes: it picks coordinates by a hash of (run, path,
coordinate, value) with probability 1 / (``SHARE`` * COORDS), and each pick
leads into the bucket of that longer path.  Two nodes of similarity 0.8 agree
in about 0.8 * COORDS coordinates, so they meet in a bucket with a chance that
does not fall with the number of nodes; ``runs`` repeats this until the chance
to miss such a pair at the greatest depth is below 1 - ``RECALL``.

Buckets of at most ``SMALL`` nodes are compared all against all, by their
coordinates first.  Larger ones split further.  Near copies never split, so
they are joined to random members of their bucket first (a few runs give
provisional classes): a bucket whose nodes all share a class is done, and one with
at most ``FEW`` nodes outside a single class compares those with all, in blocks.
What is still large at ``DEPTH`` is compared in salted blocks of ``SMALL`` nodes, all
against all, so neither depth nor size loses a pair.

All this yields candidate classes.  Within them every pair's exact Jaccard
similarity over whole shingle sets is worked out in blocks of about ``BLOCK``
nodes, so links are exact and complete inside a candidate class, no task holds
a whole class, and only counts and spanning links leave a block.  The blocks'
work grows with the square of the number of *different* near copies in a
class (copies of a text are one node); no row is made for a pair.

Words are lower-cased runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``.  Defined
results: a text of fewer than five words, but not none, has one shingle of all
its words; a null text or one without words has no shingles and is alone in
its class; repeated rows are copies; class_id is the least doc_id of the class
(null ids are passed over); other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import ALNUM, LOWER, chunks, group_starts, mix, shingle_hashes, prepare, stored, whole_groups, word_hashes, words
from brisa.llm.components import components, spanning
from brisa.llm.phrase_index import digest

SHINGLE = 5
THRESHOLD = 0.8
COORDS = 64
SHARE = 0.7
DEPTH = 5
RECALL = 0.9999
FIRST_RUNS = 3
SMALL = 4096
#: Nodes outside the largest class up to which a large bucket is compared class against rest.
FEW = 64
BLOCK = 128
#: Candidate classes' texts are found by a broadcast of their digests up to this many, by a shuffled join beyond.
BROADCAST_ROWS = 1 << 20
#: Agreeing coordinates of a candidate pair: five standard deviations under 0.8 * COORDS.
AGREE = math.floor(COORDS * (THRESHOLD - 5 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / COORDS)))
_LOW48 = np.uint64((1 << 48) - 1)
_PICK = np.uint64(int((1 << 64) / (SHARE * COORDS)))
_FACTORS = mix(np.arange(1, COORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def runs(recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs needed so that a pair at the threshold meets at ``depth`` with the given probability."""
    meet = 1.0
    for _ in range(depth):
        meet = 1 - math.exp(-THRESHOLD / SHARE * meet)
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 48-bit shingle hashes of each text, ascending, and each text's first."""
    data = LOWER[data]
    starts, ends, first = words(data, offsets, ALNUM)
    h, at = shingle_hashes(word_hashes(data, starts, ends), first, k)
    row = np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(at))
    out, cut = [], [0]
    for lo in range(0, len(at) - 1, 1 << 16):  # the row number takes the upper 16 bits
        hi = min(lo + (1 << 16), len(at) - 1)
        part = slice(at[lo], at[hi])
        u = np.unique((row[part] - np.uint64(lo)) << np.uint64(48) | (h[part] & _LOW48))
        cut.extend(cut[-1] + np.searchsorted(u >> np.uint64(48), np.arange(1, hi - lo + 1, dtype=np.uint64)))
        out.append(u & _LOW48)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.array(cut)


def _nodes(docs: DataFrame) -> DataFrame:
    """doc_id, node (hash of the shingle set; null without words), digest, sketch (at the node's first row in a task)."""

    def embed(batches):
        seen: set[int] = set()
        for batch in batches:
            ids, digests = batch.column("doc_id"), batch.column("digest")
            for lo, hi, data, offsets in chunks(batch.column("text")):
                s, at = shingle_sets(data, offsets)
                has = np.diff(at) > 0
                heads = at[:-1][has]
                node = np.zeros(hi - lo, np.int64)
                sketch = np.zeros((int(has.sum()), COORDS), np.uint32)
                if len(heads):
                    node[has] = mix(np.add.reduceat(mix(s + np.uint64(1)), heads) + np.diff(at)[has].astype(np.uint64)).view(np.int64)
                    for j in range(COORDS):
                        sketch[:, j] = np.minimum.reduceat((s * _FACTORS[j] + _FACTORS[-1 - j]) >> np.uint64(32), heads)
                new = iter(sketch)
                out = []
                for x, ok in zip(node.tolist(), has.tolist()):
                    mine = next(new) if ok else None
                    out.append(mine.tobytes() if ok and x not in seen else None)
                    if ok and len(seen) < 1_000_000:
                        seen.add(x)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(node, mask=~has), digests.slice(lo, hi - lo), pa.array(out, pa.binary())],
                                                 ["doc_id", "node", "digest", "sketch"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", digest().alias("digest"), "text").mapInArrow(embed, f"doc_id {kind}, node bigint, digest binary, sketch binary")
    return stored(rows, "cpj-nodes")


def _picks(path: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, longer path) of the coordinates that each row's path chooses."""
    row, out = [], []
    for j in range(COORDS):
        h = mix(path ^ mix(sketch[:, j].astype(np.uint64) + (np.uint64(j + 1) << np.uint64(32))))
        hit = np.flatnonzero(h < _PICK)
        row.append(hit)
        out.append(mix(h[hit] + np.uint64(0x632BE59BD9B4E019)))
    return np.concatenate(row), np.concatenate(out)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDS)


def _first_level(sketches: DataFrame, n_runs: int) -> DataFrame:
    def go(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                node, sketch = part.column("node").to_numpy(), _matrix(part.column("sketch"))
                for r in range(n_runs):
                    row, path = _picks(np.full(len(node), mix(np.array([r + 1], np.uint64))[0]), sketch)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), r, np.int32)), pa.array(path.view(np.int64)), pa.array(node[row])], ["run", "path", "node"])

    return sketches.select("node", "sketch").mapInArrow(go, "run int, path bigint, node bigint")


def _next_level(rows: DataFrame, sketches: DataFrame) -> DataFrame:
    def go(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 8192):
                part = batch.slice(lo, 8192)
                node = part.column("node").to_numpy()
                row, path = _picks(part.column("path").to_numpy().view(np.uint64), _matrix(part.column("sketch")))
                yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(node[row])], ["path", "node"])

    return rows.select("path", "node").join(sketches, "node").select("path", "node", "sketch").mapInArrow(go, "path bigint, node bigint")


def _alike(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) whose coordinates agree often enough."""

    def agree(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array((_matrix(x) == _matrix(y)).sum(axis=1).astype(np.int32))

    side = lambda c: sketches.select(F.col("node").alias(c), F.col("sketch").alias("s" + c))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(F.arrow_udf(agree, "int")("sa", "sb") >= AGREE).select(pairs.columns)


def _dealt(rows: DataFrame, last: bool) -> DataFrame:
    """path, block, node, label of buckets to compare now: small ones whole, lopsided ones and the last level's in blocks."""
    zero = F.lit(0).cast("long")
    blocks = lambda n: F.ceil(n / F.lit(SMALL))
    lopsided = F.col("n") - F.col("c") <= FEW
    whole = rows.where(F.col("n") <= SMALL).select("path", zero.alias("block"), "node", "label")
    lop = rows.where((F.col("n") > SMALL) & lopsided)
    mine = F.col("label") == F.col("most")
    at = F.when(mine, F.array(F.pmod(F.xxhash64("node"), blocks(F.col("c"))))).otherwise(F.sequence(zero, blocks(F.col("c")) - 1))
    out = whole.unionByName(lop.select("path", F.explode(at).alias("block"), "node", "label"))
    if not last:
        return out
    wide = rows.where((F.col("n") > SMALL) & ~lopsided).withColumn("blocks", blocks(F.col("n")))
    wide = wide.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    return out.unionByName(wide.select("path", (F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).alias("block"), "node", "label"))


def _bucket_pairs(rows: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs of classes with nodes that share a block of a bucket and agree often enough.

    Nodes of a class are connected already, and only what connects the classes of a block matters, so a block
    gives fewer pairs than it has classes.
    """

    def compare(batches):
        for table in whole_groups(batches, "path", "block"):
            label = table.column("label").to_numpy()
            sketch = _matrix(table.column("sketch")).astype(np.uint8)  # the low byte tells coordinates apart well enough
            starts = group_starts(table.column("path").to_numpy(), table.column("block").to_numpy())
            run = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            live, found = np.arange(len(label)), []
            for d in range(1, len(label)):
                live = live[live + d < len(label)]
                live = live[run[live] == run[live + d]]
                if not len(live):
                    break
                i = live[label[live] != label[live + d]]
                i = i[(sketch[i] == sketch[i + d]).sum(axis=1) >= AGREE]
                found.append(np.stack([i, i + d]))
            if found:
                i, j = np.concatenate(found, axis=1)
                names, at = np.unique(label, return_inverse=True)
                a, b = spanning(len(names), at[i], at[j])
                yield pa.RecordBatch.from_arrays([pa.array(names[a]), pa.array(names[b])], ["a", "b"])

    full = rows.join(sketches, "node").select("path", "block", "label", "sketch")
    return full.repartition("path", "block").sortWithinPartitions("path", "block").mapInArrow(compare, "a bigint, b bigint")


def _and_end(batches):
    yield from batches
    yield None


def _shared(rows: DataFrame) -> DataFrame:
    """Rows of buckets with nodes of at least two classes, with the bucket's size n and its largest class (c nodes of ``most``)."""
    parts = rows.groupBy("path", "label").agg(F.count("*").alias("c"))
    buckets = parts.groupBy("path").agg(F.sum("c").alias("n"), F.count("*").alias("classes"), F.max(F.struct("c", "label")).alias("top"))
    return rows.join(buckets.where("classes > 1").select("path", "n", F.col("top.c").alias("c"), F.col("top.label").alias("most")), "path")


def _candidates(sketches: DataFrame) -> DataFrame:
    """Edges that connect every pair found by the runs."""
    first = stored(_first_level(sketches, runs()), "cpj-paths")
    buckets = first.groupBy("path").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("path", "node").alias("h"), "node")).alias("pivot"))
    met = stored(first.join(buckets.where("n > 1").select("path", F.col("pivot.node").alias("pivot")), "path"), "cpj-met")
    start = met.where(F.col("run") < FIRST_RUNS).where("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    edges = stored(_alike(start, sketches), "cpj-start")
    labels = components(edges)

    def labelled(rows):
        own = labels.select("node", F.col("label").alias("known"))
        return rows.join(own, "node", "left").select("path", "node", F.coalesce("known", "node").alias("label"))

    found = [edges]
    rows = met.select("path", "node")
    for level in range(1, DEPTH + 1):
        rows = stored(_shared(labelled(rows)), "cpj-level")
        found.append(_bucket_pairs(_dealt(rows, level == DEPTH), sketches))
        wide = rows.where((F.col("n") > SMALL) & (F.col("n") - F.col("c") > FEW))
        if level == DEPTH or wide.limit(1).count() == 0:
            break
        rows = _next_level(wide, sketches)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return stored(out.distinct(), "cpj-edges")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, shingles (48-bit hashes, six bytes each, ascending) of the wanted nodes (node, digest)."""

    def extract(batches):
        seen: set[int] = set()
        for batch in batches:
            nodes = batch.column("node").to_pylist()
            for lo, hi, data, offsets in chunks(batch.column("text")):
                s, at = shingle_sets(data, offsets)
                new = [i for i in range(hi - lo) if nodes[lo + i] not in seen and not seen.add(nodes[lo + i])]
                packed = np.ascontiguousarray(s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
                yield pa.RecordBatch.from_arrays([pa.array([nodes[lo + i] for i in new], pa.int64()),
                                                  pa.array([packed[at[i]:at[i + 1]].tobytes() for i in new], pa.binary())], ["node", "shingles"])

    texts = docs.select(digest().alias("digest"), "text").join(_small(wanted), "digest").select("node", "text")
    return texts.mapInArrow(extract, "node bigint, shingles binary").groupBy("node").agg(F.max("shingles").alias("shingles"))


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _similar(sets: list[np.ndarray], wide: int = 2048) -> np.ndarray:
    """Boolean matrix of the pairs with Jaccard similarity of at least THRESHOLD."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    items = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), size)
    _, item, count = np.unique(items, return_inverse=True, return_counts=True)
    keep = count[item] > 1
    rank = np.cumsum(count > 1) - 1
    col, row = rank[item[keep]], row[keep]
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    total = int(col[-1]) + 1 if len(col) else 0
    for lo in range(0, total, wide):
        a, b = np.searchsorted(col, [lo, lo + wide])
        m = np.zeros((len(sets), wide), np.float32)
        m[row[a:b], col[a:b] - lo] = 1
        both += m @ m.T
    both = both.astype(np.int64)
    union = size[:, None] + size[None, :] - both
    out = 5 * both >= 4 * union  # 0.8 in whole numbers
    np.fill_diagonal(out, False)
    return out


def _links(members: DataFrame) -> DataFrame:
    """From (label, node, copies, shingles, m): rows (a, b, n) - spanning links where b is not null, else a's linked documents in a block."""
    blocks = F.ceil(F.col("m") / BLOCK)
    mine = F.pmod(F.xxhash64("node"), blocks)
    spread = members.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    spread = spread.select("label", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", "node", "copies", "shingles")

    def one(rows: list) -> tuple[list, list]:
        x, y = rows[0][1], rows[0][2]
        node, copies = [r[4] for r in rows], np.array([r[5] for r in rows])
        alike = _similar([_unpack(r[6]) for r in rows])
        inner = np.zeros_like(alike)
        if x != y:  # links inside a part are told by that part's own block
            part = np.array([r[3] for r in rows])
            inner = alike & (part[:, None] == part[None, :])
            alike &= ~inner
        counts = [(node[i], None, int(alike[i] @ copies)) for i in np.flatnonzero(alike.any(axis=1))]
        parent = list(range(len(rows)))

        def root(i):
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            return i

        tree = []
        for links, told in ((inner, True), (alike, False)):
            for i, j in zip(*(v.tolist() for v in np.nonzero(np.triu(links)))):
                a, b = root(i), root(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    if not told:
                        tree.append((node[i], node[j], 0))
        return counts, tree

    def go(batches):
        held, key = [], None
        for batch in _and_end(batches):
            out = []
            cols = [batch.column(c).to_pylist() for c in ("label", "x", "y", "mine", "node", "copies", "shingles")] if batch is not None else [[]] * 7
            for r in [*zip(*cols), None] if batch is None else zip(*cols):
                if r is None or r[:3] != key:
                    if len(held) > 1:
                        counts, tree = one(held)
                        out += counts + tree
                    held, key = [], r[:3] if r else None
                if r:
                    held.append(r)
            yield pa.RecordBatch.from_pylist([dict(zip("abn", t)) for t in out], pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())]))

    keys = ["label", "x", "y"]
    return spread.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(go, "a bigint, b bigint, n bigint")


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has few enough rows; else Spark's shuffled join takes it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, node, digest of every document; known: node, copies, least, label, linked)."""
    prepare(docs.sparkSession)
    rows = _nodes(docs)
    own = stored(rows.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("least"), F.max("digest").alias("digest")), "cpj-own")
    sketches = stored(rows.where(F.col("sketch").isNotNull()).groupBy("node").agg(F.max("sketch").alias("sketch")), "cpj-sketches")
    labels = components(_candidates(sketches))
    sizes = labels.groupBy("label").agg(F.count("*").alias("m"))
    wanted = stored(labels.join(sizes, "label").join(own, "node"), "cpj-wanted")
    sets = stored(_sets(docs, wanted.select("node", "digest")), "cpj-sets")
    links = stored(_links(wanted.select("label", "node", "copies", "m").join(sets, "node")), "cpj-links")
    classes = components(links.where(F.col("b").isNotNull()).select("a", "b"))
    counts = links.where(F.col("b").isNull()).groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    known = own.join(classes, "node", "left").join(counts, "node", "left").select(
        "node", "copies", "least", F.coalesce("label", "node").alias("label"), F.coalesce("linked", F.lit(0)).alias("linked"))
    return rows, stored(known, "cpj-known")


def join(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links, n_copies for every row of ``docs``.

    n_links counts the other documents with similarity of at least 0.8, copies included; n_copies
    those with the same shingle set.
    """
    rows, known = _classes(docs)
    ids = known.groupBy("label").agg(F.min("least").alias("class_id"))
    known = known.join(ids, "label").select("node", "class_id", (F.col("linked") + F.col("copies") - 1).alias("n_links"), (F.col("copies") - 1).alias("n_copies"))
    full = rows.where(F.col("node").isNotNull()).select("doc_id", "node").join(known, "node").select("doc_id", "class_id", "n_links", "n_copies")
    zero = F.lit(0).cast("long")
    bare = rows.where(F.col("node").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), zero.alias("n_links"), zero.alias("n_copies"))
    return full.unionByName(bare)


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each class: the least doc_id (nulls last).

    Only the ids and digests of rows to drop are joined to the texts.  Of rows that repeat both id and
    text of the kept document one stays.  Texts without words are all kept.
    """
    rows, known = _classes(docs)
    full = rows.where(F.col("node").isNotNull()).select("doc_id", "node", "digest").join(known.select("node", "label"), "node")
    key = F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "digest")
    groups = stored(full.groupBy("label", "doc_id", "digest").agg(F.count("*").alias("n")), "cpj-groups")
    best = groups.groupBy("label").agg(F.min(key).alias("best"))
    marked = stored(groups.join(best, "label").select("doc_id", "digest", "n", key.eqNullSafe(F.col("best")).alias("stays")).where("NOT stays OR n > 1"), "cpj-drop")
    named = docs.withColumn("__digest", digest())
    same = lambda side: (named["__digest"] == side["digest"]) & named["doc_id"].eqNullSafe(side["doc_id"])
    drop, repeated = _small(marked.select("doc_id", "digest")), marked.where("stays").select("doc_id", "digest")
    once = named.join(drop, same(drop), "left_anti")
    if repeated.limit(1).count() == 0:
        return once.select(docs.columns)
    again = named.join(F.broadcast(repeated) if repeated.count() <= BROADCAST_ROWS else repeated, same(repeated), "left_semi").dropDuplicates(["__digest", "doc_id"])
    return once.unionByName(again).select(docs.columns)
