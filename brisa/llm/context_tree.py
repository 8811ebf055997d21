"""Language-model scoring by context-tree weighting over bytes.

A text is the byte string of its lower-cased words, one space between them and
a line feed as the end; the contexts at its start are line feeds.  A byte is
coded as eight binary decisions.  Each decision node has a context tree over
the previous 0 .. ``DEPTH`` bytes; every tree node has the Krichevsky-Trofimov
estimate of its counts, and depths are mixed by their weights

    P_w(s) = 1/2 P_kt(s) + 1/2 prod P_w(children of s)      (P_kt at DEPTH).

Training counts (context, next byte) pairs of all training texts, combined in
each task before the shuffle; what is gathered grows with the corpus.  Trees
are worked out bottom-up where the counts lie: partitions by the two newest
context bytes hold whole subtrees of depths 2 to ``DEPTH``, then by one byte,
and only the 255 nodes of depth 0 and those of depth 1 (fixed by the alphabet)
meet on the driver.

Scoring uses every tree node.  All distinct (context, next byte) pairs of the
texts to score go through the same partitions (with a count of 0 if training
has none), where their decisions are mixed over depths ``DEPTH`` to 2; depths 1
and 0 are broadcast and complete them.  Costs of the ``HEAD_GRAMS`` most
frequent pairs are broadcast, all others go through a join on the pair, so the
result does not depend on that number.  A context that training never had is
scored by its longest suffix that it had.  Probabilities of the 256 next bytes
add up to 1 in every context.

The base score needs the training count of every token of every text.  Counts
of the ``HEAD`` most frequent tokens are broadcast; all other tokens go through
a join on the token, so vocabularies of any size are whole.

Defined results: a null or empty text has one token, the end; null ids count
as the empty text in the fold and stay null; with no training rows n_known is
0, the base is that of one unseen token in a vocabulary of none, and every
byte costs 8 bits; repeated rows are scored each; other columns are not looked
at.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import LOWER, SPACED, chunks, group_starts, mix, prepare, stored, words

DEPTH = 5
HEAD_GRAMS = 1 << 21
HEAD = 100_000
END = 10
_HALF = math.log(0.5)
_FLUSH = 1 << 20
_SUBTREES = 1 << 16
_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)


def streams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte strings of a chunk of texts, one after another, and the start of each (one more entry at the end)."""
    data = LOWER[data]
    starts, ends, first = words(data, offsets, SPACED)
    size = ends - starts
    n_words = np.diff(first)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    bare = np.cumsum(n_words == 0)
    at = np.concatenate([[0], np.cumsum(size + 1)])[:-1] + bare[doc]
    ends_at = np.concatenate([[0], np.cumsum(size + 1)])[first[1:]] + bare
    out = np.full(ends_at[-1] if len(ends_at) else 0, 32, np.uint8)
    inside = np.flatnonzero(SPACED[data])
    out[inside + np.repeat(at - starts, size)] = data[inside]
    out[ends_at - 1] = END
    return out, np.concatenate([[0], ends_at])


def grams(out: np.ndarray, at: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """For every byte: the ``depth`` bytes before it (newest lowest) and the byte itself, as one number."""
    key = out.astype(np.uint64)
    sizes = np.diff(at)
    for j in range(1, depth + 1):
        before = np.empty_like(out)
        before[:j] = END
        before[j:] = out[:-j]
        for t in range(j):
            before[at[:-1][sizes > t] + t] = END
        key |= before.astype(np.uint64) << np.uint64(8 * j)
    return key


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov block probability of a zeros and b ones."""
    out = _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1.0) - math.log(math.pi)
    return np.where(a + b > 0, out, 0.0)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after shifting the argument up by 8."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5) - shift


def leaves(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Deepest tree nodes of (context, byte) counts: node (context << 8 | decision), zeros, ones; the node of each pair's 8 decisions."""
    byte, context = key & np.uint64(255), key >> np.uint64(8) << np.uint64(8)
    code = np.concatenate([context | np.uint64(1 << t) | (byte >> np.uint64(8 - t)) for t in range(8)])
    bit = _decisions(byte).ravel()
    code, inv = np.unique(code, return_inverse=True)
    n = np.tile(n, 8)
    return code, np.bincount(inv, n * (1 - bit), minlength=len(code)), np.bincount(inv, n * bit, minlength=len(code)), inv.reshape(8, -1)


def _decisions(byte: np.ndarray) -> np.ndarray:
    """The eight decisions (rows) of each byte."""
    return np.stack([(byte >> np.uint64(7 - t)) & np.uint64(1) for t in range(8)]).astype(np.int64)


def parents(code: np.ndarray, zeros: np.ndarray, ones: np.ndarray, log_w: np.ndarray, depth: int):
    """Nodes of contexts one byte shorter (``depth`` bytes): node, zeros, ones, log P_w, weight of stopping there; the parent of each node."""
    up = code & np.uint64((1 << (8 * depth + 8)) - 1)
    up, inv = np.unique(up, return_inverse=True)
    a, b, below = (np.bincount(inv, x, minlength=len(up)) for x in (zeros, ones, log_w))
    stop = _HALF + _log_kt(a, b)
    total = np.logaddexp(stop, _HALF + below)
    return up, a, b, total, np.exp(stop - total), inv


def _one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov estimate of a one; NaN for a node that training never visited."""
    return np.where(zeros + ones > 0, (ones + 0.5) / (zeros + ones + 1), np.nan)


def _mixed(here: np.ndarray, stop: np.ndarray, deeper: np.ndarray) -> np.ndarray:
    """Probability at a depth from its own estimate and that of the depths below (NaN: not visited)."""
    return np.where(np.isnan(here), deeper, np.where(np.isnan(deeper), here, stop * here + (1 - stop) * deeper))


_NODE = "code bigint, zeros double, ones double, log_w double"
_DEEP = f"gram bigint, n bigint, chances binary, {_NODE}"


def _nodes(code, zeros, ones, log_w) -> dict:
    return {"code": pa.array(code.view(np.int64)), "zeros": pa.array(zeros), "ones": pa.array(ones), "log_w": pa.array(log_w)}


def _columns(batches, *names):
    parts = [[b.column(c).to_numpy(zero_copy_only=False) for c in names] for b in batches]
    return [np.concatenate(x) if parts else np.zeros(0) for x in (zip(*parts) if parts else [()] * len(names))]


def _pairs(texts: DataFrame, depth: int) -> DataFrame:
    """gram, n: how often each byte follows each context, summed up within tasks."""

    def go(batches):
        held, size = [], 0

        def merged():
            key, inv = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return key, np.bincount(inv, np.concatenate([c for _, c in held])).astype(np.int64)

        def rows(key, n):
            for lo in range(0, len(key), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(key[lo:lo + (1 << 18)].view(np.int64)), pa.array(n[lo:lo + (1 << 18)])], ["gram", "n"])

        for batch in batches:
            for _, _, data, offsets in chunks(batch.column("text"), 1 << 20):
                held.append(np.unique(grams(*streams(data, offsets), depth), return_counts=True))
                size += len(held[-1][0])
                if size > _FLUSH:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > _FLUSH // 2:
                        yield from rows(*held[0])
                        held, size = [], 0
        if held:
            yield from rows(*merged())

    return texts.select("text").mapInArrow(go, "gram bigint, n bigint")


def count_grams(texts: DataFrame, depth: int = DEPTH, asked: DataFrame | None = None) -> DataFrame:
    """gram, n: how often each byte follows each context, over all texts; grams that only the texts ``asked`` have count 0."""
    found = _pairs(texts, depth)
    if asked is not None:
        found = found.unionByName(_pairs(asked, depth).withColumn("n", F.lit(0).cast("long")))
    return found.groupBy("gram").agg(F.sum("n").alias("n"))


def _subtrees(batches):
    """(gram, n) of whole subtrees of depth 2, at least ``_SUBTREES`` grams at a time, from batches sorted by the two newest context bytes."""
    held, size, need = [], 0, _SUBTREES
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < need:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        newest = table.column("gram").to_numpy() >> 8 & 0xFFFF
        cut = int(np.argmax(newest == newest[-1]))  # sorted: the last subtree begins at its first row
        if cut:
            yield _columns([table.slice(0, cut)], "gram", "n")
        held = table.slice(cut).to_batches()
        size -= cut
        need = max(_SUBTREES, 2 * size)
    if size:
        yield _columns(held, "gram", "n")


def gram_bits(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """gram, n, bits (log2 P(byte | context) by the tree of all counts) of every row of the table of gram counts."""
    spark = counts.sparkSession

    def deep(batches):
        for key, n in _subtrees(batches):
            key = key.astype(np.int64).view(np.uint64)
            code, a, b, at = leaves(key, n.astype(np.float64))
            w, one, up = _log_kt(a, b), _one(a, b), np.arange(len(code))
            for d in range(depth - 1, 1, -1):
                code, a, b, w, stop, to = parents(code, a, b, w, d)
                up = to[up]
                one = _mixed(_one(a, b)[up], stop[up], one)
            p = np.where(_decisions(key & np.uint64(255)) == 1, one[at], 1 - one[at]).T.astype("<f4")
            raw = pa.py_buffer(np.ascontiguousarray(p))
            chances = pa.Array.from_buffers(pa.binary(), len(key), [None, pa.py_buffer(np.arange(0, 32 * len(key) + 1, 32, dtype=np.int32)), raw])
            yield from _padded({"gram": pa.array(key.view(np.int64)), "n": pa.array(n.astype(np.int64)), "chances": chances})
            seen = a + b > 0
            yield from _padded(_nodes(code[seen], a[seen], b[seen], w[seen]))

    def _padded(have):
        size = len(next(iter(have.values())))
        kinds = {"gram": pa.int64(), "n": pa.int64(), "chances": pa.binary(), "code": pa.int64(), "zeros": pa.float64(), "ones": pa.float64(), "log_w": pa.float64()}
        if size:
            yield pa.RecordBatch.from_arrays([have.get(k, pa.nulls(size, t)) for k, t in kinds.items()], list(kinds))

    def up(batches):
        code, a, b, w = _columns(list(batches), "code", "zeros", "ones", "log_w")
        if len(code):
            code, a, b, w, stop, _ = parents(code.astype(np.int64).view(np.uint64), a, b, w, 1)
            have = _nodes(code, a, b, w) | {"stop": pa.array(stop)}
            yield pa.RecordBatch.from_arrays(list(have.values()), list(have))

    newest = lambda c, k: F.shiftright(F.col(c), 8).bitwiseAND(F.lit((1 << (8 * k)) - 1))
    low = counts.withColumn("newest", newest("gram", 2)).repartition("newest").sortWithinPartitions("newest").select("gram", "n")
    low = stored(low.mapInArrow(deep, _DEEP), "ctw-deep")
    nodes = low.where("gram IS NULL").select("code", "zeros", "ones", "log_w")
    one = nodes.repartition(newest("code", 1)).mapInArrow(up, f"{_NODE}, stop double").toArrow()  # at most 256 * 255 rows
    code, a, b, w, stop = (one.column(c).to_numpy() for c in ("code", "zeros", "ones", "log_w", "stop"))
    code = code.astype(np.int64).view(np.uint64)
    top = []
    for size in (256, 1):  # depths 1 and 0 as tables of context and decision
        table = np.full((2, size * 256), np.nan)
        table[:, code.astype(np.int64)] = _one(a, b), stop
        top.append(table)
        code, a, b, w, stop, _ = parents(code, a, b, w, 0)
    shared = spark.sparkContext.broadcast(top)

    def complete(batches):
        for batch in batches:
            key = batch.column("gram").to_numpy().view(np.uint64)
            byte = key & np.uint64(255)
            p = np.frombuffer(b"".join(batch.column("chances").to_pylist()), "<f4").reshape(-1, 8).T.astype(np.float64)
            bit = _decisions(byte)
            node = np.stack([np.uint64(1 << t) | (byte >> np.uint64(8 - t)) for t in range(8)])
            for d, (one, stop) in zip((1, 0), shared.value):
                at = ((key & np.uint64((1 << (8 * d + 8)) - 256)) | node).astype(np.int64)
                p = _mixed(np.where(bit == 1, one[at], 1 - one[at]), stop[at], p)
            bits = np.log2(np.where(np.isnan(p), 0.5, p)).sum(axis=0)
            yield pa.RecordBatch.from_arrays([batch.column("gram"), batch.column("n"), pa.array(bits)], ["gram", "n", "bits"])

    found = low.where("gram IS NOT NULL").select("gram", "n", "chances").mapInArrow(complete, "gram bigint, n bigint, bits double")
    return stored(found, "ctw-bits")


class Model:
    """The counts of all training texts, and what they say of any grams."""

    def __init__(self, counts: DataFrame, depth: int):
        self.counts, self.depth = counts, depth

    def cached(self, key: np.ndarray) -> np.ndarray:
        """log2 P(byte | context) of grams."""
        spark = self.counts.sparkSession
        asked = spark.createDataFrame(pa.table({"gram": np.unique(key).view(np.int64)}))
        both = self.counts.unionByName(asked.withColumn("n", F.lit(0).cast("long"))).groupBy("gram").agg(F.sum("n").alias("n"))
        got = gram_bits(both, self.depth).join(asked, "gram").toArrow()
        at = got.column("gram").to_numpy().view(np.uint64)
        order = np.argsort(at)
        return got.column("bits").to_numpy()[order][np.searchsorted(at[order], key)]


def train(texts: DataFrame, depth: int = DEPTH) -> Model:
    """The model of a column of texts."""
    prepare(texts.sparkSession)
    return Model(stored(count_grams(texts, depth), "ctw-grams"), depth)


class Head:
    """Bits of the most frequent grams in a hash table."""

    def __init__(self, gram: np.ndarray, bits: np.ndarray):
        self.gram, self.bits, self.key = gram, bits, None

    def __getstate__(self):
        return {"gram": self.gram, "bits": self.bits, "key": None}

    def _build(self):
        self.shift = np.uint64(64 - max(4, (2 * len(self.gram)).bit_length()))
        self.key = np.full(1 << (64 - int(self.shift)), _FREE)
        self.value = np.zeros(len(self.key))
        left, probe = np.arange(len(self.gram)), 0
        while len(left):
            slot = self._slot(self.gram[left], probe)
            free = self.key[slot] == _FREE
            self.key[slot[free]] = self.gram[left[free]]  # one of several wins; the others go on
            won = self.key[slot] == self.gram[left]
            self.value[slot[won]] = self.bits[left[won]]
            left, probe = left[~won], probe + 1

    def _slot(self, gram, probe):
        return (mix(gram + np.uint64(probe * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> self.shift).astype(np.int64)

    def find(self, gram: np.ndarray) -> np.ndarray:
        """Bits of each gram; NaN for those that are not there."""
        if self.key is None:
            self._build()
        slot = self._slot(gram, 0)
        there = self.key[slot]
        out = np.where(there == gram, self.value[slot], np.nan)
        open_, probe = np.flatnonzero((there != gram) & (there != _FREE)), 1
        while len(open_):
            slot = self._slot(gram[open_], probe)
            there = self.key[slot]
            hit = there == gram[open_]
            out[open_[hit]] = self.value[slot[hit]]
            open_, probe = open_[~hit & (there != _FREE)], probe + 1
        return out


def head_of(bits: DataFrame, limit: int) -> Head:
    """The most frequent rows of ``gram_bits``, about so many at most."""
    # counts on a scale of sixteenths of a power of two: some hundred classes at any size of corpus
    level = F.floor(16 * F.log2(F.col("n"))).cast("int")
    sizes = sorted(((r[0], r[1]) for r in bits.where("n > 0").groupBy(level.alias("level")).count().collect()), reverse=True)
    least, total = 1 << 20, 0
    for at, k in sizes:  # the lowest class that still fits
        total += k
        if total > limit:
            break
        least = at
    got = bits.where((F.col("n") > 0) & (level >= least)).select("gram", "bits").toArrow()
    return Head(got.column("gram").to_numpy().astype(np.int64).view(np.uint64), got.column("bits").to_numpy().astype(np.float64))


def _rare(key: np.ndarray, at: np.ndarray, missing: np.ndarray) -> pa.Array:
    """The grams at the places ``missing`` of each text, with their counts, as lists of (gram, times)."""
    row = np.searchsorted(at, missing, side="right") - 1
    gram = key[missing]
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    cut = group_starts(row, gram)
    values = pa.StructArray.from_arrays([pa.array(gram[cut[:-1]].view(np.int64)), pa.array(np.diff(cut))], ["gram", "times"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row[cut[:-1]], np.arange(len(at))), pa.int32()), values)


def count_tokens(texts: DataFrame) -> DataFrame:
    """token, c over all texts (words only)."""

    def go(batches):
        held: Counter = Counter()

        def rows():
            keys = list(held)
            for lo in range(0, len(keys), 1 << 17):
                part = keys[lo:lo + (1 << 17)]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([held[k] for k in part], pa.int64())], ["token", "c"])

        for batch in batches:
            for text in batch.column("text"):
                raw = text.as_buffer()
                if raw is not None:
                    held.update(raw.to_pybytes().lower().split())
                if len(held) > 250_000:
                    yield from rows()
                    held.clear()
        yield from rows()

    return texts.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(go, "token binary, c bigint").groupBy("token").agg(F.sum("c").alias("c"))


def score(docs: DataFrame, held_out: Column, depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes of every document.

    Learns from the rows where ``held_out`` is false.
    """
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.where(~held_out)
    counts = stored(count_tokens(texts), "ctw-tokens")
    n_docs = texts.count()
    n_words, n_types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    train_tokens, types = n_words + n_docs, n_types + (n_docs > 0)
    head = counts.orderBy(F.col("c").desc(), "token").limit(HEAD)
    shared = spark.sparkContext.broadcast({bytes(r.token): math.log10(r.c + 1) for r in head.collect()})
    bits = gram_bits(stored(count_grams(texts, depth, docs.where(F.coalesce(held_out, F.lit(True)))), "ctw-grams"), depth)
    model = spark.sparkContext.broadcast(head_of(bits, HEAD_GRAMS))
    end = math.log10(n_docs + 1)
    kind = dict(docs.dtypes)["doc_id"]

    def go(batches):
        known, m, number = shared.value, model.value, TaskContext.get().partitionId() << 36
        get = known.get
        for batch in batches:
            text, ids, held = batch.column("text"), batch.column("doc_id"), batch.column("held_out")
            for lo, hi, data, offsets in chunks(text, 1 << 20):
                out, at = streams(data, offsets)
                key = grams(out, at, depth)
                cost = m.find(key)
                missing = np.flatnonzero(np.isnan(cost))
                cost[missing] = 0
                far = _rare(key, at, missing)
                raw = data.tobytes()
                n_tokens, n_known, base, rest = [], [], [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    tokens = raw[a:b].lower().split()
                    values = list(map(get, tokens))
                    tail = [t for t, v in zip(tokens, values) if v is None] if None in values else []
                    n_tokens.append(len(tokens) + 1)
                    n_known.append(len(tokens) - len(tail) + (n_docs > 0))
                    base.append(math.fsum(v for v in values if v is not None) + end)
                    rest.append(tail)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(number, number + hi - lo)), ids.slice(lo, hi - lo), held.slice(lo, hi - lo), pa.array(n_tokens, pa.int64()),
                    pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(np.add.reduceat(cost, at[:-1])), pa.array(np.diff(at)),
                    pa.array(rest, pa.list_(pa.binary())), far],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "bits", "n_bytes", "tail", "far"])
                number += hi - lo

    rows = docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        go, f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, bits double, n_bytes bigint, "
            "tail array<binary>, far array<struct<gram: bigint, times: bigint>>")
    rows = stored(rows, "ctw-scores")  # row numbers are fixed by writing them
    rare = rows.select("row", F.explode("tail").alias("token")).join(counts, "token").groupBy("row").agg(
        F.count("*").alias("more"), F.sum(F.log10(F.col("c") + 1)).alias("extra"))
    more_bits = rows.select("row", F.inline("far")).join(bits.select("gram", F.col("bits").alias("each")), "gram").groupBy("row").agg(
        F.sum(F.col("times") * F.col("each")).alias("more_bits"))
    size = math.log10(train_tokens + types + 1)
    return rows.drop("tail", "far").join(rare, "row", "left").join(more_bits, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(train_tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("extra", F.lit(0.0)) - F.col("n_tokens") * size).alias("base_score"),
        ((F.col("bits") + F.coalesce("more_bits", F.lit(0.0))) * math.log10(2)).alias("score"), "n_bytes")


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 7, is 2 (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 7 == 2


def report(docs: DataFrame) -> DataFrame:
    return score(docs, held_out())
