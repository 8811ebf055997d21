r"""Benchmark decontamination with a distributed positional inverted index.

``build`` writes the index of the training texts: document-partitioned shards,
each with its sorted term hashes and, for every term, the ascending list of
word positions (delta-coded).  ``search`` sends the benchmark's items through
every shard in blocks of bounded size.  In a shard a window (``length``
consecutive item words) starts from the postings of its rarest term; the
lists of the other terms, adjusted by their offsets, are intersected with it
outward from there.  Proximity matches need all words of a window, in any
order, within ``span`` consecutive words; their lists are met from the rarest
term upwards as well.

Terms are 64-bit hashes of lower-cased words of the class
``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.  What a text contains depends on the text
alone, so hits are keyed by the text's digest: a text with very many copies
gives one row of hits, and documents join that (a join Spark can split).

Defined results: a null or empty text has no words and no hits; an item of
fewer than ``length`` words, but not none, is one window; items without words
never match; rows with the same item_id are one item, and a null item_id is an
item written as the empty string; an empty benchmark or document table gives
no hits or no rows.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import ALNUM, LOWER, chunks, prepare, stored, word_hashes, words

LENGTH = 10
SPAN = 15
#: Bytes of benchmark text in one block; a block is what every task holds at a time.
BLOCK_BYTES = 32 << 20

SHARD = "digests binary, first binary, terms binary, counts binary, positions binary"
HITS = "digest binary, runs array<struct<s:int,e:int>>, items array<string>, near array<string>"


def digest(text: str = "text") -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def word_count(text: str = "text") -> Column:
    """Words of a text (in bytes through Arrow: several times cheaper than counting matches of a pattern)."""

    def count(column: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0, np.int64)] + [np.diff(words(LOWER[data], offsets, ALNUM)[2]) for _, _, data, offsets in chunks(column)]))

    return F.arrow_udf(count, "bigint")(F.col(text))


def hashed(column: pa.Array, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, term hash of every word, first word of every row) for chunks of texts."""
    for lo, hi, data, offsets in chunks(column, limit):
        data = LOWER[data]
        starts, ends, first = words(data, offsets, ALNUM)
        yield lo, hi, word_hashes(data, starts, ends), first


def _planes(a: np.ndarray) -> bytes:
    """int32 values byte plane by byte plane (small values then compress well)."""
    return np.ascontiguousarray(a.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplanes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<i4").ravel()


@dataclass
class Shard:
    """One shard in memory: ``tid`` is the term number of every word, in text order."""

    terms: np.ndarray
    counts: np.ndarray
    order: np.ndarray  # positions, term after term
    first: np.ndarray

    def __post_init__(self):
        self.at = np.concatenate([[0], np.cumsum(self.counts)])
        self.tid = np.empty(len(self.order), dtype=np.int32)
        self.tid[self.order] = np.repeat(np.arange(len(self.terms), dtype=np.int32), self.counts)
        self.row = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    @classmethod
    def of(cls, h: np.ndarray, first: np.ndarray) -> Shard:
        order = np.argsort(h, kind="stable").astype(np.int32)
        terms, counts = np.unique(h[order], return_counts=True) if len(h) else (h, np.zeros(0, np.int64))
        return cls(terms, counts, order, first)


def _pack(digests: bytes, s: Shard) -> dict:
    delta = np.diff(s.order, prepend=0)
    heads = s.at[:-1]
    delta[heads] = s.order[heads]
    return {"digests": digests, "first": s.first.astype("<i8").tobytes(), "terms": s.terms.astype("<u8").tobytes(),
            "counts": _planes(s.counts), "positions": _planes(delta)}


def _unpack(r: dict) -> Shard:
    counts = _unplanes(r["counts"]).astype(np.int64)
    delta = _unplanes(r["positions"]).astype(np.int64)
    total = np.cumsum(delta)
    heads = np.concatenate([[0], np.cumsum(counts)])[:-1]
    base = total[heads] - delta[heads] if len(heads) else heads
    return Shard(np.frombuffer(r["terms"], "<u8"), counts, (total - np.repeat(base, counts)).astype(np.int32), np.frombuffer(r["first"], "<i8"))


def build(docs: DataFrame, chunk_bytes: int = 2 << 20) -> DataFrame:
    """The stored index: one row for each shard (a chunk of documents)."""

    prepare(docs.sparkSession)

    def index(batches):
        for batch in batches:
            keys = batch.column("digest")
            for lo, hi, h, first in hashed(batch.column("text"), chunk_bytes):
                packed = _pack(b"".join(keys.slice(lo, hi - lo).to_pylist()), Shard.of(h, first))
                yield pa.RecordBatch.from_pylist([packed], pa.schema([(k, pa.binary()) for k in packed]))

    return stored(docs.select(digest().alias("digest"), "text").mapInArrow(index, SHARD), "phrase-index")


@dataclass
class Block:
    """Query side: the items' term hashes, and every window as (first term, length, item)."""

    h: np.ndarray
    start: np.ndarray
    size: np.ndarray
    item: np.ndarray
    ends: np.ndarray  # for every window, the item's first and end term
    names: list[str]


def _block(rows: list, length: int) -> Block:
    h, start, size, item, ends, at = [], [], [], [], [], 0
    names = sorted({"" if r.item_id is None else str(r.item_id) for r in rows})
    number = {n: i for i, n in enumerate(names)}
    for r in rows:
        for _, _, x, _ in hashed(pa.array([r.text], pa.string()), BLOCK_BYTES):
            n = len(x)
            if n:
                h.append(x)
                begins = np.arange(at, at + max(1, n - length + 1))
                start.append(begins)
                size.append(np.full(len(begins), min(n, length)))
                item.append(np.full(len(begins), number["" if r.item_id is None else str(r.item_id)]))
                ends.append(np.tile([at, at + n], (len(begins), 1)))
                at += n
    cat = lambda xs, dtype: np.concatenate(xs) if xs else np.zeros(0, dtype)
    return Block(cat(h, np.uint64), cat(start, np.int64), cat(size, np.int64), cat(item, np.int64),
                 np.concatenate(ends) if ends else np.zeros((0, 2), np.int64), names)


def _spread(s: Shard, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All postings of each given term: (index into ``term``, position)."""
    n = s.counts[term]
    i = np.repeat(np.arange(len(term)), n)
    k = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)])[:-1], n)
    return i, s.order[s.at[term][i] + k].astype(np.int64)


def search_shard(s: Shard, b: Block, length: int, span: int) -> tuple[tuple, tuple]:
    """((row, item, run start, run end) of phrases, (row, item) of proximity matches); runs count words from the row's first."""
    none = np.zeros(0, np.int64)
    empty = (none, none, none, none), (none, none)
    if not len(b.start) or not len(s.terms):
        return empty
    at = np.minimum(np.searchsorted(s.terms, b.h), len(s.terms) - 1)
    bt = np.where(s.terms[at] == b.h, at, -1)
    many = np.where(bt >= 0, s.counts[bt], 0)
    absent = np.concatenate([[0], np.cumsum(bt < 0)])
    w = np.flatnonzero(absent[b.start + b.size] == absent[b.start])  # windows with all their terms in the shard
    if not len(w):
        return empty
    step = np.arange(length)
    cell = np.minimum(b.start[w, None] + step, len(bt) - 1)
    inside = step < b.size[w, None]
    rarity = np.where(inside, many[cell], np.iinfo(np.int64).max)
    rank = np.argsort(rarity, axis=1, kind="stable")
    anchor = b.start[w] + rank[:, 0]
    # phrases: windows that share an item word as anchor are one probe
    probe, pick = np.unique(anchor, return_index=True)
    item, lo, hi = b.item[w][pick], b.ends[w][pick, 0], b.ends[w][pick, 1]
    i, p = _spread(s, bt[probe])
    row = s.row[p]
    reach = []
    for sign in (-1, 1):
        grown, alive = np.zeros(len(p), np.int64), np.arange(len(p))
        for j in range(1, length):
            q, d = probe[i[alive]] + sign * j, p[alive] + sign * j
            ok = (q >= lo[i[alive]]) & (q < hi[i[alive]]) & (d >= s.first[row[alive]]) & (d < s.first[row[alive] + 1])
            alive, q, d = alive[ok], q[ok], d[ok]
            alive = alive[s.tid[d] == bt[q]]
            grown[alive] = j
        reach.append(grown)
    need = np.minimum(length, (hi - lo)[i])
    found = reach[0] + reach[1] + 1 >= need
    base = s.first[row[found]]
    phrases = (row[found], item[i[found]], p[found] - reach[0][found] - base, p[found] + reach[1][found] + 1 - base)
    # proximity: from the rarest term of each window, keep postings that have the next one near
    i, p = _spread(s, bt[anchor])
    key = s.tid.astype(np.int64)[s.order] * (len(s.tid) + 1) + s.order  # ascending (term, position)
    for r in range(1, length):
        if not len(i):
            break
        real = r < b.size[w[i]]
        term = bt[np.minimum(b.start[w[i]] + rank[i, r], len(bt) - 1)]
        low = np.maximum(p - span + 1, s.first[s.row[p]])
        high = np.minimum(p + span, s.first[s.row[p] + 1])
        k = np.searchsorted(key, term * (len(s.tid) + 1) + low)
        hit = (k < len(key)) & (key[np.minimum(k, len(key) - 1)] < term * (len(s.tid) + 1) + high)
        i, p = i[hit | ~real], p[hit | ~real]
    good = np.zeros(len(i), bool)
    for shift in range(span):
        left = np.flatnonzero(~good)
        if not len(left):
            break
        begin = np.maximum(p[left] - shift, s.first[s.row[p[left]]])
        end = np.minimum(begin + span, s.first[s.row[p[left]] + 1])
        view = begin[:, None] + np.arange(span)
        have = np.where(view < end[:, None], s.tid[np.minimum(view, len(s.tid) - 1)], -1)
        want = np.where(inside[i[left]], bt[cell[i[left]]], -2)
        all_in = np.ones(len(left), bool)
        for j in range(length):
            all_in &= (want[:, j] == -2) | (have == want[:, j, None]).any(axis=1)
        good[left] = all_in
    return phrases, (s.row[p[good]], b.item[w[i[good]]])


def _blocks(benchmark: DataFrame, length: int) -> Iterator[Block]:
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // BLOCK_BYTES) + 1
    rows = benchmark.select("item_id", "text")
    for k in range(n):
        yield _block(rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect(), length)


def search(index: DataFrame, benchmark: DataFrame, length: int = LENGTH, span: int = SPAN) -> DataFrame:
    """digest, n_hit, items, near (item names, sorted) of every text with a phrase or proximity match."""
    spark = index.sparkSession
    schema = pa.schema([("digest", pa.binary()), ("runs", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                        ("items", pa.list_(pa.string())), ("near", pa.list_(pa.string()))])
    parts = []
    for block in _blocks(benchmark, length):
        shared = spark.sparkContext.broadcast(block)

        def look(batches, shared=shared):
            b = shared.value
            for batch in batches:
                for shard in batch.to_pylist():
                    s = _unpack(shard)
                    (row, item, lo, hi), (near_row, near_item) = search_shard(s, b, length, span)
                    runs = np.unique(np.stack([row, lo, hi], axis=1), axis=0)
                    pairs = np.unique(np.stack([row, item], axis=1), axis=0)
                    close = np.unique(np.stack([near_row, near_item], axis=1), axis=0)
                    hit = np.union1d(row, near_row)
                    cut = [np.searchsorted(a[:, 0], [hit, hit + 1]) for a in (runs, pairs, close)]
                    out = [{"digest": shard["digests"][16 * x:16 * x + 16],
                            "runs": [{"s": u, "e": v} for _, u, v in runs[cut[0][0, k]:cut[0][1, k]].tolist()],
                            "items": [b.names[v] for _, v in pairs[cut[1][0, k]:cut[1][1, k]].tolist()],
                            "near": [b.names[v] for _, v in close[cut[2][0, k]:cut[2][1, k]].tolist()]} for k, x in enumerate(hit.tolist())]
                    yield pa.RecordBatch.from_pylist(out, schema)

        parts.append(index.mapInArrow(look, HITS))
    hits = parts[0]
    for more in parts[1:]:
        hits = hits.unionByName(more)
    # copies of a text repeat its hits: sets are merged before the shuffle
    merged = hits.groupBy("digest").agg(F.flatten(F.collect_set("runs")).alias("runs"), F.flatten(F.collect_set("items")).alias("items"),
                                        F.flatten(F.collect_set("near")).alias("near"))
    covered = ("aggregate(array_sort(runs), named_struct('at', 0, 'n', 0L), (a, r) -> named_struct('at', greatest(a.at, r.e), "
               "'n', a.n + greatest(0, r.e - greatest(a.at, r.s))), a -> a.n)")
    names = lambda c: F.array_sort(F.array_distinct(c))
    return merged.select("digest", F.expr(covered).alias("n_hit"), names("items").alias("items"), names("near").alias("near"))


def report(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, span: int = SPAN) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near of every document."""
    hits = stored(search(build(docs), benchmark, length, span), "phrase-hits")  # build() readies the session
    rows = docs.select("doc_id", word_count().alias("n_words"), digest().alias("digest"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(hits, "digest", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.size(F.coalesce("near", F.array().cast("array<string>"))).cast("long").alias("n_near"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no window of any item."""
    hits = stored(search(build(docs), benchmark, length).where("n_hit > 0").select("digest"), "phrase-hits")
    return docs.withColumn("__digest", digest()).join(hits.withColumnRenamed("digest", "__digest"), "__digest", "left_anti").select(docs.columns)
