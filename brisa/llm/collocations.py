r"""Collocations of 2 to 4 words, counted by weighted acyclic automata.

Texts are lower-cased (A-Z), split at ``[.,;:!?\x0A-\x0D]`` into pieces and
those into words ``[^\x20\x09]+``; all counts are per language.

1. Words, then pairs of frequent neighbours, are tallied: tasks merge (hash,
   count) arrays of their texts and hand them out by ranges of the hash, where they
   are merged again.  A phrase and its parts occur at least ``LEAST`` times only if all
   its words and pairs do, so the two tallies say which phrases need counting.  They go
   to the tasks as bit filters of a fixed size.  A false hit, of the hash or the filter,
   costs work, never a result: what is counted is counted by its words.
2. Each task sorts its shard's phrases and builds count transducers
   (``automata.Builder``), one for each range of the order of (language, first
   two words); a sample of the texts says where to cut, so no range is hot.
3. Transducers of one range are united, weights summed, a bounded number of
   phrases at a time; phrases under ``LEAST`` go and the rest is a transducer again.
4. The phrases of these transducers are the candidates.  Their parts, sorted,
   are an acceptor for each range; composed with the range's transducer it gives
   the parts' counts.
5. Scores (whole-number arithmetic), containment and the report are joins,
   group-bys and a window that keeps ``TOP`` rows of a language in each task.

Defined results: null texts are empty; a null language is ``und``; repeated
rows count each time; ids and other columns are not looked at; a language
without candidates has no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brisa.llm.automata import WORDS, Automaton, build, ordered, union
from brisa.llm.common import LOWER, chunks, group_starts, mix, prepare, stored, word_hashes, words

LEAST = 30
SCALE = 2_000_000
#: A candidate goes if a longer one around it has at least this many per hundred of its occurrences.
INSIDE = 80
TOP = 2000
#: Texts of about so many bytes are one shard.
SHARD = 3 << 20
#: Phrases that wait to be merged in a task, or to be united.
HELD = 1 << 21
#: Words of the corpus for each range of the tallies and of the transducers.
TALLY, RANGE = 4 << 20, 16 << 20
#: Texts to take the limits of the ranges from.
SAMPLE = 4000
#: Bits of a filter (8 MB).
BITS = 1 << 26

BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = ~BREAK
WORD[[0x20, 0x09]] = False


class Filter:
    """A set of hashes as a bit field of fixed size; may say yes to others, never no to a member."""

    def __init__(self, slots: np.ndarray, masks: np.ndarray):
        self.bits = np.zeros(BITS >> 6, np.uint64)
        self.bits[slots] = masks.view(np.uint64)

    @staticmethod
    def places(h: np.ndarray) -> list[np.ndarray]:
        return [x & np.uint64(BITS - 1) for x in (h, h >> np.uint64(32), mix(h))]

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for p in self.places(h):
            out &= (self.bits[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def _filter(hashes: DataFrame) -> Filter:
    """Filter of a table of hashes (h); the driver gets at most BITS / 64 slots."""

    def spread(batches):
        for batch in batches:
            h = batch.column("h").to_numpy().view(np.uint64)
            for p in Filter.places(h):
                yield pa.RecordBatch.from_arrays([pa.array((p >> np.uint64(6)).astype(np.int32)), pa.array((np.uint64(1) << (p & np.uint64(63))).view(np.int64))], ["slot", "mask"])

    got = hashes.select("h").mapInArrow(spread, "slot int, mask bigint").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    return Filter(got.column("slot").to_numpy(), got.column("mask").to_numpy())


class Shard:
    """Words and phrases of some texts as numbers: every phrase of n words is its first n - 1 words' number and a word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lang: np.ndarray, langs: list):
        data = LOWER[data]
        starts, ends, first = words(data, offsets, WORD)
        self.n = len(starts)
        breaks = np.concatenate([[0], np.cumsum(BREAK[data], dtype=np.int32)])
        #: whether the next word follows in the same piece
        self.goes_on = np.zeros(self.n, bool)
        self.goes_on[:-1] = breaks[starts[1:]] == breaks[ends[:-1]]
        last = first[1:] - 1
        self.goes_on[last[(last >= 0) & (np.diff(first) > 0)]] = False
        edge = np.concatenate([[0], np.cumsum(ends - starts)])
        flat = pa.Array.from_buffers(pa.large_binary(), self.n, [None, pa.py_buffer(edge.astype(np.int64)), pa.py_buffer(data[WORD[data]])])
        coded = flat.dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        self.vocabulary = coded.dictionary.take(pa.array(order))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.word = rank[coded.indices.to_numpy()] if self.n else np.zeros(0, np.int64)
        self.langs, self.size = langs, max(1, len(order))
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        key, self.one, self.one_n = np.unique(lang[row] * self.size + self.word, return_inverse=True, return_counts=True)
        self.one_lang, self.one_word = key // self.size, key % self.size
        self.one_h = self._hashes()

    def _hashes(self) -> np.ndarray:
        raw = self.vocabulary
        _, off, data = raw.buffers()
        if not len(raw):
            return np.zeros(0, np.uint64)
        off = np.frombuffer(off, np.int64)[raw.offset:raw.offset + len(raw) + 1]
        h = word_hashes(np.frombuffer(data, np.uint8), off[:-1], off[1:])
        name = np.array([_text_hash(x) for x in self.langs], np.uint64)
        return mix(h[self.one_word] ^ name[self.one_lang])

    def pairs(self, frequent: Filter):
        """Numbers and counts of pairs of frequent neighbours: (parent, word, n, hash); ``two`` has a pair for each place."""
        ok = frequent.has(self.one_h)
        at = np.flatnonzero(self.goes_on)
        at = at[ok[self.one[at]] & ok[self.one[at + 1]]]
        key, inverse, n = np.unique(self.one[at] * self.size + self.word[at + 1], return_inverse=True, return_counts=True)
        parent, word = key // self.size, key % self.size
        self.two = np.full(self.n, -1)
        self.two[at] = inverse
        # the second word's own number, for its hash
        second = np.zeros(len(key), np.int64)
        second[inverse] = self.one[at + 1]
        self.ok = ok
        return parent, word, n, mix(self.one_h[parent] * np.uint64(0x9FB21C651E98DF25) + self.one_h[second])

    def longer(self, parents: np.ndarray, shift: int):
        """Phrases one word longer than ``parents`` (a number or -1 for each place) whose last ``shift`` words are a parent too."""
        at = np.flatnonzero((parents[:-1] >= 0) & (parents[1:] >= 0)) if self.n else np.zeros(0, np.int64)
        key, inverse, n = np.unique(parents[at] * self.size + self.word[at + shift], return_inverse=True, return_counts=True)
        out = np.full(self.n, -1)
        out[at] = inverse
        return out, key // self.size, key % self.size, n


def _text_hash(raw: bytes) -> int:
    a = np.frombuffer(raw or b"\0", np.uint8)
    return int(word_hashes(a, np.array([0]), np.array([len(a)]))[0])


def _shards(batches):
    for batch in batches:
        coded = batch.column("lang").dictionary_encode()
        langs, lang = [x.encode() for x in coded.dictionary.to_pylist()], coded.indices.to_numpy().astype(np.int64)
        for lo, hi, data, offsets in chunks(batch.column("text"), SHARD):
            yield Shard(data, offsets, lang[lo:hi], langs)


def _strings(column: pa.Array) -> pa.Array:
    return column.cast(pa.binary()).cast(pa.string())


def _lang_column(shard: Shard, number: np.ndarray) -> pa.Array:
    return pa.array([x.decode() for x in shard.langs], pa.string()).take(pa.array(number))


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and their summed counts."""
    h, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(h)
    h, n = h[order], n[order]
    starts = group_starts(h) if len(h) else np.zeros(1, np.int64)
    return h[starts[:-1]], np.add.reduceat(n, starts[:-1]) if len(h) else n


def _tally(texts: DataFrame, slots: int, pick, name: str) -> DataFrame:
    """h, n of the frequent among the (hash, count) arrays that ``pick`` gives for a shard; lang, n of all words where h is null."""

    def tally(batches):
        held, size = [], 0

        def out():
            h, n = _merged(held)
            slot = ((h >> np.uint64(40)) * np.uint64(slots)) >> np.uint64(24)
            edge = np.searchsorted(slot, np.arange(slots + 1, dtype=np.uint64))
            some = np.flatnonzero(np.diff(edge))
            raw = lambda x: pa.array([x[edge[i]:edge[i + 1]].tobytes() for i in some], pa.binary())
            nothing = pa.nulls(len(some), pa.string()), pa.nulls(len(some), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), raw(h), raw(n.astype(np.int64)), *nothing], ["slot", "h", "n", "lang", "words"])

        for s in _shards(batches):
            held.append(pick(s))
            size += len(held[-1][0])
            if size > HELD:
                yield out()
                held, size = [], 0
            total = np.bincount(s.one_lang, s.one_n, len(s.langs)).astype(np.int64)
            k = len(total)
            yield pa.RecordBatch.from_arrays([pa.array([-1] * k, pa.int32()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()), pa.array([x.decode() for x in s.langs], pa.string()), pa.array(total)], ["slot", "h", "n", "lang", "words"])
        if held:
            yield out()

    def merge(batches):
        slot, held, size = None, [], 0

        def out():
            h, n = _merged(held)
            h, n = h[n >= LEAST], n[n >= LEAST]
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n), pa.nulls(len(h), pa.string())], ["h", "n", "lang"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("slot", "h", "n", "lang", "words")]
            plain = [(lang, words) for at, _, _, lang, words in zip(*cols) if at < 0]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(plain), pa.int64()), pa.array([p[1] for p in plain], pa.int64()), pa.array([p[0] for p in plain], pa.string())], ["h", "n", "lang"])
            for at, h, n, _, _ in zip(*cols):
                if at < 0:
                    continue
                if at != slot:
                    if held:
                        yield out()
                    slot, held, size = at, [], 0
                held.append((np.frombuffer(h, np.uint64), np.frombuffer(n, np.int64)))
                size += len(held[-1][0])
                if size > max(HELD, 2 * len(held[0][0])):
                    held = [_merged(held)]
                    size = len(held[0][0])
        if held:
            yield out()

    counted = texts.mapInArrow(tally, "slot int, h binary, n binary, lang string, words bigint")
    # the languages' totals of single shards have no slot and go anywhere
    dealt = counted.repartition(F.when(F.col("slot") >= 0, F.col("slot")).otherwise(F.xxhash64("words"))).sortWithinPartitions("slot")
    return stored(dealt.mapInArrow(merge, "h bigint, n bigint, lang string"), name)


def _key(lang: str, phrase: str) -> tuple:
    return (lang.encode(), *(phrase.encode().split(b" ") + [b""])[:2])


def _bounds(texts: DataFrame, rows: int, ranges: int, frequent, frequent_pairs) -> list[tuple]:
    """(language, word, word) limits of ranges with about equally many pairs in a sample of the texts."""

    def count(batches):
        for s in _shards(batches):
            parent, word, n, h = s.pairs(frequent.value)
            keep = np.flatnonzero(frequent_pairs.value.has(h))
            both = pc.binary_join_element_wise(s.vocabulary.take(pa.array(s.one_word[parent[keep]])), s.vocabulary.take(pa.array(word[keep])), pa.scalar(b" ", pa.large_binary()))
            yield pa.RecordBatch.from_arrays([_lang_column(s, s.one_lang[parent[keep]]), _strings(both)], ["lang", "phrase"])

    some = texts.sample(min(1.0, SAMPLE / max(rows, 1)), 12) if rows > SAMPLE else texts
    found = some.mapInArrow(count, "lang string, phrase string").repartitionByRange(ranges, "lang", "phrase")
    least = found.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("lang", "phrase")).alias("low")).select("low.*")
    return sorted({_key(r.lang, r.phrase) for r in least.collect()})


def _shard_ranges(s: Shard, bounds: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """The limits as numbers that compare with those of the shard's phrases (language, word, second word + 1), and the languages' order."""
    order = sorted(range(len(s.langs)), key=lambda i: s.langs[i])
    names = [s.langs[i] for i in order]
    vocabulary = s.vocabulary.to_pylist()
    out = []
    for lang, a, b in bounds:
        at = bisect_left(names, lang)
        p = q = 0
        if at < len(names) and names[at] == lang:
            p = bisect_left(vocabulary, a)
            if p < len(vocabulary) and vocabulary[p] == a:
                q = bisect_left(vocabulary, b) + 1
        out.append((at * (s.size + 1) + p) * (s.size + 2) + q)
    return np.array(out, np.int64), np.argsort(order)


def _transducers(texts: DataFrame, frequent, frequent_pairs, bounds) -> DataFrame:
    """range, lang, raw: the count transducer of every shard and range."""

    def make(batches):
        for s in _shards(batches):
            parent, word, n, h = s.pairs(frequent.value)
            keep = frequent_pairs.value.has(h)
            two = np.where((s.two >= 0) & keep[np.maximum(s.two, 0)], s.two, -1) if len(keep) else np.full(s.n, -1)
            three, up3, word3, n3 = s.longer(two, 2)
            _, up4, word4, n4 = s.longer(three, 3)
            pad = lambda cols, m: np.stack([*cols, *([np.full(m, -1)] * (WORDS - len(cols)))], axis=1)
            first2 = s.one_word[parent], word
            first3 = (first2[0][up3], first2[1][up3], word3)
            ones, twos = np.flatnonzero(s.ok), np.flatnonzero(keep)
            paths = np.concatenate([pad((s.one_word[ones],), len(ones)), pad((first2[0][twos], first2[1][twos]), len(twos)),
                                    pad(first3, len(word3)), pad((*(c[up4] for c in first3), word4), len(word4))]).astype(np.int32)
            lang = np.concatenate([s.one_lang[ones], s.one_lang[parent[twos]], s.one_lang[parent[up3]], s.one_lang[parent[up3][up4]]])
            count = np.concatenate([s.one_n[ones], n[twos], n3, n4])
            limits, rank = _shard_ranges(s, bounds.value)
            place = (rank[lang] * (s.size + 1) + paths[:, 0]) * (s.size + 2) + paths[:, 1] + 1 if len(lang) else np.zeros(0, np.int64)
            region = np.searchsorted(limits, place, side="right")
            order = np.lexsort([*paths.T[::-1], lang, region])
            paths, lang, count, region = paths[order], lang[order], count[order], region[order]
            vocabulary = s.vocabulary.to_pylist()
            starts = group_starts(region, lang)
            out = [(int(region[a]), s.langs[lang[a]].decode(), build(vocabulary, paths[a:b], count[a:b]).pack()) for a, b in zip(starts, starts[1:])]
            for lo in range(0, len(out), 256):
                part = out[lo:lo + 256]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.string()), pa.array([r[2] for r in part], pa.binary())], ["region", "lang", "raw"])

    return texts.mapInArrow(make, "region int, lang string, raw binary")


def _united(transducers: DataFrame) -> DataFrame:
    """region, lang, raw: one transducer of the frequent phrases of each range and language."""

    def unite(batches):
        name, parts, pending = None, [], 0

        def whole():
            labels, paths, n = union(parts)
            often = n >= LEAST
            return pa.RecordBatch.from_arrays([pa.array([name[0]], pa.int32()), pa.array([name[1]]), pa.array([build(labels, paths[often], n[often]).pack()], pa.binary())], ["region", "lang", "raw"])

        for batch in batches:
            for region, lang, raw in zip(*(batch.column(c).to_pylist() for c in ("region", "lang", "raw"))):
                if (region, lang) != name:
                    if parts:
                        yield whole()
                    name, parts, pending = (region, lang), [], 0
                a = Automaton.unpack(raw)
                parts.append((a.labels, *a.phrases()))
                pending += len(parts[-1][2])
                if pending > max(HELD, 2 * len(parts[0][2])):
                    parts = [union(parts)]
                    pending = len(parts[0][2])
        if parts:
            yield whole()

    return stored(transducers.repartition("region").sortWithinPartitions("region", "lang").mapInArrow(unite, "region int, lang string, raw binary"), "coll-counts")


def _candidates(counts: DataFrame) -> DataFrame:
    """lang, phrase, a, words of the frequent phrases of two words or more."""

    def read(batches):
        for batch in batches:
            for lang, raw in zip(batch.column("lang").to_pylist(), batch.column("raw").to_pylist()):
                a = Automaton.unpack(raw)
                paths, n = a.phrases()
                size = (paths >= 0).sum(axis=1)
                long = np.flatnonzero(size > 1)
                text = [b" ".join([a.labels[i] for i in p[:k]]) for p, k in zip(paths[long].tolist(), size[long].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(long), pa.string()), pa.array(text, pa.binary()).cast(pa.string()), pa.array(n[long]), pa.array(size[long].astype(np.int32))], ["lang", "phrase", "a", "words"])

    return stored(counts.mapInArrow(read, "lang string, phrase string, a bigint, words int"), "coll-candidates")


def _lookups(parts: DataFrame, counts: DataFrame, bounds) -> DataFrame:
    """lang, part, n of distinct phrases (lang, part) that the transducers count."""

    def place(batches):
        for batch in batches:
            keys = [_key(*r) for r in zip(batch.column("lang").to_pylist(), batch.column("part").to_pylist())]
            region = pa.array([bisect_right(bounds.value, k) for k in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([region, batch.column("lang"), batch.column("part")], ["region", "lang", "part"])

    def answer(batches):
        name, counted = None, None
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("region", "lang", "raw", "part")]
            rows = list(zip(*cols))
            lo = 0
            while lo < len(rows):
                if rows[lo][2] is not None:
                    name, counted = rows[lo][:2], Automaton.unpack(rows[lo][2])
                    lo += 1
                    continue
                hi = lo
                while hi < len(rows) and rows[hi][:2] == rows[lo][:2] and rows[hi][2] is None:
                    hi += 1
                if rows[lo][:2] == name:
                    asked = [r[3].encode().split(b" ") for r in rows[lo:hi]]
                    labels = sorted({w for p in asked for w in p})
                    number = {w: i for i, w in enumerate(labels)}
                    paths = np.array([[*(number[w] for w in p), *[-1] * (WORDS - len(p))] for p in asked], np.int32)
                    acceptor = build(labels, *ordered(paths, np.ones(len(paths), np.int64)))
                    found, n = counted.compose(acceptor)
                    text = [b" ".join([acceptor.labels[i] for i in p if i >= 0]) for p in found.tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array([name[1]] * len(text), pa.string()), pa.array(text, pa.binary()).cast(pa.string()), pa.array(n)], ["lang", "part", "n"])
                lo = hi

    asked = parts.mapInArrow(place, "region int, lang string, part string").select("region", "lang", F.lit(None).cast("binary").alias("raw"), "part")
    both = asked.unionByName(counts.select("region", "lang", "raw", F.lit(None).cast("string").alias("part")))
    dealt = both.repartition("region").sortWithinPartitions("region", "lang", F.col("raw").isNull(), "part")
    return stored(dealt.mapInArrow(answer, "lang string, part string, n bigint"), "coll-parts")


def _scores(candidates: DataFrame, counts: DataFrame, bounds) -> DataFrame:
    """The candidates with l, r and score of their weakest cut."""
    tokens = F.split("phrase", " ")
    cut = lambda k: F.struct(k.alias("k"), F.array_join(F.slice(tokens, F.lit(1), k), " ").alias("left"), F.array_join(F.slice(tokens, k + 1, F.col("words") - k), " ").alias("right"))
    cuts = candidates.withColumn("cut", F.explode(F.transform(F.sequence(F.lit(1), F.col("words") - 1), cut))).select("lang", "phrase", "a", "cut.*")
    cuts = stored(cuts, "coll-cuts")
    parts = cuts.select("lang", F.explode(F.array("left", "right")).alias("part")).distinct()
    known = _lookups(parts, counts, bounds)
    of = lambda side, n: known.select("lang", F.col("part").alias(side), F.col("n").alias(n))
    whole = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    score = F.expr(f"(CAST(a AS DECIMAL(28,0)) * {SCALE}) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    best = whole.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "best.a", "best.l", "best.r", "best.score")


def _contained(candidates: DataFrame) -> DataFrame:
    """lang, phrase, around: the largest count of a longer candidate that the phrase lies in."""
    tokens = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: F.array_join(F.slice(tokens, i, m), " "))))
    return candidates.where("words > 2").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))


def mine(docs: DataFrame, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of every language."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    share = spark.sparkContext.broadcast
    size = texts.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    size_words, least = (size.bytes or 0) // 6, 2 * spark.sparkContext.defaultParallelism
    slots, ranges = (max(least, -(-size_words // k)) for k in (TALLY, RANGE))
    counted = _tally(texts, slots, lambda s: (s.one_h, s.one_n), "coll-words")
    totals = counted.where("h IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = share(_filter(counted.where("h IS NOT NULL")))

    def of_pairs(s):
        _, _, n, h = s.pairs(frequent.value)
        return h, n

    frequent_pairs = share(_filter(_tally(texts, slots, of_pairs, "coll-pairs").where("h IS NOT NULL")))
    bounds = share(_bounds(texts, size.rows, ranges, frequent, frequent_pairs))
    counts = _united(_transducers(texts, frequent, frequent_pairs, bounds))
    candidates = _candidates(counts)
    scored = _scores(candidates, counts, bounds).join(_contained(candidates), ["lang", "phrase"], "left")
    kept = scored.where(f"around IS NULL OR 100 * CAST(around AS DECIMAL(28,0)) < {INSIDE} * CAST(a AS DECIMAL(28,0))")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
