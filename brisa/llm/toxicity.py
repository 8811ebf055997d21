"""Toxicity: a convolutional text classifier trained in numpy.

A word is the sum of hashed embeddings of the word and of its beginnings (4, 5
and 6 bytes), so inflected and compound forms share what their stems say, and
words that share one bucket still differ in the others.  Filters of widths 1, 2 and 3 slide over the
words, a rectifier and the maximum over the text follow, and a logistic output
gives the score in (0, 1).

Training begins on the driver with at most twice ``SAMPLE`` labelled rows (in the order of
their texts' digests).  If there are more, all of them are then learnt from on the executors:
shards of the rows go on from that model batch by batch, their changes are averaged, and this is
done ``ROUNDS`` times; the driver sees parameters only.  Every text is used whole.  Scoring depends on the text alone: labels, language, source
and id are never inputs.  It needs no shuffle; tasks hold the model (some 16 MB,
fixed by the parameters) and one chunk of texts.

Thresholds by language are calibrated on the part of the labelled rows kept back from
training: the threshold with the best F1 for each language with enough toxic
and clean rows there, the overall one otherwise.

Defined results: a null or empty text has no words, so every maximum is 0 and
the output's constant term decides (clean if training saw clean texts); with
no labelled rows all scores are 0.5; equal texts get equal scores; repeated
rows stay; other columns are not looked at.
"""

from __future__ import annotations

import copy
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisa.llm.common import ALNUM, LOWER, chunks, mix, prepare, word_hashes, words
from brisa.llm.sampling import every_labelled, labelled_documents, one_label
from brisa.session import cut_lineage

BUCKETS = 1 << 17
WIDTH = 8
FILTERS = 8
SPANS = (1, 2, 3)
#: Labelled rows to begin on (at most twice as many); every fifth of all is kept back for the thresholds.
SAMPLE = 5000
EPOCHS = 30
BATCH = 64
#: Passes over all rows where there are more; the shards that learn side by side; buckets merged at once.
ROUNDS = 2
MOST_SHARDS = 64
BLOCK = 1024
#: Scores are told apart to 1 / STEPS where thresholds come from counts.
STEPS = 10000
THRESHOLD = 0.7
#: Adagrad on embeddings; the damping keeps words that occur once or twice from being learnt by heart.
RATE, DAMP = 0.1, 1e-2
#: Share of words hidden in each training step.
HIDE = 0.3
#: Bytes of a word's beginnings that have embeddings of their own.
STEMS = (4, 5, 6)
PARTS = 1 + len(STEMS)
_PAD = max(SPANS) - 1


@dataclass
class Model:
    table: np.ndarray  # (PARTS, BUCKETS + 1, WIDTH); the last row is padding and stays 0
    filters: list  # for each span: (span, WIDTH, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    constant: float
    by_lang: dict = field(default_factory=dict)
    overall: float = THRESHOLD

    def scores(self, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        x = _embed(self.table, ids)
        full = np.flatnonzero(sizes > 0)
        pooled = np.zeros((len(starts), len(SPANS) * FILTERS), np.float32)
        if len(full):
            bounds = np.stack([starts[full], starts[full] + sizes[full]], axis=1).ravel()
            for k, w in enumerate(self.filters):
                y = _convolve(x, w)
                pooled[full, k * FILTERS:(k + 1) * FILTERS] = np.maximum.reduceat(y, bounds, axis=0)[::2]
        hidden = np.where(sizes[:, None] > 0, np.maximum(pooled + self.bias, 0), 0).astype(np.float64)
        z = np.full(len(starts), self.constant)
        for column, weight in zip(hidden.T, self.out):
            z += column * weight
        return 1 / (1 + np.exp(-z))


def _embed(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    x = table[0][ids[0]]
    for t, i in zip(table[1:], ids[1:]):
        x += t[i]
    return x


def _convolve(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Filter outputs by word, added up column by column: a word's sums do not depend on where in a chunk it is,
    as they may in a matrix product."""
    columns = [np.ascontiguousarray(c)[:, None] for c in x.T]
    y = np.zeros((len(x), w.shape[2]), x.dtype)
    for j in range(len(w)):
        for c, weights in zip(columns, w[j]):
            y[:len(x) - j] += c[j:] * weights
    return y


def _product(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The same as matrix products: faster, for training, where batches are always the same."""
    y = x @ w[0]
    for j in range(1, len(w)):
        y[:-j] += x[j:] @ w[j]
    return y


def word_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(PARTS, words) bucket numbers of a chunk's words, and each text's first word."""
    data = LOWER[data]
    starts, ends, first = words(data, offsets, ALNUM)
    parts = [word_hashes(data, starts, ends)] + [mix(word_hashes(data, starts, np.minimum(ends, starts + k)) + np.uint64(k)) for k in STEMS]
    return np.stack([h % np.uint64(BUCKETS) for h in parts]).astype(np.int32), first


def padded(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers with padding after every text; start and size of the texts in it."""
    sizes = np.diff(first)
    starts = first[:-1] - first[0] + _PAD * np.arange(len(sizes))
    out = np.full((len(ids), (first[-1] - first[0]) + _PAD * len(sizes) + 1), BUCKETS, np.int32)
    to = np.arange(first[-1] - first[0]) + _PAD * np.repeat(np.arange(len(sizes)), sizes)
    out[:, to] = ids[:, first[0]:first[-1]]
    return out, starts, sizes


class _Trainer:
    """Adam on the weighted logistic loss; the maximum passes its gradient to the word span it came from."""

    def __init__(self, model: Model, ratio: float):
        self.model, self.ratio = model, ratio
        self.state: dict = {}
        self.count = 0
        self.squares = np.zeros((PARTS, BUCKETS + 1, 1), np.float32)
        self.constant = np.array([model.constant])

    def _adam(self, name, value, grad, rate):
        a, b = self.state.setdefault(name, (np.zeros_like(value, dtype=np.float64), np.zeros_like(value, dtype=np.float64)))
        a += 0.1 * (grad - a)
        b += 0.01 * (grad * grad - b)
        value -= rate * (a / (1 - 0.9 ** self.count)) / (np.sqrt(b / (1 - 0.99 ** self.count)) + 1e-8)

    def step(self, ids: np.ndarray, first: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        m, n_out = self.model, len(SPANS) * FILTERS
        self.count += 1
        ids = np.where(rng.random(ids.shape[1]) < HIDE, BUCKETS, ids).astype(np.int32)
        ids, starts, sizes = padded(ids, first)
        x = _embed(m.table, ids)
        full = np.flatnonzero(sizes > 0)
        pooled, where = np.zeros((len(y), n_out), np.float32), np.zeros((len(y), n_out), np.int64)
        for k, w in enumerate(m.filters):
            conv = _product(x, w)
            for r in full:
                part = conv[starts[r]:starts[r] + sizes[r]]
                at = part.argmax(axis=0)
                cols = slice(k * FILTERS, (k + 1) * FILTERS)
                where[r, cols] = starts[r] + at
                pooled[r, cols] = part[at, np.arange(FILTERS)]
        live = (pooled + m.bias > 0) & (sizes[:, None] > 0)
        hidden = np.where(live, pooled + m.bias, 0)
        p = 1 / (1 + np.exp(-(hidden @ m.out + self.constant[0])))
        g = (p - y) * np.where(y == 1, self.ratio, 1.0) / len(y)
        g_hidden = np.where(live, g[:, None] * m.out[None], 0)
        gx: list = []
        for k, w in enumerate(m.filters):
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            gh, at = g_hidden[full, cols], where[full, cols]
            gw = np.zeros_like(w, dtype=np.float64)
            for j in range(len(w)):
                gw[j] = np.einsum("rfe,rf->ef", x[at + j], gh)
                gx.append(((at + j).ravel(), (gh[:, :, None] * w[j].T[None]).reshape(-1, WIDTH)))
            self._adam(f"w{k}", m.filters[k], gw, 0.01)
        self._adam("bias", m.bias, g_hidden.sum(axis=0), 0.01)
        self._adam("out", m.out, hidden.T @ g + 1e-4 * m.out, 0.02)
        self._adam("constant", self.constant, np.array([g.sum()]), 0.02)
        at, grad = np.concatenate([a for a, _ in gx]), np.concatenate([b for _, b in gx])
        for t in range(PARTS):  # Adagrad on the few embedding rows touched
            rows, inv = np.unique(ids[t][at], return_inverse=True)
            total = np.zeros((len(rows), WIDTH), np.float32)
            np.add.at(total, inv, grad)
            self.squares[t][rows] += (total * total).mean(axis=1, keepdims=True)
            m.table[t][rows] -= RATE * total / (np.sqrt(self.squares[t][rows]) + DAMP)
            m.table[t][BUCKETS] = 0

    def dense(self) -> list[np.ndarray]:
        """All parameters but the embeddings."""
        return [*self.model.filters, self.model.bias, self.model.out, self.constant]


def _train(texts: list[np.ndarray], y: np.ndarray, seed: int = 7) -> Model:
    """A model of texts at hand."""
    return _trained(texts, y, seed).model


def _trained(texts: list[np.ndarray], y: np.ndarray, seed: int = 7) -> _Trainer:
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (PARTS, BUCKETS + 1, WIDTH)).astype(np.float32)
    table[:, BUCKETS] = 0
    filters = [rng.normal(0, 1 / np.sqrt(s * WIDTH), (s, WIDTH, FILTERS)).astype(np.float32) for s in SPANS]
    n_out = len(SPANS) * FILTERS
    m = Model(table, filters, np.zeros(n_out, np.float32), rng.normal(0, 0.3, n_out), 0.0)
    trainer = _Trainer(m, _ratio(len(y), y.sum()))
    if not len(y):
        m.out[:] = 0
        return trainer
    for _ in range(EPOCHS):
        for pick in np.array_split(rng.permutation(len(y)), max(1, len(y) // BATCH)):
            ids = np.concatenate([texts[i] for i in pick], axis=1)
            first = np.concatenate([[0], np.cumsum([texts[i].shape[1] for i in pick])])
            trainer.step(ids, first, y[pick], rng)
    m.constant = float(trainer.constant[0])
    seen = np.zeros((PARTS, BUCKETS + 1), bool)
    for t in texts:
        for k in range(PARTS):
            seen[k][t[k]] = True
    m.table[~seen] = 0  # buckets no training word fell into say nothing
    return trainer


def _ratio(n: int, toxic: int) -> float:
    return min(10.0, (n - toxic) / max(toxic, 1))


def _round(trainer: _Trainer, rows: DataFrame, shards: int, seed: int) -> None:
    """One pass over all ``rows``: shards of them go on from the same model, in batches, and their changes are averaged.

    A bucket's change is the mean over the shards whose words fell into it, all other parameters' by the
    shards' rows.  What comes to the driver has the size of the model.
    """
    shared = rows.sparkSession.sparkContext.broadcast(trainer)

    def learn(batches):
        start, mine, n = shared.value, copy.deepcopy(shared.value), 0
        shard = TaskContext.get().partitionId()
        rng = np.random.default_rng([seed, shard])
        seen = np.zeros((PARTS, BUCKETS), bool)
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column("text")):
                ids, first = word_ids(data, offsets)
                y = batch.column("toxic").slice(lo, hi - lo).to_numpy()
                for part in np.array_split(np.arange(hi - lo), max(1, (hi - lo) // BATCH)):
                    a, b = part[0], part[-1] + 1
                    mine.step(ids[:, first[a]:first[b]], first[a:b + 1] - first[a], y[a:b], rng)
                for k in range(PARTS):
                    seen[k][ids[k]] = True
                n += hi - lo
        if not n:
            return
        change = np.concatenate([mine.model.table - start.model.table, mine.squares - start.squares], axis=2)
        out = [(-1, b"", np.concatenate([(a - b).ravel() for a, b in zip(mine.dense(), start.dense())]).astype("<f8").tobytes())]
        for at in range(0, BUCKETS, BLOCK):
            hit = seen[:, at:at + BLOCK]
            if hit.any():
                out.append((at, hit.tobytes(), change[:, at:at + BLOCK][hit].astype("<f4").tobytes()))
        blocks, hits, changes = zip(*out)
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array([shard] * len(out), pa.int32()), pa.array([n] * len(out), pa.int64()),
                                          pa.array(hits, pa.binary()), pa.array(changes, pa.binary())], ["block", "shard", "n", "hit", "change"])

    def merge(pdf):
        pdf = pdf.sort_values("shard")  # sums do not depend on the order in which shards come in
        if pdf.block.iloc[0] < 0:
            total = sum(n * np.frombuffer(c, "<f8") for n, c in zip(pdf.n, pdf.change)) / pdf.n.sum()
            return pd.DataFrame({"block": pdf.block.iloc[:1], "change": [total.tobytes()]})
        total, count = np.zeros((PARTS, BLOCK, WIDTH + 1)), np.zeros((PARTS, BLOCK, 1))
        for h, c in zip(pdf.hit, pdf.change):
            hit = np.frombuffer(h, bool).reshape(PARTS, BLOCK)
            total[hit] += np.frombuffer(c, "<f4").reshape(-1, WIDTH + 1)
            count[hit] += 1
        return pd.DataFrame({"block": pdf.block.iloc[:1], "change": [(total / np.maximum(count, 1)).astype("<f4").tobytes()]})

    dealt = rows.repartition(shards, "draw").sortWithinPartitions("draw", "digest", "toxic", "lang").select("toxic", "text")
    changes = dealt.mapInArrow(learn, "block int, shard int, n long, hit binary, change binary")
    for r in changes.groupBy("block").applyInPandas(merge, "block int, change binary").collect():
        if r.block < 0:
            flat, at = np.frombuffer(r.change, "<f8"), 0
            for v in trainer.dense():
                v += flat[at:at + v.size].reshape(v.shape).astype(v.dtype)
                at += v.size
        else:
            change = np.frombuffer(r.change, "<f4").reshape(PARTS, BLOCK, WIDTH + 1)
            trainer.model.table[:, r.block:r.block + BLOCK] += change[:, :, :WIDTH]
            trainer.squares[:, r.block:r.block + BLOCK] = np.maximum(trainer.squares[:, r.block:r.block + BLOCK] + change[:, :, WIDTH:], 0)
    trainer.model.constant = float(trainer.constant[0])
    shared.unpersist()


def _thresholds(model: Model, rows: DataFrame) -> None:
    """The thresholds of ``_threshold`` over any number of rows, to 1 / STEPS, from counts by score."""
    rated = rows.select("lang", "toxic", F.floor(score(model, rows) * STEPS).alias("at"))
    cells = cut_lineage(rated.groupBy("lang", "at").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).withColumn("whole", F.lit(False)))
    every = cells.groupBy("at").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).select(F.lit("").alias("lang"), "at", "n", "t", F.lit(True).alias("whole"))
    mine = Window.partitionBy("whole", "lang")
    down = mine.orderBy(F.col("at").desc())
    f1 = 2 * F.sum("t").over(down) / (F.sum("n").over(down) + F.sum("t").over(mine))
    cells = cells.unionByName(every).select("whole", "lang", "at", f1.alias("f1"), F.sum("t").over(mine).alias("toxic"), F.sum("n").over(mine).alias("all"))
    best = cells.where("least(toxic, `all` - toxic) >= 20").groupBy("whole", "lang").agg(F.max_by("at", F.struct("f1", "at")).alias("at")).collect()
    model.overall = next((r["at"] / STEPS for r in best if r.whole), THRESHOLD)
    model.by_lang = {r.lang: r["at"] / STEPS for r in best if not r.whole}


def _threshold(p: np.ndarray, y: np.ndarray) -> float | None:
    """The score with the best F1, or None where either class has fewer than 20 rows."""
    if min(y.sum(), len(y) - y.sum()) < 20:
        return None
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    k = int(f1.argmax())
    low = p[order[k + 1]] if k + 1 < len(p) else 0.0
    return float((p[order[k]] + low) / 2)


def fit(docs: DataFrame, labels: DataFrame, where: Column | None = None, sample: int = SAMPLE) -> Model:
    """Fit on all documents whose doc_id has a ``toxic`` label (0 or 1) that ``where`` (on doc_id) admits.

    About ``sample`` of them give the model to begin with; if there are more, ``ROUNDS`` passes over all of them follow.
    """
    known = F.col("toxic").isin(0, 1) if where is None else F.col("toxic").isin(0, 1) & where
    toxic = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    rows = labelled_documents(docs, toxic, sample, "toxicity", known)

    def extract(batches):
        for batch in batches:
            toxic, lang, digests = batch.column("toxic"), batch.column("lang"), batch.column("digest")
            for lo, hi, data, offsets in chunks(batch.column("text")):
                ids, first = word_ids(data, offsets)
                yield pa.RecordBatch.from_arrays([
                    toxic.slice(lo, hi - lo), lang.slice(lo, hi - lo), digests.slice(lo, hi - lo),
                    pa.array([ids[:, a:b].astype("<i4").tobytes() for a, b in zip(first, first[1:])], pa.binary())], ["toxic", "lang", "digest", "ids"])

    got = rows.select("toxic", F.coalesce("lang", F.lit("")).alias("lang"), "digest", "text").mapInArrow(extract, "toxic int, lang string, digest binary, ids binary").collect()
    got.sort(key=lambda r: (r.digest, r.toxic, r.lang))  # the model follows the rows, not the order they come in
    texts = [np.frombuffer(r.ids, "<i4").reshape(PARTS, -1) for r in got]
    y, lang = np.array([r.toxic for r in got], int), np.array([r.lang for r in got], object)
    back = np.array([r.digest[0] % 5 == 4 for r in got], bool)
    trainer = _trained([t for t, b in zip(texts, back) if not b], y[~back])
    model = trainer.model
    n = one_label(toxic, known).count()
    if n > sample:
        every = every_labelled(docs, toxic, "toxicity", known).select("draw", "toxic", F.coalesce("lang", F.lit("")).alias("lang"), "digest", "text")
        every = cut_lineage(every.withColumn("back", F.conv(F.hex(F.substring("digest", 1, 1)), 16, 10).cast("int") % 5 == 4))
        used = every.where(~F.col("back")).drop("back")
        seen = used.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
        trainer.ratio = _ratio(seen.n, seen.t)
        for i in range(ROUNDS):
            _round(trainer, used, min(MOST_SHARDS, -(-n // sample)), i)
        _thresholds(model, every.where("back"))
    elif back.any():
        p = np.concatenate([model.scores(*padded(t, np.array([0, t.shape[1]]))) for t, b in zip(texts, back) if b])
        model.overall = _threshold(p, y[back]) or THRESHOLD
        for name in np.unique(lang[back].astype(str)):
            mine = lang[back] == name
            model.by_lang[str(name)] = _threshold(p[mine], y[back][mine]) or model.overall
    return model


def score(model: Model, docs: DataFrame, text: str = "text") -> Column:
    """Column of toxicity scores of a text column."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(column: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for lo, hi, data, offsets in chunks(column, 1 << 20):
            out.append(shared.value.scores(*padded(*word_ids(data, offsets))))
        return pa.array(np.concatenate(out))

    return F.arrow_udf(rate, "double")(F.col(text))


def threshold(model: Model, lang: str = "lang") -> Column:
    """The calibrated threshold of a row's language."""
    out = F.lit(model.overall)
    for name, t in sorted(model.by_lang.items()):
        out = F.when(F.coalesce(F.col(lang), F.lit("")) == name, t).otherwise(out)
    return out


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3 (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, flagged (by the language's threshold) of every document."""
    model = fit(docs, labels, fold() != 1)
    rated = docs.select("doc_id", "lang", score(model, docs).alias("score"))
    return rated.select("doc_id", (fold() == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                        (F.col("score") >= threshold(model)).alias("flagged"))
