"""Operators that SQL cannot express, against brute force or held-out rows."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brisa.llm import catalog, chosen_path, context_tree, nn_descent, ordinal, phrase_index, secrets, toxicity
from brisa.llm.common import ALNUM, LOWER, SPACED, chunks, shingle_hashes, word_hashes, words
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s or "")


# --- shared word kernels

def test_words_and_hashes_match_a_plain_split():
    rng = random.Random(3)
    texts = ["".join(rng.choice("aB3 é.\n\t-\x00") for _ in range(rng.randrange(60))) for _ in range(300)] + [None, ""]
    seen = {}
    for member, split in ((SPACED, lambda s: re.findall(r"[^\x20\x09-\x0D]+", low(s))), (ALNUM, lambda s: WORD.findall(low(s)))):
        for limit in (1, 50, 1 << 20):
            for lo, hi, data, offsets in chunks(pa.array(texts, pa.string()), limit):
                data = LOWER[data]
                starts, ends, first = words(data, offsets, member)
                h = word_hashes(data, starts, ends)
                for i in range(hi - lo):
                    mine = range(first[i], first[i + 1])
                    assert [bytes(data[starts[k]:ends[k]]).decode() for k in mine] == split(texts[lo + i])
                    for k, w in zip(mine, split(texts[lo + i])):
                        assert seen.setdefault(w, h[k]) == h[k]
    assert len(set(seen.values())) == len(seen)


def test_shingles_stay_within_their_row():
    h = np.arange(1, 13, dtype=np.uint64)
    first = np.array([0, 0, 3, 8, 8, 12])
    s, at = shingle_hashes(h, first, 4)
    assert np.diff(at).tolist() == [0, 1, 2, 0, 1]
    alone, _ = shingle_hashes(h[3:8], np.array([0, 5]), 4)
    assert s[1:3].tolist() == alone.tolist() and len(set(s.tolist())) == 4


# --- 2 context-tree weighting

class PlainTree:
    """One context tree per decision node, by the definition."""

    def __init__(self, texts, depth):
        self.depth, self.n = depth, {}
        for s in texts:
            s = b"\n" * depth + s
            for i in range(depth, len(s)):
                for d in range(depth + 1):
                    for t in range(8):
                        key = (s[i - d:i], (1 << t) | s[i] >> (8 - t))
                        self.n.setdefault(key, [0, 0])[s[i] >> (7 - t) & 1] += 1

    def log_kt(self, key):
        a, b = self.n[key]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def log_w(self, key):
        context, node = key
        if len(context) == self.depth:
            return self.log_kt(key)
        below = sum(self.log_w(k) for k in self.n if k[1] == node and len(k[0]) == len(context) + 1 and k[0][1:] == context)
        return float(np.logaddexp(math.log(.5) + self.log_kt(key), math.log(.5) + below))

    def one(self, context, node, d=0):
        key = (context[len(context) - d:], node)
        if key not in self.n:
            return None
        a, b = self.n[key]
        p = (b + .5) / (a + b + 1)
        deeper = self.one(context, node, d + 1) if d < self.depth else None
        if deeper is None:
            return p
        w = math.exp(math.log(.5) + self.log_kt(key) - self.log_w(key))
        return w * p + (1 - w) * deeper

    def p(self, context, byte):
        out = 1.0
        for t in range(8):
            one = self.one(context, 1 << t | byte >> (8 - t))
            one = .5 if one is None else one
            out *= one if byte >> (7 - t) & 1 else 1 - one
        return out


def test_context_tree_equals_the_definition(spark):
    texts = ["abracadabra abra", "Cadabra\n abra", "é b", ""]
    streams = [b" ".join(low(t).encode().split()) + b"\n" for t in texts]
    depth = 3
    model = context_tree.train(spark.createDataFrame([(t,) for t in texts], "text string"), depth=depth)
    plain = PlainTree(streams, depth)
    seen = {(b"\n" * depth + s)[i:i + depth] for s in streams for i in range(len(s))} | {b"zzz", b"zra", b"\n\nq"}
    for context in sorted(seen):
        ctx = int.from_bytes(context, "big")
        got = np.exp2(model.cached(np.array([ctx << 8 | b for b in range(256)], dtype=np.uint64)))
        assert math.isclose(got.sum(), 1, rel_tol=1e-5)
        for b in b"abrcd \n\xc3z":
            assert math.isclose(got[b], plain.p(context, b), rel_tol=1e-4)


def test_streams_and_grams():
    texts = ["A b", "", "  c\td  ", None, "éa"]
    (_, _, data, offsets), = chunks(pa.array(texts, pa.string()))
    out, at = context_tree.streams(data, offsets)
    assert [bytes(out[a:b]) for a, b in zip(at, at[1:])] == [b"a b\n", b"\n", b"c d\n", b"\n", "éa\n".encode()]
    key = context_tree.grams(out, at, 2)
    for a, b in zip(at, at[1:]):
        s = b"\n\n" + bytes(out[a:b])
        assert [int(k) for k in key[a:b]] == [int.from_bytes(s[i:i + 3], "big") for i in range(b - a)]


def test_context_tree_base_score_by_brute_force(spark):
    got = catalog.QUERIES["op2_context_tree_score"](spark, SF_SMALL).toPandas().set_index("doc_id")
    texts = {r.doc_id: low(r.text).encode().split() for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    c = Counter(w for d, ws in texts.items() if not held[d] for w in ws)
    c[None] = sum(not h for h in held.values())
    n, v = sum(c.values()), len(c)
    assert set(got.index) == set(texts)
    for d, ws in texts.items():
        ws = ws + [None]
        r = got.loc[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    bits = -got[got.held_out].score.sum() / math.log10(2) / got[got.held_out].n_bytes.sum()
    assert bits < 3  # 8 without a model; about 4.2 for single letters


def test_rare_tokens_are_joined(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"the the rare{i % 5} once{i}") for i in range(60)], "doc_id long, text string")
    want = sorted((r.doc_id, r.n_known, round(r.base_score, 9)) for r in context_tree.report(docs).collect())
    monkeypatch.setattr(context_tree, "HEAD", 1)
    assert sorted((r.doc_id, r.n_known, round(r.base_score, 9)) for r in context_tree.report(docs).collect()) == want


def test_scores_use_every_node_of_the_tree(spark):
    """Random letters three times over: the next letter follows from five before it, in more nodes than were once kept."""
    text = "".join(random.Random(8).choices("abcdefghijklmnopqrstuvwxyz", k=200_000))
    docs = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string")
    for r in context_tree.score(docs, F.lit(False)).collect():
        assert -r.score / math.log10(2) / r.n_bytes < 3  # 4.7 for single letters


@pytest.mark.parametrize("head", [0, 3, 1 << 21])
def test_scores_equal_the_definition_with_any_head(spark, monkeypatch, head):
    monkeypatch.setattr(context_tree, "HEAD_GRAMS", head)
    texts = ["abracadabra abra", "Cadabra\n abra", "é b", "", None, "zebra cadab\x00 qué", "abra abra abra"]
    streams = [b" ".join(low(t).encode().split()) + b"\n" for t in texts]
    plain = PlainTree([s for i, s in enumerate(streams) if i < 5], 3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in context_tree.score(docs, F.col("doc_id") >= 5, depth=3).collect()}
    for i, s in enumerate(streams):
        padded = b"\n\n\n" + s
        assert math.isclose(got[i], sum(math.log10(plain.p(padded[k:k + 3], padded[k + 3])) for k in range(len(s))), rel_tol=1e-5)


# --- 4 ordinal classifier, 9 toxicity

def test_ordinal_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    ratings = ordinal.ratings(labels)
    model = ordinal.fit(docs, ratings.where("doc_id % 3 <> 0"), 3)
    assert model.thresholds[0] <= model.thresholds[1]
    rows = docs.join(ratings.where("doc_id % 3 = 0"), "doc_id").select("grade", ordinal.score(model, docs).alias("r")).collect()
    good = [r for r in rows if r.grade > 0]
    assert sum(r.r.tails[0] >= ordinal.KEEP for r in good) / len(good) > 0.98
    bad = [r for r in rows if r.grade == 0]
    assert sum(r.r.tails[0] < ordinal.KEEP for r in bad) / len(bad) > 0.9
    mean = [np.mean([r.r.expected for r in rows if r.grade == g]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2]


def test_ordinal_gradient_separates_ordered_grades():
    grade = np.repeat([0, 1, 2], 30)
    m = ordinal._train(np.arange(90), np.repeat([5, 6, 7], 30), np.ones(90), grade, 3)
    t = m.tails(m.weights[[5, 6, 7]])
    assert t[0, 0] < .2 and t[1, 0] > .8 and t[1, 1] < .2 and t[2, 1] > .8


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = catalog.QUERIES["op9_toxicity"](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    toxic, clean = got[got.toxic == 1], got[got.toxic == 0]
    assert toxic.predicted.mean() > 0.85 and clean.predicted.mean() < 0.03
    assert toxic.flagged.mean() > 0.85 and clean.flagged.mean() < 0.03


def test_convolution_scores_equal_a_plain_loop():
    rng = np.random.default_rng(0)
    m = toxicity._train([rng.integers(0, 50, (toxicity.PARTS, n)).astype(np.int32) for n in (3, 1, 0, 7, 2, 5)], np.array([0, 1, 0, 1, 0, 1]))
    texts = [rng.integers(0, 60, (toxicity.PARTS, n)).astype(np.int32) for n in (0, 1, 2, 9)]
    first = np.concatenate([[0], np.cumsum([t.shape[1] for t in texts])])
    got = m.scores(*toxicity.padded(np.concatenate(texts, axis=1), first))
    for t, p in zip(texts, got):
        x = np.concatenate([sum(m.table[k][t[k]] for k in range(toxicity.PARTS)).reshape(-1, toxicity.WIDTH), np.zeros((2, toxicity.WIDTH))])
        best = [max((sum(x[i + j] @ w[j] for j in range(len(w)))[f] for i in range(t.shape[1])), default=0) for w in m.filters for f in range(toxicity.FILTERS)]
        hidden = np.maximum(np.array(best) + m.bias, 0) if t.shape[1] else np.zeros(len(best))
        assert math.isclose(p, 1 / (1 + math.exp(-(hidden @ m.out + m.constant))), rel_tol=1e-4)


# --- 5 secrets: what the SQL comparison does not reach

def test_secrets_with_very_many_matches(spark):
    text = " ".join(f"x token={i:08d}q" for i in range(3000)) + " " + "Zk3" * 4000 + " é AKIA" + "Q7" * 8
    r = secrets.report(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    spans = [tuple(s.split(":")) for s in r.spans.split(",")]
    base = [(k, m.start(), m.end()) for k, p in (("assign", r"token=([A-Za-z0-9+/_.=-]+)"), ("access", r"AKIA[A-Z0-9]+")) for m in re.finditer(p, text)]
    assert [(k, int(s), int(e)) for k, s, e in spans if k in ("assign", "access")] == base
    assert r.n_assign == 3000 and r.n_access == 1


def test_redaction_merges_overlapping_spans(spark):
    text = 'é token = "1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae" end password=abcdefgh1'
    docs = spark.createDataFrame([(1, text, len(text))], "doc_id long, text string, n_chars long")
    r = secrets.redact(docs).collect()[0]
    assert r.text == 'é [secret]" end [secret]' and r.n_chars == len(r.text)


# --- 6 near duplicates

def _jaccard_classes(texts):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(low(t))
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()
    links, label = Counter(), {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
            links[a] += 1
            links[b] += 1
            x, y = sorted((label[a], label[b]))
            label = {i: x if v == y else v for i, v in label.items()} if x != y else label
    return {i: (label[i], links[i]) for i in sets}


@pytest.mark.parametrize("small, block", [(48, 128), (3, 8)])
def test_join_equals_brute_force(spark, monkeypatch, small, block):
    """One hot group of near copies, exact copies, chains, and a passage that all share; also with buckets and blocks made tiny."""
    monkeypatch.setattr(chosen_path, "SMALL", small)
    monkeypatch.setattr(chosen_path, "BLOCK", block)
    rng = random.Random(5)
    vocab = [f"t{i}" for i in range(400)]
    shared = [rng.choice(vocab) for _ in range(30)]
    seed = [rng.choice(vocab) for _ in range(120)]
    texts = {}
    for i in range(70):  # near copies of one text, some at the edge of similarity
        w = list(seed)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        texts[i] = " ".join(w)
    for i in range(70, 130):
        texts[i] = " ".join(shared + [rng.choice(vocab) for _ in range(rng.randrange(60))])
    chain = [rng.choice(vocab) for _ in range(90)]
    for i in range(130, 140):
        chain = chain[5:] + [rng.choice(vocab) for _ in range(5)]
        texts[i] = " ".join(chain)
    for i in range(140, 150):
        texts[i] = texts[130]
    got = chosen_path.join(spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == _jaccard_classes(texts)


def test_runs_follow_the_target_recall():
    assert chosen_path.runs(0.99) < chosen_path.runs(0.9999) and chosen_path.runs(depth=1) < chosen_path.runs(depth=5)


# --- 7 phrases in several blocks

def test_phrases_do_not_depend_on_benchmark_blocks(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(tuple, phrase_index.report(docs, bench).collect()))
    monkeypatch.setattr(phrase_index, "BLOCK_BYTES", 4000)
    assert sorted(map(tuple, phrase_index.report(docs, bench).collect())) == want
    assert any(r[5] for r in want)


# --- 10 nearest neighbours

def _recall(spark, vectors, ids):
    table = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>")
    got = {}
    for r in nn_descent.nearest(table, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    x = np.asarray(vectors, np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        sim = x @ x[q]
        sim[q] = -9
        order = np.lexsort((ids, -sim))[:5]
        mine = got[ids[q]]
        assert [mine[k][1] for k in range(1, 6)] == sorted((v for _, v in mine.values()), reverse=True)
        for v, s in mine.values():
            assert math.isclose(s, sim[np.flatnonzero(ids == v)[0]], abs_tol=1e-9)
        hits += len(set(ids[order]) & {v for v, _ in mine.values()})
        total += 5
    return hits / total


def test_recall_on_spread_vectors(spark):
    rng = np.random.default_rng(2)
    assert _recall(spark, rng.normal(size=(4000, 32)), np.arange(4000)) >= 0.9


def test_recall_with_a_third_in_one_tight_cluster(spark):
    rng = np.random.default_rng(4)
    tight = rng.normal(size=16) + 0.01 * rng.normal(size=(1000, 16))
    assert _recall(spark, np.concatenate([tight, rng.normal(size=(2000, 16))]), rng.permutation(3000)) >= 0.9


def test_ties_go_to_the_smaller_id(spark):
    """Forty vectors at one angle to the query, and forty multiples of one vector."""
    e = np.eye(100)
    rng = np.random.default_rng(6)
    vectors = np.concatenate([e[:1], e[0] + e[1:41], e[50:51] * 2.0 ** np.arange(-20, 20)[:, None], e[50:51] + e[60:62], -0.0 - e[70:90]])
    ids = np.concatenate([[0], rng.permutation(np.arange(1, 41)), 50 + rng.permutation(40), [93, 94], np.arange(101, 121)])
    table = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    got = {}
    for r in nn_descent.nearest(table, F.col("vec_id").isin(0, 50)).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    assert got == {0: {k: k for k in range(1, 6)}, 50: {k: 50 + k for k in range(1, 6)}}


# --- the pipeline, stage by stage

def test_pipeline_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    cols, left, kept = docs.columns, docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in left.collect()}
        out = stage(spark, left, SF_SMALL)
        rows = {r.doc_id: r for r in out.collect()}
        kept[name] = (before, rows)
        if name != "mix":
            assert out.columns == cols
            left = spark.createDataFrame(list(rows.values()), docs.schema)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    before, rows = kept["quality"]
    gone = set(before) - set(rows)
    assert gone and not [d for d in gone if labels.get(d) == 1] and all(rows[d] == before[d] for d in rows)
    before, rows = kept["near_duplicates"]
    classes = _jaccard_classes({d: r.text for d, r in before.items()})
    assert set(rows) == {d for d, (c, _) in classes.items() if c == d} and all(rows[d] == before[d] for d in rows)
    before, rows = kept["decontamination"]
    windows = set()
    for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect():
        w = WORD.findall(low(r.text))
        windows |= {" ".join(w[i:i + 10]) for i in range(max(len(w) - 9, 1))} if w else set()
    clean = {d for d, r in before.items() if not any(f" {x} " in f" {' '.join(WORD.findall(low(r.text)))} " for x in windows)}
    assert set(rows) == clean and len(clean) < len(before)
    before, rows = kept["secret_scan"]
    assert set(rows) == set(before)
    for d, r in rows.items():
        assert not re.search(r"AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}", r.text) and r.n_chars == len(r.text)
        assert r.text == before[d].text or "[secret]" in r.text
    before, rows = kept["mix"]
    assert set(rows) == set(before)
    for d, r in rows.items():
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", before[d].text)) and r.taken <= 3 * r.size
    for s in {r.source for r in rows.values()}:
        mine = [r for r in rows.values() if r.source == s]
        rest = [r.size for r in mine if r.taken < 3 * r.size and r.size]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(rest, default=0)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_SMALL).collect())) == sorted(map(tuple, rows.values()))
