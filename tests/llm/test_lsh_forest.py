"""The LSH forest against all pairs: hot groups, templates, every way through wide regions, edge cases."""

import random
import re

import pytest

from brisa.llm import lsh_forest
from tests.llm.conftest import EDGE

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {" ".join(w[i:i + 2]) for i in range(max(1, len(w) - 1))} if w else set()


def brute(texts):
    """Least index of every text's component."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))], [len(s) for s in sets]


def check(make, texts):
    got = {r.doc_id: r for r in lsh_forest.cluster(make([(i, t, "en", "a", 1) for i, t in enumerate(texts)])).collect()}
    want, sizes = brute(texts)
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert [got[i].component_id for i in range(len(texts))] == want
    assert all(got[i].kept == (want[i] == i) for i in range(len(texts)))


def corpus(seed):
    """Near copies of one text, pages of one template, texts with one common line, chains, and texts of their own."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    line = lambda n: [word() for _ in range(n)]

    def edited(base, n):
        out = list(base)
        for _ in range(n):
            out[rng.randrange(len(out))] = word()
        return out

    base, template, common = line(120), line(100), line(12)
    texts = [edited(base, rng.randrange(0, 9)) for _ in range(70)] + [edited(base, rng.randrange(9, 20)) for _ in range(40)]
    texts += [template + line(rng.randrange(10, 45)) for _ in range(80)]
    texts += [common + line(rng.randrange(3, 12)) for _ in range(70)]
    step = line(60)
    for _ in range(25):
        step = edited(step, 2)
        texts.append(step)
    texts += [line(rng.randrange(1, 40)) for _ in range(60)]
    texts += [texts[0]] * 40
    texts = [" ".join(t) for t in texts]
    rng.shuffle(texts)
    return texts


def test_hot_groups(make):
    check(make, corpus(1))


@pytest.mark.parametrize("wide,few", [(20, 2), (20, 64)])
def test_wide_regions_lose_nothing(make, monkeypatch, wide, few):
    """Deeper steps, salted blocks at the last one, lopsided regions, and blocks of large classes."""
    monkeypatch.setattr(lsh_forest, "WIDE", wide)
    monkeypatch.setattr(lsh_forest, "FEW", few)
    monkeypatch.setattr(lsh_forest, "BLOCK", 16)
    monkeypatch.setattr(lsh_forest, "TURNS", 1)
    check(make, corpus(2))


def test_without_neighbours(make, monkeypatch):
    """The regions alone find what the neighbours find."""
    monkeypatch.setattr(lsh_forest, "LCP", 99)
    monkeypatch.setattr(lsh_forest, "BLOCK", 16)
    check(make, corpus(3)[:200])


def test_orders_are_distinct_coordinates():
    for step, (depth, trees) in enumerate(lsh_forest.FOREST):
        got = lsh_forest.orders(step)
        assert got.shape == (trees, depth + lsh_forest.TAIL) and all(len(set(r)) == len(r) for r in got.tolist())
        assert (1 - 0.8 ** depth) ** trees < 1e-4


def test_edges(edge, empty):
    got = {}
    for r in lsh_forest.cluster(edge).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(EDGE)
    for i in (1, 2, 3):
        assert (got[i][0].n_shingles, got[i][0].component_id, got[i][0].kept) == (0, i, True)
    assert got[4][0].n_shingles == 1 and got[9][0].n_shingles == 1
    assert len(got[6]) == 2 and all(r.component_id == 6 and r.kept for r in got[6])
    assert got[7][0].component_id == 6 and not got[7][0].kept
    assert got[None][0].component_id is None and got[None][0].kept
    assert got[5][0].n_shingles == len(shingles(next(e[1] for e in EDGE if e[0] == 5)))
    assert lsh_forest.cluster(empty).count() == 0


def test_null_ids_give_way(make):
    rows = [(None, "a b c d e f", "en", "a", 1), (9, "A b c d e f", "en", "a", 1), (3, "a B c d e f g", "en", "a", 1), (None, "x y", "en", "a", 1), (None, "x y", "en", "a", 1)]
    got = sorted(((r.n_shingles, r.doc_id is None, r.component_id, r.kept) for r in lsh_forest.cluster(make(rows)).collect()), key=str)
    assert got == sorted([(5, True, 3, False), (5, False, 3, False), (6, False, 3, True), (1, True, None, True), (1, True, None, True)], key=str)
