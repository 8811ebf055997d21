"""Automata against dictionaries, and collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from brisa.llm import automata, collocations
from tests.llm.conftest import EDGE

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(phrases):
    """(labels, word numbers, counts) of a dictionary of phrases (tuples of bytes)."""
    labels = sorted({w for p in phrases for w in p})
    at = {w: i for i, w in enumerate(labels)}
    paths = np.array([[*(at[w] for w in p), *[-1] * (automata.WORDS - len(p))] for p in phrases], np.int32).reshape(-1, automata.WORDS)
    return labels, *automata.ordered(paths, np.array(list(phrases.values()), np.int64))


def as_dict(labels, paths, counts):
    return {tuple(labels[i] for i in p if i >= 0): int(c) for p, c in zip(paths.tolist(), counts.tolist())}


def some(rng, n=400, words=30):
    return {tuple(b"w%d" % rng.randrange(words) for _ in range(rng.randrange(1, 5))): rng.randrange(1, 1 << rng.choice([2, 40])) for _ in range(n)}


@pytest.mark.parametrize("seed", range(4))
def test_automata(seed):
    rng = random.Random(seed)
    a, b = some(rng), some(rng)
    one = automata.build(*table(a), batch=37)
    assert as_dict(one.labels, *one.phrases()) == a
    again = automata.Automaton.unpack(one.pack())
    assert as_dict(again.labels, *again.phrases()) == a
    both = automata.build(*automata.union([table(a), table(b)]))
    assert as_dict(both.labels, *both.phrases()) == dict(Counter(a) + Counter(b))
    asked = automata.build(*table({p: 1 for p in [*list(b)[:100], (b"none",), (b"w1", b"none")]}))
    assert as_dict(asked.labels, *one.compose(asked)) == {p: a[p] for p in list(b)[:100] if p in a}


def test_states_are_shared():
    """Equal endings are one state, across batches too."""
    same = {(b"w%03d" % i, *tail): 7 for i in range(300) for tail in ((b"a",), (b"a", b"b"), (b"c", b"d", b"e"))}
    a = automata.build(*table(same), batch=64)
    assert len(a.first) - 1 == 6  # none, after "a", "c" and "c d", after a first word, the root
    empty = automata.build([], np.zeros((0, automata.WORDS), np.int32), np.zeros(0, np.int64))
    assert len(empty.phrases()[1]) == 0 and len(empty.compose(a)[1]) == 0 and len(a.compose(empty)[1]) == 0


def brute(texts, top=collocations.TOP):
    f = {}
    for text, lang in texts:
        mine = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            mine.update(tuple(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(x for p, x in c.items() if len(p) == 1)
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= 30}
        around = Counter()
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[p[i:i + k]] = max(around[p[i:i + k]], a)
        rows = []
        for p, a in cand.items():
            score, _, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, k) for k in range(1, len(p)))
            if 100 * around[p] < 80 * a:
                rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def mined(df, **more):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in collocations.mine(df, **more).collect())


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = ["the", "Of", "ünï", "—", "x y", "\x01odd", "naïve", "ß", *(f"w{i}" for i in range(40))]
    lines = [[rng.choice(words) for _ in range(6)] for _ in range(8)]
    texts = []
    for _ in range(n):
        out = []
        for _ in range(rng.randrange(1, 12)):
            out += rng.choice(lines) if rng.random() < 0.4 else [rng.choice(words) for _ in range(rng.randrange(1, 9))]
            out.append(rng.choice([".", ",", "\n", "\t", " ", ";x", "\x0b", "!?"]))
        texts.append((" ".join(out), rng.choice(["en", "en", "en", "de", None, "und", ""])))
    return texts


def test_against_counting(make):
    texts = corpus(1) + [("hot line of copied words here", "en")] * 400
    want = brute(texts)
    assert len(want) > 20
    assert mined(make([(i, t, lang, "a", 1) for i, (t, lang) in enumerate(texts)]).repartition(5)) == want


def test_many_ranges_small_unions_and_a_narrow_filter(make, spark, monkeypatch):
    """Ranges of a few words, limits from a sample; arrays are merged and phrases united early; a short report."""
    monkeypatch.setattr(collocations, "RANGE", 40)
    monkeypatch.setattr(collocations, "TALLY", 100)
    monkeypatch.setattr(collocations, "SAMPLE", 60)
    texts = corpus(2)
    df = make([(i, t, lang, "a", 1) for i, (t, lang) in enumerate(texts)]).repartition(3)
    assert mined(df, top=7) == brute(texts, 7)


def test_filter_never_misses():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 64, 5000, dtype=np.uint64)
    slots, masks = {}, {}
    for p in collocations.Filter.places(h):
        for s, b in zip((p >> np.uint64(6)).tolist(), (p & np.uint64(63)).tolist()):
            slots[s] = slots.get(s, 0) | 1 << b
    f = collocations.Filter(np.array(list(slots)), np.array(list(slots.values()), np.uint64).view(np.int64))
    assert f.has(h).all() and f.has(rng.integers(0, 1 << 64, 5000, dtype=np.uint64)).mean() < 0.01


def test_edges(make, edge, empty):
    assert collocations.mine(empty).count() == 0
    assert mined(edge) == brute([(e[1], e[2]) for e in EDGE])
    assert mined(make([(1, None, None, "a", 1), (2, " . , ", "en", "a", 1)])) == []
    twice = [(1, "a b c d e. " * 15, None, "a", 1)] * 2  # repeated rows count each time; overlaps count
    assert mined(make(twice)) == brute([(t[1], t[2]) for t in twice])
    run = [(1, "na " * 100, "en", "a", 1)]
    assert mined(make(run)) == brute([(run[0][1], "en")])
