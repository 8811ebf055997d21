"""Repeatable models, secrets beside placeholders, long repeated urls, and wide buckets of the shingle join."""

import itertools
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from brisa.llm import catalog, chosen_path, ordinal, sampling, secrets, toxicity, url_rules
from tests.conftest import SF_SMALL
from tests.helpers import duck

# --- 4, 9 samples


def _tables(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet")


@pytest.mark.parametrize("module", [toxicity, ordinal])
def test_models_do_not_depend_on_partitions(spark, module):
    docs, labels = _tables(spark)
    key = lambda r: str(tuple(r))
    want = sorted(map(key, module.report(docs, labels).collect()))
    assert sorted(map(key, module.report(docs.repartition(7), labels.repartition(3)).collect())) == want
    backwards = docs.orderBy(F.desc("doc_id")).coalesce(1)
    assert sorted(map(key, module.report(backwards, labels.orderBy(F.desc("doc_id"))).collect())) == want


def test_equal_texts_have_equal_scores_anywhere(spark):
    """The same texts at other places of other chunks."""
    docs, labels = _tables(spark)
    model = toxicity.fit(docs, labels)
    texts = docs.select("text")
    many = texts.withColumn("n", F.lit(0)).unionByName(texts.withColumn("n", F.lit(1)).repartition(5)).unionByName(texts.withColumn("n", F.lit(2)).orderBy("text"))
    apart = many.select("text", toxicity.score(model, many).alias("s")).groupBy("text").agg(F.countDistinct("s").alias("k")).where("k > 1")
    assert apart.count() == 0


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    docs = spark.range(100_000).select(F.lit(5).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 3).alias("text"), F.lit("en").alias("lang"))
    docs = docs.unionByName(spark.createDataFrame([(6, "other", None), (7, None, "de")], "doc_id long, text string, lang string"))
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, 1), (7, 0), (8, 1)], "doc_id long, y int")
    got = sampling.labelled_documents(docs, labels, 100, "t").collect()
    assert len(got) == 3 and {r.y for r in got if r.text and r.text.startswith("text")} == {0}
    again = sampling.labelled_documents(docs.repartition(9), labels, 100, "t").collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


# --- 4 against a plain loop

def test_ordinal_against_a_plain_loop(spark):
    """Features, tails and decisions of the report, worked out word by word from the fitted weights."""
    docs, labels = _tables(spark)
    model = ordinal.fit(docs, ordinal.ratings(labels), 3)
    rows = {r.doc_id: r for r in ordinal.report(docs, labels).collect()}
    import numpy as np
    for r in docs.orderBy("doc_id").limit(40).collect():
        data = np.frombuffer((r.text or "").encode(), np.uint8)
        row, feature, value = ordinal.features(data, np.array([0, len(data)]))
        total = 0.0
        for f, v in zip(feature.tolist(), value.tolist()):
            total += model.weights[f] * v
        tails = [1 / (1 + np.exp(-(total - t))) for t in model.thresholds]
        got = rows[r.doc_id]
        assert got.p_good == pytest.approx(tails[0], abs=1e-9) and got.p_clean == pytest.approx(tails[1], abs=1e-9)
        assert got.expected_grade == pytest.approx(sum(tails), abs=1e-9) and got.keep == (tails[0] >= ordinal.KEEP)


# --- 5 secrets

KEY = "q7Zr2Kx9Lw4Tn8Vb3Hs6Jd1Gf5Pc0My7Rt2Xe9Ab"
LETTERS = "qWzRtKxLpTnVbHsJdGfPcMyBvNmQsXeAbDrF"
SECRETS = [KEY, "/sample/keys/" + KEY, KEY + "/example", KEY[:20] + "xxxx" + KEY[20:], LETTERS, "kqzvwxjtrpbnmgdhflsckqzvwxjtrpbnmgdh"]
WORDS = ["some/path/to-a_file/in/the/tree", "getUserNameFromTableOfAllUsers", "internationalisationally", "Donaudampfschiffahrtsgesellschaft",
         "1234567890-1234567890-1234567890", "123e4567-e89b-12d3-a456-426614174000", "example_example_example_example", "SOME-UPPER_CASE-CONSTANT", "/////////////////////", "xxxxxxxxxxxxxxxxxxxxxxxx"]


def _spans(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: [s for s in r.spans if s.kind.startswith("entropy")] for r in secrets.scan(docs).collect()}


def test_secrets_beside_placeholders_are_found(spark):
    got = _spans(spark, [f"a {s} b" for s in SECRETS])
    for i, s in enumerate(SECRETS):
        assert len(got[i]) == 1, s
        found = f"a {s} b"[got[i][0].start:got[i][0].end]
        assert "example" not in found and "sample" not in found and len(found) >= 24


def test_words_and_numbers_are_no_secrets(spark):
    assert [i for i, s in _spans(spark, [f"a {w} b" for w in WORDS]).items() if s] == []


def test_oracle_agrees_on_the_probe_texts(spark):
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    texts = [f"x {s} y" for s in SECRETS + WORDS]
    texts += ["".join(rng.choice(letters + "0123456789+/_-") for _ in range(rng.randrange(16, 90))) for _ in range(60)]
    texts += ["-".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 30))) for _ in range(3)) for _ in range(60)]
    texts += [KEY[:k] + "Example" + KEY[k:] for k in range(0, 40, 5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duck(SF_SMALL)
    con.execute("CREATE OR REPLACE TEMP TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = con.sql(catalog.ORACLE["op5_secret_scan"]).df().sort_values("doc_id")
    got = secrets.report(docs).toPandas().sort_values("doc_id")
    assert list(got.spans) == list(want.spans) and list(got.base_sha256) == list(want.base_sha256)


def test_most_random_letters_are_secrets(spark):
    rng = random.Random(9)
    mixed = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(36)) for _ in range(200)]
    lower = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(36)) for _ in range(200)]
    assert sum(bool(s) for s in _spans(spark, mixed).values()) >= 198
    assert sum(bool(s) for s in _spans(spark, lower).values()) >= 150


def test_a_very_long_candidate(spark):
    """No pattern recurses over the length of a candidate."""
    got = _spans(spark, ["abc/" * 4_000, "Ab" * 3_000, "abcdefgh" * 9_000])
    assert got[0] == [] and got[1] == []


# --- 8 url rules

def _brute_rules(rows, support, confidence):
    n, least = len(rows), -(-support * len(rows) // 1)
    out = {}
    sets = [(frozenset(t), v) for t, v in rows]
    seen = {x for t, _ in sets for k in (1, 2, 3) for x in itertools.combinations(sorted(t), k)}
    for x in seen:
        held = [v for t, v in sets if t.issuperset(x)]
        for v in set(held):
            if held.count(v) >= least and held.count(v) / len(held) >= confidence:
                out[x, v] = (held.count(v) / len(held), held.count(v) / n)
    return {(x, v): c for (x, v), c in out.items() if not any(u == v and len(y) < len(x) and set(y) <= set(x) and out[y, u][0] >= c[0] for y, u in out)}


@pytest.mark.parametrize("seed", range(3))
def test_mined_rules_equal_brute_force(spark, seed):
    """Tokens that always come together, tokens of one verdict, and tokens of both."""
    rng = random.Random(seed)
    rows = []
    for _ in range(120):
        t = {f"t{rng.randrange(7)}" for _ in range(rng.randrange(0, 5))}
        t |= {"pair1", "pair2"} if rng.random() < 0.3 else set()
        v = "block" if ("t1" in t and "t2" in t) or rng.random() < 0.3 else "allow"
        t |= {"onlyblock"} if v == "block" and rng.random() < 0.3 else set()
        rows.append((sorted(t), v))
    rows = [r for r in rows if r[0]]
    got = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.02, 0.6).collect()
    have = {(tuple(r.antecedent), r.verdict): (r.confidence, r.support) for r in got}
    want = _brute_rules(rows, 0.02, 0.6)
    assert len(have) == len(got) and have.keys() == want.keys()
    assert all(have[k] == pytest.approx(want[k]) for k in want)


def test_long_repeated_urls_end(spark):
    """300 copies of a url of 60 tokens, among urls of both verdicts that share all of them."""
    path = "/".join(f"w{i}x" for i in range(58))
    urls = [f"http://a.net/{path}"] * 300 + [f"http://x.org/fr/{path}"] * 40 + [f"http://b{i}.net/{i}" for i in range(200)] + [f"http://c.de/{path}/{i}" for i in range(20)]
    began = time.time()
    got = url_rules.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    assert time.time() - began < 60 and len(got) == len(urls)
    assert {r.verdict for r in got if r.host == "c.de"} == {"block"} and {r.verdict for r in got if r.host == "x.org"} == {"allow"}


# --- 6 wide buckets

def _jaccard(texts):
    sets = [{tuple(t.split()[k:k + 5]) for k in range(max(len(t.split()) - 4, 1))} for t in texts]
    label, links = list(range(len(texts))), [0] * len(texts)
    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
            links[a] += 1
            links[b] += 1
            x, y = sorted((label[a], label[b]))
            label = [x if v == y else v for v in label] if x != y else label
    return {i: (label[i], links[i]) for i in range(len(texts))}


@pytest.mark.parametrize("small,few,depth", [(1024, 64, 5), (6, 2, 2), (6, 200, 5)])
def test_templates_and_common_lines(spark, monkeypatch, small, few, depth):
    """A template at similarity of about 0.7, short texts with one line, near copies; salted blocks at the last level, lopsided buckets."""
    for name, value in (("SMALL", small), ("FEW", few), ("DEPTH", depth), ("BLOCK", 16)):
        monkeypatch.setattr(chosen_path, name, value)
    rng = random.Random(small + few)
    line = lambda n: [f"v{rng.randrange(900)}" for _ in range(n)]
    template, common, base = line(80), line(12), line(100)
    texts = [template + line(rng.randrange(8, 26)) for _ in range(60)] + [common + line(rng.randrange(3, 9)) for _ in range(60)]
    for _ in range(60):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(100)] = f"v{rng.randrange(900)}"
        texts.append(w)
    texts = [" ".join(t) for t in texts]
    rng.shuffle(texts)
    got = chosen_path.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == _jaccard(texts)


# --- 3 licences as files have them

def _known(spark, name):
    from brisa.llm import licences
    return next(t for n, t in licences.KNOWN if n == name)


@pytest.mark.parametrize("name,title", [("MIT", "MIT License"), ("MIT", "The MIT License (MIT)"), ("ISC", "ISC License"), ("0BSD", "BSD Zero Clause License")])
@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_titled_commented_and_wrapped_licences(spark, name, title, mark):
    import textwrap
    from brisa.llm import licences
    text = _known(spark, name)
    wrapped = "\n".join("\n".join(textwrap.wrap(p, 62)) + "\n" for p in text.split("\n"))
    whole = f"{title}\n\nCopyright (c) 2019 A. Person\nAll rights reserved.\n\n{wrapped}"
    file = "\n".join(mark + line for line in whole.split("\n"))
    docs = spark.createDataFrame([(1, file), (2, file + "\nand more"), (3, wrapped)], "doc_id long, text string")
    got = {r.doc_id: r.licence for r in licences.scan(docs, licences.known(spark)).collect()}
    assert got == {1: name, 2: None, 3: name}


def test_licences_known_by_digest(spark):
    """Whole texts of this machine, where it has them; a table's own digests; texts win over digests of one row."""
    import os
    from brisa.llm import licences
    folder = "/usr/share/common-licenses"
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    texts = [(i, open(f"{folder}/{f}").read(), n) for i, (f, n) in enumerate(files.items()) if os.path.exists(f"{folder}/{f}")]
    docs = spark.createDataFrame([(i, "\n".join("# " + x for x in t.split("\n"))) for i, t, _ in texts] + [(99, "my licence\ntext"), (98, "text")], "doc_id long, text string")
    got = {r.doc_id: r.licence for r in licences.scan(docs, licences.known(spark)).collect()}
    assert got == {**{i: n for i, _, n in texts}, 99: None, 98: None}
    own = spark.createDataFrame([("mine", None, licences.digest("My  License text")), ("other", "Text.", "00")], "licence string, text string, digest string")
    got = {r.doc_id: r.licence for r in licences.scan(docs, own).collect() if r.doc_id > 90}
    assert got == {99: "mine", 98: "other"}
    assert len({n for n, _ in (*licences.DIGESTS, *((n, 0) for n, t in licences.KNOWN if len(t) > 300))}) >= 10


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """A word that no row of the sample has is learnt; the model does not depend on partitions, and thresholds follow all rows kept back."""
    rated = []
    real = toxicity._thresholds
    monkeypatch.setattr(toxicity, "_thresholds", lambda model, rows: rated.append(rows.count()) or real(model, rows))
    ids = spark.range(900).withColumnRenamed("id", "doc_id")
    labels = ids.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    drawn = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30)) < int(100 / 900 * (1 << 30))
    word = F.when(F.col("doc_id") % 3 != 0, "calm").when(drawn, "nasty").otherwise("zorgblat")
    docs = ids.select("doc_id", F.concat_ws(" ", F.lit("some text"), F.md5(F.col("doc_id").cast("string")), word).alias("text"), F.lit("en").alias("lang"))
    model = toxicity.fit(docs, labels, sample=100)
    data = np.frombuffer(b"zorgblat", np.uint8)
    at = toxicity.word_ids(data, np.array([0, 8]))[0]
    assert all(np.abs(model.table[k][at[k]]).max() > 0 for k in range(toxicity.PARTS))
    back = docs.where(F.conv(F.substring(F.md5("text"), 1, 2), 16, 10).cast("int") % 5 == 4)
    assert rated == [back.count()] and set(model.by_lang) == {"en"}
    got = {r.w: r.s for r in docs.select(word.alias("w"), toxicity.score(model, docs).alias("s")).groupBy("w").agg(F.avg("s").alias("s")).collect()}
    assert got["zorgblat"] > 0.5 > got["calm"]
    again = toxicity.fit(docs.repartition(5), labels.repartition(3), sample=100)
    assert (again.table == model.table).all() and again.constant == model.constant and again.by_lang == model.by_lang
