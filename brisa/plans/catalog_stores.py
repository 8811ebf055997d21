"""Registered queries over stored forms of the tables: partitioned series, ingested JSON, the word index, the
co-bucketed star, partial aggregates, repeatable runs, versions and the compacted log."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from brisa.functions import text as TX
from brisa.operators import knn as KNN
from brisa.operators import partials as PA
from brisa.operators import word_index as WI
from brisa.operators.relational import having_count
from brisa.plans import reviews as E
from brisa.plans import standins as S
from brisa.plans import wind as W
from brisa.plans.catalog_models import K, STAMPS, WIND_SQL, _parts, _r6, holdout_sql, knn_sql
from brisa.plans.catalog_reviews import DROPPED, MARKER, ORACLE, REGIONS, SEP
from brisa.plans.catalog_series import AS_OF, E11_SQL, training_set
from brisa.plans.registry import register
from brisa.plans.tables import table as T
from brisa.session import scratch_path
from brisa.sources import ingest as IN
from brisa.sources import series as SE
from brisa.sources import sinks as SK
from brisa.sources import star as ST

AUTH, NEG = S.AUTH, S.NEG


# ------------------------------------------------------------------ M2: the leaf directory
_THREE = f"SELECT *, CAST(hour(time) AS DOUBLE) AS x3 FROM ({WIND_SQL})"


@register("knn_three_features", f"""SELECT qid AS test_id, rk, rid, round(d2, 6) AS d2 FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d2, rid) AS rk FROM
    (SELECT q.id AS qid, t.id AS rid, (q.x1 - t.x1) * (q.x1 - t.x1) + (q.x2 - t.x2) * (q.x2 - t.x2) + (q.x3 - t.x3) * (q.x3 - t.x3) AS d2
     FROM (SELECT * FROM ({_THREE}) WHERE is_test) q, (SELECT * FROM ({_THREE}) WHERE NOT is_test) t)) WHERE rk <= {K}""")
def knn_three_features(spark, d):
    """The nearest training rows by speed, angle and hour of the day."""
    rows = training_set(spark, d).select(F.col("event_id").alias("id"), F.col("Speed").alias("x1"), F.col("Angle").alias("x2"),
                                         F.hour("time").cast("double").alias("x3"), F.col("Energy").alias("y"))
    rows = KNN.hash_split(rows, "id", "420")
    nb = KNN.nearest(rows.filter(~F.col("is_test")), rows.filter(F.col("is_test")), K, ("x1", "x2", "x3"))
    return nb.select(F.col("qid").alias("test_id"), F.col("rk").cast("bigint").alias("rk"), "rid", _r6("d2"))


@register("knn_saved_index", f"""SELECT qid AS test_id, round(avg(y), 6) AS prediction FROM
    ({knn_sql(f"SELECT * FROM ({WIND_SQL}) WHERE NOT is_test", f"SELECT * FROM ({WIND_SQL}) WHERE is_test", K)}) GROUP BY qid""")
def knn_saved_index(spark, d):
    """An index built for more neighbours, saved, loaded and searched."""
    tr, te = _parts(spark, d)
    path = scratch_path(spark, "knn-index")
    KNN.build_index(tr, 3 * K).save(path)
    p = KNN.search_predict(KNN.LV.Directory.load(spark, path), te, K)
    return p.select(F.col("qid").alias("test_id"), F.round("prediction", 6).alias("prediction"))


# ------------------------------------------------------------------ S4-S6: the partitioned series
_SCANS_SQL = " UNION ALL ".join(f"SELECT '{name}' AS scan, event_id, ts AS time, value AS \"Total\" FROM events WHERE {where}" for name, where in (
    ("trailing", f"ts > TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY"), ("history", f"ts > TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY AND ts <= TIMESTAMP '{AS_OF}' AND event_type = 'click'"),
    ("horizon", f"ts > TIMESTAMP '{AS_OF}'")))


def _series(spark, d):
    """Events as a series: all of them, then the last days loaded a second time."""
    path = scratch_path(spark, "series")
    rows = T(spark, d, "events").select(F.col("ts").alias("time"), F.col("value").alias("Total"), "event_id", "event_type")
    SE.write_series(rows, path)
    SE.write_series(rows.filter(F.col("time") >= F.to_timestamp_ntz(F.lit("2024-01-20 00:00:00"))), path)
    return SE.read_series(spark, path, "time timestamp_ntz, Total double, event_id bigint, event_type string")


def series_scans(series):
    """The three scans of the wind job over a partitioned series."""
    return {"trailing": SE.trailing_window(series, "time", AS_OF, 10), "history": SE.bounded_history(series, "time", AS_OF, 10, "event_type", "click"),
            "horizon": SE.future_horizon(series, "time", AS_OF)}


@register("partitioned_scans", _SCANS_SQL)
def partitioned_scans(spark, d):
    out = None
    for name, df in series_scans(_series(spark, d)).items():
        part = df.select(F.lit(name).alias("scan"), "event_id", "time", "Total")
        out = part if out is None else out.unionByName(part)
    return out


@register("partitioned_training_set", f"""SELECT event_id, time, round(Energy, 6) AS "Energy", Speed AS "Speed", Angle AS "Angle" FROM ({E11_SQL})""")
def partitioned_training_set(spark, d):
    """E11 from two partitioned series."""
    paths = {}
    for name, df in (("generation", S.generation(spark, d)), ("forecasts", S.forecasts(spark, d))):
        paths[name] = scratch_path(spark, f"series-{name}")
        SE.write_series(df, paths[name])
    gen = SE.trailing_window(SE.read_series(spark, paths["generation"]), "time", AS_OF, 365).drop(SE.DAY)
    fc = SE.bounded_history(SE.read_series(spark, paths["forecasts"]), "time", AS_OF, 365).drop(SE.DAY)
    return W.e11_training_set(gen, fc, AS_OF, 365).select("event_id", "time", _r6("Energy"), "Speed", "Angle")


# ------------------------------------------------------------------ S1, S2: ingest
_CUT = """'{"doc_id": ' || doc_id || ', "lang": "' || lang"""
_KIND = """'{"doc_id": "n' || doc_id || '", "lang": "' || lang || '"}'"""


@register("ingest_quarantine", f"""SELECT 'rows' AS part, doc_id, lang, length(text) AS n, NULL AS line FROM documents WHERE doc_id % 50 NOT IN (7, 11, 13)
    UNION ALL SELECT 'quarantine', NULL, NULL, NULL, CASE WHEN doc_id % 50 = 7 THEN {_CUT} WHEN doc_id % 50 = 11 THEN {_KIND} ELSE '[' || doc_id || ', ' END
    FROM documents WHERE doc_id % 50 IN (7, 11, 13)""")
def ingest_quarantine(spark, d):
    """Documents as JSON lines, some cut short, some of a wrong type, some no object: rows and quarantine."""
    k = F.pmod("doc_id", F.lit(50))
    n = F.col("doc_id").cast("string")
    line = (F.when(k == 7, F.concat(F.lit('{"doc_id": '), n, F.lit(', "lang": "'), "lang"))
            .when(k == 11, F.concat(F.lit('{"doc_id": "n'), n, F.lit('", "lang": "'), "lang", F.lit('"}')))
            .when(k == 13, F.concat(F.lit("["), n, F.lit(", "))).otherwise(F.to_json(F.struct("doc_id", "lang", "text"))))
    source = scratch_path(spark, "ingest-lines")
    T(spark, d, "documents").select(line.alias("value")).write.text(source)
    got = IN.ingest_jsonl(spark, source, "doc_id bigint, lang string, text string", scratch_path(spark, "ingest"), required=("doc_id",))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    rows = got.rows().select(F.lit("rows").alias("part"), "doc_id", "lang", F.length("text").cast("bigint").alias("n"), none("string", "line"))
    return rows.unionByName(got.quarantine().select(F.lit("quarantine").alias("part"), none("bigint", "doc_id"), none("string", "lang"), none("bigint", "n"), "line"))


# ------------------------------------------------------------------ P9-P14, E6-E9: the word index
def _indexed(spark, d, terms):
    """Reviews without their texts, with a mark for each term from a word index of the texts."""
    reviews = S.reviews(spark, d)
    index = WI.build(reviews, scratch_path(spark, "word-index"))
    return index.mark(reviews.drop("text"), terms)


_FORMS = (("literal", TX.lexicon_literal), ("intended", TX.lexicon_intended), ("complement_literal", TX.complement_literal),
          ("complement_intended", TX.complement_intended))


@register("indexed_lexicon", f"""SELECT form, doc_id AS review_id FROM (
    SELECT 'literal' AS form, * FROM documents WHERE text LIKE '%whou%' OR text LIKE '%eaux%' AND (text LIKE '%ouen%' OR text LIKE '%licen%') UNION ALL
    SELECT 'intended', * FROM documents WHERE (text LIKE '%whou%' OR text LIKE '%eaux%') AND (text LIKE '%ouen%' OR text LIKE '%licen%') UNION ALL
    SELECT 'complement_literal', * FROM documents WHERE text LIKE '%whou%' OR text LIKE '%eaux%' AND (text NOT LIKE '%ouen%' OR text NOT LIKE '%licen%') UNION ALL
    SELECT 'complement_intended', * FROM documents WHERE (text LIKE '%whou%' OR text LIKE '%eaux%') AND NOT (text LIKE '%ouen%' OR text LIKE '%licen%'))""")
def indexed_lexicon(spark, d):
    """The four lexicon predicates from the index; no text is read after it is built."""
    marked, marks = _indexed(spark, d, AUTH + NEG)
    out = None
    for name, form in _FORMS:
        part = marked.filter(form(marks, AUTH, NEG)).select(F.lit(name).alias("form"), "review_id")
        out = part if out is None else out.unionByName(part)
    return out


@register("indexed_word_share", ORACLE["e6_word_share"])
def indexed_word_share(spark, d):
    marked, marks = _indexed(spark, d, ["That"])
    return E.e6_word_share(marked, "That", marks)


@register("indexed_top_categories", ORACLE["e7_top_categories"])
def indexed_top_categories(spark, d):
    marked, marks = _indexed(spark, d, ["ouen"])
    return E.e7_top_categories(marked, S.business(spark, d), "ouen", 40, SEP, marks)


@register("indexed_place_share", ORACLE["e8_place_share"])
def indexed_place_share(spark, d):
    marked, marks = _indexed(spark, d, AUTH)
    return E.e8_place_share(marked, S.business(spark, d), AUTH, text=marks)


@register("indexed_negative_categories", ORACLE["e9_negative_literal"])
def indexed_negative_categories(spark, d):
    marked, marks = _indexed(spark, d, AUTH + NEG)
    return E.e9_category_table(marked, S.business(spark, d), "literal", AUTH, NEG, MARKER, [DROPPED], SEP, marks)


@register("indexed_region_ratio", ORACLE["e9_region_ratio_intended"])
def indexed_region_ratio(spark, d):
    marked, marks = _indexed(spark, d, AUTH + NEG)
    return E.e9_region_ratio(marked, S.business(spark, d), False, REGIONS, auth=AUTH, neg=NEG, marker=MARKER, drop=[DROPPED], sep=SEP, text=marks)


@register("indexed_phrases", """SELECT doc_id AS review_id, text LIKE '%e a%' AS a, text LIKE '% of the %' AS b, text LIKE '%n of th%' AS c FROM documents
    WHERE text LIKE '%e a%' OR text LIKE '% of the %' OR text LIKE '%n of th%'""")
def indexed_phrases(spark, d):
    """Terms with spaces: candidates by their pieces, decided on the candidates' texts."""
    reviews, terms = S.reviews(spark, d), ["e a", " of the ", "n of th"]
    index = WI.build(reviews, scratch_path(spark, "word-index"))
    found, marks = index.lookup(terms, reviews)
    return found.select("review_id", *[marks.contains(t).alias(n) for t, n in zip(terms, "abc")])


# ------------------------------------------------------------------ J1, J3, E4: the co-bucketed star
@register("bucketed_star", """SELECT o.o_custkey AS user_id, l.l_partkey AS business_id, p.p_brand AS brand, c.c_mktsegment AS segment, count(*) AS n
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey JOIN customer c ON c.c_custkey = o.o_custkey
    GROUP BY ALL""")
def bucketed_star(spark, d):
    """Both joins of the star without a shuffle of the facts: one by business, its result's copy by user."""
    star = ST.star(spark, 8, T(spark, d, "lineitem").count())
    parts = T(spark, d, "part").select(F.col("p_partkey").alias("business_id"), F.col("p_brand").alias("brand"))
    customers = T(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    star.add("facts", S.user_reviews(spark, d), "business_id").add("parts", parts, "business_id").add("customers", customers, "user_id")
    by_part = star.meet("facts", "parts", "business_id").groupBy("business_id", "user_id", "brand").agg(F.count(F.lit(1)).alias("n"))
    return star.add("by_user", by_part, "user_id").meet("by_user", "customers", "user_id").select("user_id", "business_id", "brand", "segment", "n")


@register("bucketed_influencers", ORACLE["e4_influencer_businesses"])
def bucketed_influencers(spark, d):
    """E4 over the star: the reviews meet the influencers and the businesses in their buckets."""
    star = ST.star(spark, 8, T(spark, d, "lineitem").count()).add("facts", S.user_reviews(spark, d), "user_id").add("influencers", E.e3_influencers(S.users(spark, d), 15), "user_id")
    star.add("theirs", star.meet("facts", "influencers", "user_id", "left_semi"), "business_id")
    star.add("businesses", S.business(spark, d).select("business_id"), "business_id")
    return having_count(star.meet("theirs", "businesses", "business_id", "left_semi"), "business_id", 5)


# ------------------------------------------------------------------ A7, A8, A14, A17: partial aggregates
@register("incremental_place_share", ORACLE["e8_place_share"])
def incremental_place_share(spark, d):
    """E8 from the partials of two loads of reviews."""
    place = S.business(spark, d).filter(F.col("state").isNotNull() | F.col("city").isNotNull()).select("business_id", "state", "city")
    cube = PA.CubePartials(spark, scratch_path(spark, "place-cube"), ("state", "city"))
    for load in (0, 1):
        rows = S.reviews(spark, d).filter(F.pmod("review_id", F.lit(2)) == load).join(place, "business_id")
        cube.add(f"load-{load}", rows, F.coalesce(TX.contains_any("text", AUTH), F.lit(False)))
    return cube.share().select("state", "city", F.col("n").alias("all_count"), F.col("m").alias("match_count"), "gid", "ratio")


_PLACE_SQL = """SELECT lang, source, count(*) AS n, count(*) FILTER (WHERE text LIKE '%ouen%') AS m, grouping_id(lang, source) AS gid,
    CAST(count(*) FILTER (WHERE text LIKE '%ouen%') AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) AS ratio FROM documents GROUP BY CUBE (lang, source)"""


@register("incremental_cube", _PLACE_SQL)
def incremental_cube(spark, d):
    """The share cube from the partials of three loads, one of them run twice; no load rereads another's rows."""
    docs = T(spark, d, "documents")
    cube = PA.CubePartials(spark, scratch_path(spark, "cube"), ("lang", "source"))
    part = F.pmod("doc_id", F.lit(3))
    for load in (0, 1, 2, 1):
        cube.add(f"load-{load}", docs.filter(part == load), F.col("text").contains("ouen"))
    return cube.share()


@register("distinct_sketches", """SELECT event_type, since, n AS exact, true AS within FROM (
    SELECT event_type, 'all' AS since, count(DISTINCT user_id) AS n FROM events GROUP BY event_type UNION ALL
    SELECT event_type, '2024-01-20', count(DISTINCT user_id) FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' GROUP BY event_type)""")
def distinct_sketches(spark, d):
    """Distinct users of each event type over all days and over the last ones, from daily sketches of two loads; ``within``: four standard errors."""
    events = T(spark, d, "events").select("event_type", "user_id", "ts")
    sketches = PA.DistinctSketches(spark, scratch_path(spark, "sketches"), ("event_type",))
    for load in (0, 1):
        sketches.add(f"load-{load}", events.filter(F.pmod("user_id", F.lit(2)) == load), "user_id", "ts")
    out = None
    for since in (None, "2024-01-20"):
        rows = events if since is None else events.filter(F.col("ts") >= F.to_timestamp_ntz(F.lit(f"{since} 00:00:00")))
        exact = rows.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))
        near = F.abs(F.col("users") - F.col("exact")) <= 4 * sketches.error * F.col("exact") + 1
        part = exact.join(sketches.estimates(since=since), "event_type", "left").select("event_type", F.lit(since or "all").alias("since"), "exact", near.alias("within"))
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------------ K2-K6: runs, versions, compaction
@register("repeated_runs", f"""SELECT r.run, event_id, r.factor * value / 10.0 AS prediction FROM events,
    (VALUES {", ".join(f"('run-{i}', {i + 1})" for i in range(len(STAMPS)))}) r(run, factor) WHERE ts > TIMESTAMP '{AS_OF}'""")
def repeated_runs(spark, d):
    """Three runs, the second saved again after the third: each run's rows are there once."""
    path = scratch_path(spark, "runs-saved")
    fc = S.forecasts(spark, d).join(T(spark, d, "events").filter(F.col("ts") > F.to_timestamp_ntz(F.lit(AS_OF))).select("event_id"), "event_id")
    for i in (0, 1, 2, 1):
        SK.save_predictions(fc.withColumn("prediction", (i + 1) * F.col("Speed")), path, STAMPS[i], run=f"run-{i}")
    return SK.load_predictions(spark, path).select("run", "event_id", "prediction")


@register("versioned_model", f"SELECT round(r2, 6) AS r2, n FROM ({holdout_sql(WIND_SQL, K)})")
def versioned_model(spark, d):
    """A second version replaces the first; a third that was written and never published is not seen."""
    from brisa.operators import evaluate as EV
    from brisa.sources import versions as VS
    tr, te = _parts(spark, d)
    rows, path = tr.select("id", "x1", "x2", "y"), scratch_path(spark, "model")
    SK.save_model(rows.filter(F.col("x1") > 5), 1, path)
    SK.save_model(rows, K, path)
    rows.filter(F.col("x1") < 2).write.parquet(f"{VS.begin(spark, path)}/rows")
    model, k = SK.load_model(spark, path)
    truth = te.select(F.col("id").alias("qid"), "y")
    return EV.r2_score(KNN.knn_predict(model, te, k).join(truth, "qid"), "y", "prediction").select(_r6("r2"), "n")


@register("compacted_log", """SELECT 'run-' || event_type AS run_id, event_type AS kind, CAST(count(*) AS DOUBLE) AS events, round(avg(value), 6) AS mean_value, round(max(value), 6) AS most
    FROM events GROUP BY event_type""")
def compacted_log(spark, d):
    """A run for each event type, logged in many small files, folded twice with more logged between; the search finds the keys itself."""
    path = scratch_path(spark, "log")
    at = _dt.datetime(2024, 2, 1)
    values = F.struct(F.count(F.lit(1)).cast("double").alias("events"), F.avg("value").alias("mean_value"), F.max("value").alias("most"))
    runs = T(spark, d, "events").groupBy("event_type").agg(values.alias("v")).withColumn("run_id", F.concat(F.lit("run-"), "event_type")).repartition(6, "run_id")

    def log(kind, key, value, when):
        column = "str_value" if kind == "param" else "num_value"
        SK.log_rows(runs.select("run_id", F.lit(kind).alias("kind"), F.lit(key).alias("key"), value.alias(column), F.lit(when).alias("logged_at")), path)

    log("param", "kind", F.lit("old"), at - _dt.timedelta(days=1))
    log("param", "kind", F.col("event_type"), at)
    log("metric", "events", F.lit(-1.0), at - _dt.timedelta(days=1))
    log("metric", "events", F.col("v.events"), at)
    SK.compact_runs(spark, path)
    log("metric", "mean_value", F.col("v.mean_value"), at)
    log("metric", "most", F.col("v.most"), at)
    SK.compact_runs(spark, path)
    return SK.search_runs(spark, path).select("run_id", "kind", "events", _r6("mean_value"), _r6("most"))
