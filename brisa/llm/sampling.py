"""A bounded, repeatable sample of labelled rows, joined to their documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import prepare
from brisa.llm.phrase_index import digest


def labelled_documents(docs: DataFrame, labels: DataFrame, sample: int, salt: str, where: Column | None = None) -> DataFrame:
    """text, lang, digest (of the text) and the label columns of about ``sample`` labelled documents, never over twice as many.

    ``labels`` has doc_id and any label columns.  Rows that repeat a doc_id give one label (the least of
    each column), and documents that repeat one give one text (that of the least digest, then the least
    language); null ids and null labels are left out.  The choice is by a hash of the id, so reruns
    agree; sort by (digest, label, lang) for an order that the table's partitions do not change.  The
    chosen labels are bounded by ``sample``, which makes them safe to broadcast: the texts are filtered
    where they lie, and of an id each task passes one on.
    """
    prepare(docs.sparkSession)
    one = one_label(labels, where)
    n = one.count()
    share = min(1.0, sample / max(n, 1))
    draw = F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    chosen = one.where(draw).limit(2 * sample)
    return _one_text(docs, F.broadcast(chosen)).select("r.*")


def one_label(labels: DataFrame, where: Column | None = None) -> DataFrame:
    """One row for each labelled id that ``where`` admits: the least of each label column."""
    cols = [c for c in labels.columns if c != "doc_id"]
    one = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*[F.min(c).alias(c) for c in cols]).dropna()
    return one if where is None else one.where(where)


def every_labelled(docs: DataFrame, labels: DataFrame, salt: str, where: Column | None = None) -> DataFrame:
    """The same columns of all labelled documents, and ``draw``: a hash of the id to deal and order them by."""
    prepare(docs.sparkSession)
    return _one_text(docs, one_label(labels, where)).select(F.xxhash64(F.lit(salt), "doc_id").alias("draw"), "r.*")


def _one_text(docs: DataFrame, labels: DataFrame) -> DataFrame:
    cols = [c for c in labels.columns if c != "doc_id"]
    have = [c for c in ("text", "lang") if c in docs.columns]
    met = docs.select("doc_id", *have, digest().alias("digest")).join(labels, "doc_id")
    order = F.struct("digest", *[c for c in have if c == "lang"])
    return met.groupBy("doc_id").agg(F.min_by(F.struct(*have, "digest", *cols), order).alias("r"))
