r"""Mixing sources to target weights by weighted sampling without replacement.

Each document draws the key -ln(u) / w (Efraimidis and Spirakis), u from a hash
of its id and w its quality weight, and is taken in key order until its
source's budget of words is used up.  A source whose target exceeds its size
gives all its documents once for every complete epoch first; only the rest of
the budget is filled by the keyed order.

Targets: sources in code-point order (null last) weigh 1, 2, 3, 1, ... and
share the words of the whole input; no target exceeds three times its source's
size, and what that cuts off is shared among the other sources by weight.

The order within a source is found without sorting the source: keys fall into
a fixed number of ordered buckets, bucket sums are added up in Spark, and only
the one bucket of each source in which its budget ends is sorted.  So a source
with a third of all rows costs no more in any task than the others.  What the
last document that fits leaves open is filled in further passes, in the same
order, by documents small enough for it; at last the smallest document that
does not fit is taken if its excess is less than what is still open.

Defined results: null text, or one without words, has size 0 and is never
taken; null source is a source of its own; rows that repeat an id and a text
are counted apart (each can be taken up to three times) and are interchangeable;
equal keys go by id, then size; the empty table gives an empty result.  Other
columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisa.llm.common import stored

BUCKETS = 1024
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
#: Passes over the documents of a source that go on filling its budget with what still fits.
ROUNDS = 3


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: str = "text") -> Column:
    """Sampling weight in [0.05, 1]: falls with the share of ASCII punctuation in the text."""
    t = F.col(text)
    symbols = F.length(t) - F.length(F.regexp_replace(t, r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]", ""))
    return F.greatest(F.lit(0.05), F.coalesce(1 - 3 * symbols / F.nullif(F.length(t), F.lit(0)), F.lit(0.05)))


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1) from the first 52 bits of a digest of the id."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target from one row for each source (source, source_size).

    Filling level: with the sources in order of cap / weight, the level after cutting off the first j
    rises while cut-off sources leave excess and falls afterwards, so the level is its greatest value.
    """
    n = len(weights)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % n + 1).cast("int"))
    w = sizes.withColumn("weight", weight.cast("double"))
    w = w.withColumn("most", (cap * F.col("source_size")).cast("double")).withColumn("level", F.col("most") / F.col("weight"))
    everything = Window.partitionBy()
    before = Window.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    w = w.withColumn("fill", left / open_weight)
    w = w.withColumn("fill", F.max("fill").over(everything))
    return w.select("source", "source_size", F.least("most", F.col("fill") * F.col("weight")).alias("target"))


def _fill(rows: DataFrame, left: DataFrame) -> DataFrame:
    """Take, in key order, documents not taken yet that fit what is left of their source's budget.

    ``rows``: doc_id, source, size, key, bucket, extra (0 or 1); ``left``: source, left, only (a key; if not null,
    only documents with it are looked at).  Returns ``rows`` with ``extra`` set where taken.
    """
    r, g = rows.alias("r"), left.alias("g")
    opened = (F.col("extra") == 0) & (F.col("size") > 0) & (F.col("size") <= F.col("left")) & F.coalesce(F.col("key") == F.col("only"), F.lit(True))
    own = r.join(g, F.col("r.source").eqNullSafe(F.col("g.source"))).where(opened)
    # a third of the words may sit in one source: (source, bucket) sums are made before the shuffle
    sums = own.groupBy("r.source", "bucket", "left", "only").agg(F.sum("size").alias("words"))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
    end = F.col("before") + F.col("words")
    # the bucket in which the budget ends, and the last one that is taken whole
    cut = stored(sums.groupBy("source", "left", "only").agg(
        F.max(F.when((F.col("before") < F.col("left")) & (end > F.col("left")), F.struct("bucket", "before"))).alias("cut"),
        F.max(F.when(end <= F.col("left"), F.col("bucket"))).alias("whole")), "mix-cut")
    c = cut.alias("c")
    met = r.join(c, F.col("r.source").eqNullSafe(F.col("c.source")), "left").select("r.*", "left", "only", "cut", "whole")
    edge = F.coalesce(opened & (F.col("cut.bucket") == F.col("bucket")), F.lit(False))
    plain = met.where(~edge).withColumn("extra", F.greatest("extra", F.coalesce((opened & (F.col("bucket") <= F.col("whole"))).cast("int"), F.lit(0))))
    same = ["doc_id", "source", "size", "key", "bucket"]
    at = met.where(edge).groupBy(*same, "left", F.col("cut.before").alias("start")).agg(F.count("*").alias("n"))
    order = Window.partitionBy("source", "bucket").orderBy("key", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    at = at.withColumn("start", F.col("start") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(order), F.lit(0)))
    fits = F.greatest(F.lit(0), F.least("n", F.floor((F.col("left") - F.col("start")) / F.col("size"))))
    at = at.withColumn("fits", fits).select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("i"))
    at = at.withColumn("extra", (F.col("i") <= F.col("fits")).cast("int"))
    cols = [*same, "extra"]
    return stored(plain.select(cols).unionByName(at.select(cols)), "mix")


def mix(docs: DataFrame, weight: Column | None = None, weights: tuple[int, ...] = WEIGHTS,
        cap: int = MAX_EPOCHS, seed: str = SEED, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every document."""
    rows = docs.select("doc_id", "source", word_count().alias("size"),
                       (-F.log(uniform(F.col("doc_id"), seed)) / (quality_weight() if weight is None else weight)).alias("key"))
    rows = rows.withColumn("bucket", F.least(F.lit(BUCKETS - 1), F.floor(BUCKETS * (1 - F.exp(-F.col("key"))))).cast("int"))
    rows = stored(rows.withColumn("extra", F.lit(0)), "mix")
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    goal = goal.withColumn("epochs", F.coalesce(F.least(F.lit(cap), F.floor(F.col("target") / F.nullif("source_size", F.lit(0)))), F.lit(0)).cast("long"))
    goal = stored(goal.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-goal")
    def left() -> DataFrame:
        used, g = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("extra")).alias("used")).alias("u"), goal.alias("g")
        return g.join(used, F.col("g.source").eqNullSafe(F.col("u.source"))).select("g.source", (F.col("rest") - F.col("used")).alias("left"))

    for _ in range(rounds):
        rows = _fill(rows, left().withColumn("only", F.lit(None).cast("double")))
    r, g = rows.where("extra = 0").alias("r"), left().alias("g")
    over = r.join(g, F.col("r.source").eqNullSafe(F.col("g.source"))).where((F.col("size") > F.col("left")) & (F.col("size") < 2 * F.col("left")))
    over = over.groupBy("r.source").agg(F.min(F.struct("size", "key")).alias("next"))
    rows = _fill(rows, over.select("source", F.col("next.size").cast("double").alias("left"), F.col("next.key").alias("only")))
    r, g = rows.alias("r"), goal.alias("g")
    return r.join(g, F.col("r.source").eqNullSafe(F.col("g.source"))).select(
        "doc_id", "r.source", "size", "source_size", "target", (F.col("size") * (F.col("epochs") + F.col("extra"))).cast("long").alias("taken"))
