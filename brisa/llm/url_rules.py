r"""URL filter: a fixed rule table, and association rules mined by FP-growth where no rule fits.

A rule is (host, path, verdict).  It fits a url whose host is the rule's or a
subdomain of it and whose path starts with the rule's path; the longest wins.

Urls a rule fits are the labels for the rest: Spark's FP-growth mines them for
combinations of tokens (host labels, path words, query keys; numbers count as
one token) that come with a verdict.  FP-growth lists itemsets of every length, so a
long url that is repeated would cost a power of its tokens; two reductions that lose no
rule come first.  A token that always comes with one verdict is a rule by itself, and any
rule with more tokens around it is redundant, so it leaves the transactions.  Tokens that
are in exactly the same urls are one item while mining, and every one of them after.
Mined rules are pruned by support, by
confidence, by length, and by redundancy (a rule goes if a rule on a subset of
its tokens has the same verdict and at least its confidence).  They are
matched by an inverted index: a rule is listed under its rarest token, a url
looks up its tokens, and the tokens of the rules found are compared.  The
highest confidence wins, then support, then the tokens' text.  A url that
nothing matches is allowed.

A verdict depends on a url's tokens alone, so different token sets are matched
once however many urls share them (one host may hold a third of all rows), and
urls join the outcome.

Defined results: a null url, or one without ``://``, has empty host and path,
no tokens, and is allowed; a url with an empty host likewise unless its path
has tokens; repeated rows are judged each; an empty table gives no rows; with
no labelled urls nothing is mined.  Other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import stored

# The rule table.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
SUPPORT = 0.005
CONFIDENCE = 0.6
LONGEST = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parse(urls: DataFrame) -> DataFrame:
    """``urls`` (page_id, url) with host, path, and query."""
    at = F.locate("://", F.coalesce("url", F.lit("")))
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    out = urls.withColumn("rest", rest)
    return out.select(
        "page_id", F.translate(F.regexp_extract("rest", r"^[^/?#]*", 0), UPPER, LOWER).alias("host"),
        F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"), F.regexp_extract("rest", r"^[^?#]*\?([^#]*)", 1).alias("query"))


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits host and path, else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        text, verdict = F.when(fits, host + path).otherwise(text), F.when(fits, what).otherwise(verdict)
    return text, verdict


def tokens() -> Column:
    """Sorted distinct tokens of host, path and query."""
    return F.expr(r"""array_sort(array_distinct(concat(
        transform(filter(split(host, '\\.'), x -> x <> ''), x -> concat('h:', x)),
        transform(filter(split(translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+'), x -> x <> ''),
                  x -> concat('p:', regexp_replace(x, '^[0-9]+$', '#'))),
        transform(filter(split(query, '[&=]'), (x, i) -> i % 2 = 0 AND x <> ''), x -> concat('q:', x)))))""")


def _alike(items: DataFrame, mixed: DataFrame) -> DataFrame:
    """token, item (the first token that is in exactly the same rows) of the tokens of ``mixed``."""
    rows = items.select(F.xxhash64("tokens").cast("decimal(38,0)").alias("h"), F.xxhash64(F.lit("again"), "tokens").alias("g"), F.explode("tokens").alias("token"))
    same = rows.join(mixed, "token").groupBy("token").agg(F.count("*").alias("n"), F.sum("h").alias("h"), F.sum(F.col("g").cast("decimal(38,0)")).alias("g"))
    first = same.groupBy("n", "h", "g").agg(F.min("token").alias("item"))
    return same.join(first, ["n", "h", "g"]).select("token", "item")


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, longest: int = LONGEST) -> DataFrame:
    """antecedent (sorted tokens), key (its rarest token), verdict, confidence, support from rows (tokens, verdict)."""
    items = stored(labelled.where(F.size("tokens") > 0).select("tokens", "verdict", F.monotonically_increasing_id().alias("row")), "url-items")
    total = items.count()
    least = math.ceil(support * total)
    known = items.select("verdict", F.explode("tokens").alias("token")).groupBy("token", "verdict").agg(F.count("*").alias("c"))
    freq = known.groupBy("token").agg(F.sum("c").alias("freq"), F.max("c").alias("most"))
    freq = stored(freq.where(F.col("freq") >= max(least, 1)), "url-tokens")
    pure = known.join(freq.where("freq = most"), "token").select(
        F.array("token").alias("antecedent"), "verdict", F.lit(1.0).alias("confidence"), (F.col("c") / F.lit(float(total or 1))).alias("support"))
    alike = stored(_alike(items, freq.where("freq > most").select("token")), "url-alike")
    kept = items.select("row", F.explode("tokens").alias("token")).join(alike, "token").groupBy("row").agg(F.collect_set("item").alias("some"))
    whole = items.join(kept, "row", "left").select(F.concat(F.coalesce("some", F.array().cast("array<string>")), F.array(F.concat(F.lit("="), "verdict"))).alias("items"))
    whole = stored(whole, "url-sets")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(whole)
    rules = model.associationRules.where(F.col("consequent")[0].startswith("=") & (F.size("antecedent") <= longest)).where(
        "NOT exists(antecedent, x -> x LIKE '=%')")
    rules = rules.select(F.array_sort("antecedent").alias("antecedent"), F.substring(F.col("consequent")[0], 2, 100).alias("verdict"), "confidence", "support")
    rules = stored(rules, "url-mined")
    general, special = rules.alias("g"), rules.alias("s")
    part = special.select("*", F.explode("antecedent").alias("one")).alias("s").join(
        general.select("*", F.col("antecedent")[0].alias("one")).alias("g"), "one").where(
        (F.col("s.verdict") == F.col("g.verdict")) & (F.size("g.antecedent") < F.size("s.antecedent")) & (F.col("g.confidence") >= F.col("s.confidence"))
        & (F.size(F.array_except("g.antecedent", "s.antecedent")) == 0))
    redundant = part.select(F.col("s.antecedent").alias("antecedent"), F.col("s.verdict").alias("verdict")).distinct()
    left = rules.join(redundant, ["antecedent", "verdict"], "left_anti").withColumn("rule", F.monotonically_increasing_id())
    left = stored(left, "url-left")
    # every item stands for its tokens: one rule for each choice of them
    groups = alike.groupBy("item").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    sides = left.select("rule", F.explode("antecedent").alias("item")).join(groups, "item").groupBy("rule").agg(F.collect_list("tokens").alias("sides"))
    choices = F.expr("aggregate(sides, array(cast(array() as array<string>)), (acc, s) -> flatten(transform(acc, p -> transform(s, t -> concat(p, array(t))))))")
    spread = left.drop("antecedent").join(sides, "rule").withColumn("antecedent", F.explode(choices)).withColumn("antecedent", F.array_sort("antecedent"))
    every = spread.select("antecedent", "verdict", "confidence", "support").unionByName(pure)
    keyed = every.select("*", F.explode("antecedent").alias("token")).join(freq.select("token", "freq"), "token").groupBy(
        "antecedent", "verdict", "confidence", "support").agg(F.min(F.struct("freq", "token")).alias("rarest"))
    return stored(keyed.select("antecedent", F.col("rarest.token").alias("key"), "verdict", "confidence", "support"), "url-rules")


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``sets`` (tokens) with the verdict of the best mined rule whose tokens they hold; sets without one are left out."""
    looked = sets.select("tokens", F.explode("tokens").alias("key")).join(rules, "key")
    held = looked.where(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = F.max(F.struct("confidence", "support", F.array_join("antecedent", " ").alias("text"), "verdict"))
    return held.groupBy("tokens").agg(best.alias("best")).select("tokens", F.col("best.verdict").alias("mined"), F.col("best.text").alias("by"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule of every page."""
    text, verdict = rule_of(rules)
    rows = parse(pages.select("page_id", "url")).select(
        "page_id", "host", "path", tokens().alias("tokens"), text.alias("rule"), verdict.alias("verdict"))
    rows = stored(rows, "url-rows")
    mined = mine(rows.where("rule IS NOT NULL").select("tokens", "verdict"))
    known = stored(match(rows.where("rule IS NULL").select("tokens").distinct(), mined), "url-matched")
    own = rows.where("rule IS NOT NULL").select("page_id", "host", "path", "rule", "verdict", F.lit(None).cast("string").alias("mined_rule"))
    rest = rows.where("rule IS NULL").join(known, "tokens", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("mined", F.lit("allow")).alias("verdict"), F.col("by").alias("mined_rule"))
    return own.unionByName(rest)
