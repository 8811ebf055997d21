"""Relational building blocks: suffixed merge, cubes, shares, token tables.

Design notes for scale
* Cubes aggregate to the finest grain first and cube the (small) result:
  ``Expand`` then multiplies only the aggregated rows, not the input.
* Shares and ratios are conditional aggregates - one scan, no second
  pass and no join between two aggregates.
* Frequency tables stay distributed (``groupBy().count()``); top-k uses
  ``orderBy().limit()`` which plans as ``TakeOrderedAndProject``.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.functions.text import split_tokens


# ----------------------------------------------------------------- joins
def merge_suffixed(left: DataFrame, right: DataFrame, on: Sequence[str],
                   how: str = "inner", suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Join on key columns; other columns present on both sides get suffixes."""
    on = list(on)
    shared = (set(left.columns) & set(right.columns)) - set(on)
    lsel = [F.col(c).alias(c + suffixes[0]) if c in shared else F.col(c) for c in left.columns]
    rsel = [F.col(c).alias(c + suffixes[1]) if c in shared else F.col(c) for c in right.columns]
    return left.select(*lsel).join(right.select(*rsel), on=on, how=how)


def newest_rows(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` equals the column maximum.

    The maximum is a one-row aggregate, so the broadcast side is bounded
    by construction (exactly one row).
    """
    top = df.agg(F.max(col).alias("__max"))
    return df.join(F.broadcast(top), F.col(col) == F.col("__max"), "inner").drop("__max")


def having_count(df: DataFrame, keys: Sequence[str] | str, more_than: int,
                 count_col: str = "count") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > more_than)


def distinct_count_having(df: DataFrame, keys: Sequence[str] | str, distinct_of: str,
                          more_than: int, count_col: str = "count", approx: bool = False) -> DataFrame:
    """``count(DISTINCT x) > n`` per key (``approx``: a sketch of fixed size for each key instead).

    Written as two aggregations (dedupe ``(key, x)`` first, then count) so a
    hot key is pre-aggregated map-side on both steps instead of building one
    large distinct set per key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if approx:
        return df.groupBy(*keys).agg(F.approx_count_distinct(distinct_of).alias(count_col)).filter(F.col(count_col) > more_than)
    pairs = df.select(*keys, distinct_of).dropDuplicates(keys + [distinct_of]).filter(
        F.col(distinct_of).isNotNull())
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(
        F.col(count_col) > more_than)


# ----------------------------------------------------------------- shares
def share_percent(df: DataFrame, predicate: Column, name: str = "percent") -> DataFrame:
    """Matching rows / all rows x 100 in one scan (null predicate = no match)."""
    return df.agg(
        F.try_divide(F.count_if(F.coalesce(predicate, F.lit(False))).cast("double") * 100.0,
                     F.count(F.lit(1)).cast("double")).alias(name),
        F.count_if(F.coalesce(predicate, F.lit(False))).alias("matching"),
        F.count(F.lit(1)).alias("total"),
    )


def cube_counts(df: DataFrame, dims: Sequence[str], count_col: str = "n",
                gid_col: str = "gid") -> DataFrame:
    """``cube(dims).count()`` with ``grouping_id``, computed from the finest grain."""
    dims = list(dims)
    fine = df.groupBy(*dims).agg(F.count(F.lit(1)).alias("__n"))
    return fine.cube(*dims).agg(F.sum("__n").alias(count_col), F.grouping_id().alias(gid_col))


def cube_share(df: DataFrame, dims: Sequence[str], predicate: Column,
               all_col: str = "all_count", match_col: str = "match_count",
               ratio_col: str = "ratio", gid_col: str = "gid") -> DataFrame:
    """Per-cell share of matching rows for every cell of the cube over ``dims``.

    One scan: the matching count is a conditional count beside the total.
    Missing matches count 0; a zero total gives a null ratio.
    """
    dims = list(dims)
    fine = df.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("__all"),
        F.count_if(F.coalesce(predicate, F.lit(False))).alias("__match"))
    out = fine.cube(*dims).agg(F.sum("__all").alias(all_col), F.sum("__match").alias(match_col),
                                F.grouping_id().alias(gid_col))
    return out.withColumn(ratio_col, F.try_divide(F.col(match_col).cast("double") * 100.0,
                                                  F.col(all_col).cast("double")))


def cube_share_two_sided(all_rows: DataFrame, matching_rows: DataFrame, dim: str,
                         null_safe: bool = False) -> DataFrame:
    """The literal two-cube form: cube each side, full outer join, fill 0, divide.

    ``null_safe=False`` joins on ``key = key`` as the original text does, so
    null keys (cube totals and real nulls) never meet; ``True`` joins on
    ``(grouping_id, key <=> key)`` so totals line up.  Division is
    ``try_divide``: a zero denominator gives null instead of an error.
    """
    a = cube_counts(all_rows.select(dim), [dim], "all_lan_count", "gid_all")
    m = cube_counts(matching_rows.select(dim), [dim], "auth_lan_count", "gid_auth") \
        .withColumnRenamed(dim, dim + "_auth")
    if null_safe:
        cond = (F.col(dim).eqNullSafe(F.col(dim + "_auth"))) & (F.col("gid_all") == F.col("gid_auth"))
    else:
        cond = F.col(dim) == F.col(dim + "_auth")
    j = a.join(m, cond, "full_outer").drop("gid_all", "gid_auth")
    j = j.fillna(0, subset=["all_lan_count", "auth_lan_count"])
    return j.withColumn("ratio", F.try_divide(F.col("auth_lan_count").cast("double") * 100.0,
                                              F.col("all_lan_count").cast("double")))


# ----------------------------------------------------------------- tokens
def explode_tokens(df: DataFrame, col: str, sep: str, token_col: str = "token",
                   keep: Sequence[str] = ()) -> DataFrame:
    """One row per token of a separated string; null strings yield no rows."""
    return df.select(*keep, F.explode(split_tokens(col, sep)).alias(token_col))


def token_freq(df: DataFrame, col: str, sep: str, token_col: str = "token",
               count_col: str = "n") -> DataFrame:
    """Counter over the tokens of a column, as a distributed table."""
    return explode_tokens(df, col, sep, token_col).groupBy(token_col).agg(
        F.count(F.lit(1)).alias(count_col))


def top_k(df: DataFrame, k: int, by: str, tie: str | Sequence[str]) -> DataFrame:
    """Top-k by ``by`` descending; ties broken by ``tie`` ascending (deterministic)."""
    tie = [tie] if isinstance(tie, str) else list(tie)
    return df.orderBy(F.col(by).desc(), *[F.col(t).asc() for t in tie]).limit(k)


def nested_token_freq(df: DataFrame, cols: Sequence[str], token_col: str = "token",
                      count_col: str = "n") -> DataFrame:
    """Per-column token counts of ``array<array<string>>`` columns, stacked long."""
    parts = [
        df.select(F.lit(c).alias("column"), F.explode(F.flatten(F.col(c))).alias(token_col))
          .groupBy("column", token_col).agg(F.count(F.lit(1)).alias(count_col))
        for c in cols
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _tagged_counts(numer: DataFrame, denom: DataFrame, token_col: str, count_col: str) -> DataFrame:
    """Both frequency tables as one long frame ``(token, num, den)`` (no join)."""
    return (numer.select(F.col(token_col), F.col(count_col).cast("bigint").alias("__num"),
                         F.lit(0).cast("bigint").alias("__den"))
            .unionByName(denom.select(F.col(token_col), F.lit(0).cast("bigint").alias("__num"),
                                      F.col(count_col).cast("bigint").alias("__den"))))


def set_ratio(numer: DataFrame, denom: DataFrame, tokens: Iterable[str], token_col: str = "token",
              count_col: str = "n", name: str = "ratio") -> DataFrame:
    """sum(numer counts over ``tokens``) / sum(denom counts over ``tokens``).

    Absent tokens count 0 (Counter semantics); a zero denominator gives null.
    One aggregate over the union of both tables.
    """
    toks = list(tokens)
    both = _tagged_counts(numer, denom, token_col, count_col).filter(F.col(token_col).isin(toks))
    out = both.agg(F.coalesce(F.sum("__num"), F.lit(0)).alias("numerator"),
                   F.coalesce(F.sum("__den"), F.lit(0)).alias("denominator"))
    return out.withColumn(
        name, F.try_divide(F.col("numerator").cast("double"), F.col("denominator").cast("double")))


def grouped_set_ratio(numer: DataFrame, denom: DataFrame, groups: dict[str, list[str]],
                      token_col: str = "token", count_col: str = "n") -> DataFrame:
    """``set_ratio`` for several named token sets at once, one row per set.

    The token -> set mapping is a literal whose size is fixed by the caller
    (a handful of names), so broadcasting it is safe.  Every set appears in
    the output even when none of its tokens occur.
    """
    spark = numer.sparkSession
    mapping = spark.createDataFrame(
        [(g, t) for g, toks in groups.items() for t in toks], f"region string, {token_col} string")
    both = _tagged_counts(numer, denom, token_col, count_col).join(F.broadcast(mapping), token_col)
    zeros = mapping.select("region", F.lit(0).cast("bigint").alias("__num"),
                           F.lit(0).cast("bigint").alias("__den"))
    out = both.select("region", "__num", "__den").unionByName(zeros).groupBy("region").agg(
        F.sum("__num").alias("numerator"), F.sum("__den").alias("denominator"))
    return out.withColumn("ratio", F.try_divide(F.col("numerator").cast("double"),
                                                F.col("denominator").cast("double")))
