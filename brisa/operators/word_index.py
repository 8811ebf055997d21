"""Word index for ``LIKE '%w%'`` filters: which texts hold a term, without reading the texts.

A token is a run of characters that are not white space.  The index has, for
every distinct token, the sorted ids of the texts that hold it, in blocks
(``block`` is a hash of the id), so a token that all texts hold is many rows of
bounded size.  Rows are sorted by token.

A term without white space occurs in a text exactly if it occurs in one of its
tokens, so the filter runs over the distinct tokens (a ``contains`` that reaches
the reader) and the ids follow: the text column is not read at all.  A term
with white space says what its tokens end with, are, and begin with; texts that
hold all of them are candidates, and ``contains`` on their text decides.

``marks`` gives a table of ids with one boolean column a term; ``Marks`` stands
in for the text column in ``functions.text``, so each lexicon predicate and each
analysis built on it runs on the marks.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brisa.session import cut_lineage

SPACE = r"[ \t\n\x0B\f\r]+"
#: Texts for each block: the longest list of ids of an index row.
BLOCK_TEXTS = 1 << 17


class Marks:
    """Has ``contains`` like a text column; the answer is the mark of a term that was looked up."""

    def __init__(self, terms: list[str]):
        self.names = {t: f"has_{i}" for i, t in enumerate(dict.fromkeys(terms))}

    def contains(self, term: str) -> Column:
        return F.col(self.names[term])


@dataclass(frozen=True)
class WordIndex:
    """``tokens``: token, block, ids; read from ``path``."""

    spark: SparkSession
    path: str

    @property
    def tokens(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def lookup(self, terms: list[str], texts: DataFrame | None = None, id_col: str = "review_id", text_col: str = "text") -> tuple[DataFrame, Marks]:
        """(id and a mark for each term, for every text that holds at least one; the ``Marks``).

        ``texts`` is needed for terms with white space only, and of it the candidates' texts.
        """
        marks = Marks(terms)
        found = {t: [p for p in re.split(SPACE, t)] for t in marks.names}
        plain = [t for t, p in found.items() if len(p) == 1]
        spaced = [t for t, p in found.items() if len(p) > 1]
        if spaced and texts is None:
            raise ValueError("terms with white space need the texts of their candidates")
        out = self._plain(plain, marks) if plain else None
        for t in spaced:
            mine = self._spaced(t, found[t], texts, id_col, text_col).select("id", F.lit(True).alias(marks.names[t]))
            out = mine if out is None else out.join(mine, "id", "full_outer")
        named = [F.coalesce(n, F.lit(False)).alias(n) for n in marks.names.values()]
        return out.select(F.col("id").alias(id_col), *named), marks

    def _plain(self, terms: list[str], marks: Marks) -> DataFrame:
        tests = {marks.names[t]: F.col("token").contains(t) if t else F.lit(True) for t in terms}
        some = None
        for test in tests.values():
            some = test if some is None else some | test
        rows = self.tokens.filter(some).select(F.explode("ids").alias("id"), *[test.alias(name) for name, test in tests.items()])
        return rows.groupBy("id").agg(*[F.max(name).alias(name) for name in tests])

    def _spaced(self, term: str, pieces: list[str], texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """Ids of the texts that hold a term with white space: met by its pieces, decided on the text."""
        tests = [F.col("token").endswith(pieces[0]), *[F.col("token") == p for p in pieces[1:-1]], F.col("token").startswith(pieces[-1])]
        tests = [t for t, p in zip(tests, pieces) if p]  # an empty end is met by any token
        own = texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("__text"))
        if tests:
            some = tests[0]
            for t in tests[1:]:
                some = some | t
            rows = self.tokens.filter(some).select(F.explode("ids").alias("id"), *[t.alias(f"p{i}") for i, t in enumerate(tests)])
            met = rows.groupBy("id").agg(*[F.max(f"p{i}").alias(f"p{i}") for i in range(len(tests))])
            own = own.join(met.filter(" AND ".join(f"p{i}" for i in range(len(tests)))).select("id"), "id", "left_semi")
        return own.filter(F.col("__text").contains(term)).select("id")

    def mark(self, rows: DataFrame, terms: list[str], texts: DataFrame | None = None, id_col: str = "review_id", text_col: str = "text") -> tuple[DataFrame, Marks]:
        """``rows`` with a mark for each term (false where no text of that id holds it)."""
        found, marks = self.lookup(terms, texts, id_col, text_col)
        out = rows.join(found, id_col, "left")
        return out.select(*rows.columns, *[F.coalesce(n, F.lit(False)).alias(n) for n in marks.names.values()]), marks


def build(texts: DataFrame, path: str, id_col: str = "review_id", text_col: str = "text") -> WordIndex:
    """Write the index of ``texts`` to ``path`` (replaced).

    Texts that are null or blank have no tokens; ids are unique and not null.  Each task sends a token of
    a block once with its ids, so a hot token is as many rows as there are blocks and tasks.
    """
    spark = texts.sparkSession
    blocks = max(1, -(-texts.count() // BLOCK_TEXTS))
    tokens = F.explode(F.filter(F.array_distinct(F.split(text_col, SPACE)), lambda t: t != "")).alias("token")
    block = F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int").alias("block")
    lists = texts.select(F.col(id_col).alias("id"), block, tokens).groupBy("token", "block").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    lists = cut_lineage(lists)  # range limits are sampled from it
    lists.repartitionByRange("token", "block").sortWithinPartitions("token", "block").write.mode("overwrite").parquet(path)
    return WordIndex(spark, path)


def token_counts(index: WordIndex) -> DataFrame:
    """``token, n``: how many texts hold each token, from the lists' lengths."""
    return index.tokens.groupBy("token").agg(F.sum(F.size("ids")).cast("bigint").alias("n"))
