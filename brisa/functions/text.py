"""Text predicates over a string column.

``LIKE '%w%'`` is ``Column.contains`` in Spark; Catalyst pushes it to the
Parquet reader as ``StringContains``, so these predicates prune row groups
before any text reaches an operator.  SQL null logic is kept: a null text
gives a null predicate (the row is dropped by a filter) except where the
reference's pandas code turns null into False (``ci_contains``).
"""

from __future__ import annotations

import re
from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains_any(col, terms: Iterable[str]) -> Column:
    """Case-sensitive ``col LIKE '%t1%' OR col LIKE '%t2%' ...``."""
    c = _col(col)
    parts = [c.contains(t) for t in terms]
    if not parts:
        return F.lit(False)
    return reduce(lambda a, b: a | b, parts)


def lexicon_literal(col, auth: list[str], neg: list[str]) -> Column:
    """The predicate as the SQL text is written: ``a1 OR ... OR an AND (n1 OR ...)``.

    AND binds tighter than OR, so only the last authenticity word is tied to
    the negative words: ``a1 OR ... OR (an AND any(neg))``.
    """
    c = _col(col)
    head = [c.contains(t) for t in auth[:-1]]
    tail = c.contains(auth[-1]) & contains_any(c, neg)
    return reduce(lambda a, b: a | b, head + [tail])


def lexicon_intended(col, auth: list[str], neg: list[str]) -> Column:
    """``(any authenticity word) AND (any negative word)``."""
    return contains_any(col, auth) & contains_any(col, neg)


def complement_literal(col, auth: list[str], neg: list[str]) -> Column:
    """As written: ``a1 OR ... OR an AND (NOT n1 OR NOT n2 ...)``.

    The bracket is true unless every negative word occurs.
    """
    c = _col(col)
    head = [c.contains(t) for t in auth[:-1]]
    not_all = reduce(lambda a, b: a | b, [~c.contains(t) for t in neg])
    tail = c.contains(auth[-1]) & not_all
    return reduce(lambda a, b: a | b, head + [tail])


def complement_intended(col, auth: list[str], neg: list[str]) -> Column:
    """``(any authenticity word) AND NOT (any negative word)``."""
    return contains_any(col, auth) & ~contains_any(col, neg)


def ci_contains(col, word: str) -> Column:
    """Case-insensitive contains where a null text counts as False."""
    return F.coalesce(F.lower(_col(col)).contains(word.lower()), F.lit(False))


def variant_match(col, stem: str) -> Column:
    """A word that begins with ``stem`` in any case (``authentic``, ``Authenticity``).

    The text is lower-cased first instead of using ``(?i)``: Java and RE2 treat
    case-insensitive negated classes differently.
    """
    return F.lower(_col(col)).rlike(r"(^|\P{L})" + re.escape(stem.lower()))


def split_tokens(col, sep: str) -> Column:
    """Split on a literal separator (``split`` takes a regex, so quote it)."""
    return F.split(_col(col), re.escape(sep))
