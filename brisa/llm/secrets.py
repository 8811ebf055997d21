r"""Secret scan: fixed patterns plus sliding-window entropy, in SQL functions only.

Patterns (``BASE``) are matched leftmost and non-overlapping.  Positions come
from the lengths of the matches and of the gaps between them, in code points.

Entropy: candidate strings are runs of 16 or more characters of the class
``[A-Za-z0-9+/_-]``.  A window of 16 characters slides over each candidate; the
character counts and the sum of n*log2(n) are updated by one leaving and one
entering character (never recounted), so each step costs the same however long
the candidate is.  The threshold depends on the candidate's character class
(hexadecimal digits only, or mixed).  The reported span runs from the first to
the last window that reaches it.  Allow-list: candidates that are numbers, UUIDs or
words are dropped before windows are looked at, and windows that hold a
placeholder (``example``, ``xxxx``, ...) do not count - the rest of the candidate
does.  Words are judged by shape (``_words_sql``): pieces between ``- _ / +`` and
humps of camel case must look like words and have three letters on average, so a random string of letters is none.

Defined results: a null or empty text has no spans; repeated rows and ties give
one result for each row; nothing depends on other rows, so there is no shuffle
and no skew.  Other columns of the input are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns (kind, pattern, least length, group whose length counts).
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    ("access", r"AKIA[A-Z0-9]+", 16, 0),
    ("hex", r"[0-9a-f]{32,}", 32, 0),
)
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
# Whole candidates that are no secrets.
ALLOW = (
    r"^[0-9]+([-_/+][0-9]+)*$",
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
)
# What stands for a secret in examples.
PLACEHOLDER = r"(?i:example|sample|dummy|placeholder|xxxx|0123456789)"
# The shape of a word, and of what no word holds; a longer word needs its share of vowels.  Letters that
# stand for one sound, and doubled ones, count as one consonant there.
WORD = r"^([A-Z]?[a-z]{1,15}|[A-Z]{1,15})$"
LONG_WORD, HARD, ONE_SOUND = r"^([A-Z]?[a-z]{16,}|[A-Z]{16,})$", r"[bcdfghjklmnpqrstvwxz]{6}", r"sch|ch|ck|ph|th|st|ng|ff|ll|mm|nn|ss|tt"
VOWELS, VOWEL_SHARE, MEAN_PIECE = r"[^aeiouy]", 0.3, 3


@dataclass(frozen=True)
class Entropy:
    """Window length in characters, and the bits a window must reach by character class."""

    window: int = 16
    hex_bits: float = 3.0
    mixed_bits: float = 3.5


def _quoted(s: str) -> str:
    return "r'" + s.replace("'", "\\x27") + "'"


def _matches(text: str, pattern: str, group: int) -> str:
    """SQL for array<struct<start, end, token, part>> of all matches, in order.

    Prefix sums run in blocks of about sqrt(n) matches, so a text with very many matches stays cheap.
    """
    p = _quoted(pattern)
    rows = (f"transform(array(named_struct('g', split({text}, {p}, -1), 'm', regexp_extract_all({text}, {p}, 0), "
            f"'p', regexp_extract_all({text}, {p}, {group}))), v -> transform(v.m, (m, i) -> named_struct("
            "'gap', length(v.g[i]), 'len', length(m), 'token', m, 'part', v.p[i])))[0]")
    blocks = ("transform(array(named_struct('r', {rows})), w -> transform(sequence(0, cast(ceil(sqrt(size(w.r))) as int)), "
              "b -> slice(w.r, b * cast(ceil(sqrt(size(w.r))) as int) + 1, cast(ceil(sqrt(size(w.r))) as int))))[0]").format(rows=rows)
    offsets = ("aggregate(b.blocks, array(0), (acc, x) -> concat(acc, array(element_at(acc, -1) + "
               "aggregate(x, 0, (s, y) -> s + y.gap + y.len))))")
    inner = ("aggregate(x, named_struct('at', o.off[k], 'out', cast(array() as array<struct<start:int,end:int,token:string,part:string>>)), "
             "(a, y) -> named_struct('at', a.at + y.gap + y.len, 'out', concat(a.out, array(named_struct("
             "'start', a.at + y.gap, 'end', a.at + y.gap + y.len, 'token', y.token, 'part', y.part)))), a -> a.out)")
    return (f"transform(array(named_struct('blocks', {blocks})), b -> transform(array(named_struct('off', {offsets})), "
            f"o -> flatten(transform(b.blocks, (x, k) -> {inner})))[0])[0]")


_EMPTY = "cast(array() as array<struct<start:int,ord:int,kind:string,end:int>>)"


def _base_sql(text: str, order: int, kind: str, pattern: str, least: int, group: int) -> str:
    found = _matches(text, pattern, group)
    size = "length(m.part)"
    return (f"CASE WHEN {text} RLIKE {_quoted(pattern)} THEN transform(filter({found}, m -> {size} >= {least}), "
            f"m -> named_struct('start', m.start, 'ord', {order}, 'kind', '{kind}', 'end', m.end)) ELSE {_EMPTY} END")


def _words_sql(token: str) -> str:
    """SQL for whether a candidate is words: letters in pieces and humps that are each shaped like one."""
    pieces = f"split(regexp_replace({token}, '([a-z])([A-Z])', '$1-$2'), '[-_/+]')"
    sounds = f"regexp_replace(lower(p), '{ONE_SOUND}', 'x')"
    vowels = f"length(regexp_replace({sounds}, '{VOWELS}', '')) >= {VOWEL_SHARE}D * length({sounds})"
    shaped = f"p = '' OR p RLIKE '{WORD}' OR (p RLIKE '{LONG_WORD}' AND NOT {sounds} RLIKE '{HARD}' AND {vowels})"
    long = f"length(regexp_replace({token}, '[^A-Za-z]', '')) >= {MEAN_PIECE} * size(filter({pieces}, p -> p <> ''))"
    return f"({token} RLIKE '^[A-Za-z/_+-]*[A-Za-z][A-Za-z/_+-]*$' AND {long} AND forall({pieces}, p -> {shaped}))"


def _windows_sql(token: str, bits: str, window: int) -> str:
    """SQL for struct<first, last>: ends of the first and last window that reach ``bits`` and hold no placeholder (0: none)."""
    f = "CASE WHEN {n} > 1 THEN {n} * log2({n}) ELSE 0D END"
    n, k = "element_at(a.n, e.c)", "e.d"
    total = f"(a.s + {f.format(n=f'({n} + {k})')} - {f.format(n=n)})"
    clear = f"(size(x.marks) = 0 OR NOT exists(x.marks, p -> p.start >= e.i - {window} AND p.end <= e.i))"
    hot = f"(e.d = 1 AND e.i >= {window} AND log2({window}) - {total} / {window} >= {bits} - 1e-9 AND {clear})"
    events = (f"flatten(transform(x.codes, (c, i) -> concat("
              f"CASE WHEN i >= {window} THEN array(named_struct('i', i + 1, 'd', -1, 'c', x.codes[i - {window}])) "
              f"ELSE cast(array() as array<struct<i:int,d:int,c:int>>) END, "
              f"array(named_struct('i', i + 1, 'd', 1, 'c', c)))))")
    step = (f"(a, e) -> named_struct('n', transform(a.n, (v, j) -> CASE WHEN j = e.c - 1 THEN v + e.d ELSE v END), 's', {total}, "
            f"'first', CASE WHEN a.first = 0 AND {hot} THEN e.i ELSE a.first END, 'last', CASE WHEN {hot} THEN e.i ELSE a.last END)")
    marks = (f"CASE WHEN {token} RLIKE {_quoted(PLACEHOLDER)} THEN transform({_matches(token, PLACEHOLDER, 0)}, m -> named_struct('start', m.start, 'end', m.end)) "
             "ELSE cast(array() as array<struct<start:int,end:int>>) END")
    return (f"transform(array(named_struct('marks', {marks}, 'codes', transform(split({token}, ''), ch -> locate(ch, '{ALPHABET}')))), "
            f"x -> aggregate({events}, named_struct('n', array_repeat(0, {len(ALPHABET)}), 's', 0D, 'first', 0, 'last', 0), {step}))[0]")


def _entropy_sql(text: str, e: Entropy) -> str:
    found = _matches(text, CANDIDATE, 0)
    allowed = " OR ".join([*(f"m.token RLIKE {_quoted(p)}" for p in ALLOW), _words_sql("m.token")])
    is_hex = "m.token RLIKE '^[0-9a-fA-F]+$'"
    bits = f"CASE WHEN {is_hex} THEN {e.hex_bits}D ELSE {e.mixed_bits}D END"
    scored = (f"transform(filter({found}, m -> NOT ({allowed})), m -> named_struct('m', m, 'w', "
              f"{_windows_sql('m.token', bits, e.window)}))")
    return (f"CASE WHEN {text} RLIKE '{CANDIDATE}' THEN transform(filter({scored}, t -> t.w.first > 0), t -> named_struct("
            f"'start', t.m.start + t.w.first - {e.window}, 'ord', CASE WHEN {is_hex.replace('m.token', 't.m.token')} THEN {len(BASE)} ELSE {len(BASE) + 1} END, "
            f"'kind', CASE WHEN {is_hex.replace('m.token', 't.m.token')} THEN 'entropy_hex' ELSE 'entropy_mixed' END, "
            f"'end', t.m.start + t.w.last)) ELSE {_EMPTY} END")


def base_spans(text: str) -> Column:
    """All pattern spans of a text column as array<struct<start, ord, kind, end>>, by start then kind."""
    return F.expr("array_sort(concat(" + ", ".join(_base_sql(text, i, *b) for i, b in enumerate(BASE)) + "))")


def entropy_spans(text: str, entropy: Entropy = Entropy()) -> Column:
    return F.expr(f"array_sort({_entropy_sql(text, entropy)})")


def _joined(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def scan(docs: DataFrame, entropy: Entropy = Entropy()) -> DataFrame:
    """doc_id, base and spans (arrays of start, ord, kind, end) of every document."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    both = text.select("doc_id", base_spans("t").alias("base"), entropy_spans("t", entropy).alias("more"))
    return both.select("doc_id", "base", F.expr("array_sort(concat(base, more))").alias("spans"))


def report(docs: DataFrame, entropy: Entropy = Entropy()) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (text), n_entropy."""
    found = scan(docs, entropy)
    count = lambda kind: F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as bigint)")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k, *_ in BASE],
        F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"),
        F.expr("cast(size(spans) - size(base) as bigint)").alias("n_entropy"))


def redact(docs: DataFrame, mark: str = "[secret]", entropy: Entropy = Entropy()) -> DataFrame:
    """The same rows and columns with every span of ``text`` replaced by ``mark``.

    Overlapping spans become one mark.  ``n_chars``, if present, follows the new text.  Rows
    without spans, null texts included, stay as they are.
    """
    spans = "array_sort(concat(`__base`, `__more`))"
    pieces = (f"aggregate({spans}, named_struct('at', 0, 'out', cast(array() as array<string>)), (a, s) -> named_struct("
              "'at', greatest(a.at, s.end), 'out', CASE WHEN s.start >= a.at THEN concat(a.out, array("
              "substring(text, a.at + 1, s.start - a.at))) ELSE a.out END), "
              f"a -> concat(array_join(a.out, '{mark}'), '{mark}', substring(text, a.at + 1)))")
    marked = docs.withColumn("__base", base_spans("coalesce(text, '')")).withColumn(
        "__more", entropy_spans("coalesce(text, '')", entropy))
    hit = F.expr("size(`__base`) + size(`__more`) > 0")
    out = marked.withColumn("text", F.when(hit, F.expr(pieces)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)
