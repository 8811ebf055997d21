"""Column expressions: all built-in Spark functions, no Python UDFs."""

from brisa.functions.compass import COMPASS_DEGREES, compass_angle, compass_point
from brisa.functions.stamps import epoch_seconds, parse_stamp, stamp_text, stamp_to_int
from brisa.functions.text import (
    ci_contains,
    complement_intended,
    complement_literal,
    contains_any,
    lexicon_intended,
    lexicon_literal,
    split_tokens,
    variant_match,
)

__all__ = [
    "COMPASS_DEGREES", "compass_angle", "compass_point",
    "epoch_seconds", "parse_stamp", "stamp_text", "stamp_to_int",
    "ci_contains", "complement_intended", "complement_literal",
    "contains_any", "lexicon_intended", "lexicon_literal", "split_tokens",
    "variant_match",
]
