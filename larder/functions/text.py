"""Text rules for product descriptions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from larder.config import (
    CATEGORY_CODE_LIMITS,
    CATEGORY_CODE_REST,
    CATEGORY_KEYWORDS,
    CATEGORY_UNKNOWN,
)

# Between a letter and a non-letter, either way round.
_LETTER_EDGE = r"(?<=[^\p{L}])|(?=[^\p{L}])"
# Text on which initcap gives another answer than title_case.
_NOT_PLAIN = r"[^A-Za-z ][A-Za-z]|[^\x20-\x7E]"
# Most texts are letters and spaces only; that is found out in a tenth of the time.
_WORDS_ONLY = r"\A[A-Za-z ]*+\z"


def title_case(text: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest.

    ``initcap`` only looks at spaces, so it serves the plain texts and the
    split on letter edges is kept for the others.
    """
    pieces = F.split(F.lower(text), _LETTER_EDGE)
    general = F.array_join(F.transform(pieces, F.initcap), "")
    return F.when(text.rlike(_WORDS_ONLY), F.initcap(text)).when(text.rlike(_NOT_PLAIN), general).otherwise(F.initcap(text))


def title_key(text: Column) -> Column:
    """Lower-case text that is equal exactly when the title cases are equal.

    Letters outside ASCII may change length with their case, so those texts go
    through the title case itself.
    """
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.lower(title_case(text)))


def product_category(description: Column, code: Column) -> Column:
    """Category from description keywords, else from the stock-code prefix."""
    upper = F.upper(description)
    rule = F.when(description.isNull(), CATEGORY_UNKNOWN)
    for category, words in CATEGORY_KEYWORDS.items():
        hit = reduce(Column.__or__, [upper.contains(w) for w in words])
        rule = rule.when(hit, category)

    trimmed = F.trim(code)
    numeric = trimmed.rlike("^[0-9]+$")
    prefix = F.when(F.length(trimmed) >= 2, F.substring(trimmed, 1, 2).try_cast("int")).otherwise(0)
    for limit, category in CATEGORY_CODE_LIMITS:
        rule = rule.when(numeric & (prefix < limit), category)
    return rule.when(numeric, CATEGORY_CODE_REST).otherwise(CATEGORY_UNKNOWN)
