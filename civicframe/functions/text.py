"""Regular expressions, text cleaning and list columns, all as built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns whose results must be matched.
EMAIL_PATTERN = r"^[\w\.]+@[\w\.]+\.\w+$"
URL_PATTERN = r"https?://[\w\d\.-]+\.\w{2,}|www\.[\w\d\.-]+\.\w{2,}"
WORD_PATTERN = "[a-z]+"
SPECIAL_CHARACTERS = "@$!%*?&"


def detect(x: Column, pattern: str) -> Column:
    return x.rlike(pattern)


def extract_all(x: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(x, F.lit(pattern), F.lit(group))


def match(x: Column, pattern: str, groups: int) -> Column:
    """Array of the full match and each group; null when nothing matches."""
    parts = [F.regexp_extract(x, pattern, i) for i in range(groups + 1)]
    return F.when(x.rlike(pattern), F.array(*parts))


def replace_all(x: Column, pattern: str, replacement: str) -> Column:
    """Replacement text uses $1, $2, ... for groups; patterns may use backreferences."""
    return F.regexp_replace(x, pattern, replacement)


def is_email(x: Column, unicode_words: bool = True) -> Column:
    return x.rlike(("(?U)" if unicode_words else "") + EMAIL_PATTERN)


def urls(x: Column) -> Column:
    return extract_all(x, URL_PATTERN)


# Three digits, three digits, four digits; not part of a longer run of digits.
PHONE_PATTERN = r"(?<![0-9])\(?([0-9]{3})\)?[-. ]?([0-9]{3})[-. ]?([0-9]{4})(?![0-9])"


def standard_phones(x: Column) -> Column:
    """Rewrite phone numbers inside a text as (XXX) XXX-XXXX."""
    return F.regexp_replace(x, PHONE_PATTERN, "($1) $2-$3")


def strong_password(x: Column) -> Column:
    rules = ["[A-Z]", "[a-z]", "[0-9]", f"[{SPECIAL_CHARACTERS}]"]
    return reduce(lambda a, b: a & b, [x.rlike(r) for r in rules], F.length(x) >= 8)


def first_match(x: Column, pattern: str) -> Column:
    """First match, or the empty text."""
    return F.trim(F.regexp_extract(x, pattern, 0))


def squeeze(x: Column) -> Column:
    """Runs of white space become one blank; no blank at the ends."""
    return F.trim(F.regexp_replace(x, "[\\s\\u00a0]+", " "))


def drop_blank(items: Column) -> Column:
    return F.filter(F.transform(items, lambda v: F.trim(v)), lambda v: v != "")


def tokens(x: Column, pattern: str = WORD_PATTERN) -> Column:
    return extract_all(F.lower(x), pattern)
