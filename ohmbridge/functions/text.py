"""Text as Column expressions: normal forms, similarity, ids."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def collapse(c: Column) -> Column:
    """White space runs to one space, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def filled(c: Column) -> Column:
    """Null for a blank text: absent and empty are the same."""
    return F.nullif(c, F.lit(""))


def first_filled(*cols: Column) -> Column:
    return F.coalesce(*(filled(c) for c in cols))


def normal(c: Column) -> Column:
    """Lower case, anything but letters and digits to single spaces; '' for null."""
    return F.coalesce(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")), F.lit(""))


def key_text(c: Column) -> Column:
    """An id as it is compared: trimmed, lower case, null if blank."""
    return filled(F.lower(F.trim(c.cast("string"))))


def tokens(c: Column) -> Column:
    return F.filter(F.split(normal(c), " "), lambda t: t != "")


def token_dice(a: Column, b: Column) -> Column:
    """Twice the common distinct tokens over all distinct tokens; 1 if both have none, 0 if one has none."""
    x, y = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    both = F.size(x) + F.size(y)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(x, y)) / F.greatest(both, F.lit(1)))


@F.pandas_udf(T.DoubleType())
def _sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def name_similarity(a: Column, b: Column) -> Column:
    """The larger of the character-sequence ratio and token Dice of two normalised names.

    The ratio has no built-in; it is Arrow-batched, and meant for pairs that
    blocking has left. It depends on the order of a and b.
    """
    na, nb = normal(a), normal(b)
    return F.when((na == "") & (nb == ""), F.lit(1.0)).when((na == "") | (nb == ""), F.lit(0.0)).otherwise(F.greatest(_sequence_ratio(na, nb), token_dice(a, b)))


def sha1_id(prefix: str, *parts: Column, sep: str = ":") -> Column:
    """prefix and the first 12 hex digits of the SHA-1 of the joined parts."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws(sep, *parts).cast("binary")), 1, 12))


def sha256_id(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(key, 256), 1, 20))


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null if there is none or it is blank."""
    return filled(F.trim(F.regexp_extract(c, pattern, group)))


def ordered_case(c: Column, rules: list[tuple[str, str]], otherwise: Column | None = None) -> Column:
    """The value of the first pattern that is found."""
    out = None
    for pattern, value in rules:
        out = F.when(c.rlike(pattern), F.lit(value)) if out is None else out.when(c.rlike(pattern), F.lit(value))
    return out.otherwise(otherwise if otherwise is not None else F.lit(None).cast("string"))
