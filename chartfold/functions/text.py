"""Text cleaning and typed casts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartfold.contracts import NULL_TOKENS

# Every character that counts as white space in Unicode, and the four
# information separators, which text files from older systems use as such.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def as_column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def strip(column: Column | str) -> Column:
    """Remove surrounding white space, of any Unicode kind."""
    return F.btrim(as_column(column), F.lit(WHITESPACE))


def has_text(column: Column | str) -> Column:
    """True for a value with at least one visible character, never NULL."""
    return F.coalesce(strip(column) != "", F.lit(False))


def default_fill(column: Column | str, default: str) -> Column:
    """The stripped value, or the default where it is blank or NULL."""
    return F.when(has_text(column), strip(column)).otherwise(F.lit(default))


def null_tokens(column: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """NULL where the whole value is one of the tokens."""
    return F.when(~as_column(column).isin(*tokens), as_column(column))


def to_bigint(column: Column | str) -> Column:
    """Number or numeric text to a whole number, halves away from zero; NULL if it is neither."""
    return as_column(column).try_cast("decimal(38,0)").try_cast("bigint")


def typed_cast(column: Column | str, type_name: str) -> Column:
    if type_name in ("bigint", "long"):
        return to_bigint(column)
    return as_column(column).try_cast(type_name)
