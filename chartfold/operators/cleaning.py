"""Row rules between a landing table and a silver or staging table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartfold.contracts import HASHED_ID, LINEAGE_COLUMNS, Contract
from chartfold.functions.privacy import pseudonymize_hmac
from chartfold.functions.text import default_fill, has_text, null_tokens, strip, typed_cast


def all_present(columns: list[str], blank_counts_as_missing: bool = True) -> Column:
    """True where every column has a value; by default blank text is no value."""
    tests = [has_text(c) if blank_counts_as_missing else F.col(c).isNotNull() for c in columns]
    return reduce(Column.__and__, tests, F.lit(True))


def required_keys(
    df: DataFrame, columns: list[str], blank_counts_as_missing: bool = True
) -> DataFrame:
    if not blank_counts_as_missing:
        return df.dropna(subset=columns)
    return df.where(all_present(columns))


def trim_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: strip(c) for c in columns})


def fill_defaults(df: DataFrame, contract: Contract) -> DataFrame:
    defaults = {
        f.name: default_fill(f.name, f.default) for f in contract.fields if f.default is not None
    }
    return df.withColumns(defaults) if defaults else df


def nullify_tokens(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: null_tokens(c) for c in columns})


def drop_identity(df: DataFrame, contract: Contract, extras: tuple[str, ...] = ()) -> DataFrame:
    """Only contract columns leave, without the clear identity; extras must be named."""
    kept = [c for c in df.columns if c in contract.silver_columns or c in extras]
    return df.select(*[c for c in kept if c != contract.identity])


def clean_rows(df: DataFrame, contract: Contract, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Silver columns of every row, plus ``is_valid`` and the columns in ``keep``.

    Invalid rows stay, flagged, so that one pass yields both the silver rows and the
    counts per file; their values are of no further use.
    """
    text = {f.name: strip(f.name) for f in contract.fields if f.name != contract.identity}
    text |= {
        f.name: default_fill(f.name, f.default) for f in contract.fields if f.default is not None
    }
    if contract.identity:
        text[HASHED_ID] = pseudonymize_hmac(contract.identity, key)
    kept = [c for c in (*LINEAGE_COLUMNS, *keep) if c not in text]
    return df.select(
        *[text[c].alias(c) for c in contract.silver_columns if c in text],
        *kept,
        all_present(contract.non_blank).alias("is_valid"),
    )


def typed_columns(df: DataFrame, contract: Contract) -> DataFrame:
    """Silver columns in their contract types, matched by name; an absent one is NULL.

    ``cast_errors`` names the columns whose value did not fit their type.
    """
    present = set(df.columns)
    casts, errors = [], []
    for name in contract.silver_columns:
        kind = contract.typed(name)
        if name not in present:
            casts.append(F.lit(None).cast(kind).alias(name))
            continue
        cast = typed_cast(name, kind)
        casts.append(cast.alias(name))
        if kind != "string":
            errors.append(F.when(cast.isNull() & F.col(name).isNotNull(), F.lit(name)))
    found = F.array_compact(F.array(*errors)) if errors else F.array().cast("array<string>")
    others = [c for c in df.columns if c not in contract.silver_columns]
    return df.select(*casts, *others, found.alias("cast_errors"))
