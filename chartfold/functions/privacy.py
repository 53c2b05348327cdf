"""Pseudonyms and surrogate keys, without leaving the JVM."""

from __future__ import annotations

import hashlib
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartfold.functions.text import as_column, has_text, strip

KEY_VARIABLE = "CHARTFOLD_HMAC_KEY"
_BLOCK = 64  # bytes in one SHA-256 block


def load_key(path: str | None = None) -> str:
    """The secret, from a file or from the environment. There is no default."""
    secret = Path(path).read_text().strip() if path else os.environ.get(KEY_VARIABLE, "")
    if not secret:
        raise ValueError(f"no pseudonym key: set {KEY_VARIABLE} or name a key file")
    return secret


def hmac_pads(key: str) -> tuple[bytes, bytes]:
    """Inner and outer pad of HMAC-SHA256 (RFC 2104)."""
    raw = key.encode()
    if len(raw) > _BLOCK:
        raw = hashlib.sha256(raw).digest()
    block = raw.ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)


def hmac_sha256(message: Column, key: str) -> Column:
    """Hex HMAC-SHA256 of a binary column as two nested native SHA-256 calls."""
    inner_pad, outer_pad = hmac_pads(key)
    inner = F.unhex(F.sha2(F.concat(F.lit(inner_pad), message), 256))
    return F.sha2(F.concat(F.lit(outer_pad), inner), 256)


def pseudonymize_hmac(column: Column | str, key: str) -> Column:
    """Keyed pseudonym of the stripped, upper-cased identifier; NULL for a blank one."""
    clean = F.upper(strip(column))
    return F.when(has_text(column), hmac_sha256(clean.cast("binary"), key))


def pseudonymize_concat(column: Column | str, salt: str) -> Column:
    """Compatibility form: plain digest of identifier followed by salt, nothing normalised."""
    return F.sha2(F.concat(as_column(column), F.lit(salt)), 256)


def timestamp_text(column: Column | str) -> Column:
    return F.date_format(as_column(column), "yyyy-MM-dd HH:mm:ss.SSS")


def surrogate_key(encounter: Column | str, vendor: Column | str, loaded: Column | str) -> Column:
    """Digest naming one version of one encounter; NULL if any part is NULL."""
    parts = [as_column(encounter), F.lit("_"), as_column(vendor), F.lit("_"), timestamp_text(loaded)]
    return F.md5(F.concat(*parts))


def _texts(value: Column, kind: T.DataType) -> Column:
    """All values inside a column, as an array of texts, whatever its nesting."""
    if isinstance(kind, T.StructType):
        return F.concat(*[_texts(value.getField(f.name), f.dataType) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        items = F.coalesce(value, F.array().cast(kind))
        return F.flatten(F.transform(items, lambda x: _texts(x, kind.elementType)))
    if isinstance(kind, T.MapType):
        sides = ((F.map_keys(value), kind.keyType), (F.map_values(value), kind.valueType))
        return F.concat(*[_texts(side, T.ArrayType(of)) for side, of in sides])
    return F.array(value.cast("string"))


def clear_identities(df: DataFrame, identities: DataFrame) -> DataFrame:
    """Distinct clear identifiers that still occur anywhere in ``df``: as a value of any column
    or nested field, number or text, or as a word of a longer text.

    ``identities`` has one column ``identity``. Words and identities meet in one aggregate, which each
    task begins before the shuffle: a word that most rows hold, as a vendor or a blank, comes once
    per task, and no task has to sort its copies.
    """
    known = identities.select(F.col("identity").cast("string").alias("identity"), F.lit(True).alias("is_known"))
    values = F.concat(*[_texts(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])
    each = df.select(F.explode(F.array_distinct(values)).alias("value")).where("value IS NOT NULL")
    words = F.array_union(F.array("value"), F.split("value", r"[^\p{L}\p{N}_-]+"))
    found = each.select(F.explode(words).alias("identity"), F.lit(False).alias("is_known"))
    both = found.unionByName(known).groupBy("identity").agg(
        F.bool_or("is_known").alias("is_known"), F.bool_or(~F.col("is_known")).alias("is_found"))
    return both.where("is_known AND is_found").select("identity")
