"""Columns derived from object keys and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartfold.functions.text import as_column

# The grammar of object keys and names.
UNKNOWN_UUID = "UNKNOWN_UUID"  # stands for a name without a file id
SILVER_PREFIX = "silver-vitals/"
_EXTENSION = r"(?i)\.(csv|xml)$"
_NAMED = r"^(.+)__vitals__(.*)$"


def decode_key(key: Column | str) -> Column:
    """Undo URL encoding, once: ``+`` is a space, ``%2B`` a plus. NULL if it is malformed."""
    return F.try_url_decode(as_column(key))


def file_name(key: Column | str) -> Column:
    return F.substring_index(as_column(key), "/", -1)


def _name_parts(key: Column | str) -> Column:
    return F.split(F.replace(file_name(key), F.lit(".csv"), F.lit("")), "__")


def vendor_from_name(key: Column | str) -> Column:
    """Small-file rule: first ``__`` part of the file name."""
    return F.get(_name_parts(key), F.lit(0))


def lineage_uuid(key: Column | str) -> Column:
    """Small-file rule: fourth ``__`` part of the file name."""
    return F.coalesce(F.get(_name_parts(key), F.lit(3)), F.lit(UNKNOWN_UUID))


def vendor_from_path(key: Column | str) -> Column:
    """Bulk rule: what precedes ``__vitals__`` in the first path segment that has it."""
    return F.regexp_extract(as_column(key), r"([^/]+)__vitals__", 1)


def _stem(name: Column | str) -> Column:
    return F.regexp_replace(as_column(name), _EXTENSION, "")


def object_vendor(name: Column | str) -> Column:
    """The rule both lanes share: text before ``__vitals__`` in the file name, else NULL."""
    return F.nullif(F.regexp_extract(_stem(name), _NAMED, 1), F.lit(""))


def object_uuid(name: Column | str) -> Column:
    """The rule both lanes share: second part behind ``__vitals__``, without extension."""
    tail = F.split(F.regexp_extract(_stem(name), _NAMED, 2), "__")
    return F.coalesce(F.nullif(F.get(tail, F.lit(1)), F.lit("")), F.lit(UNKNOWN_UUID))


def plain_path(path: Column | str) -> Column:
    """Path as text: Spark reports it URI-encoded, where ``+`` stands for itself."""
    return F.try_url_decode(F.replace(as_column(path), F.lit("+"), F.lit("%2B")))


def scan_path() -> Column:
    """Path of the file that a scanned row comes from, in the form of a file listing."""
    return F.regexp_replace(plain_path("_metadata.file_path"), "^file:/+", "file:/")


def _whole_object(path: Column | str, parts: str | None) -> Column:
    """Path of the object a file belongs to: the file, or the folder `<parts>=<name>` around it."""
    text = as_column(path)
    return F.regexp_replace(text, rf"/{parts}=([^/]+)/[^/]+$", "/$1") if parts else text


def object_key(path: Column | str, root: str, parts: str | None = None) -> Column:
    """Key of a landed object: what follows the landing root, which `path` must begin with.

    ``root`` is a qualified path. With ``parts``, a folder ``<parts>=<name>`` holds one object
    that a Spark job wrote in several files; all of them share the key.
    """
    whole = _whole_object(path, parts)
    return F.when(F.startswith(whole, F.lit(f"{root}/")), F.substring(whole, len(root) + 2, 1 << 20))


def object_name(path: Column | str, parts: str | None = None) -> Column:
    """File name of a landed object, see :func:`object_key`."""
    return file_name(_whole_object(path, parts))


def is_xml(name: Column | str) -> Column:
    return F.lower(as_column(name)).endswith(".xml")


def silver_bucket(bucket: Column | str) -> Column:
    return F.replace(as_column(bucket), F.lit("-bronze"), F.lit("-silver"))


def silver_key(name: Column | str) -> Column:
    """Target of a cleaned file; the extension is matched in any case."""
    clean = F.regexp_replace(file_name(name), r"(?i)\.csv$", "_clean.csv")
    return F.concat(F.lit(SILVER_PREFIX), clean)
