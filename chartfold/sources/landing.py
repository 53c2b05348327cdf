"""Landed vendor files: headers, verdicts before reading, and rows by column name.

A landing folder mixes files whose columns come in different orders. CSV files are cut into
records first (:mod:`chartfold.sources.records`), whatever their size and line ends; a join with
the table of file headers then puts every cell under its name. The folder is listed once;
everything later opens files by name. How large a file is decides how many tasks read it, never
which rows it has: a large XML file is split only if a look at all of its text shows no record
end within a record. A CSV file's first record that is not empty is its header.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field
from fnmatch import fnmatch
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartfold.contracts import Contract
from chartfold.functions.paths import (
    is_xml,
    object_key,
    object_name,
    object_uuid,
    object_vendor,
    scan_path,
)
from chartfold.operators.quality import EMPTY, ENCODING, HEADER_CONTRACT, MALFORMED, NO_VENDOR
from chartfold.operators.routing import BULK_BYTES, lane
from chartfold.session import fresh_folder
from chartfold.sources.records import POSITION, cut_records, read_records, record_heads
from chartfold.storage import is_hidden, listed, literal_path, qualified

# A larger XML file is cut at its record ends, so that several tasks can read it.
XML_SPLIT_BYTES = 128 * 1024 * 1024
_BROKEN = "_malformed"
LISTING = "file_path string, file_size bigint, modified bigint"


@dataclass(frozen=True)
class Landing:
    """A landing folder.

    ``options`` may hold ``modifiedAfter`` and ``modifiedBefore`` (ISO times in UTC) and
    ``pathGlobFilter`` (for names). With ``parts``, folders ``<parts>=<name>`` hold objects
    of several files.
    """

    root: str
    options: dict[str, str] = field(default_factory=dict)
    parts: str | None = None
    bulk_bytes: int = BULK_BYTES
    xml_split_bytes: int = XML_SPLIT_BYTES

    def _wanted(self, path: str, modified: int) -> bool:
        def bound(option: str) -> float | None:
            text = self.options.get(option)
            return dt.datetime.fromisoformat(text).replace(tzinfo=dt.UTC).timestamp() * 1000 if text else None

        after, before = bound("modifiedAfter"), bound("modifiedBefore")
        name = path.rpartition("/")[2]
        return (
            (after is None or modified > after)
            and (before is None or modified < before)
            and fnmatch(name, self.options.get("pathGlobFilter", "*"))
        )

    def files(self, spark: SparkSession, keys: Iterable[str] | None = None) -> DataFrame:
        """``file_path, file_size, modified, object_key, object_version`` of all files, or of
        those that the keys of some objects lead to. The version names the state of an object:
        sizes and times. What a listing of the root leaves out, no key leads to.
        """
        root = qualified(spark, self.root)
        if keys is None:
            found = listed(spark, root)
        else:
            found = []
            for key in keys:
                folder, _, name = f"{root}/{key}".rpartition("/")
                places = [f"{folder}/{name}", *([f"{folder}/{self.parts}={name}"] if self.parts else [])]
                found += [file for place in places for file in listed(spark, place)]
            found = [f for f in found if f[0].startswith(f"{root}/") and not is_hidden(f[0][len(root):])]
        found = sorted({file for file in found if self._wanted(file[0], file[2])})
        table = spark.createDataFrame(found, LISTING)
        state = F.concat_ws(":", "file_path", "file_size", "modified")
        of_object = Window.partitionBy("object_key")
        return table.withColumn("object_key", object_key("file_path", root, self.parts)).withColumn(
            "object_version", F.md5(F.array_join(F.sort_array(F.collect_list(state).over(of_object)), "|"))
        )


def _header_names(line: Column) -> Column:
    """Names in a CSV header line, quoted or not, without a byte-order mark."""
    text = F.regexp_replace(line, "^﻿|\r$", "")
    cells = F.regexp_extract_all(text, F.lit(r'("(?:[^"]|"")*"|[^,]*)(?:,|$)'), F.lit(1))
    return F.transform(
        cells,
        lambda c: F.when(
            c.startswith('"'), F.replace(F.regexp_replace(c, '^"|"$', ""), F.lit('""'), F.lit('"'))
        ).otherwise(c),
    )


def _position(header: Column, name: str) -> Column:
    """Index of the last column of that name, NULL without one."""
    from_end = F.array_position(F.reverse(header), name)
    return F.when(from_end > 0, F.size(header) - from_end).cast("int")


def _opened(paths: list[str]) -> list[str]:
    return [literal_path(path) for path in paths]


def _xml_heads(spark: SparkSession, paths: list[str], tag: str) -> DataFrame:
    """Whether a large XML file holds what could hide a record end, or an unclosed record.

    Text is cut at record ends. Safe is a file whose every piece has one record start at
    most and no comment, CDATA section or declaration, and whose last piece, behind which no
    record end follows, has none.
    """
    starts = F.regexp_count("value", F.lit(rf"<{tag}[\s>/]"))
    hidden = F.contains("value", F.lit("<!")) | (starts > 1)
    closes_root = F.rlike(F.col("value"), F.lit(r"^\s*</[^<>]+>\s*$"))
    return (
        spark.read.option("lineSep", f"</{tag}>")
        .text(_opened(paths))
        .select(scan_path().alias("file_path"), F.is_valid_utf8("value").alias("is_text"),
                hidden.alias("hidden"), closes_root.alias("closes"), (starts == 1).alias("starts"))
        .groupBy("file_path")
        .agg(
            F.lit("").alias("header_line"),
            F.bool_and("is_text").alias("is_text"),
            # One piece closes the root and holds no record; all others hold one each.
            (F.bool_or("hidden") | (F.count_if("closes") != 1)
             | (F.count_if(~F.col("starts")) != 1)).alias("whole"),
        )
    )


def _whole_texts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Whether XML files that one task reads each are UTF-8."""
    return spark.read.format("binaryFile").load(_opened(paths)).select(
        scan_path().alias("file_path"), F.lit("").alias("header_line"),
        F.is_valid_utf8(F.col("content").cast("string")).alias("is_text"), F.lit(True).alias("whole"))


def read_heads(
    spark: SparkSession, landing: Landing, files: DataFrame, work: str, tag: str = "record"
) -> DataFrame:
    """``file_path, header_line, header_at, is_text, whole, is_open, records`` of every file that
    is not empty; an XML file has no header line. CSV files are cut into records below ``work``
    on the way. Only kinds of files that occur are opened.
    """
    lanes = defaultdict(list)
    for row in files.select("file_path", "file_size").where("file_size > 0").collect():
        xml = row.file_path.lower().endswith(".xml")
        lanes[xml, row.file_size >= (landing.xml_split_bytes if xml else landing.bulk_bytes)].append(row.file_path)
    heads = []
    if lanes[False, False] or lanes[False, True]:
        records = cut_records(spark, lanes[False, False], lanes[False, True], work)
        heads.append(record_heads(spark, records).withColumn("records", F.lit(records)))
    if lanes[True, False]:
        heads.append(_whole_texts(spark, lanes[True, False]))
    if lanes[True, True]:
        heads.append(_xml_heads(spark, lanes[True, True], tag))
    nothing = files.where("false").select(
        "file_path", F.lit("").alias("header_line"), F.lit(None).cast(POSITION).alias("header_at"),
        F.lit(True).alias("is_text"), F.lit(False).alias("whole"), F.lit(False).alias("is_open"),
        F.lit("").alias("records"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), heads, nothing)


def list_files(
    spark: SparkSession, landing: Landing, contract: Contract, listing: DataFrame | None = None,
    work: str | None = None,
) -> DataFrame:
    """One row per landed file: object, lane, lineage, column positions, and the reason if
    the file cannot be read. A fault in one part of an object rejects the whole object.

    The records of CSV files are left below ``work``, where :func:`read_landing` finds them.
    """
    listing = landing.files(spark) if listing is None else listing
    work = work or fresh_folder(spark, "records")
    header = _header_names(F.coalesce("header_line", F.lit("")))
    positions = F.struct(*[_position(F.col("header"), c).alias(c) for c in contract.columns])
    complete = reduce(
        Column.__and__, [F.col(f"positions.{c}").isNotNull() for c in contract.columns]
    )
    named = listing.join(read_heads(spark, landing, listing, work), "file_path", "left")
    files = named.withColumn("header", header).select(
        "file_path",
        "file_size",
        "object_key",
        "object_version",
        object_name("file_path", landing.parts).alias("object_name"),
        F.when(is_xml("file_path"), "xml").otherwise("csv").alias("format"),
        positions.alias("positions"),
        F.coalesce("is_text", F.lit(True)).alias("is_text"),
        F.coalesce("whole", F.lit(False)).alias("whole"),
        F.coalesce("is_open", F.lit(False)).alias("is_open"),
        "header_at",
        "records",
    )
    files = files.select(
        "*",
        (F.greatest(F.lit(-1), *[F.col(f"positions.{c}") for c in contract.columns]) + 1).alias("width"),
        lane("file_size", "file_path", landing.bulk_bytes).alias("lane"),
        object_vendor("object_name").alias("source_vendor"),
        object_uuid("object_name").alias("lineage_file_uuid"),
    )
    reason = (
        F.when(F.col("file_size") == 0, EMPTY)
        .when(~F.col("is_text"), ENCODING)
        .when((F.col("format") == "csv") & ~complete, HEADER_CONTRACT)
        .when(F.col("source_vendor").isNull(), NO_VENDOR)
        .when(F.col("is_open"), MALFORMED)
    )
    of_object = Window.partitionBy("object_key")
    return files.withColumn("reason", F.min(reason).over(of_object)).drop("is_text", "is_open")


_FILE_COLUMNS = ["object_key", "source_vendor", "lineage_file_uuid"]


def _with_file(rows: DataFrame, files: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of readable files, beside some columns of the file table."""
    return rows.join(files.where("reason is null").select("file_path", *columns), "file_path")


def read_landing_csv(spark: SparkSession, files: DataFrame, contract: Contract, records: str, width: int) -> DataFrame:
    """Contract columns, as text, of the records of readable CSV files.

    ``width`` is the number of columns needed of the file that has them farthest apart.
    """
    schema = ", ".join(f"c{i} string" for i in range(width))
    placed = _with_file(read_records(spark, records), files, [*_FILE_COLUMNS, "positions", "header_at", "lane"])
    rows = placed.where((F.col("at") > F.col("header_at")) & (F.col("text") != ""))
    cells = F.array(*[F.col(f"row.c{i}") for i in range(width)])
    # Behind an explode, a later filter is not pushed down to parse every record once more.
    row = F.explode(F.array(F.from_csv("text", schema, {"escape": '"'})))
    rows = rows.withColumn("row", row).withColumn("cells", cells)
    return rows.select(
        *[F.get("cells", F.col(f"positions.{c}")).alias(c) for c in contract.columns],
        *_FILE_COLUMNS,
        "lane",
        F.lit(False).alias("is_malformed"),
    )


def _steps(path: str) -> list[tuple[str, bool]]:
    """Names along a path of an XML record, as Spark's reader names them, and whether they repeat."""
    return [(step.removesuffix("[]").replace("@", "_"), step.endswith("[]")) for step in path.split("/")]


def _xml_schema(paths: list[str]) -> T.StructType:
    """Schema of a record that holds text at some paths, and a column for broken ones."""

    def of(places: list[list[tuple[str, bool]]]) -> T.StructType:
        below = defaultdict(list)
        for (name, repeated), *rest in places:
            below[name, repeated].append(rest)
        fields = []
        for (name, repeated), rests in below.items():
            nested = [rest or [("_VALUE", False)] for rest in rests]
            kind = of(nested) if any(rests) else T.StringType()
            fields.append(T.StructField(name, T.ArrayType(kind) if repeated else kind))
        return T.StructType(fields)

    return of([_steps(path) for path in dict.fromkeys(paths)]).add(_BROKEN, T.StringType())


def _at_path(schema: T.StructType, path: str) -> Column:
    """The text at a path, NULL where there is none; texts of repeated children joined, without blank ones."""

    def inside(value: Column | None, kind: T.DataType, steps: list[tuple[str, bool]]) -> tuple[Column, bool]:
        if not steps:
            return (value["_VALUE"] if isinstance(kind, T.StructType) else value), False
        (name, repeated), *rest = steps
        child, below = F.col(f"`{name}`") if value is None else value[name], kind[name].dataType
        if not repeated:
            return inside(child, below, rest)
        many = inside(F.element_at(child, 1), below.elementType, rest)[1]
        texts = F.transform(child, lambda each: inside(each, below.elementType, rest)[0])
        return F.flatten(F.array_compact(texts)) if many else texts, True

    found, many = inside(None, schema, _steps(path))
    return F.array_join(F.filter(found, lambda text: F.trim(text) != ""), ",") if many else found


def _whole_xml(spark: SparkSession, paths: list[str], schema: T.StructType, options: dict) -> DataFrame:
    rows = spark.read.format("xml").options(**options).schema(schema).load(_opened(paths))
    return rows.select("*", scan_path().alias("file_path"))


def _split_xml(spark: SparkSession, paths: list[str], schema: T.StructType, options: dict) -> DataFrame:
    """Large files as text that ends with each record, which Spark can split."""
    tag = options["rowTag"]
    fragment = F.regexp_extract("value", rf"(?s)(<{tag}[\s>/].*)$", 1)
    # Behind an explode, a later filter is not pushed down to cut and to parse every record once more.
    parsed = F.explode(F.array(F.from_xml(F.concat("fragment", F.lit(f"</{tag}>")), schema, options)))
    return (
        spark.read.option("lineSep", f"</{tag}>")
        .text(_opened(paths))
        .select(scan_path().alias("file_path"), F.explode(F.array(fragment)).alias("fragment"))
        .where("fragment <> ''")
        .withColumn("r", parsed)
        .select("r.*", "file_path")
    )


def read_landing_xml(
    spark: SparkSession,
    files: DataFrame,
    contract: Contract,
    paths: list[str],
    whole: bool,
    tag: str = "record",
) -> DataFrame:
    """Contract columns, as text, of each ``<record>``; a broken record is all NULL and flagged."""
    places = [f.xml_path or f.name for f in contract.fields]
    schema = _xml_schema(places)
    options = {"rowTag": tag, "columnNameOfCorruptRecord": _BROKEN}
    read = (_whole_xml if whole else _split_xml)(spark, paths, schema, options)
    values = [_at_path(schema, place).alias(c) for place, c in zip(places, contract.columns)]
    rows = read.select(*values, F.col(_BROKEN).isNotNull().alias("is_malformed"), "file_path")
    return _with_file(rows, files, _FILE_COLUMNS).select(
        *contract.columns, *_FILE_COLUMNS, F.lit("bulk").alias("lane"), "is_malformed")


def read_landing(
    spark: SparkSession, landing: Landing, files: DataFrame, contract: Contract
) -> DataFrame:
    """Rows of every readable file. Only kinds of files that occur are scanned for."""
    readable = files.where("reason is null")
    cut = readable.where("format = 'csv'").groupBy("records").agg(F.max("width").alias("width")).collect()
    tables = [read_landing_csv(spark, files, contract, row.records, row.width) for row in cut]
    kinds = defaultdict(list)
    for row in readable.where("format = 'xml'").select("file_path", "whole").collect():
        kinds[row.whole].append(row.file_path)
    tables += [read_landing_xml(spark, files, contract, paths, whole) for whole, paths in sorted(kinds.items())]
    if not tables:
        columns = [*contract.columns, *_FILE_COLUMNS, "lane"]
        nothing = files.where("false").select(*[F.lit("").alias(c) for c in columns])
        return nothing.withColumn("is_malformed", F.lit(False))
    return reduce(DataFrame.unionByName, tables)


def read_raw_text(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Raw lines with the file they come from."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .text(paths)
        .select("value", scan_path().alias("file_path"))
    )


def read_notifications(spark: SparkSession, path: str) -> DataFrame:
    """Queue messages saved as JSON lines."""
    return spark.read.schema("receipt string, body string").json(path)


def stream_notifications(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema("receipt string, body string")
        .option("maxFilesPerTrigger", max_files)
        .json(path)
    )
