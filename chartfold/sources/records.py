"""CSV text cut into records, by as many tasks as there are blocks of a file.

A record ends at a line end outside quotes. Line ends are LF and CRLF; in a file whose first one
is a lone CR, CR ends lines, too. Anywhere else a lone CR belongs to its cell. A quote opens a
quoted cell only where a cell begins, and a doubled quote within one stands for itself.

A small file comes whole, and one pattern cuts all of its records. A large one is cut at every line
end first, and whether a line begins within quotes is settled after.
A line is a function from "begins within quotes" to "ends within quotes": it keeps that, turns it,
or ends the same way whatever came before. Such functions compose, so a running window over the
lines of each chunk of a block, and one over the chunks of each file, give every line's beginning. Lines
that belong together are then joined with the line ends that stood between them. Only files with a
line that opens quotes and does not close them take part in this; in all others each line is a
record where it was read.

The lines are written once, so that every later step sees the same blocks, however Spark would
split the file at another time. No window holds more than 65,536 of them, and they pass through
the windows once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartfold.functions.paths import scan_path
from chartfold.storage import delete, is_complete, literal_path, write_work_table

# Where a line lies: the block's first byte, its number within the block, its number within a CR line.
POSITION = "struct<block: bigint, line: bigint, part: int>"
# Lines of a block that one window holds, in bits of their number.
CHUNK_BITS = 16
# What stands within quotes. These patterns never give back what they took, so they need no stack.
_QUOTED = '(?:[^"]++|"")*+'


def _cells(line_ends: str) -> str:
    """Pattern of one cell, up to a comma or a line end outside quotes."""
    return f'(?:"{_QUOTED}"?+)?+[^,{line_ends}]*+'


_OPEN_CELL = rf'(?:{_cells("")},)*+"{_QUOTED}\z'


def _opened(paths: list[str]) -> list[str]:
    return [literal_path(path) for path in paths]


def ends_inside(line: Column, begins_inside: bool) -> Column:
    """Whether a line ends within quotes, for either beginning."""
    pattern = rf'\A{_QUOTED}(?:\z|"[^,]*+,{_OPEN_CELL})' if begins_inside else rf"\A{_OPEN_CELL}"
    return F.when(F.contains(line, F.lit('"')), F.rlike(line, F.lit(pattern))).otherwise(begins_inside)


def _pieces(value: Column, is_cr: Column) -> Column:
    """Lines within what a file's own line end cut, each with the line end before it."""
    after_crlf = F.startswith(value, F.lit("\n"))
    rest = F.when(after_crlf, F.substring(value, F.lit(2), F.length(value))).otherwise(value)
    first = F.when(after_crlf, F.lit("\r\n")).otherwise(F.lit("\r"))
    in_cr = F.transform(F.split(rest, "\n"), lambda text, i: F.struct(
        i.alias("part"), F.when(i == 0, first).otherwise(F.lit("\n")).alias("lead"), text.alias("value")))
    in_lf = F.array(F.struct(F.lit(0).alias("part"), F.lit("\n").alias("lead"), value.alias("value")))
    return F.when(is_cr, in_cr).otherwise(in_lf)


def _first_end_is_cr(text: Column) -> Column:
    return F.regexp_extract(text, "\r\n|\n|\r", 0) == "\r"


def _small_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file_path, at, text, is_text, is_open`` of the records of files that come whole."""

    def by_ends(of: Callable[[str], Column]) -> Column:
        return F.when(F.col("is_cr"), of(r"\r\n")).otherwise(of(r"\n"))

    def unmarked(ends: str) -> Column:
        return F.regexp_replace("text", rf"(\A|[{ends}])\ufeff", "$1")

    def cut(ends: str) -> Column:
        cell, end = _cells(ends), r"\r\n|\r|\n" if ends == r"\r\n" else ends
        return F.regexp_extract_all("text", F.lit(rf"({cell}(?:,{cell})*+)(?:{end}|\z)"), F.lit(1))

    text = F.col("content").cast("string")
    files = spark.read.format("binaryFile").load(_opened(paths)).select(
        scan_path().alias("file_path"), text.alias("text"), _first_end_is_cr(text).alias("is_cr"),
        F.is_valid_utf8(text).alias("is_text"))
    marked = F.contains("text", F.lit("\ufeff"))
    files = files.withColumn("text", F.when(marked, by_ends(unmarked)).otherwise(F.col("text")))
    files = files.withColumn("records", by_ends(cut))
    # The pattern finds an empty record at the end of every text, behind the last one.
    is_open = F.exists(F.slice("records", -2, 2), lambda record: ends_inside(record, False))
    found = F.slice("records", 1, F.size("records") - 1)
    files = files.select("file_path", "is_text", is_open.alias("is_open"), found.alias("records"))
    # Beside the explode stand plain columns only: what it needs of the array would be copied with every record.
    records = files.select("file_path", "is_text", "is_open", F.posexplode("records").alias("line", "text"))
    at = F.struct(F.lit(0).cast("bigint").alias("block"), F.col("line").cast("bigint").alias("line"), F.lit(0).alias("part"))
    return records.select("file_path", at.alias("at"), "text", "is_text", "is_open")


def _bulk_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of files that many tasks read, each at the line end that the file has first."""
    cells = spark.read.option("lineSep", ",").text(_opened(paths)).select(
        scan_path().alias("file_path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("number"), _first_end_is_cr(F.col("value")).alias("is_cr"),
        (F.contains("value", F.lit("\n")) | F.contains("value", F.lit("\r"))).alias("has_end"))
    blocks = cells.where("has_end").groupBy("file_path", "block").agg(F.min_by("is_cr", "number").alias("is_cr"))
    kinds = blocks.groupBy("file_path").agg(F.min_by("is_cr", "block").alias("is_cr"))
    cr = {row.file_path for row in kinds.where("is_cr").select("file_path").collect()}
    tables = []
    for separator, is_cr in (("\n", False), ("\r", True)):
        mine = [path for path in paths if (path in cr) == is_cr]
        if mine:
            lines = spark.read.option("lineSep", separator).text(_opened(mine))
            tables.append(lines.select(
                scan_path().alias("file_path"), F.lit(is_cr).alias("is_cr"), F.is_valid_utf8("value").alias("is_text"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"), "value"))
    return tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file_path, at, lead, value, is_text, opens, stays``: whether a line ends within quotes, for both beginnings."""
    read = _bulk_lines(spark, paths)
    pieces = read.select("file_path", "block", "line", "is_text", F.explode(_pieces(F.col("value"), F.col("is_cr"))).alias("piece"))
    value = F.regexp_replace("piece.value", "^\ufeff", "")
    lines = pieces.select(
        "file_path", F.struct("block", "line", F.col("piece.part").alias("part")).alias("at"),
        F.col("piece.lead").alias("lead"), value.alias("value"), "is_text")
    return lines.withColumns({"opens": ends_inside(F.col("value"), False), "stays": ends_inside(F.col("value"), True)})


def _composed(rows: DataFrame, window) -> DataFrame:
    """Adds ``fixed`` and ``turns``: what the functions (opens, stays) before a row make of a
    beginning. ``fixed`` is NULL where they only keep or turn it; else the beginning does not count."""
    turns = F.col("opens") & ~F.col("stays")
    rows = rows.withColumn("turned", F.sum(turns.cast("int")).over(window.rowsBetween(Window.unboundedPreceding, 0)) % 2)
    same = F.when(F.col("opens") == F.col("stays"), (F.col("opens").cast("int") + F.col("turned")) % 2)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("same", same).withColumns({
        "fixed": F.last("same", ignorenulls=True).over(before),
        "turns": F.coalesce(F.last("turned").over(before), F.lit(0))}).drop("same", "turned")


def _begins(start: Column) -> Column:
    return (F.coalesce("fixed", start) + F.col("turns")) % 2


def _walked(lines: DataFrame) -> DataFrame:
    """Lines with what the lines before them in their chunk make of either beginning of the chunk: whether a
    line ``begins0``, ``begins1`` within quotes, and the first line of its record, if the chunk has it."""
    rows = lines.select("file_path", "at.*", "lead", "value", "is_text", "opens", "stays").withColumn(
        "chunk", F.shiftright("line", CHUNK_BITS))
    in_chunk = Window.partitionBy("file_path", "block", "chunk").orderBy("line", "part")
    walked = _composed(rows, in_chunk).withColumns({f"begins{start}": _begins(F.lit(start)) for start in (0, 1)})
    at = F.struct("block", "line", "part")
    upto = in_chunk.rowsBetween(Window.unboundedPreceding, 0)
    return walked.drop("fixed", "turns").withColumns({
        f"record{start}": F.last(F.when(F.col(f"begins{start}") == 0, at), ignorenulls=True).over(upto)
        for start in (0, 1)})


def _chunks(walked: DataFrame) -> DataFrame:
    """``file_path, block, chunk, start, ends, carried``: whether a chunk begins and ends within quotes, and the
    first line of the record that it begins in."""
    at = F.struct("line", "part")
    # A chunk as a function: its last line's, behind all before it.
    after = [F.max_by(F.when(F.col(f"begins{start}") == 1, F.col("stays")).otherwise(F.col("opens")), at).alias(name)
             for start, name in ((0, "opens"), (1, "stays"))]
    last = [F.max(f"record{start}").alias(f"last{start}") for start in (0, 1)]
    path = Window.partitionBy("file_path").orderBy("block", "chunk")
    chunks = _composed(walked.groupBy("file_path", "block", "chunk").agg(*after, *last), path)
    chunks = chunks.withColumn("start", _begins(F.lit(0)))
    newest = F.when(F.col("start") == 1, F.col("last1")).otherwise(F.col("last0"))
    ends = F.when(F.col("start") == 1, F.col("stays")).otherwise(F.col("opens"))
    return chunks.select(
        "file_path", "block", "chunk", "start", ends.alias("ends"),
        F.last(newest, ignorenulls=True).over(path.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))


def _joined_records(walked: DataFrame, chunks: DataFrame) -> DataFrame:
    """Records of files whose lines may belong together."""
    of_start = {
        name: F.when(F.col("start") == 1, F.col(f"{name}1")).otherwise(F.col(f"{name}0")) for name in ("begins", "record")}
    at = F.struct("block", "line", "part")
    placed = walked.join(chunks.drop("ends"), ["file_path", "block", "chunk"]).withColumns({"at": at, **of_start})
    ends = F.when(F.col("begins") == 1, F.col("stays")).otherwise(F.col("opens"))
    placed = placed.withColumn("ends", ends).withColumn("record", F.coalesce("record", "carried", "at"))
    alone = (F.col("begins") == 0) & ~F.col("ends")
    single = placed.where(alone).select("file_path", "at", F.col("value").alias("text"), "is_text")
    parts = F.sort_array(F.collect_list(F.struct("at", "lead", "value")))
    several = placed.where(~alone).groupBy("file_path", "record").agg(
        parts.alias("parts"), F.bool_and("is_text").alias("is_text"))
    text = F.array_join(F.transform("parts", lambda p, i: F.when(i == 0, p["value"]).otherwise(
        F.concat(p["lead"], p["value"]))), "")
    several = several.select("file_path", F.col("record").alias("at"), text.alias("text"), "is_text")
    return single.unionByName(several)


def cut_records(spark: SparkSession, small: list[str], bulk: list[str], work: str) -> str:
    """Cuts files into records below ``work`` and returns it. ``small`` files are read whole."""
    if small:
        write_work_table(_small_records(spark, small), f"{work}/records")
    if not bulk:
        return work
    lines = write_work_table(_lines(spark, bulk), f"{work}/lines")
    opening = write_work_table(lines.where("opens").select("file_path").distinct(), f"{work}/opening")
    if not opening.isEmpty():
        walked = write_work_table(_walked(lines.join(opening, "file_path", "left_semi")), f"{work}/walked")
        chunks = write_work_table(_chunks(walked), f"{work}/chunks")
        write_work_table(_joined_records(walked, chunks), f"{work}/joined")
        write_work_table(chunks.groupBy("file_path").agg(
            F.max_by("ends", F.struct("block", "chunk")).alias("is_open")), f"{work}/ends")
        delete(spark, f"{work}/walked")
    return work


def read_records(spark: SparkSession, work: str) -> DataFrame:
    """``file_path, at, text, is_text`` of all records, empty lines included."""
    tables = []
    if is_complete(spark, f"{work}/records"):
        tables.append(spark.read.parquet(f"{work}/records").drop("is_open"))
    if is_complete(spark, f"{work}/lines"):
        lines = spark.read.parquet(f"{work}/lines")
        if is_complete(spark, f"{work}/joined"):
            lines = lines.join(spark.read.parquet(f"{work}/opening"), "file_path", "left_anti")
            tables.append(spark.read.parquet(f"{work}/joined"))
        tables.append(lines.select("file_path", "at", F.col("value").alias("text"), "is_text"))
    records = reduce(DataFrame.unionByName, tables)
    cut = F.when(F.endswith("text", F.lit("\r")), F.left("text", F.length("text") - 1)).otherwise(F.col("text"))
    return records.withColumn("text", cut)


def record_heads(spark: SparkSession, work: str) -> DataFrame:
    """``file_path, header_line, header_at, is_text, is_open`` of all files; header is the first record
    that is not empty, and open a file that ends within quotes."""
    records = read_records(spark, work)
    filled = F.col("text") != ""
    # Numbers only, which need no sort; the text of the one record is looked up after.
    blocks = records.groupBy("file_path", F.col("at.block").alias("block")).agg(
        F.min(F.when(filled, F.col("at.line"))).alias("line"), F.bool_and("is_text").alias("is_text"))
    files = blocks.groupBy("file_path").agg(
        F.min(F.when(F.col("line").isNotNull(), F.struct("block", "line"))).alias("first"),
        F.bool_and("is_text").alias("is_text"))
    place = F.struct(F.col("at.block").alias("block"), F.col("at.line").alias("line"))
    first = files.where("first is not null").select("file_path", "first")
    found = records.where(filled).select("file_path", "at", "text", place.alias("first")).join(
        F.broadcast(first), ["file_path", "first"])
    texts = found.groupBy("file_path").agg(F.min_by("text", "at").alias("header_line"), F.min("at").alias("header_at"))
    heads = files.join(texts, "file_path", "left").select("file_path", "header_line", "header_at", "is_text")
    heads = heads.withColumn("whole", F.lit(False))
    ends = [spark.read.parquet(f"{work}/{table}").select("file_path", "is_open")
            for table in ("records", "ends") if is_complete(spark, f"{work}/{table}")]
    if not ends:
        return heads.withColumn("is_open", F.lit(False))
    open_files = reduce(DataFrame.unionByName, ends).where("is_open").distinct()
    return heads.join(open_files, "file_path", "left").withColumn("is_open", F.coalesce("is_open", F.lit(False)))
