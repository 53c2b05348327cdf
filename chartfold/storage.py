"""Small file system questions, asked through the Hadoop file system Spark itself uses."""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority and without `..`, as file listings name it."""
    hadoop_path, fs = _path(spark, path)
    return fs.makeQualified(hadoop_path).toString().rstrip("/")


def is_hidden(below: str) -> bool:
    """Whether a path below a folder has a name that begins with `_` or `.`."""
    return re.search(r"/[._]", below) is not None


def listed(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, modification time in ms) of a file, or of all files below a folder.

    Empty files are listed too, which Spark's readers leave out; names that begin with `_`
    or `.` are not. A path that does not exist has no files.
    """
    hadoop_path, fs = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    top = fs.makeQualified(hadoop_path).toString().rstrip("/")
    found, files = [], fs.listFiles(hadoop_path, True)
    while files.hasNext():
        status = files.next()
        name = status.getPath().toString()
        if not is_hidden(name[len(top):]):
            found.append((name, status.getLen(), status.getModificationTime()))
    return sorted(found)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, for folders that hold one entry per batch."""
    hadoop_path, fs = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def delete(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _path(spark, path)
    fs.delete(hadoop_path, True)


def literal_path(path: str) -> str:
    """The path with characters escaped that Spark would take for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def complete(spark: SparkSession, path: str) -> None:
    """Marks a folder as written to its end. Not every committer of Spark leaves such a mark."""
    hadoop_path, fs = _path(spark, f"{path}/_COMPLETE")
    fs.mkdirs(hadoop_path.getParent())
    fs.create(hadoop_path, True).close()


def is_complete(spark: SparkSession, path: str) -> bool:
    """True once the folder was marked; overwriting it takes the mark away first."""
    return exists(spark, f"{path}/_COMPLETE")


def claim(spark: SparkSession, path: str, name: str) -> str:
    """Creates a file that holds a name, unless there is one; returns the name it holds."""
    hadoop_path, fs = _path(spark, path)
    try:
        out = fs.create(hadoop_path, False)
    except Py4JJavaError:
        held = fs.open(hadoop_path)
        try:
            return spark._jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8")
        finally:
            held.close()
    out.write(bytearray(name.encode()))
    out.close()
    return name


def _moved(spark: SparkSession, source: str, target: str) -> None:
    """Moves a finished file. A lost driver may have left both: then the target is whole."""
    hadoop_source, fs = _path(spark, source)
    hadoop_target, _ = _path(spark, target)
    fs.mkdirs(hadoop_target.getParent())
    if fs.exists(hadoop_target):
        fs.delete(hadoop_source, False)
    elif not fs.rename(hadoop_source, hadoop_target):
        raise OSError(f"{source} could not be moved to {target}")


def write_once(
    spark: SparkSession, path: str, write: Callable[[str], None], on_step: Callable[[str], None] = lambda step: None
) -> str:
    """A folder whose files appear one by one, each finished, and never change or go.

    ``write`` fills a folder beside it that no reader lists, as often as it takes. Once that is
    marked as finished it is not written again, so that its file names stand, and its files
    are moved, those that a lost driver had not moved yet. Whoever reads the folder meanwhile, as
    a stream does, meets each file once. ``on_step`` hears of every step that is behind.
    """
    parent, _, name = path.rpartition("/")
    staged = f"{parent}/_staged/{name}"
    if not is_complete(spark, path):
        if not is_complete(spark, staged):
            write(staged)
            on_step(f"{path} written")
            complete(spark, staged)
            on_step(f"{path} staged")
        top = qualified(spark, staged)
        moves = [(file, f"{path}{file[len(top):]}") for file, _, _ in listed(spark, staged)]
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda move: _moved(spark, *move), moves))
        on_step(f"{path} moved")
        complete(spark, path)
        on_step(f"{path} complete")
    delete(spark, staged)
    return path


def write_work_table(df: DataFrame, path: str) -> DataFrame:
    """Write and read back: cuts the lineage and gives the planner true sizes.

    A repeated batch writes the same rows, so overwriting is safe.
    """
    df.write.mode("overwrite").parquet(path)
    complete(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
