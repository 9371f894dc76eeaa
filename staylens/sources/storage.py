"""Directory listings through Hadoop, so that any lake location works."""

from __future__ import annotations

import hashlib
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, location: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, location: str) -> bool:
    fs, path = _path(spark, location)
    return fs.exists(path)


def children(spark: SparkSession, location: str) -> list[str]:
    """Names of the visible entries of a directory; empty when it is absent."""
    fs, path = _path(spark, location)
    if not fs.exists(path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches a pattern."""
    fs, path = _path(spark, pattern)
    return bool(fs.globStatus(path))


def directories(spark: SparkSession, pattern: str, root: str) -> list[str]:
    """Directories that match a pattern and hold Parquet files themselves, relative to ``root``."""
    fs, path = _path(spark, f"{pattern}/*.parquet")
    start = fs.makeQualified(_path(spark, root)[1]).toString().rstrip("/") + "/"
    return sorted({status.getPath().getParent().toString().removeprefix(start) for status in fs.globStatus(path) or []})


def partition_directories(spark: SparkSession, location: str) -> list[str]:
    """Every directory below ``location`` that holds Parquet files, relative to it."""
    fs, path = _path(spark, location)
    if not fs.exists(path):
        return []
    start = fs.makeQualified(path).toString().rstrip("/") + "/"
    found, files = set(), fs.listFiles(path, True)
    while files.hasNext():
        file = files.next().getPath()
        if file.getName().endswith(".parquet"):
            found.add(file.getParent().toString().removeprefix(start))
    return sorted(found)


def count_files(spark: SparkSession, locations: list[str]) -> int:
    """How many Parquet files some directories hold themselves."""
    total = 0
    for location in locations:
        total += sum(name.endswith(".parquet") for name in children(spark, location))
    return total


def fingerprint(spark: SparkSession, location: str) -> str:
    """A digest of the names, lengths and times of the Parquet files a directory holds itself."""
    fs, path = _path(spark, f"{location}/*.parquet")
    files = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.globStatus(path) or []]
    return hashlib.sha256(repr(sorted(files)).encode()).hexdigest()[:32]


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a directory to a place that must be free."""
    fs, path = _path(spark, target)
    fs.mkdirs(path.getParent())
    if not fs.rename(_path(spark, source)[1], path):
        raise OSError(f"could not move {source} to {target}")


def read_text(spark: SparkSession, location: str) -> str:
    fs, path = _path(spark, location)
    stream = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, location: str, text: str) -> bool:
    """Write a file that must not exist yet, all of it or nothing; False where it exists.

    The text goes to a file of its own that is then renamed without overwriting,
    which is atomic on HDFS and on local disks.
    """
    jvm = spark.sparkContext._jvm
    fs, path = _path(spark, location)
    if fs.exists(path):
        return False
    draft = jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(text.encode())
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, path, options)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        fs.delete(draft, False)
        return False


def delete(spark: SparkSession, location: str) -> None:
    fs, path = _path(spark, location)
    fs.delete(path, True)
