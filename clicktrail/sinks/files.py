"""File system steps on the storage Spark itself writes to.

Metadata operations only: file contents are moved by renames and written by
Spark tasks, never through the driver.
"""

from __future__ import annotations

import csv
import uuid

from py4j.java_gateway import is_instance_of
from pyspark.sql import DataFrame, SparkSession


HEADER_BYTES = 1 << 20


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _plain(spark: SparkSession, fs):
    """On local disks the file system without checksum files: a rename cannot take a file and its checksum along in one step."""
    local = is_instance_of(spark.sparkContext._gateway, fs, "org.apache.hadoop.fs.ChecksumFileSystem")
    return fs.getRawFileSystem() if local else fs


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def facts(spark: SparkSession, path: str) -> tuple[int, int]:
    """Length and time of change of a file; a rename keeps both."""
    fs, p = _fs(spark, path)
    status = fs.getFileStatus(p)
    return status.getLen(), status.getModificationTime()


def children(spark: SparkSession, folder: str) -> list[str]:
    """Paths of what is directly in a folder; none if there is no folder."""
    fs, p = _fs(spark, folder)
    return sorted(f"{folder.rstrip('/')}/{s.getPath().getName()}" for s in fs.listStatus(p)) if fs.exists(p) else []


def head(spark: SparkSession, path: str, size: int) -> bytes:
    """The first bytes of a file, no more than ``size``."""
    fs, p = _fs(spark, path)
    io = spark._jvm.org.apache.commons.io
    stream = _plain(spark, fs).open(p)
    try:
        return bytes(io.IOUtils.toByteArray(io.input.BoundedInputStream(stream, size)))
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str:
    """The header of a text file, malformed bytes replaced; reads HEADER_BYTES at most."""
    raw = head(spark, path, HEADER_BYTES)
    end = "\n".encode(encoding) if encoding.upper() not in ("UTF-16", "UTF-32") else None
    if end is None:
        text = raw.decode(encoding, errors="replace")
        line, found = text.split("\n", 1)[0], "\n" in text
    else:
        at = raw.find(end)
        while at > 0 and at % len(end):  # within a character of several bytes
            at = raw.find(end, at + 1)
        line, found = (raw if at < 0 else raw[:at]).decode(encoding, errors="replace"), at >= 0
    if not found and len(raw) == HEADER_BYTES:
        raise ValueError(f"{path} has no line end in its first {HEADER_BYTES} bytes")
    return line.rstrip("\r").removeprefix("\ufeff")


def header_names(spark: SparkSession, path: str, delimiter: str, encoding: str = "UTF-8") -> tuple[str, ...]:
    """Column names of a delimited file; a quoted name may hold the delimiter and doubled quotes, as in its rows."""
    line = first_line(spark, path, encoding)
    return tuple(next(csv.reader([line], delimiter=delimiter, doublequote=True), ())) or ("",)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file that this package wrote."""
    return head(spark, path, HEADER_BYTES).decode()


def part_files(spark: SparkSession, folder: str, prefix: str = "part-") -> list[str]:
    fs, p = _fs(spark, folder)
    names = [s.getPath().toString() for s in fs.listStatus(p)]
    return sorted(n for n in names if n.rsplit("/", 1)[-1].startswith(prefix))


def _rename(spark: SparkSession, source: str, target: str, overwrite: bool) -> None:
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _fs(spark, target)[0].getUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, int(overwrite))
    if overwrite:
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target), options)


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """One rename that takes the place of an existing file; readers see the old or the new one."""
    _rename(spark, source, target, overwrite=True)


def move_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename to a name that is free; fails if it is not."""
    fs, dst = _fs(spark, target)
    fs.mkdirs(dst.getParent())
    _rename(spark, source, target, overwrite=False)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that takes the place of the one before in one step."""
    folder, name = path.rsplit("/", 1)
    staging = f"{folder}/_{name}-{uuid.uuid4().hex}"
    write_text(spark, staging, text)
    fs, p = _fs(spark, staging)
    if (plain := _plain(spark, fs)) is fs:
        _replace(spark, staging, path)
    elif not plain.rename(p, _fs(spark, path)[1]):  # on a local disk this replaces
        raise OSError(f"could not replace {path}")


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename, replacing the target; safe to repeat after a failure part-way.

    A file replaces a file in one step.  A folder cannot: the old one is set
    aside, and put back if the new one cannot take its place.
    """
    fs, src = _fs(spark, source)
    _, dst = _fs(spark, target)
    if not fs.exists(src):
        if fs.exists(dst):
            return
        raise FileNotFoundError(source)
    fs.mkdirs(dst.getParent())
    if not fs.exists(dst) or (fs.getFileStatus(src).isFile() and fs.getFileStatus(dst).isFile()):
        _replace(spark, source, target)
        return
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{target}_old")
    fs.delete(aside, True)
    if not fs.rename(dst, aside):
        raise OSError(f"could not set aside {target}")
    if not fs.rename(src, dst):
        fs.rename(aside, dst)
        raise OSError(f"could not rename {source} to {target}")
    fs.delete(aside, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, such as the reason beside a file that was set aside."""
    fs, p = _fs(spark, path)
    out = _plain(spark, fs).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def has_data(spark: SparkSession, path: str, encoding: str = "UTF-8") -> bool:
    """Whether a text file has anything after its first line."""
    fs, p = _fs(spark, path)
    io = spark._jvm.java.io
    lines = io.BufferedReader(io.InputStreamReader(fs.open(p), encoding))
    try:
        lines.readLine()
        while (line := lines.readLine()) is not None:
            if line.strip():
                return True
        return False
    finally:
        lines.close()


def publish_one_file(df: DataFrame, target: str, order: list, **options) -> None:
    """Write a small table as a single sorted, delimited file that appears all at once.

    The caller has checked that the table is small enough for one task.
    """
    spark = df.sparkSession
    staging = f"{target}_tmp"
    one = df.repartition(1).sortWithinPartitions(*order) if order else df.coalesce(1)
    one.write.mode("overwrite").options(header=True, emptyValue="", **options).csv(staging)
    parts = part_files(spark, staging)
    if len(parts) != 1:
        raise OSError(f"expected one part file in {staging}, found {len(parts)}")
    move(spark, parts[0], target)
    delete(spark, staging)


def publish_parts(df: DataFrame, target: str, order: list, **options) -> None:
    """Write a large table as a folder of globally sorted parts.

    Each version is a folder of its own below ``target``, and a manifest that is replaced in one step names the one that
    counts, so a reader who follows it (:func:`current`) always finds one whole version.  The version before stays for
    those who are still reading it.
    """
    spark = df.sparkSession
    fs, p = _fs(spark, target)
    if fs.exists(p) and fs.getFileStatus(p).isFile():
        fs.delete(p, False)  # a report of the other layout
    before = current(spark, target)
    version = f"{target}/version={uuid.uuid4().hex}"
    (df.orderBy(*order) if order else df).write.options(header=True, emptyValue="", **options).csv(version)
    replace_text(spark, f"{target}/_CURRENT", version.rsplit("/", 1)[-1])
    for path in children(spark, target):
        if "/version=" in path and path not in (version, before):
            delete(spark, path)


def current(spark: SparkSession, target: str) -> str | None:
    """The folder of the version that counts; None if none was published."""
    manifest = f"{target}/_CURRENT"
    return f"{target}/{read_text(spark, manifest)}" if exists(spark, manifest) else None
