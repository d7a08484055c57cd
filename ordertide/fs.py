"""Small file-system helpers over the Hadoop FileSystem API of the session.

Used only for metadata-sized work (markers, existence checks, listing a
handful of directories); data always moves through Spark readers/writers, so
the same code works on local disk, HDFS or an object store.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hpath, hpath.getFileSystem(conf)


def exists(spark: SparkSession, path: str) -> bool:
    hpath, fs = _path(spark, path)
    return bool(fs.exists(hpath))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file (overwrites)."""
    hpath, fs = _path(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    hpath, fs = _path(spark, path)
    if not fs.exists(hpath):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(hpath)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path`` (empty if it does not exist)."""
    hpath, fs = _path(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(hpath))


def fingerprint(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int, int]]:
    """``(path, files, bytes, latest modification time)`` per path, over all
    files below it, so a file changed inside a partition folder shows."""
    out = []
    for p in paths:
        hpath, fs = _path(spark, p)
        if not fs.exists(hpath):
            out.append((p, -1, -1, -1))
            continue
        files = size = mtime = 0
        listed = fs.listFiles(hpath, True)
        while listed.hasNext():
            entry = listed.next()
            files += 1
            size += int(entry.getLen())
            mtime = max(mtime, int(entry.getModificationTime()))
        out.append((p, files, size, mtime))
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's own scratch files."""
    hpath, fs = _path(spark, path)
    fs.delete(hpath, True)
