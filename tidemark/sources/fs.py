"""Small file-system helpers over the Hadoop FileSystem API (works for local
paths, HDFS and object stores alike).  Used for pointer and commit files only;
all data goes through DataFrame readers and writers."""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import SparkSession


_RENAME = threading.Lock()


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
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


def write_text_atomic(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file at a path that must not exist yet: write a hidden
    temp file next to it, then rename.  Readers see the whole file or none.
    Never replaces an existing file (commit markers are create-only)."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    with _RENAME:           # a local rename would replace a marker that another thread just wrote
        done = not fs.exists(p) and fs.rename(tmp, p)
    if not done:
        fs.delete(tmp, False)
        raise FileExistsError(f"commit marker already present: {path}")


def touch(spark: SparkSession, path: str) -> None:
    """Create or replace an empty file, which sets its modification time."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def modified(spark: SparkSession, path: str) -> int | None:
    """Modification time in milliseconds by the store's clock; None if absent."""
    fs, p = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime()) if fs.exists(p) else None


def store_time(spark: SparkSession, folder: str) -> int:
    """The store's own time in milliseconds, so that ages do not depend on driver clocks."""
    probe = f"{folder}/.time.{uuid.uuid4().hex}"
    touch(spark, probe)
    now = modified(spark, probe)
    remove(spark, probe)
    return now


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder that the library wrote; absent is fine."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_json(spark: SparkSession, path: str) -> dict | None:
    text = read_text(spark, path)
    return None if text is None else json.loads(text)


def write_json_atomic(spark: SparkSession, path: str, obj: dict) -> None:
    write_text_atomic(spark, path, json.dumps(obj, sort_keys=True))
