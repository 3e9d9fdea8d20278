"""Small Hadoop FileSystem helpers (work on local, HDFS and object stores alike)."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import SparkSession


def source_key(source: str) -> str:
    """A source's name as a folder name: other characters than letters, digits, ``_ . -`` are
    replaced, and a short hash of the name keeps such names apart."""
    plain = re.sub(r"[^A-Za-z0-9_.-]", "_", source)
    if plain == source and source:
        return source
    return f"{plain}-{hashlib.md5(source.encode()).hexdigest()[:8]}"


def batch_folder(path: str, source: str, batch_id: int) -> str:
    """Where a batch of a source writes its own rows (quarantine, delivery, metrics)."""
    return f"{path}/source={source_key(source)}/batch_id={int(batch_id)}"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)]


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file (overwriting), the commit point of a version."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file (driver side)."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file; it appears under its name only when it is complete."""
    fs, p = _fs(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}.tmp")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(part, p):
        raise OSError(f"cannot write {path}")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
