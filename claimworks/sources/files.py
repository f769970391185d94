"""Hadoop file-system look-ups: any scheme the session can read."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def is_committed(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_SUCCESS")


def numbered_folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """N of every ``<prefix>N`` folder, ascending; finished or not. Names only."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory()]
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder, ascending; none where there is no folder."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isFile())


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename within one file system; an attempt that was repeated finds it done."""
    fs, hadoop_path = _fs(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    if not fs.rename(hadoop_path, to) and not fs.exists(to):
        raise OSError(f"cannot move {source} to {target}")


def publish_folder(spark: SparkSession, source: str, target: str) -> None:
    """A finished folder to its place by one rename, so that readers see all of its files or none.

    What an attempt that broke off has left at the target goes first. Stores that
    rename by copying show the files one by one, but whole ones.
    """
    fs, hadoop_path = _fs(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if fs.exists(to):
        fs.delete(to, True)
    if not fs.rename(hadoop_path, to):
        raise OSError(f"cannot move {source} to {target}")


def remove_file(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, False)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.mkdirs(hadoop_path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None where there is none."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file at once, whole; False, and no change, where there is one already."""
    fs, hadoop_path = _fs(spark, path)
    if fs.exists(hadoop_path):
        return False
    part = spark._jvm.org.apache.hadoop.fs.Path(hadoop_path.getParent(), f".{hadoop_path.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(part, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    return fs.rename(part, hadoop_path)


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    if fmt == "delta":
        return path_exists(spark, f"{path}/_delta_log")
    return is_committed(spark, path)
