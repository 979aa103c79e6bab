"""Files and folders of the shared store, through Hadoop's file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _opened(spark, path)
    return files.exists(at)


def written(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job has written this folder to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no folder."""
    files, at = _opened(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    files, at = _opened(spark, path)
    files.delete(at, True)


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a folder in one step; false if ``to`` exists already."""
    files, at = _opened(spark, path)
    target = _opened(spark, to)[1]
    if files.exists(target):
        return False
    files.mkdirs(target.getParent())
    return files.rename(at, target)


def write_line(spark: SparkSession, path: str, line: str) -> None:
    """One small file, written under another name and then renamed, so that readers see all of it or nothing."""
    files, at = _opened(spark, path)
    part = at.suffix(".part")
    out = files.create(part, True)
    out.write(bytearray(line.encode()))
    out.close()
    files.delete(at, False)
    files.rename(part, at)


def read_line(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first().value
