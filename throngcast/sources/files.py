"""Folders of a shared file system, seen through Hadoop's interface: names only, never data."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _of(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _of(spark, path)
    return system.exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none where it does not exist."""
    system, target = _of(spark, path)
    return [s.getPath().getName() for s in system.listStatus(target)] if system.exists(target) else []


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below a folder that readers see."""
    return [n for n in folder_names(spark, path) if not n.startswith(("_", "."))]


def complete_numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers N of the folders ``name=N`` whose write has succeeded, in order."""
    found = sorted(int(n.split("=", 1)[1]) for n in folder_names(spark, path) if n.startswith(f"{name}="))
    return [n for n in found if exists(spark, f"{path}/{name}={n}/_SUCCESS")]


def delete_folder(spark: SparkSession, path: str) -> None:
    system, target = _of(spark, path)
    system.delete(target, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a place that is free; its parent is made."""
    system, old = _of(spark, source)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"{source} could not be renamed to {target}")


def create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false where it exists. Of several callers one gets true."""
    system, target = _of(spark, path)
    return bool(system.createNewFile(target))


def total_bytes(spark: SparkSession, path: str) -> int:
    system, target = _of(spark, path)
    return system.getContentSummary(target).getLength() if system.exists(target) else 0
