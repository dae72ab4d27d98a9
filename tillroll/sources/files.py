"""Small file-system helpers over the Hadoop FileSystem of the session.

Used only for existence checks, for removing partition folders that a merge
emptied and for the times of staged files; all data movement goes through
DataFrame readers/writers.
"""
from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    fs, p = _fs(spark, path)
    if not fs.rename(p, _fs(spark, to)[1]):
        raise OSError(f"cannot rename {path} to {to}")


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """The folders of a table, without those that Spark's readers skip."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return [n for n in names if not n.startswith(("_", "."))]


def order_files(spark: SparkSession, path: str, per_folder: int) -> None:
    """Give every folder of ``path`` ``per_folder`` files (empty ones where it
    has fewer) and modification times that follow the folders' names, one
    second apart.  Touches names and times only, a call a file."""
    fs, p = _fs(spark, path)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    shown = lambda folder: [s.getPath() for s in fs.listStatus(folder) if not s.getPath().getName().startswith(("_", "."))]
    folders = sorted(shown(p), key=lambda f: f.getName())
    for number, folder in enumerate(folders):
        files = shown(folder)
        if len(files) > per_folder:
            raise ValueError(f"{folder.toString()} has {len(files)} files, not {per_folder}")
        for i in range(per_folder - len(files)):
            empty = path_of(folder, f"empty-{i}.txt")
            fs.create(empty).close()
            files.append(empty)
        for f in files:
            fs.setTimes(f, 1_000_000_000_000 + 1000 * number, -1)
