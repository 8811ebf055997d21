"""Versions of a stored thing, published by one small file.

The parts of a version are written under a folder of its own; a marker file that
names the folder makes it current.  A marker is created whole or not at all and is
numbered, and the highest number counts, so a reader sees the old version or the
new one, never a mixture: a writer that dies between its writes leaves a folder
that nobody reads.  Two writers cannot take one number.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: Folders that begin with an underscore are not read as data.
VERSIONS, MARKERS = "_versions", "_published"


def _fs(spark: SparkSession, path: str):
    j = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return j.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if there is no such folder."""
    fs, at = _fs(spark, path), _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def begin(spark: SparkSession, path: str) -> str:
    """A fresh folder for the parts of a version."""
    return f"{path}/{VERSIONS}/{uuid.uuid4().hex[:16]}"


def _markers(spark: SparkSession, path: str) -> list[str]:
    return [m for m in files(spark, f"{path}/{MARKERS}") if m[:12].isdigit() and "-" in m]


def publish(spark: SparkSession, path: str, folder: str) -> None:
    """Make a written folder the current version.

    A number is taken by creating the empty file of that name, which one writer only can; such claims stay,
    so a number is never given twice, and the claim of a writer that died names no version.
    """
    fs, name = _fs(spark, path), folder.rstrip("/").rpartition("/")[2]
    while True:
        taken = [int(f[:12]) for f in files(spark, f"{path}/{MARKERS}") if f[:12].isdigit()]
        number = f"{path}/{MARKERS}/{max(taken, default=0) + 1:012d}"
        if fs.createNewFile(_path(spark, number)):
            fs.create(_path(spark, f"{number}-{name}"), False).close()
            return


def current(spark: SparkSession, path: str) -> str | None:
    """Folder of the current version."""
    markers = _markers(spark, path)
    return f"{path}/{VERSIONS}/{markers[-1][13:]}" if markers else None


def history(spark: SparkSession, path: str) -> list[str]:
    """Folders of all published versions, oldest first."""
    return [f"{path}/{VERSIONS}/{m[13:]}" for m in _markers(spark, path)]


def expire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all but the last ``keep`` published versions; readers of a removed one fail.  Returns how many went."""
    markers = _markers(spark, path)
    old = markers[:-keep] if keep else markers
    for m in old:
        remove(spark, f"{path}/{VERSIONS}/{m[13:]}")
        remove(spark, f"{path}/{MARKERS}/{m}")
        remove(spark, f"{path}/{MARKERS}/{m[:12]}")
    return len(old)
