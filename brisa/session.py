"""Session construction and shared-folder helpers.

On a cluster the checkpoint folder comes from ``spark.checkpoint.dir``
(a shared file system).  Only on a local master, where one machine runs
everything, a fresh temporary folder stands in for it when it is unset.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_scope: list[str] = []


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "brisa", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time and AQE on.

    Master and shuffle partitions are left to spark-submit's settings unless given.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder, setting it if absent.

    The cluster's ``spark.checkpoint.dir`` wins.  Without it a temporary folder is used on a local
    master (``local``, ``local[n]``); on any other it raises, since executors would not see that folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    target = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not target:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        target = tempfile.mkdtemp(prefix="brisa-ckpt-")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for written tables."""
    root = checkpoint_dir(spark).rstrip("/")
    inner = "/".join(["brisa-scratch", *_scope])
    return f"{root}/{inner}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Remove the written scratch tables of the calls inside, at the end.

    Results that read them must be consumed (collected or written elsewhere) inside.
    """
    _scope.append(f"scope-{uuid.uuid4().hex[:12]}")
    path = "/".join([checkpoint_dir(spark).rstrip("/"), "brisa-scratch", *_scope])
    try:
        yield path
    finally:
        _scope.pop()
        jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def cut_lineage(df):
    """``df`` written to the shared scratch folder and read back.

    The plan runs once, in one job; later reads use the files, with the reader's pruning and
    pushed filters, and a lost executor costs nothing but reading them again.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
