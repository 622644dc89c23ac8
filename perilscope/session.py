"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "perilscope") -> SparkSession:
    """Session for tests and the bench (local mode; a cluster brings its own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared work folder, as named by ``spark.checkpoint.dir``.

    Only when a local session names none (tests, a bare local run) do we pick
    one, and then only through ``setCheckpointDir`` (the conf itself is read-only
    at run time).  On a cluster a missing setting is an error: executors could
    not share a folder of the driver's machine.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="perilscope-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


_SCOPE: ContextVar[list[str] | None] = ContextVar("perilscope_scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, for staged tables written by a job."""
    base = shared_dir(spark)
    path = os.path.join(base, "perilscope", f"{name}-{uuid.uuid4().hex[:12]}")
    if _SCOPE.get() is not None:
        _SCOPE.get().append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Stages stored inside are removed at the end, also after a failure.

    For code that has written its results by then: a frame that still reads a stage cannot be used
    behind the scope.  Stages of other threads and of enclosing code are left alone.
    """
    mine: list[str] = []
    token = _SCOPE.set(mine)
    try:
        yield mine
    finally:
        _SCOPE.reset(token)
        for path in mine:
            fs, p = file_system(spark, path)
            fs.delete(p, True)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path in it: any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def spread(df, *keys: str):
    """Deal ``df`` evenly over the shuffle partitions, or by ``keys``.

    Used right before a high-expansion step (tile/day explode, ray casts) on its
    narrow side, whatever the input's size: an input read as one split is then not
    expanded by a single task.  Plans only; no job runs here.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def materialize(df, name: str = "stage"):
    """Cut the lineage of a frame that is read more than once: write it as a
    parquet table in the shared folder named by ``spark.checkpoint.dir`` and read
    it back.  One computation (an eager ``checkpoint()`` would compute it twice),
    columnar re-reads, and a lost executor never re-runs the upstream plan."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make ``perilscope`` importable on the executors' Python workers.

    The Arrow UDFs (clip kernel, tile classes, top-k blocks, IVF probe) are
    functions of this package; a zip of it is added once per SparkContext with
    ``addPyFile`` (Spark distributes it to every executor).
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_perilscope_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="perilscope-pkg-"), "perilscope.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._perilscope_shipped = True
