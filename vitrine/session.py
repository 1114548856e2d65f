"""Session helpers: a tuned local session and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("vitrine")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="vitrine-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


_written: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def scratch_mark() -> int:
    """How many folders this process has written; ``clear_scratch`` deletes those after a mark."""
    return len(_written)


def clear_scratch(spark: SparkSession, since: int = 0, kept: int = 0) -> int:
    """Delete what operators of this process left in the shared folder; returns the number of folders.

    Only folders written after the mark ``since``, and not the last ``kept`` of them.  Call it once the
    results are written: lazy results still read these folders.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    end = len(_written) - kept
    for written in _written[since:end]:
        path = hadoop.Path(written)
        gone += path.getFileSystem(configuration).delete(path, True)
    del _written[since:end]
    return gone
