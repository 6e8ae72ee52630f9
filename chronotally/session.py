"""Session settings and the folders a run may write to."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the results depend on, or that a whole-table run needs.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_local_scratch: str | None = None


def build_session(app: str = "chronotally", **extra: str) -> SparkSession:
    """A session with the defaults above. Master and memory are left to the submitter."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Calendar parts and printed windows depend on the session zone, so fix it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def adaptive_on(spark: SparkSession) -> bool:
    """Whether Spark may split an oversized shuffle partition while the job runs."""
    return all(
        spark.conf.get(key, "true").lower() == "true"
        for key in (
            "spark.sql.adaptive.enabled",
            "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled",
        )
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only ``local`` and ``local[...]``, where driver and executors are one process, may fall back to
    a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(
            "spark.checkpoint.dir is not set: name a folder that all executors share"
        )
    global _local_scratch
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="chronotally-")
    return _local_scratch


def run_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared one. The caller owns what is written there."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """The file system a path names, and the path as that system takes it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = _file_system(spark, path)
    return system.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, without looking into any of them."""
    system, hadoop_path = _file_system(spark, path)
    return [status.getPath().getName() for status in system.listStatus(hadoop_path)]


def make_folder(spark: SparkSession, path: str) -> None:
    system, hadoop_path = _file_system(spark, path)
    system.mkdirs(hadoop_path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, seen by readers of its folder once it is whole."""
    system, to = _file_system(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(to.getParent(), f"_{to.getName()}")
    out = system.create(hidden, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if not system.rename(hidden, to):
        raise OSError(f"could not write {path}")


def remove_folder(spark: SparkSession, path: str) -> None:
    system, hadoop_path = _file_system(spark, path)
    system.delete(hadoop_path, True)


def moved(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder; False if the target is there. One step on file systems that have it."""
    system, to = _file_system(spark, target)
    if system.exists(to):
        return False
    system.mkdirs(to.getParent())
    if not system.rename(spark._jvm.org.apache.hadoop.fs.Path(source), to):
        raise OSError(f"could not rename {source} to {target}")
    return True


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the length of a block. The session is shared: what other threads plan
    meanwhile sees them too."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
