"""Session helpers: building a local session for tests/bench and finding the
shared folder where jobs may write tables.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names; we
only invent one when it is unset (tests on a laptop).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_TABLE_ROOT = "tidemark"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """A local session configured the way the library expects (UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; unset, a temporary one in local mode, an error on a cluster."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the shared checkpoint dir for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, _TABLE_ROOT, *parts, uuid.uuid4().hex])


def pin_utc(spark: SparkSession) -> None:
    """Dates are rendered in the session zone; the API speaks UTC (trap T13)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the time of a write, then as they were. What the session runs beside it may see them too."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exists(spark: SparkSession, path: str) -> bool:
    """Does a path exist on the cluster file system (Hadoop FS, not os)?"""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def mkdirs(spark: SparkSession, path: str) -> None:
    """Create a folder (and parents) on the cluster file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hpath)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` on the cluster file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()]


def modified_ms(spark: SparkSession, path: str) -> int:
    """When a path was last changed, in milliseconds since 1970."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hpath).getModificationTime()


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in ``path`` on the cluster file system, none if there is no such folder."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return [s.getPath().getName() for s in fs.listStatus(hpath) if not s.isDirectory()]


def read_text(spark: SparkSession, path: str) -> str:
    """The text of one small file on the cluster file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    stream = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(hpath)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file if none of that name exists: of several writers one gets True.

    HDFS and object stores with conditional writes decide this by themselves; for the local file system,
    whose Hadoop client looks before it writes, the operating system does.
    """
    mkdirs(spark, path.rsplit("/", 1)[0])
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    data = text.encode()
    if fs.getUri().getScheme() == "file":
        try:
            with open(hpath.toUri().getPath(), "xb") as f:
                f.write(data)
        except FileExistsError:
            return False
        return True
    try:
        out = fs.create(hpath, False)
    except Py4JJavaError:
        if fs.exists(hpath):
            return False
        raise
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return True


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete a path on the cluster file system (Hadoop FS, not os)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


__all__ = [
    "local_session",
    "ensure_checkpoint_dir",
    "shared_dir",
    "pin_utc",
    "settings",
    "exists",
    "mkdirs",
    "list_dirs",
    "modified_ms",
    "list_files",
    "read_text",
    "create_new",
    "delete_path",
]
