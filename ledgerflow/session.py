"""Session and shared-storage helpers.

Scratch output (landing fixtures, stream checkpoints, tables written by the
registered queries) lives under the session's checkpoint directory, which on a
cluster names shared storage. Only when it is unset (tests, local runs) do we
pick a local folder ourselves.
"""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _cores(cpus) -> int:
    import os

    return (os.cpu_count() or 8) if str(cpus) == "*" else int(cpus)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerflow") -> SparkSession:
    """Local session for tests, bench and the examples."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.schemaInference", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # one listing task per few hundred files, not one per file
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(max(8, 4 * _cores(cpus))))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict):
    """Session settings for the time of a block, put back after it."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set one only if it is unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A folder under the shared checkpoint root: ``<root>/ledgerflow/<name>[-<uuid>]``."""
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{checkpoint_root(spark).rstrip('/')}/ledgerflow/{leaf}"


#: a finished write's shuffle files go at once, not when the driver's garbage collector finds them
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Fs:
    """Thin access to the Hadoop FileSystem of a path (metadata operations only)."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def _fs(self, p: str):
        return self._path(p).getFileSystem(self._conf)

    def exists(self, p: str) -> bool:
        return bool(self._fs(p).exists(self._path(p)))

    def mkdirs(self, p: str) -> None:
        self._fs(p).mkdirs(self._path(p))

    def delete(self, p: str, recursive: bool = True) -> None:
        self._fs(p).delete(self._path(p), recursive)

    def backdate(self, p: str, days: int) -> None:
        """Set the modification time of the files in ``p`` back (fixtures of late files)."""
        fs = self._fs(p)
        with ThreadPoolExecutor(8) as pool:  # a call waits for the store, and a folder may hold very many files
            for _ in pool.map(lambda s: fs.setTimes(s.getPath(), s.getModificationTime() - days * 86_400_000, -1), fs.listStatus(self._path(p))):
                pass

    def stamps(self, p: str) -> list[tuple[str, int, int]]:
        """(name, modification time, length) of a file or of the direct children of a folder."""
        return sorted((s.getPath().getName(), int(s.getModificationTime()), int(s.getLen())) for s in self._fs(p).listStatus(self._path(p)))

    def rename(self, src: str, dst: str) -> bool:
        return bool(self._fs(src).rename(self._path(src), self._path(dst)))

    def ls(self, p: str) -> list[str]:
        """Names of the direct children of ``p`` (empty if ``p`` does not exist)."""
        if not self.exists(p):
            return []
        return sorted(s.getPath().getName() for s in self._fs(p).listStatus(self._path(p)))

    def write_text(self, p: str, text: str, overwrite: bool = False) -> bool:
        """Create a small file by rename, so a reader sees it whole or not at all; with
        ``overwrite=False`` returns False if it already exists."""
        fs = self._fs(p)
        path = self._path(p)
        if not overwrite and fs.exists(path):
            return False
        folder, _, name = p.rpartition("/")
        part = f"{folder}/.{name}.{uuid.uuid4().hex}"
        fs.mkdirs(self._path(folder))
        out = fs.create(self._path(part), True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        if overwrite and fs.exists(path):
            fs.delete(path, False)
        if not self.rename(part, p):
            fs.delete(self._path(part), False)
            return False
        return True

    def read_text(self, p: str) -> str:
        fs = self._fs(p)
        stream = fs.open(self._path(p))
        try:
            reader = self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()

    def size(self, p: str) -> int:
        """Total bytes under ``p`` (0 if absent)."""
        if not self.exists(p):
            return 0
        return int(self._fs(p).getContentSummary(self._path(p)).getLength())
