"""Session helpers: mandatory job parameters, shared scratch space, lineage cuts."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_releasing: dict[int, tuple[int, str | None]] = {}
_lock = threading.Lock()


def require_ref(ref: str | None) -> str:
    """The load reference (``yyyy-MM`` or ``yyyyMMdd``) is mandatory; it names a partition."""
    if not ref or not ref.strip():
        raise ValueError("the load reference 'datrefcarga' is mandatory and was not given")
    if not re.fullmatch(r"[0-9-]+", ref.strip()):
        raise ValueError(f"not a load reference: {ref!r}")
    return ref.strip()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a folder on this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="ouvidoria-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder; never reused between calls."""
    return f"{shared_dir(spark)}/ouvidoria/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written in here go when it is written, not when the driver next collects its garbage.

    The session's setting is as it was when the last of several threads leaves.
    """
    key = id(spark)
    with _lock:
        depth, before = _releasing.get(key, (0, spark.conf.get(_RELEASE, None)))
        _releasing[key] = depth + 1, before
        spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        with _lock:
            depth, before = _releasing.pop(key)
            if depth > 1:
                _releasing[key] = depth - 1, before
            elif before is None:
                spark.conf.unset(_RELEASE)
            else:
                spark.conf.set(_RELEASE, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of executors and is computed once."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    with shuffles_released(df.sparkSession):
        # A frame of its own, which nothing runs again.
        return df.select("*").checkpoint(eager=True)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


class Files:
    """Small files and folders of any store that Spark reaches, by its own file systems.

    Used for listings and for the few bytes of a manifest; data are read and written by Spark jobs.
    """

    def __init__(self, spark: SparkSession):
        self._sc = spark.sparkContext

    def _open(self, path: str):
        p = self._sc._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._sc._jsc.hadoopConfiguration()), p

    def exists(self, path: str) -> bool:
        fs, p = self._open(path)
        return fs.exists(p)

    def qualified(self, path: str) -> str:
        """The one form of a path with its scheme, so that two of them can be compared."""
        fs, p = self._open(path)
        return fs.makeQualified(p).toString()

    def names(self, folder: str) -> list[str]:
        """Names in a folder, in order; none if there is no such folder."""
        fs, p = self._open(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def make(self, folder: str) -> None:
        fs, p = self._open(folder)
        fs.mkdirs(p)

    def move(self, source: str, target: str) -> None:
        """Rename; a file that is there is replaced."""
        fs, p = self._open(source)
        _, to = self._open(target)
        if fs.exists(to):
            fs.delete(to, True)
        elif not fs.exists(to.getParent()):
            fs.mkdirs(to.getParent())
        if not fs.rename(p, to):
            raise OSError(f"could not move {source} to {target}")

    def lift(self, folder: str, target: str, name) -> None:
        """Move the files that lie in the folders of ``folder`` into ``target``, under ``name(folder's name, file's name)``."""
        fs, p = self._open(folder)
        path = self._sc._jvm.org.apache.hadoop.fs.Path
        found = [s.getPath() for s in fs.globStatus(path(p, "*/part-*"))]

        def one(file) -> None:
            to = f"{target}/{name(file.getParent().getName(), file.getName())}"
            if not fs.rename(file, path(to)):
                raise OSError(f"could not move {file} to {to}")

        with ThreadPoolExecutor(max_workers=8) as pool:
            list(pool.map(one, found))

    def delete(self, path: str) -> None:
        fs, p = self._open(path)
        fs.delete(p, True)

    def read(self, path: str) -> str:
        fs, p = self._open(path)
        stream = fs.open(p)
        try:
            return self._sc._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """A file that is there whole or not at all: it gets its name when it is written."""
        draft = f"{path}.{uuid.uuid4().hex}.draft"
        fs, p = self._open(draft)
        stream = fs.create(p, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.move(draft, path)
