"""The folder that driver and executors share, for tables written between two steps of a job."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``. Where none is set, a local session gets a temporary
    one of its own, and any other is refused: a folder of one machine would be lost or unseen by the rest."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        app = spark.sparkContext.applicationId
        folder = _OWN.get(app) or _OWN.setdefault(app, tempfile.mkdtemp(prefix="lotframe-"))
    return folder.rstrip("/")


#: The paths handed out since each ``scratch`` that is open began.
_SCRATCH: list[list[str]] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_folder(spark)}/lotframe-{name}-{uuid.uuid4().hex}"
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession, *paths: str) -> Iterator[None]:
    """Deletes what is written to fresh paths inside, and ``paths``, when the work inside is done; its result has to be
    written elsewhere by then. If the work fails, everything stays."""
    _SCRATCH.append([*paths])
    try:
        yield
        for path in _SCRATCH[-1]:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    finally:
        _SCRATCH.pop()


def written(df: DataFrame, path: str) -> DataFrame:
    """Writes ``df`` as Parquet and reads it back, so that a lost executor costs no recomputation."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
