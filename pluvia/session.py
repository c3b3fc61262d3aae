"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from pluvia.sources import folders

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}

_local_scratch: dict[str, str] = {}


def build_session(app_name: str = "pluvia", **conf: str) -> SparkSession:
    """A session with adaptive execution on. Size ``spark.sql.shuffle.partitions`` for the data
    (about 128-256 MB a partition); adaptive execution merges what turns out too small."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it then gets a fresh folder in /tmp.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_scratch[app]


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was written to scratch paths made within. Frames that read them must be done with by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            folders.delete(spark, path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Later actions read columns from the files instead of repeating the plan, and a lost executor
    costs a re-read, not a recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
