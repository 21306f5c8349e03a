"""Session defaults and the shared folder for cut lineage."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "strataforge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; given settings win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or, only where that is unset on a local master, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    found = os.path.join(tempfile.gettempdir(), "strataforge-shared")
    spark.sparkContext.setCheckpointDir(found)
    return found


_local = threading.local()


@contextmanager
def scratch_tables() -> Iterator[None]:
    """Tables this thread materialises inside are deleted at the end, for runs that write their result inside."""
    scopes = _local.__dict__.setdefault("scopes", [])
    scopes.append([])
    try:
        yield
    finally:
        for files, folder in scopes.pop():
            files.delete(folder, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there and a lost executor costs nothing.

    The table is deleted at the end of the scratch_tables it is made in, else when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.deleteOnExit(folder)
    if getattr(_local, "scopes", None):
        _local.scopes[-1].append((files, folder))
    return spark.read.schema(df.schema).parquet(path)
