"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_passing = threading.local()


def build_session(app_name: str = "sparkvigil", **conf: str) -> SparkSession:
    """A session with the settings the library is tested with; cluster values win."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (tests, a laptop) gets a folder of its own: on a
    cluster a machine-local folder is invisible to the other executors, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="sparkvigil-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own for one intermediate table, below the shared folder."""
    app = spark.sparkContext.applicationId
    path = f"{shared_root(spark)}/sparkvigil-{app}/{name}-{uuid.uuid4().hex[:12]}"
    if getattr(_passing, "paths", None) is not None:
        _passing.paths.append(path)
    return path


@contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside, by this thread, are removed at the end.

    Results must have been written by then: tables are read lazily.
    """
    before, _passing.paths = getattr(_passing, "paths", None), []
    try:
        yield
    finally:
        for path in _passing.paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        _passing.paths = before


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage like a checkpoint, survives the loss of executors, and stays columnar, so that
    every later pass reads only the columns it needs.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
