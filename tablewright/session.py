"""Session helpers: shared folder for cut lineage, and sensible session defaults."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What a session for this package should run with.  All are plain Spark settings; a cluster's own
# values win, because `session()` only sets what the caller did not.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Wide projections of parsed columns generate long methods, and HotSpot never compiles one beyond
    # 8,000 bytes: such a stage runs faster as separate, split projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# For writes of such projections in sessions that this package did not make.
COMPILED = {"spark.sql.codegen.hugeMethodLimit": DEFAULTS["spark.sql.codegen.hugeMethodLimit"]}


def session(
    app: str = "tablewright", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A SparkSession with the package defaults under the given settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once per application.

    Functions that run in Python workers are pickled by reference, so the workers must be able to
    import the package, wherever the driver found it.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = _shipped[app] = tempfile.TemporaryDirectory()  # Spark serves the file while the application runs
    archive = os.path.join(os.path.realpath(folder.name), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for top, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(top, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, where lineage is cut.

    It is the cluster's `spark.checkpoint.dir`.  Only a single-JVM session without one gets a folder
    of its own; any other session without one is an error, since a machine-local folder would be
    lost together with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path in the folder of this application, below the shared one."""
    return f"{_application_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tablewright-{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application has materialized; call it when no frame is read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(
    df: DataFrame, label: str = "stage", partition_by: tuple[str, ...] = (), conf: Mapping[str, str] | None = None
) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Used where a result must not be computed twice (ids that depend on partition numbers, a frame
    that several later jobs read).  Unlike cached blocks the files survive the loss of an executor,
    and unlike a checkpoint they keep column pruning, pushdown and size statistics.  `conf` holds settings
    for this write alone.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    # what the write shuffled is not read again: let Spark remove it now, not at some garbage collection
    with set_for(spark, {_TIDY: "true", **(conf or {})}):
        df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def set_for(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the jobs inside; the caller's values come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
