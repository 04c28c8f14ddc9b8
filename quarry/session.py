"""SparkSession helper for local runs and submitted jobs."""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import SparkSession

from .shared import shared_dir

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def build_session(app: str = "quarry", cpus: int | str | None = None, shuffle_partitions: int | None = None,
                  driver_memory: str | None = None, extra: dict | None = None) -> SparkSession:
    """A session with UTC and small Arrow batches (page bodies can be megabytes).

    Under ``spark-submit`` the submitted master, memory and partition counts
    hold; elsewhere the master is ``local[cpus]``.
    """
    builder = SparkSession.builder.appName(app)
    if "PYSPARK_GATEWAY_PORT" not in os.environ:  # not launched by spark-submit
        builder = builder.master(f"local[{cpus or '*'}]").config("spark.ui.enabled", "false")
        if driver_memory is not None:
            builder = builder.config("spark.driver.memory", driver_memory)
        if shuffle_partitions is not None:
            builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    small_batches(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bound the Arrow batches handed to Python, unless the session's owner chose a size."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(rows))


def ship_package(spark: SparkSession) -> None:
    """Hand the package to the Python workers, so that jobs run from any folder; once a context.

    The archive is written to the shared folder through Spark's own file system.
    """
    context = spark.sparkContext
    name = f"quarry-{context.applicationId}.zip"
    if name in context._python_includes:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    at = context._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = at.getFileSystem(context._jsc.hadoopConfiguration()).create(at, True)
    out.write(held.getvalue())
    out.close()
    context.addPyFile(at.toString())
