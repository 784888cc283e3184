"""Session defaults and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
    # The JVM never compiles a method above 8,000 bytes; wide projections are
    # faster when Spark splits them up instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(app: str = "tidewheel", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings this library expects; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {key.replace("_", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder all executors can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    master, as in tests, may fall back to a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidewheel-")
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Python functions refer to it by name, so workers must be able to import it
    wherever the driver was started.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root, name = os.path.split(package)
    target = os.path.join(tempfile.mkdtemp(prefix="tidewheel-"), name)
    context.addPyFile(shutil.make_archive(target, "zip", root, name))
    _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()
