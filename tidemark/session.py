"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where that costs one more shuffle for a later aggregate
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_LOCAL_DIRS: dict[str, str] = {}


def build_session(master: str | None = None, app: str = "tidemark", **extra: str) -> SparkSession:
    """Session with the settings the operators expect; cluster settings win where already given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from spark.checkpoint.dir.

    Only a local session may go without the setting; it then gets a fresh
    folder under the system's temporary directory.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_DIRS[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """Unused path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, makes values such as a
    partition id repeatable, and gives the planner a true file size, so
    that it broadcasts the table only when it is small.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, *steps: Callable[[], Any]) -> list[Any]:
    """Results of steps that do not need each other, in their order.

    Their jobs share the cluster, so one step uses the cores that the last
    tasks of another leave idle. All steps are ended before the first error,
    in their order, is raised.
    """
    if not steps:
        return []
    with ThreadPoolExecutor(len(steps)) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [run.result() for run in runs]
