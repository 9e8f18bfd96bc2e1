"""Shared storage for lineage cuts and round trips, and queries side by side."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Queries handed to Spark at a time: while one is planned, the tasks of others run.
_AT_ONCE = 4


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is absent, a local-mode session gets a folder of its own;
    on a cluster that would be one machine's disk, so it is refused instead.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def side_by_side(spark: SparkSession, calls: Iterable[Callable]) -> list:
    """Results of calls that each run queries, a few of them at a time. All have ended when one's error is raised."""
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]
        return [done.result() for done in started]
