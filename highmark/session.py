"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Days are in UTC. The windows of the ladder sort a task's rows several times and keep each sorted copy, some
#: thirty bytes for one that was shuffled: tasks read 8 MB, and shuffles have enough parts for that up to 8 GB.
#: Aggregates of days keep nearly all that a task scans, so that this is bounded, too; small files still come
#: 32 to a task.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.files.openCostInBytes": "1m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
}


def settle(spark: SparkSession) -> None:
    """The settings that jobs rely on, in a session that others have built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


def build_session(
    app_name: str = "highmark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with UTC days, small tasks and adaptive execution; other sizes come from the caller or the cluster."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config(map=SETTINGS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared folder named by ``spark.checkpoint.dir``.

    Only tests, in a single process, may go without that setting; on a cluster, a local one
    included, a machine-local folder would be invisible to other executors.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="highmark-")
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")
