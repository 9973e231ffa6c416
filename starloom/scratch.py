"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cache
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"{application}-")


def scratch_folder(spark: SparkSession) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``, or else set
    by ``setCheckpointDir``.

    Only a local-mode session, as in tests, may go without.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_folder(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}/{uuid4()}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back.

    What follows does not recompute ``df``, survives lost executors, and is
    planned with the size of the written files.
    """
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_all(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """``settle`` for several small frames, as concurrent jobs."""
    if not frames:
        return {}
    spark = next(iter(frames.values())).sparkSession
    with ThreadPoolExecutor(len(frames)) as pool:
        settled = pool.map(inheritable_thread_target(spark)(settle), frames.values())
        return dict(zip(frames, settled, strict=True))
