"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", partitions: int | None = None) -> SparkSession:
    """A session with the settings the jobs are written for; a cluster passes its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("gridspan")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    spark = builder.getOrCreate()
    ship(spark)
    return spark


PACKAGE = Path(__file__).resolve().parent


def _is_local(spark: SparkSession) -> bool:
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


@cache
def _shipped(application: str) -> str:
    folder = tempfile.mkdtemp(prefix=f"gridspan-{application}-")
    return shutil.make_archive(f"{folder}/gridspan", "zip", PACKAGE.parent, PACKAGE.name)


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package, wherever the driver was started.

    Workers on the driver's machine get its folder in their path. Others are sent an archive
    once, which Spark hands out from the driver, unless the package is installed there.
    """
    context = spark.sparkContext
    paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
    if str(PACKAGE.parent) not in paths:
        paths = [p for p in [*paths, str(PACKAGE.parent)] if p]
        context.environment["PYTHONPATH"] = os.pathsep.join(paths)
        if not _is_local(spark):
            context.addPyFile(_shipped(context.applicationId))


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"gridspan-{application}-")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the cluster's shared checkpoint folder.

    Only a session whose tasks run in the driver falls back to a temporary folder if it names
    none; on a cluster, a local one included, the executors could not see it. The folders are left for the cluster's own clean-up.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not _is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder(context.applicationId)
    return f"{base.rstrip('/')}/gridspan/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """`df` written once to the shared scratch folder and read back.

    For a frame several later steps read: its source is then scanned once, and a lost
    executor costs a re-read of this table instead of a recomputation.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
