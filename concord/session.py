"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections import defaultdict

from pyspark.sql import SparkSession

#: Settings the jobs are written for. ANSI mode and AQE are on by default in Spark 4; they
#: are repeated here because results and skew handling rely on them. The method limit is the
#: size above which the JVM leaves a generated method uncompiled: stages with much text work
#: then run as several compiled projections in place of one interpreted method.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


#: Settings of joins one after the other that share a part of their keys: rows shuffled by it for the first
#: join stay where they are for the next, unless a frequent key has adaptive execution split a partition.
SHARED_PARTITIONS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def shared_partitions(spark: SparkSession) -> None:
    """Have joins on some and on more of the same keys shuffle their rows once in this session."""
    for key, value in SHARED_PARTITIONS.items():
        spark.conf.set(key, value)


def local_session(cores: str = "*", name: str = "concord", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Sub-folders given out, by application.
_folders: dict[str, list[str]] = defaultdict(list)
#: Folders of local sessions that name none, by application.
_local: dict[str, str] = {}


def drop_written(spark: SparkSession) -> int:
    """Remove the tables this session's jobs have written to the shared folder; tells how many folders.

    For whoever owns the session, once the results that read them are stored or shown.
    """
    return drop_folders(spark, written_folders(spark))


def written_folders(spark: SparkSession) -> list[str]:
    """The folders of the tables this session's jobs have written so far and not removed."""
    return list(_folders[spark.sparkContext.applicationId])


def drop_folders(spark: SparkSession, folders: list[str]) -> int:
    """Remove written tables by their folders, once nothing reads them any more; tells how many."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
        _folders[spark.sparkContext.applicationId].remove(folder)
    return len(folders)


def shared_folder(spark: SparkSession) -> str:
    """A fresh sub-folder of the folder the cluster names in spark.checkpoint.dir.

    Only a local session may leave the setting out; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="concord-")
        _local[spark.sparkContext.applicationId] = root
    folder = os.path.join(root, f"concord-{uuid.uuid4().hex}")
    _folders[spark.sparkContext.applicationId].append(folder)
    return folder


def checkpointed(df):
    """Write the frame to the shared folder and read it back, which cuts its lineage."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
