"""Small helpers on DataFrames shared by the operators."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import tempfile
import zipfile
from collections import defaultdict
from collections.abc import Callable, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.session import checkpointed

#: A table of at most so many narrow rows (24 bytes or so) is broadcast; a larger one is joined by a shuffle.
SMALL_ROWS = 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: lineage is cut, later steps read it."""
    return checkpointed(df)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written_once(df: DataFrame) -> DataFrame:
    """As written, and the files of the shuffles on the way go with the end of the write.

    They would else stay on the disks until the driver happens to collect garbage. Only the write reads them.
    """
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        return checkpointed(df)
    finally:
        spark.conf.set(_CLEANUP, before)


def small_or_shuffled(df: DataFrame, lists: str | None = None) -> DataFrame:
    """A hint to broadcast a written table if it is counted to be small; else the frame as it is.

    lists: a column of lists, whose entries count as rows.
    """
    entries = F.count("*") if lists is None else F.count("*") + F.coalesce(F.sum(F.greatest(F.size(lists), F.lit(0))), F.lit(0))
    return F.broadcast(df) if df.agg(entries).first()[0] <= SMALL_ROWS else df


def picked(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names the operator uses; all others, clashing or not, are left out."""
    return docs.select(*(docs[old].alias(new) for new, old in columns.items()))


def fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(n, df.schema[n].dataType, True) for n in names]


_sent: dict[str, list[Broadcast]] = defaultdict(list)


def sent(spark: SparkSession, value) -> Broadcast:
    """A value sent to every task, remembered so that its copies can be freed."""
    out = spark.sparkContext.broadcast(value)
    _sent[spark.sparkContext.applicationId].append(out)
    return out


def free_sent(spark: SparkSession) -> None:
    """Free the copies of what has been sent so far; a task that still reads one gets it again."""
    for value in _sent.pop(spark.sparkContext.applicationId, []):
        value.unpersist()


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Fewer rows in a batch between the JVM and its workers for this session, unless it has its own number.

    Texts are long rows: batches of the usual ten thousand hold tens of megabytes on both sides.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(rows))


def release_memory() -> None:
    """Give memory that a worker has freed back to the machine, which it shares with other stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session, which need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def shipped(query: Callable) -> Callable:
    """A query or stage that ships the package first."""

    @functools.wraps(query)
    def run(spark, *rest):
        ship(spark)
        return query(spark, *rest)

    return run
