"""Shared scratch tables.

Every intermediate that is read more than once is written as Parquet below the folder that the cluster names in
``spark.checkpoint.dir``.  Such a table survives the loss of any executor and cuts the lineage of what reads it.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import SparkFiles, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: The folders of local sessions that name none, by application.
_own: dict[str, str] = {}


def root(spark: SparkSession) -> str:
    """The shared folder; a temporary one, made here, only for a local session that names none."""
    context = spark.sparkContext
    found = spark.conf.get(CHECKPOINT_DIR, None) or _own.get(context.applicationId)
    if not found:
        if not context.master.startswith("local["):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        found = _own[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return found.rstrip("/")


def place(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{root(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again."""
    path = place(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Whether Spark deletes the shuffle files of a query when it is done.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep_alone(df: DataFrame, name: str) -> DataFrame:
    """keep(), whose shuffle files are deleted when it is done; nothing else may read these, so df must not be cached."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return keep(df, name)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def keep_once(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """keep(), with the path, for discard()."""
    path = place(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


#: Bits of the largest bit map of keys, 32 MB; it has 16 bits a key, or fewer where there are more keys than that allows.
MOST_BITS = 1 << 28


def likely(df: DataFrame, key: Column, keys: DataFrame, name: str) -> DataFrame:
    """df with a boolean column ``name``: false where ``key`` is certainly not in the one column of keys.

    A bit map of hashes of the keys goes to every task: its size is bounded by MOST_BITS, whatever the number of keys.  More
    keys only make more rows likely that are none; callers decide on likely rows by a join, so that all others, with their
    texts, stay where they are.
    """
    n = keys.count()
    bits = min(MOST_BITS, 1 << max(15, math.ceil(math.log2(16 * max(n, 1)))))

    def place(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(bits)) + 1

    taken = {c.lower() for c in df.columns} | {name.lower()}
    page, bitmap = [x for x in (f"tidemark_{k}" for k in range(len(taken) + 2)) if x not in taken][:2]
    own = place(F.col(f"`{keys.columns[0]}`"))
    pages = keys.filter(F.col(f"`{keys.columns[0]}`").isNotNull()).groupBy(F.bitmap_bucket_number(own).alias(page)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(own)).alias(bitmap))
    bit = F.bitmap_bit_position(place(key))
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (bit % 8).cast("int")) == 1
    joined = df.withColumn(page, F.bitmap_bucket_number(place(key))).join(F.broadcast(pages), page, "left")
    return joined.withColumn(name, F.coalesce(is_set, F.lit(False)) & key.isNotNull()).drop(page, bitmap)


def among(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows of df whose key is in the one column of keys, a kept table; only likely rows move."""
    flag, (own,) = _fresh(df, "tidemark_likely"), keys.columns
    return likely(df, key, keys, flag).filter(F.col(flag)).drop(flag).join(keys.withColumnRenamed(own, flag), key == F.col(flag), "left_semi")


def without(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows of df whose key is null or not in the one column of keys, a kept table; only likely rows move."""
    flag, (own,) = _fresh(df, "tidemark_likely"), keys.columns
    marked = likely(df, key, keys, flag)
    doubtful = marked.filter(F.col(flag)).drop(flag).join(keys.withColumnRenamed(own, flag), key == F.col(flag), "left_anti")
    return marked.filter(~F.col(flag)).drop(flag).union(doubtful)


def _fresh(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table that nothing will read again."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_shipped: set[str] = set()
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors through Spark's own file server, once a session; Python operators call it first.

    Arrow batches of texts are made smaller, unless the session has a size of its own: a batch is held by the executor's
    JVM, outside its heap, and by the Python worker.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, str(BATCH_ROWS))
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="tidemark-ship-")) / "tidemark_shipped.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return spark


_sent: set[tuple[str, str]] = set()


def ship_file(spark: SparkSession, path: str) -> None:
    """Sends a file of the driver to the executors, once a session: their machines need not have it at that path."""
    if (mark := (spark.sparkContext.applicationId, path)) not in _sent:
        spark.sparkContext.addFile(path)
        _sent.add(mark)


def here(path: str) -> str:
    """Where a file that was sent is on this machine: in a task the copy that Spark has brought, else the path itself."""
    if TaskContext.get() is None:
        return path
    copy = os.path.join(SparkFiles.getRootDirectory(), os.path.basename(path))
    return copy if os.path.exists(copy) else path
