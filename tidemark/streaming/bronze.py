"""Incremental raw ingest: new files once, with their lineage, until none is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.tables import Table
from tidemark.sources.rescue import read_rescued

MONTH_IN_PATH = r"source_month=(\d{4}-\d{2}(?:-\d{2})?)"
#: What the reader of whole files gives.
LISTING = "path string, modificationTime timestamp, length bigint, content binary"
SNAPSHOT_IN_PATH = r"snapshot=([0-9a-f]{64})"


def snapshot_in(path: Column) -> Column:
    """The checksum in a path, or null."""
    return F.nullif(F.regexp_extract(path, SNAPSHOT_IN_PATH, 1), F.lit(""))


def month_in(path: Column) -> Column:
    """The month in a path, as its first day, or null."""
    found = F.nullif(F.regexp_extract(path, MONTH_IN_PATH, 1), F.lit(""))
    return F.to_date(F.concat(F.substring(found, 1, 7), F.lit("-01")))


def with_lineage(df: DataFrame, file: Column | None = None) -> DataFrame:
    """Adds the file that a row is from (null where a frame has none) and when it came in."""
    return df.withColumn("_source_file", (F.lit(None) if file is None else file).cast("string")).withColumn("_ingested_at", F.current_timestamp())


def located(df: DataFrame) -> DataFrame:
    """Adds what the path of a row's file says."""
    path = F.col("_source_file")
    return df.withColumns({"source_snapshot_id": snapshot_in(path), "source_month": month_in(path), "_source_object_id": F.sha2(path, 256), "_source_object_version": snapshot_in(path)})


def read_stream(spark: SparkSession, folder: str, schema: StructType, glob: str = "*.parquet") -> DataFrame:
    """A stream of the folder's files, at any depth, with lineage and what the path says."""
    raw = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", "true").parquet(folder)
    return located(with_lineage(raw, F.col("_metadata.file_path")))


def ingest(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Appends what is new to a Parquet folder and returns; with the same checkpoint, files are never taken twice."""
    query = stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def ingest_rescued(table: Table, folder: str, checkpoint: str, schema: StructType, *, glob: str = "*.parquet", files_at_a_time: int = 1000) -> None:
    """Appends the folder's new files to a table and returns; files whose schema drifts keep what does not fit as JSON.

    A batch of files is known to the table by its number, so one that is tried again after a failure goes in once.
    """
    spark = table.spark
    # only paths are selected, so no content is read here
    found = spark.readStream.format("binaryFile").schema(LISTING).option("pathGlobFilter", glob).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_at_a_time).load(folder).select("path")

    def take(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # files_at_a_time at most
        if paths:
            rows = read_rescued(spark, paths, schema, "_source_file")
            table.append(located(with_lineage(rows, F.col("_source_file"))), (checkpoint, number))

    found.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def complete(table: DataFrame, received: DataFrame) -> DataFrame:
    """(uri, rows_received, rows_found) of files that the table does not have in full; received: uri, rows_received."""
    found = table.groupBy(F.col("_source_file").alias("uri")).agg(F.count("*").alias("rows_found"))
    both = received.join(found, "uri", "left").withColumn("rows_found", F.coalesce("rows_found", F.lit(0)))
    return both.filter(F.col("rows_received").isNotNull() & (F.col("rows_received") != F.col("rows_found")))
