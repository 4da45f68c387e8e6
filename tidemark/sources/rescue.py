"""Reads of Parquet files whose schema drifts: what does not fit the declared schema is rescued as JSON, row by row."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RESCUED = "_rescued_data"


def read_rescued(spark: SparkSession, paths: list[str], schema: StructType, file: str | None = None) -> DataFrame:
    """The files under one schema, with RESCUED: columns that are not declared and values that cannot be cast.

    file: a column to add, with the path of the file that a row is from.  Footers are read by tasks, and merged there; what one
    file has and another has not is null in the other, so files are one scan unless a column's types are at odds.
    """
    frames = [_fitted(spark.read.schema(kind).parquet(*files), schema, file) for kind, files in merged_schemas(spark, sorted(paths))]
    if not frames:
        return spark.createDataFrame([], schema).withColumns({name: F.lit(None).cast("string") for name in (RESCUED, file) if name})
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


#: What Spark calls types that are at odds.
_AT_ODDS = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE", "FAILED_MERGE", "Failed merging")


def merged_schemas(spark: SparkSession, paths: list[str]) -> list[tuple[StructType, list[str]]]:
    """The files in groups whose schemas merge, with the merged one.

    Spark reads and merges the footers of a group in tasks and gives the driver one schema.  Where types are at odds, the
    group is halved: files that were delivered together stand together by their paths, so k changes of types along the way
    take about k times the logarithm of the files, and the driver never looks at files one by one.
    """
    todo, found = [paths] if paths else [], []
    while todo:
        files = todo.pop()
        try:
            found.append((spark.read.option("mergeSchema", True).parquet(*files).schema, files))
        except (PySparkException, Py4JJavaError) as error:
            if len(files) == 1 or not any(told in str(error) for told in _AT_ODDS):
                raise
            todo += [files[len(files) // 2 :], files[: len(files) // 2]]
    joined: list[tuple[StructType, list[str]]] = []
    for kind, files in found:  # neighbours that were halved for nothing are one scan again
        if joined and joined[-1][0] == kind:
            joined[-1] = (kind, joined[-1][1] + files)
        else:
            joined.append((kind, files))
    return joined


def _fitted(df: DataFrame, schema: StructType, file: str | None) -> DataFrame:
    declared, native = {f.name: f.dataType for f in schema}, {f.name: f.dataType for f in df.schema}
    columns, rescued = [], []
    for name, kind in declared.items():
        if name not in native:
            columns.append(F.lit(None).cast(kind).alias(name))
        elif native[name] == kind:
            columns.append(F.col(name))
        else:
            fitted = F.col(name).try_cast(kind)
            lost = F.col(name).isNotNull() & (fitted.isNull() | ~fitted.try_cast(native[name]).eqNullSafe(F.col(name)))
            columns.append(F.when(~lost, fitted).alias(name))
            rescued.append(F.when(lost, F.col(name)).alias(name))
    rescued += [F.col(name) for name in native if name not in declared]
    found = F.to_json(F.struct(*rescued)) if rescued else F.lit(None).cast("string")
    origin = [F.col("_metadata.file_path").alias(file)] if file else []
    return df.select(*columns, F.when(found != "{}", found).alias(RESCUED), *origin)
