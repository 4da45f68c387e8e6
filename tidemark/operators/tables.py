"""Tables on Parquet folders, with the writes that a lakehouse merge would do.

A table is a log of versions and folders of data.  A version is a small file that names the folders of each partition; a
write makes new folders first and then the next version, which no two writers can both create.  Readers take the newest
version, so they see a write in whole or not at all, and a write that breaks off leaves nothing but folders that no version
names.  A frame may read the table that it replaces.  A writer that was overtaken tries again on the newer version.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.files import Files, Taken

WHOLE, NONE = "", "__HIVE_DEFAULT_PARTITION__"
#: Attempts of a writer that others overtake.
ATTEMPTS = 10
_BY = "__partition"
#: The column of changes(): whether a row came or went.
CHANGE = "__change"


def work_folder(spark: SparkSession) -> str:
    """A new folder that all executors share: below spark.checkpoint.dir, or a temporary one for a local session."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        return tempfile.mkdtemp(prefix="tidemark-")
    return f"{found.rstrip('/')}/tidemark-tables/{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Version:
    """folders: by partition value, as text, or under WHOLE.  done: the last batch of each stream that was appended."""

    number: int
    schema: str
    folders: dict[str, list[str]]
    done: dict[str, int]


@dataclass(frozen=True)
class Table:
    spark: SparkSession
    path: str
    partition: str | None = None

    @property
    def _files(self) -> Files:
        return Files(self.spark)

    # -- versions

    def version(self, number: int | None = None) -> Version | None:
        """That version, or the newest; None where there is no table."""
        names = [n for n in self._files.names(f"{self.path}/_versions") if n.endswith(".json") and not n.startswith(".")]
        name = names[-1] if names and number is None else f"{number:010d}.json" if number is not None else None
        return Version(**self._files.read_json(f"{self.path}/_versions/{name}")) if name in names else None

    def _commit(self, schema: StructType, change: Callable[[dict[str, list[str]]], dict[str, list[str]]], stream: tuple[str, int] | None = None, base: int | None = None) -> int:
        """The next version, with the folders that ``change`` makes of those of the newest, or of the version ``base``."""
        for _ in range(ATTEMPTS):
            now = self.version() or Version(0, "", {}, {})
            if stream and now.done.get(stream[0], -1) >= stream[1]:
                return now.number  # this batch is in
            old = now if base is None else self.version(base) or Version(0, "", {}, {})
            if self._next(now, schema, change(old.folders), stream):
                return now.number + 1
        raise Taken(f"{self.path}: overtaken {ATTEMPTS} times")

    def _next(self, now: Version, schema: StructType, folders: dict[str, list[str]], stream: tuple[str, int] | None = None) -> bool:
        done = now.done | ({stream[0]: stream[1]} if stream else {})
        document = {"number": now.number + 1, "schema": json.dumps(schema.jsonValue()), "folders": {k: v for k, v in folders.items() if v}, "done": done}
        try:
            self._files.create_json(f"{self.path}/_versions/{now.number + 1:010d}.json", document)
        except Taken:
            return False
        return True

    def _written(self, frame: DataFrame) -> dict[str, list[str]]:
        """The frame in new folders, by partition value.  The partition's column stays in the data."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        if self.partition is None:
            frame.write.parquet(folder)
            return {WHOLE: [folder]}
        frame.withColumn(_BY, F.col(self.partition).cast("string")).write.partitionBy(_BY).parquet(folder)
        return {unquote(name.split("=", 1)[1]): [f"{folder}/{name}"] for name in self._files.names(folder) if name.startswith(f"{_BY}=")}

    # -- reads

    def exists(self) -> bool:
        return self.version() is not None

    def read(self, values: Iterable | None = None, version: int | None = None) -> DataFrame:
        """The table, or its partitions of some values, of which no other folder is looked at."""
        now = self.version(version)
        if now is None:
            raise FileNotFoundError(self.path)
        wanted = None if values is None else {NONE if v is None else str(v) for v in values}
        folders = [f for value, own in sorted(now.folders.items()) if wanted is None or value in wanted for f in own]
        schema = StructType.fromJson(json.loads(now.schema))
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    # -- writes

    def _gathered(self, frame: DataFrame) -> DataFrame:
        """The frame with the rows of a partition together, in stretches of the size that Spark is told to make, so that a write
        makes few files and no task has a whole large partition."""
        return frame if self.partition is None else frame.withColumn(_BY, F.col(self.partition).cast("string")).hint("rebalance", _BY).drop(_BY)

    def overwrite(self, frame: DataFrame) -> int:
        written = self._written(self._gathered(frame))
        return self._commit(frame.schema, lambda old: written)

    def append(self, frame: DataFrame, stream: tuple[str, int] | None = None) -> int:
        """Adds rows.  stream: name and number of a batch, which goes in once however often it is given."""
        written = self._written(self._gathered(frame))
        return self._commit(frame.schema, lambda old: {k: old.get(k, []) + written.get(k, []) for k in {*old, *written}}, stream)

    def replace_partitions(self, frame: DataFrame, values: Sequence, base: int | None = None, stream: tuple[str, int] | None = None) -> int:
        """The partitions of these values become the frame, be it empty; a row of another partition is an error.

        base: the version whose other partitions stay, in place of the newest; 0 for none.  stream: as for append().
        """
        if self.partition is None:
            raise ValueError("the table has no partitions")
        texts = [NONE if v is None else str(v) for v in values]
        written = self._written(self._gathered(frame))
        if {*written} - {*texts}:  # told by the folders that were written, so by no pass of its own
            raise ValueError(f"rows outside {self.partition} = {', '.join(texts)}")
        return self._commit(frame.schema, lambda old: {k: v for k, v in old.items() if k not in texts} | written, stream, base)

    def replace_partition(self, frame: DataFrame, value) -> int:
        return self.replace_partitions(frame, [value])

    def insert_new(self, frame: DataFrame, keys: Sequence[str]) -> None:
        """Appends the rows whose key the table does not have; rows of the frame that share a key go in once.

        If the partition is one of the keys, only the partitions that the frame has rows of are read.
        """
        fresh = frame.dropDuplicates(list(keys))
        for _ in range(ATTEMPTS):
            now = self.version()
            if now is None:
                now, new = Version(0, "", {}, {}), fresh
            else:
                touched = [r[0] for r in fresh.select(self.partition).distinct().collect()] if self.partition in keys else None
                new = without(fresh, self.read(touched, now.number), keys)
                if new.isEmpty():
                    return
            written = self._written(new)
            if self._next(now, frame.schema, {k: now.folders.get(k, []) + written.get(k, []) for k in {*now.folders, *written}}):
                return
        raise Taken(f"{self.path}: overtaken {ATTEMPTS} times")

    def upsert(self, frame: DataFrame, keys: Sequence[str]) -> None:
        """Rows of the frame take the place of those with the same key; meant for small control tables."""
        for _ in range(ATTEMPTS):
            now = self.version()
            whole = upserted(self.read(version=now.number), frame, keys) if now else frame
            if self._next(now or Version(0, "", {}, {}), frame.schema, self._written(whole)):
                return
        raise Taken(f"{self.path}: overtaken {ATTEMPTS} times")

    def clustered(self, columns: Sequence[str], files: int) -> int | None:
        """Rewrites the table in ranges of the columns, so that the statistics of its row groups skip much."""
        return self.rewrite(lambda rows: rows.repartitionByRange(files, *columns).sortWithinPartitions(*columns))

    def rewrite(self, how: Callable[[DataFrame], DataFrame], values: Iterable | None = None) -> int | None:
        """The same rows in other files: the table, or its partitions of some values, as ``how`` lays them out.

        Only partitions that are there are rewritten; None where there are none.  A writer that comes in between wins, and the
        layout is made anew from what it has left.
        """
        wanted = None if values is None else {NONE if v is None else str(v) for v in values}
        for _ in range(ATTEMPTS):
            if (now := self.version()) is None:
                return None
            old = {k: v for k, v in now.folders.items() if wanted is None or k in wanted}
            if not old:
                return None
            schema = StructType.fromJson(json.loads(now.schema))
            written = self._written(how(self.spark.read.schema(schema).parquet(*(f for own in old.values() for f in own))))
            if self._next(now, schema, {k: v for k, v in now.folders.items() if k not in old} | written):
                return now.number + 1
        raise Taken(f"{self.path}: overtaken {ATTEMPTS} times")

    def changes(self, old: int, new: int) -> DataFrame:
        """What changed between two versions (0: before the first): the rows of folders that came, with CHANGE 1, and of those that
        went, with CHANGE -1.  Folders that both have are not read.  A row that only moved to another file is there twice, with
        either sign, so sums over CHANGE times a value are right."""
        before, after = (({f for own in v.folders.values() for f in own} if (v := self.version(n)) else set()) for n in (old, new))
        now = self.version(new)
        if now is None:
            raise FileNotFoundError(f"{self.path}, version {new}")
        schema = StructType.fromJson(json.loads(now.schema))
        out = self.spark.createDataFrame([], schema).withColumn(CHANGE, F.lit(1))
        for folders, sign in ((after - before, 1), (before - after, -1)):
            if folders:
                out = out.union(self.spark.read.schema(schema).parquet(*sorted(folders)).withColumn(CHANGE, F.lit(sign)))
        return out

    def vacuum(self, versions: int = 10, hours: float = 0) -> list[str]:
        """Deletes folders that none of the newest versions names, among them those of writes that broke off.

        hours: only folders that are so old, longer than any write takes; with 0 no write may be under way."""
        files, now = self._files, self.version()
        kept = [v for n in range(max(1, now.number - versions + 1), now.number + 1) if (v := self.version(n))] if now else []
        named = {f[len(self.path) + len("/data/") :].split("/")[0] for v in kept for own in v.folders.values() for f in own}
        gone = [name for name in files.names(f"{self.path}/data") if name not in named and (not hours or files.age(f"{self.path}/data/{name}") >= 3600 * hours)]
        for name in gone:
            files.delete(f"{self.path}/data/{name}")
        return gone


def without(frame: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a frame whose key the other does not have; null keys are equal."""
    named = [f"__{k}" for k in keys]
    side = other.select(*(F.col(k).alias(n) for k, n in zip(keys, named, strict=True))).distinct()
    same = F.lit(True)
    for k, n in zip(keys, named, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(n))
    return frame.join(side, same, "left_anti")


def upserted(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return without(old, new, keys).unionByName(new)


def difference(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What replacing old by new does: action (insert, update, delete, keep) and its number of rows."""
    values = [c for c in new.columns if c not in keys]
    a = old.select(*keys, F.struct(*values).alias("__old"), F.lit(True).alias("__in_old"))
    b = new.select(*keys, F.struct(*values).alias("__new"), F.lit(True).alias("__in_new"))
    both = a.join(b, list(keys), "full_outer")
    action = F.when(F.col("__in_old").isNull(), "insert").when(F.col("__in_new").isNull(), "delete").when(F.col("__old").eqNullSafe(F.col("__new")), "keep").otherwise("update")
    return both.groupBy(action.alias("action")).agg(F.count("*").alias("n"))


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: rows that either frame has more often than the other."""
    return a.exceptAll(b).unionByName(b.exceptAll(a)).agg(F.count("*").alias("different"))
