"""Small files and renames on any file system that Spark reads, through Hadoop's API."""

from __future__ import annotations

import hashlib
import json
import posixpath
import time
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

CHUNK = 1 << 20
#: Schemes whose rename to a taken place fails, whoever comes first.  A mount table passes on what its target does.
RENAMED = {"file", "hdfs", "webhdfs", "viewfs"}
#: Schemes of object stores where a rename is a look and a copy, but a file can be created on condition that there is none: the
#: store decides at the end of the upload.
CONDITIONAL = {"gs", "abfs", "abfss", "s3a"}
#: What asks the s3a connector for that; it refuses where it cannot.
_S3_CONDITION = "fs.option.create.conditional.overwrite"


class Taken(FileExistsError):
    """A place that must be free is not."""


class Unsafe(NotImplementedError):
    """A file system on which two writers could both create the same file."""


@dataclass(frozen=True)
class Files:
    """Nothing is ever half there, and what is there is not overwritten: content is written aside, and put in place by a rename
    that overwrites nothing or, on object stores, by an upload on condition that nothing is there.  Other schemes are refused."""

    spark: SparkSession

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._system(path).exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        """What a folder holds, by name; nothing where there is no folder."""
        return sorted(s.getPath().getName() for s in self._system(folder).listStatus(self._path(folder))) if self.exists(folder) else []

    def modified(self, path: str) -> int:
        """When a file was last changed, in milliseconds."""
        return self._system(path).getFileStatus(self._path(path)).getModificationTime()

    def age(self, path: str) -> float:
        """Seconds since a file, or a folder's list of files, was last changed."""
        return time.time() - self.modified(path) / 1000

    def delete(self, path: str) -> None:
        self._system(path).delete(self._path(path), True)

    def chunks(self, path: str) -> Iterator[bytes]:
        stream = self._system(path).open(self._path(path))
        try:
            while chunk := bytes(stream.readNBytes(CHUNK)):
                yield chunk
        finally:
            stream.close()

    def read(self, path: str) -> bytes:
        return b"".join(self.chunks(path))

    def checksum(self, path: str) -> str:
        digest = hashlib.sha256()
        for chunk in self.chunks(path):
            digest.update(chunk)
        return digest.hexdigest()

    def stage(self, path: str, chunks: Iterable[bytes]) -> str:
        """Content beside ``path``, under a name that readers of Parquet pass over; gives that place."""
        aside = posixpath.join(posixpath.dirname(path), f".{posixpath.basename(path)}.{uuid.uuid4().hex}")
        out = self._system(aside).create(self._path(aside), True)
        try:
            for chunk in chunks:
                for at in range(0, len(chunk), CHUNK):
                    out.write(bytearray(chunk[at : at + CHUNK]))
            out.close()
        except BaseException:
            out.close()
            self.delete(aside)
            raise
        return aside

    def settle(self, aside: str, path: str) -> None:
        """Brings a staged file to its place, which must be free."""
        scheme = self._system(path).getUri().getScheme()
        try:
            if scheme in RENAMED:
                self._renamed(aside, path)
            elif scheme in CONDITIONAL:
                self._uploaded(aside, path, scheme)
            else:
                raise Unsafe(f"{scheme}: two writers could both create {path}")
        except Py4JJavaError as error:
            if not any(told in f"{error.java_exception.getClass().getName()} {error.java_exception.getMessage()}" for told in ("FileAlreadyExists", "412", "PreconditionFailed", "ConditionNotMet")):
                raise
            self.delete(aside)
            raise Taken(path) from None

    def _uploaded(self, aside: str, path: str, scheme: str) -> None:
        builder = self._system(path).createFile(self._path(path)).overwrite(False).recursive()
        out = (builder.must(_S3_CONDITION, True) if scheme == "s3a" else builder).build()
        try:
            for chunk in self.chunks(aside):
                out.write(bytearray(chunk))
        except BaseException:
            getattr(out, "abort", out.close)()  # an upload that is not ended leaves nothing
            raise
        out.close()
        self.delete(aside)

    def _renamed(self, aside: str, path: str) -> None:
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(path).toUri(), self.spark._jsc.hadoopConfiguration())
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark._sc._gateway.new_array(kind, 0)
        self._system(path).mkdirs(self._path(path).getParent())
        context.rename(self._path(aside), self._path(path), options)

    def create(self, path: str, content: bytes) -> None:
        """A new file, whole or not at all; Taken where there is one."""
        if self.exists(path):
            raise Taken(path)
        self.settle(self.stage(path, [content]), path)

    def create_json(self, path: str, document: object) -> None:
        self.create(path, json.dumps(document, sort_keys=True, default=str).encode())

    def read_json(self, path: str):
        return json.loads(self.read(path))
