"""Tables that are changed bucket by bucket: an upsert rewrites what its keys hit, and a commit is one small file.

A table is a folder. Rows lie below data/<write>/__bucket=<n>, by the hash of their keys; versions/<number>.json names the
write that holds each bucket. A reader takes the newest version when it begins and reads only files that the version names, which no
later commit changes: it sees a whole table, the old or the new one. A job that dies leaves a write that no version names; vacuum()
deletes it. All work on rows is Spark's; the driver sees numbers of buckets and names of writes, both bounded by `buckets`."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.session import materialize, release

BUCKET = "__bucket"


class Conflict(Exception):
    """Another writer committed the version that was to be the next."""


@dataclass(frozen=True)
class Version:
    """What a commit says: parts maps a bucket to the write that holds it; buckets without rows are absent."""

    number: int
    keys: tuple[str, ...]
    buckets: int
    schema: T.StructType
    parts: dict[int, str]


class _Files:
    """The few calls on files of the driver, on any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self.hadoop, self.gateway = jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
        self.io, root = jvm.org.apache.commons.io.IOUtils, jvm.org.apache.hadoop.fs.Path(path)
        self.system = root.getFileSystem(spark._jsc.hadoopConfiguration())
        self.context = self.hadoop.FileContext.getFileContext(self.system.getUri(), spark._jsc.hadoopConfiguration())
        self.root = self.system.makeQualified(root).toString()

    def at(self, name: str):
        return self.hadoop.Path(f"{self.root}/{name}")

    def names(self, folder: str) -> list[str]:
        path = self.at(folder)
        return [s.getPath().getName() for s in self.system.listStatus(path)] if self.system.exists(path) else []

    def text(self, name: str) -> str:
        stream = self.system.open(self.at(name))
        try:
            return self.io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a file whole or not at all; one that is there already is a Conflict."""
        made, target = self.at(f"{name}.{uuid.uuid4().hex}.new"), self.at(name)
        stream = self.system.create(made, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        rename = self.hadoop.Options.Rename
        none = self.gateway.new_array(rename, 1)
        none[0] = rename.NONE
        try:
            self.context.rename(made, target, none)
        except Exception as error:
            self.system.delete(made, False)
            if self.system.exists(target):
                raise Conflict(name) from error
            raise

    def delete(self, name: str) -> None:
        self.system.delete(self.at(name), True)


class BucketTable:
    """A table at path whose rows are found by keys.

    Keys decide the bucket by xxhash64, so buckets are even however skewed the values are, as long as a key has few rows; null keys have a
    bucket as well. A bucket should be what a task holds: table bytes / 128 MB or so buckets, fixed when the table is made."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.files = spark, _Files(spark, path)

    @classmethod
    def create(cls, rows: DataFrame, path: str, keys: list[str], buckets: int = 64) -> BucketTable:
        """A new table of rows, as version 0. Rows need not be there (an empty table), keys must be columns."""
        if BUCKET in rows.columns or not keys or set(keys) - set(rows.columns) or buckets < 1:
            raise ValueError(f"keys must be columns, buckets positive, and no column {BUCKET}")
        table = cls(rows.sparkSession, path)
        table._commit(Version(0, tuple(keys), buckets, rows.schema, table._write(rows, tuple(keys), buckets, rows.schema)))
        return table

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names("versions") if n.endswith(".json"))

    def version(self, number: int | None = None) -> Version:
        """That version, or the newest one."""
        if number is None:
            number = (self.versions() or [0])[-1]
        said = json.loads(self.files.text(f"versions/{number:010d}.json"))
        return Version(number, tuple(said["keys"]), said["buckets"], T.StructType.fromJson(said["schema"]), {int(b): w for b, w in said["parts"].items()})

    def read(self, number: int | None = None, buckets: set[int] | None = None) -> DataFrame:
        """The rows of a version (the newest when this is called), of all or some buckets."""
        return self._read(self.version(number), buckets)

    def bucket(self, version: Version) -> Column:
        return _bucket(version.keys, version.buckets, version.schema)

    def upsert(self, incoming: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], attempts: int = 5) -> Version:
        """Commit merge(old, new) for the buckets that keys of incoming hit; all others keep their files.

        old has the table's rows of those buckets, new is incoming; the result has the table's columns, and rows it leaves out are gone. A key
        that is not of a hit bucket must not come out of merge: this is an error. Without incoming rows nothing is
        committed. If another writer was first, the commit is made on top of its version where it left the hit buckets alone, else
        merge is called again on what it wrote, `attempts` times in all."""
        new = materialize(incoming, "incoming")
        try:
            seen = self.version()
            hit = {r[0] for r in new.select(self.bucket(seen)).distinct().collect()}  # at most as many as there are buckets
            for _ in range(attempts if hit else 0):
                parts = self._write(merge(self._read(seen, hit), new), seen.keys, seen.buckets, seen.schema)
                if strays := set(parts) - hit:
                    raise ValueError(f"merge gave keys of other buckets: {sorted(strays)[:5]}")
                while True:
                    now = self.version()
                    if any(now.parts.get(b) != seen.parts.get(b) for b in hit):
                        break
                    kept = {b: w for b, w in now.parts.items() if b not in hit}
                    try:
                        return self._commit(Version(now.number + 1, now.keys, now.buckets, now.schema, kept | parts))
                    except Conflict:
                        continue
                seen = now
            if hit:
                raise Conflict(f"others changed the same buckets {attempts} times")
            return seen
        finally:
            release(new)

    def replace(self, rows: DataFrame, check: Callable[[DataFrame], object] | None = None) -> Version:
        """Commit rows (the table's columns) as all there is; readers see the old table until then. A Conflict if another
        writer was first. check is given the rows as they were written, before the commit; if it raises, the table stays."""
        seen = self.version()
        new = Version(seen.number + 1, seen.keys, seen.buckets, seen.schema, self._write(rows, seen.keys, seen.buckets, seen.schema))
        if check is not None:
            check(self._read(new))
        return self._commit(new)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete all but the newest `keep` versions and writes that none of them names; the names of these writes.

        Not while a writer is at work or a reader holds an older version: their files would go."""
        numbers = self.versions()
        used = {w for n in numbers[-keep:] for w in self.version(n).parts.values()}
        for n in numbers[:-keep]:
            self.files.delete(f"versions/{n:010d}.json")
        gone = sorted(set(self.files.names("data")) - used)
        for w in gone:
            self.files.delete(f"data/{w}")
        return gone

    def _read(self, version: Version, buckets: set[int] | None = None) -> DataFrame:
        folders = [f"{self.files.root}/data/{w}/{BUCKET}={b}" for b, w in sorted(version.parts.items()) if buckets is None or b in buckets]
        if not folders:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*folders)

    def _write(self, rows: DataFrame, keys: tuple[str, ...], buckets: int, schema: T.StructType) -> dict[int, str]:
        """The buckets of rows and the write that holds them. One shuffle by bucket, which adaptive execution splits or
        joins to even tasks."""
        if sorted(rows.columns) != sorted(schema.names):
            raise ValueError(f"columns {rows.columns} are not those of the table: {schema.names}")
        rows, write = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]), uuid.uuid4().hex
        rows.withColumn(BUCKET, _bucket(keys, buckets, schema)).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(self.files.at(f"data/{write}").toString())
        return {int(n.removeprefix(f"{BUCKET}=")): write for n in self.files.names(f"data/{write}") if n.startswith(f"{BUCKET}=")}

    def _commit(self, version: Version) -> Version:
        said = {"keys": version.keys, "buckets": version.buckets, "schema": version.schema.jsonValue(), "parts": version.parts}
        self.files.create(f"versions/{version.number:010d}.json", json.dumps(said))
        return version


def _bucket(keys: tuple[str, ...], buckets: int, schema: T.StructType) -> Column:
    """Keys are hashed in the types of the table, as a hash differs between an int and a long."""
    return F.pmod(F.xxhash64(*[F.col(k).cast(schema[k].dataType) for k in keys]), F.lit(buckets)).cast("int")
