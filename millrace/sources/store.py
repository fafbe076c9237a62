"""Stored tables that change by key bucket: copy-on-write files, and one manifest that names the current files of all tables.

A table's rows lie in buckets by a hash of their key. A batch reads and writes anew only the buckets that its rows fall into, under its own
version; what it leaves alone stays where earlier versions wrote it. The manifest says for each table and bucket which version holds it. It is
renamed into place once all tables are written, so a reader sees all of a batch or nothing of it, and a batch that is killed leaves
the tables as they were. A batch that runs again starts from the same manifest and takes its own place.

    path/<table>/v=<version>/__bucket=<k>/*.parquet      path/_manifest/<version>.json
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import _fs


@dataclass(frozen=True)
class Spec:
    """A stored table: its columns as DDL or a schema, its key, and in how many buckets it lies."""

    columns: str | T.StructType
    keys: tuple[str, ...]
    buckets: int = 16


class Store:
    def __init__(self, spark: SparkSession, path: str, specs: dict[str, Spec]):
        self.spark, self.path, self.specs = spark, path, specs

    # What is there

    def versions(self) -> list[str]:
        """Committed versions, oldest first."""
        fs, at = _fs(self.spark, f"{self.path}/_manifest")
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(n.removesuffix(".json") for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self, before: str | None = None) -> dict[str, dict[str, str]]:
        """Table to bucket to version, of the last version, or of the last below `before`; empty where there is none."""
        found = [v for v in self.versions() if before is None or v < before]
        if not found:
            return {name: {} for name in self.specs}
        fs, at = _fs(self.spark, f"{self.path}/_manifest/{found[-1]}.json")
        stream = fs.open(at)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def schema(self, table: str) -> T.StructType:
        columns = self.specs[table].columns
        return columns if isinstance(columns, T.StructType) else T.StructType.fromDDL(columns)

    def read(self, table: str, manifest: dict | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a table, of all buckets or of some; files of other buckets are not listed."""
        at = (manifest or self.manifest()).get(table, {})
        paths = [f"{self.path}/{table}/v={v}/__bucket={b}" for b, v in sorted(at.items()) if buckets is None or int(b) in set(buckets)]
        return self.spark.read.schema(self.schema(table)).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema(table))

    def bucket(self, table: str) -> Column:
        spec = self.specs[table]
        return F.pmod(F.xxhash64(*spec.keys), F.lit(spec.buckets)).cast("int")

    def of_keys(self, table: str, keys: DataFrame, manifest: dict | None = None) -> DataFrame:
        """The stored rows of the buckets that these keys (columns as the table's key) fall into."""
        return self.read(table, manifest, self.touched(table, keys))

    def touched(self, table: str, rows: DataFrame) -> list[int]:
        """The buckets that rows fall into: at most as many numbers as the table has buckets."""
        return sorted(r[0] for r in rows.select(self.bucket(table)).distinct().collect())

    # Changes

    def write(self, table: str, version: str, manifest: dict, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], **counts: Column) -> tuple[dict[str, str], dict]:
        """Merge changes into the buckets that they fall into; merge(stored rows of these buckets, changes) gives their new rows, with any columns
        besides the table's, which `counts` (aggregates, taken on the way) may use. Returns the table's part of the next manifest, and
        the counts with `buckets`, the number of buckets written. changes have to be the same when they are computed twice."""
        touched = self.touched(table, changes)
        if not touched:
            return dict(manifest.get(table, {})), {"buckets": 0, **dict.fromkeys(counts, 0)}
        merged = merge(self.read(table, manifest, touched), changes)
        seen = Observation()
        rows = merged.observe(seen, F.count(F.lit(1)).alias("__rows"), *[c.alias(k) for k, c in counts.items()])
        rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema(table)]).withColumn("__bucket", self.bucket(table))
        at = f"{self.path}/{table}/v={version}"
        rows.hint("rebalance", F.col("__bucket")).write.mode("overwrite").partitionBy("__bucket").parquet(at)
        fs, folder = _fs(self.spark, at)
        there = {n.removeprefix("__bucket=") for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.startswith("__bucket=")}
        stays = {b: v for b, v in manifest.get(table, {}).items() if int(b) not in set(touched)}
        return stays | dict.fromkeys(sorted(there), version), {"buckets": len(touched), **{k: seen.get[k] for k in counts}}

    def commit(self, version: str, files: dict[str, dict[str, str]]) -> None:
        """Make the files of all tables the current ones, at once."""
        fs, target = _fs(self.spark, f"{self.path}/_manifest/{version}.json")
        _, draft = _fs(self.spark, f"{self.path}/_manifest/.{version}.draft")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(files).encode()))
        finally:
            stream.close()
        if fs.exists(target):  # the same batch, run again
            fs.delete(target, False)
        if not fs.rename(draft, target):
            raise OSError(f"version {version} could not be committed")

    def vacuum(self, keep: int = 1) -> int:
        """Delete the bucket folders that none of the last `keep` versions names, and the manifests before those; the number of folders deleted.
        Not while a batch is under way: files without a manifest go too."""
        versions = self.versions()
        needed = {(t, v, b) for k in versions[-keep:] for t, at in self._named(k).items() for b, v in at.items()}
        gone = 0
        for table in self.specs:
            fs, top = _fs(self.spark, f"{self.path}/{table}")
            for folder in fs.listStatus(top) if fs.exists(top) else ():
                version = folder.getPath().getName().removeprefix("v=")
                for part in fs.listStatus(folder.getPath()):
                    name = part.getPath().getName()
                    if name.startswith("__bucket=") and (table, version, name.removeprefix("__bucket=")) not in needed:
                        gone += bool(fs.delete(part.getPath(), True))
        for v in versions[:-keep]:
            fs, at = _fs(self.spark, f"{self.path}/_manifest/{v}.json")
            fs.delete(at, False)
        return gone

    def _named(self, version: str) -> dict:
        return self.manifest(before=version + "~")
