"""What the operators share: tables in the shared folder, checked broadcasts, skew-safe joins, bounded batches."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a slim table (keys and a few numbers, under 64 bytes a row) that may be broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Groups that may be treated as hot, and so broadcast, at most.
HOT_GROUPS = 100_000

_own_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset on one machine, as in tests, a temporary
    folder; on a cluster, whose executors would write to disks of their own, an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if "dir" not in _own_dir:
            _own_dir["dir"] = tempfile.mkdtemp(prefix="millrace-")
            atexit.register(shutil.rmtree, _own_dir["dir"], ignore_errors=True)
        base = f"file://{_own_dir['dir']}"
    return f"{base.rstrip('/')}/millrace"


def materialize(df: DataFrame, tag: str = "t") -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage, survives the loss of executors."""
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(key, None)
    # The write's shuffle files are of no use once the table is there; Spark removes them when the write has ended.
    spark.conf.set(key, "true")
    try:
        df.select("*").write.parquet(path)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(df: DataFrame) -> None:
    """Delete a table of materialize() that nothing will read again."""
    delete(df.sparkSession, df._written_to)


def clean(spark: SparkSession) -> None:
    """Delete all tables of materialize(), those of other applications too: for the end of a job, when its results are stored."""
    delete(spark, shared_dir(spark))


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a written slim table, but only when its counted rows are within the bound; beyond it Spark joins by shuffle."""
    return F.broadcast(df) if df.count() <= max_rows else df


def join_skewed(left: DataFrame, right: DataFrame, on: str, size: str, how: str = "inner", hot_groups: int = HOT_GROUPS) -> DataFrame:
    """Join left rows to the one right row of their group without bringing a hot group together.

    right: one row per key, with the number of left rows of that key in column `size`. At most hot_groups keys can hold
    N / hot_groups rows or more, so those are broadcast; the rest are joined by shuffle and none of them is hot."""
    hot_min = max(1000, left.count() // hot_groups + 1)
    hot, cold = right.where(F.col(size) >= hot_min), right.where(F.col(size) < hot_min)
    near = left.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), on, "left")
    there = near.where("__hot").drop("__hot")
    rest = near.where("__hot is null").select(*left.columns)
    return there.unionByName(rest.join(cold, on, how))


def crc_mod(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % F.lit(n)


def _release() -> None:
    """Give memory that this worker no longer uses back to the machine: workers are kept for the stages that follow."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run):
    """run (a function of an iterator of batches), with small batches and the worker's unused memory released before and after."""
    small_batches(SparkSession.active())

    def tidied(batches):
        _release()
        try:
            yield from run(batches)
        finally:
            _release()

    return tidied


def small_batches(spark: SparkSession, limit: int = 8 << 20) -> None:
    """Batches for Python of at most `limit` bytes; a single longer text is a batch of its own. Plans read this setting when they run,
    so it stays with the session; one that is lower already is left as it is."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > limit:
        spark.conf.set(key, f"{limit}b")


def slices(texts, limit: int = 4_000_000):
    """(start, end) runs of a batch of texts with at most about `limit` characters; a single longer text is a run of its own."""
    start = total = 0
    for i, t in enumerate(texts):
        if i > start and total + len(t) > limit:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)


def batches_of_groups(frames, keys: list[str]):
    """From frames sorted by `keys`, frames that end at the end of a group: each holds whole groups only."""
    import pandas as pd

    held = []
    for f in frames:
        if not len(f):
            continue
        k = f[keys].to_numpy()
        last = (k == k[-1]).all(axis=1)
        if last.all():
            if held and (held[-1][keys].to_numpy()[-1] == k[-1]).all():
                held.append(f)
                continue
            if held:
                yield pd.concat(held, ignore_index=True)
            held = [f]
            continue
        cut = len(f) - int(last[::-1].argmin())
        held.append(f.iloc[:cut])
        yield pd.concat(held, ignore_index=True)
        held = [f.iloc[cut:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
