"""Dedup with a time to live in processing time: state of a stream that stays over runs, and counts its hits by tier.

A key that was seen is dropped until its time to live is over, counted from when it was first let through; then it passes again. The group of
the state is a bucket of keys, and the state store drops an entry by its own time to live. Within a micro-batch the first row of a key
passes; its repeats are hits of the batch, those of keys that earlier batches let through are hits of the state.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

#: What a query with such state needs; the session's own settings come back after its start (see with_state).
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    # State by processing time asks for another micro-batch without end, also where only what is there is to be read.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


class with_state:
    """The settings of a state store while queries start and run."""

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.before = {k: self.spark.conf.get(k, None) for k in SETTINGS}
        for k, v in SETTINGS.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *_):
        for k, v in self.before.items():
            self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)


class _Seen(StatefulProcessor):
    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.seen = handle.getMapState("seen", "key string", "hits long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        tiers: dict[str, str] = {}
        for r in rows:
            if r["key"] not in tiers:
                known = self.seen.containsKey((r["key"],))
                tiers[r["key"]] = "state" if known else "batch"
                if not known:  # an entry that is there keeps its own time
                    self.seen.updateValue((r["key"],), (0,))
                    yield Row(row=r["row"], tier="passed")
                    continue
            yield Row(row=r["row"], tier=tiers[r["key"]])

    def close(self) -> None:
        pass


def tiers_with_ttl(df: DataFrame, keys: list[str], ttl_ms: int, buckets: int = 64) -> DataFrame:
    """A stream's rows with `tier`: passed, batch (a repeat within the micro-batch) or state (let through by an earlier batch less than ttl_ms
    milliseconds ago). Null keys are equal. Columns go along as they are."""
    packed = df.select(
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"),
        F.to_json(F.array(*[F.col(k).cast("string") for k in keys])).alias("key"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("row"),
    )
    out = packed.groupBy("bucket").transformWithState(_Seen(ttl_ms), "row string, tier string", "append", "processingTime")
    return out.select(F.from_json("row", df.schema).alias("row"), "tier").select("row.*", "tier")
