"""Alerts for follow-ups that are missing, as a stateful stream: a view opens an obligation, a sale in time cancels it.

Events come in batches and out of order. W(b), the clock of batch b, is the largest event time of the batches before b less a slack; an
event of batch b before W(b) is late. The others are applied for each client in the order of their times over all batches, so they wait
until the clock has passed them.

One streaming query does this in two steps, each turn:

1. Slots: an operator with state by the row API of transformWithState. Events are dealt by client and hour, so a client with a third of all
   rows lies on every task. A MapState holds a list of events for each hour slot. Timers on the watermark drain the slots below W in order
   and split the one that W lies in. Within a slot all that matters of a client's events is constant in size: the views before the first
   sale, that sale, the views after the last.
2. Obligations: the sink of the query (foreachBatch) folds these by client, at most a few for each client and hour, into the open obligations
   that the turn before has written, raises those whose time is over, and writes what stays open as the table of its turn. A turn that is
   done again writes its table again.

The second step keeps its state in tables, not in an operator: Spark opens a state store for each operator, partition and start, whatever it
holds, and does not free the native counters of a store it has closed (RocksDB's Statistics, 0.5 MB each with 8 cores).

A group of either step is a bucket of clients, and what travels between them is packed, since a call to the state store for each client
would cost more than all else. The watermark is Spark's own: the event time less the slack, over all batches so far, kept in the
checkpoint. Spark counts it in milliseconds, so the time column is stretched by 1,000: a millisecond of the watermark is a microsecond of W.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from .common import delete, shared_dir
from .hashing import mix

HOUR = 3_600_000_000
BATCHES, HOURS, SHIFT = 12, 3648, 80
SLACK_HOURS, WAIT_HOURS = 48, 24
#: Events of a bucket of clients, in all batches together.
BUCKET_ROWS = 100_000
#: A time after all others (in the year 2261), by which the stream ends.
END = 9_200_000_000_000_000
_DRAINED = "bucket int, clock long, runs binary, late binary"
_TURN = "bucket int, batch int, open binary, client_id array<long>, opened_us array<long>, due_us array<long>, n_rows array<long>"
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A store is closed when its task ends, so that the stores of one start are gone before the next; no disk is kept in advance.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # The files of a store go through Hadoop's FileSystem, which starts no process for a local file as FileContext does; its file systems have
    # checksums of their own.
    "spark.sql.streaming.checkpointFileManagerClass": "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager",
    "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",  # one turn a start, but for the last
}


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970; a timestamp without a zone is read as UTC, whatever the session's zone."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.unix_micros(c)
    seconds = F.unix_date(c.cast("date")).cast("long") * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def batch_of(arrived_us: Column, key: str, batches: int = BATCHES, hours: int = HOURS, shift: int = SHIFT, start_us: int = 1_704_067_200_000_000) -> Column:
    """The batch of a row by its arrival, moved by up to three times `shift` hours by its id. Arrivals before the start are in the first
    batch, rows without an arrival or an id in the last."""
    whole = F.floor((arrived_us - F.lit(start_us)) / HOUR) + F.lit(shift) * (F.crc32(F.col(key).cast("string").cast("binary")) % 4)
    return F.greatest(F.lit(0), F.least(F.lit(batches - 1), F.floor(whole * batches / hours))).cast("int")


def shop_events(clicks: DataFrame, sales: DataFrame) -> DataFrame:
    """batch, client_id, t_us, sale (boolean): views, rows equal in all columns once, and sales; rows without a client or a time are
    no events."""
    views = clicks.where("kind = 'view' and client_id is not null and ts is not null").distinct()
    views = views.select(batch_of(micros(views, "arrived_at"), "click_id").alias("batch"), F.col("client_id").cast("long"), micros(views, "ts").alias("t_us"), F.lit(False).alias("sale"))
    sold = sales.where("client_id is not null and sold_at is not null")
    sold = sold.select(batch_of(micros(sold, "arrived_at"), "sale_id").alias("batch"), F.col("client_id").cast("long"), micros(sold, "sold_at").alias("t_us"), F.lit(True).alias("sale"))
    return views.unionByName(sold)


def _pack(*columns: np.ndarray) -> bytes:
    return np.column_stack(columns).astype("<i8").tobytes() if len(columns[0]) else b""


def _unpack(parts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(parts), "<i8").reshape(-1, width)


def _edges(*keys: np.ndarray) -> np.ndarray:
    """Where a new group begins in rows sorted by these keys; the number of rows is not among them."""
    turn = np.zeros(len(keys[0]), bool)
    turn[:1] = True
    for k in keys:
        turn[1:] |= k[1:] != k[:-1]
    return np.nonzero(turn)[0]


def summary(client: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Rows (client, first, last, n) of the events (code: twice the time, and one for a sale) of whole slots or of the parts of a slot: the
    views before the first sale, that sale (n is 0), the views after the last one. Views between two sales of a slot are cancelled."""
    order = np.lexsort((code, client))
    client, code = client[order], code[order]
    t, sale = code >> 1, code & 1
    slot = t // HOUR
    begin = _edges(client, slot)
    if not len(begin):
        return np.zeros((0, 4), np.int64)
    length = np.diff(np.append(begin, len(t)))
    so_far = np.cumsum(sale)
    so_far -= np.repeat((so_far - sale)[begin], length)
    all_of = np.repeat(np.add.reduceat(sale, begin), length)
    keep = np.where(sale == 1, so_far == 1, (so_far == 0) | (so_far == all_of))
    part = np.where(sale == 1, 1, np.where(so_far == 0, 0, 2))[keep]
    client, slot, t, sale = client[keep], slot[keep], t[keep], sale[keep]
    begin = _edges(client, slot, part)
    end = np.append(begin[1:], len(t)) - 1
    return np.column_stack([client[begin], t[begin], t[end], np.where(sale[begin] == 1, 0, end - begin + 1)])


def fold(rows: np.ndarray, w: int, wait: int) -> tuple[np.ndarray, np.ndarray]:
    """(alerts, open) of rows (client, first, last, n), all before w: obligations that no sale cancelled, by whether their time is over."""
    order = np.lexsort((rows[:, 3] == 0, rows[:, 1], rows[:, 0]))
    client, first, last, n = rows[order].T
    sale = n == 0
    same = np.append(False, client[1:] == client[:-1])
    joins = ~sale & same & np.append(False, ~sale[:-1] & (first[1:] - last[:-1] <= wait))
    begin = np.nonzero(~sale & ~joins)[0]
    if not len(begin):
        return rows[:0], rows[:0]
    # A group ends before the next group or sale; what stands there may cancel it.
    group = np.cumsum(~sale & ~joins) - 1
    views = np.nonzero(~sale)[0]
    end = np.zeros(len(begin), np.int64)
    end[group[views]] = views
    total = np.bincount(group[views], n[views], len(begin)).astype(np.int64)
    due = last[end] + wait
    after = np.minimum(end + 1, len(client) - 1)
    follows = (end + 1 < len(client)) & (client[after] == client[end])
    cancelled = follows & sale[after] & (first[after] <= due)
    done = np.column_stack([client[begin], first[begin], last[end], total])
    over = due < w
    return done[~cancelled & over], done[~cancelled & ~over]


class Slots(StatefulProcessor):
    """Holds the events of a bucket until the clock has passed them."""

    def __init__(self, buckets: int, last_clock: int):
        self.buckets, self.last_clock = buckets, last_clock

    def init(self, handle) -> None:
        self.handle = handle
        self.slots = handle.getMapState("slots", "slot long", "events binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        w = timerValues.getCurrentWatermarkInMs()
        got = np.fromiter((x for r in rows for x in (r[1], r[2])), np.int64).reshape(-1, 2)
        if key[0] < 0:  # the row by which every batch has one tells the clock; that of the last batch tells it at the end, too
            if got[:, 1].max() >= 2 * END:
                self.handle.registerTimer(self.last_clock)
            yield Row(bucket=-1, clock=w, runs=b"", late=b"")
            return
        late = (got[:, 1] >> 1 < w) if w else np.zeros(len(got), bool)
        who, times = np.unique(got[late, 0], return_counts=True)
        yield from self._turn(w, got[~late], _pack(who, times))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        w = timerValues.getCurrentWatermarkInMs()
        if key[0] < 0:
            yield Row(bucket=-1, clock=w, runs=b"", late=b"")
        else:
            yield from self._turn(w, np.zeros((0, 2), np.int64), b"")

    def _turn(self, w: int, new: np.ndarray, late: bytes) -> Iterator[Row]:
        """Drain what is before w, take in what is new, and set the timer for the next event."""
        held = {k[0]: v[0] for k, v in self.slots.iterator()} if self.slots.exists() else {}
        below = sorted(s for s in held if s * HOUR < w)
        drained = _unpack([held[s] for s in below], 2)
        before = self._first(held)
        if below:
            self.slots.clear()
            for s in below:
                del held[s]
            stays = drained[drained[:, 1] >> 1 >= w]  # of the slot that w lies in
            drained = drained[drained[:, 1] >> 1 < w]
            if len(stays):
                held[below[-1]] = stays.astype("<i8").tobytes()
        changed = dict(held) if below else {}
        new = new[np.argsort(new[:, 1], kind="stable")]
        slot = (new[:, 1] >> 1) // HOUR
        begin = _edges(slot)
        for s, part in zip(slot[begin].tolist(), np.split(new, begin[1:]), strict=False):
            held[s] = changed[s] = held.get(s, b"") + part.astype("<i8").tobytes()
        for s, events in changed.items():
            self.slots.updateValue((s,), (events,))
        first = self._first(held)
        if first != before:
            if before is not None and before >= w:
                self.handle.deleteTimer(before + 1)
            if first is not None:
                self.handle.registerTimer(first + 1)  # a timer at the watermark fires: this one when W is past the event
        yield from self._sent(w, summary(drained[:, 0], drained[:, 1]), _unpack([late], 2))

    @staticmethod
    def _first(held: dict[int, bytes]) -> int | None:
        return int(_unpack([held[min(held)]], 2)[:, 1].min() >> 1) if held else None

    def _sent(self, w: int, runs: np.ndarray, late: np.ndarray) -> Iterator[Row]:
        """A row for each bucket of clients."""
        to = [(mix(x[:, 0].astype(np.uint64)) % np.uint64(self.buckets)).astype(np.int64) for x in (runs, late)]
        order = [np.argsort(k, kind="stable") for k in to]
        runs, late, to = runs[order[0]], late[order[1]], [k[o] for k, o in zip(to, order, strict=True)]
        for b in np.unique(np.concatenate(to)).tolist():
            x, y = (v[slice(*np.searchsorted(k, (b, b + 1)))] for v, k in ((runs, to[0]), (late, to[1])))
            yield Row(bucket=b, clock=w, runs=x.astype("<i8").tobytes(), late=y.astype("<i8").tobytes())

    def close(self) -> None:
        pass


def obligations(batch: int, w: int, wait: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """For the rows (bucket, runs, late) of a bucket of clients, what was open before among them: what stays open, alerts and late events."""

    def turn(rows: pd.DataFrame) -> pd.DataFrame:
        late = _unpack(rows["late"].tolist(), 2)
        who, at = np.unique(late[:, 0], return_inverse=True)
        none = np.full(len(who), -1)
        missed = np.column_stack([who, none, none, np.bincount(at, late[:, 1], len(who)).astype(np.int64)])
        alerts, still = fold(_unpack(rows["runs"].tolist(), 4), w, wait)
        alerts = alerts + np.array([0, 0, wait, 0])
        out = np.concatenate([alerts, missed])
        columns = dict(zip(("client_id", "opened_us", "due_us", "n_rows"), ([x.tolist()] for x in out.T), strict=True))
        return pd.DataFrame({"bucket": [int(rows["bucket"].iloc[0])], "batch": [batch], "open": [_pack(*still.T)], **columns})

    return turn


def _move(spark: SparkSession, source: str, target: str) -> None:
    at, to = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).rename(at, to):
        raise OSError(f"{source} could not be moved")


def missing_follow_ups(events: DataFrame, batches: int = BATCHES, slack_hours: int = SLACK_HOURS, wait_hours: int = WAIT_HOURS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """events: batch (int, 0 to batches - 1), client_id (long), t_us (long), sale (boolean), none of them null.

    Returns batch, client_id, opened_us, due_us, n_rows: a row per alert (the first batch whose clock is past due_us, or `batches`; n_rows: its
    views), and a row per batch and client with late events (-1, -1, their number). A view joins the open obligation of its client or opens
    one, which is open through due_us, wait_hours (at least one) after its latest view; a sale up to then cancels it; at one time views come
    first. Repeated rows count each. A table without rows gives none. Times have to lie between 1970-01-03 and the year 2261.

    Every call writes the batches to a new folder in the shared folder, then starts the query once for each batch on one checkpoint; the
    last start has a second turn for the end. A start that lost an executor goes on by Spark's retries, and one that fails raises its error."""
    if wait_hours < 1:
        raise ValueError("an obligation is open for an hour at least")
    spark = events.sparkSession
    base = f"{shared_dir(spark)}/follow-up-{uuid.uuid4().hex}"
    inside = F.greatest(F.lit(0), F.least(F.lit(END - 1), F.col("t_us")))
    rows = events.select("batch", "client_id", (F.shiftleft(inside, 1) + F.col("sale").cast("long")).alias("code"))
    # A row without a client in each batch: also a batch without events has its turn. The last one ends the stream.
    turns = spark.range(0, batches, 1, 1).select(F.col("id").cast("int").alias("batch"), F.lit(None).cast("long").alias("client_id"), F.when(F.col("id") == batches - 1, F.lit(2 * END)).otherwise(F.lit(0)).cast("long").alias("code"))
    rows.hint("rebalance", F.col("batch")).unionByName(turns).write.partitionBy("batch").parquet(f"{base}/staged")
    spark.createDataFrame([], "client_id long, code long").write.parquet(f"{base}/feed/none")  # the folder has to be there
    delete(spark, f"{base}/feed/none")
    n = spark.read.parquet(f"{base}/staged").count()
    buckets = max(16, -(-n // bucket_rows))
    wait = wait_hours * HOUR
    before = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for k, v in _SETTINGS.items():
        spark.conf.set(k, v)
    try:
        for b in range(batches):
            # Without new rows a turn follows only where the clock has moved on: after the last batch, to its end.
            spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(b == batches - 1).lower())
            _move(spark, f"{base}/staged/batch={b}", f"{base}/feed/batch={b}")
            _start(spark, base, buckets, slack_hours, wait)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    turned = spark.read.schema(_TURN).option("recursiveFileLookup", "true").parquet(f"{base}/turns")
    return turned.select("batch", F.inline(F.arrays_zip("client_id", "opened_us", "due_us", "n_rows")))


def _start(spark: SparkSession, base: str, buckets: int, slack_hours: int, wait: int) -> None:
    """Start the query for what has been added to its feed, and wait for its end."""
    fed = spark.readStream.schema("client_id long, code long").option("recursiveFileLookup", "true").parquet(f"{base}/feed")
    fed = fed.withColumn("clock", F.timestamp_millis(F.shiftright("code", 1))).withWatermark("clock", f"{slack_hours * 1000} hours")
    bucket = F.pmod(F.xxhash64("client_id", F.floor(F.shiftright("code", 1) / HOUR)), F.lit(buckets)).cast("int")
    # Late rows are told by the operator, which counts them: the time column stays below it.
    dealt = fed.select(F.when(F.col("client_id").isNull(), F.lit(-1)).otherwise(bucket).alias("bucket"), F.coalesce("client_id", F.lit(0)).cast("long").alias("client_id"), "code")
    runs = dealt.groupBy("bucket").transformWithState(Slots(buckets, END - slack_hours * HOUR), _DRAINED, "append", "eventTime")

    def turn(drained: DataFrame, number: int) -> None:
        """The turns are numbered as the batches are, the one after the last batch by `batches`: a start has one turn, but for the last."""
        drained.write.mode("overwrite").parquet(f"{base}/drained/{number}")
        new = spark.read.schema(_DRAINED).parquet(f"{base}/drained/{number}")
        rows = new.where("bucket >= 0").select("bucket", "runs", "late")
        if number:
            held = spark.read.schema(_TURN).parquet(f"{base}/turns/{number - 1}")
            rows = rows.unionByName(held.where("length(open) > 0").select("bucket", F.col("open").alias("runs"), F.lit(b"").alias("late")))
        fold_bucket = obligations(number, new.agg(F.max("clock")).first()[0], wait)
        rows.groupBy("bucket").applyInPandas(fold_bucket, _TURN).write.mode("overwrite").parquet(f"{base}/turns/{number}")
        delete(spark, f"{base}/drained/{number}")

    query = runs.writeStream.foreachBatch(turn).option("checkpointLocation", f"{base}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def op11_missing_follow_up_alerts(spark, sf_dir: str) -> DataFrame:
    return missing_follow_ups(shop_events(spark.read.parquet(f"{sf_dir}/clicks.parquet"), spark.read.parquet(f"{sf_dir}/sales.parquet")))


_CRC = """list_reduce(list_concat([4294967295], list_transform(string_split(CAST({id} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda r, c: xor(r >> 8, crc_table[CAST(xor(r, c) & 255 AS INTEGER) + 1]))"""
_BATCH = "greatest(0, least(11, floor((floor((epoch_us(arrived_at) - 1704067200000000) / 3600000000) + 80 * (xor({crc}, 4294967295) % 4)) * 12 / 3648)))"
SQL = {
    "op11_missing_follow_up_alerts": f"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce([CAST(n AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table),
events AS (
  SELECT CAST({_BATCH.format(crc=_CRC.format(id="click_id"))} AS INTEGER) AS batch, client_id, epoch_us(ts) AS t, 0 AS sale
  FROM (SELECT DISTINCT * FROM clicks WHERE kind = 'view' AND client_id IS NOT NULL AND ts IS NOT NULL), crc
  UNION ALL
  SELECT CAST({_BATCH.format(crc=_CRC.format(id="sale_id"))} AS INTEGER), client_id, epoch_us(sold_at), 1 FROM sales, crc WHERE client_id IS NOT NULL AND sold_at IS NOT NULL),
clock AS (SELECT CAST(b AS INTEGER) AS batch, (SELECT max(t) FROM events e WHERE e.batch < b) - 172800000000 AS w FROM range(12) x(b)),
timed AS (SELECT e.*, coalesce(e.t < c.w, false) AS late FROM events e JOIN clock c USING (batch)),
kept AS (SELECT client_id, t, sale, row_number() OVER (PARTITION BY client_id ORDER BY t, sale) AS k FROM timed WHERE NOT late),
near AS (SELECT *, lag(sale) OVER o AS before_sale, lag(t) OVER o AS before_t, lead(sale) OVER o AS next_sale, lead(t) OVER o AS next_t FROM kept WINDOW o AS (PARTITION BY client_id ORDER BY k)),
grouped AS (SELECT *, sum(CASE WHEN sale = 0 AND before_sale = 0 AND t - before_t <= 86400000000 THEN 0 ELSE 1 END) OVER (PARTITION BY client_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS g FROM near),
obligations AS (
  SELECT client_id, min(t) AS opened, max(t) + 86400000000 AS due, count(*) AS n, bool_or(coalesce(next_sale = 1 AND next_t <= t + 86400000000, false)) AS cancelled
  FROM grouped WHERE sale = 0 GROUP BY client_id, g)
SELECT CAST(coalesce((SELECT min(c.batch) FROM clock c WHERE c.w > o.due), 12) AS INTEGER) AS batch, client_id, opened AS opened_us, due AS due_us, n AS n_rows FROM obligations o WHERE NOT cancelled
UNION ALL
SELECT batch, client_id, CAST(-1 AS BIGINT), CAST(-1 AS BIGINT), count(*) FROM timed WHERE late GROUP BY batch, client_id""",
}
