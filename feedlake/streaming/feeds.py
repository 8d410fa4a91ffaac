"""Structured Streaming forms of the poll loop: incremental ingest, first-seen dedup, windowed
mention counts.

Every query runs with trigger(availableNow=True) on the table path itself, be it one file or a folder of
part files. `table` and `checkpoint` name the output and the offsets; a job that is run again with the
same two resumes and reads only new files. Without them a fresh pair under the shared checkpoint
folder is taken, which replays the whole history. A replay reads all files in one micro-batch unless
`max_files` is given, so that no watermark passes between files that are not in time order.
Outputs are parquet tables (exactly-once file sink / idempotent foreachBatch merges), which a
batch query then reads.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from feedlake.operators import snapshots as SN
from feedlake.operators import state as ST
from feedlake.session import is_folder, scratch_path


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """The table as a file stream; its schema is the batch table's. A folder is read as it is; Spark streams
    folders only, so a table that is one file is read as that file of its folder."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    reader = reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _events_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    return table_stream(spark, sf_dir, "events", max_files).withColumn("ts", F.col("ts").cast("timestamp"))


def _places(spark: SparkSession, name: str, table: str | None, checkpoint: str | None) -> tuple[str, str]:
    """Given places, or fresh ones under the shared checkpoint folder."""
    return table or scratch_path(spark, f"{name}-table"), checkpoint or scratch_path(spark, f"{name}-offsets")


def ingest_events(spark: SparkSession, sf_dir: str, table: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """H1: file source -> parquet sink, availableNow; returns the sink table."""
    out, ck = _places(spark, "ingest", table, checkpoint)
    q = (_events_stream(spark, sf_dir).select("event_id", "user_id", "event_type", "ts")
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def first_seen_stream(spark: SparkSession, sf_dir: str, buckets: int = 16, table: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """H2: per micro-batch, keep-first per user, then insert-if-absent into a versioned seen
    table: only the buckets the micro-batch touches are read and rewritten, a batch is committed
    whole or not at all, and one replayed after a failure changes nothing."""
    table, ck = _places(spark, "seen", table, checkpoint)
    if not SN.exists(spark, table):
        SN.create(spark, table, spark.createDataFrame([], "user_id long, event_id long, ts timestamp"), "user_id", buckets)

    def merge(batch: DataFrame, epoch_id: int) -> None:
        SN.merge(batch.sparkSession, table, batch.select("user_id", "event_id", "ts"), ["ts", "event_id"], mode="keep_first")

    q = (_events_stream(spark, sf_dir).writeStream.foreachBatch(merge)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return SN.read(spark, table)


def _origin_seconds(spark: SparkSession, origin: str, days: int) -> int:
    """F.window is aligned to the Unix epoch: the origin's offset within a window, in seconds."""
    return int(spark.range(1).select(F.pmod(F.unix_timestamp(F.lit(origin).cast("timestamp")), F.lit(days * 86400))).first()[0])


def windowed_counts(spark: SparkSession, sf_dir: str, days: int = 7, watermark: str = "1 day",
                    origin: str | None = None, max_files: int | None = None, table: str | None = None,
                    checkpoint: str | None = None) -> DataFrame:
    """H3: tumbling `days`-day windows aligned to `origin` (default: midnight of the first
    event, read once from the static table), per event type, with a watermark for late rows.

    Update mode: each micro-batch emits only the windows it changed, with their running
    counts, and the watermark lets the state store drop closed windows (state stays bounded on
    an endless stream). The sink is an update log partitioned by micro-batch id; a replayed
    micro-batch overwrites its own partition (dynamic overwrite), so the log is exactly-once.
    Readers take the last update per (event_type, bin_start) with a keep-last aggregate. Gap
    filling is done at read time (see operators.mentions)."""
    if origin is None:
        first = spark.read.parquet(os.path.join(sf_dir, "events.parquet")).agg(F.min("ts")).first()[0]
        origin = first.strftime("%Y-%m-%d 00:00:00")
    offset_s = _origin_seconds(spark, origin, days)
    ev = _events_stream(spark, sf_dir, max_files).withWatermark("ts", watermark)
    agg = (ev.groupBy(F.window("ts", f"{days} days", f"{days} days", f"{offset_s} seconds").alias("w"), "event_type")
           .agg(F.count(F.lit(1)).alias("n")))
    log, ck = _places(spark, "mentions", table, checkpoint)

    def append(batch: DataFrame, epoch_id: int) -> None:
        rows = batch.select("event_type", F.col("w.start").alias("bin_start"), "n", F.lit(epoch_id).cast("long").alias("_epoch"))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_epoch").parquet(log))

    q = (agg.writeStream.outputMode("update").foreachBatch(append)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return read_window_counts(spark, log)


def read_window_counts(spark: SparkSession, log: str) -> DataFrame:
    """Current counts from the update log: the last update per (event_type, bin_start)."""
    schema = "event_type string, bin_start timestamp, n long, _epoch long"
    updates = spark.read.schema(schema).parquet(log)
    return ST.keep_last(updates, ["event_type", "bin_start"], ["_epoch"]).select("event_type", "bin_start", "n")


def closed_window_counts(spark: SparkSession, events: DataFrame, origin: str, table: str, checkpoint: str, days: int = 7,
                         watermark: str = "1 day") -> tuple[DataFrame, int]:
    """H3 in append mode: counts of a stream `events` (ts, event_type) by window and type, written once, when the
    watermark has passed the window's end, so that no reader ever sees a count that changes. Returns the table
    (event_type, bin_start, n) so far, and how many rows of this run came too late for a window already closed.

    Null times and types: a row without ts is in no window and counts as late; null is a type of its own. The state is
    the open windows' counts; the watermark and the state go on where the run before stopped. Late rows are what the run
    read less what it counted (in closed windows or open ones): Spark's own metric counts partial sums, not rows."""
    offset_s = _origin_seconds(spark, origin, days)
    schema = "event_type string, bin_start timestamp, n long"
    closed = spark.read.schema(schema).parquet(table) if _exists(spark, table) else spark.createDataFrame([], schema)
    counted = closed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + _open_rows(spark, checkpoint)
    agg = (events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type").withWatermark("ts", watermark)
           .groupBy(F.window("ts", f"{days} days", f"{days} days", f"{offset_s} seconds").alias("w"), "event_type")
           .agg(F.count(F.lit(1)).alias("n")))
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "1000000")  # the progress of every micro-batch of this run, each some KB
    try:
        q = (agg.select("event_type", F.col("w.start").alias("bin_start"), "n").writeStream.outputMode("append").format("parquet")
             .option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
        read = sum(p.numInputRows for p in q.recentProgress)
    finally:
        spark.conf.set(kept, before)
    closed = spark.read.schema(schema).parquet(table)
    now = closed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + _open_rows(spark, checkpoint)
    return closed, read - (now - counted)


def _open_rows(spark: SparkSession, checkpoint: str) -> int:
    """Rows counted in windows that are still open, read from the state itself."""
    if not _exists(spark, f"{checkpoint}/commits/0"):
        return 0
    return spark.read.format("statestore").load(checkpoint).agg(F.coalesce(F.sum("value.count"), F.lit(0))).first()[0]


PAYLOAD_SCHEMA = "url string, fetched_at timestamp, payload string"


def ingest_feed_payloads(spark: SparkSession, landing: str, table: str, seen_path: str, ck: str,
                         limit: int = 3, hash_len: int = 40, buckets: int = 16, max_files: int = 16):
    """H1 + H2 over feed payloads: the poll loop as a stream.

    The landing folder receives JSON lines (url, fetched_at, payload), one per fetched feed.
    Each micro-batch is routed and parsed (RSS / Atom / JSON), keyed (hash of link, else title),
    deduplicated keep-first within the batch, filtered against the seen snapshot, appended to
    the items table (partition per micro-batch, overwritten on replay) and inserted into the
    seen snapshot. Returns the started query (availableNow)."""
    from feedlake.sources import feeds as FD

    if not SN.exists(spark, seen_path):
        SN.create(spark, seen_path, spark.createDataFrame([], "url_hash string, url string, first_seen timestamp"), "url_hash", buckets)
    stream = spark.readStream.schema(PAYLOAD_SCHEMA).option("maxFilesPerTrigger", max_files).json(landing)

    def step(batch: DataFrame, epoch_id: int) -> None:
        s = batch.sparkSession
        items = FD.with_item_keys(FD.feed_items(batch.select("url", "payload"), limit), hash_len)
        first = ST.keep_first(items, "url_hash", ["feed_url", "entry_pos"])
        fresh = ST.unseen(first, SN.read(s, seen_path)).withColumn("_epoch", F.lit(epoch_id).cast("long"))
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_epoch").parquet(table)
        written = s.read.parquet(table).where(F.col("_epoch") == epoch_id)
        SN.merge(s, seen_path, written.select("url_hash", F.col("link").alias("url"), F.current_timestamp().alias("first_seen")),
                 ["first_seen"], mode="keep_first")

    return (stream.writeStream.foreachBatch(step).option("checkpointLocation", ck)
            .trigger(availableNow=True).start())


def _exists(spark: SparkSession, path: str) -> bool:
    from feedlake.session import path_exists
    return path_exists(spark, path)


def keyword_mention_stream(spark: SparkSession, sf_dir: str, keywords: DataFrame, days: int = 7,
                           max_files: int | None = None, table: str | None = None,
                           checkpoint: str | None = None) -> DataFrame:
    """Streaming mention series: the documents table as a file stream; each micro-batch's articles are
    matched against the static keywords by the batch operator (operators.mentions, any number of keywords)
    and counted per keyword in `days`-day bins aligned to the archive's first midnight. The log holds one
    partition of partial counts for each micro-batch, overwritten on replay; readers add them up. Gap fill
    happens at read time, so the result equals the batch series (keyword, bin_start, mentions)."""
    from feedlake.functions import dates as D
    from feedlake.functions import text as T
    from feedlake.operators import mentions as MN
    from feedlake.sources import tables as TB

    kw = keywords.select("keyword").distinct().withColumn("kw", F.lower("keyword"))
    docs = os.path.join(sf_dir, "documents.parquet")
    static = spark.read.parquet(docs)
    ts_of = lambda c: D.parse_published(TB.published_text(TB.true_published(F.col(c)), F.col("lang")))
    b = static.agg(F.min(ts_of("doc_id")).alias("o"), F.max(ts_of("doc_id")).alias("m")).first()
    if b["o"] is None:
        return kw.select("keyword", F.lit(None).cast("timestamp").alias("bin_start"), F.lit(0).cast("long").alias("mentions")).limit(0)
    origin = b["o"].replace(hour=0, minute=0, second=0, microsecond=0)
    width = days * 86400
    last_bin = origin + dt.timedelta(seconds=int((b["m"] - origin).total_seconds() // width) * width)
    log, ck = _places(spark, "keyword-mentions", table, checkpoint)
    words = f"{log}-keywords"
    if not _exists(spark, words):  # written once; every micro-batch reads it
        kw.write.parquet(words)
    kw = spark.read.schema("keyword string, kw string").parquet(words)
    title = T.cut(T.first_line("text"), 80)
    start = F.lit(origin.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")

    def append(batch: DataFrame, epoch_id: int) -> None:
        arts = batch.select(T.search_text(title, T.cut("text", 800), F.col("text")).alias("text"), D.bin_start(ts_of("doc_id"), start, days).alias("bin_start"))
        counts = MN.contains_counts(arts, kw.select("kw"), carry=["bin_start"]).withColumn("_epoch", F.lit(epoch_id).cast("long"))
        counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_epoch").parquet(log)

    (table_stream(spark, sf_dir, "documents", max_files).writeStream.foreachBatch(append).option("checkpointLocation", ck)
     .trigger(availableNow=True).start().awaitTermination())
    counts = spark.read.schema("kw string, bin_start timestamp, n long, _epoch long").parquet(log).groupBy("kw", "bin_start").agg(F.sum("n").alias("n"))
    spine = kw.withColumn("bin_start", F.explode(F.sequence(
        F.lit(origin.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"),
        F.lit(last_bin.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"), F.expr(f"INTERVAL {days} DAYS"))))
    return (spine.join(counts, ["kw", "bin_start"], "left")
            .select("keyword", "bin_start", F.coalesce("n", F.lit(0)).cast("long").alias("mentions")))


def first_seen_within_watermark(spark: SparkSession, sf_dir: str, watermark: str = "7 days", table: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """H2 with bounded state: dropDuplicatesWithinWatermark on the key, so a key's state expires
    once the watermark passes it (the unbounded variant above never forgets, like the original
    seen table). Within one micro-batch the surviving row for a key is the first one read, not
    necessarily the earliest; use first_seen_stream when the earliest row must win."""
    out, ck = _places(spark, "seen-watermark", table, checkpoint)
    q = (_events_stream(spark, sf_dir).withWatermark("ts", watermark)
         .dropDuplicatesWithinWatermark(["user_id"]).select("user_id", "event_id", "ts")
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema("user_id long, event_id long, ts timestamp").parquet(out)


SEEN_SCHEMA = "user_id long, event_id long, ts timestamp"


class FirstSeen(StatefulProcessor):
    """The earliest row of a key, by (ts, event_id). A key's state is four numbers, however many rows it has.

    A timer just after the earliest time so far gives the row out once the watermark has passed it, when none can come before.
    A second timer, `forget_ms` after the latest time, ends the state of a key that has fallen silent: its next row is
    a first one again."""

    def __init__(self, forget_ms: int):
        self.forget_ms = forget_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("seen", "first_us long, event_id long, last_us long, given boolean")

    def handleInputRows(self, key, rows, timerValues):
        first = last = None
        for r in rows:
            at = (r.us, r.event_id)
            first = at if first is None or at < first else first
            last = r.us if last is None or r.us > last else last
        given = False
        if self.state.exists():
            first_us, event_id, last_us, given = self.state.get()
            first, last = (first_us, event_id) if given else min(first, (first_us, event_id)), max(last, last_us)
            self._timers(self.handle.deleteTimer, (first_us, last_us), given)
        self.state.update((*first, last, given))
        self._timers(self.handle.registerTimer, (first[0], last), given)
        return iter(())

    def _timers(self, act, times, given) -> None:
        if not given:
            act(times[0] // 1000 + 1)
        act(times[1] // 1000 + self.forget_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.state.exists():
            return
        first_us, event_id, last_us, given = self.state.get()
        if not given:
            self.state.update((first_us, event_id, last_us, True))
            yield Row(user_id=key[0], event_id=event_id, us=first_us)
        if expiredTimerInfo.getExpiryTimeInMs() >= last_us // 1000 + self.forget_ms:
            self.state.clear()

    def close(self) -> None:
        pass


def first_seen_with_expiry(spark: SparkSession, events: DataFrame, table: str, checkpoint: str, watermark: str = "1 day",
                           forget_days: int = 365) -> DataFrame:
    """H2 with state of its own for each key (RocksDB, event-time timers): the earliest row of each user of a stream
    `events` (user_id, event_id, ts), whatever the order of the rows within the watermark; given out once, when the
    watermark has passed it. A run with the same table and checkpoint goes on where the last one stopped.

    A user silent for `forget_days` before the watermark is forgotten. Rows without ts or event_id are left out; a null
    user_id is a user. Users first seen after the watermark are given out by a later run."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    rows = (events.select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts")).where("ts IS NOT NULL AND event_id IS NOT NULL")
            .withWatermark("ts", watermark).withColumn("us", F.unix_micros("ts")))
    first = rows.groupBy("user_id").transformWithState(FirstSeen(forget_days * 86_400_000), "user_id long, event_id long, us long", "append", "eventTime")
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        q = (first.select("user_id", "event_id", F.timestamp_micros("us").alias("ts")).writeStream.outputMode("append").format("parquet")
             .option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.unset(provider) if before is None else spark.conf.set(provider, before)
    return spark.read.schema(SEEN_SCHEMA).parquet(table)
