"""The incremental run as Structured Streaming: changes, dedupe, merges and expiry."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues)

from listflow.functions import dates, keys
from listflow.operators import changes, filters
from listflow.streaming import slices

_CHANGES = "fingerprint string, pos long, change string, content_hash string"
_TRACKED = "fingerprint string, start_ms long, status string"

#: Buckets of keys in the state of :func:`stream_changes_keyed`; another number needs a new checkpoint.
_BUCKETS = 65_536
#: Segments of a bucket before they are merged.
_SEGMENTS = 16

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def epoch_ms(c: Column) -> Column:
    """Milliseconds since the epoch of Pacific wall-clock time."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", start, dates.utc_from_pacific(c))


def with_event_time(stream: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermark on an instant made from a wall-clock column, whatever the session zone."""
    return stream.withColumn("seen_at", F.timestamp_millis(epoch_ms(F.col(column)))).withWatermark(
        "seen_at", delay)


def _first_copies(batch: DataFrame) -> DataFrame:
    """The rows a batch run would hash: normalized, the first of every source key."""
    return changes.with_keys(filters.dedupe_same_source(filters.normalize_listing(batch)))


def change_step(as_of: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """One run over a batch: the next fingerprint state, with ``change`` and ``pos`` of the rows
    the batch brought (null for the rest). One join gives the answer and the state."""
    now = dates.as_ntz(as_of)

    def step(current: DataFrame, batch: DataFrame) -> DataFrame:
        c = current.alias("c")
        b = _first_copies(batch).select("fingerprint", "content_hash", "pos").alias("b")
        seen = F.col("b.pos").isNotNull()
        return c.join(b, "fingerprint", "full_outer").select(
            "fingerprint", "c.canonical_id",
            F.coalesce("b.content_hash", "c.content_hash").alias("content_hash"),
            F.coalesce("c.first_seen", now).alias("first_seen"),
            F.when(seen, now).otherwise(F.col("c.last_seen")).alias("last_seen"),
            F.when(seen, F.when(F.col("c.content_hash").isNull(), "new").when(
                F.col("c.content_hash") != F.col("b.content_hash"), "changed")
                .otherwise("unchanged")).alias("change"),
            F.col("b.pos").alias("pos"))

    return step


def stream_changes(listings: DataFrame, state: str, checkpoint: str, initial: DataFrame,
                   as_of: str) -> str:
    """Run everything that landed against the state; :func:`read_changes` gives what was found."""
    return stream_merge(listings, state, checkpoint, initial, change_step(as_of))


def read_changes(spark: SparkSession, state: str) -> DataFrame:
    """New and changed listings of every batch, with the batch's ``version``; the state is not read."""
    return spark.read.parquet(f"{state}/changes").select("version", "fingerprint", "pos", "change", "content_hash")


class _Changes(StatefulProcessor):
    """The last content hash of each key of a bucket; a row where a key's first one of a batch differs.

    A batch appends what it found as one segment; of a key's hashes the last one counts. Segments are
    merged when half of what they hold is out of date, or when there are many.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._known = handle.getListState("known", "fingerprints array<string>, hashes array<string>")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        first = {}
        for _, fingerprint, pos, content_hash in rows:
            at = float("-inf") if pos is None else pos
            if fingerprint not in first or at < first[fingerprint][0]:
                first[fingerprint] = at, pos, content_hash
        segments = [*self._known.get()]
        known = {}
        for fingerprints, hashes in segments:
            known.update(zip(fingerprints, hashes))
        changed = {f: h for f, (_, _, h) in first.items() if h != known.get(f)}
        for f, h in changed.items():
            yield Row(fingerprint=f, pos=first[f][1], change="new" if known.get(f) is None else "changed", content_hash=h)
        if changed:
            known.update(changed)
            held = len(changed) + sum(len(s[0]) for s in segments)
            if held > 2 * len(known) or len(segments) >= _SEGMENTS:
                self._known.put([([*known], [*known.values()])])
            else:
                self._known.appendValue(([*changed], [*changed.values()]))

    def close(self) -> None:
        pass


def stream_changes_keyed(listings: DataFrame) -> DataFrame:
    """The same answer from keyed state, for small continuous batches over a large state.

    A key's rows of one batch are streamed through and only the first in input order is kept,
    as a run keeps the first of its same-source duplicates. State is held by bucket of keys: all keys
    that a batch brings to a bucket share its exchanges with the state. A checkpoint whose state is
    held by key is refused.
    """
    keyed = changes.with_keys(filters.normalize_listing(listings)).select(
        slices.slice_of("fingerprint", _BUCKETS).alias("bucket"), "fingerprint", "pos", "content_hash")
    return keyed.groupBy("bucket").transformWithState(_Changes(), _CHANGES, "Append", "None")


def stream_dedupe(listings: DataFrame, delay: str = "12 hours") -> DataFrame:
    """One record per source key within the watermark; ``listings`` has an event time."""
    keyed = listings.withColumn("source_key", F.coalesce(F.nullif("source_id", F.lit("")), "url"))
    return keyed.dropDuplicatesWithinWatermark(["source", "source_key"])


class _Track(StatefulProcessor):
    """The start of each tracked key, with a timer where its lead falls below the floor."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._tracked = handle.getValueState("tracked", "start_ms long, floor_ms long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        last = max(rows, key=lambda r: r.start_ms)
        known = self._tracked.get() if self._tracked.exists() else None
        if known is not None:
            self._handle.deleteTimer(known[1])
        if last.floor_ms <= timerValues.getCurrentWatermarkInMs():
            self._tracked.clear()
            yield Row(fingerprint=key[0], start_ms=last.start_ms, status="too_late")
            return
        self._tracked.update((last.start_ms, last.floor_ms))
        self._handle.registerTimer(last.floor_ms)
        if known is None:
            yield Row(fingerprint=key[0], start_ms=last.start_ms, status="tracked")

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        start = self._tracked.get()[0]
        self._tracked.clear()
        yield Row(fingerprint=key[0], start_ms=start, status="expired")

    def close(self) -> None:
        pass


def expire_late(listings: DataFrame, floor_days: int = 2) -> DataFrame:
    """Track dated listings until their lead falls below the floor, then let the state go.

    ``listings`` has an event time; a timer per key fires when the watermark passes the floor.
    """
    start = epoch_ms(F.col("start_dt"))
    keyed = listings.filter("start_dt is not null").select(
        keys.fingerprint(F.col("source"), F.col("source_id")).alias("fingerprint"),
        start.alias("start_ms"), (start - floor_days * 86_400_000).alias("floor_ms"), "seen_at")
    return keyed.groupBy("fingerprint").transformWithState(_Track(), _TRACKED, "Append", "EventTime")


def run_available(stream: DataFrame, out: str, checkpoint: str) -> str:
    """Process everything that has landed, append it to ``out``, and stop. Keyed state is kept in RocksDB."""
    conf = stream.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKSDB)
    try:
        query = (stream.writeStream.format("parquet").outputMode("append")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))
        query.awaitTermination()
    finally:
        conf.unset(_PROVIDER) if before is None else conf.set(_PROVIDER, before)
    return out


def _listing_keys(batch: DataFrame) -> DataFrame:
    return changes.with_keys(filters.normalize_listing(batch))


def stream_merge(stream: DataFrame, path: str, checkpoint: str, initial: DataFrame,
                 merge: Callable[[DataFrame, DataFrame], DataFrame], key: str = "fingerprint",
                 keyed: Callable[[DataFrame], DataFrame] = _listing_keys, n_slices: int = slices.SLICES) -> str:
    """Apply a merge per micro-batch to the state in hash slices of ``key`` (``streaming/slices.py``).

    ``merge(current, batch)`` gives the new rows of the slices that the batch's keys, as ``keyed`` has
    them, fall into; all other slices stay as they are. A batch that is run again after a failure
    makes the same version again; a lost checkpoint goes on from the newest version.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        slices.advance(path, initial, batch, keyed(batch), key, merge, run, batch_id, n_slices)

    query = (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return path


def merge_seen(as_of: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Fingerprint merge of a batch of listings."""
    def merge(current: DataFrame, batch: DataFrame) -> DataFrame:
        seen = _first_copies(batch).select(
            "fingerprint", "content_hash", F.lit(None).cast("string").alias("canonical_id"))
        return changes.merge_fingerprints(current, seen, as_of)

    return merge
