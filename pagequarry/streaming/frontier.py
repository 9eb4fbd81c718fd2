"""A frontier of work as keyed state: what is pending, who holds it for how long, and what became of it."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor

#: Seconds after which what is held counts as given up.
LEASE = 900
TOLD = "url string, at timestamp, seq long, event string, granted boolean, state string, attempts int, claimed_at timestamp"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def step(held: tuple | None, event: str, at: float, lease: float = LEASE) -> tuple[tuple | None, bool]:
    """(state, attempts, claimed at) after an event, and whether the event took effect.

    add puts in what is new, claim takes what is pending or was held for longer than the lease, done and fail close
    what was put in, whoever holds it; what is closed can't be claimed, as can't what was never put in.
    """
    if event == "add":
        return (held, False) if held else (("pending", 0, None), True)
    if held is None:
        return None, False
    state, attempts, claimed = held
    if event == "claim":
        free = state == "pending" or (state == "in_progress" and claimed < at - lease)
        return (("in_progress", attempts + 1, at), True) if free else (held, False)
    if event in ("done", "fail"):
        return ({"done": "done", "fail": "failed"}[event], attempts, claimed), True
    return held, False


class Frontier(StatefulProcessor):
    """One value for each URL, and a timer for each lease, which puts back what is still held when it has run out.

    Claims of one URL are settled in the one place that has its state, so no two are granted within a lease. A timer
    fires when the watermark has passed it; a claim that comes before that finds the lease run out by itself.
    """

    def __init__(self, lease: int = LEASE):
        self.lease = lease

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "state string, attempts int, claimed double")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = tuple(self.held.get()) if self.held.exists() else None
        for row in sorted(rows, key=lambda r: (r.at, r.seq)):
            at = row.at.timestamp()
            held, took = step(held, row.event, at, self.lease)
            if took and row.event == "claim":
                self.handle.registerTimer(int((at + self.lease) * 1000) + 1)
            yield Row(url=key[0], at=row.at, seq=row.seq, event=row.event, granted=took, state=held[0] if held else None, attempts=held[1] if held else None, claimed_at=_time(held))
        if held:
            self.held.update(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state, attempts, claimed = tuple(self.held.get()) if self.held.exists() else (None, None, None)
        due = expiredTimerInfo.getExpiryTimeInMs()
        if state == "in_progress" and int((claimed + self.lease) * 1000) + 1 == due:
            self.held.update(("pending", attempts, None))
            yield Row(url=key[0], at=_stamp(due / 1000), seq=None, event="expired", granted=True, state="pending", attempts=attempts, claimed_at=None)

    def close(self) -> None:
        pass


def _stamp(seconds: float):
    from datetime import datetime

    return datetime.fromtimestamp(seconds)


def _time(held):
    return _stamp(held[2]) if held and held[2] is not None else None


@contextmanager
def rocks(spark: SparkSession):
    """Streams that start in here keep their state in RocksDB, as timers and typed values need; the setting is put back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def settled(events: DataFrame, lease: int = LEASE, late: str = "0 seconds") -> DataFrame:
    """The stream of what each event (url, at, seq, event) came to, and of leases that ran out; TOLD has its columns."""
    return events.withWatermark("at", late).groupBy("url").transformWithState(Frontier(lease), TOLD, "Append", "EventTime")


def replay(spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str, lease: int = LEASE, files: int = 1) -> DataFrame:
    """Runs through the files of a folder, so many at a time or all at once if 0, those that no earlier call has; returns what all calls wrote.

    Files that come one after the other must follow each other in time, as what is older than the watermark goes.
    """
    with rocks(spark):
        reader = spark.readStream.schema(schema)
        events = (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(source)
        run = settled(events, lease).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
        run.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(TOLD).parquet(sink)
