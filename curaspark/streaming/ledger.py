"""The ledger over Structured Streaming: arrivals, new-only items, late events, state by submission."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENT = T.StructType([T.StructField("submission", T.LongType()), T.StructField("reviewer", T.LongType()), T.StructField("at", T.TimestampType()), T.StructField("seq", T.LongType()), T.StructField("kind", T.StringType())])


def read_events(spark: SparkSession, folder: str, schema: T.StructType = EVENT) -> DataFrame:
    """Files of events as they arrive; the checkpoint remembers which were read."""
    return spark.readStream.schema(schema).parquet(folder)


def new_only(events: DataFrame, key: list[str], delay: str = "60 days") -> DataFrame:
    """Items not seen before within the watermark; the seen list is the operator's state."""
    return events.withWatermark("at", delay).dropDuplicatesWithinWatermark(key)


def latest_verdicts(events: DataFrame) -> DataFrame:
    """The latest verdict by event time in update mode; an older one that comes late changes nothing."""
    last = events.groupBy("submission", "reviewer").agg(F.max_by(F.struct("kind", "at"), F.struct("at", "seq")).alias("v"))
    return last.select("submission", "reviewer", "v.kind", "v.at")


def review_state_stream(events: DataFrame, moves: dict[str, tuple[str, ...]], leads_to: dict[str, str], delay: str = "1 hour") -> DataFrame:
    """(submission, state, refused) after each batch; events of a submission are held until the watermark
    has passed them, so that they are folded in order of event time however they arrive."""

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, refused, held = state.get if state.exists else ("received", 0, [])
        held = [tuple(x) for x in held]
        for frame in frames:
            held += [(t.value // 1000, int(s), k) for t, s, k in zip(frame["at"], frame["seq"], frame["kind"])]
        mark = state.getCurrentWatermarkMs() * 1000
        ready = sorted(x for x in held if x[0] <= mark)
        for _, _, kind in ready:
            to = leads_to.get(kind)
            if now in moves.get(to, ()):
                now = to
            elif to != now and kind != "received":
                refused += 1
        held = [x for x in held if x[0] > mark]
        state.update((now, refused, held))
        if held:
            state.setTimeoutTimestamp(max(min(held)[0] // 1000, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame({"submission": [key[0]], "state": [now], "refused": [refused]})

    marked = events.withWatermark("at", delay)
    return marked.groupBy("submission").applyInPandasWithState(
        fold, "submission long, state string, refused long", "state string, refused long, held array<struct<at:long,seq:long,kind:string>>", "update", GroupStateTimeout.EventTimeTimeout
    )


def _due_processor(hold_ms: int, dormant_ms: int):
    """Made here, so that it travels with its plan and executors need no copy of this package."""
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    class Due(StatefulProcessor):
        """Value state: the newest event, approval and objection by (time, seq), what was told last and how often."""

        def init(self, handle) -> None:
            self.handle = handle
            self.state = handle.getValueState("ledger", "last long, approved long, approved_seq long, objected long, objected_seq long, told string, turn long")

        def _told(self, key, state, now: int):
            last, approved, approved_seq, objected, objected_seq, told, turn = state
            stands = approved is not None and (objected is None or (objected, objected_seq) < (approved, approved_seq))
            action = "publish" if stands and now >= approved + hold_ms else "dormant" if now >= last + dormant_ms else None
            if now >= last + dormant_ms:
                # nothing is waited for any more: what is silent for so long holds no state
                self.state.clear()
            else:
                self.state.update((last, approved, approved_seq, objected, objected_seq, action, turn + (action != told)))
                for due in ([approved + hold_ms] if stands else []) + [last + dormant_ms]:
                    if due > now:
                        self.handle.registerTimer(due)
            changed = [(key[0], action, now, turn + 1)] if action != told else []
            return pd.DataFrame(changed, columns=["submission", "action", "as_of", "turn"])

        def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
            old = self.state.get() if self.state.exists() else None
            last, approved, approved_seq, objected, objected_seq, told, turn = old or (None, None, None, None, None, None, 0)
            for frame in rows:
                for at, seq, kind in zip(frame["at"], frame["seq"], frame["kind"]):
                    at = at.value // 1_000_000
                    last = at if last is None else max(last, at)
                    if kind == "approve" and (approved is None or (approved, approved_seq) < (at, seq)):
                        approved, approved_seq = at, int(seq)
                    if kind in ("hold", "retract") and (objected is None or (objected, objected_seq) < (at, seq)):
                        objected, objected_seq = at, int(seq)
            yield self._told(key, (last, approved, approved_seq, objected, objected_seq, told, turn), timerValues.getCurrentWatermarkInMs())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
            if self.state.exists():
                yield self._told(key, self.state.get(), timerValues.getCurrentWatermarkInMs())

        def close(self) -> None:
            pass

    return Due()


def due_actions_stream(events: DataFrame, hold_hours: int, dormant_days: int, delay: str = "1 hour") -> DataFrame:
    """(submission, action, as_of, turn): what is due, told whenever it changes: publish once an approval has stood for its hold without a
    later objection, dormant once nothing has happened for so long; null where a later event takes it back.

    Event-time timers fire when the watermark passes a hold or a silence, so an action comes without any further event of its
    submission. State is one row for each submission with an event in the last ``dormant_days``; what is silent for longer is let go.
    The session needs the RocksDB state store (``with_timers``).
    """
    marked = events.withWatermark("at", delay)
    return marked.groupBy("submission").transformWithStateInPandas(_due_processor(hold_hours * 3_600_000, dormant_days * 86_400_000), "submission long, action string, as_of long, turn long", "Append", "EventTime")


@contextmanager
def with_timers(spark: SparkSession):
    """The state store that timers need, as long as the block runs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, was) if was else spark.conf.unset(name)


def replay(events: DataFrame, transform, batches: int, until: str, delay: str, shuffle_by: str = "seq") -> DataFrame:
    """A stored ledger run through a streaming operator in ``batches`` files dealt by a hash, so in no order of time, then
    up to a point in time; the rows that the operator told, read back from the shared folder."""
    from curaspark.operators.shared import shared_folder

    spark, folder = events.sparkSession, shared_folder(events.sparkSession)
    columns = [f.name for f in EVENT]
    rows = events.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT])
    for k in range(batches):
        rows.filter(F.pmod(F.xxhash64(shuffle_by), F.lit(batches)) == k).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    end = spark.range(1).select(F.lit(-1).cast("long").alias("submission"), F.lit(-1).cast("long").alias("reviewer"), (F.lit(until).cast("timestamp") + F.expr(f"interval {delay}")).alias("at"), F.lit(-1).cast("long").alias("seq"), F.lit("end").alias("kind"))
    end.select(*columns).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    told = transform(stream, delay)
    run = told.writeStream.format("parquet").option("checkpointLocation", f"{folder}/progress").option("path", f"{folder}/out").outputMode("append").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(told.schema).parquet(f"{folder}/out").filter("submission <> -1")
