"""Alerts kept up to date from a folder of events: state by alert, and a log of what changes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tramline.functions.svc_time import epoch_seconds
from tramline.operators.selection import keep_last
from tramline.plans.alerts import EVENT, valid


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(EVENT).json(folder).withColumn("_seen", F.col("_metadata.file_modification_time"))


_STATE = "seen timestamp"
_CHANGE = "id string, seen timestamp, gone boolean, event string"


def _follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """What changes for one alert: its newest version, or that its time is over."""
    change = lambda seen, gone, event: pd.DataFrame({"id": [key[0]], "seen": pd.to_datetime([seen]), "gone": [gone], "event": [event]})
    if state.hasTimedOut:
        (seen,) = state.get
        state.remove()
        yield change(seen, True, None)
        return
    newest = None
    for frame in frames:
        own = frame.sort_values(["_seen", "event"]).iloc[-1]
        if newest is None or (own["_seen"], own["event"]) > (newest["_seen"], newest["event"]):
            newest = own
    if newest is None or state.exists and pd.Timestamp(state.get[0]) > newest["_seen"]:
        return
    known, ends = state.exists, newest["ends"]
    if not pd.isna(ends) and int(ends) <= state.getCurrentWatermarkMs():
        if known:
            state.remove()
            yield change(newest["_seen"], True, None)
        return
    state.update((newest["_seen"].to_pydatetime(),))
    # a state without a time to end at waits for a day that doesn't come
    state.setTimeoutTimestamp(NEVER_MS if pd.isna(ends) else int(ends))
    yield change(newest["_seen"], False, newest["event"])


#: The end of an alert that has none: the year 9999.
NEVER_MS = 253_370_764_800_000


def changes(events: DataFrame, late: str = "0 seconds") -> DataFrame:
    """(id, seen, gone, event as JSON) of a stream of events: new versions of alerts, and alerts whose end is over.

    State is kept by alert, and holds when its last version was seen. Time goes by what is seen: an alert ends when
    something is seen that is later than its end by ``late``.
    """
    fields = [f.name for f in events.schema if f.name != "_seen"]
    own = valid(events).select("id", "_seen", F.to_json(F.struct(*fields)).alias("event"), (epoch_seconds(F.col("end")) * 1000).cast("double").alias("ends"))
    return own.withWatermark("_seen", late).groupBy("id").applyInPandasWithState(_follow, _CHANGE, _STATE, "update", GroupStateTimeout.EventTimeTimeout)


def current(spark: SparkSession, state: str) -> DataFrame:
    """The events of the alerts in force, from the changes below a folder."""
    log = spark.read.schema(f"{_CHANGE}, batch int").parquet(state)
    last = keep_last(log, "id", ["batch"]).where("NOT gone")
    return last.select(F.from_json("event", EVENT).alias("e")).select("e.*")


def run(spark: SparkSession, folder: str, state: str, publish: Callable[[DataFrame], None], checkpoint: str, once: bool = True, late: str = "0 seconds") -> StreamingQuery:
    """Follows a folder of events: each batch writes what has changed below ``state`` and gives it to ``publish``.

    A batch reads and writes changes alone, so it costs what is new, however many alerts are in force; ``current`` has all
    of these. A batch that is run again after a failure writes the same again.
    """

    def batch(made: DataFrame, number: int) -> None:
        path = f"{state}/batch={number}"
        made.write.mode("overwrite").parquet(path)
        publish(spark.read.schema(_CHANGE).parquet(path))

    writer = changes(event_stream(spark, folder), late).writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()


def rates(events: DataFrame, stamp: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by type and tumbling window; late ones are counted until the watermark passes."""
    return events.withWatermark(stamp, late).groupBy(F.window(stamp, width), "event_type").agg(F.count("*").alias("n"))
