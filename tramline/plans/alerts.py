"""Service alerts: events to the entities of a realtime feed, and that feed's bytes."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.svc_time import epoch_seconds

#: Columns of an event.
EVENT = (
    "id string, type string, header map<string,string>, description map<string,string>, url map<string,string>, route_ids array<string>, stop_ids array<string>,"
    " trip_ids array<string>, start string, end string, cause string, effect string, replacement_stop_id string"
)
#: Fixed effects of the event types that name none.
DEFAULT_EFFECT = {"stop_moved": "STOP_MOVED", "stop_closed": "NO_SERVICE", "detour": "DETOUR", "modified_service": "MODIFIED_SERVICE", "network_notice": "UNKNOWN_EFFECT", "accessibility_notice": "ACCESSIBILITY_ISSUE"}
#: Fixed numbers of causes and effects in the public realtime format.
CAUSES = {"UNKNOWN_CAUSE": 1, "OTHER_CAUSE": 2, "TECHNICAL_PROBLEM": 3, "STRIKE": 4, "DEMONSTRATION": 5, "ACCIDENT": 6, "HOLIDAY": 7, "WEATHER": 8, "MAINTENANCE": 9, "CONSTRUCTION": 10, "POLICE_ACTIVITY": 11, "MEDICAL_EMERGENCY": 12}
EFFECTS = {"NO_SERVICE": 1, "REDUCED_SERVICE": 2, "SIGNIFICANT_DELAYS": 3, "DETOUR": 4, "ADDITIONAL_SERVICE": 5, "MODIFIED_SERVICE": 6, "OTHER_EFFECT": 7, "UNKNOWN_EFFECT": 8, "STOP_MOVED": 9, "NO_EFFECT": 10, "ACCESSIBILITY_ISSUE": 11}


def _map(values: dict) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def valid(events: DataFrame) -> DataFrame:
    """Events with an id, a known type and times that hold a 'T'."""
    timed = lambda c: F.col(c).isNull() | F.col(c).contains("T")
    return events.where(F.col("id").isNotNull() & F.col("type").isin(*DEFAULT_EFFECT) & timed("start") & timed("end"))


def _texts(column: Column) -> Column:
    """Texts by language, blank ones left out."""
    entries = F.filter(F.map_entries(F.coalesce(column, F.create_map().cast("map<string,string>"))), lambda e: F.coalesce(e["value"], F.lit("")) != "")
    return F.array_sort(F.transform(entries, lambda e: F.struct(e["key"].alias("language"), e["value"].alias("text"))))


def entities(events: DataFrame) -> DataFrame:
    """One alert for each event: active period, cause, effect, texts and selectors.

    An event without ids is network-wide: one empty selector. A moved or closed
    stop with a replacement gets a hint if there is no English description.
    """
    none = F.lit(None).cast("string")
    selector = lambda **ids: F.struct(*((ids.get(k, none)).alias(k) for k in ("route_id", "stop_id", "trip_id")))
    listed = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    chosen = F.concat(F.transform(listed("route_ids"), lambda x: selector(route_id=x)), F.transform(listed("stop_ids"), lambda x: selector(stop_id=x)), F.transform(listed("trip_ids"), lambda x: selector(trip_id=x)))
    effect = F.coalesce("effect", _map(DEFAULT_EFFECT)[F.col("type")], F.lit("OTHER_EFFECT"))
    cause = F.when(F.col("cause").isNotNull(), F.when(F.col("cause").isin(*CAUSES), F.col("cause")).otherwise("OTHER_CAUSE"))
    hint = F.col("replacement_stop_id").isNotNull() & F.col("type").isin("stop_moved", "stop_closed") & (F.coalesce(F.try_element_at("description", F.lit("en")), F.lit("")) == "")
    said = _texts(F.col("description"))
    hinted = F.concat(said, F.array(F.struct(F.lit("en").alias("language"), F.concat(F.lit("Use replacement stop "), F.col("replacement_stop_id"), F.lit(".")).alias("text"))))
    start, end = epoch_seconds(F.col("start")), epoch_seconds(F.col("end"))
    return events.select(
        "id",
        F.struct(start.alias("start"), end.alias("end")).alias("active_period"),
        cause.alias("cause"),
        F.when(effect.isin(*EFFECTS), effect).otherwise("OTHER_EFFECT").alias("effect"),
        _texts(F.col("header")).alias("header_text"),
        F.when(hint, hinted).otherwise(said).alias("description_text"),
        _texts(F.col("url")).alias("url"),
        F.when(F.size(chosen) > 0, chosen).otherwise(F.array(selector())).alias("informed_entity"),
    )


def in_feed_order(alerts: DataFrame) -> DataFrame:
    """By start, those without one first, then id."""
    return alerts.orderBy(F.coalesce(F.col("active_period.start"), F.lit(0)), "id")


# -- the feed's bytes -----------------------------------------------------------------------------


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | str | int) -> bytes:
    """One field of the protocol-buffer wire format: numbers as varints, all else by length."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    raw = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(raw)) + raw


def _translated(texts) -> bytes:
    return b"".join(_field(1, _field(1, t["text"]) + _field(2, t["language"])) for t in texts)


def alert_bytes(row) -> bytes:
    """An alert entity in the public realtime format."""
    period = row["active_period"]
    alert = _field(1, b"".join(_field(n, period[k]) for n, k in ((1, "start"), (2, "end")) if period[k] is not None))
    for chosen in row["informed_entity"]:
        selector = b""
        if chosen["route_id"] is not None:
            selector += _field(2, chosen["route_id"])
        if chosen["trip_id"] is not None:
            selector += _field(4, _field(1, chosen["trip_id"]))
        if chosen["stop_id"] is not None:
            selector += _field(5, chosen["stop_id"])
        alert += _field(5, selector)
    if row["cause"] is not None:
        alert += _field(6, CAUSES[row["cause"]])
    alert += _field(7, EFFECTS[row["effect"]])
    for number, name in ((8, "url"), (10, "header_text"), (11, "description_text")):
        if row[name]:
            alert += _field(number, _translated(row[name]))
    return _field(1, row["id"]) + _field(5, alert)


#: Bytes of a part of the feed, about.
PART = 1 << 20


def feed_parts(alerts: DataFrame, most: int = PART) -> DataFrame:
    """(part): the alerts' messages in feed order, several in a row. A message of repeated fields is the bytes of its parts, one after another."""

    def encode(batches):
        made, long = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                made.append(_field(2, alert_bytes(row)))
                long += len(made[-1])
                if long >= most:
                    yield pa.RecordBatch.from_pydict({"part": pa.array([b"".join(made)], pa.binary())})
                    made, long = [], 0
        if made:
            yield pa.RecordBatch.from_pydict({"part": pa.array([b"".join(made)], pa.binary())})

    return in_feed_order(alerts).mapInArrow(encode, "part binary")


def feed_chunks(alerts: DataFrame, timestamp: int, most: int = PART) -> Iterator[bytes]:
    """The whole feed, a full data set, a piece at a time: tasks encode the alerts, and the driver holds the parts of one task."""
    yield _field(1, _field(1, "2.0") + _field(2, 0) + _field(3, timestamp))
    for row in feed_parts(alerts, most).toLocalIterator():
        yield bytes(row["part"])


def feed_bytes(alerts: DataFrame, timestamp: int) -> bytes:
    return b"".join(feed_chunks(alerts, timestamp))


def write_feed(alerts: DataFrame, timestamp: int, path: str) -> None:
    """The feed as a file, which is put in its place when it is whole."""
    with open(f"{path}.part", "wb") as file:
        file.writelines(feed_chunks(alerts, timestamp))
    os.replace(f"{path}.part", path)
