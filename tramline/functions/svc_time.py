"""Service-day times: seconds after midnight of the service day, hours without an upper limit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400


def to_seconds(clock: Column) -> Column:
    """Seconds of an H:MM:SS text; null unless it has exactly three whole numbers.

    The text is looked at once, so an expression that makes it is not evaluated again for each number.
    """
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("s"))
    step = lambda a, part: F.struct((a["n"] + 1).alias("n"), F.when(a["n"] < 3, a["s"] * 60 + part.try_cast("int")).otherwise(a["s"]).alias("s"))
    return F.aggregate(F.split(F.trim(clock), ":"), start, step, lambda a: F.when(a["n"] == 3, a["s"]))


def to_clock(seconds: Column) -> Column:
    """HH:MM:SS of seconds; 25:10:00 is ten past one of the next day."""
    s = seconds.cast("bigint")
    return F.when(s.isNotNull(), F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60))


def clock_difference(start: Column, end: Column) -> Column:
    """Seconds from one HH:MM to another, over midnight if the second is smaller."""
    minutes = lambda c: F.get(F.split(c, ":"), F.lit(0)).try_cast("int") * 60 + F.get(F.split(c, ":"), F.lit(1)).try_cast("int")
    gap = (minutes(end) - minutes(start)) * 60
    return F.when(gap < 0, gap + DAY).otherwise(gap)


def per_stop_seconds(start: Column, end: Column, stops: Column, default: int = 180, most: int = 900) -> Column:
    """Average seconds between stops of a run from first to last clock time; the default outside (0, most)."""
    average = F.try_divide(clock_difference(start, end).cast("double"), (stops - 1).cast("double"))
    return F.when((average > 0) & (average < most), average).otherwise(F.lit(float(default)))


def epoch_seconds(stamp: Column) -> Column:
    """Unix seconds of an RFC 3339 text with an offset; null if it can't be read."""
    return F.unix_seconds(F.try_to_timestamp(stamp)).cast("bigint")


def headway_seconds(text: Column) -> Column:
    """Seconds of a headway in minutes: '2.1', a range '3.6-5' (mean), a list '2.5 / 4' (mean); null if unreadable.

    Notes in brackets and behind # or ~ are dropped; the result is truncated.
    """
    bare = F.trim(F.regexp_replace(F.regexp_replace(text, r"\([^)]*\)", ""), r"[#~].*$", ""))
    listed = F.transform(F.split(bare, "/"), lambda x: F.trim(x).try_cast("double"))
    ranged = F.transform(F.split(bare, "-"), lambda x: F.trim(x).try_cast("double"))
    mean = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x) / F.size(xs)
    minutes = F.when(bare.contains("/"), mean(listed)).when(bare.contains("-"), F.when(F.size(ranged) == 2, mean(ranged))).otherwise(bare.try_cast("double"))
    return (minutes * 60).cast("int")


def seconds_over(kilometres: Column, detour: float = 1.5, speed: float = 25.0) -> Column:
    """Seconds for a distance as the crow flies, with a detour factor, at a speed in km/h."""
    return kilometres * (detour * 3600 / speed)
