"""Headways, intervals and sequences of trips. Times are seconds of the service day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

DAY = 86_400


def gap(second: Column, order: WindowSpec) -> Column:
    """Seconds to the next departure; the last keeps the gap before it, a single one lasts a day."""
    following, before = F.lead(second).over(order), F.lag(second).over(order)
    return F.when(following.isNotNull(), following - second).when(before.isNotNull(), second - before).otherwise(DAY)


def headways(departures: DataFrame, trip: str, second: str) -> DataFrame:
    """(trip, start, end, headway) between consecutive distinct departures.

    The last departure keeps the gap before it; a single one lasts a day.
    """
    one = departures.where(F.col(second).isNotNull()).select(trip, second).distinct()
    gaps = one.select(trip, F.col(second).alias("start"), gap(F.col(second), Window.partitionBy(trip).orderBy(second)).alias("headway"))
    return gaps.select(trip, "start", (F.col("start") + F.col("headway")).alias("end"), "headway")


def coalesce_intervals(intervals: DataFrame, trip: str, start: str = "start", end: str = "end", headway: str = "headway") -> DataFrame:
    """Intervals of a trip that don't overlap: those of one headway that meet are joined, others end where the next begins.

    Rows are unique by (trip, start).
    """
    order = Window.partitionBy(trip).orderBy(start)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    runs = intervals.withColumn("_turn", F.when(F.lag(headway).over(order) == F.col(headway), 0).otherwise(1)).withColumn("_run", F.sum("_turn").over(order))
    # runs and islands are numbered upwards, so the greatest pair is of the latest; all windows share one order
    reached = runs.withColumn("_reached", F.max(F.struct("_run", F.col(end).alias("_end"))).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    meets = (F.col("_reached._run") == F.col("_run")) & (F.col(start) <= F.col("_reached._end"))
    broken = reached.withColumn("_break", F.when(meets, 0).otherwise(1)).withColumn("_island", F.sum("_break").over(order))
    marked = broken.withColumns({"_start": F.max(F.when(F.col("_break") == 1, F.col(start))).over(so_far), "_end": F.max(F.struct("_island", F.col(end).alias("_end"))).over(so_far)["_end"], "_next": F.lead("_island").over(order)})
    islands = marked.where("_next IS NULL OR _next <> _island").withColumn("_following", F.lead("_start").over(order))
    return islands.select(trip, F.col("_start").alias(start), F.when(F.col("_following") < F.col("_end"), F.col("_following")).otherwise(F.col("_end")).alias(end), headway)


def departure_blocks(departures: DataFrame, trip: str, second: str, tolerance: float = 0.1, least: int = 60, keep_tail: bool = False) -> DataFrame:
    """(trip, start, end, headway) of runs of departures whose gaps stay within ``tolerance`` of the run's first.

    Headway is the truncated mean gap of a run, ``least`` at least. A gap that
    breaks the run at the very end has no run of its own; ``keep_tail`` gives it one.
    """
    sorted_ = departures.where(F.col(second).isNotNull()).groupBy(trip).agg(F.array_sort(F.collect_set(second)).alias("t"))
    sorted_ = sorted_.where("size(t) > 2").withColumn("g", F.expr("transform(sequence(1, size(t) - 1), i -> t[i] - t[i - 1])"))
    kind = "struct<s:int,c:double,b:array<struct<s:int,e:int>>>"
    last = "size(g) - 1"
    tail = f"if(i = {last} and abs(greatest(g[i], {least}) - a.c) / a.c > {tolerance}, array(named_struct('s', i, 'e', i + 1)), array())" if keep_tail else "array()"
    fold = f"""
      aggregate(sequence(1, {last}),
        cast(named_struct('s', 0, 'c', cast(greatest(g[0], {least}) as double), 'b', array()) as {kind}),
        (a, i) -> cast(
          if(abs(greatest(g[i], {least}) - a.c) / a.c > {tolerance} or i = {last},
            named_struct('s', i, 'c', cast(greatest(g[i], {least}) as double),
              'b', concat(a.b, array(named_struct('s', a.s, 'e', if(abs(greatest(g[i], {least}) - a.c) / a.c > {tolerance}, i, i + 1))), {tail})),
            a) as {kind}),
        a -> a.b)"""
    blocks = sorted_.select(trip, "t", "g", F.explode(F.expr(fold)).alias("x"))
    mean = F.expr("cast(aggregate(slice(g, x.s + 1, x.e - x.s), 0D, (a, y) -> a + y) / (x.e - x.s) as int)")
    return blocks.select(trip, F.expr("t[x.s]").alias("start"), F.expr("t[x.e]").alias("end"), F.greatest(mean, F.lit(least)).alias("headway"))


def day_slices(base: DataFrame, slices: list[tuple[int, int, int, str]], peak: Column, off_peak: Column) -> DataFrame:
    """Each row once for each slice (start, end, default headway, 'peak' or 'off'); a headway of the row goes before the default."""
    literal = F.array(*(F.struct(F.lit(s).alias("start"), F.lit(e).alias("end"), F.lit(h).alias("default"), F.lit(k).alias("kind")) for s, e, h, k in slices))
    own = F.when(F.col("_slice.kind") == "peak", peak).otherwise(off_peak)
    return base.withColumn("_slice", F.explode(literal)).select(*base.columns, F.col("_slice.start").alias("start"), F.col("_slice.end").alias("end"), F.coalesce(own, F.col("_slice.default")).alias("headway"))


def renumber(df: DataFrame, keys: list[str], order: list[str], into: str, first: int = 1) -> DataFrame:
    return df.withColumn(into, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) + (first - 1)).cast("int"))


def offsets(stops: DataFrame, trip: str, order: str, seconds: Column, into: str = "offset") -> DataFrame:
    """Running sum of the seconds since the stop before; the first stop has 0."""
    w = Window.partitionBy(trip).orderBy(order)
    own = F.when(F.row_number().over(w) == 1, F.lit(0)).otherwise(seconds)
    return stops.withColumn("_own", own).withColumn(into, F.sum("_own").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_own")


def with_previous(stops: DataFrame, trip: str, order: str, **columns: str) -> DataFrame:
    w = Window.partitionBy(trip).orderBy(order)
    return stops.withColumns({name: F.lag(c).over(w) for name, c in columns.items()})


def edge_seconds(segments: DataFrame, edges: DataFrame, a: str, b: str, into: str, default: Column, most: int = 3600) -> DataFrame:
    """Seconds of a segment from the edge forward, else backward, else a default; what is not in (0, most] counts as the default."""
    forward = edges.select(F.col("from_id").alias(a), F.col("to_id").alias(b), F.col("seconds").alias("_forward"))
    backward = edges.select(F.col("to_id").alias(a), F.col("from_id").alias(b), F.col("seconds").alias("_backward"))
    found = segments.join(forward, [a, b], "left").join(backward, [a, b], "left").withColumn(into, F.coalesce("_forward", "_backward"))
    return found.withColumn(into, F.when((F.col(into) > 0) & (F.col(into) <= most), F.col(into)).otherwise(default)).drop("_forward", "_backward")


def change_points(rows: DataFrame, trip: str, order: str, value: str) -> DataFrame:
    """Rows whose value differs from that of the row before; rows without a value take no part."""
    w = Window.partitionBy(trip).orderBy(order)
    return rows.where(F.col(value).isNotNull()).withColumn("_before", F.lag(value).over(w)).where(F.col("_before").isNull() | (F.col("_before") != F.col(value))).drop("_before")


def guarded_median(df: DataFrame, column: str, low: int, high: int, default: int) -> DataFrame:
    """One row: the median if it is in [low, high], else the default."""
    m = F.median(column)
    return df.agg(F.when(m.between(low, high), m).otherwise(F.lit(float(default))).alias("median"))


def merge_overlap(out: Column, back: Column) -> Column:
    """Array ``back`` behind ``out`` without its beginning that mirrors the end of ``out``: back[i] = out[-1 - i], up to the first difference."""
    most = F.least(F.size(out), F.size(back))
    alike = F.aggregate(F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>")), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, i: F.struct(F.when(a["on"] & (F.get(out, F.size(out) - i) == F.get(back, i - 1)), i).otherwise(a["n"]).alias("n"), (a["on"] & (F.get(out, F.size(out) - i) == F.get(back, i - 1))).alias("on")), lambda a: a["n"])
    return F.concat(out, F.slice(back, alike + 1, F.greatest(F.size(back) - alike, F.lit(0))))


def splice_circular(stops: DataFrame, route: str, bound: str, order: str, stop: str) -> DataFrame:
    """(route, stop, sequence): outbound stops, then inbound ones from the first that outbound lacks (from the start if none is).

    Windows by route alone and by route and stop share one shuffle.
    """
    by_route, outbound = Window.partitionBy(route), F.col(bound) == "O"
    marked = stops.where(F.col(bound).isin("O", "I")).select(route, stop, order, bound).withColumn("_known", F.max(outbound).over(Window.partitionBy(route, stop)))
    first_new = F.min(F.when(~outbound & ~F.col("_known"), F.col(order))).over(by_route)
    marked = marked.withColumns({"_base": F.max(F.when(outbound, F.col(order))).over(by_route), "_begin": F.coalesce(first_new, F.lit(1))})
    kept = marked.where(outbound | (F.col("_base").isNotNull() & (F.col(order) >= F.col("_begin"))))
    place = F.row_number().over(Window.partitionBy(route, bound).orderBy(order))
    return kept.select(route, stop, F.when(outbound, F.col(order)).otherwise(F.col("_base") + place).cast("int").alias("sequence"))


def interpolated(index: Column, average: Column) -> Column:
    """Whole seconds at a position, halves to even."""
    return F.bround(average * index).cast("int")
