"""Headways, intervals, sequences and travel times, on events and line items as schedules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.functions import svc_time as T

from tramline.operators import schedule as S
from tramline.operators import spatial as P
from tramline.operators.selection import first_and_last, keep_first, keep_ties, primary_and_alternative, referential
from tramline.plans.registry import SECOND, STOPS, Registry, clock_sql, haversine_sql, second_of_day, stops

REGISTRY = Registry()
query = REGISTRY.query


@query(f"""
WITH d AS (SELECT DISTINCT user_id, CAST({SECOND} AS BIGINT) AS s FROM events),
g AS (SELECT user_id, s, lead(s) OVER w - s AS after, s - lag(s) OVER w AS before FROM d WINDOW w AS (PARTITION BY user_id ORDER BY s))
SELECT user_id, s AS "start", s + coalesce(after, before, 86400) AS "end", coalesce(after, before, 86400) AS headway,
  {clock_sql("s")} AS start_time, {clock_sql("s + coalesce(after, before, 86400)")} AS end_time FROM g""")
def headway_from_schedule(read):
    """Frequencies of trips that have only departures."""
    out = S.headways(read("events").select("user_id", second_of_day().alias("second")), "user_id", "second")
    return out.withColumns({"start_time": T.to_clock(F.col("start")), "end_time": T.to_clock(F.col("end"))})


_INTERVALS = f"""SELECT user_id, s, s + 900 + CAST(floor(value) AS BIGINT) % 7 * 600 AS e, 300 + CAST(floor(value) AS BIGINT) % 3 * 300 AS h
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, s ORDER BY event_id) AS rn FROM (SELECT *, CAST({SECOND} // 60 * 60 AS BIGINT) AS s FROM events)) WHERE rn = 1"""


def _intervals(read):
    own = keep_first(read("events").withColumn("start", (F.floor(second_of_day() / 60) * 60).cast("int")), ["user_id", "start"], [F.col("event_id")])
    whole = F.floor("value")
    return own.select("user_id", "start", (F.col("start") + 900 + whole % 7 * 600).cast("int").alias("end"), (300 + whole % 3 * 300).cast("int").alias("headway"))


@query(f"""
WITH i AS ({_INTERVALS}),
a AS (SELECT *, CASE WHEN lag(h) OVER (PARTITION BY user_id ORDER BY s) = h THEN 0 ELSE 1 END AS turn FROM i),
b AS (SELECT *, sum(turn) OVER (PARTITION BY user_id ORDER BY s) AS run FROM a),
c AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY user_id, run ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS brk FROM b),
d AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY s) AS island FROM c),
f AS (SELECT user_id, min(s) AS s, max(e) AS e, min(h) AS h FROM d GROUP BY user_id, island)
SELECT user_id, s AS "start", least(e, coalesce(lead(s) OVER (PARTITION BY user_id ORDER BY s), e)) AS "end", h AS headway FROM f""")
def interval_coalesce(read):
    """Frequencies that don't overlap."""
    return S.coalesce_intervals(_intervals(read), "user_id")


@query(f"""
WITH RECURSIVE t AS (SELECT user_id, list_sort(list(DISTINCT {SECOND} // 60 * 60)) AS t FROM events GROUP BY user_id),
g AS (SELECT user_id, t, list_transform(range(1, len(t)), lambda i: t[i + 1] - t[i]) AS g FROM t WHERE len(t) > 2),
r AS (
  SELECT user_id, 1 AS i, 0 AS st, greatest(g[1], 60)::DOUBLE AS c, NULL::BIGINT AS s, NULL::BIGINT AS e FROM g
  UNION ALL
  SELECT r.user_id, r.i + 1, CASE WHEN brk OR last THEN r.i ELSE r.st END, CASE WHEN brk OR last THEN n ELSE r.c END,
    CASE WHEN brk OR last THEN r.st END, CASE WHEN brk THEN r.i WHEN last THEN r.i + 1 END
  FROM r JOIN g USING (user_id), LATERAL (SELECT greatest(g[r.i + 1], 60)::DOUBLE AS n, r.i = len(g) - 1 AS last) x, LATERAL (SELECT abs(n - r.c) / r.c > 0.1 AS brk) y
  WHERE r.i < len(g))
SELECT user_id, t[s + 1] AS "start", t[e + 1] AS "end", greatest(60, CAST(trunc(list_avg(g[s + 1:e])) AS BIGINT)) AS headway
FROM r JOIN g USING (user_id) WHERE s IS NOT NULL""")
def block_segmentation(read):
    """Runs of departures with nearly equal gaps."""
    return S.departure_blocks(read("events").select("user_id", (F.floor(second_of_day() / 60) * 60).cast("int").alias("second")), "user_id", "second")


@query(f"""WITH {STOPS} SELECT l_orderkey, l_partkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS stop_sequence
FROM stops WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def renumber_sequence(read):
    """Stops of known trips, numbered from 1 without gaps."""
    own = referential(stops(read), read("orders").where("o_orderstatus = 'F'"), "l_orderkey", "o_orderkey")
    return S.renumber(own, ["l_orderkey"], ["l_linenumber"], "stop_sequence").select("l_orderkey", "l_partkey", "l_linenumber", "stop_sequence")


_EDGES = "edges AS (SELECT p_partkey % 50 AS f, p_partkey * 7 % 53 AS t, min(60 + p_size * 80) AS s FROM part GROUP BY ALL)"


def _edges(read):
    return read("part").groupBy((F.col("p_partkey") % 50).alias("from_id"), (F.col("p_partkey") * 7 % 53).alias("to_id")).agg(F.min(60 + F.col("p_size") * 80).alias("seconds"))


def _segments(read):
    own = stops(read).select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 53).alias("stop_id"))
    return S.with_previous(own, "l_orderkey", "l_linenumber", from_id="stop_id").withColumnRenamed("stop_id", "to_id")


@query(f"""
WITH {STOPS}, {_EDGES}, g AS (SELECT l_orderkey, l_linenumber, l_partkey % 53 AS stop_id, lag(l_partkey % 53) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS before FROM stops),
h AS (SELECT g.*, CASE WHEN row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) = 1 THEN 0 ELSE coalesce(s, 120) END AS own FROM g LEFT JOIN edges ON f = before AND t = stop_id),
o AS (SELECT *, CAST(sum(own) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS BIGINT) AS "offset" FROM h)
SELECT l_orderkey, l_linenumber, stop_id, "offset", {clock_sql('"offset"')} AS arrival_time FROM o""")
def cumulative_offsets(read):
    """Arrival times of a pattern: seconds between stops, 120 where unknown, added up."""
    timed = _segments(read).join(_edges(read), ["from_id", "to_id"], "left")
    out = S.offsets(timed, "l_orderkey", "l_linenumber", F.coalesce("seconds", F.lit(120)))
    return out.select("l_orderkey", "l_linenumber", F.col("to_id").alias("stop_id"), "offset", T.to_clock(F.col("offset")).alias("arrival_time"))


@query(f"""
WITH {STOPS}, {_EDGES}, m AS (SELECT CASE WHEN median(s) BETWEEN 30 AND 600 THEN median(s) ELSE 120 END AS d FROM edges),
g AS (SELECT l_orderkey, l_linenumber, l_partkey % 53 AS to_id, lag(l_partkey % 53) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS from_id FROM stops)
SELECT l_orderkey, l_linenumber, from_id, to_id, CAST(CASE WHEN coalesce(a.s, b.s) > 0 AND coalesce(a.s, b.s) <= 3600 THEN coalesce(a.s, b.s) ELSE d END AS DOUBLE) AS seconds
FROM g LEFT JOIN edges a ON a.f = from_id AND a.t = to_id LEFT JOIN edges b ON b.f = to_id AND b.t = from_id, m WHERE from_id IS NOT NULL""")
def edge_time_fallback(read):
    """Seconds of a segment: forward edge, backward edge, guarded median."""
    edges = _edges(read)
    default = S.guarded_median(edges, "seconds", 30, 600, 120)  # one row
    own = _segments(read).where("from_id IS NOT NULL").join(F.broadcast(default))
    return S.edge_seconds(own, edges, "from_id", "to_id", "seconds", F.col("median")).select("l_orderkey", "l_linenumber", "from_id", "to_id", F.col("seconds").cast("double").alias("seconds"))


_POINTS = "points AS (SELECT l_orderkey, l_linenumber, 22.2 + l_partkey % 97 * 0.003 AS lat, 113.9 + l_suppkey % 89 * 0.004 AS lon FROM stops)"


def _points(read):
    return stops(read).select("l_orderkey", "l_linenumber", (22.2 + F.col("l_partkey") % 97 * 0.003).cast("double").alias("lat"), (113.9 + F.col("l_suppkey") % 89 * 0.004).cast("double").alias("lon"))


@query(f"""
WITH {STOPS}, {_POINTS}, p AS (SELECT *, lag(lat) OVER w AS a, lag(lon) OVER w AS b FROM points WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber))
SELECT l_orderkey, l_linenumber, round(sum(coalesce({haversine_sql("a", "b", "lat", "lon")}, 0)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber), 2) AS shape_dist FROM p""")
def polyline_distance(read):
    """Metres along the points of a shape."""
    return P.along(_points(read), "l_orderkey", "l_linenumber", "lat", "lon").select("l_orderkey", "l_linenumber", F.round("distance", 2).alias("shape_dist"))


@query(f"""
WITH {STOPS}, {_POINTS}, e AS (SELECT l_orderkey, arg_min(lat, l_linenumber) AS a, arg_min(lon, l_linenumber) AS b, arg_max(lat, l_linenumber) AS c, arg_max(lon, l_linenumber) AS d FROM points GROUP BY l_orderkey),
g AS (SELECT o_orderkey AS l_orderkey, 22.2 + o_custkey % 83 * 0.0035 AS ga, 113.9 + o_custkey % 79 * 0.0045 AS gb, 22.2 + o_orderkey % 71 * 0.004 AS gc, 113.9 + o_orderkey % 73 * 0.005 AS gd FROM orders),
x AS (SELECT l_orderkey, {haversine_sql("a", "b", "ga", "gb")} + {haversine_sql("c", "d", "gc", "gd")} AS al, {haversine_sql("a", "b", "gc", "gd")} + {haversine_sql("c", "d", "ga", "gb")} AS inv FROM e JOIN g USING (l_orderkey))
SELECT l_orderkey, round(al, 2) AS aligned, round(inv, 2) AS inverted, inv + 200 < al AS warning, inv + 200 < al AND inv < 5000 AS flip FROM x""")
def direction_inversion(read):
    """Trips whose ends lie at the other trip's opposite ends."""
    mine = P.ends(_points(read), "l_orderkey", "l_linenumber", "lat", "lon")
    step = lambda base, c, m, f: (base + F.col(c) % m * f).cast("double")
    theirs = read("orders").select(F.col("o_orderkey").alias("l_orderkey"), step(22.2, "o_custkey", 83, 0.0035).alias("ga"), step(113.9, "o_custkey", 79, 0.0045).alias("gb"), step(22.2, "o_orderkey", 71, 0.004).alias("gc"), step(113.9, "o_orderkey", 73, 0.005).alias("gd"))
    out = P.inversion(mine.join(theirs, "l_orderkey"), ("lat_first", "lon_first", "lat_last", "lon_last"), ("ga", "gb", "gc", "gd"), flip_below=5000.0)
    return out.select("l_orderkey", F.round("aligned", 2).alias("aligned"), F.round("inverted", 2).alias("inverted"), "warning", "flip")


@query(f"""
WITH {STOPS}, o AS (SELECT l_orderkey AS route, l_partkey % 11 AS stop, l_linenumber AS seq FROM stops WHERE l_linestatus = 'F'), i AS (SELECT l_orderkey AS route, l_partkey % 11 AS stop, l_linenumber AS seq FROM stops WHERE l_linestatus = 'O')
SELECT route, stop, seq AS sequence FROM o
UNION ALL
SELECT route, stop, (SELECT max(seq) FROM o WHERE o.route = i.route) + row_number() OVER (PARTITION BY route ORDER BY seq) FROM i
WHERE route IN (SELECT route FROM o) AND seq >= coalesce((SELECT min(j.seq) FROM i j WHERE j.route = i.route AND NOT EXISTS (SELECT 1 FROM o WHERE o.route = j.route AND o.stop = j.stop)), 1)""")
def correlated_scalar_splice(read):
    """Circular routes: outbound stops, then inbound ones from the first that is new."""
    own = stops(read).select(F.col("l_orderkey").alias("route"), (F.col("l_partkey") % 11).alias("stop"), F.col("l_linenumber").alias("seq"), F.when(F.col("l_linestatus") == "F", "O").otherwise("I").alias("bound"))
    return S.splice_circular(own, "route", "bound", "seq", "stop")


@query(f"""
WITH {STOPS}, a AS (SELECT l_orderkey, list(l_partkey % 5 ORDER BY l_linenumber) FILTER (l_linestatus = 'F') AS o, list(l_partkey % 5 ORDER BY l_linenumber) FILTER (l_linestatus = 'O') AS i FROM stops GROUP BY l_orderkey),
n AS (SELECT *, coalesce(list_min(list_filter(range(1, least(len(o), len(i)) + 1), lambda k: o[len(o) + 1 - k] != i[k])) - 1, least(len(o), len(i))) AS k FROM a WHERE o IS NOT NULL AND i IS NOT NULL)
SELECT l_orderkey, array_to_string(list_concat(o, i[k + 1:]), '-') AS stops FROM n""")
def circular_array_merge(read):
    """Two directions of a circular route as one array, without what mirrors the turn."""
    part = lambda status: F.transform(F.array_sort(F.collect_list(F.when(F.col("l_linestatus") == status, F.struct("l_linenumber", (F.col("l_partkey") % 5).alias("s"))))), lambda x: x["s"])
    both = stops(read).groupBy("l_orderkey").agg(part("F").alias("o"), part("O").alias("i")).where("size(o) > 0 AND size(i) > 0")
    return both.select("l_orderkey", F.array_join(F.transform(S.merge_overlap(F.col("o"), F.col("i")), lambda x: x.cast("string")), "-").alias("stops"))


@query("""
SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS order_first, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS order_last,
  arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS priority_first, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS priority_last FROM orders GROUP BY o_custkey""")
def ordered_first_last(read):
    """First and last of a group in an explicit order."""
    return first_and_last(read("orders"), "o_custkey", F.struct("o_orderdate", "o_orderkey"), order="o_orderkey", priority="o_orderpriority")


@query(f"""
WITH {STOPS}, r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS rn FROM stops)
SELECT l_orderkey, max(l_partkey) FILTER (rn = 1) AS l_partkey, max(l_partkey) FILTER (rn = 2) AS l_partkey_alt,
  max(l_returnflag) FILTER (rn = 1) AS l_returnflag, max(l_returnflag) FILTER (rn = 2) AS l_returnflag_alt FROM r WHERE rn <= 2 GROUP BY l_orderkey""")
def pivot_primary_alt(read):
    """First and second variant side by side."""
    return primary_and_alternative(stops(read), "l_orderkey", [F.col("l_linenumber")], ["l_partkey", "l_returnflag"])


@query(f"""
WITH {STOPS}, v AS (SELECT *, max(CAST(l_returnflag = 'N' AS INT)) OVER (PARTITION BY l_orderkey) AS has FROM stops),
k AS (SELECT * FROM v WHERE has = 0 OR l_returnflag = 'N'),
c AS (SELECT l_orderkey, l_suppkey % 5 AS variant, count(*) AS n FROM k GROUP BY ALL)
SELECT l_orderkey, variant, n FROM (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY n DESC) AS r FROM c) WHERE r = 1""")
def variant_selection(read):
    """Normal variants if a route has any, and of those the most frequent, ties kept."""
    from pyspark.sql import Window

    has = F.max((F.col("l_returnflag") == "N").cast("int")).over(Window.partitionBy("l_orderkey"))
    kept = stops(read).withColumn("has", has).where("has = 0 OR l_returnflag = 'N'")
    counted = kept.groupBy("l_orderkey", (F.col("l_suppkey") % 5).alias("variant")).agg(F.count("*").alias("n"))
    return keep_ties(counted, "l_orderkey", F.desc("n")).select("l_orderkey", "variant", "n")


@query(f"""
WITH {STOPS}, c AS (SELECT l_orderkey, count(*) AS n, 600 + l_orderkey % 7 * 333 AS run FROM stops GROUP BY l_orderkey)
SELECT l_orderkey, l_linenumber, CAST(round_even((CASE WHEN n > 1 AND run / (n - 1) > 0 AND run / (n - 1) < 900 THEN run / (n - 1) ELSE 180 END) * (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1), 0) AS BIGINT) AS elapsed
FROM stops JOIN c USING (l_orderkey)""")
def linear_interpolation(read):
    """Elapsed seconds at a position: average times index, halves to even."""
    own = S.renumber(stops(read), ["l_orderkey"], ["l_linenumber"], "index", first=0)
    n = own.groupBy("l_orderkey").agg(F.count("*").alias("n")).withColumn("run", 600 + F.col("l_orderkey") % 7 * 333)
    average = F.try_divide("run", F.col("n") - 1)
    average = F.when((average > 0) & (average < 900), average).otherwise(180.0)
    return own.join(n, "l_orderkey").select("l_orderkey", "l_linenumber", S.interpolated(F.col("index"), average).alias("elapsed"))


@query("""
WITH slices(s, e, d, k) AS (VALUES (19800, 25200, 360, 'off'), (25200, 36000, 180, 'peak'), (36000, 61200, 300, 'mid'), (61200, 72000, 180, 'peak'), (72000, 82800, 360, 'mid'), (82800, 90000, 600, 'off')),
p AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_size * 6 END AS peak, CASE WHEN p_size % 4 = 0 THEN p_size * 9 END AS mid FROM part)
SELECT p_partkey, printf('%02d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) AS start_time, printf('%02d:%02d:%02d', e // 3600, e // 60 % 60, e % 60) AS end_time,
  coalesce(CASE k WHEN 'peak' THEN peak WHEN 'mid' THEN mid END, d) AS headway FROM p, slices""")
def slice_expand(read):
    """Trips times the slices of a day, with scraped headways before the defaults."""
    own = read("part").select("p_partkey", F.when(F.col("p_size") % 3 == 0, F.col("p_size") * 6).alias("peak"), F.when(F.col("p_size") % 4 == 0, F.col("p_size") * 9).alias("mid"))
    out = S.day_slices(own, DAY_SLICES, F.col("peak"), F.when(F.col("_slice.kind") == "mid", F.col("mid")))
    return out.select("p_partkey", T.to_clock(F.col("start")).alias("start_time"), T.to_clock(F.col("end")).alias("end_time"), "headway")


#: Default slices of a rail day: from, to, headway, and whether a scraped headway of a kind goes before it.
DAY_SLICES = [(19800, 25200, 360, "off"), (25200, 36000, 180, "peak"), (36000, 61200, 300, "mid"), (61200, 72000, 180, "peak"), (72000, 82800, 360, "mid"), (82800, 90000, 600, "off")]
