"""Rail, light rail, walks in stations, and the operators' raw tables, on the same tables as the other queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tramline.operators import selection
from tramline.plans import feed, fixed, silver
from tramline.plans.registry import STOPS, Registry, clock_sql, stops
from tramline.sources import readers

REGISTRY = Registry()
query = REGISTRY.query

_WAY = "CASE l_orderkey % 3 WHEN 0 THEN 'UT' WHEN 1 THEN 'DT' ELSE 'LMC-DT' END"
#: Each order is a line in one direction; large quantities stand for numbers that can't be read.
LINES = f"""{STOPS},
lines AS (
  SELECT 'T' || l_orderkey AS line, {_WAY} AS direction, 'S' || (l_partkey % 53) AS station_code, 'Station ' || (l_partkey % 53) AS name_en, 'tc ' || (l_partkey % 53) AS name_tc, l_linenumber AS sequence, l_returnflag
  FROM stops WHERE l_quantity < 48)"""


def raw_lines(read):
    return stops(read).selectExpr(
        "concat('T', l_orderkey) AS `Line Code`", f"concat(' ', {_WAY}) AS Direction", "concat('S', l_partkey % 53) AS `Station Code`", "string(l_partkey) AS `Station ID`", "concat('Station ', l_partkey % 53) AS `English Name`",
        "concat('tc ', l_partkey % 53) AS `Chinese Name`", "CASE WHEN l_quantity < 48 THEN concat(l_linenumber, '.00') ELSE 'n/a' END AS Sequence", "l_returnflag",
    )


def lines(read):
    return feed.rail_lines(raw_lines(read))


@query(f"WITH {LINES} SELECT line, direction, station_code, name_en, name_tc, sequence FROM lines")
def rail_lines(read):
    """Stations of lines, those without a readable number left out."""
    return lines(read).drop("station_id")


@query(f"WITH {LINES} SELECT 'MTRR-' || line || '-' || direction AS trip_id, arg_max(name_en, sequence) AS en, arg_max(name_tc, sequence) AS tc FROM lines GROUP BY line, direction")
def rail_headsigns(read):
    """The terminal of each trip, by the first spelling of its direction that is known."""
    own = lines(read)
    return feed.rail_headsigns(feed.rail_trips(own), feed.rail_terminals(own))


@query(f"WITH {LINES} SELECT DISTINCT 'MTRR-' || line AS route_id, 'MTRR-' || line || '-' || direction AS trip_id, CASE WHEN direction LIKE '%DT' THEN 1 ELSE 0 END AS direction_id, 'MTRR-' || line || '-DEFAULT' AS service_id FROM lines")
def rail_trips(read):
    """A daily trip for each line and direction."""
    return feed.rail_trips(lines(read)).select("route_id", "trip_id", "direction_id", "service_id")


_PLATFORMS = """
ends AS (SELECT line, direction, arg_max(station_code, sequence) AS destination FROM lines GROUP BY ALL),
pl AS (
  SELECT 'S' || (p_partkey % 53) AS station_code, 'P' || p_partkey AS stop_id, NULL AS line, NULL AS direction, NULL AS destination FROM part WHERE p_size > 20
  UNION ALL SELECT station_code, 'Q' || line, line, direction, NULL FROM lines WHERE l_returnflag = 'R'
  UNION ALL SELECT station_code, 'X' || line, line, direction, destination FROM lines JOIN ends USING (line, direction) WHERE l_returnflag = 'A'),
edges AS (SELECT 'S' || (p_partkey % 53) AS f, 'S' || (p_partkey * 7 % 53) AS t, min(60 + p_size * 80) AS s FROM part GROUP BY ALL),
med AS (SELECT CASE WHEN median(s) BETWEEN 30 AND 600 THEN median(s) ELSE 120 END AS d FROM edges)"""


@query(f"""WITH {LINES}, {_PLATFORMS},
g AS (SELECT *, lag(station_code) OVER w AS before FROM lines WINDOW w AS (PARTITION BY line, direction ORDER BY sequence)),
h AS (
  SELECT g.*, CASE WHEN before IS NULL THEN 0 ELSE CAST(trunc(CASE WHEN coalesce(a.s, b.s) > 0 AND coalesce(a.s, b.s) <= 3600 THEN coalesce(a.s, b.s) ELSE d END) AS BIGINT) END AS own
  FROM g LEFT JOIN edges a ON a.f = before AND a.t = station_code LEFT JOIN edges b ON b.t = before AND b.f = station_code, med),
o AS (SELECT *, CAST(sum(own) OVER (PARTITION BY line, direction ORDER BY sequence) AS BIGINT) AS sec FROM h),
x AS (SELECT line, direction, sequence, sec, coalesce(e.stop_id, l.stop_id, y.stop_id) AS stop_id FROM o JOIN ends USING (line, direction)
  LEFT JOIN (SELECT station_code, line, direction, destination, min(stop_id) AS stop_id FROM pl WHERE destination IS NOT NULL GROUP BY ALL) e USING (station_code, line, direction, destination)
  LEFT JOIN (SELECT station_code, line, direction, min(stop_id) AS stop_id FROM pl WHERE destination IS NULL AND line IS NOT NULL GROUP BY ALL) l USING (station_code, line, direction)
  LEFT JOIN (SELECT station_code, min(stop_id) AS stop_id FROM pl GROUP BY ALL) y USING (station_code))
SELECT 'MTRR-' || line || '-' || direction AS trip_id, {clock_sql("sec")} AS arrival_time, stop_id, sequence AS stop_sequence FROM x WHERE stop_id IS NOT NULL""")
def rail_stop_times(read):
    """Times at platforms, by destination, direction or station, from seconds between stations or their guarded median."""
    own = lines(read)
    flagged = raw_lines(read).where("Sequence <> 'n/a'").selectExpr("`Station Code` AS station_code", "`Line Code` AS line", "trim(Direction) AS direction", "l_returnflag", "int(double(Sequence)) AS sequence")
    whole = Window.partitionBy("line", "direction").orderBy("sequence").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    any_ = read("part").where("p_size > 20").selectExpr("concat('S', p_partkey % 53) AS station_code", "concat('P', p_partkey) AS stop_id")
    of_line = flagged.withColumn("destination", F.last("station_code").over(whole)).where("l_returnflag IN ('R', 'A')")
    of_line = of_line.selectExpr("station_code", "concat(if(l_returnflag = 'R', 'Q', 'X'), line) AS stop_id", "line", "direction", "if(l_returnflag = 'A', destination, null) AS destination")
    platforms = selection.union_all(of_line, any_)
    edges = read("part").groupBy(F.expr("concat('S', p_partkey % 53)").alias("from_id"), F.expr("concat('S', p_partkey * 7 % 53)").alias("to_id")).agg(F.min(60 + F.col("p_size") * 80).cast("double").alias("seconds"))
    return feed.rail_stop_times(own, feed.rail_trips(own), platforms, edges).select("trip_id", "arrival_time", "stop_id", "stop_sequence")


_CODES = [c for c, _ in fixed.LINES]
_NAMED = ", ".join(f"({i}, '{code}', '{base} Line')" for i, (code, base) in enumerate(fixed.LINES))
_SLICED = ", ".join(f"({s}, {e}, {h}, '{k}')" for s, e, h, k in fixed.SLICES)


@query(f"""
WITH ln(i, code, name) AS (VALUES {_NAMED}), sl(s, e, d, k) AS (VALUES {_SLICED}),
pub AS (SELECT code, max((n_nationkey + 2) * 60 + 30) AS peak, max(n_nationkey * 60 + 90) AS mid FROM nation JOIN ln ON i = n_nationkey % 12 GROUP BY code),
t AS (SELECT 'T' || c_custkey AS trip_id, code FROM customer LEFT JOIN ln ON i = c_custkey % 13)
SELECT trip_id, {clock_sql("s")} AS start_time, {clock_sql("e")} AS end_time, coalesce(CASE k WHEN 'peak' THEN nullif(peak, 0) WHEN 'mid' THEN nullif(mid, 0) END, d) AS headway_secs
FROM t LEFT JOIN pub USING (code), sl""")
def rail_frequencies(read):
    """Trips in the slices of a day, with published headways where there are any."""
    name = F.create_map(*(F.lit(x) for i, (_, base) in enumerate(fixed.LINES) for x in (i, f"{base} Line")))
    code = F.create_map(*(F.lit(x) for i, (c, _) in enumerate(fixed.LINES) for x in (i, c)))
    published = read("nation").select(F.try_element_at(name, F.col("n_nationkey") % 12).alias("line"), F.expr("concat(n_nationkey + 2, '.5')").alias("morning_peak"), F.expr("concat(n_nationkey, '-', n_nationkey + 3, ' #')").alias("non_peak"))
    own = read("customer").select(F.expr("concat('T', c_custkey)").alias("trip_id"), F.try_element_at(code, (F.col("c_custkey") % 13).cast("int")).alias("line"))
    return feed.rail_frequencies(own, published)


@query(f"""WITH {STOPS},
raw AS (SELECT CAST(l_orderkey AS VARCHAR) AS route, CASE WHEN l_orderkey IN (705, 706) THEN 'O' WHEN l_linestatus = 'F' THEN 'O' ELSE 'I' END AS way, l_orderkey IN (705, 706) AS loop, l_partkey % 53 AS stop, l_linenumber AS seq FROM stops),
heads AS (SELECT route, way, any_value(loop) AS loop, 'Stop ' || arg_max(stop, seq) AS dest, count(DISTINCT stop) AS n FROM raw GROUP BY route, way),
own AS (SELECT route, way, stop, row_number() OVER (PARTITION BY route, way ORDER BY min(seq)) - 1 AS i FROM raw GROUP BY route, way, stop),
tt AS (SELECT CAST(o_orderkey AS VARCHAR) AS route, 'Stop ' || (o_custkey % 53) AS direction, 300 + o_orderkey % 50 AS b, 300 + o_orderkey % 50 + o_custkey % 37 AS f FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'a way', 400, 400 + o_orderkey % 29 FROM orders),
ch AS (SELECT heads.*, b, f FROM heads LEFT JOIN tt USING (route)
  QUALIFY row_number() OVER (PARTITION BY route, way ORDER BY CASE WHEN direction = 'circular' THEN 0 WHEN contains(lower(direction), lower(dest)) THEN 1 ELSE 3 END, direction) = 1),
av AS (SELECT *, CASE WHEN n > 1 AND (f - b) * 60 / (n - 1) > 0 AND (f - b) * 60 / (n - 1) < 900 THEN (f - b) * 60 / (n - 1) ELSE 180 END AS a FROM ch),
x AS (SELECT 'LR-' || route || CASE WHEN loop THEN '' ELSE '-' || way END AS trip_id, 'LR' || stop AS stop_id, i + 1 AS stop_sequence, CAST(round_even(a * i, 0) AS BIGINT) AS sec FROM own JOIN av USING (route, way))
SELECT trip_id, {clock_sql("sec")} AS arrival_time, stop_id, stop_sequence FROM x""")
def light_rail_times(read):
    """Light-rail times from the first trains at the ends of the direction whose name holds the destination."""
    raw = stops(read).selectExpr("string(l_orderkey) AS route", "CASE WHEN l_linestatus = 'F' THEN '1' ELSE '2' END AS bound", "string(l_partkey % 53) AS stop_id", "concat('Stop ', l_partkey % 53) AS name_en", "concat('tc ', l_partkey % 53) AS name_tc", "concat(l_linenumber, '.00') AS seq")
    minutes = lambda m: f"format_string('%02d:%02d', ({m}) div 60, ({m}) % 60)"
    rows = lambda where, direction, begin, finish: read("orders").where(where).selectExpr("string(o_orderkey) AS route", f"{direction} AS direction", f"inline(array(struct(0 AS position, {minutes(begin)} AS first_train, '00:10' AS last_train), struct(1 AS position, {minutes(finish)} AS first_train, '00:20' AS last_train)))")
    timetable = rows("o_orderstatus <> 'P'", "concat('Stop ', o_custkey % 53)", "300 + o_orderkey % 50", "300 + o_orderkey % 50 + o_custkey % 37").unionByName(rows("true", "'a way'", "400", "400 + o_orderkey % 29"))
    places = read("part").selectExpr("string(p_partkey % 53) AS stop_id", "22.5D AS lat", "114.0D AS lon").distinct()
    return feed.light_rail(raw, places, timetable).stop_times.select("trip_id", "arrival_time", "stop_id", "stop_sequence")


_STATION = """
plat AS (SELECT 'N' || s_nationkey AS station_code, 'a' || s_suppkey AS amenity_id, 'P' || s_suppkey AS stop_id FROM supplier),
ent AS (SELECT DISTINCT 'N' || c_nationkey AS station_code, chr(CAST(65 + c_custkey % 8 AS INT)) AS exit, 'E' || c_nationkey || chr(CAST(65 + c_custkey % 8 AS INT)) AS stop_id FROM customer WHERE c_acctbal > 0),
wk AS (SELECT l_suppkey, o_custkey, min(l_quantity) AS m, min(l_linenumber) AS t FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' GROUP BY ALL),
pex AS (
  SELECT 'MTR-PATH-PEX-a' || l_suppkey || '-x' || o_custkey AS pathway_id, plat.stop_id AS f, ent.stop_id AS t, m AS length, wk.t * 60.0 AS secs
  FROM wk JOIN customer ON c_custkey = o_custkey JOIN ent ON ent.station_code = 'N' || c_nationkey AND exit = chr(CAST(65 + c_custkey % 8 AS INT)) JOIN plat ON amenity_id = 'a' || l_suppkey),
pp AS (SELECT 'MTR-PATH-PP-a' || a.s_suppkey || '-a' || b.s_suppkey AS pathway_id, 'P' || a.s_suppkey AS f, 'P' || b.s_suppkey AS t, NULL AS length, 90.0 AS secs FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND b.s_suppkey = a.s_suppkey + 25),
kn AS (SELECT * FROM pex UNION ALL SELECT * FROM pp),
done AS (SELECT DISTINCT least(f, t) AS lo, greatest(f, t) AS hi FROM kn),
gap AS (
  SELECT DISTINCT 'DUMMY-PEX-' || plat.stop_id || '-' || ent.stop_id AS pathway_id, plat.stop_id AS f, ent.stop_id AS t FROM plat JOIN ent USING (station_code)
  UNION ALL SELECT 'DUMMY-PP-' || a.stop_id || '-' || b.stop_id, a.stop_id, b.stop_id FROM plat a JOIN plat b ON a.station_code = b.station_code AND a.stop_id < b.stop_id),
every AS (SELECT * FROM kn UNION ALL SELECT gap.*, NULL, 60.0 FROM gap WHERE (least(f, t), greatest(f, t)) NOT IN (SELECT (lo, hi) FROM done))"""


@query(f"WITH {_STATION} SELECT pathway_id, f AS from_stop_id, t AS to_stop_id, 1 AS pathway_mode, 1 AS is_bidirectional, CAST(round_even(length, 0) AS BIGINT) AS length, CAST(round_even(secs, 0) AS BIGINT) AS traversal_time FROM every")
def station_pathways(read):
    """Walks between platforms and exits, exits found by their codes, and pairs without a walk."""
    platforms = read("supplier").selectExpr("concat('N', s_nationkey) AS station_code", "concat('a', s_suppkey) AS amenity_id", "concat('P', s_suppkey) AS stop_id")
    letter = "char(65 + c_custkey % 8)"
    entrances = read("customer").where("c_acctbal > 0").selectExpr("concat('N', c_nationkey) AS station_code", "concat('Station ', c_nationkey) AS station_name", f"{letter} AS exit", f"concat('E', c_nationkey, {letter}) AS stop_id").distinct()
    exits = read("customer").selectExpr("concat('x', c_custkey) AS amenity_id", f"CASE WHEN c_custkey % 2 = 0 THEN lower({letter}) END AS ref", f"concat('Exit  ', {letter}) AS name_en", "'' AS name_zh")
    walked = read("lineitem").where("l_returnflag = 'R'").join(read("orders"), F.col("o_orderkey") == F.col("l_orderkey")).groupBy("l_suppkey", "o_custkey").agg(F.min("l_quantity").alias("m"), F.min("l_linenumber").alias("t"))
    walks = walked.join(read("customer"), F.col("c_custkey") == F.col("o_custkey")).selectExpr("concat('a', l_suppkey) AS platform_amenity_id", "concat('x', o_custkey) AS exit_amenity_id", "concat('n', c_nationkey) AS station_code", "m AS walk_distance_metres", "double(t) AS walk_time_minutes")
    pair = read("supplier").selectExpr("s_nationkey", "s_suppkey AS a", "s_suppkey + 25 AS b").join(read("supplier").selectExpr("s_nationkey", "s_suppkey AS b"), ["s_nationkey", "b"])
    across = pair.selectExpr("concat('a', a) AS start_platform_amenity_id", "concat('a', b) AS end_platform_amenity_id", "CAST(NULL AS double) AS walk_distance_metres", "1.5D AS walk_time_minutes")
    return feed.pathways(platforms, entrances, exits, walks, across)


@query("""
WITH l AS (SELECT l_suppkey, 'L' || (l_partkey % 9) AS line, l_linestatus AS direction, 'S' || (l_partkey % 53) AS destination FROM lineitem WHERE l_quantity > 45)
SELECT 'N' || s_nationkey AS station_code, 'p' || s_suppkey AS platform, 'MTR-PLATFORM-a' || s_suppkey AS stop_id, line, direction, destination FROM supplier LEFT JOIN l ON l_suppkey = s_suppkey""")
def rail_platforms(read):
    """Platforms in long form, one row for each line and direction, also those without any."""
    listed = F.collect_list(F.struct(F.expr("concat('L', l_partkey % 9)").alias("line_code"), F.col("l_linestatus").alias("direction"), F.expr("concat('S', l_partkey % 53)").alias("destination_station_code")))
    served = read("lineitem").where("l_quantity > 45").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(listed.alias("lines_and_directions"))
    raw = read("supplier").join(served, "s_suppkey", "left").selectExpr("concat('p', s_suppkey) AS platform", "concat('a', s_suppkey) AS amenity_id", "'' AS ref", "lines_and_directions")
    station_of = read("supplier").selectExpr("concat('p', s_suppkey) AS platform", "concat('N', s_nationkey) AS station_code")
    return feed.rail_platforms(raw, station_of)


# -- operators' raw tables ------------------------------------------------------------------------


@query(f"WITH {STOPS} SELECT CAST(l_orderkey AS VARCHAR) AS route_id, l_linestatus AS direction, 'C' || (l_partkey % 53) AS stop_id, row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY l_linenumber) AS sequence, l_orderkey || '-' || l_linestatus AS unique_route_id FROM stops")
def citybus_sequences(read):
    """Arrays of stops in long form, numbered from 1."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", F.expr("concat('C', l_partkey % 53)").alias("s")))), lambda x: x["s"])
    raw = stops(read).groupBy(F.expr("string(l_orderkey)").alias("route_id"), F.col("l_linestatus").alias("direction")).agg(listed.alias("stop_ids"))
    return readers.citybus_sequences(raw)


_VARIANTS = f"""{STOPS},
v AS (SELECT o_orderkey AS route_id, 'HKI' AS region, CAST(o_custkey AS VARCHAR) AS route_code, CASE WHEN o_orderpriority < '3' THEN 1 ELSE 2 END AS route_seq, o_orderstatus = 'F' AS normal, o_orderpriority FROM orders),
k AS (SELECT * FROM v QUALIFY normal OR NOT bool_or(normal) OVER (PARTITION BY region, route_code)),
ks AS (SELECT v.*, l_linenumber, l_partkey FROM v JOIN stops ON l_orderkey = route_id QUALIFY normal OR NOT bool_or(normal) OVER (PARTITION BY region, route_code))"""


def _variants(read):
    described = "CASE WHEN o_orderstatus = 'F' THEN 'Normal Departure' ELSE 'Special' END"
    own = read("orders").selectExpr("o_orderkey AS route_id", "CASE WHEN o_orderpriority < '3' THEN 1 ELSE 2 END AS route_seq", "'HKI' AS region", "string(o_custkey) AS route_code", f"{described} AS variant_description_en", "o_orderpriority AS orig_en", "concat('To ', o_orderpriority, CASE WHEN o_orderpriority > '4' THEN ' (Circular)' ELSE '' END) AS dest_en", "'' AS orig_tc", "'' AS dest_tc", "'' AS orig_sc", "'' AS dest_sc")
    calls = stops(read).selectExpr("l_orderkey AS route_id", "string(l_partkey % 53) AS stop_id", "l_linenumber AS sequence", "concat('Stop ', l_partkey % 53) AS stop_name_en", "'' AS stop_name_tc")
    return readers.green_minibus(own, calls.join(own.select("route_id", "route_seq", "region", "route_code", "variant_description_en"), "route_id"))


@query(f"WITH {_VARIANTS} SELECT route_id, route_seq, route_code, o_orderpriority > '4' AS is_circular FROM k")
def minibus_directions(read):
    """Directions of the normal variants, of all variants where a route has no normal one."""
    return _variants(read)[0].select("route_id", "route_seq", "route_code", "is_circular")


@query(f"WITH {_VARIANTS} SELECT route_id, route_seq, l_linenumber AS sequence, CAST(l_partkey % 53 AS VARCHAR) AS stop_id FROM ks")
def minibus_stops(read):
    """Stops of the variants that stay."""
    return _variants(read)[1].select("route_id", "route_seq", "sequence", "stop_id")


@query(f"""WITH {_VARIANTS},
c AS (SELECT route_code, route_seq, route_id, count(*) AS n FROM ks GROUP BY ALL),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY route_code, route_seq ORDER BY n DESC, route_id) = 1)
SELECT 'HKI-' || route_code || CASE route_seq WHEN 2 THEN '-I' ELSE '-O' END AS route_key, 'GMB-' || (l_partkey % 53) AS stop_id, l_linenumber AS sequence FROM b JOIN stops ON l_orderkey = route_id""")
def minibus_patterns(read):
    """Of the variants of a direction the one with most stops."""
    directions, calls = _variants(read)
    places = read("part").selectExpr("string(p_partkey % 53) AS stop_id", "named_struct('wgs84', named_struct('latitude', 22.5D, 'longitude', 114D)) AS coordinates").distinct()
    return silver.green_minibus(directions, places, calls).patterns.select("route_key", "stop_id", "sequence")


@query("""
WITH p AS (SELECT *, string_split(p_name, ' ') AS w FROM part),
t AS (SELECT p_partkey, list_aggregate(list_transform(w, lambda x: upper(x[1]) || x[2:]), 'string_agg', ' ') AS title FROM p)
SELECT CAST(p_partkey AS VARCHAR) || '-O-1' AS route_key, title AS orig_en, title || ' (Circular)' AS dest_en, true AS is_circular FROM t""")
def kmb_routes(read):
    """Routes with their names in title case and their keys."""
    raw = read("part").selectExpr("string(p_partkey) AS route", "'O' AS bound", "'1' AS service_type", "upper(p_name) AS orig_en", "'' AS orig_tc", "'' AS orig_sc", "concat(upper(p_name), ' (CIRCULAR)') AS dest_en", "'' AS dest_tc", "'' AS dest_sc")
    none = read("part").selectExpr("string(p_partkey) AS stop", "p_name AS name_en", "p_name AS name_tc", "'22' AS lat", "'114' AS long")
    calls = raw.selectExpr("route", "bound", "service_type", "'1' AS seq", "'x' AS stop")
    return silver.kmb(raw, none, calls).routes.select("route_key", "orig_en", "dest_en", "is_circular")


@query("""
WITH p AS (SELECT *, string_split(p_name, ' ') AS w FROM part)
SELECT 'KMB-' || p_partkey AS stop_id, list_aggregate(list_transform(w, lambda x: upper(x[1]) || x[2:]), 'string_agg', ' ') || ' - Pier' || CASE p_size % 2 WHEN 0 THEN ' (B1)' ELSE '' END AS name_en,
  CASE WHEN p_size < 40 THEN 22 + p_size / 64 END AS lat FROM p""")
def kmb_stops(read):
    """Stops with cleaned names; places that can't be read are null."""
    name = "concat(upper(p_name), '-PIER', CASE p_size % 2 WHEN 0 THEN '(B1)' ELSE '' END, ' (AB123)')"
    raw = read("part").selectExpr("string(p_partkey) AS stop", f"{name} AS name_en", "p_name AS name_tc", "CASE WHEN p_size < 40 THEN string(22 + p_size / 64D) ELSE 'none' END AS lat", "'114' AS long")
    none = raw.selectExpr("stop AS route", "'O' AS bound", "'1' AS service_type", "'' AS orig_en", "'' AS orig_tc", "'' AS dest_en", "'' AS dest_tc", "'1' AS seq", "stop")
    return silver.kmb(none, raw, none).stops.select("stop_id", "name_en", "lat")


@query("""
WITH r AS (SELECT s_suppkey, 'X' || (s_suppkey // 2 * 2 % 7 + s_nationkey) AS no FROM supplier),
n AS (SELECT *, count(*) OVER (PARTITION BY no) AS n, row_number() OVER (PARTITION BY no ORDER BY CAST(s_suppkey AS VARCHAR)) AS k FROM r)
SELECT no AS route, CAST(s_suppkey AS VARCHAR) AS route_key, CASE WHEN n = 2 AND k = 2 THEN 'I' ELSE 'O' END AS bound, 'A' || s_suppkey AS orig_en, CASE WHEN s_suppkey % 3 = 0 THEN 'A' || s_suppkey ELSE 'B' || s_suppkey END AS dest_en FROM n""")
def lantao_routes(read):
    """A number with two routes has them as directions; names are pairs."""
    name = "CASE WHEN s_suppkey % 3 = 0 THEN concat('A', s_suppkey) ELSE concat('A', s_suppkey, ' > B', s_suppkey) END"
    raw = read("supplier").selectExpr("string(s_suppkey) AS routeId", "concat('X', s_suppkey div 2 * 2 % 7 + s_nationkey) AS routeNo", "'' AS routeName_c", "'' AS routeName_s", f"{name} AS routeName_e")
    places = read("supplier").selectExpr("string(s_suppkey) AS stopId", "'' AS stopName_c", "'' AS stopName_e", "'22' AS latitude", "'114' AS longitude")
    calls = raw.selectExpr("routeId", "routeNo", "routeId AS stopId", "1 AS sequence")
    return silver.nlb(raw, places, calls).routes.select("route", "route_key", "bound", "orig_en", "dest_en")


@query("""
SELECT CAST(a.s_suppkey AS VARCHAR) AS stop_code, a.s_name AS name_en, b.c_name AS name_tc, c.p_name AS name_sc
FROM supplier a LEFT JOIN customer b ON b.c_custkey = a.s_suppkey AND c_acctbal > 0 LEFT JOIN part c ON c.p_partkey = a.s_suppkey AND p_size > 25""")
def tram_stops(read):
    """Stops with their names in three languages."""
    en = read("supplier").selectExpr("string(s_suppkey) AS stop_code", "s_name AS name")
    tc = read("customer").where("c_acctbal > 0").selectExpr("string(c_custkey) AS stop_code", "c_name AS name")
    sc = read("part").where("p_size > 25").selectExpr("string(p_partkey) AS stop_code", "p_name AS name")
    return readers.tram_stops(en, tc, sc)


_NAMES = """
d AS (SELECT DISTINCT p_brand AS brand, CASE WHEN p_size < 26 THEN 'O' ELSE 'I' END AS bound, p_name AS name FROM part),
t AS (SELECT DISTINCT p_type AS type, CASE WHEN p_size % 3 = 0 THEN 'O' ELSE 'I' END AS bound, p_name AS name FROM part),
pr AS (SELECT p_brand AS brand, p_type AS type, CASE WHEN min(p_size) < 3 THEN 100.0 ELSE 0 END AS penalty FROM part GROUP BY ALL)"""


@query(f"""WITH {_NAMES},
best AS (SELECT brand, type, d.bound, d.name, max(100.0 * (1 - levenshtein(d.name, t.name) / greatest(length(d.name), length(t.name))::DOUBLE)) AS s FROM pr JOIN d USING (brand) JOIN t USING (type) WHERE d.bound = t.bound GROUP BY ALL),
per AS (SELECT brand, type, bound, 100 - avg(s) AS off, count(*) AS n FROM best GROUP BY ALL),
tot AS (SELECT brand, type, sum(off + abs(n - m)) + any_value(penalty) AS total, count(*) AS ways FROM per JOIN (SELECT type, bound, count(*) AS m FROM t GROUP BY ALL) USING (type, bound) JOIN pr USING (brand, type) GROUP BY brand, type)
SELECT brand, type, round(total, 6) AS total FROM tot WHERE ways = 2 QUALIFY row_number() OVER (PARTITION BY brand ORDER BY round(total, 6), type) = 1""")
def fuzzy_sequence_match(read):
    """The group whose names, in both directions, are most like a route's, with penalties for lengths and for words of variants."""
    p = read("part")
    mine = p.select(F.col("p_brand").alias("brand"), F.expr("CASE WHEN p_size < 26 THEN 'O' ELSE 'I' END").alias("bound"), F.col("p_name").alias("name")).distinct()
    theirs = p.select(F.col("p_type").alias("type"), F.expr("CASE WHEN p_size % 3 = 0 THEN 'O' ELSE 'I' END").alias("bound"), F.col("p_name").alias("name")).distinct()
    pairs = p.groupBy(F.col("p_brand").alias("brand"), F.col("p_type").alias("type")).agg(F.when(F.min("p_size") < 3, 100.0).otherwise(0.0).alias("penalty"))
    return selection.fuzzy_sequences(pairs, mine, theirs, "brand", "type", "bound", "name")


_BUS = """
r AS (SELECT 'R' || c_custkey AS route, 'O' || c_custkey AS orig, CASE WHEN c_mktsegment = 'BUILDING' THEN 'D' || c_custkey || ' (Circular)' ELSE 'D' || c_custkey END AS dest, c_mktsegment = 'BUILDING' AS circular FROM customer),
s AS (SELECT DISTINCT 'R' || o_custkey AS route, CASE WHEN o_orderpriority < '3' THEN 'O' ELSE 'I' END AS bound FROM orders)"""


@query(f"""WITH {_BUS},
e AS (SELECT DISTINCT route, CASE WHEN circular THEN 'O' ELSE bound END AS bound, circular, orig, dest FROM r JOIN s USING (route))
SELECT route || '-' || bound AS route_key, bound, CASE WHEN bound = 'I' THEN dest ELSE orig END AS orig_en, CASE WHEN bound = 'I' THEN orig ELSE dest END AS dest_en FROM e""")
def citybus_routes(read):
    """Routes with a sequence in a direction: inbound ones swap their ends, circular ones have one direction."""
    dest = "CASE WHEN c_mktsegment = 'BUILDING' THEN concat('D', c_custkey, ' (Circular)') ELSE concat('D', c_custkey) END"
    routes = read("customer").selectExpr("concat('R', c_custkey) AS route", "concat('O', c_custkey) AS orig_en", "concat('O', c_custkey) AS orig_tc", f"{dest} AS dest_en", f"{dest} AS dest_tc", "'' AS dest_sc")
    way = "CASE WHEN o_orderpriority < '3' THEN 'outbound' ELSE 'inbound' END"
    sequences = read("orders").groupBy(F.expr("concat('R', o_custkey)").alias("route_id"), F.expr(way).alias("direction")).agg(F.sort_array(F.collect_set(F.expr("concat('C', o_orderkey)"))).alias("stop_ids"))
    stops = read("orders").selectExpr("concat('C', o_orderkey) AS stop", "'' AS name_en", "'' AS name_tc", "'22' AS lat", "'114' AS long")
    return silver.citybus(routes, stops, sequences).routes.select("route_key", "bound", "orig_en", "dest_en")


@query("""
WITH r AS (SELECT DISTINCT 'K' || p_size AS route, CASE WHEN p_partkey % 2 = 0 THEN 'O' ELSE 'I' END AS bound FROM part)
SELECT route || '-' || bound AS route_key, bound, CASE WHEN bound = 'O' THEN 'From ' || route ELSE 'Dest ' || route END AS orig_en, CASE WHEN bound = 'O' THEN 'Dest ' || route ELSE 'From ' || route END AS dest_en FROM r""")
def mtr_bus_routes(read):
    """Routes whose two names stand in one text, in each direction in which they call."""
    calls = read("part").selectExpr("concat('K', p_size) AS route_id", "CASE WHEN p_partkey % 2 = 0 THEN 'O' ELSE 'I' END AS direction", "'1' AS station_seqno", "string(p_partkey % 97) AS station_id", "'22.3' AS station_latitude", "'114.1' AS station_longitude", "'' AS station_name_chi", "'X' AS station_name_eng")
    routes = read("part").selectExpr("concat('K', p_size) AS route_id").distinct().selectExpr("route_id", "concat('起', route_id, '至', '終', route_id) AS route_name_chi", "concat('From ', route_id, ' to Dest ', route_id) AS route_name_eng", "'' AS is_circular")
    return silver.mtr_bus(routes, calls).routes.select("route_key", "bound", "orig_en", "dest_en")
