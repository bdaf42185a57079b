"""The whole bus feed at once: every table that ``feed.build`` gives, row by row, against SQL that does all of its steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.operators.calendars import DAYS
from tramline.operators.selection import union_all
from tramline.plans import feed
from tramline.plans.q_feed import _COUNTS, distances_sql, _FARES, _PAIRS, _TIMES, _WAYS, FREQUENCIES, GOV, NETWORK, TRIPS, edges, fares, gov, network, waypoints
from tramline.plans.registry import Registry, clock_sql
from tramline.plans.silver import Silver

REGISTRY = Registry()
query = REGISTRY.query

#: One leg of each route and direction, and the circles among them.
_SPLICED = """
least AS (SELECT agency, route, bound, min(route_key) AS route_key FROM routes0 GROUP BY ALL),
routes1 AS (SELECT routes0.* FROM routes0 SEMI JOIN least USING (agency, route_key)),
patterns1 AS (SELECT patterns0.* FROM patterns0 SEMI JOIN least USING (agency, route_key)),
one AS (SELECT route_short_name AS route FROM gt JOIN gr USING (route_id) WHERE agency_id = 'CTB' GROUP BY route HAVING count(*) FILTER (split_part(trip_id, '-', 2) = '2') = 0),
loops AS (SELECT route, route_key AS loop FROM routes1 WHERE agency = 'CTB' AND bound = 'O' AND route IN (FROM one)),
legs AS (SELECT loop, routes1.* FROM routes1 JOIN loops USING (route) WHERE agency = 'CTB'),
so AS (SELECT loop, stop_id, sequence FROM legs JOIN patterns1 USING (agency, route_key) WHERE bound = 'O'),
si AS (SELECT loop, stop_id, sequence FROM legs JOIN patterns1 USING (agency, route_key) WHERE bound = 'I'),
base AS (SELECT loop, max(sequence) AS base FROM so GROUP BY loop),
start AS (SELECT loop, min(sequence) AS begin FROM si ANTI JOIN so USING (loop, stop_id) GROUP BY loop),
routes AS (SELECT * FROM routes1 WHERE NOT (agency = 'CTB' AND bound = 'I' AND route IN (SELECT route FROM loops))),
patterns AS (
  SELECT 'CTB' AS agency, loop AS route_key, stop_id, sequence FROM so
  UNION ALL SELECT 'CTB', loop, stop_id, base + row_number() OVER (PARTITION BY loop ORDER BY sequence) FROM si JOIN base USING (loop) LEFT JOIN start USING (loop) WHERE sequence >= coalesce(begin, 1)
  UNION ALL SELECT agency, route_key, stop_id, sequence FROM patterns1 ANTI JOIN legs USING (agency, route_key))"""
#: Services of government routes by name and number of stops.
_MATCHED = """
rules(agency, agency_id, tolerance, same) AS (VALUES ('KMB', 'KMB', 20, true), ('KMB', 'LWB', 20, true), ('CTB', 'CTB', 12, false), ('NLB', 'NLB', 15, false)),
mp AS (
  SELECT oc.*, gov_route_id, service_id, gov_bound, abs(stop_count - gov_stops) AS count_diff FROM oc JOIN gc USING (route) JOIN rules ON rules.agency_id = gc.agency_id AND rules.agency = oc.agency
  WHERE abs(stop_count - gov_stops) <= tolerance AND (NOT same OR bound = gov_bound) AND NOT regexp_matches(regexp_replace(upper(long_name), '\\([^)]*\\)', ' ', 'g'), 'VIA|OMIT|SPECIAL|EXPRESS|SERVICE|CORRECTIONAL')),
mb AS (SELECT * FROM mp QUALIFY rank() OVER (PARTITION BY agency, route_key ORDER BY count_diff) = 1),
mt AS (SELECT route_key, gov_route_id FROM mb WHERE agency = 'NLB' GROUP BY route_key, gov_route_id QUALIFY row_number() OVER (PARTITION BY route_key ORDER BY count(*) DESC, round(avg(count_diff), 9), gov_route_id) = 1),
m AS (SELECT agency, route_key, gov_route_id, service_id AS service, gov_bound FROM mb WHERE agency <> 'NLB' OR (route_key, gov_route_id) IN (FROM mt))"""
#: Shapes of an agency that a trip may use; one that fits turned round gives way to the other direction's.
_SHAPED = f"""
w AS (
  SELECT wp.route_id, bound, wp.route_id || '-' || bound AS shape, agency_id, route_short_name, arg_min(lat, (l_orderkey, l_linenumber)) AS sf_lat, arg_min(lon, (l_orderkey, l_linenumber)) AS sf_lon,
    arg_max(lat, (l_orderkey, l_linenumber)) AS sl_lat, arg_max(lon, (l_orderkey, l_linenumber)) AS sl_lon FROM wp JOIN gr USING (route_id) GROUP BY ALL),
ok(agency, agency_id) AS (VALUES ('KMB', 'KMB'), ('KMB', 'LWB'), ('CTB', 'CTB'), ('NLB', 'NLB')),
fd AS (
  SELECT trip_id, min(shape) AS shape FROM (
    SELECT trip_id, shape FROM ot JOIN w ON w.route_id = gov_route_id AND w.bound = ot.bound JOIN ok ON ok.agency = ot.agency AND ok.agency_id = w.agency_id
    UNION ALL SELECT trip_id, shape FROM ot JOIN w ON gov_route_id IS NULL AND w.route_short_name = route AND w.bound = ot.bound JOIN ok ON ok.agency = ot.agency AND ok.agency_id = w.agency_id) GROUP BY trip_id),
te AS (SELECT trip_id, arg_min(lat, seq) AS f_lat, arg_min(lon, seq) AS f_lon, arg_max(lat, seq) AS l_lat, arg_max(lon, seq) AS l_lon FROM final JOIN places USING (stop_id) GROUP BY trip_id),
sh AS (
  SELECT trip_id, CASE WHEN {distances_sql("f", "sl", "l", "sf")} + 500 < {distances_sql("f", "sf", "l", "sl")} THEN coalesce(other.shape, w.shape) ELSE w.shape END AS shape_id
  FROM fd JOIN w USING (shape) LEFT JOIN te USING (trip_id) LEFT JOIN (SELECT route_id, bound, shape FROM w) other ON other.route_id = w.route_id AND other.bound <> w.bound)"""
_FARED = """
st AS (SELECT trip_id, s AS seq, arg_min(price, e) AS price FROM pf GROUP BY ALL),
stage AS (SELECT trip_id, stop_id, price, lag(price) OVER (PARTITION BY trip_id ORDER BY seq) AS before FROM st JOIN final USING (trip_id, seq)),
la AS (SELECT trip_id, max(seq) AS last_seq FROM final GROUP BY trip_id),
ea AS (SELECT trip_id, s, price, max(e) AS hi FROM pf GROUP BY trip_id, s, price QUALIFY count(*) OVER (PARTITION BY trip_id, s) > 1),
special AS (
  SELECT ea.trip_id, price, x.stop_id AS board, y.stop_id AS alight FROM ea JOIN la USING (trip_id) JOIN final x ON x.trip_id = ea.trip_id AND x.seq = s JOIN final y ON y.trip_id = ea.trip_id AND y.seq = hi
  WHERE hi < last_seq QUALIFY row_number() OVER (PARTITION BY ea.trip_id, y.stop_id, price ORDER BY s) = 1)"""
_NAMED = """
rn AS (
  SELECT agency, route, arg_min(orig_en, (service_type, route_key)) FILTER (bound = 'O' AND orig_en IS NOT NULL) AS oo, arg_min(orig_en, (service_type, route_key)) FILTER (bound = 'I' AND orig_en IS NOT NULL) AS oi,
    arg_min_null(dest_en, (service_type, route_key)) FILTER (bound = 'O') AS d_o, arg_min_null(dest_en, (service_type, route_key)) FILTER (bound = 'I') AS di FROM routes GROUP BY ALL),
tc AS (SELECT route_id, arg_min(concat_ws(' - ', orig_tc, dest_tc), trip_id) AS tc FROM ot GROUP BY route_id)"""
_KNOWN = """
kc AS (SELECT CAST(n_nationkey % 3 AS VARCHAR) AS service, max(n_regionkey % 2) AS m, 20240101 + max(n_nationkey) AS since FROM nation GROUP BY ALL),
kd AS (SELECT CAST(s_nationkey % 7 AS VARCHAR) AS service, 20240101 + s_suppkey % 28 AS date, min(1 + s_suppkey % 2) AS kind FROM supplier GROUP BY ALL)"""
_OWN = TRIPS[TRIPS.index("ot AS") :].replace("NULLS FIRST, route_key)", "NULLS FIRST, route_key, bound = gov_bound DESC NULLS LAST, gov_bound)")


@query(f"""WITH {NETWORK.replace("routes AS (", "routes0 AS (").replace("patterns AS (", "patterns0 AS (")}, {GOV}, {_SPLICED}, {_COUNTS}, {_MATCHED}, {_OWN}, {_PAIRS}, {_TIMES},
final AS (SELECT trip_id, sec, stop_id, row_number() OVER (PARTITION BY trip_id ORDER BY sequence) AS seq FROM ot JOIN tm USING (agency, route_key)), {_FARES}, {_FARED}, {_NAMED}, {_KNOWN}, {_WAYS}, {_SHAPED}, {FREQUENCIES}
SELECT 'stops' AS table_name, stop_id AS record, concat_ws('|', name_en, CAST(round(lat * 128) AS BIGINT), CAST(round(lon * 64) AS BIGINT)) AS content FROM places
UNION ALL SELECT 'routes', agency || '-' || route, concat_ws('|', route, concat_ws(' - ', coalesce(oo, oi), CASE WHEN oo IS NOT NULL AND oi IS NOT NULL THEN oi ELSE coalesce(d_o, di) END)) FROM rn
UNION ALL SELECT 'trips', trip_id, concat_ws('|', route_id, service_id, direction_id, coalesce(dest_en, route), coalesce(shape_id, '')) FROM ot LEFT JOIN sh USING (trip_id)
UNION ALL SELECT 'stop_times', trip_id || '#' || seq, concat_ws('|', {clock_sql("sec")}, stop_id) FROM final
UNION ALL SELECT 'frequencies', trip_id || '#' || {clock_sql("s")}, concat_ws('|', {clock_sql("e")}, h) FROM g
UNION ALL SELECT 'calendar', service_id, concat_ws('|', CASE WHEN o = 'NEVER' THEN 0 ELSE coalesce(m, 1) END, CASE WHEN o = 'NEVER' THEN 19700101 ELSE coalesce(since, 20230101) END)
  FROM (SELECT service_id, min(original_service_id) AS o FROM ot GROUP BY service_id) LEFT JOIN kc ON service = o
UNION ALL SELECT 'calendar_dates', service_id || '#' || date, CAST(min(kind) AS VARCHAR) FROM (SELECT DISTINCT service_id, original_service_id AS service FROM ot) JOIN kd USING (service) GROUP BY service_id, date
UNION ALL SELECT 'translations', 'stops.txt#' || stop_id, name_tc FROM places
UNION ALL SELECT 'translations', 'routes.txt#' || route_id, tc FROM tc
UNION ALL SELECT 'translations', 'trips.txt#' || trip_id, dest_tc FROM ot
UNION ALL SELECT 'fare_stages', trip_id || '#' || stop_id, CAST(price AS VARCHAR) FROM stage WHERE before IS NULL OR before <> price
UNION ALL SELECT 'special_fare_rules', trip_id || '#' || board || '#' || alight, CAST(price AS VARCHAR) FROM special
UNION ALL SELECT 'shapes', shape || '#' || row_number() OVER (PARTITION BY shape ORDER BY l_orderkey, l_linenumber), concat_ws('|', CAST(round(lat * 128) AS BIGINT), CAST(round(lon * 64) AS BIGINT))
  FROM (SELECT route_id || '-' || bound AS shape, * FROM wp) WHERE shape IN (SELECT shape_id FROM sh)""")
def feed_build(read):
    """Every row of every table of the feed that is built in stages."""
    raw = network(read)
    least = raw.routes.groupBy("agency", "route", "bound").agg(F.min("route_key").alias("route_key")).select("agency", "route_key")  # one leg in each direction
    legs = Silver(raw.routes.join(least, ["agency", "route_key"], "left_semi").select(*raw.routes.columns), raw.stops, raw.patterns.join(least, ["agency", "route_key"], "left_semi").select(*raw.patterns.columns))
    days = F.max(F.col("n_regionkey") % 2)
    calendar = read("nation").groupBy(F.expr("string(n_nationkey % 3)").alias("service_id")).agg(*(days.alias(d) for d in DAYS), (20240101 + F.max("n_nationkey")).alias("start_date"), F.lit(20991231).alias("end_date"))
    dates = read("supplier").selectExpr("string(s_nationkey % 7) AS service_id", "20240101 + s_suppkey % 28 AS date", "1 + s_suppkey % 2 AS exception_type")
    tables = feed.build([legs], gov(read), edges(read), calendar, dates, *fares(read), waypoints(read))
    place = "concat_ws('|', {0}bigint(round({1} * 128)), bigint(round({2} * 64)))"
    rows = {
        "stops": ("stop_id", place.format("stop_name, ", "stop_lat", "stop_lon")),
        "routes": ("route_id", "concat_ws('|', route_short_name, route_long_name)"),
        "trips": ("trip_id", "concat_ws('|', route_id, service_id, direction_id, trip_headsign, coalesce(shape_id, ''))"),
        "stop_times": ("concat_ws('#', trip_id, stop_sequence)", "concat_ws('|', arrival_time, stop_id)"),
        "frequencies": ("concat_ws('#', trip_id, start_time)", "concat_ws('|', end_time, headway_secs)"),
        "calendar": ("service_id", "concat_ws('|', monday, start_date)"),
        "calendar_dates": ("concat_ws('#', service_id, date)", "string(exception_type)"),
        "translations": ("concat_ws('#', table_name, record_id)", "translation"),
        "fare_stages": ("concat_ws('#', trip_id, from_stop_id)", "string(bigint(price))"),
        "special_fare_rules": ("concat_ws('#', trip_id, onboarding_stop_id, offboarding_stop_id)", "string(bigint(price))"),
        "shapes": ("concat_ws('#', shape_id, shape_pt_sequence)", place.format("", "shape_pt_lat", "shape_pt_lon")),
    }
    return union_all(*(tables[name].selectExpr(f"'{name}' AS table_name", f"{record} AS record", f"{content} AS content") for name, (record, content) in rows.items()))
