"""Readers and writers, on files that are made of the tables: what is read back must equal what SQL says of the tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.plans.registry import Registry
from tramline.sources import html, readers, schemas, sinks

REGISTRY = Registry()
query = REGISTRY.query

_AWKWARD = "CASE {k} % 6 WHEN 0 THEN ' \"quoted\"' WHEN 1 THEN ', comma' WHEN 2 THEN {line} WHEN 3 THEN '{amp}' WHEN 4 THEN ' ' ELSE '' END"
_SQL_NAME = _AWKWARD.format(k="c_custkey", line="chr(10) || 'line'", amp=" & é")
_RAW_NAME = _AWKWARD.format(k="c_custkey", line="'\\nline'", amp=" &amp; &eacute;").replace("' \"", "' \\\"").replace("\"'", "\\\"'")


def _one(df: DataFrame, make, folder: str) -> str:
    """A small table written as one document."""
    df.coalesce(1).agg(F.to_json(make).alias("value")).coalesce(1).write.text(folder)
    return folder


@query(f"SELECT CAST(c_custkey AS VARCHAR) AS stop_id, c_name || {_SQL_NAME} AS stop_name, c_acctbal AS stop_lat FROM customer")
def csv_source(read):
    """Quoted cells with quotes, separators, line breaks, blanks and entities."""
    df = read("customer").selectExpr("string(c_custkey) AS stop_id", f"concat(c_name, {_RAW_NAME}) AS stop_name", "c_acctbal AS stop_lat", "1D AS stop_lon")
    folder = sinks.work_folder(df.sparkSession)
    df.write.options(**sinks.CSV).csv(folder)
    return readers.csv(df.sparkSession, folder, schemas.GOV["stops"]).drop("stop_lon")


@query(f"SELECT CAST(c_custkey AS VARCHAR) AS stop_id, c_name || {_SQL_NAME} AS stop_name, CAST(c_acctbal AS DOUBLE) AS stop_lat, NULL AS stop_lon FROM customer")
def feed_text(read):
    """A feed table as it is written, read back by the reader of feeds; columns that it lacks are empty."""
    name = _SQL_NAME.replace("chr(10) || 'line'", "concat(chr(10), 'line')").replace(" & é", " & é")
    df = read("customer").selectExpr("string(c_custkey) AS stop_id", f"concat(c_name, {name}) AS stop_name", "c_acctbal AS stop_lat")
    folder = sinks.work_folder(df.sparkSession)
    sinks.write_table(df, folder, "stops")
    return readers.csv(df.sparkSession, f"{folder}/stops", "stop_id string, stop_name string, stop_lat double, stop_lon double, location_type string, parent_station string, platform_code string").select("stop_id", "stop_name", "stop_lat", "stop_lon")


@query("SELECT CAST(o_custkey AS VARCHAR) AS route_id, CAST(o_orderkey AS VARCHAR) AS trip_id, 's' || o_orderstatus AS service_id FROM orders")
def gov_table(read):
    """A table of the government feed, in splits."""
    df = read("orders").selectExpr("string(o_custkey) AS route_id", "concat('s', o_orderstatus) AS service_id", "string(o_orderkey) AS trip_id")
    folder = sinks.work_folder(df.sparkSession)
    df.write.options(**sinks.CSV).csv(f"{folder}/trips.txt")
    return readers.gov_feed(df.sparkSession, folder, "trips")["trips"]


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal > 0")
def silver_table(read):
    """A table that is written twice and read back."""
    df = read("supplier").select("s_suppkey", "s_name", "s_acctbal")
    folder = sinks.work_folder(df.sparkSession)
    sinks.silver(df, folder)
    return sinks.silver(df.where("s_acctbal > 0"), folder)


@query("SELECT 'R' || n_nationkey AS route, CASE n_regionkey % 2 WHEN 0 THEN 'O' ELSE 'I' END AS bound, '1' AS service_type, CAST(n_regionkey AS VARCHAR) AS seq, n_name AS stop FROM nation")
def json_source(read):
    """Rows of the ``data`` array of a document."""
    df = read("nation").selectExpr("concat('R', n_nationkey) AS route", "CASE n_regionkey % 2 WHEN 0 THEN 'O' ELSE 'I' END AS bound", "'1' AS service_type", "string(n_regionkey) AS seq", "n_name AS stop")
    folder = _one(df, F.struct(F.lit("x").alias("type"), F.collect_list(F.struct("*")).alias("data")), sinks.work_folder(df.sparkSession))
    return readers.json_data(df.sparkSession, folder, schemas.KMB["route_stops"])


@query("SELECT CASE n_regionkey WHEN 0 THEN 'HKI' WHEN 1 THEN 'KLN' ELSE 'NT' END AS region, n_name AS route_code FROM nation")
def region_codes(read):
    """Codes by region of a document of arrays."""
    df = read("nation").selectExpr("CASE n_regionkey WHEN 0 THEN 'HKI' WHEN 1 THEN 'KLN' ELSE 'NT' END AS region", "n_name").groupBy("region").agg(F.collect_list("n_name").alias("codes"))
    folder = _one(df, F.map_from_entries(F.collect_list(F.struct("region", "codes"))), sinks.work_folder(df.sparkSession))
    return readers.region_codes(df.sparkSession, folder)


@query("SELECT 'S' || n_regionkey AS from_id, 'S' || n_nationkey AS to_id, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_nationkey * 10.5 END::DOUBLE AS seconds FROM nation")
def journey_edges(read):
    """Seconds between stops of a document of maps; what is no number is null."""
    df = read("nation").selectExpr("concat('S', n_regionkey) AS f", "concat('S', n_nationkey) AS t", "CASE WHEN n_nationkey % 4 = 0 THEN 'none' ELSE string(n_nationkey * 10.5D) END AS s").groupBy("f").agg(F.map_from_entries(F.collect_list(F.struct("t", "s"))).alias("inner"))
    folder = _one(df, F.map_from_entries(F.collect_list(F.struct("f", "inner"))), sinks.work_folder(df.sparkSession))
    return readers.edges(df.sparkSession, folder)


@query("SELECT 'node' AS type, n_nationkey AS id, n_nationkey / 8 AS lat, n_regionkey / 4 AS lon, n_name AS name FROM nation")
def map_elements(read):
    """Elements of a map server's answer with their tags."""
    df = read("nation").select(F.struct(F.lit("node").alias("type"), F.col("n_nationkey").cast("bigint").alias("id"), (F.col("n_nationkey") / 8).alias("lat"), (F.col("n_regionkey") / 4).alias("lon"), F.create_map(F.lit("name"), F.col("n_name")).alias("tags")).alias("e"))
    folder = _one(df, F.struct(F.collect_list("e").alias("elements")), sinks.work_folder(df.sparkSession))
    return readers.overpass(df.sparkSession, folder).select("type", "id", "lat", "lon", F.col("tags")["name"].alias("name"))


@query("SELECT c_name AS line, CASE WHEN c_custkey % 9 > 0 THEN c_custkey / 8 END AS x, CASE WHEN c_custkey % 9 > 0 THEN c_nationkey / 4 END AS y FROM customer")
def layer_points(read):
    """Points of a layer's rows; other shapes have none."""
    shape = "CASE WHEN c_custkey % 9 > 0 THEN concat('POINT (', c_custkey / 8D, ' ', c_nationkey / 4D, ')') ELSE 'LINESTRING (1 2, 3 4)' END"
    df = read("customer").selectExpr(f"concat(c_name, '\\t', {shape}) AS value")
    folder = sinks.work_folder(df.sparkSession)
    df.write.text(folder)
    return readers.wkt_points(df.sparkSession, folder)


@query("SELECT CAST(n_nationkey AS VARCHAR) AS id, CASE n_regionkey % 2 WHEN 0 THEN 'detour' ELSE 'stop_closed' END AS type, n_name AS header FROM nation WHERE n_regionkey < 4")
def event_files(read):
    """Valid events of files below a folder; those of an unknown type are left out."""
    kind = "CASE WHEN n_regionkey = 4 THEN 'no such type' WHEN n_regionkey % 2 = 0 THEN 'detour' ELSE 'stop_closed' END"
    texts = (F.create_map(F.lit("en"), F.col("n_name")).alias("header"), F.create_map(F.lit("en"), F.lit("x")).alias("description"))
    df = read("nation").select("n_nationkey", F.col("n_nationkey").cast("string").alias("id"), F.expr(kind).alias("type"), *texts)
    folder = sinks.work_folder(df.sparkSession)
    df.write.partitionBy("n_nationkey").json(folder)  # a file for each event
    events = readers.events(df.sparkSession, folder)
    return events.select("id", "type", F.col("header")["en"].alias("header"))


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS route, CASE WHEN s_suppkey % 2 = 0 THEN 'Pier ' || s_nationkey ELSE 'circular' END AS direction, 1 AS position, 'Stop & ' || s_suppkey AS stop,
  CASE WHEN s_suppkey % 4 > 0 THEN '05:' || lpad(CAST(s_suppkey % 60 AS VARCHAR), 2, '0') END AS first_train, '23:00' AS last_train FROM supplier""")
def timetable_pages(read):
    """First and last trains of the tables of HTML pages."""
    head = "concat('<table><tr><th>Stop</th><th>', CASE WHEN s_suppkey % 2 = 0 THEN concat('To Pier ', s_nationkey) ELSE 'First' END, '</th></tr>')"
    row = "concat('<tr><td>Stop &amp; ', s_suppkey, '</td><td>', CASE WHEN s_suppkey % 4 = 0 THEN '-' ELSE concat('05:', lpad(string(s_suppkey % 60), 2, '0')) END, '</td><td>23:00</td></tr></table>')"
    pages = read("supplier").selectExpr("string(s_suppkey) AS route", f"concat({head}, {row}) AS html")
    return html.train_times(html.table_cells(pages, "route", "html"), "route")


@query("""
SELECT 'Line ' || n_nationkey AS line, n_regionkey || '.5' AS morning_peak, CAST(n_regionkey + 1 AS VARCHAR) AS evening_peak, CASE WHEN n_regionkey > 0 THEN CAST(n_regionkey + 2 AS VARCHAR) END AS non_peak, '5' AS saturdays, '6' AS sundays_and_holidays FROM nation""")
def headway_pages(read):
    """Published headways of the table of an HTML page; empty cells are null."""
    cells = "concat('<tr><td>Line ', n_nationkey, '</td><td>', n_regionkey, '.5</td><td> ', n_regionkey + 1, '</td><td>', CASE WHEN n_regionkey > 0 THEN string(n_regionkey + 2) ELSE ' ' END, '</td><td>5</td><td>6</td></tr>')"
    pages = read("nation").selectExpr("string(n_nationkey) AS page", f"concat('<table><tr><th>Line</th></tr>', {cells}, '</table>') AS html")
    return readers.headways(html.table_cells(pages, "page", "html"), "page")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CASE WHEN o_orderkey % 3 > 0 THEN CAST(min(o_orderkey) OVER (PARTITION BY o_custkey, o_orderkey % 3 > 0) AS VARCHAR) END AS shape_id
FROM (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey BETWEEN 1000000 AND 9999999 UNION ALL SELECT o_orderkey + 1000000, o_custkey FROM orders WHERE o_orderkey < 1000000)""")
def shapes_by_trip(read):
    """Trips whose shapes are renamed to the least of their trips."""
    trips = read("orders").selectExpr("CASE WHEN o_orderkey < 1000000 THEN o_orderkey + 1000000 ELSE o_orderkey END AS k", "o_custkey").selectExpr("string(k) AS trip_id", "CASE WHEN k % 3 > 0 THEN concat('shape ', o_custkey) END AS shape_id")
    shapes = trips.where("shape_id IS NOT NULL").select("shape_id").distinct()
    return sinks.shapes_named_by_trip(shapes, trips)[1].select("trip_id", "shape_id")


def _grid_sql(source: str) -> str:
    """CTEs that give ``placed``: ``source`` (with metres e and n of the Hong Kong 1980 Grid) and its lat and lon, a step of each iteration a CTE."""
    num = lambda x: f"{x!r}::DOUBLE"
    a, e2 = 6378388.0, 1 / 297.0 * (2 - 1 / 297.0)
    lat0, lon0 = math.radians(22 + 18 / 60 + 43.68 / 3600), math.radians(114 + 10 / 60 + 42.80 / 3600)
    c0, c2, c4 = 1 - e2 / 4 - 3 * e2**2 / 64, 3 / 8 * (e2 + e2**2 / 4), 15 / 256 * e2**2
    arc = lambda x: f"{num(a)} * ({num(c0)} * {x} - {num(c2)} * sin(2 * {x}) + {num(c4)} * sin(4 * {x}))"
    bent = f"(1 - {num(e2)} * pow(sin(b), 2))"
    steps = [f"b0 AS (SELECT *, e - {num(836694.05)} AS dx, n - {num(819069.80)} AS dy, {num(lat0)} + (n - {num(819069.80)}) / {num(a * c0)} AS b FROM {source})"]
    steps += [f"b{i + 1} AS (SELECT * REPLACE (b - ({arc('b')} - {arc(num(lat0))} - dy) / ({num(a * (1 - e2))} / pow({bent}, 1.5)) AS b) FROM b{i})" for i in range(8)]
    steps.append(f"k AS (SELECT *, tan(b) AS t, {num(a)} / sqrt({bent}) AS nu, {num(a * (1 - e2))} / pow({bent}, 1.5) AS rho FROM b8)")
    steps.append(
        f"h AS (SELECT *, b - t / rho * pow(dx, 2) / (2 * nu) * (1 - pow(dx, 2) / (12 * pow(nu, 2)) * (9 * nu / rho * (1 - pow(t, 2)) + 12 * pow(t, 2) - 4 * pow(nu / rho, 2))) AS la, "
        f"{num(lon0)} + dx / (nu * cos(b)) * (1 - pow(dx, 2) / (6 * pow(nu, 2)) * (nu / rho + 2 * pow(t, 2))) AS lo FROM k)"
    )
    steps.append(f"v AS (SELECT *, {num(a)} / sqrt(1 - {num(e2)} * pow(sin(la), 2)) AS w FROM h)")
    steps.append(f"u AS (SELECT *, w * cos(la) * cos(lo) AS x, w * cos(la) * sin(lo) AS y, w * {num(1 - e2)} * sin(la) AS z FROM v)")
    rx, ry, rz = (num(math.radians(s / 3600)) for s in (0.067753, -2.243649, -1.158827))
    scale, f2 = num(1 - 1.094246e-6), 1 / 298.257223563 * (2 - 1 / 298.257223563)
    steps.append(f"m AS (SELECT * REPLACE (-162.619 + {scale} * (x - {rz} * y + {ry} * z) AS x, -276.959 + {scale} * ({rz} * x + y - {rx} * z) AS y, -161.764 + {scale} * (- {ry} * x + {rx} * y + z) AS z) FROM u)")
    steps.append(f"g0 AS (SELECT *, atan2(z, sqrt(x * x + y * y) * {num(1 - f2)}) AS g FROM m)")
    steps += [f"g{i + 1} AS (SELECT * REPLACE (atan2(z + {num(f2)} * 6378137.0 / sqrt(1 - {num(f2)} * pow(sin(g), 2)) * sin(g), sqrt(x * x + y * y)) AS g) FROM g{i})" for i in range(6)]
    return ", ".join([*steps, "placed AS (SELECT *, degrees(g) AS lat, degrees(atan2(y, x)) AS lon FROM g6)"])


@query(f"""
WITH c AS (SELECT c_custkey AS id, c_name AS station, 830694.0 + c_custkey % 977 * 13 AS e, 815069.0 + c_custkey % 743 * 11 AS n FROM customer WHERE c_custkey % 5 > 0), {_grid_sql("c")}
SELECT c_custkey, c_name AS station, round(lat, 6) AS lat, round(lon, 6) AS lon FROM customer LEFT JOIN placed ON id = c_custkey""")
def geocoded_stations(read):
    """Stations at the first geocode of their names, from grid metres to degrees; null where the geocoder knows none."""
    east, north = "830694D + c_custkey % 977 * 13", "815069D + c_custkey % 743 * 11"
    codes = read("customer").where("c_custkey % 5 > 0").selectExpr("c_name AS name", "explode(array(0, 1)) AS rank", f"{east} AS e", f"{north} AS n").selectExpr("name", "rank", "e + rank * 100 AS east", "n + rank * 100 AS north")
    found = readers.geocoded(read("customer").selectExpr("c_custkey", "c_name AS station"), codes, "station")
    return found.select("c_custkey", "station", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query(f"""
WITH c AS (SELECT n_nationkey, n_regionkey, exit, 833000.0 + n_nationkey * 211 + length(exit) AS e, 817000.0 + n_nationkey * 97 AS n FROM nation, (VALUES ('A'), ('B1'), ('Z9')) v(exit)), {_grid_sql("c")}
SELECT 'N' || n_nationkey AS station_code, exit, n_regionkey % 2 = 0 AND exit <> 'Z9' AS barrier_free, round(lat, 6) AS lat, round(lon, 6) AS lon FROM placed""")
def geocoded_exits(read):
    """Exits that the geocoder knows by a built name, and whether a lift serves them; codes that no exit can have are not asked for."""
    stations = read("nation").selectExpr("concat('N', n_nationkey) AS station_code", "n_name AS station_name_en", "n_name AS station_name_zh")
    own = read("nation").selectExpr("*", "explode(array('A', 'B1', 'Z9', 'AA')) AS exit")
    found = own.selectExpr("concat(upper(n_name), ' STATION EXIT ', exit) AS name", "833000D + n_nationkey * 211 + length(exit) AS east", "817000D + n_nationkey * 97 AS north", "CASE WHEN n_regionkey % 2 = 0 THEN 'Lift at A, B1' END AS facility")
    return readers.station_exits(stations, found).select("station_code", "exit", "barrier_free", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS route_id, CASE WHEN n_regionkey % 2 = 0 THEN 2 ELSE 3 END AS n_points, n_nationkey / 8 AS first_lon, n_regionkey / 4 AS last_lat FROM nation WHERE n_regionkey < 4")
def waypoint_files(read):
    """Points of files with a line, or a line of several parts; other shapes have none."""
    point = lambda i: f"array(n_nationkey / 8D + {i}, n_regionkey / 4D)"
    line, parts = f"to_json(array({point(0)}, {point(1)}))", f"to_json(array(array({point(0)}, {point(1)}), array({point(2)})))"
    kind = "CASE WHEN n_regionkey = 4 THEN 'Point' WHEN n_regionkey % 2 = 0 THEN 'LineString' ELSE 'MultiLineString' END"
    shape = f"CASE WHEN n_regionkey = 4 THEN '[1, 2]' WHEN n_regionkey % 2 = 0 THEN {line} ELSE {parts} END"
    head = "'{\"type\": \"FeatureCollection\", \"features\": [{\"type\": \"Feature\", \"properties\": {\"ROUTE_ID\": \"', n_nationkey, '\"}, \"geometry\": {\"type\": \"'"
    df = read("nation").selectExpr("n_nationkey", f"concat({head}, {kind}, '\", \"coordinates\": ', {shape}, '}}}}]}}') AS value")
    folder = sinks.work_folder(df.sparkSession)
    df.write.partitionBy("n_nationkey").option("compression", "none").format("text").save(folder)
    files = readers.waypoints(df.sparkSession, folder, "*.txt")
    return files.select("route_id", F.size("points").alias("n_points"), F.element_at("points", 1)[0].alias("first_lon"), F.element_at("points", -1)[1].alias("last_lat"))


@query("SELECT c_nationkey, count(*) AS n, round(avg(c_acctbal), 4) AS mean FROM customer GROUP BY c_nationkey")
def audit_text(read):
    """A diagnostic table as it is written."""
    df = read("customer").groupBy("c_nationkey").agg(F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 4).alias("mean"))
    folder = sinks.work_folder(df.sparkSession)
    sinks.audit(df, folder)
    return df.sparkSession.read.option("header", True).schema("c_nationkey int, n bigint, mean double").csv(folder)


@query("SELECT cid + 1 AS place, name, CASE type WHEN 'BIGINT' THEN 'long' WHEN 'INTEGER' THEN 'integer' WHEN 'DOUBLE' THEN 'double' ELSE 'string' END AS type FROM pragma_table_info('customer')")
def table_schema(read):
    """The columns of a table as its schema document lists them."""
    df = read("customer")
    return df.sparkSession.createDataFrame([(i, f["name"], f["type"]) for i, f in enumerate(sinks.schema_json(df)["fields"], 1)], "place int, name string, type string")
