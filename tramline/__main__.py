"""Command line: ``fetch`` lands the publishers' data in a folder, ``feed`` builds the schedule feed of a folder of landed sources, ``alerts`` the alerts feed of a folder of events.

    python -m tramline fetch RAW [--hourly]
    python -m tramline feed RAW OUT [--zip FILE] [--work FOLDER]
    python -m tramline alerts EVENTS FILE

RAW is what ``fetch`` lands: kmb/, ctb/, nlb/ and gmb/ with JSON, mtr_bus/ with CSV, gov/ with the government feed's text
files, journey_times.json and, if there are shapes, waypoints/. For rail, rail/ has lines_and_stations.csv, fares.csv,
platforms.json, stations.json, exits.json, exit_walks.json, platform_walks.json, exit_places.jsonl, barrier_free.csv and
headways.html, light_rail_stops.csv, light_rail_fares.csv and light_rail_places.jsonl; station_times.json, light_rail_places.csv
(stop_id, lat, lon), light_rail_times.json and register.csv may be put beside them. Sources that are missing are left out.
With --work, a job that is started again on the same folder goes on behind its last whole stage.
"""

from __future__ import annotations

import argparse
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators import calendars, fares
from tramline.operators.selection import union_all
from tramline.plans import alerts, feed, fixed, silver
from tramline.plans.stages import Stages
from tramline.sources import endpoints, html, readers, schemas, sinks, web


def present(read) -> DataFrame | None:
    """What read() gives, or None if its path is not there."""
    try:
        return read()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def operators(spark: SparkSession, raw: str) -> list[silver.Silver]:
    """The silver tables of all operators that are there."""
    out = []

    def add(make, *reads) -> None:
        parts = [present(r) for r in reads]
        if all(p is not None for p in parts):
            out.append(make(*parts))

    data = lambda folder, name, schema: lambda: readers.json_data(spark, f"{raw}/{folder}/{name}.json", schema)
    rows = lambda folder, name, schema: lambda: readers.rows_below(spark, f"{raw}/{folder}/{name}", schema)
    csv = lambda folder, name, schema: lambda: readers.csv(spark, f"{raw}/{folder}/{name}.csv", schema)
    add(silver.kmb, *(data("kmb", n, schemas.KMB[n]) for n in ("routes", "stops", "route_stops")))
    add(silver.citybus, rows("ctb", "routes", schemas.CTB["routes"]), rows("ctb", "stops", schemas.CTB["stops"]), rows("ctb", "sequences", schemas.CTB["sequences"]))
    add(silver.nlb, *(rows("nlb", n, schemas.NLB[n]) for n in ("routes", "stops")), rows("nlb", "sequences", "routeId string, routeNo string, stopId string, sequence int"))
    add(lambda d, s, r: (lambda own, stops: silver.green_minibus(own, s, stops))(*readers.green_minibus(d, r)), *(rows("gmb", n, schemas.GMB[n]) for n in ("directions", "stops", "route_stops")))
    add(silver.mtr_bus, *(csv("mtr_bus", n, schemas.MTR_BUS[n]) for n in ("routes", "route_stops")))
    return out


def add(tables: dict[str, DataFrame], more: dict[str, DataFrame]) -> None:
    for name, df in more.items():
        tables[name] = union_all(tables[name], df) if name in tables else df


def entrances(spark: SparkSession, raw: str, lines: DataFrame) -> DataFrame | None:
    """(station_code, station_name, exit, stop_id, stop_name, stop_lat, stop_lon, parent_station) of the exits that the geocoder knows."""
    found = present(lambda: spark.read.schema("name string, rank int, east double, north double, name_zh string").json(f"{raw}/rail/exit_places.jsonl"))
    if found is None:
        return None
    lifts = present(lambda: readers.csv(spark, f"{raw}/rail/barrier_free.csv", schemas.BARRIER_FREE))
    stations = lines.groupBy("station_code").agg(F.min("station_id").alias("station_id"), F.min("name_en").alias("station_name_en"), F.min("name_tc").alias("station_name_zh"))
    if lifts is None:
        known = stations.withColumn("facility", F.lit(None).cast("string"))
    else:
        at = lifts.where("has = 'Y' AND coalesce(place, '') <> ''").groupBy("station_id").agg(F.concat_ws(" ", F.collect_list("place")).alias("facility"))
        known = stations.join(at, "station_id", "left")
    asked = known.select(readers.exits_name(F.col("station_name_zh")).alias("name"), "facility")
    places = found.join(asked, "name").select(F.col("name_zh").alias("name"), "east", "north", "facility").where("name IS NOT NULL")
    own = readers.station_exits(known, places, readers.exit_name(F.col("station_name_zh"), F.col("exit")))
    return own.select(
        "station_code", F.col("station_name_en").alias("station_name"), "exit", F.concat_ws("-", F.lit("MTR-ENTRANCE"), "station_code", "exit").alias("stop_id"), F.concat("station_name_en", F.lit(" Exit "), F.col("exit")).alias("stop_name"),
        F.col("lat").alias("stop_lat"), F.col("lon").alias("stop_lon"), F.concat(F.lit("MTR-"), F.col("station_code")).alias("parent_station"),
    )


def add_rail(spark: SparkSession, raw: str, tables: dict[str, DataFrame], stage: Stages) -> None:
    """Heavy rail at its platforms, with published headways, exits, walks inside stations and fares between them."""
    lines = present(lambda: readers.csv(spark, f"{raw}/rail/lines_and_stations.csv", schemas.RAIL["lines_and_stations"]))
    platforms, station_of = (present(lambda n=n, k=k: readers.by_key(spark, f"{raw}/rail/{n}.json", k)) for n, k in (("platforms", schemas.PLATFORMS), ("stations", schemas.STATIONS)))
    edges = present(lambda: readers.edges(spark, f"{raw}/rail/station_times.json"))
    if edges is None:  # the journeys between stations stand among all journeys
        edges = present(lambda: readers.edges(spark, f"{raw}/journey_times.json").where("length(from_id) <= 4 AND length(to_id) <= 4"))
    if any(x is None for x in (lines, platforms, station_of, edges)):
        return
    lines = stage("rail_lines", lambda df=lines: feed.rail_lines(df))
    own = stage("rail_platforms", lambda: platforms.select(F.col("key").alias("platform"), "value.*"))
    where = stage("rail_stations", lambda: station_of.select(F.col("key").alias("station_code"), F.explode("value.platforms").alias("platform")))
    placed = feed.rail_platforms(own, where)
    trips = feed.rail_trips(lines)
    heads = feed.rail_headsigns(trips, feed.rail_terminals(lines)).select("trip_id", F.col("en").alias("trip_headsign"))
    names = lines.groupBy("station_code").agg(F.min("name_en").alias("stop_name"))
    at = own.join(where, "platform").select("station_code", "amenity_id", F.concat(F.lit("MTR-PLATFORM-"), F.col("amenity_id")).alias("stop_id"), F.col("ref").alias("platform_code"), F.col("coordinates.lat").alias("stop_lat"), F.col("coordinates.lon").alias("stop_lon"))
    stop = at.join(names, "station_code").select("stop_id", "stop_name", "stop_lat", "stop_lon", F.lit(0).alias("location_type"), F.concat(F.lit("MTR-"), F.col("station_code")).alias("parent_station"), "platform_code")
    station = at.groupBy("station_code").agg(F.avg("stop_lat").alias("stop_lat"), F.avg("stop_lon").alias("stop_lon")).join(names, "station_code").select(F.concat(F.lit("MTR-"), F.col("station_code")).alias("stop_id"), "stop_name", "stop_lat", "stop_lon", F.lit(1).alias("location_type"))
    code_name = F.create_map(*(F.lit(x) for pair in fixed.LINES for x in pair))
    route = lines.select("line").distinct().select(F.concat(F.lit("MTRR-"), F.col("line")).alias("route_id"), F.lit("MTRR").alias("agency_id"), F.col("line").alias("route_short_name"), F.coalesce(F.try_element_at(code_name, F.col("line")), F.col("line")).alias("route_long_name"), F.lit(1).alias("route_type"), F.concat(F.lit("MTRR-"), F.col("line")).alias("network_id"), F.lit(fixed.COLORS["MTRR"]).alias("route_color"), F.lit(fixed.TEXT_COLOR).alias("route_text_color"))
    published = present(lambda: spark.read.option("wholetext", True).text(f"{raw}/rail/headways.html"))
    if published is not None:
        published = stage("rail_headways", lambda page=published: readers.headways(html.table_cells(page.select(F.lit("headways").alias("page"), F.col("value").alias("html")), "page", "html"), "page"))
    add(tables, {"routes": route, "stops": union_all(stop, station), "trips": trips.join(heads, "trip_id", "left"), "stop_times": feed.finalise_stop_times(feed.rail_stop_times(lines, trips, placed, edges), stop), "frequencies": feed.rail_frequencies(trips, published)})
    paid = present(lambda: readers.csv(spark, f"{raw}/rail/fares.csv", schemas.RAIL["fares"]))
    if paid is not None:
        stations = lines.select("station_id", F.concat(F.lit("MTR-"), F.col("station_code")).alias("stop_id")).distinct()
        add(tables, {"special_fare_rules": fares.agency_rules(paid.select(F.col("SRC_STATION_ID").alias("from_id"), F.col("DEST_STATION_ID").alias("to_id"), F.col("OCT_ADT_FARE").alias("fare")), stations, "MTRR", currency=feed.CURRENCY)})
    doors = entrances(spark, raw, lines)
    if doors is None:
        return
    doors = stage("rail_entrances", lambda df=doors: df)
    add(tables, {"stops": doors.select("stop_id", "stop_name", "stop_lat", "stop_lon", F.lit(2).alias("location_type"), "parent_station")})
    exits = present(lambda: readers.by_key(spark, f"{raw}/rail/exits.json", schemas.EXITS))
    walks = [present(lambda n=n, k=k: readers.json_rows(spark, f"{raw}/rail/{n}.json", schemas.JOURNEYS[k])) for n, k in (("exit_walks", "exits"), ("platform_walks", "platforms"))]
    if exits is not None and all(w is not None for w in walks):
        tables["pathways"] = feed.pathways(at.select("station_code", "amenity_id", "stop_id"), doors.select("station_code", "station_name", "exit", "stop_id"), exits.select("value.*"), *walks)


def add_light_rail(spark: SparkSession, raw: str, tables: dict[str, DataFrame]) -> None:
    """Light Rail with its fares; places from the geocoder, times from the first trains where they are known."""
    stops = present(lambda: readers.csv(spark, f"{raw}/rail/light_rail_stops.csv", schemas.RAIL["light_rail_stops"]))
    if stops is None:
        return
    places = present(lambda: readers.csv(spark, f"{raw}/rail/light_rail_places.csv", "stop_id string, lat double, lon double"))
    if places is None:
        found = present(lambda: spark.read.schema("name string, rank int, east double, north double").json(f"{raw}/rail/light_rail_places.jsonl"))
        if found is None:
            return
        named = stops.where("stop_id IS NOT NULL").groupBy("stop_id").agg(F.min(readers.light_rail_name(F.col("name_tc"))).alias("name"))
        places = readers.geocoded(named, found, "name").select("stop_id", "lat", "lon")
    kind = "route string, direction string, position int, first_train string, last_train string"
    times = present(lambda: readers.json_rows(spark, f"{raw}/rail/light_rail_times.json", kind))
    own = feed.light_rail(stops, places, spark.createDataFrame([], kind) if times is None else times)
    add(tables, {name: getattr(own, name) for name in ("routes", "stops", "trips", "stop_times")})
    add(tables, {"frequencies": feed.rail_frequencies(own.trips.select("trip_id", F.lit(None).cast("string").alias("line")), None)})
    paid = present(lambda: readers.csv(spark, f"{raw}/rail/light_rail_fares.csv", schemas.RAIL["light_rail_fares"]))
    if paid is not None:
        add(tables, {"special_fare_rules": fares.agency_rules(paid.select(F.col("from_station_id").alias("from_id"), F.col("to_station_id").alias("to_id"), F.col("fare_octo_adult").alias("fare")), None, "LR", "LR", feed.CURRENCY)})


def build_feed(spark: SparkSession, raw: str, stages: Stages | None = None) -> dict[str, DataFrame]:
    own = operators(spark, raw)
    if not own:
        raise ValueError(f"no operator's files below {raw}")
    stage = stages or Stages(spark)
    gov = readers.gov_feed(spark, f"{raw}/gov", *endpoints.GOV_FILES)
    edges = present(lambda: readers.edges(spark, f"{raw}/journey_times.json"))
    if edges is None:
        edges = spark.createDataFrame([], "from_id string, to_id string, seconds double")
    known = feed.Gov(*(gov[n] for n in feed.Gov._fields))
    ways = present(lambda: readers.waypoints(spark, f"{raw}/waypoints"))
    register = present(lambda: readers.csv(spark, f"{raw}/register.csv", schemas.REGISTER))
    tables = feed.build(own, known, edges, gov["calendar"], gov["calendar_dates"], gov["fare_rules"], gov["fare_attributes"], ways, stage, register, invert=True)
    ferry = feed.ferries(feed.Gov(*(stage(f"gov_{n}", lambda n=n: gov[n]) for n in feed.Gov._fields)))
    add(tables, {name: getattr(ferry, name) for name in ("routes", "stops", "stop_times", "frequencies", "trips")})
    add_rail(spark, raw, tables, stage)
    add_light_rail(spark, raw, tables)
    tables["stops"] = tables["stops"].withColumn("location_type", F.coalesce("location_type", F.lit(0)))
    services = stage("services", lambda: tables["trips"].select("service_id", "original_service_id").distinct())
    tables["calendar"] = calendars.calendar(services, gov["calendar"])
    tables["calendar_dates"] = calendars.calendar_dates(services, gov["calendar_dates"])
    return tables


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tramline", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    kinds = parser.add_subparsers(dest="kind", required=True)
    zero = kinds.add_parser("fetch")
    zero.add_argument("raw")
    zero.add_argument("--hourly", action="store_true")
    one = kinds.add_parser("feed")
    one.add_argument("raw")
    one.add_argument("out")
    one.add_argument("--zip")
    one.add_argument("--work")
    two = kinds.add_parser("alerts")
    two.add_argument("events")
    two.add_argument("file")
    asked = parser.parse_args(arguments)
    spark = spark or SparkSession.builder.appName("tramline").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if asked.kind == "fetch":
        web.fetch_all(spark, asked.raw, hourly=asked.hourly)
        return
    if asked.kind == "feed":
        tables = build_feed(spark, asked.raw, Stages(spark, asked.work))
        sinks.write_feed(tables, asked.out)
        if asked.zip:
            sinks.package(spark, asked.out, sorted(tables), asked.zip)
    else:
        alerts.write_feed(alerts.entities(readers.events(spark, asked.events)), int(time.time()), asked.file)


if __name__ == "__main__":
    main()
