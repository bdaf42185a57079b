"""The schedule feed: silver tables and the government feed to the tables that are written.

Each step is one lazy plan from DataFrames to a DataFrame; ``build`` puts them
together in stages. What differs between agencies is data: AGENCIES.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.functions import svc_time as T
from tramline.functions import text as X
from tramline.functions.geo import haversine_m, planar
from tramline.operators import calendars, fares, schedule, selection, spatial
from tramline.plans import fixed
from tramline.plans.silver import Silver
from tramline.plans.stages import Stages

#: Fixed rules by agency: government agencies that may match, tolerance of stop counts, whether directions must agree.
AGENCIES = [("KMB", ["KMB", "LWB", "KMB+CTB", "KWB"], 20, True), ("CTB", ["CTB"], 12, False), ("GMB", ["GMB"], 15, False), ("MTRB", ["LRTFeeder"], 12, False), ("NLB", ["NLB"], 15, False)]
#: Agencies whose shapes a trip may take.
SHAPE_AGENCIES = {"KMB": ["KMB", "LWB", "KMB+CTB", "KWB"], "CTB": ["CTB", "NWFB", "KMB+CTB"], "GMB": ["GMB"], "MTRB": ["LRTFeeder"], "NLB": ["NLB"]}
CURRENCY = "HKD"
#: Seconds between stops where nothing is known.
STOP_SECONDS = 120


class Gov(NamedTuple):
    routes: DataFrame
    trips: DataFrame
    stop_times: DataFrame
    stops: DataFrame
    frequencies: DataFrame


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a, g, t, d) for a, gs, t, d in AGENCIES for g in gs], "agency string, agency_id string, tolerance int, same_direction boolean")


def together(parts: list[Silver]) -> Silver:
    return Silver(*(selection.union_all(*(p[i] for p in parts)) for i in range(3)))


# -- circular routes ------------------------------------------------------------------------------


def one_way(gov: Gov, agency: str = "CTB") -> DataFrame:
    """(route): names of an agency under which no government trip goes in the second direction."""
    own = gov.trips.join(gov.routes.where(F.col("agency_id") == agency).select("route_id", F.col("route_short_name").alias("route")), "route_id")
    back = F.max((X.trip_direction(F.col("trip_id")) == "I").cast("int"))
    return own.groupBy("route").agg(back.alias("back")).where("back = 0").select("route")


def splice_one_way(silver: Silver, gov: Gov, agency: str = "CTB") -> Silver:
    """Routes that the government knows in one direction alone are circular: outbound stops, then inbound ones from the first that is new.

    Their inbound routes go. A route without an outbound one stays as it is.
    """
    mine = silver.routes.where(F.col("agency") == agency)
    outbound = mine.where("bound = 'O'").select("route", F.col("route_key").alias("_loop"))
    loops = selection.keep_first(selection.referential(outbound, one_way(gov, agency), "route"), "route", [F.col("_loop")])
    legs = mine.join(loops, "route").select("agency", "route_key", "route", "bound", "_loop")
    stops_of = silver.patterns.join(legs, ["agency", "route_key"])
    spliced = schedule.splice_circular(stops_of, "_loop", "bound", "sequence", "stop_id")
    spliced = spliced.select(F.lit(agency).alias("agency"), F.col("_loop").alias("route_key"), "stop_id", "sequence")
    patterns = silver.patterns.join(legs.select("agency", "route_key"), ["agency", "route_key"], "left_anti").unionByName(spliced)
    marked = silver.routes.join(loops.withColumn("agency", F.lit(agency)), ["agency", "route"], "left").where("_loop IS NULL OR bound = 'O'")
    marked = marked.withColumn("is_circular", F.when(F.col("_loop").isNotNull(), True).otherwise(F.col("is_circular")))
    return Silver(marked.select(*silver.routes.columns), silver.stops, patterns)


# -- matching -------------------------------------------------------------------------------------


def operator_counts(silver: Silver) -> DataFrame:
    """Routes with their number of stops. Keys begin with the one of many values, which sorts compare first."""
    return silver.routes.join(silver.patterns.groupBy("route_key", "agency").agg(F.count("*").alias("stop_count")), ["route_key", "agency"])


def gov_counts(gov: Gov) -> DataFrame:
    """(gov_route_id, agency_id, name, long_name, service_id, gov_bound, gov_stops): distinct stop numbers of each service and direction."""
    own = gov.trips.withColumn("gov_bound", X.trip_direction(F.col("trip_id"))).join(gov.stop_times.select("trip_id", "stop_sequence"), "trip_id")
    counted = own.groupBy("route_id", "service_id", "gov_bound").agg(F.count_distinct("stop_sequence").alias("gov_stops"))
    return counted.join(gov.routes.select("route_id", "agency_id", "route_short_name", "route_long_name"), "route_id").select(F.col("route_id").alias("gov_route_id"), "agency_id", F.col("route_short_name").alias("route"), F.col("route_long_name").alias("long_name"), "service_id", "gov_bound", "gov_stops")


def match(silver: Silver, gov: Gov, register: DataFrame | None = None) -> DataFrame:
    """Services of government routes for each operator route: equal names, allowed agencies, stop counts nearest within
    the tolerance with all ties; variants by name are left out. Green minibuses are matched by place instead.
    New Lantao routes keep the government route with most services. With a register, Citybus routes are those that it names."""
    spark = silver.routes.sparkSession
    elsewhere = ["GMB"] if register is None else ["GMB", "CTB"]
    may_match = F.col("agency_id").isin([g for a, gs, _, _ in AGENCIES if a not in elsewhere for g in gs])
    named = gov.routes.where(may_match & ~X.is_variant_name(F.coalesce("route_long_name", F.lit(""))))
    # trips of other routes are left out before their stops are looked up
    counted = gov_counts(gov._replace(routes=named, trips=selection.referential(gov.trips, named, "route_id")))
    public = counted.join(F.broadcast(rules(spark)), "agency_id").withColumnRenamed("agency", "_for")
    mine = operator_counts(silver).where(~F.col("agency").isin(elsewhere))
    fits = (F.col("agency") == F.col("_for")) & (~F.col("same_direction") | (F.col("bound") == F.col("gov_bound")))
    best = selection.best_matches(mine, public, "route", "stop_count", "gov_stops", F.col("tolerance"), ["route_key", "agency"], fits)
    best = selection.keep_top_group(best, ["route_key", "agency"], F.when(F.col("agency") == "NLB", F.col("gov_route_id")), "count_diff")
    found = best.select("agency", "route_key", "gov_route_id", "service_id", "gov_bound", "count_diff")
    others = match_by_place(silver, gov)
    if register is not None:
        others = others.unionByName(registered(silver, gov, register))
    return found.unionByName(others.withColumn("count_diff", F.lit(None).cast("bigint")))


def first_stops(patterns: DataFrame, stops: DataFrame, key: str) -> DataFrame:
    first = patterns.groupBy(key).agg(F.min_by("stop_id", "sequence").alias("stop_id"))
    return first.join(stops.select("stop_id", "lat", "lon"), "stop_id")


def match_by_place(silver: Silver, gov: Gov, radius: float = 500.0) -> DataFrame:
    """Green minibuses: the government route of the same code whose first stop is nearest, with all its services."""
    mine = first_stops(silver.patterns.where("agency = 'GMB'"), silver.stops, "route_key").join(silver.routes.where("agency = 'GMB'").select("route_key", F.element_at(F.split("route", "-"), -1).alias("code")), "route_key")
    codes = gov.routes.where("agency_id = 'GMB'").select("route_id", F.col("route_short_name").alias("code"))
    trips = gov.trips.join(codes, "route_id").withColumn("gov_bound", X.trip_direction(F.col("trip_id")))
    firsts = gov.stop_times.join(trips.select("trip_id", "route_id", "code", "gov_bound"), "trip_id").groupBy("route_id", "code", "gov_bound").agg(F.min_by("stop_id", F.struct("stop_sequence", "trip_id")).alias("stop_id"))
    theirs = firsts.join(gov.stops.select("stop_id", F.col("stop_lat").alias("glat"), F.col("stop_lon").alias("glon")), "stop_id").select("route_id", "code", "gov_bound", "glat", "glon")
    pairs = mine.join(theirs, "code").withColumn("tie", F.concat_ws("|", "route_id", "gov_bound"))
    near = selection.nearest_within(pairs, "route_key", haversine_m(F.col("lat"), F.col("lon"), F.col("glat"), F.col("glon")), radius, "tie")
    services = trips.select("route_id", "service_id", "gov_bound").distinct()
    return near.select("route_key", "route_id", "gov_bound").join(services, ["route_id", "gov_bound"]).select(F.lit("GMB").alias("agency"), "route_key", F.col("route_id").alias("gov_route_id"), "service_id", "gov_bound")


def match_by_register(routes: DataFrame, register: DataFrame) -> DataFrame:
    """(route, ROUTE_ID) from the transport register: the standard variant of a name, else its first."""
    own = register.where("COMPANY_CODE = 'CTB'").withColumnRenamed("ROUTE_NAMEC", "route")
    chosen = selection.keep_first(own, "route", [F.desc(F.col("SPECIAL_TYPE") == 0), F.col("ROUTE_ID")])
    return routes.select("route").distinct().join(chosen.select("route", "ROUTE_ID"), "route")


def registered(silver: Silver, gov: Gov, register: DataFrame) -> DataFrame:
    """Citybus: all services of the government route that the register gives for a name."""
    own = silver.routes.where("agency = 'CTB'")
    named = match_by_register(own, register).select("route", F.col("ROUTE_ID").cast("string").alias("gov_route_id"))
    services = gov.trips.select(F.col("route_id").alias("gov_route_id"), "service_id", X.trip_direction(F.col("trip_id")).alias("gov_bound")).distinct()
    return own.select("agency", "route_key", "route").join(named, "route").join(services, "gov_route_id").select("agency", "route_key", "gov_route_id", "service_id", "gov_bound")


def unmatched(silver: Silver, matches: DataFrame) -> DataFrame:
    return silver.routes.join(matches.select("agency", "route_key").distinct(), ["agency", "route_key"], "left_anti")


def match_report(silver: Silver, matches: DataFrame) -> DataFrame:
    """Counters by agency."""
    per = matches.groupBy("agency").agg(F.count_distinct("route_key").alias("matched"), F.count_distinct("gov_route_id").alias("gov_routes"), F.count("*").alias("patterns"))
    return silver.routes.groupBy("agency").agg(F.count_distinct("route_key").alias("routes"), F.count_distinct("route").alias("names")).join(per, "agency", "left").na.fill(0)


# -- trips, routes, stops -------------------------------------------------------------------------


def trips(silver: Silver, matches: DataFrame) -> DataFrame:
    """One trip for each route and matched service, in the government's same direction where there is a choice; a placeholder of service NEVER for each route without one."""
    own = silver.routes.join(matches, ["agency", "route_key"], "left").withColumn("is_dummy", F.col("service_id").isNull())
    service = F.coalesce("service_id", F.lit("NEVER"))
    line = F.concat_ws("-", "agency", "route")
    out = own.select(
        "agency", line.alias("route_id"), F.concat_ws("-", line, "bound", service).alias("service_id"), F.concat_ws("-", F.col("agency"), F.col("route"), F.col("bound"), F.col("service_type"), F.when(F.col("agency") == "NLB", F.col("route_key")), service).alias("trip_id"),
        F.when(F.col("bound") == "I", 1).otherwise(0).alias("direction_id"), "bound", "route", "route_key", "service_type", service.alias("original_service_id"), "gov_route_id", "gov_bound", "orig_en", "orig_tc", "dest_en", "dest_tc", "is_dummy",
    )
    return selection.keep_first(out, "trip_id", [F.col("gov_route_id"), F.col("route_key"), F.desc(F.col("gov_bound") == F.col("bound")), F.col("gov_bound")])


def routes(silver: Silver, colors: dict[str, str] = fixed.COLORS) -> DataFrame:
    """One row for each route: named by the first outbound and inbound origins, else by the ends of what there is;
    coloured by the first of its agencies."""
    order = F.struct("service_type", "route_key")
    side = lambda c, b: F.min_by(F.when(F.col("bound") == b, F.col(c)), F.when(F.col("bound") == b, order))
    both = silver.routes.groupBy("agency", "route").agg(*(side(c, b).alias(f"{c}_{b}") for c in ("orig_en", "dest_en") for b in "OI"))
    begin = F.coalesce("orig_en_O", "orig_en_I")
    end = F.when(F.col("orig_en_O").isNotNull() & F.col("orig_en_I").isNotNull(), F.col("orig_en_I")).otherwise(F.coalesce("dest_en_O", "dest_en_I"))
    color = F.lit(None).cast("string")
    for agency, value in colors.items():
        color = F.when(F.split_part("agency", F.lit("+"), F.lit(1)) == agency, value).otherwise(color)
    return both.select(F.concat_ws("-", "agency", "route").alias("route_id"), F.col("agency").alias("agency_id"), F.col("route").alias("route_short_name"), F.concat_ws(" - ", begin, end).alias("route_long_name"), F.lit(3).alias("route_type"), F.concat_ws("-", "agency", "route").alias("network_id"), X.hex_color(color).alias("route_color"), F.lit(fixed.TEXT_COLOR).alias("route_text_color"))


def stops(silver: Silver, rail_stations: DataFrame | None = None, platforms: DataFrame | None = None, entrances: DataFrame | None = None, used: DataFrame | None = None) -> DataFrame:
    """All stops: 0 stops and platforms, 1 stations, 2 entrances; with ``used``, only bus stops that a trip calls at."""
    bus = silver.stops if used is None else selection.referential(silver.stops, used, "stop_id")
    parts = [bus.select("stop_id", F.col("name_en").alias("stop_name"), F.col("lat").alias("stop_lat"), F.col("lon").alias("stop_lon"), F.lit(0).alias("location_type"))]
    for table, kind in ((rail_stations, 1), (platforms, 0), (entrances, 2)):
        if table is not None:
            parts.append(table.withColumn("location_type", F.lit(kind)))
    out = selection.union_all(*parts)
    for column in ("parent_station", "platform_code"):
        if column not in out.columns:
            out = out.withColumn(column, F.lit(None).cast("string"))
    return selection.keep_first(out, "stop_id", [F.col("location_type"), F.col("stop_name")])


def stop_times(own_trips: DataFrame, patterns: DataFrame, edges: DataFrame, default: int = STOP_SECONDS) -> DataFrame:
    """Times of every trip at the stops of its pattern, from 0, by known seconds between stops (ids without prefix) or a default."""
    segments = patterns.withColumn("before", F.lag("stop_id").over(Window.partitionBy("agency", "route_key").orderBy("sequence")))
    segments = segments.withColumns({"from_id": X.without_prefix(F.col("before")), "to_id": X.without_prefix(F.col("stop_id"))}).join(edges.select("from_id", "to_id", F.col("seconds").cast("int").alias("seconds")), ["from_id", "to_id"], "left")
    w = Window.partitionBy("agency", "route_key").orderBy("sequence")
    timed = segments.withColumn("offset", F.sum(F.when(F.col("before").isNull(), 0).otherwise(F.coalesce("seconds", F.lit(default)))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    clock = T.to_clock(F.col("offset"))
    return own_trips.select("trip_id", "agency", "route_key").join(timed, ["agency", "route_key"]).select("trip_id", clock.alias("arrival_time"), clock.alias("departure_time"), "stop_id", F.col("sequence").alias("stop_sequence"))


def finalise_stop_times(times: DataFrame, known_stops: DataFrame) -> DataFrame:
    """Numbers from 1 in order, then only stops that exist."""
    numbered = schedule.renumber(times, ["trip_id"], ["stop_sequence", "stop_id"], "stop_sequence")
    return selection.referential(numbered, known_stops, "stop_id")


# -- rail -----------------------------------------------------------------------------------------


def rail_lines(raw: DataFrame) -> DataFrame:
    """(line, direction, station_code, station_id, name_en, name_tc, sequence) of lines and stations."""
    own = raw.select(F.col("`Line Code`").alias("line"), F.trim("Direction").alias("direction"), F.col("`Station Code`").alias("station_code"), F.col("`Station ID`").alias("station_id"), F.col("`English Name`").alias("name_en"), F.col("`Chinese Name`").alias("name_tc"), X.sequence_number(F.col("Sequence")).alias("sequence"))
    return own.where("sequence IS NOT NULL")


def rail_terminals(lines: DataFrame) -> DataFrame:
    """(line, variant, rank, en, tc): last stations by every spelling under which a direction may be asked for."""
    last = lines.where("name_en IS NOT NULL AND direction <> ''").groupBy("line", "direction").agg(F.trim(F.max_by("name_en", "sequence")).alias("en"), F.trim(F.max_by("name_tc", "sequence")).alias("tc"))
    d, tail = F.col("direction"), F.regexp_replace("direction", "^[^-]*-", "")
    spelled = F.array(d, F.upper(d), F.lower(d), tail, F.upper(tail), F.lower(tail), F.when(F.upper(d).endswith("UT"), F.lit("UT")), F.when(F.upper(d).endswith("UT"), F.lit("ut")), F.when(F.upper(d).endswith("DT"), F.lit("DT")), F.when(F.upper(d).endswith("DT"), F.lit("dt")))
    every = last.select("line", "direction", "en", "tc", F.posexplode(F.array_distinct(spelled)).alias("rank", "variant")).where("variant IS NOT NULL")
    return selection.keep_first(every, ["line", "variant"], [F.col("rank") > 0, F.col("direction"), F.col("rank")]).select("line", "variant", "en", "tc")


def rail_headsigns(own_trips: DataFrame, terminals: DataFrame) -> DataFrame:
    """(trip_id, en, tc): the first candidate spelling of a trip's variant that the terminals know, then its direction's."""
    variant = F.array_join(F.slice(F.split("trip_id", "-"), 3, 99), "-")
    tail = F.regexp_replace(variant, "^[^-]*-", "")
    side = F.when(F.col("direction_id") == 0, "UT").when(F.col("direction_id") == 1, "DT")
    asked = F.array(variant, F.upper(variant), F.lower(variant), tail, F.upper(tail), F.lower(tail), side, F.lower(side))
    every = own_trips.select("trip_id", X.part_of(F.col("trip_id"), 1).alias("line"), F.posexplode(F.array_distinct(asked)).alias("asked", "variant"))
    return every.join(terminals, ["line", "variant"]).groupBy("trip_id").agg(F.min_by("en", "asked").alias("en"), F.min_by("tc", "asked").alias("tc"))


def rail_trips(lines: DataFrame) -> DataFrame:
    """A daily trip for each line and direction."""
    own = lines.select("line", "direction").distinct()
    out = own.select(F.lit("MTRR").alias("agency"), F.concat(F.lit("MTRR-"), F.col("line")).alias("route_id"), F.concat_ws("-", F.lit("MTRR"), "line", "direction").alias("trip_id"), F.when(F.upper("direction").endswith("DT"), 1).otherwise(0).alias("direction_id"), "line", "direction")
    return out.withColumns({"service_id": F.concat(F.lit("MTRR-"), F.col("line"), F.lit("-DEFAULT")), "original_service_id": F.lit("DEFAULT")})


def rail_platforms(raw: DataFrame, station_of: DataFrame) -> DataFrame:
    """(station_code, line, direction, destination, stop_id) of platforms; raw has platform, amenity_id, ref, lines_and_directions."""
    own = raw.join(station_of, "platform").select("station_code", "platform", F.concat(F.lit("MTR-PLATFORM-"), F.col("amenity_id")).alias("stop_id"), F.explode_outer("lines_and_directions").alias("l"))
    return own.select("station_code", "platform", "stop_id", F.col("l.line_code").alias("line"), F.col("l.direction").alias("direction"), F.col("l.destination_station_code").alias("destination"))


def rail_stop_times(lines: DataFrame, own_trips: DataFrame, platforms: DataFrame, edges: DataFrame) -> DataFrame:
    """Times at platforms: of the line, direction and destination, else of the line and direction, else any of the station;
    stations without a platform are left out. Seconds come from edges forward or backward, else their guarded median.

    Platforms of a line and direction are laid before its stops and dealt with them once, so neither choice of them is a join.
    """
    way, stop = ["line", "direction"], F.col("_side") == 1
    marks = platforms.where("line IS NOT NULL AND direction IS NOT NULL AND station_code IS NOT NULL").select(*way, "station_code", F.lit(0).alias("_side"), "stop_id", F.col("destination").alias("_for"))
    both = lines.select(*way, "station_code", F.lit(1).alias("_side"), "sequence").unionByName(marks, allowMissingColumns=True).repartition(*way)
    laid = Window.partitionBy(*way).orderBy("_side", "sequence")
    both = both.withColumns({"before": F.when(F.lag("_side").over(laid) == 1, F.lag("station_code").over(laid)), "destination": F.last("station_code").over(laid.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    least = lambda which: F.min(F.when(~stop & which, F.col("stop_id"))).over(Window.partitionBy(*way, "station_code"))
    own = both.withColumns({"_exact": least(F.col("_for") == F.col("destination")), "_line": least(F.col("_for").isNull())}).where(stop).select(*way, "station_code", "sequence", "before", F.coalesce("_exact", "_line").alias("_own"))
    default = schedule.guarded_median(edges, "seconds", 30, 600, STOP_SECONDS)
    own = own.withColumns({"from_id": F.col("before"), "to_id": F.col("station_code")}).join(F.broadcast(default))  # one row
    timed = schedule.edge_seconds(own, edges, "from_id", "to_id", "seconds", F.col("median"))
    w = Window.partitionBy(*way).orderBy("sequence")
    timed = timed.withColumn("offset", F.sum(F.when(F.col("before").isNull(), 0).otherwise(F.col("seconds").cast("int"))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    called = own_trips.select("trip_id", *way).join(timed.select(*way, "station_code", "sequence", "offset", "_own"), way)
    any_ = platforms.groupBy("station_code").agg(F.min("stop_id").alias("_any"))
    placed = called.join(any_, "station_code", "left").withColumn("stop_id", F.coalesce("_own", "_any")).where("stop_id IS NOT NULL")
    clock = T.to_clock(F.col("offset"))
    return placed.select("trip_id", clock.alias("arrival_time"), clock.alias("departure_time"), "stop_id", F.col("sequence").alias("stop_sequence"))


class LightRail(NamedTuple):
    routes: DataFrame
    stops: DataFrame
    trips: DataFrame
    stop_times: DataFrame


def light_rail(raw: DataFrame, places: DataFrame, timetable: DataFrame, circular: list[str] = fixed.LIGHT_RAIL_CIRCULAR, colors: dict[str, str] = fixed.LIGHT_RAIL_COLORS) -> LightRail:
    """Routes, stops, trips and times from route stops (route, bound, stop_id, name_en, name_tc, seq).

    Seconds per stop come from the first trains at the ends of the direction whose name holds the destination, else of
    the first one. Circular routes have one trip. timetable has route, direction, position, first_train, last_train.
    """
    loop = F.col("route").isin(*circular) if circular else F.lit(False)
    own = raw.withColumn("sequence", X.sequence_number(F.col("seq"))).where("sequence IS NOT NULL").withColumn("way", F.when(loop, "O").otherwise(F.when(F.col("bound").isin("1", "O"), "O").otherwise("I")))
    # the last row names the destination, also where it closes the circle; each stop is called at once
    heads = own.groupBy("route", "way").agg(*(f(c, "sequence").alias(n) for c, n, f in (("name_en", "orig_en", F.min_by), ("name_en", "dest_en", F.max_by), ("name_tc", "orig_tc", F.min_by), ("name_tc", "dest_tc", F.max_by))), F.count_distinct("stop_id").alias("n"))
    heads = heads.withColumns({"dest_en": F.when(loop, F.concat("dest_en", F.lit(" (Circular)"))).otherwise(F.col("dest_en")), "dest_tc": F.when(loop, F.concat("dest_tc", F.lit(" (循環線)"))).otherwise(F.col("dest_tc"))})
    own = selection.keep_first(own, ["route", "way", "stop_id"], [F.col("sequence")])
    ends = timetable.groupBy("route", "direction").agg(F.min_by("first_train", "position").alias("begin"), F.max_by(F.coalesce("first_train", "last_train"), "position").alias("finish"))
    bare = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\(.*$", "")))
    choice = heads.join(ends, "route", "left").withColumn("rank", F.when(F.col("direction") == "circular", 0).when((bare("dest_en") != "") & F.contains(F.lower("direction"), bare("dest_en")), 1).when((bare("dest_tc") != "") & F.contains(F.lower("direction"), bare("dest_tc")), 2).otherwise(3))
    timed = selection.keep_first(choice, ["route", "way"], [F.col("rank"), F.col("direction")])
    timed = timed.withColumn("average", F.coalesce(T.per_stop_seconds(F.col("begin"), F.col("finish"), F.col("n")), F.lit(180.0)))
    trip = F.concat_ws("-", F.lit("LR"), "route", F.when(loop, F.lit(None).cast("string")).otherwise(F.col("way")))
    made = timed.select("route", "way", "average", trip.alias("trip_id"), F.concat(F.lit("LR-"), F.col("route")).alias("route_id"), F.concat(F.lit("LR-"), F.col("route"), F.lit("-DEFAULT")).alias("service_id"), F.lit("DEFAULT").alias("original_service_id"), F.when(F.col("way") == "I", 1).otherwise(0).alias("direction_id"), F.col("dest_en").alias("trip_headsign"), F.lit("LR").alias("agency"))
    index = schedule.renumber(own.select("route", "way", "stop_id", "sequence"), ["route", "way"], ["sequence"], "index", first=0)
    clock = T.to_clock(schedule.interpolated(F.col("index"), F.col("average")))
    times = index.join(made, ["route", "way"]).select("trip_id", clock.alias("arrival_time"), clock.alias("departure_time"), F.concat(F.lit("LR"), F.col("stop_id")).alias("stop_id"), (F.col("index") + 1).alias("stop_sequence"))
    long_name = F.when(loop, F.col("dest_en")).when(F.col("orig_en") == F.col("dest_en"), F.col("dest_en")).otherwise(F.concat_ws(" - ", "orig_en", "dest_en"))
    color = F.lit(None).cast("string")
    for route, value in colors.items():
        color = F.when(F.col("route") == route, value).otherwise(color)
    named = selection.keep_first(heads, "route", [F.desc("way")]).select(F.concat(F.lit("LR-"), F.col("route")).alias("route_id"), F.lit("LR").alias("agency_id"), F.col("route").alias("route_short_name"), long_name.alias("route_long_name"), F.lit(0).alias("route_type"), F.coalesce(X.hex_color(color), F.lit(fixed.LIGHT_RAIL_DEFAULT_COLOR)).alias("route_color"))
    stop_rows = selection.keep_first(own, "stop_id", [F.col("route"), F.col("way"), F.col("sequence")]).join(places, "stop_id", "left").select(F.concat(F.lit("LR"), F.col("stop_id")).alias("stop_id"), F.col("name_en").alias("stop_name"), F.col("lat").alias("stop_lat"), F.col("lon").alias("stop_lon"))
    return LightRail(named.withColumn("route_text_color", X.text_color(F.col("route_color"))), stop_rows, made.drop("average"), times)


# -- frequencies ----------------------------------------------------------------------------------


def gov_patterns(own_trips: DataFrame, gov: Gov) -> DataFrame:
    """(trip_id, gov_trip_id): our trips and all government trips of their route, service and direction."""
    theirs = gov.trips.select(F.col("trip_id").alias("gov_trip_id"), F.col("route_id").alias("gov_route_id"), F.col("service_id").alias("original_service_id"), X.trip_direction(F.col("trip_id")).alias("gov_bound"))
    return own_trips.where("gov_route_id IS NOT NULL").select("trip_id", "gov_route_id", "original_service_id", "gov_bound").join(theirs, ["gov_route_id", "original_service_id", "gov_bound"]).select("trip_id", "gov_trip_id")


def frequencies(own_trips: DataFrame, gov: Gov) -> DataFrame:
    """Government frequencies of matched trips; for trips without any, headways between first departures. None overlap.

    Pairs of trips are made once: each looks up both, and what holds for the trip is settled where its rows lie together.
    """
    given = gov.frequencies.select(F.col("trip_id").alias("gov_trip_id"), T.to_seconds(F.col("start_time")).alias("start"), T.to_seconds(F.col("end_time")).alias("end"), F.col("headway_secs").alias("headway"), F.lit(True).alias("_given"))
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    first = gov.stop_times.withColumn("at", T.to_seconds(F.coalesce(blank("departure_time"), blank("arrival_time")))).where("at IS NOT NULL").groupBy(F.col("trip_id").alias("gov_trip_id")).agg(F.min_by("at", "stop_sequence").alias("second"))
    both = gov_patterns(own_trips, gov).join(given, "gov_trip_id", "left").join(first, "gov_trip_id", "left").where("_given OR second IS NOT NULL")
    known = both.withColumn("_known", F.max("_given").over(Window.partitionBy("trip_id")))
    every = known.where("CASE WHEN _known THEN _given AND start IS NOT NULL AND end IS NOT NULL ELSE true END").select("trip_id", F.when(F.col("_known"), F.col("start")).otherwise(F.col("second")).alias("start"), "end", "headway", "_known")
    one = selection.keep_first(every, ["trip_id", "start"], [F.col("end"), F.col("headway")])
    gap = schedule.gap(F.col("start"), Window.partitionBy("trip_id").orderBy("start"))
    own = one.withColumn("_gap", F.when(F.col("_known").isNull(), gap))
    return clocked(schedule.coalesce_intervals(own.select("trip_id", "start", F.coalesce("end", F.col("start") + F.col("_gap")).alias("end"), F.coalesce("_gap", "headway").alias("headway")), "trip_id"))


def clocked(intervals: DataFrame) -> DataFrame:
    return intervals.select("trip_id", T.to_clock(F.col("start")).alias("start_time"), T.to_clock(F.col("end")).alias("end_time"), F.col("headway").cast("int").alias("headway_secs"))


def line_of(name: Column) -> Column:
    """The line of whose name most is part of a published name; without a name, the first line whose code is."""
    bare = F.trim(F.replace(F.lower(name), F.lit(" line"), F.lit("")))
    by_name = [F.when(bare.contains(base.lower()), code) for code, base in sorted(fixed.LINES, key=lambda x: -len(x[1]))]
    return F.coalesce(*by_name, *(F.when(bare.contains(code.lower()), code) for code, _ in fixed.LINES))


def rail_frequencies(own_trips: DataFrame, published: DataFrame | None) -> DataFrame:
    """Trips (trip_id, line) in the slices of a day, with published headways where there are any."""
    own = own_trips.select("trip_id", "line")
    if published is None:
        own = own.withColumns({"peak": F.lit(None).cast("int"), "mid": F.lit(None).cast("int")})
    else:
        by_line = published.select(line_of(F.col("line")).alias("line"), T.headway_seconds(F.col("morning_peak")).alias("peak"), T.headway_seconds(F.col("non_peak")).alias("mid")).where("line IS NOT NULL").groupBy("line").agg(F.max("peak").alias("peak"), F.max("mid").alias("mid"))
        own = own.join(by_line, "line", "left")
    return clocked(schedule.day_slices(own, fixed.SLICES, F.nullif("peak", F.lit(0)), F.when(F.col("_slice.kind") == "mid", F.nullif("mid", F.lit(0)))))


class Ferry(NamedTuple):
    routes: DataFrame
    stops: DataFrame
    trips: DataFrame
    stop_times: DataFrame
    frequencies: DataFrame


def ferries(gov: Gov) -> Ferry:
    """Ferries of the government feed: trips that differ in their departure alone are one, with runs of headways.

    Single departures have an interval without length; the service id that the calendar is joined by is the raw one.
    """
    own_routes = gov.routes.where("agency_id = 'FERRY'").select(F.concat(F.lit("FERRY-"), F.col("route_id")).alias("route_id"), F.lit("FERRY").alias("agency_id"), "route_short_name", "route_long_name", F.lit(4).alias("route_type"), F.col("route_id").alias("gov_route_id"))
    raw = gov.trips.join(own_routes.select("route_id", "gov_route_id").withColumnRenamed("route_id", "new_route_id"), F.col("route_id") == F.col("gov_route_id")).withColumn("pattern", F.concat(F.lit("FERRY-"), X.strip_departure(F.col("trip_id"))))
    times = gov.stop_times.withColumn("at", T.to_seconds(F.col("departure_time"))).join(raw.select("trip_id", "pattern"), "trip_id")
    first = times.groupBy("pattern", "trip_id").agg(F.min("at").alias("second"))
    sample = first.groupBy("pattern").agg(F.min_by("trip_id", F.struct("second", "trip_id")).alias("trip_id"), F.min("second").alias("start"), F.count_distinct("second").alias("n"))
    own_trips = raw.select("pattern", "new_route_id", "service_id").distinct().select(F.col("pattern").alias("trip_id"), F.col("new_route_id").alias("route_id"), F.concat(F.lit("FERRY-"), F.col("service_id")).alias("service_id"), F.col("service_id").alias("original_service_id"), F.when(X.part_of(F.col("pattern"), 2) == "2", 1).otherwise(0).alias("direction_id"))
    clock = T.to_clock(F.col("at") - F.col("start"))
    own_times = times.join(sample.select("pattern", "trip_id", "start"), ["pattern", "trip_id"]).select(F.col("pattern").alias("trip_id"), clock.alias("arrival_time"), clock.alias("departure_time"), F.concat(F.lit("FERRY-"), F.col("stop_id")).alias("stop_id"), "stop_sequence")
    runs = schedule.departure_blocks(first, "pattern", "second").withColumnRenamed("pattern", "trip_id")
    single = sample.where("n = 1").select(F.col("pattern").alias("trip_id"), "start", F.col("start").alias("end"), F.lit(86400).alias("headway"))
    own_stops = selection.referential(gov.stops, times, "stop_id").select(F.concat(F.lit("FERRY-"), F.col("stop_id")).alias("stop_id"), F.regexp_replace("stop_name", r"^\[[^\]]*\]\s*", "").alias("stop_name"), "stop_lat", "stop_lon")
    return Ferry(own_routes.drop("gov_route_id"), own_stops, selection.keep_first(own_trips, "trip_id", [F.col("service_id")]), own_times, clocked(runs.unionByName(single)))


# -- directions, shapes, headsigns ----------------------------------------------------------------


def trip_ends(times: DataFrame, places: DataFrame, lat: str = "stop_lat", lon: str = "stop_lon") -> DataFrame:
    """(trip_id, lat_first, lon_first, lat_last, lon_last)."""
    points = times.select("trip_id", "stop_id", "stop_sequence").join(places.select("stop_id", F.col(lat).alias("lat"), F.col(lon).alias("lon")), "stop_id")
    return spatial.ends(points, "trip_id", "stop_sequence", "lat", "lon")


def inversions(own_trips: DataFrame, times: DataFrame, places: DataFrame, gov: Gov) -> DataFrame:
    """Distances of our ends from the government's, as they are and turned; warning and flip."""
    mine = trip_ends(times, places)
    sample = gov_patterns(own_trips, gov).groupBy("trip_id").agg(F.min("gov_trip_id").alias("gov_trip_id"))
    theirs = trip_ends(gov.stop_times, gov.stops).select(F.col("trip_id").alias("gov_trip_id"), *(F.col(c).alias(f"g_{c}") for c in ("lat_first", "lon_first", "lat_last", "lon_last")))
    pairs = sample.join(mine, "trip_id").join(theirs, "gov_trip_id")
    names = ("lat_first", "lon_first", "lat_last", "lon_last")
    return spatial.inversion(pairs, names, tuple(f"g_{n}" for n in names))


def auto_invert(own_trips: DataFrame, found: DataFrame) -> DataFrame:
    """Trips that are to be flipped get the other government direction."""
    flips = found.where("flip").select("trip_id", F.lit(True).alias("_flip"))
    return own_trips.join(flips, "trip_id", "left").withColumn("gov_bound", F.when(F.col("_flip"), X.swap_bound(F.col("gov_bound"))).otherwise(F.col("gov_bound"))).drop("_flip")


def cooperative_flips(mine: DataFrame, other: DataFrame, keys: list[str], factor: float = 0.8) -> DataFrame:
    """Routes that two operators run together and of which one turns the direction round: an audit, no change.

    Both sides have keys and lat_first, lon_first, lat_last, lon_last; distances are planar, in degrees. A route is
    turned if its ends lie nearer to the other's opposite ends, by a factor.
    """
    names = ("lat_first", "lon_first", "lat_last", "lon_last")
    both = mine.join(other.select(*keys, *(F.col(n).alias(f"o_{n}") for n in names)), keys)
    d = lambda a, b: planar(F.col(f"lat_{a}"), F.col(f"lon_{a}"), F.col(f"o_lat_{b}"), F.col(f"o_lon_{b}"))
    out = both.withColumns({"aligned": d("first", "first") + d("last", "last"), "turned": d("first", "last") + d("last", "first")})
    return out.withColumn("flip", F.col("turned") < factor * F.col("aligned")).select(*keys, "aligned", "turned", "flip")


def sample_trips(gov: Gov) -> DataFrame:
    """(route_id, bound, trip_id): the least trip id of each route and direction, known by the id's direction part."""
    both = F.when(F.col("trip_id").like("%-%1-%"), "O").when(F.col("trip_id").like("%-%2-%"), "I")
    marked = gov.trips.withColumn("bound", F.coalesce(F.nullif(X.trip_direction(F.col("trip_id")), F.lit("UNKNOWN")), both)).where("bound IS NOT NULL")
    return marked.groupBy("route_id", "bound").agg(F.min("trip_id").alias("trip_id"))


def area_stops(groups: DataFrame) -> DataFrame:
    """(area_id, stop_id) of areas with arrays of stops, each pair once."""
    return groups.select("area_id", F.explode("stop_ids").alias("stop_id")).distinct()


def shapes(waypoints: DataFrame) -> DataFrame:
    """Points of polylines with the metres from their beginning."""
    long = waypoints.select(F.concat_ws("-", "route_id", "bound").alias("shape_id"), F.posexplode("points").alias("place", "p"))
    points = long.select("shape_id", (F.col("place") + 1).alias("shape_pt_sequence"), F.get("p", F.lit(1)).alias("shape_pt_lat"), F.get("p", F.lit(0)).alias("shape_pt_lon"))
    return spatial.along(points, "shape_id", "shape_pt_sequence", "shape_pt_lat", "shape_pt_lon", "shape_dist_traveled").withColumn("shape_dist_traveled", F.round("shape_dist_traveled", 2))


def match_shapes(own_trips: DataFrame, waypoints: DataFrame, gov_routes: DataFrame, margin: float = 500.0, ends: DataFrame | None = None) -> DataFrame:
    """Trips with a shape of their government route and direction, of an agency that they may use; else null.

    Trips without a government route take the first shape of their short name and direction. With ``ends``
    (trip_ends), a shape that fits turned round by more than a margin gives way to that of the other direction.
    """
    shape = F.concat_ws("-", "route_id", "bound").alias("_shape")
    own = waypoints.join(gov_routes.select("route_id", "agency_id", F.col("route_short_name").alias("route")), "route_id").select(F.col("route_id").alias("gov_route_id"), "bound", "agency_id", "route", shape, "points")
    allowed = F.lit(False)
    for agency, names in SHAPE_AGENCIES.items():
        allowed = allowed | ((F.col("agency") == agency) & F.col("agency_id").isin(*names))
    asked = own_trips.select("trip_id", "agency", "route", "gov_route_id", F.when(F.col("direction_id") == 1, "I").otherwise("O").alias("bound"))
    direct = asked.where("gov_route_id IS NOT NULL").drop("route").join(own.drop("route"), ["gov_route_id", "bound"]).where(allowed)
    named = asked.where("gov_route_id IS NULL").drop("gov_route_id").join(own, ["route", "bound"]).where(allowed)
    found = selection.keep_first(direct.select("trip_id", "gov_route_id", "bound", "_shape", "points").unionByName(named.select("trip_id", "gov_route_id", "bound", "_shape", "points")), "trip_id", [F.col("_shape")])
    if ends is not None:
        point = lambda i, j: F.element_at(F.element_at("points", i), j)
        far = found.join(ends, "trip_id", "left").withColumns({"s_lat": point(1, 2), "s_lon": point(1, 1), "e_lat": point(-1, 2), "e_lon": point(-1, 1)})
        turned = spatial.inversion(far, ("lat_first", "lon_first", "lat_last", "lon_last"), ("s_lat", "s_lon", "e_lat", "e_lon"), margin)
        other = own.select("gov_route_id", X.swap_bound(F.col("bound")).alias("bound"), F.col("_shape").alias("_other"))
        found = turned.join(other, ["gov_route_id", "bound"], "left").withColumn("_shape", F.when(F.coalesce("warning", F.lit(False)), F.coalesce("_other", "_shape")).otherwise(F.col("_shape")))
    return own_trips.join(found.select("trip_id", F.col("_shape").alias("shape_id")), "trip_id", "left").select(*own_trips.columns, "shape_id")


def headsigns(own_trips: DataFrame, language: str = "en", rail: DataFrame | None = None) -> DataFrame:
    """trip_headsign: the route's destination, for rail the terminal, else the route's short name."""
    given = F.col(f"dest_{language}")
    out = own_trips
    if rail is not None:
        out = out.join(rail.select("trip_id", F.col(language).alias("_terminal")), "trip_id", "left")
        given = F.coalesce("_terminal", given)
    text = X.without_none(given)
    short = X.route_short_name(F.col("route_id"))
    return out.withColumn("trip_headsign", F.when(F.trim(text) == "", short).otherwise(text)).drop("_terminal")


# -- pathways -------------------------------------------------------------------------------------


def pathways(platforms: DataFrame, entrances: DataFrame, exits: DataFrame, exit_walks: DataFrame, platform_walks: DataFrame) -> DataFrame:
    """Walks between platforms and entrances, and between platforms; pairs of a station without one take 60 seconds.

    platforms: station_code, amenity_id, stop_id. entrances: station_code, station_name, exit, stop_id.
    exits: amenity_id, ref, name_en, name_zh.
    """
    stop = lambda aid, name: platforms.select(F.col("amenity_id").alias(aid), F.col("stop_id").alias(name)).distinct()
    code = exits.select(F.col("amenity_id").alias("exit_amenity_id"), X.exit_code(F.col("ref"), F.col("name_en"), F.col("name_zh")).alias("exit"))
    own = entrances.select(X.norm_text(F.col("station_code")).alias("station_code"), X.norm_text(F.col("station_name")).alias("station_name"), X.norm_text(F.col("exit")).alias("exit"), "stop_id")
    names = own.groupBy("station_code").agg(F.min("station_name").alias("station_name"))
    asked = exit_walks.withColumn("station_code", X.norm_text(F.col("station_code"))).join(code, "exit_amenity_id").join(names, "station_code", "left")
    by_code, by_name = (own.groupBy(k, "exit").agg(F.min("stop_id").alias("stop_id")) for k in ("station_code", "station_name"))
    found = selection.first_of(asked, (by_code, ["station_code", "exit"], "stop_id"), (by_name, ["station_name", "exit"], "stop_id"), into="to_stop_id").join(stop("platform_amenity_id", "from_stop_id"), "platform_amenity_id").where("to_stop_id IS NOT NULL")
    row = lambda ident: (ident.alias("pathway_id"), "from_stop_id", "to_stop_id", F.col("walk_distance_metres").alias("length"), (F.coalesce("walk_time_minutes", F.lit(0.0)) * 60).alias("traversal_time"))
    walks = found.select(*row(F.concat_ws("-", F.lit("MTR-PATH-PEX"), "platform_amenity_id", "exit_amenity_id")))
    across = platform_walks.join(stop("start_platform_amenity_id", "from_stop_id"), "start_platform_amenity_id").join(stop("end_platform_amenity_id", "to_stop_id"), "end_platform_amenity_id").select(*row(F.concat_ws("-", F.lit("MTR-PATH-PP"), "start_platform_amenity_id", "end_platform_amenity_id")))
    known = walks.unionByName(across)
    p = platforms.select("station_code", F.col("stop_id").alias("p")).distinct()
    to_exit = p.join(entrances.select("station_code", F.col("stop_id").alias("e")).distinct(), "station_code").select(F.col("p").alias("from_stop_id"), F.col("e").alias("to_stop_id"), F.lit("DUMMY-PEX").alias("kind"))
    between = selection.missing_pairs(p, "station_code", "p", known, "from_stop_id", "to_stop_id").select(F.col("low").alias("from_stop_id"), F.col("high").alias("to_stop_id"), F.lit("DUMMY-PP").alias("kind"))
    done = known.select(F.least("from_stop_id", "to_stop_id").alias("low"), F.greatest("from_stop_id", "to_stop_id").alias("high")).distinct()
    gaps = to_exit.withColumns({"low": F.least("from_stop_id", "to_stop_id"), "high": F.greatest("from_stop_id", "to_stop_id")}).join(done, ["low", "high"], "left_anti").drop("low", "high").unionByName(between)
    dummies = gaps.select(F.concat_ws("-", "kind", "from_stop_id", "to_stop_id").alias("pathway_id"), "from_stop_id", "to_stop_id", F.lit(None).cast("double").alias("length"), F.lit(60.0).alias("traversal_time"))
    whole = lambda c: F.bround(F.col(c)).cast("int").alias(c)
    return known.unionByName(dummies).select("pathway_id", "from_stop_id", "to_stop_id", F.lit(1).alias("pathway_mode"), F.lit(1).alias("is_bidirectional"), whole("length"), whole("traversal_time"))


# -- fares ----------------------------------------------------------------------------------------


def directed(own_trips: DataFrame) -> DataFrame:
    """(trip_id, gov_route_id, gov_direction) of the trips that have a government route."""
    return own_trips.where("gov_route_id IS NOT NULL").select("trip_id", "gov_route_id", F.when(F.col("direction_id") == 1, 2).otherwise(1).alias("gov_direction")).distinct()


def trip_fares(own_trips: DataFrame, fare_rules: DataFrame, fare_attributes: DataFrame) -> DataFrame:
    """(trip_id, start_seq, end_seq, price, currency): fares of a trip's government route and direction.

    Both fare tables have a row for each pair of stops of a route, and an estimate of a table that is exploded doesn't
    count its rows; so they are merged, never broadcast.
    """
    part = lambda i: X.part_of(F.col("fare_id"), i)
    keyed = fare_rules.select("fare_id", part(0).alias("gov_route_id"), part(1).try_cast("int").alias("gov_direction"), part(2).try_cast("int").alias("start_seq"), part(3).try_cast("int").alias("end_seq"))
    priced = keyed.join(fare_attributes.select("fare_id", "price", F.col("currency_type").alias("currency")).hint("merge"), "fare_id")
    return directed(own_trips).join(priced.hint("merge"), ["gov_route_id", "gov_direction"]).select("trip_id", "start_seq", "end_seq", "price", "currency")


def fare_stages(priced: DataFrame, times: DataFrame) -> DataFrame:
    """A row at each stop from which the price changes; the price of a stop is that of its nearest alighting."""
    first = priced.groupBy("trip_id", F.col("start_seq").alias("stop_sequence")).agg(F.min_by("price", "end_seq").alias("price"), F.min_by("currency", "end_seq").alias("currency"))
    at = times.select("trip_id", "stop_id", F.col("stop_sequence").cast("string").try_cast("int").alias("stop_sequence")).join(first, ["trip_id", "stop_sequence"])
    return schedule.change_points(at, "trip_id", "stop_sequence", "price").select("trip_id", F.col("stop_id").alias("from_stop_id"), "price", "currency")


def fare_mismatches(own_trips: DataFrame, times: DataFrame, gov: Gov) -> DataFrame:
    """Trips whose number of stops differs from that of a sample government trip."""
    key = F.concat_ws("-", X.part_of(F.col("trip_id"), 0), X.part_of(F.col("trip_id"), 1))
    sample = gov.stop_times.withColumn("key", key).withColumn("gov_sample", F.min("trip_id").over(Window.partitionBy("key"))).where("trip_id = gov_sample").groupBy("key", "gov_sample").agg(F.max("stop_sequence").alias("gov_stop_count"))
    mine = own_trips.where("gov_route_id IS NOT NULL").select("trip_id", F.concat_ws("-", "gov_route_id", F.when(F.col("direction_id") == 1, "2").otherwise("1")).alias("key")).join(times.groupBy("trip_id").agg(F.max(F.col("stop_sequence").cast("string").try_cast("int")).alias("our_stop_count")), "trip_id")
    return mine.join(sample, "key").where("our_stop_count <> gov_stop_count").select("trip_id", "our_stop_count", "gov_sample", "gov_stop_count")


def route_prices(fare_rules: DataFrame, fare_attributes: DataFrame) -> DataFrame:
    """(gov_route_id, gov_direction, start_seq, end_seq, price, currency): one fare for each pair of stops of a government route, the dearest.

    Rules and attributes of a fare meet where the fares of their route lie, so that all that is asked of a route needs no
    other shuffle. There are as many parts as the session has for shuffles: fares are short in files and long in memory.
    """
    part = lambda i: X.part_of(F.col("fare_id"), i)
    rules = fare_rules.select("fare_id", F.lit(True).alias("_rule"))
    prices = fare_attributes.select("fare_id", "price", F.col("currency_type").alias("currency"), F.lit(True).alias("_priced"))
    both = rules.unionByName(prices, allowMissingColumns=True).where("fare_id IS NOT NULL")
    both = both.repartition(int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")), part(0))
    routed = both.withColumns({"gov_route_id": part(0), "_key": F.xxhash64("fare_id")})
    # numbers are sorted first
    met = routed.withColumn("_met", F.max("_rule").over(Window.partitionBy("_key", "gov_route_id", "fare_id"))).where("_met AND _priced")
    keyed = met.select("gov_route_id", *(part(i).try_cast("int").alias(name) for i, name in ((1, "gov_direction"), (2, "start_seq"), (3, "end_seq"))), "price", "currency")
    return keyed.groupBy("gov_route_id", "gov_direction", "start_seq", "end_seq").agg(F.max("price").alias("price"), F.max("currency").alias("currency"))


def calls(own_trips: DataFrame, patterns: DataFrame) -> DataFrame:
    """(trip_id, stop_id, stop_sequence): the stops of every trip, without times."""
    return own_trips.select("trip_id", "agency", "route_key").join(patterns, ["agency", "route_key"]).select("trip_id", "stop_id", F.col("sequence").alias("stop_sequence"))


def special_fares(own_trips: DataFrame, fare_rules: DataFrame, fare_attributes: DataFrame, called: DataFrame) -> DataFrame:
    """Trip rules for prices that hold for a limited range only; of equal destinations and prices the earliest boarding.

    Ranges are found once for each government route and direction, not for each of its trips, of which each has one route. What they
    are asked of a trip's stops (called: trip_id, stop_id, stop_sequence) is settled where these lie together. Ranges are merged,
    as an estimate of fares that are exploded doesn't count their rows.
    """
    ranges = fares.price_ranges(route_prices(fare_rules, fare_attributes), ["gov_route_id", "gov_direction"], "currency")
    found = directed(own_trips).join(ranges.hint("merge"), ["gov_route_id", "gov_direction"]).drop("gov_route_id", "gov_direction")
    at = called.select("trip_id", F.struct(F.col("stop_sequence").cast("string").try_cast("int").alias("seq"), "stop_id").alias("_call")).where("_call.seq IS NOT NULL")
    stops_of = at.groupBy("trip_id").agg(F.collect_list("_call").alias("_calls"))
    held = found.join(stops_of, "trip_id").where(F.col("max_end") < F.array_max("_calls.seq"))
    stop = lambda seq: F.explode(F.transform(F.filter("_calls", lambda e: e["seq"] == F.col(seq)), lambda e: e["stop_id"]))
    named = held.withColumn("onboarding_stop_id", stop("start_seq")).withColumn("offboarding_stop_id", stop("max_end"))
    first = selection.keep_first(named, ["trip_id", "offboarding_stop_id", "price"], [F.col("start_seq")])
    return first.select(F.concat_ws("-", "trip_id", *(F.col(c).cast("string") for c in ("start_seq", "min_end", "max_end", "price"))).alias("special_fare_id"), F.lit("trip").alias("rule_type"), "trip_id", "onboarding_stop_id", "offboarding_stop_id", "price", "currency")


# -- the whole ------------------------------------------------------------------------------------


def translate(silver: Silver, own_routes: DataFrame, own_trips: DataFrame) -> DataFrame:
    """Chinese names of stops, routes and headsigns, one for each key."""
    names = own_trips.groupBy("route_id").agg(F.min_by(F.concat_ws(" - ", "orig_tc", "dest_tc"), "trip_id").alias("tc"))
    parts = [calendars.translations(silver.stops, "stops.txt", "stop_name", "stop_id", zh_Hant="name_tc"), calendars.translations(own_routes.join(names, "route_id"), "routes.txt", "route_long_name", "route_id", zh_Hant="tc"), calendars.translations(headsigns(own_trips, "tc"), "trips.txt", "trip_headsign", "trip_id", zh_Hant="trip_headsign")]
    return selection.keep_first(selection.union_all(*parts), ["table_name", "field_name", "language", "record_id"], [F.col("translation")])


def build(parts: list[Silver], gov: Gov, edges: DataFrame, gov_calendar: DataFrame, gov_calendar_dates: DataFrame, fare_rules: DataFrame, fare_attributes: DataFrame, waypoints: DataFrame | None = None, stages: Stages | None = None, register: DataFrame | None = None, invert: bool = False) -> dict[str, DataFrame]:
    """All tables of a bus feed.

    What several tables need is a stage: written once and read again, so no plan repeats the steps before it, and a
    job that is started again on the folder of its stages skips those that are whole. The tables that joins make are
    stages too, so that one of them is worked on at a time. With ``invert``, trips whose ends
    lie at the government's other ends take its other direction.
    """
    spark = edges.sparkSession
    stage = stages or Stages(spark)
    gov = Gov(*(stage(f"gov_{name}", lambda df=df: df) for name, df in zip(Gov._fields, gov, strict=True)))
    read = Silver(*(stage(f"read_{name}", lambda i=i: together(parts)[i]) for i, name in enumerate(Silver._fields)))
    spliced = splice_one_way(read, gov)
    silver = read._replace(routes=stage("network_routes", lambda: spliced.routes), patterns=stage("network_patterns", lambda: spliced.patterns))
    matches = stage("matches", lambda: match(silver, gov, register))
    own_trips = stage("own_trips", lambda: trips(silver, matches))
    own_stops = stage("own_stops", lambda: stops(silver))
    times = stage("times", lambda: finalise_stop_times(stop_times(own_trips, silver.patterns, edges), own_stops))
    if invert:
        unturned = own_trips
        turned = stage("inversions", lambda: inversions(unturned, times, own_stops, gov))
        own_trips = stage("turned_trips", lambda: auto_invert(unturned, turned))
    priced = stage("trip_fares", lambda: trip_fares(own_trips, fare_rules, fare_attributes))
    if waypoints is None:
        shaped = own_trips.withColumn("shape_id", F.lit(None).cast("string"))
    else:
        ways = stage("waypoints", lambda: waypoints)
        shaped = stage("shaped_trips", lambda: match_shapes(own_trips, ways, gov.routes, ends=trip_ends(times, own_stops)))
    own_routes = stage("own_routes", lambda: routes(silver))
    out = {
        "agency": agencies(spark),
        "stops": own_stops,
        "routes": own_routes,
        "trips": headsigns(shaped),
        "stop_times": times,
        "frequencies": stage("frequencies", lambda: frequencies(own_trips, gov)),
        "calendar": stage("calendar", lambda: calendars.calendar(own_trips, gov_calendar)),
        "calendar_dates": stage("calendar_dates", lambda: calendars.calendar_dates(own_trips, gov_calendar_dates)),
        "translations": stage("translations", lambda: translate(silver, own_routes, own_trips)),
        "fare_stages": stage("fare_stages", lambda: fare_stages(priced, times)),
        "special_fare_rules": stage("special_fare_rules", lambda: special_fares(own_trips, fare_rules, fare_attributes, times)),
    }
    if waypoints is not None:
        out["shapes"] = stage("shapes", lambda: selection.referential(shapes(ways), shaped.where("shape_id IS NOT NULL"), "shape_id"))
    return out


def agencies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, n, u, fixed.TIMEZONE, fixed.LANGUAGE) for i, n, u in fixed.AGENCIES], "agency_id string, agency_name string, agency_url string, agency_timezone string, agency_lang string")
