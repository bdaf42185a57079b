"""Operators' raw tables to one form: routes, stops and patterns that later steps share.

routes: agency, route, bound (O/I), service_type, route_key, orig_en, orig_tc, dest_en, dest_tc, is_circular
stops: stop_id (with the operator's prefix), name_en, name_tc, lat, lon
patterns: agency, route_key, stop_id, sequence
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions import text as X
from tramline.operators.schedule import merge_overlap
from tramline.operators.selection import keep_first, primary_and_alternative, referential
from tramline.operators.spatial import greedy_clusters
from tramline.plans.fixed import CN_SEPARATORS


class Silver(NamedTuple):
    routes: DataFrame
    stops: DataFrame
    patterns: DataFrame


def _routes(df: DataFrame, agency: str, **columns: Column) -> DataFrame:
    names = ("route", "bound", "service_type", "route_key", "orig_en", "orig_tc", "dest_en", "dest_tc", "is_circular")
    return df.select(F.lit(agency).alias("agency"), *(columns.get(n, F.lit(None).cast("boolean" if n == "is_circular" else "string")).alias(n) for n in names))


def _stop_id(agency: str, column: str | Column) -> Column:
    return F.concat(F.lit(f"{agency}-"), (F.col(column) if isinstance(column, str) else column).cast("string"))


def _stops(df: DataFrame, agency: str, stop: str, en: Column, tc: Column, lat: str, lon: str) -> DataFrame:
    place = lambda c: F.col(c).cast("string").try_cast("double")
    out = df.select(_stop_id(agency, stop).alias("stop_id"), en.alias("name_en"), tc.alias("name_tc"), place(lat).alias("lat"), place(lon).alias("lon"))
    return keep_first(out, "stop_id", [F.col("name_en"), F.col("lat"), F.col("lon")])


def _patterns(df: DataFrame, agency: str, key: Column, stop: Column, sequence: Column) -> DataFrame:
    out = df.select(F.lit(agency).alias("agency"), key.alias("route_key"), stop.alias("stop_id"), X.sequence_number(sequence.cast("string")).alias("sequence"))
    return out.where("sequence IS NOT NULL")


def kmb(routes: DataFrame, stops: DataFrame, route_stops: DataFrame) -> Silver:
    key = F.concat_ws("-", "route", "bound", "service_type")
    c = F.col
    return Silver(
        _routes(routes, "KMB", route=c("route"), bound=c("bound"), service_type=c("service_type"), route_key=key, orig_en=X.smart_title_case(c("orig_en")), orig_tc=c("orig_tc"), dest_en=X.smart_title_case(c("dest_en")), dest_tc=c("dest_tc"), is_circular=X.is_circular(c("dest_en"), c("dest_tc"))),
        _stops(stops, "KMB", "stop", X.clean_stop_name(c("name_en")), X.clean_stop_name(c("name_tc"), title=False), "lat", "long"),
        _patterns(route_stops, "KMB", key, _stop_id("KMB", "stop"), c("seq")),
    )


def citybus(routes: DataFrame, stops: DataFrame, sequences: DataFrame) -> Silver:
    """Circular routes have one direction, outbound, of both arrays without what mirrors the turn; inbound routes swap their ends."""
    circular = routes.where(F.lower(F.concat_ws(" ", "dest_en", "dest_tc", "dest_sc")).contains("circular")).select(F.col("route").alias("route_id")).distinct().withColumn("circular", F.lit(True))
    marked = sequences.join(circular, "route_id", "left").withColumn("circular", F.coalesce("circular", F.lit(False)))
    side = lambda d: F.max(F.when(F.col("direction") == d, F.col("stop_ids")))
    both = marked.where("circular").groupBy("route_id").agg(side("outbound").alias("o"), side("inbound").alias("i"))
    merged = both.select("route_id", F.lit("outbound").alias("direction"), F.when(F.col("o").isNull(), F.col("i")).when(F.col("i").isNull(), F.col("o")).otherwise(merge_overlap(F.col("o"), F.col("i"))).alias("stop_ids"), F.lit(True).alias("circular"))
    all_ = marked.where("NOT circular").select("route_id", "direction", "stop_ids", "circular").unionByName(merged)
    joined = routes.withColumnRenamed("route", "route_id").join(all_.select("route_id", "direction", "circular").distinct(), "route_id")
    swap = (F.col("direction") == "inbound") & ~F.col("circular")
    end = lambda a, b: F.when(swap, F.col(b)).otherwise(F.col(a))
    bound = X.direction_letter(F.col("direction"))
    key = F.concat_ws("-", "route_id", bound)
    long = all_.select("route_id", "direction", F.posexplode("stop_ids").alias("place", "stop"))
    return Silver(
        _routes(joined, "CTB", route=F.col("route_id"), bound=bound, service_type=F.lit("1"), route_key=key, orig_en=end("orig_en", "dest_en"), orig_tc=end("orig_tc", "dest_tc"), dest_en=X.with_circular(end("dest_en", "orig_en"), F.col("circular")), dest_tc=X.with_circular(end("dest_tc", "orig_tc"), F.col("circular")), is_circular=F.col("circular")),
        _stops(stops, "CTB", "stop", F.col("name_en"), F.col("name_tc"), "lat", "long"),
        _patterns(long, "CTB", key, _stop_id("CTB", "stop"), F.col("place") + 1),
    )


def green_minibus(directions: DataFrame, stops: DataFrame, route_stops: DataFrame) -> Silver:
    """Directions and stops come from readers.green_minibus; of variants of a direction the one with most stops stays."""
    ranked = primary_and_alternative(directions, ["route_id", "region", "route_code"], [F.col("route_seq")], ["orig_en", "dest_en", "orig_tc", "dest_tc"])
    circular = directions.groupBy("route_id").agg(F.bool_or("is_circular").alias("is_circular"))
    counted = route_stops.groupBy("region", "route_code", "route_seq", "route_id").agg(F.count("*").alias("n"))
    best = keep_first(counted, ["region", "route_code", "route_seq"], [F.desc("n"), F.col("route_id")])
    kept = route_stops.join(best.select("region", "route_code", "route_seq", "route_id"), ["region", "route_code", "route_seq", "route_id"], "left_semi")
    code = F.concat_ws("-", "region", "route_code")
    bound = F.when(F.col("route_seq") == 2, "I").otherwise("O")
    key = F.concat_ws("-", code, bound)
    own = best.join(ranked, ["route_id", "region", "route_code"]).join(circular, "route_id", "left")
    back = F.col("route_seq") == 2
    end = lambda a, b: F.when(back, F.coalesce(f"{a}_alt", b)).otherwise(F.col(a))
    names = route_stops.groupBy("stop_id").agg(*(F.min_by(c, F.struct("route_id", "route_seq", "sequence")).alias(c) for c in ("stop_name_en", "stop_name_tc")))
    placed = stops.select("stop_id", F.col("coordinates.wgs84.latitude").alias("lat"), F.col("coordinates.wgs84.longitude").alias("lon")).join(names, "stop_id", "left")
    return Silver(
        _routes(own, "GMB", route=code, bound=bound, service_type=F.lit("1"), route_key=key, orig_en=end("orig_en", "dest_en"), orig_tc=end("orig_tc", "dest_tc"), dest_en=end("dest_en", "orig_en"), dest_tc=end("dest_tc", "orig_tc"), is_circular=F.col("is_circular")),
        _stops(placed, "GMB", "stop_id", F.col("stop_name_en"), F.col("stop_name_tc"), "lat", "lon"),
        _patterns(kept, "GMB", key, _stop_id("GMB", "stop_id"), F.col("sequence")),
    )


def mtr_bus(routes: DataFrame, route_stops: DataFrame) -> Silver:
    """Stops of equal places, or of one name within five metres, are one."""
    raw = route_stops.select("station_id", "station_name_eng", "station_name_chi", F.col("station_latitude").try_cast("double").alias("lat"), F.col("station_longitude").try_cast("double").alias("lon"), F.monotonically_increasing_id().alias("_order"))
    one = keep_first(raw, "station_id", [F.col("_order")])
    leader = greedy_clusters(one.where("lat IS NOT NULL AND lon IS NOT NULL"), "station_name_eng", "station_id", "_order", "lat", "lon")
    merged = route_stops.join(leader, "station_id", "left").withColumn("stop", F.coalesce("leader", "station_id"))
    kept = referential(one, leader, "station_id", "leader")
    parts = F.split("route_name_eng", " to ", 2)
    main = keep_first(routes, "route_id", [F.col("route_name_eng")])
    both = merged.select("route_id", "direction").distinct().join(main, "route_id")
    out = F.col("direction") == "O"
    cn = X.split_first(F.col("route_name_chi"), CN_SEPARATORS)
    first, last = F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0)))
    key = F.concat_ws("-", "route_id", "direction")
    return Silver(
        _routes(both, "MTRB", route=F.col("route_id"), bound=F.col("direction"), service_type=F.lit("1"), route_key=key, orig_en=F.when(out, first).otherwise(last), dest_en=F.when(out, last).otherwise(first), orig_tc=F.when(out, cn["origin"]).otherwise(cn["destination"]), dest_tc=F.when(out, cn["destination"]).otherwise(cn["origin"]), is_circular=F.lower("is_circular").isin("true", "1", "y", "yes")),
        _stops(kept, "MTRB", "station_id", F.col("station_name_eng"), F.col("station_name_chi"), "lat", "lon"),
        _patterns(merged, "MTRB", key, _stop_id("MTRB", "stop"), F.col("station_seqno")),
    )


def nlb(routes: DataFrame, stops: DataFrame, sequences: DataFrame) -> Silver:
    """A number with two routes has them as directions by the lesser id; any other number has outbound ones only."""
    en, tc = X.split_name_pair(F.col("routeName_e")), X.split_name_pair(F.col("routeName_c"))
    by_number = Window.partitionBy("routeNo")
    numbered = routes.withColumns({"_n": F.count("*").over(by_number), "_k": F.row_number().over(by_number.orderBy("routeId")), "en": en, "tc": tc})
    bound = F.when((F.col("_n") == 2) & (F.col("_k") == 2), "I").otherwise("O")
    return Silver(
        _routes(numbered, "NLB", route=F.col("routeNo"), bound=bound, service_type=F.lit("1"), route_key=F.col("routeId"), orig_en=F.col("en.origin"), orig_tc=F.col("tc.origin"), dest_en=F.col("en.destination"), dest_tc=F.col("tc.destination"), is_circular=X.is_circular(F.col("routeName_e"), F.col("routeName_c"))),
        _stops(stops, "NLB", "stopId", F.col("stopName_e"), F.col("stopName_c"), "latitude", "longitude"),
        _patterns(sequences, "NLB", F.col("routeId"), _stop_id("NLB", "stopId"), F.col("sequence")),
    )
