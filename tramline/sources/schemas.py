"""Declared schemas of what is read: nothing is inferred."""

from __future__ import annotations

#: Government schedule feed, by file.
GOV = {
    "agency": "agency_id string, agency_name string, agency_url string, agency_timezone string, agency_lang string",
    "routes": "route_id string, agency_id string, route_short_name string, route_long_name string, route_type int",
    "trips": "route_id string, service_id string, trip_id string",
    "stop_times": "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int",
    "stops": "stop_id string, stop_name string, stop_lat double, stop_lon double",
    "frequencies": "trip_id string, start_time string, end_time string, headway_secs int",
    "calendar": "service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int, start_date int, end_date int",
    "calendar_dates": "service_id string, date int, exception_type int",
    "fare_attributes": "fare_id string, price double, currency_type string",
    "fare_rules": "fare_id string, route_id string",
}
#: Operators' JSON: rows of ``data``.
KMB = {
    "routes": "route string, bound string, service_type string, orig_en string, orig_tc string, orig_sc string, dest_en string, dest_tc string, dest_sc string",
    "stops": "stop string, name_en string, name_tc string, name_sc string, lat string, long string",
    "route_stops": "route string, bound string, service_type string, seq string, stop string",
}
CTB = {
    "routes": "route string, orig_en string, orig_tc string, orig_sc string, dest_en string, dest_tc string, dest_sc string",
    "sequences": "route_id string, direction string, stop_ids array<string>",
    "stops": "stop string, name_en string, name_tc string, lat string, long string",
}
NLB = {
    "routes": "routeId string, routeNo string, routeName_c string, routeName_s string, routeName_e string",
    "stops": "stopId string, stopName_c string, stopName_s string, stopName_e string, stopLocation_c string, stopLocation_s string, latitude string, longitude string",
}
GMB = {
    "routes": "region string, route_code string",
    "directions": "route_id bigint, route_seq int, region string, route_code string, orig_en string, orig_tc string, orig_sc string, dest_en string, dest_tc string, dest_sc string, variant_description_en string",
    "route_stops": "route_id bigint, route_seq int, region string, route_code string, stop_id string, sequence int, stop_name_en string, stop_name_tc string, stop_name_sc string, variant_description_en string",
    "stops": "stop_id string, coordinates struct<wgs84:struct<latitude:double,longitude:double>>",
}
MTR_BUS = {
    "routes": "route_id string, route_name_chi string, route_name_eng string, is_circular string",
    "route_stops": "route_id string, direction string, station_seqno string, station_id string, station_latitude string, station_longitude string, station_name_chi string, station_name_eng string",
}
RAIL = {
    "lines_and_stations": "`Line Code` string, Direction string, `Station Code` string, `Station ID` string, `Chinese Name` string, `English Name` string, Sequence string",
    "fares": "SRC_STATION_ID string, DEST_STATION_ID string, OCT_ADT_FARE string",
    "light_rail_stops": "route string, bound string, stop_code string, stop_id string, name_tc string, name_en string, seq string",
    "light_rail_fares": "from_station_id string, to_station_id string, fare_octo_adult string",
}
PLATFORMS = "map<string,struct<amenity_id:string,ref:string,name_en:string,name_zh:string,coordinates:struct<lat:double,lon:double>,lines_and_directions:array<struct<line_code:string,direction:string,destination_station_code:string>>>>"
EXITS = "map<string,struct<amenity_id:string,ref:string,name_en:string,name_zh:string>>"
BARRIER_FREE = "station_id string, item string, has string, place string"
REGISTER = "ROUTE_ID string, COMPANY_CODE string, ROUTE_NAMEC string, SPECIAL_TYPE int"
STATIONS = "map<string,struct<platforms:array<string>>>"
JOURNEYS = {
    "exits": "platform_amenity_id string, exit_amenity_id string, station_code string, walk_distance_metres double, walk_time_minutes double",
    "platforms": "start_platform_amenity_id string, end_platform_amenity_id string, walk_distance_metres double, walk_time_minutes double",
}
GEOJSON = "type string, features array<struct<type:string,properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
TRAM = "stop_code string, name string, lat double, lon double"

#: Output tables and their columns, in order.
FEED = {
    "agency": ["agency_id", "agency_name", "agency_url", "agency_timezone", "agency_lang"],
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon", "location_type", "parent_station", "platform_code"],
    "routes": ["route_id", "agency_id", "route_short_name", "route_long_name", "route_type", "network_id", "route_color", "route_text_color"],
    "trips": ["route_id", "service_id", "trip_id", "trip_headsign", "direction_id", "shape_id"],
    "stop_times": ["trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence"],
    "frequencies": ["trip_id", "start_time", "end_time", "headway_secs"],
    "shapes": ["shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence", "shape_dist_traveled"],
    "pathways": ["pathway_id", "from_stop_id", "to_stop_id", "pathway_mode", "is_bidirectional", "length", "traversal_time"],
    "calendar": ["service_id", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "start_date", "end_date"],
    "calendar_dates": ["service_id", "date", "exception_type"],
    "translations": ["table_name", "field_name", "language", "record_id", "translation"],
    "fare_stages": ["trip_id", "from_stop_id", "price", "currency"],
    "special_fare_rules": ["special_fare_id", "rule_type", "trip_id", "onboarding_stop_id", "offboarding_stop_id", "price", "currency"],
}
KEYS = {"agency": ["agency_id"], "stops": ["stop_id"], "routes": ["route_id"], "trips": ["trip_id"], "stop_times": ["trip_id", "stop_sequence"], "frequencies": ["trip_id", "start_time"], "shapes": ["shape_id", "shape_pt_sequence"], "pathways": ["pathway_id"], "calendar": ["service_id"], "calendar_dates": ["service_id", "date"], "translations": ["table_name", "field_name", "language", "record_id"], "fare_stages": ["trip_id", "from_stop_id"], "special_fare_rules": ["special_fare_id"]}


def fields(schema: str) -> str:
    """The columns of a schema as the fields of a struct."""
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(schema).simpleString()[len("struct<") : -1]
