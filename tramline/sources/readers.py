"""Readers of landed files. Each gives a DataFrame with a declared schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions import text as X
from tramline.functions.geo import wgs84
from tramline.operators.selection import keep_first, keep_last
from tramline.plans.alerts import EVENT, valid
from tramline.sources import schemas


#: Tables of a schedule feed that hold keys, numbers and times alone, so that no cell has a line break.
NO_TEXT = ("trips", "stop_times", "frequencies", "calendar", "calendar_dates", "fare_attributes", "fare_rules")


def json_data(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the ``data`` array of a JSON document."""
    return spark.read.schema(f"data array<struct<{schemas.fields(schema)}>>").option("multiLine", True).json(path).select(F.inline("data"))


def json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON array, or of JSON lines."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def rows_below(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table by its path without ending: JSON lines (``.jsonl``) if they are there, else a document (``.json``)."""
    try:
        return spark.read.schema(schema).json(f"{path}.jsonl")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    return json_rows(spark, f"{path}.json", schema)


def csv(spark: SparkSession, path: str, schema: str, header: bool = True, multi_line: bool = True) -> DataFrame:
    """A CSV file by its declared columns; a byte-order mark and HTML entities are taken out of texts.

    Quoted cells may hold separators, doubled quotes and line breaks. A file whose cells hold none of the
    last can be read in splits with ``multi_line`` off.
    """
    reader = spark.read.schema(schema).option("header", header).option("enforceSchema", True).option("mode", "PERMISSIVE")
    df = reader.option("quote", '"').option("escape", '"').option("multiLine", multi_line).csv(path)
    return df.select(*(X.unescape(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f"`{f.name}`") for f in df.schema))


def gov_feed(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """Tables of a schedule feed, by file name."""
    return {n: csv(spark, f"{folder}/{n}.txt", schemas.GOV[n], multi_line=n not in NO_TEXT) for n in names or schemas.GOV}


def region_codes(spark: SparkSession, path: str) -> DataFrame:
    """(region, route_code) of a document {region: [codes]}."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("region", "codes")).select("region", F.explode("codes").alias("route_code"))


def edges(spark: SparkSession, path: str) -> DataFrame:
    """(from_id, to_id, seconds) of documents {from: {to: seconds}}; what is not a map is left out."""
    text = spark.read.option("wholetext", True).text(path)
    outer = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("from_id", "inner"))
    inner = outer.select("from_id", F.explode(F.from_json("inner", "map<string,string>")).alias("to_id", "seconds"))
    return inner.select("from_id", "to_id", F.col("seconds").try_cast("double").alias("seconds"))


def by_key(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(key, value) of a document that is a map; schema is the map's type."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.explode(F.from_json("value", schema)).alias("key", "value"))


def hourly_edges(spark: SparkSession, folder: str) -> DataFrame:
    """(weekday, hour, from_id, to_id, seconds) of files WEEKDAY/HOUR.json."""
    text = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(folder).withColumn("path", F.col("_metadata.file_path"))
    place = F.regexp_extract("path", r"(\d+)/(\d+)\.json$", 1), F.regexp_extract("path", r"(\d+)/(\d+)\.json$", 2)
    outer = text.select(place[0].try_cast("int").alias("weekday"), place[1].try_cast("int").alias("hour"), F.explode(F.from_json("value", "map<string,string>")).alias("from_id", "inner"))
    return outer.select("weekday", "hour", "from_id", F.explode(F.from_json("inner", "map<string,string>")).alias("to_id", "seconds")).withColumn("seconds", F.col("seconds").try_cast("double"))


def waypoints(spark: SparkSession, folder: str, files: str = "*.json") -> DataFrame:
    """(route_id, bound, file, points) of GeoJSON files ROUTE-BOUND.json: all parts' points of the first feature, as [lon, lat]."""
    raw = spark.read.schema(schemas.GEOJSON).option("multiLine", True).option("pathGlobFilter", files).json(folder).withColumn("file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    one = raw.withColumn("f", F.get("features", F.lit(0))).where("f IS NOT NULL")
    line, parts = (F.from_json("f.geometry.coordinates", kind) for kind in ("array<array<double>>", "array<array<array<double>>>"))
    points = F.when(F.col("f.geometry.type") == "MultiLineString", F.flatten(parts)).when(F.col("f.geometry.type") == "LineString", line)
    bare = F.regexp_replace("file", r"\.json$", "")
    return one.select(F.coalesce(F.try_element_at("f.properties", F.lit("ROUTE_ID")), X.part_of(bare, 0)).alias("route_id"), F.element_at(F.split(bare, "-"), -1).alias("bound"), "file", points.alias("points")).where("points IS NOT NULL")


def wkt_points(spark: SparkSession, path: str) -> DataFrame:
    """(line, x, y) of tab-separated rows with a WKT POINT."""
    rows = spark.read.option("sep", "\t").schema("line string, wkt string").csv(path)
    pick = lambda i: F.regexp_extract("wkt", r"(?i)POINT\s*\(\s*(\S+)\s+(\S+?)\s*\)", i).try_cast("double")
    return rows.select("line", pick(1).alias("x"), pick(2).alias("y"))


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Valid events of all JSON files below a folder; a file holds one event or an array; schema files are skipped."""
    text = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(folder)
    text = text.where(~F.col("_metadata.file_path").endswith("schema.json") & ~F.coalesce(F.get_json_object("value", "$['$schema']").isNotNull(), F.lit(False)))
    many = F.when(F.trim("value").startswith("["), F.col("value")).otherwise(F.concat(F.lit("["), F.col("value"), F.lit("]")))
    kind = f"array<struct<{schemas.fields(EVENT)}>>"
    return valid(text.select(F.inline(F.from_json(many, kind))))


def citybus_sequences(raw: DataFrame) -> DataFrame:
    """(route_id, direction, stop_id, sequence from 1, unique_route_id) of arrays of stops."""
    long = raw.select("route_id", "direction", F.posexplode("stop_ids").alias("p", "stop_id"))
    return long.select("route_id", "direction", "stop_id", (F.col("p") + 1).alias("sequence"), F.concat_ws("-", "route_id", "direction").alias("unique_route_id"))


def green_minibus(directions: DataFrame, route_stops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Directions and stops of the normal variants, of all variants where a route has no normal one; circular routes marked."""
    from pyspark.sql import Window

    normal = F.lower(F.trim(F.coalesce("variant_description_en", F.lit("")))).contains("normal")
    has = F.max(normal.cast("int")).over(Window.partitionBy("region", "route_code"))
    kept = lambda df: df.withColumns({"_normal": normal, "_has": has}).where("_has = 0 OR _normal").drop("_normal", "_has")
    own = keep_first(kept(directions), ["route_id", "route_seq"], [F.col("variant_description_en")])
    own = own.withColumn("is_circular", X.is_circular(*(F.col(c) for c in ("orig_en", "dest_en", "orig_tc", "dest_tc", "orig_sc", "dest_sc"))))
    return own, keep_first(kept(route_stops), ["route_id", "route_seq", "sequence"], [F.col("stop_id")])


def exits_name(station: Column) -> Column:
    """What the geocoder is asked for a station's exits."""
    return F.concat(F.lit("港鐵"), station, F.lit("站進出口"))


def exit_name(station: Column, exit_: Column) -> Column:
    """What the geocoder calls an exit."""
    return F.concat(F.lit("港鐵"), station, F.lit("站-"), exit_, F.lit("進出口"))


def light_rail_name(stop: Column) -> Column:
    return F.concat(stop, F.lit("輕鐵站"))


def station_exits(stations: DataFrame, found: DataFrame, built: Column | None = None) -> DataFrame:
    """Exits A to Z and A1 to Z9 of stations whose built name the geocoder knows; lift access; the last of equal ones.

    found has name, east, north and facility (a list of exits with a lift). The name is built of the station's columns
    and ``exit``; from the English name if nothing is said.
    """
    letters = [chr(65 + i) for i in range(26)]
    codes = F.array(*(F.lit(x) for x in letters + [f"{a}{n}" for a in letters for n in range(1, 10)]))
    wanted = stations.select("station_code", "station_name_en", "station_name_zh", F.explode(codes).alias("exit"))
    wanted = wanted.withColumn("name", F.concat(F.upper("station_name_en"), F.lit(" STATION EXIT "), F.col("exit")) if built is None else built)
    own = wanted.join(found.withColumn("_order", F.monotonically_increasing_id()), "name")
    own = own.withColumn("_place", wgs84("east", "north")).withColumn("barrier_free", F.array_contains(X.exit_codes(F.coalesce("facility", F.lit(""))), F.col("exit")))
    return keep_last(own, ["station_code", "exit"], ["_order"]).select("station_code", "station_name_en", "station_name_zh", "exit", F.col("_place.lat").alias("lat"), F.col("_place.lon").alias("lon"), "barrier_free")


def geocoded(stations: DataFrame, geocodes: DataFrame, name: str) -> DataFrame:
    """Stations with the place of the first geocode of their name; null without one. geocodes has name, rank, east, north."""
    first = keep_first(geocodes, "name", [F.col("rank")]).select(F.col("name").alias(name), wgs84("east", "north").alias("_place"))
    return stations.join(first, name, "left").select(*stations.columns, F.col("_place.lat").alias("lat"), F.col("_place.lon").alias("lon"))


def tram_stops(en: DataFrame, tc: DataFrame, sc: DataFrame) -> DataFrame:
    """Stops with their names in three languages."""
    named = lambda df, lang: df.select("stop_code", F.col("name").alias(f"name_{lang}"))
    return en.withColumnRenamed("name", "name_en").join(named(tc, "tc"), "stop_code", "left").join(named(sc, "sc"), "stop_code", "left")


def overpass(spark: SparkSession, path: str) -> DataFrame:
    """(type, id, lat, lon, tags) of an Overpass answer."""
    kind = "elements array<struct<type:string,id:bigint,lat:double,lon:double,tags:map<string,string>>>"
    return spark.read.schema(kind).option("multiLine", True).json(path).select(F.inline("elements"))


def headways(cells: DataFrame, id_column: str) -> DataFrame:
    """(line, morning_peak, evening_peak, non_peak, saturdays, sundays_and_holidays) of a table whose first column names lines."""
    names = ("line", "morning_peak", "evening_peak", "non_peak", "saturdays", "sundays_and_holidays")
    body = cells.where("NOT is_header").groupBy(id_column, "table_no", "row_no").agg(*(F.max(F.when(F.col("cell_no") == i, F.nullif(F.trim("text"), F.lit("")))).alias(n) for i, n in enumerate(names)))
    return body.where("line IS NOT NULL").select(*names)
