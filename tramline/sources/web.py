"""Publishers that answer page by page, as a Spark source: a task asks for some pages, and tries again by itself.

``pages`` is a DataFrame of answers. What is asked for is made of tables that were landed before, so the driver holds
keys (routes, stops) and never an answer. Tables are landed as JSON lines; a table of which a page fails for good is not
landed. Which rows count is decided where they are read, not here.
"""

from __future__ import annotations

import json
import urllib.parse
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tramline.sources import endpoints, fetch, readers, schemas

#: Pages that a task asks for, one after another.
PER_TASK = 8


class Asked(InputPartition):
    def __init__(self, pages: list[tuple[str, str]]):
        self.pages = pages


class PagesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.asked = [(key, url) for key, url in json.loads(options["asked"])]
        self.per_task, self.tries, self.wait, self.timeout = int(options["pertask"]), int(options["tries"]), options.get("wait"), float(options["timeout"])

    def partitions(self) -> list[Asked]:
        return [Asked(self.asked[k : k + self.per_task]) for k in range(0, len(self.asked), self.per_task)] or [Asked([])]

    def read(self, partition: Asked) -> Iterator[tuple[str, str]]:
        more = {} if self.wait is None else {"waits": lambda n: float(self.wait)}
        for key, url in partition.pages:
            body = fetch.get_bytes(url, timeout=self.timeout, tries=self.tries, parse=_text, **more)
            if body is not None:
                yield key, body


class Pages(DataSource):
    """Format ``pages``: (key, body) of each page that is there; ``asked`` lists keys and addresses as JSON."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "key string, body string"

    def reader(self, schema) -> PagesReader:
        return PagesReader({k.lower(): v for k, v in self.options.items()})


def _text(body: bytes) -> str:
    """The answer, if it is whole: what is no JSON is asked for again."""
    text = body.decode("utf-8-sig")
    json.loads(text)
    return text


class Manners(NamedTuple):
    """How a publisher is asked: pages of a task, tries of a page, seconds between them (None: the publishers' usual) and until a try ends."""

    per_task: int = PER_TASK
    tries: int = 35
    wait: float | None = None
    timeout: float = 30


def pages(spark: SparkSession, asked: Iterable[tuple[str, str]], manners: Manners = Manners()) -> DataFrame:
    """(key, body) of the pages at some addresses; those that are not there (404) have no row."""
    spark.dataSource.register(Pages)
    reader = spark.read.format("pages").option("asked", json.dumps(list(asked))).option("perTask", manners.per_task).option("tries", manners.tries).option("timeout", manners.timeout)
    return (reader if manners.wait is None else reader.option("wait", manners.wait)).load()


def _landed(df: DataFrame, raw: str, name: str) -> DataFrame:
    """The table below a folder as JSON lines, and read from there."""
    path = f"{raw}/{name}.jsonl"
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return df.sparkSession.read.schema(df.schema).json(path)


def _data(kind: str, field: str = "data") -> Column:
    return F.from_json("body", f"{field} {kind}")[field]


def _keys(df: DataFrame, *columns: str) -> list[str]:
    """The different keys of a table, joined by a bar: what the next pages are asked for by."""
    return sorted(r[0] for r in df.select(F.concat_ws("|", *(F.col(c).cast("string") for c in columns))).distinct().collect())


def _part(i: int) -> Column:
    return F.split_part("key", F.lit("|"), F.lit(i))


def _path(key: str) -> str:
    return "/".join(urllib.parse.quote(p, safe="") for p in key.split("|"))


def citybus(spark: SparkSession, raw: str, manners: Manners = Manners()) -> None:
    """Routes, an array of stops for each route and direction, and each stop's details."""
    base = endpoints.CITYBUS
    routes = _landed(pages(spark, [("", f"{base}/route/CTB")], manners).select(F.inline(_data(f"array<struct<{schemas.fields(schemas.CTB['routes'])}>>"))), raw, "ctb/routes")
    asked = [f"{route}|{way}" for route in _keys(routes, "route") for way in ("outbound", "inbound")]
    calls = pages(spark, [(k, f"{base}/route-stop/CTB/{_path(k)}") for k in asked], manners)
    ids = F.filter(F.transform(_data("array<struct<stop:string>>"), lambda s: s["stop"]), lambda s: s.isNotNull())
    sequences = _landed(calls.select(_part(1).alias("route_id"), _part(2).alias("direction"), ids.alias("stop_ids")).where("size(stop_ids) > 0"), raw, "ctb/sequences")
    stops = _keys(sequences.select(F.explode("stop_ids").alias("stop")), "stop")
    found = pages(spark, [(s, f"{base}/stop/{_path(s)}") for s in stops], manners).select(_data(f"struct<{schemas.fields(schemas.CTB['stops'])}>").alias("s"))
    _landed(found.where("s.stop IS NOT NULL").select("s.*"), raw, "ctb/stops")


def lantao(spark: SparkSession, raw: str, manners: Manners = Manners()) -> None:
    """Routes, their stops in order, and each stop once."""
    base = endpoints.LANTAO
    routes = _landed(pages(spark, [("", f"{base}/route.php?action=list")], manners).select(F.inline(_data(f"array<struct<{schemas.fields(schemas.NLB['routes'])}>>", "routes"))), raw, "nlb/routes")
    known = _keys(routes.where("routeId IS NOT NULL"), "routeId", "routeNo")
    asked = [(k, f"{base}/stop.php?{urllib.parse.urlencode({'action': 'list', 'routeId': k.split('|')[0]})}") for k in known]
    calls = pages(spark, asked, manners).select(_part(1).alias("routeId"), _part(2).alias("routeNo"), F.posexplode(_data(f"array<struct<{schemas.fields(schemas.NLB['stops'])}>>", "stops")).alias("place", "s"))
    calls = calls.where("s.stopId IS NOT NULL").withColumn("sequence", F.col("place") + 1)
    kept = _landed(calls.select("routeId", "routeNo", "sequence", "s.*"), raw, "nlb/calls")
    _landed(kept.select("routeId", "routeNo", "stopId", "sequence"), raw, "nlb/sequences")
    one = kept.groupBy("stopId").agg(F.min_by(F.struct(*(c for c in kept.columns if c.startswith("stop") and c != "stopId" or c in ("latitude", "longitude"))), F.struct("routeId", "sequence")).alias("s"))
    _landed(one.select("stopId", "s.*"), raw, "nlb/stops")


_NAMES = [f"{end}_{lang}" for end in ("orig", "dest") for lang in ("en", "tc", "sc")]


def minibus(spark: SparkSession, raw: str, manners: Manners = Manners()) -> None:
    """All variants of all routes of every region with their directions, the stops of each, and each stop's place."""
    base = endpoints.MINIBUS
    regions = pages(spark, [("", f"{base}/route")], manners).select(F.explode(_data("struct<routes:map<string,array<string>>>")["routes"]).alias("region", "codes")).select("region", F.explode("codes").alias("route_code"))
    regions = _landed(regions, raw, "gmb/routes")
    way = f"struct<route_seq:int,{','.join(f'{n}:string' for n in _NAMES)}>"
    variant = f"array<struct<route_id:bigint,description_en:string,description_tc:string,description_sc:string,directions:array<{way}>>>"
    found = pages(spark, [(k, f"{base}/route/{_path(k)}") for k in _keys(regions, "region", "route_code")], manners).select(_part(1).alias("region"), _part(2).alias("route_code"), F.inline(_data(variant)))
    found = found.withColumn("d", F.explode("directions")).where("route_id IS NOT NULL AND d.route_seq IS NOT NULL")
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    in_chinese = text("description_tc").contains("正常") | text("description_sc").contains("正常")
    described = F.when(~F.lower(text("description_en")).contains("normal") & in_chinese, F.trim(F.concat(F.lit("Normal "), text("description_en")))).otherwise(text("description_en"))
    directions = _landed(found.select("route_id", F.col("d.route_seq").alias("route_seq"), "region", "route_code", *(text(f"d.{n}").alias(n) for n in _NAMES), described.alias("variant_description_en")), raw, "gmb/directions")
    call = "struct<route_stops:array<struct<stop_id:bigint,stop_seq:int,name_en:string,name_tc:string,name_sc:string>>>"
    calls = pages(spark, [(k, f"{base}/route-stop/{_path(k)}") for k in _keys(directions, "route_id", "route_seq")], manners).select("key", F.inline(_data(call)["route_stops"]))
    own = directions.select(F.concat_ws("|", F.col("route_id").cast("string"), F.col("route_seq").cast("string")).alias("key"), "route_id", "route_seq", "region", "route_code", "variant_description_en")
    calls = own.join(calls, "key").where("stop_id IS NOT NULL AND stop_seq IS NOT NULL")
    calls = calls.select("route_id", "route_seq", "region", "route_code", "variant_description_en", F.col("stop_id").cast("string").alias("stop_id"), F.col("stop_seq").alias("sequence"), *(F.col(f"name_{lang}").alias(f"stop_name_{lang}") for lang in ("en", "tc", "sc")))
    calls = _landed(calls, raw, "gmb/route_stops")
    place = pages(spark, [(s, f"{base}/stop/{_path(s)}") for s in _keys(calls, "stop_id")], manners).select(F.col("key").alias("stop_id"), _data("struct<coordinates:struct<wgs84:struct<latitude:double,longitude:double>>>")["coordinates"].alias("coordinates"))
    _landed(place.where("coordinates IS NOT NULL"), raw, "gmb/stops")


def places(spark: SparkSession, raw: str, name: str, asked: list[str], manners: Manners = Manners()) -> None:
    """(name, rank, east, north, name_zh) of what the geocoder gives for each name, the first being the best."""
    found = pages(spark, [(n, f"{endpoints.GEOCODE}?{urllib.parse.urlencode({'q': n})}") for n in asked], manners)
    rows = found.select(F.col("key").alias("name"), F.posexplode(F.from_json("body", "array<struct<x:double,y:double,nameZH:string>>")).alias("place", "p"))
    _landed(rows.where("p.x IS NOT NULL AND p.y IS NOT NULL").select("name", (F.col("place") + 1).alias("rank"), F.col("p.x").alias("east"), F.col("p.y").alias("north"), F.col("p.nameZH").alias("name_zh")), raw, name)


def rail_places(spark: SparkSession, raw: str, manners: Manners = Manners()) -> None:
    """The places of the exits of all landed stations, and of all landed light-rail stops."""
    for file, schema, column, build, name in (("lines_and_stations", "lines_and_stations", "Chinese Name", readers.exits_name, "exit_places"), ("light_rail_stops", "light_rail_stops", "name_tc", readers.light_rail_name, "light_rail_places")):
        try:
            rows = readers.csv(spark, f"{raw}/rail/{file}.csv", schemas.RAIL[schema])
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                continue
            raise
        asked = rows.where(F.col(f"`{column}`").isNotNull()).select(build(F.col(f"`{column}`")).alias("name"))
        places(spark, raw, f"rail/{name}", _keys(asked, "name"), manners)


def fetch_all(spark: SparkSession, raw: str, get: Callable = fetch.get_json, get_bytes: Callable = fetch.get_bytes, post: Callable = fetch.get_json, hourly: bool = False, manners: Manners = Manners()) -> None:
    """Lands all sources that the feed is made of: whole files as they are, pages through Spark."""
    for source in (endpoints.kmb, endpoints.journey_times, endpoints.platforms, *([endpoints.hourly_journey_times] if hourly else [])):
        endpoints.land(raw, source(get))
    for publisher in (citybus, lantao, minibus):
        publisher(spark, raw, manners)
    endpoints.land(raw, endpoints.texts(get_bytes))
    rail_places(spark, raw, manners)
    endpoints.land(raw, dict(endpoints.waypoints(get_bytes)))
    for what in ("routes", "stations"):
        endpoints.land(raw, endpoints.overpass(post, what))
