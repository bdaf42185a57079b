"""The publishers' endpoints, and those that answer with whole files, brought into the layout that the feed command reads.

Every function takes ``get``, which gives the JSON of a URL (``fetch.get_json``) or its bytes, and returns what
is to be written; a few files, so nothing here runs on Spark. Answers that are not there are left out. Publishers that
answer page by page are a Spark source (``web``).
"""

from __future__ import annotations

import io
import json
import os
import urllib.parse
import zipfile
from collections.abc import Callable, Iterator

from tramline.plans import fixed
from tramline.sources import fetch

#: Where the public data are.
KMB = "https://data.etabus.gov.hk/v1/transport/kmb"
CITYBUS = "https://rt.data.gov.hk/v2/transport/citybus"
LANTAO = "https://rt.data.gov.hk/v2/transport/nlb"
MINIBUS = "https://data.etagmb.gov.hk"
GOV = "https://static.data.gov.hk/td/pt-headway-en"
MTR = "https://opendata.mtr.com.hk/data"
TRAM = "https://static.data.gov.hk/tramways/datasets"
GEOCODE = "https://geodata.gov.hk/gs/api/v1.0.0/locationSearch"
OVERPASS = "https://overpass-api.de/api/interpreter"
JOURNEYS = "https://raw.githubusercontent.com/HK-Bus-ETA/hk-bus-time-between-stops/pages"
WAYPOINTS = "https://codeload.github.com/hkbus/route-waypoints/zip/refs/heads/gh-pages"
HEADWAYS = "https://www.mtr.com.hk/en/customer/services/train_service_index.html"
PLATFORMS = "https://raw.githubusercontent.com/wheelstransit/mtr-platform-exits-crawler/refs/heads/main/data/output"
#: Files by the name under which they are landed.
MTR_FILES = {"mtr_bus/routes": "mtr_bus_routes", "mtr_bus/route_stops": "mtr_bus_stops", "mtr_bus/fares": "mtr_bus_fares", "rail/lines_and_stations": "mtr_lines_and_stations", "rail/fares": "mtr_lines_fares", "rail/light_rail_stops": "light_rail_routes_and_stops", "rail/light_rail_fares": "light_rail_fares", "rail/barrier_free": "barrier_free_facilities"}
GOV_FILES = ("routes", "trips", "stop_times", "stops", "frequencies", "calendar", "calendar_dates", "fare_attributes", "fare_rules")
#: Threads that ask one publisher.
THREADS = 20

Get = Callable[[str], object]
Files = dict[str, object]


def _data(answer) -> list:
    return (answer or {}).get("data") or []


def kmb(get: Get) -> Files:
    """Routes, stops and the stops of routes, as they are answered."""
    return {f"kmb/{name}.json": {"data": _data(get(f"{KMB}/{path}"))} for name, path in (("routes", "route"), ("stops", "stop"), ("route_stops", "route-stop"))}


def journey_times(get: Get) -> Files:
    return {"journey_times.json": get(f"{JOURNEYS}/times/all.json") or {}}


def platforms(get: Get) -> Files:
    """Platforms, stations and exits by key, and the walks between platforms and exits and between platforms."""
    whole = get(f"{PLATFORMS}/mtr_data_complete.json") or {}
    walks = {name: get(f"{PLATFORMS}/{file}.json") for name, file in (("exit_walks", "journeys"), ("platform_walks", "platform_journeys"))}
    made = {name: whole.get(name) for name in ("platforms", "stations", "exits")} | walks
    return {f"rail/{name}.json": answer for name, answer in made.items() if answer}


def hourly_journey_times(get: Get, threads: int = THREADS) -> Files:
    """One document for each weekday and hour."""
    asked = [(day, hour) for day in range(7) for hour in range(24)]
    found = fetch.fan_out(asked, lambda a: (a, get(f"{JOURNEYS}/times_hourly/{a[0]}/{a[1]:02d}/all.json")), threads)
    return {f"times_hourly/{day}/{hour:02d}.json": made for (day, hour), made in found if made}


#: Filters of the map's relations by what is asked for.
OVERPASS_FILTERS = {"routes": 'relation["type"="route"]["route"~"^(bus|trolleybus|minibus|train|tram|subway|ferry)$"]', "stations": "relation[name]"}


def overpass_query(what: str, box: tuple[float, float, float, float] = fixed.BOX) -> str:
    """A query for relations of a kind in a box, with the members that they name."""
    return f"[out:json][timeout:300];({OVERPASS_FILTERS[what]}({','.join(map(str, box))}););out body;>;out skel qt;"


def overpass(post: Callable[[str, bytes], object], what: str) -> Files:
    return {f"osm/{what}.json": post(OVERPASS, urllib.parse.urlencode({"data": overpass_query(what)}).encode()) or {"elements": []}}


def texts(get_bytes: Callable[[str], bytes | None]) -> Files:
    """The government feed's and the railway's tables, and the page of headways, as they are."""
    wanted = {f"gov/{name}.txt": f"{GOV}/{name}.txt" for name in GOV_FILES} | {f"{name}.csv": f"{MTR}/{file}.csv" for name, file in MTR_FILES.items()} | {"rail/headways.html": HEADWAYS}
    for lang in ("en", "tc", "sc"):
        wanted[f"tram/stops_{lang}.csv"] = f"{TRAM}/tram_stops/summary_tram_stops_{lang}.csv"
        wanted[f"tram/routes_{lang}.csv"] = f"{TRAM}/main_routes/tramways_main_routes_{lang}.csv"
    found = {name: get_bytes(url) for name, url in wanted.items()}
    return {name: body for name, body in found.items() if body is not None}


def waypoints(get_bytes: Callable[[str], bytes | None]) -> Iterator[tuple[str, bytes]]:
    """The GeoJSON files of the archive of waypoints, without the folder that they are packed in."""
    packed = get_bytes(WAYPOINTS)
    if packed:
        with zipfile.ZipFile(io.BytesIO(packed)) as archive:
            for name in archive.namelist():
                base = os.path.basename(name)
                if base.endswith(".json") and "-" in base:
                    yield f"waypoints/{base}", archive.read(name)


def land(raw: str, files: Files) -> None:
    """Writes documents, and bytes as they are, below a folder; each is put in its place when it is whole."""
    for name, made in files.items():
        path = os.path.join(raw, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        body = made if isinstance(made, bytes) else json.dumps(made, ensure_ascii=False).encode()
        with open(f"{path}.part", "wb") as file:
            file.write(body)
        os.replace(f"{path}.part", path)
