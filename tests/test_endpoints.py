"""Endpoint clients against answers held in memory: what is asked for, and what the readers make of what is landed."""

from __future__ import annotations

import http.server
import io
import json
import threading
import urllib.error
import zipfile
from collections import Counter

import pytest

from tramline.plans import silver
from tramline.sources import endpoints as E
from tramline.sources import fetch, readers, schemas, web

KMB_STOP = {"stop": "S0", "name_en": "STOP", "name_tc": "站", "lat": "22.3", "long": "114.1"}
ANSWERS = {
    f"{E.KMB}/route": {"data": [{"route": "1", "bound": "O", "service_type": "1", "orig_en": "A", "dest_en": "B"}]},
    f"{E.KMB}/stop": {"data": [KMB_STOP]},
    f"{E.KMB}/route-stop": {"data": [{"route": "1", "bound": "O", "service_type": "1", "seq": "1", "stop": "S0"}]},
    f"{E.JOURNEYS}/times/all.json": {"S0": {"S1": 60}},
    f"{E.JOURNEYS}/times_hourly/0/07/all.json": {"S0": {"S1": 90}},
    f"{E.GOV}/trips.txt": b"route_id,service_id,trip_id\n1,a,1-1-a-0600\n",
}
PAGES = {
    "/ctb/route/CTB": {"data": [{"route": "A1", "orig_en": "X", "dest_en": "Y"}]},
    "/ctb/route-stop/CTB/A1/outbound": {"data": [{"stop": "C1"}, {"stop": "C0"}, {}]},
    "/ctb/route-stop/CTB/A1/inbound": {"data": []},
    "/ctb/stop/C0": {"data": {"stop": "C0", "name_en": "Zero", "lat": "22.1", "long": "114.1"}},
    "/ctb/stop/C1": {"data": {"stop": "C1", "name_en": "One", "lat": "22.2", "long": "114.1"}},
    "/nlb/route.php?action=list": {"routes": [{"routeId": "7", "routeNo": "3M", "routeName_e": "P > Q"}]},
    "/nlb/stop.php?action=list&routeId=7": {"stops": [{"stopId": "70", "stopName_e": "Pier"}, {"stopId": "71"}, {"stopId": "70"}]},
    "/gmb/route": {"data": {"routes": {"HKI": ["1"]}}},
    "/gmb/route/HKI/1": {"data": [{"route_id": 5, "description_en": "Normal Departure", "directions": [{"route_seq": 1, "orig_en": " A ", "dest_en": "B"}]}, {"route_id": 6, "description_tc": "正常班次", "directions": [{"route_seq": 1}]}]},
    "/gmb/route-stop/5/1": {"data": {"route_stops": [{"stop_id": 900, "stop_seq": 1, "name_en": "Pier"}]}},
    "/gmb/stop/900": {"data": {"coordinates": {"wgs84": {"latitude": 22.2, "longitude": 114.2}}}},
    "/geo?q=A+%26+B": [{"x": 836694.05, "y": 819069.8}, {"x": None, "y": 1}],
}
#: Pages that fail, and that answer with half a document, when they are asked for first.
FAILING, BROKEN = {"/ctb/route-stop/CTB/A1/outbound", "/gmb/stop/900"}, {"/ctb/stop/C1"}


class Server(http.server.BaseHTTPRequestHandler):
    asked: Counter = Counter()
    down: set[str] = set()

    def do_GET(self):
        self.asked[self.path] += 1
        if self.path in self.down or self.path in FAILING and self.asked[self.path] == 1:
            self.send_error(503)
            return
        if self.path not in PAGES:
            self.send_error(404)
            return
        body = json.dumps(PAGES[self.path]).encode()
        body = body[: len(body) // 2] if self.path in BROKEN and self.asked[self.path] == 1 else body
        self.send_response(200)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *_):
        pass


def opener(url, timeout):
    if not isinstance(url, str):
        assert url.full_url == E.OVERPASS and b"relation" in url.data
        return io.BytesIO(b'{"elements": [{"type": "node", "id": 1, "lat": 22.3, "lon": 114.1}]}')
    if url == E.WAYPOINTS:
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            z.writestr("top/7-O.json", json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": {"type": "LineString", "coordinates": [[114, 22], [114.5, 22]]}}]}))
            z.writestr("top/README.md", "x")
        return io.BytesIO(packed.getvalue())
    if url not in ANSWERS:
        raise urllib.error.HTTPError(url, 404, "no", None, None)
    body = ANSWERS[url]
    return io.BytesIO(body if isinstance(body, bytes) else json.dumps(body).encode())


def get(url, data=None):
    return fetch.get_json(url, data, opener=opener)


QUICK = web.Manners(per_task=1, tries=2, wait=0.0, timeout=5)


@pytest.fixture(scope="module")
def server():
    own = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=own.serve_forever, daemon=True).start()
    top = f"http://127.0.0.1:{own.server_port}"
    with pytest.MonkeyPatch.context() as patch:
        for name, path in (("CITYBUS", "ctb"), ("LANTAO", "nlb"), ("MINIBUS", "gmb"), ("GEOCODE", "geo")):
            patch.setattr(E, name, f"{top}/{path}")
        yield own
    own.shutdown()


@pytest.fixture(scope="module")
def raw(spark, server, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    web.fetch_all(spark, folder, get, lambda url: fetch.get_bytes(url, opener=opener), get, hourly=True, manners=QUICK)
    return folder


def test_failed_pages_are_asked_for_again_by_their_task(raw):
    assert {p: n for p, n in Server.asked.items() if n > 1} == dict.fromkeys(FAILING | BROKEN, 2)
    assert set(PAGES) - {"/geo?q=A+%26+B"} <= set(Server.asked)


def test_a_page_that_fails_for_good_lands_nothing(spark, server, tmp_path):
    Server.down.add("/gmb/route-stop/5/1")
    try:
        with pytest.raises(Exception, match="503"):
            web.minibus(spark, str(tmp_path), QUICK)
    finally:
        Server.down.clear()
    assert (tmp_path / "gmb" / "directions.jsonl" / "_SUCCESS").exists()
    assert not (tmp_path / "gmb" / "route_stops.jsonl" / "_SUCCESS").exists()
    web.minibus(spark, str(tmp_path), QUICK)
    assert (tmp_path / "gmb" / "stops.jsonl" / "_SUCCESS").exists()


def test_a_partition_holds_some_pages_and_none_is_asked_for_where_there_are_none(spark, server):
    reader = web.PagesReader({"asked": json.dumps([[str(k), "u"] for k in range(10)]), "pertask": "4", "tries": "1", "timeout": "1"})
    assert [len(p.pages) for p in reader.partitions()] == [4, 4, 2]
    assert web.pages(spark, [], QUICK).count() == 0
    assert web.pages(spark, [("x", f"{E.CITYBUS}/nowhere")], QUICK).count() == 0


def test_operators(spark, raw):
    data = lambda f, n, s: readers.json_data(spark, f"{raw}/{f}/{n}.json", s)
    rows = lambda f, n, s: readers.rows_below(spark, f"{raw}/{f}/{n}", s)
    own = silver.kmb(*(data("kmb", n, schemas.KMB[n]) for n in ("routes", "stops", "route_stops")))
    assert [r["route_key"] for r in own.routes.collect()] == ["1-O-1"]
    own = silver.citybus(rows("ctb", "routes", schemas.CTB["routes"]), rows("ctb", "stops", schemas.CTB["stops"]), rows("ctb", "sequences", schemas.CTB["sequences"]))
    assert [(r["route_key"], r["stop_id"]) for r in own.patterns.orderBy("sequence").collect()] == [("A1-O", "CTB-C1"), ("A1-O", "CTB-C0")]
    assert own.stops.count() == 2
    own = silver.nlb(*(rows("nlb", n, schemas.NLB[n]) for n in ("routes", "stops")), rows("nlb", "sequences", "routeId string, routeNo string, stopId string, sequence int"))
    assert [r["stop_id"] for r in own.patterns.orderBy("sequence").collect()] == ["NLB-70", "NLB-71", "NLB-70"] and own.stops.count() == 2
    directions, calls = readers.green_minibus(*(rows("gmb", n, schemas.GMB[n]) for n in ("directions", "route_stops")))
    assert {(r["route_id"], r["orig_en"]) for r in directions.collect()} == {(5, "A"), (6, "")}  # both are normal, one says so in Chinese
    assert silver.green_minibus(directions, rows("gmb", "stops", schemas.GMB["stops"]), calls).stops.first()["lat"] == 22.2


def test_other_files(spark, raw, server):
    assert readers.edges(spark, f"{raw}/journey_times.json").first()["seconds"] == 60
    assert [tuple(r) for r in readers.hourly_edges(spark, f"{raw}/times_hourly").collect()] == [(0, 7, "S0", "S1", 90.0)]
    assert readers.gov_feed(spark, f"{raw}/gov", "trips")["trips"].first()["trip_id"] == "1-1-a-0600"
    assert [(r["route_id"], r["bound"], len(r["points"])) for r in readers.waypoints(spark, f"{raw}/waypoints").collect()] == [("7", "O", 2)]
    assert readers.overpass(spark, f"{raw}/osm/routes.json").first()["id"] == 1
    web.places(spark, raw, "rail/places", ["A & B", "nowhere"], QUICK)
    assert [tuple(r) for r in readers.rows_below(spark, f"{raw}/rail/places", "name string, rank int, east double, north double").collect()] == [("A & B", 1, 836694.05, 819069.8)]


def test_answers_are_asked_for_again():
    calls = []

    def once(url, timeout):
        calls.append(url)
        return io.BytesIO(b"{" if len(calls) == 1 else b"{}")

    assert fetch.get_json("u", opener=once, sleep=lambda s: None) == {} and len(calls) == 2
    with pytest.raises(OSError):
        fetch.get_bytes("u", tries=2, opener=lambda url, timeout: (_ for _ in ()).throw(OSError("down")), sleep=lambda s: None)
