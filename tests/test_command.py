"""The command line on folders of landed files."""

from __future__ import annotations

import csv
import io
import json
import zipfile

from tramline.__main__ import main
from tramline.sources import schemas


def test_feed(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "kmb").mkdir(parents=True)
    (raw / "gov").mkdir()
    dump = lambda name, rows: (raw / "kmb" / f"{name}.json").write_text(json.dumps({"data": rows}, ensure_ascii=False))
    dump("routes", [{"route": "1", "bound": "O", "service_type": "1", "orig_en": "CHUK YUEN", "orig_tc": "竹園", "dest_en": "STAR FERRY", "dest_tc": "碼頭"}])
    dump("stops", [{"stop": f"S{i}", "name_en": f"STOP {i}", "name_tc": f"站{i}", "lat": str(22.3 + i / 100), "long": "114.17"} for i in range(3)])
    dump("route_stops", [{"route": "1", "bound": "O", "service_type": "1", "seq": str(i + 1), "stop": f"S{i}"} for i in range(3)])
    (raw / "journey_times.json").write_text(json.dumps({"S0": {"S1": 75}}))
    gov = {
        "agency": [], "routes": [("10", "KMB", "1", "CHUK YUEN - STAR FERRY", 3), ("30", "FERRY", "F", "PIER - ISLE", 4)],
        "trips": [("10", "a", "10-1-a-0600"), ("30", "b", "30-1-b-0700")],
        "stop_times": [("10-1-a-0600", f"06:0{i}:00", f"06:0{i}:00", f"g{i}", i + 1) for i in range(3)] + [("30-1-b-0700", "07:00:00", "07:00:00", "f0", 1)],
        "stops": [(f"g{i}", f"G{i}", 22.3 + i / 100, 114.17) for i in range(3)] + [("f0", "[FERRY] PIER", 22.2, 114.1)], "frequencies": [("10-1-a-0600", "06:00:00", "25:00:00", 600)],
        "calendar": [("a", 1, 1, 1, 1, 1, 0, 0, 20240101, 20241231), ("b", 0, 0, 0, 0, 0, 1, 1, 20240101, 20241231)], "calendar_dates": [("a", 20240101, 2)],
        "fare_attributes": [("10-1-1-3", 7.5, "HKD")], "fare_rules": [("10-1-1-3", "10")],
    }
    for name, rows in gov.items():
        out = io.StringIO()
        writer = csv.writer(out)
        writer.writerow([c.split()[0] for c in schemas.GOV[name].split(", ")])
        writer.writerows(rows)
        (raw / "gov" / f"{name}.txt").write_text(out.getvalue())
    rail = raw / "rail"
    rail.mkdir()
    (rail / "lines_and_stations.csv").write_text("Line Code,Direction,Station Code,Station ID,Chinese Name,English Name,Sequence\nTML,UT,TUM,120,屯門,Tuen Mun,1.00\nTML,UT,SIH,119,兆康,Siu Hong,2.00\n", encoding="utf-8")
    platform = lambda i, lat: {"amenity_id": f"a{i}", "ref": str(i), "coordinates": {"lat": lat, "lon": 114.0}, "lines_and_directions": [{"line_code": "TML", "direction": "UT"}]}
    (rail / "platforms.json").write_text(json.dumps({"p1": platform(1, 22.39), "p2": platform(2, 22.41)}))
    (rail / "stations.json").write_text(json.dumps({"TUM": {"platforms": ["p1"]}, "SIH": {"platforms": ["p2"]}}))
    (rail / "station_times.json").write_text(json.dumps({"TUM": {"SIH": 170}}))
    (rail / "light_rail_stops.csv").write_text("route,bound,code,id,tc,en,seq\n505,1,x,1,甲,One,1.00\n505,1,x,2,乙,Two,2.00\n", encoding="utf-8")
    (rail / "light_rail_places.csv").write_text("stop_id,lat,lon\n1,22.4,113.9\n")
    (rail / "light_rail_times.json").write_text(json.dumps([{"route": "505", "direction": "Two", "position": i, "first_train": f"05:3{4 * i}", "last_train": "00:10"} for i in (0, 1)]))
    main(["feed", str(raw), str(tmp_path / "feed"), "--zip", str(tmp_path / "feed.zip")], spark)
    with zipfile.ZipFile(tmp_path / "feed.zip") as z:
        table = lambda n: list(csv.DictReader(io.StringIO(z.read(n).decode())))
        assert {"KMB-1-O-1-a", "FERRY-30-1-b", "MTRR-TML-UT", "LR-505-O"} == {r["trip_id"] for r in table("trips.txt")}
        assert [(r["start_time"], r["end_time"]) for r in table("frequencies.txt") if r["trip_id"] == "KMB-1-O-1-a"] == [("06:00:00", "25:00:00")]
        assert [r["arrival_time"] for r in table("stop_times.txt") if r["trip_id"] == "KMB-1-O-1-a"] == ["00:00:00", "00:01:15", "00:03:15"]
        assert {(r["service_id"], r["monday"], r["saturday"]) for r in table("calendar.txt")} == {("KMB-1-O-a", "1", "0"), ("FERRY-b", "0", "1"), ("MTRR-TML-DEFAULT", "1", "1"), ("LR-505-DEFAULT", "1", "1")}
        times = {(r["trip_id"], r["stop_id"], r["arrival_time"]) for r in table("stop_times.txt")}
        assert {("MTRR-TML-UT", "MTR-PLATFORM-a2", "00:02:50"), ("LR-505-O", "LR2", "00:04:00")} <= times
        assert {(r["stop_id"], r["location_type"], r["parent_station"]) for r in table("stops.txt")} >= {("MTR-TUM", "1", ""), ("MTR-PLATFORM-a1", "0", "MTR-TUM"), ("LR1", "0", "")}
        assert {r["trip_headsign"] for r in table("trips.txt") if r["trip_id"].startswith(("MTRR", "LR"))} == {"Siu Hong", "Two"}
        assert [r["price"] for r in table("fare_stages.csv")] == ["7.5"]
        assert {r["stop_id"] for r in table("stops.txt")} >= {"KMB-S0", "FERRY-f0"}


def test_alerts(spark, tmp_path):
    (tmp_path / "events").mkdir()
    (tmp_path / "events" / "one.json").write_text(json.dumps([{"id": "1", "type": "detour", "header": {"en": "Detour"}, "description": {}}]))
    main(["alerts", str(tmp_path / "events"), str(tmp_path / "alerts.pb")], spark)
    assert b"Detour" in (tmp_path / "alerts.pb").read_bytes()


def test_fetch_then_feed(spark, tmp_path, monkeypatch):
    """What ``fetch`` lands off fake publishers is what ``feed`` reads: pathways, agency fares, flips, headways; a restart makes nothing anew."""
    import http.server
    import threading
    import urllib.parse

    from tramline import __main__ as command
    from tramline.sources import endpoints as E
    from tramline.sources import fetch, web

    point = lambda name, east: {"x": east, "y": 819069.8, "nameZH": name}
    pages = {
        "/ctb/route/CTB": {"data": [{"route": "A1", "orig_en": "X", "orig_tc": "甲", "dest_en": "Y", "dest_tc": "乙"}]},
        "/ctb/route-stop/CTB/A1/outbound": {"data": [{"stop": "C0"}, {"stop": "C1"}]}, "/ctb/route-stop/CTB/A1/inbound": {"data": [{"stop": "C1"}, {"stop": "C0"}]},
        **{f"/ctb/stop/C{i}": {"data": {"stop": f"C{i}", "name_en": f"Place {i}", "name_tc": f"地{i}", "lat": f"22.{2 + i}", "long": "114.1"}} for i in (0, 1)},
        "/nlb/route.php?action=list": {"routes": []}, "/gmb/route": {"data": {"routes": {}}},
        "/geo?" + urllib.parse.urlencode({"q": "港鐵屯門站進出口"}): [point("港鐵屯門站-A進出口", 836694.0), point("港鐵屯門站-B1進出口", 836700.0), point("elsewhere", 1.0)],
        "/geo?" + urllib.parse.urlencode({"q": "甲輕鐵站"}): [point("甲輕鐵站", 836600.0)], "/geo?" + urllib.parse.urlencode({"q": "乙輕鐵站"}): [point("乙輕鐵站", 836800.0)],
    }

    class Server(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            if self.path not in pages:
                return self.send_error(404)
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(pages[self.path]).encode())

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    for name, path in (("CITYBUS", "ctb"), ("LANTAO", "nlb"), ("MINIBUS", "gmb"), ("GEOCODE", "geo")):
        monkeypatch.setattr(E, name, f"http://127.0.0.1:{server.server_port}/{path}")

    def table(name, rows):
        out = io.StringIO()
        writer = csv.writer(out)
        writer.writerow([c.split()[0] for c in schemas.GOV[name].split(", ")])
        writer.writerows(rows)
        return out.getvalue().encode()

    platform = lambda i, lat: {"amenity_id": f"a{i}", "ref": str(i), "coordinates": {"lat": lat, "lon": 114.0}, "lines_and_directions": [{"line_code": "TML", "direction": "UT"}]}
    answers = {
        f"{E.JOURNEYS}/times/all.json": {"C0": {"C1": 75}, "TUM": {"SIH": 170}},
        f"{E.PLATFORMS}/mtr_data_complete.json": {"platforms": {"p1": platform(1, 22.39), "p2": platform(2, 22.41)}, "stations": {"TUM": {"platforms": ["p1"]}, "SIH": {"platforms": ["p2"]}}, "exits": {"x": {"amenity_id": "e1", "ref": "A", "name_en": "Exit A"}}},
        f"{E.PLATFORMS}/journeys.json": [{"platform_amenity_id": "a1", "exit_amenity_id": "e1", "station_code": "TUM", "walk_distance_metres": 50.0, "walk_time_minutes": 1.5}],
        f"{E.PLATFORMS}/platform_journeys.json": [{"start_platform_amenity_id": "a1", "end_platform_amenity_id": "a2", "walk_distance_metres": 9.0, "walk_time_minutes": 0.5}],
    }
    # the government's trip in our outbound direction runs the other way: its ends are turned
    bodies = {
        f"{E.GOV}/routes.txt": table("routes", [("20", "CTB", "A1", "X - Y", 3)]),
        f"{E.GOV}/trips.txt": table("trips", [("20", "a", "20-1-a-0600"), ("20", "a", "20-2-a-0700")]),
        f"{E.GOV}/stop_times.txt": table("stop_times", [("20-1-a-0600", "06:00:00", "06:00:00", "g1", 1), ("20-1-a-0600", "06:05:00", "06:05:00", "g0", 2), ("20-2-a-0700", "07:00:00", "07:00:00", "g0", 1), ("20-2-a-0700", "07:05:00", "07:05:00", "g1", 2)]),
        f"{E.GOV}/stops.txt": table("stops", [(f"g{i}", f"G{i}", f"22.{2 + i}", "114.1") for i in (0, 1)]),
        f"{E.GOV}/frequencies.txt": table("frequencies", [("20-1-a-0600", "06:00:00", "07:00:00", 600), ("20-2-a-0700", "07:00:00", "08:00:00", 900)]),
        f"{E.GOV}/calendar.txt": table("calendar", [("a", 1, 1, 1, 1, 1, 0, 0, 20240101, 20241231)]), f"{E.GOV}/calendar_dates.txt": table("calendar_dates", []),
        f"{E.GOV}/fare_attributes.txt": table("fare_attributes", []), f"{E.GOV}/fare_rules.txt": table("fare_rules", []),
        f"{E.MTR}/mtr_lines_and_stations.csv": "Line Code,Direction,Station Code,Station ID,Chinese Name,English Name,Sequence\nTML,UT,TUM,120,屯門,Tuen Mun,1.00\nTML,UT,SIH,119,兆康,Siu Hong,2.00\n".encode(),
        f"{E.MTR}/mtr_lines_fares.csv": b"SRC_STATION_ID,DEST_STATION_ID,OCT_ADT_FARE\n120,119,5.5\n119,120,x\n",
        f"{E.MTR}/barrier_free_facilities.csv": b"id,item,has,place\n120,Lift,Y,Exit B1\n",
        f"{E.MTR}/light_rail_routes_and_stops.csv": "route,bound,code,id,tc,en,seq\n505,1,x,1,甲,One,1.00\n505,1,x,2,乙,Two,2.00\n".encode(),
        f"{E.MTR}/light_rail_fares.csv": b"from_station_id,to_station_id,fare_octo_adult\n1,2,4.9\n",
        E.HEADWAYS: b"<table><tr><th>Line</th><th>Morning</th></tr><tr><td>Tuen Ma Line</td><td>2.5</td><td>3</td><td>6</td><td>4</td><td>5</td></tr></table>",
    }
    raw, work = tmp_path / "raw", tmp_path / "work"
    try:
        web.fetch_all(spark, str(raw), answers.get, bodies.get, lambda url, data: {"elements": []}, manners=web.Manners(tries=1, wait=0.0))
    finally:
        server.shutdown()
    assert fetch.is_forced("kmb", {"all": True})
    main(["feed", str(raw), str(tmp_path / "feed"), "--zip", str(tmp_path / "feed.zip"), "--work", str(work)], spark)
    with zipfile.ZipFile(tmp_path / "feed.zip") as z:
        table_of = lambda n: list(csv.DictReader(io.StringIO(z.read(n).decode())))
        walks = {(r["from_stop_id"], r["to_stop_id"], r["length"], r["traversal_time"]) for r in table_of("pathways.txt")}
        assert walks == {("MTR-PLATFORM-a1", "MTR-ENTRANCE-TUM-A", "50", "90"), ("MTR-PLATFORM-a1", "MTR-PLATFORM-a2", "9", "30"), ("MTR-PLATFORM-a1", "MTR-ENTRANCE-TUM-B1", "", "60")}
        stops = {r["stop_id"]: r for r in table_of("stops.txt")}
        assert stops["MTR-ENTRANCE-TUM-B1"]["location_type"] == "2" and stops["MTR-ENTRANCE-TUM-B1"]["parent_station"] == "MTR-TUM"
        assert abs(float(stops["LR1"]["stop_lat"]) - 22.31) < 0.02 and abs(float(stops["MTR-ENTRANCE-TUM-A"]["stop_lon"]) - 114.18) < 0.02
        assert {(r["onboarding_stop_id"], r["offboarding_stop_id"], r["price"]) for r in table_of("special_fare_rules.csv")} == {("MTR-TUM", "MTR-SIH", "5.5"), ("LR1", "LR2", "4.9")}
        headways = {(r["trip_id"], r["headway_secs"]) for r in table_of("frequencies.txt")}
        # both of our trips had matched the first government direction; the one that is turned has the second's headway
        assert {("CTB-A1-O-1-a", "900"), ("CTB-A1-I-1-a", "600")} <= headways or {("CTB-A1-O-a", "900"), ("CTB-A1-I-a", "600")} <= headways, headways
        assert ("MTRR-TML-UT", "150") in headways
        assert {r["arrival_time"] for r in table_of("stop_times.txt") if r["trip_id"] == "MTRR-TML-UT"} == {"00:00:00", "00:02:50"}
    stages = command.Stages(spark, str(work))
    again = command.build_feed(spark, str(raw), stages)
    assert stages.made == [] and set(again) >= {"pathways", "special_fare_rules"}
