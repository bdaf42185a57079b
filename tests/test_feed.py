"""The feed on a small hand-written network: matching, trips, times, fares, keys and references."""

from __future__ import annotations

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from tramline.plans import alerts, feed, silver
from tramline.sources import html, readers, schemas, sinks


@pytest.fixture(scope="module")
def network(spark):
    df = spark.createDataFrame
    kmb = silver.kmb(
        df([("1", "O", "1", "CHUK YUEN", "竹園", "", "STAR FERRY", "尖沙咀碼頭", ""), ("1", "I", "1", "STAR FERRY", "尖沙咀碼頭", "", "CHUK YUEN", "竹園", ""), ("9", "O", "1", "NOWHERE", "無", "", "ELSEWHERE", "他", "")], schemas.KMB["routes"]),
        df([(f"S{i}", f"STOP {i} (AB12{i})", f"站{i}", "", str(22.30 + i * 0.01), str(114.17)) for i in range(4)], schemas.KMB["stops"]),
        df([("1", b, "1", str(k + 1), f"S{i}") for b, order in (("O", (0, 1, 2, 3)), ("I", (3, 2, 1, 0))) for k, i in enumerate(order)] + [("9", "O", "1", "1", "S0"), ("9", "O", "1", "x", "S1"), ("9", "O", "1", "2", "S1")], schemas.KMB["route_stops"]),
    )
    ctb = silver.citybus(
        df([("A1", "Centre", "中", "", "Peak (Circular)", "山", ""), ("B2", "Here", "此", "", "There", "彼", ""), ("C3", "Loop", "環", "", "Turn", "轉", "")], schemas.CTB["routes"]),
        df([(f"C{i}", f"Place {i}", f"地{i}", str(22.2 + i * 0.01), "114.1") for i in range(4)], schemas.CTB["stops"]),
        df([("A1", "outbound", ["C0", "C1", "C2"]), ("A1", "inbound", ["C2", "C3", "C0"]), ("B2", "outbound", ["C0", "C3"]), ("B2", "inbound", ["C3", "C0"]), ("C3", "outbound", ["C0", "C1", "C2"]), ("C3", "inbound", ["C2", "C1", "C3", "C0"])], schemas.CTB["sequences"]),
    )
    gov = feed.Gov(
        df([("10", "KMB", "1", "CHUK YUEN - STAR FERRY", 3), ("11", "KMB", "1", "CHUK YUEN - STAR FERRY EXPRESS", 3), ("20", "CTB", "B2", "HERE - THERE", 3), ("21", "CTB", "C3", "LOOP - TURN", 3), ("30", "FERRY", "F", "PIER - ISLE", 4)], schemas.GOV["routes"]),
        df([("10", "287", "10-1-287-0600"), ("10", "287", "10-1-287-0630"), ("10", "287", "10-2-287-0700"), ("11", "287", "11-1-287-0600"), ("20", "63", "20-1-63-0800"), ("20", "63", "20-2-63-0900"), ("21", "63", "21-1-63-0900"), *[("30", "5", f"30-1-5-{h:02d}{m:02d}") for h in (7, 8) for m in (0, 20, 40)]], schemas.GOV["trips"]),
        df(
            [(f"10-1-287-{c}", f"{h}:{i:02d}:00", f"{h}:{i:02d}:00", f"g{i}", i + 1) for c, h in (("0600", "06"), ("0630", "06")) for i in range(4)]
            + [("10-2-287-0700", f"07:{i:02d}:00", f"07:{i:02d}:00", f"g{3 - i}", i + 1) for i in range(4)]
            + [("11-1-287-0600", "06:00:00", "06:00:00", "g0", 1)]
            + [("21-1-63-0900", f"09:0{i}:00", f"09:0{i}:00", "h0", i + 1) for i in range(5)]
            + [("20-1-63-0800", f"08:{i:02d}:00", f"08:{i:02d}:00", f"h{i}", i + 1) for i in range(2)]
            + [(f"30-1-5-{h:02d}{m:02d}", f"{h:02d}:{m + 15 * k}:00", f"{h:02d}:{m + 15 * k}:00", f"f{k}", k + 1) for h in (7, 8) for m in (0, 20, 40) for k in (0, 1)],
            schemas.GOV["stop_times"],
        ),
        df([(f"g{i}", f"[KMB] G{i}", 22.30 + i * 0.01, 114.17) for i in range(4)] + [(f"h{i}", f"H{i}", 22.2 + i * 0.03, 114.1) for i in range(2)] + [("f0", "[FERRY] PIER", 22.29, 114.1), ("f1", "ISLE", 22.2, 114.0)], schemas.GOV["stops"]),
        df([("10-1-287-0600", "06:00:00", "07:00:00", 900), ("10-1-287-0630", "06:30:00", "08:00:00", 600)], schemas.GOV["frequencies"]),
    )
    return [kmb, ctb], gov


@pytest.fixture(scope="module")
def built(spark, network):
    parts, gov = network
    df = spark.createDataFrame
    edges = df([("S0", "S1", 90.0), ("S1", "S2", 100.0)], "from_id string, to_id string, seconds double")
    calendar = df([("287", 1, 1, 1, 1, 1, 0, 0, 20240101, 20241231)], schemas.GOV["calendar"])
    dates = df([("287", 20240210, 2)], schemas.GOV["calendar_dates"])
    rules = df([(f"10-1-{s}-{e}", "10") for s in (1, 2, 3) for e in range(s + 1, 5)], schemas.GOV["fare_rules"])
    price = {1: 8.0, 2: 8.0, 3: 5.0}
    attributes = df([(f"10-1-{s}-{e}", 4.0 if (s, e) == (1, 2) else price[s], "HKD") for s in (1, 2, 3) for e in range(s + 1, 5)], schemas.GOV["fare_attributes"])
    points = [[114.17, 22.30 + i * 0.01] for i in range(4)]
    waypoints = df([("10", "O", "10-O.json", points), ("10", "I", "10-I.json", points[::-1])], "route_id string, bound string, file string, points array<array<double>>")
    tables = feed.build(parts, gov, edges, calendar, dates, rules, attributes, waypoints)
    kept = {k: v.cache() for k, v in tables.items()}
    yield kept
    for df in kept.values():  # the planner compares every later plan with what is cached
        df.unpersist()


def test_matching(network):
    parts, gov = network
    out = {(r["agency"], r["route_key"], r["gov_route_id"], r["gov_bound"]) for r in feed.match(feed.together(parts), gov).collect()}
    assert out == {("KMB", "1-O-1", "10", "O"), ("KMB", "1-I-1", "10", "I"), ("CTB", "B2-O", "20", "O"), ("CTB", "B2-I", "20", "O"), ("CTB", "C3-O", "21", "O"), ("CTB", "C3-I", "21", "O")}


def test_placeholders_never_run(built):
    dummy = built["trips"].where("is_dummy").select("trip_id", "service_id").collect()
    assert {r["trip_id"] for r in dummy} == {"KMB-9-O-1-NEVER", "CTB-A1-O-1-NEVER"}
    days = {r["service_id"]: (r["monday"], r["sunday"], r["start_date"]) for r in built["calendar"].collect()}
    assert days["KMB-9-O-NEVER"] == (0, 0, 19700101)
    assert days["KMB-1-O-287"] == (1, 0, 20240101)
    assert days["CTB-B2-O-63"] == (1, 1, 20230101)


def test_times(built):
    rows = built["stop_times"].where("trip_id = 'KMB-1-O-1-287'").orderBy("stop_sequence").collect()
    assert [(r["stop_id"], r["arrival_time"]) for r in rows] == [("KMB-S0", "00:00:00"), ("KMB-S1", "00:01:30"), ("KMB-S2", "00:03:10"), ("KMB-S3", "00:05:10")]


def test_circular_route(built):
    rows = built["stop_times"].where("trip_id = 'CTB-A1-O-1-NEVER'").orderBy("stop_sequence").collect()
    assert [r["stop_id"] for r in rows] == ["CTB-C0", "CTB-C1", "CTB-C2", "CTB-C3", "CTB-C0"]


def test_route_that_the_government_knows_one_way_is_spliced(built):
    """Its name doesn't say that it is circular."""
    trips = [r["trip_id"] for r in built["trips"].where("route_id = 'CTB-C3'").collect()]
    assert trips == ["CTB-C3-O-1-63"]
    rows = built["stop_times"].where("trip_id = 'CTB-C3-O-1-63'").orderBy("stop_sequence").collect()
    assert [(r["stop_id"], r["stop_sequence"]) for r in rows] == [("CTB-C0", 1), ("CTB-C1", 2), ("CTB-C2", 3), ("CTB-C3", 4), ("CTB-C0", 5)]
    assert built["trips"].where("route_id = 'CTB-B2'").count() == 2


def test_frequencies(built):
    out = [(r["trip_id"], r["start_time"], r["end_time"], r["headway_secs"]) for r in built["frequencies"].orderBy("trip_id", "start_time").collect()]
    assert ("KMB-1-O-1-287", "06:00:00", "06:30:00", 900) in out
    assert ("KMB-1-O-1-287", "06:30:00", "08:00:00", 600) in out
    assert ("KMB-1-I-1-287", "07:00:00", "31:00:00", 86400) in out


def test_shapes(built):
    shape = {r["trip_id"]: r["shape_id"] for r in built["trips"].collect()}
    assert shape["KMB-1-O-1-287"] == "10-O" and shape["KMB-1-I-1-287"] == "10-I" and shape["KMB-9-O-1-NEVER"] is None
    last = built["shapes"].where("shape_id = '10-O'").agg(F.max("shape_dist_traveled").alias("m")).first()["m"]
    assert abs(last - 3335.8) < 1


def test_fares(built):
    stages = [(r["from_stop_id"], r["price"]) for r in built["fare_stages"].orderBy(F.desc("price")).collect()]
    assert stages == [("KMB-S1", 8.0), ("KMB-S2", 5.0), ("KMB-S0", 4.0)]
    special = [(r["onboarding_stop_id"], r["offboarding_stop_id"], r["price"]) for r in built["special_fare_rules"].collect()]
    assert special == [("KMB-S0", "KMB-S1", 4.0)]


def test_headsigns_and_names(built):
    head = {r["trip_id"]: r["trip_headsign"] for r in built["trips"].collect()}
    assert head["KMB-1-O-1-287"] == "Star Ferry" and head["CTB-B2-I-1-63"] == "Here"
    names = {r["route_id"]: r["route_long_name"] for r in built["routes"].collect()}
    assert names["KMB-1"] == "Chuk Yuen - Star Ferry"
    assert built["stops"].where("stop_id = 'KMB-S1'").first()["stop_name"] == "Stop 1"


def test_integrity(built):
    for name, df in built.items():
        key = schemas.KEYS[name]
        assert df.groupBy(*key).count().where("count > 1").count() == 0, name
    for child, column, parent in (("stop_times", "trip_id", "trips"), ("stop_times", "stop_id", "stops"), ("trips", "route_id", "routes"), ("trips", "service_id", "calendar"), ("frequencies", "trip_id", "trips"), ("fare_stages", "trip_id", "trips")):
        assert built[child].join(built[parent], column, "left_anti").count() == 0, (child, column)


def test_write_and_package(spark, built, tmp_path):
    names = ["stops", "trips", "fare_stages"]
    sinks.write_feed({n: built[n] for n in names}, str(tmp_path / "feed"))
    with zipfile.ZipFile(sinks.package(spark, str(tmp_path / "feed"), names, str(tmp_path / "feed.zip"))) as z:
        assert sorted(z.namelist()) == ["fare_stages.csv", "stops.txt", "trips.txt"]
        lines = z.read("stops.txt").decode().splitlines()
    assert lines[0] == "stop_id,stop_name,stop_lat,stop_lon,location_type,parent_station,platform_code"
    assert len(lines) == 1 + built["stops"].count()


def test_quoted_cells_survive(spark, tmp_path):
    """Doubled quotes, separators, line breaks, blanks and entities, through the reader, the writer and the package."""
    import csv
    import io

    names = ['The "Peak" Road', "a, b", "two\nlines", '"', " blank ", "Caf&eacute; &#233; &lt;x&gt; &amp;amp;", "back\\slash", "", "\n\n"]
    text = io.StringIO(newline="")
    writer = csv.writer(text, lineterminator="\n")
    writer.writerows([["stop_id", "stop_name", "stop_lat", "stop_lon"], *([f"s{i}", n, 22.5, 114.5] for i, n in enumerate(names))])
    (tmp_path / "stops.txt").write_text("\ufeff" + text.getvalue(), encoding="utf-8")
    df = readers.gov_feed(spark, str(tmp_path), "stops")["stops"]
    expected = ['The "Peak" Road', "a, b", "two\nlines", '"', " blank ", "Café é <x> &amp;", "back\\slash", None, "\n\n"]
    assert [r["stop_name"] for r in df.orderBy("stop_id").collect()] == expected
    sinks.write_table(df.repartition(3), str(tmp_path / "feed"), "stops")
    sinks.write_table(df.where("false"), str(tmp_path / "feed"), "agency")
    with zipfile.ZipFile(sinks.package(spark, str(tmp_path / "feed"), ["stops", "agency"], str(tmp_path / "feed.zip"))) as z:
        rows = list(csv.DictReader(io.StringIO(z.read("stops.txt").decode(), newline="")))
        assert z.read("agency.txt").decode() == "agency_id,agency_name,agency_url,agency_timezone,agency_lang\n"
    assert [(r["stop_id"], r["stop_name"], r["stop_lat"]) for r in rows] == [(f"s{i}", n or "", "22.5") for i, n in enumerate(expected)]


def test_lines_by_their_names(spark):
    names = ["South Island Line", "Island Line", "ISL", "Tung Chung", "Airport Express", "SIL", "none"]
    out = spark.createDataFrame([(n,) for n in names], "n string").select("n", feed.line_of(F.col("n")).alias("line")).collect()
    assert {r["n"]: r["line"] for r in out} == {"South Island Line": "SIL", "Island Line": "ISL", "ISL": "ISL", "Tung Chung": "TCL", "Airport Express": "AEL", "SIL": "SIL", "none": None}


def test_schemas_and_json(spark, tmp_path):
    """A schema and a schedule as documents."""
    df = spark.createDataFrame([("1", 2)], "a string, b int")
    sinks.write_json(sinks.schema_json(df), str(tmp_path / "schema.json"))
    assert [f["name"] for f in json.loads((tmp_path / "schema.json").read_text())["fields"]] == ["a", "b"]
    sinks.write_json({"610": [{"stop": "兆康", "first": "05:30"}]}, str(tmp_path / "times.json"))
    assert json.loads((tmp_path / "times.json").read_text(encoding="utf-8")) == {"610": [{"stop": "兆康", "first": "05:30"}]}


def test_ferries(network):
    out = feed.ferries(network[1])
    assert [tuple(r) for r in out.frequencies.collect()] == [("FERRY-30-1-5", "07:00:00", "08:40:00", 1200)]
    assert {(r["stop_id"], r["stop_name"]) for r in out.stops.collect()} == {("FERRY-f0", "PIER"), ("FERRY-f1", "ISLE")}
    assert [r["arrival_time"] for r in out.stop_times.orderBy("stop_sequence").collect()] == ["00:00:00", "00:15:00"]


def test_green_minibus_matches_by_place(spark, network):
    df = spark.createDataFrame
    directions = df([(1, 1, "HKI", "5", "A", "甲", "", "B", "乙", "", "Normal Departure"), (2, 1, "HKI", "5", "A", "甲", "", "C", "丙", "", "Special")], schemas.GMB["directions"])
    stops = df([("900", {"wgs84": {"latitude": 22.25, "longitude": 114.15}})], schemas.GMB["stops"])
    route_stops = df([(1, 1, "HKI", "5", "900", 1, "Pier", "碼頭", "", "Normal Departure"), (2, 1, "HKI", "5", "900", 1, "Pier", "碼頭", "", "Special")], schemas.GMB["route_stops"])
    own = silver.green_minibus(*(lambda d, r: (d, stops, r))(*readers.green_minibus(directions, route_stops)))
    gov = network[1]._replace(routes=df([("50", "GMB", "5", "near", 3), ("51", "GMB", "5", "far", 3)], schemas.GOV["routes"]), trips=df([("50", "s", "50-1-s-0600"), ("51", "s", "51-1-s-0600")], schemas.GOV["trips"]), stop_times=df([("50-1-s-0600", "", "06:00:00", "x", 1), ("51-1-s-0600", "", "06:00:00", "y", 1)], schemas.GOV["stop_times"]), stops=df([("x", "x", 22.2501, 114.15), ("y", "y", 22.253, 114.15)], schemas.GOV["stops"]))
    assert [(r["route_key"], r["gov_route_id"]) for r in feed.match(own, gov).collect()] == [("HKI-5-O", "50")]


def test_mtr_bus_and_nlb(spark):
    df = spark.createDataFrame
    bus = silver.mtr_bus(df([("K1", "甲至乙", "Alpha to Beta", "")], schemas.MTR_BUS["routes"]), df([("K1", "O", "1.00", "a", "22.4", "114.0", "甲", "Alpha"), ("K1", "O", "2.00", "b", "22.5", "114.0", "乙", "Beta"), ("K1", "I", "1.00", "b2", "22.500001", "114.0", "乙", "Beta")], schemas.MTR_BUS["route_stops"]))
    assert {r["stop_id"] for r in bus.stops.collect()} == {"MTRB-a", "MTRB-b"}
    assert {(r["route_key"], r["stop_id"]) for r in bus.patterns.collect()} == {("K1-O", "MTRB-a"), ("K1-O", "MTRB-b"), ("K1-I", "MTRB-b")}
    assert {(r["bound"], r["dest_en"], r["dest_tc"]) for r in bus.routes.collect()} == {("O", "Beta", "乙"), ("I", "Alpha", "甲")}
    lantao = silver.nlb(df([("1", "3M", "甲 > 乙", "", "Mui Wo > Tung Chung"), ("2", "3M", "乙 > 甲", "", "Tung Chung > Mui Wo"), ("3", "X", "丙", "", "Loop")], schemas.NLB["routes"]), df([("7", "站", "", "Stop", "", "", "22.2", "113.9")], schemas.NLB["stops"]), df([("1", "3M", "7", 1)], "routeId string, routeNo string, stopId string, sequence int"))
    assert {(r["route_key"], r["bound"], r["dest_en"]) for r in lantao.routes.collect()} == {("1", "O", "Tung Chung"), ("2", "I", "Mui Wo"), ("3", "O", "Loop")}


def test_rail(spark):
    df = spark.createDataFrame
    raw = df([("TML", "UT", "TUM", "120", "屯門", "Tuen Mun", "1.00"), ("TML", "UT", "SIH", "119", "兆康", "Siu Hong", "2.00"), ("TML", "UT", "WKS", "103", "烏溪沙", "Wu Kai Sha", "3.00"), ("TML", "LMC-DT", "WKS", "103", "烏溪沙", "Wu Kai Sha", "1.00"), ("TML", "LMC-DT", "TUM", "120", "屯門", "Tuen Mun", "2.00")], schemas.RAIL["lines_and_stations"])
    lines = feed.rail_lines(raw)
    trips = feed.rail_trips(lines)
    heads = {r["trip_id"]: r["en"] for r in feed.rail_headsigns(trips, feed.rail_terminals(lines)).collect()}
    assert heads == {"MTRR-TML-UT": "Wu Kai Sha", "MTRR-TML-LMC-DT": "Tuen Mun"}
    platforms = df([("TUM", "p1", "TML", "UT", None), ("SIH", "p2", None, None, None), ("WKS", "p3", "TML", "UT", "WKS"), ("WKS", "p4", "TML", "LMC-DT", None)], "station_code string, stop_id string, line string, direction string, destination string")
    edges = df([("TUM", "SIH", 200.0), ("WKS", "SIH", 5000.0)], "from_id string, to_id string, seconds double")
    times = feed.rail_stop_times(lines, trips, platforms, edges).where("trip_id = 'MTRR-TML-UT'").orderBy("stop_sequence").collect()
    assert [(r["stop_id"], r["arrival_time"]) for r in times] == [("p1", "00:00:00"), ("p2", "00:03:20"), ("p3", "00:05:20")]
    published = df([("Tuen Ma Line", "2.7-3", "3", "4", None, None)], "line string, morning_peak string, evening_peak string, non_peak string, saturdays string, sundays_and_holidays string")
    rates = [(r["start_time"], r["headway_secs"]) for r in feed.rail_frequencies(trips, published).where("trip_id = 'MTRR-TML-UT'").orderBy("start_time").collect()]
    assert rates == [("05:30:00", 360), ("07:00:00", 171), ("10:00:00", 240), ("17:00:00", 171), ("20:00:00", 240), ("23:00:00", 600)]


def test_rail_platforms_are_chosen_without_joins(spark):
    """F8: platforms of a line lie beside its stops; only edges, trips and the station's platforms are joined. Keys without a value choose nothing."""
    lines = spark.createDataFrame([("A", "UT", "S1", 1), ("A", "UT", "S2", 2), ("A", "UT", "S3", 3), ("B", "DT", "S1", 1)], "line string, direction string, station_code string, sequence int")
    trips = spark.createDataFrame([("a", "A", "UT"), ("b", "B", "DT")], "trip_id string, line string, direction string")
    places = [("S1", "q9", "A", "UT", None), ("S1", "q8", "A", "UT", "S3"), ("S1", "q1", "A", "UT", "S2"), ("S2", "q7", "A", "UT", "S1"), ("S2", "q6", "A", "UT", None), ("S3", "q5", "A", None, "S3"), ("S3", "q4", None, "UT", None), ("S1", "q2", "C", "UT", None)]
    platforms = spark.createDataFrame(places, "station_code string, stop_id string, line string, direction string, destination string")
    edges = spark.createDataFrame([("S1", "S2", 60.0), ("S3", "S2", 90.0)], "from_id string, to_id string, seconds double")
    found = feed.rail_stop_times(lines, trips, platforms, edges)
    rows = [(r.trip_id, r.arrival_time, r.stop_id, r.stop_sequence) for r in found.orderBy("trip_id", "stop_sequence").collect()]
    assert rows == [("a", "00:00:00", "q8", 1), ("a", "00:01:00", "q6", 2), ("a", "00:02:30", "q4", 3), ("b", "00:00:00", "q1", 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 3 and plan.count("Join Inner") == 2, plan


def test_light_rail(spark):
    df = spark.createDataFrame
    raw = df([("505", "1", "x", f"{i}", f"站{i}", f"Stop {i}", f"{i}.00") for i in (1, 2, 3)] + [("705", "1", "x", f"{i}", f"站{i}", f"Stop {i}", f"{k}.00") for k, i in enumerate((3, 4, 3), 1)], schemas.RAIL["light_rail_stops"])
    timetable = df([("505", "Stop 3", 0, "05:30", "00:10"), ("505", "Stop 3", 1, "05:40", "00:20"), ("505", "Stop 1", 0, "06:00", "00:10")], "route string, direction string, position int, first_train string, last_train string")
    places = df([("1", 22.4, 113.9)], "stop_id string, lat double, lon double")
    out = feed.light_rail(raw, places, timetable)
    times = [(r["stop_id"], r["arrival_time"]) for r in out.stop_times.where("trip_id = 'LR-505-O'").orderBy("stop_sequence").collect()]
    assert times == [("LR1", "00:00:00"), ("LR2", "00:05:00"), ("LR3", "00:10:00")]
    assert {r["trip_id"] for r in out.trips.collect()} == {"LR-505-O", "LR-705"}
    assert {(r["route_id"], r["route_long_name"], r["route_text_color"]) for r in out.routes.collect()} == {("LR-505", "Stop 1 - Stop 3", "FFFFFF"), ("LR-705", "Stop 3 (Circular)", "FFFFFF")}


def test_pathways(spark):
    df = spark.createDataFrame
    platforms = df([("ADM", "a1", "P1"), ("ADM", "a2", "P2"), ("CEN", "a3", "P3")], "station_code string, amenity_id string, stop_id string")
    entrances = df([("ADM", "Admiralty", "A", "E-A"), ("ADM", "Admiralty", "B", "E-B")], "station_code string, station_name string, exit string, stop_id string")
    exits = df([("x1", " a ", "", ""), ("x2", None, "Exit B", "")], "amenity_id string, ref string, name_en string, name_zh string")
    walks = df([("a1", "x1", "ADM", 40.6, 1.5), ("a1", "x9", "ADM", 1.0, 1.0)], schemas.JOURNEYS["exits"])
    across = df([("a1", "a2", None, 2.0)], schemas.JOURNEYS["platforms"])
    out = {(r["pathway_id"], r["from_stop_id"], r["to_stop_id"], r["length"], r["traversal_time"]) for r in feed.pathways(platforms, entrances, exits, walks, across).collect()}
    assert out == {("MTR-PATH-PEX-a1-x1", "P1", "E-A", 41, 90), ("MTR-PATH-PP-a1-a2", "P1", "P2", None, 120), ("DUMMY-PEX-P1-E-B", "P1", "E-B", None, 60), ("DUMMY-PEX-P2-E-A", "P2", "E-A", None, 60), ("DUMMY-PEX-P2-E-B", "P2", "E-B", None, 60)}


def test_agency_fares(spark):
    from tramline.operators.fares import agency_rules

    fares = spark.createDataFrame([("1", "2", "5.5"), ("1", "1", "0"), ("2", "9", "3"), ("2", "1", "x")], "from_id string, to_id string, fare string")
    stations = spark.createDataFrame([("1", "MTR-A"), ("2", "MTR-B")], "station_id string, stop_id string")
    assert [(r["special_fare_id"], r["offboarding_stop_id"], r["price"]) for r in agency_rules(fares, stations, "MTR").collect()] == [("MTR-1-2", "MTR-B", 5.5)]
    assert {r["special_fare_id"] for r in agency_rules(fares, None, "LR", "LR").collect()} == {"LR-1-2", "LR-2-9"}


def test_alerts_from_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    one = {"id": "2", "type": "detour", "header": {"en": "Detour", "tc": ""}, "description": {}, "route_ids": ["R1"], "stop_ids": ["S1"], "start": "2024-01-01T00:00:00+08:00", "cause": "GREMLINS"}
    two = {"id": "1", "type": "stop_closed", "header": {"en": "Closed"}, "description": {}, "stop_ids": ["S9"], "replacement_stop_id": "S8", "effect": "NO_SUCH"}
    three = {"id": "3", "type": "network_notice", "header": {"en": "Note"}, "description": {"en": "x"}, "start": "2024-01-02T00:00:00Z"}
    (tmp_path / "a" / "one.json").write_text(json.dumps([one, three]))
    (tmp_path / "two.json").write_text(json.dumps(two))
    (tmp_path / "schema.json").write_text(json.dumps({"$schema": "x", "type": "object"}))
    (tmp_path / "bad.json").write_text(json.dumps({"id": "4", "type": "no_such_type", "header": {}, "description": {}}))
    found = alerts.entities(readers.events(spark, str(tmp_path))).collect()
    by_id = {r["id"]: r for r in found}
    assert sorted(by_id) == ["1", "2", "3"]
    assert by_id["2"]["cause"] == "OTHER_CAUSE" and by_id["2"]["effect"] == "DETOUR" and len(by_id["2"]["informed_entity"]) == 2
    assert by_id["1"]["effect"] == "OTHER_EFFECT" and by_id["1"]["description_text"][0]["text"] == "Use replacement stop S8."
    assert [tuple(e) for e in by_id["3"]["informed_entity"]] == [(None, None, None)]
    raw = alerts.feed_bytes(spark.createDataFrame(found, alerts.entities(readers.events(spark, str(tmp_path))).schema), 1_700_000_000)
    assert raw.startswith(b"\x0a\x0d\x0a\x032.0\x10\x00\x18") and raw.index(b"Closed") < raw.index(b"Detour") < raw.index(b"Note")


def decoded(message):
    """(number, value) of the fields of a message."""
    at, out = 0, []

    def number():
        nonlocal at
        n = shift = 0
        while True:
            byte = message[at]
            at += 1
            n |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return n

    while at < len(message):
        tag = number()
        if tag & 7:
            n = number()
            out.append((tag >> 3, bytes(message[at : at + n])))
            at += n
        else:
            out.append((tag >> 3, number()))
    return out


def test_feed_in_parts_equals_its_entities(spark, tmp_path):
    """Alerts over many tasks and parts: every entity once, in the feed's order."""
    events = [(f"e{i}", "detour", {"en": f"text {i}"}, f"2024-01-{1 + i * 7 % 28:02d}T00:00:00" if i % 3 else None) for i in range(400)]
    df = spark.createDataFrame(events, "id string, type string, header map<string,string>, start string").repartition(7)
    made = {"description": "map<string,string>", "url": "map<string,string>", "route_ids": "array<string>", "stop_ids": "array<string>", "trip_ids": "array<string>", "end": "string", "cause": "string", "effect": "string", "replacement_stop_id": "string"}
    found = alerts.entities(df.withColumns({c: F.lit(None).cast(kind) for c, kind in made.items()}))
    chunks = list(alerts.feed_chunks(found, 1_700_000_000, most=500))
    assert len(chunks) > 20 and max(map(len, chunks)) < 1000
    fields = decoded(b"".join(chunks))
    assert [n for n, _ in fields] == [1] + [2] * 400
    rows = alerts.in_feed_order(found).collect()
    assert [v for n, v in fields[1:]] == [alerts.alert_bytes(r) for r in rows]
    assert [dict(decoded(v))[1].decode() for _, v in fields[1:]] == [r["id"] for r in rows]
    alerts.write_feed(found, 1_700_000_000, str(tmp_path / "a.pb"))
    assert (tmp_path / "a.pb").read_bytes() == b"".join(chunks)


def test_archive_of_pieces(spark, tmp_path):
    """Members deflated in many pieces by tasks are those of the files, and checksums join."""
    import random
    import zlib

    from tramline.sources import archive

    rng = random.Random(1)
    for _ in range(50):
        a, b = rng.randbytes(rng.randint(0, 300)), rng.randbytes(rng.randint(0, 70_000))
        assert archive.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    stops = spark.range(5000).select(F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("stop_id"), F.concat(F.lit('say "é\n'), F.col("id").cast("string")).alias("stop_name"))
    sinks.write_feed({"stops": stops, "agency": feed.agencies(spark), "routes": spark.createDataFrame([], "route_id string")}, str(tmp_path / "feed"))
    target = sinks.package(spark, str(tmp_path / "feed"), ["stops", "agency", "routes"], str(tmp_path / "feed.zip"), most=3000)
    with zipfile.ZipFile(target) as z:
        assert z.testzip() is None and z.namelist() == ["stops.txt", "agency.txt", "routes.txt"]
        for name in ("stops", "agency", "routes"):
            files = sorted((tmp_path / "feed" / name).glob("part-*.csv"))
            head = ",".join(schemas.FEED[name]).encode() + b"\n"
            assert z.read(f"{name}.txt") == head + b"".join(f.read_bytes().removeprefix(head) for f in files)
        assert z.getinfo("stops.txt").compress_size < z.getinfo("stops.txt").file_size / 3
    pieces = archive.deflated(spark.read.option("lineSep", "\n").text(str(tmp_path / "feed" / "stops")).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")), 3000)
    assert pieces.count() > 20


def test_stream_of_alerts(spark, tmp_path):
    """Versions, an older one that comes late, ends; every batch writes its changes alone."""
    from tramline.streaming import alerts_stream

    folder, seen = tmp_path / "in", []
    folder.mkdir()
    state = str(tmp_path / "state")

    def step(name, at, *events):
        text = "".join(json.dumps({"type": "detour", "description": {}, **e}) + "\n" for e in events)
        (tmp_path / name).write_text(text)
        os.utime(tmp_path / name, (at, at))
        (tmp_path / name).rename(folder / name)
        del seen[:]
        alerts_stream.run(spark, str(folder), state, lambda df: seen.extend((r["id"], r["gone"]) for r in df.collect()), str(tmp_path / "check")).awaitTermination(120)
        return sorted(seen), {r["id"]: r["header"]["en"] for r in alerts_stream.current(spark, state).collect()}

    hour = 1_700_000_000
    ends = "2023-11-15T00:00:00Z"  # some two hours later
    assert step("a.json", hour, {"id": "1", "header": {"en": "one"}}, {"id": "2", "header": {"en": "two"}, "end": ends}) == ([("1", False), ("2", False)], {"1": "one", "2": "two"})
    assert step("b.json", hour + 60, {"id": "3", "header": {"en": "three"}}) == ([("3", False)], {"1": "one", "2": "two", "3": "three"})
    assert step("c.json", hour + 120, {"id": "1", "header": {"en": "four"}}) == ([("1", False)], {"1": "four", "2": "two", "3": "three"})
    assert step("d.json", hour + 30, {"id": "1", "header": {"en": "older"}}, {"id": "4", "type": "unknown", "header": {"en": "no"}}) == ([], {"1": "four", "2": "two", "3": "three"})
    # what is seen after the end of 2 ends it, in this run or the next
    changed, now = step("e.json", hour + 90_000, {"id": "5", "header": {"en": "five"}})
    more, now = step("f.json", hour + 90_060, {"id": "6", "header": {"en": "over"}, "end": ends}, {"id": "3", "header": {"en": "over"}, "end": ends})
    assert sorted(changed + more) == [("2", True), ("3", True), ("5", False)]
    assert now == {"1": "four", "5": "five"}
    assert {r["id"] for r in alerts.entities(alerts_stream.current(spark, state)).collect()} == {"1", "5"}
    written = sum(spark.read.parquet(str(p)).count() for p in (tmp_path / "state").iterdir())
    assert written == 7


def test_many_batches_write_as_much_as_changes(spark, tmp_path):
    from tramline.streaming import alerts_stream

    folder, wrote = tmp_path / "in", []
    folder.mkdir()
    for k in range(4):
        text = "".join(json.dumps({"id": f"{i}", "type": "detour", "header": {"en": f"{k}"}, "description": {}}) + "\n" for i in (range(500) if not k else range(3 * k)))
        (tmp_path / f"{k}.json").write_text(text)
        os.utime(tmp_path / f"{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))
        (tmp_path / f"{k}.json").rename(folder / f"{k}.json")
        alerts_stream.run(spark, str(folder), str(tmp_path / "state"), lambda df: wrote.append(df.count()), str(tmp_path / "check")).awaitTermination(120)
    assert [n for n in wrote if n] == [500, 3, 6, 9]
    assert alerts_stream.current(spark, str(tmp_path / "state")).count() == 500


def test_html_tables(spark):
    page = "<table><tr><th>Stop</th><th>To Yuen Long</th><th></th></tr><tr><td>A &amp; B</td><td>05:30</td><td>-</td></tr></table><table><tr><th>Stop</th><th>x</th></tr><tr><td>C</td><td>06:00</td><td>23:00</td></tr></table>"
    cells = html.table_cells(spark.createDataFrame([("610", page), ("none", "")], "route string, html string"), "route", "html")
    out = sorted(tuple(r) for r in html.train_times(cells, "route").collect())
    assert out == [("610", "Yuen Long", 1, "A & B", "05:30", None), ("610", "circular", 1, "C", "06:00", "23:00")]


def test_readers(spark, tmp_path):
    (tmp_path / "data.json").write_text(json.dumps({"data": [{"route": "1", "bound": "O", "seq": "1", "stop": "S"}]}))
    assert readers.json_data(spark, str(tmp_path / "data.json"), schemas.KMB["route_stops"]).first()["stop"] == "S"
    (tmp_path / "edges.json").write_text(json.dumps({"a": {"b": 5, "c": "x"}, "d": 3}))
    assert sorted(tuple(r) for r in readers.edges(spark, str(tmp_path / "edges.json")).collect()) == [("a", "b", 5.0), ("a", "c", None)]
    (tmp_path / "trips.txt").write_text("﻿route_id,service_id,trip_id\n1,a &amp; b,1-1-x-0600\n", encoding="utf-8")
    assert tuple(readers.gov_feed(spark, str(tmp_path), "trips")["trips"].first()) == ("1", "a & b", "1-1-x-0600")
    (tmp_path / "w").mkdir()
    shape = lambda kind, c: {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"ROUTE_ID": "7"}, "geometry": {"type": kind, "coordinates": c}}]}
    (tmp_path / "w" / "7-O.json").write_text(json.dumps(shape("LineString", [[114, 22], [114.5, 22]])))
    (tmp_path / "w" / "7-I.json").write_text(json.dumps(shape("MultiLineString", [[[114, 22]], [[115, 23]]])))
    assert {(r["route_id"], r["bound"], len(r["points"])) for r in readers.waypoints(spark, str(tmp_path / "w")).collect()} == {("7", "O", 2), ("7", "I", 2)}
    (tmp_path / "codes.json").write_text(json.dumps({"HKI": ["1", "2"], "KLN": ["3"]}))
    assert readers.region_codes(spark, str(tmp_path / "codes.json")).count() == 3


def test_fetch(spark, tmp_path):
    import io
    import urllib.error

    from tramline.sources import fetch

    calls = []

    def opener(url, timeout):
        calls.append(url)
        if len(calls) == 1:
            raise OSError("down")
        return io.BytesIO(b'{"a": 1}')

    assert fetch.get_json("u", opener=opener, sleep=lambda s: None) == {"a": 1} and len(calls) == 2

    def missing(url, timeout):
        raise urllib.error.HTTPError(url, 404, "no", None, None)

    assert fetch.get_json("u", opener=missing) is None
    rows = lambda: [{"a": "1"}]
    assert fetch.landed(spark, str(tmp_path / "x"), "a string", rows).count() == 1
    assert fetch.landed(spark, str(tmp_path / "x"), "a string", lambda: 1 / 0).count() == 1
    assert fetch.is_forced("kmb_routes", {"kmb": True}) and not fetch.is_forced("kmb_routes", {"gmb": True})


def test_exits(spark):
    stations = spark.createDataFrame([("ADM", "Admiralty", "金鐘")], "station_code string, station_name_en string, station_name_zh string")
    found = spark.createDataFrame([("ADMIRALTY STATION EXIT A", 834500.0, 815500.0, "Lift at A, C1"), ("ADMIRALTY STATION EXIT B1", 834510.0, 815510.0, None)], "name string, east double, north double, facility string")
    out = {r["exit"]: (r["barrier_free"], round(r["lat"], 2)) for r in readers.station_exits(stations, found).collect()}
    assert out == {"A": (True, 22.28), "B1": (False, 22.28)}


def test_audits_and_small_steps(spark, network):
    df = spark.createDataFrame
    cols = "route string, lat_first double, lon_first double, lat_last double, lon_last double"
    mine = df([("1", 22.0, 114.0, 22.5, 114.0), ("2", 22.0, 114.0, 22.5, 114.0)], cols)
    other = df([("1", 22.5, 114.0, 22.0, 114.0), ("2", 22.0, 114.0, 22.5, 114.0)], cols)
    assert {r["route"]: r["flip"] for r in feed.cooperative_flips(mine, other, ["route"]).collect()} == {"1": True, "2": False}
    sample = {(r["route_id"], r["bound"]): r["trip_id"] for r in feed.sample_trips(network[1]).collect()}
    assert sample["10", "O"] == "10-1-287-0600" and sample["10", "I"] == "10-2-287-0700"
    areas = df([("a", ["s", "t", "s"]), ("b", [])], "area_id string, stop_ids array<string>")
    assert sorted(tuple(r) for r in feed.area_stops(areas).collect()) == [("a", "s"), ("a", "t")]
    register = df([(7, "CTB", "B2", 1), (9, "CTB", "B2", 0), (8, "KMB", "B2", 0), (3, "CTB", "Z", 2)], "ROUTE_ID int, COMPANY_CODE string, ROUTE_NAMEC string, SPECIAL_TYPE int")
    assert [tuple(r) for r in feed.match_by_register(df([("B2",), ("B2",)], "route string"), register).collect()] == [("B2", 9)]
    report = {r["agency"]: (r["routes"], r["matched"]) for r in feed.match_report(feed.together(network[0]), feed.match(feed.together(network[0]), network[1])).collect()}
    assert report == {"KMB": (3, 2), "CTB": (5, 4)}


def test_shapes_take_trip_names(spark):
    shapes = spark.createDataFrame([("s", 1), ("t", 1)], "shape_id string, shape_pt_sequence int")
    trips = spark.createDataFrame([("b", "s"), ("a", "s"), ("c", None)], "trip_id string, shape_id string")
    one, two = sinks.shapes_named_by_trip(shapes, trips)
    assert [tuple(r) for r in one.collect()] == [("a", 1)]
    assert {r["trip_id"]: r["shape_id"] for r in two.collect()} == {"a": "a", "b": "a", "c": None}


def test_further_readers(spark, tmp_path):
    (tmp_path / "osm.json").write_text(json.dumps({"elements": [{"type": "node", "id": 1, "lat": 22.3, "lon": 114.1, "tags": {"name": "A"}}, {"type": "relation", "id": 2}]}))
    assert [(r["type"], r["id"], r["lat"]) for r in readers.overpass(spark, str(tmp_path / "osm.json")).orderBy("id").collect()] == [("node", 1, 22.3), ("relation", 2, None)]
    (tmp_path / "points.tsv").write_text("a\tPOINT (114.1 22.3)\nb\tLINESTRING (1 2, 3 4)\n")
    assert sorted((tuple(r) for r in readers.wkt_points(spark, str(tmp_path / "points.tsv")).collect()), key=repr) == [("a", 114.1, 22.3), ("b", None, None)]
    names = {lang: spark.createDataFrame([("1", f"{lang}1", 22.2, 114.2)] + ([("2", "en2", 22.3, 114.2)] if lang == "en" else []), schemas.TRAM) for lang in ("en", "tc", "sc")}
    assert sorted((r["stop_code"], r["name_en"], r["name_tc"], r["name_sc"]) for r in readers.tram_stops(names["en"], names["tc"], names["sc"]).collect()) == [("1", "en1", "tc1", "sc1"), ("2", "en2", None, None)]
    for day, hour in ((0, 7), (6, 23)):
        (tmp_path / "times" / str(day)).mkdir(parents=True)
        (tmp_path / "times" / str(day) / f"{hour}.json").write_text(json.dumps({"a": {"b": 10 * hour}}))
    assert sorted(tuple(r) for r in readers.hourly_edges(spark, str(tmp_path / "times")).collect()) == [(0, 7, "a", "b", 70.0), (6, 23, "a", "b", 230.0)]
    places = spark.createDataFrame([("One", 1, 836694.05, 819069.80), ("One", 2, 0.0, 0.0)], "name string, rank int, east double, north double")
    out = readers.geocoded(spark.createDataFrame([("One",), ("Two",)], "station string"), places, "station").orderBy("station").collect()
    assert abs(out[0]["lat"] - 22.3106) < 0.001 and out[1]["lat"] is None
    cells = html.table_cells(spark.createDataFrame([("p", "<table><tr><th>Line</th></tr><tr><td>Tuen Ma Line</td><td>2.7-3</td><td>3</td><td>4</td><td></td><td>5</td></tr></table>")], "page string, html string"), "page", "html")
    assert [tuple(r) for r in readers.headways(cells, "page").collect()] == [("Tuen Ma Line", "2.7-3", "3", "4", None, "5")]


def test_fare_tables_are_never_broadcast(spark):
    """Rules that are exploded are estimated at the size of what they are made of; a broadcast of them took the driver's memory."""
    pairs = spark.range(5).selectExpr("id", "explode(sequence(1, 6)) AS s").selectExpr("concat_ws('-', id, 1, s, s + 1) AS fare_id", "double(s) AS price", "'HKD' AS currency_type")
    own = spark.createDataFrame([("T1", "3", 0), ("T2", "9", 0)], "trip_id string, gov_route_id string, direction_id int")
    out = feed.trip_fares(own, pairs.select("fare_id"), pairs.drop("s"))
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in out.collect()) == [("T1", s, s + 1, float(s), "HKD") for s in range(1, 7)]


def test_spellings_that_are_equal_are_asked_once(spark):
    """A trip's variant in two spellings is two rows of the join with terminals, not eight."""
    lines = spark.createDataFrame([("L", "UT", "A", "a", 1), ("L", "UT", "B", "b", 2)], "line string, direction string, name_en string, name_tc string, sequence int")
    trips = spark.createDataFrame([("MTRR-L-UT", 0)], "trip_id string, direction_id int")
    out = feed.rail_headsigns(trips, feed.rail_terminals(lines))
    assert [tuple(r) for r in out.collect()] == [("MTRR-L-UT", "B", "b")]
    assert out._jdf.queryExecution().analyzed().toString().count("posexplode(array_distinct(") == 2


def test_frequencies_make_pairs_once(spark):
    """our trips are read once and laid in few orders; a trip with any government frequency, even one that can't be read, takes no headways."""
    own = spark.createDataFrame([("t1", "g1", "s", "O"), ("t2", "g2", "s", "O"), ("t3", "g3", "s", "O")], "trip_id string, gov_route_id string, original_service_id string, gov_bound string")
    trips = spark.createDataFrame([("g1", "s", "g1-1-s-0600"), ("g1", "s", "g1-1-s-0700"), ("g2", "s", "g2-1-s-0600"), ("g2", "s", "g2-1-s-0610"), ("g3", "s", "g3-1-s-0600")], "route_id string, service_id string, trip_id string")
    times = spark.createDataFrame([(t, f"{t[-4:-2]}:{t[-2:]}:00", "", 1) for t in ("g1-1-s-0600", "g1-1-s-0700", "g2-1-s-0600", "g2-1-s-0610", "g3-1-s-0600")], "trip_id string, arrival_time string, departure_time string, stop_sequence int")
    given = spark.createDataFrame([("g1-1-s-0600", "06:00:00", "07:00:00", 600), ("g1-1-s-0600", "06:30:00", "08:00:00", 600), ("g3-1-s-0600", "x", "07:00:00", 600)], "trip_id string, start_time string, end_time string, headway_secs int")
    found = feed.frequencies(own, feed.Gov(None, trips, times, None, given))
    assert sorted(tuple(r) for r in found.collect()) == [("t1", "06:00:00", "08:00:00", 600), ("t2", "06:00:00", "06:20:00", 600)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 3, plan


def test_prices_of_a_route(spark):
    """A fare needs a rule and a price; of several for a pair of stops the dearest counts; ids that are none are left out."""
    ids = ["7-1-1-2", "7-1-1-3", "7-1-1-3-b", "7-2-1-2", "8-1-1-2", None, "x"]
    rules = spark.createDataFrame([(i, "7") for i in ids], "fare_id string, route_id string").unionByName(spark.createDataFrame([("9-1-1-2", "9")], "fare_id string, route_id string"))
    prices = spark.createDataFrame([("7-1-1-2", 3.0), ("7-1-1-3", 4.0), ("7-1-1-3-b", 5.0), ("7-2-1-2", 6.0), ("7-2-1-2", 7.0), ("8-1-1-2", None), ("6-1-1-2", 1.0), (None, 2.0)], "fare_id string, price double").withColumn("currency_type", F.lit("HKD"))
    out = {(r["gov_route_id"], r["gov_direction"], r["start_seq"], r["end_seq"]): r["price"] for r in feed.route_prices(rules, prices).collect()}
    assert out == {("7", 1, 1, 2): 3.0, ("7", 1, 1, 3): 5.0, ("7", 2, 1, 2): 7.0, ("8", 1, 1, 2): None}


def test_special_fares_ask_a_route_once(spark):
    """Two trips of a route, one of which ends where the cheaper price does; stops at both ends; and no row for each trip and fare."""
    own = spark.createDataFrame([("a", "7", 0), ("b", "7", 0), ("c", "7", 1), ("d", None, 0)], "trip_id string, gov_route_id string, direction_id int")
    fares = spark.createDataFrame([("7-1-1-2", 3.0), ("7-1-1-3", 3.0), ("7-1-1-4", 5.0), ("7-1-2-3", 3.0), ("7-1-2-4", 5.0), ("7-2-1-2", 9.0)], "fare_id string, price double").withColumn("currency_type", F.lit("HKD"))
    called = spark.createDataFrame([(t, f"{t}{i}", str(i)) for t, n in (("a", 4), ("b", 3), ("c", 4), ("d", 4)) for i in range(1, n + 1)] + [("a", "odd", "x")], "trip_id string, stop_id string, stop_sequence string")
    out = feed.special_fares(own, fares.select("fare_id"), fares.drop("price", "currency_type").join(fares, "fare_id"), called)
    assert [tuple(r) for r in out.collect()] == [("a-1-2-3-3.0", "trip", "a", "a1", "a3", 3.0, "HKD")]


def test_special_fares_shuffle_fares_by_route_alone(spark, data):
    """Fares are dealt by route, once, and never by trip or by their own ids; the text of times isn't made."""
    from tramline.plans import catalog

    plan = catalog.QUERIES["feed_special_fares"](spark, data)._jdf.queryExecution().executedPlan().toString()
    dealt = [x.partition("Exchange hashpartitioning(")[2] for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert not any("fare_id" in x.replace("split(fare_id", "") or "end_seq" in x for x in dealt) and len(dealt) <= 14
    assert sum("split(fare_id" in x for x in dealt) == 1
