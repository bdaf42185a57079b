"""Operators on small cases, and properties on random ones."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tramline.operators import calendars, fares, schedule, selection, spatial


def test_intervals_equal_the_sequential_rule(spark):
    rng = random.Random(3)
    rows, expected = [], []
    for trip in range(300):
        starts = sorted(rng.sample(range(0, 60), rng.randint(1, 8)))
        own = [[s, s + rng.randint(0, 25), rng.choice([5, 10])] for s in starts]
        rows += [(trip, *o) for o in own]
        done = []
        for s, e, h in own:
            if done and s <= done[-1][1] and h == done[-1][2]:
                done[-1][1] = max(done[-1][1], e)
            else:
                if done and s < done[-1][1]:
                    done[-1][1] = s
                done.append([s, e, h])
        expected += [(trip, *d) for d in done]
    out = schedule.coalesce_intervals(spark.createDataFrame(rows, "trip int, start int, end int, headway int"), "trip")
    assert sorted(tuple(r) for r in out.select("trip", "start", "end", "headway").collect()) == sorted(expected)


def blocks(t):
    g = [b - a for a, b in zip(t, t[1:], strict=False)]
    out, start, c = [], 0, max(g[0], 60) if g else 0
    for i in range(1, len(g)):
        n = max(g[i], 60)
        d = abs(n - c) / c
        if d > 0.1 or i == len(g) - 1:
            end = i if d > 0.1 else i + 1
            out.append((t[start], t[end], max(60, int(sum(g[start:end]) / (end - start)))))
            start, c = i, n
    return out


def test_blocks_equal_the_fold(spark):
    rng = random.Random(5)
    trips = {k: sorted(rng.sample(range(0, 4000, 10), rng.randint(1, 12))) for k in range(200)}
    out = schedule.departure_blocks(spark.createDataFrame([(k, s) for k, t in trips.items() for s in t], "trip int, second int"), "trip", "second")
    assert sorted(tuple(r) for r in out.collect()) == sorted((k, *b) for k, t in trips.items() for b in blocks(t))


def test_headway_of_one_departure(spark):
    out = schedule.headways(spark.createDataFrame([("a", 100), ("b", 100), ("b", 160), ("b", 160), ("c", None)], "trip string, second int"), "trip", "second")
    assert sorted(tuple(r) for r in out.collect()) == [("a", 100, 86500, 86400), ("b", 100, 160, 60), ("b", 160, 220, 60)]


def test_ties_are_kept(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z")], "k string, d int, v string")
    assert {r["v"] for r in selection.keep_ties(df, "k", F.col("d")).collect()} == {"x", "y"}
    assert [r["v"] for r in selection.keep_first(df, "k", [F.col("d"), F.col("v")]).collect()] == ["x"]


def test_top_group_keeps_all_its_rows(spark):
    """Most rows win, then the least mean, then the least id; keys without groups keep all rows."""
    rows = [("a", "g1", 1, 2), ("a", "g2", 2, 1), ("a", "g2", 3, 1), ("b", "g3", 4, 5), ("b", "g4", 5, 3), ("c", "g6", 6, 1), ("c", "g5", 7, 1), ("d", None, 8, 1), ("d", None, 9, 2)]
    df = spark.createDataFrame(rows, "k string, g string, v int, diff int")
    kept = selection.keep_top_group(df, "k", F.col("g"), "diff")
    assert kept.columns == df.columns
    assert {r["v"] for r in kept.collect()} == {2, 3, 5, 7, 8, 9}
    ranked = {(r["k"], r["g"]) for r in selection.rank_groups(df, "k", "g", "diff").collect()}
    assert {(r["k"], r["g"]) for r in kept.collect()} == ranked


def test_overlap_of_circular_arrays(spark):
    def merged(out, back):
        return spark.range(1).select(schedule.merge_overlap(F.array(*map(F.lit, out)), F.array(*map(F.lit, back))).alias("x")).first()["x"]

    assert merged(["a", "b", "c"], ["c", "b", "d"]) == ["a", "b", "c", "d"]
    assert merged(["a", "b"], ["c", "d"]) == ["a", "b", "c", "d"]
    assert merged(["a"], ["a"]) == ["a"]


def test_as_of(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 0), (3, "b", 9)], "id int, k string, t int")
    right = spark.createDataFrame([("a", 1, 8.0), ("a", 5, 6.0), ("a", 7, 4.0)], "k string, s int, price double")
    assert {r["id"]: r["price"] for r in selection.as_of(left, right, ["k"], "t", "s", "price").collect()} == {1: 6.0, 2: None, 3: None}


def test_greedy_clusters(spark):
    rows = [("p", "N", 0, 22.0, 114.0), ("q", "N", 1, 22.00003, 114.0), ("r", "N", 2, 22.00006, 114.0), ("s", "M", 3, 22.0, 114.0), ("t", "M", 4, 22.5, 114.0)]
    out = spatial.greedy_clusters(spark.createDataFrame(rows, "id string, name string, o int, lat double, lon double"), "name", "id", "o", "lat", "lon")
    # q is 3.3 m from p; r is 6.6 m from p and leads for itself; s shares p's place
    assert {r["id"]: r["leader"] for r in out.collect()} == {"p": "p", "q": "p", "r": "r", "s": "p", "t": "t"}


def test_fare_resolution(spark):
    """The documented journeys: a stage fare of 8, a trip rule of 6.50, an agency rule of 15."""
    journeys = spark.createDataFrame([("one", "A", 3, 8, "c", "h"), ("two", "B", 1, 2, "x", "y"), ("three", "C", 1, 5, "tuen_mun", "tin_shui_wai")], "journey string, trip_id string, board_seq int, alight_seq int, board_stop string, alight_stop string")
    stages = spark.createDataFrame([("A", 1, 8.0), ("A", 4, 5.0), ("A", 6, 4.0), ("A", 7, 3.0), ("B", 1, 9.0), ("C", 1, 7.0)], "trip_id string, seq int, price double")
    trip_rules = spark.createDataFrame([("B", 1, 2, 6.5), ("C", 1, 5, 2.0)], "trip_id string, from_seq int, to_seq int, price double")
    agency = spark.createDataFrame([("tuen_mun", "tin_shui_wai", 15.0)], "board_stop string, alight_stop string, price double")
    out = {r["journey"]: (r["price"], r["rule"]) for r in fares.resolve(journeys, stages, trip_rules, agency).collect()}
    assert out == {"one": (8.0, "stage"), "two": (6.5, "trip"), "three": (15.0, "agency")}
    awkward = [("a", None, 3, 8, "tuen_mun", "tin_shui_wai"), ("b", "A", None, 8, "c", "h"), ("c", "A", 3, None, "c", None), ("d", "A", 3, 8, "c", "h"), ("e", "A", 3, 8, "c", "h")]
    out = {r["journey"]: (r["price"], r["rule"]) for r in fares.resolve(spark.createDataFrame(awkward, journeys.schema), stages, trip_rules, agency).collect()}
    assert out == {"a": (15.0, "agency"), "b": (None, None), "c": (8.0, "stage"), "d": (8.0, "stage"), "e": (8.0, "stage")}
    assert fares.resolve(journeys.where("false"), stages, trip_rules.where("false"), agency).count() == 0


def test_least_holding_equals_all_pairs(spark):
    """A hot key, nulls, ends below zero, empty and reversed ranges, repeated rows, ties."""
    rng = random.Random(12)
    some = lambda lo, hi: None if rng.random() < 0.05 else rng.randint(lo, hi)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    rules = [(key(), some(-5, 90), some(-9, 99), some(1, 400)) for _ in range(900)] + [("far", 3, 10**9, 7), ("far", 2, 5, 1)]
    asked = [(i, key(), some(-9, 99), some(-9, 120)) for i in range(900)] + [(900, "far", 4, 10**9), (901, "far", 4, 5), (902, "none", 1, 2), (903, "far", 4, 10**9 + 1)]
    out = fares.least_holding(spark.createDataFrame(asked, "id int, k string, low int, high int"), spark.createDataFrame(rules, "k string, s int, e int, price int"), ["k"], "low", "high", "s", "e", "price")
    holds = lambda r, k, low, high: None not in (k, low, high, r[1], r[2], r[3]) and r[0] == k and r[1] <= low and r[2] >= high
    expected = {i: min((r[3] for r in rules if holds(r, k, low, high)), default=None) for i, k, low, high in asked}
    assert sum(v is not None for v in expected.values()) > 100
    found = out.collect()
    assert {r["id"]: r["price"] for r in found} == expected and len(found) == len(asked)


def test_least_holding_makes_no_pairs(spark):
    """A key with 20,000 rules and as many questions that nearly all of them hold."""
    rules = spark.range(20_000).select(F.lit("k").alias("k"), (F.col("id") % 150).alias("s"), (F.col("id") + 200).alias("e"), F.col("id").alias("price"))
    asked = spark.range(20_000).select("id", F.lit("k").alias("k"), F.lit(150).alias("low"), (F.col("id") + 200).alias("high"))
    out = fares.least_holding(asked, rules, ["k"], "low", "high", "s", "e", "price")
    assert out.where("price = id").count() == 20_000


def test_special_ranges(spark):
    rows = [("t", 1, 2, 3.0), ("t", 1, 3, 3.0), ("t", 1, 4, 5.0), ("t", 2, 4, 5.0)]
    priced = spark.createDataFrame(rows, "trip_id string, start_seq int, end_seq int, price double")
    out = fares.special_ranges(priced, spark.createDataFrame([("t", 4)], "trip_id string, last_seq int"))
    assert [(r["start_seq"], r["min_end"], r["max_end"], r["price"]) for r in out.collect()] == [(1, 2, 3, 3.0)]


def test_missing_pairs(spark):
    nodes = spark.createDataFrame([("s", "p1"), ("s", "p2"), ("s", "p3"), ("u", "p4")], "station string, p string")
    edges = spark.createDataFrame([("p2", "p1")], "a string, b string")
    assert sorted((r["low"], r["high"]) for r in selection.missing_pairs(nodes, "station", "p", edges, "a", "b").collect()) == [("p1", "p3"), ("p2", "p3")]


def led_by(rows, radius=5.0):
    """The rule as it is said: in order, each free point takes the later free ones within the radius."""
    import numpy as np

    from tramline.functions.geo import geodesic

    first, out = {}, {}
    for p, n, o, lat, lon in sorted(rows, key=lambda r: (r[2], r[0])):
        first.setdefault((lat, lon), (p, n))
    for name in {n for _, n in first.values() if n is not None}:
        own = [(p, lat, lon) for (lat, lon), (p, n) in first.items() if n == name and lat is not None]
        ids, lats, lons = [r[0] for r in own], np.array([r[1] for r in own]), np.array([r[2] for r in own])
        leader = [None] * len(own)
        for i in range(len(own)):
            if leader[i] is None:
                near = [j for j in np.flatnonzero((abs(lats - lats[i]) < 1e-4) & (abs(lons - lons[i]) < 1e-4)) if j >= i and leader[j] is None]
                for j, d in zip(near, geodesic([lats[i]] * len(near), [lons[i]] * len(near), lats[near], lons[near]), strict=True):
                    if d <= radius:
                        leader[j] = ids[i]
        out |= dict(zip(ids, leader, strict=True))
    return {p: out.get(first[lat, lon][0], first[lat, lon][0]) for p, _, _, lat, lon in rows}


@pytest.mark.parametrize("n, span, step", [(300, 300, 1), (20_000, 3000, 1), (60, 60, 300)])
def test_greedy_clusters_equal_the_rule(spark, n, span, step):
    """Scattered points, one name with a crowd of them, and a chain in which each point is near the one before."""
    rng = random.Random(n)
    place = (lambda i: (round(22.3 + rng.randrange(span) * 1e-6, 7), round(114.1 + rng.randrange(span) * 1e-6, 7))) if step == 1 else (lambda i: (round(22.3 + i * 4e-5, 7), 114.1))
    rows = [(i, "N" if n > 1000 or rng.random() < 0.7 else "M", i if step > 1 else rng.randrange(n), *place(i)) for i in range(n)]
    rows += [(n + 1, None, 5, 22.3, 114.1), (n + 2, "N", -1, None, 114.1), (n + 3, "N", 3, None, 114.1), (n + 4, "N", 3, *rows[0][3:])]
    df = spark.createDataFrame(rows, "id int, name string, o int, lat double, lon double")
    out = spatial.greedy_clusters(df, "name", "id", "o", "lat", "lon")
    assert {r["id"]: r["leader"] for r in out.collect()} == led_by(rows)


def test_greedy_clusters_of_nothing(spark):
    assert spatial.greedy_clusters(spark.createDataFrame([], "id int, name string, o int, lat double, lon double"), "name", "id", "o", "lat", "lon").count() == 0


def test_near_places_are_measured_as_on_the_ellipsoid(spark):
    from tramline.functions.geo import geodesic, near_m

    rng = random.Random(1)
    rows = [(lat := rng.uniform(-80, 80), lon := rng.uniform(-180, 179), lat + rng.uniform(-1e-4, 1e-4), lon + rng.uniform(-1e-4, 1e-4)) for _ in range(200)]
    got = [r[0] for r in spark.createDataFrame(rows, "a double, b double, c double, d double").select(near_m(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()]
    want = geodesic(*zip(*rows, strict=True))
    assert all(abs(x - y) < 1e-5 for x, y in zip(got, want, strict=True))


def test_best_names_equal_those_of_all_pairs(spark):
    """Words with few and with many edits, short and empty names, and how many pairs are compared for them."""
    from tramline.functions.text import similarity
    from tramline.operators import fuzzy

    rng = random.Random(9)
    words = ["STAR FERRY", "CHUK YUEN ESTATE", "CENTRAL PIER", "TSIM SHA TSUI EAST", "YAU TONG", "LAM TIN STATION", "KWUN TONG PROMENADE", "WONG TAI SIN TEMPLE", "SHATIN MARKET", "TAI PO CENTRE"]

    def changed(word, edits):
        letters = list(word)
        for _ in range(edits):
            at = rng.randrange(len(letters) + 1)
            letters[at : at + rng.randrange(2)] = rng.choice(["", "X", "ST"])
        return "".join(letters)

    asked = {(k, g, changed(rng.choice(words), rng.choice([0, 0, 1, 2, 9]))) for k in range(40) for g in range(4) for _ in range(6)} | {(0, 0, ""), (0, 1, "A"), (0, 1, "ZZZZ"), (0, 9, "STAR"), (0, 0, None)}
    offered = {(g, changed(w, e)) for g in range(4) for w in words for e in (0, 1, 3)} | {(g, changed("".join(rng.choice("ABCDEFGHIJKLMNOPRSTUVW") for _ in range(rng.randint(6, 18))), 0)) for g in range(4) for _ in range(60)} | {(1, ""), (1, "B"), (2, None)}
    a, o = spark.createDataFrame(sorted(asked, key=repr), "k int, g int, name string"), spark.createDataFrame(sorted(offered, key=repr), "g int, other string")
    every = a.where("name IS NOT NULL").join(o.where("other IS NOT NULL"), "g")
    want = {tuple(r) for r in every.groupBy("k", "g", "name").agg(F.max(similarity(F.col("name"), F.col("other")))).collect()}
    assert {(r.k, r.g, r.name, r.best) for r in fuzzy.best_scores(a, o, ["g"], ["k"], "name", "other").select("k", "g", F.col("name").alias("name"), "best").collect()} == want
    equal, compared = fuzzy.compared_pairs(a, o, ["g"], ["k"], "name", "other")
    assert equal.count() > 100
    assert compared.count() < every.count() / 3, (compared.count(), every.count())


def test_near_pairs_of_a_crowded_cell(spark):
    """Equal to all pairs, with cells of many points and parts of few."""
    rng = random.Random(4)
    rows = [(i, "N" if i % 3 else "M", rng.random() * (4 if i % 2 else 60), rng.random() * (4 if i % 2 else 60)) for i in range(500)]
    want = {(a[1], a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and (a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2 <= 25}
    df = spark.createDataFrame(rows, "id int, name string, x double, y double")
    got = [tuple(r) for r in spatial.near_pairs(df, "name", "id", "x", "y", 5.0, crowd=20).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_a_calendars_dates_are_one_before_they_meet_services(spark):
    """A date that is published many times is joined once, and the least exception counts, a null never before one that is known."""
    known = spark.createDataFrame([("a", 20240101 + i % 3, 1 + i % 2) for i in range(3000)] + [("a", 20240101, None), ("b", 20240101, 2), ("c", 20240109, 1)], "service_id string, date int, exception_type int")
    services = spark.createDataFrame([(f"S{i}", "a") for i in range(20)] * 2 + [("S0", "b"), ("T", None)], "service_id string, original_service_id string")
    out = calendars.calendar_dates(services, known)
    assert sorted(map(tuple, out.collect())) == sorted((f"S{i}", 20240101 + d, 1) for i in range(20) for d in range(3))
    below = out._jdf.queryExecution().optimizedPlan().toString().partition("Join Inner")[2]
    assert below.count("Aggregate [") == 2  # services and dates, each one first
