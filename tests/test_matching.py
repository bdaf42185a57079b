"""Tracks onto roads: planted walks come back, the pass over a track against all ways, awkward rows."""

from __future__ import annotations

import itertools
import random

import pytest

from tramline.operators import matching as M

ROADS = "road int, a string, b string, ax double, ay double, bx double, by double"


def grid(n: int, size: float = 100.0):
    """Streets of an n by n grid: {(from, to): road}, rows."""
    rows, named = [], {}
    for x, y in itertools.product(range(n), repeat=2):
        for dx, dy in ((1, 0), (0, 1)):
            if x + dx < n and y + dy < n:
                named[(x, y), (x + dx, y + dy)] = named[(x + dx, y + dy), (x, y)] = len(rows)
                rows.append((len(rows), f"{x},{y}", f"{x + dx},{y + dy}", x * size, y * size, (x + dx) * size, (y + dy) * size))
    return named, rows


def test_planted_walks_come_back(spark):
    """Points every 20 m with an error of 6 m; all but those at crossings lie on the road that was walked."""
    rng = random.Random(4)
    named, rows = grid(9)
    points, truth = [], {}
    for track in range(30):
        at, before, step = (rng.randrange(9), rng.randrange(9)), None, 0
        for _ in range(12):
            to = rng.choice([p for a, p in named if a == at and p != before])
            for k in range(5):
                x, y = (100 * (at[i] + (to[i] - at[i]) * k / 5) + rng.gauss(0, 6) for i in (0, 1))
                points.append((track, step, x, y))
                truth[track, step] = (named[at, to], k)
                step += 1
            at, before = to, at
    out = M.match_tracks(spark.createDataFrame(points, "track int, step int, x double, y double").repartition(5), spark.createDataFrame(rows, ROADS), "track", "step").collect()
    assert len(out) == len(points)
    inside = [(r["road"], truth[r["track"], r["step"]][0]) for r in out if truth[r["track"], r["step"]][1] in (2, 3)]
    assert sum(a == b for a, b in inside) == len(inside) == 720
    assert sum(r["road"] == truth[r["track"], r["step"]][0] for r in out) > 0.85 * len(out)


def test_the_network_decides_where_the_nearest_road_is_wrong(spark):
    """A bridge over a street: the nearest road of the middle point is the street, which the bridge does not meet."""
    roads = [(1, "a", "b", 0.0, 0.0, 100.0, 0.0), (2, "b", "c", 100.0, 0.0, 200.0, 0.0), (3, "d", "e", 100.0, -200.0, 100.0, 200.0)]
    points = [("t", 1, 60.0, 2.0), ("t", 2, 99.0, 8.0), ("t", 3, 140.0, 1.0)]
    out = M.match_tracks(spark.createDataFrame(points, "k string, o int, x double, y double"), spark.createDataFrame(roads, ROADS), "k", "o").collect()
    assert {r["o"]: r["road"] for r in out} in ({1: 1, 2: 1, 3: 2}, {1: 1, 2: 2, 3: 2})


@pytest.mark.parametrize("seed", range(20))
def test_the_pass_finds_the_least_of_all_ways(seed):
    rng = random.Random(seed)
    steps = [[(road, rng.randint(0, 9)) for road in range(rng.randint(1, 4))] for _ in range(rng.randint(1, 5))]
    cost = {(n, road, before): rng.randint(0, 9) for n in range(1, len(steps)) for road, _ in steps[n] for before, _ in steps[n - 1] if rng.random() < 0.6}
    jump = 7
    price = lambda way: sum(steps[n][road][1] for n, road in enumerate(way)) + sum(min(cost.get((n, way[n], way[n - 1]), jump), jump) for n in range(1, len(way)))
    sources = lambda n, road: [{"before": b, "cost": c} for (m, r, b), c in cost.items() if (m, r) == (n, road)]
    out = [*M.likeliest([(n, [(road, own, sources(n, road)) for road, own in here]) for n, here in enumerate(steps)], jump)][::-1]
    every = itertools.product(*([road for road, _ in here] for here in steps))
    assert price([road for _, road in out]) == min(map(price, every)) and [n for n, _ in out] == list(range(len(steps)))


def test_a_long_road_is_found_from_all_along_it(spark):
    roads = [(1, "a", "b", -5000.0, -5000.0, 5000.0, 5000.0), (2, "c", "c", 3.0, 4.0, 3.0, 4.0)]
    points = [("t", i, float(i), i + 10.0) for i in range(-4000, 4000, 500)]
    near = M.nearby_roads(spark.createDataFrame(points, "k string, o int, x double, y double"), spark.createDataFrame(roads, ROADS), 50.0).collect()
    assert sorted(r["o"] for r in near if r["road"] == 1) == [p[1] for p in points]
    assert [(r["o"], r["along"], round(r["away"], 6)) for r in near if r["road"] == 2] == [(0, 0.0, round((9 + 36) ** 0.5, 6))]


def test_ways(spark):
    roads = [(1, "a", "b", 0.0, 0.0, 10.0, 0.0), (2, "b", "c", 10.0, 0.0, 15.0, 0.0), (3, "a", "c", 0.0, 0.0, 0.0, 30.0), (4, "c", "d", 0.0, 0.0, 0.0, 1.0)]
    ways = {(r["a"], r["b"]): r["way"] for r in M.ways_between(spark.createDataFrame(roads, ROADS), 2).collect()}
    assert ways["a", "c"] == ways["c", "a"] == 15.0 and ways["a", "a"] == 0.0 and ways["a", "d"] == 31.0 and ("b", "d") in ways


def test_awkward_rows(spark):
    """Nulls, places that are no numbers, points far from any road, repeated points and roads, clashing columns, no rows."""
    roads = spark.createDataFrame([(1, "a", "b", 0.0, 0.0, 100.0, 0.0)] * 2 + [(None, "a", "b", 0.0, 0.0, 100.0, 0.0), (3, None, None, 0.0, 0.0, None, 0.0)], ROADS)
    rows = [("t", 1, 10.0, 1.0), ("t", 1, 10.0, 1.0), ("t", 1, 20.0, 1.0), ("t", 2, 9999.0, 1.0), ("t", 3, 50.0, 0.0), (None, 1, 1.0, 1.0), ("t", None, 1.0, 1.0), ("t", 4, None, 1.0), ("t", 5, float("nan"), 1.0), ("u", 1, 9999.0, 0.0)]
    points = spark.createDataFrame([(*r, 7, 8, "n", "own") for r in rows], "k string, o int, x double, y double, road int, along int, n string, own string")
    out = M.match_tracks(points, roads, "k", "o").collect()
    assert len(out) == len(rows)
    assert sorted((r["o"], r["x"], r["along"]) for r in out if r["road"] == 1) == [(1, 10.0, 10.0), (1, 10.0, 10.0), (1, 20.0, 20.0), (3, 50.0, 50.0)]
    assert {r["road"] for r in out} == {1, None} and {r["n"] for r in out} == {"n"}
    assert M.match_tracks(points.where("false"), roads, "k", "o").count() == 0
    assert {r["road"] for r in M.match_tracks(points, roads.where("false"), "k", "o").collect()} == {None}


def test_a_step_asks_once_for_each_end(spark):
    """Four roads meet near both points: 12 pairs of roads at four pairs of ends are 48 questions, from five ends they are five."""
    roads = [(i, "m", e, 0.0, 0.0, 100.0 * dx, 100.0 * dy) for i, (e, dx, dy) in enumerate((("n", 0, 1), ("e", 1, 0), ("s", 0, -1), ("w", -1, 0)))]
    points = spark.createDataFrame([("t", 1, 3.0, 1.0), ("t", 2, 2.0, 5.0)], "_track string, _o int, x double, y double")
    network = spark.createDataFrame(roads, ROADS)
    steps = M.in_steps(M.nearby_roads(points, network, 50.0), 10.0)
    assert [(r["n"], len(r["here"]), r["asked"] and sorted(r["asked"])) for r in steps.orderBy("n").collect()] == [(1, 4, None), (2, 4, ["e", "m", "n", "s", "w"])]
    told = {r["u"]: {v: way for v, way in r["to"]} for r in M.ways_asked(steps, M.ways_between(network, 3)).collect()}
    assert told == {u: {v: 100.0 * (2 if "m" not in (u, v) else 1) * (u != v) for v in "mnesw"} for u in "mnesw"}


def test_moves_cost_what_the_way_differs_from_the_line():
    earlier = [(1, 0, "a", "b", 90.0, 10.0), (2, 0, "b", "c", 5.0, 95.0), (3, 0, None, "z", 1.0, 1.0)]
    ways = {"a": {"b": 100.0, "c": 200.0}, "b": {"b": 0.0, "c": 100.0}, "c": {"b": 100.0, "c": 0.0}}
    assert M.moves((2, 0, "b", "c", 30.0, 70.0), earlier, ways, 42.0, 20.0) == [{"before": 1, "cost": 100_000}, {"before": 2, "cost": 850_000}]
    assert M.moves((2, 0, "b", "c", 30.0, 70.0), earlier, {}, 25.0, 20.0) == [{"before": 2, "cost": 0}]


def plainly(points, roads, ways, radius=50.0, noise=10.0, slack=20.0, jump=30_000_000):
    """{(track, order, x, y): road} by ``moves`` and ``likeliest``, one track and one point after another."""
    import math

    out = {}
    for track in {p[0] for p in points}:
        steps, earlier, last = [], [], None
        for point in sorted({p for p in points if p[0] == track}):
            _, _, x, y = point
            here = []
            for road, a, b, ax, ay, bx, by in roads:
                length = math.hypot(bx - ax, by - ay)
                share = min(max(((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / length**2, 0.0), 1.0) if length else 0.0
                away = math.hypot(x - (ax + (bx - ax) * share), y - (ay + (by - ay) * share))
                if away <= radius:
                    here.append((road, round((away / noise) ** 2 / 2 * M.UNIT), a, b, share * length, length - share * length))
            if here:
                line = math.hypot(x - last[0], y - last[1]) if last else 0.0
                steps.append((point, [(r[0], r[1], M.moves(r, earlier, ways, line, slack)) for r in here]))
                earlier, last = here, (x, y)
        if steps:
            out.update(M.likeliest(steps, jump))
    return out


def town(seed):
    """Random streets with named ends, some double, closed, without an end or of no length, and walks with jumps among them."""
    rng = random.Random(seed)
    place = {f"p{i}": (rng.uniform(-900, 900), rng.uniform(-900, 900)) for i in range(120)}
    roads = []
    for a, (x, y) in place.items():
        for b in sorted(place, key=lambda p: (place[p][0] - x) ** 2 + (place[p][1] - y) ** 2)[rng.choice((0, 1)) : 4]:
            roads.append((len(roads), a if rng.random() > 0.03 else None, b, x, y, *place[b]))
    points = []
    for track in range(40):
        x, y = rng.uniform(-900, 900), rng.uniform(-900, 900)
        for step in range(rng.randint(1, 25)):
            x, y = (x + rng.gauss(0, 40), y + rng.gauss(0, 40)) if rng.random() > 0.05 else (rng.uniform(-1500, 1500), rng.uniform(-900, 900))
            points += [(track, step // 2, x, y)] * rng.choice((1, 1, 2))
    return points, roads


@pytest.mark.parametrize(("seed", "hops", "tile", "part"), [(1, 3, 32, 200_000), (2, 3, 2, 20), (3, 4, 3, 50), (4, 1, 2, 20), (5, 0, 1, 10)])
def test_tiles_and_parts_give_what_the_whole_network_gives(spark, monkeypatch, seed, hops, tile, part):
    """Tracks over many tiles and homes in many parts, against all roads and all ways."""
    monkeypatch.setattr(M, "TILE", tile)
    monkeypatch.setattr(M, "PART", part)
    points, roads = town(seed)
    network = spark.createDataFrame(roads, ROADS)
    ways = {}
    for r in M.ways_between(network, hops).collect():
        ways.setdefault(r["a"], {})[r["b"]] = r["way"]
    out = M.match_tracks(spark.createDataFrame(points, "k int, o int, x double, y double").repartition(3), network, "k", "o", hops=hops).collect()
    assert sorted(tuple(r)[:4] for r in out) == sorted(points)
    truth = plainly(points, roads, ways)
    assert {p: truth.get(p) for p in points} == {tuple(r)[:4]: r["road"] for r in out}
    assert len({r["road"] for r in out}) > 50


@pytest.mark.parametrize("pairs", [1, 40, 500_000])
def test_the_pass_in_pieces(monkeypatch, pairs):
    """However few pairs are weighed in one go, all tracks come out the same."""
    import numpy as np

    monkeypatch.setattr(M, "PAIRS", pairs)
    points, roads = town(7)
    own = sorted(set(points))
    steps = {(min(a, b), max(a, b), np.hypot(bx - ax, by - ay)) for _, a, b, ax, ay, bx, by in roads if a}
    least = {e: min(w for u, v, w in steps if (u, v) == e) for e in {s[:2] for s in steps}}
    net = M.network({(*r, float(np.hypot(r[5] - r[3], r[6] - r[4]))) for r in roads}, {(*e, w) for e, w in least.items()})
    track, x, y = (np.array([p[i] for p in own]) for i in (0, 2, 3))
    found, _ = M.likeliest_of_all(track, x, y, net, M.on_cells(net, 50.0), 50.0, 10.0, 20.0, 3, 30_000_000)
    ways = {u: {v: 0.0 for v in (u,)} for e in least for u in e}
    for _ in range(3):
        ways = {u: {v: min(w for w in (to.get(v), *(to[m] + s for m, s in neighbours(least, v) if m in to)) if w is not None) for v in {*to, *(n for m in to for n, _ in neighbours(least, m))}} for u, to in ways.items()}
    truth = plainly(points, roads, ways)
    assert [None if i < 0 else net.names[i] for i in found] == [truth.get(p) for p in own]


def neighbours(least, end):
    return [(v if u == end else u, w) for (u, v), w in least.items() if end in (u, v)]


def test_points_are_dealt_once_and_without_their_roads(spark, data):
    """Nothing is written down on the way; no join but that of tiles has roads, and rows of points go to their homes once."""
    import os

    from tramline.plans import catalog

    top = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(top))
    plan = catalog.QUERIES["matched_tracks"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert set(os.listdir(top)) == before
    exchanges = [x.partition("(")[2].partition(")")[0] for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert sum("_part#" in x for x in exchanges) == 1 and not any("_track" in x for x in exchanges)
