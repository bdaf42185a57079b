"""Tracks onto roads: which road each point of a track was on, by the likeliest way through the network.

``match_tracks`` does the whole. ``nearby_roads``, ``ways_between``, ``in_steps`` and ``ways_asked`` find the same by joins, a row for
each point and road or step and end; ``moves`` and ``likeliest`` are the plain form of its pass. Tests hold the pass against them.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Costs are whole numbers of this part of a unit, so that sums and ties don't depend on the order of adding.
UNIT = 1_000_000
#: Cells along a side of a tile; a cell is twice the radius wide.
TILE = 32
#: Rows of points with the same tiles that are one part of a home, about, and rows that a task looks at in one go.
PART, GO = 200_000, 20_000
#: Pairs of roads that a task weighs in one go, about.
PAIRS = 500_000
#: What is known of a road; of a step, its ends and length.
NET = ("road", "a", "b", "ax", "ay", "bx", "by", "length")
#: A cost that no way has.
NEVER = 2**61


def laid(roads: DataFrame, size: float, reach: float) -> DataFrame:
    """roads, with length, once for each square, ``size`` wide, from which they can be ``reach`` away: _cx and _cy. Long roads are laid in pieces no longer than a square."""
    c = F.col
    cut = roads.withColumn("_n", F.greatest(F.ceil(c("length") / size), F.lit(1)).cast("int"))
    cut = cut.withColumn("_i", F.explode(F.sequence(F.lit(0), c("_n") - 1)))
    cell = lambda v: F.floor(v / size).cast("long")

    def span(axis: str) -> Column:
        begin, end = c(f"a{axis}"), c(f"b{axis}")
        one, two = begin + (end - begin) * c("_i") / c("_n"), begin + (end - begin) * (c("_i") + 1) / c("_n")
        return F.sequence(cell(F.least(one, two) - reach), cell(F.greatest(one, two) + reach))

    return cut.withColumn("_cx", F.explode(span("x"))).withColumn("_cy", F.explode(span("y"))).drop("_i", "_n").distinct()


def whole_roads(roads: DataFrame) -> DataFrame:
    """(road, a, b, ax, ay, bx, by, length) of the roads that have an id and a length."""
    length = F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))
    own = roads.where(length.isNotNull() & F.col("road").isNotNull())
    return own.select("road", "a", "b", *(F.col(k).cast("double").alias(k) for k in ("ax", "ay", "bx", "by"))).withColumn("length", length)


def both_ways(roads: DataFrame) -> DataFrame:
    """(a, b, way): the shortest road from one end to another, in both directions."""
    one = roads.select("a", "b", F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")).alias("way"))
    return one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"), "way")).where("a IS NOT NULL AND b IS NOT NULL AND way IS NOT NULL").groupBy("a", "b").agg(F.min("way").alias("way"))


def nearby_roads(points: DataFrame, roads: DataFrame, radius: float) -> DataFrame:
    """Each point once for each road within ``radius``: columns of both, along (units from the road's first end), away.

    Points have x and y on a plane; roads have road, a, b (names of their ends), ax, ay, bx, by. A road is laid on a grid
    in pieces no longer than a cell, so long roads are found from all along them, and a point stands in one cell.
    """
    c = F.col
    size = 2.0 * radius
    cell = lambda v: F.floor(v / size).cast("long")
    placed = points.withColumns({"_cx": cell(c("x")), "_cy": cell(c("y"))}).join(laid(whole_roads(roads), size, radius), ["_cx", "_cy"]).drop("_cx", "_cy")
    dot = (c("x") - c("ax")) * (c("bx") - c("ax")) + (c("y") - c("ay")) * (c("by") - c("ay"))
    share = F.when(c("length") > 0, F.least(F.greatest(dot / (c("length") * c("length")), F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    near = placed.withColumn("_share", share)
    away = F.hypot(c("x") - (c("ax") + (c("bx") - c("ax")) * c("_share")), c("y") - (c("ay") + (c("by") - c("ay")) * c("_share")))
    return near.withColumns({"along": c("_share") * c("length"), "away": away}).where(c("away") <= radius).drop("_share")


def ways_between(roads: DataFrame, hops: int) -> DataFrame:
    """(a, b, way): the shortest way between two ends over at most ``hops`` roads, in both directions, none to itself included."""
    step = both_ways(roads)
    found = step.select("a").distinct().select("a", F.col("a").alias("b"), F.lit(0.0).alias("way"))
    for _ in range(hops):
        further = found.join(step.select(F.col("a").alias("b"), F.col("b").alias("_c"), F.col("way").alias("_way")), "b").select("a", F.col("_c").alias("b"), (F.col("way") + F.col("_way")).alias("way"))
        found = found.unionByName(further).groupBy("a", "b").agg(F.min("way").alias("way"))
    return found


def in_steps(near: DataFrame, noise: float) -> DataFrame:
    """(_track, n, _o, x, y, line, asked, ends, here): the points of each track that have roads near them, in order.

    near has (_track, _o, x, y, road, a, b, length, along, away). here are the roads of a point, line is the straight way from the
    point before; asked and ends are the ends of roads there and here, between which ways are to be looked up. One
    shuffle by track makes all of it.
    """
    c = F.col
    own = F.round(F.pow(c("away") / noise, 2) / 2 * UNIT).cast("bigint")
    road = F.struct("road", own.alias("own"), "a", "b", "along", (c("length") - c("along")).alias("left"))
    each = near.select("_track", "_o", "x", "y", road.alias("_road")).repartition("_track").groupBy("_track", "_o", "x", "y").agg(F.collect_list("_road").alias("here"))
    each = each.withColumn("ends", F.array_compact(F.array_distinct(F.concat("here.a", "here.b"))))
    w = Window.partitionBy("_track").orderBy("_o", "x", "y")
    line = F.hypot(c("x") - F.lag("x").over(w), c("y") - F.lag("y").over(w))
    return each.select("_track", F.row_number().over(w).alias("n"), "_o", "x", "y", line.alias("line"), F.lag("ends").over(w).alias("asked"), "ends", "here")


def ways_asked(steps: DataFrame, ways: DataFrame) -> DataFrame:
    """(_track, n, u, to): the known ways from an end u of a road near the point before to the ends of those near this one.

    A step asks once for each end, with all that it asks for, and not for each pair of roads and of their ends; what it
    is told is no more than it asked for.
    """
    c = F.col
    reach = ways.groupBy(c("a").alias("u")).agg(F.collect_list(F.struct(c("b").alias("v"), "way")).alias("_reach"))
    asked = steps.where("asked IS NOT NULL").select("_track", "n", F.explode("asked").alias("u"), "ends")
    told = asked.join(reach, "u").select("_track", "n", "u", F.filter("_reach", lambda e: F.array_contains(c("ends"), e["v"])).alias("to"))
    return told.where(F.size("to") > 0)


def moves(road: tuple, earlier: list[tuple], ways: dict, line: float, slack: float) -> list[dict]:
    """{"before", "cost"} of each road of the step before from which a known way leads here, dearer the more the way
    differs from the straight line; roads are (road, own, a, b, along, left), ways {u: {v: way}}."""
    name, _, a, b, along, left = road
    here, found = ((a, along), (b, left)), []
    for before, _, u, w, gone, rest in earlier:
        if before == name:
            way = abs(along - gone)
        else:
            way = min([out + back + to[v] for e, out in ((u, gone), (w, rest)) if (to := ways.get(e)) for v, back in here if v in to], default=None)
            if way is None:
                continue
        cost = abs(way - line) / slack * UNIT
        whole = int(cost)
        found.append({"before": before, "cost": whole + (cost - whole >= 0.5)})
    return found


def likeliest(steps: list[tuple[int, list]], jump: int) -> Iterator[tuple]:
    """Viterbi over one track: (n, road) of the cheapest way, last step first; steps are (n, [(road, own, sources)]),
    sources {"before", "cost"}.

    A road is reached from one that connects with it, or by a jump from the best road of the step before. The lesser
    road wins a tie.
    """
    last, came = {}, []
    for _, here in steps:
        best = min(((cost, road) for road, cost in last.items()), default=None)
        reached, back = {}, {}
        for road, own, sources in here:
            ways = [(last[s["before"]] + s["cost"], s["before"]) for s in sources if s["before"] in last]
            if best is not None:
                ways.append((best[0] + jump, best[1]))
            cost, back[road] = min(ways, default=(0, None))
            reached[road] = cost + own
        last = reached
        came.append(back)
    road = min((cost, road) for road, cost in last.items())[1]
    for (n, _), back in zip(reversed(steps), reversed(came), strict=True):
        yield n, road
        road = back[road]


def tiles_of(roads: DataFrame, side: float, reach: float, hops: int) -> DataFrame:
    """(_cx, _cy, _net): the roads that a point in a tile, ``side`` wide, can be on, and, without an id, the steps that ways of at most
    ``hops`` roads between the ends of these go over: each is incident to an end that is less than half as many roads away."""
    c, tile = F.col, ["_cx", "_cy"]
    step = both_ways(roads)
    own = laid(whole_roads(roads), side, reach)
    ends = own.select(*tile, F.explode(F.array("a", "b")).alias("a")).where("a IS NOT NULL").distinct()
    for _ in range((hops + 1) // 2 - 1):
        ends = ends.unionByName(ends.join(step, "a").select(*tile, c("b").alias("a"))).distinct()
    steps = ends.join(step, "a").select(*tile, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), c("way").alias("length")).distinct()
    both = own.unionByName(steps, allowMissingColumns=True)
    return both.groupBy(*tile).agg(F.collect_list(F.struct(*NET)).alias("_net"))


class Network(NamedTuple):
    """Roads in the order of their ids, with numbers for their ends, and the steps from end to end, in the order of where they begin."""

    names: list
    ends: np.ndarray  # two for each road, -1 for none
    places: np.ndarray  # ax, ay, bx, by, length
    first: np.ndarray  # of the steps from an end
    to: np.ndarray
    way: np.ndarray


def network(roads: set[tuple], steps: set[tuple]) -> Network:
    own = sorted(roads, key=itemgetter(0))
    number = {end: i for i, end in enumerate(dict.fromkeys(end for a, b, _ in steps for end in (a, b)))}
    both = np.array([(number[u], number[v], way) for a, b, way in steps for u, v in ((a, b), (b, a))], dtype="f8").reshape(-1, 3)
    both = both[np.argsort(both[:, 0], kind="stable")]
    # an end that no road with a length has leads nowhere
    ends = np.array([[number.get(r[1], -1), number.get(r[2], -1)] for r in own], dtype="i8").reshape(-1, 2)
    first = np.searchsorted(both[:, 0], np.arange(len(number) + 1))
    return Network([r[0] for r in own], ends, np.array([r[3:] for r in own], dtype="f8").reshape(-1, 5), first, both[:, 1].astype("i8"), both[:, 2])


def runs(first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of numbers that begin at first: whose run each is of, and the number."""
    whose = np.repeat(np.arange(len(counts)), counts)
    return whose, np.arange(len(whose)) + np.repeat(first - (np.cumsum(counts) - counts), counts)


def rounded(value: np.ndarray) -> np.ndarray:
    """Whole numbers, halves upwards."""
    value = np.minimum(value, NEVER)
    whole = np.floor(value)
    return whole.astype("i8") + (value - whole >= 0.5)


def on_cells(net: Network, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cx, cy, road) of the cells, twice the radius wide, from which a road can be within the radius."""
    size, (ax, ay, bx, by, length) = 2.0 * radius, net.places.T
    n = np.maximum(np.ceil(length / size), 1).astype("i8")
    road, i = runs(np.zeros(len(n), "i8"), n)
    spans = []
    for a, b in ((ax, bx), (ay, by)):
        one, two = a[road] + (b - a)[road] * i / n[road], a[road] + (b - a)[road] * (i + 1) / n[road]
        low = np.floor((np.minimum(one, two) - radius) / size).astype("i8")
        spans.append((low, np.floor((np.maximum(one, two) + radius) / size).astype("i8") - low + 1))
    (x, wide), (y, high) = spans
    piece, k = runs(np.zeros(len(x), "i8"), wide * high)
    cells = np.unique(np.stack([x[piece] + k // high[piece], y[piece] + k % high[piece], road[piece]], axis=1), axis=0)
    return cells[:, 0], cells[:, 1], cells[:, 2]


def near(x: np.ndarray, y: np.ndarray, net: Network, cells: tuple, radius: float) -> tuple[np.ndarray, ...]:
    """(point, road, along, away) of all roads within the radius of each point, as ``nearby_roads`` finds them."""
    size, (cx, cy, road) = 2.0 * radius, cells
    px, py = np.floor(x / size), np.floor(y / size)
    low, high = cy.min(), cy.max()
    inside = (px >= cx.min()) & (px <= cx.max()) & (py >= low) & (py <= high)
    at = np.where(inside, px, 0).astype("i8") * (high - low + 1) + np.where(inside, py - low, 0).astype("i8")
    held = cx * (high - low + 1) + cy - low
    first = np.searchsorted(held, at)
    point, k = runs(first, np.where(inside, np.searchsorted(held, at, "right") - first, 0))
    road = road[k]
    ax, ay, bx, by, length = net.places[road].T
    x, y = x[point], y[point]
    dot = (x - ax) * (bx - ax) + (y - ay) * (by - ay)
    share = np.where(length > 0, np.minimum(np.maximum(dot / np.where(length > 0, length * length, 1.0), 0.0), 1.0), 0.0)
    away = np.hypot(x - (ax + (bx - ax) * share), y - (ay + (by - ay) * share))
    keep = away <= radius
    return point[keep], road[keep], (share * length)[keep], away[keep]


def ways_from(ends: np.ndarray, net: Network, hops: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, way) of the shortest ways of at most ``hops`` roads from the ends, as ``ways_between`` finds them; the code is from * all ends + to."""
    size = max(len(net.first) - 1, 1)
    code, way = ends * (size + 1), np.zeros(len(ends))
    for _ in range(hops):
        at = code % size
        of, k = runs(net.first[at], net.first[at + 1] - net.first[at])
        code = np.concatenate([code, code[of] // size * size + net.to[k]])
        way = np.concatenate([way, way[of] + net.way[k]])
        order = np.lexsort((way, code))
        code, way = code[order], way[order]
        least = np.r_[True, code[1:] != code[:-1]]
        code, way = code[least], way[least]
    return code, way


def least_of(value: np.ndarray, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least value of each run, none of them empty, and the place of the first that has it."""
    least = np.minimum.reduceat(value, first)
    return least, np.minimum.reduceat(np.where(value == np.repeat(least, counts), np.arange(len(value)), len(value)), first)


def likeliest_of_all(track: np.ndarray, x: np.ndarray, y: np.ndarray, net: Network, cells: tuple, radius: float, noise: float, slack: float, hops: int, jump: int) -> tuple[np.ndarray, np.ndarray]:
    """(road, along) of each step of whole tracks, -1 where no road is near: what ``likeliest`` finds with ``moves``, for all
    tracks at once, the first steps of all before the second ones. The pairs of roads at hand are PAIRS, or those of one step."""
    road_of, along_of = np.full(len(x), -1), np.zeros(len(x))
    point, road, along, away = near(x, y, net, cells, radius)
    if not len(point):
        return road_of, along_of
    step, counts = np.unique(point, return_counts=True)
    begins = np.r_[True, track[step][1:] != track[step][:-1]]
    begin = np.flatnonzero(begins)
    level = np.arange(len(step)) - np.repeat(begin, np.diff(np.r_[begin, len(step)]))
    order = np.argsort(level, kind="stable")
    bounds = np.searchsorted(level[order], np.arange(level.max() + 2))
    upto = np.r_[0, np.cumsum(np.where(begins, 0, counts * np.r_[0, counts[:-1]])[order])]
    if len(begin) > 1 and np.diff(upto[bounds]).max() > PAIRS:
        cut = step[begin[len(begin) // 2]]
        halves = [likeliest_of_all(track[k], x[k], y[k], net, cells, radius, noise, slack, hops, jump) for k in (slice(0, cut), slice(cut, None))]
        return np.concatenate([h[0] for h in halves]), np.concatenate([h[1] for h in halves])
    line = np.r_[0.0, np.hypot(np.diff(x[step]), np.diff(y[step]))]
    first = np.cumsum(counts) - counts
    own = rounded((away / noise) ** 2 / 2 * UNIT)
    left = net.places[road, 4] - along
    ends = net.ends[road]
    used = np.unique(ends)
    known, known_way = ways_from(used[used >= 0], net, hops)
    size = max(len(net.first) - 1, 1)

    def cost_of(before: np.ndarray, here: np.ndarray, straight: np.ndarray) -> np.ndarray:
        way = np.where(road[before] == road[here], np.abs(along[here] - along[before]), np.inf)
        other = np.flatnonzero(road[before] != road[here])
        p, q = before[other], here[other]
        if len(known):
            for i, out in enumerate((along, left)):
                for j, back in enumerate((along, left)):
                    u, v = ends[p, i], ends[q, j]
                    code = u * size + v
                    at = np.minimum(np.searchsorted(known, code), len(known) - 1)
                    there = (u >= 0) & (v >= 0) & (known[at] == code)
                    way[other] = np.minimum(way[other], np.where(there, out[p] + back[q] + known_way[at], np.inf))
        return np.where(np.isinf(way), NEVER, rounded(np.abs(way - straight) / slack * UNIT))

    total, back = own.copy(), np.full(len(own), -1)
    n = 1
    while n < len(bounds) - 1:
        m = max(n + 1, int(np.searchsorted(upto[bounds], upto[bounds[n]] + PAIRS, "right")) - 1)
        m = min(m, len(bounds) - 1)
        steps = order[bounds[n] : bounds[m]]
        # a road of a step after another, with all roads of the step before it
        s, here = runs(first[steps], counts[steps])
        q, before = runs(first[steps - 1][s], counts[steps - 1][s])
        cost = cost_of(before, here[q], line[steps][s][q])
        roads_upto, pairs_upto = np.r_[0, np.cumsum(counts[steps])], np.r_[0, np.cumsum(counts[steps - 1][s])]
        for k in range(n, m):
            i, j = bounds[k] - bounds[n], bounds[k + 1] - bounds[n]
            of, a, b = steps[i:j], roads_upto[i], roads_upto[j]
            c, d = pairs_upto[a], pairs_upto[b]
            value, place = least_of(total[before[c:d]] + cost[c:d], pairs_upto[a:b] - c, counts[steps - 1][s[a:b]])
            source = before[c:d][place]
            w, all_before = runs(first[of - 1], counts[of - 1])
            best, best_at = least_of(total[all_before], np.cumsum(counts[of - 1]) - counts[of - 1], counts[of - 1])
            best, best_at = (best + jump)[s[a:b] - i], all_before[best_at][s[a:b] - i]
            jumps = (best < value) | ((best == value) & (best_at < source))
            total[here[a:b]] += np.where(jumps, best, value)
            back[here[a:b]] = np.where(jumps, best_at, source)
        n = m
    _, cheapest = least_of(total, first, counts)
    last = np.r_[begins[1:], True]
    chosen = np.where(last, cheapest, -1)
    for n in range(len(bounds) - 2, 0, -1):
        steps = order[bounds[n] : bounds[n + 1]]
        chosen[steps - 1] = back[chosen[steps]]
    road_of[step], along_of[step] = road[chosen], along[chosen]
    return road_of, along_of


def walked(dealt: DataFrame, shape, radius: float, noise: float, slack: float, hops: int, jump: int) -> DataFrame:
    """The rows of dealt that are points, as shape has them, with _road and _along.

    dealt has rows of tiles with _net, and of points with _x, _y, _step (whether they have a place in a track) and _at: twice the number of the row
    in its track, and one more if it is equal to the row before. Both have _home and _part, which are dealt over tasks and
    sorted, the tiles of a home before its tracks, so a task holds the roads of one home and some whole tracks.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(shape)

    def run(batches):
        def matched(held, net, cells):
            rows = pa.Table.from_batches(held)
            road, along = np.full(len(rows), -1), np.zeros(len(rows))
            if net is not None and net.names:
                x, y, place, counts = (rows[k].to_numpy() for k in ("_x", "_y", "_at", "_step"))
                of = np.flatnonzero(counts)
                new = place[of] % 2 == 0
                at = of[new]
                if len(at):
                    found, distance = likeliest_of_all(np.cumsum(place == 2)[at], x[at], y[at], net, cells, radius, noise, slack, hops, jump)
                    road[of], along[of] = found[np.cumsum(new) - 1], distance[np.cumsum(new) - 1]
            none = road < 0
            names = pa.array(net.names if net is not None else [], out.field("_road").type)
            given = {"_road": names.take(pa.array(road, mask=none)), "_along": pa.array(along, mask=none)}
            yield from pa.Table.from_arrays([given[f.name] if f.name in given else rows[f.name] for f in out], schema=out).to_batches()

        key, roads, steps, held, net, cells = None, set(), set(), [], None, None
        for batch in batches:
            home, part, tile = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("_home", "_part", "_tile"))
            turns = np.flatnonzero((home[1:] != home[:-1]) | (part[1:] != part[:-1]) | (tile[1:] != tile[:-1])) + 1
            for i, j in zip([0, *turns], [*turns, len(home)], strict=True):
                if i == j:
                    continue
                own = batch.slice(i, j - i)
                if (home[i], part[i]) != key:
                    if held:
                        yield from matched(held, net, cells)
                    key, roads, steps, held, net, cells = (home[i], part[i]), set(), set(), [], None, None
                if tile[i]:
                    for row in zip(*(field.to_pylist() for field in own.column("_net").flatten()), strict=True):
                        if row[0] is None:
                            steps.add((row[1], row[2], row[-1]))
                        else:
                            roads.add(row)
                    continue
                if net is None and roads:
                    net = network(roads, steps)
                    cells = on_cells(net, radius)
                held.append(own)
                if sum(map(len, held)) >= GO:
                    begin = np.flatnonzero(own.column("_at").to_numpy(zero_copy_only=False) == 2)
                    if len(begin) and (begin[-1] or len(held) > 1):
                        held[-1] = own.slice(0, begin[-1])
                        yield from matched(held, net, cells)
                        held = [own.slice(begin[-1])]
        if held:
            yield from matched(held, net, cells)

    return dealt.mapInArrow(run, shape)


def match_tracks(points: DataFrame, roads: DataFrame, track: str, order: str, radius: float = 50.0, noise: float = 10.0, slack: float = 20.0, hops: int = 3, jump: float = 30.0) -> DataFrame:
    """points with road and along: the likeliest road of each point, by a hidden Markov model over the track.

    A point is dear by the square of its distance to the road (``noise``), a step by how much the way on the network
    differs from the straight line (``slack``); where no way of at most ``hops`` roads connects two steps, a ``jump``
    is paid. All roads within the radius take part. A point with no road near it, or without a place, an order
    or a track, has null, and the step goes on from the point before. Points of a track with equal order are ranked by
    place; equal points are equal rows of the result, and equal roads are one; other roads have ids of their own.
    Columns that points have besides are kept, but for road and along.

    Points are dealt once: tracks over the same tiles of the plane have one home, to which the roads of these tiles are
    sent once, with those that ways between their ends go over, and not for each point and step. A home of many tracks has
    several parts. The pass holds the roads of the tiles of one track, and some tracks.
    """
    c = F.col
    points = points.drop(*({"road", "along"} - {track, order}))
    side = 2.0 * radius * TILE
    x, y = c("x").cast("double"), c("y").cast("double")
    step = c(track).isNotNull() & c(order).isNotNull() & x.isNotNull() & y.isNotNull()
    tile = F.when(step, F.struct(F.floor(x / side).cast("long").alias("_cx"), F.floor(y / side).cast("long").alias("_cy")))
    # rows without a track are no one's, and are spread out
    placed = points.withColumn("_spare", F.when(c(track).isNull(), F.xxhash64(order, "x", "y")))
    own = Window.partitionBy(track, "_spare")
    ordered = own.orderBy(order, x, y)
    ranked = placed.withColumn("_at", F.row_number().over(ordered) * 2 + (F.rank().over(ordered) != F.row_number().over(ordered)).cast("int"))
    ranked = ranked.withColumn("_tiles", F.sort_array(F.collect_set(tile).over(own)))
    dealt = ranked.withColumn("_home", F.when(F.size("_tiles") > 0, F.xxhash64("_tiles")).otherwise(F.xxhash64(track, "_spare")))
    homes = dealt.where(F.size("_tiles") > 0).groupBy("_home", "_tiles").agg(F.count("*").alias("_points"))
    # at most one home for each PART points
    parts = homes.groupBy("_home").agg(F.ceil(F.sum("_points") / PART).cast("int").alias("_parts")).where("_parts > 1")
    many = lambda df: df.join(F.broadcast(parts), "_home", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    mine = many(dealt).select(*points.columns, "_at", "_home", F.pmod(F.xxhash64(track), c("_parts")).cast("int").alias("_part"))
    asked = many(homes).select("_home", F.explode(F.sequence(F.lit(0), c("_parts") - 1)).alias("_part"), "_tiles").select("_home", "_part", F.inline("_tiles"))
    sent = asked.join(tiles_of(roads, side, radius * 1.001, hops), ["_cx", "_cy"]).select("_home", "_part", "_net")
    both = mine.unionByName(sent, allowMissingColumns=True).repartition("_home", "_part").sortWithinPartitions("_home", "_part", c("_at").isNotNull(), track, "_at")
    ready = both.select(*points.columns, x.alias("_x"), y.alias("_y"), "_at", step.alias("_step"), "_home", "_part", c("_at").isNull().alias("_tile"), F.explode_outer("_net").alias("_net"))
    kind = roads.schema["road"].dataType
    shape = points.select("*", F.lit(None).cast(kind).alias("_road"), F.lit(None).cast("double").alias("_along")).schema
    found = walked(ready, shape, radius, noise, slack, hops, round(jump * UNIT))
    return found.withColumnsRenamed({"_road": "road", "_along": "along"})
