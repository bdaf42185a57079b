"""Points, lines and clusters."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.geo import haversine_m, near_m
from tramline.operators.selection import keep_first, union_all
from tramline.sources.sinks import kept


def along(points: DataFrame, line: str, order: str, lat: str, lon: str, into: str = "distance") -> DataFrame:
    """Metres from the line's first point, along its points."""
    w = Window.partitionBy(line).orderBy(order)
    step = haversine_m(F.lag(lat).over(w), F.lag(lon).over(w), F.col(lat), F.col(lon))
    return points.withColumn("_step", F.coalesce(step, F.lit(0.0))).withColumn(into, F.sum("_step").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_step")


def ends(points: DataFrame, line: str, order: str, lat: str, lon: str) -> DataFrame:
    """(line, lat_first, lon_first, lat_last, lon_last)."""
    return points.groupBy(line).agg(*(f(c, order).alias(f"{c}_{n}") for c in (lat, lon) for n, f in (("first", F.min_by), ("last", F.max_by))))


def inversion(pairs: DataFrame, mine: tuple[str, ...], theirs: tuple[str, ...], margin: float = 200.0, flip_below: float = 500.0) -> DataFrame:
    """aligned and inverted distances of two lines' ends, a warning if inverted is less by a margin, and whether to flip.

    mine and theirs name (lat, lon) of the first and (lat, lon) of the last point.
    """
    c = F.col
    d = lambda a, b: haversine_m(c(mine[a]), c(mine[a + 1]), c(theirs[b]), c(theirs[b + 1]))
    out = pairs.withColumn("aligned", d(0, 0) + d(2, 2)).withColumn("inverted", d(0, 2) + d(2, 0))
    warn = c("inverted") + margin < c("aligned")
    return out.withColumn("warning", warn).withColumn("flip", warn & (c("inverted") < flip_below))


#: Points of a cell of near_pairs that one task compares with.
CROWD = 4096


def near_pairs(points: DataFrame, name: str, point: str, x: str, y: str, radius: float, crowd: int = CROWD) -> DataFrame:
    """(name, low, high) of points of a name within a radius on a plane: equi-join on grid cells of that size.

    The points that are compared with a cell of more than ``crowd`` are dealt over parts, each of which gets the cell's
    points, so a crowded cell is the work of several tasks.
    """
    cell = lambda c: F.floor(F.col(c) / radius).cast("long")
    keys = [name, "_cx", "_cy"]
    own = points.select(name, point, x, y, cell(x).alias("_cx"), cell(y).alias("_cy"))
    parts = own.groupBy(*keys).agg(F.ceil(F.count("*") / crowd).cast("int").alias("_parts")).where("_parts > 1")
    number = F.coalesce("_parts", F.lit(1))
    near = _neighbourhood(own.select(name, F.col(point).alias("low"), F.col(x).alias("_x"), F.col(y).alias("_y"), "_cx", "_cy")).join(parts, keys, "left").withColumn("_part", F.pmod(F.xxhash64("low"), number).cast("int")).drop("_parts")
    dealt = own.withColumnRenamed(point, "high").join(parts, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), number - 1))).drop("_parts")
    pairs = near.join(dealt, [*keys, "_part"])
    return pairs.where((F.col("low") < F.col("high")) & (F.pow(F.col(x) - F.col("_x"), 2) + F.pow(F.col(y) - F.col("_y"), 2) <= radius * radius)).select(name, "low", "high")


_AROUND = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]


def _neighbourhood(df: DataFrame) -> DataFrame:
    """Each row of a cell once for each of the nine cells around it."""
    return df.withColumn("_n", F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in _AROUND)))).withColumns({"_cx": F.col("_cx") + F.col("_n.i"), "_cy": F.col("_cy") + F.col("_n.j")}).drop("_n")


def greedy_clusters(points: DataFrame, name: str, point: str, order: str, lat: str, lon: str, radius: float = 5.0, digits: int = 7) -> DataFrame:
    """(point, leader): equal rounded places share their first point; within a name, in order, each free point leads
    and takes later free ones within ``radius`` metres of itself.

    The rule depends on order, yet needs no walk: a point leads if no earlier one within the radius does, and is led by
    the earliest leader within it. So in each round the first free point of each cell of a grid leads if no earlier free
    one is near, and what is near a leader is free no longer; the rounds end when no point is free. A point meets the few
    first points of the cells around it only, so a crowded cell makes no pairs, and a name of any size is spread over its
    cells. A round is written down, as the next begins from it.
    """
    rounded = points.withColumns({"_lat": F.round(lat, digits), "_lon": F.round(lon, digits)})
    head = rounded.groupBy("_lat", "_lon").agg(F.min(F.struct(F.col(order).alias("o"), F.col(point).alias("p"), F.col(name).alias("n"))).alias("_first"))
    heads = head.select(F.col("_first.n").alias("_name"), F.col("_first.p").alias("_head"), F.col("_first.o").alias("_order"), "_lat", "_lon").where("_name IS NOT NULL AND _lat IS NOT NULL AND _lon IS NOT NULL")
    farthest = heads.agg(F.max(F.abs("_lat"))).first()[0] or 0.0
    cell = {"_cy": radius / 110_000, "_cx": radius / (110_000 * math.cos(math.radians(min(float(farthest), 89.0))))}  # degrees; a degree of latitude has more metres
    own = kept(heads.withColumns({"_cx": F.floor(F.col("_lon") / cell["_cx"]), "_cy": F.floor(F.col("_lat") / cell["_cy"])}))
    where = ["_name", "_cx", "_cy"]
    near = near_m(F.col("_lat"), F.col("_lon"), F.col("c._lat"), F.col("c._lon")) <= radius
    free, leaders = own, []
    while free.limit(1).count():
        first = free.groupBy(*where).agg(F.min(F.struct("_order", "_head", "_lat", "_lon")).alias("c"))
        blocked = _neighbourhood(first).join(free, where).where((F.struct("_order", "_head") < F.struct("c._order", "c._head")) & near).select("c._head").distinct()
        led = kept(first.join(blocked, F.col("c._head") == blocked["_head"], "left_anti"))
        leaders.append(led)
        taken = _neighbourhood(led).join(free, where).where(near).select("_head").distinct()
        free = kept(free.join(taken, "_head", "left_anti"))
    found = own.select("_head", F.col("_head").alias("leader")).limit(0)
    if leaders:
        found = _neighbourhood(union_all(*leaders)).join(own, where).where(near).groupBy("_head").agg(F.min(F.struct("c._order", "c._head")).alias("l")).select("_head", F.col("l._head").alias("leader"))
    placed = rounded.select(point, "_lat", "_lon").join(head.select(F.col("_lat").alias("_a"), F.col("_lon").alias("_b"), F.col("_first.p").alias("_head")), F.col("_lat").eqNullSafe(F.col("_a")) & F.col("_lon").eqNullSafe(F.col("_b")))
    return placed.join(found, "_head", "left").select(point, F.coalesce("leader", "_head").alias("leader"))


def lines(features: DataFrame, coordinates: str = "coordinates") -> Column:
    """All points of a MultiLineString's parts, one after another."""
    return F.flatten(F.col(coordinates))


def best_shape(trips: DataFrame, shapes: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Trips with the first shape of their keys; null if there is none."""
    return trips.join(keep_first(shapes, keys, order), keys, "left")
