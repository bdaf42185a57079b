"""Matching, nearest neighbours, lookups with fallbacks, and existence tests."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tramline.functions import text as X
from tramline.functions.geo import haversine_m
from tramline.operators import matching as M
from tramline.operators import selection as S
from tramline.operators import spatial as P
from tramline.plans import feed, fixed
from tramline.plans.registry import STOPS, Registry, haversine_sql, stops

REGISTRY = Registry()
query = REGISTRY.query

_MATCH = """
o AS (SELECT c_nationkey || '-' || c_mktsegment AS route_key, c_nationkey AS name, c_mktsegment AS bound, n FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL)),
g AS (SELECT name, service, agency, k * 3 + service AS m FROM (SELECT s_nationkey AS name, s_suppkey % 7 AS service, CASE WHEN s_suppkey % 2 = 0 THEN 'KMB' ELSE 'LWB' END AS agency, count(*) AS k FROM supplier GROUP BY ALL)),
p AS (SELECT *, abs(n - m) AS count_diff FROM o JOIN g USING (name) WHERE abs(n - m) <= CASE WHEN agency = 'KMB' THEN 20 ELSE 12 END)"""


def _matches(read):
    operator = read("customer").groupBy(F.concat_ws("-", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("route_key"), F.col("c_nationkey").alias("name"), F.col("c_mktsegment").alias("bound")).agg(F.count("*").alias("n"))
    service = F.col("s_suppkey") % 7
    public = read("supplier").groupBy(F.col("s_nationkey").alias("name"), service.alias("service"), F.when(F.col("s_suppkey") % 2 == 0, "KMB").otherwise("LWB").alias("agency")).agg(F.count("*").alias("k"))
    public = public.withColumn("m", F.col("k") * 3 + F.col("service")).drop("k")
    return S.best_matches(operator, public, "name", "n", "m", F.when(F.col("agency") == "KMB", 20).otherwise(12), "route_key")


@query(f"WITH {_MATCH} SELECT route_key, service, agency, n, m, count_diff FROM (SELECT *, rank() OVER (PARTITION BY route_key ORDER BY count_diff) AS r FROM p) WHERE r = 1")
def best_match_keep_ties(read):
    """Routes of two publishers with equal names and nearly equal stop counts: all of the least difference."""
    return _matches(read).select("route_key", "service", "agency", "n", "m", "count_diff")


@query(f"""WITH {_MATCH}, b AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY route_key ORDER BY count_diff) AS r FROM p) WHERE r = 1)
SELECT agency, count(DISTINCT route_key) AS routes, count(DISTINCT name) AS names, count(DISTINCT bound) AS bounds, count(*) AS patterns FROM b GROUP BY agency""")
def match_summary(read):
    """Counters of a matching run."""
    return _matches(read).groupBy("agency").agg(F.count_distinct("route_key").alias("routes"), F.count_distinct("name").alias("names"), F.count_distinct("bound").alias("bounds"), F.count("*").alias("patterns"))


@query("""
WITH e AS (SELECT l_returnflag || l_linestatus AS route_key, l_suppkey AS gov_route, count(*) AS patterns, avg(abs(l_quantity - 25)) AS mean_diff FROM lineitem GROUP BY ALL)
SELECT route_key, gov_route, patterns, round(mean_diff, 6) AS mean_diff FROM (SELECT *, row_number() OVER (PARTITION BY route_key ORDER BY patterns DESC, round(mean_diff, 9), gov_route) AS r FROM e) WHERE r = 1""")
def rank_service_groups(read):
    """For each key the group with most patterns, then the least mean difference."""
    own = read("lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("route_key"), F.col("l_suppkey").alias("gov_route"), F.abs(F.col("l_quantity") - 25).alias("diff"))
    return S.rank_groups(own, "route_key", "gov_route", "diff").select("route_key", "gov_route", "patterns", F.round("mean_diff", 6).alias("mean_diff"))


def _place(key: str, a: int, b: int):
    return ((22.2 + F.col(key) % a * 0.002).cast("double"), (113.9 + F.col(key) % b * 0.003).cast("double"))


_D = haversine_sql("22.2 + c_custkey % 97 * 0.002", "113.9 + c_custkey % 89 * 0.003", "22.2 + s_suppkey % 83 * 0.002", "113.9 + s_suppkey % 79 * 0.003")


@query(f"""
WITH p AS (SELECT c_custkey, s_suppkey, {_D} AS d FROM customer JOIN supplier ON c_custkey // 150 = s_suppkey // 10)
SELECT c_custkey, s_suppkey, round(d, 3) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) AS r FROM p WHERE d <= 9000) WHERE r = 1""")
def nearest_within_radius(read):
    """The nearest candidate of the same code within a radius; the lesser key wins a tie."""
    lat, lon = _place("c_custkey", 97, 89)
    mine = read("customer").select("c_custkey", F.floor(F.col("c_custkey") / 150).alias("code"), lat.alias("a"), lon.alias("b"))
    lat, lon = _place("s_suppkey", 83, 79)
    theirs = read("supplier").select("s_suppkey", F.floor(F.col("s_suppkey") / 10).alias("code"), lat.alias("c"), lon.alias("d"))
    found = S.nearest_within(mine.join(theirs, "code"), "c_custkey", haversine_m(F.col("a"), F.col("b"), F.col("c"), F.col("d")), 9000.0, "s_suppkey")
    return found.select("c_custkey", "s_suppkey", F.round("distance", 3).alias("distance"))


@query("""
WITH n AS (SELECT p_brand AS b, p_name AS name, count(*) AS n FROM part GROUP BY ALL),
p AS (SELECT l.b AS brand, l.name, r.name AS other, round(100.0 * (1 - levenshtein(l.name, r.name) / greatest(length(l.name), length(r.name))::DOUBLE), 6) AS score FROM n l JOIN n r ON l.b = r.b AND l.name <> r.name)
SELECT brand, name, other, score FROM (SELECT *, row_number() OVER (PARTITION BY brand, name ORDER BY score DESC, other) AS r FROM p) WHERE r = 1""")
def fuzzy_name_match(read):
    """The most similar other name of a brand by edit distance."""
    names = read("part").select(F.col("p_brand").alias("brand"), F.col("p_name").alias("name")).distinct()
    pairs = names.join(names.withColumnRenamed("name", "other"), "brand").where("name <> other")
    scored = pairs.withColumn("score", F.round(X.similarity(F.col("name"), F.col("other")), 6))
    return S.keep_first(scored, ["brand", "name"], [F.desc("score"), F.col("other")])


@query("""
WITH c AS (SELECT o_custkey AS k, o_orderpriority AS grp, count(*) FILTER (o_orderstatus = 'O') - 2 AS od, count(*) FILTER (o_orderstatus = 'F') - 2 AS idiff FROM orders GROUP BY ALL)
SELECT k, grp, abs(od) + abs(idiff) AS total_diff FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY abs(od) + abs(idiff), grp) AS r FROM c) WHERE r = 1""")
def paired_direction_match(read):
    """The group whose two directions together differ least."""
    own = read("orders").groupBy(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("grp")).agg((F.count_if(F.col("o_orderstatus") == "O") - 2).alias("od"), (F.count_if(F.col("o_orderstatus") == "F") - 2).alias("idiff"))
    return S.paired_directions(own, "k", "grp", "od", "idiff").select("k", "grp", "total_diff")


@query("""
WITH a AS (SELECT s_suppkey AS k, s_nationkey AS v, 'a' AS origin FROM supplier), b AS (SELECT c_custkey AS k, c_nationkey AS v, 'b' AS origin FROM customer WHERE c_acctbal < 3000)
SELECT k, v, origin FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, v, origin FROM b""")
def override_matches(read):
    """One publisher's matches in place of another's for shared routes."""
    base = read("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("v"), F.lit("a").alias("origin"))
    other = read("customer").where("c_acctbal < 3000").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("v"), F.lit("b").alias("origin"))
    return S.override(base, other, "k")


@query("""
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45))
AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P' AND o_totalprice > 450000)""")
def semi_anti_chain(read):
    """Nested IN and NOT EXISTS as semi and anti joins."""
    returned = read("lineitem").where("l_returnflag = 'R' AND l_quantity > 45")
    orders = read("orders")
    some = S.referential(orders, returned, "o_orderkey", "l_orderkey")
    own = S.referential(read("customer"), some, "c_custkey", "o_custkey")
    return S.orphans(own, orders.where("o_orderstatus = 'P' AND o_totalprice > 450000"), "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query("""
WITH s AS (SELECT s_suppkey, s_suppkey // 10 AS station FROM supplier),
pairs AS (SELECT a.station, a.s_suppkey AS low, b.s_suppkey AS high FROM s a JOIN s b ON a.station = b.station AND a.s_suppkey < b.s_suppkey),
e AS (SELECT DISTINCT least(x, y) AS low, greatest(x, y) AS high FROM (SELECT l_suppkey AS x, lag(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS y, l_quantity FROM lineitem) WHERE y IS NOT NULL AND l_quantity > 49)
SELECT station, low, high FROM pairs WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.low = pairs.low AND e.high = pairs.high)""")
def missing_pairs(read):
    """Pairs of a station that no walk joins in either direction."""
    nodes = read("supplier").select("s_suppkey", F.floor(F.col("s_suppkey") / 10).alias("station"))
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    edges = read("lineitem").select(F.col("l_suppkey").alias("x"), F.lag("l_suppkey").over(w).alias("y"), "l_quantity").where("y IS NOT NULL AND l_quantity > 49")
    return S.missing_pairs(nodes, "station", "s_suppkey", edges, "x", "y").select("station", "low", "high")


@query("""
WITH c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), k AS (SELECT user_id, ts, value FROM events WHERE event_type = 'click')
SELECT c.event_id, c.user_id, k.value FROM c ASOF LEFT JOIN k ON c.user_id = k.user_id AND c.ts >= k.ts""")
def asof_stage_fare(read):
    """The last price at or before a time: a value carried forward, without pairs."""
    e = read("events")
    return S.as_of(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), e.where("event_type = 'click'").select("user_id", "ts", "value"), ["user_id"], "ts", "ts", "value").select("event_id", "user_id", "value")


@query(f"""
WITH {STOPS}, p AS (SELECT s_nationkey AS n, s_suppkey % 4 AS d, min(s_suppkey) AS platform FROM supplier GROUP BY ALL), q AS (SELECT s_nationkey AS n, min(s_suppkey) AS platform FROM supplier WHERE s_acctbal > 3000 GROUP BY ALL),
s AS (SELECT l_orderkey, l_linenumber, l_partkey % 25 AS n, l_linenumber % 4 AS d FROM stops)
SELECT l_orderkey, l_linenumber, coalesce(p.platform, q.platform) AS platform FROM s LEFT JOIN p USING (n, d) LEFT JOIN q USING (n) WHERE coalesce(p.platform, q.platform) IS NOT NULL""")
def platform_resolution(read):
    """A platform of the station's line and direction, else any of the station; stops without one are dropped."""
    sup = read("supplier")
    exact = sup.groupBy(F.col("s_nationkey").alias("n"), (F.col("s_suppkey") % 4).alias("d")).agg(F.min("s_suppkey").alias("platform"))
    some = sup.where("s_acctbal > 3000").groupBy(F.col("s_nationkey").alias("n")).agg(F.min("s_suppkey").alias("platform"))
    own = stops(read).select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 25).alias("n"), (F.col("l_linenumber") % 4).alias("d"))
    return S.first_of(own, (exact, ["n", "d"], "platform"), (some, ["n"], "platform"), into="platform").where("platform IS NOT NULL").select("l_orderkey", "l_linenumber", "platform")


_LINES = ", ".join(f"({i}, '{code}', '{base}')" for i, (code, base) in enumerate(fixed.LINES))


@query(f"""
WITH ln(i, code, base) AS (VALUES {_LINES})
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN base || ' Line' WHEN 1 THEN upper(base) || ' LINE (Main)' WHEN 2 THEN code ELSE 'the ' || base END AS name, code AS line FROM part JOIN ln ON i = p_partkey % 10""")
def containment_match(read):
    """Published names of lines to their codes, by the longest name that they hold, else by a code."""
    code, base = (F.element_at(F.array(*(F.lit(x[k]) for x in fixed.LINES)), (F.col("p_partkey") % 10 + 1).cast("int")) for k in (0, 1))
    k = F.col("p_size") % 4
    name = F.when(k == 0, F.concat(base, F.lit(" Line"))).when(k == 1, F.concat(F.upper(base), F.lit(" LINE (Main)"))).when(k == 2, code).otherwise(F.concat(F.lit("the "), base))
    return read("part").select("p_partkey", name.alias("name")).withColumn("line", feed.line_of(F.col("name")))


@query("""
WITH p AS (SELECT s_suppkey AS id, s_nationkey AS name, s_suppkey % 31 * 0.7 AS x, s_suppkey % 17 * 0.9 AS y FROM supplier)
SELECT a.name, a.id AS low, b.id AS high FROM p a JOIN p b ON a.name = b.name AND a.id < b.id WHERE pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 16""")
def grid_near_pairs(read):
    """Points of a name within a radius, by an equi-join on grid cells."""
    own = read("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("name"), (F.col("s_suppkey") % 31 * 0.7).cast("double").alias("x"), (F.col("s_suppkey") % 17 * 0.9).cast("double").alias("y"))
    return P.near_pairs(own, "name", "id", "x", "y", 4.0)


_APART = haversine_sql("22.3 + x % 7 * 0.00002", "114.1 + x % 5 * 0.00002", "22.3 + h.id % 7 * 0.00002", "114.1 + h.id % 5 * 0.00002")


@query(f"""
WITH RECURSIVE h AS (
  SELECT c_custkey % 35 AS place, min(c_custkey) AS id, min(c_custkey) // 20 AS name, row_number() OVER (PARTITION BY min(c_custkey) // 20 ORDER BY min(c_custkey)) AS rn FROM customer GROUP BY c_custkey % 35),
r AS (
  SELECT DISTINCT name, CAST(0 AS BIGINT) AS rn, CAST([] AS BIGINT[]) AS led, CAST(NULL AS BIGINT) AS id, CAST(NULL AS BIGINT) AS leader FROM h
  UNION ALL
  SELECT h.name, h.rn, CASE WHEN near IS NULL THEN list_append(led, h.id) ELSE led END, h.id, coalesce(near, h.id)
  FROM r JOIN h ON h.name = r.name AND h.rn = r.rn + 1, LATERAL (SELECT list_filter(led, lambda x: {_APART} <= 5)[1] AS near) n)
SELECT c_custkey, leader FROM customer JOIN h ON place = c_custkey % 35 JOIN r ON r.id = h.id""")
def greedy_cluster(read):
    """Points of a name within five metres of a leader, in order."""
    own = read("customer").select("c_custkey", F.floor(F.col("c_custkey") / 20).cast("string").alias("name"), (22.3 + F.col("c_custkey") % 7 * 0.00002).cast("double").alias("lat"), (114.1 + F.col("c_custkey") % 5 * 0.00002).cast("double").alias("lon"))
    return P.greedy_clusters(own, "name", "c_custkey", "c_custkey", "lat", "lon")


@query("""
WITH t AS (SELECT o_orderkey AS trip, o_custkey % 50 AS route, CASE WHEN o_orderkey % 2 = 0 THEN 'O' ELSE 'I' END AS bound FROM orders),
s AS (SELECT p_partkey % 50 AS route, CASE WHEN p_size % 2 = 0 THEN 'O' ELSE 'I' END AS bound, min(p_partkey) AS shape_id, arg_min(p_brand, p_partkey) AS agency FROM part GROUP BY ALL)
SELECT trip, CASE WHEN agency IN ('Brand#1', 'Brand#2', 'Brand#3') THEN NULL ELSE shape_id END AS shape_id FROM t LEFT JOIN s USING (route, bound)""")
def shape_match(read):
    """Shapes by route and bound; a shape of another agency is left out, the trip stays."""
    trips = read("orders").select(F.col("o_orderkey").alias("trip"), (F.col("o_custkey") % 50).alias("route"), F.when(F.col("o_orderkey") % 2 == 0, "O").otherwise("I").alias("bound"))
    shapes = read("part").select((F.col("p_partkey") % 50).alias("route"), F.when(F.col("p_size") % 2 == 0, "O").otherwise("I").alias("bound"), F.col("p_partkey").alias("shape_id"), F.col("p_brand").alias("agency"))
    found = P.best_shape(trips, shapes, ["route", "bound"], [F.col("shape_id")])
    return found.select("trip", F.when(~F.col("agency").isin("Brand#1", "Brand#2", "Brand#3"), F.col("shape_id")).alias("shape_id"))


_STREETS = """
k AS (SELECT c_custkey AS k FROM customer),
roads AS (SELECT k.k * 2 AS road, k.k AS a, k.k + 1 AS b, k.k % 12 * 100.0 AS ax, k.k // 12 * 100.0 AS ay, k.k % 12 * 100.0 + 100 AS bx, k.k // 12 * 100.0 AS b_y FROM k JOIN k AS o ON o.k = k.k + 1 WHERE k.k % 12 < 11
  UNION ALL SELECT k.k * 2 + 1, k.k, k.k + 12, k.k % 12 * 100.0, k.k // 12 * 100.0, k.k % 12 * 100.0, k.k // 12 * 100.0 + 100 FROM k JOIN k AS o ON o.k = k.k + 12),
pts AS (SELECT l_orderkey AS track, l_linenumber AS step, o_custkey % 12 * 100.0 + 50 + (l_linenumber - 1 - (l_linenumber - 1) * (o_orderkey % 3) // 2) * 100 + l_partkey % 31 - 15 AS x,
  o_custkey // 12 * 100.0 + (l_linenumber - 1) * (o_orderkey % 3) // 2 * 100 + l_suppkey % 29 - 14 AS y FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""


def _streets(read):
    """A grid of streets with a crossing for each customer, twelve crossings wide, and orders that walk along it."""
    key = read("customer").select(F.col("c_custkey").alias("a"))
    x, y = (F.col("a") % 12 * 100).cast("double"), (F.floor(F.col("a") / 12) * 100).cast("double")
    ways = [key.where(where).select((F.col("a") * 2 + i).alias("road"), "a", (F.col("a") + step).alias("b"), x.alias("ax"), y.alias("ay"), (x + dx).alias("bx"), (y + dy).alias("by")) for i, step, dx, dy, where in ((0, 1, 100, 0, "a % 12 < 11"), (1, 12, 0, 100, "true"))]
    roads = S.referential(S.union_all(*ways), key, "b", "a").select("road", "a", "b", "ax", "ay", "bx", "by")
    at = F.col("l_linenumber") - 1
    up = F.floor(at * (F.col("o_orderkey") % 3) / 2)
    start = F.col("o_custkey")
    walked = read("lineitem").join(read("orders").select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    points = walked.select(F.col("l_orderkey").alias("track"), F.col("l_linenumber").alias("step"), (start % 12 * 100.0 + 50 + (at - up) * 100 + F.col("l_partkey") % 31 - 15).alias("x"), (F.floor(start / 12) * 100.0 + up * 100 + F.col("l_suppkey") % 29 - 14).alias("y"))
    return points, roads


_LINE = "sqrt(pow(q.x - p.x, 2) + pow(q.y - p.y, 2))"


@query(f"""
WITH RECURSIVE {_STREETS},
d AS (SELECT DISTINCT track, step, x, y FROM pts),
s AS (SELECT d.*, r.*, least(greatest(((x - ax) * (bx - ax) + (y - ay) * (b_y - ay)) / 10000, 0), 1) AS share FROM d JOIN roads AS r ON x BETWEEN ax - 50 AND bx + 50 AND y BETWEEN ay - 50 AND b_y + 50),
w AS (SELECT *, share * 100 AS along, sqrt(pow(x - (ax + (bx - ax) * share), 2) + pow(y - (ay + (b_y - ay) * share), 2)) AS away FROM s),
c AS (SELECT *, dense_rank() OVER (PARTITION BY track ORDER BY step, x, y) AS n, CAST(round(pow(away / 10, 2) / 2 * 1000000) AS BIGINT) AS own FROM w WHERE away <= 50),
one AS (SELECT a, b, 100 AS way FROM roads UNION ALL SELECT b, a, 100 FROM roads),
h0 AS (SELECT DISTINCT a, a AS b, 0 AS way FROM one),
h1 AS (SELECT a, b, min(way) AS way FROM (SELECT * FROM h0 UNION ALL SELECT h.a, o.b, h.way + o.way FROM h0 AS h JOIN one AS o ON o.a = h.b) GROUP BY ALL),
h2 AS (SELECT a, b, min(way) AS way FROM (SELECT * FROM h1 UNION ALL SELECT h.a, o.b, h.way + o.way FROM h1 AS h JOIN one AS o ON o.a = h.b) GROUP BY ALL),
h3 AS (SELECT a, b, min(way) AS way FROM (SELECT * FROM h2 UNION ALL SELECT h.a, o.b, h.way + o.way FROM h2 AS h JOIN one AS o ON o.a = h.b) GROUP BY ALL),
e AS (SELECT track, n, road, x, y, a AS u, along AS off FROM c UNION ALL SELECT track, n, road, x, y, b, 100 - along FROM c),
m AS (SELECT q.track, q.n, q.road, p.road AS before, p.off + way + q.off AS way, {_LINE} AS line FROM e AS p JOIN h3 ON h3.a = p.u JOIN e AS q ON q.track = p.track AND q.n = p.n + 1 AND q.u = h3.b
  UNION ALL SELECT q.track, q.n, q.road, p.road, abs(q.along - p.along), {_LINE} FROM c AS p JOIN c AS q ON q.track = p.track AND q.n = p.n + 1 AND q.road = p.road),
t AS (SELECT track, n, road, before, CAST(round(abs(min(way) - min(line)) / 20 * 1000000) AS BIGINT) AS cost FROM m GROUP BY ALL),
pair AS (SELECT q.track, q.n, q.road, p.road AS before, least(coalesce(t.cost, 30000000), 30000000) + q.own AS cost FROM c AS p JOIN c AS q ON q.track = p.track AND q.n = p.n + 1
  LEFT JOIN t ON t.track = q.track AND t.n = q.n AND t.road = q.road AND t.before = p.road),
v AS (SELECT track, n, road, own AS cost, CAST(NULL AS BIGINT) AS before FROM c WHERE n = 1
  UNION ALL SELECT track, n, road, k // 10000000, k % 10000000 FROM (SELECT pair.track, pair.n, pair.road, min((v.cost + pair.cost) * 10000000 + pair.before) AS k FROM v JOIN pair ON pair.track = v.track AND pair.n = v.n + 1 AND pair.before = v.road GROUP BY ALL)),
b AS (SELECT track, n, road, before FROM (SELECT *, row_number() OVER (PARTITION BY track ORDER BY n DESC, cost, road) AS rn FROM v) WHERE rn = 1
  UNION ALL SELECT v.track, v.n, v.road, v.before FROM b JOIN v ON v.track = b.track AND v.n = b.n - 1 AND v.road = b.before)
SELECT pts.track, pts.step, pts.x, pts.y, f.road, round(f.along, 3) AS along FROM pts LEFT JOIN (SELECT c.track, c.step, c.x, c.y, c.road, c.along FROM c JOIN b USING (track, n, road)) AS f USING (track, step, x, y)""")
def matched_tracks(read):
    """The road that each point of a walk was on, by the likeliest way through a network of streets."""
    points, roads = _streets(read)
    return M.match_tracks(points, roads, "track", "step").select("track", "step", "x", "y", "road", F.round("along", 3).alias("along"))
