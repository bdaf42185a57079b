"""Fare stages, special fares and the resolution of a journey's fare."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.operators import fares as R
from tramline.operators.schedule import change_points
from tramline.operators.selection import keep_first
from tramline.plans.registry import STOPS, Registry, stops

REGISTRY = Registry()
query = REGISTRY.query


@query(f"""
WITH {STOPS}, p AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_suppkey % 5 <> 0 THEN floor(l_extendedprice / l_quantity / 1000) END AS price FROM stops),
c AS (SELECT *, lag(price) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS before FROM p WHERE price IS NOT NULL)
SELECT l_orderkey AS trip_id, l_partkey AS from_stop_id, CAST(price AS DOUBLE) AS price FROM c WHERE before IS NULL OR before <> price""")
def fare_stage_changes(read):
    """Stops of a trip at which the price changes; stops without a fare take no part."""
    price = F.when(F.col("l_suppkey") % 5 != 0, F.floor(F.col("l_extendedprice") / F.col("l_quantity") / 1000))
    out = change_points(stops(read).withColumn("price", price), "l_orderkey", "l_linenumber", "price")
    return out.select(F.col("l_orderkey").alias("trip_id"), F.col("l_partkey").alias("from_stop_id"), F.col("price").cast("double").alias("price"))


_FARES = "f AS (SELECT l_suppkey AS trip_id, l_linenumber AS s, l_linenumber + l_partkey % 10 AS e, max(CAST(floor(l_extendedprice / 20000) AS DOUBLE)) AS price FROM lineitem GROUP BY ALL)"


def _fares(read):
    return read("lineitem").groupBy(F.col("l_suppkey").alias("trip_id"), F.col("l_linenumber").alias("start_seq"), (F.col("l_linenumber") + F.col("l_partkey") % 10).alias("end_seq")).agg(F.max(F.floor(F.col("l_extendedprice") / 20000).cast("double")).alias("price"))


@query(f"""
WITH {_FARES}, l AS (SELECT trip_id, max(e) AS last FROM f GROUP BY trip_id),
g AS (SELECT trip_id, s, price, min(e) AS lo, max(e) AS hi FROM f GROUP BY ALL), k AS (SELECT trip_id, s FROM g GROUP BY ALL HAVING count(*) > 1),
r AS (SELECT g.* FROM g JOIN k USING (trip_id, s) JOIN l USING (trip_id) WHERE hi < last)
SELECT trip_id, s AS start_seq, lo AS min_end, hi AS max_end, price FROM (SELECT *, row_number() OVER (PARTITION BY trip_id, hi, price ORDER BY s) AS rn FROM r) WHERE rn = 1""")
def special_fare_ranges(read):
    """Prices that hold for a limited range of a trip only; of equal ones the earliest boarding."""
    found = R.special_ranges(_fares(read), _fares(read).groupBy("trip_id").agg(F.max("end_seq").alias("last_seq")))
    return keep_first(found, ["trip_id", "max_end", "price"], [F.col("start_seq")]).select("trip_id", "start_seq", "min_end", "max_end", "price")


@query(f"""
WITH {STOPS}, j AS (SELECT o_orderkey AS journey, o_orderkey % 100 AS trip_id, o_custkey % 7 + 1 AS board, o_custkey % 7 + 1 + o_orderkey % 5 AS alight FROM orders),
st AS (SELECT l_suppkey AS trip_id, l_linenumber AS seq, min(l_quantity) AS price FROM lineitem WHERE l_quantity < 20 GROUP BY ALL),
ag AS (SELECT p_partkey % 7 + 1 AS board, p_size % 12 AS alight, min(p_retailprice) AS price FROM part WHERE p_size < 30 GROUP BY ALL),
tr AS (SELECT s_suppkey AS trip_id, s_suppkey % 4 + 1 AS lo, s_suppkey % 4 + 3 AS hi, s_acctbal AS price FROM supplier WHERE s_acctbal > 4000),
x AS (SELECT j.*, ag.price AS a, tr.price AS t, (SELECT arg_max(st.price, st.seq) FROM st WHERE st.trip_id = j.trip_id AND st.seq <= j.board) AS s
  FROM j LEFT JOIN ag USING (board, alight) LEFT JOIN tr ON tr.trip_id = j.trip_id AND j.board >= lo AND j.alight <= hi)
SELECT journey, coalesce(a, t, s) AS price, CASE WHEN a IS NOT NULL THEN 'agency' WHEN t IS NOT NULL THEN 'trip' WHEN s IS NOT NULL THEN 'stage' END AS rule FROM x""")
def priority_rule(read):
    """Fare of a journey: an agency's exact pair, else a trip's range, else the last stage at or before boarding."""
    journeys = read("orders").select(F.col("o_orderkey").alias("journey"), (F.col("o_orderkey") % 100).alias("trip_id"), (F.col("o_custkey") % 7 + 1).alias("board_seq"), (F.col("o_custkey") % 7 + 1 + F.col("o_orderkey") % 5).alias("alight_seq"))
    journeys = journeys.withColumns({"board_stop": F.col("board_seq"), "alight_stop": F.col("alight_seq")})
    stages = read("lineitem").where("l_quantity < 20").groupBy(F.col("l_suppkey").alias("trip_id"), F.col("l_linenumber").alias("seq")).agg(F.min("l_quantity").alias("price"))
    agency = read("part").where("p_size < 30").groupBy((F.col("p_partkey") % 7 + 1).alias("board_stop"), (F.col("p_size") % 12).alias("alight_stop")).agg(F.min("p_retailprice").alias("price"))
    trip = read("supplier").where("s_acctbal > 4000").select(F.col("s_suppkey").alias("trip_id"), (F.col("s_suppkey") % 4 + 1).alias("from_seq"), (F.col("s_suppkey") % 4 + 3).alias("to_seq"), F.col("s_acctbal").alias("price"))
    return R.resolve(journeys, stages, trip, agency).select("journey", "price", "rule")


@query("""
WITH r AS (SELECT l_partkey AS trip_id, l_orderkey % 60 AS lo, l_orderkey % 60 + l_suppkey % 40 AS hi, l_extendedprice AS price FROM lineitem),
j AS (SELECT DISTINCT o_custkey AS trip_id, o_orderkey % 64 AS board, o_orderkey % 64 + o_custkey % 12 + 1 AS alight FROM orders),
p AS (SELECT j.trip_id, board, alight, min(price) AS price FROM j JOIN r ON r.trip_id = j.trip_id AND lo <= board AND hi >= alight GROUP BY ALL)
SELECT o_orderkey AS journey, price FROM orders LEFT JOIN p ON p.trip_id = o_custkey AND board = o_orderkey % 64 AND alight = o_orderkey % 64 + o_custkey % 12 + 1""")
def least_range_fares(read):
    """The cheapest of a trip's ranges that hold a journey, for every journey."""
    board = F.col("o_orderkey") % 64
    journeys = read("orders").select(F.col("o_orderkey").alias("journey"), F.col("o_custkey").alias("trip_id"), board.alias("board"), (board + F.col("o_custkey") % 12 + 1).alias("alight"))
    start = F.col("l_orderkey") % 60
    rules = read("lineitem").select(F.col("l_partkey").alias("trip_id"), start.alias("lo"), (start + F.col("l_suppkey") % 40).alias("hi"), F.col("l_extendedprice").alias("price"))
    return R.least_holding(journeys, rules, ["trip_id"], "board", "alight", "lo", "hi", "price").select("journey", "price")


@query("""
WITH s AS (SELECT DISTINCT c_custkey % 97 AS code, c_custkey // 97 AS station FROM customer WHERE c_custkey < 97 * 3),
f AS (SELECT o_custkey % 291 // 97 * 97 + o_custkey % 97 AS src, o_orderkey % 291 AS dst, min(o_totalprice) AS fare FROM orders GROUP BY ALL)
SELECT 'RAIL-' || src || '-' || dst AS special_fare_id, 'RAIL-' || src AS onboarding_stop_id, 'RAIL-' || dst AS offboarding_stop_id, fare AS price
FROM f WHERE src <> dst AND src IN (SELECT c_custkey FROM customer WHERE c_acctbal > 2000) AND dst IN (SELECT c_custkey FROM customer WHERE c_acctbal > 2000)""")
def agency_fare_rules(read):
    """Point-to-point fares between known stations; fares to the same station are left out."""
    src = F.floor(F.col("o_custkey") % 291 / 97) * 97 + F.col("o_custkey") % 97
    fares = read("orders").groupBy(src.cast("bigint").alias("from_id"), (F.col("o_orderkey") % 291).alias("to_id")).agg(F.min("o_totalprice").alias("fare"))
    stations = read("customer").where("c_acctbal > 2000").select(F.col("c_custkey").alias("station_id"), F.concat(F.lit("RAIL-"), F.col("c_custkey").cast("string")).alias("stop_id"))
    return R.agency_rules(fares, stations, "RAIL").select("special_fare_id", "onboarding_stop_id", "offboarding_stop_id", "price")
