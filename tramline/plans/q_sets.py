"""Duplicates, unions, calendars, pivots and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.operators import calendars as C
from tramline.operators import selection as S
from tramline.plans.registry import Registry

REGISTRY = Registry()
query = REGISTRY.query


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def dedupe_keep_first(read):
    """The first row of a key, by an explicit order."""
    return S.keep_first(read("events"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id", "value")


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def dedupe_keep_last(read):
    """The last row of a key wins."""
    return S.keep_last(read("events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("SELECT p_size, string_agg(p_brand, ' - ' ORDER BY p_brand) AS brands, count(*) AS n FROM (SELECT DISTINCT p_size, p_brand FROM part) GROUP BY p_size")
def distinct_name_join(read):
    """Distinct values of a group in order, joined."""
    return read("part").groupBy("p_size").agg(F.array_sort(F.collect_set("p_brand")).alias("b")).select("p_size", F.array_join("b", " - ").alias("brands"), F.size("b").alias("n"))


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END) = 0")
def having_conditional_distinct(read):
    """Groups in which no row has a property."""
    out = read("orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_distinct(F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))).alias("p"))
    return out.where("p = 0").select("o_custkey", "n")


@query("""SELECT l_suppkey, count(*) AS n, count(DISTINCT l_partkey) AS parts, round(avg(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 6) AS avg_out, round(avg(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 6) AS avg_in,
  bool_or(l_linestatus = 'O') AND bool_or(l_linestatus = 'F') AS both_directions FROM lineitem GROUP BY l_suppkey""")
def conditional_averages(read):
    """Counts, distinct counts, averages by direction, and whether both directions exist."""
    flag = lambda f: F.round(F.avg(F.when(F.col("l_returnflag") == f, F.col("l_quantity"))), 6)
    return read("lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count_distinct("l_partkey").alias("parts"), flag("A").alias("avg_out"), flag("R").alias("avg_in"), (F.bool_or(F.col("l_linestatus") == "O") & F.bool_or(F.col("l_linestatus") == "F")).alias("both_directions"))


@query("""
SELECT 'KMB-' || c_custkey AS stop_id, c_name AS stop_name, CAST(NULL AS VARCHAR) AS parent_station, c_acctbal AS balance FROM customer
UNION ALL SELECT 'MTR-' || s_suppkey, s_name, 'MTR-' || s_nationkey, NULL FROM supplier
UNION ALL SELECT 'LR' || n_nationkey, n_name, NULL, NULL FROM nation""")
def union_hetero(read):
    """Frames with different columns as one; what a frame lacks is null."""
    ident = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    a = read("customer").select(ident("KMB-", "c_custkey").alias("stop_id"), F.col("c_name").alias("stop_name"), F.col("c_acctbal").alias("balance"))
    b = read("supplier").select(ident("MTR-", "s_suppkey").alias("stop_id"), F.col("s_name").alias("stop_name"), ident("MTR-", "s_nationkey").alias("parent_station"))
    c = read("nation").select(ident("LR", "n_nationkey").alias("stop_id"), F.col("n_name").alias("stop_name"))
    return S.union_all(a, b, c).select("stop_id", "stop_name", "parent_station", "balance")


@query("""
SELECT 'difference' AS kind, k FROM (SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
UNION ALL SELECT 'union', k FROM (SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
UNION ALL SELECT 'intersection', k FROM (SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""")
def set_operations(read):
    """Difference, union and intersection of ids."""
    a = read("customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k"))
    b = read("supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("k"))
    kinds = {"difference": a.subtract(b), "union": a.union(b).distinct(), "intersection": a.intersect(b)}
    return S.union_all(*(df.select(F.lit(kind).alias("kind"), "k") for kind, df in kinds.items()))


@query("""
WITH s AS (SELECT DISTINCT 'S' || c_custkey AS service_id, CASE WHEN c_custkey % 5 = 0 THEN 'NEVER' WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey AS VARCHAR) ELSE 'X' END AS o FROM customer),
k AS (SELECT CAST(n_nationkey AS VARCHAR) AS o, n_nationkey % 2 AS m, 1 - n_nationkey % 2 AS sat, 20240101 + n_nationkey AS a FROM nation)
SELECT service_id, CASE WHEN s.o = 'NEVER' THEN 0 ELSE coalesce(m, 1) END AS monday, CASE WHEN s.o = 'NEVER' THEN 0 ELSE coalesce(sat, 1) END AS saturday,
  CASE WHEN s.o = 'NEVER' THEN 19700101 ELSE coalesce(a, 20230101) END AS start_date, CASE WHEN s.o = 'NEVER' THEN 19700101 ELSE coalesce(a + 10000, 20991231) END AS end_date FROM s LEFT JOIN k USING (o)""")
def default_calendar(read):
    """Calendars of services: the public one, else every day, and never for placeholders."""
    original = F.when(F.col("c_custkey") % 5 == 0, "NEVER").when(F.col("c_custkey") % 3 == 0, F.col("c_nationkey").cast("string")).otherwise("X")
    services = read("customer").select(F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("service_id"), original.alias("original_service_id"))
    odd = F.col("n_nationkey") % 2
    known = read("nation").select(F.col("n_nationkey").cast("string").alias("service_id"), *(odd.alias(d) if d != "saturday" else (1 - odd).alias(d) for d in C.DAYS), (20240101 + F.col("n_nationkey")).alias("start_date"), (20250101 + F.col("n_nationkey")).alias("end_date"))
    return C.calendar(services, known).select("service_id", "monday", "saturday", "start_date", "end_date")


@query("""
WITH s AS (SELECT DISTINCT 'S' || c_custkey % 40 AS service_id, CAST(c_nationkey AS VARCHAR) AS o FROM customer), k AS (SELECT CAST(s_nationkey AS VARCHAR) AS o, 20240000 + s_suppkey % 12 AS date, 1 + s_suppkey % 2 AS exception_type FROM supplier)
SELECT service_id, date, min(exception_type) AS exception_type FROM s JOIN k USING (o) GROUP BY ALL""")
def calendar_exceptions(read):
    """Exceptions of known services, one for each date."""
    services = read("customer").select(F.concat(F.lit("S"), (F.col("c_custkey") % 40).cast("string")).alias("service_id"), F.col("c_nationkey").cast("string").alias("original_service_id"))
    known = read("supplier").select(F.col("s_nationkey").cast("string").alias("service_id"), (20240000 + F.col("s_suppkey") % 12).alias("date"), (1 + F.col("s_suppkey") % 2).alias("exception_type"))
    return C.calendar_dates(services, known)


@query("""
SELECT 'stops.txt' AS table_name, 'stop_name' AS field_name, language, CAST(n_nationkey AS VARCHAR) AS record_id, translation
FROM (SELECT n_nationkey, n_name AS en, CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) END AS "zh-Hant", '' AS fr FROM nation) UNPIVOT (translation FOR language IN (en, "zh-Hant", fr)) WHERE trim(translation) <> ''
UNION ALL
SELECT 'routes.txt', 'route_long_name', language, CAST(r_regionkey AS VARCHAR), translation FROM (SELECT r_regionkey, r_name AS en, reverse(r_name) AS "zh-Hant" FROM region) UNPIVOT (translation FOR language IN (en, "zh-Hant"))""")
def translations_unpivot(read):
    """Names by language in long form."""
    n, r = read("nation"), read("region")
    return S.union_all(C.translations(n, "stops.txt", "stop_name", "n_nationkey", en="n_name", zh_Hant=F.when(F.col("n_nationkey") % 2 == 0, F.lower("n_name")), fr=F.lit("")), C.translations(r, "routes.txt", "route_long_name", "r_regionkey", en="r_name", zh_Hant=F.reverse("r_name")))


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, count(value) AS present, sum(CAST(value IS NULL AS BIGINT)) AS missing FROM events GROUP BY event_type")
def diagnostics(read):
    """Counts by value, of distinct values and of missing ones."""
    return read("events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.count("value").alias("present"), F.count_if(F.col("value").isNull()).alias("missing"))


@query("""SELECT name, special, key FROM (SELECT p_name AS name, p_size % 2 AS special, p_partkey AS key, row_number() OVER (PARTITION BY p_name ORDER BY CAST(p_size % 2 = 0 AS INT) DESC, p_partkey) AS r FROM part) WHERE r = 1""")
def standard_first_fallback(read):
    """The standard variant of a name if it has one, else its first."""
    own = read("part").select(F.col("p_name").alias("name"), (F.col("p_size") % 2).alias("special"), F.col("p_partkey").alias("key"))
    return S.keep_first(own, "name", [F.desc(F.col("special") == 0), F.col("key")])
