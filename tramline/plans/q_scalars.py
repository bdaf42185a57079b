"""Text, keys, times, JSON and HTML, row by row."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.functions import geo
from tramline.functions import svc_time as T
from tramline.functions import text as X
from tramline.operators import spatial
from tramline.plans import alerts, fixed
from tramline.plans.fixed import CN_SEPARATORS
from tramline.plans.registry import Registry, haversine_sql
from tramline.sources import html

REGISTRY = Registry()
query = REGISTRY.query


@query("""
WITH k AS (SELECT o_orderkey, 'R' || o_custkey || '-' || (o_orderkey % 4) || '-' || o_orderstatus || '-' || printf('%04d', o_orderkey % 2400) AS trip_id FROM orders)
SELECT o_orderkey, trip_id, split_part(trip_id, '-', 1) AS route, CASE split_part(trip_id, '-', 2) WHEN '1' THEN 'O' WHEN '2' THEN 'I' ELSE 'UNKNOWN' END AS direction,
  regexp_replace(trip_id, '-\\d{4}$', '') AS pattern, regexp_replace(trip_id, '^[^-]*-', '') AS bare FROM k""")
def key_split_direction(read):
    """Composite keys: their parts, direction, and what is left without a departure or a prefix."""
    key = F.concat_ws("-", F.concat(F.lit("R"), F.col("o_custkey").cast("string")), (F.col("o_orderkey") % 4).cast("string"), "o_orderstatus", F.format_string("%04d", F.col("o_orderkey") % 2400))
    own = read("orders").select("o_orderkey", key.alias("trip_id"))
    c = F.col("trip_id")
    return own.select("o_orderkey", "trip_id", X.part_of(c, 0).alias("route"), X.trip_direction(c).alias("direction"), X.strip_departure(c).alias("pattern"), X.without_prefix(c).alias("bare"))


@query("SELECT event_id, user_id, key, CAST(json_extract_string(props, key) AS BIGINT) AS value FROM (SELECT event_id, user_id, props, unnest(json_keys(props)) AS key FROM events)")
def json_map_explode(read):
    """Nested maps in long form."""
    return read("events").select("event_id", "user_id", F.explode(F.from_json("props", "map<string,bigint>")).alias("key", "value"))


def _spoken(name: str):
    return F.upper(F.concat(F.col(name), F.lit(" OF THE ("), F.col(name), F.lit(" AND MTR) TSZ-WAN II")))


@query(r"""
WITH t AS (SELECT p_partkey, p_name, upper(p_name || ' of the (' || p_name || ' and mtr) tsz-wan ii') AS x FROM part),
w AS (SELECT p_partkey, x, string_split(upper(p_name), ' ') AS w FROM t)
SELECT p_partkey, list_aggregate(list_transform(w, lambda y: y[1] || lower(y[2:])), 'string_agg', ' ') || ' of the (' || list_aggregate(list_transform(w, lambda y: y[1] || lower(y[2:])), 'string_agg', ' ') || ' and MTR) Tsz-Wan II' AS title FROM w""")
def title_case(read):
    """Title case with acronyms, small words, brackets and hyphens."""
    return read("part").select("p_partkey", X.smart_title_case(_spoken("p_name")).alias("title"))


@query(r"""
SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS raw_title, CAST(len(regexp_extract_all(html, '<a href="[^"]*">')) AS BIGINT) AS n_links, CAST(len(regexp_extract_all(html, '<li>')) AS BIGINT) AS n_items FROM pages""")
def html_rows(read):
    """What stands in the elements of a page."""
    return read("pages").select("page_id", html.element_text("html", "title").alias("raw_title"), html.count_tag("html", r'<a href="[^"]*">').alias("n_links"), html.count_tag("html", "<li>").alias("n_items"))


@query(r"""
WITH t AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN (p_size || '.5') WHEN 1 THEN (p_size || '-' || (p_size + 3)) WHEN 2 THEN (p_size || ' / ' || (p_size + 1)) WHEN 3 THEN (p_size || ' (note) #x') ELSE '-' END AS h FROM part)
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_size * 60 + 30 WHEN 1 THEN p_size * 60 + 90 WHEN 2 THEN p_size * 60 + 30 WHEN 3 THEN p_size * 60 END AS headway FROM t JOIN part USING (p_partkey)""")
def headway_text(read):
    """Seconds of headways that are written as numbers, ranges and lists of minutes."""
    s = F.col("p_size").cast("string")
    more = lambda n: (F.col("p_size") + n).cast("string")
    k = F.col("p_partkey") % 5
    text = F.when(k == 0, F.concat(s, F.lit(".5"))).when(k == 1, F.concat_ws("-", s, more(3))).when(k == 2, F.concat_ws(" / ", s, more(1))).when(k == 3, F.concat(s, F.lit(" (note) #x"))).otherwise("-")
    return read("part").select("p_partkey", T.headway_seconds(text).alias("headway"))


@query("""
WITH c AS (SELECT p_partkey, upper(printf('%06x', p_partkey * 7919 % 16777216)) AS color FROM part),
d AS (SELECT *, p_partkey * 7919 % 16777216 AS v FROM c)
SELECT p_partkey, color, CASE WHEN 0.299 * (v // 65536) + 0.587 * (v // 256 % 256) + 0.114 * (v % 256) >= 186 THEN '000000' ELSE 'FFFFFF' END AS text_color FROM d""")
def text_colors(read):
    """Black or white text by the luma of a colour."""
    own = read("part").select("p_partkey", X.hex_color(F.concat(F.lit("#"), F.lower(F.format_string("%06x", F.col("p_partkey") * 7919 % 16777216)))).alias("color"))
    return own.withColumn("text_color", X.text_color(F.col("color")))


@query("""
WITH e AS (SELECT *, CASE user_id % 4 WHEN 0 THEN 'detour' WHEN 1 THEN 'stop_closed' WHEN 2 THEN 'network_notice' ELSE 'accessibility_notice' END AS kind FROM events WHERE event_type = 'error')
SELECT CAST(event_id AS VARCHAR) AS id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS start_epoch, CASE kind WHEN 'detour' THEN 'DETOUR' WHEN 'stop_closed' THEN 'NO_SERVICE' WHEN 'network_notice' THEN 'UNKNOWN_EFFECT' ELSE 'ACCESSIBILITY_ISSUE' END AS effect,
  CASE WHEN user_id % 3 = 0 THEN 1 ELSE 1 + CAST(user_id % 2 = 0 AS INT) END AS n_entities, user_id % 3 = 0 AS network_wide FROM e""")
def alert_entities(read):
    """Alerts with their active period, effect and selectors."""
    kind = F.element_at(F.array(F.lit("detour"), F.lit("stop_closed"), F.lit("network_notice"), F.lit("accessibility_notice")), (F.col("user_id") % 4 + 1).cast("int"))
    ids = lambda wanted, prefix: F.when(wanted, F.array(F.concat(F.lit(prefix), F.col("user_id").cast("string")))).otherwise(F.array().cast("array<string>"))
    own = read("events").where("event_type = 'error'").select(
        F.col("event_id").cast("string").alias("id"), kind.alias("type"), F.create_map(F.lit("en"), F.lit("Notice")).alias("header"), F.create_map(F.lit("en"), F.lit("")).alias("description"), F.lit(None).cast("map<string,string>").alias("url"),
        ids(F.col("user_id") % 3 != 0, "R").alias("route_ids"), ids((F.col("user_id") % 3 != 0) & (F.col("user_id") % 2 == 0), "S").alias("stop_ids"), ids(F.lit(False), "T").alias("trip_ids"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("start"), F.lit(None).cast("string").alias("end"), F.lit(None).cast("string").alias("cause"), F.lit(None).cast("string").alias("effect"), F.lit(None).cast("string").alias("replacement_stop_id"))
    out = alerts.entities(own)
    wide = (F.size("informed_entity") == 1) & F.col("informed_entity")[0]["route_id"].isNull() & F.col("informed_entity")[0]["stop_id"].isNull()
    return out.select("id", F.col("active_period.start").alias("start_epoch"), "effect", F.size("informed_entity").alias("n_entities"), wide.alias("network_wide"))


@query(r"""
WITH n AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN ' a' || s_suppkey % 3 || ' ' END AS ref, CASE s_suppkey % 4 WHEN 1 THEN 'Station exit B' || s_suppkey % 5 ELSE 'None' END AS en, CASE WHEN s_suppkey % 4 = 2 THEN 'c' || s_suppkey % 9 || '出口' ELSE '出口' END AS zh FROM supplier)
SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'A' || s_suppkey % 3 WHEN 1 THEN 'B' || s_suppkey % 5 WHEN 2 THEN 'C' || s_suppkey % 9 END AS exit_code FROM n""")
def exit_code_parse(read):
    """Codes of exits from references and names."""
    k = F.col("s_suppkey") % 4
    text = lambda prefix, m, suffix="": F.concat(F.lit(prefix), (F.col("s_suppkey") % m).cast("string"), F.lit(suffix))
    return read("supplier").select("s_suppkey", X.exit_code(F.when(k == 0, text(" a", 3, " ")), F.when(k == 1, text("Station exit B", 5)).otherwise("None"), F.when(k == 2, text("c", 9, "出口")).otherwise("出口")).alias("exit_code"))


@query("""
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN 'NLB' ELSE c_mktsegment END AS origin, CASE c_custkey % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN 'NLB' ELSE c_mktsegment END AS destination,
  CASE c_custkey % 3 WHEN 0 THEN 0 ELSE 1 END AS direction FROM customer""")
def name_pairs(read):
    """Origin, destination and direction of 'A > B'."""
    k = F.col("c_custkey") % 3
    name = F.when(k == 0, F.concat_ws(" > ", "c_name", "c_mktsegment")).when(k == 1, "NLB").otherwise(F.col("c_mktsegment"))
    pair = X.split_name_pair(name)
    return read("customer").select("c_custkey", pair["origin"].alias("origin"), pair["destination"].alias("destination"), X.direction_of(name, F.col("c_name")).alias("direction"))


@query("""
WITH t AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '25:10:00' WHEN 1 THEN '7:05:09' WHEN 2 THEN '12:00' WHEN 3 THEN 'x:1:2' ELSE printf('%d:%02d:%02d', event_id % 30, event_id % 60, event_id % 59) END AS c FROM events)
SELECT event_id, CASE event_id % 5 WHEN 0 THEN 90600 WHEN 1 THEN 25509 WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE event_id % 30 * 3600 + event_id % 60 * 60 + event_id % 59 END AS seconds FROM t""")
def clock_parse(read):
    """Seconds of service-day times, hours beyond 23 included."""
    e = F.col("event_id")
    text = F.when(e % 5 == 0, "25:10:00").when(e % 5 == 1, "7:05:09").when(e % 5 == 2, "12:00").when(e % 5 == 3, "x:1:2").otherwise(F.format_string("%d:%02d:%02d", e % 30, e % 60, e % 59))
    return read("events").select("event_id", T.to_seconds(text).alias("seconds"))


#: A word for each row: directions, numbers, and names in several spellings.
_WORDS = ["outbound", " I ", "2", "loop", "1.00", "x9", "VIA PEAK", "Peak (VIA)", "Peak Circular", "循環線", "None", " nan ", "GMB-HKI-5", "KMB-1-O", "plain", "甲至乙", "A-B", "Exits A1, B2 and C"]


@query(f"""
WITH w AS (SELECT o_orderkey, ({_WORDS!r})[CAST(o_orderkey % {len(_WORDS)} AS INT) + 1] AS w FROM orders),
x AS (SELECT *, lower(trim(w)) AS l, regexp_matches(w, '(?i)circular') OR regexp_matches(w, '循環|环线|循环') AS c FROM w)
SELECT o_orderkey, CASE WHEN l IN ('outbound', 'o', '1') THEN 'O' WHEN l IN ('inbound', 'i', '2') THEN 'I' ELSE upper(trim(w)) END AS letter, TRY_CAST(trunc(TRY_CAST(w AS DOUBLE)) AS BIGINT) AS number,
  regexp_matches(regexp_replace(upper(w), '\\([^)]*\\)', ' ', 'g'), 'VIA|OMIT|SPECIAL|EXPRESS|SERVICE|CORRECTIONAL') AS variant, c AS circular,
  CASE WHEN c AND NOT contains(lower(w), 'circular') THEN w || ' (Circular)' ELSE w END AS headsign, CASE WHEN l IN ('nan', 'none') THEN '' ELSE w END AS cleaned,
  CASE WHEN w = 'GMB-HKI-5' THEN 'HKI-5' WHEN contains(w, '-') THEN split_part(w, '-', 2) ELSE w END AS short_name, array_to_string(regexp_extract_all(w, '[A-Z][0-9]*'), ',') AS codes,
  CASE WHEN contains(w, '至') THEN '甲' WHEN contains(w, '-') THEN split_part(w, '-', 1) ELSE trim(w) END AS origin,
  'R_' || CASE WHEN w IN ('1', 'O') THEN 'O' WHEN w IN ('2', 'I') THEN 'I' ELSE 'O' END AS route_key, CASE WHEN w = 'outbound' THEN 'inbound' ELSE w END AS swapped FROM x""")
def name_rules(read):
    """Rules for directions, numbers and names, on words in several spellings."""
    w = F.element_at(F.array(*map(F.lit, _WORDS)), (F.col("o_orderkey") % len(_WORDS) + 1).cast("int"))
    own = read("orders").select("o_orderkey", w.alias("w"))
    c = F.col("w")
    return own.select(
        "o_orderkey", X.direction_letter(c).alias("letter"), X.sequence_number(c).alias("number"), X.is_variant_name(c).alias("variant"), X.is_circular(c).alias("circular"), X.with_circular(c, X.is_circular(c)).alias("headsign"),
        X.without_none(c).alias("cleaned"), X.route_short_name(c).alias("short_name"), F.array_join(X.exit_codes(c), ",").alias("codes"), X.split_first(c, CN_SEPARATORS)["origin"].alias("origin"),
        X.route_key(F.lit("R"), c).alias("route_key"), X.swap_bound(c).alias("swapped"),
    )


_KM = haversine_sql("a", "b", "c", "d").replace("6371000", "6371")


@query(f"""
WITH p AS (SELECT c_custkey, 22 + c_custkey % 64 / 64 AS a, 113.5 + c_custkey % 32 / 32 AS b, CASE WHEN c_custkey % 9 > 0 THEN 22 + c_custkey % 61 / 64 END AS c, 113.5 + c_custkey % 29 / 32 AS d FROM customer)
SELECT c_custkey, round({_KM}, 6) AS km, round(sqrt(pow(a - c, 2) + pow(b - d, 2)), 9) AS degrees, round({_KM} * 216, 4) AS seconds, coalesce({_KM}, 'infinity'::DOUBLE) > 20 AS far,
  a BETWEEN 22.15 AND 22.56 AND b BETWEEN 113.83 AND 114.42 AS inside FROM p""")
def distance_rules(read):
    """Kilometres, degrees, seconds over a distance, and whether a point is in a box."""
    own = read("customer").selectExpr("c_custkey", "22 + c_custkey % 64 / 64D AS a", "113.5D + c_custkey % 32 / 32D AS b", "CASE WHEN c_custkey % 9 > 0 THEN 22 + c_custkey % 61 / 64D END AS c", "113.5D + c_custkey % 29 / 32D AS d")
    a, b, c, d = (F.col(x) for x in "abcd")
    km = geo.haversine_km(a, b, c, d)
    return own.select("c_custkey", F.round(km, 6).alias("km"), F.round(geo.planar(a, b, c, d), 9).alias("degrees"), F.round(T.seconds_over(km), 4).alias("seconds"), (geo.far_if_unknown(km) > 20).alias("far"), geo.within_box(a, b, *fixed.BOX).alias("inside"))


@query("""
WITH t AS (SELECT o_orderkey, o_orderkey % 1440 AS a, CASE WHEN o_orderkey % 7 > 0 THEN o_custkey * 13 % 1440 END AS b, 1 + o_orderkey % 30 AS n FROM orders),
x AS (SELECT *, CASE WHEN b < a THEN (b - a) * 60 + 86400 ELSE (b - a) * 60 END AS gap FROM t)
SELECT o_orderkey, gap, CASE WHEN n > 1 AND gap / (n - 1) > 0 AND gap / (n - 1) < 900 THEN gap / (n - 1) ELSE 180 END AS average FROM x""")
def clock_rules(read):
    """Seconds between clock times, over midnight too, and what they make for each stop."""
    clock = lambda m: f"format_string('%02d:%02d', ({m}) div 60, ({m}) % 60)"
    own = read("orders").selectExpr("o_orderkey", f"{clock('o_orderkey % 1440')} AS a", f"CASE WHEN o_orderkey % 7 > 0 THEN {clock('o_custkey * 13 % 1440')} END AS b", "1 + o_orderkey % 30 AS n")
    return own.select("o_orderkey", T.clock_difference(F.col("a"), F.col("b")).alias("gap"), T.per_stop_seconds(F.col("a"), F.col("b"), F.col("n")).alias("average"))


@query("""
WITH t AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN [[1, 2], [3]] WHEN 1 THEN [[c_custkey], [], [4, 5]] ELSE [] END AS parts FROM customer)
SELECT c_custkey, array_to_string(flatten(parts), '-') AS points FROM t""")
def flat_lines(read):
    """All points of the parts of lines, one after another."""
    parts = "CASE c_custkey % 3 WHEN 0 THEN array(array(1L, 2L), array(3L)) WHEN 1 THEN array(array(c_custkey), array(), array(4L, 5L)) ELSE array() END AS coordinates"
    own = read("customer").selectExpr("c_custkey", parts)
    return own.select("c_custkey", F.array_join(F.transform(spatial.lines(own), lambda x: x.cast("string")), "-").alias("points"))
