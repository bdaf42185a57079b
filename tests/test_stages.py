"""Jobs in stages: bounded plans, restarts, what a job left unfinished."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F
from test_feed import network  # noqa: F401  the hand-written network

from tramline.plans import feed, stages
from tramline.sources import schemas

#: Exchanges that a stage or a table of the feed may have in its plan.
MOST = 40


def inputs(spark):
    df = spark.createDataFrame
    edges = df([("S0", "S1", 90.0)], "from_id string, to_id string, seconds double")
    calendar, dates = df([("287", 1, 1, 1, 1, 1, 0, 0, 20240101, 20241231)], schemas.GOV["calendar"]), df([("287", 20240210, 2)], schemas.GOV["calendar_dates"])
    rules, attributes = df([("10-1-1-3", "10")], schemas.GOV["fare_rules"]), df([("10-1-1-3", 4.0, "HKD")], schemas.GOV["fare_attributes"])
    ways = df([("10", "O", "10-O.json", [[114.17, 22.3], [114.17, 22.33]])], "route_id string, bound string, file string, points array<array<double>>")
    return edges, calendar, dates, rules, attributes, ways


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"(?<!Reused)Exchange", plan))


def test_no_plan_repeats_what_is_before_it(spark, network, tmp_path, monkeypatch):  # noqa: F811
    seen = {}
    whole = stages.Stages.__call__
    stage = stages.Stages(spark, str(tmp_path))

    def watched(self, name, make):
        return whole(self, name, lambda: seen.setdefault(name, make()))

    monkeypatch.setattr(stages.Stages, "__call__", watched)
    parts, gov = network
    tables = feed.build(parts, gov, *inputs(spark), stages=stage)
    counts = {name: exchanges(df) for name, df in {**seen, **{f"table {k}": v for k, v in tables.items()}}.items()}
    assert max(counts.values()) <= MOST, counts
    assert set(seen) == set(stage.made) >= {"matches", "own_trips", "times", "trip_fares", "shaped_trips"}

    again = stages.Stages(spark, str(tmp_path))
    more = feed.build(parts, gov, *inputs(spark), stages=again)
    assert again.made == []
    assert sorted(map(tuple, more["trips"].collect()), key=repr) == sorted(map(tuple, tables["trips"].collect()), key=repr)


def test_restart_goes_on_behind_the_last_whole_stage(spark, tmp_path):
    calls = []

    def make(name, n):
        def run():
            calls.append(name)
            return spark.range(n).withColumn("name", F.lit(name))

        return run

    first = stages.Stages(spark, str(tmp_path))
    first("a", make("a", 3))
    with pytest.raises(Exception, match="broken"):
        first("b", lambda: spark.range(5).select(F.raise_error(F.lit("broken")).alias("x")))
    second = stages.Stages(spark, str(tmp_path))
    assert second("a", make("a", 99)).count() == 3
    assert second("b", make("b", 5)).count() == 5
    assert calls == ["a", "b"] and second.made == ["b"]


def test_a_note_without_a_row_is_no_stage(spark, tmp_path):
    stage = stages.Stages(spark, str(tmp_path))
    (tmp_path / "whole" / "a" / "_temporary").mkdir(parents=True)
    assert stage("a", lambda: spark.range(2)).count() == 2


def test_empty_tables(spark, tmp_path):
    stage = stages.Stages(spark, str(tmp_path))
    assert stage("none", lambda: spark.range(0)).count() == 0
    assert stages.Stages(spark, str(tmp_path))("none", lambda: spark.range(9)).count() == 0


def test_stages_broadcast_by_the_size_of_rows_and_not_of_files(spark, tmp_path, monkeypatch):
    """A million equal texts are a small file and many rows; a stage's plan doesn't take the one for the other, and the session keeps its settings."""
    spark.range(1_000_000, numPartitions=1).selectExpr("id", "repeat('x', 1000) AS text").write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many")).where("id % 2 = 0")
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = [spark.conf.get(k, None) for k in keys]
    plan = lambda: (spark.range(3_000_000).join(many, "id"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    with stages.measured_joins(spark):
        assert "BroadcastHashJoin" not in plan()
        assert spark.conf.get(keys[1]) == before[0]
    assert [spark.conf.get(k, None) for k in keys] == before
    seen = []
    monkeypatch.setattr(stages, "measured_joins", lambda s, f=stages.measured_joins: seen.append(s) or f(s))
    stages.Stages(spark, str(tmp_path))("a", lambda: spark.range(2))
    assert seen == [spark] and [spark.conf.get(k, None) for k in keys] == before
