"""Every registered query of the engine against its SQL; plans without cross joins or Python in hot paths."""

from __future__ import annotations

import pytest
from compare import same_rows

from tramline.plans import catalog


#: HTML, HTML's entities in CSV, map projections by numpy, and Viterbi's pass over one track.
IN_PYTHON = {"matched_tracks", "geocoded_stations", "geocoded_exits", "timetable_pages", "headway_pages", "csv_source", "feed_text", "gov_table"}
#: Queries that add the one row of a median to every row.
ONE_ROW = {"edge_time_fallback", "rail_stop_times"}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, data, name):
    """The same rows, by a plan without products or Python."""
    df = catalog.QUERIES[name](spark, data)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan or name in ONE_ROW
    assert ("Python" not in plan and "Pandas" not in plan) or name in IN_PYTHON
    cursor = duck.execute(catalog.SQL[name])
    columns = [d[0] for d in cursor.description]
    same_rows(df, cursor.fetchall(), columns)


def test_matching_finds_its_pairs_once(spark, data):
    """The best route of Lantao's is found among the pairs at hand, and of stops only the numbers are read."""
    plan = catalog.QUERIES["feed_match"](spark, data)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
    assert len(scans) <= 8
    assert {x.partition("[")[2].partition("]")[0].count(",") for x in scans if "l_orderkey" in x} == {1}
    assert "concat_ws(|" not in plan


def test_entry(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_imports_without_the_corpus_package(tmp_path):
    """With the corpus package and pipeline gone, the entry point still lists the other queries."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/tramline", tmp_path / "tramline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert said.stdout.split() == [str(len(catalog.QUERIES)), str(len(catalog.SQL))], said.stderr
