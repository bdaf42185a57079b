"""Counts against plain Python, cutoffs against the exact binomial, the query against SQL."""

from __future__ import annotations

import math
import re

import pytest
from compare import same_rows
from pyspark.sql import functions as F

from tramline.llm import quality as Q


def counts(text):
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    windows = {}
    for s in range(len(own) - 7):
        windows.setdefault(tuple(own[s : s + 8]), []).append(s)
    repeated = {p for at in windows.values() if len(at) > 1 for s in at for p in range(s, s + 8)}
    return (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))


def test_counts(spark, docs, rows):
    extra = [(900, "a b c d e f g h " * 5), (901, "x\n\nx\n \ny\nx"), (902, "### $$$ | <a>\t\x0b\x0c\r\n!!"), (903, " \x0b"), (904, "  nbsp is a character"), (905, "f\nf\n\x0c\n\x0c\n f \n\x0b\x0c\x0b")]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id bigint, text string"))
    out = Q.count_features(df).collect()
    mine = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in out), key=repr)
    assert mine == sorted(((i, *counts(t)) for i, t in [*rows, *extra]), key=repr)


@pytest.mark.parametrize(("n", "k", "p"), [(10, 0, 0.1), (50, 3, 0.01), (2000, 5, 0.01), (30000, 250, 0.01)])
def test_binomial_tail(spark, n, k, p):
    exact = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log(1 - p)) for j in range(k + 1))
    got = spark.range(1).select(Q.binomial_tail(F.lit(n).cast("bigint"), F.lit(k).cast("bigint"), p).alias("x")).first()["x"]
    assert abs(got - exact) < 1e-9 + 1e-9 * exact


def test_cutoffs_hold_the_risk(spark):
    """A rule that parts good from poor gets a cutoff; one whose good rows are too few, or fail too often, gets none."""
    base = {"n_words": 100, "word_chars": 1000, "n_symbols": 0, "n_dup_lines": 0, "n_repeat_words": 0, "n_lines": 10, "n_shouts": 0, "n_capitals": 0, "base_failed": False}
    rows = [{**base, "stratum": "en", "quality": 1} for _ in range(900)] + [{**base, "stratum": "en", "quality": 0, "n_symbols": 300} for _ in range(100)]
    rows += [{**base, "stratum": "de", "quality": 1} for _ in range(100)] + [{**base, "stratum": "de", "quality": 0, "n_symbols": 300} for _ in range(50)]
    rows += [{**base, "stratum": "fr", "quality": int(i % 20 != 0), "n_shouts": 50} for i in range(1000)]
    out = {(r["stratum"], r["rule"]): r["cutoff"] for r in Q.choose_cutoffs(spark.createDataFrame(rows), 3).collect()}
    assert set(out) == {("en", "symbols")} and 5 <= out["en", "symbols"] < 300


def test_query(spark, duck, data):
    cursor = duck.execute(Q.ORACLE_SQL)
    columns = [d[0] for d in cursor.description]
    same_rows(Q.op3_quality(spark, data), cursor.fetchall(), columns)


def test_empty_and_unlabelled(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert Q.judge(no_docs, none).count() == 0
    out = Q.judge(docs, none)
    assert out.count() == docs.count() and out.where("kept = base_failed").count() == 0


def test_a_trial_is_a_distinct_text(spark):
    """Copies don't make a stratum testable, and every language has its own bound."""
    rows = [(i, f"text {i} " + "word other more and so on it goes from here to the end of a line that is long enough " * 1, f"l{i % 20}", 1) for i in range(20 * 50)]
    rows += [(5000 + i, "the same good text over and over again with words that pass the base of twenty words in a row so it counts", "copied", 1) for i in range(900)]
    rows += [(9000, "a poor copy", "copied", 0)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3], 0) for r in rows], "doc_id bigint, quality int, toxic int")
    tried = Q.trials(Q.count_features(docs).join(labels, "doc_id").drop("toxic"))
    assert tried.where("stratum = 'copied'").count() == 1 and tried.count() == 1001
    assert Q.testable(tried) == 0 and Q.testable(tried, risk=0.9) == 20 + (math.log(1 - 0.9 / 5) <= math.log(0.05 / 5 / 21))
