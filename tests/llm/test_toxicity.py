"""Segments against a quadratic search; held-out accuracy; awkward labels."""

from __future__ import annotations

import random

from tramline.llm import toxicity as T


def brute(scores):
    """All maximal scoring segments by their definition: split at the best one, again and again."""
    best, at = 0.0, None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best + 1e-12 or at and abs(total - best) <= 1e-12 and j - i < at[1] - at[0]:
                best, at = total, (i, j)
    if at is None:
        return []
    left, right = brute(scores[: at[0]]), brute(scores[at[1] + 1 :])
    return [*left, (at[0], at[1], best), *((a + at[1] + 1, b + at[1] + 1, s) for a, b, s in right)]


def test_segments():
    rng = random.Random(4)
    for _ in range(300):
        rest = -rng.choice([0.3, 1.1, 2.3])
        hits = [(i, rng.choice([1.7, 2.9, 0.6]) + rng.random() * 1e-3) for i in range(rng.randint(1, 25)) if rng.random() < 0.4]
        scores = [rest] * 25
        for i, s in hits:
            scores[i] = s
        mine = T.maximal_segments(hits, rest)
        assert [(a, b) for a, b, _ in mine] == [(a, b) for a, b, _ in brute(scores)]
        assert all(abs(x[2] - y[2]) < 1e-9 for x, y in zip(mine, brute(scores), strict=True))


def corpus(n=700):
    rng = random.Random(8)
    plain = [f"w{i}" for i in range(300)]
    out = []
    for i in range(n):
        own = [rng.choice(plain) for _ in range(rng.randint(20, 200))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randint(2, 6)):
                own.insert(rng.randrange(len(own)), rng.choice(["vile", "scummy", "nasty"]))
        out.append((i, " ".join(own), int(toxic)))
    return out


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id bigint, quality int, toxic int")
    out = T.score_toxicity(docs, docs, labels).where(T.held_out()).select("doc_id", "_tl_score").collect()
    truth = {r[0]: r[2] for r in rows}
    assert len(out) > 100
    assert all((r["_tl_score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in out)


def test_copies_count_once(spark):
    """Words of one toxic text that is copied many times don't become toxic."""
    rows = corpus()
    copied = [(2000 + i, "unlucky words stand in this text vile " + " ".join(f"w{k}" for k in range(40)), 1) for i in range(200)]
    docs = spark.createDataFrame([r[:2] for r in rows + copied], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows + copied], "doc_id bigint, quality int, toxic int")
    lexicon = T.fit_lexicon(T.training_rows(docs, labels))
    assert set(lexicon.words) == {b"vile", b"scummy", b"nasty"}


def test_awkward_rows(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, 1, None), (None, 0, 1), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
    for labels in (none, some):
        out = T.score_toxicity(docs, docs, labels)
        assert out.columns == [*docs.columns, "_tl_score"]
        assert out.count() == docs.count() and out.where("_tl_score IS NULL OR _tl_score < 0 OR _tl_score > 1").count() == 0
    assert T.score_toxicity(no_docs, no_docs, none).count() == 0


def plain_score(text, lexicon, fit):
    """Probability and toxic passages of a text, from segments by their definition."""
    import math

    own = T.words(text.encode() if text else None)
    score = lambda w: lexicon.words.get(w) or (lexicon.prefixes.get(w.decode()[: lexicon.length].encode()) if len(w.decode()) > lexicon.length else None) or lexicon.rest
    found = brute([score(w) for w in own])
    if not found:
        return fit.none, []
    each = [lexicon.decay * s - math.log(fit.k * len(own)) for _, _, s in found]
    best = max(each)
    t = best + sum(max(0.0, x) for x in each) - max(0.0, best)
    least = -math.log(-math.log1p(-T.SIGNIFICANT))
    return 1 / (1 + math.exp(-(fit.intercept + fit.slope * t))), [(a, b) for (a, b, _), x in zip(found, each, strict=True) if x >= least]


def test_scores_and_passages_equal_a_plain_version(spark):
    rows = corpus(260)
    rows += [(900, None, 0), (901, "", 0), (902, "vile vile scummy", 1), (903, "vile", 0), (903, "vile scummy nasty " * 4 + "w1 " * 40 + "nasty " * 14, 1)]
    docs = spark.createDataFrame([(*r[:2], "x") for r in rows], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id bigint, quality int, toxic int")
    training = T.training_rows(docs, labels)
    lexicon = T.fit_lexicon(training, T.choose_length(training))
    fit = T.calibrate(training, lexicon)
    out = T.score_toxicity(docs, docs, labels, segment_column="found").collect()
    assert len(out) == len(rows) and any(r["found"] for r in out)
    for r in out:
        score, passages = plain_score(r["text"], lexicon, fit)
        assert abs(r["_tl_score"] - score) < 1e-9 and [(s["first"], s["last"]) for s in r["found"]] == passages


def test_query(spark, data):
    out = T.op4_toxicity(spark, data)
    assert out.columns == ["doc_id", "held_out", "score", "predicted", "passages"]
    found = out.join(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text"), "doc_id").collect()
    for r in found:
        for span in filter(None, r["passages"].split(",")):
            first, last = map(int, span.split(":"))
            assert 0 <= first <= last < len(T.words(r["text"].encode()))


def test_beginnings_are_characters():
    assert [T.beginning(w.encode()) for w in ("abcd", "abcde", "ééé", "éééé", "ééééé")] == [None, b"abcd", None, None, "éééé".encode()]
    assert [T.beginning(w.encode(), n) for w, n in (("abcdefg", 6), ("abcdef", 6), ("abcdef", 0))] == [b"abcdef", None, None]


def test_beginnings_are_chosen_by_the_other_half(spark):
    """Words that are new in each text but begin alike need beginnings; where all words are known, none are taken."""
    rng, rows = random.Random(2), corpus()
    new = [(i, t.replace("vile", f"vile{rng.randrange(10**6)}").replace("nasty", f"nast{rng.randrange(10**6)}").replace("scummy", f"scum{rng.randrange(10**6)}"), y) for i, t, y in rows]
    for given, want in ((rows, 0), (new, 4)):
        docs = spark.createDataFrame([r[:2] for r in given], "doc_id bigint, text string")
        labels = spark.createDataFrame([(r[0], r[2]) for r in given], "doc_id bigint, toxic int")
        assert T.choose_length(T.training_rows(docs, labels)) == want


def test_no_word_is_dropped(spark):
    import pytest

    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    with pytest.raises(ValueError, match="more than 2 words"):
        T.fit_lexicon(T.training_rows(docs, labels), most=2)


def test_the_scan_is_linear():
    """Sparse hits, dense hits, falling and rising sums: ten times the hits take about ten times as long."""
    import time

    rng = random.Random(1)
    for gap, rest, score in ((100, -0.05, lambda i: 1.0), (1, -0.05, lambda i: 1.0), (3, -0.5, lambda i: rng.random() * 2), (2, -1.0, lambda i: 1.5 - i * 1e-6), (2, -1.0, lambda i: 0.5 + i * 1e-6)):
        took = []
        for n in (100_000, 1_000_000):
            hits = [(i * gap, score(i)) for i in range(n)]
            began = time.perf_counter()
            T.maximal_segments(hits, rest)
            took.append(time.perf_counter() - began)
        assert took[1] < 40 * took[0] + 0.5 and took[1] < 20, took
