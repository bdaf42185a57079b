"""The trees against dictionaries, a proper distribution, scores from blocks against the whole, and the base in SQL."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from compare import cell

from tramline.llm import scoring as S

BASE_SQL = r"""
WITH d AS (SELECT doc_id, crc32_mod AS held, list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), chr(10)) AS w FROM t),
x AS (SELECT doc_id, held, unnest(w) AS w FROM d), c AS (SELECT w, count(*) AS c FROM x WHERE NOT held GROUP BY w), n AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM c)
SELECT doc_id, held AS held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n) AS train_tokens, sum(log10((coalesce(c, 0) + 1) / (n + v + 1))) AS base_score FROM x LEFT JOIN c USING (w), n GROUP BY doc_id, held"""


def test_probabilities_equal_dictionaries():
    depth, rng = 3, np.random.default_rng(0)
    texts = [bytes(rng.choice(list(b"abc "), size=rng.integers(0, 60))) for _ in range(60)]
    codes = [S.grams(list(S.pieces(t, depth)), depth) for t in texts]
    known, n = np.unique(np.concatenate(codes[:40]), return_counts=True)
    tree = S.levels(known, n.astype(float), 0, depth)
    every = np.unique(np.concatenate(codes))
    counts: dict = {}
    for t in texts[:40]:
        line = [255] * depth + list(t) + [255]
        for i in range(depth, len(line)):
            for d in range(depth + 1):
                for j in range(8):
                    key = (tuple(line[i - 1 - k] for k in range(d)), (1 << j) | (line[i] >> (8 - j)))
                    counts.setdefault(key, [0, 0])[(line[i] >> (7 - j)) & 1] += 1
    children: dict = {}
    for context, decision in counts:
        if context:
            children.setdefault((context[:-1], decision), []).append((context, decision))

    def estimate(key):
        a, b = counts[key]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @lru_cache(None)
    def weighted(key):
        if len(key[0]) == depth:
            return estimate(key)
        return float(np.logaddexp(estimate(key), sum(map(weighted, children[key])))) - math.log(2)

    def log2(context, symbol):
        total = 0.0
        for j in range(8):
            decision, bit = (1 << j) | (symbol >> (8 - j)), (symbol >> (7 - j)) & 1
            mixed, rest, last = 0.0, 1.0, 0.5
            for d in range(depth + 1):
                key = (context[:d], decision)
                if key not in counts:
                    break
                last = (counts[key][bit] + 0.5) / (sum(counts[key]) + 1)
                stop = 1.0 if d == depth else min(1.0, math.exp(estimate(key) - math.log(2) - weighted(key)))
                mixed, rest = mixed + rest * stop * last, rest * (1 - stop)
            total += math.log2(mixed + rest * last)
        return total

    for code, value in zip(every.tolist(), S.log2_probability(every, tree, depth), strict=True):
        context = tuple((code >> (8 * (depth - k))) & 255 for k in range(depth))
        assert abs(log2(context, code & 255) - value) < 1e-9
    context = int(every[3]) >> 8
    assert abs(sum(2 ** S.log2_probability(np.array([(context << 8) | b for b in range(256)]), tree, depth)) - 1) < 1e-9


def test_pieces_cover_a_text(monkeypatch):
    whole = np.sort(S.grams(list(S.pieces(b"abcdefghij" * 9))))
    monkeypatch.setattr(S, "SEGMENT", 7)
    parts = list(S.pieces(b"abcdefghij" * 9))
    assert len(parts) > 5 and (np.sort(S.grams(parts)) == whole).all()


def test_lookup():
    codes = np.unique(np.random.default_rng(1).integers(-(2**62), 2**62, 50_000))
    table = S.Lookup(len(codes), np.float32).fill(codes, np.arange(len(codes), dtype=np.float32))
    value, found = table(codes)
    assert found.all() and (value == np.arange(len(codes))).all()
    assert not table(codes + 1)[1][~np.isin(codes + 1, codes)].any()


def test_log_gamma():
    x = np.array([0.5, 1.0, 2.5, 7.9, 8.0, 100.0, 1e7])
    assert np.allclose(S.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-9)


def whole_scores(texts, held, depth):
    """Scores from one tree of all texts, without blocks or parts."""
    codes = [S.grams(list(S.pieces(t, depth)), depth) for t in texts]
    every = np.unique(np.concatenate(codes))
    known, n = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *(c for c, h in zip(codes, held, strict=True) if not h)]), return_counts=True)
    value = S.log2_probability(every, S.levels(known, n.astype(float), 0, depth), depth)
    return [float(value[np.searchsorted(every, c)].sum()) * math.log10(2) for c in codes]


def test_blocks_and_the_base(spark, docs, rows):
    import duckdb
    import pandas as pd
    import zlib

    plain = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", "text", "key", "length").cache()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in plain.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    expected = dict(zip(texts, whole_scores(list(texts.values()), held.values(), S.DEPTH), strict=True))
    one = {r["doc_id"]: r for r in S.score(plain).collect()}
    two = {r["doc_id"]: r for r in S.score(plain, parts=7, block_bytes=3000, together=2).collect()}
    assert one.keys() == two.keys() == texts.keys()
    for i, r in one.items():
        assert all(x == y or abs(x - y) < 1e-9 * max(1, abs(x)) for x, y in zip(r, two[i], strict=True))
        assert abs(r["score"] - expected[i]) < 1e-5 * max(1, abs(expected[i])) and r["score"] < 0
    table = pd.DataFrame([(i, t.decode(), held[i]) for i, t in texts.items()], columns=["doc_id", "text", "crc32_mod"])
    con = duckdb.connect()
    con.register("t", table)
    for doc_id, held_out, n_tokens, n_known, train, base in con.execute(BASE_SQL).fetchall():
        r = one[doc_id]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held_out, n_tokens, n_known, cell(int(train)))
        assert abs(r["base_score"] - base) < 1e-9 * max(1, abs(base))


def test_a_text_beyond_a_segment(spark):
    """Scored whole, from counts in dictionaries."""
    from collections import Counter

    depth, long = 3, b"ab cd abc " * 60_000 + b"dcba" * 20_000
    texts = [long, b"ab cd", b"zzz", b""]
    assert len(long) > S.SEGMENT
    lines = [b"\xff" * depth + t + b"\xff" for t in texts]
    pairs = [Counter(zip(*(x[k:] for k in range(depth + 1)))) for x in lines]  # noqa: B905
    counts: dict = {}
    for own in pairs:
        for pair, n in own.items():
            context, symbol = pair[:-1][::-1], pair[-1]
            for d in range(depth + 1):
                for j in range(8):
                    counts.setdefault((context[:d], (1 << j) | (symbol >> (8 - j))), [0, 0])[(symbol >> (7 - j)) & 1] += n
    children: dict = {}
    for context, decision in counts:
        if context:
            children.setdefault((context[:-1], decision), []).append((context, decision))
    estimate = lambda c: math.lgamma(c[0] + 0.5) + math.lgamma(c[1] + 0.5) - math.lgamma(sum(c) + 1) - math.log(math.pi)

    @lru_cache(None)
    def weighted(key):
        own = estimate(counts[key])
        return own if len(key[0]) == depth else float(np.logaddexp(own, sum(map(weighted, children[key])))) - math.log(2)

    def log2(pair):
        context, symbol, total = pair[:-1][::-1], pair[-1], 0.0
        for j in range(8):
            mixed, rest, last = 0.0, 1.0, 0.5
            for d in range(depth + 1):
                key = (context[:d], (1 << j) | (symbol >> (8 - j)))
                if key not in counts:
                    break
                last = (counts[key][(symbol >> (7 - j)) & 1] + 0.5) / (sum(counts[key]) + 1)
                stop = 1.0 if d == depth else min(1.0, math.exp(estimate(counts[key]) - math.log(2) - weighted(key)))
                mixed, rest = mixed + rest * stop * last, rest * (1 - stop)
            total += math.log2(mixed + rest * last)
        return total

    docs = spark.createDataFrame([(f"d{i}", t.decode()) for i, t in enumerate(texts)], "doc_id string, text string")
    from pyspark.sql import functions as F

    out = {r["doc_id"]: r["score"] for r in S.score(docs, F.lit(False), depth).collect()}
    for i, own in enumerate(pairs):
        expected = sum(n * log2(pair) for pair, n in own.items()) * math.log10(2)
        assert abs(out[f"d{i}"] - expected) < 1e-5 * max(1, abs(expected))


def test_awkward(spark, docs, no_docs, rows):
    assert S.score(docs).count() == len(rows)
    assert S.score(no_docs).count() == 0
    only_held = docs.where(S.held_out())
    out = S.score(only_held).collect()
    assert len(out) == only_held.count() and all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in out)


def test_parts_equal_the_whole(spark):
    """Probabilities from parts of the trees are those of one tree."""
    rng = np.random.default_rng(5)
    codes = np.unique(np.concatenate([S.grams(list(S.pieces(bytes(rng.choice(list(b"abcd e"), size=200))))) for _ in range(20)]))
    n = rng.integers(0, 4, len(codes))
    part = S.part_of(S.GRAM, codes, 5)
    counted = [(p, bytearray(S.squeeze_codes(codes[part == p])), bytearray(S.squeeze(n[part == p]))) for p in np.unique(part).tolist()]
    out = S.gram_values(spark.createDataFrame(counted, "part int, codes binary, n binary")).collect()
    found = np.concatenate([S.unsqueeze_codes(bytes(r["codes"])) for r in out])
    value = np.concatenate([S.unsqueeze(bytes(r["data"]), np.float32) for r in out])
    order = np.argsort(found)
    whole = S.log2_probability(codes, S.levels(codes[n > 0], n[n > 0].astype(float), 0, S.DEPTH), S.DEPTH)
    assert found[order].tolist() == codes.tolist()
    assert np.allclose(value[order], whole, rtol=1e-5, atol=1e-5)


def test_runs_of_a_part_equal_the_whole(monkeypatch):
    rng = np.random.default_rng(6)
    codes = np.unique(S.grams([b"\xff" * 5 + rng.choice(list(b"abcde "), size=9000).astype(np.uint8).tobytes()]))
    n = rng.integers(0, 4, len(codes))
    one, _ = S.near_level(codes, n, S.DEPTH)
    monkeypatch.setattr(S, "BLOCK", 400)
    assert len(S.runs_of(codes, S.DEPTH)) > 5
    two, below = S.near_level(codes, n, S.DEPTH)
    assert below is None and (one.key == two.key).all() and np.allclose(one.weighted, two.weighted) and np.allclose(one.stop, two.stop)


def test_squeezing():
    for numbers in (np.zeros(0, dtype=np.int64), np.sort(np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 999)), np.array([5])):
        assert (S.unsqueeze_codes(S.squeeze_codes(numbers)) == numbers).all() and (S.unsqueeze(S.squeeze(numbers), np.int64) == numbers).all()
