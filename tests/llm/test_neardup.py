"""The join against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tramline.llm import neardup as N


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def sets(text):
    own = words(text)
    n = min(5, len(own))
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()


def expected(rows):
    """(links between different texts, class ids) by comparing all pairs of texts."""
    texts = sorted({t for _, t in rows if t})  # those without words have no shingles, and equal ones are one class
    own = {t: sets(t) for t in texts}
    links, root = {t: 0 for t in texts}, {t: t for t in texts}

    def top(t):
        while root[t] != t:
            t = root[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[i + 1 :]:
            both = len(own[a] & own[b])
            if own[a] and own[b] and both >= 0.8 * (len(own[a]) + len(own[b]) - both):
                links[a] += 1
                links[b] += 1
                root[top(a)] = top(b)
    least = {}
    for i, t in rows:
        if t in links and i is not None:
            least[top(t)] = min(least.get(top(t), i), i)
    return sorted(((i, least[top(t)] if t in links else i, links.get(t, 0)) for i, t in rows), key=repr)


def near_group(size=60):
    rng = random.Random(2)
    base = [f"t{rng.randrange(5000)}" for _ in range(120)]
    out = []
    for i in range(size):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = f"u{rng.randrange(10**6)}"
        out.append((500 + i, " ".join(own)))
    return out


@pytest.mark.parametrize("tile", [256, 8])
def test_join_equals_all_pairs(spark, docs, rows, tile):
    more = near_group()
    every = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id bigint, text string"))
    out = N.near_duplicates(every, tile=tile).collect()
    mine = sorted(((r["id"], r["class_id"], r["n_links"]) for r in out), key=repr)
    assert mine == expected([*rows, *more])


def test_keep_one(spark, docs, rows):
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    out = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted((r for r in out if not r[1]), key=repr) == sorted((r for r in rows if not r[1]), key=repr)
    found = N.near_duplicates(docs).collect()
    groups = {bytes(r["root"]) for r in found if r["root"] is not None}
    assert len([r for r in out if r[1]]) == len(groups)


@pytest.mark.parametrize("kind", ["string", "binary", "decimal(20,0)", "timestamp"])
def test_ids_of_any_type(spark, kind):
    texts = ["one two three four five six seven"] * 3 + ["*** --- ***"] * 4 + ["+ +", "a b c d e f g h i", None, None, "", ""]
    docs = spark.createDataFrame([(1000 + i, t, "x") for i, t in enumerate(texts)], "n int, text string, id string")
    one = "timestamp_seconds(n)" if kind == "timestamp" else "concat('doc-', n)" if kind in ("string", "binary") else "n"
    docs = docs.selectExpr(f"CAST({one} AS {kind}) AS doc_id", "text", "id")
    assert docs.schema["doc_id"].dataType.simpleString() == kind
    out = N.near_duplicates(docs)
    assert out.schema["class_id"].dataType == docs.schema["doc_id"].dataType
    assert out.select("class_id").distinct().count() == 1 + 1 + 2 + 4
    kept = N.keep_one(docs)
    assert kept.schema == docs.schema and sorted((r["text"] or "-" for r in kept.collect())) == sorted(["-"] * 4 + [texts[0], "*** --- ***", "+ +", "a b c d e f g h i"])


def test_links_equal_an_exact_join(spark):
    """All pairs of a whole table that reach the threshold, found through an inverted index of shingles: none is lost."""
    from collections import Counter

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {t: N.shingles(t.encode()).tolist() for t in {r["text"] for r in docs.collect()} if t and sets(t)}
    index, shared = {}, Counter()
    for i, own in enumerate(texts.values()):
        for s in own:
            for j in index.setdefault(s, []):
                shared[j, i] += 1
            index[s].append(i)
    sizes = [len(own) for own in texts.values()]
    exact = Counter()
    for (i, j), both in shared.items():
        if both >= 0.8 * (sizes[i] + sizes[j] - both):
            exact.update((i, j))
    number = {t: i for i, t in enumerate(texts)}
    found = {number[r["text"]]: r["n_links"] for r in N.near_duplicates(docs).drop("key").join(docs, docs["doc_id"] == N.F.col("id")).collect() if r["text"] in number}
    assert sum(exact.values()) > 0 and found == {i: exact[i] for i in range(len(texts))}


def test_verify_both_ways():
    rng = np.random.default_rng(0)
    own = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(30)]
    a, b = (x.ravel() for x in np.meshgrid(range(30), range(30)))
    many = N.verify(own, a, b, 0.4)
    for x, y, got in zip(a, b, many, strict=True):
        s, t = set(own[x].tolist()), set(own[y].tolist())
        assert got == (len(s & t) >= 0.4 * len(s | t) - 1e-9)
        assert got == N.verify(own, np.array([x]), np.array([y]), 0.4)[0]


def test_pruning_keeps_what_reaches_the_threshold():
    keep = N.least_matches(0.8, 1e-6, 128, 16)
    assert list(keep) == list(range(16, 129, 16)) and all(0 < m < 0.8 * n for n, m in keep.items())


def test_components(spark):
    rng = random.Random(6)
    edges = [(f"{rng.randrange(200):03d}", f"{rng.randrange(200):03d}") for _ in range(150)] + [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    out = {r["node"]: r["root"] for r in N.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert out == {x: top(x) for x in root if top(x) != x}


def test_empty(no_docs):
    assert N.near_duplicates(no_docs).count() == 0 and N.keep_one(no_docs).count() == 0
