"""The index search against a plain scan."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from compare import same_rows

from tramline.llm import decontamination as D
from tramline.llm import registry


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def scan(text, items, n=10):
    own = words(text)
    hit, found = set(), set()
    for item, body in items:
        theirs = words(body)
        if not theirs or item is None:
            continue
        k = min(n, len(theirs))
        windows = {tuple(theirs[s : s + k]) for s in range(len(theirs) - k + 1)}
        for s in range(len(own) - k + 1):
            if tuple(own[s : s + k]) in windows:
                hit.update(range(s, s + k))
                found.add(item)
    return len(own), len(hit), sorted(map(str, found))


@pytest.fixture(scope="module")
def items(rows):
    rng = random.Random(1)
    out = [(i, " ".join((rows[i][1] or "").split(" ")[2:22])) for i in range(0, 50, 7)]
    out += [(100, "word"), (101, None), (102, "..."), (None, rows[4][1]), (100, "word"), (103, rows[20][1].upper()), (104, "x x x"), (105, "not there at all")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("block", "batch"), [(1 << 19, 1 << 18), (300, 40)])
def test_search_equals_a_scan(spark, docs, rows, items, block, batch):
    found = D.decontaminate(docs, spark.createDataFrame(items, "item_id bigint, text string"), block_words=block, batch_words=batch)
    mine = sorted((r["id"], r["n_words"], sum(e - s for s, e in zip(r["starts"], r["ends"], strict=True)), tuple(sorted(map(str, r["items"])))) for r in found.collect() if r["id"] is not None)
    brute = sorted((i, *scan(t, items)[:2], tuple(scan(t, items)[2])) for i, t in rows if i is not None)
    assert mine == brute


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "one two extra three four"), (2, "one two three four"), (3, "four three two one x y z")], "doc_id bigint, text string")
    items = spark.createDataFrame([(9, "one two three four")], "item_id bigint, text string")
    out = {r["id"]: (len(r["items"]), len(r["near_items"])) for r in D.decontaminate(docs, items, slop=1).collect()}
    assert out == {1: (0, 1), 2: (1, 1), 3: (0, 0)}


def near_scan(text, items, n, slop):
    own, found = words(text), set()
    at = {}
    for i, w in enumerate(own):
        at.setdefault(w, set()).add(i)
    for item, body in items:
        theirs = words(body)
        if not theirs or item is None:
            continue
        k = min(n, len(theirs))
        for s in range(len(theirs) - k + 1):
            window = theirs[s : s + k]
            if all(w in at for w in window) and any(all(any(p + j + d in at[w] for d in range(-slop, slop + 1)) for j, w in enumerate(window)) for p in range(-slop, len(own) + slop)):
                found.add(item)
    return found


@pytest.mark.parametrize(("block", "slop"), [(1 << 19, 2), (40, 1), (40, 7), (300, 0)])
def test_proximity_equals_a_scan(spark, block, slop):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 30))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    items = [(i, " ".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 9)))) for i in range(40)]
    out = D.decontaminate(docs, spark.createDataFrame(items, "item_id bigint, text string"), n=6, slop=slop, block_words=block).collect()
    assert len(out) == len(texts)
    for r in out:
        assert set(r["near_items"]) == near_scan(texts[r["id"]], items, 6, slop)
        assert set(map(str, r["items"])) == set(scan(texts[r["id"]], items, 6)[2])


def test_empty_tables(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert D.decontaminate(no_docs, none).count() == 0
    assert D.decontaminate(docs, none).where("size(starts) > 0").count() == 0
    assert D.contaminated_keys(no_docs, none).count() == 0


def test_query(spark, duck, data):
    cursor = duck.execute(D.ORACLE_SQL)
    columns = [d[0] for d in cursor.description]
    out = registry.QUERIES["op1_decontamination"](spark, data)
    same_rows(out, cursor.fetchall(), columns)
    assert out.where("n_hit = 0").first()["items_sha256"] == hashlib.sha256(b"").hexdigest()
