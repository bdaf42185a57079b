"""Near-duplicate groups against all pairs, and the signature against its definition."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from compare import same_rows

from tramline.llm import superminhash as op


def sets_of(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({k: 32 for k in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def plain(given):
    """(id, n, component) of each row by all pairs."""
    own = [sets_of(t) for _, t in given]
    root = list(range(len(given)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(given)), 2):
        both = len(own[a] & own[b])
        if both and 100 * both >= 85 * (len(own[a]) + len(own[b]) - both):
            root[max(top(a), top(b))] = min(top(a), top(b))
    out = []
    for k, (i, _) in enumerate(given):
        ids = [given[j][0] for j in range(len(given)) if top(j) == top(k) and given[j][0] is not None]
        out.append((i, len(own[k]), min(ids) if ids else None))
    return out


def found(docs, **more):
    return sorted(((r.id, r.n, r.component_id) for r in op.near_duplicate_groups(docs, **more).collect()), key=repr)


def variants(rng, n, words, edits):
    """A text, and copies with some words changed: each close to the text, not all to one another."""
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = [" ".join(base)]
    for k in range(n):
        own = list(base)
        for at in rng.sample(range(words), rng.randint(0, edits)):
            own[at] = f"edit{k}x{at}"
        out.append(" ".join(own))
    return out


def one_by_one(own, values):
    """The signature's definition, an element at a time."""
    least = [(2**32, 0)] * values
    for element in own.tolist():
        slots = list(range(values))
        for rank in range(values):
            drawn = int(op._mixed(np.array([element], dtype=np.uint64) + np.uint64(op._STEP * (rank + 1) % 2**64))[0])
            place = rank + ((drawn & 0xFFFFFFFF) * (values - rank) >> 32)
            slots[rank], slots[place] = slots[place], slots[rank]
            least[slots[rank]] = min(least[slots[rank]], (rank, drawn >> 32))
    return [rank << 32 | part for rank, part in least]


@pytest.mark.parametrize("n", [1, 2, 5, 40, 300])
def test_signature_by_its_definition(n, monkeypatch):
    own = np.unique(np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64))
    for block in (7, 4096):
        monkeypatch.setattr(op, "BLOCK", block)
        assert op.ranked_values(own, 16).tolist() == one_by_one(own, 16)
        assert op.ranked_values(own[::-1], 16).tolist() == one_by_one(own, 16)


def test_less_scattered_than_independent_values():
    """Sets as small as the signature: the mean square error is below that of 128 independent values."""
    rng, errors, similarity = np.random.default_rng(5), [], 1 / 3
    for _ in range(300):
        a, b, c = (rng.integers(0, 2**63, 40, dtype=np.uint64) for _ in range(3))
        one, two = (np.frombuffer(op.signature(np.concatenate(x)), "<u2") for x in ((a, b), (b, c)))
        errors.append((one == two).mean() - similarity)
    assert abs(np.mean(errors)) < 0.01
    assert np.mean(np.square(errors)) < 0.75 * similarity * (1 - similarity) / op.VALUES


def test_matches_that_are_asked_for():
    from math import comb

    m = op.least_matches(85)
    assert 60 < m < 90
    assert sum(comb(128, k) * 0.85**k * 0.15 ** (128 - k) for k in range(m)) <= op.MISS


def test_all_pairs(spark):
    rng = random.Random(0)
    texts = [t for words in (6, 30, 60, 200, 400) for edits in (1, 2, 5) for t in variants(rng, 12, words, edits)]
    rng.shuffle(texts)
    given = list(enumerate(texts))
    docs = spark.createDataFrame(given, "doc_id bigint, text string").repartition(3)
    want = sorted(plain(given), key=repr)
    assert found(docs, tile=3) == want
    assert len({c for _, _, c in want}) > 15


def test_pairs_that_only_the_second_pass_joins(spark):
    """A pivot that is far from most: copies of a text at 0.9, at 0.81 of one another."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(400)]
    texts = [" ".join(base)]
    for k in range(60):
        own = list(base)
        for at in rng.sample(range(0, 400, 6), 4):
            own[at] = f"x{k}y{at}"
        texts.append(" ".join(own))
    given = [(i, t) for i, t in enumerate(texts[1:] + texts[:1])]
    want = sorted(plain(given), key=repr)
    assert {c for _, _, c in want} == {0}
    assert found(spark.createDataFrame(given, "doc_id bigint, text string"), tile=8) == want


def test_awkward_rows(docs, rows):
    assert found(docs) == sorted(plain(rows), key=repr)


def test_ids_of_text_and_no_rows(spark, no_docs):
    given = [("b", "one two three four five six"), ("a", "One  two\tthree four five six"), (None, "one two three four five six"), (None, None), ("c", "é"), (None, "q")]
    assert found(spark.createDataFrame(given, "doc_id string, text string")) == sorted(plain(given), key=repr)
    assert found(no_docs) == []


def test_query(spark, data, duck):
    answer = duck.execute(op.ORACLE_SQL)
    same_rows(op.op12_minhash_dedup(spark, data), answer.fetchall(), [d[0] for d in answer.description])


def test_the_pivot_is_the_class_that_meets_most(spark):
    """A class that shares all bands with ten others, of which each shares one with it alone, is the pivot of every bucket, though its key is the greatest."""
    word = lambda band, i: (band * 1000 + i).to_bytes(8, "big")
    base = [word(b, 0) for b in range(32)]
    of = [(b"z", b"".join(base))] + [(bytes([97 + i]), b"".join(base[b] if b in (i, 31) else word(b, i + 1) for b in range(32))) for i in range(10)]
    met = op.meetings(spark.createDataFrame([(bytearray(k), bytearray(v)) for k, v in of], "key binary, signature binary")).collect()
    assert {bytes(r["pivot"]) for r in met} == {b"z"} and len(met) == 2 * 10 + 11
