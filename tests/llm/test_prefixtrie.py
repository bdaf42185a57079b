"""The prefix trie against nested dictionaries."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from compare import same_rows

from tramline.llm import prefixtrie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, depth int, n_convs int, parent string"


def plain(given):
    """Every node by a walk over nested dictionaries of the rebuilt conversations."""
    turns = {}
    for c, turn, role, text in given:
        if c is not None:
            role, text = role or "", text or ""
            turns.setdefault(c, []).append(((turn is not None, turn or 0), role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), text))
    turns = {c: [(role, text) for _, role, _, text in sorted(own)] for c, own in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = turns.get(c - c % 100, [])[:h] + own[h:]
    members = {}
    for c, own in whole.items():
        for d in range(len(own) + 1):
            members.setdefault(tuple(own[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    below = {}
    for node in sorted(members, key=len, reverse=True):
        chars = len(node[-1][1]) if node else 0
        saved, leaves = (len(members[node]) - 1) * chars, int(node not in kids)
        for kid in kids.get(node, []):
            saved, leaves = saved + below[kid][0], leaves + below[kid][1]
        below[node] = saved, leaves

    out = []
    for node, own in members.items():
        saved, leaves = below[node]
        ends = ",".join(str(c) for c in sorted(own) if len(whole[c]) == len(node))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(kids.get(node, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def made(spark, given):
    extra = [(*r, "k", 1, 2, "p") for r in given]
    return prefixtrie.prefix_trie(spark.createDataFrame(extra, SCHEMA).repartition(3)).select(*prefixtrie.NODE)


def same(spark, given):
    assert sorted((tuple(r) for r in made(spark, given).collect()), key=repr) == sorted(plain(given), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    rng = random.Random(seed)
    given = []
    for c in rng.sample(range(-150, 420), 90):
        start = rng.choice([["a", "b"], ["a"], ["c", "d", "e"], []])
        for turn, text in enumerate([*start, *(rng.choice("xyz") * rng.randint(0, 3) for _ in range(rng.randint(1, 9)))]):
            given.append((c, turn, rng.choice(["user", "assistant"]) if rng.random() < 0.1 else ["user", "assistant"][turn % 2], text))
    same(spark, given)


def test_awkward_rows(spark):
    given = [
        (None, 0, "user", "of no conversation"), (0, None, None, None), (0, 0, "user", "é中😀"), (0, 1, None, "x"), (0, 1, "user", "x"), (0, 1, "user", "x"), (0, 2, "user", ""),
        (1, 5, "user", "late"), (1, None, "user", "first"), (1, None, None, "first too"), (2, 0, "user", "y" * 100_000), (100, 0, "a", "b"), (101, 0, "ab", ""), (101, 1, "", "ab"), (205, 0, "user", "alone"), (-1, 0, "user", "below zero"),
    ]
    same(spark, given)
    same(spark, given + given)


def test_copies_and_one_long_conversation(spark):
    """A third of all rows in one conversation and a third of all conversations equal."""
    given = [(7, t, "user", f"turn {t % 50}") for t in range(1500)] + [(300 + 100 * c, t, "user", f"copy {t}") for c in range(300) for t in range(3)] + [(33 + 100 * c, t, "user", f"{c} {t}") for c in range(300) for t in range(3)]
    same(spark, given)


def test_pieces_of_ids(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "PIECE", 10)
    ends = spark.createDataFrame([(b"k", i) for i in range(-50, 400)] + [(b"l", 3)], "key binary, conv_id bigint").repartition(5)
    want = {b"k": ",".join(map(str, range(-50, 400))), b"l": "3"}
    assert {bytes(r.key): r.ends_sha256 for r in prefixtrie.digests(ends).collect()} == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


def test_no_rows(spark):
    assert made(spark, []).count() == 0
    assert made(spark, [(None, 1, "user", "x")]).count() == 0


def test_running_sums_of_a_group_over_many_ranges(spark):
    given = [(g, i, (i * 7) % 5) for g, n in (("a", 3), ("b", 1000), ("c", 1)) for i in range(n)]
    got = prefixtrie.running(spark.createDataFrame(given, "g string, i int, v bigint").repartition(3), "g", ["i"], {"upto": "v"}).collect()
    want, total = {}, {}
    for g, i, v in given:
        total[g] = want[g, i] = total.get(g, 0) + v
    assert {(r.g, r.i): r.upto for r in got} == want


def test_query(spark, data, duck):
    found = duck.execute(prefixtrie.ORACLE_SQL)
    same_rows(prefixtrie.op13_prefix_trie(spark, data), found.fetchall(), [d[0] for d in found.description])
