"""Whole groups, slots without gaps, and a balance that the greedy rule doesn't reach."""

from __future__ import annotations

import random
import zlib

import pytest

from tramline.llm import sharding as S


def test_differencing_places_all_bytes():
    rng = random.Random(3)
    for k in (2, 3, 8):
        sizes = [rng.randint(1, 10_000) for _ in range(300)]
        goes, final = S.differencing([[x] + [0] * (k - 1) for x in sizes])
        made = [0] * k
        for x, to in zip(sizes, goes, strict=True):
            assert sorted(to) == list(range(k))
            made[to[0]] += x
        assert made == final
        greedy = [0] * k
        for x in sorted(sizes, reverse=True):
            greedy[greedy.index(min(greedy))] += x
        assert max(final) - min(final) <= max(greedy) - min(greedy) + 3
    assert S.differencing([]) == ([], [])


@pytest.mark.parametrize("chunk", [20_000, 10])
def test_shards(spark, docs, rows, chunk):
    out = S.shard(docs, 4, chunk).collect()
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=repr) == sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    for s in range(4):
        own = sorted(r["slot"] for r in out if r["shard"] == s)
        assert own == list(range(len(own)))
    where = {}
    for r in out:
        where.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert all(len(x) == 1 for x in where.values())
    loads = [sum(r["size"] for r in out if r["shard"] == s) for s in range(4)]
    groups = {}
    for _, t in rows:
        groups[t or ""] = groups.get(t or "", 0) + len((t or "").encode()) + 1
    loads.sort()
    assert loads[2:] == sorted(groups.values())[-2:]  # the two longest texts each fill more than a shard's part
    assert loads[1] - loads[0] <= 0.05 * sum(loads)


def sequential(sizes, shards):
    """Plain differencing of sorted lists, without a heap or marks: the loads of the shards up to a constant."""
    lists = [[n] + [0] * (shards - 1) for n in sizes]
    while len(lists) > 1:
        lists.sort(key=lambda x: max(x) - min(x))
        a, b = lists.pop(), lists.pop()
        lists.append([x + y for x, y in zip(sorted(a), sorted(b, reverse=True), strict=True)])
    return sorted(lists[0])


def spread_of_the_best(sizes, shards):
    """The least spread of any partition, by trying all."""
    from itertools import product

    best = None
    for to in product(range(shards), repeat=len(sizes)):
        made = [0] * shards
        for x, n in zip(to, sizes, strict=True):
            made[x] += n
        best = max(made) - min(made) if best is None else min(best, max(made) - min(made))
    return best


@pytest.mark.parametrize("shards", [2, 3, 8])
def test_differencing_equals_a_plain_version(shards):
    rng = random.Random(shards)
    for _ in range(20):
        sizes = rng.sample(range(1, 10**6), rng.randint(1, 60))
        _, final = S.differencing([[n] + [0] * (shards - 1) for n in sizes])
        plain = sequential(sizes, shards)
        assert sum(final) == sum(plain) and abs((max(final) - min(final)) - (plain[-1] - plain[0])) <= 0.02 * max(sizes)
    for _ in range(10):
        sizes = [rng.randint(1, 50) for _ in range(7)]
        _, final = S.differencing([[n, 0] for n in sizes])
        assert max(final) - min(final) <= spread_of_the_best(sizes, 2) + max(sizes) / 2


def test_two_runs_agree(spark):
    rng = random.Random(8)
    groups = [(bytearray(rng.randbytes(16)), rng.choice([5, 5, 9])) for _ in range(3000)]
    runs = []
    for own in (groups, groups[::-1]):
        df = spark.createDataFrame(own, "id binary, bytes bigint").repartition(4, "id")
        runs.append({bytes(r["id"]): r["shard"] for r in S.balance(df, 8, 100).collect()})
    assert runs[0] == runs[1]


def test_balance(spark):
    rng = random.Random(5)
    rows = [(i, "x" * rng.randint(0, 4000)) for i in range(800)] + [(1000 + i, "copy" * 50) for i in range(40)]
    out = S.shard(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), 8).groupBy("shard").sum("size").collect()
    sums = [r[1] for r in out]
    assert len(sums) == 8 and max(sums) - min(sums) <= 0.001 * sum(sums)


def test_empty(no_docs):
    assert S.shard(no_docs, 8).count() == 0


@pytest.mark.parametrize("share", [0.0, 0.10, 0.33])
def test_balance_of_many_chunks_beside_a_big_group(spark, share):
    rng = random.Random(7)
    sizes = [rng.randint(1, 4000) for _ in range(6000)]
    if share:
        sizes.append(int(sum(sizes) * share / (1 - share)))
    groups = spark.createDataFrame([(bytearray(i.to_bytes(16, "big")), n) for i, n in enumerate(sizes)], "id binary, bytes bigint").repartition(7)
    made = [0] * 8
    out = S.balance(groups, 8, 200).collect()
    assert sorted(int.from_bytes(r["id"], "big") for r in out) == list(range(len(sizes)))
    for r in out:
        made[r["shard"]] += sizes[int.from_bytes(r["id"], "big")]
    made.sort()
    if share > 1 / 8:
        assert made.pop() == sizes[-1]  # the big group alone is more than a shard's part
    assert made[-1] - made[0] <= 0.001 * sum(sizes)


def test_room_levels_what_it_can():
    assert S.room([0, 0, 0], 10) == [4, 3, 3]
    assert S.room([9, 1, 3], 4) == [0, 3, 1]
    assert S.room([5, 5], 0) == [0, 0]
