"""Round trips of ids, exact use of every piece, and how full sequences are."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tramline.llm import packing as P


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.vocabulary())


def test_ids_are_the_librarys(library, rows):
    encode = P.encoder(P.vocabulary())
    rng = random.Random(1)
    pool = "ab  \n\t'sléß中́  \U0001f600 1٣.,!<|endoftext|>\r\x0b\x00İﬁK"
    texts = [t or "" for _, t in rows] + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>", "  <|endoftext|>\n\n<|endoftext|><|endoftext|>é", "<|endoftext|", "<|ENDOFTEXT|>", "one " * 2000 + "<|endoftext|>two"])
def test_added_tokens_are_the_librarys(text):
    plain = Tokenizer.from_file(P.vocabulary())
    assert np.frombuffer(P.encoder(P.vocabulary())(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_other_files_go_to_the_library(name):
    assert P.Encoder(P.vocabulary(name)).ranked is None


def test_pack(spark, docs, rows, library):
    out = P.pack(docs, P.vocabulary(), size=128, with_ids=True).collect()
    whole = {}
    for r in out:
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"] <= 128 and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        whole.setdefault(r["doc_id"], []).append((r["start"], r["piece"], ids.tolist()))
    expected = {}
    for i, t in rows:
        expected.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 2])
    for i, wanted in expected.items():
        assert sum(len(x) for x in wanted) == sum(len(x[2]) for x in whole[i])
        if len(wanted) == 1:
            assert [y for x in sorted(whole[i]) for y in x[2]] == wanted[0]
            assert all(len(x[2]) == 128 for x in sorted(whole[i])[1:])
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 128
    total = sum(r["length"] for r in out)
    assert len(by_sequence) <= 1.03 * -(-total // 128) + 1


def best_fit_decreasing(lengths, size):
    room = []
    for x in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= x]
        if fits:
            room[min(fits)[1]] -= x
        else:
            room.append(size - x)
    return len(room)


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_all_and_is_tight(seed):
    rng = random.Random(seed)
    size = rng.choice([50, 100, 256])
    lengths = [min(size, int(rng.paretovariate(1.1)) if seed % 2 else rng.randint(1, size)) for _ in range(1500)]
    histogram = {}
    for x in lengths:
        histogram[x] = histogram.get(x, 0) + 1
    planned = P.plan(histogram, size)
    used = {}
    for own, times in planned:
        assert sum(own) <= size and times > 0
        for x in own:
            used[x] = used.get(x, 0) + times
    assert used == histogram
    assert sum(t for _, t in planned) <= 1.01 * best_fit_decreasing(lengths, size) + 1


def fewest(lengths, size):
    """The least number of sequences, by trying every place for every piece."""
    order, best = sorted(lengths, reverse=True), len(lengths)

    def place(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(order):
            best = len(room)
            return
        for r in {r for r in room if r >= order[i]}:
            k = room.index(r)
            place(i + 1, [*room[:k], r - order[i], *room[k + 1 :]])
        place(i + 1, [*room, size - order[i]])

    place(0, [])
    return best


def test_plan_against_the_optimum_of_tiny_inputs():
    rng, over = random.Random(12), 0
    for _ in range(150):
        size = rng.choice([7, 10, 20, 50])
        lengths = [rng.randint(1, size) for _ in range(rng.randint(1, 9))]
        histogram = {x: lengths.count(x) for x in lengths}
        used = sum(t for _, t in P.plan(histogram, size))
        best = fewest(lengths, size)
        assert best <= used <= best + 1
        over += used - best
    assert over <= 4  # nearly always the optimum


def test_empty(no_docs):
    assert P.pack(no_docs, P.vocabulary()).count() == 0
    assert P.plan({}, 10) == [] and P.plan({10: 3}, 10) == [((10,), 3)]
