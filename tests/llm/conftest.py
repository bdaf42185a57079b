"""Small awkward tables: nulls, empty and long texts, repeated rows, ties, extra columns with clashing names."""

from __future__ import annotations

import random

import pytest

SYLLABLES = ["the", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it", "st", "io", "le", "is", "ou", "ar", "as", "de", "rt", "ve"]


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) + rng.choice(["", "", "", ",", ".", "\n"]) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    rng = random.Random(11)
    base = [prose(rng, rng.randint(5, 200)) for _ in range(60)]
    near = base[0].split(" ")
    near[3] = "changedword"
    texts = [*base, base[1], base[1], " ".join(near), base[2] + " end", None, None, "", "   ", "word", "word", "Word!", "éé ñ 中文 😀 Ünï", prose(rng, 6000), "a" * 50_000, "x " * 3000]
    out = [(i, t) for i, t in enumerate(texts)]
    return [*out, out[5], (None, base[7]), (3, base[9])]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """Rows with columns whose names operators use inside."""
    every = [(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), 0.5, 1, "k", 2, b"x") for i, t in rows]
    return spark.createDataFrame(every, "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, shard int, key string, length int, id binary").repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")


def same(a, b):
    assert sorted(a, key=repr) == sorted(b, key=repr)
