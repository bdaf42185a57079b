"""The fill-in-middle transformation against lists of units."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from compare import same_rows

from tramline.llm import infill

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plain(one, text):
    """(units, form, prefix, middle, output) by cutting the text into a list."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if one is None else one}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("every", [1, 2, 7, 1024])
@pytest.mark.parametrize("block", [1, 5, 64, 1 << 16])
def test_every_offset(every, block):
    rng = random.Random(every * block)
    for n in (0, 1, 2, 40, 300):
        text = "".join(rng.choice(["a", "Bc", "é", "中", "😀", " ", "\n", "9", "zzzzzzzzz"]) for _ in range(n))
        units, index = UNIT.findall(text), infill.Checkpoints(text.encode(), every, block)
        assert (index.n, index.n_points) == (len(units), len(text))
        assert len(index.units) <= len(units) // every + 1
        for k in range(len(units) + 1):
            head = "".join(units[:k])
            assert index.offset(k) == (len(head.encode()), len(head))


def test_marks_that_meet_pieces(spark):
    texts = ["<", "<S", "<P<", "<<M", "a<", "<S a <P b <M c", ">S<", "M>x<M", "<P>", "x<S>y", "<M>"] * 20
    made = infill.fill_in_middle(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    got = made.select("id", "form", "output", infill.restored(made["output"], made["form"]).alias("back")).collect()
    assert all(r.back == texts[r.id] for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert all(r.form == "plain" for r in got if any(m in texts[r.id] for m in ("<P>", "<S>", "<M>")))


def test_awkward_rows(docs, rows):
    made = infill.fill_in_middle(docs)
    got = made.select("*", infill.restored(made["output"], made["form"]).alias("back")).collect()
    assert sorted([tuple(r[:-1]) for r in got], key=repr) == sorted([(i, *plain(i, t)) for i, t in rows], key=repr)
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in rows)


def test_ids_of_text(spark):
    made = infill.fill_in_middle(spark.createDataFrame([("k1", "some text é"), (None, "more"), ("ü", None)], "doc_id string, text string"))
    assert {tuple(r) for r in made.collect()} == {(i, *plain(i, t)) for i, t in [("k1", "some text é"), (None, "more"), ("ü", None)]}


def test_no_rows(no_docs):
    made = infill.fill_in_middle(no_docs)
    assert made.count() == 0 and made.columns == ["id", "n", "form", "prefix_chars", "middle_chars", "output"]


def test_long_texts_take_time_in_proportion():
    import time

    for text in (b"a" * 20_000_000, "é ".encode() * 5_000_000):
        began = time.perf_counter()
        n, form, _, _, output = infill.transform(text, [2**31 + 12345, 2**30 + 999, 0, 50])
        assert form == "psm" and len(output) == len(text) + 9 and n in (1, 10_000_000)
        assert time.perf_counter() - began < 8


def test_query(spark, data, duck):
    found = duck.execute(infill.ORACLE_SQL)
    same_rows(infill.op11_fill_in_middle(spark, data), found.fetchall(), [d[0] for d in found.description])
