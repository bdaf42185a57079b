"""Places against plain word windows; the parser against known expressions."""

from __future__ import annotations

import random
import re

import pytest

from tramline.llm import licenses as L


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def places(text):
    own = words(text)
    return sorted((i, p) for p in L.BASE for i in range(len(own)) if own[i : i + len(p.split())] == p.split())


def test_places_equal_windows(spark, rows):
    rng = random.Random(2)
    bits = ["CC", "by", "General", "public", "license", "all", "rights", "reserved", "x", ",", "\n", "-", "cc-by", "éall"]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(400)] + [t for _, t in rows]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in L.scan_licenses(docs).collect():
        text = texts[r["doc_id"]]
        own = places(text)
        assert (r["n_words"], r["n_base"]) == (len(words(text)), len(own))
        assert (r["first_word"], r["last_word"]) == ((own[0][0], own[-1][0]) if own else (None, None))
        base = sorted({L.BASE[p] for _, p in own})
        assert r["base_labels"] == ",".join(base) and set(base) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1


@pytest.mark.parametrize(
    ("expression", "postfix"),
    [("MIT", ["mit"]), ("MIT OR Apache-2.0 AND ISC", ["mit", "apache-2.0", "isc", "and", "or"]), ("(MIT OR Apache-2.0) AND ISC", ["mit", "apache-2.0", "or", "isc", "and"]), ("GPL-2.0 with Classpath-exception-2.0", ["gpl-2.0", "classpath-exception-2.0", "with"]), ("", None), ("MIT OR", ["mit"]), ("(MIT", None), ("MIT)", ["mit"]), ("MIT MIT", ["mit"]), ("AND", None), ("MIT This file is part of x", ["mit"]), ("MIT/Apache-2.0", ["mit", "apache-2.0", "or"]), ("MIT and this is prose", ["mit"]), ("(MIT or ISC) and see below", ["mit", "isc", "or"]), ("MIT. Or not.", ["mit"]), ("see the file", None), ("MIT, GPL-2.0", ["mit"])],
)
def test_postfix(expression, postfix):
    assert L.to_postfix(expression) == postfix


@pytest.mark.parametrize(("expression", "labels"), [("GPL-3.0-only OR MIT", {"mit"}), ("GPL-3.0-only AND MIT", {"gpl", "mit"}), ("(GPL-2.0 OR AGPL-3.0) AND MIT", {"gpl", "mit"}), ("GPL-2.0 WITH x-exception", {"gpl"}), ("Strange-1.0", {"other"}), ("mitre-x", {"other"}), ("MIT-0", {"mit"}), ("BSD-3-Clause", {"bsd"}), ("bsd-ish", {"other"}), ("MIT/GPL-2.0", {"mit"}), ("GPL-2.0 or MIT or is it", {"mit"})])
def test_evaluate(expression, labels):
    assert L.evaluate(expression)[0] == labels


def test_tags():
    assert L.scan(b"// SPDX-License-Identifier: (MIT OR GPL-2.0) */\ncode")[2] == ["mit"]
    assert L.scan(b"SPDX-License-Identifier: MIT OR")[2] == ["mit"]
    assert L.scan(b"SPDX-License-Identifier: MIT This file is part of x")[2] == ["mit"]
    assert L.scan(b"<!-- SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 AND (MIT OR CC0-1.0) -->")[2] == ["cc0", "gpl"]
    assert L.scan("Licensed under the Apache License, Version 2.0.".encode())[2] == ["apache"]
    assert L.scan(None) == (0, [], [], 0.0)
    assert L.scan(b"cc by cc by")[1] == [("cc by", 0), ("cc by", 2)]


def test_empty(no_docs, docs, rows):
    assert L.scan_licenses(no_docs).count() == 0 and L.scan_licenses(docs).count() == len(rows)


def descend(tokens):
    """(labels, binds) by recursive descent: ``or`` of ``and`` of ``with``."""
    at = 0

    def choice():
        nonlocal at
        left = both()
        while at < len(tokens) and tokens[at] == "or":
            at += 1
            right = both()
            left = left if left[1] <= right[1] else right
        return left

    def both():
        nonlocal at
        left = excepted()
        while at < len(tokens) and tokens[at] == "and":
            at += 1
            right = excepted()
            left = (left[0] | right[0], max(left[1], right[1]))
        return left

    def excepted():
        nonlocal at
        left = one()
        while at < len(tokens) and tokens[at] == "with":
            at += 2
            left = (left[0], left[1] * 0.75)
        return left

    def one():
        nonlocal at
        at += 1
        if tokens[at - 1] != "(":
            return L.family(tokens[at - 1])
        inner = choice()
        at += 1
        return inner

    return choice()


def plain_labels(text):
    """Labels and score from word windows, and from every prefix of a tag's line that is an expression."""
    own, kinds = words(text), {}
    stands = lambda p: any(own[i : i + len(p.split())] == p.split() for i in range(len(own)))
    for p, label in L.NOTICES.items():
        if stands(p):
            kinds[label] = "notice"
    for p, label in L.BASE.items():
        if stands(p):
            kinds.setdefault(label, "base")
    for line in re.findall(r"(?ai)spdx-license-identifier:[ \t]*([^\n\r]*)", text or ""):
        best = None
        tokens = line.replace("(", " ( ").replace(")", " ) ").replace("/", " or ").split()
        for end in range(1, len(tokens) + 1):
            some = [t.lower() for t in tokens[:end]]
            shape = "".join(t if t in "()" else "+" if t in ("or", "and", "with") else "x" for t in some)
            while len(shape) != len(shape := shape.replace("(x)", "x").replace("x+x", "x")):
                pass
            nested = any(a == "with" and b == "(" for a, b in zip(some, some[1:], strict=False))
            best = some if shape == "x" and not nested else best
        if best:
            kinds.update(dict.fromkeys(descend(best)[0], "tag"))
    rest = 1.0
    for kind in kinds.values():
        rest *= 1 - L.WEIGHTS[kind]
    return ",".join(sorted(kinds)), 1 - rest


def test_labels_equal_a_plain_version(spark):
    rng = random.Random(6)
    identifiers = ["MIT", "Apache-2.0", "GPL-2.0-only", "ISC", "Foo-9", "CC-BY-4.0", "(MIT OR ISC)", "(GPL-3.0 AND (MIT OR CC0-1.0))"]
    tag = lambda: "SPDX-License-Identifier: " + "".join(rng.choice(identifiers) + rng.choice([" OR ", " and ", "/", " WITH ", " "]) for _ in range(rng.randint(0, 6))) + rng.choice(identifiers)
    texts = ["\n".join(rng.choice([tag, lambda: rng.choice([*L.NOTICES, *L.BASE, "plain words"])])() for _ in range(rng.randint(0, 4))) for _ in range(300)] + [None, ""]
    out = L.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    for r in out:
        labels, score = plain_labels(texts[r["doc_id"]])
        assert r["labels"] == labels and abs(r["score"] - score) < 1e-12


def test_planted_lines_equal_sql(spark, duck, data):
    from compare import same_rows

    cursor = duck.execute(L.PLANTED_SQL)
    columns = [d[0] for d in cursor.description]
    same_rows(L.licenses_planted(spark, data), cursor.fetchall(), columns)


@pytest.mark.parametrize(("line", "labels", "kind"), L._PLANTED)
def test_planted_lines(line, labels, kind):
    assert L.scan(line.encode())[2] == sorted(labels.split())
    assert kind == "tag" or plain_labels(line)[0] == labels
