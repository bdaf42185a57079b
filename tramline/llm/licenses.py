"""Licence scans (operator 10).

An Aho-Corasick automaton runs once over the words of a text and finds notice
phrases and the words of identifier tags. Where a tag stands, the longest
well-formed expression behind it is read by a shunting-yard parser and
evaluated: ``or``, or a slash, is the choice of the freer side, ``and`` binds
both sides, ``with`` adds an exception to the licence before it. What follows on
the line, prose say, is not part of the expression. Whole identifiers are looked
up; one that is not known has the label ``other``.

Null and empty texts have no words and no labels. Equal rows, and rows with
equal ids, get results one by one and alike; of two sides that bind alike (a
tie) the left one is chosen. Texts of any length are scanned whole. Only the
columns doc_id and text are read. An empty table gives no rows.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import Buffer, arrow_schema, rows, table, words

#: Fixed phrases and labels of the base.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Further notices, in words, and their labels.
NOTICES = {
    "apache license": "apache",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "gnu affero general public license": "agpl",
    "gnu lesser general public license": "lgpl",
    "lesser general public license": "lgpl",
    "released under the mit license": "mit",
    "the mit license": "mit",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "eclipse public license": "epl",
    "dedicated to the public domain": "public-domain",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
#: The words of the tag that an expression follows.
TAG = "spdx license identifier"
TAG_LINE = re.compile(r"spdx-license-identifier:[ \t]*([^\n\r]*)", re.I | re.A)
TOKEN = re.compile(r"[ \t]*(\(|\)|/|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
#: Whole licence identifiers in lower case: pattern, label, and how much a licence binds its user from 0 to 1.
FAMILIES = tuple(
    (re.compile(pattern), label, binds)
    for pattern, label, binds in (
        (r"apache-\d(\.\d)*", "apache", 0.2),
        (r"mit(-0|-cmu|-advertising|-feh|-enna|-modern-variant|-open-group|nfa)?", "mit", 0.1),
        (r"(0bsd|bsd-[0-9]-clause(-[a-z-]+)?)", "bsd", 0.1),
        (r"isc", "isc", 0.1),
        (r"cc0(-\d(\.\d)*)?", "cc0", 0.0),
        (r"unlicense", "public-domain", 0.0),
        (r"cc-by-nc(-sa|-nd)?(-\d(\.\d)*)?", "cc-by-nc", 0.7),
        (r"cc-by-sa(-\d(\.\d)*)?", "cc-by-sa", 0.6),
        (r"cc-by(-nd)?(-\d(\.\d)*)?", "cc-by", 0.3),
        (r"agpl-\d(\.\d)*(-only|-or-later|\+)?", "agpl", 0.9),
        (r"lgpl-\d(\.\d)*(-only|-or-later|\+)?", "lgpl", 0.6),
        (r"gpl-\d(\.\d)*(-only|-or-later|\+)?", "gpl", 0.8),
        (r"mpl-\d(\.\d)*(-no-copyleft-exception)?", "mpl", 0.5),
        (r"epl-\d(\.\d)*", "epl", 0.5),
    )
)
#: Weight of one kind of evidence in the score.
WEIGHTS = {"tag": 0.9, "notice": 0.7, "base": 0.5}


def identifier_like(token: str) -> bool:
    """Known identifiers, and words with a digit, a hyphen or capitals alone, as identifiers have; not the words of prose."""
    return known(token) is not None or "-" in token or any("0" <= c <= "9" for c in token) or token.isupper()


def longest(expression: str) -> list[str]:
    """The tokens of the longest well-formed expression with which a line begins, in lower case; a slash is an ``or``."""
    tokens: list[str] = []
    at, depth, operand, whole = 0, 0, True, 0
    while (found := TOKEN.match(expression, at)) is not None:
        token = found[1].rstrip(".:")
        if token == "(" and operand and tokens[-1:] != ["with"]:  # an exception is one identifier
            depth += 1
        elif token == ")" and not operand and depth:
            depth -= 1
        elif (token == "/" or token.lower() in PRECEDENCE) and not operand:
            operand = True
        elif operand and token not in ("(", ")", "/") and token.lower() not in PRECEDENCE and identifier_like(token):
            operand = False
        else:
            break
        tokens.append("or" if token == "/" else token.lower())
        if not operand and not depth:
            whole = len(tokens)
        if token != found[1]:  # the sentence ends
            break
        at = found.end()
    return tokens[:whole]


def to_postfix(expression: str) -> list[str] | None:
    """Shunting-yard over the longest well-formed expression; operators are and/or/with in either case; None if there is none."""
    out: list[str] = []
    stack: list[str] = []
    for token in longest(expression):
        if token == "(":
            stack.append(token)
        elif token == ")":
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        elif token in PRECEDENCE:
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[token]:
                out.append(stack.pop())
            stack.append(token)
        else:
            out.append(token)
    return out + stack[::-1] or None


def known(identifier: str) -> tuple[str, float] | None:
    for pattern, label, binds in FAMILIES:
        if pattern.fullmatch(identifier.lower()):
            return label, binds
    return None


def family(identifier: str) -> tuple[frozenset[str], float]:
    label, binds = known(identifier) or ("other", 0.5)
    return frozenset([label]), binds


def evaluate(expression: str) -> tuple[frozenset[str], float] | None:
    """Labels that hold under the expression and how much they bind; None if the line begins with none."""
    postfix = to_postfix(expression)
    if postfix is None:
        return None
    stack: list[tuple[str, frozenset[str], float]] = []
    for token in postfix:
        if token not in PRECEDENCE:
            stack.append((token, *family(token)))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":  # an exception frees the user of a part of what binds
            stack.append((left[0], left[1], left[2] * 0.75))
        elif token == "and":
            stack.append(("", left[1] | right[1], max(left[2], right[2])))
        else:
            stack.append(left if left[2] <= right[2] else right)
    return stack[0][1], stack[0][2]


_automaton = None


def automaton():
    """The automaton over all phrases, made once in each Python process."""
    global _automaton
    if _automaton is None:
        import ahocorasick

        made = ahocorasick.Automaton()
        for phrase in dict.fromkeys([*BASE, *NOTICES, TAG]):
            made.add_word(f" {phrase} ", phrase)
        made.make_automaton()
        _automaton = made
    return _automaton


def scan(text: bytes | None) -> tuple[int, list[tuple[str, int]], list[str], float]:
    """Words; all places (phrase, first word); labels; score."""
    own = words(text)
    if not own:
        return 0, [], [], 0.0
    line = f" {b' '.join(own).decode()} "
    places = [(phrase, end - len(phrase) - 1) for end, phrase in automaton().iter(line)]
    if not places:
        return len(own), [], [], 0.0
    at, number, starts = 0, 0, []
    for phrase, start in sorted(places, key=lambda p: (p[1], p[0])):
        number += line.count(" ", at, start)
        at = start
        starts.append((phrase, number))
    kinds: dict[str, str] = {}
    for phrase, _ in starts:
        if phrase in NOTICES:
            kinds[NOTICES[phrase]] = "notice"
        if phrase in BASE:
            kinds.setdefault(BASE[phrase], "base")
    if any(phrase == TAG for phrase, _ in starts):
        for found in TAG_LINE.finditer(text.decode()):
            if (value := evaluate(found[1])) is not None:
                kinds.update(dict.fromkeys(value[0], "tag"))
    rest = 1.0
    for kind in kinds.values():
        rest *= 1 - WEIGHTS[kind]
    return len(own), starts, sorted(kinds), 1 - rest


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: what scan() finds in its text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    out = pa.schema([arrow_schema(docs.select("doc_id")).field(0), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("n_places", pa.int64())])

    def run(batches):
        buffer = Buffer(out)
        for doc_id, text in rows(batches, "doc_id", "text"):
            n, starts, labels, score = scan(text)
            base = [(phrase, at) for phrase, at in starts if phrase in BASE]
            buffer.add(doc_id, n, len(base), min((at for _, at in base), default=None), max((at for _, at in base), default=None), ",".join(sorted({BASE[p] for p, _ in base})), ",".join(labels), score, len(starts))
            if buffer.full:
                yield buffer.take()
        yield buffer.take()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, n_places bigint")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every whole document."""
    return scan_licenses(table(spark, sf_dir, "documents"))


#: Last lines of licenses_planted, by the remainder of the id, and the labels that each must give, worked out by hand.
_PLANTED = (
    ("// SPDX-License-Identifier: (MIT OR GPL-2.0) */", "mit", "tag"),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 AND (MIT OR CC0-1.0)", "gpl cc0", "tag"),
    ("spdx-license-identifier: Apache-2.0/MIT", "mit", "tag"),
    ("SPDX-License-Identifier: Strange-1.0 and ISC This file is part of x", "other isc", "tag"),
    ("SPDX-License-Identifier: AGPL-3.0-or-later OR LGPL-2.1+ AND MPL-2.0", "lgpl mpl", "tag"),
    ("SPDX-License-Identifier: see the file", "", "tag"),
    ("Licensed under the Apache License, Version 2.0.", "apache", "notice"),
)


def licenses_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with a tag and an expression, a tag without one, or a notice behind seven of eight."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = F.pmod(F.col("doc_id"), F.lit(len(_PLANTED) + 1))
    more = F.coalesce(*(F.when(left == i, F.lit(f"\n{line}")) for i, (line, _, _) in enumerate(_PLANTED)), F.lit(""))
    out = scan_licenses(docs.select("doc_id", F.concat(F.coalesce("text", F.lit("")), more).alias("text")))
    return out.select("doc_id", "n_words", "labels", F.round("score", 6).alias("score"))


def _values(*columns: list[str]) -> str:
    return ", ".join(f"({', '.join(row)})" for row in zip(*columns, strict=True))


def _quoted(values) -> list[str]:
    return ["'" + v.replace("'", "''") + "'" for v in values]


PLANTED_SQL = rf"""
WITH plant(i, line, labels, kind) AS (VALUES {_values([str(i) for i in range(len(_PLANTED))], *(_quoted(column) for column in zip(*_PLANTED, strict=True)))}),
phrase(p, label, weight) AS (VALUES {_values(_quoted([*NOTICES, *BASE]), _quoted([*NOTICES.values(), *BASE.values()]), [str(WEIGHTS["notice"])] * len(NOTICES) + [str(WEIGHTS["base"])] * len(BASE))}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') || coalesce(chr(10) || line, '') AS text, labels, kind FROM documents LEFT JOIN plant ON i = doc_id % {len(_PLANTED) + 1}),
w AS (SELECT r, doc_id, labels, kind, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS own FROM d),
l AS (SELECT *, ' ' || array_to_string(own, ' ') || ' ' AS line FROM w),
f AS (SELECT r, label, weight FROM l JOIN phrase ON contains(line, ' ' || p || ' ')
  UNION ALL SELECT r, unnest(string_split(labels, ' ')), {WEIGHTS["tag"]} FROM l WHERE kind = 'tag' AND labels <> ''),
k AS (SELECT r, label, max(weight) AS weight FROM f GROUP BY ALL),
s AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels, 1 - product(1 - weight) AS score FROM k GROUP BY r)
SELECT l.doc_id, len(own) AS n_words, coalesce(s.labels, '') AS labels, round(coalesce(CAST(s.score AS DOUBLE), 0.0), 6) AS score FROM l LEFT JOIN s USING (r)"""
