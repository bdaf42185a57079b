"""Best segmentations against a plain dynamic program for each pre-token."""

from __future__ import annotations

import math

import pytest

from tramline.llm import tokencounts as T


def plain(model, word):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        found = [(best[s][0] + model.score[word[s:end]], best[s][1] - 1) for s in range(end) if word[s:end] in model.score]
        best.append(max(found))
    return -best[-1][1]


@pytest.mark.parametrize("kept", [500_000, 50])
def test_counts(spark, docs, rows, monkeypatch, kept):
    monkeypatch.setattr(T, "KEPT", kept)
    model = T.Model([b"the", b"er", b" th", b" the", b"a", b"aa", b"aaa", b"on", b"in", b" ", b"re", b"ere", "é".encode()])
    texts = [t.encode()[:3000] if t else None for _, t in rows]
    for text, (n, tokens) in zip(texts, [x for s in range(0, len(texts), 7) for x in model.count(texts[s : s + 7])], strict=True):
        own = T.PRETOKEN.findall(text or b"")
        assert b"".join(own) == (text or b"") and n == len(own)
        assert tokens == sum(plain(model, w) for w in own)


def test_counts_on_the_vocabulary(spark, docs, rows):
    """The query's own model on whole texts, against a plain dynamic program over every pre-token."""
    model, known = T.model(T.vocabulary()), {}

    def plainly(word):
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            own = [(best[s][0] + score, best[s][1] - 1) for s in range(max(0, end - model.longest), end) if (score := model.score.get(word[s:end])) is not None]
            best.append(max(own))
        return -best[-1][1]

    texts = dict(rows)
    for r in T.count_tokens(docs.where("doc_id IS NOT NULL AND doc_id <> 3"), T.vocabulary()).collect():
        own = T.PRETOKEN.findall((texts[r["doc_id"]] or "").encode())
        assert r["n_tokens"] == sum(known.setdefault(w, None) or known.update({w: plainly(w)}) or known[w] for w in own)


def test_query(spark, docs, no_docs, rows):
    out = T.count_tokens(docs, T.vocabulary()).collect()
    assert len(out) == len(rows) and all((r["n_tokens"] > 0) == (r["n_bytes"] > 0) for r in out)
    assert T.count_tokens(no_docs, T.vocabulary()).count() == 0
    model = T.model(T.vocabulary())
    assert math.isclose(sum(math.exp(s) for s in model.score.values()), 1, rel_tol=1e-3)
