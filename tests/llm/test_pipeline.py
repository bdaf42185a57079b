"""The stages, one after another, on the small tables."""

from __future__ import annotations

import math
import os
import struct
import zlib

from pyspark.sql import functions as F
from test_decontamination import scan
from test_neardup import expected as all_pairs
from test_toxicity import brute
from tokenizers import Tokenizer

import corpus_pipeline
from tramline.llm import toxicity as T
from tramline.llm.common import stored, table
from tramline.llm.decontamination import decontaminate
from tramline.llm.neardup import near_duplicates
from tramline.llm.packing import vocabulary
from tramline.llm.secrets import RULES, find


def test_stages(spark, data):
    docs = table(spark, data, "documents")
    kept = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = docs = stored(stage(spark, docs, data))
    names = list(kept)
    for before, after in zip(names[:-2], names[1:-1], strict=True):
        assert kept[after].columns == kept["documents"].columns
        assert kept[after].join(kept[before].select("doc_id"), "doc_id", "left_anti").count() == 0
    toxic = table(spark, data, "labels").where("toxic = 1").join(kept["documents"], "doc_id", "left_semi")
    clean = table(spark, data, "labels").where("toxic = 0").join(kept["documents"], "doc_id", "left_semi")
    assert clean.join(kept["toxicity"], "doc_id", "left_semi").count() >= 0.97 * clean.count()
    assert toxic.join(kept["toxicity"], "doc_id", "left_semi").count() <= 0.5 * max(1, toxic.count()) or toxic.count() < 20
    groups = near_duplicates(kept["toxicity"]).where("root IS NOT NULL")
    assert kept["near_duplicates"].count() == groups.select("root").distinct().count() + near_duplicates(kept["toxicity"]).where("root IS NULL").count()
    assert near_duplicates(kept["near_duplicates"]).where("n_links > 0").count() == 0
    assert decontaminate(kept["decontamination"], table(spark, data, "benchmark")).where("size(starts) > 0").count() == 0
    assert not any(find(r["text"], RULES) for r in kept["secrets"].where("text IS NOT NULL").collect())
    pieces = kept["packing"]
    assert pieces.select("doc_id").distinct().count() == kept["secrets"].select("doc_id").distinct().count()
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def toxic(text, lexicon, fit):
    """A plain score: segments by their definition, on words of the lexicon and the gaps between them."""
    own = T.words(text.encode() if text else None)
    hits = [(i, s) for i, w in enumerate(own) if (s := lexicon.words.get(w) or lexicon.prefixes.get(T.beginning(w, lexicon.length)))]
    scores = [x for k, (i, s) in enumerate(hits) for x in ((lexicon.rest * (i - hits[k - 1][0] - 1),) if k else ()) + (s,)]
    found = brute(scores)
    if not found:
        return fit.none
    each = [lexicon.decay * s - math.log(fit.k * len(own)) for _, _, s in found]
    t = max(each) + sum(max(0.0, x) for x in each) - max(0.0, max(each))
    return 1 / (1 + math.exp(-(fit.intercept + fit.slope * t)))


def cut(text):
    out, at = [], 0
    for start, end in sorted((s, e) for _, _, s, e in find(text, RULES)):
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def test_stages_equal_plain_versions(spark, data):
    """Every stage on its own input, held against a version without Spark."""
    data = f"{os.path.dirname(data)}/sf0.01"  # the smallest table with enough labels
    docs, labels, items = (table(spark, data, name) for name in ("documents", "labels", "benchmark"))
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())
    training = T.training_rows(docs, labels)
    lexicon = T.fit_lexicon(training, T.choose_length(training))
    fit = T.calibrate(training, lexicon)
    now = stored(stages["toxicity"](spark, docs, data))
    expected = [r for r in rows(docs) if toxic(r[1], lexicon, fit) < 0.5]
    assert rows(now) == expected and len(expected) < docs.count()
    classes = {}
    for i, group, _ in all_pairs(expected):
        classes.setdefault(group, []).append(i)
    expected = [r for r in expected if not r[1] or r[0] in classes]
    now = stored(stages["near_duplicates"](spark, now, data))
    assert rows(now) == expected
    theirs = [(r["item_id"], r["text"]) for r in items.collect()]
    expected = [r for r in expected if not scan(r[1], theirs)[1]]
    now = stored(stages["decontamination"](spark, now, data))
    assert rows(now) == expected
    expected = [(i, t and cut(t)) for i, t in expected]
    now = stored(stages["secrets"](spark, now, data))
    assert rows(now) == expected
    library, pieces = Tokenizer.from_file(vocabulary()), []
    for i, t in expected:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        for k, (a, b) in enumerate(zip([0, *range(first, len(ids), 1024)], [*range(first, len(ids), 1024), len(ids)], strict=True)):
            pieces.append((i, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))))
    out = stages["packing"](spark, now, data).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == sorted(pieces)


def test_run(spark, data):
    assert corpus_pipeline.run(spark, data).count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]


def test_awkward_rows(spark, docs, no_docs, data):
    named = docs.withColumn("doc_id", F.concat(F.lit("doc-"), "doc_id"))
    for some in (docs, no_docs, named):
        out = some
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stored(stage(spark, out, data))
            assert out.schema == some.schema
        corpus_pipeline.STAGES[-1][1](spark, out, data).count()
