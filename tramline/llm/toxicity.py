"""Toxic passages as maximum-scoring segments (operator 4).

Each word, and each beginning of so many characters of a longer word, gets its
log-odds between toxic and clean training texts under an informative Dirichlet
prior in proportion to its overall frequency. Those whose z-score stays
significant after a Bonferroni correction over all of them are counted again,
now once for each pair of neighbouring words, so that copies of one text say a
thing once; those that are still significant make the lexicon. A word that
training never showed, an inflected form say, has the score of its beginning if
that is in the lexicon; every other word gets the small negative score that its
share in toxic and clean text implies. Whether beginnings help, and of how many
characters, is chosen among LENGTHS by the loss on one half of the training rows
of a model learned from the other. The lexicon is a table of the model and holds
all significant words; if there are more than a stated number, LEXICON, that is
an error and no word is dropped. A linear scan finds all maximal segments of a text. Their scores are
calibrated by extreme-value theory: lambda is the root of the clean words'
moment equation, K the maximum-likelihood estimate from the clean training
texts (those without a segment are censored), and a text of n words has the statistic

    T = lambda S1 - ln(K n) + sum over further segments of max(0, lambda Si - ln(K n)).

A logistic curve fitted on a histogram of T over the training rows makes it a
probability; texts without a segment get the share of toxic ones among such. A
segment is a toxic passage if a clean text as long as its own would hold one
that scores as high with a chance of at most SIGNIFICANT.

Labels are learned only from rows that are not held out; score inputs are words
alone. Null and empty texts have no segment. Rows with equal texts get equal
scores; of lengths that tie the least is chosen. Without
toxic training rows the lexicon is empty and every score is the (smoothed) share
of toxic rows, one quarter if there are no training rows at all. Labels that
repeat for an id count as toxic if one says so; null labels are no labels. Texts
of any length are read whole. Other columns are handed on; those that the
operator adds are named by its caller or begin with ``_tl_``. An empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import batched
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import batch_of, join_labels, rows, stored, table, words

#: Weight of the Dirichlet prior, as a share of the training words: in tests of significance, and in scores.
PRIOR, SCORE_PRIOR = 0.2, 0.01
#: Least score of a word of the lexicon.
LEAST_SCORE = 1.0
#: Chance that any word of none at all enters the lexicon.
ALPHA = 0.01
#: Characters of a word's beginning among which training chooses (0: no beginnings), and where nothing is chosen.
LENGTHS, PREFIX = (0, 4, 6), 4
#: Words and beginnings that a lexicon may have; more are an error.
LEXICON = 1_000_000
#: Chance at which a clean text holds a segment as high as a toxic passage.
SIGNIFICANT = 0.01


class Lexicon(NamedTuple):
    words: dict[bytes, float]
    prefixes: dict[bytes, float]
    rest: float  # score of every other word, negative
    decay: float  # lambda
    length: int = PREFIX  # characters of a beginning


def beginning(word: bytes, length: int = PREFIX) -> bytes | None:
    """The first so many characters of a longer word; none of no characters."""
    if len(word) <= length or not length:
        return None
    if word.isascii():
        return word[:length]
    text = word.decode()
    return text[:length].encode() if len(text) > length else None


class Calibration(NamedTuple):
    k: float
    none: float  # probability without a segment
    slope: float
    intercept: float


def held_out(folds: int = 5) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0


def training_rows(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """(text, toxic, half) of the labelled rows that are not held out; equal texts are in one half."""
    own = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")).where(~held_out(folds))
    return join_labels(docs.select("doc_id", "text"), own, 32).select("text", "toxic", (F.crc32(F.coalesce("text", F.lit("")).cast("binary")) % 2).cast("int").alias("half"))


def counts(training: DataFrame, length: int = PREFIX) -> DataFrame:
    """(feature, toxic, clean): how often each word ('w') and beginning ('p') stands in either class; feature '' counts words."""
    out = pa.schema([("feature", pa.binary()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(batches):
        seen = (Counter(), Counter())

        def flush():
            names = list(seen[0].keys() | seen[1].keys())
            for s in range(0, len(names), 1 << 14):
                some = names[s : s + (1 << 14)]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary()), pa.array([seen[1][x] for x in some], pa.int64()), pa.array([seen[0][x] for x in some], pa.int64())], schema=out)
            seen[0].clear()
            seen[1].clear()

        for text, toxic in rows(batches, "text", "toxic"):
            own = words(text)
            to = seen[toxic]
            to[b""] += len(own)
            to.update([b"w" + w for w in own])
            if length:
                to.update([b"p" + p for w in own if len(w) > length and (p := w[:length] if w.isascii() else beginning(w, length))])
            if len(seen[0]) + len(seen[1]) > 400_000:
                yield from flush()
        yield from flush()

    return training.mapInArrow(run, "feature binary, toxic bigint, clean bigint").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def contexts(training: DataFrame, wanted: frozenset[bytes], length: int = PREFIX) -> DataFrame:
    """(feature, toxic, clean): in how many different pairs of neighbours a wanted feature stands in either class."""
    out = pa.schema([("feature", pa.binary()), ("kind", pa.int32()), ("context", pa.int64())])
    to = training.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        import xxhash

        seen: set[tuple[bytes, int, int]] = set()

        def flush():
            for part in batched(seen, 1 << 15):
                yield batch_of(out, list(map(list, zip(*part, strict=True))))
            seen.clear()

        for text, toxic in rows(batches, "text", "toxic"):
            own = words(text)
            for i, w in enumerate(own):
                for feature in (b"w" + w, b"p" + (beginning(w, length) or b"")):
                    if feature in to.value:
                        near = (own[i - 1] if i else b"") + b" " + (own[i + 1] if i + 1 < len(own) else b"")
                        seen.add((feature, toxic, xxhash.xxh3_64_intdigest(near) >> 1))
            if len(seen) > 300_000:
                yield from flush()
        yield from flush()

    every = training.mapInArrow(run, "feature binary, kind int, context bigint").distinct()
    return every.groupBy("feature").agg(F.sum("kind").cast("long").alias("toxic"), F.sum(1 - F.col("kind")).cast("long").alias("clean"))


def _scored(counted: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """Scores, z-scores and shares in either class."""
    n = n_toxic + n_clean

    def odds(share: float) -> Column:
        prior, weight = (F.col("toxic") + F.col("clean")) * share, share * n
        one = lambda y, of: F.log((F.col(y) + prior) / (of + weight - F.col(y) - prior))
        return one("toxic", n_toxic) - one("clean", n_clean)

    prior = lambda share: (F.col("toxic") + F.col("clean")) * share
    z = odds(PRIOR) / F.sqrt(1 / (F.col("toxic") + prior(PRIOR)) + 1 / (F.col("clean") + prior(PRIOR)))
    share = lambda y, of: ((F.col(y) + prior(SCORE_PRIOR)) / (of + SCORE_PRIOR * n))
    return counted.select("feature", odds(SCORE_PRIOR).alias("score"), z.alias("z"), share("clean", n_clean).alias("in_clean"), share("toxic", n_toxic).alias("in_toxic"))


def fit_lexicon(training: DataFrame, length: int = PREFIX, most: int = LEXICON) -> Lexicon:
    """Significant features only reach the driver; more than ``most`` of them are an error."""
    every = stored(counts(training, length))
    total = every.where("feature = X''").first()
    n_toxic, n_clean = (total["toxic"], total["clean"]) if total else (0, 0)
    if not n_toxic or not n_clean:
        return Lexicon({}, {}, -1e-3, 1.0, length)
    least = _normal_quantile(ALPHA / max(1, every.count()))
    strong = lambda counted: _scored(counted, n_toxic, n_clean).where((F.col("z") >= least) & (F.col("score") >= LEAST_SCORE))
    found = strong(every.where("feature <> X'' AND toxic > 0")).select("feature").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} words are significant; a lexicon of more has to be asked for")
    wanted = frozenset(bytes(r["feature"]) for r in found)
    kept = {bytes(r["feature"]): r for r in strong(contexts(training, wanted, length)).collect()} if wanted else {}
    by_word, by_prefix = ({f[1:]: r for f, r in kept.items() if f[:1] == kind} for kind in (b"w", b"p"))
    clean = sum(r["in_clean"] for r in by_word.values())
    toxic = sum(r["in_toxic"] for r in by_word.values())
    rest = min(-1e-3, math.log(max(1e-9, 1 - min(toxic, 0.9)) / max(1e-9, 1 - clean)))
    pairs = [(r["in_clean"], r["score"]) for r in by_word.values()]
    return Lexicon({w: r["score"] for w, r in by_word.items()}, {p: r["score"] for p, r in by_prefix.items()}, rest, _decay(pairs, rest), length)


def _normal_quantile(tail: float) -> float:
    """z with the given upper tail of the normal distribution."""
    low, high = 0.0, 40.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if 0.5 * math.erfc(middle / math.sqrt(2)) > tail else (low, middle)
    return low


def _decay(pairs: list[tuple[float, float]], rest: float) -> float:
    """The positive root of sum p exp(x s) = 1 over clean words."""
    if not pairs:
        return 1.0
    p, s = np.array([x for x, _ in pairs]), np.array([x for _, x in pairs])
    free = max(0.0, 1 - p.sum())
    low, high = 1e-6, 20.0
    for _ in range(80):
        middle = (low + high) / 2
        value = float((p * np.exp(np.minimum(middle * s, 700))).sum() + free * math.exp(middle * rest))
        low, high = (middle, high) if value < 1 else (low, middle)
    return low


def maximal_segments(hits: list[tuple[int, float]], rest: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score) in time linear in the hits.

    hits are the positions and positive scores; each word between them scores ``rest``. A held segment knows the last
    one before it with a lower sum on its left, so a search steps over those that can't be joined; and when no held
    segment has a lower sum than the new one, all of them are maximal and none is looked at again.
    """
    done: list[list] = []
    held: list[list] = []  # [first, last, sum before, sum after, place of the last one with a lower sum before]
    total, at = 0.0, -1
    for place, score in hits:
        total += rest * (place - at - 1)
        at = place
        new = [place, place, total, total + score, -1]
        total += score
        j = len(held) - 1
        while True:
            while j >= 0 and held[j][2] >= new[2]:
                j = held[j][4]
            if j < 0:
                done += held
                held = [new]
                break
            if held[j][3] >= new[3]:
                new[4] = j
                held.append(new)
                break
            new = [held[j][0], new[1], held[j][2], new[3], -1]
            before = held[j][4]
            del held[j:]
            j = before
    return [(a, b, after - before) for a, b, before, after, _ in done + held]


def segments(text: bytes | None, lexicon: Lexicon) -> tuple[int, list[tuple[int, int, float]]]:
    """Words of a text and its maximal segments."""
    own = words(text)
    known, begins, length = lexicon.words.get, lexicon.prefixes.get, lexicon.length or len(text or b"")
    hits = [(i, s) for i, w in enumerate(own) if (s := known(w) or (begins(w[:length] if w.isascii() else beginning(w, length)) if len(w) > length else None))]
    return len(own), maximal_segments(hits, lexicon.rest)


def with_segments(docs: DataFrame, lexicon: Lexicon, column: str = "_tl_found") -> DataFrame:
    """docs with a struct of n (words), and first, last, score of each segment."""
    to = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("n bigint, first array<int>, last array<int>, score array<double>")
    def find(text: pd.Series) -> pd.DataFrame:
        found = [segments(t.encode() if t else None, to.value) for t in text]
        return pd.DataFrame({"n": [n for n, _ in found], **{c: [[s[k] for s in own] for _, own in found] for k, c in enumerate(("first", "last", "score"))}})

    return docs.withColumn(column, find("text"))


def statistic(found: Column, decay: float, k: float) -> Column:
    """T; null without a segment."""
    floor = F.log(F.lit(k) * found["n"])
    one = F.transform(found["score"], lambda s: s * decay - floor)
    more = F.aggregate(one, F.lit(0.0), lambda a, x: a + F.greatest(x, F.lit(0.0)))
    best = F.array_max(one)
    return best + more - F.greatest(best, F.lit(0.0))


def calibrate(training: DataFrame, lexicon: Lexicon) -> Calibration:
    found = stored(with_segments(training, lexicon).select("toxic", F.struct(F.col("_tl_found.n").alias("n"), F.col("_tl_found.score").alias("score")).alias("found")))
    floor = min([*lexicon.words.values(), *lexicon.prefixes.values()], default=1.0)
    has, clean = F.size("found.score") > 0, F.col("toxic") == 0
    expected = F.col("found.n") * F.exp(-lexicon.decay * F.when(has, F.array_max("found.score")).otherwise(F.lit(floor)))
    sums = found.agg(F.sum(F.when(clean, expected)).alias("expected"), F.sum(F.when(clean & has, 1)).alias("hits"), F.sum(F.when(~has, F.col("toxic"))).alias("none_toxic"), F.sum(F.when(~has, 1)).alias("none")).first()
    k = (1 + (sums["hits"] or 0)) / max(1e-300, sums["expected"] or 1.0)
    t = statistic(F.col("found"), lexicon.decay, k)
    bins = found.where(F.size("found.score") > 0).select(F.least(F.greatest(F.round(t, 1), F.lit(-50.0)), F.lit(150.0)).alias("t"), "toxic").groupBy("t").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).collect()  # at most 2001 rows
    slope, intercept = _logistic([(r["t"], r["toxic"], r["n"]) for r in bins])
    return Calibration(k, ((sums["none_toxic"] or 0) + 0.5) / ((sums["none"] or 0) + 1) if sums["none"] else 0.25, slope, intercept)


def _logistic(points: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope (not negative) and intercept by Newton steps with a weak ridge."""
    if not points:
        return 1.0, 0.0
    t, y, n = (np.array(x, dtype=float) for x in zip(*points, strict=True))
    x = np.stack([np.ones_like(t), t / 10])
    weights, ridge = np.zeros(2), 0.05
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(weights @ x, -30, 30)))
        gradient = x @ (y - n * p) - ridge * weights
        curve = (x * (n * p * (1 - p))) @ x.T + ridge * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        size = np.abs(step).max()
        weights += step * min(1.0, 2.0 / max(size, 1e-12))
        if size < 1e-9:
            break
    return max(0.0, float(weights[1]) / 10), float(weights[0])


def probability(found: Column, lexicon: Lexicon, fit: Calibration) -> Column:
    t = statistic(found, lexicon.decay, fit.k)
    curve = 1 / (1 + F.exp(-(F.lit(fit.intercept) + F.lit(fit.slope) * t)))
    return F.when(F.size(found["score"]) == 0, F.lit(fit.none)).otherwise(curve)


def passages(found: Column, lexicon: Lexicon, fit: Calibration, chance: float = SIGNIFICANT) -> Column:
    """The segments (first and last word, score) that a clean text of that length holds with at most this chance."""
    least = -math.log(-math.log1p(-chance))  # the number of such segments is about Poisson with mean exp(-t)
    floor = F.log(F.lit(fit.k) * found["n"])
    return F.filter(F.arrays_zip(found["first"], found["last"], found["score"]), lambda s: s["score"] * lexicon.decay - floor >= least)


def choose_length(training: DataFrame, lengths: tuple[int, ...] = LENGTHS) -> int:
    """The length of beginnings with which a model of one half of the training rows has the least loss on the other; on a tie the least."""
    half, other = training.where("half = 0"), training.where("half = 1")
    losses = []
    for length in lengths:
        lexicon = fit_lexicon(half, length)
        p = probability(F.col("_tl_found"), lexicon, calibrate(half, lexicon))
        loss = -F.log(F.greatest(F.when(F.col("toxic") == 1, p).otherwise(1 - p), F.lit(1e-6)))
        losses.append((round(with_segments(other, lexicon).agg(F.avg(loss)).first()[0] or 0.0, 9), length))
    return min(losses)[1]


def score_toxicity(docs: DataFrame, labelled: DataFrame, labels: DataFrame, folds: int = 5, column: str = "_tl_score", segment_column: str | None = None) -> DataFrame:
    """docs with a probability of being toxic, and with their toxic passages if a column is named for them; the model is learned from ``labelled`` and ``labels``."""
    training = stored(training_rows(labelled, labels, folds))
    lexicon = fit_lexicon(training, choose_length(training))
    fit = calibrate(training, lexicon)
    found = with_segments(docs, lexicon)
    made = {column: probability(F.col("_tl_found"), lexicon, fit)}
    if segment_column:
        made[segment_column] = passages(F.col("_tl_found"), lexicon, fit)
    return found.withColumns(made).drop("_tl_found")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole document, and its toxic passages as first:last words, comma-joined."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    out = score_toxicity(docs, docs, labels, segment_column="_tl_passages")
    spans = F.concat_ws(",", F.transform("_tl_passages", lambda s: F.concat_ws(":", s["first"].cast("string"), s["last"].cast("string"))))
    score = F.col("_tl_score")
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), spans.alias("passages"))
