"""Quality rules with risk-controlled thresholds (operator 3), in DataFrame functions alone.

Every text gets counts of words, characters, symbols and repetitions. A rule
rejects a text whose feature, in thousandths, exceeds a cutoff. Cutoffs are
chosen for each stratum (language) on labelled rows: going from the loosest
cutoff to the strictest, each is tested by the exact binomial tail for the
hypothesis that it rejects more than its share of the good rows, and testing
stops at the first that can't be refuted. So within a rule no correction is
needed for the number of cutoffs; across rules and strata the level is divided
by their number (Bonferroni), and each rule may reject RISK / rules of the good
rows of a stratum. With confidence 1 - LEVEL no stratum loses more than RISK of
those of its good texts that pass the base. Of the cutoffs that passed, the one
that tells good from poor rows best is used; a rule without any is off in that
stratum.

A trial is a distinct text of a stratum: copies of one text are one trial, good
only if all of them are. The guarantee is for texts drawn independently as the
labelled ones were; near copies, which no digest tells, count as trials of their
own. Every language is a stratum, however many there are; the level is divided
by the number of those with enough good texts to refute any cutoff, and the
others, where no test can succeed, have no rules.

Null and empty texts have no words and fail the base. A null language is the
language ''. Every row is judged, repeated rows alike; of cutoffs that tie the
loosest is used. Labels that repeat for an id count as good only if all say so.
Without labels only the base decides. Texts of any length are counted whole. Of
the columns only doc_id, text and lang are read. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm.common import join_labels, small, stored, table, text_key

#: Share of a stratum's good rows that all rules together may reject.
RISK = 0.05
#: Chance that this fails in any stratum.
LEVEL = 0.05
#: Cutoffs in thousandths, loosest first.
CUTOFFS = (1000, 900, 800, 700, 600, 500, 400, 350, 300, 250, 200, 160, 130, 100, 80, 60, 50, 40, 30, 20, 15, 10, 5)
#: Features: a count, and the count that it is taken in thousandths of.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "shouts": ("n_shouts", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
    "lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}
#: How many times worse it is to reject a share of the good than to keep that share of the poor.
DEAR = 20

_WORDS = r"array_remove(split(coalesce(text, ''), '[ \\t-\\r]+'), '')"
_LINES = r"filter(split(coalesce(text, ''), '\n'), x -> btrim(x, ' \t\u000b\u000c\r') <> '')"
#: Words in windows of eight whose hash stands twice; the fast way out is a text without such.
_REPEATS = """
  case when size(w) < 9 then 0L else
  transform(array(transform(w, x -> xxhash64(x))), h ->
    transform(array(transform(sequence(0, size(h) - 8), i -> xxhash64(h[i], h[i + 1], h[i + 2], h[i + 3], h[i + 4], h[i + 5], h[i + 6], h[i + 7]))), v ->
      case when size(array_distinct(v)) = size(v) then 0L else
      transform(array(array_sort(transform(v, (x, i) -> struct(x, i)))), p ->
        aggregate(
          array_sort(transform(filter(sequence(0, size(p) - 1), k -> (k > 0 and p[greatest(k - 1, 0)].x = p[k].x) or (k < size(p) - 1 and p[least(k + 1, size(p) - 1)].x = p[k].x)), k -> p[k].i)),
          named_struct('last', -8, 'n', 0L),
          (a, i) -> named_struct('last', i, 'n', a.n + cast(least(8, i - a.last) as bigint))).n)[0]
      end)[0])[0]
  end
"""


def count_features(docs: DataFrame) -> DataFrame:
    """doc_id, stratum (the language, '' without such a column), the text's digest and the counts of every text."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", lang.alias("stratum"), text.alias("text"), F.expr(_WORDS).alias("w"), F.expr(_LINES).alias("l"))
    less = lambda pattern: (F.length("text") - F.length(F.regexp_replace("text", pattern, ""))).cast("long")
    return split.select(
        "doc_id",
        "stratum",
        text_key().alias("digest"),
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        less(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.expr(_REPEATS).alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
        (F.length("text") - F.length(F.replace("text", F.lit("!"), F.lit("")))).cast("long").alias("n_shouts"),
        less(r"[\p{Lu}]+").alias("n_capitals"),
    ).withColumn("base_failed", F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words"))


def _feature(rule: str) -> Column:
    part, whole = RULES[rule]
    return F.expr(f"(1000 * {part}) div greatest({whole}, 1)")


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), by summing its terms in logarithms."""
    odds = math.log(p / (1 - p))
    start = F.struct((n * math.log(1 - p)).alias("t"), F.exp(n * math.log(1 - p)).alias("s"))
    step = lambda a, j: F.struct((a["t"] + F.log((n - j + 1) / j) + odds).alias("t"), (a["s"] + F.exp(a["t"] + F.log((n - j + 1) / j) + odds)).alias("s"))
    return F.aggregate(F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")), start, step, lambda a: a["s"])


def trials(labelled: DataFrame) -> DataFrame:
    """One row for each distinct text of a stratum that passes the base; good if all its rows are."""
    counts = [c for c in labelled.columns if c not in ("doc_id", "stratum", "digest", "quality")]
    each = labelled.where("NOT base_failed").groupBy("stratum", "digest")
    return each.agg(F.min("quality").alias("quality"), *(F.first(c).alias(c) for c in counts))


def testable(tried: DataFrame, risk: float = RISK, level: float = LEVEL) -> int:
    """How many strata have so many good trials that a cutoff which rejects none of them is refuted."""
    good = tried.where("quality = 1").groupBy("stratum").agg(F.count("*").alias("n"))  # one row for each language
    ranked = good.withColumn("i", F.row_number().over(Window.orderBy(F.desc("n"), "stratum")))
    refuted = F.col("n") * math.log(1 - risk / len(RULES)) <= F.log(F.lit(level / len(RULES)) / F.col("i"))
    return ranked.where(refuted).count()


def choose_cutoffs(labelled: DataFrame, n_strata: int, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """(stratum, rule, cutoff) from trials with stratum, quality (1 good, 0 poor) and the counts; base failures don't count."""
    share = risk / len(RULES)
    loosest = F.array(*(F.lit(c) for c in CUTOFFS))
    features = F.array(*(F.struct(F.lit(r).alias("rule"), _feature(r).alias("value")) for r in RULES))
    one = labelled.where("NOT base_failed").select("stratum", "quality", F.explode(features).alias("f"))
    # the first cutoff that rejects the row; one past the last if none does
    one = one.select("stratum", "quality", "f.rule", F.size(F.filter(loosest, lambda c: F.col("f.value") <= c)).alias("place"))
    each = one.groupBy("stratum", "rule", "place").agg(F.sum("quality").cast("long").alias("good"), F.sum(1 - F.col("quality")).cast("long").alias("poor"))
    totals = each.groupBy("stratum", "rule").agg(F.sum("good").alias("n_good"), F.sum("poor").alias("n_poor"), F.collect_list(F.struct("place", "good", "poor")).alias("each"))
    grid = totals.select("stratum", "rule", "n_good", "n_poor", "each", F.posexplode(loosest).alias("place", "cutoff"))
    upto = lambda field: F.aggregate(F.filter("each", lambda e: e["place"] <= F.col("place")), F.lit(0).cast("long"), lambda a, e: a + e[field])
    grid = grid.select("stratum", "rule", "place", "cutoff", "n_good", "n_poor", upto("good").alias("k_good"), upto("poor").alias("k_poor"))
    tail = F.when(F.col("k_good") <= share * F.col("n_good"), binomial_tail(F.col("n_good"), F.col("k_good"), share)).otherwise(1.0)
    passed = grid.withColumn("fails", (tail > level / (n_strata * len(RULES))).cast("int"))
    in_order = Window.partitionBy("stratum", "rule").orderBy("place")
    passed = passed.withColumn("failed", F.sum("fails").over(in_order)).where("failed = 0")
    merit = F.col("k_poor") / F.greatest("n_poor", F.lit(1)) - DEAR * F.col("k_good") / F.greatest("n_good", F.lit(1))
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc(F.round("merit", 9)), "place")
    return passed.withColumn("merit", merit).where("k_poor > 0").withColumn("rank", F.row_number().over(best)).where("rank = 1").select("stratum", "rule", F.col("cutoff").cast("long").alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """doc_id, the counts, base_failed and kept for every row of docs."""
    counted = stored(count_features(docs))
    quality = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("quality"))
    tried = stored(trials(join_labels(counted, quality, 32)))
    cutoffs = choose_cutoffs(tried, max(1, testable(tried, risk, level)), risk, level)
    cutoffs = stored(cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")))
    ruled = counted.join(small(cutoffs, 400), "stratum", "left")
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(_feature(rule) > F.col("cutoffs")[rule], F.lit(False))
    return ruled.withColumn("kept", ~F.col("base_failed") & ~rejected).drop("stratum", "digest", "cutoffs")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole document."""
    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_SQL_RULES = ", ".join(f"('{rule}', (1000 * {part}) // greatest({whole}, 1))" for rule, (part, whole) in RULES.items())
ORACLE_SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
s AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
win AS (SELECT r, i, list_aggregate(w[i:i + 7], 'string_agg', ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM s WHERE len(w) >= 8)),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM win JOIN (SELECT r, g FROM win GROUP BY r, g HAVING count(*) > 1) USING (r, g)) GROUP BY r),
c AS (
  SELECT r, doc_id, stratum, text, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(l) AS BIGINT) AS n_lines, CAST(length(text) - length(replace(text, '!', '')) AS BIGINT) AS n_shouts,
    CAST(length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS BIGINT) AS n_capitals
  FROM s LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c),
q AS (SELECT doc_id, CAST(min(quality) > 0 AS INT) AS quality FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
lab AS (SELECT min(r) AS r, stratum, min(quality) AS quality FROM f JOIN q USING (doc_id) WHERE NOT base_failed GROUP BY stratum, text),
strata AS (
  SELECT greatest(1, count(*)) AS m FROM (SELECT count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, stratum) AS i FROM lab WHERE quality = 1 GROUP BY stratum)
  WHERE n * ln(1 - {RISK / len(RULES)!r}) <= ln({LEVEL / len(RULES)!r} / i)),
v AS (SELECT f.r, stratum, base_failed, u.rule, u.value FROM f, LATERAL (SELECT * FROM (VALUES {_SQL_RULES}) AS x(rule, value)) AS u),
cut(place, cutoff) AS (VALUES {", ".join(f"({i}, {c})" for i, c in enumerate(CUTOFFS))}),
g AS (
  SELECT stratum, rule, place, cutoff, sum(quality) AS n_good, sum(1 - quality) AS n_poor,
    coalesce(sum(quality) FILTER (value > cutoff), 0) AS k_good, coalesce(sum(1 - quality) FILTER (value > cutoff), 0) AS k_poor
  FROM v JOIN (SELECT r, quality FROM lab) USING (r), cut WHERE NOT base_failed GROUP BY ALL),
tails AS (
  SELECT g.*, CASE WHEN k_good <= {RISK / len(RULES)!r} * n_good THEN
    (SELECT sum(exp(lgamma(n_good + 1) - lgamma(j + 1) - lgamma(n_good - j + 1) + j * ln({RISK / len(RULES)!r}) + (n_good - j) * ln(1 - {RISK / len(RULES)!r}))) FROM (SELECT unnest(range(0, CAST(k_good AS BIGINT) + 1)) AS j))
    ELSE 1 END AS tail FROM g),
ok AS (
  SELECT * FROM (SELECT *, max(CAST(tail > {LEVEL!r} / ((SELECT m FROM strata) * {len(RULES)}) AS INT)) OVER (PARTITION BY stratum, rule ORDER BY place) AS failed FROM tails)
  WHERE failed = 0 AND k_poor > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY round(k_poor / greatest(n_poor, 1) - {DEAR} * k_good / greatest(n_good, 1), 9) DESC, place) = 1),
rej AS (SELECT r, bool_or(coalesce(value > cutoff, false)) AS rejected FROM v LEFT JOIN (SELECT stratum, rule, cutoff FROM ok) USING (stratum, rule) GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept
FROM f JOIN rej USING (r)
"""
