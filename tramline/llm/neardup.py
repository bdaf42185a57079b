"""N-gram Jaccard join with Bayesian candidate pruning (operator 6).

A text is the set of its shingles of five words. Equal texts are one class and
enter the join once. 128 MinHash values (16 bits kept of each) stand for a
class; classes whose values agree in a whole band of four meet in a bucket. A
bucket is cut into tiles and each pair of tiles is a task of its own, so a
bucket of any size is spread out. Within a tile pair a pair of classes is
looked at in the first band in which it meets, so once in all. Its values are
compared 16 at a time, and it is dropped as soon as the posterior probability
that its similarity reaches the threshold, under a uniform prior, falls below a
tolerance. The pairs that are left are verified on their shingles exactly.
Tiles hand on only a count of links for each class and a forest that spans
them, so pairs are never written out; the forest's components are the groups.

With bands of four, a pair of similarity 0.8 fails to meet with probability
(1 - 0.8^4)^32 < 1e-7. Texts of one to four words are one shingle. Equal texts
are one class, those without a word too; null and empty texts link to nothing
and are groups of their own rows. Ids are of any type that has an order; rows
with equal ids, or none, are rows like others. Of equal texts the least id
stands for the class (a tie: any row of that id). Texts of any length are
compared whole. Of the columns only the id and text are read; ``keep_one`` hands
on the others, its own names begin with ``_tl_``. An empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import Buffer, arrow_schema, rows, small, spread_join, stored, table, text_key, words

N_WORDS = 5
THRESHOLD = 0.8
VALUES = 128
BAND = 4
#: A pair is dropped when its similarity reaches the threshold with less than this probability.
TOLERANCE = 1e-6
#: Values that are compared before the posterior is looked at.
STEP = 16
#: Classes in a tile.
TILE = 256

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_hashes(own: list[bytes], n: int = N_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of n words; fewer words are one run."""
    if not own:
        return np.zeros(0, dtype=np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, own), dtype=np.uint64, count=len(own))
    n = min(n, len(one))
    count = len(one) - n + 1
    made = np.full(count, n, dtype=np.uint64)
    for k in range(n):
        made = (made ^ one[k : k + count]) * _M1
        made ^= made >> np.uint64(29)
    made *= _M2
    made ^= made >> np.uint64(32)
    return np.unique(made)


def shingles(text: bytes | None, n: int = N_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    return shingle_hashes(words(text), n)


@lru_cache
def _factors(values: int) -> np.ndarray:
    return np.random.default_rng(7).integers(1, 2**63, values, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(own: np.ndarray, values: int = VALUES) -> bytes:
    """``values`` MinHash values of 16 bits."""
    factors, least = _factors(values), np.full(values, np.iinfo(np.uint64).max, dtype=np.uint64)
    for s in range(0, len(own), 512):
        np.minimum(least, (own[s : s + 512, None] * factors).min(axis=0), out=least)
    least ^= least >> np.uint64(31)
    return ((least * _M2) >> np.uint64(48)).astype("<u2").tobytes()


@lru_cache
def least_matches(threshold: float, tolerance: float, values: int, step: int) -> dict[int, int]:
    """For each number of compared values, the fewest matches with which a pair stays.

    The posterior of the similarity s after m matches of n under a uniform prior
    is Beta(m + 1, n - m + 1); a 16-bit value matches by chance so seldom that
    s stands for the probability of a match.
    """
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = {}
    for n in range(step, values + 1, step):
        for m in range(n + 1):
            density = m * np.log(grid) + (n - m) * np.log1p(-grid)
            density = np.exp(density - density.max())
            if density[grid >= threshold].sum() / density.sum() >= tolerance:
                out[n] = m
                break
    return out


def classes(docs: DataFrame, id_column: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows: id, key) and (classes: key, id, signature): a class is a text, its id the least of its rows'; without words it has no signature."""
    source = docs.select(F.col(id_column).alias("id"), text_key().alias("key"), "text")
    id_type = source.schema["id"].dataType.simpleString()
    out = pa.schema([arrow_schema(source).field(0), ("key", pa.binary()), ("signature", pa.binary()), ("empty", pa.bool_())])

    def run(batches):
        buffer = Buffer(out)
        for one, key, text in rows(batches, "id", "key", "text"):
            own = shingles(text)
            buffer.add(one, key, signature(own) if len(own) else None, not text)
            if buffer.full:
                yield buffer.take()
        yield buffer.take()

    every = stored(source.mapInArrow(run, f"id {id_type}, key binary, signature binary, empty boolean"))
    of = every.where("NOT empty").groupBy("key").agg(F.min("id").alias("id"), F.min("signature").alias("signature"))
    return every.select("id", "key"), of


def tiles(of: DataFrame, values: int = VALUES, band: int = BAND, tile: int = TILE) -> DataFrame:
    """(band, bucket, a, b, left, right, key): classes of buckets with two or more, copied to every pair of tiles they are in."""
    width, bands = 2 * band, values // band
    pieces = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.substring(F.col("signature"), k * width + 1, F.lit(width)))
    entry = of.select("key", F.posexplode(pieces).alias("band", "piece"))
    entry = entry.select("key", "band", F.concat(F.unhex(F.lpad(F.hex("band"), 2, "0")), "piece").alias("bucket"))
    sizes = stored(entry.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    met = spread_join(entry, sizes, "bucket", "inner", sizes=sizes, total=bands * of.count())
    met = met.withColumn("tiles", F.ceil(F.col("n") / tile).cast("int")).withColumn("own", F.pmod(F.xxhash64("key", "band"), F.col("tiles")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return met.select("band", "bucket", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), (F.col("own") <= F.col("other")).alias("left"), (F.col("own") >= F.col("other")).alias("right"), "key")


def candidates(left: np.ndarray, right: np.ndarray, same: bool, band: int, width: int, keep: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (rows of left, rows of right) that first meet in this band and that the Bayesian test keeps."""
    pairs_a, pairs_b = [], []
    for s in range(0, len(left), 64):
        own = left[s : s + 64]
        a, b = np.divmod(np.arange(len(own) * len(right)), len(right))
        a = a + s
        if same:
            later = b > a
            a, b = a[later], b[later]
        for k in range(band):  # not if they met in an earlier band
            apart = (left[a, k * width : (k + 1) * width] != right[b, k * width : (k + 1) * width]).any(axis=1)
            a, b = a[apart], b[apart]
            if not len(a):
                break
        matches = np.zeros(len(a), dtype=np.int32)
        at = 0
        for n, least in keep.items():
            matches += (left[a, at:n] == right[b, at:n]).sum(axis=1, dtype=np.int32)
            stays = matches >= least
            a, b, matches, at = a[stays], b[stays], matches[stays], n
            if not len(a):
                break
        pairs_a.append(a)
        pairs_b.append(b)
    empty = np.zeros(0, dtype=np.int64)
    return (np.concatenate(pairs_a), np.concatenate(pairs_b)) if pairs_a else (empty, empty)


def verify(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """For each pair of sets whether their Jaccard similarity reaches the threshold, exactly."""
    sizes = np.array([len(s) for s in sets])
    if len(a) > 4 * len(sets):  # many pairs: shared counts of all from products of incidence matrices
        every, codes = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), sizes)
        often = np.bincount(codes, minlength=len(every)) > 1
        owner, codes = owner[often[codes]], (np.cumsum(often) - 1)[codes[often[codes]]]
        shared = np.zeros((len(sets), len(sets)), dtype=np.float32)
        order = np.argsort(codes, kind="stable")
        owner, codes = owner[order], codes[order]
        for s in range(0, int(often.sum()), 2048):
            lo, hi = np.searchsorted(codes, [s, s + 2048])
            part = np.zeros((len(sets), 2048), dtype=np.float32)
            part[owner[lo:hi], codes[lo:hi] - s] = 1
            shared += part @ part.T
        both = shared[a, b].astype(np.int64)
    else:
        both = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b, strict=True)], dtype=np.int64)
    return both >= threshold * (sizes[a] + sizes[b] - both) - 1e-9


def first_met(own: list[tuple], same: bool, band: int, keep: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """candidates() of the rows (key, left, right, signature) of a tile pair, as row numbers."""
    width = 2 * BAND
    if len(own) <= 8:
        pairs = []
        for x, (_, x_left, _, x_sig) in enumerate(own):
            for y, (_, _, y_right, y_sig) in enumerate(own):
                if x_left and y_right and (x < y if same else x != y) and not any(x_sig[k : k + width] == y_sig[k : k + width] for k in range(0, band * width, width)):
                    one, two = np.frombuffer(x_sig, "<u2"), np.frombuffer(y_sig, "<u2")
                    equal = np.cumsum(one == two)
                    if all(equal[n - 1] >= least for n, least in keep.items()):
                        pairs.append((x, y))
        out = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        return out[:, 0], out[:, 1]
    values = np.frombuffer(b"".join(o[3] for o in own), dtype="<u2").reshape(-1, VALUES)
    left, right = (np.flatnonzero([o[k] for o in own]) for k in (1, 2))
    a, b = candidates(values[left], values[right], same, band, BAND, keep)
    return left[a], right[b]


def links(docs: DataFrame, of: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """(key, n_links) of classes with links, and the edges (a, b) of a forest for each tile pair."""
    keep = least_matches(threshold, TOLERANCE, VALUES, STEP)
    group = ["band", "bucket", "a", "b"]
    met = tiles(of, tile=tile).join(of.select("key", "signature"), "key")
    met = met.select(*group, "key", "left", "right", "signature").repartition(*group).sortWithinPartitions(*group, "key")
    some = pa.schema([("band", pa.int32()), ("bucket", pa.binary()), ("a", pa.int32()), ("b", pa.int32()), ("place", pa.int32()), ("key", pa.binary()), ("pairs", pa.binary())])

    def compare(batches):
        buffer = Buffer(some)
        for where, own in groupby(rows(batches, *group, "key", "left", "right", "signature"), key=itemgetter(0, 1, 2, 3)):
            own = [r[4:] for r in own]
            a, b = first_met(own, where[2] == where[3], where[0], keep)
            if not len(a):
                continue
            # each class with a pair carries, as places, those that it comes before in a pair
            used, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
            first, second = codes[: len(a)], codes[len(a) :]
            order = np.argsort(first, kind="stable")
            cut = np.searchsorted(first[order], np.arange(len(used) + 1))
            second = second[order].astype("<i4")
            for place, row in enumerate(used.tolist()):
                buffer.add(*where, place, own[row][0], second[cut[place] : cut[place + 1]].tobytes())
            if buffer.full:
                yield buffer.take()
        yield buffer.take()

    survivors = stored(met.mapInArrow(compare, "band int, bucket binary, a int, b int, place int, key binary, pairs binary"))
    wanted = survivors.select("key").distinct()
    texts = docs.select(text_key().alias("key"), "text").join(small(wanted, 64), "key", "left_semi").dropDuplicates(["key"])
    whole = survivors.join(texts, "key").select(*group, "place", "key", "pairs", "text").repartition(*group).sortWithinPartitions(*group, "place")
    good = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("root", pa.binary())])

    def check(batches):
        buffer = Buffer(good)
        for _, own in groupby(rows(batches, *group, "key", "pairs", "text", step=64), key=itemgetter(0, 1, 2, 3)):
            keys, pairs, sets = [], [], []
            for *_, key, pair, text in own:
                keys.append(key)
                pairs.append(np.frombuffer(pair, dtype="<i4"))
                sets.append(shingles(text))
            a, b = np.repeat(np.arange(len(keys)), [len(p) for p in pairs]), np.concatenate(pairs)
            right = verify(sets, a, b, threshold)
            a, b = a[right], b[right]
            count = np.bincount(a, minlength=len(keys)) + np.bincount(b, minlength=len(keys))
            root = forest(len(keys), a, b)
            for x in np.flatnonzero(count).tolist():
                buffer.add(keys[x], int(count[x]), keys[root[x]])
            if buffer.full:
                yield buffer.take()
        yield buffer.take()

    verified = stored(whole.mapInArrow(check, "key binary, n bigint, root binary"))
    return verified.groupBy("key").agg(F.sum("n").alias("n_links")), verified.where("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b")).distinct()


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[int]:
    """For each of n nodes the least node that edges connect it with."""
    root = list(range(n))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = top(x), top(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    return [top(x) for x in range(n)]


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each node's component, by alternating large and small stars."""
    arcs = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while True:
        # large star: each greater neighbour goes to the least of the neighbourhood
        both = arcs.unionByName(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = spread_join(both, least, "u", "inner").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        # small star: the node and its lesser neighbours go to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        pointed = large.join(low, "u")
        after = stored(pointed.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(low.select("u", F.col("low").alias("v"))).distinct())
        moved = after.join(arcs, ["u", "v"], "left_anti").limit(1).count() + arcs.join(after, ["u", "v"], "left_anti").limit(1).count()
        arcs = after
        if not moved:
            break
    return arcs.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(id, key, root, class_id, copy_id, n_links) for every row of docs.

    copy_id is the least id of the rows with an equal text, class_id the least
    of all rows that links connect with it, n_links the number of different
    texts that are linked with the row's text. root stands for the class; it is
    null for rows of null or empty text, whose ids are their own.
    """
    every, of = classes(docs, id_column)
    of = stored(of)
    n_links, edges = links(docs, of.where("signature IS NOT NULL"), threshold, tile)
    member = components(edges).select(F.col("node").alias("key"), "root")
    rooted = of.select("key", F.col("id").alias("copy_id")).join(member, "key", "left").withColumn("root", F.coalesce("root", "key"))
    rooted = stored(rooted)
    low = rooted.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    known = spread_join(rooted, low, "root").join(n_links, "key", "left").select("key", "root", "class_id", "copy_id", "n_links")
    out = spread_join(every, known, "key")
    return out.select("id", "key", "root", F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("copy_id")).alias("copy_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with one row left of each class: one of its least id. Rows of null or empty text all stay."""
    found = near_duplicates(docs, threshold=threshold).where("root IS NOT NULL")
    each = stored(found.groupBy("root", "id", "key").agg(F.count("*").alias("n")))
    best = each.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "key")).alias("best"), F.count("*").alias("kinds"))
    best = best.where("kinds > 1").select("root", F.col("best.id").alias("best_id"), F.col("best.key").alias("best_key"))
    chosen = F.col("best_key").isNull() | (F.col("id").eqNullSafe(F.col("best_id")) & (F.col("key") == F.col("best_key")))
    marked = spread_join(each, stored(best), "root").select("id", "key", "n", chosen.alias("chosen"))
    marked = marked.select(F.col("id").alias("_tl_id"), F.col("key").alias("_tl_key"), "n", "chosen")

    def without(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = small(right.select("_tl_id", "_tl_key").distinct(), 80)
        same = (text_key(left["text"]) == right["_tl_key"]) & left["doc_id"].eqNullSafe(right["_tl_id"])
        return left.join(right, same, how)

    kept = without(docs, marked.where("NOT chosen"), "left_anti")
    repeated = marked.where("chosen AND n > 1")
    if repeated.limit(1).count():
        more = without(kept, repeated, "left_semi").withColumns({"_tl_id": F.col("doc_id"), "_tl_key": text_key()})
        kept = without(kept, repeated, "left_anti").unionByName(more.dropDuplicates(["_tl_id", "_tl_key"]).select(*docs.columns))
    return kept


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates among all documents: a class and a number of links for each."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "copy_id", "n_links")
