"""Near duplicates by SuperMinHash signatures (operator 12).

A text is the set of its shingles of five words. Rows of equal sets are one
class. The signature of a class is a SuperMinHash: every element deals the slots
out in a random order of its own, and its value in the slot at rank j lies
between j and j + 1; a slot keeps its least value. The values of one element are
thus correlated so that its draws fall into different slots, which makes the
estimate of similarity less scattered than that of independent values, and no
element goes beyond the rank of the largest value that is still kept, which for
sets larger than the signature is one rank or two. Classes whose values agree in
a whole band of four meet in a bucket.

Only groups are asked for, so links that join what is joined already need no
look. First every class of a bucket is verified against the bucket's pivot, the
class that meets most others: a group of n copies costs n verifications, and a
pivot of any number of classes is spread over chunks. Union-find makes groups of these links.
A bucket that is one group then is done. In the others the classes that are
outside the pivot's group are compared with all others of the bucket, tile by
tile: signatures first, and of the pairs that may be links the likelier first,
each verified unless union-find has joined its sides by then. Links are confirmed
on whole sets, and the components of all links are the groups.

With bands of four of 128 values a pair of similarity 0.85 fails to meet with
probability (1 - 0.85^4)^32 < 1e-10, and agrees in fewer values than are asked
for before verification with less than MISS.

Words are lower-cased (A-Z) and end at ASCII blanks only. A text of fewer than
five words is one shingle; one without words, or null, has an empty set, is
linked with nothing and stands alone in its row. Ids are of any type that has an
order. Equal ids are rows like others; of a group without any id the id is null,
and its rows are kept. Texts of any length are read whole. Of the columns only
id and text are read, whatever others are called. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm.common import LOWER_BYTES, Buffer, arrow_schema, rows, small, spread_join, stored, table, text_key
from tramline.llm.neardup import components, shingle_hashes

#: Links: so many hundredths of the union are shared at least.
SHARED = 85
VALUES, BAND = 128, 4
#: A link may be lost before verification with this probability at most.
MISS = 1e-9
#: Classes that are verified against a pivot in one group of rows, and classes of a tile.
CHUNK, TILE = 256, 512
#: Elements whose orders are drawn together.
BLOCK = 4096

_STEP = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOW, _HALF = np.uint64(0xFFFFFFFF), np.uint64(32)


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    return shingle_hashes(text.translate(LOWER_BYTES).split() if text else [])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def ranked_values(own: np.ndarray, values: int = VALUES) -> np.ndarray:
    """Of each slot the least of rank (upper half) and fraction (lower half) over all elements."""
    least = np.full(values, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(own), BLOCK):
        part = own[start : start + BLOCK]
        row = np.arange(len(part))
        order = np.tile(np.arange(values, dtype=np.uint8 if values <= 256 else np.uint32), (len(part), 1))
        rank = 0
        while rank < values and rank <= int(least.max() >> _HALF):
            drawn = _mixed(part + np.uint64(_STEP * (rank + 1) % 2**64))
            place = rank + ((drawn & _LOW) * np.uint64(values - rank) >> _HALF).astype(np.int64)
            slot = order[row, place]
            order[row, place] = order[:, rank]
            np.minimum.at(least, slot, np.uint64(rank << 32) | drawn >> _HALF)
            rank += 1
    return least


def signature(own: np.ndarray, values: int = VALUES) -> bytes:
    """16 bits for each slot's value."""
    return (_mixed(ranked_values(own, values)) >> np.uint64(48)).astype("<u2").tobytes()


@lru_cache
def least_matches(shared: int, values: int = VALUES, miss: float = MISS) -> int:
    """The most equal values that can be asked for so that a pair at the threshold has fewer with probability ``miss`` at most."""
    s, below = shared / 100, 0.0
    for m in range(values + 1):
        below += math.comb(values, m) * s**m * (1 - s) ** (values - m)
        if below > miss:
            return m
    return values


def linked(a: np.ndarray, b: np.ndarray, shared: int) -> bool:
    """Whether two sets share so many hundredths of their union."""
    if 100 * min(len(a), len(b)) < shared * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= shared * (len(a) + len(b) - both)


def classes(docs: DataFrame, id_column: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows: id, key, n) and (classes: key, id, rep, signature): key stands for a set, rep for one text of it; empty sets have no key."""
    source = docs.select(F.col(id_column).alias("id"), text_key().alias("rep"), "text")
    id_type = source.schema["id"].dataType.simpleString()
    out = pa.schema([arrow_schema(source).field(0), ("key", pa.binary()), ("n", pa.int64()), ("rep", pa.binary()), ("signature", pa.binary())])

    def run(batches):
        buffer = Buffer(out)
        for one, rep, text in rows(batches, "id", "rep", "text"):
            own = shingles(text)
            buffer.add(one, hashlib.md5(own.tobytes()).digest() if len(own) else None, len(own), rep, signature(own) if len(own) else None)
            if buffer.full:
                yield buffer.take()
        yield buffer.take()

    every = stored(source.mapInArrow(run, f"id {id_type}, key binary, n bigint, rep binary, signature binary"))
    of = stored(every.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("id"), F.min("rep").alias("rep"), F.min("signature").alias("signature")))
    return every.select("id", "key", "n"), of


def meetings(of: DataFrame, values: int = VALUES, band: int = BAND) -> DataFrame:
    """(bucket, key, band, n, pivot) of each class in each bucket of two or more.

    The pivot of a bucket is the class that meets most others in all of its buckets, of equal ones the least. What most
    copies were made of shares more bands with them than they share with one another, so it has links to most, and
    few are left for the tiles; buckets of one group have one pivot, so its pairs are verified once.
    """
    width, bands = 2 * band, values // band
    pieces = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.substring(F.col("signature"), k * width + 1, F.lit(width)))
    entry = of.select("key", F.posexplode(pieces).alias("band", "piece"))
    entry = entry.select("key", "band", F.concat(F.unhex(F.lpad(F.hex("band"), 2, "0")), "piece").alias("bucket"))
    sizes = stored(entry.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    # a row of a bucket streams past one row of the right side; Spark splits the partition of a hot bucket
    shared = entry.join(sizes, "bucket").withColumn("weight", F.sum("n").over(Window.partitionBy("key")))
    shared = stored(shared.select("bucket", "key", "band", "n", "weight"))
    pivots = stored(shared.groupBy("bucket").agg(F.min(F.struct((-F.col("weight")).alias("w"), "key"))["key"].alias("pivot")))
    return stored(shared.join(pivots, "bucket").select("bucket", "key", "band", "n", "pivot"))


def texts_of(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """needed (with rep) and the text of each row's rep."""
    texts = docs.select(text_key().alias("rep"), "text").join(small(needed.select("rep").distinct(), 64), "rep", "left_semi").dropDuplicates(["rep"])
    return spread_join(needed, texts, "rep", "inner")


def pivot_links(docs: DataFrame, of: DataFrame, met: DataFrame, shared: int) -> DataFrame:
    """(a, b): links between pivots and the classes of their buckets."""
    least = least_matches(shared)
    pair = pa.schema([("pivot", pa.binary()), ("key", pa.binary())])
    stars = stored(met.where("key <> pivot").select("pivot", "key").distinct())
    signed = spread_join(stars.join(of.select("key", "signature"), "key"), of.select(F.col("key").alias("pivot"), F.col("signature").alias("other")), "pivot", "inner")

    def alike(batches):
        buffer = Buffer(pair)
        for pivot, key, one, other in rows(batches, "pivot", "key", "signature", "other"):
            if np.count_nonzero(np.frombuffer(one, "<u2") == np.frombuffer(other, "<u2")) >= least:
                buffer.add(pivot, key)
            if buffer.full:
                yield buffer.take()
        yield buffer.take()

    pairs = stored(signed.select("pivot", "key", "signature", "other").mapInArrow(alike, "pivot binary, key binary"))
    chunks = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    dealt = stored(spread_join(pairs, chunks, "pivot", "inner").select("pivot", "key", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int").alias("chunk")))
    wanted = dealt.withColumn("member", F.lit(1)).unionByName(dealt.select("pivot", "chunk").distinct().withColumns({"key": F.col("pivot"), "member": F.lit(0)}))
    whole = texts_of(docs, stored(spread_join(wanted, of.select("key", "rep"), "key", "inner")))
    whole = whole.select("pivot", "chunk", "member", "key", "text").repartition("pivot", "chunk").sortWithinPartitions("pivot", "chunk", "member")
    edge = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def check(batches):
        buffer, at, base = Buffer(edge), None, None
        for pivot, chunk, member, key, text in rows(batches, "pivot", "chunk", "member", "key", "text", step=64):
            own = shingles(text)
            if not member:
                at, base = (pivot, chunk), own
            elif at == (pivot, chunk) and linked(base, own, shared):
                buffer.add(pivot, key)
            if buffer.full:
                yield buffer.take()
        yield buffer.take()

    return stored(whole.mapInArrow(check, "a binary, b binary"))


def labelled(of: DataFrame, edges: DataFrame) -> DataFrame:
    """(key, label): the least class of each class's group."""
    member = components(edges).select(F.col("node").alias("key"), F.col("root").alias("label"))
    return stored(of.select("key").join(member, "key", "left").select("key", F.coalesce("label", "key").alias("label")))


def cells(met: DataFrame, labels: DataFrame, tile: int) -> DataFrame:
    """(band, bucket, i, j, key, label, side): classes outside the pivot's group (side 0, tile i) and all classes (side 1, tile j) of unfinished buckets."""
    pivots = labels.select(F.col("key").alias("pivot"), F.col("label").alias("pivot_label"))
    of_bucket = met.where("n > 2").join(labels, "key")
    own = spread_join(of_bucket, pivots, "pivot", "inner").withColumn("apart", F.col("label") != F.col("pivot_label"))
    own = stored(own.select("bucket", "band", "key", "label", "n", "apart"))
    left = stored(own.groupBy("bucket").agg(F.count_if("apart").alias("r")).where("r > 0"))
    own = spread_join(own, left, "bucket", "inner")
    across, down = F.ceil(F.col("n") / tile).cast("int"), F.ceil(F.col("r") / tile).cast("int")
    own = own.withColumns({"across": across, "down": down, "hash": F.xxhash64("key", "band")})
    row, column = F.pmod("hash", F.col("down")).cast("int"), F.pmod("hash", F.col("across")).cast("int")
    first = own.where("apart").withColumns({"i": row, "j": F.explode(F.sequence(F.lit(0), F.col("across") - 1)), "side": F.lit(0)})
    second = own.withColumns({"i": F.explode(F.sequence(F.lit(0), F.col("down") - 1)), "j": column, "side": F.lit(1)})
    columns = ["band", "bucket", "i", "j", "key", "label", "side", "apart"]
    return first.select(*columns).unionByName(second.select(*columns))


def likely(one: list[tuple], two: list[tuple], band: int, least: int) -> list[tuple[int, int, int]]:
    """(equal values, place in one, place in two) of pairs of different groups that first meet in this band and may be links.

    Rows are (key, label, apart, signature). A pair of which both sides are apart is in both orders among the rows, and taken in one.
    """
    a, b = (np.frombuffer(b"".join(r[3] for r in side), "<u2").reshape(len(side), -1) for side in (one, two))
    out = []
    for start in range(0, len(a), 16):
        equal = a[start : start + 16, None, :] == b[None, :, :]
        matches = np.count_nonzero(equal, axis=2)
        for x, y in zip(*np.nonzero(matches >= least), strict=True):
            (key, label, _, _), (other, other_label, apart, _) = one[start + x], two[y]
            if label != other_label and not (apart and key > other) and not equal[x, y, : band * BAND].reshape(-1, BAND).all(axis=1).any():
                out.append((int(matches[x, y]), start + int(x), int(y)))
    return out


def rest_links(docs: DataFrame, of: DataFrame, met: DataFrame, labels: DataFrame, shared: int, tile: int = TILE) -> DataFrame:
    """(a, b): links that join what the links with pivots have left apart."""
    least = least_matches(shared)
    where = ["band", "bucket", "i", "j"]
    signed = cells(met, labels, tile).join(of.select("key", "signature"), "key").select(*where, "side", "key", "label", "apart", "signature")
    signed = signed.repartition(*where).sortWithinPartitions(*where, "side")
    some = pa.schema([("band", pa.int32()), ("bucket", pa.binary()), ("i", pa.int32()), ("j", pa.int32()), ("side", pa.int32()), ("key", pa.binary()), ("label", pa.binary()), ("apart", pa.bool_())])

    def sides(own) -> tuple[list, list]:
        out = [], []
        for *_, side, key, label, apart, sig in own:
            out[side].append((key, label, apart, sig))
        return out

    def compare(batches):
        buffer = Buffer(some)
        for at, own in groupby(rows(batches, *where, "side", "key", "label", "apart", "signature"), key=itemgetter(0, 1, 2, 3)):
            both = sides(own)
            pairs = likely(*both, at[0], least) if all(both) else []
            for side in (0, 1):
                for place in sorted({p[1 + side] for p in pairs}):
                    buffer.add(*at, side, *both[side][place][:3])
            if buffer.full:
                yield buffer.take()
        yield buffer.take()

    kept = stored(signed.mapInArrow(compare, "band int, bucket binary, i int, j int, side int, key binary, label binary, apart boolean"))
    whole = texts_of(docs, kept.join(of.select("key", "rep", "signature"), "key"))
    whole = whole.select(*where, "side", "key", "label", "apart", "signature", "text").repartition(*where).sortWithinPartitions(*where, "side")
    edge = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def check(batches):
        buffer = Buffer(edge)
        for at, own in groupby(rows(batches, *where, "side", "key", "label", "apart", "signature", "text", step=64), key=itemgetter(0, 1, 2, 3)):
            sets, plain = {}, []
            for *row, text in own:
                if row[5] not in sets:
                    sets[row[5]] = shingles(text)
                plain.append(row)
            one, two = sides(plain)
            top = {}

            def root(x: bytes) -> bytes:
                while top.get(x, x) != x:
                    top[x] = top.get(top[x], top[x])
                    x = top[x]
                return x

            for _, x, y in sorted(likely(one, two, at[0], least), reverse=True):
                (key, label, *_), (other, other_label, *_) = one[x], two[y]
                a, b = root(label), root(other_label)
                if a != b and linked(sets[key], sets[other], shared):
                    top[max(a, b)] = min(a, b)
                    buffer.add(key, other)
            if buffer.full:
                yield buffer.take()
        yield buffer.take()

    return stored(whole.mapInArrow(check, "a binary, b binary"))


def near_duplicate_groups(docs: DataFrame, id_column: str = "doc_id", shared: int = SHARED, tile: int = TILE) -> DataFrame:
    """(id, n, component_id, root) of every row: size of its set, least id of its group, and the class that stands for the group (null: no words)."""
    every, of = classes(docs, id_column)
    met = meetings(of)
    first = pivot_links(docs, of, met, shared)
    second = rest_links(docs, of, met, labelled(of, first), shared, tile)
    labels = labelled(of, first.unionByName(second)).join(of.select("key", "id"), "key")
    low = labels.groupBy("label").agg(F.min("id").alias("component_id"))
    known = stored(spread_join(labels.select("key", "label"), low, "label", "inner"))
    out = spread_join(every, known, "key")
    return out.select("id", "n", F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"), F.col("label").alias("root"))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the groups that links of similarity 0.85 or more make, the one of the least id being kept."""
    found = near_duplicate_groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE_SQL = """
WITH RECURSIVE source AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
         ELSE list_transform(range(1, len(words) - 3), lambda k: array_to_string(words[k:k + 4], ' ')) END) AS shingles
  FROM source
), items AS (
  SELECT doc_id, unnest(shingles) AS shingle FROM sets
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM shared JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y WHERE 100 * n >= 85 * (len(p.shingles) + len(q.shingles) - n)
), arcs AS (
  SELECT x, y FROM links UNION SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sets UNION SELECT r.x, a.y FROM reach r JOIN arcs a ON a.x = r.y
)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sets s JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) r USING (doc_id)
"""
