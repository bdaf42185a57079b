"""Conversation prefix trie by smallest-member ownership (operator 13).

A node is a distinct beginning of conversations, from the root without turns;
the conversations that begin with it are its members, and the smallest of them
owns it. As members only get fewer on the way down, a conversation owns a suffix
of its path, which may be empty, and every node has one owner. So what a node's
subtree holds needs no walk over the trie: a member adds all that its own path
has from the node on, less what of that it owns, and one flag if it owns a leaf.
All numbers of all nodes come from one group-by over prefixes:

* saved_tokens: sum over members of the code points between node and owned suffix;
* n_leaves: sum over members of the flag of an owned leaf;
* n_children: members that own the next node of their path.

A prefix is known by its depth and by the running sum, over its turns, of 128
bits of a hash of place and content, which windows over conversations make. A
window covers one conversation's rows of one range of the sorted table, and the
sums of earlier ranges are added, so a conversation of any length is spread over
tasks. The smallest member of a prefix is a partial aggregate and never a window
over the prefix, whose members may be all conversations. Texts are hashed and
measured where they are read and never shuffled. The digest of the ids that end
at a node is fed in order from pieces of PIECE characters that the sorted ranges
join, so no list of ids is ever in memory.

Turns go by their number, null first; equal numbers by role, then by a digest of
role and text. Null roles and texts are empty, and so is a text of any length
whole. Rows that repeat are turns like others. Rows without conv_id belong to no
conversation and are left out; ids may be negative, the base being the next
multiple at or below. Columns besides conv_id, turn, role and text are not read,
whatever they are called. An empty table has no conversation and gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm.common import Buffer, rows, spread_join, stored, table

#: A conversation takes its first turns from the next multiple of FAMILY at or below its id, fewer than HEADS of them.
FAMILY, HEADS = 100, 6
#: Characters of ids in one piece.
PIECE = 1 << 16

_SUMS = ["s0", "s1", "s2", "s3"]
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def running(df: DataFrame, group: str, order: list[str], sums: dict[str, str]) -> DataFrame:
    """df with running sums (new name: column) over the rows of each group in an order; a group of any size is spread over ranges."""
    laid = stored(df.withColumn("_tl_tie", F.monotonically_increasing_id()).repartitionByRange(group, *order, "_tl_tie").withColumn("_tl_range", F.spark_partition_id()))
    here = Window.partitionBy("_tl_range", group).orderBy(*order, "_tl_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(group).orderBy("_tl_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = laid.groupBy(group, "_tl_range").agg(*(F.sum(c).alias(f"_tl_{new}") for new, c in sums.items()))
    before = totals.select(group, "_tl_range", *(F.sum(f"_tl_{new}").over(earlier).alias(f"_tl_{new}") for new in sums)).where(F.col(f"_tl_{next(iter(sums))}").isNotNull())
    # one group at most goes on from an earlier range into each, so there are fewer rows than ranges
    summed = laid.select("*", *(F.sum(c).over(here).alias(new) for new, c in sums.items())).join(F.broadcast(before), [group, "_tl_range"], "left")
    return summed.withColumns({new: F.col(new) + F.coalesce(f"_tl_{new}", F.lit(0)) for new in sums}).drop("_tl_tie", "_tl_range", *(f"_tl_{new}" for new in sums))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length, depth, item, chars) of every turn of the rebuilt conversations and of a root for each, and (conv_id, length)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    item = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turns = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), item.alias("item"), F.length(text).cast("bigint").alias("chars"), F.lit(1).cast("bigint").alias("one"))
    turns = turns.where("conv_id IS NOT NULL")
    own = stored(running(turns, "conv_id", ["turn", "role", "item"], {"place": "one"}).select("conv_id", "place", "item", "chars"))
    sizes = own.groupBy("conv_id").agg(F.max("place").alias("n"))
    heads = own.where(F.col("place") < HEADS).groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("place", "item", "chars"))).alias("head"))
    known = sizes.select("conv_id", "n", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h"), (F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))).alias("base")).join(heads, "base", "left")
    known = known.withColumn("lead", F.slice(F.coalesce("head", F.array().cast("array<struct<place:bigint,item:binary,chars:bigint>>")), F.lit(1), F.col("h").cast("int")))
    known = stored(known.select("conv_id", "n", "h", "lead", (F.size("lead") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    tail = spread_join(own, known.select("conv_id", "h", F.size("lead").alias("m"), "length"), "conv_id", "inner", sizes=known.select("conv_id", "n"), total=own.count())
    tail = tail.where("place > h").select("conv_id", "length", (F.col("place") - F.col("h") + F.col("m")).alias("depth"), "item", "chars")
    lead = known.select("conv_id", "length", F.posexplode("lead").alias("at", "turn")).select("conv_id", "length", (F.col("at") + 1).cast("bigint").alias("depth"), "turn.item", "turn.chars")
    root = known.select("conv_id", "length", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("binary").alias("item"), F.lit(0).cast("bigint").alias("chars"))
    return root.unionByName(lead).unionByName(tail), known.select("conv_id", "length")


def paths(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length, depth, key, parent, chars, read) of every place of a path, and (conv_id, length); read counts the code points up to and with the place."""
    places, lengths = rebuilt(conversations)
    hashes = [F.xxhash64(F.lit(k), F.col("depth"), F.col("item")) for k in (1, 2)]
    halves = [h for x in hashes for h in (F.shiftrightunsigned(x, 32), x.bitwiseAND(F.lit(0xFFFFFFFF)))]
    places = places.withColumns({name: F.when(F.col("item").isNull(), F.lit(0)).otherwise(half).cast("bigint") for name, half in zip(_SUMS, halves, strict=True)})
    summed = running(places.drop("item"), "conv_id", ["depth"], {f"sum_{c}": c for c in _SUMS} | {"read": "chars"})

    def key(depth: Column, sums: list[Column]) -> Column:
        return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *(s.cast("string") for s in sums)).cast("binary")))

    sums = [F.col(f"sum_{c}") for c in _SUMS]
    parent = F.when(F.col("depth") > 0, key(F.col("depth") - 1, [s - F.col(c) for s, c in zip(sums, _SUMS, strict=True)]))
    return stored(summed.select("conv_id", "length", "depth", key(F.col("depth"), sums).alias("key"), parent.alias("parent"), "chars", "read")), lengths


def digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): of each key's ids, ascending, in decimal, joined by commas."""
    piece = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
    digest = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])

    def join(batches):
        buffer = Buffer(piece, most=64)
        for key, own in groupby(rows(batches, "key", "conv_id"), key=itemgetter(0)):
            first, ids, long = None, [], 0
            for _, one in own:
                first = one if first is None else first
                ids.append(str(one))
                long += len(ids[-1]) + 1
                if long >= PIECE:
                    buffer.add(key, first, ",".join(ids))
                    first, ids, long = None, [], 0
                    if buffer.full:
                        yield buffer.take()
            if ids:
                buffer.add(key, first, ",".join(ids))
            if buffer.full:
                yield buffer.take()
        yield buffer.take()

    def feed(batches):
        buffer = Buffer(digest)
        for key, own in groupby(rows(batches, "key", "ids", step=16), key=itemgetter(0)):
            state, comma = hashlib.sha256(), b""
            for _, ids in own:
                state.update(comma)
                state.update(ids)
                comma = b","
            buffer.add(key, state.hexdigest())
            if buffer.full:
                yield buffer.take()
        yield buffer.take()

    pieces = ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(join, "key binary, first bigint, ids string")
    return pieces.repartition("key").sortWithinPartitions("key", "first").select("key", "ids").mapInArrow(feed, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """(key, parent and the columns of NODE) of every node of the trie of the rebuilt conversations."""
    path, lengths = paths(conversations)
    least = path.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.max("length").alias("far"), F.min("depth").alias("depth"), F.min(F.col("read") - F.col("chars")).alias("before"))
    owned = least.groupBy("conv_id").agg(F.min("depth").alias("first"), F.min("before").alias("before"), F.max((F.col("far") == F.col("depth")).cast("int")).alias("leaf"))
    lasts = stored(path.where("depth = length").select("conv_id", "length", F.col("read").alias("total"), "key"))
    marks = lasts.join(owned, "conv_id", "left").select("conv_id", F.coalesce("first", F.col("length") + 1).alias("first"), F.coalesce("before", "total").alias("before"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    marks = stored(marks)
    marked = spread_join(path, marks, "conv_id", "inner", sizes=lengths.select("conv_id", (F.col("length") + 1).alias("n")), total=path.count())
    nodes = marked.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.min("parent").alias("parent"),
        F.count("*").alias("n_convs"),
        F.sum(((F.col("first") <= F.col("depth") + 1) & (F.col("depth") < F.col("length"))).cast("bigint")).alias("n_children"),
        F.sum(F.col("leaf").cast("bigint")).alias("n_leaves"),
        F.sum(F.greatest(F.col("before") - F.col("read") + F.col("chars"), F.lit(0))).alias("saved_tokens"),
        F.max(F.col("first") == F.col("depth")).alias("top"),
    )
    nodes = stored(nodes)
    # only the first node that a conversation owns hangs on a node of another
    inner = nodes.where("NOT top").withColumn("parent_conv_id", F.col("conv_id"))
    tops = spread_join(nodes.where("top"), nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent")
    every = inner.unionByName(tops).join(digests(lasts), "key", "left")
    return every.select("key", "parent", *NODE[:-1], F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations")).select(*NODE)


ORACLE_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS item,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
  SELECT conv_id, count(*) AS n, conv_id - ((conv_id % 100) + 100) % 100 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
             lambda a, c: list_reduce(list_prepend(xor(a, c), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)),
             4294967295::BIGINT) % 6 AS h
  FROM turns GROUP BY conv_id
), lead_in AS (
  SELECT s.conv_id, t.place AS depth, t.item, t.text FROM sizes s JOIN turns t ON t.conv_id = s.base AND t.place <= s.h
), led AS (
  SELECT s.conv_id, s.h, count(l.depth) AS m FROM sizes s LEFT JOIN lead_in l USING (conv_id) GROUP BY s.conv_id, s.h
), places AS (
  SELECT * FROM lead_in
  UNION ALL SELECT t.conv_id, t.place - l.h + l.m, t.item, t.text FROM turns t JOIN led l USING (conv_id) WHERE t.place > l.h
), path AS (
  SELECT conv_id, depth, string_agg(item, '') OVER (PARTITION BY conv_id ORDER BY depth) AS key, length(text) AS chars FROM places
  UNION ALL SELECT conv_id, 0, '', 0 FROM sizes
), nodes AS (
  SELECT key, min(conv_id) AS conv_id, min(depth) AS depth, count(*) AS n_convs, min(chars) AS chars, CASE WHEN key <> '' THEN left(key, length(key) - 32) END AS parent FROM path GROUP BY key
), children AS (
  SELECT parent AS key, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), ends AS (
  SELECT key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, max_by(key, depth) AS key FROM path GROUP BY conv_id) GROUP BY key
), below AS (
  SELECT p.key, sum((v.n_convs - 1) * v.chars) AS saved_tokens, sum(CASE WHEN c.key IS NULL THEN 1 ELSE 0 END) AS n_leaves
  FROM nodes v JOIN path p ON p.conv_id = v.conv_id AND p.depth <= v.depth LEFT JOIN children c ON c.key = v.key GROUP BY p.key
)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(c.n_children, 0)::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves,
       b.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN below b USING (key) LEFT JOIN nodes u ON u.key = n.parent LEFT JOIN children c ON c.key = n.key LEFT JOIN ends e ON e.key = n.key
"""
