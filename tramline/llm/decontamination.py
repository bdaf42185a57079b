"""Benchmark decontamination on a distributed positional inverted index (operator 1).

The index is cut by document: a block holds the postings of some whole
documents, one row for each term of the block with all its positions, so no
term's list grows beyond a block and a hot term makes no hot task. The test
items are laid in batches of bounded size, and all are searched in one pass: a
join takes from the stored index the postings of their terms, each for the
batches that hold it; a task then has one batch and some blocks, and searches
each block on its own: for every window of item words the lists are shifted by
the term's offset in the window and intersected from the rarest term on: without
slop for exact phrases, and within a slop for proximity matches, which are the
places from which every word of the window stands at its offset give or take
the slop.

Null and empty texts have no words; a document's row is kept all the same.
Items without words, or without an id, are not searched. Rows with equal ids
or texts (ties) are searched row by row, and an item id counts once. A text of
any length is indexed whole, in a block of its own if it is long; items of any
length are searched whole, in parts. Of the columns only the id and text of
either table are read. Empty tables: no documents give no rows, no items give
documents without hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tramline.llm.common import arrow_schema, batch_of, partition_number, rows, small, stored, table, tasks, text_key, words

#: Words of a block at least, unless its task has no more; a single longer document is a block.
BLOCK_WORDS = 1 << 19
#: Unused positions between two documents: more than twice any slop, so no match spans two.
GAP = 16
#: Words of test items that a task searches at once.
BATCH_WORDS = 1 << 18
#: Blocks that a task searches for one batch.
TOGETHER = 16


def build_index(docs: DataFrame, id_column: str = "doc_id", block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(postings, directory): (block, term, positions as differences) and (block, base, id, n_words)."""
    source = docs.select(F.col(id_column).alias("id"), "text")
    id_type = source.schema["id"].dataType.simpleString()
    out = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("term", pa.binary()), ("positions", pa.binary()), ("base", pa.int64()), arrow_schema(source).field(0), ("n_words", pa.int64())])

    def run(batches):
        count, number = 0, partition_number()

        def flush(codes, ids, bases, lengths, terms):
            block = (number << 32) + count
            n = len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(["d"] * n), pa.array([block] * n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), pa.array(bases, pa.int64()), pa.array(ids, out.field(5).type), pa.array(lengths, pa.int64())], schema=out)
            if not terms:
                return
            code = np.concatenate(codes)
            at = np.concatenate([np.arange(b, b + m, dtype=np.int32) for b, m in zip(bases, lengths, strict=True)])
            order = np.argsort(code, kind="stable")
            code, at = code[order], at[order]
            starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            steps = np.diff(at, prepend=np.int32(0)).astype("<i4")
            steps[starts] = at[starts]
            offsets = np.append(starts, len(at)).astype(np.int32) * 4
            names = list(terms)
            for s in range(0, len(names), 1 << 14):  # codes are dealt in order, so the k-th list is the k-th term's
                some = names[s : s + (1 << 14)]
                k = len(some)
                own = offsets[s : s + k + 1]
                data = pa.py_buffer(steps[own[0] // 4 : own[-1] // 4].tobytes())
                lists = pa.Array.from_buffers(pa.binary(), k, [None, pa.py_buffer((own - own[0]).astype(np.int32).tobytes()), data])
                yield pa.RecordBatch.from_arrays([pa.array(["p"] * k), pa.array([block] * k, pa.int64()), pa.array(some, pa.binary()), lists, pa.nulls(k, pa.int64()), pa.nulls(k, out.field(5).type), pa.nulls(k, pa.int64())], schema=out)

        class Codes(dict):
            def __missing__(self, word):
                self[word] = code = len(self)
                return code

        terms, codes, ids, bases, lengths, end = Codes(), [], [], [], [], 0
        for one, text in rows(batches, "id", "text"):
            own = words(text)
            ids.append(one)
            bases.append(end)
            lengths.append(len(own))
            codes.append(np.fromiter(map(terms.__getitem__, own), dtype=np.int32, count=len(own)))
            end += len(own) + GAP
            if end >= block_words:
                yield from flush(codes, ids, bases, lengths, terms)
                terms, codes, ids, bases, lengths, end, count = Codes(), [], [], [], [], 0, count + 1
        if ids:
            yield from flush(codes, ids, bases, lengths, terms)

    index = stored(source.mapInArrow(run, f"kind string, block bigint, term binary, positions binary, base bigint, id {id_type}, n_words bigint"), "kind")
    return index.where("kind = 'p'").select("block", "term", "positions"), index.where("kind = 'd'").select("block", "base", "id", "n_words")


def item_batches(items: DataFrame, n: int, most: int) -> DataFrame:
    """(batch, ids, texts): items in batches of at most ``most`` words; long items come in parts that share n - 1 words."""
    items = items.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    id_field = arrow_schema(items.select("item_id")).field(0)
    out = pa.schema([("batch", pa.int64()), ("ids", pa.list_(id_field.type)), ("texts", pa.list_(pa.binary()))])
    step = max(1, most - n + 1)

    def run(batches):
        batch, ids, texts, held = partition_number() << 32, [], [], 0
        for item, text in rows(batches, "item_id", "text", step=16):
            own = words(text)
            for s in range(0, max(1, len(own) - n + 1) if own else 0, step):
                part = own[s : s + step + n - 1]
                if held and held + len(part) > most:
                    yield batch_of(out, [[batch], [ids], [texts]])
                    batch, ids, texts, held = batch + 1, [], [], 0
                ids.append(item)
                texts.append(b" ".join(part))
                held += len(part)
        if ids:
            yield batch_of(out, [[batch], [ids], [texts]])

    dealt = items.repartition(int(total // (8 * most)) + 1)  # tasks with a few full batches each
    return stored(dealt.mapInArrow(run, f"batch bigint, ids array<{items.schema['item_id'].dataType.simpleString()}>, texts array<binary>"))


def windows_of(batch: list[tuple[object, list[bytes]]], n: int) -> dict[tuple[bytes, ...], list]:
    """Distinct windows of n consecutive words (all words of a shorter item) and the items that hold them."""
    made: dict[tuple[bytes, ...], list] = {}
    for item, own in batch:
        for s in range(max(1, len(own) - n + 1)):
            held = made.setdefault(tuple(own[s : s + n]), [])
            if not held or held[-1] != item:
                held.append(item)
    return made


def search_block(lists: dict[bytes, np.ndarray], windows: dict[tuple[bytes, ...], list], slop: int) -> Iterator[tuple[tuple[bytes, ...], np.ndarray, np.ndarray]]:
    """(window, starts of exact phrases, starts of proximity matches) for the windows that a block holds.

    A proximity match is a start from which every word of the window stands at
    its offset give or take ``slop``.
    """

    def meet(starts, order, tolerance):
        for offset, own in order:
            if not len(starts):
                break
            k = np.searchsorted(own, starts + (offset - tolerance))
            k[k == len(own)] = len(own) - 1
            found = own[k] - offset - starts
            starts = starts[(found >= -tolerance) & (found <= tolerance)]
        return starts

    for window in windows:
        order = []
        for offset, term in enumerate(window):
            own = lists.get(term)
            if own is None:
                break
            order.append((offset, own))
        else:
            order.sort(key=lambda x: len(x[1]))
            # a start is within the slop of the rarest word, so other words are within twice the slop of where that word puts them
            anchors = meet(order[0][1] - order[0][0], order[1:], 2 * slop)
            if not len(anchors):
                continue
            starts = meet(anchors, order[1:], 0) if slop else anchors
            near = meet(np.unique(anchors[:, None] + np.arange(-slop, slop + 1, dtype=anchors.dtype)), order[1:], slop) if slop else anchors
            if len(near):
                yield window, starts, near


def search(postings: DataFrame, batches: DataFrame, blocks: int, n: int, slop: int) -> DataFrame:
    """(block, length, items, starts, near) for each window that a block holds; starts and near are 32-bit positions."""
    salts = max(1, -(-blocks // TOGETHER))
    term = pa.schema([("term", pa.binary()), ("batch", pa.int64())])

    def terms(own):
        for batch, texts in rows(own, "batch", "texts", step=1):
            found = sorted({w for text in texts for w in text.split()})
            yield batch_of(term, [found, [batch] * len(found)])

    every = stored(batches.mapInArrow(terms, "term binary, batch bigint"))
    salt = F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt")
    wanted = postings.join(small(every, 64), "term").select("batch", salt, "block", "term", "positions")
    asked = batches.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # a batch stands before its blocks, and a block's rows follow one another
    lines = asked.unionByName(wanted, allowMissingColumns=True).repartition(tasks(postings.sparkSession, salts), "batch", "salt").sortWithinPartitions("batch", "salt", "block", "term")
    schema = f"block bigint, length int, items {batches.schema['ids'].dataType.simpleString()}, starts binary, near binary"
    made = to_arrow_schema(_parse_datatype_string(schema))

    def run(lines):
        now, windows = None, {}
        for (batch, block), own in groupby(rows(lines, "batch", "block", "term", "positions", "ids", "texts"), key=itemgetter(0, 1)):
            if block is None:
                if batch != now:
                    _, _, _, _, ids, texts = next(own)
                    now, windows = batch, windows_of([(i, t.split()) for i, t in zip(ids, texts, strict=True)], n)
                continue
            found = {term: np.cumsum(np.frombuffer(positions, dtype="<i4"), dtype=np.int32) for _, _, term, positions, _, _ in own}
            out = [(block, len(window), windows[window], starts.astype("<i4").tobytes(), near.astype("<i4").tobytes()) for window, starts, near in search_block(found, windows, slop)]
            if out:
                yield batch_of(made, list(map(list, zip(*out, strict=True))))

    return lines.mapInArrow(run, schema)


def placed(found: DataFrame, directory: DataFrame, slop: int) -> DataFrame:
    """(block, base, starts, ends, items, near_items) for each document with a match; spans of words don't overlap."""
    item_type = found.schema["items"].dataType.elementType.simpleString()
    schema = f"block bigint, base bigint, starts array<bigint>, ends array<bigint>, items array<{item_type}>, near_items array<{item_type}>"
    made = to_arrow_schema(_parse_datatype_string(schema))
    where = directory.groupBy("block").agg(F.sort_array(F.collect_list("base")).alias("bases")).join(found.select("block").distinct(), "block", "left_semi")
    lines = where.withColumn("tag", F.lit(0)).unionByName(found.withColumn("tag", F.lit(1)), allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "tag")

    def run(batches):
        for block, own in groupby(rows(batches, "block", "bases", "length", "items", "starts", "near"), key=itemgetter(0)):
            bases = np.asarray(next(own)[1], dtype=np.int64)
            hits: list[tuple[np.ndarray, int]] = []
            exact: dict[int, set] = {}
            close: dict[int, set] = {}
            for _, _, length, items, starts, near in own:
                starts, near = (np.frombuffer(x, dtype="<i4").astype(np.int64) for x in (starts, near))
                for places, to in ((starts, exact), (near + slop, close)):  # a near start may lie before its document, its first word doesn't
                    for doc in np.unique(np.searchsorted(bases, places, side="right") - 1).tolist():
                        to.setdefault(doc, set()).update(items)
                if len(starts):
                    hits.append((starts, length))
            first, last = _merged(hits)
            doc = np.searchsorted(bases, first, side="right") - 1
            out = []
            for d in sorted(close):
                spans = doc == d
                out.append((block, int(bases[d]), (first[spans] - bases[d]).tolist(), (last[spans] - bases[d]).tolist(), list(exact.get(d, ())), list(close[d])))
            yield batch_of(made, list(map(list, zip(*out, strict=True))))

    return lines.mapInArrow(run, schema)


def _merged(hits: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Spans that cover (starts, length) and don't overlap or touch."""
    if not hits:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first = np.concatenate([s for s, _ in hits]).astype(np.int64)
    last = np.concatenate([s + k for s, k in hits]).astype(np.int64)
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.flatnonzero(np.concatenate([[True], first[1:] > last[:-1]]))
    return first[new], last[np.append(new[1:], len(last)) - 1]


def decontaminate(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", n: int = 10, slop: int = 2, block_words: int = BLOCK_WORDS, batch_words: int = BATCH_WORDS) -> DataFrame:
    """(id, n_words, starts, ends, items, near_items) for every row of docs.

    starts and ends are spans of words that lie in an exact occurrence of a
    window; items hold such a window; near_items also count proximity matches.
    """
    if not 0 <= 2 * slop < GAP:
        raise ValueError(f"slop is 0 to {(GAP - 1) // 2}")
    item_type = items.schema["item_id"].dataType.simpleString()
    postings, directory = build_index(docs, id_column, block_words)
    blocks = directory.select("block").distinct().count()
    found = stored(search(postings, item_batches(items, n, batch_words), blocks, n, slop))
    found = stored(placed(found, directory, slop))
    none = {c: F.array().cast(f"array<{t}>") for c, t in (("starts", "bigint"), ("ends", "bigint"), ("items", item_type), ("near_items", item_type))}
    return directory.join(found, ["block", "base"], "left").select("id", "n_words", *(F.coalesce(k, v).alias(k) for k, v in none.items()))


def contaminated_keys(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Keys of the texts that hold an item's window."""
    found = decontaminate(docs.select(text_key().alias("key"), "text"), items, "key", slop=0)  # exact phrases alone decide
    return found.where(F.size("starts") > 0).select(F.col("id").alias("key")).distinct()


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items: exact phrases, and items that come near within a slop of two words."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("bigint"), lambda a, x: a + x)
    names = lambda c: F.sha2(F.concat_ws(",", F.array_sort(F.transform(c, lambda x: x.cast("string")))), 256)
    size = lambda c: F.size(c).cast("long")
    return found.select(
        F.col("id").alias("doc_id"), "n_words", hit.alias("n_hit"), size("items").alias("n_items"), names("items").alias("items_sha256"),
        (hit > 0).alias("contaminated"), size("near_items").alias("n_near_items"), names("near_items").alias("near_items_sha256"),
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, list_aggregate(w[i:i + least(len(w), 10) - 1], 'string_agg', ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT r, i, k, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS s
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
m AS (SELECT r, i, k, item_id FROM dw JOIN bw USING (k, s)),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM m)) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY r),
win AS (SELECT row_number() OVER () AS x, k, s FROM (SELECT DISTINCT k, s FROM bw)),
ww AS (SELECT x, k, j - 1 AS j, l[j] AS word FROM (SELECT x, k, l, unnest(range(1, k + 1)) AS j FROM (SELECT x, k, string_split(s, ' ') AS l FROM win))),
tok AS (SELECT r, i - 1 AS pos, w[i] AS word FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d) WHERE word IN (SELECT word FROM ww)),
wf AS (SELECT x, k, j, word, f FROM ww JOIN (SELECT word, count(*) AS f FROM tok GROUP BY word) USING (word)),
anchor AS (SELECT x, k, j, word FROM wf QUALIFY count(*) OVER (PARTITION BY x) = k AND row_number() OVER (PARTITION BY x ORDER BY f, j) = 1),
ca AS (SELECT DISTINCT r, x, k, pos - j + dd AS p FROM anchor JOIN tok USING (word), (SELECT unnest(range(-2, 3)) AS dd)),
near AS (
  SELECT r, x FROM (SELECT r, x, k, p, j FROM ca JOIN ww USING (x, k), (SELECT unnest(range(-2, 3)) AS dd)
    WHERE (r, word, p + j + dd) IN (SELECT (r, word, pos) FROM tok)) GROUP BY r, x, k, p HAVING count(DISTINCT j) = k),
nt AS (
  SELECT r, count(*) AS n_near, string_agg(item, ',' ORDER BY item) AS near_ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM near JOIN win USING (x) JOIN bw USING (k, s)) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near_items, sha256(coalesce(near_ids, '')) AS near_items_sha256
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r) LEFT JOIN nt USING (r)
"""
