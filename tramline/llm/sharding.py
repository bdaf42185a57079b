"""Shards of nearly equal bytes by Karmarkar-Karp differencing (operator 8).

Rows with equal texts form a group that is never divided. Each group begins as
a partial partition (its bytes, 0, ..., 0). Differencing takes the two partial
partitions of largest spread, adds them in opposite order, and goes on until
one is left. Groups above a size bound, of which there are few, are differenced
on the driver first. Chunks of the others are differenced in parallel, each
around its share of what the big groups leave uneven, so that they fill up the
other shards; each chunk leaves a few groups over, and these are differenced on
the driver last, around what all chunks have placed.

Null texts count as empty. Equal texts share a group, rows with equal ids are
placed one by one. Groups enter in the order of their text's digest, which
breaks ties between equal sizes; within a shard the slots are in no set order.
A text of any length counts with all its bytes. Of the columns only doc_id and
text are read. An empty table gives no rows.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm.common import Buffer, partition_number, rows, spread_join, stored, table, text_key

#: Groups that are differenced at once in a task, and about as many on the driver.
CHUNK = 20_000


def differencing(sums: list[list[int]]) -> tuple[list[list[int]], list[int]]:
    """For each partial partition, where each of its subsets goes; and the bytes of the final subsets."""
    if not sums:
        return [], []
    k, nodes = len(sums[0]), [list(s) for s in sums]
    parent: list[tuple[int, list[int]] | None] = [None] * len(nodes)
    heap = [(min(s) - max(s), i) for i, s in enumerate(nodes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        falling = sorted(range(k), key=nodes[a].__getitem__, reverse=True)
        rising = sorted(range(k), key=nodes[b].__getitem__)
        made = [nodes[a][x] + nodes[b][y] for x, y in zip(falling, rising, strict=True)]
        for child, order in ((a, falling), (b, rising)):
            to = [0] * k
            for place, subset in enumerate(order):
                to[subset] = place
            parent[child] = (len(nodes), to)
        heapq.heappush(heap, (min(made) - max(made), len(nodes)))
        nodes.append(made)
        parent.append(None)
    goes: list[list[int]] = [[]] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        goes[i] = list(range(k)) if parent[i] is None else [goes[parent[i][0]][x] for x in parent[i][1]]
    return goes[: len(sums)], nodes[-1]


def room(loads: list[int], rest: int) -> list[int]:
    """How much of ``rest`` each shard takes so that all end as level as the loads allow; shards above that level take 0."""
    order = sorted(range(len(loads)), key=loads.__getitem__)
    most = 1
    while most < len(order) and loads[order[most]] * most < rest + sum(loads[x] for x in order[:most]):
        most += 1
    total = rest + sum(loads[x] for x in order[:most])
    out = [0] * len(loads)
    for place, x in enumerate(order[:most]):
        out[x] = total // most + (place < total % most) - loads[x]
    return out


def fill(own: list[int], sizes: list[int]) -> tuple[list[int], list[int]]:
    """For each group the shard it goes to, and the bytes that go to each shard, about in proportion to ``own``."""
    open_shards = [x for x, r in enumerate(own) if r > 0] or list(range(len(own)))
    k, most, all_room, total = len(open_shards), max(own), sum(own) or 1, sum(sizes)
    lacks = [(most - own[x]) * total // all_room for x in open_shards]
    goes, _ = differencing([lacks] + [[n] + [0] * (k - 1) for n in sizes])
    shard_of = {place: x for x, place in zip(open_shards, goes[0], strict=True)}
    to = [shard_of[g[0]] for g in goes[1:]]
    sums = [0] * len(own)
    for x, n in zip(to, sizes, strict=True):
        sums[x] += n
    return to, sums


def _level(groups: DataFrame, own: list[int], chunk: int, spare: float) -> DataFrame:
    """(id, bytes, shard, sums): chunks of groups placed in proportion to ``own``, sums on one row of each chunk; the part ``spare`` of a chunk has no shard yet."""
    out = pa.schema([("id", pa.binary()), ("bytes", pa.int64()), ("shard", pa.int32()), ("sums", pa.list_(pa.int64()))])

    def run(batches):
        buffer, held = Buffer(out), []

        def flush():
            exact = len(held) * spare  # a part of a group is a chance of one, drawn by an id, so that all chunks keep the share and no more
            kept = int(exact) + (int.from_bytes(held[0][0][-4:], "big") < exact % 1 * 2**32)
            to, sums = fill(own, [n for _, n in held[kept:]])
            for i, (one, n) in enumerate(held):
                buffer.add(one, n, to[i - kept] if i >= kept else None, sums if i == 0 else None)

        for one, n in rows(batches, "id", "bytes"):
            held.append((one, n))
            if len(held) >= chunk:
                flush()
                held = []
                yield buffer.take()
        if held:
            flush()
            yield buffer.take()

    return stored(groups.select("id", "bytes").mapInArrow(run, "id binary, bytes bigint, shard int, sums array<bigint>"))


def balance(groups: DataFrame, shards: int, chunk: int = CHUNK) -> DataFrame:
    """(id, shard) for groups (id binary, bytes long)."""
    spark = groups.sparkSession
    groups = stored(groups.sortWithinPartitions("id"))
    count, total = groups.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    # fewer than `chunk` groups are above the bound; few groups are all placed at once
    big = F.lit(True) if count <= chunk else F.col("bytes") > total // chunk
    first = sorted((bytes(r.id), r.bytes) for r in groups.where(big).collect())
    goes, loads = differencing([[n] + [0] * (shards - 1) for _, n in first])
    loads = loads or [0] * shards
    made = [(bytearray(one), to[0]) for (one, _), to in zip(first, goes, strict=True)]
    if count <= chunk:
        return spark.createDataFrame(made, "id binary, shard int")
    level = _level(groups.where(~big), room(loads, total - sum(loads)), chunk, chunk / count)
    for r in level.where("sums IS NOT NULL").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("n")).collect():
        loads[r["pos"]] += r["n"]
    spare = sorted((bytes(r.id), r.bytes) for r in level.where("shard IS NULL").select("id", "bytes").collect())
    to, _ = fill(room(loads, total - sum(loads)), [n for _, n in spare])
    made += [(bytearray(one), x) for (one, _), x in zip(spare, to, strict=True)]
    return level.where("shard IS NOT NULL").select("id", "shard").unionByName(spark.createDataFrame(made, "id binary, shard int"))


def shard(docs: DataFrame, shards: int = 8, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): every row once, equal texts together, slots of a shard from 0 without gaps."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = stored(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), text_key().alias("id")))
    groups = keyed.groupBy("id").agg(F.sum("size").alias("bytes"))
    placed = spread_join(keyed, balance(groups, shards, chunk), "id", "inner").select("doc_id", "size", "text_crc32", "shard")
    fields = placed.schema["doc_id"].dataType.simpleString()

    def number(batches):
        part, seen = partition_number(), [0] * shards
        for batch in batches:
            own = batch.column(3).to_pylist()
            place = []
            for s in own:
                place.append(seen[s])
                seen[s] += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(own), pa.int32()), pa.array(place, pa.int64())], names=[*batch.schema.names, "part", "place"])

    out = stored(placed.mapInArrow(number, f"doc_id {fields}, size bigint, text_crc32 bigint, shard int, part int, place bigint"))
    counts = out.groupBy("part", "shard").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    return out.join(base, ["part", "shard"]).select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("place")).alias("slot"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards under the law ``bytes``."""
    out = shard(table(spark, sf_dir, "documents"), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
