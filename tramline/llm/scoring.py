"""Language-model scores by context-tree weighting over bytes (operator 9).

A text is its bytes and one end symbol (0xFF, which no UTF-8 text holds). A
byte is eight binary decisions, each with its own tree over the DEPTH bytes
before it. A node of depth d has the Krichevsky-Trofimov probability Pe of the
decisions that the training texts made there, and

    Pw = Pe at depth DEPTH, else 1/2 Pe + 1/2 (product of the children's Pw),

so that a decision's probability mixes the estimates at all depths of its path
with the weights 1/2 Pe / Pw from the root on; where a path is not in the tree,
its last estimate takes the rest. The product over decisions gives the code
length of each byte, and a text's score is minus their sum in decimal digits.

There is one path at every size, and no table of the corpus is broadcast. Texts
are dealt in blocks of bounded size. A block hands on its distinct items
((context, byte) pairs, and words) with their training counts, cut into parts by the two
nearest bytes or by hash. The counts of a part are merged over all blocks, in
two steps so that no task merges more than a bounded number of blocks; trees
are worked out part by part, and only the nodes of depth 1, at most 256 x 255,
go to the driver. Each block then gets back one number for each of its items,
in the order in which it can list them itself, and scores its texts with them.

Null texts count as empty: one end symbol. Null ids belong to training. Rows
with equal ids or texts (ties) are scored one by one and alike. A text of any
length is scored whole: beyond SEGMENT bytes it is worked on in segments that
carry their context along, and it lies in one block. Columns other than doc_id
and text are not read, whatever their names. An empty table gives no rows;
with no training rows every decision has probability 1/2 and every count is 0.
"""

from __future__ import annotations

import math
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import LOWER_BYTES, arrow_schema, batch_of, partition_number, rows, stored, table, tasks

DEPTH = 5
#: Bytes by which parts are dealt, and those by which a part's trees are worked out in runs.
NEAR, SPLIT = 2, 3
END = b"\xff"
#: Symbols, and bytes of one text, that are worked on at once.
BLOCK, SEGMENT = 1 << 20, 1 << 19
#: Bytes of text of a block at least, unless its task has no more.
BLOCK_BYTES = 32 << 20
#: Bytes of text that are compressed together where blocks are stored.
CHUNK_BYTES = 1 << 16
#: Parts into which the items of a kind are dealt.
PARTS = 1024
#: Blocks whose items are merged in one task.
TOGETHER = 512
#: Distinct items that are held apart before they are merged.
APART = 4 << 20
GRAM, WORD = 0, 1
_WORD_END = b"\n"  # stands for the end among words; no word holds it


def held_out(folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


# -- symbols of texts -----------------------------------------------------------------------------


def pieces(text: bytes | None, depth: int = DEPTH):
    """Parts of a text with its end, each with the ``depth`` bytes before it."""
    whole, before = (text or b"") + END, END * depth
    for s in range(0, len(whole), SEGMENT):
        part = before + whole[s : s + SEGMENT]
        yield part
        before = part[-depth:]


def grams(parts: list[bytes], depth: int = DEPTH) -> np.ndarray:
    """A code for each symbol: the bytes before it, the nearest first, and itself in the last 8 bits."""
    every = np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.int64)
    n = len(every) - depth
    code = every[depth:].copy()
    for k in range(depth):
        code |= every[depth - 1 - k : depth - 1 - k + n] << (8 * (depth - k))
    lengths = np.array([len(p) for p in parts])
    keep = np.ones(len(every), dtype=bool)
    for k, start in enumerate(np.cumsum(lengths) - lengths):
        keep[start : start + depth] = False
    return code[keep[depth:]]


def word_codes(text: bytes | None) -> np.ndarray:
    """64-bit hashes of the words of a text and of its end."""
    own = [*(text or b"").translate(LOWER_BYTES).split(), _WORD_END]
    return np.fromiter(map(xxhash.xxh3_64_intdigest, own), dtype=np.uint64, count=len(own)).view(np.int64)


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and how often each stands."""
    found = np.sort(codes)
    starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, dtype=np.int64)
    return found[starts], np.diff(np.append(starts, len(found)))


def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes of several lists and the sums of their counts."""
    if len(held) == 1:
        return held[0]
    code = np.concatenate([np.zeros(0, dtype=np.int64), *(c for c, _ in held)])
    n = np.concatenate([np.zeros(0, dtype=np.int64), *(x for _, x in held)])
    if not len(code):
        return code, n
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return code[starts], np.add.reduceat(n, starts)


class Items:
    """The distinct items of the texts of a block and their training counts; those of held-out texts alone have 0."""

    def __init__(self, depth: int):
        self.depth, self.size, self.waiting = depth, 0, 0
        self.texts: dict[bool, list[bytes]] = {False: [], True: []}
        self.words: dict[bool, list[np.ndarray]] = {False: [], True: []}
        self.found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {GRAM: [], WORD: []}

    def add(self, held: bool, text: bytes | None) -> None:
        self.words[held].append(word_codes(text))
        for part in pieces(text, self.depth):
            self.texts[held].append(part)
            self.waiting += len(part)
            self.size += len(part)
            if self.waiting >= BLOCK:
                self._turn()

    def _turn(self) -> None:
        for held in (False, True):
            for kind, codes in ((GRAM, [grams(self.texts[held], self.depth)] if self.texts[held] else []), (WORD, self.words[held])):
                if codes:
                    code, n = _counted(np.concatenate(codes))
                    self.found[kind].append((code, np.zeros_like(n) if held else n))
            self.texts[held], self.words[held] = [], []
        self.waiting = 0
        for kind, own in self.found.items():
            if len(own) > 1 and sum(len(c) for c, _ in own) > APART:
                self.found[kind] = [merged(own)]

    def by_part(self, parts: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each kind the codes by part and code, their counts, and the part of each."""
        self._turn()
        out = {}
        for kind, own in self.found.items():
            code, n = merged(own)
            part = part_of(kind, code, parts, self.depth)
            order = np.argsort(part, kind="stable")
            out[kind] = (code[order], n[order], part[order])
        return out


def part_of(kind: int, codes: np.ndarray, parts: int, depth: int = DEPTH) -> np.ndarray:
    """Grams that share their NEAR nearest bytes share a part."""
    if kind == GRAM:
        near = codes >> (8 * (depth + 1 - NEAR))
        return (((near * 40503) & 0xFFFF) * parts) >> 16
    return ((codes.view(np.uint64) >> np.uint64(40)).astype(np.int64) * parts) >> 24


def squeeze(numbers: np.ndarray) -> bytes:
    """Numbers compressed, the first bytes of all together, then the second, and so on."""
    import zstandard

    width = numbers.dtype.itemsize
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, width).T.tobytes())


def unsqueeze(data: bytes, kind: type) -> np.ndarray:
    import zstandard

    width = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(kind)


def squeeze_codes(codes: np.ndarray) -> bytes:
    """Sorted codes as differences."""
    return squeeze(np.diff(codes, prepend=np.int64(0)))


def unsqueeze_codes(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(data, np.int64))


_ITEM = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("block", pa.int64()), ("codes", pa.binary()), ("n", pa.binary())])


def blocks(texts: DataFrame, depth: int = DEPTH, parts: int = PARTS, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(kind, part, block, codes, n) and (block, ids, held, lengths, data) of texts (doc_id, held_out, text); data are texts, compressed."""
    id_type = texts.schema["doc_id"].dataType.simpleString()
    out = pa.schema([("tag", pa.string()), *_ITEM, ("ids", pa.list_(arrow_schema(texts.select("doc_id")).field(0).type)), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int64())), ("data", pa.binary())])

    def run(batches):
        import zstandard

        packer = zstandard.ZstdCompressor(level=3)
        block, items, chunk, size = partition_number() << 32, Items(depth), [], 0

        def texts_row():
            ids, held, own = zip(*chunk, strict=True)
            row = ["t", None, None, block, None, None, list(ids), list(held), [len(t) for t in own], packer.compress(b"".join(own))]
            return batch_of(out, [[x] for x in row])

        def item_rows():
            for kind, (code, n, part) in items.by_part(parts).items():
                starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
                ends = [*starts[1:], len(part)] if len(part) else []
                found = [(kind, int(part[a]), block, squeeze_codes(code[a:b]), squeeze(n[a:b])) for a, b in zip(starts, ends, strict=True)]
                if found:
                    k = len(found)
                    yield batch_of(out, [["i"] * k, *map(list, zip(*found, strict=True)), *(pa.nulls(k, f.type) for f in list(out)[6:])])

        for doc_id, is_held, text in rows(batches, "doc_id", "held_out", "text"):
            chunk.append((doc_id, is_held, text or b""))
            size += len(text or b"") + 1
            items.add(is_held, text)
            if size >= CHUNK_BYTES:
                yield texts_row()
                chunk, size = [], 0
            if items.size >= block_bytes:
                if chunk:
                    yield texts_row()
                yield from item_rows()
                block, items, chunk, size = block + 1, Items(depth), [], 0
        if chunk:
            yield texts_row()
        yield from item_rows()

    made = texts.mapInArrow(run, f"tag string, kind int, part int, block bigint, codes binary, n binary, ids array<{id_type}>, held array<boolean>, lengths array<bigint>, data binary")
    made = stored(made, "tag")
    return made.where("tag = 'i'").select("kind", "part", "block", "codes", "n"), made.where("tag = 't'").select("block", "ids", "held", "lengths", "data")


def merge_parts(items: DataFrame, salts: int, most: int) -> DataFrame:
    """(kind, part, codes, n): the training counts of the whole corpus, one row for each part; ``most`` tasks do the first step."""

    def step(of: DataFrame, number: int, *keys: str) -> DataFrame:
        out = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("codes", pa.binary()), ("n", pa.binary())])

        def run(batches):
            for key, own in groupby(rows(batches, *keys, "codes", "n", step=16), key=lambda r: r[: len(keys)]):
                held, size = [], 0
                for *_, codes, n in own:
                    held.append((unsqueeze_codes(codes), unsqueeze(n, np.int64)))
                    size += len(held[-1][0])
                    if size > APART:
                        held = [merged(held)]
                        size = len(held[0][0]) // 2
                code, n = merged(held)
                yield batch_of(out, [[key[0]], [key[1]], [squeeze_codes(code)], [squeeze(n)]])

        return of.repartition(number, *keys).sortWithinPartitions(*keys).mapInArrow(run, "kind int, part int, codes binary, n binary")

    some = step(items.select("kind", "part", salt_of(salts), "codes", "n"), most, "kind", "part", "salt")
    return stored(step(some, tasks(items.sparkSession, 1), "kind", "part"))


def salt_of(salts: int) -> Column:
    return F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt")


# -- the trees ------------------------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x > 0: Stirling's series above 8, the recurrence below."""
    x = np.asarray(x, dtype=np.float64)
    shift, y = np.zeros_like(x), x.copy()
    while (low := y < 8).any():
        shift[low] += np.log(y[low])
        y[low] += 1
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y - shift


def kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


def nodes_at(codes: np.ndarray, n: np.ndarray, depth: int, full: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, zeros, ones) of the decisions at a depth: key is the context's ``depth`` bytes and the decision's number 1 to 255."""
    context, symbol = codes >> (8 * (full + 1 - depth)), codes & 255
    keys, zeros, ones = [], [], []
    for level in range(8):
        key = (context << 8) | (1 << level) | (symbol >> (8 - level))
        bit = (symbol >> (7 - level)) & 1
        own, at = np.unique(key, return_inverse=True)
        one = np.bincount(at, weights=n * bit, minlength=len(own))
        keys.append(own)
        ones.append(one)
        zeros.append(np.bincount(at, weights=n, minlength=len(own)) - one)
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    return key[order], np.concatenate(zeros)[order], np.concatenate(ones)[order]


class Level:
    """The nodes of one depth: keys, estimates of a one, and the weights at which a path stops there."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.key, self.zeros, self.ones = key, zeros, ones
        estimate = kt(zeros, ones)
        if below is None:
            self.weighted, self.stop = estimate, np.ones(len(key))
        else:
            self.weighted = np.logaddexp(estimate, below) - np.log(2)
            self.stop = np.exp(np.minimum(0.0, estimate - np.log(2) - self.weighted))

    def gathered(self, above: np.ndarray) -> np.ndarray:
        """Sums of ln Pw of these nodes for the sorted keys of the depth above."""
        parent = ((self.key >> 16) << 8) | (self.key & 255)
        return np.bincount(np.searchsorted(above, parent), weights=self.weighted, minlength=len(above))


def levels(codes: np.ndarray, n: np.ndarray, first: int, full: int) -> list[Level]:
    """Nodes of depths first to full, from pairs with a count."""
    made: list[Level] = []
    for depth in range(full, first - 1, -1):
        key, zeros, ones = nodes_at(codes, n, depth, full)
        made.insert(0, Level(key, zeros, ones, made[0].gathered(key) if made else None))
    return made


def log2_probability(codes: np.ndarray, tree: list[Level], full: int) -> np.ndarray:
    """log2 of the probability of each pair's byte after its context; tree holds depths 0 to full."""
    total = np.zeros(len(codes))
    symbol = codes & 255
    for place in range(8):
        decision = (1 << place) | (symbol >> (8 - place))
        bit = (symbol >> (7 - place)) & 1
        mixed, rest, last, live = np.zeros(len(codes)), np.ones(len(codes)), np.full(len(codes), 0.5), np.ones(len(codes), dtype=bool)
        for depth, level in enumerate(tree):
            if not len(level.key):
                break
            key = ((codes >> (8 * (full + 1 - depth))) << 8) | decision
            at = np.minimum(np.searchsorted(level.key, key), len(level.key) - 1)
            live &= level.key[at] == key
            own = np.where(bit == 1, level.ones[at], level.zeros[at])
            p = (own + 0.5) / (level.zeros[at] + level.ones[at] + 1)
            stop = np.where(live, level.stop[at], 0.0)
            last = np.where(live, p, last)
            mixed += rest * stop * p
            rest *= 1 - stop
        total += np.log2(mixed + rest * last)
    return total


def _above(low: list[Level]) -> tuple[np.ndarray, ...]:
    """(key, zeros, ones, ln of the product of the children's Pw) of the nodes above some levels of one depth."""
    key = np.concatenate([((x.key >> 16) << 8) | (x.key & 255) for x in low])
    above, at = np.unique(key, return_inverse=True)
    add = lambda field: np.bincount(at, weights=np.concatenate([getattr(x, field) for x in low]), minlength=len(above))
    return above, add("zeros"), add("ones"), add("weighted")


def runs_of(code: np.ndarray, depth: int) -> list[tuple[int, int]]:
    """Rows of sorted codes in runs of about BLOCK / 4 that don't divide what shares its SPLIT nearest bytes."""
    near, out, a = code >> (8 * (depth + 1 - SPLIT)), [], 0
    while a < len(code):
        b = min(a + BLOCK // 4, len(code))
        b = int(np.searchsorted(near, near[b - 1], side="right"))
        out.append((a, b))
        a = b
    return out


def trained(code: np.ndarray, n: np.ndarray, depth: int) -> list[Level]:
    """Levels from SPLIT on of the pairs that have a count."""
    seen = n > 0
    return levels(code[seen], n[seen].astype(np.float64), SPLIT, depth) if seen.any() else []


def near_level(code: np.ndarray, n: np.ndarray, depth: int) -> tuple[Level | None, list[Level] | None]:
    """The nodes of depth NEAR of a part and, if it is one run, the levels below them."""
    low, own = [], None
    runs = runs_of(code, depth)
    for a, b in runs:
        own = trained(code[a:b], n[a:b], depth)
        if own:
            low.append(own[0])
    return (Level(*_above(low)) if low else None), (own if len(runs) == 1 else None)


def gram_values(counted: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(part, codes, data): log2 probabilities, as 32-bit floats, of the grams of each part of (part, codes, n)."""
    node = pa.schema([("key", pa.int64()), ("zeros", pa.float64()), ("ones", pa.float64()), ("weighted", pa.float64())])

    def up(batches):
        for codes, n in rows(batches, "codes", "n", step=16):
            level, _ = near_level(unsqueeze_codes(codes), unsqueeze(n, np.int64), depth)
            if level is not None:
                yield batch_of(node, [pa.array(x) for x in _above([level])])

    each = counted.mapInArrow(up, "key bigint, zeros double, ones double, weighted double")
    first = each.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "weighted"))).toArrow()  # at most 256 x 255 nodes
    to = counted.sparkSession.sparkContext.broadcast(_upper(*(first.column(c).to_numpy() for c in ("key", "zeros", "ones", "weighted"))))
    value = pa.schema([("part", pa.int32()), ("codes", pa.binary()), ("data", pa.binary())])

    def down(batches):
        for part, codes, n in rows(batches, "part", "codes", "n", step=16):
            code, count = unsqueeze_codes(codes), unsqueeze(n, np.int64)
            level, below = near_level(code, count, depth)
            found = []
            for a, b in runs_of(code, depth):
                low = trained(code[a:b], count[a:b], depth) if below is None else below
                found.append(log2_probability(code[a:b], to.value + ([level] if level else []) + (low if level else []), depth))
            yield batch_of(value, [[part], [codes], [squeeze(np.concatenate(found).astype(np.float32))]])

    return counted.mapInArrow(down, "part int, codes binary, data binary")


def _upper(key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> list[Level]:
    """Depths 0 to NEAR - 1 from the sums at depth NEAR - 1."""
    order = np.argsort(key, kind="stable")
    out = [Level(key[order], zeros[order], ones[order], below[order])]
    while len(out) < NEAR:
        out.insert(0, Level(*_above(out[:1])))
    return out


# -- scores ---------------------------------------------------------------------------------------


class Lookup:
    """An open-addressing table, three fifths full, from the 64-bit codes of a block to floats."""

    FREE = np.int64(-(2**63))  # no code; a word hashes to it with probability 2^-64

    def __init__(self, items: int, kind: type):
        self.size = max(16, items * 5 // 3)
        self.codes, self.values = np.full(self.size, self.FREE), np.zeros(self.size, dtype=kind)

    def fill(self, codes: np.ndarray, values: np.ndarray) -> Lookup:
        """Adds codes that the table doesn't hold yet."""
        for s in range(0, len(codes), BLOCK):
            self._insert(codes[s : s + BLOCK], values[s : s + BLOCK])
        return self

    def _insert(self, codes: np.ndarray, values: np.ndarray) -> None:
        left, slot = np.arange(len(codes)), self._slot(np.ascontiguousarray(codes))
        while len(left):
            free = self.codes[slot] == self.FREE
            _, first = np.unique(np.where(free, slot, -1), return_index=True)
            first = first[free[first]]
            here = slot[first]
            self.codes[here], self.values[here] = codes[left[first]], values[left[first]]
            rest = np.ones(len(left), dtype=bool)
            rest[first] = False
            left, slot = left[rest], (slot[rest] + 1) % self.size

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        mixed = codes.view(np.uint64) >> np.uint64(29)
        mixed ^= codes.view(np.uint64)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed >>= np.uint64(32)
        mixed *= np.uint64(self.size)
        mixed >>= np.uint64(32)
        return mixed.view(np.int64)

    def __call__(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, found); values are 0 where a code is not found."""
        slot = self._slot(codes)
        own = self.codes.take(slot)
        found = own == codes
        out = self.values.take(slot)
        left = np.flatnonzero(~found)
        out[left] = 0
        left = left[own[left] != self.FREE]
        at = slot[left]
        while len(left):
            at += 1
            at[at == self.size] = 0
            own = self.codes.take(at)
            hit = own == codes[left]
            out[left[hit]], found[left[hit]] = self.values[at[hit]], True
            on = (own != self.FREE) & ~hit
            left, at = left[on], at[on]
        return out, found


def answers(items: DataFrame, values: DataFrame, salts: int, most: int) -> DataFrame:
    """(block, kind, part, data): the values (kind, part, codes, data) of each block's items, in the order of its codes; by ``most`` tasks."""
    known = values.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumn("tag", F.lit(0))
    asked = items.select("kind", "part", "block", "codes", salt_of(salts), F.lit(1).alias("tag"))
    keys = ["kind", "part", "salt"]
    lines = known.unionByName(asked, allowMissingColumns=True).repartition(most, *keys).sortWithinPartitions(*keys, "tag")
    out = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()), ("data", pa.binary())])

    def run(batches):
        code = value = np.zeros(0)
        for kind, part, tag, block, codes, data in rows(batches, "kind", "part", "tag", "block", "codes", "data", step=64):
            if tag == 0:
                code, value = unsqueeze_codes(codes), unsqueeze(data, np.float32 if kind == GRAM else np.int64)
            else:
                yield batch_of(out, [[block], [kind], [part], [squeeze(value[np.searchsorted(code, unsqueeze_codes(codes))])]])

    return lines.mapInArrow(run, "block bigint, kind int, part int, data binary")


def score_blocks(texts: DataFrame, answered: DataFrame, depth: int, parts: int, most: int) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, words, bits): each block's answers stand before its texts, which are scored with them; by ``most`` tasks."""
    id_type = texts.schema["ids"].dataType.elementType.simpleString()
    lines = answered.withColumn("tag", F.lit(0)).unionByName(texts.withColumn("tag", F.lit(1)), allowMissingColumns=True)
    lines = lines.repartition(most, "block").sortWithinPartitions("block", "tag", "kind", "part")
    out = pa.schema([pa.field("doc_id", arrow_schema(texts.select("ids")).field(0).type.value_type), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("words", pa.float64()), ("bits", pa.float64())])

    def run(batches):
        import zstandard

        unpacker = zstandard.ZstdDecompressor()
        for _, lines in groupby(rows(batches, "block", "tag", "kind", "data", "ids", "held", "lengths", step=16), key=itemgetter(0)):
            data: dict[int, list[np.ndarray]] = {GRAM: [np.zeros(0, dtype=np.float32)], WORD: [np.zeros(0, dtype=np.int64)]}
            chunks = []
            for _, tag, kind, own, ids, held, lengths in lines:
                if tag == 0:
                    data[kind].append(unsqueeze(own, np.float32 if kind == GRAM else np.int64))
                else:
                    chunks.append((own, ids, held, lengths))

            def texts():
                for own, ids, held, lengths in chunks:  # noqa: B023
                    whole, at = unpacker.decompress(own), 0
                    for doc_id, is_held, length in zip(ids, held, lengths, strict=True):
                        yield doc_id, is_held, whole[at : at + length]
                        at += length

            items = Items(depth)
            for _, _, text in texts():
                items.add(False, text)
            found = items.by_part(parts)
            del items
            lookups = {}
            for kind, type_ in ((GRAM, np.float32), (WORD, np.float64)):
                value = np.concatenate(data.pop(kind))
                code = found.pop(kind)[0]
                if len(code) != len(value):
                    raise ValueError("a block's answers don't belong to its texts")
                lookups[kind] = Lookup(len(code), type_).fill(code, value if kind == GRAM else np.log10(value + 1.0))
            yield from scored(texts(), lookups[GRAM], lookups[WORD])

    def scored(texts, gram_value, word_value):
        held, parts_, owners, size = [], [], [], 0

        def finish():
            value, _ = gram_value(grams(parts_, depth))
            lengths = np.array([len(p) - depth for p in parts_])
            sums = np.add.reduceat(value.astype(np.float64), np.cumsum(lengths) - lengths)
            bits = np.bincount(owners, weights=sums, minlength=len(held))
            return batch_of(out, [*map(list, zip(*held, strict=True)), bits.tolist()])

        for doc_id, is_held, text in texts:
            codes = word_codes(text)
            value, _ = word_value(codes)
            row = (doc_id, is_held, len(codes), int((value > 0).sum()), float(value.sum()))
            own = list(pieces(text, depth))
            if len(own) > 1:  # a long text by itself, piece by piece
                if held:
                    yield finish()
                    held, parts_, owners, size = [], [], [], 0
                bits = sum(float(gram_value(grams([p], depth))[0].astype(np.float64).sum()) for p in own)
                yield batch_of(out, [[c] for c in (*row, bits)])
                continue
            owners.append(len(held))
            held.append(row)
            parts_ += own
            size += len(own[0])
            if size >= BLOCK:
                yield finish()
                held, parts_, owners, size = [], [], [], 0
        if held:
            yield finish()

    return lines.mapInArrow(run, f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, words double, bits double")


def score(docs: DataFrame, held: Column | None = None, depth: int = DEPTH, parts: int = PARTS, block_bytes: int = BLOCK_BYTES, together: int = TOGETHER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of docs."""
    held = held_out() if held is None else held
    items, texts = blocks(docs.select("doc_id", held.alias("held_out"), "text"), depth, parts, block_bytes)
    n_blocks = items.select("block").distinct().count()
    salts = max(1, math.ceil(n_blocks / together))
    exchange, scoring = tasks(docs.sparkSession, n_blocks // 8), tasks(docs.sparkSession, n_blocks)
    counted = merge_parts(items, salts, exchange)

    def totals(batches):
        for (n,) in rows(batches, "n", step=16):
            own = unsqueeze(n, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([int(own.sum())]), pa.array([int((own > 0).sum())])], names=["n", "v"])

    words = counted.where(f"kind = {WORD}")
    sums = words.mapInArrow(totals, "n bigint, v bigint").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n_train, v_train = int(sums["n"] or 0), int(sums["v"] or 0)
    values = gram_values(counted.where(f"kind = {GRAM}"), depth).select(F.lit(GRAM).alias("kind"), "part", "codes", "data")
    values = stored(values.unionByName(words.select("kind", "part", "codes", F.col("n").alias("data"))))
    scored = score_blocks(texts, answers(items, values, salts, exchange), depth, parts, scoring)
    scale = math.log10(n_train + v_train + 1)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), (F.col("words") - F.col("n_tokens") * scale).alias("base_score"), (F.col("bits") * math.log10(2)).alias("score"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all whole documents."""
    return score(table(spark, sf_dir, "documents").select("doc_id", "text"))
