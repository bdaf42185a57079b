"""Packing of token sequences by a configuration linear program (operator 2).

Documents longer than a sequence are cut; what is left to do depends only on
how many pieces have each length, a histogram of at most ``size`` numbers. The
program's variables are configurations (multisets of lengths that fit in one
sequence). It is solved by multiplicative weights: in each round a knapsack
dynamic program prices configurations under the present weights, configurations
within a factor of the best are used a little, and the weights of the lengths
that they cover shrink. The fractional solution is rounded down, and what
remains is covered by configurations that the same dynamic program prices under
weights that favour long pieces, then filled up from the longest piece that
still fits.

Pieces are numbered within their length in parallel; the plan says for each
range of numbers which sequences and offsets it fills, so nothing is collected
but the histogram. Null texts count as empty and become their end token alone.
Equal rows, and rows with equal ids, are packed one by one; which of the pieces
of one length (a tie) goes into which sequence is not set. Texts of any length
are encoded whole and cut. Of the columns only doc_id and text are read. An
empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm.common import Buffer, arrow_schema, partition_number, rows, stored, table

ROUNDS = 240
#: A configuration is used if its value is at least this part of the best one's.
NEAR_BEST = 0.97


# -- tokens ---------------------------------------------------------------------------------------


#: How a byte-level BPE of this kind cuts a text before it merges (a fixed pattern of the vocabulary).
CUT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Ids that the ``tokenizers`` library gives for a file, as little-endian unsigned 32-bit numbers.

    Where the file is a byte-level BPE whose merges stand in the order of the
    ids they make, a rank-based encoder made from the file's own vocabulary
    gives the same ids several times faster; any other file, and any text that
    it refuses or that holds one of the file's added tokens, goes to the
    library itself.
    """

    def __init__(self, path: str):
        self.path, self.library, self.added = path, None, ()
        self.ranked = self._ranked(path)

    def _ranked(self, path: str):
        import json

        import tiktoken

        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        model = made["model"]
        self.added = tuple(t["content"] for t in made.get("added_tokens") or [])
        if model.get("type") != "BPE" or (made.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or made["pre_tokenizer"].get("add_prefix_space") or made.get("normalizer"):
            return None
        vocabulary = model["vocab"]
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        if [vocabulary.get(m) for m in merged] != list(range(256, 256 + len(merged))):
            return None
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = dict(zip(map(chr, plain), plain, strict=True)) | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if i < 256 + len(merged)}
        return tiktoken.Encoding("ranked", pat_str=CUT, mergeable_ranks=ranks, special_tokens={}) if len(ranks) == 256 + len(merged) else None

    def slow(self, text: str) -> bytes:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if self.ranked is None or any(t in text for t in self.added):
            return self.slow(text)
        try:
            return self.ranked.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
        except Exception:  # its regular expressions give up on some very long runs
            return self.slow(text)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each file in each Python process."""
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be shorter than ``size``."""
    first = n % size or min(n, size)
    return [(0, first), *((s, size) for s in range(first, n, size))] if n else []


def pieces(docs: DataFrame, path: str, size: int, end: int, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents, each numbered within its length and its task."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    out = pa.schema([arrow_schema(docs.select("doc_id")).field(0), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("place", pa.int64()), *([("ids", pa.binary())] if with_ids else [])])
    last = int(end).to_bytes(4, "little")

    def run(batches):
        encode, part, seen, buffer = encoder(path), partition_number(), [0] * (size + 1), Buffer(out)
        for doc_id, text in rows(batches, "doc_id", "text"):
            ids = encode(text.decode() if text else "") + last
            for k, (start, length) in enumerate(cuts(len(ids) // 4, size)):
                own = ids[4 * start : 4 * (start + length)]
                buffer.add(doc_id, k, start, length, zlib.crc32(own), part, seen[length], *([own] if with_ids else []))
                seen[length] += 1
            if buffer.full:
                yield buffer.take()
        yield buffer.take()

    return stored(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, place bigint" + ", ids binary" * with_ids))


# -- the program ----------------------------------------------------------------------------------


def price(lengths: np.ndarray, weights: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: the best value for each capacity and the length taken last (-1: none)."""
    best, taken = np.zeros(size + 1), np.full(size + 1, -1, dtype=np.int64)
    ends = np.searchsorted(lengths, np.arange(size + 1), side="right")
    for c in range(1, size + 1):
        best[c], taken[c] = best[c - 1], -2  # -2: leave one token free
        k = ends[c]
        if k:
            values = best[c - lengths[:k]] + weights[:k]
            at = int(values.argmax())
            if values[at] > best[c]:
                best[c], taken[c] = values[at], at
    return best, taken


def trace(taken: np.ndarray, lengths: np.ndarray, room: int) -> list[int]:
    """Indexes of the lengths in the best filling of ``room``."""
    out = []
    while room > 0:
        if taken[room] == -2:
            room -= 1
        else:
            out.append(int(taken[room]))
            room -= int(lengths[taken[room]])
    return out


def fractional(lengths: np.ndarray, counts: np.ndarray, size: int, rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Multiplicative weights: uses of configurations that cover every length about ``counts`` times."""
    covered = np.zeros(len(lengths))
    uses: dict[tuple[int, ...], float] = {}
    start = lengths / size
    rate = 4.0
    for t in range(1, rounds + 1):
        weights = start * np.exp(-rate * (covered - t / rounds))
        best, taken = price(lengths, weights, size)
        value = weights + best[size - lengths]
        for i in np.flatnonzero(value >= NEAR_BEST * value.max()):
            if covered[i] > t / rounds:
                continue
            own = np.sort(np.array([i, *trace(taken, lengths, size - int(lengths[i]))]))
            which, many = np.unique(own, return_counts=True)
            step = float((counts[which] / many).min()) / rounds * 2
            covered[which] += many * step / counts[which]
            key = tuple(own.tolist())
            uses[key] = uses.get(key, 0.0) + step
    return uses


def plan(histogram: dict[int, int], size: int, rounds: int = ROUNDS) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths in a sequence, longest first; sequences)] that use every piece exactly once."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram), dtype=np.int64)
    left = np.array([histogram[int(x)] for x in lengths], dtype=np.int64)
    out: list[tuple[tuple[int, ...], int]] = []

    def take(own: np.ndarray, most: int | None = None) -> None:
        which, many = np.unique(own, return_counts=True)
        times = int((left[which] // many).min())
        times = times if most is None else min(times, most)
        if times > 0:
            left[which] -= many * times
            out.append((tuple(int(x) for x in sorted(lengths[own], reverse=True)), times))

    if (full := int(left[-1])) and lengths[-1] == size:
        out.append(((size,), full))
        left[-1] = 0
    if left.any():
        some = np.flatnonzero(left)
        uses = fractional(lengths[some], left[some].astype(float), size, rounds)
        for key, use in sorted(uses.items(), key=lambda x: (-x[1], x[0])):
            if use >= 1:
                take(some[list(key)], int(use))
    while left.any():
        some = np.flatnonzero(left)
        own_lengths = lengths[some]
        _, taken = price(own_lengths, own_lengths * (1 + 0.02 * own_lengths / size), size)
        longest = int(own_lengths[-1])
        own: list[int] = []
        have = left[some].copy()
        room = size
        for i in sorted([len(some) - 1, *trace(taken, own_lengths, size - longest)], reverse=True):
            if have[i] and own_lengths[i] <= room:
                own.append(i)
                have[i] -= 1
                room -= int(own_lengths[i])
        while room:
            fits = np.flatnonzero((have > 0) & (own_lengths <= room))
            if not len(fits):
                break
            own.append(int(fits[-1]))
            have[fits[-1]] -= 1
            room -= int(own_lengths[fits[-1]])
        take(some[np.array(own)])
    return out


def ranges(planned: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first numbers of ranges, first sequence, pieces in a sequence, offset of the first."""
    made: dict[int, list[list[int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for own, times in planned:
        offset = 0
        for length in dict.fromkeys(own):
            many = own.count(length)
            made.setdefault(length, []).append([used.get(length, 0), sequence, many, offset])
            used[length] = used.get(length, 0) + many * times
            offset += many * length
        sequence += times
    return {k: tuple(np.array(v, dtype=np.int64).T) for k, v in made.items()}


def pack(docs: DataFrame, path: str, size: int = 1024, end: int = 2, with_ids: bool = False, rounds: int = ROUNDS) -> DataFrame:
    """One row for each piece with its sequence and its place there; ``with_ids`` adds its ids."""
    cut = pieces(docs, path, size, end, with_ids)
    each = cut.groupBy("part", "length").count()
    histogram = {int(r["length"]): int(r["n"]) for r in each.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # at most `size` rows
    to = docs.sparkSession.sparkContext.broadcast(ranges(plan(histogram, size, rounds)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = each.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    numbered = cut.join(base, ["part", "length"]).select(*columns, (F.col("base") + F.col("place")).alias("number"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema[: len(columns)])

    def place(batches):
        for batch in batches:
            length, number = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
            for one in np.unique(length):
                own = np.flatnonzero(length == one)
                first, start, many, at = to.value[int(one)]
                k = np.searchsorted(first, number[own], side="right") - 1
                within = number[own] - first[k]
                sequence[own] = start[k] + within // many[k]
                offset[own] = at[k] + within % many[k] * one
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    return numbered.mapInArrow(place, f"{kinds}, sequence_id bigint, offset bigint")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"), vocabulary())
