"""A zip archive whose members are deflated in pieces by tasks and put together by their bytes.

Pieces that end in a full flush follow each other as one deflate stream, and the checksum of a member follows from those
of its pieces and their lengths; so whoever writes the archive needs no line of a member.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of text that are deflated together.
CHUNK = 4 << 20
#: Fixed value: the polynomial of the archive's checksum, lowest power first.
POLYNOMIAL = 0xEDB88320

Piece = tuple[int, int, bytes]  # length and checksum of the text, deflated bytes


def deflate(text: bytes) -> Piece:
    made = zlib.compressobj(6, zlib.DEFLATED, -15)
    return len(text), zlib.crc32(text), made.compress(text) + made.flush(zlib.Z_FULL_FLUSH)


def deflated(lines: DataFrame, most: int = CHUNK) -> DataFrame:
    """(file, start, place, n, crc, bytes): pieces of files from their lines (value, file, start of the split), without each file's first line."""
    out = pa.schema([("file", pa.string()), ("start", pa.int64()), ("place", pa.int64()), ("n", pa.int64()), ("crc", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, place, held, long = None, 0, [], 0

        def taken() -> pa.RecordBatch:
            n, crc, made = deflate(b"".join(held))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*at, place, n, crc, made), out, strict=True)], schema=out)

        for batch in batches:
            for value, file, start in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if (file, start) != at:
                    if held:
                        yield taken()
                    at, place, held, long = (file, start), 0, [], 0
                    if not start:
                        continue
                line = value.encode() + b"\n"
                held.append(line)
                long += len(line)
                if long >= most:
                    yield taken()
                    place, held, long = place + 1, [], 0
        if held:
            yield taken()

    return lines.select("value", "file", "start").mapInArrow(run, "file string, start bigint, place bigint, n bigint, crc bigint, bytes binary")


def _times(a: int, b: int) -> int:
    """Product of two polynomials over two elements, modulo POLYNOMIAL; the highest bit is the constant."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return out


def joined_crc(first: int, second: int, n: int) -> int:
    """The checksum of two texts, one after the other, from theirs and the second's length: the first's moves on by n bytes."""
    power, moved = 1 << 23, 1 << 31  # x^8 and 1
    while n:
        if n & 1:
            moved = _times(power, moved)
        power = _times(power, power)
        n >>= 1
    return _times(moved, first) ^ second


class Archive:
    """Writes members from their pieces; every length has room for 64 bits."""

    def __init__(self, path: str):
        self.file, self.entries = open(path, "wb"), []

    def __enter__(self) -> Archive:
        return self

    def add(self, name: str, *pieces: Iterable[Piece]) -> None:
        start, raw = self.file.tell(), name.encode()
        head = lambda crc, packed, n: struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0x800, 8, 0, 0x21, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(raw), 20) + raw + struct.pack("<HHQQ", 1, 16, n, packed)
        self.file.write(head(0, 0, 0))
        n = crc = packed = 0
        for more, own, body in chain(*pieces):
            self.file.write(body)
            n, crc, packed = n + more, joined_crc(crc, own, more), packed + len(body)
        self.file.write(b"\x03\x00")  # an empty last block
        end = self.file.tell()
        self.file.seek(start)
        self.file.write(head(crc, packed + 2, n))
        self.file.seek(end)
        self.entries.append(struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0x800, 8, 0, 0x21, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(raw), 28, 0, 0, 0, 0, 0xFFFFFFFF) + raw + struct.pack("<HHQQQ", 1, 24, n, packed + 2, start))

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            start = self.file.tell()
            self.file.write(b"".join(self.entries))
            long, count = self.file.tell() - start, len(self.entries)
            self.file.write(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, count, count, long, start))
            self.file.write(struct.pack("<IIQI", 0x07064B50, 0, start + long, 1))
            self.file.write(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, min(count, 0xFFFF), min(count, 0xFFFF), 0xFFFFFFFF, 0xFFFFFFFF, 0))
        self.file.close()
