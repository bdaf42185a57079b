"""Fill-in-middle transformation with a sparse checkpoint index (operator 11).

A text is a row of units: a run of ASCII letters, or any other code point. Two
cuts between units part it into prefix, middle and suffix, and the output has
the middle last, behind its marks. While the units of a text are counted, the
byte and the code-point offset of every EVERY-th unit are noted. A cut is found
by binary search among these checkpoints and a rescan of fewer than EVERY units
from there, so the index takes a small share of the text's memory and no text is
cut into a list of units. Texts are read in blocks of BLOCK bytes, so one of any
length, or a run of letters of any length, is worked on whole in bounded space
besides the text itself.

The cuts and the form are drawn from the SHA-256 of seed and id, so a row has
the same output wherever and whenever it is made. Null text counts as empty;
empty texts and texts that hold a mark stay plain, that is as they are. A null
id is drawn for as an empty one. Rows with equal ids have equal draws and rows
with equal ids and texts equal outputs. Of the columns only the id and the text
are read, whatever others are called. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import Buffer, arrow_schema, rows, table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Units between two checkpoints.
EVERY = 1024
#: Bytes that are looked at together.
BLOCK = 1 << 16
#: Of a hundred texts so many are transformed, and of a hundred of these so many have the suffix first.
RATE, SUFFIX_FIRST = 90, 20
SEED = 1
#: Bytes of outputs that wait to be handed on.
WAITING = 8 << 20

_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
#: Bytes that begin a code point.
_BEGINS = np.array([b & 0xC0 != 0x80 for b in range(256)])


def _unit_starts(text: bytes, start: int, stop: int, after_letter: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Of text[start:stop]: where units start, where code points start (both from ``start``), and whether it ends in a letter."""
    part = np.frombuffer(text, dtype=np.uint8, count=stop - start, offset=start)
    letter, begins = _LETTER[part], _BEGINS[part]
    before = np.empty_like(letter)
    before[0], before[1:] = after_letter, letter[:-1]
    return np.flatnonzero(begins & ~(letter & before)), begins, bool(letter[-1])


class Checkpoints:
    """How many units a text has, and the offsets of every EVERY-th."""

    def __init__(self, text: bytes, every: int = EVERY, block: int = BLOCK):
        self.text, self.every, self.block = text, every, block
        self.units, self.bytes, self.points = [0], [0], [0]
        n = points = 0
        after_letter = False
        for start in range(0, len(text), block):
            starts, begins, after_letter = _unit_starts(text, start, min(start + block, len(text)), after_letter)
            first = -n % every  # the place in ``starts`` of the first unit whose number is a multiple of ``every``
            if first < len(starts):
                passed = np.cumsum(begins)
                for k in range(first, len(starts), every):
                    if n + k:
                        at = int(starts[k])
                        self.units.append(n + k)
                        self.bytes.append(start + at)
                        self.points.append(points + int(passed[at]) - 1)
            n += len(starts)
            points += int(np.count_nonzero(begins))
        self.n, self.n_points = n, points

    def offset(self, unit: int) -> tuple[int, int]:
        """Bytes and code points before a unit; ``n`` stands for the end."""
        if unit >= self.n:
            return len(self.text), self.n_points
        k = bisect_right(self.units, unit) - 1
        seen, start, points = self.units[k], self.bytes[k], self.points[k]
        after_letter = False  # a checkpoint is the start of a unit
        span = min(self.block, 8 * self.every)
        while True:
            starts, begins, after_letter = _unit_starts(self.text, start, min(start + span, len(self.text)), after_letter)
            if unit - seen < len(starts):
                at = int(starts[unit - seen])
                return start + at, points + int(np.count_nonzero(begins[:at]))
            seen += len(starts)
            points += int(np.count_nonzero(begins))
            start, span = min(start + span, len(self.text)), self.block


def draws(one: object, seed: int = SEED) -> list[int]:
    """The four numbers that decide on a row."""
    digest = hashlib.sha256(f"{seed}:{'' if one is None else one}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12)]


def transform(text: bytes, draw: list[int], every: int = EVERY) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of the prefix, of the middle, output) of one text."""
    index = Checkpoints(text, every)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or draw[2] % 100 >= RATE:
        return index.n, "plain", None, None, text
    low, high = sorted((draw[0] % (index.n + 1), draw[1] % (index.n + 1)))
    (a, a_points), (b, b_points) = index.offset(low), index.offset(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draw[3] % 100 < SUFFIX_FIRST:
        return index.n, "spm", a_points, b_points - a_points, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return index.n, "psm", a_points, b_points - a_points, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def fill_in_middle(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: int = SEED) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) for every row of docs."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    out = pa.schema([arrow_schema(source).field(0), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    def run(batches):
        buffer, waiting = Buffer(out), 0
        for one, text in rows(batches, "id", "text", step=64):
            *made, output = transform(text or b"", draws(one.decode() if isinstance(one, bytes) else one, seed))
            buffer.add(one, *made, output)
            waiting += len(output)
            if buffer.full or waiting > WAITING:
                yield taken(buffer)
                waiting = 0
        yield taken(buffer)

    def taken(buffer: Buffer) -> pa.RecordBatch:
        *columns, output = buffer.columns
        buffer.columns = [[] for _ in out]
        first = pa.array([c.decode() if isinstance(c, bytes) else c for c in columns[0]], type=out.field(0).type)
        return pa.RecordBatch.from_arrays([first, *(pa.array(c, type=f.type) for c, f in zip(columns[1:], list(out)[1:-1], strict=True)), pa.array(output, type=pa.binary()).cast(pa.string())], schema=out)

    return source.mapInArrow(run, f"id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column) -> Column:
    """The text from which an output of a form was made. Marks end nowhere as they begin, so the first mark found is the one that was set."""

    def between(first: str, second: str) -> Column:
        start = F.locate(second, output) + 3
        end = F.locate(MIDDLE.decode(), output)
        lead, rest, middle = F.substring(output, F.lit(4), start - 7), F.substring(output, start, end - start), F.substring(output, end + 3, F.length(output))
        return F.concat(lead, middle, rest) if first == PREFIX.decode() else F.concat(rest, middle, lead)

    p, s = PREFIX.decode(), SUFFIX.decode()
    return F.when(form == "psm", between(p, s)).when(form == "spm", between(s, p)).otherwise(output)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the middle last, as digests of the output and of the text that it gives back."""
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


ORACLE_SQL = """
WITH source AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hex
  FROM documents
), numbers AS (
  SELECT *, len(units) AS n,
         [list_reduce(list_transform(string_split(substr(hex, 8 * k + 1, 8), ''), lambda c: strpos('0123456789abcdef', c)::BIGINT - 1), lambda a, b: a * 16 + b)
          FOR k IN [0, 1, 2, 3]] AS h
  FROM source
), cuts AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT *, coalesce(array_to_string(units[1:low], ''), '') AS prefix, coalesce(array_to_string(units[low + 1:high], ''), '') AS middle,
         coalesce(array_to_string(units[high + 1:], ''), '') AS suffix
  FROM cuts
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
