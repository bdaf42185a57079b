"""Token counts under a unigram model, on a trie of pre-tokens (operator 5).

The pieces are a public vocabulary; with no counts published, the i-th piece
gets the Zipf probability in proportion to 1 / (i + 2.7). The tokens of a
pre-token are those of its best segmentation. The distinct new pre-tokens of
many texts make a trie, which is laid out and walked depth first in sorted
order; a node's forward score is the best over the pieces that end there of the
score before the piece plus the piece's, and is computed once for all
pre-tokens that begin alike. What terminal nodes hold, the number of tokens on
the best path, is kept, and texts only look their pre-tokens up. Any single
byte is a piece, so every text has a segmentation. Of equal scores the one with
fewer tokens counts.

Pre-tokens are runs of non-space bytes with the one space before them, and runs
of further white space. Null and empty texts have none. Repeated rows, and rows
with equal ids, are counted one by one and alike. Texts of any length are counted
whole; a pre-token may be as long as its text. Of the columns only doc_id and
text are read. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import Buffer, arrow_schema, rows, table

PRETOKEN = re.compile(rb" ?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+?(?=\x20?[^\x20\x09-\x0D]|$)|[\x20\x09-\x0D]+")
SHIFT = 2.7
#: Terminal counts that a Python process keeps.
KEPT = 500_000
#: Texts whose new pre-tokens make a trie together.
TEXTS = 1024


class Model:
    """Scores of pieces, and the terminal counts of the pre-tokens seen so far."""

    def __init__(self, pieces: list[bytes], shift: float = SHIFT):
        norm = math.log(sum(1 / (i + shift) for i in range(len(pieces))))
        self.score: dict[bytes, float] = {}
        for i, piece in enumerate(pieces):
            self.score.setdefault(piece, -math.log(i + shift) - norm)
        for b in range(256):
            self.score.setdefault(bytes([b]), -math.log(len(pieces) + 256 + shift) - norm)
        self.longest = max(map(len, self.score))
        self.counts: dict[bytes, int] = {}

    def insert(self, words: list[bytes]) -> None:
        """Walks the trie of sorted distinct pre-tokens: the path to the last node is the stack of forward scores."""
        score, longest, before = self.score.get, self.longest, b""
        best, tokens = [0.0], [0]
        for word in words:
            at, common = 0, min(len(before), len(word))
            while at < common and before[at] == word[at]:
                at += 1
            del best[at + 1 :], tokens[at + 1 :]
            for end in range(at + 1, len(word) + 1):
                high, fewest = -math.inf, 0
                for start in range(end - longest if end > longest else 0, end):
                    own = score(word[start:end])
                    if own is not None:
                        own += best[start]
                        if own > high or own == high and tokens[start] < fewest - 1:
                            high, fewest = own, tokens[start] + 1
                best.append(high)
                tokens.append(fewest)
            self.counts[word] = tokens[-1]
            before = word

    def count(self, texts: list[bytes | None]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        own = [PRETOKEN.findall(t) if t else [] for t in texts]
        kept = self.counts
        new = {w for words in own for w in words if w not in kept}
        if len(kept) + len(new) > KEPT:
            kept.clear()
            new = {w for words in own for w in words}
        self.insert(sorted(new))
        return [(len(words), sum(map(kept.__getitem__, words))) for words in own]


_models: dict[str, Model] = {}


def model(path: str) -> Model:
    """One model for each vocabulary file in each Python process."""
    if path not in _models:
        import base64

        with open(path, "rb") as file:
            _models[path] = Model([base64.b64decode(line.split()[0]) for line in file])
    return _models[path]


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens, n_bytes) for every row of docs."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    out = pa.schema([arrow_schema(docs.select("doc_id")).field(0), ("n_pretokens", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())])

    def run(batches):
        own, buffer = model(path), Buffer(out)
        for some in batched(rows(batches, "doc_id", "text"), TEXTS):
            for (doc_id, text), found in zip(some, own.count([t for _, t in some]), strict=True):
                buffer.add(doc_id, *found, len(text or b""))
            yield buffer.take()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_pretokens bigint, n_tokens bigint, n_bytes bigint")


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document."""
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary()).select(F.col("doc_id"), "n_pretokens", "n_tokens", "n_bytes")
