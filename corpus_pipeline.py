"""The corpus pipeline: from documents to packed token sequences, in stages.

Each stage works on all that its predecessor kept and returns the columns of
documents, so that the next can read them from Parquet; the last returns the
pieces of the packed sequences. Ids are of any type that has an order, and may be
null or repeat. Texts may be null or empty: they are not toxic, have no near
duplicates, benchmark words or secrets, and are packed as their end token.
Rows that repeat a text are near duplicates; one of them stays, and of those of
one id (a tie) any. Texts of any length are worked on whole in every stage.
Other columns are handed on as they are up to the packing; columns that stages
add on the way begin with ``_tl_`` or are qualified by their table, so no name
clashes. An empty table gives an empty result in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.llm.common import small, stored, table, text_key
from tramline.llm.decontamination import contaminated_keys
from tramline.llm.neardup import keep_one
from tramline.llm.packing import pack, vocabulary
from tramline.llm.secrets import redact
from tramline.llm.toxicity import score_toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier not toxic than toxic, by a model learned from the labelled ones; without labels all stay."""
    scored = score_toxicity(docs, docs, table(spark, sf_dir, "labels"), column="_tl_score")
    return scored.where("_tl_score < 0.5").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are similar to 0.8 or more, that of the least id; null and empty texts all stay."""
    return keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten words of a benchmark item occurs; without items, all."""
    leaked = small(contaminated_keys(docs, table(spark, sf_dir, "benchmark")), 64)
    return docs.join(leaked, text_key(docs["text"]) == leaked["key"], "left_anti")


def cut_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret in a text, or run of secrets that overlap, replaced by a mark."""
    return redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens; a document without text is its end token."""
    return pack(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", cut_secrets),
    ("packing", pack_sequences),
]

#: The toxicity model can't be expressed in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
