"""A training corpus from raw documents, in five stages of the library's operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs.  All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm import mixing, near_dup, pieces, site_lines, toxicity
from silverlode.llm.common import materialize, packed, prepare, unpacked
from silverlode.llm.queries import BUDGET_SHARE, MAX_EPOCHS, SOURCE_WEIGHTS, sentencepiece_model
from silverlode.llm.registry import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects go; null and empty texts are not toxic."""
    prepare(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on a large share of a source's documents go; ``n_chars`` follows the text.

    Documents stay, if need be with an empty text; null texts stay null.  Extra columns
    may have any name.
    """
    prepare(spark)
    text, length = F.col("text").cast("string"), F.col("n_chars")
    rows = packed(docs, "text", "n_chars", host=F.col("source"), text=text, n_chars=length)
    cleaned = site_lines.cleaned_lines(rows, F.col("host"))
    length = F.when(F.col("_dropped") > 0, F.length("text").cast("long")).otherwise(length)
    return unpacked(cleaned, docs.columns, text=F.col("text"), n_chars=length)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id.

    Shingles of five words, a similarity of 0.8.  Rows without an id stay.
    """
    prepare(spark)
    return near_dup.one_of_each(docs, shingle=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out, so that sources reach their target weights.

    Texts without words move no words and come as often as their source's whole epochs
    say.  Null sources are one source; rows without an id are rows of their own.
    """
    prepare(spark)
    return mixing.mixed_rows(docs, SOURCE_WEIGHTS, BUDGET_SHARE, MAX_EPOCHS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left; null and empty texts have none."""
    prepare(spark)
    return pieces.encoded(docs, sentencepiece_model(), ["doc_id", "lang", "source"])


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

# Learned weights, components and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``."""
    docs = table(prepare(spark), sf_dir.rstrip("/"), "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir.rstrip("/")), name.replace(" ", "-"))
    return docs
