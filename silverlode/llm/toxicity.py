"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Unigrams are also taken of stems, the first bytes of longer words, since many
languages build insults as compounds.
"""

from __future__ import annotations

import string

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import packed, unpacked
from .linear import Model, Settings, fit, scored

SETTINGS = Settings()

# A-Z become a-z, ASCII punctuation becomes space; other bytes stay.
PLAIN = bytes.maketrans(
    (string.ascii_uppercase + string.punctuation).encode(),
    (string.ascii_lowercase + " " * len(string.punctuation)).encode(),
)


# Bytes of the stems.
STEMS = (4, 5, 6, 7)


def grams(text: bytes) -> np.ndarray:
    """Hashed unigrams, stems, bigrams and skip-grams (one word left out) of a whole text."""
    plain = text.translate(PLAIN)
    words, starts, ends = hashing.text_words(plain)
    codes = np.frombuffer(plain, np.uint8)
    one, two, skip, stem = hashing.constants(4, 404)
    found = [hashing.mix(words * one)]
    if len(words) > 1:
        found.append(hashing.mix(words[:-1] * two + words[1:]))
    if len(words) > 2:
        found.append(hashing.mix(words[:-2] * skip + words[2:]))
    for size in STEMS:
        first = starts[ends - starts > size]
        value = np.full(len(first), size, np.uint64)
        for j in range(size):
            value = value * stem + codes[first + j]
        found.append(hashing.mix(value))
    return (np.concatenate(found) >> np.uint64(64 - SETTINGS.bits)).astype(np.int32)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", settings: Settings = SETTINGS) -> Model:
    """Fit on at most ``settings.max_rows`` labelled documents, those first by a hash of the id.

    Held-out rows are not used.  Null ids and labels are ignored; of several labels
    for one id the largest counts, of several texts the first by code point.  Labels
    without a document are ignored.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(label).alias("target"))
    place = F.md5(F.concat(F.lit("toxicity:"), F.col("id").cast("string")))
    known = known.withColumn("place", place).orderBy("place").limit(settings.max_rows)
    text = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text"))
    # The side of at most max_rows ids and labels is broadcast.
    sample = text.join(F.broadcast(known), "id").groupBy("place", "target").agg(F.min("text").alias("text"))
    return fit(sample, grams, settings)


def toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Toxicity of every whole text.

    Returns one row per row of ``docs``: ``doc_id``, ``held_out``, ``score`` (0 to 1)
    and ``predicted`` (1 from a score of 0.5 on).  The text alone makes the score; id,
    source, language and labels do not.

    * Null and empty texts, and texts without words, get the score of the bias.
    * Rows without an id are scored and count as not held out.
    * Without labels nothing is rejected.  An empty table gives an empty result.
    * Equal texts get equal scores.  Other columns are not read.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    model = train(rows, labels)
    found = scored(rows, ["doc_id"], "text", model, grams, "score")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the model rejects (columns ``doc_id`` and ``text``).

    Null and empty texts have the score of the bias; extra columns may have any name.
    """
    rows = packed(docs, text=F.col("text").cast("string"))
    found = scored(rows, ["row"], "text", train(docs, labels), grams, "score")
    return unpacked(found.where("score < 0.5"), docs.columns)
