"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document.
Expectation-maximisation over the counts of vote patterns of all documents estimates
how often each labeller is right, without any given label.  The posterior of a
document's pattern is the soft label that a hashed linear scorer is trained on; the
scorer then judges every whole text by itself, also where no labeller votes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import materialize
from .linear import Model, Settings, fit, scored

BAD, NONE, GOOD = 0, 1, 2
SETTINGS = Settings(bits=16, l1=2.0, max_rows=8000)

SYMBOL = np.isin(np.arange(256), list(b"#$%&*+<=>@[]^_`{}~\\"))
STOP = np.isin(np.arange(256), list(b".!?"))


def _vote(value: float, good_to: float, bad_from: float) -> int:
    return GOOD if value <= good_to else BAD if value >= bad_from else NONE


def votes(text: bytes) -> list[int]:
    """One vote per labeller on a whole text.  Fewer than 5 words: all but the last abstain."""
    words, starts, ends = hashing.text_words(text)
    n = len(words)
    if n < 5:
        return [NONE] * (LABELLERS - 1) + [BAD if n == 0 else NONE]
    codes = np.frombuffer(text, np.uint8)
    last = codes[ends - 1]
    upper = np.count_nonzero((codes >= 65) & (codes <= 90))
    lower = np.count_nonzero((codes >= 97) & (codes <= 122))
    lines = [x for x in text.split(b"\n") if x.strip()]
    lengths = ends - starts
    sentences = np.count_nonzero(STOP[last])
    return [
        # symbols in the text
        _vote(np.count_nonzero(SYMBOL[codes]) / n, 0.02, 0.3),
        # shouting
        _vote(upper / max(upper + lower, 1), 0.2, 0.6),
        # words that end in an exclamation mark
        _vote(np.count_nonzero(last == 33) / n, 0.02, 0.2),
        # bars of tables and menus
        _vote(np.count_nonzero((codes[starts] == 124) & (lengths == 1)) / n, 0.01, 0.15),
        # repeated words, against what a text of this length may repeat
        _vote(1 - len(np.unique(words)) / n, 0.75, 0.93),
        # repeated lines
        _vote(1 - len(set(lines)) / max(len(lines), 1), 0.2, 0.5),
        # sentence ends
        GOOD if 0.02 <= sentences / n <= 0.5 else BAD,
        # words that end in a symbol or bar
        _vote(np.count_nonzero(SYMBOL[last] | (last == 124)) / n, 0.02, 0.2),
        # length
        GOOD if n >= 40 else NONE,
    ]


LABELLERS = 9


def vote_patterns(rows: DataFrame) -> DataFrame:
    """``(place, pattern)`` of ``rows(place, text)``; patterns are votes as digits in base 3."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = 3 ** np.arange(LABELLERS)
        for batch in batches:
            patterns = [int(np.dot(votes(t or b""), base)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(patterns, pa.int64())], names=["place", "pattern"])

    return rows.select("place", F.col("text").cast("binary")).mapInArrow(work, "place string, pattern long")


def posteriors(counts: dict[int, int], rounds: int = 100) -> dict[int, float]:
    """Probability of good quality per vote pattern, by expectation-maximisation.

    The model: a document is good or bad, and each labeller votes independently given
    that, abstaining included.  The start counts a bad vote like ten good ones, since a
    text has few ways to be good and many to be bad; it also fixes which class is which.
    """
    if not counts:
        return {}
    patterns = np.array(sorted(counts))
    weight = np.array([counts[p] for p in patterns.tolist()], float)
    vote = patterns[:, None] // 3 ** np.arange(LABELLERS) % 3
    one_hot = np.stack([vote == v for v in (BAD, NONE, GOOD)], axis=2).astype(float)
    good, bad = (vote == GOOD).sum(1), (vote == BAD).sum(1)
    p = (good + 1) / (good + 10 * bad + 2)
    for _ in range(rounds):
        tables = []
        for share in (p, 1 - p):
            # Add-one smoothing keeps votes that were never seen possible.
            table = (one_hot * (weight * share)[:, None, None]).sum(0) + 1
            tables.append(np.log(table / table.sum(1, keepdims=True)))
        prior = ((weight * p).sum() + 1) / (weight.sum() + 2)
        odds = np.log(prior / (1 - prior)) + (one_hot * (tables[0] - tables[1])).sum((1, 2))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - p).max() < 1e-6:
            break
        p = new
    return dict(zip(patterns.tolist(), p.tolist(), strict=True))


def style(text: bytes) -> np.ndarray:
    """Hashed features of a whole text: words, shares of word shapes in steps of two,
    length, and shares of distinct words and of sentence ends in steps of a twentieth."""
    words, starts, ends = hashing.text_words(text)
    if not len(words):
        return np.zeros(1, np.int32)
    codes = np.frombuffer(text, np.uint8)
    kind = np.full(256, 1, np.uint64)
    kind[list(range(65, 91))], kind[list(range(97, 123))], kind[list(range(48, 58))] = 2, 3, 4
    kind[128:] = 5
    kind[list(b"!#$%&*+<=>@[]^_`{}~\\|")] = range(10, 31)
    shape = kind[codes[starts]] + 64 * kind[codes[ends - 1]] + 4096 * (ends - starts == 1).astype(np.uint64)
    shapes, n = np.unique(shape, return_counts=True)
    step = np.floor(np.log2(n / len(words))).astype(np.int64) + 40
    fresh = 20 * len(np.unique(words)) // len(words)
    stops = 20 * np.count_nonzero(STOP[codes[ends - 1]]) // len(words)
    whole = np.array([np.log2(len(words)), 100 + fresh, 200 + stops], np.uint64)
    salts = hashing.constants(3, 505)
    found = [
        hashing.mix(shapes * salts[0] + step.astype(np.uint64)),
        hashing.mix(words * salts[1]),
        hashing.mix(whole * salts[2]),
    ]
    return (np.concatenate(found) >> np.uint64(64 - SETTINGS.bits)).astype(np.int32)


def train(docs: DataFrame, id_column: str, text_column: str, settings: Settings = SETTINGS) -> Model:
    """The scorer, from all documents' votes and at most ``settings.max_rows`` soft labels.

    The patterns of all documents are counted; there are 3 ** ``LABELLERS`` at most, so
    the counts fit the driver.  Soft labels come from the documents first by a hash of
    id and text.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"))
    place = F.md5(F.concat_ws(":", F.col("id").cast("string"), F.md5(F.coalesce("text", F.lit("")))))
    rows = rows.withColumn("place", place)
    voted = materialize(vote_patterns(rows), "votes")
    counted = voted.groupBy("pattern").agg(F.count("*").alias("n"))
    known = posteriors({r["pattern"]: r["n"] for r in counted.collect()})
    chosen = voted.distinct().orderBy("place").limit(settings.max_rows)
    labels = docs.sparkSession.createDataFrame(list(known.items()), "pattern long, target double")
    chosen = chosen.join(F.broadcast(labels), "pattern").select("place", "target")
    # At most max_rows hashes and labels are broadcast.
    sample = rows.join(F.broadcast(chosen), "place")
    sample = sample.groupBy("place", "target").agg(F.min("text").alias("text"))
    return fit(sample, style, settings)


def quality(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: float = 0.5) -> DataFrame:
    """Quality of every whole text, learned without given labels.

    Returns one row per row of ``docs``: ``doc_id``, ``score`` (0 to 1, higher is
    better) and ``kept`` (score of at least ``least``).

    * Null and empty texts, and texts without words, are bad by vote; they share one
      feature and so one score.
    * Rows without an id are scored and used like others.
    * Repeated rows are counted each in the votes and used once in the training.
    * Equal texts get equal scores.  Other columns are not read.  An empty table gives
      an empty result.
    """
    model = train(docs, id_column, text_column)
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    found = scored(rows, ["doc_id"], "text", model, style, "score")
    return found.withColumn("kept", F.col("score") >= least)
