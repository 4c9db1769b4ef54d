"""Repeated passages across documents: MinHash banding of paragraphs, verified and clustered.

A paragraph ends at a line end, or at the end of a sentence of at least ``SENTENCE``
words.  These cuts depend on the text near them alone, so a passage pasted into other
text is cut alike everywhere, also in the middle of a line.  Short sentences are
joined with what follows, which keeps paragraphs long enough to be telling.

Passages without such cuts of their own (short or unpunctuated sentences, lines broken
elsewhere) are found by windows of ``WINDOW`` words, compared exactly.  They begin where
the words' hash is least among ``EVERY`` neighbours, so whatever stands around an exact
copy of ``n`` words and however it is cut, neighbouring windows cover ``n - 22`` of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import hashing
from .collide import link
from .common import materialize, packed, unpacked
from .components import components

SENTENCE = 12
# Windows follow each other by EVERY words at most, so they leave no gap, and 47 equal
# words hold 25 that are covered.
WINDOW = 13
EVERY = 12
ANCHOR = 3
# 6 bands of 3 coordinates: a pair of similarity 0.8 meets with a probability of
# 1 - (1 - 0.8**3)**6 = 0.986, one of 0.9 with 0.9996, an equal one always.
BANDS = 6
ROWS = 3

# Texts are cut together in runs of about so many bytes.
RUN_BYTES = 1 << 18

UNITS = (
    "doc_id long, start long, end long, first long, size long, words long, digest binary, tokens array<long>, mark long"
)


def _stops() -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(b".!?")] = True
    return out


def cuts(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, sentence: int) -> np.ndarray:
    """Index of the last word of every paragraph of texts joined by line ends, given their words."""
    line_end = np.zeros(len(starts), bool)
    breaks = np.searchsorted(starts, np.flatnonzero(codes == 10)) - 1
    line_end[breaks[breaks >= 0]] = True
    line_end[-1] = True
    at = np.flatnonzero(_stops()[codes[ends - 1]] | line_end)
    return at[(np.diff(at, prepend=-1) >= sentence) | line_end[at]]


def _sliding(values: np.ndarray, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every ``EVERY`` neighbouring values."""
    out, width = values, 1
    while width < EVERY:
        step = min(width, EVERY - width)
        out, width = pick(out[:-step], out[step:]), width + step
    return out


def _without_overlaps(at: np.ndarray, hashes: np.ndarray) -> list[int]:
    """Text that repeats itself: which windows stay so that equal ones do not overlap."""
    last: dict[int, int] = {}
    keep = []
    for i, (place, value) in enumerate(zip(at.tolist(), hashes.tolist(), strict=True)):
        if place - last.get(value, -WINDOW) >= WINDOW:
            last[value] = place
            keep.append(i)
    return keep


def windows(words: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every window of texts whose words end at ``until``.

    Texts of fewer than ``WINDOW + EVERY`` words have none.
    """
    counts = np.diff(until, prepend=0)
    if len(words) < WINDOW + EVERY:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    keys = hashing.shingle_hashes(words, ANCHOR)
    least = _sliding(keys, np.minimum)
    # Runs of neighbours that do not lie in one text of enough words count as 0.
    ends = np.repeat(np.where(counts >= WINDOW + EVERY, until, 0), counts)[: len(least)]
    least[np.arange(len(least)) + EVERY + ANCHOR - 1 > ends] = 0
    edge = np.zeros(EVERY - 1, np.uint64)
    # Least of some run of neighbours: the largest of the least values of its runs is its own.
    chosen = _sliding(np.concatenate((edge, least, edge)), np.maximum) == keys
    at = np.flatnonzero(chosen)
    of = np.searchsorted(until, at, side="right")
    inside = (at + WINDOW <= until[of]) & (counts[of] >= WINDOW + EVERY)
    at, of = at[inside], of[inside]
    factors = hashing.constants(WINDOW, 1000 + WINDOW)
    total = np.zeros(len(at), np.uint64)
    for j in range(WINDOW):
        total += words[at + j] * factors[j]
    hashes = hashing.mix(total)
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1]))
    if len(again):
        stays = np.ones(len(at), bool)
        for text in np.unique(of[again]).tolist():
            lo, hi = np.searchsorted(of, [text, text + 1])
            stays[lo:hi] = False
            stays[lo + np.array(_without_overlaps(at[lo:hi], hashes[lo:hi]))] = True
        at, hashes = at[stays], hashes[stays]
    return at, hashes


def _runs(ids: list, texts: list) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Ids and texts in runs of about ``RUN_BYTES``; a longer text may make its own."""
    at, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or b"") + 1
        if size >= RUN_BYTES or i + 1 == len(texts):
            yield np.array(ids[at : i + 1], np.int64), [t or b"" for t in texts[at : i + 1]]
            at, size = i + 1, 0


def _sizes(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Number of distinct values of each of the consecutive sets of ``counts`` values."""
    of = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    # Sets with equal low bits may repeat a value.
    keys = np.sort(of << np.uint64(32) | values & np.uint64(0xFFFFFFFF))
    out, begins = counts.copy(), np.cumsum(counts) - counts
    for i in np.unique(keys[1:][keys[1:] == keys[:-1]] >> np.uint64(32)).astype(np.int64).tolist():
        out[i] = len(hashing.distinct(values[begins[i] : begins[i] + counts[i]]))
    return out


def _shingles(words: np.ndarray, first: np.ndarray, last: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every paragraph's shingles, repeated ones too, and their number."""
    counts = np.maximum(last - first + 2 - shingle, 1)
    values = np.empty(int(counts.sum()), np.uint64)
    begins = np.cumsum(counts) - counts
    few = last - first + 1 < shingle
    if len(words) >= shingle:
        place = np.repeat(first - begins, counts) + np.arange(len(values))
        whole = np.repeat(~few, counts)
        values[whole] = hashing.shingle_hashes(words, shingle)[place[whole]]
    for i in np.flatnonzero(few).tolist():
        values[begins[i]] = hashing.shingle_hashes(words[first[i] : last[i] + 1], shingle)[0]
    return values, counts


def units(
    docs: DataFrame, id_column: str, text_column: str, shingle: int, min_words: int, sentence: int = SENTENCE
) -> DataFrame:
    """Paragraphs of at least ``min_words`` words with place, set size, digest and band tokens.

    Whatever has the length at which sentences are cut is judged too.  ``start`` and
    ``end`` count characters, ``first`` and ``words`` count words.  Windows have the
    bytes of their hash as ``mark`` and neither size, digest nor tokens.
    """
    shortest = min(min_words, sentence)
    names = [f.split()[0] for f in UNITS.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _runs(*(c.to_pylist() for c in batch.columns)):
                joined = b"\n".join(texts).lower()
                words, starts, ends = hashing.text_words(joined)
                if not len(words):
                    continue
                codes = np.frombuffer(joined, np.uint8)
                begins = np.cumsum([0] + [len(t) + 1 for t in texts])
                until = np.searchsorted(starts, begins[1:])
                begun = until - np.diff(until, prepend=0)
                chars = np.concatenate(([0], np.cumsum((codes & 0xC0) != 0x80)))

                def places(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
                    """Id, first and last character and first word of the words ``a`` to ``b`` of one text each."""
                    of = np.searchsorted(until, a, side="right")
                    base = chars[begins[of]]
                    return [ids[of], chars[starts[a]] - base, chars[ends[b]] - base, a - begun[of]]

                last = cuts(codes, starts, ends, sentence)
                first = np.concatenate(([0], last[:-1] + 1))
                long = last + 1 - first >= shortest
                first, last = first[long], last[long]
                if len(first):
                    values, counts = _shingles(words, first, last, shingle)
                    sign = hashing.least(values, np.cumsum(counts) - counts, BANDS * ROWS).astype(np.uint64)
                    sign = sign.reshape(-1, BANDS, ROWS)
                    factors = hashing.constants(BANDS * ROWS, 91).reshape(BANDS, ROWS)
                    tokens = hashing.mix((sign * factors).sum(axis=2, dtype=np.uint64) + factors[:, 0]).view(np.int64)
                    offsets = np.arange(len(first) + 1, dtype=np.int32) * BANDS
                    numbers = [*places(first, last), _sizes(values, counts), last + 1 - first]
                    digests = [hashing.digest(words[a : b + 1]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                    columns = [pa.array(c.astype(np.int64)) for c in numbers] + [pa.array(digests, pa.binary())]
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens.ravel())))
                    columns.append(pa.nulls(len(first), pa.int64()))
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                # Texts too short to be judged have no windows either.
                at, hashes = windows(words, until)
                if shortest > WINDOW + EVERY:
                    enough = np.diff(until, prepend=0)[np.searchsorted(until, at, side="right")] >= shortest
                    at, hashes = at[enough], hashes[enough]
                if len(at):
                    n = len(at)
                    columns = [pa.array(c.astype(np.int64)) for c in places(at, at + WINDOW - 1)]
                    columns += [pa.nulls(n, pa.int64()), pa.array(np.full(n, WINDOW, np.int64))]
                    columns += [pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(pa.int64())), pa.array(hashes.byteswap().view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    return rows.where("doc_id is not null").mapInArrow(work, UNITS)


def repeated_paragraphs(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    min_words: int = 16,
    min_span: int = 25,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Paragraphs that recur in other documents, exactly or with ``percent`` Jaccard similarity.

    Returns one row per recurring paragraph, survivors too: ``doc_id``, ``start`` and
    ``end`` (characters), ``words``, ``component_id`` (a number per cluster),
    ``keep_doc_id`` and ``keep_start`` (the cluster's first paragraph by id and place)
    and ``kept`` (true for that one).  Paragraphs of fewer than ``min_words`` and
    ``SENTENCE`` words are not judged, and a run of neighbouring recurring paragraphs
    counts from ``min_span`` words on, so stock phrases stay.

    Windows that recur exactly are rows as well, in clusters of their own, of negative
    numbers.  They overlap with paragraphs and each other.

    * Null or empty texts have no paragraph; rows without an id take no part.
    * A paragraph that recurs only under its own id (in one text, or in repeated rows)
      is no repeat.
    * Documents without a recurring paragraph have no row; an empty table has no result.
    * Other columns of ``docs`` are not read.

    Equal paragraphs are collapsed before banding, so a passage that a third of all
    documents hold posts its tokens once.
    """
    places = materialize(units(docs, id_column, text_column, shingle, min_words), "paragraphs")
    marks = places.where("mark is not null").select("doc_id", "start", "end", "first", "mark")
    places = places.where("mark is null")
    first = F.min(F.struct("doc_id", "start", "end", "size", "tokens")).alias("first")
    classes = places.groupBy("digest").agg(first, F.max("doc_id").alias("last"))
    classes = materialize(
        classes.select(F.monotonically_increasing_id().alias("node"), "digest", "first.*", "last"), "classes"
    )
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    span = F.expr("substring(text, cast(start as int) + 1, cast(end - start as int))")

    def texts_of(nodes: DataFrame) -> DataFrame:
        # A whole text may hold many paragraphs, so they are cut out in the join.
        named = nodes.join(classes.select("node", "doc_id", "start", "end"), "node")
        none = F.lit(None).cast("binary").alias("signature")
        return source.join(named, "doc_id").select("node", span.alias("text"), none)

    # Bands of three coordinates hardly meet by chance, so they need no sketch.
    tokens = classes.select(F.explode("tokens").alias("token"), "node", "size", F.lit(0).cast("long").alias("bits"))
    links = link(tokens, texts_of, shingle, percent)
    found = components(links)
    named = classes.join(found, "node", "left").withColumn("component_id", F.coalesce("component", "node"))
    clusters = named.groupBy("component_id").agg(
        F.min(F.struct("doc_id", "start", "end")).alias("keep"), F.max("last").alias("last")
    )
    clusters = clusters.where("keep.doc_id < last").drop("last")
    shared = named.select("digest", "component_id").join(clusters, "component_id")
    rows = places.select("doc_id", "start", "end", "first", "words", "digest").join(shared, "digest")

    # Few windows recur, so only those are carried further.
    several = marks.groupBy("mark").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last"))
    several = several.where("least < last").select("mark")
    again = materialize(marks.join(several, "mark"), "windows")
    # Clusters are numbered in the order of the hashes' bytes.
    digest = F.unhex(F.lpad(F.hex("mark"), 16, "0")).alias("digest")
    firsts = again.groupBy(digest).agg(F.min(F.struct("doc_id", "start", "end")).alias("keep"), F.min("mark").alias("mark"))
    firsts = firsts.drop("digest")
    firsts = materialize(firsts.withColumn("component_id", -1 - F.monotonically_increasing_id()), "first-windows")
    again = again.join(firsts, "mark").withColumn("words", F.lit(WINDOW).cast("long"))
    rows = rows.drop("digest").unionByName(again.drop("mark"))
    # What overlaps the copy that stays, in a text that repeats itself, stays with it.
    inside = (F.col("doc_id") == F.col("keep.doc_id")) & (F.col("start") > F.col("keep.start"))
    rows = rows.where(~(inside & (F.col("start") < F.col("keep.end"))))

    # Neighbours: at most a judged paragraph's length of unjudged words between them.
    order = Window.partitionBy("doc_id").orderBy("first", "words")
    until = F.col("first") + F.col("words")
    before = F.max(until).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("before", before)
    rows = rows.withColumn("run", F.when(F.col("first") - F.col("before") < min_words, 0).otherwise(1))
    rows = rows.withColumn("run", F.sum("run").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # Words that several rows cover count once.
    fresh = until - F.greatest("first", F.coalesce("before", "first"))
    span_words = F.sum(F.greatest(fresh, F.lit(0))).over(Window.partitionBy("doc_id", "run"))
    rows = rows.withColumn("span", span_words).where(F.col("span") >= min_span)
    return rows.select(
        "doc_id",
        "start",
        "end",
        "words",
        "component_id",
        F.col("keep.doc_id").alias("keep_doc_id"),
        F.col("keep.start").alias("keep_start"),
        ((F.col("doc_id") == F.col("keep.doc_id")) & (F.col("start") == F.col("keep.start"))).alias("kept"),
    )


def without_repeats(
    docs: DataFrame, repeats: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with the paragraphs that ``repeats`` marks as not kept cut out of their texts.

    Overlapping spans are cut once; an earlier copy of every word that goes is left.  The spans of one document are gathered; their number is bounded by its length.
    Texts without such spans, null texts and rows without an id stay as they are.
    """
    dropped = repeats.where("not kept").groupBy(F.col("doc_id").alias("of"))
    spans = dropped.agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    rows = packed(docs, text_column, id=F.col(f"`{id_column}`").cast("long"), text=F.col(f"`{text_column}`"))
    cut = F.expr(
        """aggregate(spans, named_struct('at', 0L, 'text', ''),
            (s, x) -> named_struct('at', greatest(s.at, x.end), 'text', concat(s.text,
                substring(text, cast(s.at as int) + 1, cast(x.start - s.at as int)))),
            s -> concat(s.text, substring(text, cast(s.at as int) + 1)))"""
    )
    joined = rows.join(spans, F.col("id") == F.col("of"), "left")
    return unpacked(joined, docs.columns, **{text_column: F.when(F.col("spans").isNull(), F.col("text")).otherwise(cut)})
