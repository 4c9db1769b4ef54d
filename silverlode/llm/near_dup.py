"""MinHash near-duplicates by an inverted join of signature coordinates.

Every document posts itself under its (coordinate, value) pairs.  Two documents whose
similarity reaches the threshold agree in at least ``matches`` of ``coordinates``
pairs, except with a probability below one in ten thousand.  If they agree in that
many, they must share one of the first ``coordinates - matches + 1`` postings of
either, whatever the common order; so only this prefix is posted, rarest first,
which leaves out the values that a common passage gives to many documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing
from .collide import link
from .common import materialize, packed, unpacked
from .components import components

COORDINATES = 64
# At a similarity of 0.8 fewer than 36 of 64 coordinates agree once in 200,000 pairs.
MATCHES = 36
# Postings are counted in a table of fixed size; collisions only blur the order.
CELLS = 1 << 16

SKETCH = "doc_id long, size long, digest binary, signature binary"


def sketches(docs: DataFrame, id_column: str, text_column: str, shingle: int) -> DataFrame:
    """Set size, set digest and signature of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            sizes, digests, signs = [], [], []
            for at in range(0, len(texts), 256):
                sets = list(hashing.shingle_sets(texts[at : at + 256], shingle))
                full = [s for s in sets if len(s)]
                sign = iter(hashing.signatures(full, COORDINATES) if full else ())
                for s in sets:
                    sizes.append(len(s))
                    digests.append(hashing.digest(s) if len(s) else None)
                    signs.append(next(sign).tobytes() if len(s) else None)
            columns = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signs, pa.binary())]
            yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "size", "digest", "signature"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    return rows.mapInArrow(work, SKETCH)


def _tokens(signature: np.ndarray) -> np.ndarray:
    """One 64-bit token per coordinate and value."""
    return hashing.mix(signature.astype(np.uint64) + hashing.constants(signature.shape[1], 55)[None, :])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), COORDINATES)


def posting_counts(classes: DataFrame) -> np.ndarray:
    """How often tokens of each cell occur; a table of ``CELLS`` numbers, whatever the input."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            if batch.num_rows:
                cells = (_tokens(_matrix(batch.column(0))) % np.uint64(CELLS)).ravel().astype(np.int64)
                total += np.bincount(cells, minlength=CELLS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["cell", "n"])

    counts = np.zeros(CELLS, np.int64)
    per_task = classes.select("signature").mapInArrow(work, "cell long, n long")
    for row in per_task.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[row["cell"]] = row["n"]
    return counts


def postings(classes: DataFrame, counts: np.ndarray) -> DataFrame:
    """``(token, node, size, bits)`` of every class's prefix, rarest tokens first."""
    prefix = COORDINATES - MATCHES + 1
    shared = classes.sparkSession.sparkContext.broadcast(counts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signature = _matrix(batch.column(2))
            tokens = _tokens(signature)
            order = np.lexsort((tokens, shared.value[(tokens % np.uint64(CELLS)).astype(np.int64)]))
            chosen = np.take_along_axis(tokens, order[:, :prefix], axis=1).view(np.int64)
            offsets = np.arange(len(chosen) + 1, dtype=np.int32) * prefix
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(chosen.ravel()))
            bits = pa.array(hashing.low_bits(signature))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], bits, lists], names=["node", "size", "bits", "tokens"])

    posted = classes.select("node", "size", "signature").mapInArrow(
        work, "node long, size long, bits long, tokens array<long>"
    )
    return posted.select(F.explode("tokens").alias("token"), "node", "size", "bits")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Groups of documents linked by word-shingle sets of at least ``percent`` Jaccard similarity.

    Returns one row per input row: ``doc_id``, ``n_shingles`` (size of its set),
    ``component_id`` (smallest id reachable over links, itself included) and
    ``kept`` (``doc_id = component_id``).  A-Z are lower-cased; words are runs of
    non-space characters; fewer words than ``shingle`` make one shingle.

    * Null or empty texts and texts without words have no shingle and no link.
    * Rows without an id are never linked: ``component_id`` is null and they are kept.
    * Rows that repeat an id are one document; its texts link all of them.
    * Other columns of ``docs`` are not read.  An empty table gives an empty result.

    Equal sets are collapsed first.  Classes and postings are written to the shared
    folder.  Only ``CELLS`` counts are collected and broadcast.
    """
    rows = materialize(sketches(docs, id_column, text_column, shingle), "sketches")
    linkable = rows.where("doc_id is not null and size > 0")
    first = F.min(F.struct("doc_id", "size", "signature")).alias("first")
    classes = linkable.groupBy("digest").agg(first)
    classes = classes.select("digest", F.col("first.doc_id").alias("node"), "first.size", "first.signature")
    classes = materialize(classes, "classes")
    source = docs.select(F.col(id_column).cast("long").alias("node"), F.col(text_column).alias("text"))

    def texts_of(nodes: DataFrame) -> DataFrame:
        return source.join(nodes.join(classes.select("node", "signature"), "node"), "node")

    links = link(postings(classes, posting_counts(classes)), texts_of, shingle, percent, MATCHES)
    named = linkable.select("doc_id", "digest").join(classes.select("digest", "node"), "digest")
    several = named.groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    repeated = named.join(several.select("doc_id", "lo"), "doc_id").select("lo", "node").distinct()
    found = components(links.union(repeated))
    groups = classes.select("digest", "node").join(found, "node", "left")
    groups = groups.select("digest", F.coalesce("component", "node").alias("component_id"))
    alone = rows.where("doc_id is null or size = 0").select("doc_id", "size", F.col("doc_id").alias("component_id"))
    joined = linkable.select("doc_id", "size", "digest").join(groups, "digest").select("doc_id", "size", "component_id")
    return joined.union(alone).select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate group, that with the smallest id.

    Rows without an id stay.  Equal rows are one document and collapse; rows that share
    an id with different values stay or go together.
    """
    groups = near_duplicates(docs, shingle, percent, id_column, text_column)
    kept = groups.where("kept and doc_id is not null").select(F.col("doc_id").alias("of")).distinct()
    rows = packed(docs, id=F.col(f"`{id_column}`").cast("long"))
    named = rows.join(materialize(kept, "kept"), F.col("id") == F.col("of"), "left_semi")
    # Equal ids already lie together, so this needs no other shuffle.
    named = named.dropDuplicates(["id", "row"])
    return unpacked(named.union(rows.where("id is null").dropDuplicates()), docs.columns)
