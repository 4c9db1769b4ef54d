"""Periodic runs of words, found with a suffix automaton and link-cut access.

Words are appended one by one.  The suffix links of the automaton form a tree whose
path from a prefix to the root lists the classes of the prefix's suffixes; a class has
the colour of its last occurrence's end.  Appending word ``i`` recolours that path,
which is the access operation of a link-cut tree: its preferred paths are the segments
of one colour, and O(log n) segments are met per word, amortised.  A segment of colour
``p`` whose longest class has ``l`` words says that ``l`` words, and no more, end both
at ``p`` and at ``i``.  If ``d = i - p`` is at most ``l``, the words from ``p - l + 1``
to ``i`` have the smallest period ``d``; ``l`` being the longest, they do not extend to
the left, and the largest such ``i`` ends the run.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import WORD, div

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def suffix_automaton(letters: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """(suffix link, longest length) per state, and the state of every prefix.  State 0 is the root."""
    link, length, steps, prefixes = [-1], [0], [{}], []
    last = 0
    for letter in letters:
        state = len(link)
        link.append(0)
        length.append(length[last] + 1)
        steps.append({})
        at = last
        while at >= 0 and letter not in steps[at]:
            steps[at][letter] = state
            at = link[at]
        if at >= 0:
            to = steps[at][letter]
            if length[to] == length[at] + 1:
                link[state] = to
            else:
                copy = len(link)
                link.append(link[to])
                length.append(length[at] + 1)
                steps.append(steps[to].copy())
                link[to] = link[state] = copy
                while at >= 0 and steps[at].get(letter) == to:
                    steps[at][letter] = copy
                    at = link[at]
        prefixes.append(state)
        last = state
    return link, length, prefixes


class Paths:
    """Preferred paths of a rooted tree as splay trees, ordered by depth.

    All nodes of a path have one colour, which is kept at the root of its splay tree;
    -1 stands for none.
    """

    def __init__(self, parent: list[int]):
        n = len(parent)
        self.up = list(parent)
        self.above, self.below = [-1] * n, [-1] * n
        self.colour = [-1] * n

    def _rotate(self, x: int) -> None:
        up, above, below = self.up, self.above, self.below
        p = up[x]
        top = up[p]
        if above[p] == x:
            inner = below[x]
            above[p], below[x] = inner, p
        else:
            inner = above[x]
            below[p], above[x] = inner, p
        if inner >= 0:
            up[inner] = p
        up[p], up[x] = x, top
        if top >= 0:
            if above[top] == p:
                above[top] = x
            elif below[top] == p:
                below[top] = x

    def _inner(self, x: int) -> bool:
        """Whether ``x`` has a parent within its splay tree."""
        p = self.up[x]
        return p >= 0 and (self.above[p] == x or self.below[p] == x)

    def _splay(self, x: int) -> None:
        """Make ``x`` the root of its splay tree, with the colour of the tree."""
        root = x
        while self._inner(root):
            root = self.up[root]
        colour = self.colour[root]
        while self._inner(x):
            p = self.up[x]
            if self._inner(p):
                self._rotate(p if (self.above[self.up[p]] == p) == (self.above[p] == x) else x)
            self._rotate(x)
        self.colour[x] = colour

    def access(self, node: int, colour: int) -> Iterator[tuple[int, int]]:
        """Recolour the path from ``node`` to the root.

        Yields the deepest node and the former colour of every segment that is met.
        """
        x, lower = node, -1
        while x >= 0:
            self._splay(x)
            former = self.colour[x]
            yield x, former
            cut = self.below[x]
            if cut >= 0:
                self.colour[cut] = former
            self.below[x] = lower
            lower, x = x, self.up[x]
        self._splay(node)
        self.colour[node] = colour


def runs(letters: Sequence[int], min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least both bounds, by start, then period.

    A run is a stretch with smallest period ``q``, not shorter than ``min_exponent * q``
    (2 at least), that no neighbour extends keeping the period.
    """
    link, length, prefixes = suffix_automaton(letters)
    paths = Paths(link)
    ends: dict[tuple[int, int], int] = {}
    for i, state in enumerate(prefixes):
        for node, last in paths.access(state, i):
            period = i - last
            if last >= 0 and period <= length[node]:
                start = last - length[node] + 1
                if i - start + 1 >= max(min_length, min_exponent * period):
                    ends[start, period] = i
    return sorted((start, end - start + 1, period) for (start, period), end in ends.items())


def stretches(letters: np.ndarray, gram: int) -> Iterator[tuple[int, int]]:
    """Begin and end of the stretches whose every ``gram`` letters occur elsewhere in the text as well."""
    n = len(letters) - gram + 1
    if n < 2:
        return
    keys = np.zeros(n, np.uint64)
    for j, factor in enumerate(hashing.constants(gram, 2000 + gram)):
        keys += letters[j : j + n] * factor
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    repeated = np.zeros(n + 2, np.int8)
    repeated[order[1:][same] + 1] = 1
    repeated[order[:-1][same] + 1] = 1
    edges = np.flatnonzero(np.diff(repeated))
    for begin, end in zip(edges[::2], edges[1::2], strict=True):
        yield int(begin), int(end) + gram - 1


def text_runs(words: list[bytes], min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """Runs of a whole text.

    In a run of ``l >= min_length`` words and period ``q <= l / min_exponent``, every
    ``g`` words have a twin one period away inside the run if ``l >= 2 * q + g - 1``.
    So runs lie in stretches of repeated ``g``-grams, and the automaton is built for
    those alone.  Colliding hashes of grams only lengthen stretches.
    """
    if len(words) < min_length:
        return []
    gram = min_length * (min_exponent - 2) // min_exponent + 1
    known: dict[bytes, int] = {}
    letters = [known.setdefault(w, len(known)) for w in words]
    found = []
    for begin, end in stretches(np.array(letters, np.uint64), gram):
        if end - begin >= min_length:
            found += [(begin + s, n, q) for s, n, q in runs(letters[begin:end], min_length, min_exponent)]
    return sorted(found)


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces, without those a run contains after its first period."""
    if found:
        keep = np.ones(len(words), bool)
        for start, size, period in found:
            keep[start + period : start + size] = False
        words = [words[i] for i in np.flatnonzero(keep)]
    return b" ".join(words)


def periodic_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_length: int = 24,
    min_exponent: int = 3,
) -> DataFrame:
    """All periodic runs of the words of every whole text, and the text with each run cut to one period.

    Returns one row per row of ``docs``: ``doc_id``, ``runs`` (an array of ``start``,
    ``length`` and ``period`` in words, by start, then period) and ``collapsed`` (the
    words that stay, joined by single spaces).  Words are the stretches between ASCII
    white space and are compared byte by byte.

    * Null and empty texts, and texts without words, have no runs and an empty
      ``collapsed``.
    * Rows without an id and repeated rows are rows of their own; other columns are
      not read.  An empty table gives an empty result.
    * A text is held by one task, with some 500 bytes for each word that lies in a
      stretch of repeated words; texts without such stretches need their words only.
    """
    if min_length < 1 or min_exponent < 2:
        raise ValueError("runs have at least two periods")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, texts = [], []
            for text in batch.column(1):
                words = (text.as_py() or b"").split()
                inside = text_runs(words, min_length, min_exponent)
                found.append([{"start": s, "length": n, "period": q} for s, n, q in inside])
                texts.append(collapsed(words, inside))
            columns = [batch.column(0), pa.array(found, pa.list_(RUN)), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(
        work, f"doc_id {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    )
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))


def planted(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, text)`` with a periodic tail in about a tenth of the texts, chosen by their ids.

    With ``h`` the CRC-32 of the id as text and ``g = h div 10``, texts of ``n`` words
    with ``h mod 10 = 0`` go on from word ``g mod n`` with a period of
    ``1 + (n - g mod n) div (3 + g mod 8)`` words.  Rows without an id stay as they are.
    """
    h = F.crc32(F.col(id_column).cast("string").cast("binary"))
    text = F.col(text_column).cast("string")
    chosen = docs.select(
        F.col(id_column).alias("doc_id"),
        text.alias("text"),
        F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).alias("words"),
        div(h, F.lit(10)).alias("g"),
    )
    n = F.nullif(F.size("words"), F.lit(0))
    a = (F.col("g") % n).cast("int")
    p = (F.lit(1) + div(n - a, F.lit(3) + F.col("g") % 8)).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    whole = F.concat(F.slice("words", F.lit(1), a), F.slice(tail, F.lit(1), n - a))
    return chosen.select("doc_id", F.when(n.isNotNull(), F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Number, most periodic run and digests of the rows of ``periodic_runs``."""

    def better(best: Column, run: Column) -> Column:
        # Ratios are compared exactly; of equal ones the first by start, then period, stays.
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    def line(run: Column) -> Column:
        return F.concat(F.concat_ws(",", *[run[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))

    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), better)
    rows = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        div(F.lit(1000) * F.col("best.length"), F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
