"""Links between sets that share a token, without writing out all pairs of a long list.

Members of lists of up to ``SHORT`` are paired if their sizes and one-bit sketches allow
similarity.  Members of longer lists are not compared with each other at first.  Such a
list has a pivot, and every member is compared with the pivots of its lists.  That is
the list's most connected member or, if that has a near copy which leads one of its
other lists, the most connected of those; so one pivot serves a group of near copies
in most of its lists.  The comparison leaves, per member and pivot, the exact number of
common shingles and the shingles that the pivot lacks.  Two members of a pivot's lists
that are not linked through it can only be similar if

* they share one of those lacking shingles, or
* all they share lies in the pivot, and then both counts bound their intersection.

Similar members share four fifths of either, so at least what that leaves beyond the
pivot's common shingles are shared lacking ones.  By the prefix filter two such sets meet
in the first of them, a fifth of a member's size and one at most, and only those are
written out.  Where more than ``COMMON`` members have one of these, its members' other
lacking shingles follow, and the common ones among them are counted to the pivot instead
(the bound holds for any fixed set), so lists stay short in both cases.  Each is a join
that finds next to nothing in a group of near copies of one text, where all pairs would
be its square.  A pivot with changes of its own lacks shingles that all others share, so
the bounds of many members that lie just beyond its reach stay open.  Such a group takes
the member that shares most with those as its next pivot, up to ``TURNS`` times, and all
others are compared with it; pairs are listed for the last one alone.  The links found
have the components of all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import materialize
from .components import components

SHORT = 24
COMMON = 32
# So often a group that its pivot leaves open gets another one.
TURNS = 2
# Of 64 one-bit sketches 6.4 differ on average at a similarity of 0.8, with a deviation
# of 2.4; 20 are over five deviations away.  Unrelated sets differ in 32.
MOST_BITS = 20


def shared_lists(tokens: DataFrame) -> DataFrame:
    """``tokens(token, node, size, bits)`` whose token several nodes have, with their number ``n``."""
    lists = tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    return materialize(tokens.join(lists, "token"), "hits")


def short_pairs(hits: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``a < b`` of short lists whose sizes and sketches allow similarity."""
    short = hits.where(F.col("n") <= SHORT)
    l, r = short.alias("l"), short.alias("r")
    differing = F.bit_count(F.col("l.bits").bitwiseXOR(F.col("r.bits")))
    on = (F.col("l.token") == F.col("r.token")) & (F.col("l.node") < F.col("r.node"))
    met = l.join(r, on & similar_sizes("l", "r", percent) & (differing <= MOST_BITS))
    return met.select(F.col("l.node").alias("a"), F.col("r.node").alias("b")).distinct()


def pivot_pairs(hits: DataFrame) -> DataFrame:
    """Distinct ``(a, b)``: the pivots ``a`` of long lists and their other members ``b``."""
    long = hits.where(F.col("n") > SHORT).select("token", "node", "n", "bits")
    weights = long.groupBy("node").agg(F.sum("n").alias("weight"))
    weighed = long.select("token", "node", "bits").join(weights, "node")
    lead = F.max_by(F.struct("node", "weight", "bits"), F.struct("weight", -F.col("node"))).alias("lead")
    leads = materialize(weighed.groupBy("token").agg(lead).select("token", "lead.*"), "leads")
    # A lead's own lists and who leads them; itself is one of those.
    lists = long.select("token", "node", "bits").join(leads.select("node").distinct(), "node").alias("l")
    near = F.bit_count(F.col("l.bits").bitwiseXOR(F.col("r.bits"))) <= MOST_BITS
    others = lists.join(leads.alias("r"), (F.col("l.token") == F.col("r.token")) & near)
    others = others.select(F.col("l.node").alias("lead"), F.col("r.node").alias("other"), "r.weight")
    pivots = others.groupBy("lead").agg(F.max_by("other", F.struct("weight", -F.col("other"))).alias("a"))
    leads = leads.select("token", F.col("node").alias("lead")).join(pivots, "lead")
    met = long.join(leads, "token").select("a", F.col("node").alias("b"))
    return met.where("a != b").distinct()


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` with both texts and signatures; ``a``, which many may share, joins last."""
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"), F.col("signature").alias("sig_b"))
    pivot = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"), F.col("signature").alias("sig_a"))
    both = pairs.join(other, "b").join(pivot, "a")
    return both.select("a", "b", *[F.col(f"text_{x}").cast("binary").alias(f"text_{x}") for x in "ab"], "sig_a", "sig_b")


def compared(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Every pair with ``size_a``, ``size_b``, ``common`` and ``lacking``, the shingles of ``b`` that ``a`` lacks.

    The lacking ones are cut to 32 bits: equal ones stay equal, and a chance collision
    only adds a pair that is verified in full.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, text_a, text_b = (c.to_pylist() for c in batch.columns[:4])
            sizes_a, sizes_b, commons, lacking = [], [], [], []
            last_text, pivot = None, None
            for one, other in zip(text_a, text_b, strict=True):
                if one != last_text:
                    last_text, pivot = one, next(hashing.shingle_sets([one], shingle))
                mine = next(hashing.shingle_sets([other], shingle))
                rest = mine[~hashing.contained(mine, pivot)]
                sizes_a.append(len(pivot))
                sizes_b.append(len(mine))
                commons.append(len(mine) - len(rest))
                lacking.append((rest >> np.uint64(32)).astype(np.uint32).view(np.int32))
            columns = [batch.column(0), batch.column(1), *[pa.array(x, pa.int64()) for x in (sizes_a, sizes_b, commons)]]
            columns.append(pa.array(lacking, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "size_a", "size_b", "common", "lacking"])

    schema = "a long, b long, size_a long, size_b long, common long, lacking array<int>"
    return _with_texts(pairs, texts).mapInArrow(work, schema)


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int, min_matches: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets reach ``percent`` Jaccard similarity.

    Pairs with fewer than ``min_matches`` equal signature coordinates are skipped
    before their sets are built.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, text_a, text_b, sig_a, sig_b = (c.to_pylist() for c in batch.columns)
            keep = []
            last_text, pivot = None, None
            for i in range(len(a)):
                if min_matches:
                    same = np.frombuffer(sig_a[i], np.uint32) == np.frombuffer(sig_b[i], np.uint32)
                    if np.count_nonzero(same) < min_matches:
                        continue
                if text_a[i] != last_text:
                    last_text, pivot = text_a[i], next(hashing.shingle_sets([text_a[i]], shingle))
                mine = next(hashing.shingle_sets([text_b[i]], shingle))
                common = int(np.count_nonzero(hashing.contained(mine, pivot)))
                if 100 * common >= percent * (len(pivot) + len(mine) - common):
                    keep.append(i)
            index = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(index), batch.column(1).take(index)], names=["a", "b"])

    return _with_texts(pairs, texts).mapInArrow(work, "a long, b long").distinct()


def similar_sizes(left: str, right: str, percent: int) -> Column:
    """Sets whose sizes allow a Jaccard similarity of ``percent`` at all."""
    a, b = F.col(f"{left}.size"), F.col(f"{right}.size")
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _ordered(met: DataFrame) -> DataFrame:
    """Pairs ``x < y`` of a group ``a``."""
    return met.select("l.a", F.least("l.node", "r.node").alias("x"), F.greatest("l.node", "r.node").alias("y"))


def _similar(percent: int) -> Column:
    """``compared`` rows whose sets reach the similarity."""
    return 100 * F.col("common") >= percent * (F.col("size_a") + F.col("size_b") - F.col("common"))


def _meeting(shingles: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs that share a shingle of few members, and the rows of shingles that many have."""
    several = shingles.groupBy("a", "shingle").agg(
        F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")
    )
    several = several.where("lo < hi").select("a", "shingle", "n")
    shared = materialize(shingles.join(several, ["a", "shingle"]), "shared")
    l, r = shared.where(F.col("n") <= COMMON).alias("l"), shared.where(F.col("n") <= COMMON).alias("r")
    on = (F.col("l.a") == F.col("r.a")) & (F.col("l.shingle") == F.col("r.shingle"))
    pairs = _ordered(l.join(r, on & (F.col("l.label") < F.col("r.label")) & similar_sizes("l", "r", percent)))
    return pairs, shared.where(F.col("n") > COMMON)


def _outside(against: DataFrame, members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of members that share a shingle their pivot lacks, and the rows of shingles that many have.

    Similar ones share at least ``owed`` of those, so they meet before the last ``owed - 1``.
    """
    lacking = against.select("a", F.col("b").alias("node"), "lacking")
    lacking = lacking.join(members.select("a", "node", "size", "label", "common"), ["a", "node"])
    owed = F.ceil(F.col("size") * percent / 100) - F.col("common")
    lacking = lacking.withColumn("ahead", (F.size("lacking") - F.greatest(owed, F.lit(1)) + 1).cast("int")).drop("common")
    lacking = materialize(lacking, "lacking")
    columns = ["a", "node", "size", "label"]
    ahead = lacking.select(*columns, F.expr("slice(lacking, 1, ahead)").alias("ahead"))
    ahead = materialize(ahead.select(*columns, F.explode("ahead").alias("shingle")), "ahead")
    few, crowded = _meeting(ahead, percent)
    # Members that meet in crowds alone may share any other shingle.
    crowd = materialize(crowded.select("a", "node").distinct(), "crowd")
    beyond = lacking.where("ahead < size(lacking)").join(crowd, ["a", "node"])
    beyond = beyond.select(*columns, F.explode(F.expr("slice(lacking, ahead + 1, size(lacking))")).alias("shingle"))
    more, crowded = _meeting(ahead.join(crowd, ["a", "node"]).select(*columns, "shingle").union(beyond), percent)
    return few.union(more), crowded


def _inside(plain: DataFrame, loose: DataFrame, percent: int) -> DataFrame:
    """Pairs whose pivot, with the common shingles, could hold all that they share."""
    l, r = loose.alias("l"), plain.alias("r")
    most = F.least("l.common", "r.common") + F.least("l.extra", "r.extra")
    enough = (100 + percent) * most >= percent * (F.col("l.size") + F.col("r.size"))
    once = F.col("r.linked") | (F.col("l.node") < F.col("r.node"))
    apart = (F.col("l.label") != F.col("r.label")) & similar_sizes("l", "r", percent)
    return _ordered(l.join(r, (F.col("l.a") == F.col("r.a")) & apart & enough & once))


def _crowds(loose: DataFrame, percent: int) -> DataFrame:
    """Groups ``a`` where more than ``COMMON`` loose members could be similar to others of their size."""
    wide = (100 + percent) * (F.col("common") + F.col("extra")) >= 2 * percent * F.col("size")
    counts = loose.where(wide).groupBy("a").agg(F.count("*").alias("n"))
    return materialize(counts.where(F.col("n") > COMMON).select("a"), "crowds")


def _next_pivots(crowds: DataFrame, plain: DataFrame, loose: DataFrame, crowded: DataFrame) -> DataFrame:
    """The ``pivot`` of every crowd ``a``: the member that shares most with its loose ones, by counts of shingles."""
    inside = loose.join(crowds, "a").groupBy("a").agg((F.sum("common") / F.max("size_a")).alias("each"))
    held = crowded.join(loose.select("a", "node"), ["a", "node"]).groupBy("a", "shingle").agg(F.count("*").alias("held"))
    beside = crowded.join(held, ["a", "shingle"]).groupBy("a", "node").agg(F.sum("held").alias("beside"))
    scored = plain.join(inside, "a").join(beside, ["a", "node"], "left")
    score = F.col("common") * F.col("each") + F.coalesce("beside", F.lit(0))
    best = F.max_by("node", F.struct(score, -F.col("size"), -F.col("node"))).alias("pivot")
    return materialize(scored.groupBy("a").agg(best), "next")


def remaining_pairs(
    against: DataFrame, links: DataFrame, texts: DataFrame, shingle: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Pairs that may be linked though their labels differ, and the components of all links known by then.

    ``against`` has ``compared`` rows; pairs with the pivot itself have been compared already.
    A group whose pivot leaves too many pairs open gets another one, with which all its
    members are compared; after ``TURNS`` of these the open pairs are listed as they are.
    """
    rest, found = [], components(links)
    for turn in range(TURNS + 1):
        members = against.select(
            "a", F.col("b").alias("node"), F.col("size_b").alias("size"), "size_a", "common", _similar(percent).alias("linked")
        )
        members = members.join(found, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
        members = materialize(members, "members")
        groups = members.groupBy("a").agg(
            F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("size").alias("least")
        )
        groups = materialize(groups.where("lo < hi").select("a", "least"), "groups")
        members = materialize(members.join(groups, "a"), "open")
        pairs, crowded = _outside(against, members, percent)
        extra = crowded.groupBy("a", "node").agg(F.count("*").alias("extra"))
        plain = members.join(extra, ["a", "node"], "left").withColumn("extra", F.coalesce("extra", F.lit(0)))
        plain = materialize(plain, "bounds")
        # Two members that are both linked to the pivot have one label.
        most, size = F.col("common") + F.col("extra"), F.col("size")
        loose = plain.where(~F.col("linked") & ((100 + percent) * most >= percent * (size + F.col("least"))))
        loose = materialize(loose, "loose")
        crowds = _crowds(loose, percent)
        if turn == TURNS or crowds.isEmpty():
            rest += [pairs, _inside(plain, loose, percent)]
            break
        settled = loose.join(crowds, "a", "left_anti")
        rest += [pairs.join(crowds, "a", "left_anti").select("a", "x", "y"), _inside(plain, settled, percent)]
        pivots = _next_pivots(crowds, plain, loose, crowded)
        again = plain.join(pivots, "a").where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
        against = materialize(compared(materialize(again.distinct(), "again"), texts, shingle, percent), "compared")
        # What is known goes on as one link to the component for each node.
        found = components(found.toDF("a", "b").union(against.where(_similar(percent)).select("a", "b")))
    return reduce(DataFrame.union, rest).select(F.col("x").alias("a"), F.col("y").alias("b")), found


def unlinked(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose nodes lie in different components ``found``."""
    for side in "ab":
        labels = found.select(F.col("node").alias(side), F.col("component").alias(f"{side}_label"))
        pairs = pairs.join(labels, side, "left")
    return pairs.where(~F.coalesce("a_label", "a").eqNullSafe(F.coalesce("b_label", "b"))).select("a", "b")


def link(tokens: DataFrame, texts_of, shingle: int, percent: int, min_matches: int = 0) -> DataFrame:
    """Links ``(a, b)`` with the components of all similar pairs that share a token.

    A node may be linked to its component instead of a similar one, and to itself.

    ``tokens`` is ``(token, node, size, bits)``; equal ``bits`` everywhere switch the
    sketch off.  ``texts_of`` turns a frame of nodes into ``(node, text, signature)``.
    """
    hits = shared_lists(tokens)
    short = materialize(short_pairs(hits, percent), "short")
    pairs = materialize(pivot_pairs(hits), "pairs")
    nodes = short.union(pairs).select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = materialize(texts_of(nodes), "texts")
    against = materialize(compared(pairs, texts, shingle, percent), "compared")
    # One pair per node first; most of the others then lie in one component.
    nearest = short.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    first = against.where(_similar(percent)).select("a", "b")
    first = first.union(verified(nearest, texts, shingle, percent, min_matches))
    pairs, found = remaining_pairs(against, first, texts, shingle, percent)
    rest = materialize(unlinked(pairs.union(short), found).distinct(), "rest")
    # Components found so far are stars, which leaves little to do for those of all links.
    return found.toDF("a", "b").union(verified(rest, texts, shingle, percent, min_matches))
