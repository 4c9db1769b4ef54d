"""Approximate nearest neighbours by balanced posting lists.

Centroids come from balanced splits of a bounded sample.  Every vector is posted in
the list of its nearest centroid, and, if it lies near a boundary, in those of others
about as near.  A query finds its nearest centroids in an in-memory neighbour graph,
keeps those within a ratio of the nearest one's distance, and is compared with all
vectors of these lists in double precision: first with the nearest list, then with the
others in turn, which give back only what lies within the k-th distance so far, and are
left out where by their radius nothing can.  The ratio is the smallest that reaches
the wanted recall on the sample, against brute force there; the sample's neighbours
lie farther apart than the table's, so the ratio is on the safe side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


@dataclass(frozen=True)
class Settings:
    """Bounds and ratios of the index.

    The index is fitted on ``sample`` vectors, those first by a hash of their id, and
    has ``max_lists`` lists at most; all vectors are indexed.  ``boundary`` is the
    distance ratio to the nearest centroid up to which a vector is posted again, in
    ``replicas`` lists at most.  A query's lists have no cap but the ratio that
    ``recall`` asks for.
    """

    sample: int = 20_000
    max_lists: int = 4096
    list_size: int = 256
    links: int = 16
    beam: int = 24
    boundary: float = 1.15
    replicas: int = 4
    recall: float = 0.98
    trials: int = 200
    # Rows of a list, and queries, that one group of the comparison holds on average.
    vector_block: int = 4096
    query_block: int = 1024


@dataclass(frozen=True)
class Graph:
    """Centroids, the nearest others of each, and the search's entry points."""

    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray


def balanced_centroids(vectors: np.ndarray, count: int) -> np.ndarray:
    """``count`` centroids (about): the sample is halved along its widest direction."""
    rng = np.random.default_rng(7)
    leaves = [vectors]
    while leaves and len(leaves) < count:
        halves = []
        for leaf in leaves:
            if len(leaf) < 2:
                halves.append(leaf)
                continue
            a, b = leaf[rng.choice(len(leaf), 2, replace=False)]
            for _ in range(4):
                near = ((leaf - a) ** 2).sum(1) < ((leaf - b) ** 2).sum(1)
                if near.all() or not near.any():
                    break
                a, b = leaf[near].mean(0), leaf[~near].mean(0)
            order = np.argsort(leaf @ (b - a), kind="stable")
            halves += [leaf[order[: len(leaf) // 2]], leaf[order[len(leaf) // 2 :]]]
        if len(halves) == len(leaves):
            break
        leaves = halves
    return np.unique(np.array([leaf.mean(0) for leaf in leaves]), axis=0)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def build_graph(centroids: np.ndarray, links: int) -> Graph:
    n = len(centroids)
    links = min(links, max(n - 1, 1))
    found = np.empty((n, links), np.int32)
    for at in range(0, n, 512):
        far = squared(centroids[at : at + 512], centroids)
        far[np.arange(len(far)), np.arange(at, at + len(far))] = np.inf
        found[at : at + 512] = np.argsort(far, axis=1, kind="stable")[:, :links]
    # A few far links keep separate clusters reachable.
    rng = np.random.default_rng(11)
    found = np.concatenate((found, rng.integers(0, n, (n, 4), dtype=np.int32)), axis=1)
    entries = np.unique(np.linspace(0, n - 1, min(n, 16)).astype(np.int32))
    return Graph(centroids, found, entries)


def list_distances(graph: Graph, vectors: np.ndarray, beam: int, ratio: float = 1.0) -> np.ndarray:
    """Distances of vectors to centroids, infinite where the search did not come.

    Best-first search in the graph: every step expands each vector's nearest centroid
    not yet expanded, ``beam`` times at least, and on while that one lies within
    ``ratio`` of the nearest.
    """
    n, c = len(vectors), len(graph.centroids)
    rows = np.arange(n)
    far = np.full((n, c), np.inf)
    waiting = np.full((n, c), np.inf)

    def visit(which: np.ndarray, ids: np.ndarray) -> None:
        new = np.sqrt(((graph.centroids[ids] - vectors[which][:, None, :]) ** 2).sum(2))
        at = which[:, None]
        waiting[at, ids] = np.where(np.isinf(far[at, ids]), new, waiting[at, ids])
        far[at, ids] = new

    visit(rows, np.broadcast_to(graph.entries, (n, len(graph.entries))))
    step = 0
    while len(rows):
        best = waiting[rows].argmin(1)
        reach = waiting[rows, best]
        on = np.isfinite(reach)
        if step >= beam:
            on &= reach <= ratio * far[rows].min(1)
        rows, best = rows[on], best[on]
        waiting[rows, best] = np.inf
        # Expanded centroids stay finite in ``far``, so they do not wait again.
        visit(rows, graph.links[best])
        step += 1
    return far


def chosen_lists(
    graph: Graph, far: np.ndarray, ratio: float, most: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Row and list of every list within ``ratio`` of the nearest.

    With ``most``, the nearest ``most`` of them, less those whose centroid is shaded: so
    near to one taken before that both lie on the same side of the vector.
    """
    near = far <= ratio * far.min(1, keepdims=True)
    if most is None:
        return np.nonzero(near)
    lists = np.argsort(far, axis=1, kind="stable")[:, :most]
    take = np.take_along_axis(near, lists, 1)
    reach = np.take_along_axis(far, lists, 1)
    for j in range(1, lists.shape[1]):
        between = ((graph.centroids[lists[:, j]][:, None] - graph.centroids[lists[:, :j]]) ** 2).sum(2)
        take[:, j] &= ~((between <= reach[:, j : j + 1] ** 2 / 4) & take[:, :j]).any(1)
    take[:, 0] = True
    row, column = np.nonzero(take)
    return row, lists[row, column]


def search_ratio(graph: Graph, points: np.ndarray, k: int, s: Settings) -> float:
    """Smallest distance ratio that finds ``s.recall`` of the sample's nearest neighbours."""
    trials = np.linspace(0, len(points) - 1, min(s.trials, len(points))).astype(int)
    far = squared(points[trials], points)
    far[np.arange(len(trials)), trials] = np.inf
    k = min(k, len(points) - 1)
    if k < 1 or len(graph.centroids) < 2:
        return 1.0
    true = np.argpartition(far, k - 1, axis=1)[:, :k].ravel()
    asked = np.sqrt(squared(points[trials], graph.centroids))
    asked /= np.maximum(asked.min(1, keepdims=True), 1e-300)
    needed = []
    for at in range(0, len(true), 256):
        part = true[at : at + 256]
        row, lists = chosen_lists(graph, list_distances(graph, points[part], s.beam), s.boundary, s.replicas)
        ratios = asked[(at + row) // k, lists]
        least = np.full(len(part), np.inf)
        np.minimum.at(least, row, ratios)
        needed.append(least)
    return float(np.quantile(np.concatenate(needed), s.recall)) + 1e-9


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``(vec_id, vec)`` of the vectors that take part, as doubles."""
    vec = F.col(f"`{vector_column}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), vec.alias("vec"))
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & ~F.coalesce(odd, F.lit(True)))
    rows = rows.where(F.exists("vec", lambda x: x != 0))
    usual = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return rows.where(F.size("vec") == (usual["d"] if usual else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _posted(rows: DataFrame, id_name: str, graph, beam: int, ratio: float, most: int | None = None) -> DataFrame:
    """``(list, far, turn, <id_name>, vec)`` for the lists that ``chosen_lists`` gives every vector.

    ``far`` is the distance to the list's centroid, ``turn`` the list's place by it.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = Graph(*graph.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                far = list_distances(g, _matrix(batch.column(1)), beam, 1.0 if most else ratio)
                row, lists = chosen_lists(g, far, ratio, most)
                reach = far[row, lists]
                order = np.lexsort((lists, reach, row))
                row, lists, reach = row[order], lists[order], reach[order]
                turn = np.arange(len(row)) - np.searchsorted(row, row)
                index = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists.astype(np.int32)), pa.array(reach), pa.array(turn.astype(np.int32)),
                     *(c.take(index) for c in batch.columns)],
                    names=["list", "far", "turn", id_name, "vec"],
                )

    return rows.select(id_name, "vec").mapInArrow(work, f"list int, far double, turn int, {id_name} long, vec array<double>")


# A query's lists in the order in which they are visited: the nearest, some more, the rest.
TURNS = ((0, 1), (1, 8), (8, None))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    settings: Settings = Settings(),
) -> DataFrame:
    """The ``k`` nearest found of all other rows for every row where ``is_query(vec_id)`` holds.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` (Euclidean
    distance of the given vectors in double precision); ties go to the smaller id.

    * Vectors that are null, zero, of an unusual length or hold null or non-finite
      components take no part, nor do rows without an id.
    * Queries with fewer than ``k`` candidates found have fewer rows.
    * Equal vectors are near each other with score 0.  Only the ``k + 1`` smallest ids
      of equal vectors can be among anyone's nearest; the others are not compared.
      Equal queries are searched once.
    * Rows that repeat an id and its vector count once.
    * Other columns are not read; an empty table gives an empty result.
    """
    s = settings
    spark = vectors.sparkSession
    rows = usable(vectors, id_column, vector_column)
    copies = Window.partitionBy("vec").orderBy("vec_id")
    # A hot vector is limited before the shuffle.
    few = rows.distinct().withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
    few = materialize(few, "vectors")
    total = few.count()
    # The first copy of a vector names its class.
    classes = few.where("copy = 1").select(F.col("vec_id").alias("cls"), "vec")
    queries = rows.where(is_query).distinct().select(F.col("vec_id").alias("query_id"), "vec")
    queries = materialize(queries.join(classes, "vec").select("query_id", "cls", "vec"), "queries")

    hashed = F.md5(F.col("vec_id").cast("string"))
    sample = few.where("copy = 1").select("vec_id", "vec").orderBy(hashed, "vec_id").limit(s.sample)
    taken = sample.toArrow()
    points = _matrix(taken.column("vec").combine_chunks()) if taken.num_rows else np.zeros((0, 1))
    count = max(1, min(s.max_lists, total // s.list_size))
    centroids = balanced_centroids(points, count) if len(points) else np.zeros((1, 1))
    built = build_graph(centroids, s.links)
    ratio = search_ratio(built, points, k, s) if len(points) else 1.0
    # Broadcast values are pickled by name, so plain arrays are sent.
    graph = spark.sparkContext.broadcast((built.centroids, built.links, built.entries))

    postings = materialize(
        _posted(few.select("vec_id", "vec"), "vec_id", graph, s.beam, s.boundary, s.replicas), "postings"
    )
    asked = queries.select("cls", "vec").dropDuplicates(["cls"])
    asked = materialize(_posted(asked, "cls", graph, s.beam, ratio), "asked")

    radii = postings.groupBy("list").agg(F.max("far").alias("radius"), F.ceil(F.count("*") / s.vector_block).cast("int").alias("v_blocks"))
    radii = materialize(radii, "lists")
    key = ["list", "v_block", "q_block"]

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if a.num_rows and b.num_rows:
            q, v = _matrix(a.column("vec").combine_chunks()), _matrix(b.column("vec").combine_chunks())
            ids, bounds = b.column("vec_id").to_numpy(), a.column("bound").to_numpy()
            for i, (cls, row) in enumerate(zip(a.column("cls").to_pylist(), squared(q, v), strict=True)):
                worst = min(bounds[i] ** 2, np.partition(row, k)[k] if len(row) > k + 1 else np.inf)
                near = np.flatnonzero(row <= worst * (1 + 1e-6) + 1e-9)
                score = np.sqrt(((v[near] - q[i]) ** 2).sum(1))
                order = np.lexsort((ids[near], score))[: k + 1]
                order = order[score[order] <= bounds[i]]
                out[0] += [cls] * len(order)
                out[1] += ids[near][order].tolist()
                out[2] += score[order].tolist()
        types = (pa.int64(), pa.int64(), pa.float64())
        arrays = [pa.array(x, t) for x, t in zip(out, types, strict=True)]
        return pa.table(arrays, names=["cls", "vec_id", "score"])

    def visited(turn: DataFrame) -> DataFrame:
        """What the lists of ``turn(list, cls, vec, bound)`` hold of each query's ``k + 1`` nearest within its bound."""
        # Lists and the queries of a list are dealt into blocks; at most max_lists rows.
        asking = turn.groupBy("list").agg(F.ceil(F.count("*") / s.query_block).cast("int").alias("q_blocks"))
        plan = F.broadcast(materialize(radii.join(asking, "list").select("list", "v_blocks", "q_blocks"), "blocks"))

        def dealt(df: DataFrame, id_name: str, own: str, other: str, *more: str) -> DataFrame:
            placed = df.join(plan, "list")
            mine = F.pmod(F.xxhash64(id_name), F.col(f"{own}_blocks")).cast("int")
            all_ = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))
            return placed.select("list", mine.alias(f"{own}_block"), all_.alias(f"{other}_block"), id_name, "vec", *more)

        left, right = dealt(turn, "cls", "q", "v", "bound"), dealt(postings, "vec_id", "v", "q")
        pairs = left.groupBy(*key).cogroup(right.groupBy(*key))
        return pairs.applyInArrow(compare, "cls long, vec_id long, score double")

    best = Window.partitionBy("cls").orderBy("score", "vec_id")
    found = spark.createDataFrame([], "cls long, vec_id long, score double")
    for first, last in TURNS:
        # The k-th distance so far bounds what is still of use.  A list none of whose vectors can lie
        # within it, by the triangle inequality, is not visited; only vectors within it are returned.
        bounds = found.groupBy("cls").agg(F.count("*").alias("n"), F.max("score").alias("most"))
        bounds = bounds.where(F.col("n") > k).select(F.col("cls").alias("of"), "most")
        turn = asked.where((F.col("turn") >= first) & (F.col("turn") < last if last else F.lit(True)))
        turn = turn.join(bounds, F.col("cls") == F.col("of"), "left").join(radii.select("list", "radius"), "list")
        turn = turn.withColumn("bound", F.coalesce("most", F.lit(float("inf"))))
        reachable = F.col("far") - F.col("radius") <= F.col("bound") * (1 + 1e-9)
        turn = materialize(turn.where(reachable).select("list", "cls", "vec", "bound"), "turn")
        met = found.unionByName(visited(turn)).groupBy("cls", "vec_id").agg(F.min("score").alias("score"))
        ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1)
        found = materialize(ranked.select("cls", "vec_id", "score"), "found")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    pairs = queries.select("query_id", "cls").join(found, "cls").where("query_id != vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
