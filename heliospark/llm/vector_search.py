"""Approximate nearest neighbours by largest inner product, over balanced posting lists.

A bounded sample fits centroids (balanced k-means, on vectors extended so that the largest inner product is the smallest
distance). Centroids are searched by beam search in a neighbour graph that every task holds. Each vector goes to its
nearest list and to others about as near (boundary vectors), unless a chosen centroid already lies nearer to them. A query
takes the lists whose distance stays within a ratio of the nearest, at least as many as hold ``MIN_VECTORS``. Neighbouring
lists form groups, in which a query meets the vectors of its own lists and leaves its k best. Groups larger than ``SHARD``
are split into shards and a group's queries into blocks, so no task's group is unbounded; all are compared.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliospark.llm.shared import keep

LIST_SIZE = 256
MAX_LISTS = 8192  # bounds what is broadcast: 8192 centroids and their graph
SAMPLE = 40_000  # rows that fit the centroids, at most
REPLICAS = 4
BOUNDARY = 1.15
RATIO = 1.6
FIRST_PROBES = 40  # lists looked up in the graph before a query is compared with all centroids
MIN_VECTORS = 2000
GROUP = 32  # lists that are searched together
SHARD = 16_384  # vectors of a group that are searched together
QUERIES = 4096
DEGREE = 16
BEAM = 64


def _rows(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def extended(vectors: np.ndarray, most: float) -> np.ndarray:
    """One more coordinate that gives every vector the norm of the longest."""
    return np.column_stack([vectors, np.sqrt(np.maximum(most - (vectors * vectors).sum(1), 0))])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1), 0)


def balanced_centroids(sample: np.ndarray, lists: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """k-means in which the centroids of the smallest lists move into the largest ones after each round but the last."""
    random = np.random.default_rng(seed)
    lists = min(lists, len(sample))
    centroids = sample[random.choice(len(sample), lists, replace=False)]
    for step in range(rounds):
        nearest = np.concatenate([_distances(part, centroids).argmin(1) for part in np.array_split(sample, math.ceil(len(sample) / 2048))])
        counts = np.bincount(nearest, minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
        if step < rounds - 1:
            large = np.flatnonzero(counts > 2 * len(sample) / lists)
            small = np.argsort(counts)[:len(large)]
            for to, of in zip(small, large):
                if counts[to] < len(sample) / lists / 2:
                    centroids[to] = sample[random.choice(np.flatnonzero(nearest == of))]
    return centroids


class CentroidGraph:
    """Neighbour graph over centroids with beam search for many vectors at once."""

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE, seed: int = 13):
        self.centroids = centroids
        n = len(centroids)
        near = [_distances(part, centroids).argsort(1)[:, 1:degree + 1] for part in np.array_split(centroids, max(1, math.ceil(n / 1024)))]
        random = np.random.default_rng(seed)
        self.links = np.column_stack([np.concatenate(near), random.integers(0, n, (n, 4))])  # some far links keep the graph whole
        self.entries = random.choice(n, min(n, 48), replace=False)

    def search(self, vectors: np.ndarray, k: int, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest centroids found and their squared distances, nearest first; -1 where there are fewer."""
        n, rows = len(self.centroids), np.arange(len(vectors))[:, None]
        beam = min(max(beam, k), n)
        seen = np.zeros((len(vectors), n), bool)
        seen[:, self.entries] = True
        ids = np.repeat(self.entries[None], len(vectors), 0)
        dist = _distances(vectors, self.centroids[self.entries])
        opened = np.zeros(ids.shape, bool)
        own = (vectors * vectors).sum(1)[:, None]
        lengths = (self.centroids * self.centroids).sum(1)
        while True:
            best = np.where(opened, np.inf, dist)
            order = best.argsort(1)[:, :4]
            going = np.isfinite(np.take_along_axis(best, order, 1))
            if not going.any():
                break
            np.put_along_axis(opened, order, True, 1)
            new = self.links[np.take_along_axis(ids, order, 1)].reshape(len(vectors), -1)
            fresh = ~seen[rows, new] & np.repeat(going, self.links.shape[1], 1)
            seen[rows, new] |= fresh
            d = np.where(fresh, np.maximum(own - 2 * np.einsum("ij,ikj->ik", vectors, self.centroids[new]) + lengths[new], 0), np.inf)
            ids, dist, opened = np.column_stack([ids, new]), np.column_stack([dist, d]), np.column_stack([opened, ~fresh])
            order = np.lexsort((ids, dist), axis=1)
            ids, dist, opened = (np.take_along_axis(x, order, 1) for x in (ids, dist, opened))
            again = np.zeros(ids.shape, bool)
            again[:, 1:] = (ids[:, 1:] == ids[:, :-1])
            dist = np.where(again, np.inf, dist)
            opened |= ~np.isfinite(dist)
            order = dist.argsort(1, kind="stable")[:, :beam]
            ids, dist, opened = (np.take_along_axis(x, order, 1) for x in (ids, dist, opened))
        order = dist.argsort(1, kind="stable")[:, :k]
        ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        return np.where(np.isfinite(dist), ids, -1), dist


def _usable(dimension: int | None):
    def run(batches):
        for batch in batches:
            ids, found = [], []
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
                v = np.array(v.values.to_numpy(zero_copy_only=False), float) if v.is_valid else np.zeros(0)
                if i is not None and len(v) and np.isfinite(v).all() and v.any() and dimension in (None, len(v)):
                    ids.append(i)
                    found.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.float64())), pa.array([len(v) for v in found], pa.int32()),
                                              pa.array([float(v @ v) for v in found], pa.float64())], names=["vec_id", "v", "size", "norm2"])
    return run


def _postings(shared):
    def run(batches):
        graph, most = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                lists, dist = graph.search(extended(_rows(part.column("v")), most), REPLICAS)
                take = (lists >= 0) & (dist <= BOUNDARY * dist[:, :1])
                take[:, 0] = True
                for j in range(1, lists.shape[1]):
                    for i in range(j):
                        apart = ((graph.centroids[lists[:, i]] - graph.centroids[lists[:, j]]) ** 2).sum(1)
                        take[:, j] &= ~(take[:, i] & (apart < dist[:, j]))
                row, column = np.nonzero(take)
                yield pa.RecordBatch.from_arrays([pa.array(lists[row, column].astype(np.int32)), part.column("vec_id").take(pa.array(row)), part.column("v").take(pa.array(row))],
                                                 names=["list", "vec_id", "v"])
    return run


def chosen_lists(graph: CentroidGraph, queries: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and list of all lists within the ratio of a query's nearest, and of the nearest until ``least`` vectors are held.

    The beam settles a query when its last centroid is beyond both; the others are compared with all centroids.
    """
    def take(lists, dist):
        held = np.cumsum(np.where(lists >= 0, sizes[lists], 0), 1)
        before = np.column_stack([np.zeros(len(held)), held[:, :-1]])
        return (lists >= 0) & ((dist <= RATIO * dist[:, :1]) | (before < least))

    lists, dist = graph.search(queries, min(FIRST_PROBES, len(graph.centroids)))
    good = take(lists, dist)
    wide = np.flatnonzero(good[:, -1] | (lists[:, -1] < 0))
    good[wide] = False
    row, column = np.nonzero(good)
    rows, found = [row], [lists[row, column]]
    for part in np.array_split(wide, math.ceil(len(wide) / 128)) if len(wide) else []:
        dist = _distances(queries[part], graph.centroids)
        lists = dist.argsort(1, kind="stable")
        row, column = np.nonzero(take(lists, np.take_along_axis(dist, lists, 1)))
        rows.append(part[row])
        found.append(lists[row, column])
    return np.concatenate(rows), np.concatenate(found)


def list_groups(centroids: np.ndarray) -> np.ndarray:
    """Group of each list: lists in order along the direction in which centroids differ most."""
    centred = centroids - centroids.mean(0)
    along = centred @ np.linalg.eigh(centred.T @ centred)[1][:, -1]
    groups = np.empty(len(centroids), np.int32)
    groups[along.argsort(kind="stable")] = np.arange(len(centroids)) // GROUP
    return groups


def _probes(shared, sizes: np.ndarray, k: int, groups: np.ndarray | None = None):
    """Lists of each query, a row each; with ``groups`` a row for each group and its lists."""
    def run(batches):
        graph, _ = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                vectors = _rows(part.column("v"))
                row, found = chosen_lists(graph, np.column_stack([vectors, np.zeros(len(vectors))]), sizes, max(MIN_VECTORS, 40 * k))
                lists, names = pa.array(found.astype(np.int32)), ["list", "query_id", "q"]
                if groups is not None:
                    order = np.lexsort((groups[found], row))
                    row, found = row[order], found[order]
                    grp = groups[found]
                    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (grp[1:] != grp[:-1])])) if len(row) else np.zeros(0, np.int64)
                    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(found)), pa.int32()), pa.array(found.astype(np.int32)))
                    row, names = row[first], ["grp", "lists", "query_id", "q"]
                values = [lists, part.column("vec_id").take(pa.array(row)), part.column("v").take(pa.array(row))]
                yield pa.RecordBatch.from_arrays(values if groups is None else [pa.array(grp[first].astype(np.int32)), *values], names=names)
    return run


def nearest_in(query_ids, queries, vec_ids, vectors, k: int, own: np.ndarray | None = None) -> list[tuple[int, int, float]]:
    """Exact k best of each query among the vectors (those that ``own`` allows it): products prune, row sums in double precision decide."""
    rough = queries @ vectors.T
    bound = np.sqrt((queries * queries).sum(1) * (vectors * vectors).sum(1).max()) * 1e-10
    rough[query_ids[:, None] == vec_ids] = -np.inf
    if own is not None:
        rough[~own] = -np.inf
    keep_from = max(0, rough.shape[1] - k)
    least = np.partition(rough, keep_from, axis=1)[:, keep_from] - bound
    rows, columns = np.nonzero((rough >= least[:, None]) & np.isfinite(rough))
    scores = (vectors[columns] * queries[rows]).sum(1)
    order = np.lexsort((vec_ids[columns], -scores, rows))
    rows, columns, scores = rows[order], columns[order], scores[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    best = place < k
    return list(zip(query_ids[rows[best]].tolist(), vec_ids[columns[best]].tolist(), scores[best].tolist()))


def _compare(k: int):
    def run(key, left, right):
        out = []
        if left.num_rows and right.num_rows:
            vectors, ids = _rows(right.column("v").combine_chunks()), right.column("vec_id").to_numpy()
            names, where = np.unique(right.column("list").to_numpy(), return_inverse=True)
            for at in range(0, left.num_rows, 256):
                some = left.slice(at, 256)
                wanted = some.column("lists").combine_chunks()
                owner = np.repeat(np.arange(len(wanted)), wanted.value_lengths().to_numpy(zero_copy_only=False))
                place = np.searchsorted(names, lists := wanted.flatten().to_numpy())
                held = (place < len(names)) & (names[np.minimum(place, len(names) - 1)] == lists)
                allowed = np.zeros((len(wanted), len(names)), bool)
                allowed[owner[held], place[held]] = True
                out += nearest_in(some.column("query_id").to_numpy(), _rows(some.column("q").combine_chunks()), ids, vectors, k, allowed[:, where])
        columns = list(zip(*out)) or [[]] * 3
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])
    return run


def search(embeddings: DataFrame, query_filter, k: int = 20, list_size: int = LIST_SIZE) -> DataFrame:
    """The k nearest vectors found for each query row: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    ``embeddings`` needs ``vec_id`` and ``embedding``; ``query_filter`` is a condition on ``vec_id``. Nearest is the largest
    inner product of the original vectors in double precision, ties to the smaller vec_id; a query's own vec_id is no
    candidate, a vec_id that repeats counts once with its best score. Vectors that are null, zero, hold null, NaN or
    infinite components, lack a vec_id or differ from the most common length (ties: the longer) take no part, neither as
    query nor as candidate. With fewer than k candidates all are returned; an empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    schema = "vec_id long, v array<double>, size int, norm2 double"
    raw = keep(embeddings.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(_usable(None), schema), "vectors")
    shapes = raw.groupBy("size").agg(F.count("*").alias("n"), F.max("norm2").alias("most"))
    common = shapes.orderBy(F.desc("n"), F.desc("size")).first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = raw.where(F.col("size") == common["size"])
    lists = int(min(MAX_LISTS, max(1, math.ceil(common["n"] / list_size))))
    share = min(1.0, SAMPLE / common["n"])
    picked = usable.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) <= int(share * (1 << 20))).select("v").limit(2 * SAMPLE)
    sample = extended(np.array([r[0] for r in picked.collect()] or [usable.first()["v"]]), common["most"])
    shared = spark.sparkContext.broadcast((CentroidGraph(balanced_centroids(sample, lists)), common["most"]))

    postings = keep(usable.select("vec_id", "v").mapInArrow(_postings(shared), "list int, vec_id long, v array<double>"), "postings")
    sizes = np.zeros(lists, np.int64)
    for r in postings.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    groups = list_groups(shared.value[0].centroids)
    probes = keep(usable.where(query_filter).select("vec_id", "v").mapInArrow(_probes(shared, sizes, k, groups), "grp int, lists array<int>, query_id long, q array<double>"), "probes")
    of_list = spark.createDataFrame([(i, int(g)) for i, g in enumerate(groups)], "list int, grp int")  # MAX_LISTS rows at most
    members = postings.join(F.broadcast(of_list), "list")
    cuts = (probes.groupBy("grp").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks"))
            .join(members.groupBy("grp").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards")), "grp"))
    queries = (probes.join(cuts, "grp").withColumn("block", F.pmod(F.xxhash64("query_id"), "blocks").cast("int"))
               .select("grp", "block", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "query_id", "lists", "q"))
    members = (members.join(cuts, "grp").withColumn("shard", F.pmod(F.xxhash64("vec_id"), "shards").cast("int"))
               .select("grp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "shard", "list", "vec_id", "v"))
    keys = ["grp", "block", "shard"]
    found = queries.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInArrow(_compare(k), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
