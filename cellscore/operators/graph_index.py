"""Approximate neighbour search by navigable proximity graphs.

References are dealt to shards of bounded bytes by a hash of their row. In each shard a graph is built by insertion: vectors go in
by growing batches, each of which is searched for in the graph so far; a vector is linked to the near ones that
are closer to it than to one another, so that links lead in different directions, and those are linked back under the same
rule. The graph is a table: a row a vector with its place in the shard and the places that it is linked to. A search walks each shard's graph
from its first vectors with a beam: the nearest vectors so far that were not looked at yet are replaced by their links, until
the beam holds only vectors that were. All queries of a task are walked in step.

The work of a query grows with the beam, the links and the logarithm of the shard, not with its size; how far it is below that of an exact search
depends on the vectors: on some without any structure, in 64 dimensions, a walk has to look at far more of them than where they lie in
clusters or near a surface of few dimensions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of vectors (as doubles) of a shard, and of the queries that meet it in one task.
SHARD_BYTES, QUERY_BYTES = 1 << 25, 1 << 24
#: A table of fewer shards than SHARDS is cut further, into as many, down to shards of a quarter of the bytes, and the queries into as many
#: parts as give TASKS tasks, down to PART_ROWS rows: shards and parts are built and walked by one task each.
SHARDS, TASKS, PART_ROWS = 8, 64, 1024
#: Links that a vector gets when it is inserted (twice as many in all), and the beam of the search for them.
LINKS, BUILD_BEAM = 16, 48
#: Vectors from which a walk starts, and those that are replaced in one step of it.
STARTS, STEP = 16, 4
#: Queries that are walked in step: such that no array of flags is over so many bytes.
FLAGS = 1 << 25


def scaled(x: np.ndarray, metric: str) -> np.ndarray:
    """Vectors whose squared differences order as the metric does."""
    if metric not in ("l2", "cosine"):
        raise ValueError(f"unknown metric {metric}")
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) if metric == "cosine" else x


def compact(x: np.ndarray) -> np.ndarray:
    """x in single precision where that loses nothing, as the walk's time is that of fetching vectors; otherwise x."""
    single = x.astype(np.float32) if not x.size or np.abs(x).max() < 1e15 else x
    return single if np.array_equal(single, x) else x


def apart(x: np.ndarray, of: np.ndarray, y: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Squared distances of rows of x from rows of y."""
    parts = [np.zeros(0, x.dtype)]
    for i in range(0, len(of), 4096):
        d = x.take(of[i : i + 4096], axis=0)
        d -= y.take(node[i : i + 4096], axis=0)
        parts.append(np.einsum("ij,ij->i", d, d))
    return np.concatenate(parts)


def walk(x: np.ndarray, links: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By query the beam nearest places that a walk found (-1: none) in ascending order, their squared distances, and the vectors compared.

    links has a row a vector, filled up with -1. Where x is single, the distances on the way are, too.
    """
    queries = queries.astype(x.dtype, copy=False)
    n, found, far, compared = len(x), [], [], []
    at_once = max(1, min(512, FLAGS // max(1, n)))
    for first in range(0, len(queries), at_once):
        q = queries[first : first + at_once]
        m = len(q)
        seen = np.zeros(m * n, bool)
        place, distance, open_ = np.full((m, beam), -1), np.full((m, beam), np.inf, x.dtype), np.zeros((m, beam), bool)
        fresh = (np.arange(m)[:, None] * n + np.arange(min(STARTS, n))[None, :]).ravel()
        count = np.zeros(m, np.int64)
        while len(fresh):
            seen[fresh] = True
            row, node = np.divmod(fresh, n)
            new = apart(q, row, x, node)
            by = np.bincount(row, minlength=m)
            count += by
            column = np.arange(len(row)) - np.repeat(np.cumsum(by) - by, by)
            wide = by.max()
            all_place, all_distance, all_open = (np.concatenate([old, np.full((m, wide), fill, old.dtype)], axis=1) for old, fill in ((place, -1), (distance, np.inf), (open_, False)))
            all_place[row, beam + column], all_distance[row, beam + column], all_open[row, beam + column] = node, new, True
            order = np.argsort(all_distance, axis=1, kind="stable")[:, :beam]
            place, distance, open_ = (np.take_along_axis(a, order, axis=1) for a in (all_place, all_distance, all_open))
            nth = np.cumsum(open_, axis=1)
            row, column = np.nonzero(open_ & (nth <= STEP))
            open_[row, column] = False
            around = links[place[row, column]]
            keys = (row[:, None] * n + around)[around >= 0]
            keys = np.sort(keys[~seen[keys]])
            fresh = keys[np.diff(keys, prepend=-1) > 0]
        found.append(place)
        far.append(distance)
        compared.append(count)
    return (np.concatenate(found), np.concatenate(far), np.concatenate(compared)) if found else (np.zeros((0, beam), np.int64), np.zeros((0, beam)), np.zeros(0, np.int64))


def spread(x: np.ndarray, near: np.ndarray, distance: np.ndarray, most: int) -> np.ndarray:
    """Of each row's near places (ascending by distance, -1: none) up to most, none of which is closer to a chosen one than to the row's own vector; the nearest others fill up."""
    rows, width = near.shape
    chosen, picked = np.zeros((rows, width), bool), np.zeros(rows, np.int64)
    between = np.empty((rows, width, width), np.float32)
    for i in range(0, rows, 32):
        vectors = x[np.maximum(near[i : i + 32], 0)].astype(np.float64)
        square = np.einsum("ijk,ijk->ij", vectors, vectors)
        sums = square[:, :, None] + square[:, None, :]
        product = np.matmul(vectors, vectors.transpose(0, 2, 1))
        product *= -2
        product += sums
        product *= product > 1e-12 * sums  # copies are at 0, but for rounding
        between[i : i + 32] = product
    least = np.full((rows, width), np.inf)  # squared distance to the nearest chosen one
    for j in range(width):
        take = (near[:, j] >= 0) & (picked < most) & (least[:, j] > distance[:, j])
        chosen[take, j] = True
        picked += take
        np.minimum(least, between[:, j], out=least, where=take[:, None])
    order = np.argsort(np.where(near >= 0, np.where(chosen, 0, 1), 2), axis=1, kind="stable")[:, :most]
    return np.take_along_axis(near, order, axis=1)


def build(x: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM) -> np.ndarray:
    """A row of 2 * links places (-1: none) for each vector."""
    n, wide = len(x), 2 * links
    table = np.full((n, wide), -1)
    done = min(n, links + 1)
    for i in range(done):  # the first ones know each other
        others = np.delete(np.arange(done), i)[:wide]
        table[i, : len(others)] = others
    while done < n:
        stop = min(n, done + max(1, min(done // 2, 4096)))
        near, distance, _ = walk(x[:done], table[:done], x[done:stop], beam)
        for a in range(done, stop, 512):
            b = min(stop, a + 512)
            own = spread(x, near[a - done : b - done], distance[a - done : b - done], links)
            table[a:b, : own.shape[1]] = own
        new, slot = np.nonzero(table[done:stop] >= 0)
        old, new = table[done:stop][new, slot], new + done
        order = np.argsort(old, kind="stable")
        old, new = old[order], new[order]
        touched, first, count = np.unique(old, return_index=True, return_counts=True)
        for a in range(0, len(touched), 512):  # those that are linked back to choose anew among old and new links
            t, c = touched[a : a + 512], count[a : a + 512]
            width = c.max()
            added = np.full((len(t), width), -1)
            which = np.repeat(np.arange(len(t)), c)
            column = np.arange(len(which)) - np.repeat(np.cumsum(c) - c, c)
            added[which, column] = new[np.repeat(first[a : a + 512], c) + column]
            both = np.concatenate([table[t], added], axis=1)
            row, column = np.nonzero(both >= 0)
            away = np.full(both.shape, np.inf)
            away[row, column] = apart(x, t[row], x, both[row, column])
            order = np.argsort(away, axis=1, kind="stable")[:, : 2 * wide]
            table[t] = spread(x, np.take_along_axis(both, order, axis=1), np.take_along_axis(away, order, axis=1), wide)
        done = stop
    return table


def _matrix(column) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1)


def graph_index(references: DataFrame, metric: str = "l2", links: int = LINKS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """shard, place, cas_cell_index, embedding and links (places) of references; write it to use it again.

    references has cas_cell_index and embedding; null vectors are left out. A shard is one task's.
    """
    scaled(np.zeros((0, 1)), metric)
    r = references.select("cas_cell_index", "embedding").where(F.col("embedding").isNotNull())
    n, width = r.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    shards = max(1, -(-8 * n * width // shard_bytes), min(SHARDS, 8 * n * width // (shard_bytes // 4)))
    schema = "shard int, place int, cas_cell_index long, embedding array<double>, links array<int>"

    def link(t: pa.Table) -> pa.Table:
        t = t.sort_by("cas_cell_index")
        shuffled = t.take(pa.array(np.random.default_rng(len(t)).permutation(len(t))))  # the first ones are those that a walk starts from
        x = _matrix(shuffled.column("embedding"))
        table = build(compact(scaled(x, metric)), links)
        kept = table >= 0
        return pa.table({
            "shard": shuffled.column("shard"), "place": pa.array(np.arange(len(x), dtype=np.int32)), "cas_cell_index": shuffled.column("cas_cell_index"),
            "embedding": pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel())),
            "links": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(kept.sum(axis=1))]).astype(np.int32)), pa.array(table[kept].astype(np.int32))),
        })

    return r.withColumn("shard", F.pmod(F.xxhash64("cas_cell_index", "embedding"), F.lit(shards)).cast("int")).groupBy("shard").applyInArrow(link, schema)


def graph_search(queries: DataFrame, index: DataFrame, k: int = 10, metric: str = "l2", beam: int = 64) -> DataFrame:
    """cell_id, cas_cell_index, distance, rank (1 to k; ties by cas_cell_index) and compared: the vectors that the cell was compared with.

    index is that of graph_index for the same metric. Every query walks every shard. Where a walk finds fewer than k vectors of
    a shard that has them, the whole shard is measured, so every cell gets k rows if there are so many references.
    """
    scaled(np.zeros((0, 1)), metric)
    q = queries.select("cell_id", "embedding").where(F.col("embedding").isNotNull())
    n, width = q.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    shards = index.select("shard").distinct()
    # more parts only as far as the index is sent to some TASKS tasks
    parts = max(1, -(-8 * n * width // QUERY_BYTES), min(n // PART_ROWS, TASKS // max(1, shards.count())))
    schema = "cell_id long, cas_cell_index long, distance double, compared long"

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({"cell_id": pa.array([], pa.int64()), "cas_cell_index": pa.array([], pa.int64()), "distance": pa.array([], pa.float64()), "compared": pa.array([], pa.int64())})
        b = b.sort_by("place")
        x, y = scaled(_matrix(b.column("vector")), metric), scaled(_matrix(a.column("embedding")), metric)
        counts = b.column("links").combine_chunks().value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        table = np.full((len(x), max(1, int(counts.max()))), -1)
        table[np.repeat(np.arange(len(x)), counts), np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)] = b.column("links").combine_chunks().flatten().to_numpy()
        place, square, compared = walk(compact(x), table, y, max(beam, k))
        # what single precision put in order is measured again
        row, column = np.nonzero(place >= 0)
        square = np.full(place.shape, np.inf)
        square[row, column] = apart(y, row, x, place[row, column])
        order = np.argsort(square, axis=1, kind="stable")
        place, square = np.take_along_axis(place, order, axis=1), np.take_along_axis(square, order, axis=1)
        want = min(k, len(x))
        for i in np.flatnonzero((place[:, :want] < 0).any(axis=1)):
            every = ((x - y[i]) ** 2).sum(axis=1)
            nearest = np.argsort(every, kind="stable")[: place.shape[1]]
            place[i, : len(nearest)], square[i, : len(nearest)] = nearest, every[nearest]
            compared[i] += len(x)
        # all that are as near as the k-th, so that ties go by id
        kept = (place >= 0) & (square <= square[:, want - 1 : want])
        row, column = np.nonzero(kept)
        near = square[row, column]
        return pa.table({"cell_id": a.column("cell_id").combine_chunks().take(pa.array(row)), "cas_cell_index": b.column("cas_cell_index").combine_chunks().take(pa.array(place[row, column])), "distance": pa.array(near / 2 if metric == "cosine" else np.sqrt(near)), "compared": pa.array(compared[row])})

    part = F.pmod(F.xxhash64("cell_id", "embedding"), F.lit(parts)).cast("int")
    left = q.withColumn("part", part).crossJoin(F.broadcast(shards)).groupBy("part", "shard")  # a line a shard
    right = index.withColumn("part_of", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select("part_of", F.col("shard").alias("shard_of"), "place", "cas_cell_index", F.col("embedding").alias("vector"), "links").groupBy("part_of", "shard_of")
    met = left.cogroup(right).applyInArrow(search, schema)
    by = Window.partitionBy("cell_id")
    # a shard's count stands in each of its rows of the cell, the same in all
    met = met.withColumn("rank", F.row_number().over(by.orderBy("distance", "cas_cell_index")))
    return met.where(F.col("rank") <= k)
