"""Neighbour search, neighbour statistics and look-ups of reference cells."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscore.operators.graph_index import graph_index, graph_search
from cellscore.plans import cut_lineage, small_enough

#: Reference vectors and query vectors that are compared at once.
BLOCK, QUERIES = 2048, 512
#: Bytes of vectors (as doubles) that one task holds: of all queries, if they are broadcast, or of one cell of the grid.
MOST_BYTES = 1 << 25
#: Fixed values, in the contract's order: the searchable columns of a reference cell.
CELL_FEATURES = (
    "cas_cell_index", "cell_type", "assay", "disease", "donor_id", "is_primary_data", "development_stage", "organism",
    "self_reported_ethnicity", "sex", "suspension_type", "tissue", "total_mrna_umis", "cell_type_ontology_term_id",
    "assay_ontology_term_id", "disease_ontology_term_id", "development_stage_ontology_term_id", "organism_ontology_term_id",
    "self_reported_ethnicity_ontology_term_id", "sex_ontology_term_id", "tissue_ontology_term_id",
)


def _vectors(ids, vectors) -> tuple[np.ndarray, np.ndarray]:
    """Arrow columns of ids and equally long vectors as arrays; floats stay single, as half the bytes."""
    ids = ids.to_numpy(zero_copy_only=False) if isinstance(ids, pa.Array) else ids.to_numpy()
    flat = (vectors if isinstance(vectors, pa.Array) else vectors.combine_chunks()).flatten().to_numpy(zero_copy_only=False)
    return ids, (flat if flat.dtype == np.float32 else flat.astype(np.float64)).reshape(len(ids), -1)


class Nearest:
    """The k nearest references of each query, of those added so far.

    Vectors stay as they came: QUERIES of them at a time are doubled, scaled and compared with a block, so that beside the vectors and k rows
    a query, memory is that of one such comparison, whatever the number of ties.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, metric: str, exclude_self: bool):
        self.ids, self.vectors, self.k, self.metric, self.exclude_self = ids, vectors, k, metric, exclude_self
        self.near, self.distance = np.zeros((len(ids), k), np.int64), np.full((len(ids), k), np.inf)
        self.filled = np.zeros(len(ids), np.int64)

    @staticmethod
    def scaled(x: np.ndarray, metric: str) -> np.ndarray:
        x = x.astype(np.float64)
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) if metric == "cosine" else x

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        room = np.empty(QUERIES * BLOCK)
        for start in range(0, len(ids), BLOCK):
            b = self.scaled(vectors[start : start + BLOCK], self.metric)
            square = (b**2).sum(axis=1)
            # a row (a, |a|^2, 1) times a column (-2 b, 1, |b|^2) is the squared distance, but for rounding
            columns = np.concatenate([-2 * b, np.ones((len(b), 1)), square[:, None]], axis=1).T
            for first in range(0, len(self.ids), QUERIES):
                self._meet(first, ids[start : start + BLOCK], b, columns, square.max(), room)

    def _meet(self, first: int, ids: np.ndarray, b: np.ndarray, columns: np.ndarray, most: float, room: np.ndarray) -> None:
        """QUERIES queries from the first-th on, and a block."""
        here = slice(first, first + QUERIES)
        a, k = self.scaled(self.vectors[here], self.metric), self.k
        square = (a**2).sum(axis=1)
        near = np.matmul(np.concatenate([a, square[:, None], np.ones((len(a), 1))], axis=1), columns, out=room[: len(a) * len(b)].reshape(len(a), len(b)))
        bound = np.where(self.filled[here] == k, self.distance[here, -1], np.inf)
        slack = 1e-9 + 1e-12 * (square + most)
        limit = (2 * bound if self.metric == "cosine" else bound**2) + slack
        close = near <= limit[:, None]
        if np.count_nonzero(close) > 2 * k * len(a):  # few references were seen so far: only the nearest of the block, ties included
            n = min(k + self.exclude_self, len(b))
            close &= near <= (np.partition(near, n - 1, axis=1)[:, n - 1] + slack)[:, None]
        of, at, far = [], [], []
        step = max(1, (1 << 19) // max(1, a.shape[1]))
        x, y = np.nonzero(close)
        for i in range(0, len(x), step):
            p, q = x[i : i + step], y[i : i + step]
            distance = ((a[p] - b[q]) ** 2).sum(axis=1)
            distance = distance / 2 if self.metric == "cosine" else np.sqrt(distance)
            better = distance <= bound[p]
            if self.exclude_self:
                better &= self.ids[first + p] != ids[q]
            of.append(p[better])
            at.append(ids[q[better]])
            far.append(distance[better])
        if not sum(map(len, of)):
            return
        # the rows so far of those that gain some
        touched = np.unique(np.concatenate(of))
        row, column = np.nonzero(np.arange(k) < self.filled[first + touched][:, None])
        row = touched[row]
        of, at, far = np.concatenate([*of, row]), np.concatenate([*at, self.near[first + row, column]]), np.concatenate([*far, self.distance[first + row, column]])
        order = np.lexsort((at, far, of))
        of = of[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of, side="left")
        kept = rank < k
        of, rank, order = of[kept], rank[kept], order[kept]
        self.near[first + of, rank], self.distance[first + of, rank] = at[order], far[order]
        self.filled[first + touched] = np.bincount(of, minlength=len(a))[touched]

    def table(self) -> pa.RecordBatch:
        row, column = np.nonzero(np.arange(self.k) < self.filled[:, None])
        return pa.RecordBatch.from_arrays([pa.array(self.ids[row]), pa.array(self.near[row, column]), pa.array(self.distance[row, column])], names=["cell_id", "cas_cell_index", "distance"])


def knn_search(queries: DataFrame, references: DataFrame, k: int = 10, metric: str = "l2", exclude_self: bool = False) -> DataFrame:
    """cell_id, cas_cell_index, distance and rank (1 to k; ties by cas_cell_index), exact.

    queries has cell_id and embedding, references cas_cell_index and embedding; null vectors are left out.
    A matrix product picks candidates; their distances are then worked out from the differences, so equal
    vectors are at 0.

    Queries of up to MOST_BYTES are broadcast, and a task over references keeps k rows a query. More of both are dealt
    to the cells of a grid: each cell holds a part of the queries and a part of the references, of about
    MOST_BYTES at most, and yields k rows a query. Those are all that is shuffled to rank them.
    """
    if metric not in ("l2", "cosine"):
        raise ValueError(f"unknown metric {metric}")
    spark = queries.sparkSession
    q = queries.select("cell_id", "embedding").where(F.col("embedding").isNotNull())
    r = references.select("cas_cell_index", "embedding").where(F.col("embedding").isNotNull())
    schema = "cell_id long, cas_cell_index long, distance double"
    weigh = lambda df: tuple(df.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first())
    n, width = weigh(q)
    if 8 * n * width <= MOST_BYTES:
        shared = spark.sparkContext.broadcast(_vectors(*q.toArrow().columns) if n else None)

        def nearest(batches):
            if shared.value is None:
                return
            found = Nearest(*shared.value, k, metric, exclude_self)
            for batch in batches:
                if batch.num_rows:
                    found.add(*_vectors(*batch.columns))
            yield found.table()

        met = r.mapInArrow(nearest, schema)
    else:
        parts = lambda count: max(1, -(-8 * count * width // MOST_BYTES))
        nq, nr = parts(n), parts(weigh(r)[0])
        deal = lambda df, key, own, other, name, theirs: df.withColumn(name, F.pmod(F.xxhash64(key), F.lit(own)).cast("int")).withColumn(theirs, F.explode(F.sequence(F.lit(0), F.lit(other - 1))))
        left = deal(q, "cell_id", nq, nr, "i", "j").groupBy("i", "j")
        right = deal(r, "cas_cell_index", nr, nq, "j", "i").groupBy("i", "j")

        def compare(a: pa.Table, b: pa.Table) -> pa.Table:
            if not a.num_rows or not b.num_rows:
                return pa.table({"cell_id": pa.array([], pa.int64()), "cas_cell_index": pa.array([], pa.int64()), "distance": pa.array([], pa.float64())})
            found = Nearest(*_vectors(a.column("cell_id"), a.column("embedding")), k, metric, exclude_self)
            found.add(*_vectors(b.column("cas_cell_index"), b.column("embedding")))
            return pa.Table.from_batches([found.table()])

        met = left.cogroup(right).applyInArrow(compare, schema)
    rank = F.row_number().over(Window.partitionBy("cell_id").orderBy("distance", "cas_cell_index"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k)


def knn_search_approx(queries: DataFrame, references: DataFrame, k: int = 10, metric: str = "l2", beam: int = 64, links: int = 16) -> DataFrame:
    """Approximate neighbours, by a walk through proximity graphs of the references (see graph_index, which builds them once for many searches).

    Every cell gets k rows if there are so many references. A wider beam, or more links, raise the recall.
    """
    return graph_search(queries, cut_lineage(graph_index(references, metric, links)), k, metric, beam).drop("compared")


def neighbor_summary_stats(neighbors: DataFrame) -> DataFrame:
    """By cell and cell type: cell_count, and the least, quartile, median and greatest distance."""
    quartiles = F.percentile("distance", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    stats = neighbors.groupBy("cell_id", "cell_type").agg(F.count("*").alias("cell_count"), F.min("distance").alias("min_distance"), quartiles.alias("q"), F.max("distance").alias("max_distance"))
    return stats.select("cell_id", "cell_type", "cell_count", "min_distance", F.col("q")[0].alias("p25_distance"), F.col("q")[1].alias("median_distance"), F.col("q")[2].alias("p75_distance"), "max_distance")


def neighbor_dataset_stats(neighbors: DataFrame) -> DataFrame:
    """By cell, cell type and dataset: count_per_dataset and the least, greatest, median and mean distance."""
    return neighbors.groupBy("cell_id", "cell_type", "dataset_id").agg(
        F.count("*").alias("count_per_dataset"), F.min("distance").alias("min_distance"), F.max("distance").alias("max_distance"),
        F.median("distance").alias("median_distance"), F.avg("distance").alias("mean_distance"),
    )


def summary_response(neighbors: DataFrame, extended: bool = False) -> DataFrame:
    """One row a cell with matches, a list by cell type; with extended, each match lists its datasets, else that is null."""
    stats = neighbor_summary_stats(neighbors)
    names = ["cell_type", "cell_count", "min_distance", "p25_distance", "median_distance", "p75_distance", "max_distance"]
    if extended:
        one = F.struct("dataset_id", "count_per_dataset", "min_distance", "max_distance", "median_distance", "mean_distance")
        lists = neighbor_dataset_stats(neighbors).groupBy("cell_id", "cell_type").agg(F.array_sort(F.collect_list(one)).alias("dataset_ids_with_counts"))
        stats = stats.join(lists, ["cell_id", "cell_type"])
    else:
        stats = stats.withColumn("dataset_ids_with_counts", F.lit(None).cast("array<string>"))
    return stats.groupBy("cell_id").agg(F.array_sort(F.collect_list(F.struct(*names, "dataset_ids_with_counts"))).alias("matches"))


def distance_weight(distance, median, prefactor: float):
    """exp(-|prefactor| d / median), 1 where the median is 0."""
    return F.when(median == 0, F.lit(1.0)).otherwise(F.exp(-F.lit(abs(prefactor)) * distance / F.nullif(median, F.lit(0.0))))


def ontology_aware_scores(neighbors: DataFrame, terms: DataFrame, closure: DataFrame, prune_threshold: float = 0.05, weighting_prefactor: float = 1.0, weight=distance_weight) -> DataFrame:
    """cell_id, term_id, label, score, total_weight, total_neighbors, total_neighbors_unrecognized.

    A term's score is the share of weight of the neighbours whose cell type is the term or
    below it. terms and closure are broadcast if they are small, as an ontology's are. All windows
    and groups are by cell, so the neighbours are shuffled once then.
    """
    by = Window.partitionBy("cell_id")
    known = small_enough(terms.select(F.col("term_id").alias("cell_type"), F.lit(True).alias("known")))
    weighed = neighbors.withColumn("median", F.median("distance").over(by)).join(known, "cell_type", "left")
    weighed = weighed.withColumn("w", F.when(F.col("known"), weight(F.col("distance"), F.col("median"), weighting_prefactor)))
    weighed = weighed.withColumns({"total_weight": F.sum("w").over(by), "total_neighbors": F.count("*").over(by), "total_neighbors_unrecognized": F.count_if(F.col("known").isNull()).over(by)})
    up = small_enough(closure.select(F.col("term_id").alias("cell_type"), F.col("ancestor_id").alias("term_id")))
    scored = weighed.where("known").join(up, "cell_type").groupBy("cell_id", "term_id", "total_weight", "total_neighbors", "total_neighbors_unrecognized").agg(F.sum("w").alias("s"))
    scored = scored.select("cell_id", "term_id", F.try_divide("s", "total_weight").alias("score"), "total_weight", "total_neighbors", "total_neighbors_unrecognized")
    return scored.where(F.col("score") >= prune_threshold).join(small_enough(terms.select("term_id", "label")), "term_id")


def align_results_to_query(cells: DataFrame, response: DataFrame, order: str) -> DataFrame:
    """Every query cell with its matches; one without a result has an empty list and unprocessed true.

    response has cell_id, matches and the column order; of several results of a cell, the last by it counts
    (of equals, the one whose list compares as greater).
    """
    if order not in response.columns:
        raise ValueError(f"no column {order}, which tells the last result of a cell; there are {', '.join(response.columns)}")
    last = response.groupBy("cell_id").agg(F.max_by("matches", F.struct(F.col(order), F.col("matches"))).alias("matches"))
    empty = F.array().cast(response.schema["matches"].dataType)
    return cells.join(last, "cell_id", "left").withColumns({"unprocessed": F.col("matches").isNull(), "matches": F.coalesce("matches", empty)})


def query_cells_by_ids(references: DataFrame, ids: DataFrame | None, features: list[str] | None = None, condition: Column | None = None) -> DataFrame:
    """Reference cells with the given ids (column cas_cell_index), or of a condition in their place, and the chosen features."""
    features = list(features or CELL_FEATURES)
    unknown = [f for f in features if f not in CELL_FEATURES]
    if unknown:
        raise ValueError(f"unknown features: {', '.join(unknown)}")
    chosen = list(dict.fromkeys(["cas_cell_index", *features]))
    if condition is not None:
        return references.where(condition).select(*chosen)
    return references.join(ids.select("cas_cell_index").distinct(), "cas_cell_index", "left_semi").select(*chosen)


def write_reference_store(path: str, references: DataFrame, files: int | None = None, overwrite: bool = False) -> None:
    """References as Parquet in the order of cas_cell_index, with Bloom filters of it, so that a look-up reads row groups that may hold an asked id."""
    n = max(1, references.count())
    ordered = references.repartitionByRange(files, "cas_cell_index") if files else references.repartitionByRange("cas_cell_index")
    options = {"parquet.bloom.filter.enabled#cas_cell_index": "true", "parquet.bloom.filter.expected.ndv#cas_cell_index": str(-(-n // files) if files else min(n, 1_000_000))}
    ordered.sortWithinPartitions("cas_cell_index").write.mode("overwrite" if overwrite else "error").options(**options).parquet(path)


#: Ids of a look-up that are pushed down to the store; for more, the range of the ids is, and the rest is a join.
MOST_PUSHED = 10_000


def query_store_by_ids(store: DataFrame, ids: DataFrame, features: list[str] | None = None) -> DataFrame:
    """The rows of query_cells_by_ids from a store, as spark.read.parquet gives what write_reference_store wrote. Runs one small job over ids."""
    wanted = ids.select(F.col("cas_cell_index").cast("long").alias("cas_cell_index")).where(F.col("cas_cell_index").isNotNull()).distinct()
    some = [r["cas_cell_index"] for r in wanted.limit(MOST_PUSHED + 1).collect()]
    if len(some) <= MOST_PUSHED:
        return query_cells_by_ids(store, None, features, F.col("cas_cell_index").isin(some) if some else F.lit(False))
    low, high = wanted.agg(F.min("cas_cell_index"), F.max("cas_cell_index")).first()
    return query_cells_by_ids(store.where(F.col("cas_cell_index").between(low, high)), wanted, features)


def drop_null_fields(records: DataFrame, key: str = "cas_cell_index") -> DataFrame:
    """key and fields: an object (VARIANT) of the other columns with their types, without those that are null."""
    names = [c for c in records.columns if c != key]
    pairs = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*(F.col(c).cast("variant") for c in names)))
    return records.select(key, F.to_variant_object(F.map_filter(pairs, lambda _, v: v.isNotNull())).alias("fields"))
