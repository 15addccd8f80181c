"""Connectivities of a neighbour graph, as weighted-neighbour reducers take them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the definition: rounds of bisection, its tolerance, and the least share of the mean distance.
ROUNDS, TOLERANCE, LEAST_SHARE = 64, 1e-5, 1e-3


def bisected(distances: np.ndarray, goal: float) -> np.ndarray:
    """rho and sigma of each row of distances (filled up with infinity): rho is the least distance over 0, and
    the sum of exp(-max(0, d - rho) / sigma) is goal, as nearly as bisection gets."""
    real = np.isfinite(distances)
    rho = np.where(real & (distances > 0), distances, np.inf).min(axis=1, initial=np.inf)
    rho[~np.isfinite(rho)] = 0
    above = np.where(real, np.maximum(np.where(real, distances, 0) - rho[:, None], 0), np.inf)
    low, high, sigma = np.zeros(len(rho)), np.full(len(rho), np.inf), np.ones(len(rho))
    open_ = np.ones(len(rho), bool)
    for _ in range(ROUNDS):
        total = np.exp(-above / sigma[:, None]).sum(axis=1)
        open_ &= np.abs(total - goal) >= TOLERANCE
        large = open_ & (total > goal)
        small = open_ & ~large
        high[large] = sigma[large]
        low[small] = sigma[small]
        middle = np.where(np.isfinite(high), (low + np.where(np.isfinite(high), high, 0)) / 2, sigma * 2)
        sigma = np.where(open_, middle, sigma)
    return np.stack([rho, sigma], axis=1)


def smooth_distances(graph: DataFrame, n_neighbors: int) -> DataFrame:
    """i, rho and sigma of each cell of graph (i, j, distance), whose lists have n_neighbors cells with i itself.

    sigma is at least LEAST_SHARE of the mean distance of the cell (of all cells, where rho is 0), i itself at distance 0 counted.
    """
    goal = float(np.log2(n_neighbors))

    @F.pandas_udf("array<double>")
    def found(lists: pd.Series) -> pd.Series:
        width = max((len(x) for x in lists), default=0)
        table = np.full((len(lists), width), np.inf)
        for row, x in enumerate(lists):
            table[row, : len(x)] = x
        return pd.Series(list(bisected(table, goal)))

    rows = graph.groupBy("i").agg(F.collect_list("distance").alias("d"), F.sum("distance").alias("sum"), F.count("*").alias("n"))  # a cell's few neighbours
    every = rows.agg((F.sum("sum") / F.sum(F.col("n") + 1)).alias("mean_all"))
    solved = rows.select("i", F.col("sum").alias("_sum"), (F.col("n") + 1).alias("_n"), found("d").alias("x")).crossJoin(F.broadcast(every))  # one row
    rho, sigma = F.col("x")[0], F.col("x")[1]
    least = F.lit(LEAST_SHARE) * F.when(rho > 0, F.col("_sum") / F.col("_n")).otherwise(F.col("mean_all"))
    return solved.select("i", rho.alias("rho"), F.greatest(sigma, least).alias("sigma"))


def fuzzy_connectivities(graph: DataFrame, n_neighbors: int) -> DataFrame:
    """i, j and connectivity over graph (i, j, distance: each cell's nearest others): both directions of a pair alike.

    A neighbour belongs to a cell by exp(-max(0, d - rho) / sigma), and to both cells of a pair by the fuzzy union a + b - a b of its
    two memberships. i is no neighbour of itself; of a pair that repeats, the least distance counts.
    """
    if n_neighbors < 2:
        raise ValueError("n_neighbors must be at least 2")
    graph = graph.where("i <> j").groupBy("i", "j").agg(F.min("distance").alias("distance"))
    above = F.col("distance") - F.col("rho")
    member = F.when((above <= 0) | (F.col("sigma") == 0), F.lit(1.0)).otherwise(F.exp(-above / F.nullif(F.col("sigma"), F.lit(0.0))))
    ways = graph.join(smooth_distances(graph, n_neighbors), "i").select("i", "j", member.alias("w"))
    both = ways.unionByName(ways.select(F.col("j").alias("i"), F.col("i").alias("j"), "w"))
    union = F.sum("w") - F.when(F.count("*") == 2, F.product("w")).otherwise(0.0)
    return both.groupBy("i", "j").agg(union.alias("connectivity")).where("connectivity > 0")
