"""Reducers over neighbour statistics: by cell, by cluster and over a neighbour graph.

matches has cell_id, pos (place in the cell's list), cell_type, cell_count and min_distance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellscore.plans import small_enough

#: Fixed value: the label that others expect for types of too few cells.
UNRELIABLE = "Unknown or Unconfident"
#: The ways to weigh neighbours that the contract allows.
STRATEGIES = ("connectivities",)


def majority_vote(cells: DataFrame, matches: DataFrame) -> DataFrame:
    """cell_id, cell_type of the largest count (the first in the list of equals) and confidence, its share; null without matches."""
    best = F.min_by(F.struct("cell_type", "cell_count"), F.struct(-F.col("cell_count"), F.col("pos")))
    voted = matches.groupBy("cell_id").agg(best.alias("x"), F.sum("cell_count").alias("total"))
    return cells.select("cell_id").join(voted, "cell_id", "left").select("cell_id", "x.cell_type", F.try_divide("x.cell_count", "total").alias("confidence"))


def min_distance_vote(cells: DataFrame, matches: DataFrame) -> DataFrame:
    """cell_id, cell_type of the least distance (the first of equals) and min_distance; without matches null and infinity."""
    best = matches.groupBy("cell_id").agg(F.min_by(F.struct("cell_type", "min_distance"), F.struct("min_distance", "pos")).alias("x"))
    return cells.select("cell_id").join(best, "cell_id", "left").select("cell_id", "x.cell_type", F.coalesce("x.min_distance", F.lit(float("inf"))).alias("min_distance"))


def cluster_vote_detail(matches: DataFrame, clusters: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """cluster, cell_type, frequency and rank, from the summed counts of the cluster's cells.

    Equal counts go by first appearance: the earliest cell (pos of clusters), then place in its list.
    """
    joined = matches.where(~F.col("cell_type").isin(*ignore)) if ignore else matches
    joined = joined.join(clusters.select("cell_id", "cluster", F.col("pos").alias("cell_pos")), "cell_id").where(F.col("cluster").isNotNull())
    summed = joined.groupBy("cluster", "cell_type").agg(F.sum("cell_count").alias("n"), F.min(F.struct("cell_pos", "pos")).alias("first"))
    by = Window.partitionBy("cluster")
    return summed.select("cluster", "cell_type", (F.col("n") / F.sum("n").over(by)).alias("frequency"), F.row_number().over(by.orderBy(F.desc("n"), "first")).alias("rank"))


def cluster_majority_vote(matches: DataFrame, clusters: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """cell_id, cell_type and confidence of the cell's cluster; null for a cluster of ignored types only."""
    best = cluster_vote_detail(matches, clusters, ignore).where("rank = 1").select("cluster", "cell_type", F.col("frequency").alias("confidence"))
    return clusters.join(best, "cluster", "left").select("cell_id", "cell_type", "confidence")


def wnn_weights(graph: DataFrame, cells: DataFrame, n_neighbors: int = 10, self_connectivity: float = 1.0) -> DataFrame:
    """i, j and weight: each cell's strongest edges, the edge to itself included, as shares of their sum.

    A cell without an edge has itself alone. Weights that don't add up to 1, as those of connectivities of 0, are an error.
    """
    if n_neighbors < 1:
        raise ValueError("n_neighbors must be at least 1")
    own = cells.select(F.col("cell_id").alias("i"), F.col("cell_id").alias("j"), F.lit(float(self_connectivity)).alias("connectivity"))
    edges = graph.where("i <> j").select("i", "j", "connectivity").unionByName(own)
    rank = F.row_number().over(Window.partitionBy("i").orderBy(F.desc("connectivity"), "j"))
    top = edges.withColumn("rank", rank).where(F.col("rank") <= n_neighbors).withColumn("sum", F.sum("connectivity").over(Window.partitionBy("i")))
    share = F.when(F.col("sum") > 0, F.col("connectivity") / F.nullif(F.col("sum"), F.lit(0.0))).otherwise(F.raise_error(F.lit("weights do not add up to 1")).cast("double"))
    return top.select("i", "j", share.alias("weight"))


def cell_type_probs(matches: DataFrame) -> DataFrame:
    """cell_id, cell_type and prob: the type's share of the cell's counts."""
    return matches.select("cell_id", "cell_type", F.try_divide("cell_count", F.sum("cell_count").over(Window.partitionBy("cell_id"))).alias("prob"))


def wnn_probs(weights: DataFrame, probs: DataFrame) -> DataFrame:
    """cell_id, cell_type and prob: the neighbours' probabilities, weighted."""
    joined = weights.join(probs.select(F.col("cell_id").alias("j"), "cell_type", "prob"), "j")
    return joined.groupBy(F.col("i").alias("cell_id"), "cell_type").agg(F.sum(F.col("weight") * F.col("prob")).alias("prob"))


def wnn_vote(probs: DataFrame, digits: int = 9) -> DataFrame:
    """cell_id, cell_type and confidence: the likeliest type; of types equal to so many digits the first by name."""
    best = F.min_by(F.struct("cell_type", "prob"), F.struct(-F.round("prob", digits), F.col("cell_type")))
    return probs.groupBy("cell_id").agg(best.alias("x")).select("cell_id", "x.cell_type", F.col("x.prob").alias("confidence"))


def relabel_rare_types(voted: DataFrame, min_n_cells_per_type: int = 10, unreliable: str = UNRELIABLE) -> DataFrame:
    """voted with types of fewer cells replaced; the confidence stays.

    The count is a groupBy with partial sums, not a window, since one type may hold most cells.
    """
    rare = voted.groupBy("cell_type").count().where(F.col("count") < min_n_cells_per_type).select("cell_type", F.lit(True).alias("rare"))
    return voted.join(rare, "cell_type", "left").select("cell_id", F.when(F.col("rare"), F.lit(unreliable)).otherwise(F.col("cell_type")).alias("cell_type"), "confidence")


def wnn(cells: DataFrame, responses: DataFrame, graph: DataFrame, graph_neighbors: int, n_neighbors: int = 10, strategy: str = "connectivities", self_connectivity: float = 1.0, min_n_cells_per_type: int = 10, unreliable: str = UNRELIABLE) -> tuple[DataFrame, DataFrame]:
    """The votes (cell_id, cell_type, confidence) of all cells, null for those without any match around, and the probabilities behind them.

    responses has a row for each cell: cell_id and matches (a list). graph_neighbors is what the graph was built with.
    An unknown strategy, or more neighbours than the graph has, is an error at once; a cell without a response, or a response of no cell, when
    the votes are worked out.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {', '.join(STRATEGIES)}, not {strategy}")
    if n_neighbors > graph_neighbors:
        raise ValueError(f"n_neighbors is {n_neighbors}, but the graph has {graph_neighbors}")
    paired = cells.select("cell_id", F.lit(True).alias("there")).join(responses.select("cell_id", "matches"), "cell_id", "full")
    both = F.col("there").isNotNull() & F.col("matches").isNotNull()
    listed = F.when(both, F.col("matches")).otherwise(F.raise_error(F.lit("there must be a response for each cell")).cast(responses.schema["matches"].dataType))
    matches = paired.select("cell_id", F.posexplode(listed).alias("pos", "m")).select("cell_id", "pos", "m.cell_type", "m.cell_count")
    probs = wnn_probs(wnn_weights(graph, cells, n_neighbors, self_connectivity), cell_type_probs(matches))
    voted = relabel_rare_types(wnn_vote(probs), min_n_cells_per_type, unreliable)
    return cells.select("cell_id").join(voted, "cell_id", "left"), probs


def interpolate_type_colors(probs: DataFrame, colors: DataFrame) -> DataFrame:
    """cell_id, r, g, b (0 to 1): the colours (hex) of its types, mixed by probability; a type without one is white."""
    joined = probs.join(small_enough(colors.select("cell_type", "hex")), "cell_type", "left")
    plain = F.lower(F.ltrim(F.coalesce("hex", F.lit("#ffffff")), F.lit("#")))
    part = lambda i: F.least(F.greatest(F.sum(F.col("prob") * F.conv(F.substring(plain, 2 * i + 1, 2), 16, 10).cast("double")) / 255, F.lit(0.0)), F.lit(1.0))
    return joined.groupBy("cell_id").agg(part(0).alias("r"), part(1).alias("g"), part(2).alias("b"))
