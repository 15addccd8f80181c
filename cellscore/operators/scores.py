"""Score matrices, their aggregation over cells, and the most granular supported labels.

A score matrix is long: cell_id, term_id, score; a pair that is absent scores 0.
terms has term_id, idx, label, depth_short and depth_long.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellscore.operators.ontology import ROOT
from cellscore.plans import cut_lineage, small_enough
from cellscore.plans.lineage import MOST_SMALL

THRESHOLD = 1e-4


def score_matrix(response: DataFrame, terms: DataFrame) -> DataFrame:
    """cell_id, term_id, idx and score from matches; scores of a pair that comes twice add up. An unknown term is an error."""
    joined = response.join(small_enough(terms.select("term_id", "idx")), "term_id", "left")
    known = F.when(F.col("idx").isNotNull(), F.col("idx")).otherwise(F.raise_error(F.concat(F.lit("unknown term "), F.col("term_id"))).cast("int"))
    return joined.groupBy("cell_id", "term_id", known.alias("idx")).agg(F.sum(F.col("score").cast("double")).alias("score"))


def attach_scores(scores: DataFrame, terms: DataFrame, resource_name: str) -> DataFrame:
    """The score matrix with labels and the name of the ontology resource."""
    return scores.join(small_enough(terms.select("term_id", "label")), "term_id").withColumn("resource_name", F.lit(resource_name))


def require_selection(cells: DataFrame) -> DataFrame:
    """cells, or an error if there is none. Runs one small job."""
    if cells.isEmpty():
        raise ValueError("no cell is selected")
    return cells


def _selected(scores: DataFrame, cells: DataFrame, by: str | None) -> tuple[DataFrame, DataFrame]:
    """Stored scores over 0 (grp, term_id, score) of the selected cells, and sizes (grp, cells). An empty selection is an error."""
    group = F.col(by) if by else F.lit("all")
    members = require_selection(cells).select("cell_id", group.alias("grp")).where(F.col("grp").isNotNull())
    stored = scores.join(members, "cell_id").select("grp", "term_id", F.col("score").cast("double").alias("score"))
    stored = stored.withColumn("score", F.when(F.col("score") < 0, F.raise_error(F.lit("negative score")).cast("double")).otherwise(F.col("score")))
    return stored.where("score > 0"), members.groupBy("grp").agg(F.count("*").alias("cells"))


def fraction_over_threshold(scores: DataFrame, cells: DataFrame, terms: DataFrame, threshold: float = THRESHOLD, by: str | None = None) -> DataFrame:
    """grp, term_id, idx and fraction: the share of the group's cells with a score over the threshold, for every group and term."""
    stored, sizes = _selected(scores, cells, by)
    above = stored.where(F.col("score") > threshold).groupBy("grp", "term_id").agg(F.count("*").alias("above"))
    dense = sizes.crossJoin(small_enough(terms.select("term_id", "idx")))
    return dense.join(above, ["grp", "term_id"], "left").select("grp", "term_id", "idx", F.coalesce(F.col("above") / F.col("cells"), F.lit(0.0)).alias("fraction"))


#: Bins of a histogram, and histograms within each other, before the values of one bin are sorted.
BINS, LEVELS = 4096, 2


def _at_ranks(counted: DataFrame, wanted: DataFrame, start: int, few: bool) -> DataFrame:
    """grp, term_id, slot and value: the value at a rank (from 0) among the values of grp and term_id.

    counted has grp, term_id, score and n (times), wanted grp, term_id, slot, rank, and lo and hi, between which the value
    lies. Histograms, from level start on, narrow lo and hi down, a bin of the last one is sorted: no window holds all values of a term.
    few tells that the groups and terms are few enough to broadcast.
    """
    key = ["grp", "term_id", "lo", "hi"]
    width = F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))
    for level in range(start, LEVELS + 1):
        ranges = wanted.select(*key).distinct()
        ours = counted.join(F.broadcast(ranges) if few else ranges, ["grp", "term_id"]).where((F.col("score") >= F.col("lo")) & (F.col("score") <= F.col("hi")))
        place = F.coalesce(F.least(F.floor((F.col("score") - F.col("lo")) / width * BINS), F.lit(BINS - 1)), F.lit(0)) if level < LEVELS else F.col("score")
        tally = ours.groupBy(*key, place.alias("bin")).agg(F.sum("n").alias("n"), F.min("score").alias("least"), F.max("score").alias("most"))
        upto = tally.withColumn("upto", F.sum("n").over(Window.partitionBy(*key).orderBy("bin")))
        met = wanted.join(upto, key).where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        wanted = met.select("grp", "term_id", "slot", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), F.col("least").alias("lo"), F.col("most").alias("hi"))
        if level < LEVELS:
            wanted = cut_lineage(wanted)
            if wanted.where("lo < hi").isEmpty():
                break
    return wanted.select("grp", "term_id", "slot", F.col("lo").alias("value"))


def aggregate_scores(scores: DataFrame, cells: DataFrame, terms: DataFrame, threshold: float = THRESHOLD, by: str | None = None) -> DataFrame:
    """All four aggregates and the fraction over the threshold, for every group and every term.

    cells (cell_id and, if given, the column by) is the selection, and must not be empty; by None makes one group,
    named all. Columns: mean_all, median_all (over all cells, absent pairs as 0), mean_over,
    median_over (over scores above the threshold, 0 if there is none), fraction. Scores must
    not be negative: the zeros come first, so the median is found by rank without storing them.
    A group and term may hold any number of cells: the middle values are found by histograms.
    """
    stored, sizes = _selected(scores, cells, by)
    # equal scores are counted together, so a group and term has a row for each distinct score
    counted = cut_lineage(stored.groupBy("grp", "term_id", "score").agg(F.count("*").alias("n")))
    over = F.col("score") > threshold
    facts = counted.groupBy("grp", "term_id").agg(
        F.sum("n").alias("stored"), F.count("*").alias("values"), F.coalesce(F.sum(F.when(over, F.col("n"))), F.lit(0)).alias("above"), F.min("score").alias("lo"), F.max("score").alias("hi"),
        F.sum(F.col("score") * F.col("n")).alias("sum"), F.coalesce(F.sum(F.when(over, F.col("score") * F.col("n"))), F.lit(0.0)).alias("sum_over"),
    )
    facts = cut_lineage(facts.join(sizes, "grp"))
    # where no group and term has more values than a histogram has bins, they are sorted at once
    pairs, most = facts.agg(F.count("*"), F.coalesce(F.max("values"), F.lit(0))).first()
    # ranks among the stored scores: of all cells, those without a score come first; of the ones over the threshold, those at or below it
    middle = lambda size: (F.floor((size - 1) / 2), F.ceil((size - 1) / 2))
    ranks = [m - F.col("cells") + F.col("stored") for m in middle(F.col("cells"))] + [m + F.col("stored") - F.col("above") for m in middle(F.col("above"))]
    slots = F.array(*(F.struct(F.lit(i).alias("slot"), r.cast("long").alias("rank")) for i, r in enumerate(ranks)))
    wanted = facts.select("grp", "term_id", "lo", "hi", F.inline(slots)).where((F.col("rank") >= 0) & (F.col("rank") < F.col("stored")))
    at = lambda i: F.coalesce(F.max(F.when(F.col("slot") == i, F.col("value"))), F.lit(0.0))
    medians = _at_ranks(counted, wanted, LEVELS if most <= BINS else 0, 4 * pairs <= MOST_SMALL).groupBy("grp", "term_id").agg(((at(0) + at(1)) / 2).alias("median_all"), ((at(2) + at(3)) / 2).alias("median_over"))
    dense = sizes.crossJoin(small_enough(terms.select("term_id", "idx")))
    joined = dense.join(facts.drop("cells"), ["grp", "term_id"], "left").join(medians, ["grp", "term_id"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return joined.select(
        "grp", "term_id", "idx",
        zero(F.col("sum") / F.col("cells")).alias("mean_all"),
        zero(F.col("median_all")).alias("median_all"),
        zero(F.try_divide("sum_over", "above")).alias("mean_over"),
        zero(F.when(F.col("above") > 0, F.col("median_over"))).alias("median_over"),
        zero(F.col("above") / F.col("cells")).alias("fraction"),
    )


def most_granular_top_k(scores: DataFrame, terms: DataFrame, groups: DataFrame, min_acceptable_score: float, top_k: int = 1, root_note: str = "ROOT", shortest: bool = True) -> DataFrame:
    """grp, rank, score, depth, term_id and label: per group, the k deepest terms of a score at or over the minimum.

    Order: depth and score descending, then place in the ontology; ranks beyond the terms are
    padded with the root note (score 1, depth 0). A term without depth is an error. With a
    minimum at or under 0, terms that are absent count as well, so the scores are made dense.
    """
    depth = F.col("depth_short" if shortest else "depth_long")
    known = terms.select("term_id", "idx", "label", F.when(depth.isNotNull(), depth).otherwise(F.raise_error(F.concat(F.lit("no depth for "), F.col("term_id"))).cast("int")).alias("depth"))
    scores = scores.select("grp", "term_id", "score")
    if min_acceptable_score <= 0:
        dense = groups.select("grp").distinct().crossJoin(small_enough(terms.select("term_id")))
        scores = dense.join(scores, ["grp", "term_id"], "left").select("grp", "term_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    ranked = scores.where(F.col("score") >= min_acceptable_score).join(small_enough(known), "term_id")
    rank = F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("depth"), F.desc("score"), "idx"))
    top = ranked.withColumn("rank", rank).where(F.col("rank") <= top_k).select("grp", "rank", "score", "depth", "term_id", "label")
    spine = groups.select("grp").distinct().select("grp", F.explode(F.sequence(F.lit(1), F.lit(top_k))).alias("rank"))
    padded = spine.join(top, ["grp", "rank"], "left")
    pad = F.col("term_id").isNull()
    return padded.select("grp", "rank", F.when(pad, 1.0).otherwise(F.col("score")).alias("score"), F.when(pad, 0).otherwise(F.col("depth")).alias("depth"), F.when(pad, F.lit(ROOT)).otherwise(F.col("term_id")).alias("term_id"), F.when(pad, F.lit(root_note)).otherwise(F.col("label")).alias("label"))


def calls_wide(top: DataFrame, top_k: int, prefix: str, key: str) -> DataFrame:
    """key and {prefix}_label_k, _name_k and _score_k for each rank: all labels, then names, then scores."""
    pick = lambda c, r: F.max(F.when(F.col("rank") == r, F.col(c)))
    columns = [pick(c, r).alias(f"{prefix}_{name}_{r}") for name, c in (("label", "label"), ("name", "term_id"), ("score", "score")) for r in range(1, top_k + 1)]
    return top.groupBy(F.col("grp").alias(key)).agg(*columns)


def top_k_calls_single(scores: DataFrame, cells: DataFrame, terms: DataFrame, min_acceptable_score: float, top_k: int = 3, prefix: str = "cas_cell_type", shortest: bool = True) -> DataFrame:
    """The most granular labels of each cell, wide."""
    groups = cells.select(F.col("cell_id").alias("grp"))
    top = most_granular_top_k(scores.withColumnRenamed("cell_id", "grp"), terms, groups, min_acceptable_score, top_k, shortest=shortest)
    return calls_wide(top, top_k, prefix, "cell_id")


def top_k_calls_cluster(scores: DataFrame, cells: DataFrame, terms: DataFrame, min_acceptable_score: float, cluster: str = "cluster", aggregate: str = "mean_all", threshold: float = THRESHOLD, top_k: int = 3, prefix: str = "cas_cluster_type", shortest: bool = True) -> DataFrame:
    """The most granular labels of each cluster's aggregated scores, on each of its cells; null for cells without a cluster."""
    summed = aggregate_scores(scores, cells, terms, threshold, by=cluster)
    top = most_granular_top_k(summed.select("grp", "term_id", F.col(aggregate).alias("score")), terms, summed, min_acceptable_score, top_k, shortest=shortest)
    wide = calls_wide(top, top_k, prefix, cluster)
    return cells.select("cell_id", cluster).join(wide, cluster, "left").drop(cluster)


def rooted_score_tree(aggregated: DataFrame, edges: DataFrame, root: str = ROOT, min_score: float = 0.05, min_fraction: float = 0.0, hidden: tuple[str, ...] = ()) -> DataFrame:
    """path, ord, term_id, parent, depth, score and fraction: the graph unrolled from the root, one row a path.

    aggregated has term_id, score and fraction; edges has child_ord. ord is the place of each node of the path among its
    parent's children, so rows ordered by it are the tree in the resource's order. A node that is hidden, or at or under a
    minimum, is left out on each path, with what is below it there. A root that fails is an error, and so is a path that
    meets a term again; a path may be of any length otherwise. Each level is written once, and the next one starts from it.
    """
    passing = aggregated.where((F.col("score") > min_score) & (F.col("fraction") > min_fraction) & ~F.col("term_id").isin(*(hidden or ("",)))).select("term_id", "score", "fraction")
    passing = cut_lineage(passing)
    level = passing.where(F.col("term_id") == root).select(F.array("term_id").alias("path"), F.array().cast("array<int>").alias("ord"), "term_id", F.lit(None).cast("string").alias("parent"), F.lit(0).alias("depth"), "score", "fraction")
    if level.isEmpty():
        raise ValueError(f"the root {root} does not pass")
    down = edges.select(F.col("parent").alias("above"), "child", F.col("child_ord").cast("int").alias("place")).join(passing, F.col("child") == F.col("term_id"))
    down = cut_lineage(down.select("above", F.col("child").alias("below"), "place", F.col("score").alias("s"), F.col("fraction").alias("f")))
    levels, again = [level], F.exists(F.slice("path", 1, F.size("path") - 1), lambda x: x == F.col("term_id"))
    while True:
        grown = levels[-1].join(down, F.col("term_id") == F.col("above"))
        grown = grown.select(F.array_append("path", F.col("below")).alias("path"), F.array_append("ord", F.col("place")).alias("ord"), F.col("below").alias("term_id"), F.col("above").alias("parent"), F.lit(len(levels)).alias("depth"), F.col("s").alias("score"), F.col("f").alias("fraction"))
        level = cut_lineage(grown)
        seen = level.agg(F.count("*").alias("n"), F.first(F.when(again, F.col("term_id")), ignorenulls=True).alias("term")).first()
        if seen["term"] is not None:
            raise ValueError(f"a path meets {seen['term']} again: the graph has a cycle")
        if not seen["n"]:
            return reduce(DataFrame.unionByName, levels)
        levels.append(level)


def term_score_opacity(scores: DataFrame, cells: DataFrame, term: str, low: float = 0.1, high: float = 1.0) -> DataFrame:
    """cell_id, score of one term (0 if absent) and opacity: the larger of the score and its place between the extremes."""
    one = cells.select("cell_id").join(scores.where(F.col("term_id") == term).select("cell_id", F.col("score").alias("s")), "cell_id", "left").select("cell_id", F.coalesce("s", F.lit(0.0)).alias("score"))
    extremes = one.agg(F.min("score").alias("least"), F.max("score").alias("most"))
    scaled = low + (high - low) * (F.col("score") - F.col("least")) / (1e-6 + F.col("most") - F.col("least"))
    return one.crossJoin(F.broadcast(extremes)).select("cell_id", "score", F.greatest("score", scaled).alias("opacity"))  # one row of extremes


def padded_bounds(points: DataFrame, padding: float = 0.05) -> DataFrame:
    """x_min, x_max, y_min, y_max, widened by a share of the range."""
    found = points.agg(*(f(c).alias(f"{c}_{n}") for c in ("x", "y") for f, n in ((F.min, "lo"), (F.max, "hi"))))
    pad = lambda c: padding * (F.col(f"{c}_hi") - F.col(f"{c}_lo"))
    return found.select(*(x for c in ("x", "y") for x in ((F.col(f"{c}_lo") - pad(c)).alias(f"{c}_min"), (F.col(f"{c}_hi") + pad(c)).alias(f"{c}_max"))))


def inferred_labels(single: DataFrame, cluster: DataFrame | None = None) -> DataFrame:
    """cell_id and the label, name and score columns of cells, then those of clusters, as far as they exist."""
    return single if cluster is None else single.join(cluster, "cell_id", "left")
