"""Operators over the cell ontology, a graph of terms in which a term may have several parents.

edges has columns parent, child and child_ord (place among the parent's children).
"""

from __future__ import annotations

import re
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscore.plans import cut_lineage, small_enough

ROOT = "CL:0000000"


def parents_map(edges: DataFrame) -> DataFrame:
    """child and parent of every edge."""
    return edges.select("child", "parent").distinct()


def _twice(steps: DataFrame) -> DataFrame:
    """Pairs (low, high) that are twice as many edges apart as those of steps."""
    return steps.join(steps.select(F.col("low").alias("high"), F.col("high").alias("further")), "high").select("low", F.col("further").alias("high")).distinct()


def ancestor_closure(edges: DataFrame, terms: DataFrame) -> DataFrame:
    """term_id and ancestor_id for each term and each term it can be reached from, itself included.

    By doubling: with the pairs that are just 2^k edges apart, all pairs of less than 2^(k+1) edges follow from those of less than
    2^k, so there are as many rounds as the depth has binary digits. Pairs already known are left out, so a diamond counts once, and a
    cycle ends. Each round writes its new pairs, and nothing is written twice.
    """
    steps = edges.select(F.col("child").alias("low"), F.col("parent").alias("high")).where("low <> high").distinct()
    every = terms.select("term_id").union(steps.select("low")).union(steps.select("high")).distinct()
    rounds, steps = [cut_lineage(every.select("term_id", F.col("term_id").alias("ancestor_id")))], cut_lineage(steps)
    while True:
        known = reduce(DataFrame.unionByName, rounds)
        reached = steps.select(F.col("low").alias("from"), F.col("high").alias("term_id")).join(known, "term_id").select(F.col("from").alias("term_id"), "ancestor_id").distinct()
        new = cut_lineage(reached.join(known, ["term_id", "ancestor_id"], "left_anti"))
        if new.isEmpty():
            return known.join(terms.select("term_id").distinct(), "term_id", "left_semi")
        rounds.append(new)
        steps = cut_lineage(_twice(steps))


def descendant_closure(closure: DataFrame) -> DataFrame:
    """term_id and descendant_id: the closure the other way round."""
    return closure.select(F.col("ancestor_id").alias("term_id"), F.col("term_id").alias("descendant_id"))


def _related(asked: DataFrame, closure: DataFrame, other: str, remove_root: bool, remove_self: bool) -> DataFrame:
    wanted = closure.join(asked.select("term_id").distinct(), "term_id", "left_semi")  # sets of the asked terms only
    lists = wanted.groupBy("term_id").agg(F.collect_set(other).alias("found"))
    found = F.coalesce("found", F.array("term_id"))
    gone = [F.lit(ROOT)] * remove_root + [F.col("term_id")] * remove_self
    if gone:
        found = F.array_except(found, F.array(*gone))
    return asked.select("term_id").join(lists, "term_id", "left").select("term_id", F.array_sort(found).alias(other.replace("_id", "s")))


def get_ancestors(asked: DataFrame, closure: DataFrame, remove_root: bool = False, remove_self: bool = False) -> DataFrame:
    """ancestors (a sorted array) of each asked term; an unknown term is its own only one."""
    return _related(asked, closure, "ancestor_id", remove_root, remove_self)


def get_descendants(asked: DataFrame, closure: DataFrame, remove_root: bool = False, remove_self: bool = False) -> DataFrame:
    """descendants (a sorted array) of each asked term; an unknown term is its own only one."""
    return _related(asked, descendant_closure(closure), "descendant_id", remove_root, remove_self)


def path_depths(edges: DataFrame, root: str = ROOT) -> DataFrame:
    """depth_short and depth_long of every term that the root reaches; a cycle that it reaches is an error.

    By doubling: a path of 2^k to 2^(k+1) - 1 edges is a shorter one and then just 2^k edges, whose ends are known by squaring.
    So a depth of n takes as many rounds as n has binary digits.
    """
    if root != ROOT:
        raise ValueError(f"depths are measured from {ROOT}")
    steps = cut_lineage(edges.select(F.col("child").alias("low"), F.col("parent").alias("high")).distinct())
    depths = cut_lineage(edges.sparkSession.createDataFrame([(root, 0, 0)], "term_id string, depth_short int, depth_long int"))
    nodes, length = steps.count() + 1, 1  # no more terms than that hang together
    while True:
        further = steps.select(F.col("high").alias("term_id"), "low").join(depths, "term_id").select(F.col("low").alias("term_id"), *(F.col(c) + F.lit(length) for c in ("depth_short", "depth_long"))).toDF("term_id", "depth_short", "depth_long")
        further = cut_lineage(further.groupBy("term_id").agg(F.min("depth_short").alias("depth_short"), F.max("depth_long").alias("depth_long")))
        if further.isEmpty():
            return depths
        if length > nodes:
            raise ValueError(f"a path is longer than {nodes}: the graph has a cycle")
        depths = cut_lineage(depths.unionByName(further).groupBy("term_id").agg(F.min("depth_short").alias("depth_short"), F.max("depth_long").alias("depth_long")))
        steps, length = cut_lineage(_twice(steps)), 2 * length


def parse_ranked_labels(wide: DataFrame, terms: DataFrame, cell: str = "cell_id") -> DataFrame:
    """cell, rank, term_id and score for each rank's label that is a term; a null score counts as 0."""
    ranks = sorted(int(m[1]) for c in wide.columns if (m := re.fullmatch(r"cas_cell_type_name_(\d+)", c)))
    if not ranks:
        raise ValueError("no column cas_cell_type_name_<rank>")
    each = F.array(*(F.struct(F.lit(r).alias("rank"), F.col(f"cas_cell_type_name_{r}").alias("term_id"), F.coalesce(F.col(f"cas_cell_type_score_{r}"), F.lit(0.0)).alias("score")) for r in ranks))
    return wide.select(cell, F.inline(each)).join(terms.select("term_id"), "term_id", "left_semi").select(cell, "rank", "term_id", "score")


def linearity_violations(ranked: DataFrame, closure: DataFrame, cell: str = "cell_id") -> DataFrame:
    """Distinct pairs of neighbouring ranks where the coarser term is no ancestor of the finer."""
    coarser = F.lead("term_id").over(Window.partitionBy(cell).orderBy("rank"))
    pairs = ranked.select(F.col("term_id").alias("finer"), coarser.alias("coarser")).where(F.col("coarser").isNotNull()).distinct()
    known = closure.select(F.col("term_id").alias("finer"), F.col("ancestor_id").alias("coarser"))
    return pairs.join(known, ["finer", "coarser"], "left_anti")


def propagate_scores_max(ranked: DataFrame, closure: DataFrame, cell: str = "cell_id") -> DataFrame:
    """cell, term_id and score: each ranked term gives its score to itself and its ancestors; the largest counts, at least 0."""
    given = ranked.join(closure, "term_id").select(cell, F.col("ancestor_id").alias("term_id"), "score")
    return given.groupBy(cell, "term_id").agg(F.greatest(F.max("score"), F.lit(0.0)).alias("score"))


class OntologyResponse(NamedTuple):
    """response, a row a cell; report, with kind (unknown or nonlinear), value and coarser: what a user should look at."""

    response: DataFrame
    report: DataFrame


def unknown_ids(wide: DataFrame, terms: DataFrame) -> DataFrame:
    """value: distinct ids of the ranked columns that are no term."""
    names = [c for c in wide.columns if re.fullmatch(r"cas_cell_type_name_\d+", c)]
    each = wide.select(F.explode(F.array(*(F.col(c) for c in names))).alias("term_id")).where(F.col("term_id").isNotNull()).distinct()
    return each.join(terms.select("term_id"), "term_id", "left_anti").select(F.col("term_id").alias("value"))


def build_ontology_response(wide: DataFrame, terms: DataFrame, closure: DataFrame, reference: str, cell: str = "cell_id") -> OntologyResponse:
    """The response (matches by term, with score, term and label; total_weight, total_neighbors, total_neighbors_unrecognized, model_name) and its report.

    The report names ids that are no term, and pairs of neighbouring ranks whose coarser term is no ancestor of the finer one.
    """
    ranked = parse_ranked_labels(wide, terms, cell)
    first = ranked.groupBy(cell).agg(F.min_by("score", "rank").alias("total_weight"))
    scored = propagate_scores_max(ranked, closure, cell).join(small_enough(terms.select("term_id", "label")), "term_id")
    match = F.struct("score", F.col("term_id").alias("cell_type_ontology_term_id"), F.col("label").alias("cell_type"))
    lists = scored.groupBy(cell).agg(F.array_sort(F.collect_list(match), _by_term).alias("matches"))
    empty = F.array().cast(lists.schema["matches"].dataType)
    response = (
        wide.select(cell).join(first, cell, "left").join(lists, cell, "left")
        .select(cell, F.coalesce("matches", empty).alias("matches"), F.coalesce("total_weight", F.lit(0.0)).alias("total_weight"), F.lit(1).alias("total_neighbors"), F.lit(0).alias("total_neighbors_unrecognized"), F.lit(f"azimuth_{reference}").alias("model_name"))
    )
    unknown = unknown_ids(wide, terms).select(F.lit("unknown").alias("kind"), "value", F.lit(None).cast("string").alias("coarser"))
    nonlinear = linearity_violations(ranked, closure, cell).select(F.lit("nonlinear").alias("kind"), F.col("finer").alias("value"), "coarser")
    return OntologyResponse(response, unknown.unionByName(nonlinear))


def _by_term(a: Column, b: Column) -> Column:
    x, y = a["cell_type_ontology_term_id"], b["cell_type_ontology_term_id"]
    return F.when(x < y, -1).when(x > y, 1).otherwise(0)
