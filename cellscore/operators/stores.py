"""Stored states that later data are merged into, and stores that are read in part.

Score sketches: sums, counts and KLL quantile sketches by group and term. States of other cells are merged without the cells; aggregates
follow from a state, with medians whose rank is off by some share at most (see RANK_ERROR).

Term store: a score matrix clustered by buckets of terms, so that one term's scores are found without reading the others'.

Run store: confusion matrices by run, and their sums by group. A run that is put again replaces its former matrix, and only its group is added up again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscore.operators.scores import THRESHOLD, _selected
from cellscore.plans import cut_lineage, small_enough

#: Size of a sketch (its k), and the share of all ranks by which a quantile's rank is off, 99 times in 100 or more.
SKETCH_K, RANK_ERROR = 400, 0.0075
#: Ranks, in equal steps, at which a sketch is asked, as it takes constant ones only.
GRID = 1000
#: Buckets of terms of a score store, and parts of a bucket that are written by tasks of their own.
TERM_BUCKETS, PARTS = 64, 8
#: What tells one run from another, and its group.
RUN, GROUP = ("model_name", "test_sample"), "model_name"


def sketch_scores(scores: DataFrame, cells: DataFrame, threshold: float = THRESHOLD, by: str | None = None, k: int = SKETCH_K) -> DataFrame:
    """A state by grp and term_id: stored and above (counts of scores over 0 and over the threshold), sums of both, and a sketch of each; a line with
    a null term_id has the number of the group's cells. The selection is that of aggregate_scores."""
    stored, sizes = _selected(scores, cells, by)
    above = F.when(F.col("score") > threshold, F.col("score"))
    found = stored.groupBy("grp", "term_id").agg(
        F.lit(0).cast("long").alias("cells"), F.count("*").alias("stored"), F.count(above).alias("above"), F.sum("score").alias("sum"), F.coalesce(F.sum(above), F.lit(0.0)).alias("sum_over"),
        F.kll_sketch_agg_double("score", k).alias("sketch"), F.kll_sketch_agg_double(above, k).alias("sketch_over"),
    )
    return found.unionByName(sizes.select("grp", "cells"), allowMissingColumns=True)


def merged_sketches(states: DataFrame) -> DataFrame:
    """One state of several, of cells that no two of them share."""
    sums = [F.sum(c).alias(c) for c in ("cells", "stored", "above", "sum", "sum_over")]
    return states.groupBy("grp", "term_id").agg(*sums, *(F.kll_merge_agg_double(c).alias(c) for c in ("sketch", "sketch_over")))


def sketched_aggregates(state: DataFrame, terms: DataFrame) -> DataFrame:
    """The columns of aggregate_scores from a state: means and fraction exact, medians by the sketches."""
    sizes = state.where(F.col("term_id").isNull()).select("grp", F.col("cells").alias("size"))
    dense = sizes.crossJoin(small_enough(terms.select("term_id", "idx")))
    joined = dense.join(state.where(F.col("term_id").isNotNull()).drop("cells"), ["grp", "term_id"], "left")
    # the cells without a stored score come first
    place = (F.col("size") / 2 - (F.col("size") - F.col("stored"))) / F.col("stored")
    ranks = F.array(*(F.lit(i / GRID) for i in range(GRID + 1)))
    middle = F.element_at(F.kll_sketch_get_quantile_double("sketch", ranks), F.round(F.greatest(place, F.lit(0.0)) * GRID).cast("int") + 1)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return joined.select(
        "grp", "term_id", "idx",
        zero(F.col("sum") / F.col("size")).alias("mean_all"),
        zero(F.when(place > 0, middle)).alias("median_all"),
        zero(F.when(F.col("above") > 0, F.try_divide("sum_over", "above"))).alias("mean_over"),
        zero(F.when(F.col("above") > 0, F.kll_sketch_get_quantile_double("sketch_over", F.lit(0.5)))).alias("median_over"),
        zero(F.col("above") / F.col("size")).alias("fraction"),
    )


def _bucket(term, buckets: int):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_term_store(path: str, scores: DataFrame, buckets: int = TERM_BUCKETS, overwrite: bool = False) -> None:
    """A score matrix in folders by bucket of term_id, a file for each of PARTS parts of its cells: the root's scores are in no single task."""
    bucketed = scores.withColumn("term_bucket", _bucket("term_id", buckets)).repartition("term_bucket", F.pmod(F.xxhash64("cell_id"), F.lit(PARTS)))
    bucketed.sortWithinPartitions("term_bucket", "term_id", "cell_id").write.mode("overwrite" if overwrite else "error").partitionBy("term_bucket").parquet(path)


def term_scores(spark: SparkSession, path: str, term: str, buckets: int = TERM_BUCKETS) -> DataFrame:
    """One term's rows of a store; just its bucket's folder is read."""
    return spark.read.parquet(path).where((F.col("term_bucket") == _bucket(F.lit(term), buckets)) & (F.col("term_id") == term)).drop("term_bucket")


def put_runs(path: str, confusion: DataFrame, metadata: DataFrame) -> None:
    """Put runs (confusion: model_name, test_sample, k, true_label, pred_label, n; metadata: model_name, test_sample, label_order) in the store.

    A run that is there is replaced, with all its k; others stay. The sums of the groups of these runs, and of no others, are worked
    out again. Matrices are written first, then the manifest with the total of each run, which reading checks, then the sums. A label order unlike that of the group's
    other runs, or a run without metadata, is an error before anything is written (two small jobs).
    """
    spark = confusion.sparkSession
    confusion = cut_lineage(confusion.select(*RUN, "k", "true_label", "pred_label", "n"))
    runs = confusion.groupBy(*RUN).agg(F.sum("n").alias("total")).join(metadata.select(*RUN, "label_order").distinct(), list(RUN), "left")
    runs = cut_lineage(runs)
    there = _manifest(spark, path)
    kept = runs if there is None else runs.unionByName(there.join(runs.select(*RUN), list(RUN), "left_anti").join(runs.select(GROUP).distinct(), GROUP, "left_semi"))
    wrong = kept.groupBy(GROUP).agg(F.count_distinct("label_order").alias("orders"), F.count_if(F.col("label_order").isNull()).alias("lone"), F.count("*").alias("n"), F.count_distinct("test_sample").alias("samples"))
    if bad := wrong.where("orders <> 1 or lone > 0 or n <> samples").limit(5).collect():
        raise ValueError(f"runs without one label order in {', '.join(str(r[GROUP]) for r in bad)}")

    def replace(df: DataFrame, name: str, keys: tuple[str, ...]) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(f"{path}/{name}")

    replace(confusion.repartition(*RUN), "matrix", RUN)
    replace(runs.select(*RUN, "total", "label_order").coalesce(1), "manifest", RUN)  # a row a run
    touched = runs.select(GROUP).distinct().collect()
    stored, _ = read_runs(spark, path, [r[GROUP] for r in touched])
    replace(stored.groupBy(GROUP, "k", "true_label", "pred_label").agg(F.sum("n").alias("n")).repartition(GROUP), "groups", (GROUP,))


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """The manifest of a store, or None where there is no store yet."""
    from pyspark.errors import AnalysisException

    schema = "total long, label_order array<string>, model_name string, test_sample string"
    try:
        return spark.read.schema(schema).parquet(f"{path}/manifest").select(*RUN, "total", "label_order")
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_runs(spark: SparkSession, path: str, groups: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Matrices and manifest of a store, of some groups if named, of which no others are read. A matrix whose total is not the manifest's is an error (one small job)."""
    schema = "k int, true_label string, pred_label string, n long, model_name string, test_sample string"
    matrix, manifest = spark.read.schema(schema).parquet(f"{path}/matrix"), _manifest(spark, path)
    if groups is not None:
        matrix, manifest = matrix.where(F.col(GROUP).isin(groups)), manifest.where(F.col(GROUP).isin(groups))
    totals = matrix.groupBy(*RUN).agg(F.sum("n").alias("found")).join(manifest, list(RUN), "full")
    if bad := totals.where(~F.col("found").eqNullSafe(F.col("total"))).limit(5).collect():
        raise ValueError(f"not written to the end: {', '.join(str(tuple(r[c] for c in RUN)) for r in bad)}")
    return matrix.select(*RUN, "k", "true_label", "pred_label", "n"), manifest


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """model_name, k, true_label, pred_label and n: the sums of all groups."""
    schema = "k int, true_label string, pred_label string, n long, model_name string"
    return spark.read.schema(schema).parquet(f"{path}/groups").select(GROUP, "k", "true_label", "pred_label", "n")
