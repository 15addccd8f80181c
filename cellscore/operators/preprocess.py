"""Count matrices: choosing a layer, totals, and conforming to a feature schema.

counts is long: cell_id, feature_id, layer (X or raw.X) and value; a pair that is
absent is 0. cells has cell_id and pos, features feature_id and pos, schema
feature_id and pos (the order of the model's features).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscore.plans import small_enough

LAYERS = ("X", "raw.X")


def select_count_layer(counts: DataFrame, layer: str = "X") -> DataFrame:
    """The counts of one layer."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer}")
    return counts.where(F.col("layer") == layer).drop("layer")


def cast_counts_float32(counts: DataFrame, layer: str = "X") -> DataFrame:
    """counts with the values of one layer at single precision (the column holds both layers, so it stays double)."""
    narrow = F.col("value").cast("float").cast("double")
    return counts.withColumn("value", F.when(F.col("layer") == layer, narrow).otherwise(F.col("value").cast("double")))


def total_mrna_umis(counts: DataFrame, cells: DataFrame, layer: str = "X") -> DataFrame:
    """cells with total_mrna_umis, the sum over all input features; 0 for a cell without counts."""
    sums = select_count_layer(counts, layer).groupBy("cell_id").agg(F.sum(F.col("value").cast("double")).alias("s"))
    return cells.join(sums, "cell_id", "left").withColumn("total_mrna_umis", F.coalesce("s", F.lit(0.0))).drop("s")


def feature_ids(features: DataFrame, column: str = "feature_id") -> DataFrame:
    """features with feature_id taken from a named column; an unknown column is an error."""
    if column not in features.columns:
        raise ValueError(f"no column {column}; there are {', '.join(features.columns)}")
    return features.withColumn("feature_id", F.col(column))


Step = Callable[[DataFrame, DataFrame, str], tuple[DataFrame, DataFrame]]


def _to_float32(counts: DataFrame, cells: DataFrame, layer: str) -> tuple[DataFrame, DataFrame]:
    return cast_counts_float32(counts, layer), cells


def _with_totals(counts: DataFrame, cells: DataFrame, layer: str) -> tuple[DataFrame, DataFrame]:
    return counts, total_mrna_umis(counts, cells, layer)


#: What runs, in order, before counts are conformed.
PRE_SANITIZE: tuple[Step, ...] = (_to_float32, _with_totals)


def pre_sanitize(counts: DataFrame, cells: DataFrame, layer: str = "X", steps: Sequence[Step] = PRE_SANITIZE) -> tuple[DataFrame, DataFrame]:
    """counts and cells after each step in turn."""
    for step in steps:
        counts, cells = step(counts, cells, layer)
    return counts, cells


def validate_features(features: DataFrame, schema: DataFrame, layer: str = "X") -> DataFrame:
    """One row: conforms (same ids in the same order, layer X), missing and extra (distinct ids)."""
    ours, theirs = features.select("feature_id"), schema.select("feature_id")
    missing = theirs.join(ours, "feature_id", "left_anti").agg(F.count_distinct("feature_id").alias("missing"))
    extra = ours.join(theirs, "feature_id", "left_anti").agg(F.count_distinct("feature_id").alias("extra"))
    paired = features.select("pos", F.col("feature_id").alias("a")).join(schema.select("pos", F.col("feature_id").alias("b")), "pos", "full")
    order = paired.agg(F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("unlike"))
    both = missing.crossJoin(extra).crossJoin(order)  # three single rows
    return both.select(((F.col("unlike") == 0) & F.lit(layer == "X")).alias("conforms"), "missing", "extra")


def last_features(features: DataFrame) -> DataFrame:
    """features with one row an id: of ids that come twice, the last position."""
    return features.groupBy("feature_id").agg(F.max_by(F.struct(*features.columns), "pos").alias("x")).select("x.*")


def sanitize_counts(counts: DataFrame, features: DataFrame, schema: DataFrame) -> DataFrame:
    """cell_id, pos (in the schema), feature_id and value: the features of the schema that the data has.

    counts names a feature by its feature_id, or, where ids come twice, by feature_pos as well;
    then only the last position of an id counts.
    """
    kept = counts
    if "feature_pos" in counts.columns:
        last = last_features(features).select("feature_id", F.col("pos").alias("feature_pos"))
        kept = counts.join(last, ["feature_id", "feature_pos"], "left_semi")
    return kept.join(small_enough(schema.select("feature_id", "pos")), "feature_id").select("cell_id", "pos", "feature_id", "value")


def map_feature_names(features: DataFrame, schema: DataFrame, name: str = "feature_name") -> DataFrame:
    """pos, feature_id and feature_name of the schema's features, N/A where the data has none."""
    names = features.groupBy("feature_id").agg(F.max_by(name, "pos").alias("n"))
    return schema.join(names, "feature_id", "left").select("pos", "feature_id", F.coalesce("n", F.lit("N/A")).alias("feature_name"))


def sparse_rows(sanitized: DataFrame, cells: DataFrame, size: int) -> DataFrame:
    """cell_id, size, indices and values: a sparse row for every cell, empty ones included."""
    pairs = F.array_sort(F.collect_list(F.struct("pos", "value")))
    rows = sanitized.groupBy("cell_id").agg(pairs.alias("x"))
    joined = cells.select("cell_id").join(rows, "cell_id", "left")
    return joined.select("cell_id", F.lit(size).alias("size"), F.coalesce(F.col("x.pos"), F.array().cast("array<bigint>")).alias("indices"), F.coalesce(F.col("x.value"), F.array().cast("array<double>")).alias("values"))


def validate_and_sanitize(counts: DataFrame, cells: DataFrame, features: DataFrame, schema: DataFrame, layer: str = "X", column: str = "feature_id", name: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """counts, cells and features, conformed unless they are already. Runs one small job for the decision; inputs are not changed."""
    counts, cells = pre_sanitize(counts, cells, layer)
    features = feature_ids(features, column)
    if validate_features(features, schema, layer).first()["conforms"]:
        return select_count_layer(counts, layer), cells, features
    named = map_feature_names(features, schema, name) if name else schema
    return sanitize_counts(select_count_layer(counts, layer), features, schema), cells, named
