"""Third-party predictions to ranked ontology labels, by a crosswalk table.

predictions has cell_id and columns predicted.<level> and predicted.<level>.score;
crosswalk has source_label, term_id, term_label and, for repeated labels, ord (the last counts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscore.operators.ontology import OntologyResponse, build_ontology_response
from cellscore.plans import Guard, small_enough

UNKNOWN = "unknown"
PREFIX, SUFFIX = "predicted.", ".score"


def align_predictions(cells: DataFrame, predictions: DataFrame) -> DataFrame:
    """cells (cell_id, pos) with their predictions; predictions of other cells are left out. A cell without one is an error that names up to five; runs one small job."""
    if text := _absent(cells, predictions):
        raise ValueError(text)
    return cells.select("cell_id", "pos").join(predictions, "cell_id")


def _absent(cells: DataFrame, predictions: DataFrame) -> str:
    absent = [r[0] for r in cells.join(predictions, "cell_id", "left_anti").select("cell_id").orderBy("cell_id").limit(5).collect()]
    return f"no prediction for cells such as {', '.join(map(str, absent))}" if absent else ""


def watch_predictions(cells: DataFrame, predictions: DataFrame) -> Guard:
    """align_predictions with its guard in the same pass: verify, after an action, gives its error."""
    there = predictions.withColumn("_there", F.lit(True))
    guard = Guard(cells.select("cell_id", "pos").join(there, "cell_id", "left"), F.col("_there").isNull(), lambda: _absent(cells, predictions))
    guard.frame = guard.frame.drop("_there")
    return guard


def infer_level_specs(columns: list[str]) -> list[tuple[str, str]]:
    """(label column, score column) of each level, the last column first (the finest)."""
    labels = [c for c in columns if c.startswith(PREFIX) and not c.endswith(SUFFIX)]
    lone = [c for c in labels if c + SUFFIX not in columns]
    if not labels or lone:
        raise ValueError(f"no score column for {', '.join(lone)}" if lone else f"no column {PREFIX}<level>")
    return [(c, c + SUFFIX) for c in reversed(labels)]


def _table(crosswalk: DataFrame) -> DataFrame:
    order = "ord" if "ord" in crosswalk.columns else "source_label"
    label = F.col("term_label") if "term_label" in crosswalk.columns else F.col("source_label")
    return crosswalk.groupBy("source_label").agg(F.max_by(F.struct("term_id", label.alias("term_label")), order).alias("x")).select("source_label", "x.*")


def long_levels(predictions: DataFrame, levels: list[tuple[str, str]]) -> DataFrame:
    """cell_id, rank (1 is the finest), source_label and score for each level."""
    each = F.array(*(F.struct(F.lit(i + 1).alias("rank"), F.col(f"`{label}`").alias("source_label"), F.col(f"`{score}`").cast("double").alias("score")) for i, (label, score) in enumerate(levels)))
    return predictions.select("cell_id", F.inline(each))


def crosswalk_labels(labels: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """labels with term_id and term_label of source_label: null stays null, an unmapped one is unknown."""
    joined = labels.join(small_enough(_table(crosswalk)), "source_label", "left")
    mapped = lambda c: F.when(F.col("source_label").isNotNull(), F.coalesce(c, F.lit(UNKNOWN)))
    return joined.withColumns({"term_id": mapped(F.col("term_id")), "term_label": mapped(F.col("term_label"))})


def crosswalk_wide(predictions: DataFrame, crosswalk: DataFrame, prefix: str = "cas_cell_type") -> DataFrame:
    """cell_id and label, name and score columns by rank: all labels, then names, then scores."""
    levels = infer_level_specs(predictions.columns)
    mapped = crosswalk_labels(long_levels(predictions, levels), crosswalk)
    pick = lambda c, r: F.max(F.when(F.col("rank") == r, F.col(c)))
    columns = [pick(c, r).alias(f"{prefix}_{name}_{r}") for name, c in (("label", "term_label"), ("name", "term_id"), ("score", "score")) for r in range(1, len(levels) + 1)]
    return mapped.groupBy("cell_id").agg(*columns)


def crosswalk_metadata(predictions: DataFrame, reference: str) -> DataFrame:
    """One row: model_name and n_cells."""
    return predictions.agg(F.lit(f"azimuth_{reference}").alias("model_name"), F.count("*").alias("n_cells"))


def unmapped_label_report(labels: DataFrame, crosswalk: DataFrame, terms: DataFrame) -> DataFrame:
    """kind and value: distinct labels that the crosswalk lacks, and distinct term ids of it that the ontology lacks."""
    source = labels.where(F.col("source_label").isNotNull()).join(crosswalk, "source_label", "left_anti").select(F.lit("label").alias("kind"), F.col("source_label").alias("value")).distinct()
    term = crosswalk.join(terms, "term_id", "left_anti").select(F.lit("term").alias("kind"), F.col("term_id").alias("value")).distinct()
    return source.unionByName(term)


def crosswalk_pipeline(cells: DataFrame, predictions: DataFrame, crosswalk: DataFrame, terms: DataFrame, closure: DataFrame, reference: str) -> OntologyResponse:
    """The ontology response, and its report, of the aligned and mapped predictions; operators.runs writes them as a run."""
    wide = crosswalk_wide(align_predictions(cells, predictions).drop("pos"), crosswalk)
    return build_ontology_response(wide, terms, closure, reference)
