"""Whole runs: embeddings, or third-party predictions, to the files that a benchmark reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscore import sources as io
from cellscore.operators import crosswalk as cw
from cellscore.operators import neighbors as nb
from cellscore.operators import preprocess as pp
from cellscore.operators import scores as sc
from cellscore.plans import cut_lineage

FILES = {"response": "ontology_response.json", "resource": "ontology_resource.json", "labels": "inferred_labels.csv", "metadata": "metadata.json", "scores": "scores.parquet", "counts": "counts.parquet"}


def _paths(folder: str) -> dict[str, str]:
    return {name: f"{folder}/{file}" for name, file in FILES.items()}


def response_lists(scored: DataFrame) -> DataFrame:
    """query_cell_id, matches (by term) and totals, a row a cell, from scores by cell and term."""
    match = F.struct("score", F.col("term_id").alias("cell_type_ontology_term_id"), F.col("label").alias("cell_type"))
    totals = [F.col("total_weight"), *(F.col(c).cast("int").alias(c) for c in ("total_neighbors", "total_neighbors_unrecognized"))]
    return scored.groupBy(F.col("cell_id").cast("string").alias("query_cell_id"), *totals).agg(F.array_sort(F.collect_list(match)).alias("matches"))


def annotate(
    folder: str, cells: DataFrame, references: DataFrame, terms: DataFrame, closure: DataFrame, edges: DataFrame, *, known: DataFrame | None = None, input_path: str = "", model_name: str = "knn",
    resource_name: str = "ontology", k: int = 10, min_acceptable_score: float = 0.2, top_k: int = 3, cluster: str | None = None, infer_labels: bool = True,
    matrix: tuple[DataFrame, DataFrame] | None = None, feature_schema: DataFrame | None = None, layer: str = "X", overwrite: bool = False,
) -> dict[str, str]:
    """Write the run of cells (cell_id, pos, embedding and, if named, the cluster column) below folder; gives the paths of its files.

    With a matrix (counts and features of the cells) and the features that the model takes, the counts are validated and conformed
    first, and written with the cells' totals. Then neighbours, ontology-aware scores, the response aligned to the cells (one without a result has an empty list), the score matrix with
    labels, the most granular labels of cells and clusters, and the run's metadata. known is the terms that the scores recognise, all by default.
    Each later step reads what the response file holds. The metadata come last, so a folder that has them is whole. With overwrite a run is written again.
    """
    spark, paths = cells.sparkSession, _paths(folder)
    if (matrix is None) != (feature_schema is None):
        raise ValueError("a matrix and a feature schema come together")
    if matrix is not None:
        io.write_counts(paths["counts"], *pp.validate_and_sanitize(matrix[0], cells.select("cell_id", "pos"), matrix[1], feature_schema, layer), overwrite)
    else:
        del paths["counts"]
    types = references.select("cas_cell_index", "cell_type")
    near = nb.knn_search(cells, references, k).join(types, "cas_cell_index")
    scored = response_lists(nb.ontology_aware_scores(near, known if known is not None else terms, closure))
    answered = scored.select(F.col("query_cell_id").alias("cell_id"), "matches", F.lit(0).alias("batch"))
    named = cells.select(F.col("cell_id").cast("string").alias("cell_id"), "pos")
    aligned = nb.align_results_to_query(named, answered, "batch").drop("unprocessed").withColumnRenamed("cell_id", "query_cell_id")
    totals = scored.drop("matches")
    zero = lambda c, kind: F.coalesce(c, F.lit(0).cast(kind)).alias(c)
    response = aligned.join(totals, "query_cell_id", "left").select("query_cell_id", "matches", zero("total_weight", "double"), zero("total_neighbors", "int"), zero("total_neighbors_unrecognized", "int"))
    io.write_ontology_response(paths["response"], response, overwrite)
    io.write_ontology_resource(paths["resource"], terms, edges, overwrite=overwrite)

    back = io.read_ontology_response(spark, paths["response"]).select(F.col("query_cell_id").cast(cells.schema["cell_id"].dataType).alias("cell_id"), F.inline("matches"))
    matrix = sc.score_matrix(back.select("cell_id", F.col("cell_type_ontology_term_id").alias("term_id"), "score"), terms)
    sc.attach_scores(matrix, terms, resource_name).write.mode("overwrite" if overwrite else "error").parquet(paths["scores"])
    if infer_labels:
        stored = spark.read.parquet(paths["scores"])
        single = sc.top_k_calls_single(stored, cells, terms, min_acceptable_score, top_k)
        grouped = sc.top_k_calls_cluster(stored, cells, terms, min_acceptable_score, cluster, top_k=top_k) if cluster else None
        io.write_inferred_labels(paths["labels"], sc.inferred_labels(single, grouped), overwrite)
    io.write_run_metadata(paths["metadata"], cells.agg(F.lit(input_path).alias("input_path"), F.lit(model_name).alias("model_name"), F.count("*").alias("n_cells"), F.lit(resource_name).alias("ontology_resource_name")), overwrite)
    return paths if infer_labels else {n: p for n, p in paths.items() if n != "labels"}


def crosswalk_run(
    folder: str, cells: DataFrame, predictions: DataFrame, crosswalk: DataFrame, terms: DataFrame, closure: DataFrame, edges: DataFrame, reference: str,
    input_path: str = "", resource_name: str = "ontology", overwrite: bool = False,
) -> dict[str, str]:
    """Write the four files of a run from third-party predictions, and a report of what did not fit; gives their paths. The metadata come last."""
    paths = {n: p for n, p in _paths(folder).items() if n not in ("scores", "counts")} | {"report": f"{folder}/report.json"}
    spark = cells.sparkSession
    aligned = cw.watch_predictions(cells, predictions)
    wide = cut_lineage(cw.crosswalk_wide(aligned.frame.drop("pos"), crosswalk))  # a cell without a prediction ends the run before a file is there
    aligned.verify()
    io.write_inferred_labels(paths["labels"], wide, overwrite)
    found = cw.build_ontology_response(io.read_inferred_labels(spark, paths["labels"]), terms, closure, reference)
    io.write_ontology_response(paths["response"], found.response.withColumnRenamed("cell_id", "query_cell_id"), overwrite)
    found.report.write.mode("overwrite" if overwrite else "error").json(paths["report"])
    io.write_ontology_resource(paths["resource"], terms, edges, overwrite=overwrite)
    metadata = cw.crosswalk_metadata(predictions.join(cells.select("cell_id"), "cell_id", "left_semi"), reference)
    io.write_run_metadata(paths["metadata"], metadata.select(F.lit(input_path).alias("input_path"), "model_name", "n_cells", F.lit(resource_name).alias("ontology_resource_name")), overwrite)
    return paths
