"""A query for each operator: name -> (spark, sf_dir) -> DataFrame over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscore import fixtures as fx
from cellscore import sources as io
from cellscore.operators import connectivities as cn
from cellscore.operators import crosswalk as cw
from cellscore.operators import metrics as mt
from cellscore.operators import neighbors as nb
from cellscore.operators import ontology as on
from cellscore.operators import preprocess as pp
from cellscore.operators import reducers as rd
from cellscore.operators import runs
from cellscore.operators import scores as sc
from cellscore.operators import stores as st
from cellscore.operators import term_sets as ts
from cellscore.plans import numbered_within
from cellscore.plans.lineage import checkpoint_folder


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """df with doubles rounded, so that sums in another order compare equal."""
    names = columns or [f.name for f in df.schema if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in names})


def _scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def _joined(c: str) -> Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


def knn_search(spark, d):
    return _rounded(nb.knn_search(fx.query_cells(spark, d), fx.reference_cells(spark, d)))


def knn_search_approx(spark, d):
    return _rounded(nb.knn_search_approx(fx.query_cells(spark, d), fx.reference_cells(spark, d)))


def neighbor_summary_stats(spark, d):
    return _rounded(nb.neighbor_summary_stats(fx.neighbors(spark, d)))


def neighbor_dataset_stats(spark, d):
    return _rounded(nb.neighbor_dataset_stats(fx.neighbors(spark, d)))


def ontology_aware_scores(spark, d):
    return _rounded(fx.scores(spark, d))


def align_results_to_query(spark, d):
    """Cells of every third id get no result, those of an even id an empty one in an earlier batch."""
    found = nb.summary_response(fx.neighbors(spark, d)).withColumn("batch", F.lit(1))
    earlier = found.where("cell_id % 2 = 0").withColumns({"batch": F.lit(0), "matches": F.slice("matches", 1, 0)})
    response = found.where("cell_id % 3 <> 0").unionByName(earlier)
    return nb.align_results_to_query(fx.query_cells(spark, d).select("cell_id", "pos"), response, "batch").select("cell_id", "pos", F.size("matches").alias("n_matches"), "unprocessed")


def query_cells_by_ids(spark, d):
    ids = fx.table(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("cas_cell_index"))
    return nb.query_cells_by_ids(fx.cell_metadata(spark, d), ids, ["tissue", "disease"])


def query_store_by_ids(spark, d):
    """As query_cells_by_ids, of the 50 dearest orders, from a store in the order of ids."""
    path = _scratch(spark, "references")
    nb.write_reference_store(path, fx.cell_metadata(spark, d))
    ids = fx.table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50).select(F.col("o_custkey").alias("cas_cell_index"))
    return nb.query_store_by_ids(spark.read.parquet(path), ids, ["tissue", "disease"])


def drop_null_fields(spark, d):
    fields = nb.drop_null_fields(fx.cell_metadata(spark, d))
    get = lambda name, kind: F.variant_get("fields", f"$.{name}", kind).alias(name)
    names = F.array_join(F.array_sort(F.json_object_keys(F.to_json("fields"))), ";").alias("names")
    return fields.select("cas_cell_index", names, get("tissue", "string"), get("donor_id", "string"), get("disease", "string"), get("total_mrna_umis", "bigint"))


def majority_vote(spark, d):
    return _rounded(rd.majority_vote(fx.query_cells(spark, d), fx.matches(spark, d)))


def min_distance_vote(spark, d):
    return _rounded(rd.min_distance_vote(fx.query_cells(spark, d), fx.matches(spark, d)))


def cluster_majority_vote(spark, d):
    return _rounded(rd.cluster_majority_vote(fx.matches(spark, d), fx.query_cells(spark, d), ("T0",)))


def cluster_vote_detail(spark, d):
    return _rounded(rd.cluster_vote_detail(fx.matches(spark, d), fx.query_cells(spark, d), ("T0",)))


def wnn_weights(spark, d):
    return _rounded(rd.wnn_weights(fx.knn_graph(spark, d), fx.query_cells(spark, d)))


def _fuzzy_graph(spark, d):
    cells = fx.query_cells(spark, d)
    near = nb.knn_search(cells, cells.select(F.col("cell_id").alias("cas_cell_index"), "embedding"), 9, exclude_self=True)
    return cn.fuzzy_connectivities(near.select(F.col("cell_id").alias("i"), F.col("cas_cell_index").alias("j"), "distance"), 10)


def fuzzy_connectivities(spark, d):
    return _rounded(_fuzzy_graph(spark, d))


def fuzzy_wnn_vote(spark, d):
    """R7 over the fuzzy graph."""
    voted, _ = rd.wnn(fx.query_cells(spark, d), nb.summary_response(fx.neighbors(spark, d)), _fuzzy_graph(spark, d), 10, min_n_cells_per_type=0)
    return _rounded(voted)


def cell_type_probs(spark, d):
    return _rounded(rd.cell_type_probs(fx.matches(spark, d)))


def _wnn_probs(spark, d):
    return rd.wnn_probs(rd.wnn_weights(fx.knn_graph(spark, d), fx.query_cells(spark, d)), rd.cell_type_probs(fx.matches(spark, d)))


def wnn_vote(spark, d):
    """All votes before rare types are renamed."""
    voted, _ = rd.wnn(fx.query_cells(spark, d), nb.summary_response(fx.neighbors(spark, d)), fx.knn_graph(spark, d), 10, min_n_cells_per_type=0)
    return _rounded(voted)


def relabel_rare_types(spark, d):
    return _rounded(rd.relabel_rare_types(rd.wnn_vote(_wnn_probs(spark, d))))


def interpolate_type_colors(spark, d):
    return _rounded(rd.interpolate_type_colors(_wnn_probs(spark, d), fx.colors(spark)))


def parents_map(spark, d):
    return on.parents_map(fx.market_edges(spark, d))


def ancestor_closure(spark, d):
    return fx.market_closure(spark, d)


def descendant_closure(spark, d):
    return on.descendant_closure(fx.market_closure(spark, d))


def _asked(spark, d, **columns):
    parts = [fx.table(spark, d, t).select(F.concat(F.lit(letter), F.col(c).cast("string")).alias("term_id")) for letter, (t, c) in columns.items()]
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    return every.distinct()


def get_ancestors(spark, d):
    asked = _asked(spark, d, C=("orders", "o_custkey"), X=("supplier", "s_suppkey"))
    return on.get_ancestors(asked, fx.market_closure(spark, d), remove_root=True, remove_self=True).select("term_id", _joined("ancestors").alias("ancestors"))


def get_descendants(spark, d):
    asked = _asked(spark, d, N=("supplier", "s_nationkey"), R=("region", "r_regionkey"), Y=("supplier", "s_suppkey"))
    return on.get_descendants(asked, fx.market_closure(spark, d)).select("term_id", _joined("descendants").alias("descendants"))


def descendant_pages(spark, d):
    """O5 by pages: the number of descendants of each asked term on each page."""
    asked = _asked(spark, d, N=("supplier", "s_nationkey"), R=("region", "r_regionkey"), Y=("supplier", "s_suppkey"))
    closure = fx.market_closure(spark, d)
    paged = ts.asked_pages(asked, on.descendant_closure(closure), ts.term_places(closure), "descendant_id")
    return paged.select("term_id", "page", F.bitmap_count("bits").alias("n"))


def path_depths(spark, d):
    return on.path_depths(fx.market_edges(spark, d))


def _wide_azimuth(spark, d):
    return cw.crosswalk_wide(fx.azimuth(spark, d), fx.crosswalk(spark, d))


def _ranked_azimuth(spark, d):
    return on.parse_ranked_labels(_wide_azimuth(spark, d), fx.terms(spark))


def linearity_violations(spark, d):
    return on.linearity_violations(_ranked_azimuth(spark, d), fx.closure(spark))


def propagate_scores_max(spark, d):
    return _rounded(on.propagate_scores_max(_ranked_azimuth(spark, d), fx.closure(spark)))


def parse_ranked_labels(spark, d):
    return _rounded(_ranked_azimuth(spark, d))


def _long_response(response: DataFrame) -> DataFrame:
    each = response.select("cell_id", F.explode_outer("matches").alias("m"), "total_weight", "total_neighbors", "total_neighbors_unrecognized", "model_name")
    return _rounded(each.select("cell_id", F.col("m.cell_type_ontology_term_id").alias("term_id"), F.col("m.cell_type").alias("label"), F.col("m.score").alias("score"), "total_weight", "total_neighbors", "total_neighbors_unrecognized", "model_name"))


def build_ontology_response(spark, d):
    return _long_response(on.build_ontology_response(_wide_azimuth(spark, d), fx.terms(spark), fx.closure(spark), "market").response)


def score_matrix(spark, d):
    once = fx.scores(spark, d).select("cell_id", "term_id", "score")
    return _rounded(sc.score_matrix(once.union(once.where("cell_id % 2 = 0")), fx.terms(spark)))


def _matrix(spark, d):
    return sc.score_matrix(fx.scores(spark, d).select("cell_id", "term_id", "score"), fx.terms(spark))


def attach_scores(spark, d):
    return _rounded(sc.attach_scores(_matrix(spark, d), fx.terms(spark), "market"))


def _aggregated(spark, d, by=None):
    return sc.aggregate_scores(_matrix(spark, d), fx.query_cells(spark, d), fx.terms(spark), by=by)


def fraction_over_threshold(spark, d):
    return _rounded(sc.fraction_over_threshold(_matrix(spark, d), fx.query_cells(spark, d), fx.terms(spark)).select("term_id", "fraction"))


def aggregate_scores(spark, d):
    return _rounded(_aggregated(spark, d))


def aggregate_scores_by_cluster(spark, d):
    return _rounded(_aggregated(spark, d, "cluster"))


def sketched_aggregates(spark, d):
    """A4 by sketches: the state of one half of the cells, merged with that of the other."""
    matrix, cells = _matrix(spark, d), fx.query_cells(spark, d)
    states = [st.sketch_scores(matrix, cells.where(f"cell_id % 2 = {half}")) for half in (0, 1)]
    return _rounded(st.sketched_aggregates(st.merged_sketches(states[0].unionByName(states[1])), fx.terms(spark)))


def most_granular_top_k(spark, d):
    summed = _aggregated(spark, d, "cluster")
    return _rounded(sc.most_granular_top_k(summed.select("grp", "term_id", F.col("mean_over").alias("score")), fx.terms(spark), summed, 0.3, 5, shortest=False))


def top_k_calls_single(spark, d):
    return _rounded(sc.top_k_calls_single(_matrix(spark, d), fx.query_cells(spark, d), fx.terms(spark), 0.2))


def rooted_score_tree(spark, d):
    summed = _aggregated(spark, d).select("term_id", F.col("mean_over").alias("score"), "fraction")
    tree = _rounded(sc.rooted_score_tree(summed, fx.edges(spark), min_fraction=0.01))
    return tree.withColumns({"path": F.array_join("path", "/"), "ord": _joined("ord")})


def top_k_calls_cluster(spark, d):
    return _rounded(sc.top_k_calls_cluster(_matrix(spark, d), fx.query_cells(spark, d), fx.terms(spark), 0.2))


def term_score_opacity(spark, d):
    return _rounded(sc.term_score_opacity(_matrix(spark, d), fx.query_cells(spark, d), "M1"))


def term_opacity_from_store(spark, d):
    path = _scratch(spark, "terms")
    st.write_term_store(path, _matrix(spark, d))
    return _rounded(sc.term_score_opacity(st.term_scores(spark, path, "M1"), fx.query_cells(spark, d), "M1"))


def padded_bounds(spark, d):
    points = fx.table(spark, d, "embeddings").select(F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return _rounded(sc.padded_bounds(points))


def _labels(spark, d):
    matrix, cells, terms = _matrix(spark, d), fx.query_cells(spark, d), fx.terms(spark)
    return sc.inferred_labels(sc.top_k_calls_single(matrix, cells, terms, 0.2), sc.top_k_calls_cluster(matrix, cells, terms, 0.2))


def inferred_labels(spark, d):
    return _rounded(_labels(spark, d))


def annotate_pipeline(spark, d):
    """Embeddings and counts to labels, with the sinks of a run; the labels come from the files."""
    cells, terms = fx.query_cells(spark, d), fx.terms(spark)
    counts = fx.counts(spark, d).join(cells.select("cell_id"), "cell_id", "left_semi")
    paths = runs.annotate(
        _scratch(spark, "annotate"), cells, fx.reference_cells(spark, d), terms, fx.closure(spark), fx.edges(spark),
        known=terms.where("term_id <> 'T9'"), input_path=d, resource_name="labels", cluster="cluster", matrix=(counts, fx.features(spark, d)), feature_schema=fx.feature_schema(spark, d), layer="raw.X",
    )
    back = io.read_inferred_labels(spark, paths["labels"])
    return _rounded(back.withColumn("cell_id", F.col("cell_id").cast("long")))


def align_predictions(spark, d):
    """Every second customer is a cell: predictions of the others are the extra rows that are left out."""
    cells = fx.table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("cell_id"), F.col("c_custkey").alias("pos"))
    return _plain_levels(cw.align_predictions(cells, fx.azimuth(spark, d)), "pos")


def _plain_levels(df: DataFrame, *more: str) -> DataFrame:
    return df.select("cell_id", *more, F.col("`predicted.l1`").alias("l1"), F.col("`predicted.l2`").alias("l2"), F.round("`predicted.l1.score`", 6).alias("s1"), F.round("`predicted.l2.score`", 6).alias("s2"))


def _long_azimuth(spark, d):
    predictions = fx.azimuth(spark, d)
    return cw.long_levels(predictions, cw.infer_level_specs(predictions.columns))


def crosswalk_labels(spark, d):
    return _rounded(cw.crosswalk_labels(_long_azimuth(spark, d), fx.crosswalk(spark, d)))


def crosswalk_wide(spark, d):
    return _rounded(_wide_azimuth(spark, d))


def unmapped_label_report(spark, d):
    return cw.unmapped_label_report(_long_azimuth(spark, d), fx.crosswalk(spark, d), fx.terms(spark))


def crosswalk_pipeline(spark, d):
    cells = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("cell_id"), F.col("c_custkey").alias("pos"))
    paths = runs.crosswalk_run(_scratch(spark, "crosswalk"), cells, fx.azimuth(spark, d), fx.crosswalk(spark, d), fx.terms(spark), fx.closure(spark), fx.edges(spark), "market")
    response = io.read_ontology_response(spark, paths["response"]).withColumn("cell_id", F.col("query_cell_id").cast("long"))
    return _long_response(response.crossJoin(io.read_run_metadata(spark, paths["metadata"]).select("model_name")))  # one row of metadata


RUN, GROUP = ["model_name", "test_sample"], ["model_name", "k"]


def labels_outside_universe(spark, d):
    universe = fx.terms(spark).where("term_id not in ('T8', 'T9')").select(F.col("term_id").alias("label"))
    return mt.labels_outside_universe(fx.predictions(spark, d).withColumnRenamed("name_1", "pred_label"), universe)


def confusion_matrix(spark, d):
    return mt.confusion_matrix(fx.predictions(spark, d).withColumnRenamed("name_1", "pred_label"), RUN, fx.universe(spark))


def top_k_hit_predictions(spark, d):
    hits = mt.top_k_hit_predictions(fx.predictions(spark, d), ["name_1", "name_2", "name_3"], 3)
    return mt.confusion_matrix(hits, [*RUN, "k"])


def join_truth_predictions(spark, d):
    return mt.join_truth_predictions(fx.truth(spark, d), fx.ranked_labels(spark, d))


def aggregate_confusion(spark, d):
    matrices = fx.confusion(spark, d)
    metadata = mt.confusion_metadata(matrices, fx.universe(spark), [*RUN, "k"])
    return mt.aggregate_confusion(matrices, GROUP, metadata).join(mt.aggregate_metadata(metadata, GROUP).select(*GROUP, "n_samples_aggregated"), GROUP)


def aggregate_confusion_custom(spark, d):
    return mt.aggregate_confusion_custom(fx.confusion(spark, d), [["model_name", "k"], ["test_sample", "k"], ["k"]])


def f_measure(spark, d):
    return _rounded(mt.f_measure(fx.confusion(spark, d), GROUP), digits=9)


def hierarchical_counts(spark, d):
    return mt.hierarchical_counts(fx.confusion(spark, d), fx.closure(spark), GROUP)


def pair_overlaps(spark, d):
    """The hits and misses of B10 over all nodes, from overlaps of the ancestor sets of each pair of labels."""
    confusion, closure = fx.confusion(spark, d), fx.closure(spark).where(F.col("ancestor_id") != on.ROOT)
    paged = ts.pages(closure, ts.term_places(fx.terms(spark)), "term_id", "ancestor_id")
    both = ts.pair_overlaps(confusion.select(F.col("true_label").alias("a"), F.col("pred_label").alias("b")), paged)
    joined = confusion.join(both, (F.col("true_label") == F.col("a")) & (F.col("pred_label") == F.col("b")))
    times = lambda c, name: F.sum(F.col("n") * F.col(c)).alias(name)
    return joined.groupBy(*GROUP).agg(times("n_both", "tp"), times("n_only_b", "fp"), times("n_only_a", "fn"))


def hierarchical_f_measure(spark, d):
    return _rounded(mt.hierarchical_f_measure(fx.confusion(spark, d), fx.closure(spark), GROUP), digits=9)


def f_measure_per_sample(spark, d):
    return _rounded(mt.wide_by_k(mt.f_measure(fx.confusion(spark, d), [*RUN, "k"]), RUN, 3), digits=9)


def f_measure_per_group(spark, d):
    grouped = mt.aggregate_confusion(fx.confusion(spark, d), GROUP).withColumnRenamed("model_name", "group_name")
    return _rounded(mt.wide_by_k(mt.f_measure(grouped, ["group_name", "k"]), ["group_name"], 3), digits=9)


def hierarchical_per_sample(spark, d):
    return _rounded(mt.hierarchical_f_measure(fx.confusion(spark, d).where("k = 1"), fx.closure(spark), RUN), digits=9)


def hierarchical_per_group(spark, d):
    grouped = mt.aggregate_confusion(fx.confusion(spark, d).where("k = 1"), ["model_name"]).withColumnRenamed("model_name", "group_name")
    return _rounded(mt.hierarchical_f_measure(grouped, fx.closure(spark), ["group_name"]), digits=9)


def _truth_and_ranks(spark, d):
    return mt.join_truth_predictions(fx.truth(spark, d), fx.ranked_labels(spark, d))


def build_all_confusions(spark, d):
    return mt.build_all_confusions(_truth_and_ranks(spark, d), "name_1", 2, RUN, fx.universe(spark))


def benchmark_pipeline(spark, d):
    """All four tables are written as CSV; the one per sample is read again."""
    tables = mt.benchmark_pipeline(_truth_and_ranks(spark, d), fx.closure(spark), "name_1", 2, fx.universe(spark))
    folder = _scratch(spark, "benchmark")
    io.write_metrics(folder, tables)
    schema = tables["f_measure_per_sample"].schema
    return _rounded(io.read_predictions_csv(spark, f"{folder}/f_measure_per_sample.csv", schema), digits=9)


def select_count_layer(spark, d):
    return pp.select_count_layer(fx.counts(spark, d), "raw.X")


def cast_counts_float32(spark, d):
    return _rounded(pp.cast_counts_float32(fx.counts(spark, d)), digits=9)


def total_mrna_umis(spark, d):
    return _rounded(pp.total_mrna_umis(fx.counts(spark, d), fx.cells(spark, d)).select("cell_id", "total_mrna_umis"))


def pre_sanitize(spark, d):
    return _rounded(pp.pre_sanitize(fx.counts(spark, d), fx.cells(spark, d))[1].select("cell_id", "total_mrna_umis"))


def validate_features(spark, d):
    return pp.validate_features(fx.features(spark, d), fx.feature_schema(spark, d))


def _sanitized(spark, d):
    return pp.sanitize_counts(pp.select_count_layer(fx.counts(spark, d), "raw.X"), fx.features(spark, d), fx.feature_schema(spark, d))


def sanitize_counts(spark, d):
    return _sanitized(spark, d)


def map_feature_names(spark, d):
    return pp.map_feature_names(fx.features(spark, d), fx.feature_schema(spark, d))


def sparse_rows(spark, d):
    rows = pp.sparse_rows(_sanitized(spark, d), fx.cells(spark, d), fx.feature_schema(spark, d).count())
    return rows.select("cell_id", "size", _joined("indices").alias("indices"), F.array_join(F.transform("values", lambda x: x.cast("long").cast("string")), ",").alias("values"))


def validate_and_sanitize(spark, d):
    return _rounded(pp.validate_and_sanitize(fx.counts(spark, d), fx.cells(spark, d), fx.features(spark, d), fx.feature_schema(spark, d))[0])


def _mex(spark, d):
    folder = _scratch(spark, "mex")
    io.write_10x_mex(folder, pp.select_count_layer(fx.counts(spark, d), "raw.X"), fx.cells(spark, d), fx.features(spark, d))
    return io.read_10x_mex(spark, folder)


def read_10x_mex(spark, d):
    return _mex(spark, d)[0].select(F.col("cell_id").cast("long").alias("cell_id"), F.col("feature_id").cast("long").alias("feature_id"), "value")


def write_10x_mex(spark, d):
    return _mex(spark, d)[2].select(F.col("feature_id").cast("long").alias("feature_id"), "feature_name", "pos")


def counts_parquet(spark, d):
    folder = _scratch(spark, "matrix") + ".parquet"
    io.write_counts(folder, fx.counts(spark, d), fx.cells(spark, d), fx.features(spark, d))
    return io.read_matrix(spark, folder)[0]


def _resource(spark, d):
    links = fx.market_edges(spark, d)
    depths = on.path_depths(links).withColumn("all", F.lit(0))
    terms = numbered_within(depths, "all", "term_id", "idx").select("term_id", F.col("idx").cast("long").alias("idx"), F.lower("term_id").alias("label"), "depth_short", "depth_long")
    path = _scratch(spark, "resource")
    io.write_ontology_resource(path, terms, io.number_children(links))
    return io.read_ontology_resource(spark, path)


def read_ontology_resource(spark, d):
    return _resource(spark, d)[0]


def write_ontology_resource(spark, d):
    return _resource(spark, d)[1]


def ontology_response_json(spark, d):
    path = _scratch(spark, "response")
    io.write_ontology_response(path, runs.response_lists(fx.scores(spark, d)))
    back = io.read_ontology_response(spark, path)
    total = F.aggregate("matches", F.lit(0.0), lambda a, m: a + m["score"])
    return _rounded(back.select(F.col("query_cell_id").cast("long").alias("cell_id"), F.size("matches").alias("n_matches"), total.alias("score"), "total_weight", "total_neighbors", "total_neighbors_unrecognized"))


def inferred_labels_csv(spark, d):
    path = _scratch(spark, "labels")
    io.write_inferred_labels(path, sc.top_k_calls_single(_matrix(spark, d), fx.query_cells(spark, d), fx.terms(spark), 0.2))
    back = io.read_inferred_labels(spark, path)
    return _rounded(back.withColumn("cell_id", F.col("cell_id").cast("long")))


def run_metadata_json(spark, d):
    path = _scratch(spark, "metadata")
    runs = fx.table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("input_path"), F.col("o_orderpriority").alias("model_name")).agg(F.count("*").alias("n_cells"))
    io.write_run_metadata(path, runs.withColumn("ontology_resource_name", F.lit("market")))
    return io.read_run_metadata(spark, path)


def collect_runs(spark, d):
    """Runs are written by Spark, a folder each, and found again by their files."""
    parent = _scratch(spark, "runs")
    orders = fx.table(spark, d, "orders").select(F.concat(F.lit("run_"), F.col("o_orderstatus")).alias("run"), F.col("o_orderkey").cast("string").alias("cell_id"))
    for (run,) in orders.select("run").distinct().collect():  # a few folders
        orders.where(F.col("run") == run).select("cell_id").write.option("header", True).csv(f"{parent}/{run}/inferred_labels.csv")
    return io.collect_runs(io.run_files(spark, parent), ["inferred_labels.csv"])


def confusion_store(spark, d):
    path = _scratch(spark, "confusion")
    matrices = fx.confusion(spark, d)
    io.write_confusion(path, matrices, mt.confusion_metadata(matrices, fx.universe(spark), [*RUN, "k"]))
    matrices, metadata = io.read_confusion(spark, path)
    return matrices.join(metadata.select(*RUN, F.col("k").cast("int").alias("k"), F.col("matrix_size").cast("int").alias("matrix_size")), [*RUN, "k"])


def run_store(spark, d):
    """All runs, put in two parts, one of which is put twice; the sums by group are read."""
    path = _scratch(spark, "runs")
    matrices = fx.confusion(spark, d)
    metadata = mt.confusion_metadata(matrices, fx.universe(spark), RUN)
    for part in ("model_name < 'N'", "model_name >= 'N'", "model_name < 'N'"):
        st.put_runs(path, matrices.where(part), metadata.where(part))
    return st.read_groups(spark, path)


def metrics_csv(spark, d):
    folder = _scratch(spark, "metrics")
    metrics = mt.f_measure(fx.confusion(spark, d), GROUP)
    io.write_metrics(folder, {"f_measure": metrics})
    return _rounded(io.read_predictions_csv(spark, f"{folder}/f_measure.csv", metrics.schema), digits=9)


def read_predictions_csv(spark, d):
    path = _scratch(spark, "azimuth")
    predictions = fx.azimuth(spark, d)
    predictions.write.option("header", True).csv(path)
    return _plain_levels(io.read_predictions_csv(spark, path, predictions.schema))


QUERIES = {
    "k1_knn_search": knn_search, "k2_knn_search_approx": knn_search_approx, "k3_neighbor_summary_stats": neighbor_summary_stats,
    "k4_neighbor_dataset_stats": neighbor_dataset_stats, "k5_ontology_aware_scores": ontology_aware_scores,
    "k6_align_results_to_query": align_results_to_query, "k7_query_cells_by_ids": query_cells_by_ids, "k7_query_store_by_ids": query_store_by_ids, "k8_drop_null_fields": drop_null_fields,
    "r1_majority_vote": majority_vote, "r2_min_distance_vote": min_distance_vote, "r3_cluster_majority_vote": cluster_majority_vote,
    "r4_cluster_vote_detail": cluster_vote_detail, "r5_wnn_weights": wnn_weights, "r5_fuzzy_connectivities": fuzzy_connectivities, "r6_cell_type_probs": cell_type_probs,
    "r7_wnn_vote": wnn_vote, "r7_fuzzy_wnn_vote": fuzzy_wnn_vote, "r8_relabel_rare_types": relabel_rare_types, "r9_interpolate_type_colors": interpolate_type_colors,
    "o1_parents_map": parents_map, "o2_ancestor_closure": ancestor_closure, "o3_descendant_closure": descendant_closure,
    "o4_get_ancestors": get_ancestors, "o5_get_descendants": get_descendants, "o5_descendant_pages": descendant_pages, "o6_path_depths": path_depths,
    "o7_linearity_violations": linearity_violations, "o8_propagate_scores_max": propagate_scores_max,
    "o9_parse_ranked_labels": parse_ranked_labels, "o10_build_ontology_response": build_ontology_response,
    "a1_score_matrix": score_matrix, "a2_attach_scores": attach_scores, "a3_fraction_over_threshold": fraction_over_threshold,
    "a4_aggregate_scores": aggregate_scores, "a4_sketched_aggregates": sketched_aggregates, "a5_aggregate_scores_by_cluster": aggregate_scores_by_cluster,
    "a6_most_granular_top_k": most_granular_top_k, "a7_top_k_calls_single": top_k_calls_single, "a8_rooted_score_tree": rooted_score_tree,
    "a9_top_k_calls_cluster": top_k_calls_cluster, "a10_term_score_opacity": term_score_opacity, "a10_term_opacity_from_store": term_opacity_from_store, "a11_padded_bounds": padded_bounds,
    "a12_inferred_labels": inferred_labels, "a13_annotate_pipeline": annotate_pipeline,
    "z1_align_predictions": align_predictions, "z3_crosswalk_labels": crosswalk_labels, "z4_crosswalk_wide": crosswalk_wide,
    "z5_unmapped_label_report": unmapped_label_report, "z6_crosswalk_pipeline": crosswalk_pipeline,
    "b1_labels_outside_universe": labels_outside_universe, "b2_confusion_matrix": confusion_matrix, "b5_top_k_hit_predictions": top_k_hit_predictions,
    "b6_join_truth_predictions": join_truth_predictions, "b7_aggregate_confusion": aggregate_confusion,
    "b8_aggregate_confusion_custom": aggregate_confusion_custom, "b9_f_measure": f_measure, "b10_hierarchical_counts": hierarchical_counts, "b10_pair_overlaps": pair_overlaps,
    "b11_hierarchical_f_measure": hierarchical_f_measure, "b12_f_measure_per_sample": f_measure_per_sample,
    "b13_f_measure_per_group": f_measure_per_group, "b14_hierarchical_per_sample": hierarchical_per_sample,
    "b14_hierarchical_per_group": hierarchical_per_group, "b15_build_all_confusions": build_all_confusions, "b16_benchmark_pipeline": benchmark_pipeline,
    "p1_select_count_layer": select_count_layer, "p2_cast_counts_float32": cast_counts_float32, "p3_total_mrna_umis": total_mrna_umis,
    "p4_pre_sanitize": pre_sanitize, "p6_validate_features": validate_features, "p7_sanitize_counts": sanitize_counts,
    "p8_map_feature_names": map_feature_names, "p9_sparse_rows": sparse_rows, "p10_validate_and_sanitize": validate_and_sanitize,
    "s1_read_10x_mex": read_10x_mex, "s2_counts_parquet": counts_parquet, "s3_write_10x_mex": write_10x_mex,
    "s4_read_ontology_resource": read_ontology_resource, "s5_write_ontology_resource": write_ontology_resource,
    "s6_ontology_response_json": ontology_response_json, "s7_inferred_labels_csv": inferred_labels_csv, "s8_run_metadata_json": run_metadata_json,
    "s9_collect_runs": collect_runs, "s10_confusion_store": confusion_store, "s10_run_store": run_store, "s11_metrics_csv": metrics_csv, "s12_read_predictions_csv": read_predictions_csv,
}
