import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellscore import fixtures as fx
from cellscore import sources as io
from cellscore.operators import connectivities as cn
from cellscore.operators import crosswalk as cw
from cellscore.operators import neighbors as nb
from cellscore.operators import preprocess as pp
from cellscore.operators import reducers as rd
from cellscore.operators import runs
from cellscore.operators import scores as sc


def test_knn_against_numpy_with_ties_and_equal_vectors(spark):
    rng = np.random.default_rng(1)
    q, r = rng.normal(size=(7, 5)), rng.normal(size=(40, 5))
    r[11], r[12] = q[3], q[3]
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "cell_id long, embedding array<double>")
    references = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(r)], "cas_cell_index long, embedding array<double>").repartition(3)
    for metric in ("l2", "cosine"):
        a, b = (q, r) if metric == "l2" else (q / np.linalg.norm(q, axis=1)[:, None], r / np.linalg.norm(r, axis=1)[:, None])
        d = np.linalg.norm(a[:, None] - b[None], axis=2)
        found = {(x["cell_id"], x["rank"]): x["cas_cell_index"] for x in nb.knn_search(queries, references, 4, metric).collect()}
        assert found == {(i, n + 1): j for i in range(7) for n, j in enumerate(np.lexsort((np.arange(40), d[i]))[:4].tolist())}
    with pytest.raises(ValueError):
        nb.knn_search(queries, references, 4, "city")


def test_neighbours_of_many_queries_by_a_grid(spark, monkeypatch):
    """Queries over the bound for broadcasts meet the references in the cells of a grid; the rows are the same."""
    rng = np.random.default_rng(4)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(90, 6)))]
    q = spark.createDataFrame([*vectors[:30], (99, None)], "cell_id long, embedding array<double>")
    r = spark.createDataFrame([*vectors, (100, None)], "cas_cell_index long, embedding array<double>").repartition(3)
    rows = lambda: sorted(map(tuple, nb.knn_search(q, r, 5, exclude_self=True).collect()))
    whole = rows()
    monkeypatch.setattr(nb, "MOST_BYTES", 500)
    assert rows() == whole and len(whole) == 150 and all(a != b for a, b, *_ in whole)
    assert nb.knn_search(q.limit(0), r, 5).count() == 0 and nb.knn_search(q, r.limit(0), 5).count() == 0


def test_memory_of_the_exact_search_does_not_grow_with_queries_or_ties():
    """Vectors stay as floats, and candidates are those of one comparison: of four times the queries, all as near to all references, too."""
    import tracemalloc

    rng = np.random.default_rng(5)
    peaks = []
    for n in (2048, 8192):
        q = rng.normal(size=(n, 32)).astype(np.float32)
        tracemalloc.start()
        found = nb.Nearest(np.arange(n), q, 5, "l2", False)
        found.add(np.arange(2048), np.ones((2048, 32), np.float32))
        found.add(np.arange(2048, 4096), np.ones((2048, 32), np.float32))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert found.table().column("cas_cell_index").to_numpy().tolist() == [0, 1, 2, 3, 4] * n
    assert peaks[1] < 1.2 * peaks[0] and peaks[1] < 100e6


def test_exact_search_by_small_steps_against_numpy(monkeypatch):
    """Batches smaller than k, ties over batches, single floats, copies and the query itself among the references."""
    rng = np.random.default_rng(6)
    monkeypatch.setattr(nb, "BLOCK", 7)
    monkeypatch.setattr(nb, "QUERIES", 4)
    r = rng.integers(-2, 3, size=(90, 3)).astype(np.float32)
    r[40:60] = r[:20]
    ids = rng.permutation(90)
    for metric, alone in (("l2", False), ("l2", True), ("cosine", True)):
        x = nb.Nearest.scaled(r + np.float32(0.5), metric)
        found = nb.Nearest(ids[:30], (r + np.float32(0.5))[:30], 6, metric, alone)
        for start in range(0, 90, 11):
            found.add(ids[start : start + 11], (r + np.float32(0.5))[start : start + 11])
        apart = ((x[:30, None] - x[None]) ** 2).sum(axis=2)
        apart = apart / 2 if metric == "cosine" else np.sqrt(apart)
        got = found.table()
        for i in range(30):
            others = np.flatnonzero(ids != ids[i]) if alone else np.arange(90)
            nearest = others[np.lexsort((ids[others], apart[i, others]))[:6]]
            mine = got.column("cell_id").to_numpy() == ids[i]
            assert got.column("distance").to_numpy()[mine] == pytest.approx(apart[i, nearest])
            assert metric == "cosine" or got.column("cas_cell_index").to_numpy()[mine].tolist() == ids[nearest].tolist()


def test_last_result_of_a_cell_wins(spark):
    cells = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "cell_id long, pos long")
    response = spark.createDataFrame([(1, ["a"], 0), (1, ["b"], 1), (2, [], 0)], "cell_id long, matches array<string>, batch int")
    found = {r["cell_id"]: (r["matches"], r["unprocessed"]) for r in nb.align_results_to_query(cells, response, "batch").collect()}
    assert found == {1: (["b"], False), 2: ([], False), 3: ([], True)}
    with pytest.raises(ValueError, match="none"):
        nb.align_results_to_query(cells, response, "none")


def test_medians_of_many_values_by_histograms(spark, monkeypatch):
    """Windows of at most 8 bins, a few levels deep, find the same middles as numpy."""
    monkeypatch.setattr(sc, "BINS", 8)
    rng = np.random.default_rng(5)
    values = {t: np.round(rng.exponential(size=n), 3) for t, n in (("T0", 301), ("T1", 300), ("T2", 120), ("T3", 1))}
    scores = spark.createDataFrame([(i, t, float(v)) for t, x in values.items() for i, v in enumerate(x)], "cell_id long, term_id string, score double")
    cells = spark.range(303).withColumnRenamed("id", "cell_id")
    for r in sc.aggregate_scores(scores, cells, fx.terms(spark).where("term_id in ('T0', 'T1', 'T2', 'T3', 'T4')"), threshold=0.2).collect():
        dense = np.zeros(303)
        dense[: len(values.get(r["term_id"], []))] = values.get(r["term_id"], [])
        over = dense[dense > 0.2]
        assert r["median_all"] == pytest.approx(np.median(dense)) and r["median_over"] == pytest.approx(np.median(over) if len(over) else 0)
        assert r["fraction"] == pytest.approx(len(over) / 303)
    with pytest.raises(ValueError):
        sc.aggregate_scores(scores, cells.limit(0), fx.terms(spark))
    with pytest.raises(ValueError):
        sc.fraction_over_threshold(scores, cells.limit(0), fx.terms(spark))


def test_medians_with_implicit_zeros(spark):
    cells = spark.createDataFrame([(i, "a" if i < 5 else "b") for i in range(9)], "cell_id long, cluster string")
    values = {(0, "T0"): 0.5, (1, "T0"): 0.2, (2, "T0"): 0.9, (5, "T0"): 0.3, (0, "T1"): 0.00005, (6, "T1"): 0.4, (7, "T1"): 0.4, (8, "T1"): 0.1}
    scores = spark.createDataFrame([(c, t, s) for (c, t), s in values.items()], "cell_id long, term_id string, score double")
    rows = {(r["grp"], r["term_id"]): r for r in sc.aggregate_scores(scores, cells, fx.terms(spark), by="cluster").collect()}
    assert len(rows) == 2 * len(fx.TERMS)
    for grp, members in (("a", range(5)), ("b", range(5, 9))):
        for term in ("T0", "T1", "T2"):
            dense = np.array([values.get((c, term), 0.0) for c in members])
            over = dense[dense > sc.THRESHOLD]
            r = rows[grp, term]
            assert r["mean_all"] == pytest.approx(dense.mean()) and r["median_all"] == pytest.approx(np.median(dense))
            assert r["mean_over"] == pytest.approx(over.mean() if len(over) else 0) and r["median_over"] == pytest.approx(np.median(over) if len(over) else 0)
            assert r["fraction"] == pytest.approx(len(over) / len(dense))
    with pytest.raises(ValueError):
        sc.require_selection(cells.limit(0))


def test_most_granular_order_padding_and_dense_threshold(spark):
    terms = spark.createDataFrame([("CL:0000000", 0, "root", 0, 0), ("CL:0000255", 1, "a", 1, 1), ("CL:0000540", 2, "b", 2, 2), ("CL:0000404", 3, "c", 2, 2)], "term_id string, idx int, label string, depth_short int, depth_long int")
    scores = spark.createDataFrame([("g", "CL:0000000", 1.0), ("g", "CL:0000540", 0.9), ("g", "CL:0000255", 0.6), ("g", "CL:0000404", 0.5)], "grp string, term_id string, score double")
    top = sorted(tuple(r) for r in sc.most_granular_top_k(scores, terms, scores, 0.2, 5).select("rank", "term_id", "score", "depth").collect())
    assert top == [(1, "CL:0000540", 0.9, 2), (2, "CL:0000404", 0.5, 2), (3, "CL:0000255", 0.6, 1), (4, "CL:0000000", 1.0, 0), (5, "CL:0000000", 1.0, 0)]
    dense = sc.most_granular_top_k(scores.where("term_id = 'CL:0000255'"), terms, scores, 0.0, 2).select("rank", "term_id", "score").collect()
    assert sorted(map(tuple, dense)) == [(1, "CL:0000540", 0.0), (2, "CL:0000404", 0.0)]


def test_tree_drops_a_failing_node_with_its_subtree(spark):
    aggregated = spark.createDataFrame([("CL:0000000", 1.0, 1.0), ("M0", 0.5, 1.0), ("K0", 0.5, 1.0), ("K1", 0.04, 1.0), ("T1", 0.9, 1.0), ("T0", 0.9, 1.0)], "term_id string, score double, fraction double")
    found = sc.rooted_score_tree(aggregated, fx.edges(spark)).orderBy("ord").collect()
    assert [r["term_id"] for r in found] == ["CL:0000000", "M0", "T0", "K0", "T0"]  # children in the resource's order
    paths = {"/".join(r["path"]) for r in found}
    assert paths == {"CL:0000000", "CL:0000000/M0", "CL:0000000/K0", "CL:0000000/M0/T0", "CL:0000000/K0/T0"}
    with pytest.raises(ValueError):
        sc.rooted_score_tree(aggregated, fx.edges(spark), root="K1")


def test_tree_of_any_depth_and_cycles(spark):
    """A chain is unrolled to its end; a path that closes on itself, or a term that is its own child, is an error."""
    names = ["CL:0000000", *(f"N{i}" for i in range(1, 13))]
    aggregated = spark.createDataFrame([(t, 0.5, 1.0) for t in names], "term_id string, score double, fraction double").coalesce(1)
    chain = list(zip(names, names[1:]))
    edges = lambda pairs: spark.createDataFrame([(a, b, 0) for a, b in pairs], "parent string, child string, child_ord int").coalesce(1)
    found = sc.rooted_score_tree(aggregated, edges(chain)).select("depth", "path").collect()
    assert sorted((r["depth"], r["path"]) for r in found) == [(i, names[: i + 1]) for i in range(13)]
    for extra in (("N3", "N1"), ("N2", "N2"), ("N2", "CL:0000000")):
        with pytest.raises(ValueError, match="cycle"):
            sc.rooted_score_tree(aggregated, edges([*chain[:4], extra]))


def test_votes_ties_and_empty_lists(spark):
    matches = spark.createDataFrame([(1, 0, "B", 2, 0.3), (1, 1, "A", 2, 0.3), (2, 0, "A", 1, 0.5)], "cell_id long, pos int, cell_type string, cell_count long, min_distance double")
    cells = spark.createDataFrame([(1, 0, "x"), (2, 1, "x"), (3, 2, "y")], "cell_id long, pos int, cluster string")
    assert sorted(map(tuple, rd.majority_vote(cells, matches).collect()), key=str) == [(1, "B", 0.5), (2, "A", 1.0), (3, None, None)]
    assert sorted(map(str, map(tuple, rd.min_distance_vote(cells, matches).collect()))) == ["(1, 'B', 0.3)", "(2, 'A', 0.5)", "(3, None, inf)"]
    voted = {r["cell_id"]: (r["cell_type"], r["confidence"]) for r in rd.cluster_majority_vote(matches, cells).collect()}
    assert voted == {1: ("A", 0.6), 2: ("A", 0.6), 3: (None, None)}
    voted = {r["cell_id"]: r["cell_type"] for r in rd.cluster_majority_vote(matches, cells, ("A", "B")).collect()}
    assert voted == {1: None, 2: None, 3: None}


def test_weighted_votes_and_their_guards(spark):
    cells = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "cell_id long, pos int")
    kind = "cell_id long, matches array<struct<cell_type string, cell_count long>>"
    responses = spark.createDataFrame([(1, [("A", 3), ("B", 1)]), (2, [("B", 2)]), (3, [])], kind)
    graph = spark.createDataFrame([(1, 2, 1.0)], "i long, j long, connectivity double")
    assert sorted(map(tuple, rd.wnn_weights(graph, cells, 5).collect())) == [(1, 1, 0.5), (1, 2, 0.5), (2, 2, 1.0), (3, 3, 1.0)]
    voted, probs = rd.wnn(cells, responses, graph, 5, 5, min_n_cells_per_type=2)
    assert sorted(map(tuple, voted.collect()), key=str) == [(1, "B", 0.625), (2, "B", 1.0), (3, None, None)] and probs.count() == 3
    assert {r["cell_type"] for r in rd.wnn(cells, responses, graph, 5, 5)[0].where("cell_id < 3").collect()} == {rd.UNRELIABLE}
    for wrong in ({"strategy": "umap"}, {"n_neighbors": 6}, {"responses": responses.where("cell_id < 3")}, {"cells": cells.where("cell_id < 3")}, {"n_neighbors": 0}):
        with pytest.raises(Exception, match="strategy|n_neighbors|response for each cell"):
            rd.wnn(**({"cells": cells, "responses": responses, "graph": graph, "graph_neighbors": 5, "n_neighbors": 5} | wrong))[0].collect()
    with pytest.raises(Exception, match="add up to 1"):
        rd.wnn_weights(graph.limit(0), cells, 5, 0.0).collect()


def test_ontology_response_reports_what_does_not_fit(spark):
    wide = spark.createDataFrame([(1, "T0", 0.5, "M0", 0.7), (2, "T0", 0.5, "M1", 0.7), (3, "X9", 0.5, None, None)], "cell_id long, cas_cell_type_name_1 string, cas_cell_type_score_1 double, cas_cell_type_name_2 string, cas_cell_type_score_2 double")
    found = cw.build_ontology_response(wide, fx.terms(spark), fx.closure(spark), "r")
    assert sorted(map(str, map(tuple, found.report.collect()))) == ["('nonlinear', 'T0', 'M1')", "('unknown', 'X9', None)"]
    assert {r["cell_id"]: len(r["matches"]) for r in found.response.collect()}[3] == 0


def test_runs_are_written_and_found_again(spark, tmp_path):
    d, terms = "/root/testdata/sf0.001", fx.terms(spark)
    cells = fx.query_cells(spark, d)
    paths = runs.annotate(f"{tmp_path}/runs/a", cells, fx.reference_cells(spark, d), terms, fx.closure(spark), fx.edges(spark), cluster="cluster", input_path="here")
    assert io.read_run_metadata(spark, paths["metadata"]).first()["n_cells"] == cells.count() == io.read_ontology_response(spark, paths["response"]).count()
    assert io.read_ontology_resource(spark, paths["resource"])[0].count() == terms.count() and spark.read.parquet(paths["scores"]).first()["resource_name"] == "ontology"
    p = spark.createDataFrame([(1, "a", 0.5), (2, "b", 0.4), (7, "b", 0.4)], "cell_id long, `predicted.l1` string, `predicted.l1.score` double")
    table = spark.createDataFrame([("a", "T1", "t1")], "source_label string, term_id string, term_label string")
    one = spark.createDataFrame([(1, 0), (2, 1)], "cell_id long, pos long")
    more = runs.crosswalk_run(f"{tmp_path}/runs/b", one, p, table, terms, fx.closure(spark), fx.edges(spark), "ref")
    assert tuple(io.read_run_metadata(spark, more["metadata"]).first())[1:3] == ("azimuth_ref", 2) and [r["value"] for r in spark.read.json(more["report"]).collect()] == ["unknown"]
    (tmp_path / "list.txt").write_text(f"{tmp_path}/runs/b\n\n{tmp_path}/runs/a/\n")
    required = ["ontology_response.json", "ontology_resource.json", "inferred_labels.csv", "metadata.json"]
    assert [r["run_id"] for r in io.collect_runs(io.run_files(spark, f"{tmp_path}/list.txt"), required).collect()] == [f"{tmp_path}/runs/a", f"{tmp_path}/runs/b"]
    assert [r["run_id"] for r in io.collect_runs(io.run_files(spark, f"{tmp_path}/runs"), required).collect()] == ["a", "b"]
    with pytest.raises(ValueError, match="scores.parquet"):
        io.collect_runs(io.run_files(spark, f"{tmp_path}/list.txt"), ["scores.parquet"])
    (tmp_path / "none.txt").write_text("\n")
    with pytest.raises(ValueError):
        io.run_files(spark, f"{tmp_path}/none.txt")


def test_feature_validation_and_sanitising(spark):
    ids = [f"g{i}" for i in range(13)]
    table = lambda names: spark.createDataFrame([(n, i, n.upper()) for i, n in enumerate(names)], "feature_id string, pos long, feature_name string")
    report = lambda names, layer="X": tuple(pp.validate_features(table(names), table(ids), layer).first())
    assert report(ids) == (True, 0, 0) and report(ids, "raw.X") == (False, 0, 0)
    assert report(ids[:9]) == (False, 4, 0) and report([*ids, "x", "y", "z"]) == (False, 0, 3) and report([*ids[:10], "x", "y"]) == (False, 3, 2)
    assert report(ids[::-1]) == (False, 0, 0)
    umis = {(0, 0): 1, (0, 2): 2, (1, 2): 1, (2, 0): 2, (2, 1): 1}
    counts = spark.createDataFrame([(c, ids[f], "X", float(v)) for (c, f), v in umis.items()], "cell_id long, feature_id string, layer string, value double")
    cells = spark.createDataFrame([(i, i) for i in range(4)], "cell_id long, pos long")
    assert [r["total_mrna_umis"] for r in pp.total_mrna_umis(counts, cells).orderBy("cell_id").collect()] == [3, 1, 3, 0]
    schema = table(["g2", "new", "g0"]).drop("feature_name")
    clean, more, names = pp.validate_and_sanitize(counts, cells, table(ids), schema, name="feature_name")
    rows = {r["cell_id"]: (r["indices"], r["values"]) for r in pp.sparse_rows(clean, cells, 3).collect()}
    assert rows == {0: ([0, 2], [2.0, 1.0]), 1: ([0], [1.0]), 2: ([2], [2.0]), 3: ([], [])}
    assert [r["feature_name"] for r in names.orderBy("pos").collect()] == ["G2", "N/A", "G0"] and "total_mrna_umis" in more.columns
    twice = spark.createDataFrame([("a", 0, "x"), ("a", 1, "y")], "feature_id string, pos long, feature_name string")
    two = spark.createDataFrame([(1, "a", 0, 5.0), (1, "a", 1, 7.0)], "cell_id long, feature_id string, feature_pos long, value double")
    assert [r["value"] for r in pp.sanitize_counts(two, twice, twice.limit(1)).collect()] == [7.0]
    with pytest.raises(ValueError):
        pp.feature_ids(twice, "none")


def test_crosswalk_corners(spark):
    p = spark.createDataFrame([(1, "a", 0.5, None, 0.1), (2, "b", 0.5, "zz", 0.2)], "cell_id long, `predicted.l1` string, `predicted.l1.score` double, `predicted.l2` string, `predicted.l2.score` double")
    table = spark.createDataFrame([("a", "T1", "t1", 0), ("a", "T2", "t2", 1), ("b", "T3", "t3", 2)], "source_label string, term_id string, term_label string, ord int")
    assert cw.infer_level_specs(p.columns)[0][0] == "predicted.l2"
    rows = {r["cell_id"]: r for r in cw.crosswalk_wide(p, table).collect()}
    assert rows[1]["cas_cell_type_name_1"] is None and rows[1]["cas_cell_type_name_2"] == "T2" and rows[2]["cas_cell_type_label_1"] == "unknown"
    cells = spark.createDataFrame([(1, 0), (9, 1)], "cell_id long, pos long")
    with pytest.raises(ValueError, match="9"):
        cw.align_predictions(cells, p)
    with pytest.raises(ValueError):
        cw.infer_level_specs(["predicted.l1"])


def test_sources_round_trip_and_guards(spark, tmp_path):
    counts = spark.createDataFrame([("c1", "g1", 2.0), ("c2", "g0", 3.5)], "cell_id string, feature_id string, value double")
    cells = spark.createDataFrame([("c1", 1), ("c2", 0)], "cell_id string, pos long")
    features = spark.createDataFrame([("g0", 0, "s0"), ("g1", 1, "nan"), ("nan", 2, "s2")], "feature_id string, pos long, feature_name string").repartition(3)
    io.write_10x_mex(f"{tmp_path}/m.mex", counts, cells, features)
    a, b, c = io.read_matrix(spark, f"{tmp_path}/m.mex")
    assert sorted(map(tuple, a.collect())) == [("c1", "g1", 2.0), ("c2", "g0", 3.5)]
    assert [r["cell_id"] for r in b.orderBy("pos").collect()] == ["c2", "c1"]
    assert sorted(map(tuple, c.collect())) == [("g0", "s0", 0), ("g1", "", 1), ("s2", "s2", 2)]
    with pytest.raises(ValueError):
        io.read_matrix(spark, f"{tmp_path}/m.h5")
    for genome in ("g38", "m10"):  # the older layout, a folder a genome
        io.write_10x_mex(f"{tmp_path}/old.mex/{genome}", counts.where(f"'{genome}' = 'g38'"), cells, features)
    assert io.read_matrix(spark, f"{tmp_path}/old.mex", genome="g38")[0].count() == 2 and io.read_10x_mex(spark, f"{tmp_path}/old.mex", "m10")[0].count() == 0
    for wrong in (None, "x"):
        with pytest.raises(ValueError, match="g38, m10"):
            io.read_10x_mex(spark, f"{tmp_path}/old.mex", wrong)
    for form in (None, "record", "lines"):
        io.write_ontology_resource(f"{tmp_path}/{form}.json", fx.terms(spark), fx.edges(spark), form)
        back = io.read_ontology_resource(spark, f"{tmp_path}/{form}.json")
        for mine, theirs in zip(back, (fx.terms(spark), fx.edges(spark))):
            assert sorted(map(tuple, mine.select(*theirs.columns).collect())) == sorted(map(tuple, theirs.collect()))
    links = spark.createDataFrame([("a" if i % 10 else "b", f"c{i:04}") for i in range(300)], "parent string, child string").repartition(5)
    numbers = {(r["parent"], r["child"]): r["child_ord"] for r in io.number_children(links).collect()}
    assert sorted(v for (p, _), v in numbers.items() if p == "a") == list(range(270)) and numbers["b", "c0290"] == 29
    (tmp_path / "r.json").write_text('{"query_cell_id": "1", "matches": []}\n')
    with pytest.raises(Exception, match="missing total_weight"):
        io.read_ontology_response(spark, f"{tmp_path}/r.json").collect()
    io.write_inferred_labels(f"{tmp_path}/l.csv", cells)
    with pytest.raises(ValueError, match="cell_id"):
        io.read_inferred_labels(spark, f"{tmp_path}/l.csv", ["none"])
    for run, names in (("r1", ("a", "b")), ("r2", ("a",))):
        for n in names:
            (tmp_path / "runs" / run).mkdir(parents=True, exist_ok=True)
            (tmp_path / "runs" / run / n).write_text("x")
    files = io.run_files(spark, f"{tmp_path}/runs")
    assert [r["run_id"] for r in io.collect_runs(files, ["a"]).collect()] == ["r1", "r2"]
    with pytest.raises(ValueError, match="r2/b"):
        io.collect_runs(files, ["a", "b"])
    with pytest.raises(ValueError):
        nb.query_cells_by_ids(cells, cells, ["no such"])


def test_ontology_resource_of_other_tools_and_empty_ones(spark, tmp_path, monkeypatch):
    record = {
        "cl_names": ["CL:0000000", "b", "a"], "cell_ontology_term_id_to_cell_type": {"a": "A", "b": "B", "CL:0000000": "cell"}, "children_dictionary": {"CL:0000000": ["b", "a"], "b": ["a"]},
        "shortest_path_lengths_from_cell_root": {"CL:0000000": 0, "a": 1, "b": 1}, "longest_path_lengths_from_cell_root": {"CL:0000000": 0, "a": 2, "b": 1}, "ancestors_dictionary": {"a": ["b"]},
    }
    path = tmp_path / "ontology_resource.json"
    path.write_text(json.dumps(record, indent=1))
    terms, edges = io.read_ontology_resource(spark, str(path))
    assert sorted(map(tuple, terms.collect()), key=lambda r: r[1]) == [("CL:0000000", 0, "cell", 0, 0), ("b", 1, "B", 1, 1), ("a", 2, "A", 1, 2)]
    assert sorted(map(tuple, edges.collect())) == [("CL:0000000", "a", 1), ("CL:0000000", "b", 0), ("b", "a", 0)]
    (tmp_path / "empty.json").write_text("{}")
    with pytest.raises(ValueError, match="holds no ontology"):
        io.read_ontology_resource(spark, f"{tmp_path}/empty.json")
    monkeypatch.setattr(io, "MOST_RECORD", 5)
    with pytest.raises(ValueError, match="are no record"):
        io.write_ontology_resource(f"{tmp_path}/r", fx.terms(spark), fx.edges(spark), "record")
    io.write_ontology_resource(f"{tmp_path}/r", fx.terms(spark), fx.edges(spark))
    assert spark.read.json(f"{tmp_path}/r/terms").count() == 16


def test_a_run_with_counts_is_written_again(spark, tmp_path):
    d, terms = "/root/testdata/sf0.001", fx.terms(spark)
    cells = fx.query_cells(spark, d)
    counts = fx.counts(spark, d).join(cells.select("cell_id"), "cell_id", "left_semi")
    once = lambda **more: runs.annotate(f"{tmp_path}/run", cells, fx.reference_cells(spark, d), terms, fx.closure(spark), fx.edges(spark), matrix=(counts, fx.features(spark, d)), feature_schema=fx.feature_schema(spark, d), layer="raw.X", **more)
    paths = once()
    with pytest.raises(Exception, match="(?i)exists"):
        once()
    assert once(overwrite=True) == paths
    conformed, totals, features = io.read_counts(spark, paths["counts"])
    known = {r["feature_id"] for r in fx.feature_schema(spark, d).collect()}
    sums = {r["cell_id"]: r["v"] for r in counts.where("layer = 'raw.X'").groupBy("cell_id").agg(F.sum("value").alias("v")).collect()}
    assert {r["cell_id"]: r["total_mrna_umis"] for r in totals.collect()} == {r["cell_id"]: sums.get(r["cell_id"], 0.0) for r in cells.collect()}
    assert conformed.count() > 0 and features.count() == len(known)
    with pytest.raises(ValueError, match="come together"):
        runs.annotate(f"{tmp_path}/other", cells, fx.reference_cells(spark, d), terms, fx.closure(spark), fx.edges(spark), feature_schema=fx.feature_schema(spark, d))


def rows_read(df):
    """Rows that the scans of df's plan gave when it was collected."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_look_ups_read_only_row_groups_with_asked_ids(spark, tmp_path, monkeypatch):
    even = spark.range(0, 20000, 2).select(F.col("id").alias("cas_cell_index"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("tissue"), F.lit(None).cast("string").alias("disease")).repartition(4)
    nb.write_reference_store(f"{tmp_path}/store", even, files=20)
    store = spark.read.parquet(f"{tmp_path}/store")
    ask = lambda *ids: nb.query_store_by_ids(store, spark.createDataFrame([(i,) for i in ids], "cas_cell_index long"), ["tissue"])
    assert sorted(map(tuple, ask(2, 4, 2, 777, None).collect())) == [(2, "t2"), (4, "t4")]
    even.write.parquet(f"{tmp_path}/plain")
    assert 0 < rows_read(ask(2, 4)) <= 700 and rows_read(spark.read.parquet(f"{tmp_path}/plain").where("cas_cell_index in (2, 4)")) >= 2000
    assert rows_read(ask(*range(1, 19999, 1000))) <= 1500  # absent ids within every file's range: the filters rule nearly all files out
    assert ask().count() == 0
    few = sorted(map(tuple, ask(*range(0, 300, 3)).collect()))
    monkeypatch.setattr(nb, "MOST_PUSHED", 10)
    assert sorted(map(tuple, ask(*range(0, 300, 3)).collect())) == few and len(few) == 50
    with pytest.raises(ValueError, match="unknown features"):
        nb.query_store_by_ids(store, spark.createDataFrame([(1,)], "cas_cell_index long"), ["colour"])


def test_records_keep_types_and_lose_nulls(spark):
    import datetime

    row = (1, "a b", None, 2.5, True, 7, [1, 2], datetime.date(2020, 1, 2))
    df = spark.createDataFrame([row, (2, *[None] * 7)], "cas_cell_index long, s string, n string, d double, b boolean, i int, l array<int>, t date")
    found = {r["cas_cell_index"]: r["fields"].toPython() for r in nb.drop_null_fields(df).collect()}
    assert found == {1: {"s": "a b", "d": 2.5, "b": True, "i": 7, "l": [1, 2], "t": datetime.date(2020, 1, 2)}, 2: {}}
    kinds = nb.drop_null_fields(df).select(F.schema_of_variant("fields").alias("k")).first()["k"]
    assert "d: DOUBLE" in kinds and "b: BOOLEAN" in kinds and "n:" not in kinds


def test_fuzzy_connectivities_against_numpy(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(60, 3))
    x[10:14] = x[10]  # equal points: all distances of theirs are 0
    k, target = 5, np.log2(5)
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    near = [[j for j in np.lexsort((np.arange(60), d[i])) if j != i][: k - 1] for i in range(60)]
    w, mean_all = np.zeros((60, 60)), np.mean([np.append(d[i, near[i]], 0) for i in range(60)])
    for i in range(60):
        own = d[i, near[i]]
        rho = own[own > 0].min() if (own > 0).any() else 0.0
        low, high, sigma = 0.0, np.inf, 1.0
        for _ in range(64):
            total = np.exp(-np.maximum(own - rho, 0) / sigma).sum()
            if abs(total - target) < 1e-5:
                break
            if total > target:
                high = sigma
                sigma = (low + high) / 2
            else:
                low = sigma
                sigma = sigma * 2 if high == np.inf else (low + high) / 2
        sigma = max(sigma, 1e-3 * (np.append(own, 0).mean() if rho > 0 else mean_all))
        w[i, near[i]] = np.exp(-np.maximum(own - rho, 0) / sigma)
    union = w + w.T - w * w.T
    graph = spark.createDataFrame([(i, int(j), float(d[i, j])) for i in range(60) for j in near[i]] + [(3, 3, 0.0), (0, int(near[0][1]), 99.0)], "i long, j long, distance double")
    got = np.zeros((60, 60))
    for r in cn.fuzzy_connectivities(graph, k).collect():
        got[r["i"], r["j"]] = r["connectivity"]
    assert np.abs(got - union).max() < 1e-6
    assert cn.fuzzy_connectivities(graph.limit(0), k).count() == 0
    with pytest.raises(ValueError):
        cn.fuzzy_connectivities(graph, 1)
