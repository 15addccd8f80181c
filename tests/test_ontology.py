from cellscore import fixtures as fx
from cellscore.operators import ontology as on

import pytest

ROOT = on.ROOT


def graph(spark, *pairs):
    edges = spark.createDataFrame([(p, c, i) for i, (p, c) in enumerate(pairs)], "parent string, child string, child_ord int")
    nodes = sorted({x for pair in pairs for x in pair})
    return edges, spark.createDataFrame([(n,) for n in nodes], "term_id string")


def above(closure, term):
    return {r["ancestor_id"] for r in closure.where(f"term_id = '{term}'").collect()}


def test_closure_of_a_diamond_counts_each_term_once(spark):
    closure = on.ancestor_closure(*graph(spark, ("D", "B"), ("D", "C"), ("B", "A"), ("C", "A")))
    assert above(closure, "A") == {"A", "B", "C", "D"}
    assert closure.where("term_id = 'A'").count() == 4


def test_closure_of_a_cycle_ends(spark):
    closure = on.ancestor_closure(*graph(spark, ("A", "B"), ("B", "A")))
    assert above(closure, "A") == {"A", "B"}


def test_flags_and_unknown_terms(spark):
    closure = on.ancestor_closure(*graph(spark, (ROOT, "1"), ("1", "2"), ("1", "3"), ("3", "4")))
    asked = spark.createDataFrame([("4",), ("nowhere",)], "term_id string")
    found = {r["term_id"]: r["ancestors"] for r in on.get_ancestors(asked, closure, remove_root=True).collect()}
    assert found == {"4": ["1", "3", "4"], "nowhere": ["nowhere"]}
    found = {r["term_id"]: r["ancestors"] for r in on.get_ancestors(asked, closure, remove_root=True, remove_self=True).collect()}
    assert found == {"4": ["1", "3"], "nowhere": []}
    down = on.get_descendants(spark.createDataFrame([("3",)], "term_id string"), closure, remove_self=True)
    assert down.first()["descendants"] == ["4"]


def test_depths_differ_by_mode_and_target_is_fixed(spark):
    depths = {r["term_id"]: (r["depth_short"], r["depth_long"]) for r in on.path_depths(fx.edges(spark)).collect()}
    assert depths == {t: (s, n) for t, s, n in zip(fx.TERMS, fx.SHORT, fx.LONG)}
    with pytest.raises(ValueError):
        on.path_depths(fx.edges(spark), root="M0")
    with pytest.raises(ValueError, match="cycle"):
        on.path_depths(graph(spark, (ROOT, "A"), ("A", "B"), ("B", "A"))[0])


def test_ranked_labels_linearity_and_response(spark):
    wide = spark.createDataFrame([(1, "T1", "M1", 0.7, 0.9), (2, "T1", "M2", None, 0.4), (3, "gone", None, 0.5, 0.5)], "cell_id long, cas_cell_type_name_1 string, cas_cell_type_name_2 string, cas_cell_type_score_1 double, cas_cell_type_score_2 double")
    terms, closure = fx.terms(spark), fx.closure(spark)
    ranked = on.parse_ranked_labels(wide, terms)
    assert sorted((r["cell_id"], r["rank"], r["score"]) for r in ranked.collect()) == [(1, 1, 0.7), (1, 2, 0.9), (2, 1, 0.0), (2, 2, 0.4)]
    assert [tuple(r) for r in on.linearity_violations(ranked, closure).collect()] == [("T1", "M2")]
    rows = {r["cell_id"]: r for r in on.build_ontology_response(wide, terms, closure, "x").response.collect()}
    assert {m["cell_type_ontology_term_id"]: m["score"] for m in rows[1]["matches"]} == {"T1": 0.7, "M1": 0.9, "K1": 0.7, "M0": 0.7, ROOT: 0.9}
    assert rows[3]["matches"] == [] and rows[3]["total_weight"] == 0.0 and rows[1]["total_weight"] == 0.7 and rows[1]["model_name"] == "azimuth_x"
    with pytest.raises(ValueError):
        on.parse_ranked_labels(wide.select("cell_id"), terms)


@pytest.fixture
def cuts(monkeypatch):
    """How often lineage was cut."""
    seen = []
    real = on.cut_lineage
    monkeypatch.setattr(on, "cut_lineage", lambda df: seen.append(1) or real(df))
    return seen


def test_depths_of_a_chain_of_a_thousand_terms_take_ten_rounds(spark, cuts):
    names = [ROOT, *(f"n{i}" for i in range(1, 1000))]
    edges = graph(spark, *zip(names, names[1:]), (ROOT, "n500"))[0]
    depths = {r["term_id"]: (r["depth_short"], r["depth_long"]) for r in on.path_depths(edges).collect()}
    assert depths == {n: (i if i < 500 else i - 499, i) for i, n in enumerate(names)}
    assert len(cuts) <= 3 * 10 + 3


def test_closure_of_a_chain_takes_rounds_by_the_logarithm(spark, cuts):
    names = [f"n{i:03}" for i in range(120)]
    edges, terms = graph(spark, *zip(names, names[1:]))
    pairs = {(r["term_id"], r["ancestor_id"]) for r in on.ancestor_closure(edges, terms).collect()}
    assert pairs == {(b, a) for i, a in enumerate(names) for b in names[i:]}
    assert len(cuts) <= 2 * 7 + 3


def test_doubling_agrees_with_a_walk_on_random_graphs(spark):
    import random

    rng = random.Random(6)
    pairs = list({(min(a, b), max(a, b)) for a, b in ((rng.randrange(25), rng.randrange(25)) for _ in range(60)) if a != b})
    named = [(ROOT if a == 0 else f"t{a}", f"t{b}") for a, b in pairs]
    edges, terms = graph(spark, *named)
    children = {}
    for a, b in named:
        children.setdefault(a, set()).add(b)
    lengths, level = {}, {ROOT}
    for n in range(30):
        for t in level:
            lengths.setdefault(t, []).append(n)
        level = {c for t in level for c in children.get(t, ())}
    assert {r["term_id"]: (r["depth_short"], r["depth_long"]) for r in on.path_depths(edges).collect()} == {t: (min(x), max(x)) for t, x in lengths.items()}
    below = {t: {t} for t in {x for p in named for x in p}}
    for _ in range(25):
        for t in below:
            below[t] |= {d for c in children.get(t, ()) for d in below[c]}
    found = {(r["ancestor_id"], r["term_id"]) for r in on.ancestor_closure(edges, terms).collect()}
    assert found == {(t, d) for t, ds in below.items() for d in ds}
    some = on.ancestor_closure(edges, terms.where("term_id = 't20'"))
    assert {r["term_id"] for r in some.collect()} <= {"t20"}


def test_a_cycle_out_of_the_root_s_reach_is_no_error(spark):
    depths = on.path_depths(graph(spark, (ROOT, "a"), ("x", "y"), ("y", "x"))[0])
    assert {r["term_id"] for r in depths.collect()} == {ROOT, "a"}
