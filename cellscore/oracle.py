"""DuckDB SQL for the same tables, by query name. Common parts are views in front of each statement."""

from __future__ import annotations

from cellscore.fixtures import CHILDREN, COLORS, LONG, SHORT, TERMS


def _values(rows: list[tuple], names: str) -> str:
    return f"(select * from (values {', '.join(str(r) if len(r) > 1 else f'({r[0]!r})' for r in rows)}) t({names}))"


_ONTOLOGY = f"""
terms as {_values([(t, i, t.lower(), s, n) for i, (t, s, n) in enumerate(zip(TERMS, SHORT, LONG))], 'term_id, idx, label, depth_short, depth_long')},
edges as {_values([(p, c, i) for p, cs in CHILDREN.items() for i, c in enumerate(cs)], 'parent, child, child_ord')},
closure as (select term_id, term_id as ancestor_id from terms union select c.term_id, e.parent from closure c join edges e on e.child = c.ancestor_id)"""
_CELLS = """
q as (select vec_id as cell_id, cast(embedding as double[]) as e, 'c' || (vec_id % 7) as cluster, 'T' || label as truth from embeddings where vec_id % 5 = 0),
r as (select vec_id as cas_cell_index, cast(embedding as double[]) as e, 'T' || label as cell_type, 'ds' || (vec_id % 4) as dataset_id from embeddings where vec_id % 5 <> 0)"""
_NN = _CELLS + """,
nn as (select cell_id, cas_cell_index, cell_type, dataset_id, distance, rank from (
  select q.cell_id, r.cas_cell_index, r.cell_type, r.dataset_id, list_distance(q.e, r.e) as distance, row_number() over (partition by q.cell_id order by list_distance(q.e, r.e), r.cas_cell_index) as rank from q, r) where rank <= 10)"""
_K3 = _NN + """,
k3 as (select cell_id, cell_type, count(*) as cell_count, min(distance) as min_distance, quantile_cont(distance, 0.25) as p25_distance, median(distance) as median_distance, quantile_cont(distance, 0.75) as p75_distance, max(distance) as max_distance from nn group by all),
m as (select *, row_number() over (partition by cell_id order by cell_type) - 1 as pos from k3)"""
_K5 = _ONTOLOGY + "," + _NN + """,
w as (select nn.cell_id, nn.cell_type, case when md = 0 then 1.0 else exp(-distance / md) end as w, t.term_id is not null as known from nn join (select cell_id, median(distance) as md from nn group by 1) using (cell_id) left join (select term_id from terms where term_id <> 'T9') t on t.term_id = nn.cell_type),
tot as (select cell_id, sum(w) filter (where known) as total_weight, count(*) as total_neighbors, count(*) filter (where not known) as total_neighbors_unrecognized from w group by 1),
k5 as (select w.cell_id, c.ancestor_id as term_id, sum(w) / any_value(total_weight) as score from w join closure c on c.term_id = w.cell_type join tot using (cell_id) where known group by 1, 2 having sum(w) / any_value(total_weight) >= 0.05)"""
_AGG = """
g as (select cell_id, {grp} as grp from q),
dense as (select grp, cell_id, t.term_id, t.idx, coalesce(k5.score, 0) as score from g cross join terms t left join k5 using (cell_id, term_id)),
agg as (select grp, term_id, any_value(idx) as idx, avg(score) as mean_all, median(score) as median_all, coalesce(avg(score) filter (where score > 1e-4), 0) as mean_over, coalesce(median(score) filter (where score > 1e-4), 0) as median_over, avg((score > 1e-4)::int) as fraction from dense group by grp, term_id)"""
_VOTES = """,
wt as (select i, j, connectivity / sum(connectivity) over (partition by i) as weight from (select *, row_number() over (partition by i order by connectivity desc, j) as n from (select * from graph union all select distinct i, i, 1.0 from graph)) where n <= 10),
pr as (select cell_id, cell_type, cell_count / sum(cell_count) over (partition by cell_id) as prob from k3),
wp as (select i as cell_id, cell_type, sum(weight * prob) as prob from wt join pr on pr.cell_id = wt.j group by 1, 2),
vote as (select cell_id, cell_type, prob as confidence from wp qualify row_number() over (partition by cell_id order by round(prob, 9) desc, cell_type) = 1)"""
_GRAPH = _K3 + """,
graph as (select i, j, connectivity from (select a.cell_id as i, b.cell_id as j, 1 / (1 + list_distance(a.e, b.e)) as connectivity, row_number() over (partition by a.cell_id order by list_distance(a.e, b.e), b.cell_id) as n from q a join q b on a.cell_id <> b.cell_id) where n <= 10)""" + _VOTES
#: The fuzzy graph: sigma by bisection, round by round.
_FUZZY = _K3 + """,
n9 as (select * from (select a.cell_id as i, b.cell_id as j, list_distance(a.e, b.e) as d, row_number() over (partition by a.cell_id order by list_distance(a.e, b.e), b.cell_id) as n from q a join q b on a.cell_id <> b.cell_id) where n <= 9),
fr as (select i, list(d order by n) as ds, coalesce(min(d) filter (where d > 0), 0) as rho, sum(d) as s, count(*) + 1 as c from n9 group by i),
fb as (select i, ds, rho, 0.0::double as lo, 'inf'::double as hi, 1.0::double as mid, 0 as it from fr union all
  select i, ds, rho, case when tot > log2(10) then lo else mid end, case when tot > log2(10) then mid else hi end, case when tot > log2(10) then (lo + mid) / 2 when isinf(hi) then mid * 2 else (mid + hi) / 2 end, it + 1
  from (select *, list_sum(list_transform(ds, lambda x: exp(-greatest(x - rho, 0) / mid))) as tot from fb) where it < 64 and abs(tot - log2(10)) >= 1e-5),
fs as (select i, arg_max(mid, it) as mid from fb group by i),
sg as (select fr.i, rho, greatest(mid, 1e-3 * case when rho > 0 then s / c else (select sum(s) / sum(c) from fr) end) as sigma from fr join fs using (i)),
ww as (select i, j, case when d <= rho then 1.0 else exp(-(d - rho) / sigma) end as w from n9 join sg using (i)),
graph as (select i, j, sum(w) - case when count(*) = 2 then product(w) else 0 end as connectivity from (select i, j, w from ww union all select j, i, w from ww) group by 1, 2)""" + _VOTES
_MARKET = """
me as (select 'CL:0000000' as parent, 'R' || r_regionkey as child from region union all select 'R' || n_regionkey, 'N' || n_nationkey from nation union all select distinct 'CL:0000000', 'G' || c_mktsegment from customer union all select 'N' || c_nationkey, 'C' || c_custkey from customer union all select 'G' || c_mktsegment, 'C' || c_custkey from customer),
mn as (select child as t from me union select parent from me),
mc as (select t, t as a from mn union select mc.t, me.parent from mc join me on me.child = mc.a)"""
_COUNTS = """
raw as (select l_orderkey as cell_id, l_partkey as feature_id, sum(l_quantity) as v from lineitem group by 1, 2),
counts as (select cell_id, feature_id, 'X' as layer, v / 10 as value from raw union all select cell_id, feature_id, 'raw.X', v from raw),
fs as (select p_partkey as feature_id from part where p_size <= 40 union all select p_partkey + 1000000 from part where p_size <= 3)"""
_PRED = """
p as (select l_returnflag as model_name, l_linestatus as test_sample, 'T' || (l_partkey % 10) as t, 'T' || (l_suppkey % 10) as n1, 'T' || (l_linenumber % 10) as n2, 'M' || (l_partkey % 3) as n3 from lineitem),
hits as (select model_name, test_sample, 1 as k, t as true_label, n1 as pred_label from p union all select model_name, test_sample, 2, t, case when t in (n1, n2) then t else n1 end from p union all select model_name, test_sample, 3, t, case when t in (n1, n2, n3) then t else n1 end from p),
cm as (select model_name, test_sample, k, true_label, pred_label, count(*) as n from hits group by all)"""
_ORDERS = """
o as (select o_orderkey as cell_id, o_orderstatus as model_name, o_orderpriority as test_sample, 'T' || (o_custkey % 10) as t, 'T' || (o_orderkey % 10) as n1, 'M' || (o_custkey % 3) as n2 from orders),
hits as (select model_name, test_sample, 1 as k, t as true_label, n1 as pred_label from o union all select model_name, test_sample, 2, t, case when t in (n1, n2) then t else n1 end from o),
cm as (select model_name, test_sample, k, true_label, pred_label, count(*) as n from hits group by all)"""
_AZIMUTH = """
az as (select c_custkey as cell_id, r_name as l1, (c_acctbal + 1000) / 11000 as s1, case when c_custkey % 50 <> 0 then n_name end as l2, 1 - (c_acctbal + 1000) / 11000 as s2 from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
cw as (select r_name as source_label, 'M' || (r_regionkey % 3) as term_id from region union all select n_name, 'T' || (n_nationkey % 10) from nation where n_nationkey < 23),
lv as (select cell_id, 1 as rank, l2 as source_label, s2 as score from az union all select cell_id, 2, l1, s1 from az),
mp as (select lv.*, case when lv.source_label is not null then coalesce(cw.term_id, 'unknown') end as term_id from lv left join cw using (source_label)),
rk as (select cell_id, rank, term_id, coalesce(score, 0) as score from mp where term_id in (select term_id from terms)),
prop as (select cell_id, ancestor_id as term_id, greatest(max(score), 0) as score from rk join closure using (term_id) group by 1, 2),
resp as (select az.cell_id, p.term_id, p.score, coalesce(f.score, 0) as total_weight, 1 as total_neighbors, 0 as total_neighbors_unrecognized, 'azimuth_market' as model_name from az left join prop p using (cell_id) left join (select cell_id, arg_min(score, rank) as score from rk group by 1) f using (cell_id))"""
_RATIOS = "case when {a} > 0 then {b} / {a}::double else 0 end"


def _summary(classes: str, keys: str, used: str, prefix: str = "") -> str:
    """The twelve metrics by keys from tp, fp and fn by class."""
    r = lambda num, den: _RATIOS.format(a=f"({den})", b=f"({num})")
    one = {"precision": r("tp", "tp + fp"), "recall": r("tp", "tp + fn"), "f1": r("2 * tp", "2 * tp + fp + fn")}
    total = {"precision": r("sum(tp)", "sum(tp) + sum(fp)"), "recall": r("sum(tp)", "sum(tp) + sum(fn)"), "f1": r("2 * sum(tp)", "2 * sum(tp) + sum(fp) + sum(fn)")}
    columns = [f"sum({c})::bigint as {prefix}{c}" for c in ("tp", "fp", "fn")]
    columns += [f"round({x}, 9) as {prefix}{m}_micro" for m, x in total.items()]
    columns += [f"round(coalesce(avg({x}) filter (where {used}), 0), 9) as {prefix}{m}_macro" for m, x in one.items()]
    columns += [f"round(coalesce(sum(({x}) * (tp + fn)) filter (where {used}) / nullif(sum(tp + fn) filter (where {used}), 0), 0), 9) as {prefix}{m}_weighted" for m, x in one.items()]
    return f"select {keys}, {', '.join(columns)} from {classes} group by {keys}"


def _flat(source: str, keys: str) -> str:
    return f"""cls as (select {keys}, label, sum(hit)::bigint as tp, (sum(c) - sum(hit))::bigint as fp, (sum(rw) - sum(hit))::bigint as fn from (
  select {keys}, true_label as label, case when true_label = pred_label then n else 0 end as hit, n as rw, 0 as c from {source} union all select {keys}, pred_label, 0, 0, n from {source}) group by all)"""


def _nodes(source: str, keys: str) -> str:
    return f"""up as (select term_id, list(ancestor_id) as s from closure where ancestor_id <> 'CL:0000000' group by 1),
nd as (select {keys}, node, coalesce(sum(n) filter (where kind = 'tp'), 0)::bigint as tp, coalesce(sum(n) filter (where kind = 'fp'), 0)::bigint as fp, coalesce(sum(n) filter (where kind = 'fn'), 0)::bigint as fn from (
  select {keys}, n, unnest(list_intersect(t.s, p.s)) as node, 'tp' as kind from {source} join up t on t.term_id = true_label join up p on p.term_id = pred_label
  union all select {keys}, n, unnest(list_filter(p.s, lambda x: not list_contains(t.s, x))), 'fp' from {source} join up t on t.term_id = true_label join up p on p.term_id = pred_label
  union all select {keys}, n, unnest(list_filter(t.s, lambda x: not list_contains(p.s, x))), 'fn' from {source} join up t on t.term_id = true_label join up p on p.term_id = pred_label) group by all)"""


_FLAT_USED, _NODE_USED = "tp + fp + fn > 0", "tp + fn > 0"
_METRICS = ["tp", "fp", "fn", *(f"{m}_{k}" for k in ("micro", "macro", "weighted") for m in ("precision", "recall", "f1"))]


def _wide(source: str, keys: str, top_k: int) -> str:
    return f"select {keys}, " + ", ".join(f"max({m}) filter (where k = {k}) as {m}_k{k}" for k in range(1, top_k + 1) for m in _METRICS) + f" from {source} group by {keys}"


def _calls(source: str, key: str, prefix: str, k: int, depth: str = "depth_short", least: float = 0.2) -> str:
    """Wide top-k calls by key from source (key, term_id, score), for every key of gk."""
    pick = lambda c, i: f"coalesce(max({c}) filter (where n = {i}), {{}})"
    pads = {"label": ("label", "'ROOT'"), "name": ("term_id", "'CL:0000000'"), "score": ("score", "1.0")}
    columns = [f"{'round(' if name == 'score' else '('}{pick(c, i).format(pad)}{', 6)' if name == 'score' else ')'} as {prefix}_{name}_{i}" for name, (c, pad) in pads.items() for i in range(1, k + 1)]
    return f"select gk.{key}, {', '.join(columns)} from gk left join (select s.{key} as kk, s.term_id, s.score, t.label, row_number() over (partition by s.{key} order by t.{depth} desc, s.score desc, t.idx) as n from {source} s join terms t using (term_id) where s.score >= {least}) x on x.kk = gk.{key} group by gk.{key}"


def _with(*parts: str) -> str:
    return "with recursive " + ",\n".join(p.strip() for p in parts) + "\n"


_CLUSTER = _AGG.format(grp="cluster")
_ALL = _AGG.format(grp="'all'")
_CALLS = _with(_K5, _CLUSTER, f"single as ({_calls('k5', 'cell_id', 'cas_cell_type', 3).replace('gk.', 'q.').replace('from gk', 'from q')})", "cs as (select grp as cluster, term_id, mean_all as score from agg)", f"cl as ({_calls('cs', 'cluster', 'cas_cluster_type', 3).replace('from gk', 'from (select distinct cluster from q) gk')})")
_LABELS = _CALLS + "select single.*, cl.* exclude (cluster) from single join q using (cell_id) left join cl on cl.cluster = q.cluster"
_AGG_COLUMNS = "round(mean_all, 6) as mean_all, round(median_all, 6) as median_all, round(mean_over, 6) as mean_over, round(median_over, 6) as median_over, round(fraction, 6) as fraction"
_STATS = "round(min_distance, 6) as min_distance, round(p25_distance, 6) as p25_distance, round(median_distance, 6) as median_distance, round(p75_distance, 6) as p75_distance, round(max_distance, 6) as max_distance"
_RESPONSE = "select cell_id, term_id, lower(term_id) as label, round(score, 6) as score, round(total_weight, 6) as total_weight, total_neighbors, total_neighbors_unrecognized, model_name from resp"
_MATRIX = _with(_COUNTS) + "select cell_id, feature_id, value from counts where layer = 'raw.X'"
_SAMPLES = _with(_ORDERS, _flat("cm", "model_name, test_sample, k"), f"mt as ({_summary('cls', 'model_name, test_sample, k', _FLAT_USED)})")
_HEX = ", ".join(f"('T{i}', {int(c[1:3], 16)}, {int(c[3:5], 16)}, {int(c[5:7], 16)})" for i, c in enumerate(COLORS[:9]))

SQL: dict[str, str] = {
    # neighbours
    "k1_knn_search": _with(_NN) + "select cell_id, cas_cell_index, round(distance, 6) as distance, rank::int as rank from nn",
    "k3_neighbor_summary_stats": _with(_K3) + f"select cell_id, cell_type, cell_count, {_STATS} from k3",
    "k4_neighbor_dataset_stats": _with(_NN) + "select cell_id, cell_type, dataset_id, count(*) as count_per_dataset, round(min(distance), 6) as min_distance, round(max(distance), 6) as max_distance, round(median(distance), 6) as median_distance, round(avg(distance), 6) as mean_distance from nn group by 1, 2, 3",
    "k5_ontology_aware_scores": _with(_K5) + "select cell_id, term_id, label, round(score, 6) as score, round(total_weight, 6) as total_weight, total_neighbors, total_neighbors_unrecognized from k5 join tot using (cell_id) join terms using (term_id)",
    "k6_align_results_to_query": _with(_K3) + "select q.cell_id, q.cell_id as pos, count(k3.cell_id)::int as n_matches, count(k3.cell_id) = 0 and q.cell_id % 2 <> 0 as unprocessed from q left join (select * from k3 where cell_id % 3 <> 0) k3 using (cell_id) group by 1",
    "k7_query_cells_by_ids": "select c_custkey as cas_cell_index, c_mktsegment as tissue, case when c_acctbal >= 0 then 'd' || c_nationkey end as disease from customer where c_custkey in (select o_custkey from orders where o_totalprice > 300000)",
    "k7_query_store_by_ids": "select c_custkey as cas_cell_index, c_mktsegment as tissue, case when c_acctbal >= 0 then 'd' || c_nationkey end as disease from customer where c_custkey in (select o_custkey from (select * from orders order by o_totalprice desc, o_orderkey limit 50))",
    "k8_drop_null_fields": "select c_custkey as cas_cell_index, concat_ws(';', case when c_acctbal >= 0 then 'disease' end, 'donor_id', 'tissue', 'total_mrna_umis') as names, c_mktsegment as tissue, c_name as donor_id, case when c_acctbal >= 0 then 'd' || c_nationkey end as disease, floor(c_acctbal)::bigint as total_mrna_umis from customer",
    # reducers
    "r1_majority_vote": _with(_K3) + "select cell_id, cell_type, round(cell_count / total, 6) as confidence from (select *, sum(cell_count) over (partition by cell_id) as total, row_number() over (partition by cell_id order by cell_count desc, pos) as n from m) where n = 1",
    "r2_min_distance_vote": _with(_K3) + "select cell_id, cell_type, round(min_distance, 6) as min_distance from m qualify row_number() over (partition by cell_id order by min_distance, pos) = 1",
    "r3_cluster_majority_vote": _with(_K3, "d as (select cluster, cell_type, sum(cell_count) as s, min(cell_id * 1000 + pos) as f from m join q using (cell_id) where cell_type <> 'T0' group by 1, 2)", "b as (select cluster, cell_type, s / sum(s) over (partition by cluster) as confidence from d qualify row_number() over (partition by cluster order by s desc, f) = 1)") + "select cell_id, cell_type, round(confidence, 6) as confidence from q left join b using (cluster)",
    "r4_cluster_vote_detail": _with(_K3, "d as (select cluster, cell_type, sum(cell_count) as s, min(cell_id * 1000 + pos) as f from m join q using (cell_id) where cell_type <> 'T0' group by 1, 2)") + "select cluster, cell_type, round(s / sum(s) over (partition by cluster), 6) as frequency, (row_number() over (partition by cluster order by s desc, f))::int as rank from d",
    "r5_wnn_weights": _with(_GRAPH) + "select i, j, round(weight, 6) as weight from wt",
    "r6_cell_type_probs": _with(_GRAPH) + "select cell_id, cell_type, round(prob, 6) as prob from pr",
    "r5_fuzzy_connectivities": _with(_FUZZY) + "select i, j, round(connectivity, 6) as connectivity from graph",
    "r7_fuzzy_wnn_vote": _with(_FUZZY) + "select cell_id, cell_type, round(confidence, 6) as confidence from vote",
    "r7_wnn_vote": _with(_GRAPH) + "select cell_id, cell_type, round(confidence, 6) as confidence from vote",
    "r8_relabel_rare_types": _with(_GRAPH) + "select cell_id, case when count(*) over (partition by cell_type) < 10 then 'Unknown or Unconfident' else cell_type end as cell_type, round(confidence, 6) as confidence from vote",
    "r9_interpolate_type_colors": _with(_GRAPH) + f"select cell_id, round(least(greatest(sum(prob * coalesce(r, 255)) / 255, 0), 1), 6) as r, round(least(greatest(sum(prob * coalesce(g, 255)) / 255, 0), 1), 6) as g, round(least(greatest(sum(prob * coalesce(b, 255)) / 255, 0), 1), 6) as b from wp left join (values {_HEX}) h(cell_type, r, g, b) using (cell_type) group by 1",
    # ontology
    "o1_parents_map": _with(_MARKET) + "select distinct child, parent from me",
    "o2_ancestor_closure": _with(_MARKET) + "select t as term_id, a as ancestor_id from mc",
    "o3_descendant_closure": _with(_MARKET) + "select a as term_id, t as descendant_id from mc",
    "o4_get_ancestors": _with(_MARKET, "ask as (select distinct 'C' || o_custkey as t from orders union all select 'X' || s_suppkey from supplier)") + "select ask.t as term_id, coalesce(string_agg(mc.a, ',' order by mc.a), '') as ancestors from ask left join mc on mc.t = ask.t and mc.a not in ('CL:0000000', ask.t) where ask.t in (select t from mn) group by 1 union all select t, '' from ask where t not in (select t from mn)",
    "o5_get_descendants": _with(_MARKET, "ask as (select distinct 'N' || s_nationkey as t from supplier union all select 'R' || r_regionkey from region union all select 'Y' || s_suppkey from supplier)") + "select ask.t as term_id, coalesce(string_agg(mc.t, ',' order by mc.t), ask.t) as descendants from ask left join mc on mc.a = ask.t group by ask.t",
    "o5_descendant_pages": _with(_MARKET, "ask as (select distinct 'N' || s_nationkey as t from supplier union all select 'R' || r_regionkey from region), pl as (select t, row_number() over (order by t) as place from (select distinct t from mn))") + "select ask.t as term_id, (1 + (place - 1) // 32768)::bigint as page, count(*)::bigint as n from ask join mc on mc.a = ask.t join pl on pl.t = mc.t group by 1, 2",
    "o6_path_depths": _with(_MARKET, "lv as (select 'CL:0000000' as t, 0 as l union select me.child, l + 1 from lv join me on me.parent = lv.t)") + "select t as term_id, min(l)::int as depth_short, max(l)::int as depth_long from lv group by 1",
    "o7_linearity_violations": _with(_ONTOLOGY, _AZIMUTH, "pr as (select distinct term_id as finer, lead(term_id) over (partition by cell_id order by rank) as coarser from rk)") + "select finer, coarser from pr where coarser is not null and not exists (select 1 from closure c where c.term_id = finer and c.ancestor_id = coarser)",
    "o8_propagate_scores_max": _with(_ONTOLOGY, _AZIMUTH) + "select cell_id, term_id, round(score, 6) as score from prop",
    "o9_parse_ranked_labels": _with(_ONTOLOGY, _AZIMUTH) + "select cell_id, rank, term_id, round(score, 6) as score from rk",
    "o10_build_ontology_response": _with(_ONTOLOGY, _AZIMUTH) + _RESPONSE,
    # scores
    "a1_score_matrix": _with(_K5) + "select cell_id, term_id, idx, round(case when cell_id % 2 = 0 then 2 * score else score end, 6) as score from k5 join terms using (term_id)",
    "a2_attach_scores": _with(_K5) + "select cell_id, term_id, idx, label, round(score, 6) as score, 'market' as resource_name from k5 join terms using (term_id)",
    "a3_fraction_over_threshold": _with(_K5, _ALL) + "select term_id, round(fraction, 6) as fraction from agg",
    "a4_aggregate_scores": _with(_K5, _ALL) + f"select grp, term_id, idx, {_AGG_COLUMNS} from agg",
    "a5_aggregate_scores_by_cluster": _with(_K5, _CLUSTER) + f"select grp, term_id, idx, {_AGG_COLUMNS} from agg",
    "a6_most_granular_top_k": _with(_K5, _CLUSTER) + "select grp, rank::int as rank, round(coalesce(score, 1), 6) as score, coalesce(depth, 0) as depth, coalesce(term_id, 'CL:0000000') as term_id, coalesce(label, 'ROOT') as label from (select distinct grp from agg) cross join (values (1), (2), (3), (4), (5)) v(rank) left join (select grp, mean_over as score, depth_long as depth, term_id, label, row_number() over (partition by grp order by depth_long desc, mean_over desc, terms.idx) as rank from agg join terms using (term_id) where mean_over >= 0.3) x using (grp, rank)",
    "a7_top_k_calls_single": _CALLS + "select * from single",
    "a8_rooted_score_tree": _with(_K5, _ALL, "ok as (select term_id, mean_over as score, fraction from agg where mean_over > 0.05 and fraction > 0.01)", "tree as (select term_id as path, '' as ord, term_id, null::varchar as parent, 0 as depth, score, fraction from ok where term_id = 'CL:0000000' union all select tree.path || '/' || ok.term_id, tree.ord || case when tree.ord = '' then '' else ',' end || edges.child_ord, ok.term_id, tree.term_id, depth + 1, ok.score, ok.fraction from tree join edges on edges.parent = tree.term_id join ok on ok.term_id = edges.child)") + "select path, ord, term_id, parent, depth, round(score, 6) as score, round(fraction, 6) as fraction from tree",
    "a9_top_k_calls_cluster": _CALLS + "select q.cell_id, cl.* exclude (cluster) from q left join cl on cl.cluster = q.cluster",
    "a10_term_score_opacity": _with(_K5, "s as (select q.cell_id, coalesce(score, 0) as score from q left join (select * from k5 where term_id = 'M1') k using (cell_id))") + "select cell_id, round(score, 6) as score, round(greatest(score, 0.1 + 0.9 * (score - min(score) over ()) / (1e-6 + max(score) over () - min(score) over ())), 6) as opacity from s",
    "a10_term_opacity_from_store": _with(_K5, "s as (select q.cell_id, coalesce(score, 0) as score from q left join (select * from k5 where term_id = 'M1') k using (cell_id))") + "select cell_id, round(score, 6) as score, round(greatest(score, 0.1 + 0.9 * (score - min(score) over ()) / (1e-6 + max(score) over () - min(score) over ())), 6) as opacity from s",
    "a11_padded_bounds": "select round(min(x) - 0.05 * (max(x) - min(x)), 6) as x_min, round(max(x) + 0.05 * (max(x) - min(x)), 6) as x_max, round(min(y) - 0.05 * (max(y) - min(y)), 6) as y_min, round(max(y) + 0.05 * (max(y) - min(y)), 6) as y_max from (select embedding[1]::double as x, embedding[2]::double as y from embeddings)",
    "a12_inferred_labels": _LABELS,
    "a13_annotate_pipeline": _LABELS,
    # crosswalk
    "z1_align_predictions": _with(_ONTOLOGY, _AZIMUTH) + "select cell_id, cell_id as pos, l1, l2, round(s1, 6) as s1, round(s2, 6) as s2 from az where cell_id % 2 = 0",
    "z3_crosswalk_labels": _with(_ONTOLOGY, _AZIMUTH) + "select cell_id, rank, source_label, term_id, lower(term_id) as term_label, round(score, 6) as score from mp",
    "z4_crosswalk_wide": _with(_ONTOLOGY, _AZIMUTH) + "select a.cell_id, lower(a.term_id) as cas_cell_type_label_1, lower(b.term_id) as cas_cell_type_label_2, a.term_id as cas_cell_type_name_1, b.term_id as cas_cell_type_name_2, round(a.score, 6) as cas_cell_type_score_1, round(b.score, 6) as cas_cell_type_score_2 from mp a join mp b on a.cell_id = b.cell_id and a.rank = 1 and b.rank = 2",
    "z5_unmapped_label_report": _with(_ONTOLOGY, _AZIMUTH) + "select distinct 'label' as kind, source_label as value from lv where source_label is not null and source_label not in (select source_label from cw) union all select distinct 'term', term_id from cw where term_id not in (select term_id from terms)",
    "z6_crosswalk_pipeline": _with(_ONTOLOGY, _AZIMUTH) + _RESPONSE,
    # metrics
    "b1_labels_outside_universe": _with(_PRED) + "select distinct 'truth' as side, t as label from p where t in ('T8', 'T9') union all select distinct 'prediction', n1 from p where n1 in ('T8', 'T9')",
    "b2_confusion_matrix": _with(_PRED) + "select model_name, test_sample, true_label, pred_label, n from cm where k = 1",
    "b5_top_k_hit_predictions": _with(_PRED) + "select model_name, test_sample, k, true_label, pred_label, n from cm",
    "b6_join_truth_predictions": _with(_ORDERS) + "select cell_id, t as true_label, model_name, test_sample, n1 as name_1, n2 as name_2 from o",
    "b7_aggregate_confusion": _with(_PRED) + "select model_name, k, true_label, pred_label, sum(n)::bigint as n, (select count(distinct test_sample) from cm c where c.model_name = cm.model_name and c.k = cm.k) as n_samples_aggregated from cm group by all",
    "s10_run_store": _with(_PRED) + "select model_name, k, true_label, pred_label, sum(n)::bigint as n from cm group by all",
    "b8_aggregate_confusion_custom": _with(_PRED) + "select case when grouping(model_name) = 0 then 'model_name+k' when grouping(test_sample) = 0 then 'k+test_sample' else 'k' end as group_name, model_name, test_sample, k, true_label, pred_label, sum(n)::bigint as n from cm group by grouping sets ((model_name, k, true_label, pred_label), (test_sample, k, true_label, pred_label), (k, true_label, pred_label))",
    "b9_f_measure": _with(_PRED, _flat("cm", "model_name, k")) + _summary("cls", "model_name, k", _FLAT_USED),
    "b10_hierarchical_counts": _with(_ONTOLOGY, _PRED, _nodes("cm", "model_name, k")) + "select model_name, k, node, tp, fp, fn from nd",
    "b10_pair_overlaps": _with(_ONTOLOGY, _PRED, _nodes("cm", "model_name, k")) + "select model_name, k, sum(tp)::bigint as tp, sum(fp)::bigint as fp, sum(fn)::bigint as fn from nd group by 1, 2",
    "b11_hierarchical_f_measure": _with(_ONTOLOGY, _PRED, _nodes("cm", "model_name, k")) + _summary("nd", "model_name, k", _NODE_USED, "h_"),
    "b12_f_measure_per_sample": _with(_PRED, _flat("cm", "model_name, test_sample, k"), f"mt as ({_summary('cls', 'model_name, test_sample, k', _FLAT_USED)})") + _wide("mt", "model_name, test_sample", 3),
    "b13_f_measure_per_group": _with(_PRED, "gm as (select model_name as group_name, k, true_label, pred_label, sum(n) as n from cm group by all)", _flat("gm", "group_name, k"), f"mt as ({_summary('cls', 'group_name, k', _FLAT_USED)})") + _wide("mt", "group_name", 3),
    "b14_hierarchical_per_sample": _with(_ONTOLOGY, _PRED, "c1 as (select * from cm where k = 1)", _nodes("c1", "model_name, test_sample")) + _summary("nd", "model_name, test_sample", _NODE_USED, "h_"),
    "b14_hierarchical_per_group": _with(_ONTOLOGY, _PRED, "c1 as (select model_name as group_name, true_label, pred_label, n from cm where k = 1)", _nodes("c1", "group_name")) + _summary("nd", "group_name", _NODE_USED, "h_"),
    "b15_build_all_confusions": _with(_ORDERS) + "select model_name, test_sample, k, true_label, pred_label, n from cm",
    "b16_benchmark_pipeline": _SAMPLES + _wide("mt", "model_name, test_sample", 2),
    # preprocessing
    "p1_select_count_layer": _with(_COUNTS) + "select cell_id, feature_id, value from counts where layer = 'raw.X'",
    "p2_cast_counts_float32": _with(_COUNTS) + "select cell_id, feature_id, layer, round(case when layer = 'X' then value::float::double else value end, 9) as value from counts",
    "p3_total_mrna_umis": _with(_COUNTS) + "select o_orderkey as cell_id, coalesce(round(s, 6), 0) as total_mrna_umis from orders left join (select cell_id, sum(value) as s from counts where layer = 'X' group by 1) on cell_id = o_orderkey",
    "p4_pre_sanitize": _with(_COUNTS) + "select o_orderkey as cell_id, coalesce(round(s, 6), 0) as total_mrna_umis from orders left join (select cell_id, sum(value::float::double) as s from counts where layer = 'X' group by 1) on cell_id = o_orderkey",
    "p6_validate_features": _with(_COUNTS) + "select false as conforms, (select count(*) from fs where feature_id not in (select p_partkey from part)) as missing, (select count(*) from part where p_partkey not in (select feature_id from fs)) as extra",
    "p7_sanitize_counts": _with(_COUNTS) + "select cell_id, feature_id as pos, feature_id, value from counts join fs using (feature_id) where layer = 'raw.X'",
    "p8_map_feature_names": _with(_COUNTS) + "select fs.feature_id as pos, fs.feature_id, coalesce(p_name, 'N/A') as feature_name from fs left join part on p_partkey = fs.feature_id",
    "p9_sparse_rows": _with(_COUNTS) + "select o_orderkey as cell_id, (select count(*) from fs)::int as size, coalesce(string_agg(feature_id, ',' order by feature_id), '') as indices, coalesce(string_agg(value::bigint, ',' order by feature_id), '') as \"values\" from orders left join (select counts.* from counts join fs using (feature_id) where layer = 'raw.X') c on c.cell_id = o_orderkey group by 1",
    "p10_validate_and_sanitize": _with(_COUNTS) + "select cell_id, feature_id as pos, feature_id, round(value::float::double, 6) as value from counts join fs using (feature_id) where layer = 'X'",
    # sources: what was written is read again
    "s1_read_10x_mex": _MATRIX,
    "s2_counts_parquet": _with(_COUNTS) + "select cell_id, feature_id, layer, value from counts",
    "s3_write_10x_mex": "select p_partkey as feature_id, p_name as feature_name, p_partkey as pos from part",
    "s4_read_ontology_resource": _with(_MARKET, "lv as (select 'CL:0000000' as t, 0 as l union select me.child, l + 1 from lv join me on me.parent = lv.t)") + "select t as term_id, (row_number() over (order by t) - 1)::bigint as idx, lower(t) as label, min(l)::int as depth_short, max(l)::int as depth_long from lv group by 1",
    "s5_write_ontology_resource": _with(_MARKET) + "select parent, child, (row_number() over (partition by parent order by child) - 1)::int as child_ord from me",
    "s6_ontology_response_json": _with(_K5) + "select cell_id, count(*)::int as n_matches, round(sum(score), 6) as score, round(any_value(total_weight), 6) as total_weight, any_value(total_neighbors)::int as total_neighbors, any_value(total_neighbors_unrecognized)::int as total_neighbors_unrecognized from k5 join tot using (cell_id) group by 1",
    "s7_inferred_labels_csv": _CALLS + "select * from single",
    "s8_run_metadata_json": "select o_orderstatus as input_path, o_orderpriority as model_name, count(*) as n_cells, 'market' as ontology_resource_name from orders group by 1, 2",
    "s9_collect_runs": "select distinct 'run_' || o_orderstatus as run_id from orders",
    "s10_confusion_store": _with(_PRED) + f"select model_name, test_sample, k, true_label, pred_label, n, {len(TERMS)} as matrix_size from cm",
    "s11_metrics_csv": _with(_PRED, _flat("cm", "model_name, k")) + _summary("cls", "model_name, k", _FLAT_USED),
    "s12_read_predictions_csv": _with(_ONTOLOGY, _AZIMUTH) + "select cell_id, l1, l2, round(s1, 6) as s1, round(s2, 6) as s2 from az",
}
