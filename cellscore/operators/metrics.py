"""Confusion matrices, flat and hierarchical F-measures, over many runs at once.

A confusion matrix is long: key columns (such as model_name, test_sample, k), true_label,
pred_label and n. All runs are rows of one table, so each metric is one job.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscore.functions import ratio
from cellscore.operators.ontology import ROOT
from cellscore.plans import Guard, cut_lineage, small_enough
from cellscore.plans.lineage import MOST_SMALL

#: The columns that metric tables are exchanged with.
COUNTS = ("tp", "fp", "fn")
METRICS = (
    "tp", "fp", "fn", "precision_micro", "recall_micro", "f1_micro", "f1_macro", "precision_macro", "recall_macro",
    "precision_weighted", "recall_weighted", "f1_weighted",
)


def labels_outside_universe(pairs: DataFrame, universe: DataFrame) -> DataFrame:
    """side (truth or prediction) and label of distinct labels that are not in universe (column label); null is the label nan."""
    one = lambda side, c: pairs.select(F.lit(side).alias("side"), F.coalesce(F.col(c), F.lit("nan")).alias("label")).distinct()
    return one("truth", "true_label").unionByName(one("prediction", "pred_label")).join(small_enough(universe.select("label")), "label", "left_anti").select("side", "label")


def _outside(pairs: DataFrame, universe: DataFrame) -> str:
    found = labels_outside_universe(pairs, universe).orderBy("side", "label").limit(10).collect()
    return "labels outside of the universe: " + ", ".join(f"{r['side']} {r['label']}" for r in found) if found else ""


def watch_universe(pairs: DataFrame, universe: DataFrame, columns: tuple[str, str] = ("true_label", "pred_label")) -> Guard:
    """pairs (with columns of the truth and the prediction) as a guard's frame: labels that are not in universe are seen as the rows pass.

    Its verify gives the error of in_universe. Labels are looked up in a broadcast, so that a hot one needs no shuffle; a universe beyond the
    bound of a broadcast is looked up by the distinct labels, in a job before.
    """
    explain = lambda: _outside(pairs.select(F.col(columns[0]).alias("true_label"), F.col(columns[1]).alias("pred_label")), universe)
    labels = universe.select("label").where("label is not null").distinct()
    if labels.limit(MOST_SMALL + 1).count() > MOST_SMALL:
        if text := explain():
            raise ValueError(text)
        return Guard(pairs, F.lit(False), explain)
    marked = pairs
    for i, c in enumerate(columns):
        known = labels.select(F.col("label").alias(f"_label_{i}"), F.lit(True).alias(f"_known_{i}"))
        marked = marked.join(F.broadcast(known), F.coalesce(marked[c], F.lit("nan")) == F.col(f"_label_{i}"), "left")
    guard = Guard(marked, F.col("_known_0").isNull() | F.col("_known_1").isNull(), explain)
    guard.frame = guard.frame.drop(*(f"{kind}_{i}" for kind in ("_label", "_known") for i in (0, 1)))
    return guard


def in_universe(pairs: DataFrame, universe: DataFrame, on_unknown: str = "error") -> DataFrame:
    """pairs with labels of the universe only: others are an error that names up to ten (one small job), or are dropped."""
    if on_unknown == "error":
        if text := _outside(pairs, universe):
            raise ValueError(text)
        return pairs
    for c in ("true_label", "pred_label"):
        pairs = pairs.join(small_enough(universe.select(F.col("label").alias(c))), c, "left_semi")
    return pairs


def confusion_matrix(pairs: DataFrame, keys: list[str], universe: DataFrame | None = None, on_unknown: str = "error") -> DataFrame:
    """n by keys, true_label and pred_label. With a universe (column label), other labels are an error, or are dropped."""
    if universe is not None:
        pairs = in_universe(pairs, universe, on_unknown)
    return pairs.groupBy(*keys, "true_label", "pred_label").agg(F.count("*").alias("n"))


def ranked_label_columns(inferred_label: str, top_k: int) -> list[str]:
    """prefix_1 to prefix_k from a name ending in _1; with k = 1, any name."""
    if top_k == 1:
        return [inferred_label]
    m = re.fullmatch(r"(.*)_1", inferred_label)
    if not m:
        raise ValueError(f"{inferred_label} must end in _1 for the first {top_k} ranks")
    return [f"{m[1]}_{i}" for i in range(1, top_k + 1)]


def effective_ranks(inferred_label: str, top_k: int, columns: list[str]) -> list[str]:
    """The ranked columns that exist without a gap from the first on."""
    found = []
    for c in ranked_label_columns(inferred_label, top_k):
        if c not in columns:
            break
        found.append(c)
    if not found:
        raise ValueError(f"no column {inferred_label}; there are {', '.join(columns)}")
    return found


def top_k_hit_predictions(pairs: DataFrame, ranked: list[str], top_k: int) -> DataFrame:
    """Each row of pairs (true_label and ranked columns) for k = 1 to top_k, with pred_label: the truth if it is in the first k, else the first."""
    hit = lambda k: F.exists(F.array(*ranked[:k]), lambda x: x.eqNullSafe(F.col("true_label")))
    each = F.array(*(F.struct(F.lit(k).alias("k"), F.when(hit(k), F.col("true_label")).otherwise(F.col(ranked[0])).alias("pred_label")) for k in range(1, top_k + 1)))
    return pairs.select(*[c for c in pairs.columns if c not in ranked], F.inline(each))


def join_truth_predictions(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """true_label (as text) and predictions, paired by cell_id."""
    return truth.select("cell_id", F.col("true_label").cast("string").alias("true_label")).join(predictions, "cell_id")


def confusion_metadata(confusion: DataFrame, universe: DataFrame, keys: list[str], order: str = "idx") -> DataFrame:
    """A row by keys: label_order (the universe's labels, by its column order) and matrix_size."""
    labels = universe.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), "label"))), lambda x: x["label"]).alias("label_order"))  # an ontology's labels
    return confusion.select(*keys).distinct().crossJoin(labels).withColumn("matrix_size", F.size("label_order"))


def aggregate_confusion(confusion: DataFrame, keys: list[str], metadata: DataFrame | None = None) -> DataFrame:
    """Confusion matrices added up by keys.

    metadata (keys, the columns that tell one matrix from another, label_order) guards the sum: no matrix at all, or matrices of a group with
    unlike label orders, are errors (one small job).
    """
    if metadata is not None:
        orders = metadata.groupBy(*keys).agg(F.count_distinct("label_order").alias("orders")).orderBy(*keys).collect()  # a row a group
        if not orders:
            raise ValueError("there is no confusion matrix to add up")
        unlike = [tuple(r[c] for c in keys) for r in orders if r["orders"] != 1]
        if unlike:
            raise ValueError(f"label orders differ within {unlike[:5]}")
    return confusion.groupBy(*keys, "true_label", "pred_label").agg(F.sum("n").alias("n"))


def aggregate_metadata(metadata: DataFrame, keys: list[str], source: str = "test_sample") -> DataFrame:
    """By keys: n_samples_aggregated, sources (a sorted list), label_order and matrix_size of the summed matrices."""
    return metadata.groupBy(*keys).agg(F.count("*").alias("n_samples_aggregated"), F.array_sort(F.collect_set(source)).alias("sources"), F.first("label_order").alias("label_order"), F.first("matrix_size").alias("matrix_size"))


def aggregate_confusion_custom(confusion: DataFrame, sets: list[list[str]]) -> DataFrame:
    """Sums over several groupings at once; a column that a grouping leaves out is null, and group_name tells the grouping."""
    every = list(dict.fromkeys(c for s in sets for c in s))
    grouped = confusion.groupingSets([[F.col(c) for c in [*s, "true_label", "pred_label"]] for s in sets], *every, "true_label", "pred_label").agg(F.sum("n").alias("n"), *(F.grouping(c).alias(f"_{c}") for c in every))
    name = F.concat_ws("+", *(F.when(F.col(f"_{c}") == 0, F.lit(c)) for c in every))
    return grouped.select(F.when(name == "", "all").otherwise(name).alias("group_name"), *every, "true_label", "pred_label", "n")


def _f1(precision: Column, recall: Column, zero: float) -> Column:
    """The harmonic mean; zero where both are 0. So with zero_division 1, no hit and no miss on one side still give a value."""
    return ratio(2 * precision * recall, precision + recall, zero)


def _summary(classes: DataFrame, keys: list[str], used: Column, zero: float, spine: DataFrame | None) -> DataFrame:
    """METRICS by keys from tp, fp and fn by class; macro over the used classes, weights are tp + fn."""
    tp, fp, fn = (F.col(c) for c in COUNTS)
    precision, recall = ratio(tp, tp + fp, zero), ratio(tp, tp + fn, zero)
    one = {"precision": precision, "recall": recall, "f1": _f1(precision, recall, zero)}
    support = tp + fn
    total = {c: F.coalesce(F.sum(c), F.lit(0)).cast("long") for c in COUNTS}
    classes = classes.withColumns(one).withColumns({"used": used, "support": support})
    aggs = [total[c].alias(c) for c in COUNTS]
    for m in one:
        aggs.append(F.coalesce(F.avg(F.when(F.col("used"), F.col(m))), F.lit(float(zero))).alias(f"{m}_macro"))
        aggs.append(ratio(F.sum(F.when(F.col("used"), F.col(m) * F.col("support"))), F.sum(F.when(F.col("used"), F.col("support"))), zero).alias(f"{m}_weighted"))
    found = classes.groupBy(*keys).agg(*aggs) if keys else classes.agg(*aggs)
    if spine is not None:
        found = spine.select(*keys).distinct().join(found, keys, "left")
        found = found.fillna(0, list(COUNTS)).fillna(float(zero))
    tp, fp, fn = (F.col(c) for c in COUNTS)
    precision, recall = ratio(tp, tp + fp, zero), ratio(tp, tp + fn, zero)
    micro = {"precision_micro": precision, "recall_micro": recall, "f1_micro": _f1(precision, recall, zero)}
    return found.withColumns(micro).select(*keys, *METRICS)


def f_measure(confusion: DataFrame, keys: list[str], zero_division: float = 0.0, spine: DataFrame | None = None) -> DataFrame:
    """METRICS by keys. Macro is over classes that occur on either side. spine gives keys that may have no pair at all."""
    side = lambda c, sign: confusion.select(*keys, F.col(c).alias("label"), F.when(F.col("true_label") == F.col("pred_label"), F.col("n")).otherwise(0).alias("hit"), F.col("n").alias("all"), F.lit(sign).alias("side"))
    both = side("true_label", "row").unionByName(side("pred_label", "column"))
    row, column = (F.coalesce(F.sum(F.when(F.col("side") == s, F.col("all"))), F.lit(0)) for s in ("row", "column"))
    hit = F.coalesce(F.sum(F.when(F.col("side") == "row", F.col("hit"))), F.lit(0))
    classes = both.groupBy(*keys, "label").agg(hit.alias("tp"), (column - hit).alias("fp"), (row - hit).alias("fn"))
    return _summary(classes, keys, F.col("tp") + F.col("fp") + F.col("fn") > 0, zero_division, spine)


def hierarchical_counts(confusion: DataFrame, closure: DataFrame, keys: list[str]) -> DataFrame:
    """tp, fp and fn by keys and node: over terms that are the label or an ancestor of it, without the root, of the truth and of the prediction."""
    sets = closure.where(F.col("ancestor_id") != ROOT).groupBy("term_id").agg(F.collect_set("ancestor_id").alias("up"))
    sets = small_enough(sets)  # counted once; the hint holds for both joins
    of = lambda c, name: sets.select(F.col("term_id").alias(c), F.col("up").alias(name))
    joined = confusion.join(of("true_label", "t"), "true_label", "left").join(of("pred_label", "p"), "pred_label", "left")
    t, p = (F.coalesce(c, F.array().cast("array<string>")) for c in ("t", "p"))
    tagged = F.concat(*(_tag(nodes, kind) for nodes, kind in ((F.array_intersect(t, p), "tp"), (F.array_except(p, t), "fp"), (F.array_except(t, p), "fn"))))
    each = joined.select(*keys, "n", F.inline(tagged))
    return each.groupBy(*keys, "node").agg(*(F.coalesce(F.sum(F.when(F.col("kind") == c, F.col("n"))), F.lit(0)).cast("long").alias(c) for c in COUNTS))


def _tag(nodes: Column, kind: str) -> Column:
    return F.transform(nodes, lambda x: F.struct(x.alias("node"), F.lit(kind).alias("kind")))


def hierarchical_f_measure(confusion: DataFrame, closure: DataFrame, keys: list[str], zero_division: float = 0.0, spine: DataFrame | None = None) -> DataFrame:
    """METRICS prefixed h_, by keys; macro and weighted over nodes that the truth supports."""
    nodes = hierarchical_counts(confusion, closure, keys)
    found = _summary(nodes, keys, F.col("tp") + F.col("fn") > 0, zero_division, spine)
    return found.select(*keys, *(F.col(m).alias(f"h_{m}") for m in METRICS))


def wide_by_k(metrics: DataFrame, keys: list[str], top_k: int) -> DataFrame:
    """A row by keys with metric_k1, metric_k2, ... from rows by keys and k."""
    columns = [F.max(F.when(F.col("k") == k, F.col(m))).alias(f"{m}_k{k}") for k in range(1, top_k + 1) for m in METRICS]
    return metrics.groupBy(*keys).agg(*columns)


def build_all_confusions(pairs: DataFrame, inferred_label: str, top_k: int, keys: list[str], universe: DataFrame | None = None, on_unknown: str = "error") -> DataFrame:
    """Confusion matrices of all runs (keys) for k = 1 to top_k, from true_label and ranked prediction columns.

    With a universe (column label), other labels are an error, or are dropped. A prediction is the truth or the first label, so
    those two are looked at.
    """
    ranked = effective_ranks(inferred_label, top_k, pairs.columns)
    spare = [c for c in pairs.columns if c not in {*keys, "true_label", *ranked}]
    if universe is not None:
        checked = in_universe(pairs.withColumn("pred_label", F.col(ranked[0])), universe, on_unknown)
        pairs = checked.select(*pairs.columns)
    return confusion_matrix(top_k_hit_predictions(pairs.drop(*spare), ranked, top_k), [*keys, "k"])


def watch_confusions(pairs: DataFrame, inferred_label: str, top_k: int, keys: list[str], universe: DataFrame) -> Guard:
    """build_all_confusions with its guard in the same pass: verify, after the matrices are written, gives its error."""
    first = effective_ranks(inferred_label, top_k, pairs.columns)[0]
    guard = watch_universe(pairs, universe, ("true_label", first))
    guard.frame = build_all_confusions(guard.frame, inferred_label, top_k, keys)
    return guard


def benchmark_pipeline(pairs: DataFrame, closure: DataFrame, inferred_label: str, top_k: int, universe: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four tables: flat and hierarchical, per sample and per group (model). The confusion matrices are worked out and written once, in one pass over pairs, labels outside of the universe included."""
    keys = ["model_name", "test_sample"]
    if universe is None:
        raw = cut_lineage(build_all_confusions(pairs, inferred_label, top_k, keys))
    else:
        guard = watch_confusions(pairs, inferred_label, top_k, keys, universe)
        raw = cut_lineage(guard.frame)
        guard.verify()
    metadata = confusion_metadata(raw, universe, ["model_name", "test_sample", "k"], "label") if universe is not None else None
    group = aggregate_confusion(raw, ["model_name", "k"], metadata).withColumnRenamed("model_name", "group_name")
    first, first_group = raw.where("k = 1").drop("k"), group.where("k = 1").drop("k")
    return {
        "f_measure_per_sample": wide_by_k(f_measure(raw, ["model_name", "test_sample", "k"]), ["model_name", "test_sample"], top_k),
        "f_measure_per_group": wide_by_k(f_measure(group, ["group_name", "k"]), ["group_name"], top_k),
        "hierarchical_per_sample": hierarchical_f_measure(first, closure, ["model_name", "test_sample"]),
        "hierarchical_per_group": hierarchical_f_measure(first_group, closure, ["group_name"]),
    }
