"""Hard negatives by slot-decomposed selection.

A row's score is its integer inner product with an anchor. An anchor's positives are its first rows of the same label. The
negatives of a positive are the first rows of other labels whose scores lie in a window below its own: from
LEAST to MOST hundredths of it. The windows of an anchor's positives overlap; their upper limits, in descending order,
split the scores into disjoint slots. Each task keeps the first k of each slot, so do the combiners, and
one descending merge of suffixes answers all windows: what is allowed for a positive is in its own slot or in a later one, and those below its
lower limit come last. So no window is searched by itself.

Anchors and rows are dealt to the cells of a grid, of bounded bytes each, by their place in the table and not by
label, so that no label, id or group of copies meets in one task; a cell yields k rows an anchor and slot at most.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part; a null id is no anchor
and comes after all other ids of its score; repeated rows and ids are rows of their own, each repeated anchor included; equal
scores go by smaller id, equal ids by place in the input; a positive with a negative score has no negatives, as its window
is empty; an empty table gives no row; other columns are ignored, whatever their names; vectors of different lengths, and
scores too large to be exact as doubles (2^53 with a row's place in its block), are errors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellscore.plans import cut_lineage

#: Bytes of vectors (8 a component) of one cell of the grid: of anchors, and of rows.
ANCHOR_BYTES, ROW_BYTES = 1 << 24, 1 << 26
#: Anchors and rows that are multiplied at once.
ANCHORS, ROWS = 256, 4096
#: Hundredths of a positive's score between which a negative's lies.
LEAST, MOST = 30, 90


def _matrix(batch: pa.RecordBatch | pa.Table, column: str) -> np.ndarray:
    """A column of equally long lists of longs as doubles."""
    lists = batch.column(column)
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)


def _step(a: np.ndarray, b: np.ndarray) -> int:
    """Rows that may be compared at once so that a score with a place among them is exact as a double."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    step = ROWS
    while step > 1 and (bound + 1) * step >= 2**53:
        step //= 2
    if (bound + 1) * step >= 2**53:
        raise OverflowError("scores of 2^53 or more aren't exact")
    return step


def _first(keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k greatest keys of each row, without those of minus infinity."""
    if keys.shape[1] > k:
        columns = np.argpartition(keys, keys.shape[1] - k, axis=1)[:, -k:]
    else:
        columns = np.broadcast_to(np.arange(keys.shape[1]), keys.shape)
    found = np.take_along_axis(keys, columns, axis=1) > -np.inf
    return np.nonzero(found)[0], columns[found]


def _kept(groups: np.ndarray, scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Indices of the first k of each group, by descending score and then place."""
    order = np.lexsort((places, -scores, groups))
    sorted_ = groups[order]
    return order[np.arange(len(order)) - np.searchsorted(sorted_, sorted_, side="left") < k]


def best(a: np.ndarray, b: np.ndarray, k: int, slots: int, slot_of) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, slot, row and score of the first k rows of b for each row of a in each slot; rows stand in the order that breaks ties.

    slot_of(i, j, scores) gives the slots of the scores of a[i] and b[j] (slices), from 0; other numbers are no slot.
    """
    step, out = _step(a, b), []
    for i in range(0, len(a), ANCHORS):
        x = slice(i, min(i + ANCHORS, len(a)))
        group, place, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for j in range(0, len(b), step):
            y = slice(j, min(j + step, len(b)))
            scores = a[x] @ b[y].T
            slot = slot_of(x, y, scores)
            keys = scores * step + (step - 1 - np.arange(y.stop - y.start))
            for s in range(slots):
                row, column = _first(np.where(slot == s, keys, -np.inf), k)
                group, place, score = np.concatenate([group, row * slots + s]), np.concatenate([place, column + j]), np.concatenate([score, scores[row, column]])
            if len(group) > 4 * ANCHORS * slots * k:
                kept = _kept(group, score, place, k)
                group, place, score = group[kept], place[kept], score[kept]
        kept = _kept(group, score, place, k)
        out.append((group[kept] // slots + i, group[kept] % slots, place[kept], score[kept].astype(np.int64)))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else tuple(np.zeros(0, np.int64) for _ in range(4))


def _grid(anchors: DataFrame, rows: DataFrame, bytes_a: int, bytes_b: int, limits: str, slots: int, k: int, slots_of) -> DataFrame:
    """anchor, slot, score, other_id and other (row): the first k rows by slot of each anchor within a cell of the grid.

    slots_of(anchor labels, anchor limits, row labels) gives best's slot_of; a row's own anchor has no slot.
    """
    na, nb = (max(1, -(-x // most)) for x, most in ((bytes_a, ANCHOR_BYTES), (bytes_b, ROW_BYTES)))
    # small tables have as many cells as the session has partitions
    nb = max(nb, min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-bytes_b // (1 << 20))))
    part = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.select("row", "label", "x", limits).withColumn("i", part(na)).withColumn("j", every(nb)).groupBy("i", "j")
    # the two sides are of one table: the names of one are new
    right = rows.withColumn("q", part(nb)).withColumn("p", every(na)).select(*(F.col(c).alias(f"other_{c}") for c in ("row", "id", "label", "x")), "p", "q").groupBy("p", "q")
    schema = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("other_id", pa.int64()), ("other", pa.int64())])

    def compare(l: pa.Table, r: pa.Table) -> pa.Table:
        if not l.num_rows or not r.num_rows:
            return schema.empty_table()
        r = r.sort_by([("other_id", "ascending"), ("other_row", "ascending")])  # nulls last
        a, b = _matrix(l, "x"), _matrix(r, "other_x")
        own, other = l.column("row").to_numpy(), r.column("other_row").to_numpy()
        inner = slots_of(l.column("label").to_numpy(), l.column(limits).to_pylist(), r.column("other_label").to_numpy())

        def slot_of(i: slice, j: slice, scores: np.ndarray) -> np.ndarray:
            return np.where(own[i][:, None] == other[j][None, :], -1, inner(i, j, scores))

        anchor, slot, place, score = best(a, b, k, slots, slot_of)
        return pa.Table.from_arrays([pa.array(own[anchor]), pa.array(slot.astype(np.int32)), pa.array(score), r.column("other_id").take(pa.array(place)).combine_chunks(), pa.array(other[place])], schema=schema)

    ddl = "anchor long, slot int, score long, other_id long, other long"
    return left.cogroup(right).applyInArrow(compare, ddl)


def _same_label(labels: np.ndarray, _limits: list, others: np.ndarray):
    return lambda i, j, scores: np.where(labels[i][:, None] == others[j][None, :], 0, -1)


def _windows(labels: np.ndarray, limits: list, others: np.ndarray):
    """Slots by upper limits; limits holds the positives' scores in descending order."""
    width = max(map(len, limits))
    p = np.array([x + [None] * (width - len(x)) for x in limits], dtype=float)  # absent ones compare as false
    upper, lower = np.floor(p * MOST / 100), np.ceil(p * LEAST / 100)

    def slot_of(i: slice, j: slice, scores: np.ndarray) -> np.ndarray:
        slot = np.full(scores.shape, -1, np.int8)
        for s in range(width):  # the last limit that a score is within tells its slot; all positives up to there allow what is over this one's lower limit
            within = scores <= upper[i, s][:, None]
            slot = np.where(within, np.where(scores >= lower[i, s][:, None], np.int8(s), np.int8(-1)), slot)
        return np.where(labels[i][:, None] != others[j][None, :], slot, np.int8(-1))

    return slot_of


def _ranked(found: DataFrame, by: list[str], k: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("other_id").asc_nulls_last(), "other")
    return found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows has id (long), label (long) and x (array of longs); is_anchor is a condition on them. They are written once,
    to the shared folder, so that a row's number is fixed.
    """
    kept = cut_lineage(rows.where(F.col("x").isNotNull() & F.col("label").isNotNull()).withColumn("row", F.monotonically_increasing_id()).withColumn("anchor", F.coalesce(is_anchor, F.lit(False))))
    n, n_anchors, width, least = kept.agg(F.count("*"), F.count_if("anchor"), F.coalesce(F.max(F.size("x")), F.lit(0)), F.coalesce(F.min(F.size("x")), F.lit(0))).first()
    if width != least:
        raise ValueError(f"vectors have {least} to {width} components")
    size = lambda count: 8 * count * max(1, width)
    anchors = kept.where("anchor").withColumn("none", F.array().cast("array<long>"))
    near = _grid(anchors, kept, size(n_anchors), size(n), "none", 1, positives, _same_label)
    near = cut_lineage(_ranked(near, ["anchor"], positives, "nth").select("anchor", "nth", "score", "other_id"))
    chosen = near.groupBy(F.col("anchor").alias("row")).agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "score"))), lambda p: p["score"]).alias("limits"), F.array_sort(F.collect_list(F.struct("nth", "score", "other_id"))).alias("near"))
    # at most so many values an anchor
    limited = anchors.join(chosen, "row")
    found = _ranked(_grid(limited, kept, size(n_anchors), size(n), "limits", positives, negatives, _windows), ["anchor", "slot"], negatives, "nth")
    slots = found.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("slot", (-F.col("score")).alias("down"), F.col("other_id").isNull().alias("no_id"), "other_id", "other")).alias("all"))
    merged = limited.select("row", "id", "near").join(slots, "row")
    below = lambda s: F.transform(F.filter("all", lambda c: c["slot"] == s), lambda c: F.struct(*(c[f].alias(f) for f in ("down", "no_id", "other_id", "other"))))
    for s in reversed(range(positives)):  # a slot's own first, with those of all slots that lie lower
        lower = below(s) if s == positives - 1 else F.concat(below(s), F.col(f"from_{s + 1}"))
        merged = merged.withColumn(f"from_{s}", F.slice(F.array_sort(lower), 1, negatives))
    each = merged.select(F.col("id").alias("anchor_id"), F.inline(F.arrays_zip(F.col("near"), F.array(*(F.col(f"from_{s}") for s in range(positives))).alias("below"))))
    windows = each.where(F.col("near").isNotNull()).select("anchor_id", F.col("near.other_id").alias("positive_id"), F.col("near.score").alias("positive_score"), F.filter("below", lambda c: -100 * c["down"] >= LEAST * F.col("near.score")).alias("below"))
    return windows.select("anchor_id", "positive_id", "positive_score", F.posexplode("below").alias("i", "c")).select(
        "anchor_id", "positive_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("c.other_id").alias("negative_id"), "positive_score", (-F.col("c.down")).alias("negative_score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: hard negatives of every row of embeddings whose id is divisible by 100, among all rows."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    doubles = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(doubles, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    x = F.when(finite, F.transform(doubles, lambda v: F.floor(v * 256)))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = e.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"))
    return hard_negatives(rows, F.col("id") % 100 == 0)


ORACLE_SQL = f"""
with e as (
  select vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label, list_transform(embedding, lambda v: floor(256 * cast(v as double))) as x
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
), s as (
  select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as same, cast(list_dot_product(a.x, r.x) as bigint) as score
  from e a join e r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0
), p as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
n as (
  select p.anchor_id, p.id as positive_id, s.id as negative_id, p.score as positive_score, s.score as negative_score,
    cast(row_number() over (partition by p.anchor_id, p.id order by s.score desc, s.id) as integer) as rank
  from p join s on p.anchor_id = s.anchor_id where not s.same and {LEAST} * p.score <= 100 * s.score and 100 * s.score <= {MOST} * p.score
) select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10"""
