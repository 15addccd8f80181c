"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positive sample, documents without a label are the
unlabelled one (labelled rows with their label hidden, where every document has one), and the
class prior is a parameter, by default the toxic share of all labels, as labels are
taken to be given without regard to the text. Several linear classifiers are trained in numpy, one per task, each on
a bounded sample; the risk of the unlabelled texts is corrected by the prior
and kept from going below zero. Their mean scores every text.

Defined results: null and empty texts have no word and score the intercept
(below 0.5 for a prior below a half); without any positive label, or any label,
every row scores the prior (0 without labels); a document labelled twice counts
as toxic if one label says so; repeated rows are scored alike; null labels are
left out; a null doc_id is scored and never learnt from; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscore.llm.arrays import bounded, plain, recoded, steps, words
from cellscore.llm.op1_language import held_out
from cellscore.plans import cut_lineage, small_enough

#: Word hashes; a model is so many weights and an intercept.
WIDTH = 1 << 18
#: Labelled ids that are broadcast to find documents without a label; more are shuffled.
MOST_LABELS = 2_000_000


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashed words of each text: text index, hash, log(1 + times). ASCII is folded to letters and digits."""
    fold = np.full(256, 32, dtype=np.uint8)
    for first, last in ((48, 57), (97, 122), (128, 255)):
        fold[first : last + 1] = np.arange(first, last + 1)
    fold[65:91] = np.arange(97, 123)
    flat, by = words(recoded(texts, fold))
    coded = pc.dictionary_encode(flat)
    hashes = np.array([zlib.crc32(w.encode()) & (WIDTH - 1) for w in coded.dictionary.to_pylist()], dtype=np.int64)
    text = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(by))
    key = text * WIDTH + (hashes[coded.indices.to_numpy()] if len(hashes) else np.zeros(0, np.int64))
    key, times = np.unique(key, return_counts=True)
    return key // WIDTH, key % WIDTH, np.log1p(times)


def telling(owner: np.ndarray, ids: np.ndarray, positive: np.ndarray, least: float = 3.0, rows: int = 5) -> np.ndarray:
    """Which word hashes are in positives far more, or less, often than in unlabelled rows (in standard deviations)."""
    n_p, n_u = positive.sum(), (~positive).sum()
    with_p = np.bincount(ids[positive[owner]], minlength=WIDTH)
    with_u = np.bincount(ids[~positive[owner]], minlength=WIDTH)
    rate = with_u / n_u
    return (np.abs(with_p - rate * n_p) >= least * np.sqrt(rate * n_p * (1 - rate) + 1)) & (with_p + with_u >= rows)


def train(owner: np.ndarray, ids: np.ndarray, values: np.ndarray, positive: np.ndarray, prior: float, rounds: int = 300, rate: float = 0.1, decay: float = 1e-4) -> np.ndarray:
    """Weights (the last is the intercept) that minimise the non-negative PU risk with logistic loss.

    positive tells which rows are positives; the others are unlabelled. When the
    corrected risk of the negatives is below zero, a step goes up on it alone, so
    that the model does not fit it further. Only telling words get a weight:
    with so few positives, the rest would be learnt by heart.
    """
    kept = telling(owner, ids, positive)[ids]
    owner, ids, values = owner[kept], ids[kept], values[kept]
    used, column = np.unique(ids, return_inverse=True)
    n_p, n_u = int(positive.sum()), int((~positive).sum())
    w, b = np.zeros(len(used)), np.log(prior / (1 - prior))
    moment, square = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for t in range(1, rounds + 1):
        g = b + np.bincount(owner, weights=w[column] * values, minlength=len(positive))
        up = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
        loss_negative = np.logaddexp(0, g)
        corrected = loss_negative[~positive].mean() - prior * loss_negative[positive].mean()
        slope_negative = np.where(positive, -prior * up / n_p, up / n_u)
        slope = slope_negative + np.where(positive, prior * (up - 1) / n_p, 0.0) if corrected >= 0 else -slope_negative
        grad = np.concatenate([np.bincount(column, weights=slope[owner] * values, minlength=len(used)) + decay * w, [slope.sum()]])
        moment = 0.9 * moment + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        step = rate * (moment / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    out = np.zeros(WIDTH + 1)
    out[used], out[-1] = w, b
    return out


def fit(docs: DataFrame, labels: DataFrame, models: int = 4, positives: int = 3000, unlabelled: int = 9000, prior: float | None = None) -> np.ndarray:
    """Mean weights of the models, from docs (doc_id, text) and labels (doc_id, toxic).

    The sample is bounded: each model takes about positives toxic rows and
    unlabelled documents without a label at most, by a hash of doc_id and the model. The
    prior is the toxic share of all labels unless given.
    """
    spark = docs.sparkSession
    labels = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    counts = labels.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0)).alias("p")).first()
    n, p = counts["n"], counts["p"]
    flat = np.zeros(WIDTH + 1)
    if p == 0 or p == n:
        flat[-1] = -30.0 if p == 0 else 30.0
        return flat
    prior = p / n if prior is None else prior
    known = small_enough(labels.select("doc_id"), MOST_LABELS)
    others = docs.select("doc_id").where(F.col("doc_id").isNotNull()).join(known, "doc_id", "left_anti").distinct()
    n_others = others.count()
    if n_others == 0:
        others, n_others = labels.select("doc_id"), n
    part = lambda salt: F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col("model"), F.lit(salt)), F.lit(1 << 20)) / float(1 << 20)
    spread = lambda df: df.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(models - 1))).alias("model"))
    chosen = spread(labels.where("toxic")).where(part("p") < min(1.0, positives / p)).withColumn("positive", F.lit(True))
    chosen = chosen.unionByName(spread(others).where(part("u") < min(1.0, unlabelled / n_others)).withColumn("positive", F.lit(False)))
    # at most about models * (positives + unlabelled) short rows; a document with several rows counts once for each
    sample = docs.select("doc_id", "text").join(F.broadcast(cut_lineage(chosen)), "doc_id").select("model", "positive", "text")

    def extract(batches):
        for batch in steps(batches):
            owner, ids, values = features(plain(batch.column("text")))
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("model"), batch.column("positive"),
                    pa.array([ids[a:b].astype(np.int32).tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                    pa.array([values[a:b].astype(np.float32).tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                ],
                names=["model", "positive", "ids", "values"],
            )

    def learn(table: pa.Table) -> pa.Table:
        ids = [np.frombuffer(x, np.int32) for x in table.column("ids").to_pylist()]
        values = [np.frombuffer(x, np.float32) for x in table.column("values").to_pylist()]
        owner = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
        positive = table.column("positive").to_numpy(zero_copy_only=False).astype(bool)
        if positive.all() or not positive.any():
            return pa.table({"weights": pa.array([], pa.binary())})
        weights = train(owner, np.concatenate(ids), np.concatenate(values).astype(float), positive, prior)
        return pa.table({"weights": pa.array([weights.astype(np.float32).tobytes()], pa.binary())})

    # written once: dealing by range looks at the rows twice
    extracted = cut_lineage(bounded(sample).mapInArrow(extract, "model int, positive boolean, ids binary, values binary"))
    rows = extracted.repartitionByRange(models, "model").groupBy("model").applyInArrow(learn, "weights binary").collect()
    if not rows:
        flat[-1] = np.log(prior / (1 - prior))
        return flat
    return np.mean([np.frombuffer(r["weights"], np.float32).astype(float) for r in rows], axis=0)


def score(docs: DataFrame, weights: np.ndarray, keep: list[str] | None = None) -> DataFrame:
    """Add score (0 to 1) of text; keep names the columns of docs to return (all by default)."""
    keep = [c for c in (keep or docs.columns) if c != "score"]
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        w = shared.value
        for batch in steps(batches):
            owner, ids, values = features(plain(batch.column("text")))
            g = w[-1] + np.bincount(owner, weights=w[ids] * values, minlength=batch.num_rows)
            value = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(value)], names=[*keep, "score"])

    columns = keep if "text" in keep else [*keep, "text"]
    return bounded(docs).select(*columns).mapInArrow(run, docs.select(*keep).schema.add("score", "double"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: toxicity of every whole text of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    weights = fit(docs.where(~held_out(5, 0)), labels.where(~held_out(5, 0)))
    out = score(docs, weights, keep=["doc_id"])
    return out.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
