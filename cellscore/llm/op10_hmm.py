"""A hidden Markov language model trained by Baum-Welch over the whole corpus.

Words are counted over all training texts. The commonest (the head, up to
most_head words) are symbols of their own; every other word, known or not, belongs by its hash to
one of CLASSES classes, which are symbols too, and inside which a word has its smoothed
share of the counts. So each word's emission depends on the state, what is broadcast
is bounded, and each rare word still gets its exact count by a join
that has no hot key. Texts are written once as symbol ids to the shared
checkpoint folder; each Baum-Welch round reads them, adds up the expected counts of
its tasks in Spark, page by page, and sends the driver one row for each page of symbols. Rounds
end when the likelihood of the training texts gains less than a tolerance; training that does not
get there in most_rounds is an error.

A long text is cut into segments, so that it takes no longer chain of steps than a
short one, but it stays one sequence: the products of a segment's matrices carry
the forward messages into it and the backward messages out of it, in training as in scoring.
Counts and scores are thus those of the whole text, by scaled recursions.

Defined results: null text is empty and has the end token alone; without a
training text every probability is 1 and every score 0; repeated rows are scored
alike, and count each time in training; a null doc_id is a row like any other; an
empty table gives no row; other columns are ignored, whatever their names. The written
texts stay in the checkpoint folder, whose owner clears it, as the result is read from them.
"""

from __future__ import annotations

import logging
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscore.llm.arrays import LOWER, bounded, cut_binary, plain, recoded, steps, words
from cellscore.llm.op1_language import held_out
from cellscore.plans.lineage import checkpoint_folder, cut_lineage

log = logging.getLogger(__name__)

#: Tokens of a segment; lock-step arrays are as long as this.
SEGMENT = 256
#: Classes of the words outside of the head (a power of two).
CLASSES = 1 << 15
#: Tasks of a training round for each core of the cluster, at most.
TASKS_A_CORE = 2
#: Symbols whose expected counts travel in one row.
PAGE = 512


def tokens(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts of a batch, A-Z in lower case, and offsets by text."""
    return words(recoded(plain(batch.column("text")), LOWER))


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n over all texts."""

    def count(batches):
        for batch in steps(batches, size=4 << 20):
            found = pc.value_counts(tokens(batch)[0])
            yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], names=["word", "n"])

    return bounded(docs).select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Unigram:
    """Counts of the corpus: head words (commonest first) and their counts, words and counts by class, and totals.

    Symbols: the head, then the classes, then the end.
    """

    head: pa.Array
    counts: np.ndarray
    class_words: np.ndarray
    class_counts: np.ndarray
    total: int
    distinct: int
    texts: int

    @property
    def size(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    @property
    def shares(self) -> np.ndarray:
        """Smoothed share of each symbol; that of a class holds its known words and one unknown."""
        return np.concatenate([self.counts + 0.5, self.class_counts + 0.5 * self.class_words + 0.5, [self.texts + 0.5]]) / self.size

    @property
    def kept(self) -> np.ndarray:
        """Share of each symbol's counts that a state keeps; a discount by word type goes to the back-off."""
        types = np.concatenate([np.ones(len(self.head)), self.class_words, [self.texts > 0]])
        return 1 - 0.75 * types / np.maximum(np.concatenate([self.counts, self.class_counts, [self.texts]]), 1)

    @property
    def backoff(self) -> np.ndarray:
        """Probability of each symbol by word types alone: a class's unknown word weighs a third of a known one."""
        weights = np.concatenate([np.full(len(self.head), 1.5), 1.5 * self.class_words + 0.5, [1.5]])
        return weights / weights.sum()


def unigram(counts: DataFrame, texts: int, most_head: int) -> tuple[Unigram, int]:
    """The unigram model with at most most_head head words, and the least count of these.

    The head is all words of at least that count: the smallest that leaves no more than most_head. What
    comes to the driver is a row for each 2^(1/8) of counts, the head and a row a class.
    """
    level = F.floor(F.log2("n") * 8).cast("long")
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("n"), F.min("n").alias("least")).collect()
    total, distinct = sum(r["n"] for r in levels), sum(r["words"] for r in levels)
    least, held = None, 0
    for r in sorted(levels, key=lambda r: -r["level"]):
        if held + r["words"] > most_head:
            break
        held, least = held + r["words"], r["least"]
    if least is None:  # no level fits, or there is no word
        least = max((r["n"] for r in levels), default=0) + 1
    head = counts.where(F.col("n") >= least).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    by = np.zeros((2, CLASSES))
    for r in counts.where(F.col("n") < least).groupBy((F.crc32(F.col("word").cast("binary")) % CLASSES).alias("class")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect():
        by[:, r["class"]] = r["words"], r["n"]
    words_model = Unigram(pc.cast(head.column("word").combine_chunks(), pa.large_string()), head.column("n").to_numpy().astype(float), by[0], by[1], total + texts, distinct + (texts > 0), texts)
    return words_model, least


def encode(docs: DataFrame, model: Unigram, keep: list[str]) -> DataFrame:
    """keep's columns, n_tokens, ids (symbols as int32) and rest (distinct words outside of the head, with their times)."""
    shared = docs.sparkSession.sparkContext.broadcast(model.head)
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("rest", T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])))])

    def run(batches):
        head = shared.value
        for batch in steps(batches, size=4 << 20):
            flat, by = tokens(batch)
            found = pc.index_in(flat, value_set=head)
            symbols = pc.fill_null(found, len(head)).to_numpy().astype(np.int32)
            n = len(by) - 1
            # distinct rest words by text
            at = np.flatnonzero(symbols == len(head))
            coded = pc.dictionary_encode(flat.take(pa.array(at)))
            classes = np.array([zlib.crc32(w.encode()) % CLASSES for w in coded.dictionary.to_pylist()], np.int32)
            symbols[at] += classes[coded.indices.to_numpy()] if len(at) else 0
            ids = np.insert(symbols, by[1:], len(head) + CLASSES) if n else symbols
            owner = np.searchsorted(by, at, side="right") - 1
            width = max(1, len(coded.dictionary))
            key, times = np.unique(owner * width + coded.indices.to_numpy(), return_counts=True)
            rest = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(key // width, np.arange(n + 1)).astype(np.int32)),
                pa.StructArray.from_arrays([coded.dictionary.take(pa.array(key % width)).cast(pa.string()), pa.array(times.astype(np.int64))], names=["word", "n"]),
            )
            binary = cut_binary(ids.astype(np.int32).tobytes(), 4 * (by[1:] + np.arange(1, n + 1)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(np.diff(by) + 1), binary, rest], names=[*keep, "n_tokens", "ids", "rest"])

    return bounded(docs).select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


@dataclass(frozen=True)
class Hmm:
    """start (K), move (K, K) and emit (symbols, K): probabilities of K states."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def segments(batch: pa.RecordBatch):
    """All ids of a batch, and by segment: its text, first id and length; the segments of a text are in order."""
    data = batch.column("ids")
    lengths = pc.binary_length(data).to_numpy() // 4
    flat = np.frombuffer(b"".join(data.to_pylist()), np.int32)
    per = -(-lengths // SEGMENT)
    text = np.repeat(np.arange(len(lengths)), per)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    first = (np.cumsum(lengths) - lengths)[text] + number * SEGMENT
    return flat, text, number, first, np.minimum(SEGMENT, lengths[text] - number * SEGMENT)


def products(flat: np.ndarray, number: np.ndarray, first: np.ndarray, length: np.ndarray, model: Hmm) -> tuple[np.ndarray, np.ndarray]:
    """The product of each segment's matrices (from the state before it to that of its last token), and the log10 it is scaled by."""
    k = len(model.start)
    order = np.argsort(-length, kind="stable")
    at, alive = first[order], np.searchsorted(-length[order], -np.arange(length.max()) - 1, side="right")
    moved = np.broadcast_to(model.move, (len(order), k, k)).copy()
    moved[number[order] == 0] = model.start  # whatever the state before a text, the first one is drawn from start
    product, logs = np.empty_like(moved), np.zeros(len(order))
    for t, m in enumerate(alive):
        step = moved[:m] if t == 0 else (product[:m].reshape(-1, k) @ model.move).reshape(m, k, k)
        step = step * model.emit[flat[at[:m] + t]][:, None, :]
        c = step.max(axis=(1, 2))
        product[:m] = step / c[:, None, None]
        logs[:m] += np.log10(c)
    back = np.argsort(order, kind="stable")
    return product[back], logs[back]


def messages(flat: np.ndarray, text: np.ndarray, number: np.ndarray, first: np.ndarray, length: np.ndarray, model: Hmm) -> tuple[np.ndarray, np.ndarray]:
    """By segment: the distribution of the state before its first token given all earlier ones, and the weight of each state of its last token given all later ones (up to scale)."""
    k = len(model.start)
    enter, leave = np.full((len(text), k), 1 / k), np.ones((len(text), k))
    many = np.flatnonzero(np.bincount(text)[text] > 1)
    if len(many):
        product, _ = products(flat, number[many], first[many], length[many], model)
        place = np.full(len(text), -1)
        place[many] = np.arange(len(many))
        for i in range(1, int(number.max()) + 1):
            rows = np.flatnonzero(number == i)
            v = np.einsum("ij,ijk->ik", enter[rows - 1], product[place[rows - 1]])
            enter[rows] = v / v.sum(axis=1, keepdims=True)
        for i in range(int(number.max()), 0, -1):
            rows = np.flatnonzero(number == i)
            v = np.einsum("ijk,ik->ij", product[place[rows]], leave[rows])
            leave[rows - 1] = v / v.sum(axis=1, keepdims=True)
    return enter, leave


def expect(flat: np.ndarray, text: np.ndarray, number: np.ndarray, first: np.ndarray, length: np.ndarray, model: Hmm):
    """Expected counts of whole texts: start, move, state weights by token (with the token's place), and the log10 probability of all."""
    enter, leave = messages(flat, text, number, first, length, model)
    order = np.argsort(-length, kind="stable")
    first, length, begins = first[order], length[order], number[order] == 0
    enter, leave = enter[order], leave[order]
    k = len(model.start)
    alive = np.searchsorted(-length, -np.arange(length.max()) - 1, side="right")  # segments longer than t
    emitted = [model.emit[flat[first[:m] + t]] for t, m in enumerate(alive)]
    forward, scale = [], []
    for t, m in enumerate(alive):
        a = emitted[t] * (np.where(begins[:, None], model.start, enter @ model.move) if t == 0 else forward[t - 1][:m] @ model.move)
        c = a.sum(axis=1, keepdims=True)
        forward.append(a / c)
        scale.append(c)
    places, weights, move = [], [], np.zeros((k, k))
    beta = np.ones((0, k))
    for t in range(len(alive) - 1, -1, -1):
        m = alive[t]
        if len(beta) < m:  # segments whose last token this is
            ending = leave[len(beta) : m]
            beta = np.concatenate([beta, ending / (forward[t][len(beta) : m] * ending).sum(axis=1, keepdims=True)])
        weights.append(forward[t] * beta)
        places.append(first[:m] + t)
        ahead = emitted[t] * beta / scale[t]
        if t:
            move += forward[t - 1][:m].T @ ahead
            beta = ahead @ model.move.T
        else:
            move += enter[~begins].T @ ahead[~begins]
    total = sum(float(np.log10(c).sum()) for c in scale)
    return weights[-1][begins].sum(axis=0), move * model.move, np.concatenate(places), np.concatenate(weights), total


def likelihood(flat: np.ndarray, text: np.ndarray, number: np.ndarray, first: np.ndarray, length: np.ndarray, model: Hmm, texts: int) -> np.ndarray:
    """log10 probability of each text by the scaled forward recursion over its segments."""
    k = len(model.start)
    product, logs = products(flat, number, first, length, model)
    state, out = np.full((texts, k), 1 / k), np.zeros(texts)
    for i in range(int(number.max()) + 1):
        rows = np.flatnonzero(number == i)
        v = np.einsum("ij,ijk->ik", state[text[rows]], product[rows])
        c = v.sum(axis=1)
        state[text[rows]] = v / c[:, None]
        out[text[rows]] += np.log10(c) + logs[rows]
    return out


def _smooth(expected: np.ndarray, words_model: Unigram) -> np.ndarray:
    """Emission probabilities from expected counts, by absolute discounting."""
    whole = np.maximum(expected.sum(axis=0), 1e-9)
    own = expected * words_model.kept[:, None] / whole
    return own + (1 - own.sum(axis=0)) * words_model.backoff[:, None]


def bags(encoded: DataFrame, common: int) -> np.ndarray:
    """A row of counts of the first `common` symbols for each text, in the order of row; at most `common` numbers a text come to the driver."""

    def count(batches):
        for batch in steps(batches, column="ids", size=2 << 20):
            found = [np.unique(x[x < common], return_counts=True) for x in (np.frombuffer(i, np.int32) for i in batch.column("ids").to_pylist())]
            lists = [pa.array([f[j].astype(np.int64).tolist() for f in found], pa.list_(pa.int64())) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *lists], names=["row", "symbols", "times"])

    rows = encoded.select("row", "ids").mapInArrow(count, "row long, symbols array<long>, times array<long>").collect()
    out = np.zeros((len(rows), common))
    for i, r in enumerate(sorted(rows, key=lambda r: r["row"])):
        out[i, r["symbols"]] = r["times"]
    return out


def begin(sample: np.ndarray, words_model: Unigram, states: int, rounds: int = 8) -> Hmm:
    """A first model: states from a clustering of a few sampled texts by their common words (a row of counts each). It only breaks the symmetry."""
    move = np.full((states, states), 0.05 / max(1, states - 1))
    np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
    symbols = len(words_model.shares)
    sample = sample[sample.sum(axis=1) > 0]
    expected = np.zeros((symbols, states))
    if len(sample):
        points = np.sqrt(sample / sample.sum(axis=1, keepdims=True))
        centres = [points[int(np.argmax(sample.sum(axis=1)))]]
        while len(centres) < states:
            centres.append(points[int(np.argmin(np.max(points @ np.array(centres).T, axis=1)))])
        centres = np.array(centres)
        for _ in range(rounds):
            near = np.argmax(points @ centres.T, axis=1)
            for s in range(states):
                if (near == s).any():
                    mean = points[near == s].mean(axis=0)
                    centres[s] = mean / np.linalg.norm(mean)
        for s in range(states):
            expected[: sample.shape[1], s] = sample[near == s].sum(axis=0)
    else:
        expected += np.random.default_rng(0).random(expected.shape)
    return Hmm(np.full(states, 1 / states), move, _smooth(expected, words_model))


def baum_welch(encoded: DataFrame, model: Hmm, words_model: Unigram) -> tuple[Hmm, float]:
    """One round over all encoded texts, and the log10 probability of them before it.

    Expected counts are added up by task, then by Spark (in single precision between the two), page by page of
    symbols; a row a page comes to the driver. As each task gives nearly all symbols, there are just some tasks a core.
    """
    spark, states = encoded.sparkSession, len(model.start)
    shared = spark.sparkContext.broadcast(model)
    pages = -(-len(model.emit) // PAGE)

    def count(batches):
        model = shared.value
        side, emit = np.zeros((states + 2, states)), np.zeros((pages * PAGE, states))
        for batch in steps(batches, column="ids", size=2 << 20):
            flat, *parts = segments(batch)
            begun, moved, places, weights, logs = expect(flat, *parts, model)
            side += np.concatenate([begun[None, :], moved, np.full((1, states), logs)])
            ids = flat[places]
            for s in range(states):
                emit[:, s] += np.bincount(ids, weights=weights[:, s], minlength=len(emit))
        paged = emit.astype(np.float32).reshape(pages, -1)
        some = np.flatnonzero(paged.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1).astype(np.int32)), pa.array([*(paged[i].tobytes() for i in some), side.tobytes()], pa.binary())], names=["page", "sums"])

    def add(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for page, sums in zip(batch.column("page").to_pylist(), batch.column("sums").to_pylist()):
                found[page] = found.get(page, 0.0) + np.frombuffer(sums, np.float32 if page >= 0 else np.float64).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([x.tobytes() for x in found.values()], pa.binary())], names=["page", "sums"])

    few = encoded.select("ids").coalesce(TASKS_A_CORE * max(1, spark.sparkContext.defaultParallelism))
    rows = few.mapInArrow(count, "page int, sums binary").repartition("page").mapInArrow(add, "page int, sums binary").collect()
    shared.unpersist()
    emit, side = np.zeros((pages, PAGE * states)), np.zeros((states + 2, states))
    for r in rows:
        if r["page"] < 0:
            side = np.frombuffer(r["sums"]).reshape(side.shape)
        else:
            emit[r["page"]] = np.frombuffer(r["sums"])
    total = float(side[-1, 0])
    side = (side[:-1] + 0.1) / (side[:-1] + 0.1).sum(axis=1, keepdims=True)
    return Hmm(side[0], side[1:], _smooth(emit.reshape(-1, states)[: len(model.emit)], words_model)), total


def train(encoded: DataFrame, first: Hmm, words_model: Unigram, most_rounds: int, tolerance: float) -> Hmm:
    """Baum-Welch until a round's log probability is at most `tolerance` (as a share) above the one before; no convergence in most_rounds is an error."""
    model, before = first, None
    for done in range(most_rounds):
        model, total = baum_welch(encoded, model, words_model)
        if before is not None and total - before <= tolerance * abs(before):
            log.info("Baum-Welch ended after %d rounds, at %.6g of log10 probability", done + 1, total)
            return model
        before = total
    raise RuntimeError(f"Baum-Welch gains over {tolerance:g} of the log probability after {most_rounds} rounds; raise most_rounds or tolerance")


def score(docs: DataFrame, training: str, states: int = 6, most_rounds: int = 40, most_head: int = 150_000, sample: int = 600, common: int = 5000, tolerance: float = 0.002) -> DataFrame:
    """doc_id, training, n_tokens, n_known, train_tokens, base_score and score of every text of docs.

    training names a boolean column of docs: the rows to learn from. Every count and
    every round covers all of them; just the first guess of the states looks at
    some `sample` texts, and at their `common` commonest words.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col(training).alias("training"), "text")
    learnt = docs.where("training")
    counts = cut_lineage(word_counts(learnt))
    texts = learnt.count()
    words_model, least = unigram(counts, texts, most_head)
    shares = words_model.shares

    checkpoint_folder(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/encoded-{uuid.uuid4().hex}"
    encode(docs, words_model, ["doc_id", "training"]).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    encoded = spark.read.parquet(path)

    model = None
    if texts:
        part = F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, sample / texts))
        chosen = encoded.where(F.col("training") & part).orderBy("row").limit(2 * sample)
        first = begin(bags(chosen, min(common, len(words_model.head) + CLASSES)), words_model, states)
        model = train(encoded.where("training"), first, words_model, most_rounds, tolerance)
    shared = spark.sparkContext.broadcast((model, np.log10(shares), len(words_model.head), len(shares) - 1))

    def run(batches):
        model, logs, head, end = shared.value
        for batch in steps(batches, column="ids", size=2 << 20):
            flat, text, number, first, length = segments(batch)
            n = batch.num_rows
            total = batch.column("n_tokens").to_numpy()
            starts = np.cumsum(total) - total
            apart = (flat >= head) & (flat < end)
            own = logs[flat] if model else np.zeros(len(flat))
            base = np.add.reduceat(np.where(apart, 0.0, own), starts)
            n_rest = np.add.reduceat(apart.astype(np.int64), starts)
            inside = np.add.reduceat(np.where(apart, own, 0.0), starts)  # a class's share, which its words divide
            value = likelihood(flat, text, number, first, length, model, n) - inside if model else np.zeros(n)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "doc_id", "training", "n_tokens")), pa.array(n_rest), pa.array(base), pa.array(value)], names=["row", "doc_id", "training", "n_tokens", "n_rest", "base", "value"])

    schema = encoded.select("row", "doc_id", "training", "n_tokens").schema.add("n_rest", "long").add("base", "double").add("value", "double")
    scored = encoded.select("row", "doc_id", "training", "n_tokens", "ids").mapInArrow(run, schema)

    # the rest words' own counts: none of them is in the head, so no key is hot
    tail = counts.where(F.col("n") < least)
    each = encoded.select("row", F.explode("rest").alias("x")).select("row", F.col("x.word").alias("word"), F.col("x.n").alias("times"))
    own = F.log10((F.coalesce(F.col("n"), F.lit(0)) + 0.5) / F.lit(float(words_model.size))) if texts else F.lit(0.0)
    of_rest = each.join(tail, "word", "left").groupBy("row").agg(F.sum(own * F.col("times")).alias("own"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(F.lit(0))).alias("known"))
    joined = scored.join(of_rest, "row", "left")
    own, known = F.coalesce("own", F.lit(0.0)), F.coalesce("known", F.lit(0))
    return joined.select(
        "doc_id", "training", "n_tokens",
        (F.col("n_tokens") - F.col("n_rest") - (0 if texts else 1) + known).cast("long").alias("n_known"),
        F.lit(words_model.total).cast("long").alias("train_tokens"),
        (F.col("base") + own).alias("base_score"), (F.col("value") + own).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: log10 probability of every whole text of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", (~held_out(5, 1)).alias("training"))
    return score(docs, "training").select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
