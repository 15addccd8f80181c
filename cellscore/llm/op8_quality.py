"""Quality rules by host, with rates shrunk by an empirical beta prior.

Every text is tested against four rules, and against all of them together. For each, the failures of a host
are counted, a beta prior is fitted to the hosts' rates by their moments, and a
host's rate becomes the posterior mean. A host whose posterior rate is so high
that its lower bound (two standard deviations down) is above the limit is
rejected, and so are all its documents. The limit of a rule is three times the rate over all
documents, but 0.1 at least and 0.25 at most.

Defined results: null text has no words and so fails the base rules; a null host
is a host of its own; without any document there is no host and no row; hosts
all with the same rate get that rate as a firm prior; repeated rows count each
time; other columns are ignored, whatever their names. Counts are whole: no
text, line or host is capped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscore.llm.arrays import bounded, plain, steps, sums, utf8, words
from cellscore.plans import cut_lineage, small_enough

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: The host table is broadcast up to so many rows; beyond that it is joined by a shuffle.
BROADCAST_HOSTS = 500_000
METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def _packed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for each distinct pair."""
    return pd.factorize((left.astype(np.int64) << 32) | right.astype(np.int64))[0]


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The metrics of each text."""
    data, offsets = utf8(texts)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    out = {"word_chars": sums(~space & ((data & 0xC0) != 0x80), offsets), "n_symbols": sums(np.isin(data, np.frombuffer(SYMBOLS.encode(), np.uint8)), offsets)}
    flat, by = words(texts)
    n = np.diff(by)
    out["n_words"] = n
    code = pc.dictionary_encode(flat).indices.to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(texts), dtype=np.int64), n)
    repeated = np.zeros(len(code) + 1, dtype=np.int64)
    if len(code) >= 3:
        pair = _packed(code[:-1], code[1:])
        triple = _packed(pair[:-1], code[2:])
        inside = np.flatnonzero(text[:-2] == text[2:])
        twice = pd.Series((text[inside] << 32) | triple[inside]).duplicated(keep=False).to_numpy()
        starts = inside[twice]
        edge = np.zeros(len(code) + 1, dtype=np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + 3, -1)
        repeated = np.cumsum(edge) > 0
    out["n_repeat_words"] = sums(repeated[:-1], by)
    lists = pc.split_pattern(texts, "\n")
    lines = lists.flatten()
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    shown = np.flatnonzero(pc.greater(pc.binary_length(pc.ascii_trim_whitespace(lines)), 0).to_numpy(zero_copy_only=False))
    which = pc.dictionary_encode(lines.take(pa.array(shown))).indices.to_numpy().astype(np.int64)
    again = pd.Series((owner[shown] << 32) | which).duplicated(keep="first").to_numpy()
    out["n_dup_lines"] = np.bincount(owner[shown], weights=again, minlength=len(texts)).astype(np.int64)
    out["n_lines"] = np.bincount(owner[shown], minlength=len(texts))
    return out


def metrics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """keep's columns of docs with the metrics of text."""

    def run(batches):
        for batch in steps(batches):
            found = measure(plain(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(found[m].astype(np.int64)) for m in METRICS)], names=[*keep, *METRICS])

    schema = docs.select(*keep).schema
    for m in METRICS:
        schema = schema.add(m, "long")
    return bounded(docs).select(*keep, "text").mapInArrow(run, schema)


#: Rule -> SQL that is true of a text that fails it.
RULES = {
    "short": "n_words < 50",
    "repetitive": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "2 * n_dup_lines > n_lines",
}
RULES["any"] = " or ".join(f"({fails})" for fails in RULES.values())
#: The rules that reject a document by itself.
BASE = ("short", "repetitive")


#: A host's limit: so many times the overall rate, between these two.
TIMES, LEAST_LIMIT, MOST_LIMIT = 3.0, 0.1, 0.25


def host_rates(measured: DataFrame, host: str = "host") -> DataFrame:
    """By host: n and, by rule, fails_, mean_ and sd_ of the posterior of its failure rate, and limit_.

    The prior of a rule is fitted over hosts: with m the overall rate and v the
    variance of the hosts' rates beyond what counting alone explains, its
    strength is m (1 - m) / v - 1, between 1 and 10,000.
    """
    hosts = measured.groupBy(host).agg(F.count("*").alias("n"), *(F.count_if(F.expr(fails)).alias(f"fails_{r}") for r, fails in RULES.items()))
    one = hosts.agg(F.sum("n").alias("docs"), F.count("*").alias("hosts"), *(x for r in RULES for x in (F.sum(f"fails_{r}").alias(f"all_{r}"), F.coalesce(F.var_pop(F.col(f"fails_{r}") / F.col("n")), F.lit(0.0)).alias(f"var_{r}"), F.avg(1 / F.col("n")).alias(f"inv_{r}"))))
    joined = hosts.crossJoin(F.broadcast(one))  # one row of totals
    columns = [F.col(host), F.col("n")]
    for r in RULES:
        m = F.col(f"all_{r}") / F.col("docs")
        spread = m * (1 - m)
        beyond = F.greatest(F.col(f"var_{r}") - spread * F.col(f"inv_{r}"), F.lit(0.0))
        strength = F.least(F.greatest(F.when(beyond > 0, spread / F.nullif(beyond, F.lit(0.0)) - 1).otherwise(F.lit(10_000.0)), F.lit(1.0)), F.lit(10_000.0))
        mean = (F.col(f"fails_{r}") + strength * m) / (F.col("n") + strength)
        columns += [F.col(f"fails_{r}"), mean.alias(f"mean_{r}"), F.sqrt(mean * (1 - mean) / (F.col("n") + strength + 1)).alias(f"sd_{r}")]
        columns.append(F.least(F.greatest(TIMES * m, F.lit(LEAST_LIMIT)), F.lit(MOST_LIMIT)).alias(f"limit_{r}"))
    return joined.select(*columns)


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, the metrics, base_failed, host_failed (names of the rules that reject the host) and kept."""
    measured = cut_lineage(metrics(docs.select("doc_id", F.col(host).cast("string").alias("host"), "text"), ["doc_id", "host"]))
    rates = host_rates(measured)
    failed = F.array_compact(F.array(*(F.when(F.col(f"mean_{r}") - 2 * F.col(f"sd_{r}") > F.col(f"limit_{r}"), F.lit(r)) for r in RULES)))
    verdicts = small_enough(rates.select(F.col("host").alias("verdict_host"), failed.alias("host_failed")), BROADCAST_HOSTS)
    judged = measured.join(verdicts, F.col("host").eqNullSafe(F.col("verdict_host")), "left").drop("verdict_host")
    base = F.lit(False)
    for r in BASE:
        base = base | F.expr(RULES[r])
    return judged.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & (F.size("host_failed") == 0))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: metrics and verdict of every whole text of documents; the host is the source."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host", F.array_join("host_failed", ",").alias("host_failed"))


def _oracle() -> str:
    conditions = {r: f"({c})" for r, c in RULES.items()}
    counts = ", ".join(f"count(*) filter (where {c}) as f_{r}" for r, c in conditions.items())
    totals = ", ".join(f"sum(f_{r}) / sum(n) as m_{r}, var_pop(f_{r} / n) as v_{r}" for r in RULES)
    beyond = lambda r: f"greatest(v_{r} - m_{r} * (1 - m_{r}) * inv, 0)"
    strength = ", ".join(f"least(greatest(case when {beyond(r)} > 0 then m_{r} * (1 - m_{r}) / {beyond(r)} - 1 else 10000 end, 1), 10000) as s_{r}" for r in RULES)
    means = ", ".join(f"(f_{r} + s_{r} * m_{r}) / (n + s_{r}) as e_{r}" for r in RULES)
    failed = ", ".join(f"case when e_{r} - 2 * sqrt(e_{r} * (1 - e_{r}) / (n + s_{r} + 1)) > least(greatest({TIMES} * m_{r}, {LEAST_LIMIT}), {MOST_LIMIT}) then '{r}' end" for r in RULES)
    return rf"""
with d as (
  select doc_id, source as host, coalesce(text, '') as text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from documents
), tri as (select doc_id, i, w[i] as a, w[i + 1] as b, w[i + 2] as c from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d)),
rep as (select doc_id, i from tri qualify count(*) over (partition by doc_id, a, b, c) > 1),
pos as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from rep) group by 1),
x as (
  select doc_id, host, cast(len(w) as bigint) as n_words, cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
    cast(coalesce(pos.n, 0) as bigint) as n_repeat_words, len(l) as n_lines from d left join pos using (doc_id)
), h as (select host, count(*) as n, {counts} from x group by 1),
t as (select avg(1 / n) as inv, {totals} from h),
s as (select h.*, t.*, {strength} from h cross join t),
e as (select s.*, {means} from s),
v as (select host, concat_ws(',', {failed}) as host_failed from e)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {conditions["short"]} or {conditions["repetitive"]} as base_failed,
  not ({conditions["short"]} or {conditions["repetitive"]}) and host_failed = '' as kept, x.host, host_failed
from x join v on x.host is not distinct from v.host
"""


ORACLE_SQL = _oracle()
