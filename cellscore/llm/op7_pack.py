"""Order-preserving packing of token ids into windows, by dynamic programming.

The documents of a partition, in input order, make one stream of ids. Windows
are cut from it at ends of documents or sentences (or, within a sentence
longer than a window, anywhere), so that padding plus penalties for cut
documents is least. The cost of a window that needs padding is linear in its
start, so the best start is kept in a monotone queue of cut points; a window
whose length is a power of two needs no padding, and its few possible starts
are looked up.

The stream is worked off in spans of some SPAN ids. A window that lies over the
end of a span starts less than a window before it, so the program is run up to
the span's last cut point, and only the cuts that all possible starts have in common
are kept; the ids behind them go to the next span. The cuts of a partition
thus cost as little as those of one program over all of it.

Defined results: null text is empty and is just its end id; a null doc_id is packed
like any other; repeated rows are
packed each; an empty table gives no row; ids of a sequence are unique over
partitions, and gaps between them are allowed; other columns are ignored,
whatever their names. A task holds a span and the longest run of ids without an
agreed cut, which is some windows, or a document of a single sentence.
"""

from __future__ import annotations

import zlib
from collections import deque
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscore.llm.arrays import bounded, cut_binary, plain, steps, tidy
from cellscore.llm.tokens import encoder

#: Ids that are taken up at once.
SPAN = 1 << 18


def public_tokenizer(name: str) -> str:
    """The path of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def cut_points(length: int, documents: np.ndarray, sentences: np.ndarray, window: int, penalties: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end (ascending, length last) and the penalty of each: none, a cut document, a cut sentence."""
    cost = np.full(length + 1, np.inf)
    cost[sentences] = penalties[0]
    cost[documents] = 0
    cost[0] = cost[length] = 0
    points = np.flatnonzero(np.isfinite(cost))
    gaps = np.flatnonzero(np.diff(points) > window)
    for a, b in zip(points[gaps], points[gaps + 1]):
        forced = np.concatenate([np.arange(a + window, b, window), np.arange(b - window, a, -window)])
        cost[forced] = np.minimum(cost[forced], penalties[1])
    points = np.flatnonzero(np.isfinite(cost))
    return points[1:], cost[points[1:]]


def solve(points: np.ndarray, penalty: np.ndarray, window: int) -> tuple[list[int], list[int]]:
    """Places (0, then points) and, for each, the index of the cut before it on the best way there.

    best[j] = penalty[j] + min over i of best[i] + padding(points[j] - points[i]):
    with padding, window - length is linear in points[i], so candidates wait in a
    queue ordered by best[i] + points[i]; lengths that are powers of two are free.
    """
    at = np.concatenate([[0], points])
    place = np.full(int(at[-1]) + 1, -1, np.int64)
    place[at] = np.arange(len(at))
    free_to, free_from = [], []
    power = 1
    while power <= window:
        j = np.flatnonzero(at >= power)
        i = place[at[j] - power]
        free_to.append(j[i >= 0])
        free_from.append(i[i >= 0])
        power *= 2
    free_to, free_from = np.concatenate(free_to), np.concatenate(free_from)
    order = np.argsort(free_to, kind="stable")
    free_to, free_from = [*free_to[order].tolist(), -1], free_from[order].tolist()
    ends, costs = at.tolist(), [0.0, *penalty.tolist()]
    best, back = [0.0] * len(ends), [0] * len(ends)
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # best + place, place, index
    free = 0
    for j in range(1, len(ends)):
        end = ends[j]
        while queue[0][1] < end - window:
            queue.popleft()
        value, _, source = queue[0]
        value += window - end
        while free_to[free] == j:
            i = free_from[free]
            if best[i] <= value:
                value, source = best[i], i
            free += 1
        value += costs[j]
        best[j], back[j] = value, source
        key = value + end
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, end, j))
    return ends, back


def way(ends: list[int], back: list[int], j: int) -> np.ndarray:
    """The cuts on the best way to the place j, ascending."""
    cuts = []
    while j:
        cuts.append(ends[j])
        j = back[j]
    return np.array(cuts[::-1], dtype=np.int64)


def plan(points: np.ndarray, penalty: np.ndarray, window: int) -> np.ndarray:
    """The cuts (ascending, without 0, with the last point) of least padding plus penalties."""
    ends, back = solve(points, penalty, window)
    return way(ends, back, len(ends) - 1)


def agreed(length: int, documents: np.ndarray, sentences: np.ndarray, window: int, penalties: tuple[float, float]) -> np.ndarray:
    """The first cuts of a stream of which just the first length ids are known: those that hold whatever follows.

    Ids behind the last end of a document or sentence may be cut in another way once the next
    end is known, so the program stops there. The cut before the first one behind that
    place is less than a window away; what the best ways to all such cuts have in common is settled.
    """
    natural = np.union1d(documents, sentences)
    last = int(natural[-1]) if len(natural) else 0
    if last == 0:
        return np.zeros(0, np.int64)
    points, penalty = cut_points(last, documents[documents <= last], sentences, window, penalties)
    ends, back = solve(points, penalty, window)
    open_ = [-j for j in range(int(np.searchsorted(ends, last - window, side="right")), len(ends))]
    heapify(open_)
    while len(open_) > 1:  # the latest of the places gives way to the cut before it, until one is left
        j = -heappop(open_)
        if not open_ or -open_[0] != j:
            heappush(open_, -back[j])
    j = -open_[0]
    ends_of = set(natural.tolist())
    while j and ends[j] not in ends_of:  # cuts inside a long sentence are worked out anew from its start
        j = back[j]
    return way(ends, back, j)


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, window: int = 1024, penalties: tuple[float, float] = (2.0, 32.0), with_ids: bool = True, most_parts: int = 400_000, step_bytes: int = 2 << 20) -> DataFrame:
    """Pieces of docs (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, with_ids, ids (uint32, little-endian).

    tokenizer is a file of the tokenizers library that executors can read (by
    default the public byte-level one). A sentence ends after an id whose text
    ends in a full stop, exclamation or question mark, or holds a line end. most_parts
    bounds the encoder's cache and step_bytes the text that it takes at once: less
    memory for more time, and the same pieces.
    """
    path = tokenizer or public_tokenizer("byte_bpe_50k.json")
    schema = docs.select("doc_id").schema
    for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"):
        schema = schema.add(name, "long")
    schema = schema.add("ids", "binary") if with_ids else schema

    def run(batches):
        coder = encoder(path, most_parts)
        closing = np.zeros(max(coder.vocabulary.values()) + 1, dtype=bool)
        for token, i in coder.vocabulary.items():
            closing[i] = token[-1:] in (".", "!", "?") or "Ċ" in token  # the byte-level sign of a line end
        closing[end_id] = True
        task = TaskContext.get()
        sequences = (task.partitionId() if task else 0) << 40

        def close(held: list, final: bool) -> tuple[pa.RecordBatch | None, list]:
            """The pieces of the settled windows of what is held, and the rest."""
            nonlocal sequences
            names = pa.concat_arrays([x[0] for x in held])
            sizes, skipped, whole, flat = (np.concatenate([x[i] for x in held]) for i in range(1, 5))  # skipped: ids of the document that are settled
            first = np.flatnonzero(np.concatenate([[True], skipped[:-1] + sizes[:-1] == whole[:-1]]))  # else the row goes on with the document before it
            names, sizes, skipped, whole = names.take(pa.array(first)), np.add.reduceat(sizes, first), skipped[first], whole[first]
            ends = np.cumsum(sizes)
            # the last document of what is held may go on behind it
            done = ends if skipped[-1] + sizes[-1] == whole[-1] else ends[:-1]
            sentences = np.flatnonzero(closing[flat]) + 1
            if final:
                cuts = plan(*cut_points(len(flat), ends, sentences, window, penalties), window)
            else:
                cuts = agreed(len(flat), done, sentences, window, penalties)
            if not len(cuts):
                return None, [(names, sizes, skipped, whole, flat)]
            upto = int(cuts[-1])
            begins = np.concatenate([[0], cuts[:-1]])
            edges = np.union1d(ends[ends < upto], cuts)
            a = np.concatenate([[0], edges[:-1]])
            doc, sequence = np.searchsorted(ends, a, side="right"), np.searchsorted(cuts, a, side="right")
            raw = flat[:upto].astype("<u4").tobytes()
            view = memoryview(raw)
            sums = [zlib.crc32(view[4 * x : 4 * y]) for x, y in zip(a.tolist(), edges.tolist())]
            columns = [
                names.take(pa.array(doc)), pa.array(a - (ends - sizes)[doc] + skipped[doc]), pa.array(edges - a), pa.array(sums, pa.int64()),
                pa.array(whole[doc]), pa.array(sequences + sequence), pa.array(a - begins[sequence]),
            ]
            out = pa.RecordBatch.from_arrays([*columns, cut_binary(raw, 4 * edges)] if with_ids else columns, names=schema.names)
            sequences += len(cuts)
            left = int(np.searchsorted(ends, upto, side="right"))  # the first document with ids left
            if left == len(ends):
                return out, []
            used = np.maximum(upto - (ends - sizes)[left:], 0)
            return out, [(names.slice(left), sizes[left:] - used, skipped[left:] + used, whole[left:], flat[upto:])]

        held, room = [], SPAN
        for batch in steps(batches, size=step_bytes):
            ids, offsets = coder.encode(plain(batch.column("text")))
            n = batch.num_rows
            ids = np.insert(ids, offsets[1:], end_id)
            offsets = offsets + np.arange(n + 1)
            at = 0
            while at < len(ids):
                stop = min(len(ids), at + room)
                first, last = np.searchsorted(offsets, at, side="right") - 1, np.searchsorted(offsets, stop, side="left")
                low = np.maximum(offsets[first:last], at)
                high = np.minimum(offsets[first + 1 : last + 1], stop)
                held.append((batch.column("doc_id").slice(first, last - first), high - low, low - offsets[first:last], np.diff(offsets)[first:last], ids[at:stop]))
                room -= stop - at
                at = stop
                if room == 0:
                    out, held = close(held, False)
                    room = max(SPAN, sum(len(x[4]) for x in held))  # twice as much is looked at if little was settled
                    if out is not None:
                        yield out
        if held:
            yield close(held, True)[0]

    return bounded(docs).select("doc_id", "text").mapInArrow(tidy(run), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: pieces of all documents in windows of 1024 ids."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)
