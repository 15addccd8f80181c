"""Secret scans with a recursive decoding worklist.

Each text is the first layer. A layer is scanned for the three kinds of
secrets; then its percent escapes, Unicode escapes, base64 runs and compressed
payloads are unwrapped into new layers, which are scanned in turn, until no new
layer appears. A layer that was seen before at the same place is not taken up
again. Every character of a layer knows the span of the whole text that it came
from, so that spans of any layer are reported in the text's own code points.

Defined results: null text is empty and has no span; spans are a set, so that
one found on several layers counts once; base spans (first layer) always stay;
a base64 run may go over line breaks, and counts line by line as well; if it does not decode
to text as a whole, then its readable stretches and compressed payloads are layers, whatever is
glued on before or after them; rows are independent, so repeated rows repeat their spans; other columns
are kept as they are, whatever their names; a null doc_id is a row like any other. All members of a payload are decompressed to
the end, and are scanned in pieces of most_bytes that overlap by a million characters at most (a guard of memory against bombs), so just a
secret longer than that can be cut.

Limits that lose nothing: the shortest secret, `token:` with a value of six, has 12 characters, so a run of base64
has 16 at least, and a readable stretch of decoded bytes 12.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscore.llm.arrays import bounded, plain, steps

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: A run over line breaks, the lines indented or not.
WRAPPED = re.compile(r"[A-Za-z0-9+/_-]+(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]+)+={0,2}")
BLANK = str.maketrans("", "", "\r\n\t ")
#: Where a compressed payload may start, and readable UTF-8 as long as the shortest secret.
MAGIC = re.compile(rb"\x1f\x8b|x[\x01\x5e\x9c\xda]|BZh|\xfd7zXZ\x00")
STRETCH = re.compile(rb"(?:[\t\n\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){12,}")
#: Bytes that a decompressor gives at once, and characters that two pieces of a payload share.
CHUNK, OVERLAP = 1 << 16, 1 << 20

#: What a text must match (in RE2) to be looked at row by row.
CANDIDATE = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
    r"|%[0-9A-Fa-f]{2}|\\u\{|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|[A-Za-z0-9+/_-]{16}"
    r"|[A-Za-z0-9+/_-]\r?\n[\x20\t]*[A-Za-z0-9+/_-]"
)

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("depth", T.IntegerType())]))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three kinds in one layer, leftmost and non-overlapping by kind.

    Runs are greedy, so a minimal length in the pattern drops just the matches that fail it.
    """
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def _opened(raw):
    """A decompressor if raw starts as gzip, zlib, bzip2 or xz do."""
    if raw[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if len(raw) > 2 and raw[0] == 0x78 and int.from_bytes(raw[:2], "big") % 31 == 0:
        return zlib.decompressobj(15)
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if raw[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def unpack(raw) -> Iterator[bytes]:
    """What raw holds decompressed, in chunks, member by member; it ends where the data are broken or at their end."""
    while (worker := _opened(raw)) is not None:
        try:
            chunk = worker.decompress(raw, CHUNK)
            while True:
                if chunk:
                    yield chunk
                if worker.eof:
                    break
                rest = getattr(worker, "unconsumed_tail", b"")
                if not chunk and not rest:
                    return
                chunk = worker.decompress(rest, CHUNK) if rest or not getattr(worker, "needs_input", False) else b""
        except (zlib.error, OSError, lzma.LZMAError, ValueError, EOFError):
            return
        raw = worker.unused_data


def pieces(chunks: Iterator[bytes], most_bytes: int) -> Iterator[str]:
    """Text of chunks in pieces of some most_bytes, each with the end of the one before; bytes that are no UTF-8 become U+FFFD."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    overlap = min(OVERLAP, most_bytes // 2)
    tail, held, size = "", [], 0
    for chunk in chunks:
        held.append(decoder.decode(chunk))
        size += len(chunk)
        if size >= most_bytes:
            text = tail + "".join(held)
            yield text
            tail, held, size = text[-overlap:], [], 0
    last = "".join(held) + decoder.decode(b"", True)
    if last:
        yield tail + last


def readable(raw: bytes) -> str | None:
    """raw as text if it is UTF-8 and nearly all printable; of other bytes, the readable stretches are layers."""
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    shown = sum(c.isprintable() or c in "\n\r\t" for c in text)
    return text if text and shown >= 0.95 * len(text) else None


def _whole(text: str, pattern: re.Pattern, decode) -> tuple[str, np.ndarray, np.ndarray] | None:
    """text with matches replaced by decode(match) -> [(string, first, last offset in match)], and each character's source."""
    out, starts, ends, at, changed = [], [], [], 0, False
    for m in pattern.finditer(text):
        pieces = decode(m)
        if pieces is None:
            continue
        changed = True
        out.append(text[at : m.start()])
        starts.append(np.arange(at, m.start()))
        ends.append(np.arange(at, m.start()) + 1)
        for piece, first, last in pieces:
            out.append(piece)
            starts.append(np.full(len(piece), m.start() + first))
            ends.append(np.full(len(piece), m.start() + last))
        at = m.end()
    if not changed:
        return None
    out.append(text[at:])
    starts.append(np.arange(at, len(text)))
    ends.append(np.arange(at, len(text)) + 1)
    return "".join(out), np.concatenate(starts), np.concatenate(ends)


def _percent(m: re.Match):
    raw = bytes.fromhex(m.group().replace("%", ""))
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return [(chr(b), 3 * i, 3 * i + 3) for i, b in enumerate(raw)]
    out, at = [], 0
    for c in text:
        n = 3 * len(c.encode("utf-8"))
        out.append((c, at, at + n))
        at += n
    return out


def _escape(m: re.Match):
    code = int(next(g for g in m.groups() if g is not None), 16)
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return None
    return [(chr(code), 0, m.end() - m.start())]


def layers(text: str, most_bytes: int):
    """Layers right below text: (text, first source offset, end source offset of every character)."""
    if "%" in text and (x := _whole(text, PERCENT, _percent)):
        yield x
    if "\\" in text and (x := _whole(text, ESCAPE, _escape)):
        yield x
    for m in BASE64.finditer(text):
        yield from _base64(m, most_bytes)
    if "\n" in text:
        for m in WRAPPED.finditer(text):
            yield from _base64(m, most_bytes)


def _base64(m: re.Match, most_bytes: int):
    """Layers of a base64 run: its text as a whole, or else the payloads and readable stretches at each of the four alignments."""
    run = m.group().translate(BLANK)
    if len(run.rstrip("=")) < 16:
        return
    core = run.rstrip("=").replace("-", "+").replace("_", "/")
    gaps = None if len(run) == m.end() - m.start() else np.flatnonzero([c not in "\r\n\t " for c in m.group()])

    def at(place):
        """Where a character of the run is in the text."""
        return m.start() + (place if gaps is None else gaps[place])

    def mapped(inner: str, skipped: int, start: int):
        widths = np.array([len(c.encode("utf-8")) for c in inner])
        last = start + np.cumsum(widths)
        first = last - widths
        return inner, at(skipped + first // 3 * 4 + first % 3), at(np.minimum(skipped + (last - 1) // 3 * 4 + (last - 1) % 3 + 2, len(core)) - 1) + 1

    for skipped in range(4):
        part = core[skipped:]
        part = part[:-1] if len(part) % 4 == 1 else part
        raw = base64.b64decode(part + "=" * (-len(part) % 4))
        if skipped == 0 and _opened(raw) is None and (inner := readable(raw)) is not None:
            yield mapped(inner, 0, 0)
            return
        for x in MAGIC.finditer(raw):
            begin = at(skipped + x.start() // 3 * 4 + x.start() % 3)
            for inner in pieces(unpack(memoryview(raw)[x.start() :]), most_bytes):
                yield inner, np.broadcast_to(begin, len(inner)), np.broadcast_to(np.int64(m.end()), len(inner))
        for x in STRETCH.finditer(raw):
            yield mapped(x.group().decode("utf-8"), skipped, x.start())


def scan_text(text: str, most_bytes: int = 1 << 22) -> list[tuple[str, int, int, int]]:
    """All spans (kind, start, end, depth of the layer) of text, by start, kind as listed, end.

    The worklist is a stack of layers that are still being unwrapped, so of a payload in many pieces one a level is held at a time. What was
    scanned is known by 128 bits of its hash and its place.
    """
    found = {span: 0 for span in base_spans(text)}
    work, seen = [(layers(text, most_bytes), None, None)], set()
    while work:
        inside, starts, ends = work[-1]
        layer = next(inside, None)
        if layer is None:
            work.pop()
            continue
        inner, first, last = layer
        if starts is not None:
            first, last = starts[first], ends[last - 1]
        key = (hashlib.blake2b(inner.encode("utf-8", "surrogatepass"), digest_size=16).digest(), int(first[0]), int(last[-1]))
        if key in seen:
            continue
        seen.add(key)
        depth = len(work)
        for kind, a, b in base_spans(inner):
            span = (kind, int(first[a]), int(last[b - 1]))
            found[span] = min(found.get(span, depth), depth)
        work.append((layers(inner, most_bytes), first, last))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(((*span, depth) for span, depth in found.items()), key=lambda x: (x[1], order[x[0]], x[2]))


def _candidates(texts: pa.Array) -> np.ndarray:
    return np.flatnonzero(pc.match_substring_regex(texts, CANDIDATE).to_numpy(zero_copy_only=False))


def scan(docs: DataFrame, keep: list[str] | None = None, redacted: bool = False) -> DataFrame:
    """Add secrets (kind, start, end, depth) of text to the columns named by keep (all by default).

    With redacted, the column text has each union of overlapping spans replaced by [REDACTED].
    """
    keep = [c for c in (keep or docs.columns) if c != "secrets"]
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("secrets", SPANS)])
    inner = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("depth", pa.int32())]))

    def run(batches):
        for batch in steps(batches):
            texts = plain(batch.column("text"))
            spans: list = [[] for _ in range(batch.num_rows)]
            changed = {}
            for i in _candidates(texts):
                text = texts[int(i)].as_py()
                spans[i] = [dict(zip(("kind", "start", "end", "depth"), x)) for x in scan_text(text)]
                if redacted and spans[i]:
                    changed[i] = redact(text, spans[i])
            columns = {c: batch.column(c) for c in keep}
            if changed:
                columns["text"] = pa.array([changed.get(i, x) for i, x in enumerate(batch.column("text").to_pylist())], pa.string())
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(spans, inner)], names=[*keep, "secrets"])

    columns = keep if "text" in keep else [*keep, "text"]
    return bounded(docs).select(*columns).mapInArrow(run, schema)


def redact(text: str, spans: list[dict], mark: str = "[REDACTED]") -> str:
    """text with each union of overlapping spans replaced by mark."""
    out, at = [], 0
    for span in sorted(spans, key=lambda x: (x["start"], x["end"])):
        if span["start"] >= at:
            out += [text[at : span["start"]], mark]
        at = max(at, span["end"])
    return "".join(out) + text[at:]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: secrets of every whole text of documents; base spans are those at depth 0."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("secrets", lambda x: x["depth"] == 0)
    count = lambda kind: F.size(F.filter("secrets", lambda x: (x["depth"] == 0) & (x["kind"] == kind))).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return found.select("doc_id", *map(count, KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
