"""Token ids by the tokenizers library, through a cache of the pieces of text between spaces.

The library splits a text into pieces before it merges bytes, and no merge
crosses a piece. A space before anything but white space always starts a piece, so
the text may be cut there and each part encoded by itself; the library then
encodes each distinct part once, and texts are put together from the cache.
New words go to the library many at a time, one after another in a text, as each call
costs as much as several words; the ids' own lengths or ends tell where each word ends.
"""

from __future__ import annotations

import os
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cellscore.llm.arrays import LOWER, give_back, utf8

#: A cut: a space with something other than white space behind it.
CUT = re.compile(r" (?=\S)")
#: Texts (in RE2) that need the slower cut: white space next to white space or at an end.
UNUSUAL = r"[\s\p{Z}\x{1C}-\x{1F}\x{85}][\s\p{Z}\x{1C}-\x{1F}\x{85}]|^\n|[ \n]$|\x{01}"
#: White space of one byte, and the first two bytes of other white space (and of much else).
BLANK = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
WIDE_BLANK = [(0xC2, 0x85), (0xC2, 0xA0), (0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80)]
#: Pieces also end between a small letter and a mark of one byte, but for an apostrophe: many words share their letters. Letters of two bytes are the Latin,
#: Greek and Cyrillic ones here, by their first byte.
MARK = np.isin(np.arange(256), [i for i in range(33, 127) if not chr(i).isalnum() and chr(i) != "'"])
SMALL = np.isin(np.arange(256), range(97, 123))
SMALL_TWO = {0xC3: (0x9F, 0xBF), 0xCE: (0xB1, 0xBF), 0xCF: (0x80, 0x8E), 0xD0: (0xB0, 0xBF), 0xD1: (0x80, 0x9F)}
#: Words that go to the library as one text.
TOGETHER = 64


def _unusual(texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The texts, whose bytes and offsets are given too, that UNUSUAL finds."""
    blank = BLANK[data]
    maybe = blank.copy()  # bytes of white space next to white space or at a text's end, or that may be other white space
    maybe[:-1] &= blank[1:]
    for one, two in WIDE_BLANK:
        at = np.flatnonzero(data == one)
        maybe[at[data[np.minimum(at + 1, len(data) - 1)] == two]] = True
    maybe |= data == 1
    full = offsets[1:] > offsets[:-1]
    for ends in (offsets[:-1][full], offsets[1:][full] - 1):
        maybe[ends] |= blank[ends]
    rows = np.unique(np.searchsorted(offsets, np.flatnonzero(maybe), side="right") - 1)
    return rows[pc.match_substring_regex(texts.take(pa.array(rows)), UNUSUAL).to_numpy(zero_copy_only=False)] if len(rows) else rows


def _cuts(data: np.ndarray, offsets: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Where parts of the texts start: at texts, spaces, both sides of line ends, and marks behind small letters."""
    cut = data == 32
    lines = np.flatnonzero(data == 10)
    cut[lines] = True
    cut[lines[lines + 1 < len(data)] + 1] = True
    stops = np.flatnonzero(marks[data])
    stops = stops[stops > 0]
    before = data[stops - 1]
    small = SMALL[before]
    first = data[np.maximum(stops - 2, 0)]
    for one, (least, most) in SMALL_TWO.items():
        small |= (first == one) & (before >= least) & (before <= most) & ~((first == 0xC3) & (before == 0xB7))
    cut[stops[small]] = True
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


def _lower(data: np.ndarray) -> np.ndarray:
    """Latin letters of one or two bytes in lower case."""
    low = LOWER[data]
    at = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = data[at]
    low[at[(second >= 0x80) & (second <= 0x9E) & (second != 0x97)]] += 0x20
    return low


class Encoder:
    """Encodes texts with one tokenizer file.

    most_parts bounds the cache (some 200 bytes a part). When it is full, the half
    that was used most stays; that costs time but changes no id.
    """

    def __init__(self, path: str, most_parts: int = 400_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; more threads would take others' and hold memory
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.most_parts = most_parts
        self.vocabulary = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        #: bytes of each token, and whether it ends a piece; the one or the other tells words in a row apart
        self.sizes, self.closing = np.zeros(1 + max(self.vocabulary.values()), np.int64), np.zeros(1 + max(self.vocabulary.values()), bool)
        for token, i in self.vocabulary.items():
            self.sizes[i], self.closing[i] = len(token), bool(suffix) and token.endswith(suffix)
        self.by_end, self.by_size = bool(suffix), not suffix and self.tokenizer.normalizer is None
        #: a tokenizer that puts letters in lower case itself gives both cases the same ids, but in special tokens, which it looks for before
        normalizer = self.tokenizer.normalizer
        self.lowers = normalizer is not None and all(normalizer.normalize_str(chr(i)) == chr(i).lower() for i in [*range(65, 91), *range(0xC0, 0xDF)])
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = MARK.copy()  # no cut inside of a special token
        self.marks[list(b"".join(t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()))] = False
        self.codes: dict[str, int] = {}
        self.renewed = 0
        self.ids, self.starts, self.lengths, self.uses = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _append(self, parts: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n = len(self.codes)
        self.codes.update(zip(parts, range(n, n + len(parts))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.uses = np.concatenate([self.uses, np.zeros(len(parts), np.int64)])
        self.ids = np.concatenate([self.ids, ids])

    def _gather(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts in a row, and the end of each part."""
        n = self.lengths[code]
        ends = np.cumsum(n)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[code] - (ends - n), n)
        return self.ids[at], ends

    def ids_of(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts in a row, and how many each has."""
        return self._gather(code)[0], self.lengths[code]

    def _shrink(self) -> None:
        order = np.argsort(-self.uses, kind="stable")[: self.most_parts // 2]
        kept = np.zeros(len(self.uses), bool)
        kept[order] = True
        parts = [p for p, k in zip(self.codes, kept.tolist()) if k]  # the dictionary is in the order of codes
        code = np.flatnonzero(kept)
        ids, _ = self._gather(code)
        lengths, uses = self.lengths[code], self.uses[code] // 2
        self.codes, self.ids, self.starts, self.lengths, self.uses = {}, ids[:0], code[:0], lengths[:0], uses[:0]
        self._append(parts, ids, lengths)
        self.uses = uses
        self.renewed += 1
        give_back()

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts in a row, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array(list(chain.from_iterable(found)), np.int32), np.array(list(map(len, found)), np.int64)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """As _library, for a space and letters each, many in a text; none if the ids don't tell them apart."""
        if not words or not (self.by_end or self.by_size):
            return None
        ids, _ = self._library(["".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)])
        if self.by_end:  # each word is a piece at least, so as many ends as words are one each
            ends = np.flatnonzero(self.closing[ids]) + 1
            if len(ends) != len(words):
                return None
        else:
            upto = np.cumsum(self.sizes[ids])
            wanted = np.cumsum([len(w) if w.isascii() else len(w.encode()) for w in words])
            ends = np.searchsorted(upto, wanted) + 1
            if upto[-1] != wanted[-1] or (upto[ends - 1] != wanted).any():
                return None
        return ids, np.diff(ends, prepend=0)

    def _codes(self, parts: list[str]) -> np.ndarray:
        code = np.fromiter(map(self.codes.get, parts, repeat(-1)), np.int64, len(parts))
        unknown = np.flatnonzero(code < 0).tolist()
        if unknown:
            missing = list(dict.fromkeys([parts[i] for i in unknown]))
            words = [p for p in missing if p[:1] == " " and p[1:].isalpha()]
            coded = self._words(words)
            if coded is not None:
                self._append(words, *coded)
                missing = [p for p in missing if p not in self.codes]
            self._append(missing, *self._library(missing))
            code[unknown] = [self.codes[parts[i]] for i in unknown]
        return code

    def parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The cached parts that make up all texts (large strings without null) in a row, and how many each text has.

        Part i's ids are ids[starts[i] : starts[i] + lengths[i]]. Numbers hold until renewed changes.
        """
        if len(self.codes) > self.most_parts:
            self._shrink()
        data, offsets = utf8(texts)
        if self.lowers:
            low = _lower(data)
            whole = low.tobytes()
            if not any(t in whole for t in self.special):
                data = low
        starts = _cuts(data, offsets, self.marks)
        counts = np.diff(np.searchsorted(starts, offsets))
        slow = {}
        if len(data):
            for i in _unusual(texts, data, offsets).tolist():
                text = texts[i].as_py()
                at = [0, *(m.start() for m in CUT.finditer(text)), len(text)]
                slow[i] = [text[a:b] for a, b in zip(at, at[1:]) if a < b]
        ends = np.append(starts[1:], len(data))
        if slow:  # their parts are those of the slower cut
            kept = ~np.repeat(np.isin(np.arange(len(counts)), list(slow)), counts)
            sizes = ends - starts
            data = data[np.repeat(kept, sizes)]
            ends = np.cumsum(sizes[kept])
        cut = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(np.append(0, ends)), pa.py_buffer(np.ascontiguousarray(data)))
        coded = pc.dictionary_encode(cut)
        code = self._codes(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        if slow:
            counts[list(slow)] = 0
            pieces = np.split(code, np.cumsum(counts)[:-1])
            pieces = [self._codes(slow[i]) if i in slow else p for i, p in enumerate(pieces)]
            counts = np.array([len(p) for p in pieces], np.int64)
            code = np.concatenate(pieces)
        self.uses += np.bincount(code, minlength=len(self.uses))
        return code, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (large strings without null) in a row, and the offsets of each text."""
        code, counts = self.parts(texts)
        ids, ends = self._gather(code)
        return ids, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].astype(np.int64)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, most_parts: int = 400_000) -> Encoder:
    """The encoder of this Python worker for a file; it keeps its cache from task to task, and the larger of the bounds asked for."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, most_parts)
    _ENCODERS[path].most_parts = max(_ENCODERS[path].most_parts, most_parts)
    return _ENCODERS[path]
