"""The block coder of op6: adaptive context mixing and a range coder, many blocks in lock step.

A file's tables give the starting state of each of its blocks: how often each symbol
occurs (order 0), how often each symbol follows each other one (order 1), and what mostly
follows the commonest pairs (order 2). A block then adapts by itself:

* order 2 predicts one symbol, what last followed the two before. The chance that it
  comes is mixed, in log odds and by weights that adapt, from the record of guesses
  as trusted as this one, its order-1 chance and its order-0 chance;
* else the symbol is coded by order 1, the failed guess left out, unless it never or once followed in the file:
  the chance of this is mixed from the tables' and the block's own record;
* else it is coded by order 0.

All of it is integer arithmetic. Blocks share nothing but the tables: each starts
from the same state, so any can be decoded by itself; numpy works on one symbol of every
block at a time, in all lanes alike: what a lane has no need of is coded with the chance 1, which takes no bits.

The coder is of the asymmetric kind (a range coder with one number for its state): coding goes backwards over
what a forward pass has noted down, and decoding forwards. States have 64 bits, output units 32.
"""

from __future__ import annotations

import math
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Slots of the order-2 table of a block (a power of two).
SLOTS = 1024
#: Times that a pair must occur for order 1, and what follows it for the start of order 2.
LEAST_PAIR, LEAST_TRIPLE = 2, 8
#: Least state of a lane (64 bits at most), and bits of a unit.
LEAST, UNIT = np.uint64(1 << 32), np.uint64(32)
#: Bits of the chance of a flag and of a symbol; the bits that the sum of a context's frequencies is scaled down to (small ones stay at 1).
FLAG_BITS, SYMBOL_BITS, SUM_BITS = 12, 24, 17
FLAG_SHIFT, SYMBOL_SHIFT = np.uint64(FLAG_BITS), np.uint64(SYMBOL_BITS)
FLAG_MASK, SYMBOL_MASK = np.uint64((1 << FLAG_BITS) - 1), np.uint64((1 << SYMBOL_BITS) - 1)
#: log odds of a chance in 1/256, and back.
STRETCH = np.array([round(256 * math.log((p + 0.5) / (4095.5 - p))) for p in range(4096)], np.int32).clip(-2047, 2047)
SQUASH = np.array([round(4096 / (1 + math.exp(-x / 256))) for x in range(-2048, 2049)], np.int32).clip(64, 4032)
#: The record of a guess starts at its trust's chance.
TRUSTED = np.array([200, 600, 1400, 2000, 2500, 2900, 3200, 3400], np.int32)
#: By right * 16 + valid * 8 + trust: whether a guess stays, and its trust then. What was right gains trust; what was wrong loses it, and is replaced once it has none.
STAYS = np.array([right or (valid and trust > 1) for right in (0, 1) for valid in (0, 1) for trust in range(8)], bool)
TRUST = np.array([min(trust + 1, 7) if right else trust >> 1 if valid and trust > 1 else 1 for right in (0, 1) for valid in (0, 1) for trust in range(8)], np.int64)
COUNTS = struct.Struct("<III")


def _level(n: np.ndarray) -> np.ndarray:
    """Counts as half powers of two."""
    return np.round(2 * np.log2(np.maximum(n, 1))).astype(np.uint8)


def _scaled(level: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """Frequencies of levels, so that a group's sum has about SUM_BITS bits at most."""
    count = np.floor(np.exp2(np.arange(256) / 2).clip(0, 1 << 40) + 0.5).astype(np.int64)[level]
    sums = np.bincount(groups, count, n)
    down = np.ceil(np.log2(np.maximum(sums, 1))).astype(np.int64) - SUM_BITS
    return np.maximum(count >> np.maximum(down, 0)[groups], 1)


def _log_odds(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return STRETCH[np.minimum((part << FLAG_BITS) // np.maximum(whole, 1), 4095)]


def _slot(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    return (before * 30011 + last * 40503) >> 4 & (SLOTS - 1)


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in ascending order, and how often each occurs."""
    values = np.sort(values)
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    return values[starts], np.diff(starts, append=len(values))


@dataclass(frozen=True)
class Tables:
    """A file's symbols in ascending order, the half-log counts of them, of pairs and of rare pairs by first symbol, and starts of order 2.

    Symbols are numbered by their place in names; a pair by its place in the order of both numbers.
    """

    names: np.ndarray
    level0: np.ndarray
    rare: np.ndarray  # level of the rare pairs of a first symbol, plus 1; 0 for none
    first: np.ndarray
    second: np.ndarray
    level1: np.ndarray
    slots: np.ndarray
    heads: np.ndarray  # the pair that a slot starts with

    @classmethod
    def learn(cls, symbols: np.ndarray) -> Tables:
        """Tables of all symbols of a file."""
        return cls.learn_pairs(symbols)[0]

    @classmethod
    def learn_pairs(cls, symbols: np.ndarray, least: int = LEAST_PAIR) -> tuple[Tables, np.ndarray]:
        """Tables of all symbols of a file, of pairs that occur least times, and the pair of each symbol but the first with the one before it (or the number of pairs)."""
        times = np.bincount(symbols, minlength=1)
        names = np.flatnonzero(times)
        v = len(names)
        x = (np.cumsum(times > 0) - 1)[symbols].astype(np.int64)
        whole = x[:-1] * max(v, 1) + x[1:]
        keys, n = _counted(whole)
        often = n >= least
        singles = np.bincount(keys[~often] // max(v, 1), n[~often], v).astype(np.int64)
        keys, n = keys[often], n[often]
        slots = heads = np.zeros(0, np.int64)
        pair = place(keys, whole)
        if len(keys):
            slot = _slot(x[:-2], x[1:-1])
            common = np.append(n >= LEAST_TRIPLE, False)[pair[1:]]  # what follows a pair often enough is in a common pair with its second symbol
            triples, m = _counted(slot[common] * len(keys) + pair[1:][common])
            by = triples // len(keys)
            best = np.lexsort((triples, -m, by))
            lead = best[np.r_[True, by[best][1:] != by[best][:-1]]] if len(best) else best
            lead = lead[m[lead] >= LEAST_TRIPLE]
            lead = lead[2 * m[lead] > np.bincount(slot, minlength=SLOTS)[by[lead]]]
            slots, heads = by[lead], triples[lead] % len(keys)
        first = keys // max(v, 1)
        return cls(names, _level(times[names]), np.where(singles > 0, _level(singles) + 1, 0).astype(np.uint8), first, keys - first * v, _level(n), slots, heads), pair

    def dump(self) -> bytes:
        """The tables as bytes."""
        per = np.bincount(self.first, minlength=len(self.names))
        turn = np.r_[True, self.first[1:] != self.first[:-1]] if len(self.first) else np.zeros(0, bool)
        gaps = np.where(turn, self.second, np.diff(self.second, prepend=0))
        parts = [np.diff(self.names, prepend=0), self.level0, self.rare, per, gaps, self.level1, np.diff(self.slots, prepend=0), self.heads]
        raw = b"".join(p.astype(t).tobytes() for p, t in zip(parts, ("<u4", "u1", "u1", "<u4", "<u4", "u1", "<u2", "<u4")))
        return COUNTS.pack(len(self.names), len(self.first), len(self.slots)) + zlib.compress(raw, 5)

    @classmethod
    def load(cls, data: bytes) -> Tables:
        """The tables that dump gave."""
        v, p, s = COUNTS.unpack_from(data)
        raw, at, parts = zlib.decompress(data[COUNTS.size :]), 0, []
        for n, t in ((v, "<u4"), (v, "u1"), (v, "u1"), (v, "<u4"), (p, "<u4"), (p, "u1"), (s, "<u2"), (s, "<u4")):
            parts.append(np.frombuffer(raw, t, n, at).astype(np.uint8 if t == "u1" else np.int64))
            at += parts[-1].size * np.dtype(t).itemsize
        names, level0, rare, per, gaps, level1, slots, heads = parts
        first = np.repeat(np.arange(v), per)
        ends = np.cumsum(gaps)
        second = ends - np.r_[0, ends][(np.cumsum(per) - per)[first]]
        return cls(np.cumsum(names), level0, rare, first, second, level1, np.cumsum(slots), heads)


def place(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted key among the given ones, or their number where it is none."""
    found = pc.index_in(pa.array(wanted), value_set=pa.array(keys))
    return pc.fill_null(found, len(keys)).to_numpy()


class _Model:
    """What the tables say, ready to look up: by context (a symbol's number, or v for none before) and by entry.

    Entries are the pairs, then one for no pair, then the symbols by order 0.
    """

    def __init__(self, tables: Tables):
        v, pairs = len(tables.names), len(tables.first)
        self.v, self.pairs = v, pairs
        n0 = _scaled(tables.level0, np.zeros(v, np.int64), 1)
        n1 = _scaled(tables.level1, tables.first, v)
        whole0, whole1 = int(n0.sum()), np.bincount(tables.first, n1, v + 1).astype(np.int64)
        rare = np.append(np.where(tables.rare > 0, np.floor(np.exp2((np.maximum(tables.rare, 1) - 1) / 2) + 0.5), 0).astype(np.int64), 0)
        real = np.bincount(tables.first, np.exp2(tables.level1 / 2), v + 1)
        rare = np.where((rare > 0) & (whole1 > 0), np.maximum((rare * whole1 / np.maximum(real, 1)).astype(np.int64), 1), rare)
        self.first = np.append(tables.first, -1)
        self.symbol = np.concatenate([tables.second, [0], np.arange(v)])
        # where an entry starts in its context, and its frequency; no pair has none
        self.offset = np.cumsum(whole1) - whole1
        self.low = np.concatenate([np.cumsum(n1) - n1 - self.offset[tables.first], [0], np.cumsum(n0) - n0])
        self.n = np.concatenate([n1, [0], n0])
        # and which entry a part belongs to: those of a context from its offset on, those of order 0 from outer on
        self.whole, self.whole0, self.outer = whole1, whole0, int(n1.sum())
        self.entry = np.repeat(np.append(np.arange(pairs), pairs + 1 + np.arange(v)).astype(np.int32), np.append(n1, n0))
        # log odds of a guess by both orders, and the grade of the former
        order1, order0 = np.append(_log_odds(n1, whole1[tables.first] + rare[tables.first]), 0), _log_odds(n0, whole0)
        self.order1, self.order0 = order1.astype(np.int32), np.append(order0[tables.second], 0).astype(np.int32)
        self.grade = (self.order1.clip(-1024, 1023).astype(np.int64) + 1024) >> 8
        # log odds of a rare follower, whether its chance is mixed, and its chance where it isn't
        self.odds = _log_odds(rare, whole1 + rare).astype(np.int32)
        self.rare = rare > 0

    def span(self, found: np.ndarray, gone: np.ndarray, hole: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The start and the number of an entry's parts, of 1 << SYMBOL_BITS; gone of its context's whole are left out from hole on."""
        low = self.low.take(found, mode="clip")
        low -= gone * (low > hole)
        high = low + self.n.take(found, mode="clip")
        # below 2 ** 53 and a whole below 2 ** 24, so that doubles round to the quotient's floor
        start = ((low << SYMBOL_BITS) / whole).astype(np.int64)
        return start, ((high << SYMBOL_BITS) / whole).astype(np.int64) - start


class _Mixer:
    """A chance for each lane, mixed from log odds by weights that adapt."""

    def __init__(self, lanes: int, start: tuple[float, ...]):
        self.weights = np.repeat(np.array([[round(w * (1 << 16))] for w in start], np.int32), lanes, 1)
        self.inputs = np.zeros_like(self.weights)

    def mix(self) -> np.ndarray:
        total = np.add.reduce(self.weights * self.inputs, 0, dtype=np.int32)
        total >>= 16
        self.chance = SQUASH.take(total + 2048, mode="clip")
        return self.chance

    def learn(self, bit: np.ndarray, asked: np.ndarray) -> None:
        """Learn from the lanes asked."""
        step = self.inputs * (((bit.astype(np.int32) << FLAG_BITS) - self.chance) * asked)
        step >>= 10
        step += self.weights
        np.minimum(np.maximum(step, -(1 << 18), out=step), 1 << 18, out=self.weights)

    def keep(self, m: int) -> None:
        self.weights, self.inputs = self.weights[:, :m].copy(), self.inputs[:, :m].copy()


class _Reader:
    """Lanes that take parts from their units; lane i's begin at at[i]."""

    def __init__(self, units: np.ndarray, at: np.ndarray):
        self.units = np.append(units, 0).astype(np.uint64)  # a damaged payload may ask for more
        self.at = at + 2
        self.state = (self.units.take(at, mode="clip") << UNIT) | self.units.take(at + 1, mode="clip")

    def flag(self, chance: np.ndarray) -> np.ndarray:
        """Whether a flag of this chance is set; two in a row may go before the next unit is taken."""
        chance = chance.astype(np.uint64)
        aim = self.state & FLAG_MASK
        bit = aim < chance
        below = self.state >> FLAG_SHIFT
        below *= chance
        self.state -= below
        self.state -= chance
        below += aim
        np.copyto(self.state, below, where=bit)
        return bit

    def aim(self) -> np.ndarray:
        """The part that is to be taken."""
        return (self.state & SYMBOL_MASK).view(np.int64)

    def take(self, start: np.ndarray, parts: np.ndarray, aim: np.ndarray) -> None:
        self.state >>= SYMBOL_SHIFT
        self.state *= parts.view(np.uint64)
        self.state += (aim - start).view(np.uint64)

    def fill(self) -> None:
        """Take a unit where the state has become too small."""
        short = self.state < LEAST
        more = self.state << UNIT
        more |= self.units.take(self.at, mode="clip")
        np.copyto(self.state, more, where=short)
        self.at += short

    def keep(self, m: int) -> None:
        self.state, self.at = self.state[:m].copy(), self.at[:m].copy()


class _Writer:
    """Lanes that put parts into their units, from the last on."""

    def __init__(self, lanes: int, longest: int):
        self.room = 2 * longest + 4  # a symbol and its two flags take 48 bits at most
        self.units = np.zeros(lanes * self.room, np.uint32)
        self.at = np.arange(1, lanes + 1) * self.room - 1  # where the next unit goes
        self.state = np.full(lanes, LEAST)

    def spill(self, m: int, parts: np.ndarray) -> None:
        """Put out a unit where the state is too large for so many parts of 1 << SYMBOL_BITS."""
        state, at = self.state[:m], self.at[:m]
        full = (state >> (np.uint64(64) - SYMBOL_SHIFT)) >= parts
        self.units[at] = state.astype(np.uint32)  # stays only if the place moves on
        at -= full
        np.copyto(state, state >> UNIT, where=full)

    def put(self, m: int, start: np.ndarray, parts: np.ndarray, bits: np.uint64) -> None:
        """What a reader takes; both of the flags make up as many bits as a symbol."""
        state = self.state[:m]
        times = state // parts
        times *= (np.uint64(1) << bits) - parts
        state += times
        state += start

    def finish(self) -> list[bytes]:
        """Each lane's bytes."""
        for _ in range(2):
            self.units[self.at] = self.state.astype(np.uint32)
            self.at -= 1
            self.state >>= UNIT
        return [self.units[a + 1 : (i + 1) * self.room].astype("<u4").tobytes() for i, a in enumerate(self.at.tolist())]


def _run(lengths: np.ndarray, model: _Model, tables: Tables, reader: _Reader | None, numbers: np.ndarray, pair: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Decode a reader's symbols to numbers (a row a step, a column a block; only the last block may be shorter), or follow
    the numbers and pairs given; this gives the chance of the first flag, the guess or no pair, whether it was right, and the other chance."""
    lanes, longest = len(lengths), int(lengths[0])
    pairs = model.pairs
    table = np.full(SLOTS, pairs << 3, np.int32)
    table[tables.slots] = tables.heads << 3 | 3
    table = np.tile(table, lanes)
    record = np.tile(np.repeat(TRUSTED, 8), lanes)
    missed = np.full(lanes * 4, 2048, np.int32)
    hits, escapes = _Mixer(lanes, (0.7, 0.3, 0.0)), _Mixer(lanes, (1.0, 0.0))
    every = np.arange(lanes)
    before = last = np.full(lanes, model.v, np.int64)
    chances, guesses, rights = (np.zeros(numbers.shape if reader is None else 0, t) for t in (np.int16, np.int32, bool))
    others = np.ones(chances.shape, np.int16)
    m = lanes
    for t in range(longest):
        if t == lengths[-1]:  # the last block has ended
            m -= 1
            before, last, every = before[:m], last[:m], every[:m]
            for each in (hits, escapes, *[reader] * (reader is not None)):
                each.keep(m)
        slot = _slot(before, last)
        slot += every * SLOTS
        held = table.take(slot, mode="clip").astype(np.int64)
        guess, trust = held >> 3, held & 7
        valid = model.first.take(guess, mode="clip") == last

        # order 2's guess, by what all three orders say of it
        state = model.grade.take(guess, mode="clip")
        state += every << 6
        state += trust << 3
        past = record.take(state, mode="clip")
        STRETCH.take(past, out=hits.inputs[0], mode="clip")
        model.order1.take(guess, out=hits.inputs[1], mode="clip")
        model.order0.take(guess, out=hits.inputs[2], mode="clip")
        chance = hits.mix() * valid
        if reader is None:
            entry = pair[t, :m]
            right = (entry == guess) & valid
            chances[t, :m], rights[t, :m] = chance, right
        else:
            right = reader.flag(chance)
        wrong = ~right
        hits.learn(right, valid)
        past += ((right.astype(np.int32) << FLAG_BITS) - past >> 4) * valid
        record[state] = np.minimum(np.maximum(past, 1), 4095)

        # a pair that the tables lack
        guessed = np.where(valid, guess, pairs)
        gone = model.n.take(guessed, mode="clip")
        whole = model.whole.take(last, mode="clip") - gone
        bare = whole == 0
        asked = model.rare.take(last, mode="clip")
        asked &= wrong
        asked &= ~bare
        other = np.minimum(trust, 3)
        other += every << 2
        past = missed.take(other, mode="clip")
        model.odds.take(last, out=escapes.inputs[0], mode="clip")
        STRETCH.take(past, out=escapes.inputs[1], mode="clip")
        chance = escapes.mix() * asked
        chance += (bare & wrong).astype(np.int32) << FLAG_BITS
        if reader is None:
            outer = entry == pairs
            guesses[t, :m], others[t, :m] = guessed, chance
        else:
            outer = reader.flag(chance)
        escapes.learn(outer, asked)
        past += ((outer.astype(np.int32) << FLAG_BITS) - past >> 5) * asked
        missed[other] = np.minimum(np.maximum(past, 1), 4095)

        # order 1 or order 0
        if reader is None:
            value = numbers[t, :m].astype(np.int64)
        else:
            reader.fill()
            gone *= ~outer
            whole = np.where(outer, model.whole0, np.maximum(whole, 1))
            aim = reader.aim()
            part = (aim + 1) * whole
            part -= 1
            part >>= SYMBOL_BITS
            hole = model.low.take(guessed, mode="clip")
            part += gone * (part >= hole)
            part += np.where(outer, model.outer, model.offset.take(last, mode="clip"))
            found = np.where(right, guess, model.entry.take(part, mode="clip"))
            start, parts = model.span(found, gone, hole, whole)
            start[right], parts[right] = 0, 1 << SYMBOL_BITS
            reader.take(start, parts, aim)
            reader.fill()
            value = model.symbol.take(found, mode="clip")
            numbers[t, :m] = value
            entry = np.minimum(found, pairs)

        turn = trust + (valid.view(np.int8) << 3) + (right.view(np.int8) << 4)
        kept = np.where(STAYS.take(turn, mode="clip"), guess, entry)
        kept <<= 3
        kept += TRUST.take(turn, mode="clip")
        table[slot] = kept
        before, last = last, value
    return chances, guesses, rights, others


def _blocks(n: int, block: int) -> np.ndarray:
    """Lengths of the blocks of n symbols."""
    return np.diff([*range(0, n, block), n])


def encode(symbols: np.ndarray, tables: Tables, block: int = 2048, pairs: np.ndarray | None = None) -> tuple[bytes, list[int]]:
    """Payloads of all blocks of symbols in a row, and the bytes of each; a symbol or a pair that the tables lack is an error.

    The pairs are those of learn_pairs, and looked up if they aren't given.
    """
    if not len(symbols):
        return b"", []
    lengths = _blocks(len(symbols), block)
    lanes, longest, v = len(lengths), int(lengths[0]), len(tables.names)
    numbers = np.searchsorted(tables.names, symbols) if tables.names[-1] >= v else symbols
    if (tables.names[np.minimum(numbers, v - 1)] != symbols).any():
        raise ValueError("a symbol is not in the tables")
    model = _Model(tables)
    pair = np.full((longest, lanes), model.pairs, np.int32)
    laid = np.zeros((longest, lanes), np.int32)
    if pairs is None:
        pairs = place(tables.first * v + tables.second, numbers[:-1].astype(np.int64) * v + numbers[1:])
    followed = np.append(model.pairs, pairs)
    followed[::block] = model.pairs
    for to, given in ((laid, numbers), (pair, followed)):
        whole = (lanes - 1) * block
        to[:, : lanes - 1] = given[:whole].reshape(lanes - 1, block)[:, :longest].T if lanes > 1 else 0
        to[: lengths[-1], lanes - 1] = given[whole:]
    chances, guesses, rights, others = _run(lengths, model, tables, None, laid, pair)
    outer = pair == model.pairs
    if (outer & (others == 0)).any():
        raise ValueError("a pair is not in the tables")
    writer = _Writer(lanes, longest)
    contexts = np.vstack([np.full((1, lanes), v, np.int32), laid[:-1]])
    for t in range(longest - 1, -1, -1):
        m = lanes if t < lengths[-1] else lanes - 1
        right, beyond, guess = rights[t, :m], outer[t, :m], guesses[t, :m].astype(np.int64)
        gone = model.n.take(guess, mode="clip")
        whole = np.where(beyond, model.whole0, np.maximum(model.whole.take(contexts[t, :m], mode="clip") - gone, 1))
        gone *= ~beyond
        found = np.where(beyond, model.pairs + 1 + laid[t, :m], pair[t, :m])
        start, n = model.span(found, gone, model.low.take(guess, mode="clip"), whole)
        start[right], n[right] = 0, 1 << SYMBOL_BITS
        start, n = start.view(np.uint64), n.view(np.uint64)
        writer.spill(m, n)
        writer.put(m, start, n, SYMBOL_SHIFT)
        flags = [(c * ~b, np.where(b, c, (1 << FLAG_BITS) - c).astype(np.uint64)) for c, b in ((others[t, :m].astype(np.uint64), beyond), (chances[t, :m].astype(np.uint64), right))]
        writer.spill(m, flags[0][1] * flags[1][1])
        for start, n in flags:
            writer.put(m, start, n, FLAG_SHIFT)
    parts = writer.finish()
    return b"".join(parts), [len(p) for p in parts]


def decode(payload: bytes, sizes: list[int], n: int, tables: Tables, block: int = 2048) -> np.ndarray:
    """The n symbols of payloads in a row, of the given bytes each."""
    if not n:
        return np.zeros(0, np.int32)
    lengths = _blocks(n, block)
    numbers = np.zeros((int(lengths[0]), len(lengths)), np.int32)
    ends = np.cumsum(sizes) // 4
    reader = _Reader(np.frombuffer(payload, "<u4", int(ends[-1])), ends - np.array(sizes) // 4)
    _run(lengths, _Model(tables), tables, reader, numbers)
    return tables.names[np.concatenate([numbers[:, :-1].T.ravel(), numbers[: lengths[-1], -1]])].astype(np.int32)
