"""An FM-index over words: suffix sorting, wavelet matrix, backward search, sampled suffix positions."""

from __future__ import annotations

import numpy as np

#: Every so many positions, and at each document's first, a suffix position is kept.
SAMPLE = 16
#: Rows whose positions are found at a time.
LOCATE_ROWS = 1 << 18


def suffix_ranks(symbols: np.ndarray) -> np.ndarray:
    """The rank of each suffix. Symbols are at least 1; a 0 ends a document, and the zeros count as different
    symbols in order of place, so no comparison goes beyond a document. Prefix doubling: suffixes are told apart by
    2, 4, 8, ... symbols, and only those not yet alone are sorted again."""
    n = len(symbols)
    width = n.bit_length()
    low, pair_of = (1 << width) - 1, 2 * width
    zeros = symbols == 0
    count = int(np.count_nonzero(zeros))
    first = symbols.astype(np.int64) + (count - 1)
    first[zeros] = np.arange(count)
    rank = np.empty(n, np.int64)
    key = first << pair_of | np.append(first[1:], 0) << width | np.arange(n)
    base, reach = None, 2
    while len(key):
        key.sort()
        at = np.arange(len(key))
        pair, where = key >> width, key & low
        opens = np.concatenate([[True], pair[1:] != pair[:-1]])
        place = np.maximum.accumulate(np.where(opens, at, 0))
        if base is not None:  # inside a group of equal prefixes: from its first rank on
            old = key >> pair_of
            begins = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), at, 0))
            place += old - begins
        rank[where] = place
        alone = opens & np.append(opens[1:], True)
        base, left = True, where[~alone]
        # A suffix that is not alone agrees with another for `reach` symbols, none of which ends a document.
        key = rank[left] << pair_of | rank[left + reach] << width | left
        reach *= 2
    return rank


class Bits:
    """Bit rows with rank: `ones(level, i)` counts the ones before i."""

    def __init__(self, packed: np.ndarray):
        self.words = packed
        self.before = np.zeros(packed.shape, np.int64)
        np.cumsum(np.bitwise_count(packed[:, :-1]), axis=1, out=self.before[:, 1:])

    @staticmethod
    def pack(bits: np.ndarray) -> np.ndarray:
        """One row of bits as 64-bit words, one word longer than needed."""
        out = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        out[:len(packed)] = packed
        return out.view("<u8")

    def get(self, level: int, i: np.ndarray) -> np.ndarray:
        return (self.words[level, i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)

    def ones(self, level: int, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level, word] + np.bitwise_count(self.words[level, word] & below)


class FmIndex:
    """The Burrows-Wheeler transform of documents of words, in a wavelet matrix, with sampled suffix positions."""

    def __init__(self, counts: np.ndarray, levels: np.ndarray, marks: np.ndarray, samples: np.ndarray):
        self.counts, self.levels, self.marks, self.samples = counts, Bits(levels), Bits(marks), samples
        self.size = int(counts.sum())
        self.first = np.concatenate([[0], np.cumsum(counts)])
        ones = self.levels.ones
        self.zeros = [self.size - int(ones(k, np.array([self.size]))[0]) for k in range(len(levels))]
        self.start = self._follow(np.arange(len(counts)), np.zeros(len(counts), np.int64))

    @classmethod
    def build(cls, symbols: np.ndarray) -> FmIndex:
        """Of documents, each ended by 0, whose words are numbered from 1."""
        n, rank = len(symbols), suffix_ranks(symbols)
        suffix = np.empty(n, np.int64)
        suffix[rank] = np.arange(n)
        turned = symbols[suffix - 1].astype(np.uint32)
        counts = np.bincount(symbols)
        levels = []
        for shift in reversed(range(max(1, (len(counts) - 1).bit_length()))):
            ones = (turned >> np.uint32(shift) & np.uint32(1)).astype(bool)
            levels.append(Bits.pack(ones))
            turned = np.concatenate([turned[~ones], turned[ones]])
        kept = np.zeros(n, bool)
        kept[::SAMPLE] = True
        kept[1:] |= symbols[:-1] == 0
        marked = kept[suffix]
        return cls(counts, np.stack(levels), Bits.pack(marked)[None, :], suffix[marked])

    def packed(self) -> bytes:
        """The index as bytes, see `unpacked`."""
        head = np.array([len(self.counts), *self.levels.words.shape, len(self.samples)], "<u4")
        return b"".join([head.tobytes(), self.levels.words.tobytes(), self.marks.words.tobytes(),
                         self.counts.astype("<u4").tobytes(), self.samples.astype("<u4").tobytes()])

    @classmethod
    def unpacked(cls, data: bytes) -> FmIndex:
        vocabulary, levels, words, _ = np.frombuffer(data, "<u4", 4).tolist()
        at = 16 + 8 * levels * words
        bits = np.frombuffer(data, "<u8", (levels + 1) * words, 16).reshape(levels + 1, words)
        numbers = np.frombuffer(data, "<u4", -1, at + 8 * words).astype(np.int64)
        return cls(numbers[:vocabulary], bits[:levels], bits[levels:], numbers[vocabulary:])

    def _follow(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where place i of the transform goes to at the bottom of the matrix, taking `symbol`'s bits."""
        depth = len(self.zeros)
        for level in range(depth):
            ones = self.levels.ones(level, i)
            i = np.where(symbol >> (depth - 1 - level) & 1, self.zeros[level] + ones, i - ones)
        return i

    def _before(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """The first i rows as seen from the rows one symbol longer."""
        return self.first[symbol] + self._follow(symbol, i) - self.start[symbol]

    def _step(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that is one symbol longer."""
        symbol, i, depth = np.zeros(len(row), np.int64), row, len(self.zeros)
        for level in range(depth):
            bit = self.levels.get(level, i).astype(bool)
            ones = self.levels.ones(level, i)
            i = np.where(bit, self.zeros[level] + ones, i - ones)
            symbol |= bit.astype(np.int64) << (depth - 1 - level)
        return self.first[symbol] + i - self.start[symbol]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first row, end row) per phrase, a row of symbols: backward search for all at once. Phrases are aligned to
        the right; 0 on the left is no symbol. A symbol below 0 is in no document."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size)
        high[(phrases < 0).any(axis=1) | (phrases[:, -1] == 0)] = 0
        for column in reversed(range(phrases.shape[1])):
            symbol = phrases[:, column]
            alive = np.flatnonzero((symbol > 0) & (low < high))
            if not len(alive):
                break
            both = self._before(np.tile(symbol[alive], 2), np.concatenate([low[alive], high[alive]]))
            low[alive], high[alive] = both[:len(alive)], both[len(alive):]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text position of each row's suffix: steps back to the next sampled one."""
        found = np.empty(len(rows), np.int64)
        open_, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(open_):
            here = rows[open_]
            marked = self.marks.get(0, here).astype(bool)
            told = open_[marked]
            found[told] = self.samples[self.marks.ones(0, here[marked])] + steps
            open_ = open_[~marked]
            rows[open_] = self._step(here[~marked])
            steps += 1
        return found
