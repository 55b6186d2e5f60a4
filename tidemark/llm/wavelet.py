"""Wavelet matrix over a small alphabet: how often a symbol occurs before a place, for many places at once."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """
    One bit vector for each bit of the symbols, the highest first; each level is stably ordered by the bit of the one above.
    A vector is kept as 64-bit words with the number of ones before each word, so a rank costs one look a level.
    """

    def __init__(self, symbols: np.ndarray, bits: int):
        self.n, self.bits, self.levels = len(symbols), bits, []
        for level in range(bits - 1, -1, -1):
            ones = (symbols >> level) & 1 == 1
            packed = np.zeros((self.n // 64 + 1) * 8, np.uint8)
            packed[: (self.n + 7) // 8] = np.packbits(ones, bitorder="little")
            words = packed.view(np.uint64)
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.levels.append((words, before, self.n - int(ones.sum())))
            if level:
                symbols = np.concatenate((symbols[~ones], symbols[ones]))

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(words[word] & below)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """Occurrences of the symbol before each place (0 to n)."""
        at, first = np.asarray(at, np.int64), np.zeros(1, np.int64)
        for i, (words, before, zeros) in enumerate(self.levels):
            ones, own = self._ones(words, before, at), self._ones(words, before, first)
            if symbol >> (self.bits - 1 - i) & 1:
                at, first = zeros + ones, zeros + own
            else:
                at, first = at - ones, first - own
        return at - first
