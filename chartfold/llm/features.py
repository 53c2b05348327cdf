"""Features of texts and a linear model over them, for the two text classifiers.

A text's features are the hashed words, word pairs and runs of three bytes that it holds,
each family as frequencies, and a few ratios of its form. A linear score over frequencies is
the mean of the weights met in the text, so scoring gathers weights and averages them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from chartfold.llm.grams import (
    CONTINUES, SPACE_WORD, U, Words, covered, marks, mixed, owners, per_text, repeated, spans_hash)

WORD_BITS, CHAR_BITS = 15, 15
FIT_BYTES = 1 << 21  # texts to fit on are cut into larger slices, as each has a gradient
SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
UPPER = np.array([65 <= c <= 90 for c in range(256)])
LETTER = np.array([c >= 128 or chr(c).isalpha() for c in range(256)])
MARK = np.array([c < 128 and not chr(c).isalnum() and not chr(c).isspace() and c > 32 for c in range(256)])
RATIOS = ("repeated words", "repeated lines", "distinct words", "symbols", "marks", "upper", "word length", "length")


@dataclass
class Counts:
    """Counts of the form of texts; the same rules serve as base rules and as features."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray


def counts(data: np.ndarray, offsets: np.ndarray, words: Words) -> Counts:
    in_word = SPACE_WORD[data]
    char = in_word & ~CONTINUES[data]
    window, of, h = words.grams(5)
    twice = window[repeated(mixed(h + of.astype(U) * U(0x9E3779B97F4A7C15)))]
    repeats = per_text(covered(len(words.hashes), twice, 5), words.first)
    starts, ends = marks(data != 10, offsets)
    worded = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[worded], ends[worded]
    line_first = np.searchsorted(starts, offsets)
    line_of = owners(line_first)
    keys = mixed(spans_hash(data, starts, ends) + line_of.astype(U) * U(0x9E3779B97F4A7C15))
    _, at = np.unique(keys, return_index=True)
    distinct = np.bincount(line_of[at], minlength=len(offsets) - 1)
    return Counts(words.counts(), per_text(char, offsets), per_text(SYMBOL[data], offsets),
                  np.diff(line_first) - distinct, repeats)


class Features:
    """Bucket numbers of the three families, with the places of the texts in each, and ratios."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets)
        self.counts = c = counts(data, offsets, words)
        top = U(64 - WORD_BITS)
        _, pair_of, pair = words.grams(2)
        code = data.astype(np.uint32)
        run = code[:-2] | (code[1:-1] << 8) | (code[2:] << 16) if len(code) > 2 else np.zeros(0, np.uint32)
        run = (run * np.uint32(2654435761)) >> np.uint32(32 - CHAR_BITS)
        # A run that crosses a text's end belongs to no text.
        last = np.maximum(offsets[1:] - 2, offsets[:-1])
        self.families = [
            ((words.hashes >> top).astype(np.int32), words.first[:-1], words.first[1:]),
            ((pair >> top).astype(np.int32) + (1 << WORD_BITS),
             np.searchsorted(pair_of, np.arange(len(offsets) - 1)),
             np.searchsorted(pair_of, np.arange(len(offsets) - 1), "right")),
            (run.astype(np.int32) + (2 << WORD_BITS), np.minimum(offsets[:-1], len(run)), np.minimum(last, len(run))),
        ]
        n, size = np.maximum(c.n_words, 1), np.maximum(np.diff(offsets), 1)
        keys = mixed(words.hashes + owners(words.first).astype(U) * U(0x9E3779B97F4A7C15))
        _, at = np.unique(keys, return_index=True)
        distinct = np.bincount(owners(words.first)[at], minlength=len(offsets) - 1)
        lines = per_text(data == 10, offsets) + 1
        letters = np.maximum(per_text(LETTER[data], offsets), 1)
        self.ratios = np.stack([
            c.n_repeat_words / n, c.n_dup_lines / lines, distinct / n, c.n_symbols / size,
            per_text(MARK[data], offsets) / size, per_text(UPPER[data], offsets) / letters,
            np.minimum(c.word_chars / n, 20) / 20, np.log1p(n) / 10], axis=1)

    def __len__(self) -> int:
        return len(self.ratios)


SIZE = (2 << WORD_BITS) + (1 << CHAR_BITS)


@dataclass
class Model:
    weights: np.ndarray
    ratio_weights: np.ndarray
    bias: float

    @classmethod
    def blank(cls) -> Model:
        return cls(np.zeros(SIZE), np.zeros(len(RATIOS)), 0.0)

    def scores(self, features: Features) -> np.ndarray:
        z = features.ratios @ self.ratio_weights + self.bias
        for bucket, low, high in features.families:
            sums = np.zeros(len(bucket) + 1)
            np.cumsum(self.weights[bucket], out=sums[1:])
            z = z + (sums[high] - sums[low]) / np.maximum(high - low, 1)
        return z

    def pull(self, features: Features, slope: np.ndarray) -> np.ndarray:
        """The gradient of sum(slope * score) as one vector: weights, ratios, bias."""
        g = np.zeros(SIZE)
        for bucket, low, high in features.families:
            share = slope / np.maximum(high - low, 1)
            edge = np.zeros(len(bucket) + 1)
            np.add.at(edge, low, share)
            np.add.at(edge, high, -share)
            g += np.bincount(bucket, np.cumsum(edge[:-1]), SIZE)
        return np.concatenate([g, slope @ features.ratios, [slope.sum()]])

    def vector(self) -> np.ndarray:
        return np.concatenate([self.weights, self.ratio_weights, [self.bias]])

    @classmethod
    def of(cls, vector: np.ndarray) -> Model:
        return cls(vector[:SIZE], vector[SIZE:-1], float(vector[-1]))


def descend(gradient, steps: int, rate: float) -> Model:
    """Adam from zero; frequencies are small, so that step sizes must be each weight's own."""
    v = Model.blank().vector()
    mean, square = np.zeros_like(v), np.zeros_like(v)
    for t in range(1, steps + 1):
        g = gradient(Model.of(v))
        mean = 0.9 * mean + 0.1 * g
        square = 0.999 * square + 0.001 * g * g
        v = v - rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-10)
    return Model.of(v)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
