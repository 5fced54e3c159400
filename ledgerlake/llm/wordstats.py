"""How much words and their letter runs speak for a label, for all words of a
batch at once.  The tables come from the bounded learning sample; they are the
inputs of the trained classifiers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

GRAMS = (3, 4, 5)
BUCKETS = 1 << 18
WORD_BUCKETS = 1 << 18
RARE = 5
TEXTS, WORDS = 100, 20_000
PRIOR = 2.0
PRIME = np.uint64(0x100000001B3)


def split_words(texts: pa.Array, between: str = r"[^\p{L}\p{N}]+") -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Bounds of each text in the list of word numbers; the numbers; the words.
    No empty words."""
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.int64), []
    split = pc.split_pattern_regex(pc.fill_null(texts, "").cast(pa.large_string()), between)
    ends = split.offsets.to_numpy() - split.offsets[0].as_py()
    found = split.flatten().dictionary_encode()
    words, at = found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy()
    real = np.array(words, object).astype(bool)[at] if len(at) else np.zeros(0, bool)
    return np.r_[0, np.cumsum(real)][ends], at[real].astype(np.int64), words


def word_buckets(words: list[str]) -> np.ndarray:
    return (pd.util.hash_array(np.array(words, dtype=object), categorize=False) & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the letter runs at every place of all words laid end to end,
    a row for each run length (-1: the run would leave its word); and where
    each word starts.  ``^`` and ``$`` mark a word's ends."""
    marked = "^" + "$^".join(words) + "$" if words else ""
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(size) - size
    left = np.repeat(starts + size, size) - np.arange(len(codes))
    out = np.full((len(GRAMS), len(codes)), -1, np.int64)
    for k, n in enumerate(GRAMS):
        m = len(codes) - n + 1
        if m > 0:
            h = np.full(m, n, np.uint64)
            for j in range(n):
                h ^= codes[j:j + m]
                h *= PRIME
            h ^= h >> np.uint64(29)
            h *= PRIME
            h >>= np.uint64(40)
            h &= np.uint64(BUCKETS - 1)
            out[k, :m] = np.where(left[:m] >= n, h.view(np.int64), -1)
    return out, starts


@dataclass(frozen=True)
class Hashed:
    """The buckets of some words and of their letter runs, made once for all that look them up."""

    words: np.ndarray
    grams: np.ndarray
    starts: np.ndarray

    @staticmethod
    def of(words: list[str]) -> Hashed:
        return Hashed(word_buckets(words), *gram_buckets(words))


@dataclass(frozen=True)
class Evidence:
    """Log odds of label 1 for buckets of words and of letter runs."""

    words: np.ndarray
    grams: np.ndarray

    @staticmethod
    def learn(texts: list[str], labels: np.ndarray) -> Evidence:
        """By the number of documents of either label that hold a bucket; some
        texts at a time, so memory does not follow the sample."""
        return Evidence.of_folds(texts, labels, np.zeros(len(texts), np.int64), 1)[0]

    @staticmethod
    def of_folds(texts: list[str], labels: np.ndarray, fold: np.ndarray, folds: int) -> tuple[Evidence, list[Evidence]]:
        """The evidence of all texts, and for each fold that of the texts outside it."""
        words, grams = np.zeros((folds, 2, WORD_BUCKETS), np.int32), np.zeros((folds, 2, BUCKETS), np.int32)
        n = np.zeros((folds, 2), np.int64)
        for k in range(folds):
            own = np.flatnonzero(fold == k)
            for s in range(0, len(own), TEXTS):
                some = own[s:s + TEXTS]
                Evidence._count([texts[i] for i in some], (labels[some] == 1).astype(np.int64), words[k], grams[k])
            n[k] = (labels[own] != 1).sum(), (labels[own] == 1).sum()

        def made(words: np.ndarray, grams: np.ndarray, n: np.ndarray) -> Evidence:
            return Evidence(Evidence._odds(words, n).astype(np.float32), Evidence._odds(grams, n).astype(np.float32))

        every = words.sum(0), grams.sum(0), n.sum(0)
        return made(*every), [made(every[0] - words[k], every[1] - grams[k], every[2] - n[k]) for k in range(folds)]

    @staticmethod
    def _count(texts: list[str], labels: np.ndarray, words: np.ndarray, grams: np.ndarray) -> None:
        """Adds the documents that hold each bucket, by label."""
        ends, at, names = split_words(pc.utf8_lower(pa.array(texts, pa.large_string())))
        if not len(at):
            return
        owner = np.repeat(np.arange(len(texts)), np.diff(ends))
        pairs = np.unique(owner * len(names) + at)
        doc, word = pairs // len(names), pairs % len(names)
        own = np.unique(doc * WORD_BUCKETS + word_buckets(names)[word])
        np.add.at(words, (labels[own // WORD_BUCKETS], own % WORD_BUCKETS), 1)
        found, starts = gram_buckets(names)
        of = np.repeat(np.arange(len(names)), np.diff(np.r_[starts, found.shape[1]]))
        by_word = np.argsort(word, kind="stable")
        first = np.searchsorted(word[by_word], np.arange(len(names) + 1))
        for row in found:
            runs = np.unique(of[row >= 0] * BUCKETS + row[row >= 0])
            n = np.diff(first)[runs // BUCKETS]
            docs = doc[by_word[np.repeat(first[runs // BUCKETS] - (np.cumsum(n) - n), n) + np.arange(n.sum())]]
            own = np.unique(docs * BUCKETS + np.repeat(runs % BUCKETS, n))
            np.add.at(grams, (labels[own // BUCKETS], own % BUCKETS), 1)

    @staticmethod
    def _odds(held: np.ndarray, n: np.ndarray) -> np.ndarray:
        no, yes = held
        odds = np.log((yes + PRIOR) / (n[1] + 2 * PRIOR)) - np.log((no + PRIOR) / (n[0] + 2 * PRIOR))
        return np.where(yes + no >= RARE, np.clip(odds, -5, 5), 0)

    def features(self, words: list[str], hashed: Hashed | None = None) -> np.ndarray:
        """Per word: its log odds; the largest, smallest and mean of its runs'."""
        if len(words) > WORDS:
            return np.vstack([self.features(words[s:s + WORDS]) for s in range(0, len(words), WORDS)])
        out = np.zeros((len(words), 4), np.float32)
        if not words:
            return out
        hashed = hashed or Hashed.of(words)
        out[:, 0] = self.words[hashed.words]
        grams, starts = hashed.grams, hashed.starts
        inside = grams >= 0
        own = self.grams[grams]
        n = np.add.reduceat(inside.sum(0), starts)
        out[:, 1] = np.maximum.reduceat(np.where(inside, own, -9).max(0), starts)
        out[:, 2] = np.minimum.reduceat(np.where(inside, own, 9).min(0), starts)
        out[:, 3] = np.add.reduceat(np.where(inside, own, 0).sum(0), starts) / np.maximum(n, 1)
        out[n == 0, 1:3] = 0
        return out


class Adam:
    """Steps for a dict of arrays."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            g = np.clip(g, -5, 5)
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            m, v = self.m[k] / (1 - 0.9 ** self.t), self.v[k] / (1 - 0.999 ** self.t)
            self.params[k] -= (self.rate * m / (np.sqrt(v) + 1e-8)).astype(self.params[k].dtype)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)
