"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input is a learned vector of the word, the mean of the learned vectors
of its letter runs (both hashed), and what the word and its runs say about the
label in the learning sample, with signs and sizes; a text in training sees what
the other folds' texts say, never its own label.  The network reads every
overlapping window of ``WINDOW`` words in both directions; attention weighs its
states; a logistic layer scores the window, and a text has the score of its
worst one.  Training, in numpy on a bounded sample, looks at each text's most
telling window and at more of the clean texts; it stops at the epoch that did
best on a fold kept aside, and the score's zero lies where that fold is best
told apart.

Null texts are empty.  A text without a word has the score of an empty window.
Without samples of both labels every score is the labels' mean (0 without
any).  Rows are scored one by one, so repeated rows repeat their score; an
empty table gives no rows; other columns are ignored by the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from ledgerlake.llm.common import release, small_batches
from ledgerlake.llm.tokens import forget
from ledgerlake.llm.wordstats import WORDS, Adam, Evidence, Hashed, sigmoid, split_words

WINDOW = 24
STEP = 12
HIDDEN = 8
EPOCHS = 8
LEAST_STEPS = 500
BATCH = 128
# Inputs of a word: what the sample says of it, and the learned vectors of the word and of its letter runs.
EVIDENCE, VECTOR = 9, 4
INPUTS = EVIDENCE + 2 * VECTOR
VECTORS = 1 << 13
FOLDS = 5
DECAY = 1e-3
CHUNK = 4096
# Texts scored at once: all their windows are held.
TEXTS_AT_ONCE = 64


def evidence_inputs(evidence: Evidence, words: list[str], hashed: Hashed | None = None) -> np.ndarray:
    """A row for each word, and a last row of zeros for the window's padding."""
    f = evidence.features(words, hashed) / 5
    known = np.ones((len(words), 1), np.float32)
    x = np.hstack([f, np.maximum(f[:, :2] - 0.3, 0) * 2, np.maximum(-f[:, [0, 2]] - 0.3, 0), known])
    return np.vstack([x, np.zeros((1, EVIDENCE), np.float32)]).astype(np.float32)


@dataclass(frozen=True)
class Letters:
    """The vectors' numbers of each word and of its letter runs (word i has ``runs`` from ``first[i]`` on)."""

    word: np.ndarray
    runs: np.ndarray
    first: np.ndarray

    @staticmethod
    def of(words: list[str], hashed: Hashed | None = None) -> Letters:
        if not words:
            return Letters(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64))
        hashed = hashed or Hashed.of(words)
        found, starts = hashed.grams, hashed.starts
        of = np.repeat(np.arange(len(words)), np.diff(np.r_[starts, found.shape[1]]))
        inside = found >= 0
        owner = np.concatenate([of[i] for i in inside])
        runs = np.concatenate([row[i] for row, i in zip(found, inside)]) & (VECTORS - 1)
        order = np.argsort(owner, kind="stable")
        return Letters(hashed.words & (VECTORS - 1), runs[order], np.r_[0, np.cumsum(np.bincount(owner, minlength=len(words)))])

    @staticmethod
    def of_all(words: list[str]) -> Letters:
        """``of`` many words, some at a time: what is made on the way does not follow their number."""
        parts = [Letters.of(words[at:at + WORDS]) for at in range(0, len(words), WORDS)] or [Letters.of([])]
        ahead = np.cumsum([0, *(len(x.runs) for x in parts[:-1])])
        return Letters(np.concatenate([x.word for x in parts]), np.concatenate([x.runs for x in parts]),
                       np.r_[np.concatenate([x.first[:-1] + n for x, n in zip(parts, ahead)]), ahead[-1] + parts[-1].first[-1]])

    def some(self, at: np.ndarray) -> Letters:
        size = np.diff(self.first)[at]
        ends = np.cumsum(size)
        runs = self.runs[np.repeat(self.first[at] - (ends - size), size) + np.arange(size.sum())]
        return Letters(self.word[at], runs, np.r_[0, ends])

    def vectors(self, v: dict[str, np.ndarray]) -> np.ndarray:
        """A row for each word: its vector, and the mean of its runs' vectors."""
        until = np.vstack([np.zeros((1, VECTOR), np.float32), np.cumsum(v["runs"][self.runs], 0)])
        size = np.maximum(1, np.diff(self.first))[:, None]
        return np.hstack([v["word"][self.word], (until[self.first[1:]] - until[self.first[:-1]]) / size]).astype(np.float32)

    def gradients(self, d: np.ndarray) -> dict[str, np.ndarray]:
        """Of the vectors, from those of the rows."""
        g = {k: np.zeros((VECTORS, VECTOR), np.float32) for k in ("word", "runs")}
        np.add.at(g["word"], self.word, d[:, :VECTOR])
        size = np.diff(self.first)
        np.add.at(g["runs"], self.runs, np.repeat(d[:, VECTOR:] / np.maximum(1, size)[:, None], size, 0))
        return g


def inputs(evidence: Evidence, vectors: dict, words: list[str]) -> np.ndarray:
    """A row for each word, some words at a time, and a last row of zeros for the window's padding."""
    if not words:
        return np.zeros((1, INPUTS), np.float32)
    parts = [words[at:at + WORDS] for at in range(0, len(words), WORDS)]
    hashed = [Hashed.of(x) for x in parts]
    rows = [np.hstack([evidence_inputs(evidence, x, h)[:-1], Letters.of(x, h).vectors(vectors)]) for x, h in zip(parts, hashed)]
    return np.vstack([*rows, np.zeros((1, INPUTS), np.float32)])


def windows(ends: np.ndarray, at: np.ndarray, padding: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all overlapping windows, and the text of each."""
    size = np.diff(ends)
    count = 1 + np.maximum(0, -(-(size - WINDOW) // STEP))
    owner = np.repeat(np.arange(len(size)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    place = (k * STEP)[:, None] + np.arange(WINDOW)
    inside = place < size[owner][:, None]
    where = np.minimum(ends[:-1][owner][:, None] + place, max(0, len(at) - 1))
    return np.where(inside, at[where] if len(at) else padding, padding), owner


def new_params(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def make(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    p = {}
    for d in "fb":
        p |= {f"W{d}": make(INPUTS, 3 * HIDDEN), f"U{d}": make(HIDDEN, 2 * HIDDEN), f"C{d}": make(HIDDEN, HIDDEN),
              f"b{d}": np.zeros(3 * HIDDEN, np.float32)}
    return p | {"A": make(2 * HIDDEN, HIDDEN), "a": make(HIDDEN), "o": make(2 * HIDDEN), "ob": np.zeros(1, np.float32)}


def run_gru(p: dict, d: str, xw: np.ndarray, seq: np.ndarray, keep: bool = False):
    """States of one direction, in text order; with ``keep`` also what the
    gradient needs.  ``xw``: inputs times W, plus b."""
    n, t = seq.shape
    h = np.zeros((n, HIDDEN), np.float32)
    out, saved = np.empty((t, n, HIDDEN), np.float32), []
    for i in range(t) if d == "f" else range(t - 1, -1, -1):
        g = xw.take(seq[:, i], 0)
        zr = h @ p[f"U{d}"]
        zr += g[:, :2 * HIDDEN]
        zr *= 0.5  # the sigmoid
        np.tanh(zr, zr)
        zr *= 0.5
        zr += 0.5
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = (r * h) @ p[f"C{d}"]
        c += g[:, 2 * HIDDEN:]
        np.tanh(c, c)
        if keep:
            saved.append((i, h, z, r, c))
            h = h + z * (c - h)
        else:
            c -= h
            c *= z
            h += c
        out[i] = h
    return (out, saved) if keep else out


def pool(p: dict, states: np.ndarray):
    """Attention over time; states: (time, windows, 2 HIDDEN)."""
    u = np.tanh(states @ p["A"])
    e = u @ p["a"]
    w = np.exp(e - e.max(0))
    w /= w.sum(0)
    return u, w, (w[:, :, None] * states).sum(0)


def logits(p: dict, x: np.ndarray, seq: np.ndarray) -> np.ndarray:
    tables = {d: x @ p[f"W{d}"] + p[f"b{d}"] for d in "fb"}
    out = np.empty(len(seq), np.float32)
    for s in range(0, len(seq), CHUNK):
        part = seq[s:s + CHUNK]
        states = np.concatenate([run_gru(p, d, tables[d], part) for d in "fb"], 2)
        out[s:s + CHUNK] = pool(p, states)[2] @ p["o"] + p["ob"]
    return out


def gradients(p: dict, x: np.ndarray, seq: np.ndarray, y: np.ndarray, weight: np.ndarray, of_inputs: np.ndarray | None = None) -> dict:
    """Of the weighted loss by parameter; adds those of the rows of ``x`` to ``of_inputs``, if given."""
    tables = {d: x @ p[f"W{d}"] + p[f"b{d}"] for d in "fb"}
    runs = {d: run_gru(p, d, tables[d], seq, True) for d in "fb"}
    states = np.concatenate([runs[d][0] for d in "fb"], 2)
    u, w, pooled = pool(p, states)
    err = (sigmoid(pooled @ p["o"] + p["ob"]) - y) * weight / len(y)
    g = {"o": pooled.T @ err, "ob": np.array([err.sum()])}
    d_pooled = err[:, None] * p["o"]
    d_w = (states * d_pooled).sum(2)
    d_e = w * (d_w - (w * d_w).sum(0))
    d_u = d_e[:, :, None] * p["a"] * (1 - u * u)
    g["a"] = (u * d_e[:, :, None]).sum((0, 1))
    g["A"] = np.tensordot(states, d_u, ([0, 1], [0, 1]))
    d_states = w[:, :, None] * d_pooled + d_u @ p["A"].T
    for k, d in enumerate("fb"):
        own = d_states[:, :, k * HIDDEN:(k + 1) * HIDDEN]
        for n in (f"W{d}", f"U{d}", f"C{d}", f"b{d}"):
            g[n] = np.zeros_like(p[n])
        d_h = np.zeros((len(seq), HIDDEN), np.float32)
        for i, h, z, r, c in reversed(runs[d][1]):
            d_h = d_h + own[i]
            d_c = d_h * z * (1 - c * c)
            d_rh = d_c @ p[f"C{d}"].T
            d_zr = np.hstack([d_h * (c - h) * z * (1 - z), d_rh * h * r * (1 - r)])
            d_g = np.hstack([d_zr, d_c])
            g[f"W{d}"] += x[seq[:, i]].T @ d_g
            g[f"b{d}"] += d_g.sum(0)
            if of_inputs is not None:
                np.add.at(of_inputs, seq[:, i], d_g @ p[f"W{d}"].T)
            g[f"U{d}"] += h.T @ d_zr
            g[f"C{d}"] += (r * h).T @ d_c
            d_h = d_h * (1 - z) + d_rh * r + d_zr @ p[f"U{d}"].T
    return g


@dataclass(frozen=True)
class Model:
    evidence: Evidence | None
    params: dict | None
    mean: float = 0.0
    vectors: dict | None = None

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.params is None:
            return np.full(len(texts), self.mean)
        ends, at, words = split_words(pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string())))
        seq, owner = windows(ends, at, len(words))
        out = np.full(len(texts), -np.inf)
        np.maximum.at(out, owner, logits(self.params, inputs(self.evidence, self.vectors, words), seq))
        return sigmoid(out)


def worst(value: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, -np.inf)
    np.maximum.at(out, owner, value)
    return out


def best_zero(value: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The value that tells the labels apart with the fewest mistakes (the middle of the widest
    such gap), and the share told right."""
    order = np.argsort(value, kind="stable")
    v, own = value[order], y[order]
    right = np.r_[own.sum(), own.sum() + np.cumsum(1 - 2 * own)]   # the first i are taken for 0
    best = np.flatnonzero(right == right.max())
    low, high = np.r_[v[0] - 1, v][best], np.r_[v, v[-1] + 1][best]
    k = int(np.argmax(high - low))
    return float((low[k] + high[k]) / 2), float(right.max() / len(y))


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> Model:
    """Learns from a bounded sample, on one machine."""
    if len(set(labels.tolist())) < 2:
        return Model(None, None, float(labels.mean()) if len(labels) else 0.0)
    rng = np.random.default_rng(seed)
    fold = np.empty(len(texts), np.int64)
    for label in (0, 1):  # either label in every fold, as far as it goes
        own = rng.permutation(np.flatnonzero(labels == label))
        fold[own] = np.arange(len(own)) % FOLDS
    evidence, others = Evidence.of_folds(texts, labels, fold, FOLDS)
    ends, at, words = split_words(pc.utf8_lower(pa.array(texts, pa.large_string())))
    letters = Letters.of_all(words)
    seq, owner = windows(ends, at, len(words))
    release()
    # rows of the inputs: all words as each fold sees them, and at last the padding
    seen = np.vstack([*(evidence_inputs(e, words)[:-1] for e in others), np.zeros((1, EVIDENCE), np.float32)])
    padding = len(words)
    seq = np.where(seq == padding, len(seen) - 1, seq + fold[owner][:, None] * len(words))
    p = new_params(rng)
    vectors = {k: (rng.standard_normal((VECTORS, VECTOR)) * 0.05).astype(np.float32) for k in ("word", "runs")}
    adam, adam_v = Adam(p, 0.01), Adam(vectors, 0.003)

    def rows_of(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, Letters, np.ndarray]:
        """Inputs of the words of some windows, the windows over these rows, and the words' letters and rows."""
        used, within = np.unique(part, return_inverse=True)
        real = used < len(seen) - 1
        own = letters.some(used[real] % max(1, len(words)))
        v = np.zeros((len(used), 2 * VECTOR), np.float32)
        v[real] = own.vectors(vectors)
        return np.hstack([seen[used], v]), within.reshape(part.shape), own, real

    def value(at: np.ndarray) -> np.ndarray:
        return np.concatenate([logits(p, *rows_of(seq[at[s:s + CHUNK]])[:2]) for s in range(0, len(at), CHUNK)] or [np.zeros(0, np.float32)])

    apart = np.flatnonzero(fold[owner] == 0)                  # tells when to stop
    learned = np.flatnonzero(fold[owner] != 0)
    if len(set(labels[fold == 0].tolist())) < 2 or len(set(labels[fold != 0].tolist())) < 2:
        apart = learned = np.arange(len(seq))
    held = np.unique(owner[apart])
    best: tuple = (np.inf,)
    epochs = max(EPOCHS, LEAST_STEPS // -(-2 * len(texts) // BATCH))
    for epoch in range(epochs):
        if epoch in (0, epochs // 3):
            now = seen[:, :2].max(1)[seq[learned]].max(1) if epoch == 0 else value(learned)
            order = np.lexsort((rng.random(len(learned)), -now, owner[learned]))
            of = owner[learned][order]
            top = learned[order][np.r_[True, of[1:] != of[:-1]]]
            clean = learned[labels[owner[learned]] == 0]
            chosen = np.concatenate([top, rng.choice(clean, min(len(clean), len(texts)), replace=False)])
        rng.shuffle(chosen)
        y = labels[owner[chosen]].astype(np.float32)
        weight = np.where(y == 1, len(y) / 2 / max(1, y.sum()), len(y) / 2 / max(1, (1 - y).sum())).astype(np.float32)
        for s in range(0, len(chosen), BATCH):
            own = slice(s, s + BATCH)
            x, part, of_words, real = rows_of(seq[chosen[own]])
            of_inputs = np.zeros_like(x)
            grads = gradients(p, x, part, y[own], weight[own], of_inputs)
            adam.step({k: g + DECAY * p[k] for k, g in grads.items()})
            grads = of_words.gradients(of_inputs[real][:, EVIDENCE:])
            adam_v.step({k: g + DECAY * vectors[k] for k, g in grads.items()})
        if (epoch + 1) % max(1, epochs // 10) == 0:
            out = worst(value(apart), owner[apart], len(texts))[held]
            zero, right = best_zero(out, labels[held])
            y_held = labels[held]
            loss = -right + 0.01 * float(np.logaddexp(0, np.where(y_held == 1, zero - out, out - zero)).mean())
            if loss < best[0]:
                best = (loss, zero, {k: v.copy() for k, v in p.items()}, {k: v.copy() for k, v in vectors.items()})
    _, zero, p, vectors = best
    p["ob"] = p["ob"] - np.float32(zero)
    return Model(evidence, p, 0.0, vectors)


def score(docs: DataFrame, model, keep: list[Column]) -> DataFrame:
    """``keep`` (named columns) and score of every row; ``model`` has ``scores(texts)``."""
    release()  # what the training has left
    small_batches(docs.sparkSession, TEXTS_AT_ONCE)
    rows = docs.select(F.col("text").alias("text"), F.struct(*keep).alias("keep"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for b in it:
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(shared.value.scores(b.column(0)), pa.float64())], names=["keep", "score"])

    schema = StructType().add("keep", rows.schema["keep"].dataType).add("score", DoubleType())
    return rows.mapInArrow(run, schema).select("keep.*", "score")
