"""Quality by attention over passages, learned from document labels alone.

A text's passages are runs of ``PASSAGE`` words.  Each is encoded from counts
of its letters, signs and repeats and from what its words say about the label;
gated attention weighs the passages, and a logistic layer scores the weighted
representation.  Training, in numpy on a bounded sample, sees whole bags of
passages with their document's label.

Null texts are empty; a text without a word is one passage of zeros.  Without
samples of both labels every score is the labels' mean (0 without any).
Repeated rows repeat their score; an empty table gives no rows; other columns
are ignored by the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerlake.llm.wordstats import TEXTS, Adam, Evidence, sigmoid, split_words

PASSAGE = 64
CODE = 16
GATE = 8
EPOCHS = 30
LEAST_STEPS = 500
BATCH = 64
COUNTED = (r"\p{Lu}", r"\p{L}", r"\p{N}", r"[^\p{L}\p{N}]", r"[|<>{}\[\]]", r"[!?*#$%&~^]")


def word_counts(evidence: Evidence, words: list[str]) -> np.ndarray:
    """Per word: letters and signs of each kind, length, and its log odds."""
    arr = pa.array(words, pa.large_string())
    cols = [pc.count_substring_regex(arr, p).to_numpy(zero_copy_only=False) for p in COUNTED]
    cols.append(pc.utf8_length(arr).to_numpy(zero_copy_only=False))
    bare = pc.utf8_lower(pc.replace_substring_regex(arr, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")).to_pylist()
    return np.hstack([np.stack(cols, 1).astype(np.float64), evidence.features(bare).astype(np.float64)])


def passages(evidence: Evidence, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the text of each."""
    ends, at, words = split_words(texts, r"\s+")
    size = np.diff(ends)
    count = np.maximum(1, -(-size // PASSAGE))
    owner = np.repeat(np.arange(len(size)), count)
    first = np.cumsum(count) - count
    if not len(at):
        return np.zeros((len(owner), 18)), owner
    place = np.arange(len(at)) - np.repeat(ends[:-1], size)
    of = np.repeat(first, size) + place // PASSAGE
    n = np.bincount(of, minlength=len(owner)).astype(np.float64)
    counts = word_counts(evidence, words)[at]
    sums = np.stack([np.bincount(of, c, minlength=len(owner)) for c in counts.T], 1)
    again = np.r_[False, (at[1:] == at[:-1]) & (of[1:] == of[:-1])]
    apart = np.unique(of * np.int64(len(words)) + at) // len(words)
    caps = (counts[:, 0] >= np.maximum(1, counts[:, 1])) & (counts[:, 1] > 1)
    bare = counts[:, 1] + counts[:, 2] == 0
    has = np.maximum(n, 1)[:, None]
    chars = np.maximum(sums[:, 6], 1)[:, None]
    extra = np.stack([np.bincount(of, c, minlength=len(owner)) for c in (again, caps, bare)], 1)
    distinct = np.bincount(apart.astype(np.int64), minlength=len(owner))[:, None]
    f = np.hstack([sums[:, :6] / chars * 3, sums[:, 6:7] / has / 10, sums[:, 7:] / has, extra / has, distinct / has,
                   np.log1p(n)[:, None] / 4, (n > 0)[:, None], np.sqrt(sums[:, 4:5] / has)])
    return f * (n > 0)[:, None], owner


def attend(p: dict, f: np.ndarray, owner: np.ndarray, n: int) -> dict:
    h = np.tanh(f @ p["E"] + p["e"])
    v, u = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
    s = (v * u) @ p["w"]
    top = np.full(n, -np.inf)
    np.maximum.at(top, owner, s)
    a = np.exp(s - top[owner])
    a /= np.bincount(owner, a, minlength=n)[owner]
    z = np.stack([np.bincount(owner, a * c, minlength=n) for c in h.T], 1)
    return {"h": h, "v": v, "u": u, "a": a, "z": z, "logit": z @ p["o"] + p["ob"]}


def gradients(p: dict, f: np.ndarray, owner: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    r = attend(p, f, owner, len(y))
    err = (sigmoid(r["logit"]) - y) * weight / len(y)
    g = {"o": r["z"].T @ err, "ob": np.array([err.sum()])}
    d_z = err[:, None] * p["o"]
    d_a = (r["h"] * d_z[owner]).sum(1)
    d_s = r["a"] * (d_a - np.bincount(owner, r["a"] * d_a, minlength=len(y))[owner])
    g["w"] = (r["v"] * r["u"]).T @ d_s
    d_v = d_s[:, None] * p["w"] * r["u"] * (1 - r["v"] ** 2)
    d_u = d_s[:, None] * p["w"] * r["v"] * r["u"] * (1 - r["u"])
    g["V"], g["U"] = r["h"].T @ d_v, r["h"].T @ d_u
    d_h = (r["a"][:, None] * d_z[owner] + d_v @ p["V"].T + d_u @ p["U"].T) * (1 - r["h"] ** 2)
    return g | {"E": f.T @ d_h, "e": d_h.sum(0)}


@dataclass(frozen=True)
class Model:
    evidence: Evidence | None
    params: dict | None
    mean: float = 0.0

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.params is None:
            return np.full(len(texts), self.mean)
        if not len(texts):
            return np.zeros(0)
        f, owner = passages(self.evidence, texts)
        return sigmoid(attend(self.params, f, owner, len(texts))["logit"])


def train(texts: list[str], labels: np.ndarray, seed: int = 5) -> Model:
    """Learns from a bounded sample, on one machine."""
    if len(set(labels.tolist())) < 2:
        return Model(None, None, float(labels.mean()) if len(labels) else 0.0)
    rng = np.random.default_rng(seed)
    evidence = Evidence.learn(texts, labels)
    parts = [passages(evidence, pa.array(texts[s:s + TEXTS], pa.large_string())) for s in range(0, len(texts), TEXTS)]
    f = np.vstack([x for x, _ in parts])
    owner = np.concatenate([own + k * TEXTS for k, (_, own) in enumerate(parts)])

    def make(*shape: int) -> np.ndarray:
        return rng.standard_normal(shape) / np.sqrt(shape[0])

    p = {"E": make(f.shape[1], CODE), "e": np.zeros(CODE), "V": make(CODE, GATE), "U": make(CODE, GATE), "w": make(GATE),
         "o": make(CODE), "ob": np.zeros(1)}
    adam = Adam(p, 0.01)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    share = labels.mean()
    for _ in range(max(EPOCHS, LEAST_STEPS // -(-len(texts) // BATCH))):
        order = rng.permutation(len(texts))
        for s in range(0, len(order), BATCH):
            docs = order[s:s + BATCH]
            rows = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in docs])
            own = np.repeat(np.arange(len(docs)), bounds[docs + 1] - bounds[docs])
            y = labels[docs].astype(np.float64)
            adam.step(gradients(p, f[rows], own, y, np.where(y == 1, 0.5 / share, 0.5 / (1 - share))))
    return Model(evidence, p)
