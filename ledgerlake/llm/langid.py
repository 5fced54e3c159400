"""Language identification by unigram pieces, summed over all segmentations.

A text's letters are lower-cased and cut into words.  For each language a word
has the probability of all its segmentations into pieces of a fixed public
vocabulary, found by a forward pass; a text's score is the sum of its words'
logarithms.  Piece probabilities are fitted by expectation-maximisation on the
word counts of every learning row: Spark counts the words and adds up the
expected piece counts, and only one number per language and piece reaches the
driver.

A text that is null or has no letter is ``und`` with score 0, and so is every
text when nothing was learned.  Equal scores go to the smaller language name.
Words longer than ``WORD`` letters count as several.  Repeated rows are rows
of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import small_batches, stored

WORD = 48
LONGEST = WORD + 1  # a word and its mark
ROUNDS = 2
SMOOTH = 0.05
UNKNOWN = 1e-9
START = "▁"
BASE = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The vocabulary's pieces in lower case, found by a rolling hash."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names = {sp.id_to_piece(i).lower() for i in range(sp.get_piece_size())
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
        names = sorted(n for n in names if 1 <= len(n) <= LONGEST)
        self.longest = max(map(len, names))
        keys = np.array([self.key(n) for n in names], np.uint64)
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.size = keys[self.order], len(names)

    @staticmethod
    def key(name: str) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for c in name:
            h = h * BASE + np.uint64(ord(c) + 1)
        return h[0]

    def edges(self, codes: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """Piece number (``size``: none) of every span of words of one length."""
        n, length = codes.shape
        out = {}
        for s in range(length):
            h = np.zeros(n, np.uint64)
            for t in range(s + 1, min(length, s + self.longest) + 1):
                h = h * BASE + codes[:, t - 1] + np.uint64(1)
                at = np.minimum(np.searchsorted(self.keys, h), self.size - 1)
                hit = self.keys[at] == h
                if hit.any() or t == s + 1:
                    out[s, t] = np.where(hit, self.order[at], self.size)
        return out


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


# Below this a word's probability is worked out in logs; and the log of one that has none.
TINY = 1e-250
IMPOSSIBLE = -1e6


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and code points of the words of each length."""
    sizes = np.array([len(w) for w in words])
    for length in np.unique(sizes):
        at = np.flatnonzero(sizes == length)
        codes = np.frombuffer("".join([words[i] for i in at]).encode("utf-32-le", "surrogatepass"), "<u4")
        yield at, codes.reshape(len(at), length).astype(np.uint64)


def forward(p: Pieces, edges: dict, length: int, n: int, probs: np.ndarray) -> np.ndarray:
    """alpha[t]: the summed probability of all segmentations of the first t
    letters, for each word and each row of ``probs``."""
    alpha = np.zeros((length + 1, n, len(probs)))
    alpha[0] = 1
    table = probs.T
    for t in range(1, length + 1):
        for s in range(max(0, t - p.longest), t):
            e = edges.get((s, t))
            if e is not None:
                own = table[e]
                if t > s + 1:
                    own[e == p.size] = 0
                alpha[t] += alpha[s] * own
    return alpha


def log_steps(p: Pieces, edges: dict, length: int, probs: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """The log probabilities of the pieces from s to t, for each word and each row of ``probs``."""
    with np.errstate(divide="ignore"):
        table = np.log(probs.T)
    for (s, t), e in edges.items():
        if t <= length and t - s <= p.longest:
            yield s, t, np.where((e == p.size)[:, None] & (t > s + 1), -np.inf, table[e])


def log_passes(p: Pieces, edges: dict, length: int, n: int, probs: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Logs of the summed probabilities of the first t letters and of those from t on, and the steps: for words whose
    probability is too small for a plain number."""
    steps = sorted(log_steps(p, edges, length, probs), key=lambda x: x[:2])
    ahead, behind = np.full((2, length + 1, n, len(probs)), -np.inf)
    ahead[0], behind[length] = 0, 0
    for s, t, own in sorted(steps, key=lambda x: x[1]):
        ahead[t] = np.logaddexp(ahead[t], ahead[s] + own)
    for s, t, own in reversed(steps):
        behind[s] = np.logaddexp(behind[s], behind[t] + own)
    return ahead, behind, steps


def word_scores(p: Pieces, words: list[str], probs: np.ndarray) -> np.ndarray:
    """log P(word | language); ``probs``: a row for each language, last column: an unknown letter."""
    out = np.zeros((len(words), len(probs)))
    for at, codes in by_length(words):
        alpha = forward(p, p.edges(codes), codes.shape[1], len(at), probs)
        small = np.flatnonzero((alpha[-1] < TINY).any(1))
        out[at] = np.log(np.maximum(alpha[-1], TINY))
        if len(small):
            own = log_passes(p, p.edges(codes[small]), codes.shape[1], len(small), probs)[0][-1]
            out[at[small]] = np.maximum(own, IMPOSSIBLE)
    return out


def expected(p: Pieces, words: list[str], counts: np.ndarray, probs: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations, for one language."""
    total = np.zeros(p.size + 1)
    for at, codes in by_length(words):
        length, edges = codes.shape[1], p.edges(codes)
        alpha = forward(p, edges, length, len(at), probs[None])[:, :, 0]
        beta = np.zeros_like(alpha)
        beta[length] = 1
        small = alpha[length] < TINY
        weight = np.where(small, 0, counts[at] / np.maximum(alpha[length], TINY))
        for s in range(length - 1, -1, -1):
            for t in range(s + 1, min(length, s + p.longest) + 1):
                e = edges.get((s, t))
                if e is not None:
                    own = probs[e]
                    if t > s + 1:
                        own = np.where(e == p.size, 0, own)
                    beta[s] += own * beta[t]
                    total += np.bincount(e, alpha[s] * own * beta[t] * weight, minlength=p.size + 1)
        small = np.flatnonzero(small)
        if len(small):
            few = p.edges(codes[small])
            ahead, behind, steps = log_passes(p, few, length, len(small), probs[None])
            able = np.isfinite(ahead[length][:, 0])
            whole = np.where(able, ahead[length][:, 0], 0)
            for s, t, own in steps:
                uses = np.exp(ahead[s][:, 0] + own[:, 0] + behind[t][:, 0] - whole) * able
                total += np.bincount(few[s, t], uses * counts[at][small], minlength=p.size + 1)
    return total


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """For every text: where its words start, its words' numbers; and the words."""
    lower = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    split = pc.split_pattern_regex(lower, r"[^\p{L}]+")
    starts = split.offsets.to_numpy()[:-1] - split.offsets[0].as_py()
    found = split.flatten().dictionary_encode()
    return starts, found.indices.to_numpy(), found.dictionary.to_pylist()


def parts(word: str) -> list[str]:
    return [(START if at == 0 else "") + word[at:at + WORD] for at in range(0, len(word), WORD)]


@dataclass(frozen=True)
class Model:
    langs: list[str]
    probs: np.ndarray
    vocabulary: str | Callable[[], str]


def where(vocabulary: str | Callable[[], str]) -> str:
    return vocabulary() if callable(vocabulary) else vocabulary


def fit(docs: DataFrame, learn: Column, vocabulary: str | Callable[[], str], rounds: int = ROUNDS) -> Model:
    """Learns from text and lang of the rows that ``learn`` picks."""
    small_batches(docs.sparkSession)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            langs = b.column(1).dictionary_encode()
            starts, at, words = words_of(b.column(0))
            row = np.zeros(len(at), np.int64)
            row[starts[1:]] = 1
            pairs = langs.indices.to_numpy()[np.cumsum(row)].astype(np.int64) * len(words) + at
            pairs, n = np.unique(pairs, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(pairs // len(words))), pa.array(words, pa.string()).take(pa.array(pairs % len(words))),
                 pa.array(n, pa.int64())], names=["lang", "word", "n"])

    counts = stored(docs.filter(learn & F.col("lang").isNotNull()).select("text", "lang")
                    .mapInArrow(count, "lang string, word string, n bigint").filter("word <> ''")
                    .groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    p = pieces(where(vocabulary))
    probs = np.full((len(langs), p.size + 1), 1 / (p.size + 1))
    probs[:, p.size] = UNKNOWN

    def step(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(where(vocabulary))
        total = np.zeros((len(langs), own.size + 1))
        for b in it:
            lang, n = np.array(b.column(0).to_pylist()), b.column(2).to_numpy()
            words = b.column(1).to_pylist()
            for k, name in enumerate(langs):
                spelled, weight = [], []
                for i in np.flatnonzero(lang == name):
                    for part in parts(words[i]):
                        spelled.append(part)
                        weight.append(n[i])
                if spelled:
                    total[k] += expected(own, spelled, np.array(weight, float), probs[k])
        at, piece = np.nonzero(total[:, :own.size])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(piece, pa.int32()), pa.array(total[at, piece])], names=["lang", "piece", "n"])

    big = docs.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for _ in range(rounds):
        docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
        # one number for each language and piece, whatever the corpus
        sums = counts.mapInArrow(step, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()
        docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", big)
        total = np.full((len(langs), p.size), SMOOTH)
        for r in sums:
            total[r["lang"], r["piece"]] += r["n"]
        probs = np.hstack([total / total.sum(1, keepdims=True), np.full((len(langs), 1), UNKNOWN)])
    return Model(langs, probs, vocabulary)


def predict(docs: DataFrame, model: Model, keep: list[Column]) -> DataFrame:
    """``keep`` (named columns), lang_pred and score of every row."""
    small_batches(docs.sparkSession)
    langs, probs, vocabulary = model.langs, model.probs, model.vocabulary
    rows = docs.select(F.col("text").alias("text"), F.struct(*keep).alias("keep"))
    kept = rows.schema["keep"].dataType

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(where(vocabulary))
        for b in it:
            names, scores = np.full(b.num_rows, "und", object), np.zeros(b.num_rows)
            starts, at, words = words_of(b.column(0))
            if langs and len(words):
                spelled, owner = [], []
                for i, w in enumerate(words):
                    for part in parts(w):
                        spelled.append(part)
                        owner.append(i)
                known = np.zeros((len(words), len(langs)))
                if spelled:
                    np.add.at(known, owner, word_scores(p, spelled, probs))
                total = np.add.reduceat(known[at], starts, 0)
                lettered = np.add.reduceat(np.array([w != "" for w in words], np.int64)[at], starts) > 0
                best = total.argmax(1)
                share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                for i in np.flatnonzero(lettered):
                    names[i], scores[i] = langs[best[i]], share[i]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(names, pa.string()), pa.array(scores)],
                                             names=["keep", "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructType

    schema = StructType().add("keep", kept).add("lang_pred", StringType()).add("score", DoubleType())
    return rows.mapInArrow(run, schema).select("keep.*", "lang_pred", "score")
