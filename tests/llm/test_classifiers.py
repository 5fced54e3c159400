import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import langid, quality, toxicity, wordstats
from ledgerlake.llm import queries as Q
from ledgerlake.llm.learning import labelled_sample

SF = "/root/testdata/sf0.01"


def held(d, k, rest):
    return zlib.crc32(str(d).encode()) % k == rest


@pytest.mark.parametrize("query, label, least", [(Q.op4_toxicity, "toxic", 0.5), (Q.op5_quality, "quality", 0.3)])
def test_held_out_accuracy(spark, query, label, least):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == held(r["doc_id"], 5, 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= least)
    test = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in test]) >= 0.85


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_rows_and_few_labels(spark, make_docs, module):
    docs = make_docs([(1, "good text here"), (2, "bad words there"), (3, None), (4, ""), (None, "x " * 20_000), (2, "bad words there")],
                     ["score", "keep", "label"])
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (9, 1), (3, None)], "doc_id bigint, y int")
    for model in (module.train(*labelled_sample(docs, labels, "y", learn=F.lit(True))), module.train([], np.zeros(0, int)),
                  module.train(["a"], np.array([1]))):
        out = toxicity.score(docs, model, [F.col("doc_id")]).collect()
        assert len(out) == 6 and all(0 <= r["score"] <= 1 for r in out)
        assert toxicity.score(make_docs([]), model, [F.col("doc_id")]).count() == 0
    assert {r["score"] for r in out} == {1.0}


@pytest.mark.parametrize("module", [toxicity, quality])
def test_gradients(module):
    """Backpropagation against differences."""
    rng = np.random.default_rng(0)
    if module is toxicity:
        x = np.vstack([rng.standard_normal((6, toxicity.INPUTS)), np.zeros((1, toxicity.INPUTS))])
        p = {k: v.astype(np.float64) for k, v in toxicity.new_params(rng).items()}
        seq = rng.integers(0, 7, (5, 4))
        loss_of = lambda: toxicity.logits(p, x, seq).astype(np.float64)
        args = (p, x, seq)
    else:
        f, owner = rng.standard_normal((9, 5)), np.array([0, 0, 1, 1, 1, 2, 3, 4, 4])
        p = {"E": rng.standard_normal((5, 4)), "e": rng.standard_normal(4), "V": rng.standard_normal((4, 3)),
             "U": rng.standard_normal((4, 3)), "w": rng.standard_normal(3), "o": rng.standard_normal(4), "ob": np.zeros(1)}
        loss_of = lambda: quality.attend(p, f, owner, 5)["logit"]
        args = (p, f, owner)
    y, w = np.array([0, 1, 1, 0, 1.0]), np.array([1, 2, 1, 1, 0.5])

    def loss():
        s = 1 / (1 + np.exp(-loss_of()))
        return -(w * (y * np.log(s) + (1 - y) * np.log(1 - s))).mean()

    grads = module.gradients(*args, y, w)
    for k, g in grads.items():
        at = tuple(rng.integers(0, n) for n in p[k].shape)
        keep, eps = p[k][at], 1e-3 if module is toxicity else 1e-5
        p[k][at] = keep + eps
        up = loss()
        p[k][at] = keep - eps
        down = loss()
        p[k][at] = keep
        assert abs((up - down) / (2 * eps) - g[at]) < 2e-3, k


def test_language_held_out_accuracy(spark):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = Q.op10_language(spark, SF).collect()
    assert len(rows) == len(langs) and all(r["held_out"] == held(r["doc_id"], 3, 1) and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in rows if r["held_out"]]) >= 0.95


def test_language_odd_rows(make_docs):
    docs = make_docs([(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, "le chien", None)])
    model = langid.fit(docs, F.lit(True), Q.piece_vocabulary)
    odd = make_docs([(1, None), (2, ""), (3, "123 ..."), (4, "the dog"), (4, "the dog"), (None, "die katze"), (5, "x" * 30_000), (6, "日本語")],
                    ["score", "keep", "lang_pred"])
    out = sorted(((r["doc_id"] or 0, r["lang_pred"], r["score"]) for r in langid.predict(odd, model, [F.col("doc_id")]).collect()))
    assert [(d, p) for d, p, _ in out][:5] == [(0, "de"), (1, "und"), (2, "und"), (3, "und"), (4, "en")]
    assert len(out) == 8 and all(s == 0 for d, p, s in out if p == "und")
    nothing = langid.fit(make_docs([]), F.lit(True), Q.piece_vocabulary)
    assert {r["lang_pred"] for r in langid.predict(odd, nothing, [F.col("doc_id")]).collect()} == {"und"}
    assert langid.predict(make_docs([]), model, [F.col("doc_id")]).count() == 0


def test_forward_sums_all_segmentations():
    p = langid.pieces(Q.piece_vocabulary())
    rng = np.random.default_rng(1)
    probs = rng.random((2, p.size + 1)) / p.size
    word = "▁hello"

    def total(s, k):
        if not s:
            return 1.0
        out = 0.0
        for n in range(1, min(langid.LONGEST, len(s)) + 1):
            at = np.searchsorted(p.keys, p.key(s[:n]))
            if at < p.size and p.keys[at] == p.key(s[:n]):
                out += probs[k, p.order[at]] * total(s[n:], k)
            elif n == 1:
                out += probs[k, p.size] * total(s[1:], k)
        return out

    assert np.allclose(langid.word_scores(p, [word], probs)[0], np.log([total(word, 0), total(word, 1)]))
    uses = langid.expected(p, [word], np.array([3.0]), probs[0])
    assert uses.sum() >= 3


def test_words_too_rare_for_plain_numbers():
    """Long runs of rare pieces keep their evidence, in scores and in learning."""
    p = langid.pieces(Q.piece_vocabulary())
    word = "▁" + "qzxj" * 10
    low = np.stack([np.full(p.size + 1, 1e-8), np.full(p.size + 1, 1e-9)])
    scores = langid.word_scores(p, [word, "▁a"], low)
    assert scores[0, 0] > scores[0, 1] + 30 and (scores[0] < np.log(1e-250)).any()
    # one sum over segmentations, in logs and in exact integers
    from fractions import Fraction
    def total(s, prob, known={}):
        if (s, prob) not in known:
            known[s, prob] = Fraction(1) if not s else sum(
                (prob * total(s[n:], prob) for n in range(1, min(langid.LONGEST, len(s)) + 1)
                 if n == 1 or (lambda at: at < p.size and p.keys[at] == p.key(s[:n]))(np.searchsorted(p.keys, p.key(s[:n])))), Fraction(0))
        return known[s, prob]
    for k, prob in enumerate((Fraction(1, 10**8), Fraction(1, 10**9))):
        exact = total(word, prob)
        want = float(np.log(float(exact.numerator / Fraction(10) ** (len(str(exact.numerator)) - 1)))) + (len(str(exact.numerator)) - 1) * np.log(10)
        want -= float(len(str(exact.denominator)) - 1) * np.log(10) + float(np.log(float(exact.denominator / Fraction(10) ** (len(str(exact.denominator)) - 1))))
        assert abs(scores[0, k] - want) < 1e-6
    uses = langid.expected(p, [word], np.array([2.0]), low[1])
    assert abs((uses[:-1] > 0).sum()) > 3 and uses.sum() >= 2 * len(word) / p.longest and np.isfinite(uses).all()


def test_logs_and_plain_numbers_agree(monkeypatch):
    p = langid.pieces(Q.piece_vocabulary())
    probs = np.random.default_rng(5).random((2, p.size + 1)) / p.size
    words, counts = ["▁hello", "▁function", "▁über", "▁日本", "▁a"], np.array([1.0, 2, 3, 4, 5])
    plain = langid.word_scores(p, words, probs), langid.expected(p, words, counts, probs[0])
    monkeypatch.setattr(langid, "TINY", 1.0)
    assert np.allclose(langid.word_scores(p, words, probs), plain[0]) and np.allclose(langid.expected(p, words, counts, probs[0]), plain[1])


def test_long_pieces_count():
    p = langid.pieces(Q.piece_vocabulary())
    for word in ("▁function", "▁something", "▁information"):
        edges = p.edges(np.array([[ord(c) for c in word]], np.uint64))
        assert (0, len(word)) in edges and edges[0, len(word)][0] < p.size


def test_words_are_hashed_once_for_a_batch(monkeypatch):
    texts = [f"some bad words{i % 7} and others{i % 5} here" if i % 2 else f"good words{i % 7} of others{i % 5}" for i in range(60)]
    model = toxicity.train(texts, np.arange(60) % 2)
    made, make = [], wordstats.gram_buckets
    count = lambda words: made.append(len(words)) or make(words)
    monkeypatch.setattr(wordstats, "gram_buckets", count)
    if hasattr(toxicity, "gram_buckets"):
        monkeypatch.setattr(toxicity, "gram_buckets", count)
    scores = model.scores(pa.array([*texts, None, ""]))
    assert len(made) == 1 and len(scores) == 62
    apart = np.concatenate([model.scores(pa.array([t])) for t in texts[:4]])
    assert np.allclose(scores[:4], apart, atol=1e-5)


def test_training_hashes_some_words_at_a_time(monkeypatch):
    monkeypatch.setattr(toxicity, "WORDS", 50)
    monkeypatch.setattr(wordstats, "WORDS", 50)
    words = [f"word{i}"[:1 + i % 9] for i in range(333)]
    for some in (words, words[:50], words[:51], []):
        one, all_ = toxicity.Letters.of(some), toxicity.Letters.of_all(some)
        assert all(np.array_equal(getattr(one, f), getattr(all_, f)) for f in ("word", "runs", "first"))
    made, make = [], wordstats.gram_buckets
    monkeypatch.setattr(wordstats, "gram_buckets", lambda words: made.append(len(words)) or make(words))
    monkeypatch.setattr(wordstats.Evidence, "_count", staticmethod(lambda *_: None))   # as many texts at a time
    toxicity.train([" ".join(words[i::7]) for i in range(60)], np.arange(60) % 2)
    assert max(made) <= 50


@pytest.mark.parametrize("of", [toxicity, quality])
def test_memory_of_the_training_is_given_back(spark, make_docs, monkeypatch, of):
    given = []
    monkeypatch.setattr(toxicity, "release", lambda: given.append(1))
    model = of.train(["good words", "bad words"] * 20, np.arange(40) % 2)
    n = len(given)
    assert toxicity.score(make_docs([(1, "good"), (2, None)]), model, [F.col("doc_id")]).count() == 2 and len(given) == n + 1
