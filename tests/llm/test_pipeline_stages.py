"""Each stage of the pipeline against a plain version of it, on a table with planted cases."""
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from test_line_dedup import brute as brute_lines
from test_near_duplicates import brute as brute_classes
from test_search_and_overlap import overlap_brute
from tokenizers import Tokenizer

import corpus_pipeline as P
from ledgerlake.llm import queries as Q
from ledgerlake.llm import toxicity
from ledgerlake.llm.common import stored
from ledgerlake.llm.learning import labelled_sample
from ledgerlake.session import new_scratch_path

INSULTS = ["vile", "scumbag", "worthless", "idiotic", "pathetic"]


@pytest.fixture(scope="module")
def corpus(spark):
    """Ids by kind, the tables' directory, and the documents as they are."""
    rng = random.Random(21)
    names = ["".join(rng.choice("bcdfgklmnprstv") + rng.choice("aeiou") for _ in range(3)) for _ in range(400)]
    line = lambda n: " ".join(rng.choice(names) for _ in range(n))
    text = lambda lines=6: "\n".join(line(14) for _ in range(lines))

    def toxic():
        words = text().split(" ")
        for _ in range(12):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        return " ".join(words)

    items = [(i, line(30)) for i in range(12)]
    rows, kinds = [], {}

    def add(kind, *texts):
        for t in texts:
            kinds.setdefault(kind, []).append(len(rows))
            rows.append((len(rows), t))

    add("clean", *(text() for _ in range(150)))
    add("toxic", *(toxic() for _ in range(70)))
    base = rows[3][1]
    add("copy", base, base)
    words = rows[5][1].replace("\n", " ").split(" ")
    add("near", *(" ".join(words[:i] + ["changed"] + words[i + 1:]) for i in (9, 50)), " ".join(words))
    add("contaminated", *(text(2) + "\n" + line(5) + " " + items[i][1] + " " + line(4) for i in range(6)))
    part = items[7][1].split(" ")
    part[4], part[17] = "other", "words"
    add("contaminated", text(1) + "\n" + " ".join(part))
    add("repeats", rows[8][1] + "\n" + line(14), "\n".join(reversed(rows[9][1].split("\n"))))
    add("odd", None, "", "\n\n")
    long = " ".join(line(14) for _ in range(900))
    add("clean", long)
    learn = [(d, int(kind == "toxic")) for kind in ("clean", "toxic") for d in kinds[kind][:60] if d < 250]
    path = new_scratch_path(spark, "planted")
    docs = spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t)) for d, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(d, 1, y) for d, y in learn], "doc_id bigint, quality bigint, toxic bigint").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return kinds, path, items


@pytest.fixture(scope="module")
def staged(spark, corpus):
    """The documents before the first stage and after each one."""
    _, path, _ = corpus
    docs = [spark.read.parquet(f"{path}/documents.parquet")]
    for name, stage in P.STAGES:
        docs.append(stored(stage(spark, docs[-1], path), "stage"))
    return docs


def rows_of(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_toxicity(spark, corpus, staged):
    kinds, path, _ = corpus
    before, after = rows_of(staged[0]), {d for d, _ in rows_of(staged[1])}
    model = toxicity.train(*labelled_sample(staged[0], spark.read.parquet(f"{path}/labels.parquet"), "toxic"))
    plain = {d for d, t in before if model.scores(pa.array([t], pa.string()))[0] < P.TOXIC}
    assert after == plain
    assert not after & set(kinds["toxic"]) and set(kinds["clean"]) <= after and set(kinds["near"] + kinds["repeats"]) <= after
    assert {d: t for d, t in before if d in after} == dict(rows_of(staged[1]))


def test_line_dedup(corpus, staged):
    kinds, _, _ = corpus
    before = rows_of(staged[1])
    dropped = brute_lines(before)
    want = {}
    for d, t in before:
        lines = (t or "").split("\n")
        own = [x for i, x in enumerate(lines) if i not in dropped.get(d, [])]
        if not t or not t.strip() or any(x.strip() for x in own):
            want[d] = None if t is None else "\n".join(own)
    assert dict(rows_of(staged[2])) == want
    assert not {*kinds["copy"], kinds["repeats"][1]} & set(want) and want[kinds["repeats"][0]].count("\n") == 0
    clean = dict(before)
    assert all(want[d] == clean[d] for d in kinds["clean"])


def test_near_duplicates(corpus, staged):
    kinds, _, _ = corpus
    before = rows_of(staged[2])
    classes = brute_classes(before)
    assert [d for d, _ in rows_of(staged[3])] == sorted({c for c, _ in classes.values()})
    near = [d for d, _ in rows_of(staged[3]) if d in [5, *kinds["near"]]]
    assert near == [5] and set(kinds["clean"]) <= {d for d, _ in rows_of(staged[3])}


def test_decontamination(corpus, staged):
    kinds, _, items = corpus
    before = rows_of(staged[3])
    bad = {d for d, _ in overlap_brute([(d, t or "") for d, t in before], items)}
    assert rows_of(staged[4]) == [r for r in before if r[0] not in bad]
    assert bad == set(kinds["contaminated"])


def test_packing(corpus, staged):
    tokenizer = Tokenizer.from_file(Q.word_vocabulary())
    pieces, held = {}, {}
    for r in staged[5].collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    before = dict(rows_of(staged[4]))
    assert set(pieces) == set(before)
    for d, text in before.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        own = sorted(pieces[d], key=lambda r: r["piece"])
        assert [(r["start"], r["length"]) for r in own] == [(s, min(4096, len(ids) - s)) for s in range(0, len(ids), 4096)]
        assert all(zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in own)
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r["length"] for own in pieces.values() for r in own)
    assert len(held) <= -(-total // 4096) + 1


def test_run_is_all_stages(spark, corpus, staged):
    _, path, _ = corpus
    keep = lambda df: sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert keep(P.run(spark, path)) == keep(staged[5])
