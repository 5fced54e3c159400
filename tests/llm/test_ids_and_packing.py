import itertools
import glob
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlake.llm import huffman, packing, tokens
from ledgerlake.llm import queries as Q

ODD = [(5, "one  two\n\n three"), (None, "no id"), (3, None), (4, ""), (7, "same text"), (7, "same text"),
       (9, "x<|endoftext|> y   z"), (11, "日本語 ÑANDÚ's ΑΣ it’s ² 1234567"), (12, " lead"), (13, "   "),
       (14, "word " * 30_000)]


def brute(rows, path, end):
    t = Tokenizer.from_file(path)
    out, at = [], 0
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [end], "<u4")
        out.append((d, at, ids))
        at += len(ids)
    return out


def test_ids_round_trip(spark, make_docs):
    path, _ = huffman.write_ids(make_docs(ODD, ["ids", "shard", "place"]), Q.byte_vocabulary)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"], r["ids"]) for r in huffman.read_ids(spark, path).collect())
    want = [(at, d, len(ids), zlib.crc32(ids.tobytes()), ids.tolist()) for d, at, ids in brute(ODD, Q.byte_vocabulary(), 2)]
    assert got == want


def test_ids_keep_their_order_when_sorts_spill(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.format_string("text %d", "id").alias("text"))
    conf = spark._jvm.org.apache.spark.SparkEnv.get().conf()
    conf.set("spark.shuffle.spill.numElementsForceSpillThreshold", "500")
    try:
        path, _ = huffman.write_ids(docs.repartition(7), Q.byte_vocabulary)
    finally:
        conf.remove("spark.shuffle.spill.numElementsForceSpillThreshold")
    rows = [tuple(r) for r in huffman.read_ids(spark, path, False).orderBy("start").select("doc_id", "start", "n_tokens").collect()]
    assert [d for d, _, _ in rows] == list(range(20_000))
    assert all(a[1] + a[2] == b[1] for a, b in zip(rows, rows[1:]))
    assert in_file_order(path) == list(range(20_000))
    # whole groups, not one for each backward step
    assert spark.read.parquet(f"{path}/groups").count() <= 20


def in_file_order(path):
    """The doc_ids as a reader meets them that takes the part files by name and sorts nothing."""
    files = sorted(glob.glob(f"{path.removeprefix('file://')}/groups/run=*/part-*.parquet"))
    return [d for f in files for own in pq.read_table(f, columns=["doc_ids"]).column(0).to_pylist() for d in own]


def test_files_hold_documents_in_ascending_order(spark):
    """Also where the texts' sizes and the input's splits differ much from one partition to the next."""
    docs = spark.range(6_000).select(((F.col("id") * 7919) % 6_000).alias("doc_id"), F.expr(
        "repeat(concat('word ', id, ' '), if(id % 6 < 2, 60, 1))").alias("text"))
    for n in (1, 5, 23):
        path, _ = huffman.write_ids(docs.repartition(n), Q.byte_vocabulary)
        assert in_file_order(path) == list(range(6_000))


def test_files_of_the_query_s_table_are_in_order(spark, sf):
    path, _ = huffman.write_ids(spark.read.parquet(f"{sf}/documents.parquet"), Q.byte_vocabulary)
    found = in_file_order(path)
    assert found == sorted(found) and len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_ids_empty_table(spark, make_docs):
    path, _ = huffman.write_ids(make_docs([]), Q.byte_vocabulary)
    assert huffman.read_ids(spark, path).count() == 0


def test_ids_query_matches_library(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {(d, at, len(ids), zlib.crc32(ids.tobytes())) for d, at, ids in brute(rows, Q.byte_vocabulary(), 2)}
    assert {tuple(r) for r in Q.op2_token_ids(spark, sf).collect()} == want


@pytest.mark.parametrize("counts", [[5], [1, 1], [0, 3, 0, 1], [2 ** k for k in range(30)], list(range(1, 400))])
def test_code_is_canonical_and_limited(counts):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts)
    used = lengths[lengths > 0]
    assert used.max() <= 16 and (lengths > 0).sum() == (counts > 0).sum()
    assert len(used) == 1 or sum(2.0 ** -n for n in used) == 1
    entropy = -(counts[counts > 0] / counts.sum() * np.log2(counts[counts > 0] / counts.sum())).sum()
    if counts.max() < 1000:
        assert entropy <= (counts * lengths).sum() / counts.sum() <= entropy + 1 or len(used) == 1
    code = huffman.Code.of_lengths(lengths)
    ids = np.random.default_rng(1).choice(np.flatnonzero(counts), 3 * huffman.BLOCK + 7)
    payload, checkpoints = huffman.pack(ids, code)
    assert (huffman.unpack(payload, checkpoints, len(ids), code.table()) == ids).all()
    # any block decodes from its checkpoint alone
    tail = huffman.unpack(payload, checkpoints[2:], len(ids) - 2 * huffman.BLOCK, code.table())
    assert (tail == ids[2 * huffman.BLOCK:]).all()


def check_packing(rows, docs, path, slack):
    want = {}
    for d, _, ids in brute(docs, path, 1):
        for k, at in enumerate(range(0, len(ids), 4096)):
            key = (d, k, at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes()))
            want[key] = want.get(key, 0) + 1
    got, bins = {}, {}
    for r in rows:
        key = tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32"))
        got[key] = got.get(key, 0) + 1
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == want
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    least = -(-sum(k[3] * n for k, n in want.items()) // 4096)
    assert len(bins) <= least * slack + 1


def test_packing_odd_rows(spark, make_docs):
    out = packing.pack(packing.pieces(make_docs(ODD, ["place", "length"]), Q.word_vocabulary))
    check_packing(out.collect(), ODD, Q.word_vocabulary(), 1.3)


def test_packing_query(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check_packing(Q.op8_packing(spark, sf).collect(), rows, Q.word_vocabulary(), 1.01)


def test_packing_empty(spark, make_docs):
    assert packing.pack(packing.pieces(make_docs([]), Q.word_vocabulary)).count() == 0


def test_child_keeps_every_piece():
    rng = np.random.default_rng(3)
    bins = packing.Bins(rng.integers(1, 4096, 300), 4096)
    a, b = bins.start(rng, 0.0), bins.start(rng, 0.9)
    c = bins.child(a, b, rng)
    assert (c >= 0).all() and bins.fill(c).max() <= 4096 and (bins.fill(c) > 0).all()


def triplets(n, seed):
    """Sizes of three pieces to a bin that fill ``n`` bins to the brim."""
    rng = np.random.default_rng(seed)
    a, b = rng.integers(1000, 1200, n), rng.integers(1300, 1400, n)
    return np.concatenate([a, b, 4096 - a - b]).tolist()


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_rounds_pack_what_best_fit_does_not(spark, seed):
    sizes = triplets(10, seed)
    bins = packing.Bins(np.array(sizes), 4096)
    assert bins.score(bins.start(np.random.default_rng(0), 0.0))[0] > 10 == bins.least()
    rows = packing.pack(spark.createDataFrame(list(enumerate(sizes)), "place bigint, length bigint")).collect()
    assert sorted(r["place"] for r in rows) == list(range(30))
    assert len({r["sequence_id"] for r in rows}) == 10
    for b in {r["sequence_id"] for r in rows}:
        assert sum(r["length"] for r in rows if r["sequence_id"] == b) == 4096


def test_least_is_no_more_than_any_packing():
    rng = np.random.default_rng(5)
    for _ in range(30):
        bins = packing.Bins(rng.integers(1, int(rng.integers(2, 101)), 6), 100)
        fewest = min(bins.score(bins.fit(np.full(6, -1), np.array(o)))[0] for o in itertools.permutations(range(6)))
        assert bins.least() <= fewest
    for sizes, n in (([60, 60, 60, 40], 3), ([51] * 5, 5), ([34] * 6, 3), ([100, 1], 2)):
        assert packing.Bins(np.array(sizes), 100).least() == n


def test_mutant_keeps_every_piece():
    rng = np.random.default_rng(4)
    bins = packing.Bins(rng.integers(1, 4096, 300), 4096)
    for c in (bins.mutant(bins.start(rng, 0.5), rng) for _ in range(20)):
        assert (c >= 0).all() and bins.fill(c).max() <= 4096 and (bins.fill(c) > 0).all()


def test_rounds_end_when_the_bound_cannot_be_met(spark):
    # by room alone four bins would do
    assert packing.Bins(np.array([1366] * 9), 4096).least() == 4
    rows = packing.pack(spark.createDataFrame([(i, 1366) for i in range(9)], "place bigint, length bigint")).collect()
    assert len(rows) == 9 and len({r["sequence_id"] for r in rows}) == 5


def test_a_worker_forgets_its_vocabulary():
    e = tokens.encoder(Q.word_vocabulary(), True)
    before = [x.tolist() for x in e.encode(pa.array(["one two", None, "three"]))]
    tokens.forget()
    assert tokens.encoder.cache_info().currsize == 0
    again = tokens.encoder(Q.word_vocabulary(), True)
    assert again is not e and [x.tolist() for x in again.encode(pa.array(["one two", None, "three"]))] == before
    tokens.forget()


VOCABULARIES = [(Q.word_vocabulary, True), (Q.byte_vocabulary, False)]


@pytest.mark.parametrize("vocabulary, lower", VOCABULARIES)
def test_plain_pieces_are_cut_as_arrays(vocabulary, lower, monkeypatch):
    """Letters and closing marks need no Python for each piece: it took most of the encoder's time."""
    texts = ["first Words, of a text; WITH marks?! größer Übel. ª º", None, "", "again first words."]
    e, t, cut = tokens.Encoder(vocabulary(), lower), Tokenizer.from_file(vocabulary()), []
    words = tokens.Encoder._words
    monkeypatch.setattr(tokens.Encoder, "_words", lambda self, piece: cut.append(piece) or words(self, piece))
    for _ in range(2):
        assert [x.tolist() for x in e.encode(pa.array(texts))] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    # a text's first piece has no space before it
    assert set(cut) <= ({""} if lower else {"first", "again", "", " "}) and len(cut) == len(set(cut))


@pytest.mark.parametrize("vocabulary, lower", VOCABULARIES)
def test_what_is_remembered_is_bounded_in_bytes(vocabulary, lower, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_PIECES", 8)
    monkeypatch.setattr(tokens, "CACHED_WORDS", 6)
    e, t = tokens.Encoder(vocabulary(), lower), Tokenizer.from_file(vocabulary())
    for n in range(4):
        texts = [f"some few words, {'long' * 40}{n} {'x' * 300}{n}. then 1{n} more’s of them İ{n}\nß Ⱥ{n} end", "a  b", " lead ", None]
        for _ in range(2):
            assert [x.tolist() for x in e.encode(pa.array(texts))] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    for known, most in ((e.of_piece, 8), (e.of_word, 6)):
        assert 0 < len(known.strings) <= most and known.strings.nbytes <= most * (tokens.CACHED_BYTES + 8) + 8
        assert len(known.ids.size) == len(known.strings) and len(known.ids.flat) == known.ids.size.sum()


def test_what_is_known_is_not_looked_through_again(monkeypatch):
    """A lookup costs what the new strings cost, however many are remembered."""
    made = []
    known = tokens.Known(200_000, lambda strings: made.append(len(strings)) or tokens.Ids.of([[len(s)] for s in strings.to_pylist()]))
    known.look(pa.array([f"w{i}" for i in range(100_000)], pa.large_string()))
    encoded, concat = [], pa.concat_arrays
    monkeypatch.setattr(pa, "concat_arrays", lambda arrays: encoded.append(sum(map(len, arrays))) or concat(arrays))
    at, ids = known.look(pa.array(["w7", "new", "w99999", "new"], pa.large_string()))
    assert made == [100_000, 1] and not encoded and ids.flat[at].tolist() == [2, 3, 6, 3]
    assert known.look(pa.array(["new"], pa.large_string()))[0].tolist() == [at[1]]


@pytest.mark.parametrize("n", [0, 1, 511, 513, 16384, 16385, 50_000])
def test_payloads_are_packed_in_parts(n):
    ids = np.minimum(np.random.default_rng(3).zipf(1.3, n), 60_000).astype("<u2")
    code = huffman.Code.of_lengths(huffman.code_lengths(np.bincount(ids, minlength=1 << 16)))
    payload, checkpoints = huffman.pack(ids, code)
    assert np.array_equal(checkpoints, (np.cumsum(code.lengths[ids]) - code.lengths[ids])[::huffman.BLOCK])
    assert np.array_equal(huffman.unpack(payload, checkpoints, n, code.table()), ids)
