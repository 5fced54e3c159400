import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerlake.llm import align
from ledgerlake.llm import queries as Q
from ledgerlake.llm.tokens import byte_letters

COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def brute(texts):
    """The result of each text, from whole texts and one step for each byte."""
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    letter = {c: x for x, c in byte_letters().items()}
    found = []
    for text in texts:
        groups = []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            raw_a = [bytes(letter[c] for c in a.id_to_token(i)) for i in ids_a]
            raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
                i = j = at_a = at_b = 0
                own = ([], [])
                while i < len(ids_a) or j < len(ids_b):
                    if at_a <= at_b:
                        own[0].append(ids_a[i])
                        at_a += len(raw_a[i])
                        i += 1
                    else:
                        own[1].append(ids_b[j])
                        at_b += len(raw_b[j])
                        j += 1
                    if at_a == at_b:
                        groups.append(own)
                        own = ([], [])
        found.append(groups)
    count = Counter()
    for groups in found:
        count.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for groups in found:
        own = [(x, y) for g in groups for x in g[0] for y in g[1]]
        spelled = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(own),
                    sum(count[p] == most[p[0]] for p in own), sum(count[p] for p in own),
                    hashlib.sha256(spelled.encode()).hexdigest() if groups else ""))
    return out


ODD = [None, "", " ", "  ", "a", " lead", "trail ", "two  spaces here", "tabs\tand\nlines\r\n more", "a \n b", "▁ mark", "a▁b and more",
       "<|endoftext|> as text </s> <s> <unk> <0x41>", "naïve café über straße", "日本語 のテキスト、そして more 한국어 ок", "no break   wide　space x",
       "a\u0085 b", "x\x00y z", "﻿mark ﬁ", "𝒳 🙂🙂 🙂 end", "it's the dogs' don't", "same same same", "same same same", "123 4567 89,00.1",
       "x" * 30000, "word " * 5000, "é" * 999 + " " + "ü" * 10, "\n\n\nthe the", "a  " * 50, "​ ​ zero", "“quoted” – dash… end"]


def test_against_whole_texts(make_docs, spark, sf):
    given = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    texts = ODD + given
    rows = list(enumerate(texts)) + [(None, "a row without an id"), (3, "the same id again"), (3, "the same id again")]
    want = brute([t for _, t in rows])
    for most in (0, 10**6):  # counts joined by shuffle, and broadcast
        out = align.alignment(make_docs(rows, ["pairs", "row", "a", "count"]), Q.byte_vocabulary, Q.piece_vocabulary, most).collect()
        key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
        assert sorted(((r["doc_id"], *(r[c] for c in COLUMNS)) for r in out), key=key) == sorted(
            ((d, *w) for (d, _), w in zip(rows, want)), key=key)
    zero = {r["doc_id"]: r for r in out if r["doc_id"] in (0, 1)}
    assert all(zero[d]["n_a"] == zero[d]["n_links"] == 0 and zero[d]["groups_sha256"] == "" for d in (0, 1))


def test_blocks_of_any_size_agree():
    import pyarrow as pa

    pair = align.Pair(Q.byte_vocabulary(), Q.piece_vocabulary())
    whole = align.aligned_block(pair, pa.array(range(len(ODD))), pa.array(ODD), 0).to_pylist()
    apart = [align.aligned_block(pair, pa.array([i]), pa.array([t], pa.string()), i).to_pylist()[0] for i, t in enumerate(ODD)]
    assert whole == apart


def test_both_forms_of_a_agree(spark, sf):
    pair = align.Pair(Q.byte_vocabulary(), Q.piece_vocabulary())
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts += ["".join(map(chr, [*range(32, 127), 10, 9, 32, 13, *range(0xC0, 0x240)])), "a\n\n b \t\t c  d   e\r\n", "I'LL I'll 12 3,4 ×÷"]
    for text in texts:
        assert pair.fast.encode_ordinary(text) == pair.a.encode(text, add_special_tokens=False).ids


def test_groups_by_hand():
    assert align.common_ends([2, 5, 6], [5, 6]) == ([5, 6], [2, 3], [1, 2])
    assert align.common_ends([], []) == ([], [], [])
    groups = align.Groups(np.array([1, 2, 3]), np.array([7, 8, 9]), np.array([2, 3]), np.array([2, 3]), np.array([1, 2]))
    assert groups.links().tolist() == [1 << 16 | 7, 1 << 16 | 8, 2 << 16 | 7, 2 << 16 | 8, 3 << 16 | 9]
    assert groups.numbers().tolist() == [[2, 2, 1, 4], [1, 1, 1, 1]]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, ""), (2, None)]])
def test_tables_without_tokens(make_docs, rows):
    out = align.alignment(make_docs(rows), Q.byte_vocabulary, Q.piece_vocabulary).collect()
    assert len(out) == len(rows) and all(r["n_a"] == r["n_groups"] == r["count_sum"] == 0 for r in out)
