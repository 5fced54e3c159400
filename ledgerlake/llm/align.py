"""Alignment of two tokenizers' ids by the bytes their tokens cover.

Tokenizer A gets a space and the text, tokenizer B the text, before which it
puts a space itself; so both cover the same bytes.  Two dictionaries lead from
the byte at which a token ends to its place; the keys they share, sorted, cut
both id lists into groups, and each group links all its A ids with all its B
ids.  The count of a linked id pair is the number of documents that hold it.

Neither tokenizer has a token across a single space between non-spaces, so
both end a token there: texts are cut at such spaces, and a stretch that comes
again in a block of texts is aligned once, many stretches in one call.
Stretches of any length are allowed (a text without such a space is one).

A text that is null or empty, or whose bytes the tokens of A or B do not spell
again, has no tokens: zeros and the empty ``groups_sha256``.  Rows equal in id
and text stay rows of their own and count as two documents.  An empty table
gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import blocks, broadcast_up_to, small_batches, stored
from ledgerlake.llm.spans import Texts, of_bytes, slices, text_of_each
from ledgerlake.llm.tokens import BYTE_WORDS, byte_letters

# Stretches encoded in one call, and the text worked on at once.  They bound memory.
CALL, BLOCK = 4096, 4 << 20
# The id pairs' counts are broadcast up to so many rows (24 bytes each); else joined by shuffle.
BROADCAST_PAIRS = 2_000_000
PLAIN = of_bytes(*range(33, 127))
LEAD_2 = of_bytes(*range(0xC3, 0xE0))
LEAD_3 = of_bytes(*range(0xE4, 0xF0))
LEAD_4 = of_bytes(*range(0xF0, 0xF5))
# ASCII that is no control character but tab and line ends, and U+00C0 to U+024F
COMMON = of_bytes(9, 10, 13, *range(32, 127), *range(0x80, 0xC0), *range(0xC3, 0xC9))


def common_ends(ends_a: Sequence[int], ends_b: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """The ends both lists have, ascending, and how many tokens of each list lie before them."""
    place_a = dict(zip(ends_a, range(1, len(ends_a) + 1)))
    place_b = dict(zip(ends_b, range(1, len(ends_b) + 1)))
    ends = sorted(place_a.keys() & place_b.keys())
    return ends, [place_a[e] for e in ends], [place_b[e] for e in ends]


@dataclass
class Groups:
    """The groups of consecutive stretches: ids, group sizes, and the groups up to each stretch's end."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    until: np.ndarray

    def numbers(self) -> np.ndarray:
        """Of each stretch: tokens of A and B, groups and links."""
        links = np.cumsum(self.sizes_a * self.sizes_b)
        totals = np.stack([self.cut_a, self.cut_b, np.arange(1, len(self.cut_a) + 1), links], axis=1)
        return np.diff(np.vstack([np.zeros((1, 4), np.int64), totals[self.until - 1]]), axis=0)

    @property
    def sizes_a(self) -> np.ndarray:
        return np.diff(self.cut_a, prepend=0)

    @property
    def sizes_b(self) -> np.ndarray:
        return np.diff(self.cut_b, prepend=0)

    def links(self) -> np.ndarray:
        """All pairs of each group in turn, as A id * 2^16 + B id."""
        a, b = self.sizes_a, self.sizes_b
        of = np.repeat(np.arange(len(a)), a * b)
        inside = expand(np.zeros(len(a), np.int64), a * b)
        return self.ids_a[(self.cut_a - a)[of] + inside // b[of]] << 16 | self.ids_b[(self.cut_b - b)[of] + inside % b[of]]

    def written(self, spelled: pa.Array, n_a: int) -> tuple[bytes, np.ndarray]:
        """The groups as text, each with a ``;`` behind it, and the text's length up to each
        stretch's end.  ``spelled`` has each id with what follows it inside and at the end of its list."""
        a, b = self.sizes_a, self.sizes_b
        order = np.empty(len(self.ids_a) + len(self.ids_b), np.int64)
        last_a, last_b = np.zeros(len(self.ids_a), np.int64), np.zeros(len(self.ids_b), np.int64)
        last_a[self.cut_a - 1], last_b[self.cut_b - 1] = 1, 1
        order[np.arange(len(last_a)) + np.repeat(self.cut_b - b, a)] = 2 * self.ids_a + last_a
        order[np.arange(len(last_b)) + np.repeat(self.cut_a, b)] = 2 * (n_a + self.ids_b) + last_b
        text = spelled.take(pa.array(order))
        at = np.frombuffer(text.buffers()[1], np.int64)
        return text.buffers()[2].to_pybytes(), at[(self.cut_a + self.cut_b)[self.until - 1]]


class Pair:
    """Both tokenizers, and the bytes of each of their ids."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of_letter = {c: b for b, c in byte_letters().items()}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for s, i in vocabulary.items():
            self.bytes_a[i] = bytes(of_letter[c] for c in s) if all(c in of_letter for c in s) else s.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.fast = self.ranked(path_a)
        # a piece with a space after something else could cross a cut
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.size_a, self.size_b = (np.array([len(x) for x in own], np.int64) for own in (self.bytes_a, self.bytes_b))
        self.spelled = pa.array([f"{i}{c}" for i in range(len(self.bytes_a)) for c in ",|"]
                                + [f"{i}{c}" for i in range(len(self.bytes_b)) for c in ",;"], pa.large_string())

    def ranked(self, path: str):
        """A's vocabulary as ranks, for a faster library that gives the same ids
        on common letters; None if its ids do not ascend with its merges."""
        import tiktoken

        with open(path) as f:
            model = json.load(f)["model"]
        made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if made != sorted(set(made)):
            return None
        ranks = {self.bytes_a[i]: i for i in model["vocab"].values() if i not in self.a.get_added_tokens_decoder()}
        return tiktoken.Encoding("ranked", pat_str=BYTE_WORDS, mergeable_ranks=ranks, special_tokens={})

    def groups(self, stretches: list[bytes], alike: bool = False) -> Groups | None:
        """The groups of stretches that stand one after the other; None if the
        tokens do not spell them again.  ``alike``: A's fast form may be used."""
        raw = b"".join(stretches)
        text = raw.decode()
        ids_a = self.fast.encode_ordinary(text) if alike else self.a.encode(text, add_special_tokens=False).ids
        # a call on a list is several times faster than one on a long text
        ids_b = list(chain.from_iterable(self.b.encode([x[1:].decode() for x in stretches], num_threads=1)))
        if b"".join([self.bytes_a[i] for i in ids_a]) != raw or b"".join([self.bytes_b[i] for i in ids_b]) != raw:
            return None
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        ends, cut_a, cut_b = common_ends(np.cumsum(self.size_a[a]).tolist(), np.cumsum(self.size_b[b]).tolist())
        stops, ends = np.cumsum([len(s) for s in stretches]), np.array(ends)
        until = np.searchsorted(ends, stops)
        if (ends[np.minimum(until, len(ends) - 1)] != stops).any():
            raise ValueError("a token crosses a cut")
        return Groups(a, b, np.array(cut_a), np.array(cut_b), until + 1)

    def stretches(self, spelled: pa.Array) -> Stretches:
        raws = spelled.to_pylist()
        plain = plain_stretches(spelled)
        alike = plain & common_letters(spelled) & (self.fast is not None)
        todo = [([i], False) for i in np.flatnonzero(~plain).tolist()]
        for kind in (False, True):
            joint = np.flatnonzero(plain & (alike == kind)).tolist()
            todo += [(joint[at:at + CALL], kind) for at in range(0, len(joint), CALL)]
        numbers, first, slot = (np.zeros((len(raws), 4), np.int64), np.zeros(len(raws), np.int64), np.zeros(len(raws), np.int64))
        pairs, texts, bounds, n_pairs, n_text, n_slots = [], [], [np.zeros(1, np.int64)], 0, 0, 0
        while todo:
            own, kind = todo.pop()
            groups = self.groups([raws[i] for i in own], kind)
            if groups is None:
                if len(own) > 1:
                    todo += [([i], kind) for i in own]
                else:
                    numbers[own[0], 0] = -1
                continue
            numbers[own] = groups.numbers()
            links = groups.links()
            first[own] = n_pairs + np.cumsum(numbers[own, 3]) - numbers[own, 3]
            slot[own] = n_slots + np.arange(len(own))
            text, until = groups.written(self.spelled, len(self.bytes_a))
            pairs.append(links), texts.append(text), bounds.append(n_text + until)
            n_pairs, n_text, n_slots = n_pairs + len(links), n_text + len(text), n_slots + len(own)
        offsets = np.concatenate(bounds)
        written = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n_slots, [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(texts))])
        return Stretches(numbers, np.concatenate(pairs) if pairs else np.zeros(0, np.int64), first, written, slot)


@dataclass
class Stretches:
    """Of distinct stretches: their ``numbers`` (-1 first: not spelled again), their id ``pairs`` from
    ``first`` on, and the groups ``written``, at ``slot``."""

    numbers: np.ndarray
    pairs: np.ndarray
    first: np.ndarray
    written: pa.Array
    slot: np.ndarray


def solid_before(d: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends at each place is certainly no white space (nor the sign B writes a space with)."""
    one, two, three, four = (d[at - k] for k in (1, 2, 3, 4))
    tail = lambda x: (x & 0xC0) == 0x80
    return PLAIN[one] | tail(one) & (LEAD_2[two] | tail(two) & (LEAD_3[three] | tail(three) & LEAD_4[four]))


def solid_after(d: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The same of the character that starts there."""
    x = d[np.minimum(at, len(d) - 1)] if len(d) else d[at]
    return PLAIN[x] | LEAD_2[x] | LEAD_3[x] | LEAD_4[x]


def cuts(texts: Texts) -> np.ndarray:
    """Where stretches start: each text's start, and each space between two characters that are certainly no white space."""
    at = np.flatnonzero(texts.data == 32)
    at = at[(at > 3) & (at + 1 < len(texts.data))]
    at = at[solid_before(texts.data, at) & solid_after(texts.data, at + 1)]
    return np.union1d(at, texts.bounds[:-1][np.diff(texts.bounds) > 0])


def raw_of(spelled: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.frombuffer(spelled.buffers()[1], np.int64)[spelled.offset:spelled.offset + len(spelled) + 1]
    return np.frombuffer(spelled.buffers()[2] or b"", np.uint8), bounds


def common_letters(spelled: pa.Array) -> np.ndarray:
    """Which values hold only characters that every library sorts alike into letters, digits, signs and space."""
    data, bounds = raw_of(spelled)
    return np.diff(np.r_[0, np.cumsum(~COMMON[data])][bounds]) == 0


def plain_stretches(spelled: pa.Array) -> np.ndarray:
    """Which stretches may stand side by side with a cut between them: a space first, then and last something solid."""
    data, bounds = raw_of(spelled)
    # four bytes ahead, so that a look back stays inside
    data, start, stop = np.r_[np.zeros(4, np.uint8), data], bounds[:-1] + 4, bounds[1:] + 4
    return (stop - start > 1) & (data[np.minimum(start, len(data) - 1)] == 32) & solid_after(data, start + 1) & solid_before(data, stop)


def expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, ``sizes`` long."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def sums(values: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(of, values, minlength=n).astype(np.int64)


ROWS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                  ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())),
                  ("times", pa.list_(pa.int32()))])
ROWS_DDL = ("row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
            "pairs array<bigint>, times array<int>")


def aligned_block(pair: Pair, doc_ids: pa.Array, texts: pa.Array, first_row: int) -> pa.RecordBatch:
    n = len(doc_ids)
    t = Texts.of(texts, before=" ")
    size = np.diff(t.bounds)
    starts = cuts(t) if pair.cuts else t.bounds[:-1][size > 0]
    # the space alone: an empty text
    starts = starts[size[text_of_each(starts, t.bounds)] > 1]
    of = text_of_each(starts, t.bounds)
    stops = np.minimum(np.r_[starts[1:], len(t.data)], t.bounds[of + 1])
    coded = slices(t.data, starts, stops)
    code = coded.indices.to_numpy().astype(np.int64)
    own = pair.stretches(coded.dictionary)
    bad = np.zeros(n, bool)
    bad[of[own.numbers[code, 0] < 0]] = True
    good = ~bad[of]
    of, code = of[good], code[good]
    n_a, n_b, n_groups, n_links = (sums(own.numbers[code, c], of, n) for c in range(4))
    hashes = []
    for lo, hi in document_blocks(of, n):  # few documents at a time: their groups are written out
        at = np.searchsorted(of, [lo, hi])
        text = own.written.take(pa.array(own.slot[code[at[0]:at[1]]]))
        bounds = np.frombuffer(text.buffers()[1], np.int64)[np.searchsorted(of[at[0]:at[1]], np.arange(lo, hi + 1))].tolist()
        view = memoryview(text.buffers()[2]) if text.buffers()[2] is not None else memoryview(b"")
        hashes += [hashlib.sha256(view[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(bounds, bounds[1:])]
    # each document's id pairs: distinct stretches first, then distinct pairs
    key = of * max(1, len(own.numbers)) + code
    key, times = np.unique(key, return_counts=True)
    doc, code = key // max(1, len(own.numbers)), key % max(1, len(own.numbers))
    many = own.numbers[code, 3]
    doc, times = np.repeat(doc, many), np.repeat(times, many)
    key = doc << 32 | own.pairs[expand(own.first[code], many)]
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    times = np.add.reduceat(times, new) if len(new) else np.zeros(0, np.int64)
    key = key[new]
    offsets = pa.array(np.searchsorted(key >> 32, np.arange(n + 1)), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(first_row, first_row + n)), doc_ids.cast(pa.int64()), *(pa.array(x) for x in (n_a, n_b, n_groups, n_links)),
         pa.array(hashes, pa.string()), pa.ListArray.from_arrays(offsets, pa.array(key & 0xFFFFFFFF)),
         pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))], schema=ROWS)


def document_blocks(of: np.ndarray, n: int, stretches: int = 200_000) -> Iterator[tuple[int, int]]:
    """Ranges of documents that hold at most so many stretches, or one document each."""
    until = np.searchsorted(of, np.arange(1, n + 1))
    lo = 0
    while lo < n:
        before = until[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(until, before + stretches, side="right")))
        yield lo, hi
        lo = hi


def aligned(docs: DataFrame, path_a: Callable[[], str] | str, path_b: Callable[[], str] | str) -> DataFrame:
    """A row for each document: its numbers and groups' hash, and its distinct
    id ``pairs`` with the ``times`` each occurs."""
    small_batches(docs.sparkSession, 64)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(*(p() if callable(p) else p for p in (path_a, path_b)))
        row = TaskContext.get().partitionId() << 40
        for b in blocks(it, "text", BLOCK):
            yield aligned_block(pair, b.column("doc_id"), b.column("text"), row)
            row += b.num_rows

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, ROWS_DDL)


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair, count (documents that hold it) and best (1: no pair of its A id has a higher count)."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("count"))
    counts = stored(counts, "pair-counts")
    id_a = F.shiftright("pair", 16)
    most = counts.groupBy(id_a.alias("a")).agg(F.max("count").alias("most"))
    # at most one row for each id of A: 2^16
    return counts.join(F.broadcast(most), id_a == F.col("a")).select("pair", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))


def alignment(docs: DataFrame, path_a: Callable[[], str] | str, path_b: Callable[[], str] | str,
              broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    rows = stored(aligned(docs, path_a, path_b), "aligned")
    counts = broadcast_up_to(stored(pair_counts(rows), "counts"), broadcast_pairs)
    own = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
    times: Column = F.col("times").cast("bigint")
    sums_of = (own.join(counts, F.col("pairs") == F.col("pair")).groupBy("row")
               .agg(F.sum(times * F.col("count")).alias("count_sum"), F.sum(times * F.col("best")).alias("n_best")))
    return rows.drop("pairs", "times").join(sums_of, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
