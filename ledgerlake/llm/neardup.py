"""Near-duplicates by Order MinHash and banded alignment.

A text is its sequence of lower-case words; its k-mers are runs of ``K`` words
labelled by occurrence (the second time a run occurs it is another k-mer).
Each of ``HASHES`` sketch values takes the ``L`` k-mers of least hash and keeps
them in text order, so texts must agree in order to agree in a value.  Two
texts are linked if their k-mers, aligned in order within the widest shift the
threshold allows, have a similarity common / (a + b - common) >= ``THRESHOLD``.

Words are compared by 16 bits of their hashes: of two texts that differ in a word, one
in 65,536 pairs seems not to.

Equal texts are one node from the start.  Candidates share a sketch value; texts
of at most ``SHORT`` k-mers, of which a sketch takes too large a part, have keys
besides by which no link between two of them is missed.  A bucket's members are
not paired: first all are compared with a centre, so that groups of copies become
components.  Where a bucket has at most ``FEW`` pairs of a node outside its largest
component and another, those of different components are compared.  The nodes of
the other buckets (of large groups, or texts that share a passage) meet by a prefix
filter instead: of n k-mers, the fifth that is rarest, and one more, hold a common one
if the similarity is 0.8.  Pairs whose k-mers differ too much by the parities of
their classes of hash are left out as they meet, and those that cannot agree so far
by their counts before any text is fetched.  Every candidate link
between different components is found; what joins them needs no more comparing.

A text with fewer than ``K`` words has one k-mer.  Null texts and texts without
a word are nobody's copy.  Rows equal in id and text share a result; of a class
the smallest doc_id stays (null ids first), one row of it.  An empty table
gives no rows.  Other columns pass through.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import small_batches, stored
from ledgerlake.llm.groups import (ODD, able, all_pairs, class_counts, components, members_of, mix, open_runs, parities, reach, star_pairs,
                                   totals, with_links)
from ledgerlake.llm.tokens import forget

K = 5
L = 5
HASHES = 28
SHORT = 50
# Hashes of a text's k-mers held at once; a longer text is sketched one hash at a time.
AT_ONCE = 1 << 18
THRESHOLD = 0.8
PERCENT = 80
# Buckets with at most so many pairs of a node outside their largest component are worked off pair by pair.
FEW = 256
COUNTERS = 1 << 20
BROADCAST_PAIRS = 100_000


def word_hashes(texts: pa.Array) -> list[np.ndarray]:
    """64-bit hashes of each text's words, in order."""
    flat, ends = flat_hashes(texts)
    return np.split(flat, ends[1:-1]) if len(texts) else []


def flat_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all texts' words end to end, and the bounds of each text."""
    if not len(texts):
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    lower = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    split = pc.split_pattern_regex(lower, r"[^\p{L}\p{N}]+")
    ends = split.offsets.to_numpy() - split.offsets[0].as_py()
    words = split.flatten().dictionary_encode()
    spelled = words.dictionary.to_pylist()
    hashes = pd.util.hash_array(np.array(spelled, dtype=object), categorize=False)
    at = words.indices.to_numpy()
    real = np.array([w != "" for w in spelled])[at]
    return hashes[at[real]], np.r_[0, np.cumsum(real)][ends]


def kmers(words: np.ndarray) -> np.ndarray:
    """Occurrence-labelled hashes of the runs of K words (one run, if fewer)."""
    words = words.astype(np.uint64)
    if not len(words):
        return words
    n = max(1, len(words) - K + 1)
    h = np.zeros(n, np.uint64)
    for j in range(min(K, len(words))):
        h = h * ODD + mix(words[j:j + n] + np.uint64(j + 1))
    order = np.argsort(h, kind="stable")
    new = np.r_[True, h[order][1:] != h[order][:-1]]
    at = np.arange(n)
    label = np.empty(n, np.uint64)
    label[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return mix(h + label * ODD)


def sketch(labelled: np.ndarray) -> np.ndarray:
    """One number per hash: its L least k-mers, in text order."""
    seeds = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * ODD)
    if len(labelled) > L:
        least = np.empty((HASHES, L), np.int64)
        some = max(1, AT_ONCE // len(labelled))
        for at in range(0, HASHES, some):
            values = mix(labelled[None, :] ^ seeds[at:at + some, None])
            least[at:at + some] = np.sort(np.argpartition(values, L - 1, axis=1)[:, :L], axis=1)
    else:
        least = np.tile(np.arange(len(labelled)), (HASHES, 1))
    out = seeds.copy()
    for j in range(least.shape[1]):
        out = mix(out * ODD + labelled[least[:, j]])
    return out


def exact_keys(labelled: np.ndarray) -> np.ndarray:
    """The k-mers of least hash, so many that texts of similarity ``THRESHOLD``
    share one: of n k-mers at least THRESHOLD * n are common, so the rest and
    one more hold a common one, and the least common one is among both texts'."""
    n = len(labelled)
    return mix(np.sort(labelled)[:n - math.ceil(THRESHOLD * n - 1e-9) + 1] ^ ODD)


def compare(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> tuple[float, bool]:
    """Jaccard similarity of the labelled k-mers, and whether the alignment in
    order reaches the threshold."""
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    total = len(a) + len(b)
    jaccard = len(at_a) / (total - len(at_a))
    if jaccard < threshold:
        return jaccard, False
    least = threshold * total / (1 + threshold)
    near = np.abs(at_a - at_b) <= max(len(a), len(b)) - least + 1
    chain = at_b[near][np.argsort(at_a[near])]
    if len(chain) and (np.diff(chain) > 0).all():
        common = len(chain)
    else:  # the longest ascending chain is the best alignment in order
        tails: list[int] = []
        for x in chain.tolist():
            at = bisect_left(tails, x)
            tails[at:at + 1] = [x]
        common = len(tails)
    return jaccard, common / (total - common) >= threshold


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, x (text hash), node (None without words), codes (16 bits a word) and the sketch values."""
    small_batches(docs.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for b in it:
            nodes, codes, keys = [], [], []
            for words in word_hashes(b.column(2)):
                if not len(words):
                    nodes.append(None), codes.append(None), keys.append([])
                    continue
                nodes.append(hashlib.md5(words.tobytes()).digest())
                own = (words >> np.uint64(48)).astype("<u2")
                codes.append(own.tobytes())
                labelled = kmers(own)
                more = [exact_keys(labelled)] * (len(labelled) <= SHORT)
                keys.append(np.concatenate([sketch(labelled), *more]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(nodes, pa.binary()), pa.array(codes, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "x", "node", "codes", "keys"])

    return docs.select("doc_id", F.xxhash64("text").alias("x"), "text").mapInArrow(
        run, "doc_id bigint, x bigint, node binary, codes binary, keys array<bigint>")


def texts_of(rows: DataFrame, members: DataFrame) -> DataFrame:
    """node, codes, n (k-mers), classes (their counts by class) and bits (their parities) of the nodes among the members."""
    texts = rows.filter(F.col("node").isNotNull()).select("node", "codes").join(members.select("node").distinct(), "node", "left_semi")
    texts = texts.groupBy("node").agg(F.first("codes").alias("codes"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            own = [kmers(np.frombuffer(c, "<u2")) for c in b.column("codes").to_pylist()]
            bounds = np.cumsum([0, *map(len, own)])
            flat = np.concatenate(own) if own else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("codes"), pa.array(np.diff(bounds), pa.int64()),
                                              pa.array(class_counts(flat, bounds), pa.binary()), parities(flat, bounds)],
                                             names=["node", "codes", "n", "classes", "bits"])

    return texts.mapInArrow(run, "node binary, codes binary, n bigint, classes binary, bits array<bigint>")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: those whose class counts allow it are aligned."""
    pairs = stored(able(pairs, texts, PERCENT), "pairs")
    left, right = texts, texts
    if pairs.count() <= BROADCAST_PAIRS:  # few pairs: their ends pick the texts before anything is shuffled
        left, right = (texts.join(F.broadcast(pairs.select(F.col(c).alias("node")).distinct()), "node", "left_semi") for c in "ab")
    left = left.select(F.col("node").alias("a"), F.col("codes").alias("codes_a"))
    right = right.select(F.col("node").alias("b"), F.col("codes").alias("codes_b"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            known: dict[bytes, np.ndarray] = {}
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                for t in (x, y):
                    if t not in known:
                        known[t] = kmers(np.frombuffer(t, "<u2"))
                ok.append(compare(known[x], known[y])[1])
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "codes_a", "codes_b")
    return stored(joined.mapInArrow(run, "a binary, b binary"), "verified")


def prefixes(texts: DataFrame) -> DataFrame:
    """node, n, weight and prefix: so many of its k-mers, rare ones first, that texts of similarity ``THRESHOLD``
    share one.  k-mers are ranked by their counts over these texts."""
    def hashes(it: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for b in it:
            yield from (kmers(np.frombuffer(c, "<u2")) for c in b.column(0).to_pylist())

    counts = texts.sparkSession.sparkContext.broadcast(totals(texts.select("codes"), hashes, COUNTERS))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            found, weight = [], []
            for c in b.column("codes").to_pylist():
                h = kmers(np.frombuffer(c, "<u2"))
                often = counts.value[(h & np.uint64(COUNTERS - 1)).astype(np.int64)]
                first = np.lexsort((h, often))[:reach(len(h), PERCENT) + 1]
                # a k-mer that no other text's class holds has no partner (places only move ahead: no pair goes)
                found.append(h[first][often[first] > 1].view(np.int64)), weight.append(int(often[first].sum()))
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("n"), pa.array(weight, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                                             names=["node", "n", "weight", "prefix"])

    return texts.select("node", "n", "codes").mapInArrow(run, "node binary, n bigint, weight bigint, prefix array<bigint>")


def links(rows: DataFrame) -> DataFrame:
    """a, b of linked nodes, enough to join every candidate link's ends."""
    return linked(rows)[0]


def linked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The links, and node and root of every node they join, in a fixed number of steps."""
    small_batches(rows.sparkSession)
    keyed = rows.filter(F.col("node").isNotNull()).select("node", F.explode("keys").alias("run")).distinct()
    sizes = keyed.groupBy("run").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = stored(keyed.join(sizes, "run"), "buckets")
    texts = stored(texts_of(rows, members), "texts")
    # who meets the most others is most likely what they are copies of: the best centre
    meets = members.groupBy("node").agg(F.sum("size").alias("meets")).join(texts.select("node", "n"), "node")
    # a sketch value has no place in an order: any partner of a size within reach counts
    members = stored(members.drop("size").join(meets, "node").withColumn("pos", F.lit(-1 << 30)), "members")
    found = [verified(star_pairs(open_runs(members, None), 1, PERCENT), texts)]
    labels = with_links(None, found[0])

    left = open_runs(members, labels)
    pairs = left.groupBy("run").agg((F.count_if(~F.col("major")) * F.first("nodes")).alias("pairs"))
    few = left.join(pairs.filter(F.col("pairs") <= FEW).select("run"), "run", "left_semi")
    found.append(verified(all_pairs(few, texts, PERCENT), texts))
    labels = with_links(labels, found[1])

    # the other buckets, of large groups or of texts that are hardly alike: only nodes that share a k-mer of
    # their prefixes can link
    many = left.join(pairs.filter(F.col("pairs") > FEW).select("run"), "run", "left_semi").select("node").distinct()
    many = stored(texts.join(many, "node", "left_semi"), "many")
    if many.head(1):
        members = stored(members_of(prefixes(many), PERCENT), "prefix-members")
        for pairs_of in (lambda own: star_pairs(own, 1, PERCENT), lambda own: all_pairs(own, many, PERCENT)):
            found.append(verified(pairs_of(open_runs(members, labels)), texts))
            labels = with_links(labels, found[-1])
    return reduce(DataFrame.union, found), labels


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, x, root (None: nobody's copy), class_id and n_class of every row."""
    rows = stored(sketched(docs), "sketches")
    roots = linked(rows)[1]
    own = rows.select("doc_id", "x", "node").join(roots, "node", "left").select(
        "doc_id", "x", F.coalesce("root", "node").alias("root"))
    own = stored(own, "roots")
    sizes = own.filter(F.col("root").isNotNull()).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").alias("class_id"), "x")).alias("first"), F.count(F.lit(1)).alias("n_class"))
    sizes = sizes.filter("n_class > 1").select("root", "first.class_id", F.col("first.x").alias("class_x"), "n_class")
    return own.join(sizes, "root", "left").select(
        "doc_id", "x", F.when(F.col("n_class").isNotNull(), F.col("root")).alias("root"),
        F.when(F.col("n_class").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_class", F.lit(1)).alias("n_class"),
        F.when(F.col("n_class").isNull(), F.lit(True)).otherwise(
            F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("x") == F.col("class_x"))).alias("kept"))


def dedup(docs: DataFrame) -> DataFrame:
    """The documents, one of each class."""
    own = classes(docs).select("doc_id", "x", "root", "kept").distinct().alias("o")
    d = docs.withColumn("_x", F.xxhash64("text")).alias("d")
    kept = d.join(own, F.expr("d.doc_id <=> o.doc_id and d._x = o.x")).filter("o.kept").select("d.*", F.col("o.root").alias("_root"))
    alone, first = kept.filter("_root is null"), kept.filter("_root is not null").dropDuplicates(["_root"])
    return alone.unionByName(first).select(*docs.columns)
