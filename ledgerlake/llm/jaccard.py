"""Exact similarity join on word shingles, with adaptive multi-match prefixes.

A text's set is its distinct runs of ``K`` words (lower-case A-Z, split at
blanks and line ends), as 64-bit hashes; fewer words are one run.  Texts with
a Jaccard similarity of ``PERCENT`` in a hundred or more are linked, and
linked texts form components.

All sets are sorted by one order of the runs, rare ones first (counted over
all texts in ``COUNTERS`` counters; the order need only be the same for all).
Two sets of n and m runs link if they share o = ceil(p (n + m) / (100 + p)).
Then, for any l, the first n - o + l runs of one and m - o + l of the other
share l.  With l = 1 that is the usual prefix.  Each set chooses its own l by
the estimated cost of its candidates, and a partner must share l of the longer
prefix's runs before the sets themselves are compared.  A pair goes by the
smaller l of the two.  (Pairs meet on the runs that may be the first they share,
those of the usual prefix; the others are counted on the pair.)

Equal sets are one node from the start.  A run's nodes are not paired with
each other: first, a few centres of each run's nodes are compared with the
others, so that groups of copies become components; then the nodes outside a
run's largest component are compared with those of other components.  All
pairs of different components that pass the prefixes are compared in the end,
so no component is missed; pairs inside one need no comparison.

Null texts and texts without words have no runs and no links.  Rows equal in
id and text are rows of their own.  Null ids never are a component's id, unless
it has no other.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import blocks, broadcast_up_to, small_batches, stored
from ledgerlake.llm.groups import (ODD, all_pairs, class_counts, counts_of, members_of, mix, open_runs, parities, reach, shared, star_pairs,
                                   totals, with_links)
from ledgerlake.llm.spans import Texts, lower, of_bytes, runs, slices, text_of_each

K = 3
PERCENT = 90
BREAKS = of_bytes(0x20, *range(0x09, 0x0E))
COUNTERS = 1 << 20
MOST_MATCHES = 8
# What a comparison of two sets costs, in runs looked up.
COMPARISON = 16
# Centres of each run's nodes, by turn; no further turn if less than so many of a turn's promising pairs link.
CENTRES = (1, 4, 16)
FRUITFUL = 0.1
BROADCAST_ROWS = 500_000


def all_runs(texts: pa.Array, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the runs of all texts, and the text of each."""
    t = Texts.of(texts)
    data = lower(t.data)
    starts, stops = runs(BREAKS[data], t.bounds)
    of = text_of_each(starts, t.bounds)
    coded = slices(data, starts, stops)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    words = hashes[coded.indices.to_numpy()] if len(hashes) else hashes
    n_words = np.bincount(of, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    found, owner = [], []
    for size in range(1, k + 1):
        if size < k:  # whole texts
            doc = np.flatnonzero(n_words == size)
            at = first[doc]
        else:
            at = np.flatnonzero(of[:-k + 1] == of[k - 1:]) if k > 1 else np.arange(len(of))
            doc = of[at]
        h = np.full(len(at), size, np.uint64)
        for j in range(size):
            h = mix(h * ODD ^ words[at + j])
        found.append(h), owner.append(doc)
    return np.concatenate(found), np.concatenate(owner)


def shingles(texts: pa.Array, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs of each text, ascending, end to end, and the bounds of each text."""
    h, doc = all_runs(texts, k)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])] if len(h) else np.zeros(0, bool)
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(texts) + 1))


def run_counts(docs: DataFrame) -> np.ndarray:
    """How often all texts hold the runs (each as often as it comes) of each of the ``COUNTERS`` classes of hashes."""
    small_batches(docs.sparkSession, 64)
    return totals(docs.select("text"), lambda it: (all_runs(b.column("text"))[0] for b in blocks(it, "text")), COUNTERS)


def matches(costs: np.ndarray, first: np.ndarray, n: np.ndarray, percent: int, most: int) -> np.ndarray:
    """How many shared runs each set asks for: the number of least cost, of looking its prefix's runs up and of
    comparing those found so often.  ``costs``: the nodes expected at each run, the sets end to end from ``first`` on."""
    until = np.r_[0, np.cumsum(costs)]
    lookups = [until[first + np.minimum(reach(n, percent) + k, n)] - until[first] for k in range(1, most + 1)]
    cost = np.stack([x * (1 + COMPARISON / k) for k, x in enumerate(lookups, 1)])
    able = np.arange(1, most + 1)[:, None] <= np.maximum(1, n - reach(n, percent))[None, :]
    return np.argmin(np.where(able, cost, np.inf), axis=0) + 1


ROWS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("x", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
                  ("matches", pa.int32()), ("weight", pa.int64()), ("classes", pa.binary()), ("bits", pa.list_(pa.int64())), ("prefix", pa.list_(pa.int64()))])
ROWS_DDL = "row bigint, doc_id bigint, x bigint, n bigint, digest binary, matches int, weight bigint, classes binary, bits array<bigint>, prefix array<bigint>"


def prefixed(docs: DataFrame, counts: np.ndarray, percent: int, most: int) -> DataFrame:
    """A row for each document: its set's size and digest (null without runs), the shared
    runs it asks for, and its prefix."""
    small_batches(docs.sparkSession, 64)
    of_class = docs.sparkSession.sparkContext.broadcast(counts)
    usual = int(counts.mean())

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, row = of_class.value, TaskContext.get().partitionId() << 40
        for b in blocks(it, "text"):
            h, bounds = shingles(b.column("text"))
            n, size = np.diff(bounds), b.num_rows
            digests = [hashlib.md5(h[lo:hi].tobytes()).digest() if hi > lo else None for lo, hi in zip(bounds, bounds[1:])]
            own = counts[(h & np.uint64(COUNTERS - 1)).astype(np.int64)]
            order = np.lexsort((h, own, np.repeat(np.arange(size), n)))
            asks = matches(np.maximum(0, own[order] - usual), bounds[:-1], n, percent, most)
            # texts of few rare runs are what others are copies of
            until = np.r_[0, np.cumsum(own[order])]
            weight = until[bounds[:-1] + np.minimum(n, reach(n, percent) + 1)] - until[bounds[:-1]]
            length = np.where(n > 0, np.minimum(n, reach(n, percent) + asks), 0)
            ends = np.cumsum(length)
            at = np.repeat(bounds[:-1] - (ends - length), length) + np.arange(length.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + size)), b.column("doc_id"), b.column("x"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(asks, pa.int32()), pa.array(weight, pa.int64()), pa.array(class_counts(h, bounds), pa.binary()), parities(h, bounds),
                 pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(h[order][at].view(np.int64)))],
                schema=ROWS)
            row += size

    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("x"), "text").mapInArrow(run, ROWS_DDL)


def sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and runs (ascending, 64 bits each) of the nodes, from the texts of the rows they stand for."""
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("x"), "text").alias("d")
    w = broadcast_up_to(nodes.select("node", F.col("doc_id").alias("of"), F.col("x").alias("of_x")), BROADCAST_ROWS).alias("w")
    texts = d.join(w, F.expr("d.x = w.of_x and d.doc_id <=> w.of")).select("w.node", "d.text")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(it, "text"):
            h, bounds = shingles(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([h[lo:hi].tobytes() for lo, hi in zip(bounds, bounds[1:])], pa.binary())],
                                             names=["node", "runs"])

    return texts.mapInArrow(run, "node bigint, runs binary")


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two ascending arrays of distinct values share."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                ok.append(common(x, y) >= shared(len(x), len(y), percent))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    of = lambda c: sets.select(F.col("node").alias(c), F.col("runs").alias(f"runs_{c}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "runs_a", "runs_b").mapInArrow(run, "a bigint, b bigint")


def promising(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs that share as many runs of their lengthened prefixes as the pair asks for, and whose class counts allow
    a link: no pair that links goes.  Only the nodes of the pairs are sent to them."""
    pairs = stored(pairs, "candidates")
    nodes = nodes.join(broadcast_up_to(ends_of(pairs), BROADCAST_ROWS), "node", "left_semi")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ok = []
            for x, y in zip(batch.column("of_a").to_pylist(), batch.column("of_b").to_pylist()):
                ask = min(x["matches"], y["matches"])
                spare = ask - shared(x["n"], y["n"], percent)
                both = set(x["prefix"][:x["n"] + spare]) & set(y["prefix"][:y["n"] + spare])
                ok.append(len(both) >= ask and np.minimum(counts_of(x["classes"]), counts_of(y["classes"])).sum()
                          >= shared(x["n"], y["n"], percent))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    own = F.struct("n", "matches", "prefix", "classes")
    of = lambda c: nodes.select(F.col("node").alias(c), own.alias(f"of_{c}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "of_a", "of_b").mapInArrow(run, "a bigint, b bigint")


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def found_links(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs that link; only the sets of their nodes are made again."""
    sets = sets_of(docs, nodes.select("node", "doc_id", "x").join(ends_of(pairs), "node", "left_semi"))
    return stored(linked(pairs, stored(sets.dropDuplicates(["node"]), "sets"), percent), "links")


def node_components(docs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """node and root of every node that is linked with another."""
    members = stored(members_of(nodes, percent), "members")
    labels = None
    for centres in CENTRES:
        pairs = stored(promising(star_pairs(open_runs(members, labels), centres, percent), nodes, percent), "star-pairs")
        found = found_links(docs, nodes, pairs, percent)
        labels = with_links(labels, found)
        if found.count() < FRUITFUL * pairs.count():  # the rest are hardly copies of each other
            break
    return with_links(labels, found_links(docs, nodes, stored(promising(all_pairs(open_runs(members, labels), nodes, percent), nodes, percent), "pairs"), percent))


def joined(docs: DataFrame, percent: int = PERCENT, most: int = MOST_MATCHES) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    rows = stored(prefixed(docs, run_counts(docs), percent, most), "prefixes")
    one = rows.filter("n > 0").groupBy("digest").agg(F.min_by(F.struct("row", "doc_id", "x", "n", "matches", "weight", "classes", "bits", "prefix"), "row").alias("s"))
    nodes = stored(one.select("digest", F.col("s.row").alias("node"), "s.doc_id", "s.x", "s.n", "s.matches", "s.weight", "s.classes", "s.bits", "s.prefix"), "nodes")
    labels = node_components(docs, nodes, percent)
    roots = nodes.select("digest", "node").join(labels, "node", "left").select("digest", F.coalesce("root", "node").alias("root"))
    own = stored(rows.select("doc_id", "n", "digest").join(roots, "digest", "left").select("doc_id", "n", "root"), "roots")
    least = own.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return own.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


JOINED_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < {K} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {K - 2}), lambda i: array_to_string(w[i:i + {K - 1}], ' '))) END) AS s
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * both_have >= {PERCENT} * (x.n + y.n - both_have)),
r AS (SELECT a AS doc_id, b AS other FROM links UNION SELECT r.doc_id, links.b FROM r JOIN links ON r.other = links.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
  least(w.doc_id, coalesce((SELECT min(other) FROM r WHERE r.doc_id = w.doc_id), w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id)
"""
