"""What similarity joins share: keys that several nodes have, pairs of nodes
from different components, and components.

A join has members: rows of node, n (the size of its set), meets (how many others
the node meets, or the like), pos (the key's place in the node's order) and run
(the key).  Nodes may be of any type that sorts.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.bitmaps import bitmap, known
from ledgerlake.llm.common import small_batches, stored

ODD = np.uint64(0x9E3779B97F4A7C15)
# Nodes of a run that one task compares with the rest of them.
PART = 256
# Nodes of a run that are put in order of their sizes, at most.
ORDERED = 1024
CLASS_BITS = 7
CLASSES = 1 << CLASS_BITS
# Bits of a set's parities, and the sets whose parities are made at once.
PARITY_BITS = 10
PARITY_SETS = 256
CHUNK = 1 << 14


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shared(n, m, percent: int):
    """The least number of runs that linked sets of n and m share."""
    return (percent * (n + m) + 99 + percent) // (100 + percent)


def reach(n, percent: int):
    """How many runs a set of n may lack of what a partner needs, at most: n less the least they share."""
    return n - shared(n, (percent * n + 99) // 100, percent)


def totals(rows: DataFrame, hashes: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], counters: int) -> np.ndarray:
    """How many of the hashes that are made from all rows fall into each of ``counters`` classes."""
    size = min(CHUNK, counters)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros(counters, np.int64), TaskContext.get().partitionId()
        for h in hashes(it):
            total += np.bincount((h & np.uint64(counters - 1)).astype(np.int64), minlength=counters)
        for c in range(0, counters, size):
            yield row(c // size, part % 16, total[c:c + size])

    def row(chunk: int, part: int, own: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"chunk": [chunk], "part": [part], "counts": [zlib.compress(own.tobytes(), 1)]}, schema=schema)

    def add(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for b in it:
            for r in b.to_pylist():
                own = total.setdefault((r["chunk"], r["part"]), np.zeros(size, np.int64))
                own += np.frombuffer(zlib.decompress(r["counts"]), np.int64)
        for (chunk, part), own in total.items():
            yield row(chunk, part, own)

    schema = pa.schema([("chunk", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])
    ddl = "chunk int, part int, counts binary"
    # the tasks' counters are added up in two steps; ``counters`` numbers in all reach the driver
    some = rows.mapInArrow(count, ddl).repartition("chunk", "part").mapInArrow(add, ddl)
    found = some.withColumn("part", F.lit(0)).repartition("chunk").mapInArrow(add, ddl).collect()
    total = np.zeros(counters, np.int64)
    for r in found:
        total[r["chunk"] * size:(r["chunk"] + 1) * size] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
    return total


def class_counts(h: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """How many runs of each set fall into each of ``CLASSES`` classes of hashes.  The sum over the classes of the
    smaller counts of two sets is never less than what they share."""
    n = len(bounds) - 1
    of = np.repeat(np.arange(n), np.diff(bounds))
    counts = np.bincount(of * CLASSES + (h >> np.uint64(64 - CLASS_BITS)).astype(np.int64), minlength=n * CLASSES).reshape(n, CLASSES)
    return [c.astype("<u2" if c.max() < 1 << 16 else "<u4").tobytes() for c in counts]


def parities(h: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    """Whether each of ``1 << PARITY_BITS`` classes of hashes holds an odd number of each set's runs, 64 classes to a
    number.  Two sets differ in at least as many runs as in parities."""
    size, found = 1 << PARITY_BITS, []
    for at in range(0, len(bounds) - 1, PARITY_SETS):
        own = bounds[at:at + PARITY_SETS + 1]
        of = np.repeat(np.arange(len(own) - 1), np.diff(own))
        cell = of * size + (h[own[0]:own[-1]] >> np.uint64(64 - PARITY_BITS)).astype(np.int64)
        found.append(np.packbits((np.bincount(cell, minlength=(len(own) - 1) * size) & 1).astype(np.uint8)).view(np.int64))
    words = size // 64
    return pa.ListArray.from_arrays(pa.array(np.arange(len(bounds)) * words, pa.int32()), pa.array(np.concatenate(found or [np.zeros(0, np.int64)])))


def counts_of(classes: bytes) -> np.ndarray:
    return np.frombuffer(classes, "<u2" if len(classes) == 2 * CLASSES else "<u4").astype(np.int64)


def least_shared(n: str, m: str, percent: int) -> Column:
    """``shared`` of two columns."""
    return F.expr(f"({percent} * ({n} + {m}) + {99 + percent}) div {100 + percent}")


def same_run(x: str, y: str, percent: int) -> Column:
    """Whether a run at ``pos`` of both sides counts for a pair: sizes within reach, places within the pair's prefixes.
    Of all runs that a linked pair shares, the first one does."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    slack = F.lit(1) - least_shared(f"{x}.n", f"{y}.n", percent)
    return ((F.lit(percent) * n <= 100 * m) & (F.lit(percent) * m <= 100 * n)
            & (F.col(f"{x}.pos") < n + slack) & (F.col(f"{y}.pos") < m + slack))


def may_link(x: str, y: str, percent: int) -> Column:
    """Whether the parities of both sides differ in no more places than linked sets of their sizes differ in runs: true
    of every linked pair."""
    differ = " + ".join(f"bit_count({x}.bits[{i}] ^ {y}.bits[{i}])" for i in range((1 << PARITY_BITS) // 64))
    return F.expr(differ) <= F.col(f"{x}.n") + F.col(f"{y}.n") - 2 * least_shared(f"{x}.n", f"{y}.n", percent)


def labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("comp", F.col("node"))
    return members.join(labels, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")


def with_links(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """node and root of all nodes in a component of two or more, after more ``links``."""
    if labels is None:
        return stored(components(links), "labels")
    root = lambda c: links.join(labels.withColumnsRenamed({"node": c, "root": f"root_{c}"}), c, "left")
    ends = root("a").join(labels.withColumnsRenamed({"node": "b", "root": "root_b"}), "b", "left")
    moved = components(ends.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).filter("a <> b"))
    moved = stored(moved.select(F.col("node").alias("root"), F.col("root").alias("to")), "moved")
    old = labels.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    alone = moved.join(labels.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("to").alias("root"))
    return stored(old.unionByName(alone), "labels")


def open_runs(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The members of runs that more than one component share, with ``major``: whether it is of the run's largest one
    (of two or more), and ``outside``: how many of the run's ``nodes`` are not."""
    own = labelled(members, labels)
    sizes = own.groupBy("run", "comp").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("run").agg(F.max(F.struct("size", "comp")).alias("largest"), F.count(F.lit(1)).alias("comps"),
                                       F.sum("size").alias("nodes")).filter("comps > 1")
    own = own.join(largest, "run").withColumn("major", (F.col("comp") == F.col("largest.comp")) & (F.col("largest.size") > 1))
    own = own.withColumn("outside", F.when(F.col("largest.size") > 1, F.col("nodes") - F.col("largest.size")).otherwise(F.col("nodes")))
    return stored(own.drop("largest", "comps"), "open-runs")


def star_pairs(own: DataFrame, centres: int, percent: int) -> DataFrame:
    """The nodes of each run that lie outside its largest component against some of them, and against some of the
    largest component's: those that meet most."""
    outside = own.filter(~F.col("major"))
    if centres == 1:
        best = own.groupBy("run", "major").agg(F.max(F.struct("meets", "node", "n", "pos", "comp")).alias("c")).select("run", "c.*")
    else:
        rank = F.row_number().over(Window.partitionBy("run", "major").orderBy(F.desc("meets"), F.desc("node")))
        best = own.withColumn("rank", rank).filter(F.col("rank") <= centres)
    best = best.select("run", "node", "n", "pos", "comp")
    c, o = best.alias("c"), outside.alias("o")
    met = o.join(c, "run").filter((F.col("c.comp") != F.col("o.comp")) & same_run("c", "o", percent))
    # a centre is met in many of a node's runs
    return met.select(F.least("c.node", "o.node").alias("a"), F.greatest("c.node", "o.node").alias("b")).distinct()


def all_pairs(own: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a run of their prefixes and may link by their parities (``bits`` of
    ``nodes``): the many near misses of a large group never become rows.  A run with many nodes outside its largest component is dealt to many tasks."""
    own = own.join(nodes.select("node", "bits"), "node")
    parts = F.greatest(F.lit(1), F.ceil(F.col("outside") / PART)).cast("int")
    left = own.filter(~F.col("major")).withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int")).alias("l")
    right = own.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).alias("r")
    once = F.col("r.major") | (F.col("l.node") < F.col("r.node"))
    met = left.join(right, F.expr("l.run = r.run and l.part = r.part")).filter(
        (F.col("l.comp") != F.col("r.comp")) & once & same_run("l", "r", percent) & may_link("l", "r", percent))
    return met.select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")).distinct()


def type_of(nodes: DataFrame) -> str:
    return nodes.schema["node"].dataType.simpleString()


def members_of(nodes: DataFrame, percent: int) -> DataFrame:
    """node, n, meets, pos and run of the runs that other nodes have too (a few that none has come along), among those
    of each prefix that a pair may share first; ``meets`` is the node's ``weight``.  See ``partnered``."""
    small_batches(nodes.sparkSession, 1024)
    length = F.col("n") + 1 - least_shared("n", f"(({percent} * n + 99) div 100)", percent)
    own = nodes.select(F.explode(F.slice("prefix", F.lit(1), length.cast("int"))).alias("run"), "n")
    sizes = own.groupBy("run").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("least"), F.max("n").alias("most"))
    # two alone must be of sizes that may link
    useful = sizes.filter((F.col("size") > 2) | ((F.col("size") == 2) & (F.lit(100) * F.col("least") >= F.lit(percent) * F.col("most"))))
    useful = stored(useful.select(F.col("run").alias("seed"), "size"), "shared-runs")
    spark = nodes.sparkSession
    shared_runs = spark.sparkContext.broadcast(bitmap(useful))
    many_nodes = spark.sparkContext.broadcast(bitmap(useful.filter(F.col("size") > ORDERED)))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, many = (np.frombuffer(x.value, np.uint8) for x in (shared_runs, many_nodes))
        for b in it:
            prefix = b.column("prefix")
            own = prefix.values.to_numpy()[prefix.offsets[0].as_py():prefix.offsets[-1].as_py()]
            length = np.diff(prefix.offsets.to_numpy())
            of = np.repeat(np.arange(b.num_rows), length)
            pos = np.arange(len(own)) - np.repeat(np.cumsum(length) - length, length)
            at = np.flatnonzero(known(bits, own.view(np.uint64)) & (pos <= reach(b.column("n").to_numpy(), percent)[of]))
            yield pa.RecordBatch.from_arrays(
                [b.column(c).take(pa.array(of[at])) for c in ("node", "n", "weight")]
                + [pa.array(pos[at], pa.int32()), pa.array(own[at]), pa.array(known(many, own[at].view(np.uint64)))],
                names=["node", "n", "meets", "pos", "run", "many"])

    found = nodes.select("node", "n", "weight", "prefix").mapInArrow(
        run, f"node {type_of(nodes)}, n bigint, meets bigint, pos int, run bigint, many boolean")
    return partnered(found, percent)


def partnered(members: DataFrame, percent: int) -> DataFrame:
    """The members whose run another node shares that may count for a pair with them (see ``same_run``), as far as the
    sizes next to theirs tell: no pair goes.  A run of very many nodes (``many``) is left as it is, each of its members alone in its
    window, so that no task has all of them."""
    # of the larger nodes the next one leaves a member the longest prefix; of the smaller ones the next one is the nearest in size
    own = Window.partitionBy("run", F.when(F.col("many"), F.col("node")))
    by_size = own.orderBy("n", "node")
    larger, smaller = F.lead("n").over(by_size), F.lag("n").over(by_size)
    rows = members.select("*", larger.alias("larger"), smaller.alias("smaller"))
    may = (((F.lit(percent) * F.col("larger") <= 100 * F.col("n")) & (F.col("pos") < F.col("n") + 1 - least_shared("n", "larger", percent)))
           | (F.lit(percent) * F.col("n") <= 100 * F.col("smaller")))
    rows = rows.filter(F.col("many") | F.coalesce(may, F.lit(False)))
    alone = F.count(F.lit(1)).over(own) == 1
    return rows.withColumn("alone", alone).filter(F.col("many") | ~F.col("alone")).select("node", "n", "meets", "pos", "run")


def able(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs that may share enough runs, by the class counts of their sets (``classes``): no pair that links goes."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = counts_of(x), counts_of(y)
                ok.append(np.minimum(x, y).sum() >= shared(x.sum(), y.sum(), percent))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    of = lambda c: nodes.select(F.col("node").alias(c), F.col("classes").alias(f"classes_{c}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "classes_a", "classes_b").mapInArrow(
        run, f"a {type_of(nodes)}, b {type_of(nodes)}")


def components(edges: DataFrame) -> DataFrame:
    """node and root (the least node of its component) of every linked node."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "both-ways")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("n")).agg(F.min("root").alias("m"))
        step = labels.join(near, F.col("node") == F.col("n")).select("node", "root", F.least("root", "m").alias("low"))
        up = labels.select(F.col("node").alias("n"), F.col("root").alias("m"))
        step = stored(step.join(up, F.col("low") == F.col("n")).select("node", F.least("low", "m").alias("new"), "root"), "labels")
        labels = step.select("node", F.col("new").alias("root"))
        if not step.filter("new <> root").head(1):
            return labels
