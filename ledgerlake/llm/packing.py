"""Best-fit packing by a grouping genetic algorithm.

Documents become pieces of at most ``CAPACITY`` tokens.  Pieces are dealt by a
hash of their place into groups of about ``GROUP`` (so that no task grows with
the corpus and equal rows spread), and ``ISLANDS`` populations work on each
group.  An individual assigns pieces to bins.  A child takes whole well-filled
bins of one parent, drops the other parent's bins that hold a piece twice, and
puts the displaced pieces where they fit best.  A mutant empties some of its
bins, the badly filled ones likelier, and its pieces change places with those
of bins that they fill better (Martello and Toth's dominance, by one or two
for one).  After each round every island receives the best individual of its
neighbour; Spark moves the populations.  A group is done when it meets a proven
lower bound of bins (no packing has fewer), or when ``PATIENCE`` rounds with
migration between them have found no better packing on any of its islands.

Null texts are empty (the end id alone).  Repeated rows are pieces of their
own.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import batches, small_batches, stored
from ledgerlake.llm.tokens import TEXTS, encoder

CAPACITY = 4096
END_ID = 1
GROUP = 4096
ISLANDS = 3
PATIENCE = 2       # rounds without a gain on any island of a group
POPULATION = 12
CHILDREN = 48      # of a round
SWAPS = 12         # bins a mutant tries, and pieces of a bin that it pairs
PIECES = pa.schema([("place", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int64()), ("ids_crc32", pa.int64())])
PIECES_DDL = "place bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, vocabulary: Callable[[], str] | str, capacity: int = CAPACITY,
           end_id: int = END_ID) -> DataFrame:
    """One row for each piece of each document; ``place`` tells rows apart."""
    small_batches(docs.sparkSession, TEXTS)
    end = np.array([end_id], "<u4")

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocabulary() if callable(vocabulary) else vocabulary, True)
        place = TaskContext.get().partitionId() << 40

        def rows() -> Iterator[dict]:
            nonlocal place
            for b in it:
                for doc_id, ids in zip(b.column(0).to_pylist(), e.encode(b.column(1))):
                    ids = np.concatenate([ids.astype("<u4"), end])
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        own = ids[at:at + capacity]
                        yield {"place": place, "doc_id": doc_id, "piece": k, "start": at, "length": len(own),
                               "ids_crc32": zlib.crc32(own.tobytes())}
                        place += 1

        yield from batches(rows(), PIECES)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES_DDL)


class Bins:
    """Bins by free room, for best fit."""

    def __init__(self, size: np.ndarray, capacity: int):
        self.size, self.capacity = size, capacity

    def fit(self, bin_of: np.ndarray, loose: np.ndarray) -> np.ndarray:
        """Puts the ``loose`` pieces, in their order, into the fullest bin that
        has room, else into a new one; numbers the bins from 0 without gaps."""
        kept = bin_of >= 0
        numbers, bin_of_kept = np.unique(bin_of[kept], return_inverse=True)
        bin_of[kept] = bin_of_kept
        filled = np.bincount(bin_of_kept, self.size[kept], minlength=len(numbers)).astype(np.int64)
        room = sorted((int(self.capacity - f), b) for b, f in enumerate(filled))
        n = len(numbers)
        sizes = self.size
        for i in loose.tolist():
            s = int(sizes[i])
            at = bisect_left(room, (s, -1))
            if at < len(room):
                free, b = room.pop(at)
            else:
                free, b, n = self.capacity, n, n + 1
            bin_of[i] = b
            if free > s:
                insort(room, (free - s, b))
        return bin_of

    def fill(self, bin_of: np.ndarray) -> np.ndarray:
        return np.bincount(bin_of, self.size, minlength=int(bin_of.max(initial=-1)) + 1)

    def score(self, bin_of: np.ndarray) -> tuple[int, float]:
        """Lower is better: bins used, then how uneven they are filled."""
        fill = self.fill(bin_of) / self.capacity
        return len(fill), -float((fill ** 2).sum())

    def child(self, mother: np.ndarray, father: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        fill = self.fill(father)
        chosen = np.flatnonzero((fill >= np.quantile(fill, 0.5)) & (rng.random(len(fill)) < 0.5))
        injected = np.isin(father, chosen)
        spoiled = np.isin(mother, mother[injected])
        child = np.where(injected, father + len(self.size), np.where(spoiled, -1, mother))
        loose = np.flatnonzero(child < 0)
        return self.fit(child, loose[np.argsort(-self.size[loose], kind="stable")])

    def mutant(self, parent: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Empties a few bins and puts their pieces back by replacement: a loose piece takes the place of one or two
        smaller ones in a bin that it fills better; what is left over then goes by best fit."""
        bin_of = parent.copy()
        fill = self.fill(bin_of)
        free = self.capacity - fill
        if len(fill) < 2:
            return bin_of
        weight = free + 1 + rng.random(len(fill)) * self.capacity / 8
        gone = rng.choice(len(fill), min(len(fill), 2 + int(rng.integers(0, 3))), replace=False, p=weight / weight.sum())
        bin_of[np.isin(bin_of, gone)] = -1
        loose = sorted(np.flatnonzero(bin_of < 0).tolist(), key=lambda i: -self.size[i])
        others = rng.permutation(np.setdiff1d(np.arange(len(fill)), gone))[:SWAPS]
        for b in others.tolist():
            own = np.flatnonzero(bin_of == b)
            room = int(free[b])
            best, trade = 0, None
            outs = [(int(self.size[i]), (i,)) for i in own] + [
                (int(self.size[i] + self.size[j]), (i, j)) for k, i in enumerate(own[:SWAPS]) for j in own[k + 1:SWAPS]]
            ins = [(int(self.size[i]), (i,)) for i in loose[:SWAPS]] + [
                (int(self.size[i] + self.size[j]), (i, j)) for k, i in enumerate(loose[:SWAPS]) for j in loose[k + 1:SWAPS]]
            for a, take in ins:
                for c, give in outs:
                    # fewer pieces of the same total come loose: large ones go in, small ones fit elsewhere
                    if best < a - c <= room:
                        best, trade = a - c, (take, give)
            if trade:
                take, give = trade
                bin_of[list(take)], bin_of[list(give)] = b, -1
                loose = sorted([i for i in loose if i not in take] + [int(i) for i in give], key=lambda i: -self.size[i])
        return self.fit(bin_of, np.array(loose, np.int64))

    def least(self) -> int:
        """No packing has fewer bins: pieces over ``capacity - k`` share with none of ``k`` or more, those over half
        with no other of their kind, and the rest of the pieces of ``k`` or more need room (Martello and Toth's L2)."""
        size = np.sort(self.size)
        total = np.r_[0, np.cumsum(size)]
        half = np.searchsorted(size, self.capacity / 2, "right")
        n = -(-int(total[-1]) // self.capacity)
        for k in np.unique(size[:half]).tolist():
            low, high = np.searchsorted(size, k), np.searchsorted(size, self.capacity - k, "right")
            over, mid = len(size) - high, high - half
            rest = int(total[half] - total[low]) - (mid * self.capacity - int(total[high] - total[half]))
            n = max(n, over + mid + max(0, -(-rest // self.capacity)))
        return max(n, len(size) - half)

    def start(self, rng: np.random.Generator, noise: float) -> np.ndarray:
        order = np.argsort(-self.size * (1 + noise * rng.random(len(self.size))), kind="stable")
        return self.fit(np.full(len(self.size), -1, np.int64), order)


def evolve(states: DataFrame, round_no: int, capacity: int) -> DataFrame:
    """One round on every island: row in, row out, with its best individual."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = {k: [] for k in STATE.names}
            for r in b.to_pylist():
                size = np.array(r["sizes"], np.int64)
                bins, rng = Bins(size, capacity), np.random.default_rng([r["group"], r["island"], round_no])
                least = bins.least()
                if r["people"]:
                    people = list(np.frombuffer(r["people"], "<i4").reshape(-1, len(size)).astype(np.int64))
                    people.append(np.frombuffer(r["guest"], "<i4").astype(np.int64))
                else:
                    people = [bins.start(rng, 0.3 * r["island"])]
                    if bins.score(people[0])[0] > least:
                        people += [bins.start(rng, 0.3 * r["island"] + 0.1 * k) for k in range(1, POPULATION)]
                people = sorted(people, key=bins.score)
                for _ in range(CHILDREN):
                    if bins.score(people[0])[0] <= least:
                        break
                    a, f = rng.choice(len(people), 2, replace=False)
                    people.append(bins.mutant(bins.child(people[a], people[f], rng), rng))
                    people = sorted(people, key=bins.score)[:POPULATION]
                people = people[:POPULATION]
                n, spread = bins.score(people[0])
                for k, v in zip(out, (r["group"], r["island"], r["places"], r["sizes"], np.stack(people).astype("<i4").tobytes(),
                                      people[0].astype("<i4").tobytes(), n, spread, least)):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=STATE)

    return states.mapInArrow(run, STATE_DDL)


STATE = pa.schema([("group", pa.int64()), ("island", pa.int32()), ("places", pa.list_(pa.int64())),
                   ("sizes", pa.list_(pa.int64())), ("people", pa.binary()), ("best", pa.binary()), ("bins", pa.int64()),
                   ("spread", pa.float64()), ("least", pa.int64())])
STATE_DDL = ("group bigint, island int, places array<bigint>, sizes array<bigint>, people binary, best binary, "
             "bins bigint, spread double, least bigint")


def pack(rows: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset to rows that hold place and length."""
    rows = stored(rows, "pieces")
    spark = rows.sparkSession
    small_batches(spark, 8)
    loose = rows.filter(F.col("length") < capacity)
    groups = max(1, -(-loose.count() // group))
    key = F.pmod(F.xxhash64("place"), F.lit(groups))
    held = (loose.groupBy(key.alias("group")).agg(F.sort_array(F.collect_list(F.struct("place", "length"))).alias("own"))
            .select("group", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
                    F.col("own.place").alias("places"), F.col("own.length").alias("sizes"),
                    F.lit(None).cast("binary").alias("people"), F.lit(None).cast("binary").alias("guest"))
            .repartition(min(groups * ISLANDS, 8 * spark.sparkContext.defaultParallelism), "group", "island"))
    r, before, done = 0, None, []
    while True:
        states = stored(evolve(held, r, capacity), f"islands-{r}")
        now = states.groupBy("group").agg(F.min("bins").alias("now"), F.max("least").alias("least"))
        if before is not None:
            now = now.join(before.drop("least"), "group")
        idle = F.lit(0) if before is None else F.when(F.col("now") < F.col("bins"), 0).otherwise(F.col("idle") + 1)
        before = stored(now.select("group", F.col("now").alias("bins"), idle.alias("idle"), "least"), f"gains-{r}")
        ended = (F.col("bins") <= F.col("least")) | (F.col("idle") >= PATIENCE)
        done.append(states.join(before.filter(ended).select("group"), "group", "left_semi"))
        going = states.join(before.filter(~ended).select("group"), "group", "left_semi")
        if going.isEmpty():
            break
        guests = going.select("group", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("best").alias("guest"))
        held = going.drop("best", "bins", "spread", "least").join(guests, ["group", "island"])
        r += 1
    best = reduce(DataFrame.unionByName, done).groupBy("group").agg(
        F.min_by(F.struct("places", "sizes", "best"), F.struct("bins", "spread", "island")).alias("s")).select("group", "s.*")
    placed = best.mapInArrow(placements, "place bigint, sequence_id bigint, offset bigint")
    whole = rows.filter(F.col("length") >= capacity).select(
        "place", (-F.col("place") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return rows.join(placed.unionByName(whole), "place")


def placements(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        for r in b.to_pylist():
            size, bin_of = np.array(r["sizes"], np.int64), np.frombuffer(r["best"], "<i4").astype(np.int64)
            order = np.argsort(bin_of, kind="stable")
            ahead = np.cumsum(size[order]) - size[order]
            first = np.r_[True, np.diff(bin_of[order]) != 0] if len(order) else np.zeros(0, bool)
            offset = ahead - np.maximum.accumulate(np.where(first, ahead, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(r["places"], np.int64)[order]), pa.array((r["group"] << 32) + bin_of[order]), pa.array(offset)],
                names=["place", "sequence_id", "offset"])
