"""Phrases that hold together, by streams of counts in two orders.

Words are the lower-case (A-Z) stretches between blanks inside the pieces that
``.,;:!?`` and line ends leave; everything is per language (null: ``und``).
All phrases of up to ``WORDS`` words with at least ``LEAST`` occurrences are
counted.  Their counts are then kept as two sorted streams, in prefix order
(words from the first on) and in suffix order (from the last on).  In prefix
order a phrase's first parts stand ahead of it and its right extensions behind
it, in suffix order the same holds for its last parts and left extensions; so
one pass over each stream, all phrase lengths in lockstep, gives the counts of
all parts and the most frequent extension on either side, with a stack of
``WORDS`` entries and no lookup.  The two results, sorted into prefix order
again, merge.  Streams are cut into shards by range, wherever that falls: the
phrases that lie open at a shard's start are handed to it.

A phrase's score is its lowest over all cuts in two, floor(1000 a n / (l r));
what an extension covers equally often is dropped, whether by one word or more
(an extension by more words lies within one by one word that is as frequent).

While counting, 8 MB bitmaps of the frequent words and word pairs keep phrases
with a rare part, which cannot be frequent, out of the shuffle; a bitmap's
false hits cost only rows, counts are exact.

Null texts are empty.  Repeated rows count again.  Texts without a word,
languages without a frequent phrase and empty tables give no rows.  Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.bitmaps import bitmap, known
from ledgerlake.llm.common import blocks, broadcast_up_to, partitions, small_batches, stored
from ledgerlake.llm.spans import Texts, lower, of_bytes, runs, slices, text_of_each

WORDS = 5
LEAST = 100
FIRST = 2000
NO_LANGUAGE = "und"
PIECE_BREAKS = of_bytes(*b".,;:!?", *range(0x0A, 0x0E))
WORD_BREAKS = PIECE_BREAKS | of_bytes(0x20, 0x09)
# The word totals of so many languages are broadcast; more are joined by shuffle.
LANGUAGES = 100_000

COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])
COUNTS_DDL = "lang string, phrase string, f bigint"
SCANNED = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("f", pa.int64()), ("parts", pa.list_(pa.int64())),
                     ("most", pa.int64())])
SCANNED_DDL = "lang string, words array<string>, f bigint, parts array<bigint>, most bigint"


class Block:
    """The words of a block of texts, numbered by language and spelling."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        t = Texts.of(texts)
        data = lower(t.data)
        starts, stops = runs(WORD_BREAKS[data], t.bounds)
        of = text_of_each(starts, t.bounds)
        piece = np.cumsum(PIECE_BREAKS[data])[starts] if len(starts) else starts
        # whether a word and the next stand in one piece
        self.joined = (of[1:] == of[:-1]) & (piece[1:] == piece[:-1])
        spelled = slices(data, starts, stops)
        tongues = pc.fill_null(langs.cast(pa.string()), NO_LANGUAGE).dictionary_encode()
        n = max(1, len(spelled.dictionary))
        key = tongues.indices.to_numpy()[of].astype(np.int64) * n + spelled.indices.to_numpy()
        self.keys, self.ids, self.times = np.unique(key, return_inverse=True, return_counts=True)
        self.lang = tongues.dictionary.take(pa.array(self.keys // n))
        self.word = spelled.dictionary.take(pa.array(self.keys % n)).cast(pa.large_string())
        self.n = max(1, len(self.keys))

    def hashes(self, langs: pa.Array, phrases: pa.Array) -> np.ndarray:
        named = pc.binary_join_element_wise(langs.cast(pa.large_string()), phrases, pa.scalar("\n", pa.large_string()))
        return np.array([xxhash.xxh64_intdigest(s, 42) for s in named.cast(pa.large_binary()).to_pylist()], np.uint64)

    def longer(self, left: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The phrases at ``at`` of the shorter phrase's number ``left`` and one word more: keys, numbers, counts."""
        return np.unique(left * self.n + self.ids[at + length - 1], return_inverse=True, return_counts=True)


def spread(ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The numbers by position, -1 where there is none."""
    out = np.full(n, -1, np.int64)
    out[at] = ids
    return out


def rows_of(block: Block, lang: pa.Array, phrases: pa.Array, times: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang.cast(pa.string()), phrases.cast(pa.string()), pa.array(times, pa.int64())], schema=COUNTS)


def block_counts(block: Block, words: np.ndarray | None, pairs: np.ndarray | None, most: int) -> Iterator[pa.RecordBatch]:
    """The counts of the block's words; of its pairs, once the frequent
    ``words`` are known; of longer phrases, once the ``pairs`` are."""
    if not len(block.ids):
        return
    if words is None:
        yield rows_of(block, block.lang, block.word, block.times)
        return
    frequent = known(words, block.hashes(block.lang, block.word))[block.ids]
    at = np.flatnonzero(frequent[:-1] & frequent[1:] & block.joined)
    if not len(at):
        return
    keys, ids, times = block.longer(block.ids[at], at, 2)
    first = pa.array(keys // block.n)
    lang = block.lang.take(first)
    phrases = pc.binary_join_element_wise(block.word.take(first), block.word.take(pa.array(keys % block.n)), pa.scalar(" ", pa.large_string()))
    if pairs is None:
        yield rows_of(block, lang, phrases, times)
        return
    frequent = known(pairs, block.hashes(lang, phrases))
    ids = spread(np.where(frequent[ids], ids, -1), at, len(block.ids))
    for length in range(3, most + 1):
        at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        if not len(at):
            return
        keys, own, times = block.longer(ids[at], at, length)
        shorter = pa.array(keys // block.n)
        lang = lang.take(shorter)
        phrases = pc.binary_join_element_wise(phrases.take(shorter), block.word.take(pa.array(keys % block.n)),
                                              pa.scalar(" ", pa.large_string()))
        yield rows_of(block, lang, phrases, times)
        ids = spread(own, at, len(block.ids))


def counted(docs: DataFrame, words: bytes | None, pairs: bytes | None, most: int) -> DataFrame:
    """lang, phrase and f of one kind of phrase (see ``block_counts``), over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast((words, pairs))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [np.frombuffer(x, np.uint8) if x is not None else None for x in shared.value]
        for b in blocks(it, "text"):
            yield from block_counts(Block(b.column("text"), b.column("lang")), *maps, most)

    rows = docs.select("text", "lang").mapInArrow(run, COUNTS_DDL)
    return rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def filter_of(counts: DataFrame) -> bytes:
    return bitmap(counts.select(F.xxhash64(F.concat_ws("\n", "lang", "phrase")).alias("seed")))


def frequent_phrases(docs: DataFrame, least: int = LEAST, most: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """lang, phrase and f of all phrases of up to ``most`` words that occur
    ``least`` times; and lang and n (words in all)."""
    small_batches(docs.sparkSession, 64)
    one = stored(counted(docs, None, None, most), "words")
    total = stored(one.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    one = stored(one.filter(F.col("f") >= least), "frequent-words")
    words = filter_of(one)
    two = stored(counted(docs, words, None, most).filter(F.col("f") >= least), "frequent-pairs")
    more = stored(counted(docs, words, filter_of(two), most).filter(F.col("f") >= least), "frequent-phrases")
    return reduce(DataFrame.unionByName, (one, two, more)), total


def scan(rows: Iterator[tuple], carried: dict[int, list[tuple]]) -> Iterator[dict]:
    """One pass over sorted (shard, lang, words, f): the counts of each
    phrase's first ``parts``, and ``most``, that of its most frequent extension
    by a word.  What was ``carried`` into a shard comes out with ``most`` alone."""
    stack: list[dict] = []
    shard_now = None

    def out(item: dict) -> Iterator[dict]:
        if item["parts"] is not None or item["most"]:
            yield item

    for shard, lang, words, f in rows:
        if shard != shard_now:
            while stack:
                yield from out(stack.pop())
            shard_now = shard
            stack = [{"lang": la, "words": w, "f": n, "parts": None, "most": 0} for la, w, n in carried.get(shard, ())]
        while stack and (stack[-1]["lang"] != lang or words[:len(stack[-1]["words"])] != stack[-1]["words"]):
            yield from out(stack.pop())
        if len(stack) != len(words) - 1:
            raise ValueError(f"a part of {words} is missing from the stream")
        if stack:
            stack[-1]["most"] = max(stack[-1]["most"], f)
        stack.append({"lang": lang, "words": words, "f": f, "parts": [x["f"] for x in stack], "most": 0})
    while stack:
        yield from out(stack.pop())


def scanned(counts: DataFrame, backwards: bool) -> DataFrame:
    """``scan`` over the counts in prefix order, or in suffix order with parts counted from the last word."""
    spark = counts.sparkSession
    n = partitions(spark)
    order = F.reverse("words") if backwards else F.col("words")
    rows = counts.select("lang", order.alias("words"), "f")
    rows = stored(rows.repartitionByRange(n, "lang", "words").withColumn("shard", F.spark_partition_id()), "stream")
    # the parts of each shard's first phrase that lie in shards before it: less than WORDS rows for each shard
    heads = rows.groupBy("shard").agg(F.min(F.struct("lang", "words")).alias("h")).select("shard", "h.*")
    heads = heads.filter(F.size("words") > 1).select("shard", "lang", F.explode(
        F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda k: F.slice("words", 1, k))).alias("words"))
    carried: dict[int, list[tuple]] = {}
    for r in rows.select("lang", "words", "f").join(F.broadcast(heads), ["lang", "words"]).collect():
        carried.setdefault(r["shard"], []).append((r["lang"], list(r["words"]), r["f"]))
    for own in carried.values():
        own.sort(key=lambda x: len(x[1]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for b in it:
                yield from zip(*(c.to_pylist() for c in b.columns))

        held: list[dict] = []
        for item in scan(each(), carried):
            held.append(item if not backwards else item | {"words": item["words"][::-1]})
            if len(held) >= 4096:
                yield pa.RecordBatch.from_pylist(held, schema=SCANNED)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=SCANNED)

    dealt = rows.repartition(n, "shard").sortWithinPartitions("shard", "lang", "words")
    return dealt.select("shard", "lang", "words", "f").mapInArrow(run, SCANNED_DDL)


def best_cut(words: list[str], a: int, n: int, first: list[int], last: list[int]) -> tuple[int, int, int]:
    """score, l and r of the cut with the lowest score (ties: the smallest k)."""
    cuts = ((first[k - 1], last[len(words) - k - 1]) for k in range(1, len(words)))
    return min(((1000 * a * n // (left * right), left, right) for left, right in cuts), key=lambda c: c[0])


RESULT = pa.schema([("lang", pa.string()), ("phrase", pa.string()), *((c, pa.int64()) for c in ("a", "l", "r", "n", "score"))])


def scored(both: DataFrame) -> DataFrame:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = []
            for r in b.to_pylist():
                score, left, right = best_cut(r["words"], r["f"], r["n"], r["first"], r["last"])
                out.append({"lang": r["lang"], "phrase": " ".join(r["words"]), "a": r["f"], "l": left, "r": right, "n": r["n"], "score": score})
            yield pa.RecordBatch.from_pylist(out, schema=RESULT)

    return both.mapInArrow(run, "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")


def phrases(docs: DataFrame, least: int = LEAST, most: int = WORDS) -> DataFrame:
    """lang, phrase, a, l, r, n and score of every phrase of two words or more
    that no extension covers."""
    counts, total = frequent_phrases(docs, least, most)
    counts = counts.select("lang", F.split("phrase", " ").alias("words"), "f")
    ahead, behind = scanned(counts, False), scanned(counts, True)
    no_parts = F.lit(None).cast("array<bigint>")
    both = ahead.withColumnRenamed("parts", "first").withColumn("last", no_parts).unionByName(
        behind.withColumnRenamed("parts", "last").withColumn("first", no_parts))
    # sorted by range again, so equal phrases of the two streams meet without a hash
    both = stored(both, "both-streams").repartitionByRange(partitions(docs.sparkSession), "lang", "words").groupBy("lang", "words").agg(
        *(F.max(c).alias(c) for c in ("f", "first", "last", "most")))
    kept = both.filter((F.size("words") > 1) & (F.col("most") < F.col("f")))
    return scored(kept.join(broadcast_up_to(total, LANGUAGES), "lang"))


def ranked(docs: DataFrame, least: int = LEAST, most: int = WORDS, first: int = FIRST) -> DataFrame:
    """The ``first`` phrases of each language by score, count and spelling."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = stored(phrases(docs, least, most), "phrases").withColumn("rank", F.row_number().over(order).cast("bigint"))
    return rows.filter(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


PHRASES_SQL = f"""
WITH d AS (
  SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]'), lambda x: x <> '') AS w FROM d),
g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, w[i:i + k - 1] AS words
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, {WORDS + 1}) t(k))),
f AS (SELECT lang, phrase, any_value(k) AS k, any_value(words) AS words, count(*) AS f FROM g GROUP BY lang, phrase),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k >= 2 AND f >= {LEAST}),
kept AS (
  SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM c o WHERE o.lang = c.lang AND o.k > c.k AND 100 * o.f >= 100 * c.f
      AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (
  SELECT lang, phrase, f, array_to_string(words[1:j], ' ') AS first_part, array_to_string(words[j + 1:], ' ') AS rest, j
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept)),
s AS (
  SELECT u.lang, u.phrase, u.f AS a, x.f AS l, y.f AS r, t.n, u.j,
    (1000::HUGEINT * u.f * t.n // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts u JOIN t USING (lang) JOIN f x ON x.lang = u.lang AND x.phrase = u.first_part
  JOIN f y ON y.lang = u.lang AND y.phrase = u.rest),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS cut_no FROM s),
r AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM b WHERE cut_no = 1)
SELECT * FROM r WHERE rank <= {FIRST}
"""
