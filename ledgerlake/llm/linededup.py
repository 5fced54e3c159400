"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

A line is dropped when an earlier line, by (doc_id, line number), equals it or
lies within one edit (one character put in, taken out or replaced).

Two lines within one edit share a deletion variant: the line itself, or the
line without one character.  Emitting all of them for every line would be one
row per character of the corpus, so the edit is first narrowed down: cut the
longer line's length in two, and at least one half is the same in both lines.
Halves are hashed, lines whose half nobody shares are done, and the others are
halved again; only the last remainder's variants are emitted.  A variant's key
holds all that lies outside the remainder, the length class, and for equal
lengths the place of the deletion, so equal keys mean one edit; a comparison
of the remainders confirms it.  No step pairs the members of a group: each
asks for its group's earliest line.

Null texts have no lines.  White space lines are neither dropped nor counted
as copies.  Lines under ``MIN_CHARS`` characters are compared for equality
alone.  Null ids sort first; rows equal in id and text are one document and
share a result; rows with one id and other texts order by the text's hash.  An
empty table gives no rows.  Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import stored

MIN_CHARS = 20
# A remainder is halved so often at once, and further while it has more characters than this.
HALVINGS, REST = 3, 16
SALT = 7
LONGER, SHORTER = 0, 1


def has_text(line: Column) -> Column:
    return line.rlike(r"[^ \t\r\n\f]")


def numbered(docs: DataFrame) -> DataFrame:
    """Rows doc_id, x (the text's hash), i (from 0) and line."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("x"), F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    return lines.filter(has_text(F.col("line")))


def half_sizes(n: Column, role: int) -> tuple[Column, Column]:
    """Characters of the first and second half, by the longer line's length."""
    longer = n + role
    first = F.floor(longer / 2).cast("int")
    return first, (longer - first).cast("int")


def left(s: Column, n: Column) -> Column:
    return F.substring(s, F.lit(1), n)


def right(s: Column, n: Column) -> Column:
    """The last n characters."""
    return F.substring(s, F.length(s) - n + 1, n)


def halves(key: Column, rest: Column, role: int) -> list[Column]:
    """The two ways to narrow an edit in ``rest`` down: each holds one half in
    its key and leaves the other to search."""
    first, second = half_sizes(F.length(rest), role)
    n = F.length(rest)
    return [F.struct(F.xxhash64(key, F.lit(1), left(rest, first)).alias("key"),
                     F.substring(rest, first + 1, F.greatest(n - first, F.lit(0))).alias("rest")),
            F.struct(F.xxhash64(key, F.lit(2), right(rest, second)).alias("key"),
                     left(rest, F.greatest(n - second, F.lit(0))).alias("rest"))]


def halver(role: int) -> Callable[[Column], Column]:
    return lambda s: F.array(*halves(s["key"], s["rest"], role))


def shared(rows: DataFrame, key: str, member: list[str]) -> DataFrame:
    """The rows whose key belongs to more than one member."""
    ends = rows.groupBy(key).agg(*(f(F.xxhash64(*member)).alias(n) for f, n in ((F.min, "lo"), (F.max, "hi"))))
    return rows.join(ends.filter("lo < hi").select(key), key, "left_semi")


def near_lines(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """doc_id, x, i of the first occurrences that have an earlier line within one edit."""
    keyed = firsts.filter(F.col("n") >= MIN_CHARS).select(
        "doc_id", "x", "i", F.posexplode(F.array("k0", "k1", "k2", "k3")).alias("which", "key"))
    again = shared(keyed, "key", ["doc_id", "x", "i"]).groupBy("doc_id", "x", "i").agg(
        F.bit_or(F.expr("shiftleft(1, which)")).alias("mask"))
    a, b = numbered(docs).alias("a"), again.alias("b")
    texts = a.join(b, F.expr("a.doc_id <=> b.doc_id and a.x = b.x and a.i = b.i")).select(
        F.struct("a.doc_id", "a.x", "a.i").alias("at"), "a.line", "b.mask")
    rests = []
    for role in (LONGER, SHORTER):
        start = halves(class_key(F.length("line"), role), F.col("line"), role)
        own = F.array(*(F.when(F.col("mask").bitwiseAND(1 << (2 * role + side)) != 0, start[side]) for side in (0, 1)))
        own = F.filter(own, lambda s: s.isNotNull())
        for _ in range(HALVINGS):
            own = F.flatten(F.transform(own, halver(role)))
        rests.append(texts.select("at", F.lit(role).alias("role"), F.inline(own)))
    rests = stored(rests[0].unionByName(rests[1]), "rests")
    return earlier(narrowed(stored(shared(rests, "key", ["at"]), "shared-rests")))


def too_long(s: Column, role: int | Column) -> Column:
    """Whether the longer line's remainder has more than ``REST`` characters."""
    return F.length(s) + role > REST


def narrowed(rests: DataFrame) -> DataFrame:
    """The remainders of long lines halved further, while a partner is left, until they have ``REST`` characters."""
    left_over = lambda df: df.filter(too_long(F.col("rest"), F.col("role")))
    done = [rests.filter(~too_long(F.col("rest"), F.col("role")))]
    while not left_over(rests).isEmpty():
        halved = []
        for role in (LONGER, SHORTER):
            own = F.array(F.struct("key", "rest"))
            for _ in range(HALVINGS):
                halve = halver(role)
                own = F.flatten(F.transform(own, lambda s: F.when(too_long(s["rest"], role), halve(s)).otherwise(F.array(s))))
            halved.append(left_over(rests).filter(F.col("role") == role).select("at", "role", F.inline(own)))
        rests = stored(shared(halved[0].unionByName(halved[1]), "key", ["at"]), "halved-rests")
        done.append(rests.filter(~too_long(F.col("rest"), F.col("role"))))
    return reduce(DataFrame.unionByName, done)


def earlier(rests: DataFrame) -> DataFrame:
    """Emits the deletion variants and asks each group for its earliest line."""
    longer, shorter = rests.filter(F.col("role") == LONGER), rests.filter(F.col("role") == SHORTER)
    cut = longer.filter(F.length("rest") > 0).select("at", "key", "rest", F.explode(F.sequence(F.lit(1), F.length("rest"))).alias("p"))
    without = F.concat(left(F.col("rest"), F.col("p") - 1), F.substring(F.col("rest"), F.col("p") + 1, F.length("rest")))
    # lines of one length: both without the character at the same place
    same = cut.select("at", "rest", F.lit(LONGER).alias("role"), F.lit(LONGER).alias("other"),
                      F.xxhash64("key", F.lit(3), "p", without).alias("variant"))
    # lengths that differ by one: the longer without a character, the shorter whole
    apart = cut.select("at", "rest", F.lit(LONGER).alias("role"), F.lit(SHORTER).alias("other"),
                       F.xxhash64("key", F.lit(4), without).alias("variant"))
    whole = shorter.select("at", "rest", F.lit(SHORTER).alias("role"), F.lit(LONGER).alias("other"),
                           F.xxhash64("key", F.lit(4), "rest").alias("variant"))
    variants = same.unionByName(apart).unionByName(whole)
    of_role = lambda r: F.min(F.when(F.col("role") == r, F.struct("at", "rest")))
    groups = variants.groupBy("variant").agg(
        of_role(LONGER).alias("m0"), of_role(SHORTER).alias("m1"), F.min(F.xxhash64("at")).alias("lo"),
        F.max(F.xxhash64("at")).alias("hi")).filter("lo < hi").drop("lo", "hi")
    found = variants.join(groups, "variant")
    partner = F.when(F.col("other") == LONGER, F.col("m0")).otherwise(F.col("m1"))
    found = found.withColumn("partner", partner).filter(F.col("partner.at") < F.col("at"))
    found = found.filter(F.levenshtein("rest", "partner.rest", 1).between(0, 1))
    return found.select("at").distinct().select("at.*")


def class_key(n: Column, role: int) -> Column:
    return F.xxhash64(F.lit(0), (n + role).cast("int"))


def kept_lines(docs: DataFrame) -> DataFrame:
    """doc_id, x and the numbers of the lines that are kept, ascending."""
    rows = numbered(docs)
    n = F.length("line")
    keys = [s["key"] for role in (LONGER, SHORTER) for s in halves(class_key(n, role), F.col("line"), role)]
    firsts = (rows.select("doc_id", "x", "i", n.alias("n"), F.xxhash64("line").alias("a"),
                          F.xxhash64(F.lit(SALT), "line").alias("b"), *(k.alias(f"k{j}") for j, k in enumerate(keys)))
              .groupBy("a", "b").agg(F.min(F.struct("doc_id", "x", "i")).alias("at"),
                                     *(F.min(c).alias(c) for c in ("n", "k0", "k1", "k2", "k3")))
              .select("at.*", "n", "k0", "k1", "k2", "k3"))
    firsts = stored(firsts, "lines")
    f, g = firsts.alias("f"), near_lines(docs, firsts).alias("g")
    kept = f.join(g, F.expr("f.doc_id <=> g.doc_id and f.x = g.x and f.i = g.i"), "left_anti")
    return kept.groupBy("doc_id", "x").agg(F.sort_array(F.collect_list("i")).alias("kept"))


def with_kept(docs: DataFrame) -> DataFrame:
    """docs with ``_lines`` (all lines) and ``_kept`` (numbers of kept ones)."""
    d = docs.withColumn("_x", F.xxhash64("text")).alias("d")
    k = kept_lines(docs).alias("k")
    return (d.join(k, F.expr("d.doc_id <=> k.doc_id and d._x = k.x"), "left")
            .select("d.*", F.coalesce("k.kept", F.expr("array()").cast("array<int>")).alias("_kept")).drop("_x"))


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (with text), n_kept and the dropped lines' numbers (comma-joined) of every document."""
    own = F.filter(F.transform(F.split("text", "\n", -1), lambda l, i: F.when(has_text(l), i)), lambda i: i.isNotNull())
    own = F.coalesce(own, F.expr("array()").cast("array<int>"))
    narrow = docs.select("doc_id", "text")
    d = narrow.select("doc_id", F.xxhash64("text").alias("x"), own.alias("own")).alias("d")
    k = kept_lines(narrow).alias("k")
    rows = d.join(k, F.expr("d.doc_id <=> k.doc_id and d.x = k.x"), "left")
    kept = F.coalesce("k.kept", F.expr("array()").cast("array<int>"))
    dropped = F.array_except("d.own", kept)
    return rows.select("d.doc_id", F.size("d.own").alias("n_lines"), F.size(kept).alias("n_kept"),
                       F.array_join(dropped.cast("array<string>"), ",").alias("dropped"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents without their dropped lines; n_chars follows the text.  A
    document that had lines and loses all of them goes."""
    rows = with_kept(docs)
    lines = F.split("text", "\n", -1)
    text = F.array_join(F.filter(lines, lambda l, i: ~has_text(l) | F.array_contains("_kept", i)), "\n")
    gone = has_text(F.coalesce("text", F.lit(""))) & (F.size("_kept") == 0)
    rows = rows.filter(~gone).withColumn("text", text).drop("_kept")
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


# The same rows from SQL: first occurrences, then earlier ones within one edit.
LINE_REPORT_SQL = r"""
WITH lines AS (
  SELECT doc_id, i - 1 AS i, l FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents)
  WHERE regexp_matches(l, '[^ \t\r\n\f]')),
firsts AS (
  SELECT l, length(l) AS n, min((doc_id, i)) AS at FROM lines GROUP BY l),
near AS (
  SELECT DISTINCT b.l FROM firsts a JOIN firsts b
  ON b.n BETWEEN a.n - 1 AND a.n + 1 AND a.at < b.at AND a.n >= 20 AND b.n >= 20
     AND (left(a.l, (greatest(a.n, b.n) // 2)::INT) = left(b.l, (greatest(a.n, b.n) // 2)::INT)
          OR right(a.l, (greatest(a.n, b.n) - greatest(a.n, b.n) // 2)::INT) = right(b.l, (greatest(a.n, b.n) - greatest(a.n, b.n) // 2)::INT))
  WHERE CASE
    WHEN a.n = b.n THEN len(list_filter(list_zip(string_split(a.l, ''), string_split(b.l, '')), lambda p: p[1] <> p[2])) = 1
    WHEN a.n > b.n THEN len(list_filter(range(1, a.n + 1), lambda p: left(a.l, (p - 1)::INT) || substr(a.l, (p + 1)::INT) = b.l)) > 0
    ELSE len(list_filter(range(1, b.n + 1), lambda p: left(b.l, (p - 1)::INT) || substr(b.l, (p + 1)::INT) = a.l)) > 0 END),
marked AS (
  SELECT lines.*, (lines.doc_id, lines.i) = firsts.at AND lines.l NOT IN (SELECT l FROM near) AS kept
  FROM lines JOIN firsts USING (l))
SELECT d.doc_id, count(m.i)::INT AS n_lines, count(m.i) FILTER (m.kept)::INT AS n_kept,
       coalesce(string_agg(m.i::VARCHAR, ',' ORDER BY m.i) FILTER (NOT m.kept), '') AS dropped
FROM documents d LEFT JOIN marked m USING (doc_id) GROUP BY d.doc_id
"""
