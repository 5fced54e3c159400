"""Personal data by bootstrapped contexts, in DataFrame operations only.

Base entities (email, ip, card, phone) are found by their patterns, leftmost
and without overlap, and checked afterwards; they are the seeds, each the whole
span, blanks included.  Outside them, every identifier-like token (one with a
digit or an @, and 5 characters) and every run of such tokens, of any length,
with the digits of a phone or a card is a candidate.  Seeds and candidates have
lexical patterns: the two words before, and the word before with the word after.
Patterns and tokens form a graph.  In each round a pattern of a kind scores the
share of its distinct tokens that are believed to be of that kind, patterns of
enough support and score are kept, and a token is believed by the chance that
not all patterns it occurs in are wrong.  Tokens over ``TOKEN_SCORE`` are spans
of that kind wherever they occur outside base spans; of those that overlap, the
better one.

Null texts are empty; a text without a match has the hash of the empty string.
Rows equal in id and text share a result; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SUPPORT = 3
PATTERN_SCORE = 0.6
TOKEN_SCORE = 0.7

# Private characters that stand for a separator between digits and a dot
# between letters; a text's own ones become a third that no pattern knows.
SEP, DOT, OTHER = "\ue000", "\ue001", "\ue002"
DOMAIN = r"A-Za-z0-9\-"
LOCAL = rf"A-Za-z0-9._%+\-{DOT}"
# A run that fails from its start fails from every later place, so matches start
# where a run does or where the last match ended; runs are possessive.
EMAIL = rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[{DOMAIN}]++{DOT}[{DOMAIN}{DOT}]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = rf"[0-9][0-9{SEP}]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# In the masked text, a base span; or a blank-delimited token without one.
HEAD, TAIL = "\ue003", "\ue004"
ELEMENT = rf"{HEAD}{TAIL}*+|(?<!\S)[^\s0-9@{HEAD}{TAIL}]*+[0-9@][^\s{HEAD}{TAIL}]*+(?!\S)"
LEAST_DIGITS, MOST_DIGITS = 10, 19
EDGE = r"^[^\p{L}\p{N}@+]+|[^\p{L}\p{N}]+$"
SPANS = "array<struct<start:int,end:int,found:string>>"


def matches(text: Column, pattern: str) -> Column:
    """start, end (code points, end exclusive) and text of all matches in order."""
    between = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zero = F.struct(F.lit(0).alias("at"), F.expr("array()").cast(SPANS).alias("out"))

    def add(state: Column, m: Column) -> Column:
        start = (state["at"] + m["before"]).cast("int")
        end = (start + F.length(m["found"])).cast("int")
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), m["found"].alias("found")))).alias("out"))

    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, m: F.struct(b.alias("before"), m.alias("found")))
    return F.aggregate(pairs, zero, add)["out"]


def none() -> Column:
    return F.expr("array()").cast(SPANS)


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(s: Column) -> Column:
    """From the right, every second digit counts double, less 9 if over 9."""
    each = F.transform(F.split(F.reverse(s), ""), lambda c, i: F.when(c == "", 0).otherwise(
        F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def is_ip(s: Column) -> Column:
    def small(part: Column) -> Column:
        own = F.regexp_replace(part, "^0+", "")
        return (F.length(own) < 3) | ((F.length(own) == 3) & (own <= "255"))
    return F.forall(F.split(s, r"\."), small)


def base_spans(text: Column) -> dict[str, Column]:
    """The base entities of each kind; texts without a sign of it cost no matching."""
    dotted = F.regexp_replace(F.translate(text, DOT, OTHER), rf"(?<=[{DOMAIN}])\.(?=[{DOMAIN}])", DOT)
    joined = F.regexp_replace(F.translate(text, SEP, OTHER), r"(?<=[0-9])[\x20-](?=[0-9])", SEP)
    n = lambda m: F.length(digits(m["found"]))
    digit = text.rlike("[0-9]")
    return {
        "email": F.when(text.contains("@"), matches(dotted, EMAIL)).otherwise(none()),
        "ip": F.when(digit, F.filter(matches(text, IP), lambda m: is_ip(m["found"]))).otherwise(none()),
        "card": F.when(digit, F.filter(matches(joined, CARD), lambda m: n(m).between(14, 19) & luhn(digits(m["found"])))).otherwise(none()),
        "phone": F.when(text.contains("+"), F.filter(matches(text, PHONE), lambda m: n(m).between(10, 15))).otherwise(none()),
    }


def units(base: Column) -> Column:
    """Of base spans that overlap, the first."""
    zero = F.struct(F.lit(0).alias("at"), F.filter(base, lambda b: F.lit(False)).alias("out"))
    return F.aggregate(base, zero, lambda state, b: F.when(b["start"] >= state["at"], F.struct(
        b["end"].alias("at"), F.concat(state["out"], F.array(b)).alias("out"))).otherwise(state))["out"]


def masked(text: Column, own: Column) -> Column:
    """The text with its units as one HEAD and, for the rest of their length, TAIL."""
    end = lambda i: F.coalesce(F.try_element_at(own, i)["end"], F.lit(0))
    plain = F.translate(text, HEAD + TAIL, OTHER * 2)
    pieces = F.transform(own, lambda u, i: F.concat(
        F.substring(plain, F.when(i > 0, end(F.greatest(i, F.lit(1)))).otherwise(0) + 1, u["start"] - F.when(i > 0, end(F.greatest(i, F.lit(1)))).otherwise(0)),
        F.lit(HEAD), F.repeat(F.lit(TAIL), u["end"] - u["start"] - 1)))
    rest = F.substring(plain, F.when(F.size(own) > 0, end(F.greatest(F.size(own), F.lit(1)))).otherwise(0) + 1, F.length(plain))
    return F.when(F.size(own) > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(plain)


def elements(text: Column, own: Column, mask: Column) -> Column:
    """The units, whole, and the identifier-like tokens outside them, in order:
    place without outer signs, kind (of units), words around, number of digits,
    and whether only blanks and signs stand between it and the one before."""
    between, found = F.split(mask, ELEMENT, -1), matches(mask, ELEMENT)

    def words(s: Column) -> Column:
        return F.filter(F.split(F.lower(s), r"\s+"), lambda w: w != "")

    def element(m: Column, i: Column) -> Column:
        before, unit = F.element_at(between, i + 1), m["found"].startswith(HEAD)
        # signs at a token's edge are part of it; those beside a unit are no words either
        near = F.regexp_replace(F.substring(before, F.greatest(F.length(before) - 63, F.lit(1)), F.lit(64)), r"[^\p{L}\p{N}\s]+$", "")
        left = words(F.concat(F.when(i == 0, "^ ^ ").otherwise("<id> <id> "), near))
        after = words(F.concat(F.regexp_replace(F.substring(F.element_at(between, i + 2), F.lit(1), F.lit(64)), r"^[^\p{L}\p{N}\s]+", ""), F.lit(" $")))
        bare = F.when(unit, m["found"]).otherwise(F.regexp_replace(m["found"], EDGE, ""))
        lead = F.when(unit, 0).otherwise(F.length(F.regexp_extract(m["found"], r"^[^\p{L}\p{N}@+]*", 0)))
        start = (m["start"] + lead).cast("int")
        end = (start + F.length(bare)).cast("int")
        kind = F.try_element_at(F.filter(own, lambda b: unit & (b["start"] == m["start"]))["kind"], F.lit(1))
        return F.struct(
            start.alias("start"), end.alias("end"),
            F.lower(F.when(unit, F.substring(text, start + 1, end - start)).otherwise(bare)).alias("token"), kind.alias("kind"),
            F.element_at(left, -2).alias("last2"), F.element_at(left, -1).alias("last"), F.element_at(after, 1).alias("next"),
            F.length(digits(bare)).alias("n"), (~unit & (i > 0) & before.rlike(r"^[\x20().-]+$")).alias("joined"),
            m["found"].rlike(r"^[^\p{L}\p{N}@+(]*\([0-9]+\)").alias("bracket"))

    return F.transform(found, element)


def occurrences(text: Column, found: Column) -> Column:
    """Candidates with their patterns: the elements, and the runs of tokens with
    as many digits as a phone or a card.  ``head`` is the longest run that starts
    where the candidate does."""
    def candidate(first: Column, last: Column, token: Column, head: Column, start: Column) -> Column:
        return F.struct(
            start.alias("start"), last["end"].alias("end"), token.alias("token"), first["kind"].alias("kind"), head.alias("head"),
            F.array(F.concat(F.lit("2 "), first["last2"], F.lit(" "), first["last"]),
                    F.concat(F.lit("1 "), first["last"], F.lit(" _ "), last["next"])).alias("patterns"))

    def runs(e: Column, i: Column) -> Column:
        """Ends (places in ``found``, from 1) of the runs of two tokens and more."""
        ends = F.sequence(i + 2, F.least(i + MOST_DIGITS, F.size(found)))
        def fits(j: Column) -> Column:
            part = F.slice(found, i + 1, j - i)
            n = F.aggregate(part, F.lit(0), lambda a, x: a + x["n"])
            return n.between(LEAST_DIGITS, MOST_DIGITS) & F.forall(F.slice(found, i + 2, j - i - 1), lambda x: x["joined"] & x["kind"].isNull())
        more = F.try_element_at(found, i + 2)
        return F.when(e["kind"].isNull() & (i + 2 <= F.size(found)) & F.coalesce(more["joined"], F.lit(False)), F.filter(ends, fits)).otherwise(
            F.expr("array()").cast("array<int>"))

    def own(e: Column, i: Column) -> Column:
        start = (e["start"] - F.when(e["bracket"], 1).otherwise(0)).cast("int")
        of = lambda j: F.lower(F.substring(text, start + 1, F.element_at(found, j)["end"] - start))
        ends = runs(e, i)
        head = F.when(F.size(ends) > 0, of(F.coalesce(F.array_max(ends), F.lit(1)))).otherwise(e["token"])
        one = F.filter(F.array(candidate(e, e, e["token"], head, e["start"])), lambda c: c["kind"].isNotNull() | (F.length(c["token"]) >= 5))
        return F.concat(one, F.transform(ends, lambda j: candidate(e, F.element_at(found, j), of(j), head, start)))

    return F.when(text.rlike("[0-9@]"), F.flatten(F.transform(found, own)))


def found_in(docs: DataFrame) -> DataFrame:
    """doc_id, x (text hash), base (spans with kind) and tokens of every row."""
    text = F.coalesce("text", F.lit(""))
    kinds = base_spans(text)
    rows = docs.select("doc_id", F.xxhash64("text").alias("x"), text.alias("text"), *(c.alias(k) for k, c in kinds.items()))
    base = F.concat(*(F.expr(f"transform({k}, m -> struct(m.start, {i} as k, m.end, '{k}' as kind))") for i, k in enumerate(KINDS)))
    rows = rows.select("doc_id", "x", "text", *(F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS), F.array_sort(base).alias("base"))
    counts = [f"n_{k}" for k in KINDS]
    rows = rows.select("doc_id", "x", "text", *counts, "base", units(F.col("base")).alias("units"))
    rows = rows.select("doc_id", "x", "text", *counts, "base", "units", masked(F.col("text"), F.col("units")).alias("mask"))
    rows = rows.select("doc_id", "x", "text", *counts, "base", elements(F.col("text"), F.col("units"), F.col("mask")).alias("elements"))
    return rows.select("doc_id", "x", *counts, "base", occurrences(F.col("text"), F.col("elements")).alias("tokens"))


def believed(tokens: DataFrame) -> DataFrame:
    """token, kind and score s of what the contexts tell, seeds left out;
    ``tokens``: token, kind (or null), head, patterns.  Of the candidates that
    start at one place a pattern counts the best."""
    heads = stored(tokens.select("token", "head", F.explode("patterns").alias("pattern")).distinct(), "edges")
    edges = heads.select("token", "pattern").distinct()
    seeds = stored(tokens.filter("kind is not null").select("token", "kind").distinct(), "seeds")
    sizes = stored(heads.select("pattern", "head").distinct().groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
                   .filter(F.col("n") >= SUPPORT), "patterns")
    belief = seeds.withColumn("s", F.lit(1.0))
    for _ in range(ROUNDS):
        trusted = (heads.join(belief, "token").groupBy("pattern", "kind", "head").agg(F.max("s").alias("s")).groupBy("pattern", "kind")
                   .agg(F.sum("s").alias("s"), F.count(F.lit(1)).alias("support")).filter(F.col("support") >= SUPPORT)
                   .join(sizes, "pattern").select("pattern", "kind", (F.col("s") / (F.col("n") + 1)).alias("p"))
                   .filter(F.col("p") >= PATTERN_SCORE))
        scored = (edges.join(trusted, "pattern").groupBy("token", "kind")
                  .agg((1 - F.exp(F.sum(F.log(1 - F.col("p"))))).alias("s")).filter(F.col("s") >= TOKEN_SCORE))
        new = stored(scored.join(seeds.select("token"), "token", "left_anti"), "believed")
        belief = seeds.withColumn("s", F.lit(1.0)).unionByName(new)
    return new.groupBy("token").agg(F.max_by("kind", F.struct("s", "kind")).alias("kind"), F.max("s").alias("s"))


def best(spans: Column) -> Column:
    """From left to right, of spans that overlap the one of the better score, then the longer one."""
    def add(out: Column, m: Column) -> Column:
        last = F.try_element_at(out, F.lit(-1))
        rank = lambda x: F.struct(x["s"], x["end"] - x["start"])
        return (F.when(last.isNull() | (last["end"] <= m["start"]), F.concat(out, F.array(m)))
                .when(rank(m) > rank(last), F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(m))).otherwise(out))

    kept = F.aggregate(F.array_sort(spans), F.filter(spans, lambda m: F.lit(False)), add)
    return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), m["k"].alias("k"), m["end"].alias("end"), m["kind"].alias("kind")))


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def extract(docs: DataFrame) -> DataFrame:
    """Counts of base entities, base_sha256 and all spans of every document."""
    rows = stored(found_in(docs), "found")
    tokens = rows.select("doc_id", "x", F.explode("tokens").alias("t")).select("doc_id", "x", "t.*")
    new = believed(tokens.select("token", "kind", "head", "patterns"))
    order = F.create_map(*(v for i, k in enumerate(KINDS) for v in (F.lit(k), F.lit(i))))
    more = (tokens.filter("kind is null").select("doc_id", "x", "token", "start", "end").join(new, "token")
            .groupBy("doc_id", "x").agg(best(F.collect_set(F.struct("start", order[F.col("kind")].alias("k"), "end", "kind", "s"))).alias("more")))
    r, m = rows.alias("r"), more.alias("m")
    out = r.join(m, F.expr("r.doc_id <=> m.doc_id and r.x = m.x"), "left")
    spans = F.array_sort(F.concat("r.base", F.coalesce("m.more", F.expr("filter(r.base, b -> false)"))))
    return out.select("r.doc_id", *(f"r.n_{k}" for k in KINDS), F.sha2(joined_spans(F.col("r.base")).cast("binary"), 256).alias("base_sha256"),
                      joined_spans(spans).alias("spans"))
