import random
import time

from ledgerlake.llm import linededup
from ledgerlake.llm import queries as Q
from oracle_check import compare, duck
from planutil import PYTHON_NODES, plan_text


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(rows):
    """Dropped line numbers per row, for distinct (id, text)."""
    lines, seen = [], set()
    for d, t in rows:
        if (d, t) not in seen:
            seen.add((d, t))
            lines += [(d, i, line) for i, line in enumerate((t or "").split("\n") if t is not None else []) if line.strip(" \t\r\f")]
    lines.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    first, dropped = {}, {}
    for d, i, line in lines:
        copy = line in first or (len(line) >= linededup.MIN_CHARS and any(
            len(o) >= linededup.MIN_CHARS and within_one(line, o) for o in first))
        first.setdefault(line, (d, i))
        if copy:
            dropped.setdefault(d, []).append(i)
    return dropped


def check(rows, out):
    want = brute(rows)
    assert len(out) == len(rows)
    for r in out:
        assert r["dropped"] == ",".join(map(str, want.get(r["doc_id"], []))), r


def test_against_brute_force(make_docs):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdé ñ") for _ in range(n)) + "z" for n in (5, 19, 20, 21, 22, 40, 41, 120, 700)]

    def edit(s):
        i = rng.randrange(len(s))
        return rng.choice([s, s[:i] + s[i + 1:], s[:i] + rng.choice("xyñ") + s[i + 1:], s[:i] + "q" + s[i:]])

    rows = [(d, "\n".join(edit(edit(rng.choice(base))) if rng.random() < 0.8 else "  " for _ in range(rng.randrange(1, 6)))) for d in range(120)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (None, "a line without any id at all"), (203, "a line without any id at all"),
             (204, "x" * 5000), (205, "x" * 4999), (206, "twice twice twice twice\n" * 3), (207, rows[0][1]), (207, rows[0][1])]
    check(rows, linededup.line_report(make_docs(rows, ["i", "x", "kept"])).collect())


def test_long_lines_in_linear_time(make_docs):
    """Two lines of 400,000 characters that differ in one, and pairs of every kind of edit at many lengths."""
    rng = random.Random(8)
    long = "".join(rng.choice("abcdefgh ") for _ in range(400_000))
    rows = [(1, long), (2, long[:250_000] + "X" + long[250_001:]), (3, long[:99] + long[100:]), (4, long[::-1])]
    start = time.time()
    out = {r["doc_id"]: r["n_kept"] for r in linededup.line_report(make_docs(rows)).collect()}
    assert out == {1: 1, 2: 0, 3: 0, 4: 1}
    assert time.time() - start < 60
    rows = []
    for n in [*range(250, 300, 7), 511, 512, 513, 1025, 4099]:
        line = "".join(rng.choice("abcdefgh ") for _ in range(n)) + "."
        i = rng.randrange(n)
        for other in (line[:i] + "X" + line[i + 1:], line[:i] + line[i + 1:], line[:i] + "Y" + line[i:], line[:i] + "ZZ" + line[i:], line[:-1], "W" + line):
            rows += [(len(rows), line), (len(rows) + 1, other)]
    check(rows, linededup.line_report(make_docs(rows)).collect())


def test_query_matches_sql(spark, sf):
    ok, msg = compare(spark, "op9", Q.op9_line_dedup, Q.ORACLE["op9_line_dedup"], sf, duck(sf))
    assert ok, msg


def test_documents_without_dropped_lines(make_docs):
    rows = [(1, "a first line of some length\nkeep this"), (2, "a first line of some lengths\nand another"), (3, "keep this\n"), (4, ""), (5, None)]
    out = {r["doc_id"]: r for r in linededup.dedup_lines(make_docs(rows, ["kept"])).collect()}
    assert out[1]["text"] == rows[0][1] and out[2]["text"] == "and another" and out[2]["n_chars"] == 11
    assert 3 not in out and out[4]["text"] == "" and out[5]["text"] is None


def test_empty_table_and_no_python(make_docs, spark, sf):
    assert linededup.line_report(make_docs([])).count() == 0
    plan = plan_text(linededup.line_report(spark.read.parquet(f"{sf}/documents.parquet")))
    assert not any(n in plan for n in PYTHON_NODES)
