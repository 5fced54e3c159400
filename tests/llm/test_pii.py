import hashlib
import re

from ledgerlake.llm import pii
from planutil import PYTHON_NODES, plan_text

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
ODD = ["a@b.c@d.ef x_y@z.co.uk. _@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 000255.0.0.1 1.2.3", None, "",
       "4041894974608795 4041 8949 7460 8795 4041-8949-7460-8795 4041--8949", "+1 (988) 555-2485 4041894974608795 +49.30.1234567 +1",
       "é12 ab@c.d 😀 a@b.cd 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", ". ".join(["a.b@c.d"] * 50),
       "9" * 5000 + " " + "1 " * 5000 + "a." * 3000 + "@" + "b." * 3000, "x@y@z.a.b..c a@b.c_x@d.e", " 12 ab@c.d"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            s, d = m.group(), re.sub("[^0-9]", "", m.group())
            if kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in s.split("."))) or (
                    kind == "card" and 14 <= len(d) <= 19 and luhn(d)) or (kind == "phone" and 10 <= len(d) <= 15):
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


def check(rows, texts):
    for r in rows:
        want = brute(texts[r["doc_id"]])
        joined = ",".join(f"{kind}:{a}:{e}" for a, _, e, kind in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (texts[r["doc_id"]] or "")[:200]
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(w[3] == k for w in want) for k in PATTERNS]
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))


def test_base_spans_of_odd_texts(make_docs):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id a@b.cd"), (1, ODD[1])]
    out = pii.extract(make_docs(rows, ["x", "base", "tokens"])).collect()
    assert len(out) == len(rows)
    check(out, dict(rows))


def test_base_spans_of_a_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(pii.extract(docs).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})


def test_contexts_find_unseen_identifiers(make_docs):
    seeds = [(i, f"we wrote please reach me at user{i}@mail.example today") for i in range(30)]
    new = [(100 + i, f"please reach me at user{i}(at)mail-example today") for i in range(3)]
    other = [(200 + i, f"the total was then {i}{i}{i}17 apples in all") for i in range(30)]
    rows = {r["doc_id"]: r["spans"] for r in pii.extract(make_docs(seeds + new + other)).collect()}
    text = dict(new)[100]
    start = text.index("user0")
    assert rows[100] == f"email:{start}:{start + len('user0(at)mail-example')}"
    assert all(rows[d] == "" for d, _ in other) and all(rows[d].count("email") == 1 for d, _ in seeds)


def test_contexts_of_phones_and_spaced_cards(make_docs):
    def card(i):
        d = f"4041 8949 74{i // 100:02d} 87{i % 100:02d}"[:-1]
        return next(d + str(c) for c in range(10) if luhn(re.sub(" ", "", d + str(c))))
    seeds = [(i, f"we wrote please call me on +1 (974) 555-{i:04d}. today") for i in range(30)]
    seeds += [(50 + i, f"it said charge my card {card(i * 10)} right now") for i in range(30)]
    new = {100: ("phone", "(974) 555 7000", "we wrote please call me on {} today"), 101: ("phone", "974 555 7001", "please call me on {}, today"),
           102: ("phone", "974-555-7002", "please call me on {} today"),
           103: ("card", "4041 8949 7460 8796", "it said charge my card {} right now")}  # no Luhn number: no base span
    other = [(200 + i, f"the total was then {i:02d}17 50021 88 apples in all") for i in range(30)]
    out = pii.extract(make_docs(seeds + [(d, t.format(v)) for d, (_, v, t) in new.items()] + other)).collect()
    rows = {r["doc_id"]: r["spans"] for r in out}
    for d, (kind, v, t) in new.items():
        start = t.index("{}")
        assert rows[d] == f"{kind}:{start}:{start + len(v)}", (d, rows[d])
    assert all(rows[d] == "" for d, _ in other)
    assert all(rows[d].count(":") == 2 for d, _ in seeds)


def test_empty_table(make_docs):
    assert pii.extract(make_docs([])).count() == 0


def test_no_python(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert not any(n in plan_text(pii.found_in(docs)) for n in PYTHON_NODES)
    assert not any(n in plan_text(pii.extract(docs)) for n in PYTHON_NODES)
