"""Personal data: rule spans against Python's regular expressions, added spans by held-out cases."""

import hashlib
import random
import re

import corpora
from pyspark.sql import functions as F

from corpusprep.llm import pii_spans
from corpusprep.llm.pii_spans import KINDS
from corpusprep.llm.queries import QUERIES

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def passes(kind, match):
    number = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(number) <= 19 and luhn(number)
    return kind == "email" or 9 <= len(number) <= 15


def brute(text):
    found = [(m.start(), k, m.end()) for k, kind in enumerate(KINDS)
             for m in BASE[kind].finditer(text or "") if passes(kind, m[0])]
    return sorted(found)


def shown(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def docs_of(spark, texts):
    return corpora.table(spark, texts).withColumns({c: F.lit(1) for c in ("t", "left", "spans", "kinds", "email_m")})


def base_of(spark, texts):
    rows = pii_spans.candidates(docs_of(spark, texts), "doc_id", "text").collect()
    found = {r["doc"]: [(s["start"], s["k"], s["end"]) for s in r["spans"] if s["rule"]] for r in rows}
    return [found[i] for i in range(len(texts))]


CASES = [
    None, "", "a@b.c_d@e.f", "a@b", "a@b.c.", "@b.c", "x..y@-.-", "é.ü@b.c", "a@b.c@d.e", "a@b.c,d@e.f;g@h.i-",
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 01.002.0003.255", "1.2.3", "1.2.3.4567", "1..2.3.4.5", "9999999999.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "4111  1111111111 11", "0 0 0 0 0 0 0 0 0 0 0 0",
    "12345678901234567890", "4111111111111111-", "\U0001f600 4111111111111111é", "+1 (974) 555-3436", "+1 555", "++49 30 123456 7",
    "+49(30)12345678901234567", "+1 (974) 555-3436+1 (974) 555-3436", "+1-------------974.555.3436)", "tel +4111111111111111 or a@1.2.3.4",
    "1.2.3.4@5.6.7.8", "+11.22.33.44", "a\n+1 974\n555", "４１１１ ٣٤٥٦",
]


def test_rules_on_cases(spark):
    assert base_of(spark, CASES) == [brute(t) for t in CASES]


def test_rules_on_random_texts(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("11234567890.-@+ ()ab é\U0001f600") for _ in range(rng.randrange(120))) for _ in range(400)]
    texts += ["".join(rng.choice("0123456789 -") for _ in range(rng.randrange(300))) for _ in range(200)]
    got, want = base_of(spark, texts), [brute(t) for t in texts]
    assert got == want and sum(map(len, want)) > 50


def test_many_spans_and_long_runs(spark):
    texts = ["a@b.cc " * 20_000, "x" * 300_000, "1." * 100_000, "a@" + "b." * 100_000 + "c", "9" * 300_000, "+1" * 50_000,
             "." * 200_000 + "@", "1 " * 150_000, "a at " * 50_000 + "dot", "ab:" * 60_000]
    got = base_of(spark, texts)
    assert [len(g) for g in got] == [20_000, 0, 25_000, 1, 0, 0, 0, 0, 0, 0]
    assert got[0] == [(7 * i, 0, 7 * i + 6) for i in range(20_000)]
    assert got[2] == [(8 * i, 1, 8 * i + 7) for i in range(25_000)]


def planted(n=160):
    """Texts with true and false numbers: the rules miss cards with a wrong digit and some phones."""
    rng = random.Random(8)
    texts, wanted = [], []
    for i in range(n):
        card = "4" + "".join(rng.choice("0123456789") for _ in range(15))
        phone = f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        code = "".join(rng.choice("0123456789abcdef") for _ in range(12)) + str(rng.randrange(10**14, 10**15)) + "fa9"
        kind = i % 4
        if kind == 0:
            text, span = f"please call my phone {phone} or write to a{i}@mail.example.com today", phone
        elif kind == 1:
            text, span = f"the credit card {card} was lost near 10.2.3.{i % 250} +1 (301) 555-{1000 + i}", card
        elif kind == 2:
            text, span = f'commit hash token = "{code}" of version {i}', None
        else:
            text, span = "nothing to see in these plain words", None
        texts.append(text)
        wanted.append(span)
    return texts, wanted


def test_added_spans(spark):
    texts, wanted = planted()
    out = {r["doc_id"]: r for r in pii_spans.find(docs_of(spark, texts)).collect()}
    right = 0
    for i, (text, span) in enumerate(zip(texts, wanted)):
        base, every = ([tuple(s) for s in out[i][c]] for c in ("base", "spans"))
        assert base == brute(text) and [s for s in every if s in base] == base and every == sorted(every)
        added = [text[a:b] for a, _, b in every if (a, _, b) not in base]
        if span is None:
            assert added == []
        else:
            right += span in added or any(text[a:b] == span for a, _, b in base)
    assert right >= 0.95 * sum(s is not None for s in wanted)


def test_reliabilities():
    """Labelers of known accuracy: expectation-maximisation tells which they are."""
    rng = random.Random(3)
    counts, truth = {}, []
    for _ in range(20_000):
        y = rng.random() < 0.4
        votes = tuple((1 if (rng.random() < a) == y else -1) if rng.random() < 0.9 else 0 for a in (0.95, 0.85, 0.8, 0.55))
        counts[0, votes] = counts.get((0, votes), 0) + 1
        truth.append((votes, y))
    posterior = pii_spans.reliabilities(counts)
    right = sum((posterior[0, v] >= 0.5) == y for v, y in truth) / len(truth)
    majority = sum((sum(v) > 0) == y for v, y in truth) / len(truth)
    assert right > 0.93 and right > majority
    assert abs(sum(n * posterior[p] for p, n in counts.items()) / 20_000 - 0.4) < 0.03


def test_running(spark):
    rows = [(i, [(7 * j) % 11 for j in range(n)]) for i, n in enumerate([0, 1, 63, 64, 65, 128, 1000])]
    got = spark.createDataFrame(rows, "i long, v array<bigint>").select("i", pii_spans.running(F.col("v")).alias("s")).collect()
    for r in got:
        v = rows[r["i"]][1]
        assert r["s"] == [sum(v[: j + 1]) for j in range(len(v))]


def test_hard_rows_and_empty(spark):
    docs = corpora.hard(spark)
    out = pii_spans.digests(pii_spans.find(docs)).collect()
    assert len(out) == docs.count()
    assert pii_spans.digests(pii_spans.find(corpora.empty(spark))).collect() == []
    none = pii_spans.digests(pii_spans.find(corpora.table(spark, [None, "", "no data"]))).collect()
    assert [(r["spans"], r["n_added"], r["n_card"]) for r in none] == [("", 0, 0)] * 3


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op12_pii_spans"](spark, sf)
    assert dict(out.dtypes) == {**{f"n_{k}": "bigint" for k in KINDS}, "doc_id": "bigint", "base_sha256": "string",
                                "spans": "string", "n_added": "bigint"}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = out.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        base = brute(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(shown(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[1] == i for s in base) for i in range(4)]
        assert set(shown(base).split(",")) <= set(r["spans"].split(",")) or not base
    assert "mapIn" not in out._jdf.queryExecution().executedPlan().toString()


