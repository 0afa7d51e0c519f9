"""Quality rules, language ID and URL verdicts."""

import collections
import random
import zlib

import corpora
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import language_id, quality, url_filter
from corpusprep.llm.queries import RULES, table

SF = "/root/testdata/sf0.01"


def counts(text):
    text = text or ""
    words = text.encode().split()
    seen, lines = set(), 0
    for line in text.split("\n"):
        lines += line in seen and bool(line.encode().split())
        seen.add(line)
    runs = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if runs[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), lines, len(hit), failed)


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts(spark):
    docs = corpora.hard(spark)
    labels = spark.createDataFrame([(7, None, 0), (None, 1, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.judge(docs, labels).collect()
    want = [(str(r["doc_id"]), *counts(r["text"])) for r in docs.collect()]
    assert sorted((str(r["doc_id"]), *(r[n] for n in NAMES)) for r in got) == sorted(want)
    # Nothing was learned, so the rule alone decides.
    assert all(r["kept"] == (not r["base_failed"]) for r in got)
    assert quality.judge(corpora.empty(spark), labels.limit(0)).collect() == []


def test_quality_is_learned(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    judged = quality.judge(docs, labels.filter(~held)).join(labels.filter(held), "doc_id")
    rows = judged.filter("NOT base_failed").select(labels.quality, "kept").collect()
    good = [r["kept"] for r in rows if r[0] == 1]
    bad = [r["kept"] for r in rows if r[0] == 0]
    assert sum(good) / len(good) > 0.95
    assert sum(bad) / max(1, len(bad)) < 0.5


def test_platt_follows_frequencies():
    import numpy as np

    rng = np.random.default_rng(0)
    margin = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * margin + 1)))).astype(float)
    a, c = quality.platt(margin, y, np.ones(4000))
    assert abs(a - 2) < 0.3 and abs(c - 1) < 0.3


def test_language_held_out(spark):
    docs = table(spark, SF, "documents")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r["lang_pred"] == r["lang"] for r in got if r["held_out"]]
    assert len(held) > 100 and sum(held) / len(held) > 0.97
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_cases(spark):
    got = {str(r["doc_id"]): r for r in language_id.identify(corpora.hard(spark)).collect()}
    for i in (0, 1, 2, 3, 17):
        assert (got[str(i)]["lang_pred"], got[str(i)]["score"]) == ("und", 0.0)
    assert got["7"]["lang_pred"] in ("en", "fr") and not got["None"]["held_out"]
    # Languages of several families, one of them with three members; one language; none.
    words = {"en": "the house is with them that", "de": "das haus ist mit ihnen doch", "nl": "het huis zijn met hen toch",
             "fr": "la maison est avec eux que", "ja": "日本 語 です この 文 は"}
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(w.split(), k=30)), k) for i, (k, w) in enumerate(list(words.items()) * 30)]
    some = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    pred = language_id.identify(some).collect()
    by_id = {i: k for i, _, k in rows}
    assert sum(r["lang_pred"] == by_id[r["doc_id"]] for r in pred) > 0.9 * len(pred)
    one = language_id.identify(some.filter("lang = 'fr'")).collect()
    assert {r["lang_pred"] for r in one} == {"fr"}
    none = language_id.identify(some.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert language_id.identify(corpora.empty(spark)).collect() == []


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.org", "https://example.org/es/x", "http://a.example.org/en/1",
    "http://a.example.org/en/2", "http://notexample.org/es/", "http://x.com/fr/1?q=://y.org/", "http://X.COM/de/",
    "http://x.com/en/", "ftp://x.net#/fr/", "http://x.com?u=/fr/", "http://org/", "http://org", "a://b://c.org/es/",
    "http://ÄB.org/", "http://example.org/ES/", "http://u@example.org:80/es/", "http://example.org/es/", "http://x.com/fr/1",
]


def plain(url):
    url = url or ""
    if "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    stop = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:stop])
    tail = rest[stop:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


@pytest.mark.parametrize("rows", [20_000, 0])
def test_urls(spark, rows):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string").withColumn("host", F.lit("x"))
    for r in url_filter.judge_urls(pages, RULES, train_rows=rows).collect():
        host, path, rule, verdict = plain(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    assert url_filter.judge_urls(pages.limit(0), RULES).collect() == []


def test_urls_follow_their_labels(spark):
    rules = (url_filter.Rule("block", "bad.example/"), url_filter.Rule("allow", "good.example/"))
    rows = [(i, f"http://bad.example/{i}/{i}/{i}/{i}?a={i}&b={i}&c={i}") for i in range(60)]
    rows += [(100 + i, f"https://good.example/page{i}") for i in range(60)]
    rows += [(200, "http://new.example/1/2/3/4?a=1&b=2&c=3"), (201, "https://new.example/page")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(pages, rules).collect()}
    assert (got[200], got[201]) == ("block", "allow")
    only = url_filter.judge_urls(pages, rules[:1]).filter("page_id = 201").first()
    assert only["verdict"] == "block"
