"""Repeated strings against counting every window."""

import collections
import random

import corpora
import numpy as np
import pytest

from corpusprep.llm import suffix_dedup as sd


def brute(texts, length):
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((bytes(np.frombuffer(t, np.uint8)[~gone]), len(t), int(gone.sum()), spans))
    return out


def test_suffix_order():
    rng = random.Random(4)
    for _ in range(200):
        text = bytes(rng.choice(b"ab\xff") for _ in range(rng.randint(1, 60)))
        got = sd.suffix_order(text, len(text) + 1)
        assert got == sorted(range(len(text)), key=lambda i: text[i:])
        wanted = np.array([rng.random() < 0.3 for _ in text])
        some = [i for i in sd.suffix_order(text, len(text) + 1, wanted) if wanted[i]]
        assert some == [i for i in got if wanted[i]]


def test_repeated_starts():
    rng = random.Random(5)
    for _ in range(100):
        regions = [bytes(rng.choice(b"ab") for _ in range(rng.randint(6, 20))) for _ in range(4)]
        numbers = [len(r) - 5 for r in regions]
        seen = collections.Counter(r[i:i + 6] for r, n in zip(regions, numbers) for i in range(n))
        want = [seen[r[i:i + 6]] > 1 for r, n in zip(regions, numbers) for i in range(n)]
        assert sd.repeated_starts(regions, numbers, 6).tolist() == want


def test_runs_cover_all_windows():
    rng = random.Random(6)
    for size in (24, 25, 100, 3000):
        data = np.frombuffer(bytes(rng.choice(b"abc") for _ in range(size)), np.uint8)
        first, number, offset, _, _ = sd.window_runs(data, 24, 8)
        covered = np.concatenate([np.arange(a, a + n) for a, n in zip(first, number)])
        assert covered.tolist() == list(range(size - 23))
        assert (offset >= number - 1).all() and (offset <= 16).all()


@pytest.mark.parametrize("group", [4096, 3, 1])
def test_random_corpora(spark, group):
    rng = random.Random(group)
    shared = ["".join(rng.choice("abcdé ") for _ in range(60)) for _ in range(3)]
    texts = []
    for i in range(80):
        parts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 50))) for _ in range(3)]
        if i % 2:
            s = rng.choice(shared)
            parts.insert(1, s[rng.randint(0, 20):])
        texts.append("".join(parts))
    texts += [texts[3], texts[3], "z" * 90, "yz" * 50, None, "", "short"]
    docs = corpora.table(spark, texts)
    got = sd.remove_repeats(docs, "doc_id", length=24, anchor=8, group=group).collect()
    want = brute([(t or "").encode() for t in texts], 24)
    for r in got:
        assert (bytes(r["kept"]), r["n_bytes"], r["n_removed"], r["n_spans"]) == want[r["doc_id"]], r["doc_id"]
    assert len(got) == len(texts)


def test_hard_rows(spark):
    docs = corpora.hard(spark)
    rows = docs.select("doc_id", "text").collect()
    want = brute([(r["text"] or "").encode() for r in rows], 200)
    got = sd.remove_repeats(docs, "doc_id").collect()
    pairs = sorted((str(r["doc_id"]), *w) for r, w in zip(rows, want))
    assert sorted((str(r["doc_id"]), bytes(r["kept"]), r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got) == pairs
    assert sd.remove_repeats(corpora.empty(spark), "doc_id").collect() == []


def test_long_text_is_cut_in_parts(spark, monkeypatch):
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(700))
    texts = ["".join(rng.choice("ijkl ") for _ in range(3000)) + passage, passage + "x" * 10]
    parts = list(sd.parts_of(3700, 200, 512))
    starts = [p for a, b in parts for p in range(a, b - 199)]
    assert starts == list(range(3501))
    monkeypatch.setattr(sd, "PART", 512)
    got = {r["doc_id"]: r["n_removed"] for r in sd.remove_repeats(corpora.table(spark, texts), "doc_id").collect()}
    assert got == {0: 700, 1: 700}


def test_characters_stay_whole():
    text = "aé".encode() + b"b"
    assert sd.cut(text, [(0, 1)], 2) == (b"\xa9b", 2, 1)
    assert sd.cut(text, [(0, 1)], 2, characters=True) == (b"b", 3, 1)
    assert sd.cut(text, [(2, 1)], 1, characters=True) == (b"ab", 2, 1)
