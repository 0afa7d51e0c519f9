"""HTML extraction and the class language model."""

import collections
import math
import random
import time

import corpora
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusprep.llm import brown_lm, html_extract

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="home"><nav><ul><li><a href="/a">Home</a></li><li>Plain item</li></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy this now and be glad about it for ever and ever.</div>
<div id="cookie-notice"><p>We use cookies.</p></div>
<article><h1>A &amp; B</h1><p>One <b>two</b>
  three&nbsp;four.</p><p><b>Open.<br><p>Next &lt;p&gt;</p><p>x</p><div class="share">Share this</div>
<table><tr><td>cell</td><td>other</td></tr></table><form><label>Mail</label><input><button>Go</button></form>
<aside>Beside</aside><p><a href="#">all link</a></p><section class="comments"><p>A long reader comment that says
a lot about nothing and goes on for many words.</p></section></article>
<footer>&copy; me</footer></body></html>"""


def test_page():
    assert html_extract.main_text(PAGE) == "A & B\nOne two three four.\nOpen.\nNext <p>\nx\ncell\nother\nall link"


def test_page_without_article():
    text = "many words in a row that tell a story about something long enough to be the text of a page"
    page = f"<body><ul><li><a href=1>x</a></li><li><a href=2>y</a></li></ul><div><p>{text}</p><p>{text} again</p></div><div class=footer>bye</div>"
    assert html_extract.main_text(page) == f"{text}\n{text} again"


BODY = "many words in a row that tell a story about something long enough to be the text of a page"


@pytest.mark.parametrize("page", [
    "<div class=post><p>{0}</p></div><article class='comment-body'><p>a reader says so</p></article>",
    "<div class=post><p>{0}</p></div><section class=related><article><p>another story</p></article></section>",
    "<article><div class='content has-sidebar'><p>{0}</p></div></article>",
    "<article><div class='entry content-with-header-image no-comments'><p>{0}</p></div></article>",
    "<article><p>{0}</p><p class=advert>Buy this now and be glad</p></article>",
])
def test_articles_and_marks(page):
    assert html_extract.main_text(f"<body>{page.format(BODY)}</body>") == BODY


SHORT = "Short closing words of the story."
NAV = "<nav><a href=1>Home</a><a href=2>About us</a></nav>"


@pytest.mark.parametrize("page, want", [
    ("<article><p>{0}</p><p>{1}</p></article>{2}", "{0}\n{1}"),
    ("<p>{0}</p><p>{1}</p><ul><li><a href=1>x</a></li><li><a href=2>y</a></li></ul>", "{0}\n{1}"),
    ("<article><h1>A title here</h1><p><a href=1>Jane Doe</a></p><p>{0}</p></article>", "A title here\nJane Doe\n{0}"),
    ("<article><p>{0}</p><h2>Sources</h2><ul><li><a href=1>One</a></li><li><a href=2>Two of them</a></li></ul></article>",
     "{0}\nSources\nOne\nTwo of them"),
    ("<article><div class='search-results'><p>{0}</p><p>{1}</p></div></article>", "{0}\n{1}"),
    ("<article><section id='discussion'><h2>Discussion</h2><p>{0}</p></section></article>", "Discussion\n{0}"),
    ("<article><header><h1>A title here</h1></header><p>{0}</p></article>", "A title here\n{0}"),
    ("<div class='notice'><p>We use cookies.</p><article><p>{0}</p></article>", "{0}"),
    ("<div class=form><article><p>{0}</p><p>{1}</p></article>", "{0}\n{1}"),
    ("<article><p>{0} <label>inside</label> end</p></article>", "{0} inside end"),
    ("<header><h1>Site</h1></header><article><p>{0}</p></article><footer>bye</footer>", "{0}"),
    ("<body class='search'><article><p>{0}</p></article>{2}</body>", "{0}"),
    ("<article><p>{0}</p><div class=comments><p>{0}</p><p>{0}</p><p>{0}</p></div></article>", "{0}"),
    ("<div class='cookie-notice'>We use cookies.</div>", ""),
])
def test_listed_pages(page, want):
    assert html_extract.main_text(page.format(BODY, SHORT, NAV)) == want.format(BODY, SHORT)


def test_generated_pages():
    """Pages put together from known blocks: none of the article is lost, nothing else gets in."""
    rng = random.Random(12)
    words = "the of a story about many things that went on for long until it came to its end".split()
    say = lambda a, b: " ".join(rng.choice(words) for _ in range(rng.randrange(a, b)))
    right = lost = added = 0
    for i in range(400):
        article = [say(2, 8)] + [say(3, 70) for _ in range(rng.randrange(1, 8))] + [say(2, 12)]
        inner = [f"<h1>{article[0]}</h1>"]
        for text in article[1:]:
            inner.append(rng.choice(["<p>{}</p>", "<p>{}", "<p><b>{}</b></p>", "<blockquote>{}</blockquote>", "<h2>{}</h2>",
                                     "<ul><li>{}</li></ul>", "<div>{}</div>", "<p><a href=x>{}</a></p>"]).format(text))
            if rng.random() < 0.3:
                inner.append(rng.choice([f"<div class='ad'>{say(2, 9)}</div>", f"<aside>{say(2, 20)}</aside>",
                                         f"<form><label>{say(1, 3)}</label><input><button>Go</button></form>",
                                         f"<script>{say(1, 5)}</script>"]))
        if rng.random() < 0.4:
            inner.append("<section class='comments'>" + "".join(f"<p>{say(5, 30)}</p>" for _ in range(rng.randrange(1, 4))) + "</section>")
        open_, close = rng.choice([("<article>", "</article>"), ("<main><div class='content has-sidebar'>", "</div></main>"),
                                   ("<article class='post'><section id='review-discussion'>", "</section></article>"),
                                   ("<div class='alert'><p>x</p><article>", "</article>")])
        links = lambda n: "".join(f"<li><a href={k}>{say(1, 4)}</a></li>" for k in range(n))
        page = (f"<html><head><title>t</title></head><body><nav><ul>{links(5)}</ul></nav><div id='cookie-bar'>{say(3, 12)}</div>"
                f"{open_}{''.join(inner)}{close}<div class='related'><ul>{links(4)}</ul></div><footer>{say(3, 25)}</footer></body></html>")
        got, want = collections.Counter(html_extract.main_text(page).split("\n")), collections.Counter(article)
        right += sum((got & want).values())
        lost += sum((want - got).values())
        added += sum((got - want).values())
    assert right > 2000 and lost == 0 and added == 0


def test_embedded_text_is_kept():
    take = lambda inner: html_extract.main_text(f"<article><p>{BODY} {inner} and on</p><p>{BODY}</p></article>")
    for inner in ("<math><mi>x</mi><mo>=</mo><mn>2</mn></math>", "<object data=a>x=2</object>", "<canvas>x=2</canvas>",
                  "<svg><title>Icon</title><text>x=2</text></svg>", "<math><mi>x</mi>=<mn>2</mn>", "<object>x=2",
                  "<svg aria-hidden=true><text>no</text></svg>x=2", "<video>x=2"):
        assert take(inner) == f"{BODY} x=2 and on\n{BODY}"
    assert html_extract.main_text("<ul class='menu'><li class='menu-item-has-children'>Home</li></ul>") == ""


def test_tree_learns_its_table():
    rows = np.array([line.split() for line in html_extract.LABELLED.splitlines()], dtype=float)
    tree = html_extract.train()
    for row in rows:
        node = tree
        while node.value is None:
            node = node.low if row[node.feature] <= node.limit else node.high
        assert node.value == bool(row[-1])


def test_extract(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p"), (5, "u", "<article>&#x41;&bogus; <unclosed"),
            (6, "u", "<article>" + "<p>w</p>" * 20_000), (7, "u", "<ARTICLE><P>Up</P></ARTICLE>"), (7, "u", "<script>never closed <p>x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = html_extract.extract(pages, "page_id", "url").collect()
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r["page_id"]].append(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert by_id[2] == [""] and by_id[3] == [""] and by_id[5] == ["A&bogus;"]
    assert by_id[6] == ["\n".join(["w"] * 20_000)] and sorted(by_id[7]) == ["", "Up"]
    assert html_extract.extract(pages.limit(0), "page_id").collect() == []


def hashes_of(words, n):
    return np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, n).view(np.int64)


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 4096}])
def test_base_scores(spark, sizes):
    import zlib

    docs = corpora.hard(spark)
    rows = docs.collect()
    counts = collections.Counter()
    for r in rows:
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            counts.update(tokens(r["text"]))
    total, distinct = sum(counts.values()), len(counts)
    got = brown_lm.score_documents(docs, **sizes).collect()
    shown = sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6), r["train_tokens"]) for r in got)
    assert shown == sorted((
        str(r["doc_id"]), len(tokens(r["text"])), sum(counts[t] > 0 for t in tokens(r["text"])),
        round(sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens(r["text"])), 6), total)
        for r in rows)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_small_blocks_score_alike(spark):
    docs = corpora.hard(spark)
    one, two = (
        sorted((str(r["doc_id"]), round(r["score"], 6)) for r in brown_lm.score_documents(docs, **s).collect())
        for s in ({}, {"block_bytes": 4096}))
    assert one == two


def test_probabilities_sum_to_one(spark):
    docs = corpora.table(spark, ["a b c a b", "b c a d", "a a e f", "c b a"] * 3, clash=False)
    lexicon, facts = brown_lm.train(docs.select(F.col("text").cast("binary").alias("text")), head=3, classes=2, groups=2)
    words = {int(hashes_of([bytes(r["word"])], 1)[0]): r for r in brown_lm.listed(lexicon).collect()}
    names = {int(h): w for w, h in ((w, hashes_of([w], 1)[0]) for w in (b"a", b"b", b"c", b"d", b"e", b"f", b"\n"))}
    assert set(words) <= set(names)
    # After an end token: all known words and the unseen one.
    vocabulary = [*(w for w in names.values() if w != b"\n"), b"unseen"]
    rows = spark.createDataFrame([(w.decode(),) for w in vocabulary] + [("",)], "text string")
    rows = rows.withColumn("t", F.col("text"))
    got = {r["t"]: r["score"] for r in brown_lm.score(rows, lexicon, facts, "t").collect()}
    move, end = facts["move"], int(hashes_of([b"\n"], 1)[0])
    end_class = words[end]["class"]
    total = 0.0
    for w in vocabulary:
        row = words.get(int(hashes_of([w], 1)[0]))
        code = row["class"] if row else len(facts["size"]) - 1
        closing = got[w.decode()] - (move[code, end_class] + math.log10(words[end]["n"] / facts["size"][end_class]))
        total += 10 ** closing
    total += 10 ** got[""]
    assert abs(total - 1) < 1e-6


def test_no_training_text(spark):
    docs = corpora.table(spark, ["a b", None], clash=False).withColumn("doc_id", F.lit(None).cast("long"))
    got = brown_lm.score_documents(docs).collect()
    assert all(math.isfinite(r["score"]) and r["n_known"] == 0 and r["train_tokens"] == 0 for r in got)
    assert brown_lm.score_documents(corpora.empty(spark)).collect() == []


def test_exchange_finds_classes():
    # Two kinds of words that alternate.
    m = np.zeros((8, 8))
    m[:4, 4:] = 10
    m[4:, :4] = 10
    of = brown_lm.exchange(m, 2)
    assert len(set(of[:4])) == 1 and len(set(of[4:])) == 1 and of[0] != of[4]


def test_gains_are_exact():
    # Against the likelihood of the whole table after each single move.
    rng = np.random.default_rng(3)
    words, kinds = 14, 5
    m = rng.integers(0, 30, (words, words)) * (rng.random((words, words)) < 0.4)
    m[np.arange(words), np.roll(np.arange(words), -1)] += 1
    m = m + m.T  # as often before as after
    n = m.sum(1)
    of = rng.integers(0, kinds, words)
    table = lambda o: np.eye(kinds)[o].T @ m @ np.eye(kinds)[o]
    word, code, count = [], [], []
    for w in range(words):
        others = np.arange(words) != w
        right = np.bincount(of[others], m[w, others], kinds)
        left = np.bincount(of[others], m[others, w], kinds)
        for c, v in enumerate([*right, *left, m[w, w]]):
            if v:
                word.append(w), code.append(c), count.append(v)
    got = brown_lm.gains(table(of), of, n.astype(float), np.array(word), np.array(code), np.array(count, float))
    now = brown_lm.likelihood(table(of))
    for w in range(words):
        for b in range(kinds):
            moved = of.copy()
            moved[w] = b
            assert abs(got[w, b] - got[w, of[w]] - (brown_lm.likelihood(table(moved)) - now)) < 1e-6


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 4096}])
def test_rare_words_are_exchanged(spark, sizes):
    # Rare words of two kinds with equal counts and the same word before: what follows tells them apart.
    texts = [f"the x{i} ran" for i in range(40)] * 2 + [f"the y{i} blue" for i in range(40)] * 2
    docs = corpora.table(spark, texts, clash=False).select(F.col("text").cast("binary").alias("text"))
    lexicon, _ = brown_lm.train(docs, head=3, classes=3, groups=2, **sizes)
    of = {int(hashes_of([bytes(r["word"])], 1)[0]): r["class"] for r in brown_lm.listed(lexicon).collect()}
    kind = lambda k: {of[int(h)] for h in hashes_of([f"{k}{i}".encode() for i in range(40)], 40)}
    assert len(kind("x")) == 1 and len(kind("y")) == 1 and kind("x") != kind("y")
    start, _ = brown_lm.train(docs, head=3, classes=3, groups=2, turns=0, **sizes)
    of = {int(hashes_of([bytes(r["word"])], 1)[0]): r["class"] for r in brown_lm.listed(start).collect()}
    assert kind("x") == kind("y")


def test_rows_are_added_as_fast_as_they_are_read():
    # Short runs: one sum per row, not one per entry of a row.
    rng = np.random.default_rng(5)
    at = np.sort(rng.integers(0, 4000, 16000))
    at = np.concatenate([at, np.full(300, 4000), np.full(9, 4001), [4003]])
    rows, index = rng.random((175, 175)), rng.integers(0, 175, len(at))
    first = np.flatnonzero(np.diff(at, prepend=-1))
    start = rng.random((4004, 175))

    def plain(out):
        out[at[first]] += np.add.reduceat(rows[index], first, axis=0)

    def best(fn):
        took = []
        for _ in range(5):
            out, begin = start.copy(), time.process_time()
            fn(out)
            took.append(time.process_time() - begin)
        return out, min(took)

    (want, slow), (got, fast) = best(plain), best(lambda out: brown_lm._add_rows(out, at, rows, index))
    assert np.allclose(got, want, rtol=1e-14, atol=0)
    assert fast < 0.6 * slow
    brown_lm._add_rows(got, at[:0], rows, index[:0])


def test_counts_are_summed_beyond_one_number():
    # With small counts a key and its count are sorted as one number; with these they do not fit into one.
    keys, counts = np.array([5, 3, 5, 1 << 40]), np.array([1, 2, 1 << 50, 4])
    for some in (slice(0, 2), slice(0, 4)):
        want = collections.Counter()
        for k, n in zip(keys[some].tolist(), counts[some].tolist()):
            want[k] += n
        got = brown_lm._summed(keys[some], counts[some])
        assert [*zip(*(x.tolist() for x in got))] == sorted(want.items())


def test_words_are_numbered_as_they_come():
    from corpusprep.llm import blocks

    block = blocks.Block()
    assert block.number([[b"a", b"b", b"a"], [], [b"c"]]).tolist() == [0, 1, 0, 2]
    assert block.number([[b"d", b"b"]]).tolist() == [3, 1] and list(block.index) == [b"a", b"b", b"c", b"d"]


def test_words_alike():
    rng = np.random.default_rng(7)
    words = 300
    own, n = rng.integers(0, 2, words), rng.integers(1, 3, words)
    lists = [sorted(rng.choice(4, rng.integers(0, 4), replace=False).tolist()) * (3 if rng.random() < 0.1 else 1) for _ in range(words)]
    word = np.repeat(np.arange(words), [len(x) for x in lists])
    code = np.array([c for x in lists for c in x], int)
    count = rng.integers(1, 3, len(code))
    kind, first = brown_lm._alike(own, n, word, code, count)
    facts = [(own[w], n[w], tuple(code[word == w]), tuple(count[word == w])) for w in range(words)]
    assert [facts[first[k]] for k in kind] == facts and (np.diff(first) > 0).all()
    few = [w for w in range(words) if len(lists[w]) <= brown_lm.FEW]
    assert len({facts[w] for w in few}) == len({kind[w] for w in few}) < len(few)
    many = [w for w in range(words) if len(lists[w]) > brown_lm.FEW]
    assert [first[kind[w]] for w in many] == many


@pytest.mark.parametrize("parts, buckets", [(64, 3), (2, 7)])
def test_score_against_a_plain_class_model(spark, monkeypatch, parts, buckets):
    """Classes as trained; everything else counted and added up in plain Python."""
    monkeypatch.setattr(brown_lm, "PARTS", parts)
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(rng.randrange(30))) for _ in range(60)]
    docs = corpora.table(spark, texts, clash=False)
    learn = docs.filter("doc_id < 40").select(F.col("text").cast("binary").alias("text"))
    lexicon, facts = brown_lm.train(learn, head=4, classes=3, groups=2, block_bytes=600, buckets=buckets)
    of = {bytes(r["word"]): (r["class"], r["n"]) for r in brown_lm.listed(lexicon).collect()}
    seqs = [tokens(t) for t in texts]
    counts = collections.Counter(w for s in seqs[:40] for w in s)
    assert {w: n for w, (_, n) in of.items()} == counts
    kinds = 1 + max(c for c, _ in of.values())
    table, size, once = np.zeros((kinds, kinds)), np.zeros(kinds), np.zeros(kinds)
    for s in seqs[:40]:
        for a, b in zip([s[-1], *s], s):
            table[of[a][0], of[b][0]] += 1
    for c, n in of.values():
        size[c] += n
        once[c] += n == 1
    share = size / size.sum()
    move = (table + brown_lm.PRIOR * share) / (table.sum(1)[:, None] + brown_lm.PRIOR)
    after_unseen = once @ move / once.sum() if once.sum() else share
    lent = brown_lm.UNSEEN * once / size

    def plain(s):
        total = 0.0
        for a, b in zip([s[-1], *s], s):
            row = move[of[a][0]] if a in of else after_unseen
            if b in of:
                c, n = of[b]
                total += math.log10(row[c]) + math.log10((0.5 if n == 1 else 1.0) * n / size[c])
            else:
                total += math.log10(row @ lent)
        return total

    got = {r["doc_id"]: r["score"] for r in brown_lm.score(docs, lexicon, facts, "doc_id", block_bytes=500).collect()}
    if once.sum():
        for i, s in enumerate(seqs):
            assert abs(got[i] - plain(s)) < 1e-9


def test_exchange_does_not_depend_on_blocks(spark):
    texts = [f"the x{i} ran" for i in range(40)] * 2 + [f"the y{i} blue" for i in range(40)] * 2
    docs = corpora.table(spark, texts, clash=False).select(F.col("text").cast("binary").alias("text"))
    one, two = (
        {bytes(r["word"]): r["class"] for r in brown_lm.listed(brown_lm.train(docs, head=3, classes=3, groups=2, buckets=5, **s)[0]).collect()}
        for s in ({}, {"block_words": 7}))
    assert one == two


@pytest.mark.parametrize("values", [[], [0], [1, 255], [256, 0, 65536], [2**40, 7], list(range(1000))])
def test_packed_numbers(values):
    from corpusprep.llm import blocks

    assert blocks.unpack(blocks.pack(np.array(values, np.int64))).tolist() == values


def test_copies_are_spread(spark):
    from corpusprep.llm import blocks

    docs = corpora.table(spark, ["one and the same text " * 20] * 400 + [None] * 50, clash=False).select(
        F.col("text").cast("binary").alias("text"))
    held = blocks.numbered(docs, bytes.split, block_bytes=4096)
    rows = blocks.documents_of(held).collect()
    counts = collections.Counter()
    numbers = []
    for r in rows:
        sizes = blocks.unpack(r["sizes"])
        counts[r["block"]] += len(sizes)
        numbers += blocks.unpack(r["ids"]).tolist()
        assert sizes.sum() * 4 <= 4096
    assert sum(counts.values()) == 450 and len(counts) >= 40
    assert len(numbers) == 400 * 100 and set(numbers) == set(range(5))
    found = {w for r in blocks.words_of(held).collect() for w in blocks.unpack_words(r["words"])}
    assert found == {b"one", b"and", b"the", b"same", b"text"}
