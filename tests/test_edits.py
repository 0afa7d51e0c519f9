"""Edit tables and large glossaries against rules applied one after the other."""

import random
import re
import time

import pyarrow as pa
import pytest

from corpusprep import model
from corpusprep.functions.batches import pieces
from corpusprep.operators.edits import Edit, EditRun, apply_edits, edit_counts
from corpusprep.operators.glossary import Glossary, cased, lowered, rewrite_by_table
from corpusprep.operators.rules import glossary_rewrite


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def in_turn(edits, text):
    hits = []
    for e in sorted(edits, key=lambda e: e.ord):
        if e.kind == "regex":
            text, n = re.subn(e.pattern, e.replacement.replace("$1", r"\1"), text)
        elif e.kind == "literal":
            n, text = text.count(e.pattern), text.replace(e.pattern, e.replacement)
        else:
            begin = text.find(e.pattern)
            end = text.find(e.stop, begin) if begin >= 0 and e.stop else -1
            n = int(end > begin)
            text = text[:begin] + e.replacement.rstrip() + "\n\n" + text[end:] if n else text
        if n:
            hits.append((e.ord, n))
    return text, hits


def table_of(spark, edits):
    return spark.createDataFrame(
        [(f"r{e.ord}", e.ord, e.kind, e.pattern, e.replacement, e.stop) for e in edits], model.EDITS)


def random_edits(rng, n, regex=False):
    piece = lambda a, b: "".join(rng.choice("abc ") for _ in range(rng.randrange(a, b)))
    out = []
    for i in range(n):
        kind = rng.choice(["literal"] * 4 + ["section"] + ["regex"] * regex)
        pattern = f"({rng.choice('abc')})b+" if kind == "regex" else piece(1, 5)
        put = "$1c" if kind == "regex" else piece(0, 5)
        out.append(Edit(i, kind, pattern, put, piece(1, 3) if kind == "section" else None))
    return out


@pytest.mark.parametrize("seed", range(40))
def test_rules_that_call_for_others(seed):
    rng = random.Random(seed)
    edits = random_edits(rng, 25)
    run = EditRun(edits)
    for _ in range(20):
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(60)))
        assert run.apply(text) == in_turn(edits, text)


@pytest.mark.parametrize("run_bytes", [None, 200])
def test_edit_table(spark, run_bytes):
    rng = random.Random(9)
    edits = random_edits(rng, 30, regex=True)
    texts = ["".join(rng.choice("abc ") for _ in range(40)) for _ in range(50)]
    rules = table_of(spark, edits)
    edited = apply_edits(docs(spark, *texts, None, ""), rules.orderBy("pattern"), run_bytes=run_bytes)
    want = [in_turn(edits, t) for t in texts]
    rows = {r["doc_id"]: r for r in edited.collect()}
    assert [(rows[i]["edited"], [tuple(h) for h in rows[i]["hits"]]) for i in range(len(texts))] == want
    assert (rows[50]["edited"], rows[50]["hits"], rows[51]["text"]) == (None, [], "")
    totals = {r["rule_id"]: (r["n_hits"], r["used"]) for r in edit_counts(edited, rules).collect()}
    sums = {f"r{e.ord}": sum(n for _, h in want for o, n in h if o == e.ord) for e in edits}
    # The two empty rows may be hit by no rule.
    assert totals == {k: (v, int(v > 0)) for k, v in sums.items()}


def test_thousands_of_rules(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(5000)]
    edits = [Edit(i, "literal", w, rng.choice(words).upper() if i % 3 else rng.choice(words)) for i, w in enumerate(words)]
    texts = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(40)]
    began = time.time()
    edited = apply_edits(docs(spark, *texts), table_of(spark, edits))
    edited._jdf.queryExecution().executedPlan()
    assert time.time() - began < 20
    got = {r["doc_id"]: r["edited"] for r in edited.collect()}
    assert [got[i] for i in range(40)] == [in_turn(edits, t)[0] for t in texts]


def test_unknown_kind(spark):
    with pytest.raises(ValueError, match="unknown kind"):
        apply_edits(docs(spark, "a"), table_of(spark, [Edit(1, "magic", "a", "b")]))


PHRASES = {"de la": "of the", "de la mer": "of the sea", "la mer": "the sea", "peu à peu": "little by little"}
WORDS = {"mer": "sea", "été": "summer", "peu": "few", "and": "AND"}
TEXTS = [
    "De la mer et de la Terre", "LA MER! la mer, lamer; peu à peu un peu", "l'été, ÉTÉ Été étés", "peu à peu à peu",
    "de  la\nde la", "x_mer mer_ mer1 1mer mer", "İ de la mer", "", None, "Peu À Peu", "DE LA MER",
]


def test_table_equals_small_form(spark):
    rows = [*PHRASES.items(), *WORDS.items()]
    got = rewrite_by_table(docs(spark, *TEXTS), spark.createDataFrame(rows, model.GLOSSARY))
    want = glossary_rewrite(docs(spark, *TEXTS), WORDS, PHRASES)
    assert sorted(map(tuple, got.select("doc_id", "rewritten").collect())) == sorted(
        map(tuple, want.select("doc_id", "text").collect()))


def test_runs_and_order(spark):
    rng = random.Random(2)
    rows = [(" ".join(rng.choice("abcdef") for _ in range(rng.randrange(2, 6))), str(i)) for i in range(200)]
    rows = list({s: (s, p) for s, p in rows}.values())
    texts = [" ".join(rng.choice("abcdef") for _ in range(30)) for _ in range(20)]
    table = spark.createDataFrame(rows, model.GLOSSARY)
    one, many = (
        [r["rewritten"] for r in rewrite_by_table(docs(spark, *texts), table, run_bytes=b).orderBy("doc_id").collect()]
        for b in (None, 2000))
    order = sorted(rows, key=lambda r: (-len(r[0]), r[0]))
    want = []
    for text in texts:
        for source, put in order:
            text = re.sub(rf"(?<!\w){source}(?!\w)", put, text)
        want.append(text)
    assert one == many == want


def test_joined_equals_shared(spark, monkeypatch):
    """Entries that call for others, adjoin them, hold no word or have one form in lower case."""
    from corpusprep.operators import glossary as gl

    rng = random.Random(4)
    piece = lambda a, b: "".join(rng.choice("abBé_- .,´") for _ in range(rng.randrange(a, b)))
    rows = [(piece(1, 7), rng.choice([piece(0, 6), None])) for _ in range(300)]
    rows += [("x", "a b"), ("a", "x y"), ("--", "..."), ("a b a b", "x"), ("-", ""), ("", "never")]
    texts = ["", None, *(piece(1, 60) + " x a b a b" for _ in range(60))]
    table = spark.createDataFrame(rows, model.GLOSSARY)
    # Blocks of any size, so that the entries of one are not those of another.
    monkeypatch.setattr(gl, "BLOCK_BYTES", 400)
    one, many = (
        [r["rewritten"] for r in rewrite_by_table(docs(spark, *texts), table, run_bytes=b).orderBy("doc_id").collect()]
        for b in (None, 500))
    assert one == many and sum(a != b for a, b in zip(one, texts)) > 50


def test_a_long_glossary_is_not_shared(spark):
    """However long it is, a text passes through as many Python functions; they were one for each run before."""
    rows = [(f"a{i} z", f"{i}") for i in range(2000)]
    done = rewrite_by_table(docs(spark, "a1 z a1999 z"), spark.createDataFrame(rows, model.GLOSSARY), run_bytes=1000)
    assert done._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") <= 1
    assert done.first()["rewritten"] == "1 1999"


def test_texts_are_taken_in_pieces():
    texts = pa.array(["a" * 10, None, "b" * 100, "", "c" * 10, "d"])
    parts = [p.to_pylist() for p in pieces(texts, 20)]
    assert sum(parts, []) == texts.to_pylist() and len(parts) > 2
    assert all(sum(len(t or "") for t in p[1:]) <= 20 for p in parts)
    assert [p.to_pylist() for p in pieces(texts[:0])] == [[]]


def test_replacements_are_subject_to_later_entries():
    glossary = Glossary([("big red dog", "red dog"), ("red dog", "dog"), ("dog", "cat")])
    assert glossary.rewrite("Big Red Dog, RED DOG, dog") == "Cat, CAT, cat"
    assert lowered("İX") == "İx" and cased("ab", "Cd") == "Cd"
