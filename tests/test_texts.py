"""Masking, rewriting, residual detection, chunking: small literal cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators import blocks as bl, cache as ca, rules as ru
from corpusprep.operators.packing import CHUNK_CHARS, chunk_text, cut_points
from corpusprep.operators.residual import Detector, needs_residual, translate_segments
from corpusprep.operators.spans import (
    FORMULAS, SpanKind, leaks, mask_spans, restore_unresolved, span_table, unmask)
from corpusprep.plans.translate import translate_documents


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def one(df, *columns):
    row = df.select(*columns).first()
    return row[0] if len(columns) == 1 else tuple(row)


def test_formulas_round_trip(spark):
    text = "Before\n\n$$x^2$$\n\nand $y$ after ![a](b.png) end"
    masked = mask_spans(docs(spark, text), FORMULAS)
    shown = one(masked, "masked")
    assert "x^2" not in shown and "$y$" not in shown and "MATHBLK0000X" in shown
    kinds = {r["kind"]: r["original"] for r in span_table(masked, FORMULAS, ["doc_id"]).collect()}
    assert kinds == {"block": "$$x^2$$", "inline": "$y$", "image": "![a](b.png)"}
    back = one(unmask(masked, FORMULAS), "restored")
    assert re.sub(r"\s", "", back) == re.sub(r"\s", "", text)


def test_swallowed_placeholder_comes_back(spark):
    # A lone dollar makes the inline pattern swallow a block placeholder.
    text = "a $ b $$q$$ c $ d"
    masked = mask_spans(docs(spark, text), FORMULAS)
    assert one(unmask(masked, FORMULAS), "restored").count("$$q$$") == 1
    assert one(unmask(masked, FORMULAS).select(leaks("restored", FORMULAS).alias("l")), "l") == []


def test_neighbours_share_one_padding(spark):
    masked = mask_spans(docs(spark, "a $x$$y$ b"), [SpanKind("inline", "MATHINL", r"\$[a-z]\$")])
    assert one(unmask(masked, [SpanKind("inline", "MATHINL", r"\$[a-z]\$")]), "restored") == "a $x$ $y$ b"


def test_ids_beyond_four_digits_are_seen(spark):
    kind = [SpanKind("inline", "MATHINL", r"\$[a-z]\$")]
    masked = mask_spans(docs(spark, "$x$ " * 10_002), kind)
    assert "MATHINL10001X" in one(masked, "masked")
    assert one(unmask(masked, kind).select(leaks("restored", kind).alias("l")), "l") == []
    assert len(one(masked.select(leaks("masked", kind).alias("l")), "l")) == 10_002


def test_restore_unresolved_reports_what_is_missing(spark):
    kind = [SpanKind("inline", "MATHINL", r"\$[a-z]\$")]
    leaked = docs(spark, "see MATHINL0001X and MATHINL0007X")
    healed = restore_unresolved(leaked, docs(spark, "$a$ $b$"), kind, ["doc_id"])
    assert one(healed, "healed", "n_restored", "missing") == ("see  $b$  and MATHINL0007X", 1, ["MATHINL0007X"])


def test_chunks_break_between_paragraphs(spark):
    p1, p2, p3 = "a" * 40, "b" * 40, "c" * 40
    got = chunk_text(docs(spark, f"{p1}\n\n{p2}\n\n{p3}"), limit=85).orderBy("chunk_no").collect()
    assert [r["chunk"].strip() for r in got] == [f"{p1}\n\n{p2}", p3]


@pytest.mark.parametrize("text", ["", "x" * 50, "ab\n" * 30, "# h\n" * 20, "p\n\n# head\nbody body body\n" * 6])
def test_chunks_lose_nothing(text):
    ends = cut_points(text, 20, re.compile(r"#+\s"))
    parts = [text[a:b] for a, b in zip([0, *ends], ends)]
    assert "".join(parts) == text and all(len(p) <= 20 for p in parts)


def test_chunks_strand_no_heading():
    assert cut_points("aaaa\nbb\n# head\n" + "b" * 30, 18, re.compile(r"#+\s"))[0] == len("aaaa\n")


def test_wrap_unfenced(spark):
    text = "\n".join([r"\begin{case}a\end{case}", "", "x = y_1", "Це рівність = так", "|---|", "$$", "q = 1", "$$"])
    got = one(ru.wrap_unfenced(
        docs(spark, text), FORMULAS[:2], r"[=_^]", r"[Ѐ-ӿ]", ["cases"],
        {r"\begin{case}": r"\begin{cases}", r"\end{case}": r"\end{cases}"}), "wrapped")
    assert "$$\n\\begin{cases}a\\end{cases}\n$$" in got
    assert "$$\nx = y_1\n$$" in got and "\nЦе рівність = так\n" in got and "\n|---|\n" in got
    assert got.count("q = 1") == 1 and got.endswith("$$\nq = 1\n$$")


def test_glossary_keeps_case_and_spares_spans(spark):
    kind = [SpanKind("code", "CODINL", r"`[^`]*`")]
    text = "Вода и вода, ВОДА; подвода `вода` чистая вода"
    masked = mask_spans(docs(spark, text), kind)
    done = ru.glossary_rewrite(masked, {"вода": "water"}, {"чистая вода": "clear water"}, "masked")
    assert one(unmask(done, kind), "restored") == "Water и water, WATER; подвода `вода` clear water"


@pytest.mark.parametrize("text", [
    "see EMLINL0000X here and a@b.com now", "EMLINL0001X is not a@b.c or d@e.f or EMLINL0000X.",
    "KEPTTK0000X with COD0000X", "xCOD00009Xy and `EMLINL0000X ab` too", "no EMLINL0000X",
])
def test_source_with_placeholders(spark, text):
    kinds = (SpanKind("email", "EMLINL", r"[a-z]+@[a-z.]*[a-z]"), SpanKind("code", "COD", "`[^`]*`"))
    masked = mask_spans(docs(spark, text), kinds)
    assert one(unmask(masked, kinds), "restored").split() == text.split()
    known = [r["idx"] for r in span_table(masked, kinds, ["doc_id"]).collect()]
    assert len(known) == text.count("@") + text.count("`") // 2
    healed = restore_unresolved(
        spark.createDataFrame([(0, "left EMLINL0000X")], "doc_id long, text string"), docs(spark, text), kinds, ["doc_id"])
    assert one(healed, "healed").split() == [
        "left", "EMLINL0000X" if "@" not in text else re.findall("[a-z]+@[a-z.]*[a-z]", text)[0]]


def test_longer_phrases_go_first(spark):
    got = ru.glossary_rewrite(docs(spark, "a b c, b c d"), {}, {"a b": "1", "b c d": "2", "b c": "3"})
    assert one(got, "text") == "1 c, 2"


def test_rewrite_beyond_one_projection(spark):
    rules = [ru.Rule(str(i), f"<{i}>", f"<{i + 1}>", "literal") for i in range(40)]
    assert one(ru.rewrite(docs(spark, "<0>"), rules), "text") == "<40>"


# Formatting rules in order; patterns are fixed values, their order matters.
MARKDOWN_CLEANUP = (
    ru.Rule("newline_before_punctuation", r"\s*\n+\s*([,.;:)])", "$1"),
    ru.Rule("comma_run", r",{3,}", " "),
    ru.Rule("comma_line", r"(?m)^[ \t,]+$", ""),
    ru.Rule("fence_indent", r"(?m)^[ \t]+(\$\$)", "$1"),
    ru.Rule("image_apart", r"\s*(!\[.*?\]\(.*?\))\s*", "\n\n$1\n\n"),
    ru.Rule("newline_run", r"\n{3,}", "\n\n"),
    ru.Rule("double_heading", r"(?m)^(#+)\s+#\s*", "$1 "),
    ru.Rule("fence_run", r"(?:\$\$\s*){2,}", r"\$\$ "),
)


def test_markdown_cleanup_and_fences(spark):
    text = "word\n.\n\n\n\n# # Head\n,,,,\nend"
    assert one(ru.rewrite(docs(spark, text), MARKDOWN_CLEANUP), "text") == "word.\n\n# Head \nend"
    fenced = docs(spark, "$$\n$$ a $$\n$$ open\nclose $$\nplain").select(ru.clean_fences("text").alias("t"))
    assert one(fenced, "t") == "$$ a $$\nopen\nclose\nplain"
    more = docs(spark, "a $$ b\n$$a$$ b $$\n$$a$$$$b$$\n  $$  \n$$$$\n\n$$ a $$ b").select(ru.clean_fences("text").alias("t"))
    assert one(more, "t") == "a b\n$$a$$ b\n$$a$$$$b$$\n$$$$\n\n$$ a $$ b"


def test_guarded_rewrite(spark):
    df = spark.createDataFrame([("bad MATHBLK0001X", "safe"), ("good", "safe")], "a string, b string")
    got = df.select(ru.guarded(F.col("a"), F.col("b"), r"MATHBLK\d{4,}X").alias("t"))
    assert [r["t"] for r in got.collect()] == ["safe", "good"]


def test_rule_audits(spark):
    rules = [ru.Rule("x", "x", "y"), ru.Rule("y", "y", "z"), ru.Rule("no", "q+", "")]
    hits = {r["rule_id"]: (r["n_hits"], r["n_docs"]) for r in ru.rule_hits(docs(spark, "xx", "y"), rules).collect()}
    assert hits == {"x": (2, 1), "y": (1, 1), "no": (0, 0)}


RUSSIAN = Detector(
    markers=["как", "что"], letters="[ыэъё]", words=r"(?iU)\bрешение\b", script=r"\p{IsCyrillic}",
    caption_prefix=r"(?iU)^рис", short_prefix=r"(?iU)^(?:#{1,6}\s+|задачи\b)")


@pytest.mark.parametrize("text, want", [
    ("# Решение уравнений", True), ("Рис. 2. Быстрая волна", True), ("# Розвʼязок рівнянь", False),
    ("```ы```", False), ("![](ы.png)", False), ("как что", False), ("как и что " + "слово " * 6, True),
    ("слово " * 20 + "как что", True), ("слово " * 20 + "как", False), ("слово " * 20 + "ы", True),
    ("задачи как", True), ("задачи", False),
])
def test_needs_residual(spark, text, want):
    assert one(docs(spark, text).select(needs_residual("text", RUSSIAN).alias("r")), "r") is want


def test_envelopes_fall_back_when_a_token_is_lost(spark):
    rows = [(1, 0, "one"), (1, 1, "two"), (2, 0, "three"), (2, 1, "lose")]
    df = spark.createDataFrame(rows, "batch long, pos long, text string")

    def service(body):
        return F.upper(F.when(body.contains("lose"), F.replace(body, F.lit("TOKEN0001"))).otherwise(body))

    got = {(r["batch"], r["pos"]): (r["via"], r["text"]) for r in translate_segments(df, ["batch"], service).collect()}
    assert got == {(1, 0): ("batch", "ONE"), (1, 1): ("batch", "TWO"),
                   (2, 0): ("single", "THREE"), (2, 1): ("single", "LOSE")}


def test_envelopes_follow_tokens_that_moved(spark):
    df = spark.createDataFrame([(1, 0, "one"), (1, 1, "two")], "batch long, pos long, text string")

    def swap(body):
        first = r"(?s)(SEGMENTTOKEN0000XYZ.*?)\s+(SEGMENTTOKEN0001XYZ.*)"
        return F.regexp_replace(body, first, "$2\n\n$1")

    got = {r["pos"]: r["text"] for r in translate_segments(df, ["batch"], swap).collect()}
    assert got == {0: "one", 1: "two"}


def test_cache_poison_modes(spark):
    chunks = docs(spark, "formula MATHINL0000X", "plain")
    cache = chunks.select(tx.digest("text").alias("md5"), F.lit("t MATHINL0000X").alias("translated"))

    def status(mode):
        got = ca.cache_lookup(chunks, cache, ["doc_id"], mode=mode)
        return [r["status"] for r in got.orderBy("doc_id").collect()]

    assert status("foreign") == ["hit", "poisoned"]
    assert status("reference") == ["poisoned", "poisoned"]
    assert ca.evict_poisoned(cache).count() == 0


def test_cache_upsert_prefers_new(spark):
    old = spark.createDataFrame([("a", "z"), ("b", "old")], ca_schema())
    new = spark.createDataFrame([("a", "b"), ("c", "new")], ca_schema())
    assert {tuple(r) for r in ca.cache_upsert(old, new).collect()} == {("a", "b"), ("b", "old"), ("c", "new")}


def ca_schema():
    from corpusprep.model import CACHE

    return CACHE


def test_translate_documents_twice(spark):
    source = docs(spark, "alpha $x$ beta", "gamma", "gamma")
    calls = spark.sparkContext.accumulator(0)

    def upper(texts):
        calls.add(len(texts))
        return texts.str.upper().str.replace("MATHINL0000X", "MATHINL0000X")

    empty = spark.createDataFrame([], ca_schema())
    done, fresh = translate_documents(source, FORMULAS, empty, ca.by_pandas(upper))
    assert [r["translated"] for r in done.orderBy("doc_id").collect()] == ["ALPHA $x$ BETA", "GAMMA", "GAMMA"]
    cache = ca.cache_upsert(empty, fresh).persist()
    assert cache.count() == 2 and calls.value == 2
    again, more = translate_documents(source, FORMULAS, cache, ca.by_pandas(upper))
    assert [r["translated"] for r in again.orderBy("doc_id").collect()] == ["ALPHA $x$ BETA", "GAMMA", "GAMMA"]
    assert more.count() == 0 and calls.value == 2


def test_split_and_join(spark):
    blocks = bl.split_blocks(docs(spark, "one\n\n  \n\ntwo\n \n# three\nfour\n"))
    assert [r["text"] for r in blocks.orderBy("pos").collect()] == ["one", "two", "# three\nfour"]
    parts = F.array(F.lit(" a \n"), F.lit(""), F.lit("\t"), F.lit("b\n\n\n\nc"))
    assert one(spark.range(1).select(bl.joined(parts).alias("t")), "t") == "a\n\nb\n\nc\n"
    assert one(spark.range(1).select(bl.joined(F.array(F.lit(" "))).alias("t")), "t") == ""


FORMULA_LINE = {
    "symbol": r"\\[a-z]+|[=^]", "prose": r"(?U)\p{IsCyrillic}{3,}", "ignore": (r"\\text\{[^}]*\}",),
    "exempt": ("^`.*`$", "^#", r"^[\d.]+$", r"\$"),
}
UNSAFE_LINE = {
    "risky": r"\\(?:Delta|qquad|left)\b", "glued": r"(?U)\p{L}\\\p{L}", "exempt": "^[#>|]",
    "formula": lambda body: bl.symbol_line(body, **FORMULA_LINE), "command": r"\\[a-z]",
}


@pytest.mark.parametrize("line, want", [
    ("u = v", True), (r"\alpha", True), ("`u = v`", False), ("# u = v", False), ("12.5", False),
    ("$u = v$", False), ("дано u = v", False), (r"\text{дано} u = v", True), ("", False), ("prose", False),
])
def test_symbol_line(spark, line, want):
    assert one(docs(spark, line).select(bl.symbol_line("text", **FORMULA_LINE).alias("r")), "r") is want


@pytest.mark.parametrize("line, want", [
    (r"\Delta u = 0", True), (r"    \qquad u = 1", True), (r"решение X\left(x\right)", True),
    (r"`\Delta u`", False), (r"# \Delta", False), (r"- `\left(`", False), ("prose", False), (r"2. \alpha + \beta = 1", True),
])
def test_unsafe_line(spark, line, want):
    assert one(docs(spark, line).select(bl.unsafe_line("text", **UNSAFE_LINE).alias("r")), "r") is want


@pytest.mark.parametrize("body, want", [
    (r"\begin{cases}a\end{cases}", set()), (r"\begin{aligned}", {"lone_begin", "environment_imbalance"}),
    (r"{x", {"brace_imbalance"}), ("MATHBLK0000X", {"leaked_token"}), (r"\Дельта", {"foreign_command"}),
    (r"\begin{array}{ll}\end{array}", {"empty_array"}), ("a\n- b", {"list_or_heading"}),
])
def test_malformed_flags(spark, body, want):
    flags = bl.malformed_flags("text")
    row = docs(spark, body).select(*[c.alias(n) for n, c in flags.items()]).first()
    assert {n for n in flags if row[n]} == want


def test_classify(spark):
    lines = ["# h", "```", "![a](b.png)", "| a |", "> q", "text"]
    got = docs(spark, *lines).orderBy("doc_id").select(bl.classify("text", bl.MARKDOWN_KINDS).alias("k"))
    assert [r["k"] for r in got.collect()] == ["heading", "code", "image", "table", "quote", "prose"]


def test_default_sizes():
    from corpusprep.operators.packing import BATCH_CHARS

    assert (CHUNK_CHARS, BATCH_CHARS) == (9000, 3500)


def cuts(text, limit, heading):
    """The chunk rule, one character at a time."""
    out, start = [], 0
    while len(text) - start > limit:
        window = range(start + 1, start + limit)
        blanks = [p for p in window if text[p:p + 2] == "\n\n" and p + 1 < start + limit]
        lines = [p for p in window if text[p] == "\n"]
        at = max(blanks or lines or [start + limit - 1])
        while True:
            before = text[start:at + 1].rstrip().split("\n")
            if len(before) < 2 or not heading.match(before[-1]):
                break
            head = start + len("\n".join(before[:-1]))
            higher = [p for p in range(start + 1, head) if text[p] == "\n"]
            if not higher:
                break
            at = higher[-1]
        start = at + 1
        out.append(start)
    return out + ([len(text)] if start < len(text) or not out else [])


def test_cut_points_follow_the_rule():
    rng = random.Random(3)
    heading = re.compile(r"#+\s")
    for _ in range(2000):
        parts = [rng.choice(["a", "bb", "\n", "\n\n", "# h", "## x y", " ", "\n# t\n", "text line"]) for _ in range(rng.randint(0, 25))]
        text, limit = "".join(parts), rng.randint(3, 30)
        got = cut_points(text, limit, heading)
        assert got == cuts(text, limit, heading), (text, limit)
        assert all(b - a <= limit for a, b in zip([0, *got], got))


def test_null_texts_stay(spark):
    from corpusprep.operators.cache import by_pandas
    from corpusprep.plans.translate import translate_documents

    docs = spark.createDataFrame([(1, "one"), (2, None), (3, "x\n" * 40)], "doc_id long, text string")
    chunks = chunk_text(docs, limit=20)
    assert {r["doc_id"] for r in chunks.collect()} == {1, 2, 3}
    cache = spark.createDataFrame([], "md5 string, translated string")
    calls = spark.sparkContext.accumulator(0)

    def shout(texts):
        calls.add(len(texts))
        return texts.str.upper()

    done, fresh = translate_documents(docs, FORMULAS, cache, by_pandas(shout), limit=20)
    got = {r["doc_id"]: r["translated"] for r in done.collect()}
    assert set(got) == {1, 2, 3} and got[1] == "ONE" and got[2] is None
    # Each distinct chunk is asked for once, however often the results are read.
    assert calls.value == fresh.count() == chunks.filter("chunk IS NOT NULL").select("chunk").distinct().count()


def test_only_lost_batches_are_sent_again(spark):
    from corpusprep.operators.residual import translate_segments

    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def service(text):
        calls.add(1)
        return text.replace("SEGMENTTOKEN0001XYZ", "") if "bad" in text and "TOKEN" in text else text.upper()

    rows = [(b, i, f"{'bad' if b else 'good'} {i}") for b in (0, 1) for i in range(5)]
    segments = spark.createDataFrame(rows, "batch long, pos long, text string")
    got = translate_segments(segments, ["batch"], lambda c: service(c)).collect()
    assert {r["batch"]: r["via"] for r in got} == {0: "batch", 1: "single"}
    assert all(r["text"] == f"{'BAD' if r['batch'] else 'GOOD'} {r['pos']}" for r in got)
    got_calls = calls.value
    assert got_calls == 2 + 5


def test_what_looks_hidden_stays(spark):
    from corpusprep.operators.rules import hide, show

    text = "see HIDE0X and \ue0000\ue001 and $a$ here"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    hidden = hide(docs, FORMULAS, "text")
    assert show(hidden, "text").first()["text"] == text


def test_residual_pass(spark):
    from corpusprep.plans.residual import residual_pass

    rows = [(1, "keep $a$ this\n\nXX send $b$ on\n\nXX and this"), (2, None), (3, ""), (4, "nothing to send")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in residual_pass(
        docs, FORMULAS, lambda t: t.startswith("XX"), lambda t: F.replace(t, F.lit("send"), F.lit("SENT"))).collect()}
    assert got[1]["residual"] == "keep $a$ this\n\nXX SENT $b$ on\n\nXX and this"
    assert (got[1]["n_blocks"], got[1]["n_sent"]) == (3, 2)
    assert got[4]["residual"] == "nothing to send" and got[4]["n_sent"] == 0
    assert got[2]["residual"] is None and got[3]["residual"] is None


def test_many_rules_stay_apart(spark):
    rules = [ru.Rule(f"r{i}", f"w{i}(?![0-9])", f"w{i + 1}") for i in range(60)]
    docs = spark.createDataFrame([(1, "w0 and w59"), (2, None)], "doc_id long, text string")
    done = ru.rewrite(docs, rules)
    assert {r["doc_id"]: r["text"] for r in done.collect()} == {1: "w60 and w60", 2: None}
    assert done.columns == docs.columns
    assert done._jdf.queryExecution().optimizedPlan().toString().count("Generate") >= 3


def test_pages_and_literal_edits(spark):
    docs = spark.createDataFrame([(1, "[p 3] a [p 12]"), (2, "none"), (3, None), (4, "[p 99999999999]")], "doc_id long, text string")
    got = {r["doc_id"]: (r["pages"], r["page"]) for r in bl.mark_pages(docs, r"\[p (\d+)\]").collect()}
    assert got == {1: ([3, 12], 3), 2: ([], None), 3: ([], None), 4: ([], None)}
    texts = [("x # A old # B y", "x new\n\n# B y"), ("# B # A old", "# B # A old"), ("# A", "# A"), (None, None)]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "id long, text string")
    edited = rows.select("id", bl.edit_literal("text", "# A", "# B", "new  ").alias("t")).collect()
    assert [r["t"] for r in sorted(edited, key=lambda r: r["id"])] == [w for _, w in texts]
