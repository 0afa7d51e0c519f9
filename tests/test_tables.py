"""Pages, assets, links, audits, sources and sinks on small literal tables."""

import pytest
from pyspark.sql import functions as F

from corpusprep.model import ASSETS, BLOCKS, RANGES
from corpusprep.operators import assets as at, audit as au, sequence as sq
from corpusprep.operators.lookup import lookup
from corpusprep.sources import readers, writers


def blocks(spark, *rows):
    return spark.createDataFrame([(1, i, t, p) for i, (t, p) in enumerate(rows)], BLOCKS).withColumn(
        "page", F.array_max("pages"))


def texts(df):
    return [r["text"] for r in df.orderBy("pos").collect()]


def test_page_chunks_follow_markers_not_order(spark):
    rows = [(f"p{p}", [p]) for p in (10, 55, 315, 147, 170, 205)] + [("after 205", [])]
    rows += [(f"p{p}", [p]) for p in (273, 301, 350)]
    got = {(r["start_page"], r["end_page"]): r["text"] for r in sq.page_chunks(blocks(spark, *rows), ["doc"]).collect()}
    assert sorted(got) == [(0, 49), (50, 99), (100, 149), (150, 199), (200, 249), (250, 299), (300, 349), (350, 350)]
    assert got[200, 249] == "p205\n\nafter 205" and got[300, 349] == "p315\n\np301"


def test_a_block_of_two_buckets_is_in_both(spark):
    got = sq.page_buckets(blocks(spark, ("lead", []), ("both", [49, 50]), ("tail", [])), ["doc"])
    assert sorted((r["text"], r["start_page"]) for r in got.collect()) == [
        ("both", 0), ("both", 50), ("lead", 0), ("tail", 50)]


def test_drop_sections(spark):
    df = blocks(spark, ("intro", [150]), ("# TABLE B", []), ("row 1", []), ("row 2", []), ("# Next", []), ("text", [170]))
    left = sq.drop_sections(df, ["doc"], F.col("text").rlike("^# TABLE"), F.col("text").rlike("^# "))
    assert texts(left) == ["intro", "# Next", "text"]


def test_monotone_example(spark):
    df = blocks(spark, *[(str(i), [p] if p else []) for i, p in enumerate((170, 0, 118, 0, 0, 177, 0))])
    assert texts(sq.monotone_filter(df, ["doc"])) == ["0", "1", "5", "6"]


def tail(spark, df):
    t = F.col("text")
    return sq.tail_ranges(df, ["doc"], t == "# PUZZLE", t.startswith("# "), t.startswith("TABLE F"), t.startswith("# Sources"))


def test_tail_is_removed_only_near_the_end(spark):
    df = blocks(spark, ("# Main", []), ("fig", [10]), ("# PUZZLE", []), ("grid", []), ("# Next", []), ("fig", [360]),
                ("# TABLES", []), ("# PUZZLE", []), ("grid", []), ("# Sources", []), ("list", []))
    ranges = tail(spark, df)
    assert {tuple(r) for r in ranges.collect()} == {(1, 7, 9, "section"), (1, 9, 11, "tail")}
    merged = sq.merge_ranges(ranges, ["doc"]).first()
    assert (merged["s"], merged["e"], [x["label"] for x in merged["labels"]]) == (7, 11, ["section", "tail"])
    assert texts(sq.remove_ranges(df, ranges, ["doc"])) == [
        "# Main", "fig", "# PUZZLE", "grid", "# Next", "fig", "# TABLES"]


def test_without_markers_any_end_matter_cuts(spark):
    df = blocks(spark, ("a", []), ("# Sources", []), ("b", []))
    assert texts(sq.remove_ranges(df, tail(spark, df), ["doc"])) == ["a"]


def test_touching_ranges_merge(spark):
    df = spark.createDataFrame([(1, 0, 5, "a"), (1, 5, 7, "b"), (1, 8, 9, "a")], RANGES)
    assert {(r["s"], r["e"]) for r in sq.merge_ranges(df, ["doc"]).collect()} == {(0, 7), (8, 9)}


def test_dedupe_keeps_references_in_prose(spark):
    df = blocks(spark, ("![](a)", []), ("see ![](a)", []), ("![](a)", []), ("![](b)", []))
    ref = F.nullif(F.regexp_extract("text", r"^!\[\]\(([^)]+)\)$", 1), F.lit(""))
    assert texts(sq.dedupe_refs(df, ["doc"], ref)) == ["![](a)", "see ![](a)", "![](b)"]


def test_captions(spark):
    lines = ["![](x)", "", "caption x", "![](y)", "# head", "late", "![](z)", "", "", "", "", "far", "![](x)", "newer"]
    df = blocks(spark, *[(t, []) for t in lines])
    t = F.col("text")
    got = sq.caption_lookahead(df, ["doc"], t.startswith("![]("), F.substring("text", 5, 1), t, t.rlike(r"^(?:#|!\[\]\()"))
    assert {r["name"]: r["caption"] for r in got.collect()} == {"x": "newer", "y": "", "z": ""}


def test_asset_table(spark):
    files = spark.createDataFrame([("d/_page_12_Figure_1.png",), ("d/_page_x_Picture.jpg",), ("d/other.png",)], "path string")
    captions = spark.createDataFrame([("other.png", "A cat")], "file_name string, caption string")
    got = at.asset_table(files, captions, (("figure", "figure"), ("picture", "picture")), "image", "Base.",
                         {"figure": " F.", "picture": " P.", "image": " I."}, "w/")
    rows = {r["file_name"]: r for r in got.collect()}
    assert [f.name for f in ASSETS] == got.columns
    assert rows["_page_12_Figure_1.png"]["page_number"] == 12
    assert rows["_page_x_Picture.jpg"]["page_number"] is None
    assert rows["other.png"]["prompt"] == "Base. I. Caption/context: A cat"
    assert rows["other.png"]["prompt_path"] == "w/prompts/other.txt"


def test_resolve_links(spark):
    targets = ["https://a/b.png", "images/k.png", "sub/a.png", "x/only.png", "chunk02__page_3_fig.png", "gone.png", r"sub\a.png"]
    links = spark.createDataFrame(list(enumerate(targets)), "id long, target string")
    inventory = spark.createDataFrame([("sub/a.png",), ("only.png",), ("_page_53_fig.png",)], "path string")
    got = {r["id"]: (r["via"], r["resolved"]) for r in at.resolve_links(links, inventory, ["id"]).collect()}
    assert got == {
        0: ("kept", targets[0]), 1: ("kept", targets[1]), 2: ("exact", "images/sub/a.png"),
        3: ("name", "images/only.png"), 4: ("remap", "images/_page_53_fig.png"), 5: ("unresolved", "gone.png"),
        6: ("exact", "images/sub/a.png")}


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_salted_lookup_equals_plain_join(spark, how):
    left = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = lookup(left, right, ["k"], ["id"], how, broadcast_bytes=-1, hot_rows=100, salts=5)
    want = left.join(right, ["k"], how)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_ranges():
    assert au.parse_ranges("3-7, 9") == [(3, 7), (9, 9)]
    for bad in ("", "0-3", "5-2", "1,,2", "x"):
        with pytest.raises(ValueError):
            au.parse_ranges(bad)


def test_ranges_past_the_end_are_reported(spark):
    rows = spark.range(1, 6).select(F.lit(1).alias("doc"), F.col("id").alias("n"))
    got = au.range_violations(rows, ["doc"], [(1, 5), (4, 8)], "n").collect()
    assert [(r["range_no"], r["range_end"]) for r in got] == [(2, 8)]


def test_a_missing_chunk_raises(spark):
    rows = spark.createDataFrame([(1,), (2,)], "c long")
    assert au.required(rows, spark.createDataFrame([(2,), (1,)], "c long"), ["c"]).count() == 2
    with pytest.raises(Exception, match="no chunk named 7"):
        au.required(rows, spark.createDataFrame([(7,)], "c long"), ["c"]).collect()


def test_missing_numbers_in_a_large_gap(spark):
    rows = spark.createDataFrame([(1, 3), (1, 200_000), (2, 1)], "d long, n int")
    got = au.missing_numbers(rows, ["d"], "n")
    assert got.count() == 199_998 and got.filter("d = 2").count() == 0


def test_error_summary_of_a_quiet_job(spark):
    rows = [(1, i, "! bad" if i % 2 else "ok") for i in range(60)] + [(2, i, "ok") for i in range(60)]
    df = spark.createDataFrame(rows, "job long, pos long, text string")
    got = au.error_summary(df, ["job"], F.col("text").startswith("!")).collect()
    assert sorted(r["pos"] for r in got if r["job"] == 1) == list(range(31, 60, 2))
    assert sorted(r["pos"] for r in got if r["job"] == 2) == list(range(40, 60))


def test_donor_and_diff(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k long, v string")
    b = spark.createDataFrame([(2, "y"), (3, "other"), (4, "w")], "k long, v string")
    fill = {r["k"]: (r["v"], r["status"]) for r in au.donor_fill(a, b, ["k"], "v").collect()}
    assert fill == {1: ("x", "present"), 2: ("y", "present"), 3: ("z", "verify"), 4: ("w", "insert")}
    diff = {r["k"]: r["change"] for r in au.revision_diff(a, b, ["k"], "v").collect()}
    assert diff == {1: "removed", 2: "same", 3: "changed", 4: "added"}


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs/a.md").write_text("one\ntwo\n", encoding="utf-8")
    (tmp_path / "docs/b.md").write_text("три", encoding="utf-8")
    (tmp_path / "img").mkdir()
    for name in ("x.PNG", "y.jpeg", "z.txt"):
        (tmp_path / "img" / name).write_bytes(b"1")
    read = readers.read_documents(spark, str(tmp_path / "docs"))
    assert sorted(r["text"] for r in read.collect()) == ["one\ntwo\n", "три"]
    assets = readers.read_assets(spark, str(tmp_path / "img"))
    assert sorted(r["path"].rsplit("/", 1)[1] for r in assets.collect()) == ["x.PNG", "y.jpeg"]

    chunks = sq.page_chunks(blocks(spark, ("a", [3]), ("b", [55])), ["doc"])
    writers.write_chunks(chunks, str(tmp_path / "chunks"), ["doc"])
    writers.write_chunk_folders(chunks, str(tmp_path / "folders"), ["doc"])
    for name in ("chunks", "folders"):
        back = spark.read.parquet(str(tmp_path / name)).select(*chunks.columns)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, chunks.collect()))
    manifest = writers.chunk_manifest(chunks, ["doc"], "book")
    writers.write_chunk_manifest(manifest, str(tmp_path / "tsv"))
    back = spark.read.csv(str(tmp_path / "tsv"), sep="\t", header=True)
    assert sorted(r["name"] for r in back.collect()) == ["book1_p000-049.md", "book1_p050-055.md"]
    quoted = spark.createDataFrame([("a\"b", "c,d")], "x string, y string")
    writers.write_manifest(quoted, str(tmp_path / "m"))
    assert tuple(spark.read.csv(f"{tmp_path}/m/csv", header=True, escape='"').first()) == ("a\"b", "c,d")
    assert tuple(spark.read.json(f"{tmp_path}/m/json").first()) == ("a\"b", "c,d")


def test_rows_with_null_keys_are_spread(spark, at_scale):
    from corpusprep.operators.lookup import lookup

    left = spark.range(2000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 7).alias("k"))
    right = spark.range(7).select(F.col("id").alias("k"), F.lit("hit").alias("v"))
    for how, n in (("left", 2000), ("left_anti", 1800), ("inner", 200)):
        joined = lookup(left, right, ["k"], ["id"], how)
        assert joined.count() == n
    assert lookup(left, right, ["k"], ["id"]).filter("k IS NULL AND v IS NULL").count() == 1800


def test_links_need_one_lookup(spark, at_scale):
    links = spark.createDataFrame([(i, f"a/{i}.png") for i in range(40)], "id long, target string")
    inventory = spark.createDataFrame([(f"{i}.png",) for i in range(0, 40, 2)], "path string")
    got = at.resolve_links(links, inventory, ["id"])
    assert {r["id"] for r in got.collect() if r["via"] == "name"} == set(range(0, 40, 2))
    assert got._jdf.queryExecution().optimizedPlan().collectLeaves().size() <= 8


def test_contamination_without_a_page_stays(spark):
    from corpusprep.operators.blocks import drop_contaminated

    rows = spark.createDataFrame([(1, None, True), (2, 200, True), (3, 200, None)], "id long, p int, m boolean")
    assert {r["id"] for r in drop_contaminated(rows, F.col("p"), F.col("m")).collect()} == {1, 3}


def test_positions_follow_any_order(spark):
    from corpusprep.operators.concat import concat_ordered, positioned

    rows = [("all", f"{a}-{b}", a, b) for a in (-(1 << 40), 3, 1 << 50) for b in (0, 1 << 33, 7)]
    df = spark.createDataFrame(rows, "t string, text string, a long, b long").repartition(5)
    placed = positioned(df, ["a", "b"], "at")
    got = concat_ordered(placed, ["t"], "at", sep=" ").first()["text"]
    assert got == " ".join(r[1] for r in sorted(rows, key=lambda r: r[2:]))


def test_ranks_have_gaps(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 7), ("c", 5), ("d", 1)], "g string, n long")
    assert {r["g"]: r["rnk"] for r in au.ranked(counts, "n").collect()} == {"b": 1, "a": 2, "c": 2, "d": 4}
