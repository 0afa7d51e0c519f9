"""The pipeline's stages against one another and against brute force on a small table."""

import corpora
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from corpusprep.llm.queries import QUERIES
from test_decontaminate import brute as leaks
from test_simhash_dedup import grouped, plain
from test_suffix_dedup import brute as repeats

SF = "/root/testdata/sf0.001"
PREFIXES = [f"op{n}_" for n in range(1, 14)]


def test_names():
    assert [next(q for q in QUERIES if q.startswith(p)) for p in PREFIXES] == list(QUERIES)
    assert len(corpus_pipeline.STAGES) == 5


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, [r.asDict() for r in docs.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    stage = dict(corpus_pipeline.STAGES)

    known = stage["language_id"](spark, docs, SF)
    assert known.columns == columns
    kept = sorted((r.asDict() for r in known.collect()), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in kept] == [r["doc_id"] for r in sorted(rows, key=lambda r: r["doc_id"])
                                           if any(c.isalpha() for c in r["text"] or "")]

    fps = {r["doc_id"]: plain(r["text"]) for r in kept}
    links = [(i, j) for i in fps for j in fps if i < j and bin(fps[i] ^ fps[j]).count("1") <= 3]
    roots = grouped(fps, links)
    known = corpus_pipeline.materialise(known, "t")
    single = corpus_pipeline.materialise(stage["near_duplicates"](spark, known, SF), "t")
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(roots.values()))

    held = sorted((r.asDict() for r in single.collect()), key=lambda r: r["doc_id"])
    cut = corpus_pipeline.materialise(stage["repeats"](spark, single, SF), "t")
    want = {r["doc_id"]: k.decode("utf-8", "ignore") for r, (k, *_) in zip(held, repeats([r["text"].encode() for r in held], 200))}
    got = {r["doc_id"]: r for r in cut.collect()}
    assert set(got) == set(want) and cut.columns == columns
    for d, r in got.items():
        assert r["n_chars"] == len(r["text"])
        assert r["text"] == want[d] or len(r["text"]) < len(want[d]) <= len(r["text"]) + 8

    clean = corpus_pipeline.materialise(stage["benchmark"](spark, cut, SF), "t")
    bad = {d for d, _ in leaks([(d, r["text"]) for d, r in got.items()], items)}
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(set(got) - bad)

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    final = stage["bpe"](spark, clean, SF).collect()
    for r in final:
        assert r["n_tokens"] == len(library.encode(got[r["doc_id"]]["text"], add_special_tokens=False).ids)
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, final))


@pytest.mark.parametrize("index", range(5))
def test_hard_rows(spark, index):
    docs = corpora.hard(spark)
    name, stage = corpus_pipeline.STAGES[index]
    for rows in (docs, corpora.empty(spark)):
        out = stage(spark, rows, SF)
        assert out.count() <= rows.count()
        if index < 4:
            assert out.columns == rows.columns
