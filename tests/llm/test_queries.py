"""Every registered query of the training-data operators on the smallest tables: columns, types, rows."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusprep.llm.queries import QUERIES, TOKEN_LIMIT

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
            "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op2": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op3": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op4": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint",
            "base_score": "double", "score": "double"},
    "op5": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op6": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op7": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op8": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op9": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op10": {"doc_id": "bigint", "item_id": "bigint"},
}


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, documents, name):
    query = next(q for q in QUERIES if q.startswith(f"{name}_"))
    out = QUERIES[query](spark, SF)
    kinds = dict(out.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    rows = out.collect()
    if "page_id" in kinds:
        assert sorted(r["page_id"] for r in rows) == sorted(r["page_id"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect())
    elif name != "op10":
        assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    if name in ("op3", "op9"):
        library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        for r in rows:
            n = len(library.encode(documents[r["doc_id"]], add_special_tokens=False).ids)
            assert r["n_tokens"] == n
            if name == "op3":
                assert r["decoded_sha256"] == hashlib.sha256(documents[r["doc_id"]].encode()).hexdigest()
            else:
                assert r["over_limit"] == (n > TOKEN_LIMIT) and r["n_bytes"] == len(documents[r["doc_id"]].encode())
