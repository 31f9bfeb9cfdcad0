import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fernweave.llm import token_counts as C

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_compact_table():
    items = [(f"k{i}".encode(), i % 250 + 1) for i in range(3000)]
    table = C.CompactTable(items)
    assert all(table.get(k) == n for k, n in items) and table.get(b"none") == 0
    assert C.CompactTable([]).get(b"a") == 0


def test_query_equals_library(spark, folder, odd_documents, monkeypatch):
    monkeypatch.setattr(C, "FREQUENT", 5)  # nearly all pre-tokens go to the second tier
    tokenizer = Tokenizer.from_file(PATH)
    rows = C.op3_token_counts(spark, folder(documents=odd_documents)).collect()
    assert len(rows) == len(odd_documents)
    expected = sorted((r[0] or 0, len((r[1] or "").encode()), len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in odd_documents)
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in rows) == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in rows)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_files_count_whole_texts(spark, name):
    df = spark.createDataFrame([(1, "Some text here"), (2, None)], "k int, text string")
    out = [r["n_tokens"] for r in C.count_tokens(df, public_tokenizers.path(name)).orderBy("k").collect()]
    assert out[0] > 2 and out[1] == 0


def test_clashing_columns_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "one two", "x"), (1, "one two", "x")], "k int, text string, N_TOKENS string")
    out = C.count_tokens(df, PATH)
    assert out.columns == ["k", "text", "n_tokens"] and [r["n_tokens"] for r in out.collect()] == [2, 2]


def test_empty_table(spark, folder):
    assert C.op3_token_counts(spark, folder(documents=[])).count() == 0
