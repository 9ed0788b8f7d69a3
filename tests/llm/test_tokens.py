"""Token counts against the libraries themselves on whole texts."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from ledgerloom.llm import tokens

FOLDER = "/root/testdata/sf0.001"
BYTES, WORDS, PIECES = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"
PARTS = [*"ab1 '\n\t\r.!<|>é中٣Ⅷ\x00\x0b\x1c\x85", "　", "\xa0", "​", "́", "᠎", "﻿", "😀", "<|endoftext|>", "'s", "'re", "  ", " word", "Z9z9"]


def whole(name, text):
    """The number of tokens that the file's library gives the text as a whole."""
    if name.endswith(".json"):
        return len(Tokenizer.from_file(public_tokenizers.path(name)).encode(text, add_special_tokens=False).ids)
    import sentencepiece

    return len(sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name)).encode(text))


@pytest.mark.parametrize("long", [1, tokens.LONG])
def test_pieces_change_no_count(monkeypatch, long):
    monkeypatch.setattr(tokens, "LONG", long)
    monkeypatch.setattr(tokens, "KNOWN", 50)
    content = open(public_tokenizers.path(BYTES), "rb").read()
    made, counter = Tokenizer.from_str(content.decode()), tokens.Counter("json", content)
    rng = random.Random(13)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(30))) for _ in range(3000)]
    assert counter.cut and all("".join(tokens.pieces(t)) == t for t in texts)
    assert counter.counts(texts) == [len(made.encode(t, add_special_tokens=False).ids) for t in texts]


def test_odd_rows_and_long_texts(spark, documents):
    rows = [(20, "x" * 300_000), (21, "ab12" * 100_000), (22, "word <|endoftext|> " * 50_000), (23, " " * 100_000), (24, "中" * 100_000)]
    long = spark.createDataFrame(rows, "doc_id long, text string")
    docs = documents.unionByName(long, allowMissingColumns=True).selectExpr("*", "1 AS n_tokens", "2 AS _body")
    found = tokens.with_counts(docs, public_tokenizers.path(BYTES))
    assert found.columns == [*documents.columns, "_body", "n_tokens"] and found.count() == docs.count()
    made = Tokenizer.from_file(public_tokenizers.path(BYTES))
    assert all(r.n_tokens == len(made.encode(r.text or "", add_special_tokens=False)) for r in found.collect())
    assert tokens.with_counts(docs.limit(0), public_tokenizers.path(BYTES)).count() == 0


@pytest.mark.parametrize("name", [WORDS, PIECES])
def test_other_tokenizers_take_whole_texts(spark, documents, name):
    docs = documents.where("doc_id <> 5 OR doc_id IS NULL")
    for r in tokens.with_counts(docs, public_tokenizers.path(name)).collect():
        assert r.n_tokens == whole(name, r.text or "")


def test_file_is_checked(spark, documents, tmp_path, monkeypatch):
    with pytest.raises(ValueError, match="json or .model"):
        tokens.with_counts(documents, "/opt/tokenizers/README.md")
    monkeypatch.setattr(tokens, "FILE", 1000)
    with pytest.raises(ValueError, match="larger"):
        tokens.with_counts(documents, public_tokenizers.path(BYTES))


def test_query_agrees_with_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    made = Tokenizer.from_file(public_tokenizers.path(BYTES))
    found = entry.queries()["op13_token_counts"](spark, FOLDER).collect()
    expected = {i: len(made.encode(t or "", add_special_tokens=False)) for i, t in texts.items()}
    assert {r.doc_id: r.n_tokens for r in found} == expected and len(found) == len(texts)
    assert all(r.n_bytes == len((texts[r.doc_id] or "").encode()) and r.over_limit == (r.n_tokens > 1024) for r in found)
