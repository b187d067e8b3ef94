import os

import pytest
from pyspark.sql import functions as F

from armlode.llm import tokens

pytestmark = pytest.mark.skipif(not os.path.exists(f"{tokens.TOKENIZERS}/byte_bpe_50k.tiktoken"), reason="no vocabulary files here")
TEXTS = [
    "Hello world, it's 2024!", "", None, "   ", "\n\n  \t x", "<|endoftext|> is ordinary <|endoftext|>", "naïve façade — “quotes” … ½ ٣٤", "日本語のテキスト　と空白", "🙂🙂 family 👨‍👩‍👧",
    "a" * 3000, " " * 5000 + "end", "x\r\n\r\ny z w\u0085v", "=" * 700 + "\\begin{document}", "​﻿zero", "don't DON'T we'll", "\x00\x1c\x1d control", "ab " * 2000, "word\n word  word   word",
]


def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{tokens.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return [x.ids for x in t.encode_batch([x or "" for x in TEXTS], add_special_tokens=False)]


def docs(spark):
    return spark.createDataFrame([(i, x) for i, x in enumerate(TEXTS)], "doc_id long, text string")


def test_ids_equal_the_library(spark):
    got = {r["doc_id"]: r["ids"] for r in tokens.encode_documents(docs(spark)).collect()}
    assert [got[i] for i in range(len(TEXTS))] == reference()


def test_words_beyond_the_lookup_table_are_joined(spark):
    d = docs(spark).union(docs(spark).filter("doc_id = 0"))
    got = sorted((r["doc_id"], r["ids"]) for r in tokens.encode_documents(d, limit=5).collect())
    want = reference()
    assert got == sorted([(i, want[i]) for i in range(len(TEXTS))] + [(0, want[0])])
    sizes = sorted((r["doc_id"], r["tokens"]) for r in tokens.count_tokens(d, limit=5).collect())
    assert sizes == [(i, len(x)) for i, x in got] and sizes == sorted((r["doc_id"], r["tokens"]) for r in tokens.count_tokens(d).collect())


def test_long_words_are_cut_where_no_token_reaches_across(spark):
    import random

    from tokenizers import Tokenizer

    r = random.Random(5)
    words = ["".join(r.choice(letters) for _ in range(n)) for letters, n in (("abcdefghijklmnopqrstuvwxyz", 20000), ("aQzX9é中", 5000), ("aeionrst", 400), ("的一是在不", 3000))]
    got = {r["doc_id"]: r["ids"] for r in tokens.encode_documents(spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")).collect()}
    t = Tokenizer.from_file(f"{tokens.TOKENIZERS}/byte_bpe_50k.json")
    assert [got[i] for i in range(len(words))] == [t.encode(w, add_special_tokens=False).ids for w in words]


def test_round_trip(spark):
    back = {r["doc_id"]: r["text"] for r in tokens.decode_ids(tokens.encode_documents(docs(spark))).collect()}
    assert [back[i] for i in range(len(TEXTS))] == [x or "" for x in TEXTS]


def test_words_join_to_the_text(spark):
    assert docs(spark).filter(F.array_join(tokens.words_of(F.coalesce("text", F.lit(""))), "") != F.coalesce("text", F.lit(""))).count() == 0


def test_empty_table_null_ids_and_extra_columns(spark):
    assert tokens.encode_documents(docs(spark).limit(0)).count() == 0
    d = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    for c in ("word", "ids", "parts", "table", "texts"):
        d = d.withColumn(c, F.lit(1))
    assert [r["ids"] for r in tokens.encode_documents(d).collect()] == [[64, 275]] * 3


def test_the_multilingual_vocabulary(spark):
    import tiktoken

    name = "byte_bpe_multi_50k"
    e = tiktoken.Encoding(name, pat_str=tokens.PYTHON_WORDS, mergeable_ranks=tokens.load_ranks(name), special_tokens={})
    got = {r["doc_id"]: r["ids"] for r in tokens.encode_documents(docs(spark), name).collect()}
    assert all(got[i] == e.encode_ordinary(x or "") for i, x in enumerate(TEXTS))
