import os
import random

import pytest
from pyspark.sql import functions as F

from armlode.llm import packing, tokens

pytestmark = pytest.mark.skipif(not os.path.exists(f"{tokens.TOKENIZERS}/byte_bpe_50k.tiktoken"), reason="no vocabulary files here")
PLAN = "plan_id int, tokenizer string, capacity_tokens long"


def check(rows, sizes, capacity):
    """Every text is in whole, pieces only of texts beyond the capacity, no container is overfull."""
    by, fill = {}, {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["first_token"], r["tokens"]))
        fill[r["container_id"]] = fill.get(r["container_id"], 0) + r["tokens"]
    assert max(fill.values(), default=0) <= capacity
    for doc, n in sizes.items():
        parts = sorted(by.get(doc, []))
        assert sum(t for _, t in parts) == n and (len(parts) <= 1 or n > capacity)
        at = 0
        for first, t in parts:
            assert first == at
            at += t
    return sum(fill.values()) / (capacity * max(1, len(fill)))


def test_packing_is_whole_and_tight(spark):
    rng = random.Random(4)
    sizes = {i: rng.choice((rng.randrange(1, 400), rng.randrange(1, 3000), 512)) for i in range(4000)} | {5000: 0, 5001: 512 * 4}
    d = spark.createDataFrame([(i, 1, 512, n) for i, n in sizes.items()] + [(i, 2, 8192, n) for i, n in sizes.items()], "doc_id long, plan_id int, capacity long, tokens long")
    rows = packing.pack(d).collect()
    assert check([r for r in rows if r["plan_id"] == 1], sizes, 512) > 0.95
    assert check([r for r in rows if r["plan_id"] == 2], sizes, 8192) > 0.95


def test_windows_are_bounded_and_best_fit():
    ids = iter(range(99))
    w = packing._Windows(10, 2, lambda: next(ids))
    assert [w.place(n) for n in (6, 7, 3, 4)] == [0, 1, 1, 0]  # 3 fills the tighter one
    w = packing._Windows(10, 2, lambda: next(ids))
    a, b, c = w.place(6), w.place(7), w.place(8)  # the fullest, b, is closed for c
    assert len({a, b, c}) == 3 and w.place(4) == a and len(w.open) <= 2


@pytest.mark.parametrize("name", ["byte_bpe_50k", "byte_bpe_multi_50k", "piece_bpe_32k", "word_bpe_49k"])
def test_counts_equal_the_library(spark, name):
    texts = ["Hello  world\n\n  again", "", None, "   ", " a b ", "naïve—日本 語", "x" * 2000, "\n x\n  y \n", "<s> text </s> <|endoftext|>", "word " * 500]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = [r["n0"] for r in packing.token_counts(d, [name]).orderBy("doc_id").collect()]
    if name.startswith("piece"):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=f"{tokens.TOKENIZERS}/{name}.model")
        want = [len(m.encode(t or "")) for t in texts]
    elif name.startswith("byte"):
        import tiktoken

        e = tiktoken.Encoding(name, pat_str=tokens.PYTHON_WORDS, mergeable_ranks=tokens.load_ranks(name), special_tokens={})
        want = [len(e.encode_ordinary(t or "")) for t in texts]
    else:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(f"{tokens.TOKENIZERS}/{name}.json")
        t.encode_special_tokens = True
        want = [len(x.ids) for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    assert got == want


def test_documents_plans_and_edges(spark):
    docs = spark.createDataFrame([(i, "word " * n) for i, n in enumerate((0, 1, 30, 2000))] + [(None, "lost"), (9, None), (1, "word ")], "doc_id long, text string")
    plan = spark.createDataFrame([(1, "byte_bpe_50k", 64), (2, "piece_bpe_32k", 128), (3, "byte_bpe_50k", None), (None, "byte_bpe_50k", 9)], PLAN)
    for c in ("tokens", "n0", "piece", "plan_id"):
        docs = docs.withColumn(c, F.lit(1))
    packed = packing.pack_documents(docs, plan)
    rows = packed.collect()
    assert {r["plan_id"] for r in rows} == {1, 2} and {r["doc_id"] for r in rows} == {1, 2, 3}
    rep = {r["plan_id"]: r for r in packing.fill_report(packed, plan).collect()}
    assert all(0 < r["used_share"] <= 1 for r in rep.values())
    assert packing.pack_documents(docs.limit(0), plan).count() == 0 and packing.pack_documents(docs, plan.limit(0)).count() == 0


def test_no_row_of_a_long_plan_is_lost(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, "four")], "doc_id long, text string")
    plan = spark.range(5000).select(F.col("id").cast("int").alias("plan_id"), F.lit("byte_bpe_50k").alias("tokenizer"), (F.col("id") + 3).alias("capacity_tokens"))
    got = packing.pack_documents(docs, plan).groupBy("plan_id").agg(F.count_distinct("doc_id").alias("n")).filter("n = 2").count()
    assert got == 5000
