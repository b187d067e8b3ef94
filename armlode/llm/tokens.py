"""Encoding texts with a public byte-level BPE tokenizer, by higher-order functions over distinct words."""

from __future__ import annotations

import base64
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from armlode.operators.scale import durable

#: Where the vocabulary files are.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
#: Fixed value: how byte-level BPE cuts a text into words, with Unicode's white space spelled out.
_SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORDS = rf"'(?:s|t|re|ve|m|ll|d)| ?\p{{L}}++| ?\p{{N}}++| ?[^{_SPACE}\p{{L}}\p{{N}}]++|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]++"
#: The same in Python's notation.
PYTHON_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PYTHON_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The most frequent words, at most so many, are looked up in a table that every task holds; all others are joined.
LOOKUP_WORDS = 1 << 17
#: Buckets of the literal rank map and of the lookup table.
RANK_BUCKETS, WORD_BUCKETS = 1 << 13, 1 << 16
#: Token ids are kept as characters from this code point on while merges run.
_FIRST_CHAR = 0x100
#: What stands between the pieces of a word; no token has this character.
_CUT = "|"


def load_ranks(name: str, folder: str = TOKENIZERS) -> dict[bytes, int]:
    """A vocabulary as bytes -> rank; a rank is the token's id."""
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in f if line.strip())}


def words_of(text: Column) -> Column:
    """The words of a text, in order; they join to the text again."""
    return F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))


def constant(df: DataFrame, column: str, name: str) -> Column:
    """The one value of ``df`` as a literal: a session variable, which may be used within higher-order functions."""
    spark, view = df.sparkSession, f"_{name}_rows"
    kind = df.select(column).schema[0].dataType.simpleString()
    df.createOrReplaceTempView(view)
    spark.sql(f"DECLARE OR REPLACE VARIABLE {name} {kind}")
    spark.sql(f"SET VAR {name} = (SELECT {column} FROM {view})")
    spark.catalog.dropTempView(view)
    return F.col(f"system.session.{name}")


def _literal(spark: SparkSession, values: list, schema: str, name: str) -> Column:
    """A literal array of ``values`` in their order."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {schema}")
    ordered = rows.agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("e")).select(F.col("e.v").alias("v"))
    return constant(ordered, "v", name)


def _rank_map(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """Literal map (left id, right id) -> id of the merge, in buckets of a few pairs each."""
    buckets: list[tuple[list[int], list[int]]] = [([], []) for _ in range(RANK_BUCKETS)]
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            a, b = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if a is not None and b is not None:
                key = (a << 20) + b
                ks, vs = buckets[key % 8191 % RANK_BUCKETS]
                ks.append(key)
                vs.append(rank)
    return _literal(spark, buckets, "struct<k:array<bigint>,v:array<int>>", "bpe_ranks")


def _followers(ranks: dict[bytes, int]) -> list[bytearray]:
    """For each byte 256 flags: the bytes that come right after it in any token."""
    flags = [bytearray(256) for _ in range(256)]
    for piece in ranks:
        for a, b in zip(piece, piece[1:]):
            flags[a][b] = 1
    return flags


def encode_word(spark: SparkSession, word: Column, ranks: dict[bytes, int]) -> Column:
    """The token ids of a word: its bytes, cut into pieces, then ranked merges folded over each piece.

    A word is cut between two bytes that stand side by side in no token of the vocabulary: no merge can ever cross
    such a place, so the pieces' ids in order are the word's. Each step of a fold merges, from left to right, every
    place of the pair that comes first in rank, as a replacement of two characters by one; steps after the last merge
    pass the piece on. A step touches one piece only, so a long word costs in proportion to its pieces.
    """
    table = _rank_map(spark, ranks)
    chars = _literal(spark, [chr(_FIRST_CHAR + i) for i in range(max(ranks.values()) + 1)], "string", "bpe_chars")
    byte_ids = _literal(spark, [ranks[bytes([b])] for b in range(256)], "int", "bpe_bytes")
    hexes = F.regexp_extract_all(F.hex(F.encode(word, "utf-8")), F.lit(".."), F.lit(0))
    numbers = F.transform(hexes, lambda h: F.conv(h, 16, 10).cast("int"))
    together = _literal(spark, _followers(ranks), "binary", "bpe_followers")
    apart = lambda a, b: F.substring(F.get(together, a), b + 1, 1) == F.lit(b"\0")
    char = lambda n: F.get(chars, F.get(byte_ids, n))
    # the last byte has no follower: it is joined with a null
    marked = F.zip_with(numbers, F.slice(numbers, F.lit(2), F.greatest(F.size(numbers) - 1, F.lit(0))), lambda a, b: F.concat(char(a), F.when(apart(a, b), F.lit(_CUT)).otherwise(F.lit(""))))
    pieces = F.split(F.array_join(marked, ""), rf"\{_CUT}")

    def merged(a: Column, b: Column) -> Column:
        key = F.shiftleft(a.cast("long"), 20) + b
        bucket = F.get(table, (key % 8191 % RANK_BUCKETS).cast("int"))
        return F.get(bucket["v"], (F.array_position(bucket["k"], key) - 1).cast("int"))

    def step(state: Column, _: Column) -> Column:
        ids, n = state["ids"], F.size(state["ids"])
        found = F.zip_with(F.slice(ids, F.lit(1), n - 1), F.slice(ids, F.lit(2), n - 1), merged)
        best = F.array_min(found)
        at = F.array_position(found, best).cast("int")
        text = F.array_join(F.transform(ids, lambda i: F.get(chars, i)), "")
        pair = F.concat(F.get(chars, F.get(ids, at - 1)), F.get(chars, F.get(ids, at)))
        after = F.transform(F.split(F.replace(text, pair, F.get(chars, best)), ""), lambda c: (F.ascii(c) - _FIRST_CHAR).cast("int"))
        return F.when(state["done"] | (n < 2), state).otherwise(F.when(best.isNull(), F.struct(ids.alias("ids"), F.lit(True).alias("done"))).otherwise(F.struct(after.alias("ids"), F.lit(False).alias("done"))))

    def folded(piece: Column) -> Column:
        first = F.transform(F.split(piece, ""), lambda c: (F.ascii(c) - _FIRST_CHAR).cast("int"))
        start = F.struct(first.alias("ids"), F.lit(False).alias("done"))
        return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(piece) - 1, F.lit(1))), start, step, lambda s: s["ids"])

    return F.flatten(F.transform(pieces, folded))


def encoded_words(documents: DataFrame, tokenizer: str, folder: str = TOKENIZERS) -> DataFrame:
    """(word, ids, texts): every distinct word of all texts, encoded once, and how many texts hold it."""
    words = documents.select(F.explode(F.array_distinct(words_of(F.col("text")))).alias("word")).groupBy("word").agg(F.count("*").alias("texts"))
    return durable(words.select("word", encode_word(documents.sparkSession, F.col("word"), load_ranks(tokenizer, folder)).alias("ids"), "texts"))


def lookup_table(words: DataFrame, value: str, limit: int = LOOKUP_WORDS) -> DataFrame:
    """One row holding the ``limit`` most frequent words in hash buckets: an array of maps.

    Its size is bounded by ``limit`` words, whatever the corpus; words beyond it are left to a join.
    """
    top = words.orderBy(F.desc("texts"), "word").limit(limit)
    bucketed = top.groupBy(_bucket(F.col("word")).alias("b")).agg(F.map_from_entries(F.collect_list(F.struct("word", F.col(value).alias("v")))).alias("m"))
    every = words.sparkSession.range(WORD_BUCKETS).join(bucketed, F.col("id") == F.col("b"), "left")
    # structs that hold maps have no order of their own: they are put in the order of their buckets
    return every.agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("m", F.create_map().cast(bucketed.schema["m"].dataType)).alias("m"))), lambda a, b: (a["id"] - b["id"]).cast("int")).alias("e")).select(F.col("e.m").alias("table"))


def _bucket(word: Column) -> Column:
    return F.hash(word).bitwiseAND(F.lit(WORD_BUCKETS - 1))


def lookup(table: Column, word: Column) -> Column:
    """What the table holds for a word, or null."""
    return F.try_element_at(F.get(table, _bucket(word)), word)


def encode_documents(documents: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS, limit: int = LOOKUP_WORDS) -> DataFrame:
    """(doc_id, ids): each text's token ids without special tokens.

    Null and empty texts give an empty list, blank texts their tokens; strings that look like
    special tokens are ordinary text. Each distinct word is encoded once; texts are then put together
    from a lookup table of the most frequent words, and words outside it by a join on the word. Rows sent again give rows
    again; a null doc_id is kept. An empty table gives no rows; extra columns are ignored.
    """
    docs = documents.select("doc_id", "text")
    words = encoded_words(docs, tokenizer, folder)
    table = constant(lookup_table(words, "ids", limit), "table", "word_ids")
    parts = docs.select("doc_id", "text", F.transform(words_of(F.coalesce("text", F.lit(""))), lambda w: lookup(table, w)).alias("parts"))
    if words.limit(limit + 1).count() <= limit:
        return parts.select("doc_id", F.flatten("parts").alias("ids"))
    return _with_rest(docs, words, limit, table)


def _with_rest(docs: DataFrame, words: DataFrame, limit: int, table: Column) -> DataFrame:
    """The same for a vocabulary larger than the lookup table: the other words are joined by word and put in by place."""
    rows = docs.withColumn("_row", F.struct(F.xxhash64("text"), F.monotonically_increasing_id()))
    rows = durable(rows)
    placed = rows.select("_row", F.posexplode(words_of(F.coalesce("text", F.lit("")))).alias("at", "word")).withColumn("ids", lookup(table, F.col("word")))
    rare = words.join(words.orderBy(F.desc("texts"), "word").limit(limit).select("word"), "word", "left_anti").select("word", F.col("ids").alias("more"))
    joined = placed.filter("ids is null").drop("ids").join(rare, "word").groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("at", "more"))).alias("rest"))
    whole = rows.join(joined, "_row", "left").withColumn("words", words_of(F.coalesce("text", F.lit(""))))
    parts = F.transform("words", lambda w, i: F.coalesce(lookup(table, w), F.try_element_at("rest", i)))
    return whole.select("doc_id", F.flatten(parts).alias("ids"))


def count_tokens(documents: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS, limit: int = LOOKUP_WORDS) -> DataFrame:
    """(doc_id, tokens): the number of ids of each text, without making them."""
    docs = documents.select("doc_id", "text")
    words = encoded_words(docs, tokenizer, folder).withColumn("n", F.size("ids").cast("long"))
    table = constant(lookup_table(words, "n", limit), "table", "word_counts")
    known = F.aggregate(words_of(F.coalesce("text", F.lit(""))), F.lit(0).cast("long"), lambda n, w: n + F.coalesce(lookup(table, w), F.lit(0)))
    if words.limit(limit + 1).count() <= limit:
        return docs.select("doc_id", known.alias("tokens"))
    rare = words.join(words.orderBy(F.desc("texts"), "word").limit(limit).select("word"), "word", "left_anti").select("word", "n")
    rows = durable(docs.withColumn("_row", F.struct(F.xxhash64("text"), F.monotonically_increasing_id())))
    more = rows.select("_row", F.explode(words_of(F.coalesce("text", F.lit("")))).alias("word")).filter(lookup(table, F.col("word")).isNull()).join(rare, "word").groupBy("_row").agg(F.sum("n").alias("more"))
    return rows.join(more, "_row", "left").select("doc_id", (known + F.coalesce("more", F.lit(0))).alias("tokens"))


def decode_ids(encoded: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): the binary pieces of the ids, concatenated in order and read as UTF-8."""
    ranks = load_ranks(tokenizer, folder)
    pieces = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex()
    hexes = _literal(encoded.sparkSession, pieces, "string", "bpe_pieces")
    return encoded.select("doc_id", F.decode(F.unhex(F.array_join(F.transform("ids", lambda i: F.get(hexes, i)), "")), "utf-8").alias("text"))
