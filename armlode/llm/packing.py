"""Filling fixed-capacity containers: bounded-space best-fit packing of texts by their tokens."""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armlode.llm import tokens
from armlode.operators.scale import bounded_broadcast, durable

#: Open windows per plan and partition.
OPEN_WINDOWS = 128
#: Segments whose counts one task remembers.
REMEMBERED = 400_000
#: Left-over containers that one merging task takes; more are merged in several tasks.
MERGE_ROWS = 200_000
#: Tokenizers that one call may size texts by, each a column; more are an error. Parts over which texts and plans of a tokenizer meet.
MOST_TOKENIZERS, SPREAD = 64, 64


def _counter(name: str, folder: str):
    """texts -> token counts by the tokenizer's own library.

    A text is cut where no token can cross: before white space (byte-level), before spaces (pieces, whose dummy space is put
    in front). Counts of segments are remembered within a task, at most REMEMBERED of them.
    """

    class Counts(dict):
        def __init__(self, size):
            self.size = size

        def __missing__(self, segment):
            if len(self) >= REMEMBERED:
                self.clear()
            n = self[segment] = self.size(segment)
            return n

    if name.startswith("piece"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{name}.model")
        counts = Counts(lambda s: 1 if s == " " else len(model.encode(s[1:])))
        cut, front = re.compile(" +[^ ]*"), " "
    elif name.startswith("byte_bpe"):
        import tiktoken

        model = tiktoken.Encoding(name, pat_str=tokens.PYTHON_WORDS, mergeable_ranks=tokens.load_ranks(name, folder), special_tokens={})
        counts = Counts(lambda s: len(model.encode_ordinary(s)))
        cut, front = re.compile(f"[{tokens.PYTHON_SPACE}]*[^{tokens.PYTHON_SPACE}]+|[{tokens.PYTHON_SPACE}]+"), ""
    else:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(f"{folder}/{name}.json")
        model.encode_special_tokens = True
        return lambda texts: [len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)]
    get, find = counts.__getitem__, cut.findall
    return lambda texts: [sum(map(get, find(front + t))) if t else 0 for t in texts]


def token_counts(documents: DataFrame, names: list[str], folder: str = tokens.TOKENIZERS) -> DataFrame:
    """doc_id and, per tokenizer, the tokens of every text, in one pass; null and empty texts have none."""
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters = [_counter(n, folder) for n in names]
        for frame in frames:
            texts = frame["text"].tolist()
            yield pd.DataFrame({"doc_id": frame["doc_id"]} | {f"n{i}": c(texts) for i, c in enumerate(counters)})

    return docs.mapInPandas(count, ", ".join(["doc_id long", *(f"n{i} long" for i in range(len(names)))]))


def items(sizes: DataFrame) -> DataFrame:
    """(plan_id, capacity, doc_id, piece, first_token, tokens): texts as items, only those larger than the capacity in pieces of it."""
    cut = F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / F.col("capacity")).cast("long"))
    rows = sizes.filter("tokens > 0").select("plan_id", "capacity", "doc_id", "tokens", F.explode(cut).alias("piece"))
    first = F.col("piece") * F.col("capacity")
    return rows.select("plan_id", "capacity", "doc_id", "piece", first.alias("first_token"), F.least(F.col("capacity"), F.col("tokens") - first).cast("long").alias("tokens"))


class _Windows:
    """A fixed number of open containers of one plan, best fit first."""

    def __init__(self, capacity: int, most: int, fresh) -> None:
        self.capacity, self.most, self.fresh = capacity, most, fresh
        self.open: list[tuple[int, int]] = []  # (room, container)

    def place(self, size: int) -> int:
        """The container that the item goes to; the fullest is closed when none fits and all are open."""
        at = bisect_left(self.open, (size, -1))
        if at < len(self.open):
            room, container = self.open.pop(at)
        else:
            if len(self.open) >= self.most:
                self.open.pop(0)
            room, container = self.capacity, self.fresh()
        if room > size:
            insort(self.open, (room - size, container))
        return container


def pack(sizes: DataFrame, windows: int = OPEN_WINDOWS) -> DataFrame:
    """(plan_id, doc_id, piece, first_token, tokens, container_id) from ``sizes`` (plan_id, capacity, doc_id, tokens).

    Each partition packs its items as they come, into a bounded number of open windows a plan; what windows
    are open at its end is merged with those of other partitions, as whole containers. Memory is bounded by the
    windows; results are written before the merge, so a lost task cannot pack anew.
    """
    mixed = items(sizes).repartition(F.xxhash64("doc_id", "piece")).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "piece", "plan_id")

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = iter(range(TaskContext.get().partitionId() << 40, 1 << 62))
        packers: dict[int, _Windows] = {}
        for frame in frames:
            got = []
            for plan, capacity, size in zip(frame["plan_id"].tolist(), frame["capacity"].tolist(), frame["tokens"].tolist()):
                packer = packers.get(plan)
                if packer is None:
                    packer = packers[plan] = _Windows(capacity, windows, lambda: next(counter))
                got.append(packer.place(size))
            yield frame.assign(container_id=got)

    placed = durable(mixed.mapInPandas(place, "plan_id int, capacity long, doc_id long, piece long, first_token long, tokens long, container_id long"))
    used = placed.groupBy("plan_id", "container_id").agg(F.first("capacity").alias("capacity"), F.sum("tokens").alias("used"))
    loose = durable(used.filter(F.col("used") <= F.col("capacity") * 0.9))
    tasks = max(1, -(-loose.count() // MERGE_ROWS))

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packers: dict[int, _Windows] = {}
        for frame in frames:
            got = []
            for plan, capacity, container, size in zip(frame["plan_id"].tolist(), frame["capacity"].tolist(), frame["container_id"].tolist(), frame["used"].tolist()):
                packer = packers.setdefault(plan, _Windows(capacity, MERGE_ROWS, None))
                packer.fresh = lambda c=container: c
                got.append(packer.place(size))
            yield pd.DataFrame({"plan_id": frame["plan_id"], "container_id": frame["container_id"], "merged": got})

    spread = F.pmod(F.xxhash64("container_id"), F.lit(tasks))
    merged = loose.withColumn("_task", spread).repartition(tasks, "_task").sortWithinPartitions("_task", F.desc("used"), "plan_id", "container_id").drop("_task").mapInPandas(merge, "plan_id int, container_id long, merged long")
    moved = durable(merged.filter("merged <> container_id"))
    return placed.join(moved, ["plan_id", "container_id"], "left").select("plan_id", "doc_id", "piece", "first_token", "tokens", F.coalesce("merged", "container_id").alias("container_id"))


def pack_documents(documents: DataFrame, plan: DataFrame, folder: str = tokens.TOKENIZERS) -> DataFrame:
    """Every text in containers, for each row of the plan: (plan_id, doc_id, piece, first_token, tokens, container_id).

    Texts are sized once in tokens of each tokenizer that the plan names, and joined with the plan's rows by tokenizer, however many there are. Texts without tokens
    take no container and give no row; only a text larger than the capacity is divided, into pieces of the capacity and a rest. Plans with a null or
    non-positive capacity are skipped, as are rows with a null doc_id; of rows with one plan_id the one of least capacity counts. Texts sent again are packed again.
    """
    fine = plan.filter("plan_id is not null and capacity_tokens > 0 and tokenizer is not null")
    rows = fine.groupBy("plan_id").agg(F.min(F.struct(F.col("capacity_tokens").cast("long").alias("capacity"), "tokenizer")).alias("r")).select(F.col("plan_id").cast("int").alias("plan_id"), "r.*")
    names = [r["tokenizer"] for r in rows.select("tokenizer").distinct().orderBy("tokenizer").limit(MOST_TOKENIZERS + 1).collect()]
    if len(names) > MOST_TOKENIZERS:
        raise ValueError(f"the plan names more than {MOST_TOKENIZERS} tokenizers")
    if not names:
        return documents.sparkSession.createDataFrame([], "plan_id int, doc_id long, piece long, first_token long, tokens long, container_id long")
    counted = durable(token_counts(documents.filter("doc_id is not null"), names, folder))
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("tokenizer"), F.col(f"n{i}").alias("tokens")) for i, n in enumerate(names)]))
    # few tokenizers are few keys: rows of either side are spread over SPREAD parts of each
    sizes = counted.select("doc_id", each.alias("s")).select("doc_id", "s.*").withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)))
    plans = rows.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
    return pack(sizes.join(bounded_broadcast(plans), ["tokenizer", "_part"]).select("plan_id", "capacity", "doc_id", "tokens"))


def fill_report(packed: DataFrame, plan: DataFrame) -> DataFrame:
    """Per plan: containers, items, tokens and the part of the containers' capacity that is used."""
    sums = packed.groupBy("plan_id").agg(F.countDistinct("container_id").alias("containers"), F.count("*").alias("items"), F.sum("tokens").alias("tokens"))
    return sums.join(plan.select("plan_id", "capacity_tokens"), "plan_id").select("plan_id", "capacity_tokens", "containers", "items", "tokens", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("used_share"))
