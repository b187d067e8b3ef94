"""Queries of the corpus problems, over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from armlode.llm import mixing, packing, splits, tokens, truncation
from armlode.sources.tables import table


def _mix(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    return mixing.recordings(table(spark, base, "selected_episodes"), table(spark, base, "source_config")), table(spark, base, "mix_targets")


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    return mixing.unreachable_targets(*_mix(spark, base))


def p3_curriculum(spark: SparkSession, base: str) -> DataFrame:
    return mixing.curriculum(*_mix(spark, base))


def p3_shares(spark: SparkSession, base: str) -> DataFrame:
    return mixing.mixture_report(*_mix(spark, base))


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    return splits.related(table(spark, base, "episodes"), table(spark, base, "source_config"))


def p4_splits(spark: SparkSession, base: str) -> DataFrame:
    groups = splits.stored(splits.related_groups(table(spark, base, "episodes"), table(spark, base, "source_config")))
    return splits.assign_splits(groups, table(spark, base, "split_plan"))


def p6_ids(spark: SparkSession, base: str) -> DataFrame:
    return tokens.encode_documents(table(spark, base, "documents"), "byte_bpe_50k")


def p6_round_trip(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents")
    return tokens.decode_ids(tokens.encode_documents(docs, "byte_bpe_50k"), "byte_bpe_50k")


def p7_pack(spark: SparkSession, base: str) -> DataFrame:
    return packing.pack_documents(table(spark, base, "documents"), table(spark, base, "pack_plan"))


def p7_fill(spark: SparkSession, base: str) -> DataFrame:
    plan = table(spark, base, "pack_plan")
    return packing.fill_report(packing.pack_documents(table(spark, base, "documents"), plan), plan)


def p8_found(spark: SparkSession, base: str) -> DataFrame:
    return truncation.cut_texts(table(spark, base, "documents"))


def p8_shares(spark: SparkSession, base: str) -> DataFrame:
    return truncation.cut_shares(table(spark, base, "documents"))


QUERIES = {f.__name__: f for f in (p3_found, p3_curriculum, p3_shares, p4_found, p4_splits, p6_ids, p6_round_trip, p7_pack, p7_fill, p8_found, p8_shares)}

_KEY = "lower(regexp_replace({}, '[^\\p{{L}}\\p{{N}}]+', '', 'g'))"

SQL = {
    "p3_found": f"""
WITH rates AS (SELECT {_KEY.format('name')} AS source, min(CASE WHEN fps > 0 THEN fps END) AS fps FROM source_config GROUP BY 1),
once AS (SELECT {_KEY.format('source_dataset')} AS source, episode_index, max(seconds) AS own, max(frames) AS frames FROM selected_episodes GROUP BY 1, 2),
sizes AS (SELECT o.source, sum(coalesce(o.own, o.frames / r.fps)) AS held FROM once o LEFT JOIN rates r ON o.source = r.source GROUP BY 1),
listed AS (SELECT m.mixture_id, m.source_dataset, coalesce(m.weight, 0) AS weight, m.max_repeats, coalesce(s.held, 0) AS held FROM mix_targets m LEFT JOIN sizes s ON s.source = {_KEY.format('m.source_dataset')}),
full_ AS (SELECT *, sum(held) OVER (PARTITION BY mixture_id) * weight / sum(weight) OVER (PARTITION BY mixture_id) AS target FROM listed)
SELECT mixture_id, source_dataset FROM full_ WHERE target > 0 AND CASE WHEN max_repeats IS NULL THEN held = 0 ELSE target > max_repeats * held * (1 + 1e-12) END
""",
    "p4_found": f"""
WITH RECURSIVE repos AS (SELECT {_KEY.format('name')} AS source, min(lower(trim(repo_id))) AS repo FROM source_config GROUP BY 1),
e AS (SELECT episode_id, {_KEY.format('source_dataset')} AS source, regexp_replace(lower(trim(source_episode)), '\\s*(?:#\\s*\\d+\\s*[-:]\\s*\\d+|\\[\\s*\\d+\\s*[:-]\\s*\\d+\\s*\\])$', '') AS cut, {_KEY.format('task')} AS task FROM episodes WHERE episode_id IS NOT NULL),
b AS (SELECT *, regexp_replace(cut, '^(episode|recording|ep|rec)[ _.:-]*', '') AS bare FROM e),
keyed AS (SELECT DISTINCT episode_id, node FROM (
  SELECT episode_id, 'r:' || coalesce('repo:' || repo, 'source:' || b.source, '') || ':' || CASE WHEN regexp_full_match(bare, '\\d+') THEN regexp_replace(bare, '^0+(\\d)', '\\1') ELSE bare END AS node FROM b LEFT JOIN repos ON b.source = repos.source WHERE bare <> ''
  UNION ALL SELECT episode_id, 't:' || task FROM b WHERE task NOT IN ('', 'tbd', 'na', 'nan', 'none', 'null', 'nil', 'unknown', 'unlabeled', 'unlabelled', 'unnamed', 'untitled', 'nodescription', 'notask', 'notavailable', 'todo', 'undefined', 'missing', 'empty', 'unspecified', 'placeholder', 'default', 'xxx'))),
reach AS (SELECT DISTINCT episode_id, episode_id AS other FROM keyed UNION SELECT r.episode_id, y.episode_id FROM reach r JOIN keyed x ON x.episode_id = r.other JOIN keyed y ON y.node = x.node),
g AS (SELECT episode_id, min(other) AS group_id, count(*) AS n FROM reach GROUP BY 1)
SELECT episode_id, group_id FROM g WHERE n > 1
""",
    "p6_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
