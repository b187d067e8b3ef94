"""Names, paths and annotations as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(c: Column) -> Column:
    """Lower case, everything but letters and digits as one underscore, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_"))


def local_folder(repo_id: Column) -> Column:
    return F.replace(repo_id, F.lit("/"), F.lit("__"))


def archive_range(path: Column) -> tuple[Column, Column]:
    """First and last episode in an archive's name, or nulls."""
    pattern = r"/(\d+)-(\d+)\.tar$"
    return F.regexp_extract(path, pattern, 1).try_cast("bigint"), F.regexp_extract(path, pattern, 2).try_cast("bigint")


def frame_rate(c: Column) -> Column:
    """A rate written as a number or a fraction."""
    top, bottom = F.split_part(c, F.lit("/"), F.lit(1)), F.split_part(c, F.lit("/"), F.lit(2))
    return F.try_divide(top.try_cast("double"), F.when(bottom == "", 1.0).otherwise(bottom.try_cast("double")))


def chunked_path(template: str, chunk: Column, file: Column) -> Column:
    """A path with chunk and file numbers in three digits, by a printf template."""
    return F.format_string(template, chunk, file)


def start_frame(from_timestamp: Column, fps: Column) -> Column:
    """The frame nearest to a time, half to even."""
    return F.bround(from_timestamp * fps).cast("bigint")


def action_frames(label: Column) -> Column:
    """The last end frame among an annotation's actions, 0 where it has none."""
    return F.coalesce(F.array_max(F.transform(label["action_config"], lambda a: a["end_frame"].cast("bigint"))), F.lit(0).cast("bigint"))


def annotation_frames(annotation: Column) -> Column:
    """:func:`action_frames` of an annotation in JSON, whose labels may stand under a misspelt key; 0 where it is broken or has none."""
    kind = "struct<action_config:array<struct<end_frame:bigint>>>"
    label = lambda key: F.from_json(F.get_json_object(annotation, f"$.{key}"), kind)
    return F.greatest(action_frames(F.coalesce(label("label_info"), label("lable_info"))), F.lit(0).cast("long"))
